"""Removal of repeated text by hashing lines, the sentences in them and windows.

Units are lines, cut further behind sentence ends. Windows of ``min_words`` words
are taken besides, at places that the words alone set (the window of smallest
hash among any ``SPREAD`` neighbouring ones), so that passages which begin and
end inside sentences meet too: a repeat of ``min_words + SPREAD - 1`` words (50)
or more holds at least one such window. Units and windows are normalised (lower
case, runs of white space as one blank) and digested. Digests are grouped over
all documents; the earliest occurrence by (doc_id, word) is the one that stays.
Later ones that touch and copy the same place are joined and, from ``min_words``
words on, compared with that place word by word at both ends, up to ``EDGE`` words,
unless other runs of the text cover those words already. A run of words that all
have an earlier occurrence is removed when it holds at least ``min_words``
words, so that a short sentence which recurs by chance stays where it is. What
remains keeps its characters, and every removed span is reported by its offsets
in the original text.

Only digests and positions are shuffled while grouping, counted per task first,
so a line that occurs in every document is one row per task. The words at the
ends of runs are read once for each place of an earlier document.

Defined cases: a null text stays null and has no spans, an empty one stays
empty; blank units are never compared; rows of one doc_id with different texts
are ordered by a hash of the text; rows equal in doc_id and text count as one
document and are cut alike, so all of them stay or go; a null doc_id comes last in
the order; a passage that overlaps its own copy, as in a loop of one word, keeps its
first occurrence whole; extra columns are carried through by
:func:`remove_repeats`.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from hashlib import blake2b
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm.common import STEP, STEP_BACK, drop, hash_spans, hash_words, keep, mixed, power

#: Words a repeated run must hold to be removed.
MIN_WORDS = 20
#: Neighbouring windows of which one is taken.
SPREAD = 31
#: Words compared at each end of a run.
EDGE = SPREAD
#: What tells copies of a place in a text from others.
COPY = ["doc_id", "version", "from_id", "from_version", "shift"]
#: Units and windows handed to Spark at a time.
ROWS = 10_000
#: Characters of text digested at a time; a longer text is taken alone.
CHARS = 1 << 17
#: What ends a unit: a line break, or white space behind a sentence end.
BREAK = re.compile(r"\n|(?<=[.!?])[^\S\n]+\n?")
#: Code points that are white space; the last entry stands for all beyond.
BLANK = np.array([chr(c).isspace() for c in range(0x3002)])
#: The bytes that end a sentence.
STOP = np.isin(np.arange(256), list(b".!?"))


def units(text: str) -> list[tuple[int, int, list[str]]]:
    """(begin, end, words) of a text's units, in order and without gaps.

    Blank stretches belong to the unit before them, or to the first one.
    """
    found: list[tuple[int, int, list[str]]] = []
    begin = 0
    for end in [*(m.end() for m in BREAK.finditer(text)), len(text)]:
        words = text[begin:end].lower().split()
        if words:
            found.append((begin, end, words))
        elif found:
            found[-1] = (found[-1][0], end, found[-1][2])
        else:
            continue
        begin = end
    return found


def windows(words: list[str], size: int = MIN_WORDS, spread: int = SPREAD) -> list[int]:
    """Places of the windows of ``size`` words that are taken, in order.

    Of any ``spread`` neighbouring windows one is: the first of smallest hash.
    Which one depends on their words only.
    """
    return _places(hash_words("\n".join(words)), np.array([len(words)]), size, spread).tolist()


def _places(hashes: np.ndarray, ends: np.ndarray, size: int, spread: int) -> np.ndarray:
    """Places of the windows taken from texts that lie behind each other and end at ``ends``."""
    n = len(hashes) - size + 1
    if n < spread:
        return np.zeros(0, np.int64)
    # A window's hash is the polynomial of its words' hashes, taken from running sums.
    with np.errstate(over="ignore"):
        sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * power(STEP_BACK, len(hashes)), out=sums[1:])
        sums = (sums[size:] - sums[:-size]) * power(STEP, n + size - 1)[size - 1 :]
    near = np.lib.stride_tricks.sliding_window_view(mixed(sums), spread)
    # A slice at a time, so that a long text does not fill the memory.
    chosen = [near[at : at + ROWS].argmin(axis=1) + np.arange(at, min(at + ROWS, len(near))) for at in range(0, len(near), ROWS)]
    # Neighbours lie in one text.
    begins = np.concatenate([[0], ends[:-1]])
    inside = np.repeat(ends, ends - begins)[: len(near)] >= np.arange(size + spread - 1, size + spread - 1 + len(near))
    # The first of smallest hash only moves on, so equal places are neighbours.
    chosen = np.concatenate(chosen)[inside]
    return chosen[np.diff(chosen, prepend=-1) != 0]


def _digested(min_words: int):
    def rows_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        """Units and windows of texts: the number of their text, where they begin and end in it, and their digests."""
        words, lines, ends = [], [], []
        for text in texts:
            for line in text.lower().split("\n"):
                words += line.split()
                lines.append(len(words))
            ends.append(len(words))
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32), []
        # Units and windows are stretches of the words, which are put together once.
        data = " ".join(words).encode("utf-8", "surrogatepass")
        held = np.frombuffer(data, np.uint8)
        blank = np.flatnonzero(held == 32)
        begin, end = np.concatenate([[0], blank + 1]), np.concatenate([blank, [len(data)]])
        # The units of :func:`units`: they end with a line or with a word that ends a sentence.
        stop = np.concatenate([[False], STOP[held[end - 1]]])
        stop[lines] = True
        stop[0] = False
        reached = np.flatnonzero(stop)
        ends = np.array(ends, np.int64)
        places = _places(hash_spans(data, begin, end), ends, min_words, SPREAD)
        first = np.concatenate([[0], reached[:-1], places])
        last = np.concatenate([reached, places + min_words])
        digests = [blake2b(data[a:b], digest_size=12).digest() for a, b in zip(begin[first].tolist(), end[last - 1].tolist())]
        text = np.searchsorted(ends, first, side="right")
        before = np.concatenate([[0], ends])[text]
        return text, (first - before).astype(np.int32), (last - before).astype(np.int32), digests

    def digested(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = batch["text"].str.len().cumsum().to_numpy()
            at = 0
            while at == 0 or at < len(batch):
                # As many texts as CHARS hold, one at least.
                upto = max(int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + CHARS, side="right")), at + 1)
                of = batch[at:upto]
                text, first, last, digests = rows_of(of["text"].tolist())
                made = {name: of[name].to_numpy()[text] for name in ("doc_id", "version")}
                made = pd.DataFrame(made | {"first": first, "last": last, "digest": digests})
                for row in range(0, max(len(made), 1), ROWS):
                    yield made[row : row + ROWS]
                at = upto

    return digested


def _edges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The words before and behind places of earlier documents."""
    columns = ["from_id", "from_version", "at", "before", "behind"]
    for batch in batches:
        rows = []
        for doc_id, version, places, text in zip(batch["from_id"], batch["from_version"], batch["places"], batch["text"]):
            words = text.lower().split()
            for at in places.tolist():
                rows.append((doc_id, version, at, " ".join(words[max(at - EDGE, 0) : at]), " ".join(words[at : at + EDGE])))
                if len(rows) == ROWS:
                    yield pd.DataFrame(rows, columns=columns)
                    rows = []
        yield pd.DataFrame(rows, columns=columns)


def _common(a: list[str], b: list[str]) -> int:
    """How many words at the beginning are the same."""
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def spans_of(text: str, runs: Iterable[tuple[int, int, int, str, str]], min_words: int = MIN_WORDS) -> list[dict[str, int]]:
    """The [begin, end) characters to remove, from runs of repeated words: where they begin and end, the least place that
    they can begin at, and the words before and behind their earlier copies."""
    words = text.lower().split()
    reach = []
    for first, last, own, before, behind in runs:
        if before:
            first -= _common(words[max(first - EDGE, 0) : first][::-1], before.split()[::-1])
        if behind:
            last += _common(words[last : last + EDGE], behind.split())
        first = max(first, own)
        if first < last:
            reach.append((first, last))
    joined: list[list[int]] = []
    for first, last in sorted(reach):
        if joined and first <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], last)
        else:
            joined.append([first, last])
    joined = [run for run in joined if run[1] - run[0] >= min_words]
    if not joined:
        return []
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    blank = BLANK[np.minimum(points, len(BLANK) - 1)]
    begins = np.flatnonzero(np.concatenate([blank[:-1] & ~blank[1:], [True]])) + 1
    # Blanks before the first word belong to it.
    begins = np.concatenate([[0], begins[int(blank[0]) :]])
    return [{"begin": int(begins[first]), "end": int(begins[last])} for first, last in joined]


def _new(*columns: pa.ChunkedArray) -> np.ndarray:
    """Whether a row differs from the one before it in any of the columns."""
    codes = [c.combine_chunks().dictionary_encode("encode").indices.to_numpy() for c in columns]
    return np.any([np.diff(c, prepend=-1) != 0 for c in codes], axis=0)


def _fresh(group: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Where ranges begin that neither touch nor overlap an earlier one of their group, in order of group and ``first``."""
    reached = np.maximum.accumulate((group << 33) + last)
    return np.flatnonzero(np.concatenate([[True], (group[1:] << 33) + first[1:] > reached[:-1]])[: len(group)])


def _joined(min_words: int):
    def runs_of(rows: pa.Table) -> pa.RecordBatch:
        """The runs of whole texts that a chain suffices for, with the places to compare words at."""
        text = np.cumsum(_new(rows["doc_id"], rows["version"]))
        copy = np.cumsum(_new(*(rows[c] for c in COPY)))
        first, last, shift = (rows[c].to_numpy().astype(np.int64) for c in ("first", "last", "shift"))
        # Units that touch or overlap and copy the same place are one run.
        row = _fresh(copy, first, last)
        text, first, last = text[row], first[row], np.maximum.reduceat(last, row)
        # Ends are compared where a run suffices by itself, as every repeat of 50
        # words has one; shorter ones count only in a chain that suffices.
        wide = last - first >= min_words
        low, high = first + np.where(wide, 0, EDGE), last + np.where(wide, 2 * EDGE, EDGE)
        order = np.lexsort((high, low, text))
        chains = _fresh(text[order], low[order], high[order])
        reach = np.maximum.reduceat(high[order], chains) - low[order][chains]
        kept = order[np.repeat(reach >= min_words, np.diff(chains, append=len(order)))]
        row, text, first, last, wide = (of[kept] for of in (row, text, first, last, wide))
        shift, itself = shift[row], rows["itself"].to_numpy()[row]
        # Only what runs cover together counts, so those that copy other texts are
        # joined, and words compared only where they can reach beyond that.
        order = np.flatnonzero(~itself)
        order = order[np.lexsort((first[order], text[order]))]
        begun = _fresh(text[order], first[order], last[order])
        sizes = np.diff(begun, append=len(order))
        begin, end = first[order][begun], np.maximum.reduceat(last[order], begun) if len(begun) else begun
        least, most = np.zeros((2, len(row)), np.int64)
        least[order], most[order] = np.repeat(begin, sizes), np.repeat(end, sizes)
        before = wide & (itself | ((least > 0) & (first - EDGE < least)))
        behind = wide & (itself | (last + EDGE > most))
        one = np.flatnonzero(itself | before | behind)
        # Joined ranges, which have no source, and then runs one by one.
        single = np.arange(len(begun) + len(one)) >= len(begun)
        at = np.concatenate([row[order][begun], row[one]])

        def cells(of_joined: np.ndarray | int, of_one: np.ndarray, told: np.ndarray | None = None) -> pa.Array:
            values = np.zeros(len(at), np.int32)
            values[~single], values[single] = of_joined, of_one[one]
            unknown = ~single
            if told is not None:
                unknown[single] = ~told[one]
            return pa.array(values, mask=None if told is None else unknown)

        made = {c: rows[c].combine_chunks().take(pa.array(at)) for c in ("doc_id", "version")}
        made |= {c: rows[c].combine_chunks().take(pa.array(at, mask=~single)) for c in ("from_id", "from_version")}
        made |= {"first": cells(begin, first), "last": cells(end, last), "own": cells(0, np.where(itself, last - shift, 0))}
        made |= {"start": cells(0, first - shift, before), "stop": cells(0, last - shift, behind)}
        return pa.RecordBatch.from_pydict(made)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows])
            if not len(rows):
                continue
            # Equal rows lie behind each other; a text's rows can go on in the next batch.
            rows = rows.filter(pa.array(_new(*rows.columns)))
            ends = int(np.flatnonzero(_new(rows["doc_id"], rows["version"]))[-1])
            if ends:
                yield runs_of(rows[:ends])
            rest = rows[ends:]
        if rest is not None:
            yield runs_of(rest)

    return joined


def repeats(spark: SparkSession, documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, version, runs): words [first, last) of documents that an earlier place holds.

    ``before`` and ``behind`` are the words around that place, and ``own`` is
    where it ends if it is in the same text. ``version`` is a 64-bit hash of
    the text, which tells rows of one id apart.
    """
    rows = documents.where(F.col("text") != "").select("doc_id", F.xxhash64("text").alias("version"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInPandas(_digested(min_words), f"doc_id {kind}, version long, first int, last int, digest binary")
    found, path = keep(spark, found, "units")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "version", "first")
    firsts = found.groupBy("digest").agg(F.min(place).alias("place"), F.count("*").alias("n")).where("n > 1").select("digest", "place")
    # Written, so that the join below has plain tables on both sides and the
    # occurrences of a very common line can be split over tasks.
    firsts, firsts_path = keep(spark, firsts, "repeated-units")
    later = found.join(firsts, "digest").where(place > F.col("place"))
    source = [F.col("place.doc_id").alias("from_id"), F.col("place.version").alias("from_version")]
    itself = F.col("doc_id").eqNullSafe(F.col("place.doc_id")) & (F.col("version") == F.col("place.version"))
    shift = (F.col("first") - F.col("place.first")).alias("shift")
    later = later.select("doc_id", "version", "first", "last", *source, shift, itself.alias("itself"))
    # All of a text's rows are brought together once, in the order that joins them.
    later = later.repartition("doc_id", "version").sortWithinPartitions(*COPY, "first", "last")
    runs = later.mapInArrow(
        _joined(min_words),
        f"doc_id {kind}, version long, from_id {kind}, from_version long, first int, last int, own int, start int, stop int",
    )
    runs, runs_path = keep(spark, runs, "repeated-runs")
    drop(spark, [path, firsts_path])
    asked = runs.select("from_id", "from_version", F.explode(F.array("start", "stop")).alias("at")).where("at is not null")
    asked = asked.groupBy("from_id", "from_version").agg(F.collect_set("at").alias("places"))
    texts = asked.join(rows, F.col("from_id").eqNullSafe(F.col("doc_id")) & (F.col("from_version") == F.col("version")))
    edges = texts.select("from_id", "from_version", "places", "text").mapInPandas(
        _edges, f"from_id {kind}, from_version long, at int, before string, behind string"
    )
    edges, edges_path = keep(spark, edges.dropDuplicates(["from_id", "from_version", "at"]), "run-edges")

    def beside(at, name: str) -> DataFrame:
        return edges.select(F.col("from_id").alias("e_id"), F.col("from_version").alias("e_version"), F.col("at").alias(at), name)

    alone = runs.where("start is null and stop is null").withColumn("before", F.lit("")).withColumn("behind", F.lit(""))
    runs = runs.where("start is not null or stop is not null")
    for name, at in (("before", F.col("start")), ("behind", F.col("stop"))):
        same = F.col("from_id").eqNullSafe(F.col("e_id")) & (F.col("from_version") == F.col("e_version")) & (at == F.col("e_at"))
        runs = runs.join(beside("e_at", name), same, "left").drop("e_id", "e_version", "e_at")
    cells = ["first", "last", "own", *[F.coalesce(c, F.lit("")).alias(c) for c in ("before", "behind")]]
    runs = runs.unionByName(alone).groupBy("doc_id", "version").agg(F.collect_list(F.struct(*cells)).alias("runs"))
    runs, _ = keep(spark, runs, "repeats")
    drop(spark, [runs_path, edges_path])
    return runs


def remove_repeats(
    spark: SparkSession, documents: DataFrame, min_words: int = MIN_WORDS, spans_as: str | None = "spans"
) -> DataFrame:
    """``documents`` with the repeated spans cut from ``text``.

    A column ``n_chars`` is brought up to date. The cut [begin, end) ranges come
    in a column ``spans_as``, in place of one of that name, unless it is None.
    """

    @F.arrow_udf("struct<spans:array<struct<begin:int,end:int>>,text:string>")
    def cut(texts: pa.Array, runs: pa.Array) -> pa.Array:
        cells = zip(*(c.to_numpy(zero_copy_only=False).tolist() for c in runs.flatten().flatten()))
        made = []
        for text, n in zip(texts.to_pylist(), runs.value_lengths().to_pylist()):
            spans = spans_of(text, islice(cells, n), min_words) if n else []
            made.append({"spans": spans, "text": _cut(text, spans)} if spans else None)
        spans = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
        return pa.array(made, pa.struct([("spans", spans), ("text", pa.string())]))

    found = repeats(spark, documents, min_words).select(
        F.col("doc_id").alias("__id"), F.col("version").alias("__version"), F.col("runs").alias("__runs")
    )
    joined = documents.join(
        found, documents["doc_id"].eqNullSafe(F.col("__id")) & (F.xxhash64(documents["text"]) == F.col("__version")), "left"
    )
    # Texts without runs are not handed to Python.
    joined = joined.withColumn("__cut", cut(F.when(F.col("__runs").isNotNull(), F.col("text")), F.col("__runs")))
    joined = joined.withColumn("text", F.coalesce("__cut.text", "text"))
    if "n_chars" in documents.columns:
        n_chars = F.length("text").cast(documents.schema["n_chars"].dataType)
        joined = joined.withColumn("n_chars", F.when(F.col("__cut").isNull(), F.col("n_chars")).otherwise(n_chars))
    if spans_as is not None:
        none = F.expr("cast(array() as array<struct<begin:int,end:int>>)")
        joined = joined.withColumn(spans_as, F.coalesce("__cut.spans", none))
    return joined.drop("__id", "__version", "__runs", "__cut")


def _cut(text: str, spans) -> str:
    parts, at = [], 0
    for span in spans:
        parts.append(text[at : span["begin"]])
        at = span["end"]
    return "".join([*parts, text[at:]])
