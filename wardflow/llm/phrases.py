"""Collocations of every language, counted over a prefix-free parse.

Texts are split at sentence marks and line ends into pieces, and pieces into
chunks: a chunk ends after each word whose checksum triggers it and reaches
``longest - 1`` words further, over the beginning of the next one. Cuts depend
on the words alone, so what many texts share gives the same chunks, and the
dictionary of distinct chunks with their frequencies stands for the corpus.
A phrase belongs to the chunk in whose own words, before the overlap, it begins:
so phrases are counted inside distinct chunks, weighted by frequency, and those
in overlaps count once.

Single words are counted first, then pairs, then all longer phrases. A phrase can
be frequent only if its parts are, so pairs are restricted to words, and longer
phrases to pairs, that pass a bit filter of those found frequent. The filter has
a fixed number of bits whatever the corpus holds: it never leaves out a frequent
phrase, and what it lets through is counted exactly, on the words themselves.
The dictionary's words are numbered block by block once for all three passes; a
task holds the blocks of one Arrow batch, at most those of its scan split.

Defined cases: a null or empty text has no words; a null language is ``und``;
rows that repeat an id count each; phrases never reach over a piece's end; extra
columns are ignored; an empty table gives an empty result. Products of counts
are decimals of 38 digits.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardflow.llm.common import drop, keep, mixed

#: A-Z small, the marks and line ends that part pieces as line feeds, tabs as blanks.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else 10 if c in b".,;:!?" or 10 <= c <= 13 else 32 if c == 9 else c for c in range(256))
#: A word ends a chunk if its checksum is 0 modulo this; longer runs without one are cut.
TRIGGER, LONGEST_RUN = 32, 128
#: Words counted together, about, at six bytes a word.
BLOCK = 1 << 20
#: Bits of the filter, 16 MB, and of one of its blocks.
FILTER_BITS, BLOCK_BITS = 27, 16
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class _Triggers(dict):
    """Whether a word ends a chunk, remembered."""

    def __init__(self, trigger: int = TRIGGER):
        self.trigger = trigger

    def __missing__(self, word: bytes) -> bool:
        if len(self) > 500_000:
            self.clear()
        self[word] = found = zlib.crc32(word) % self.trigger == 0
        return found


def chunks_of(text: bytes | None, longest: int, triggers: _Triggers) -> list[bytes]:
    """The chunks of a text: words joined by blanks, a tab before the first of the overlap."""
    out = []
    for piece in (text or b"").translate(_TABLE).split(b"\n"):
        words = piece.split()
        if not words:
            continue
        size = len(words)
        if size <= LONGEST_RUN and not any(map(triggers.__getitem__, words[:-1])):
            out.append(b" ".join(words))
            continue
        begin = 0
        for end in [*[i for i, word in enumerate(words[:-1], 1) if triggers[word]], size]:
            while begin < end:
                stop = min(end, begin + LONGEST_RUN)
                own, over = b" ".join(words[begin:stop]), b" ".join(words[stop : stop + longest - 1])
                out.append(own + b"\t" + over if over else own)
                begin = stop
    return out


def parse(spark: SparkSession, documents: DataFrame, longest: int = 5, trigger: int = TRIGGER) -> DataFrame:
    """(lang, chunk, freq): the dictionary of distinct chunks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        triggers = _Triggers(trigger)
        for batch in batches:
            found: dict[str, Counter] = {}
            for lang, text in zip(batch["lang"], batch["text"]):
                found.setdefault(lang, Counter()).update(chunks_of(text, longest, triggers))
            for lang, counts in found.items():
                yield pd.DataFrame({"lang": lang, "chunk": list(counts), "freq": list(counts.values())}, dtype=object)

    texts = documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text"))
    parsed = texts.mapInPandas(run, "lang string, chunk binary, freq long")
    return parsed.groupBy("lang", "chunk").agg(F.sum("freq").alias("freq"))


#: Chunks numbered: distinct words and each place's word, both compressed, and each chunk's language, words, own words and frequency.
PACKED = "vocabulary binary, langs array<string>, word binary, lang binary, words binary, own binary, freq binary"
_ENDS = np.zeros(256, bool)
_ENDS[[9, 10, 32]] = True


def packed(chunks: list[bytes], langs: list[str], freq: list[int]) -> tuple:
    """One row of ``PACKED``."""
    blob = b"\n".join(chunks) + b"\n"
    data = np.frombuffer(blob, np.uint8)
    kinds = data[_ENDS[data]]  # what follows each word
    last = np.flatnonzero(kinds == 10)
    size = np.diff(last, prepend=-1)
    own, tab = size.copy(), np.flatnonzero(kinds == 9)
    cut = np.searchsorted(last, tab)
    own[cut] = tab - (last - size)[cut]
    word, known = pd.factorize(np.array(blob.split(), object))
    lang, named = pd.factorize(np.array(langs, object))
    columns = [word.astype(np.int32), lang.astype(np.int32), size.astype(np.int32), own.astype(np.int32), np.array(freq, np.int64)]
    pressed = [zstandard.compress(x, 1) for x in (b" ".join(known), columns[0].tobytes())]
    return (pressed[0], list(named), pressed[1], *[c.tobytes() for c in columns[1:]])


def blocks_of(chunks: DataFrame) -> DataFrame:
    """The dictionary in blocks of about ``BLOCK`` words, numbered once for all passes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [column.split()[0] for column in PACKED.split(", ")]
        held: list[list] = [[], [], []]
        size = 0
        for batch in batches:
            for row in zip(batch["chunk"], batch["lang"], batch["freq"]):
                for part, value in zip(held, row):
                    part.append(value)
                size += len(row[0])
                if size >= BLOCK * 6:
                    yield pd.DataFrame([packed(*held)], columns=names)
                    held, size = [[], [], []], 0
        if size:
            yield pd.DataFrame([packed(*held)], columns=names)

    return chunks.select("lang", "chunk", "freq").mapInPandas(run, PACKED)


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))


def keys(langs: np.ndarray, words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each place on, with their language's."""
    with np.errstate(over="ignore"):
        out = mixed(words ^ langs)
        for j in range(1, size):
            out = mixed(out[:-1] * _FACTOR + words[j:])
    return out


def places(key: np.ndarray) -> list[np.ndarray]:
    """The two bits of each key."""
    mask = np.uint64((1 << FILTER_BITS) - 1)
    return [(key & mask).astype(np.int64), ((key >> np.uint64(32)) & mask).astype(np.int64)]


def bit_filter(frequent: DataFrame, size: int) -> np.ndarray:
    """The filter of phrases of ``size`` words, as bits packed into bytes.

    Its size is fixed; each block of it is put together in a task.
    """

    def bits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                words = hashes(b" ".join(batch["phrase"]).split(b" ")).reshape(len(batch), size)
                langs = hashes([lang.encode() for lang in batch["lang"]])
                with np.errstate(over="ignore"):
                    key = mixed(words[:, 0] ^ langs)
                    for j in range(1, size):
                        key = mixed(key * _FACTOR + words[:, j])
                at = np.concatenate(places(key))
                yield pd.DataFrame({"block": at >> BLOCK_BITS, "bit": at & ((1 << BLOCK_BITS) - 1)})

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for bit in batch["bits"]:
                flags = np.zeros(1 << BLOCK_BITS, np.uint8)
                flags[bit] = 1
                out.append(np.packbits(flags).tobytes())
            yield pd.DataFrame({"block": batch["block"], "data": out})

    set_bits = frequent.select("lang", "phrase").mapInPandas(bits, "block int, bit int").groupBy("block").agg(F.collect_set("bit").alias("bits"))
    whole = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    width = 1 << (BLOCK_BITS - 3)
    for row in set_bits.mapInPandas(packed, "block int, data binary").collect():
        whole[row.block * width : (row.block + 1) * width] = np.frombuffer(row.data, np.uint8)
    return whole


def passes(whole: np.ndarray, key: np.ndarray) -> np.ndarray:
    hit = np.ones(len(key), bool)
    for at in places(key):
        hit &= (whole[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
    return hit


class Block:
    """A row of ``PACKED`` as arrays with one entry a place."""

    def __init__(self, vocabulary: bytes, langs: list[str], word: bytes, lang: bytes, words: bytes, own: bytes, freq: bytes):
        self.known = np.array(zstandard.decompress(vocabulary).split(b" "), object)
        self.langs = np.array(list(langs), object)
        self.spaced = self.known + b" "
        self.word = np.frombuffer(zstandard.decompress(word), np.int32).astype(np.int64)
        n = np.frombuffer(words, np.int32)
        self.lang = np.repeat(np.frombuffer(lang, np.int32).astype(np.int64), n)
        self.freq = np.repeat(np.frombuffer(freq, np.int64), n)
        place = np.arange(len(self.word)) - np.repeat(np.cumsum(n) - n, n)
        self.mine = place < np.repeat(np.frombuffer(own, np.int32), n)
        self.left = np.repeat(n, n) - place

    def hits(self, whole: np.ndarray, size: int) -> np.ndarray:
        """Places whose ``size`` words the filter lets through."""
        key = keys(hashes([x.encode() for x in self.langs])[self.lang], hashes(list(self.known))[self.word], size)
        out = np.zeros(len(self.word), bool)
        out[: len(key)] = passes(whole, key)
        return out

    def counts(self, size: int, hit: np.ndarray | None, width: int) -> pd.DataFrame:
        """(lang, phrase, n) of the phrases of ``size`` words that begin in chunks' own words.

        All their parts of ``width`` words must be among ``hit``.
        """
        alive = self.mine & (self.left >= size)
        if hit is not None:
            for j in range(size - width + 1):
                alive[: len(hit) - j] &= hit[j:]
        at = np.flatnonzero(alive)
        if not len(at):
            return pd.DataFrame({"lang": [], "phrase": [], "n": []}, dtype=object)
        # Numbers that stand for the phrases one to one, made dense before they overflow.
        code, top, w = self.lang[at], len(self.langs), len(self.known)
        for j in range(size):
            if top * w >= 1 << 62:
                code, dense = pd.factorize(code)
                top = len(dense)
            code, top = code * w + self.word[at + j], top * w
        order = np.argsort(code, kind="stable")
        first = np.flatnonzero(np.diff(code[order], prepend=-1))
        found = at[order[first]]
        phrase = self.known[self.word[found + size - 1]]
        for j in range(size - 2, -1, -1):
            phrase = self.spaced[self.word[found + j]] + phrase
        return pd.DataFrame({"lang": self.langs[self.lang[found]], "phrase": phrase, "n": np.add.reduceat(self.freq[at][order], first)})


def frequent_phrases(spark: SparkSession, blocks: DataFrame, sizes: list[int], least: int, shorter: DataFrame | None, width: int) -> DataFrame:
    """(lang, phrase, f) of the phrases of ``sizes`` words that occur ``least`` times or more, written.

    ``shorter`` are the frequent ones of ``width`` words, fewer than any of ``sizes``.
    """
    shared = None if shorter is None else spark.sparkContext.broadcast(bit_filter(shorter, width))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                block = Block(*row)
                hit = None if shared is None else block.hits(shared.value, width)
                for size in sizes:
                    yield block.counts(size, hit, width)

    counted = blocks.mapInPandas(run, "lang string, phrase binary, n long")
    frequent = counted.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    written = keep(spark, frequent, f"phrases-{sizes[0]}")[0]
    if shared is not None:
        shared.destroy()
    return written


def words_of_langs(blocks: DataFrame) -> DataFrame:
    """(lang, n): all words of each language."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for langs, lang, own, freq in zip(*(batch[c] for c in ("langs", "lang", "own", "freq"))):
                n = np.zeros(len(langs), np.int64)
                np.add.at(n, np.frombuffer(lang, np.int32), np.frombuffer(own, np.int32) * np.frombuffer(freq, np.int64))
                yield pd.DataFrame({"lang": list(langs), "n": n})

    counted = blocks.select("langs", "lang", "own", "freq").mapInPandas(run, "lang string, n long")
    return counted.groupBy("lang").agg(F.sum("n").alias("n"))


def _exact(value: str) -> Column:
    return F.col(value).cast("decimal(19,0)")


def scored(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of phrases of two words or more, by their lowest-scoring cut.

    ``counts`` are (lang, phrase, f) of all frequent phrases, single words too,
    and so of every part of them; ``totals`` the words (lang, n).
    """
    words = F.split("phrase", " ")
    cut = (
        counts.join(totals, "lang")
        .withColumn("w", words)
        .where(F.size("w") > 1)
        .select("lang", "phrase", F.col("f").alias("a"), "n", "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
        .select("lang", "phrase", "a", "n", "k", F.array_join(F.slice("w", 1, F.col("k")), " ").alias("left"), F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ").alias("right"))
    )
    part = counts.select("lang", "phrase", "f")
    parted = cut.join(part.toDF("lang", "left", "l"), ["lang", "left"]).join(part.toDF("lang", "right", "r"), ["lang", "right"])
    product, expected = F.lit(1000).cast("decimal(4,0)") * _exact("a") * _exact("n"), _exact("l") * _exact("r")
    whole = parted.withColumns({"up": product, "down": expected}).withColumn("score", F.expr("up div down"))
    best = whole.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    return best.select("lang", "phrase", "a", "m.l", "m.r", "n", "m.score")


def maximal(counts: DataFrame, phrases: DataFrame) -> DataFrame:
    """``phrases`` without those that occur only inside one longer phrase.

    Counts fall as phrases grow, so if any longer phrase is as frequent, one
    that is longer by a single word is.
    """
    w = F.split("phrase", " ")
    longer = counts.withColumn("w", w).where(F.size("w") > 2)
    inside = F.explode(F.array(F.array_join(F.slice("w", 1, F.size("w") - 1), " "), F.array_join(F.slice("w", 2, F.size("w")), " ")))
    held = longer.select("lang", inside.alias("phrase"), F.col("f").alias("a")).distinct()
    return phrases.join(held, ["lang", "phrase", "a"], "left_anti")


def collocations(
    spark: SparkSession, documents: DataFrame, least: int = 100, longest: int = 5, first: int | None = 2000, trigger: int = TRIGGER
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's phrases, best first.

    Phrases of two to ``longest`` words that occur ``least`` times; ``first``
    is how many a language reports, None for all.
    """
    blocks, path = keep(spark, blocks_of(parse(spark, documents, longest, trigger)), "blocks")
    totals = keep(spark, words_of_langs(blocks), "words")[0]
    singles = frequent_phrases(spark, blocks, [1], least, None, 0)
    pairs = frequent_phrases(spark, blocks, [2], least, singles, 1)
    counts = singles.unionByName(pairs)
    if longest > 2:
        counts = counts.unionByName(frequent_phrases(spark, blocks, list(range(3, longest + 1)), least, pairs, 2))
    drop(spark, [path])
    counts = counts.withColumn("phrase", F.col("phrase").cast("string"))
    found = maximal(counts, scored(counts, totals))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase")))
    ranked = found.withColumn("rank", rank.cast("long"))
    if first is not None:
        ranked = ranked.where(F.col("rank") <= first)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
