"""Exact top-k search: BM25 over sharded inverted indexes with block-max pruning.

Documents are cut into shards of about ``SHARD_TOKENS`` tokens. A shard's index
lists for each word its documents and frequencies. A word that many documents of
a block of ``BLOCK`` hold is a column of the block's matrix; all other postings
are short lists. A query's lists are added up; a block's matrix is multiplied only
for the queries whose bar, the k-th best score known so far, can be reached by the
best such sum and the block maxima of the matrix's words together, or by what the
block's richest document holds. These sums are in single precision, with a proven
bound of their error: whatever may reach the bar is then summed exactly, from the
document's own words, and the bar grows from shard to shard. What is left out
cannot be among the k best. Document frequencies, the number of documents and
their mean length are those of the whole collection, so the tasks' lists merge
exactly.

A query is the set of distinct words of a text; each counts once. The score is
the sum over shared words of ln(1 + (N - df + 0.5) / (df + 0.5)) times
tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean length)), every summand
rounded to 2 ** -30: such sums are exact, in whichever order they are added, so
equal documents have equal scores.

Queries go to the shards in groups of about ``GROUP_TERMS`` words, one group
after another, by broadcast. Each shard is read once a group, and its lists are
looked up and weighed once a group, whatever the number of queries.

Defined cases: a query without words, or whose words no document holds, has no
results; documents sharing no word with a query are never listed, so a result
can be shorter than k; equal scores go by doc_id; repeated rows are documents of
their own; query rows with the same id form one query; null ids are indexed, but
ask nothing; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardflow.llm.common import hash_words, keep, spans

#: A shard is closed at so many words, or documents: empty ones count too.
SHARD_TOKENS, SHARD_DOCS = 2_250_000, 20_000
GROUP_TERMS = 3_000_000
BLOCK = 512
#: Queries scored together.
CHUNK = 512
#: A word in so many documents of a block is a column of the block's matrix.
DENSE = 48
#: Postings of a list that are taken at a step: those of a cache line.
ROW = 8
K1, B = 1.2, 0.75
UNIT = 2.0**30


def _packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values, np.int32))


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(data)), np.int32)


def _shards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row a shard: documents, lengths, words and postings sorted by word."""
    first = TaskContext.get().partitionId() << 32
    docs: list[tuple] = []
    size = made = 0

    def shard() -> pd.DataFrame:
        # Like texts stand together, which lowers the block maxima elsewhere:
        # by the most frequent word, as a stand-in for language, and length.
        docs.sort(key=lambda d: d[1:3])
        sizes = [len(d[3]) for d in docs]
        terms = np.concatenate([d[3] for d in docs])
        counts = np.concatenate([d[4] for d in docs])
        row = {"shard": first + made, "ids": [d[0] for d in docs], "lengths": _packed(np.array([d[2] for d in docs]))}
        docs.clear()  # the postings are held once
        order = np.argsort(terms, kind="stable")
        terms = terms[order]
        starts = np.flatnonzero(np.append(True, terms[1:] != terms[:-1])[: len(terms)])
        row |= {
            "words": terms[starts].view(np.int64),
            "sizes": _packed(np.diff(starts, append=len(terms))),
            "numbers": _packed(np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[order]),
            "counts": _packed(counts[order]),
        }
        return pd.DataFrame({k: [v] for k, v in row.items()})

    for batch in batches:
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            tokens = np.sort(hash_words(text))
            begins = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1])[: len(tokens)])
            terms, counts = tokens[begins], np.diff(begins, append=len(tokens)).astype(np.int32)
            top = int(terms[np.argmax(counts)]) if len(terms) else 0
            docs.append((None if doc_id is None or doc_id != doc_id else doc_id, top, len(tokens), terms, counts))
            size += len(tokens)
            if size >= SHARD_TOKENS or len(docs) >= SHARD_DOCS:
                yield shard()
                made += 1
                size = 0
    if docs:
        yield shard()


class Group:
    """Queries that are scored together: their ids, words and the words' idf.

    Like queries stand together, as documents do in a shard: by ``tops``, their
    most frequent words, and size.
    """

    def __init__(self, ids: list, sizes: np.ndarray, terms: np.ndarray, weights: np.ndarray, tops: np.ndarray | None = None):
        sizes = sizes.astype(np.int64)
        order = np.lexsort((sizes,) if tops is None else (sizes, tops))
        self.ids = [ids[i] for i in order]
        self.vocabulary, first, numbers, askers = np.unique(terms, return_index=True, return_inverse=True, return_counts=True)
        self.idf = weights[first]
        # Words are numbered by how many ask for them: what is looked up often lies together.
        self.numbering = np.empty(len(first), np.int32)
        self.numbering[np.argsort(-askers, kind="stable")] = np.arange(len(first))
        self.numbers = self.numbering[numbers][spans((np.cumsum(sizes) - sizes)[order], sizes[order])]
        self.starts = np.concatenate([[0], np.cumsum(sizes[order])])
        # A sum of m products, none of them negative, is off by less than a share
        # of (m + 3) * 2 ** -24 in single precision, in whichever order it is formed.
        self.slack = (int(sizes.max()) + 8) * 2.0**-23


class Index:
    """A shard's postings of the words that a group asks for."""

    def __init__(self, row, group: Group, mean_length: float):
        self.ids = np.array(list(row["ids"]), dtype=object)
        n, known = len(self.ids), len(group.vocabulary)
        lengths = _unpacked(row["lengths"]).astype(float)
        words = np.asarray(row["words"], np.int64).view(np.uint64)
        sizes = _unpacked(row["sizes"]).astype(np.int64)
        at = np.searchsorted(words, group.vocabulary)
        at[at == len(words)] = 0
        held = np.flatnonzero(words[at] == group.vocabulary) if len(words) else np.zeros(0, np.int64)
        counts = sizes[at[held]]
        wanted = np.zeros(len(words), bool)
        wanted[at[held]] = True
        wanted = np.repeat(wanted, sizes)
        docs = _unpacked(row["numbers"])[wanted]
        impact = _unpacked(row["counts"])[wanted].astype(float)
        damping = (K1 * (1 - B + B * lengths / mean_length)).take(docs)
        damping += impact
        impact *= np.divide(K1 + 1, damping, out=damping)
        impact *= np.repeat(group.idf[held], counts)
        impact *= UNIT
        np.round(impact, out=impact)
        del damping
        term = np.repeat(group.numbering[held], counts)

        # By document, for exact sums.
        by_doc = np.argsort(docs.astype(np.uint16) if n < 1 << 16 else docs, kind="stable")
        self.terms, self.exact = term.take(by_doc), impact.take(by_doc)
        self.lengths = np.bincount(docs, minlength=n)
        self.first = np.cumsum(self.lengths) - self.lengths
        self.asked = np.zeros(known, bool)
        del by_doc

        # Runs of postings of one word in one block.
        impact = impact.astype(np.float32)
        self.blocks = -(-n // BLOCK)
        block = docs // np.int32(BLOCK)
        new = np.ones(len(term), bool)
        new[1:] = (term[1:] != term[:-1]) | (block[1:] != block[:-1])
        starts = np.flatnonzero(new)
        runs = np.diff(starts, append=len(term))
        dense = runs >= DENSE
        listed = np.repeat(~dense, runs)
        # Lists lie in rows of ROW postings, taken at a step, filled up with nothings.
        sizes = np.bincount(term[listed], minlength=known)
        rows = -(-sizes // ROW)
        begins = np.cumsum(rows) - rows
        self.lists = np.stack([begins, rows], axis=1).astype(np.int32)
        sizes, begins = sizes[group.numbering[held]], begins[group.numbering[held]]
        at = np.repeat(ROW * begins - (np.cumsum(sizes) - sizes), sizes)
        at += np.arange(len(at))
        self.spots = np.zeros((rows.sum(), ROW), np.intp)
        self.light = np.zeros(self.spots.shape, np.float32)
        self.spots.reshape(-1)[at] = docs[listed]
        self.light.reshape(-1)[at] = impact[listed]
        del at

        starts, runs = starts[dense], runs[dense]
        columns, column = np.unique(term[starts], return_inverse=True)
        self.column = np.full(known, -1, np.int32)
        self.column[columns] = np.arange(len(columns))
        self.tops = np.zeros((len(columns), self.blocks), np.float32)
        self.caps = np.zeros(self.blocks, np.float32)
        # A block keeps the columns of its own words only: those of its language, mostly.
        self.held, self.matrices = [], []
        order = np.argsort(block[starts], kind="stable")
        for b, mine in enumerate(np.split(order, np.searchsorted(block[starts[order]], np.arange(1, self.blocks)))):
            at = spans(starts[mine], runs[mine])
            matrix = np.zeros((BLOCK, len(mine)), np.float32)
            matrix[docs[at] - b * BLOCK, np.repeat(np.arange(len(mine)), runs[mine])] = impact[at]
            self.held.append(column[mine])
            self.matrices.append(matrix)
            self.tops[column[mine], b] = matrix.max(axis=0)
            self.caps[b] = matrix.sum(axis=1, dtype=float).max()
        # Room for a chunk of queries, taken once.
        chunk = min(CHUNK, len(group.ids))
        self.sums = np.zeros((chunk, self.blocks * BLOCK), np.float32)
        self.products = np.zeros((chunk, BLOCK), np.float32)
        self.wanted = np.zeros((len(columns), chunk), np.float32)
        self.picked = np.zeros((max(len(h) for h in self.held), chunk), np.float32)

    def score(self, group: Group, first: int, last: int, best: Best) -> None:
        """Offer the documents to the queries ``first`` to ``last`` of the group."""
        starts = group.starts[first : last + 1] - group.starts[first]
        words = group.numbers[group.starts[first] : group.starts[last]]
        count = last - first
        column = self.column.take(words)
        dense = np.flatnonzero(column >= 0)
        self.wanted[:] = 0
        self.wanted[column.take(dense), np.repeat(np.arange(count), np.diff(starts)).take(dense)] = 1

        # A query at a time, as its sums then stay in the processor's cache.
        begins, rows = self.lists.take(words, axis=0).T
        ends = np.concatenate([[0], np.cumsum(rows)])
        begins = begins - ends[:-1] + np.repeat(ends[starts[:-1]], np.diff(starts))
        steps = np.arange(np.diff(ends[starts]).max())
        spots, light = np.empty((len(steps), ROW), np.intp), np.empty((len(steps), ROW), np.float32)
        sums = self.sums[:count]
        sums[:] = 0
        for query, (low, high) in enumerate(zip(starts.tolist(), starts[1:].tolist())):
            taken = np.repeat(begins[low:high], rows[low:high])
            if size := len(taken):
                taken += steps[:size]
                self.spots.take(taken, axis=0, out=spots[:size], mode="clip")
                self.light.take(taken, axis=0, out=light[:size], mode="clip")
                np.add.at(sums[query], spots[:size].reshape(-1), light[:size].reshape(-1))
        bounds = self.wanted.T[:count] @ self.tops
        np.minimum(bounds, self.caps, out=bounds)
        tiles = sums.reshape(count, self.blocks, BLOCK)
        bounds += tiles.max(axis=2)

        # Scores are whole units: less than a half means that no word is shared.
        bars = np.maximum(best.least[first:last] * (1 - group.slack), 0.5).astype(np.float32)
        for block, held in enumerate(self.held):
            alive = np.flatnonzero(bounds[:, block] >= bars)
            if len(alive) and len(held):
                low, high = alive[0], alive[-1] + 1
                some = slice(low, high) if len(alive) * 5 > (high - low) * 4 else alive
                picked = np.take(self.wanted, held, axis=0, out=self.picked[: len(held)], mode="clip")[:, some]
                tiles[some, block] += np.matmul(picked.T, self.matrices[block].T, out=self.products[: picked.shape[1]])
        reached, docs = np.divmod(np.flatnonzero(sums >= bars[:, None]), sums.shape[1])
        ends = np.searchsorted(reached, np.arange(count + 1)).tolist()
        for query, (begin, end) in enumerate(zip(ends, ends[1:])):
            if begin < end:
                mine = docs[begin:end]
                if len(mine) > best.k:  # of a shard the k best matter, and what may equal them
                    about = sums[query].take(mine)
                    mine = mine[about >= np.partition(about, -best.k)[-best.k] * (1 - 2 * group.slack)]
                best.offer(first + query, self.scores(group, first + query, mine), self.ids[mine])

    def scores(self, group: Group, query: int, docs: np.ndarray) -> np.ndarray:
        """The exact scores of documents that share words with a query."""
        words = group.numbers[group.starts[query] : group.starts[query + 1]]
        sizes = self.lengths.take(docs)
        spots = [slice(begin, begin + size) for begin, size in zip(self.first.take(docs).tolist(), sizes.tolist())]
        self.asked[words] = True
        shared = self.asked.take(np.concatenate([self.terms[s] for s in spots]))
        self.asked[words] = False
        return np.add.reduceat(shared * np.concatenate([self.exact[s] for s in spots]), np.cumsum(sizes) - sizes)


class Best:
    """The k best documents of each query so far, with ties by document id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.least = np.zeros(queries)
        self.found: list[list[tuple]] = [[] for _ in range(queries)]

    def offer(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        merged = self.found[query] + [(-s, d is None, 0 if d is None else d) for s, d in zip(scores.tolist(), ids) if s > 0 and s >= self.least[query]]
        merged.sort()
        self.found[query] = merged[: self.k]
        if len(merged) >= self.k:
            self.least[query] = -merged[self.k - 1][0]


def top_k(spark: SparkSession, documents: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, doc_id, score) for the texts of ``queries`` (query_id, text)."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    asked_kind = queries.schema["query_id"].dataType.simpleString()
    made = documents.select("doc_id", "text").mapInPandas(
        _shards, f"shard long, ids array<{kind}>, lengths binary, words array<bigint>, sizes binary, numbers binary, counts binary"
    )
    shards, _ = keep(spark, made, "shards")

    def doc_lengths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"tokens": [int(_unpacked(x).sum()) for x in batch["lengths"]]}, dtype="int64")

    tokens = shards.select("lengths").mapInPandas(doc_lengths, "tokens long").agg(F.sum("tokens")).first()[0] or 0
    size = shards.agg(F.sum(F.size("ids"))).first()[0] or 0
    mean_length = max(tokens / max(size, 1), 1e-9)

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for words, sizes in zip(batch["words"], batch["sizes"]):
                yield pd.DataFrame({"term": np.asarray(words, np.int64), "df": _unpacked(sizes).astype(np.int64)})

    df = shards.select("words", "sizes").mapInPandas(frequencies, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [np.unique(hash_words(t), return_counts=True) for t in batch["text"]]
            sizes = [len(words) for words, _ in sets]
            tops = [words[np.argmax(counts)] if len(words) else 0 for words, counts in sets]
            yield pd.DataFrame(
                {
                    "query_id": np.repeat(batch["query_id"].to_numpy(), sizes),
                    "term": np.concatenate([*(words for words, _ in sets), np.zeros(0, np.uint64)]).view(np.int64),
                    "top": np.repeat(np.array(tops, np.uint64).view(np.int64), sizes),
                }
            )

    asked_words = queries.where(F.col("query_id").isNotNull()).select("query_id", "text").mapInPandas(split, f"query_id {asked_kind}, term long, top long")
    terms = asked_words.groupBy("query_id", "term").agg(F.min("top").alias("top"))
    idf = F.log(1 + (F.lit(size) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighed = terms.join(df, "term").groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("term", idf.alias("weight")))).alias("t"), F.min("top").alias("top"))
    asked, _ = keep(spark, weighed.select("query_id", "top", F.col("t.term").alias("terms"), F.col("t.weight").alias("weights")), "queries")

    volume = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    groups = -(-volume // GROUP_TERMS)

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                sizes = np.array([len(t) for t in batch["terms"]])
                terms, weights = (np.concatenate(batch[c].to_numpy()) for c in ("terms", "weights"))
                yield pd.DataFrame(
                    {
                        "ids": [batch["query_id"].tolist()],
                        "tops": [batch["top"].to_numpy(np.int64).tobytes()],
                        "sizes": [_packed(sizes)],
                        "terms": [terms.astype(np.int64).tobytes()],
                        "weights": [weights.astype(float).tobytes()],
                    }
                )

    def find(asked_of):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            group = asked_of.value
            best = Best(len(group.ids), k)
            for batch in batches:
                for _, shard in batch.iterrows():
                    index = Index(shard, group, mean_length)
                    for first in range(0, len(group.ids), CHUNK):
                        index.score(group, first, min(first + CHUNK, len(group.ids)), best)
                    del index  # before the next one is made
            out = [(query, None if unnamed else doc, -score / UNIT) for query, rows in zip(group.ids, best.found) for score, unnamed, doc in rows]
            yield pd.DataFrame(out, columns=["query_id", "doc_id", "score"]).astype({"doc_id": object})

        return run

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    schema = f"query_id {asked_kind}, doc_id {kind}, score double"
    found = spark.createDataFrame([], schema)
    tasks = spark.sparkContext.defaultParallelism
    for number in range(groups):
        part = asked.where(F.pmod(F.xxhash64("query_id"), F.lit(groups)) == number)
        rows = part.mapInPandas(packed, f"ids array<{asked_kind}>, tops binary, sizes binary, terms binary, weights binary").collect()
        if not rows:
            continue
        group = Group(
            [q for r in rows for q in r["ids"]],
            np.concatenate([_unpacked(r["sizes"]) for r in rows]),
            np.concatenate([np.frombuffer(r["terms"], np.int64) for r in rows]).view(np.uint64),
            np.concatenate([np.frombuffer(r["weights"], float) for r in rows]),
            np.concatenate([np.frombuffer(r["tops"], np.int64) for r in rows]),
        )
        sent = spark.sparkContext.broadcast(group)
        # Few tasks with several shards each: the bar that a query's documents
        # must reach is carried from one shard to the next.
        lists, _ = keep(spark, shards.coalesce(tasks).mapInPandas(find(sent), schema), "found")
        found = found.union(lists)
        sent.destroy()
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")
