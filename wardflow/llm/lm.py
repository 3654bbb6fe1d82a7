"""Language-model scores by deleted interpolation of n-gram estimates.

The model mixes the maximum-likelihood bigram and unigram estimates and a uniform
one. The mixture weights depend on how often the context was seen, in buckets of
powers of two; they are learned by expectation-maximisation on the counts of a
held-out tenth of the training documents against the counts of the rest. Scores
then use the counts of all training documents.

Counting goes through blocks: a task turns its documents into blocks of token
numbers over a block vocabulary. Each block asks once for every word and every
word pair it holds, whatever their frequency, so a very common pair is one row a
block; the questions are dealt by hash, summed, and answered block by block.
Blocks and parts have fixed sizes, their number grows with the corpus.

Defined cases: null and empty texts are one end token; without training documents
every word is unknown and the score is that of the uniform part; repeated rows
are counted and scored one by one; a null doc_id is training data; extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm.common import hash_words, keep, mixed

#: Tokens of a block, and questions answered by one task.
BLOCK_TOKENS = 2_000_000
PART_KEYS = 2_000_000
END = np.array([0x5851F42D4C957F2D], np.uint64)
MAIN, WEIGHTS, HELD_OUT = 0, 1, 2
BUCKETS = 32
ROUNDS = 60
#: Cells of a factor of two in which probabilities are pooled for the weights.
GRAIN = 4


def squeeze(values: np.ndarray) -> bytes:
    """Integers as compressed values of 32 bits, or of 64 where one needs them; the first byte tells."""
    wide = len(values) > 0 and int(np.abs(values).max()) >= 1 << 31
    kind = np.int64 if wide else np.int32
    return (b"8" if wide else b"4") + zstandard.ZstdCompressor(level=1).compress(values.astype(kind).tobytes())


def unsqueeze(data: bytes) -> np.ndarray:
    kind = np.int64 if data[:1] == b"8" else np.int32
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(data[1:])), kind)


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row a block: its documents, vocabulary hashes and token numbers."""
    first = TaskContext.get().partitionId() << 32
    held: list = [[], [], []]
    size = made = 0

    def block() -> pd.DataFrame:
        ids, roles, texts = held
        vocabulary, tokens, counts = np.unique(np.concatenate(texts), return_inverse=True, return_counts=True)
        # Frequent words get small numbers, which compress well.
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        row = {
            "block": first + made,
            "ids": list(ids),
            "roles": squeeze(np.array(roles)),
            "lengths": squeeze(np.array([len(t) for t in texts])),
            "words": vocabulary[order].view(np.int64),
            "tokens": squeeze(rank[tokens.ravel()]),
        }
        return pd.DataFrame({k: [v] for k, v in row.items()})

    for batch in batches:
        for doc_id, role, text in zip(batch["doc_id"], batch["role"], batch["text"]):
            tokens = np.concatenate([hash_words(text), END])
            held[0].append(None if doc_id is None or doc_id != doc_id else doc_id)
            held[1].append(role)
            held[2].append(tokens)
            size += len(tokens)
            if size >= BLOCK_TOKENS:
                yield block()
                made += 1
                held, size = [[], [], []], 0
    if held[0]:
        yield block()


class Block:
    """A block's tokens and its distinct pairs of a context and a word."""

    def __init__(self, row):
        self.words = np.asarray(row["words"], np.int64).view(np.uint64)
        self.tokens = unsqueeze(row["tokens"])
        lengths = unsqueeze(row["lengths"])
        self.ends = np.cumsum(lengths, dtype=np.int64)
        self.lengths = lengths
        self.roles = np.repeat(unsqueeze(row["roles"]).astype(np.int8), lengths)
        # A document's first token has the end token as its context: there are
        # as many beginnings as ends.
        pairs = np.roll(self.tokens, 1).astype(np.int64)
        pairs[self.ends - lengths] = self.tokens[self.ends - 1]
        pairs *= len(self.words)
        pairs += self.tokens
        self.pairs, places = np.unique(pairs, return_inverse=True)
        self.pair_of = places.astype(np.int32)

    def keys(self, order: int) -> np.ndarray:
        if order == 1:
            return mixed(self.words)
        context, word = np.divmod(self.pairs, len(self.words))
        with np.errstate(over="ignore"):
            return mixed(mixed(self.words[context]) * np.uint64(0x9E3779B97F4A7C15) + self.words[word])

    def places(self, order: int) -> np.ndarray:
        return self.tokens if order == 1 else self.pair_of

    def by_part(self, order: int, parts: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(part, numbers, keys) of what is asked of each part."""
        keys = self.keys(order)
        part = (keys % np.uint64(parts)).astype(np.int64)
        numbers = np.argsort(part, kind="stable")
        cuts = np.searchsorted(part[numbers], np.arange(parts + 1))
        for p in range(parts):
            at = numbers[cuts[p] : cuts[p + 1]]
            if len(at):
                yield p, at, keys[at]

    def counts(self, order: int, answers: dict, parts: int) -> np.ndarray:
        """The corpus counts of the block's words or pairs."""
        counts = np.zeros(len(self.words) if order == 1 else len(self.pairs), np.int64)
        for p, at, _ in self.by_part(order, parts):
            counts[at] = unsqueeze(answers[order, p])
        return counts


def _questions(parts: int):
    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, row in batch.iterrows():
                block = Block(row)
                for order in (1, 2):
                    places, size = block.places(order), len(block.words) if order == 1 else len(block.pairs)
                    main = np.bincount(places[block.roles == MAIN], minlength=size)
                    held = np.bincount(places[block.roles == WEIGHTS], minlength=size)
                    asked = [
                        (order, p, row["block"], keys.view(np.int64), squeeze(main[at]), squeeze(held[at]))
                        for p, at, keys in block.by_part(order, parts)
                    ]
                    yield pd.DataFrame(asked, columns=["order", "part", "block", "keys", "main", "held"])

    return ask


def _answer(group: pd.DataFrame) -> pd.DataFrame:
    """Sums of a part's questions, for each block: over the main documents, and over
    all that train; the part's totals have a null block."""
    keys = np.concatenate([np.asarray(k, np.int64) for k in group["keys"]])
    main = np.concatenate([unsqueeze(x) for x in group["main"]])
    held = np.concatenate([unsqueeze(x) for x in group["held"]])
    _, place = np.unique(keys, return_inverse=True)
    main_sums = np.bincount(place, weights=main).astype(np.int64)
    both = main_sums + np.bincount(place, weights=held).astype(np.int64)
    cuts = np.cumsum([0, *(len(k) for k in group["keys"])])
    order, part = int(group["order"].iloc[0]), int(group["part"].iloc[0])
    rows = [
        (order, part, int(b), squeeze(main_sums[place[i:j]]), squeeze(both[place[i:j]]), None, None, None, None)
        for b, i, j in zip(group["block"], cuts, cuts[1:])
    ]
    rows.append((order, part, None, None, None, int((both > 0).sum()), int((main_sums > 0).sum()), int(both.sum()), int(main_sums.sum())))
    frame = pd.DataFrame(rows, columns=["order", "part", "block", "main", "all", "types", "main_types", "total", "main_total"])
    for c in ("block", "types", "main_types", "total", "main_total"):
        frame[c] = frame[c].astype("Int64")
    return frame


def bucket_of(counts: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else one more than the whole part of its log2."""
    return np.minimum(np.floor(np.log2(np.maximum(counts, 1))).astype(np.int64) + (counts > 0), BUCKETS - 1)


def parts_of(block: Block, words: np.ndarray, pairs: np.ndarray, total: int, types: int):
    """(bucket, bigram, unigram) for each pair of the block, from the given counts."""
    context, word = np.divmod(block.pairs, len(block.words))
    seen = words[context]
    return bucket_of(seen), pairs / np.maximum(seen, 1), words[word] / max(total, 1)


def learn(cells: pd.DataFrame, uniform: float) -> np.ndarray:
    """Weights (bigram, unigram, uniform) of each bucket by expectation-maximisation.

    ``cells`` pools held-out tokens by bucket and by both probabilities. A bucket
    without held-out tokens takes the weights of the nearest one below it.
    """
    weights = np.tile([0.0, 0.8, 0.2], (BUCKETS, 1))
    last = np.array([0.3, 0.5, 0.2])
    for bucket in range(BUCKETS):
        own = cells[cells["bucket"] == bucket]
        if len(own):
            n = own["n"].to_numpy(float)
            parts = np.column_stack([own["bigram"], own["unigram"], np.full(len(own), uniform)]).astype(float)
            w = np.array([0.0, 0.8, 0.2]) if bucket == 0 else np.array([0.4, 0.4, 0.2])
            for _ in range(ROUNDS):
                mass = parts * w
                w = (n[:, None] * mass / mass.sum(axis=1, keepdims=True)).sum(axis=0) / n.sum()
            # Something is left to every part, so that no text is impossible.
            w = np.maximum(w, 1e-6 * (parts.max(axis=0) > 0) + np.array([0.0, 1e-6, 1e-6]))
            weights[bucket] = w / w.sum()
            if bucket:
                last = weights[bucket]
        elif bucket:
            weights[bucket] = last
    return weights


def score(spark: SparkSession, documents: DataFrame, training: Column, weight_folds: int = 10) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    for_weights = F.pmod(F.xxhash64("doc_id", F.lit("weights")), F.lit(weight_folds)) == 0
    role = F.when(~training, HELD_OUT).when(for_weights, WEIGHTS).otherwise(MAIN)
    rows = documents.select("doc_id", role.alias("role"), "text")
    made = rows.mapInPandas(_blocks, f"block long, ids array<{kind}>, roles binary, lengths binary, words array<bigint>, tokens binary")
    blocks, _ = keep(spark, made, "token-blocks")
    volume = blocks.agg(F.sum(F.size("words")), F.sum(F.size("ids")), F.sum(F.octet_length("tokens"))).first()
    # A token takes about one and a half bytes; pairs are at most as many as tokens.
    parts = max(4, -(-(volume[2] or 0) // PART_KEYS))
    asked = blocks.mapInPandas(_questions(parts), "order int, part int, block long, keys array<bigint>, main binary, held binary")
    answered = asked.groupBy("order", "part").applyInPandas(
        _answer, "order int, part int, block long, main binary, all binary, types long, main_types long, total long, main_total long"
    )
    answered, _ = keep(spark, answered, "answers")
    sums = answered.where("block is null and order = 1").agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("types", "main_types", "total", "main_total")]).first()
    types, main_types, total, main_total = (int(x) for x in sums)

    def with_replies(counts: str, work, schema: str) -> DataFrame:
        """``work(left, right)`` for each block and the replies to it."""
        replies = answered.where("block is not null").select("order", "part", "block", F.col(counts).alias("counts"))
        return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInPandas(work, schema)

    def joined(left: pd.DataFrame, right: pd.DataFrame):
        block = Block(left.iloc[0])
        answers = {(o, p): c for o, p, c in zip(right["order"], right["part"], right["counts"])}
        return block, block.counts(1, answers, parts), block.counts(2, answers, parts)

    def pooled(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return pd.DataFrame(columns=["bucket", "b", "u", "n"])
        block, words, pairs = joined(left, right)
        n = np.bincount(block.pair_of[block.roles == WEIGHTS], minlength=len(block.pairs))
        bucket, bigram, unigram = (x[n > 0] for x in parts_of(block, words, pairs, main_total, main_types))
        b, u = (np.where(x > 0, np.round(GRAIN * -np.log2(np.maximum(x, 1e-300))), -1).astype(np.int64) for x in (bigram, unigram))
        cells = pd.DataFrame({"bucket": bucket, "b": b, "u": u, "n": n[n > 0]})
        return cells.groupby(["bucket", "b", "u"], as_index=False)["n"].sum()

    cells = (
        with_replies("main", pooled, "bucket long, b long, u long, n long").groupBy("bucket", "b", "u").agg(F.sum("n").alias("n")).toPandas()
    ).sort_values(["bucket", "b", "u"])
    for name, column in (("bigram", "b"), ("unigram", "u")):
        cells[name] = np.where(cells[column] < 0, 0.0, np.exp2(-cells[column].to_numpy(float) / GRAIN))
    weights = learn(cells, 1.0 / (main_types + 1))

    def scored(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        block, words, pairs = joined(left, right)
        bucket, bigram, unigram = parts_of(block, words, pairs, total, types)
        w = weights[bucket]
        chance = np.log10(w[:, 0] * bigram + w[:, 1] * unigram + w[:, 2] / (types + 1))
        base = np.log10((words + 0.5) / (total + 0.5 * (types + 1)))
        starts = block.ends - block.lengths
        return pd.DataFrame(
            {
                "doc_id": pd.Series(list(left.iloc[0]["ids"]), dtype=object),
                "held_out": block.roles[starts] == HELD_OUT,
                "n_tokens": block.lengths,
                "n_known": np.add.reduceat((words > 0)[block.tokens].astype(np.int64), starts),
                "train_tokens": total,
                "base_score": np.add.reduceat(base[block.tokens], starts),
                "score": np.add.reduceat(chance[block.pair_of], starts),
            }
        )

    return with_replies(
        "all", scored, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
