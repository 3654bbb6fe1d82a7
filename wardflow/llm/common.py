"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.sources.tables import scratch_path

#: Word separators of the white-space tokenisation: space, tab to carriage return.
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_BYTES = np.random.Generator(np.random.PCG64(99)).integers(1, 2**63, 256, dtype=np.uint64)
STEP = 0x9E3779B97F4A7C15
STEP_BACK = pow(STEP, -1, 2**64)
#: Bytes hashed at a time; longer texts are cut at a blank.
_PIECE = 1 << 18
_powers: dict[int, np.ndarray] = {}


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds, F.lit(0)).cast("int")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(spark: SparkSession, df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``df`` written to the shared folder and read back, and its path."""
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete tables of :func:`keep` that nothing reads any more."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def words_of(text: str | None) -> list[str]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case; none for null."""
    if not isinstance(text, str):
        return []
    # Of bytes, lower() and split() know ASCII only, which is what is asked for.
    return [w.decode("utf-8", "surrogatepass") for w in text.encode("utf-8", "surrogatepass").lower().split()]


def hash_words(text: str | None) -> np.ndarray:
    """A fixed 64-bit hash of each word of :func:`words_of`, in order.

    A word's hash is the polynomial of its bytes, taken from running sums over
    the text, and scrambled together with its length.
    """
    if not isinstance(text, str):
        return np.zeros(0, np.uint64)
    data = text.encode("utf-8", "surrogatepass").lower()
    found = []
    at = 0
    while at < len(data):
        end = len(data)
        if end - at > _PIECE:
            cut = max(data.rfind(blank, at, at + _PIECE) for blank in (b" ", b"\n"))
            end = cut + 1 if cut >= at else len(data)
        found.append(_hash_piece(np.frombuffer(data, np.uint8, end - at, at)))
        at = end
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def power(step: int, n: int) -> np.ndarray:
    """1, step, step ** 2, ... modulo 2 ** 64."""
    have = _powers.get(step)
    if have is None or len(have) < n:
        size = 1 << max(12, (n - 1).bit_length())
        have = np.full(size, step, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= _PIECE:
            _powers[step] = have
    return have[:n]


def _hash_piece(data: np.ndarray) -> np.ndarray:
    blank = np.ones(len(data) + 2, bool)
    blank[1:-1] = _BLANK[data]
    edge = np.flatnonzero(blank[1:] != blank[:-1])
    return _hash_between(data, edge[0::2], edge[1::2])


def _hash_between(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTES[data] * power(STEP, len(data)), out=sums[1:])
        words = (sums[end] - sums[begin]) * power(STEP_BACK, len(data))[begin]
        return mixed(words + (end - begin).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))


def hash_spans(data: bytes, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """What :func:`hash_words` gives for the words that lie at these places of a
    text's bytes, A-Z already in lower case."""
    found = [np.zeros(0, np.uint64)]
    at = 0
    while at < len(begin):
        # As many words as a piece holds, one at least.
        upto = max(int(np.searchsorted(end, begin[at] + _PIECE, side="right")), at + 1)
        piece = np.frombuffer(data, np.uint8, int(end[upto - 1] - begin[at]), int(begin[at]))
        found.append(_hash_between(piece, begin[at:upto] - begin[at], end[at:upto] - begin[at]))
        at = upto
    return np.concatenate(found)


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (xor-shift and multiply)."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> np.uint64(27))
        x = x * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def spans(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers begin, begin + 1, ... of every span, one span after another."""
    total = int(sizes.sum())
    offsets = np.cumsum(sizes) - sizes
    return np.arange(total) - np.repeat(offsets - begins, sizes)


def isotonic(score: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing fit by pooling adjacent violators: (scores, fitted means)."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []
    for s, y, w in zip(score[order], label[order], weight[order]):
        blocks.append([s, s, y * w, w])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
            _, high, total, mass = blocks.pop()
            blocks[-1][1] = high
            blocks[-1][2] += total
            blocks[-1][3] += mass
    xs = [x for low, high, _, _ in blocks for x in ((low, high) if high > low else (low,))]
    ys = [t / m for low, high, t, m in blocks for _ in range(2 if high > low else 1)]
    return np.array(xs, float), np.array(ys, float)


def calibration(scored: DataFrame, score: str, label: str, cells: int = 1000) -> tuple[list[float], list[float]]:
    """Isotonic curve through the mean score and label of cells 1/``cells`` wide.

    Scores are cut to [-1, 2], so only ``3 * cells`` sums reach the driver,
    however many rows there are. Without rows the curve is flat at 0.5.
    """
    cut = F.greatest(F.lit(-1.0), F.least(F.lit(2.0), F.col(score).cast("double")))
    sums = (
        scored.select(cut.alias("s"), F.col(label).cast("double").alias("y"))
        .where("s is not null and y is not null")
        .groupBy(F.floor(F.col("s") * cells).alias("cell"))
        .agg(F.avg("s").alias("s"), F.avg("y").alias("y"), F.count("*").cast("double").alias("w"))
        .orderBy("cell")
        .collect()
    )
    if not sums:
        return [0.0], [0.5]
    columns = [np.array([r[c] for r in sums], float) for c in ("s", "y", "w")]
    xs, ys = isotonic(*columns)
    return xs.tolist(), ys.tolist()


def labelled_sample(spark: SparkSession, documents: DataFrame, labels: DataFrame, label: str, chosen: Column, bound: int) -> DataFrame:
    """(doc_id, text, label, calibrate): about ``bound`` labelled rows at most, by a hash of the id.

    The label is that of ``labels`` (the largest, should a document have
    several), and ``calibrate`` marks the fifth that is kept for calibration.
    Only the sampled ids and labels, bounded by ``bound``, are broadcast; texts
    are not shuffled.
    """
    marks = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max(label).cast("double").alias("label"))
        .where(chosen)
    )
    share = min(1.0, bound / max(marks.count(), 1))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_000))
    drawn = marks.where(draw < int(share * 1_000_000)).withColumn("calibrate", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(5)) == 0)
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return keep(spark, texts.join(F.broadcast(drawn), "doc_id"), "labelled")[0]
