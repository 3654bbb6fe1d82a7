"""Near-duplicate documents by MinHash, banding, verification and components.

1. Every text becomes its set of 5-word shingles (64-bit hashes). Documents with
   the same set are one class; only class representatives go on.
2. ``BANDS * ROWS`` universal hash functions give minima; each band of them is a
   bucket key. Buckets are never expanded into all pairs: each bucket's members
   are first compared with its smallest member only, twice over.
3. Such a pair passes a length test, a comparison of one-byte signatures and then
   the exact test on full sets: 100 * intersection >= 75 * union.
   Where a bucket then still spans several components, its members outside the
   most common one meet all others through an inverted list of their shingles,
   in tiles of bounded size, so no candidate between components is skipped; only
   links that join two components leave the task.
4. Links become components by alternating large-star and small-star.

At a similarity of exactly 0.75 a pair shares no band with a probability of
(1 - 0.75 ** 5) ** 40 = 2e-5; the signature test loses one in 1e9.

Defined cases: a text without words has an empty set and is linked with
nothing; a text of fewer than five words is one shingle; rows that repeat a
doc_id are one document, for which the row with the smallest set digest stands;
rows with a null doc_id are left out; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm.common import drop, hash_words, keep, mixed, spans

WORDS = 5
BANDS, ROWS = 40, 5
SIMILARITY = 75
#: Bucket members that meet in one tile.
TILE = 256
#: Share of equal signature bytes below which a pair at 0.75 is not to be expected: six deviations.
LEAST_EQUAL = 0.566
_draw = np.random.Generator(np.random.PCG64(20240229))
MULTIPLIERS = _draw.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
ADDENDS = _draw.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)


def shingles(text: str | None, size: int = WORDS) -> np.ndarray:
    """The distinct shingle hashes of a text, in order."""
    h = hash_words(text)
    if not len(h):
        return h
    size = min(size, len(h))
    with np.errstate(over="ignore"):
        rolled = np.full(len(h) - size + 1, size, np.uint64)
        for i in range(size):
            rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - size + 1 + i]
        return np.unique(mixed(rolled))


def minima(grams: np.ndarray, step: int = 512) -> np.ndarray:
    """Minimum of each universal hash function over a non-empty set, in blocks."""
    low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(0, len(grams), step):
            part = MULTIPLIERS[:, None] * grams[None, i : i + step] + ADDENDS[:, None]
            np.minimum(low, part.min(axis=1), out=low)
    return low


def _digest(grams: np.ndarray) -> bytes:
    with np.errstate(over="ignore"):
        parts = [mixed(grams ^ np.uint64(seed)).sum(dtype=np.uint64) for seed in (0x51ED270B, 0xC2B2AE3D27D4EB4F)]
    return b"".join(int(p).to_bytes(8, "big") for p in parts)


def _signed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            grams = shingles(text)
            if not len(grams):
                rows.append((doc_id, 0, None, None, None))
                continue
            low = minima(grams)
            with np.errstate(over="ignore"):
                keys = np.arange(BANDS, dtype=np.uint64)
                for r in range(ROWS):
                    keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + low[r::ROWS])
            rows.append((doc_id, len(grams), _digest(grams), keys.view(np.int64).tolist(), (low >> np.uint64(40)).astype(np.uint8).tobytes()))
        yield pd.DataFrame(rows, columns=["doc_id", "n", "digest", "bands", "sig"])


def _shingled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for node, digest, text in zip(batch["node"], batch["digest"], batch["text"]):
            grams = shingles(text)
            if _digest(grams) == bytes(digest):
                rows.append((node, grams.view(np.int64)))
        yield pd.DataFrame(rows, columns=["node", "grams"])


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for the nodes of (a, b) links.

    Large-star links each larger neighbour of a node to the smallest of its
    neighbourhood, small-star does so for the smaller ones; both keep the
    components and end in stars. Minima are aggregated before the shuffle and a
    node with very many links is an ordinary skewed join.
    """
    edges, path = keep(spark, _ordered(links.select("a", "b")), "links")
    state = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
        large = _ordered(both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b")))
        lowest = large.groupBy("b").agg(F.min("a").alias("low"))
        small = large.join(lowest, "b").select("b", "a", "low")
        edges_next = _ordered(small.selectExpr("a as a", "low as b").union(small.selectExpr("b as a", "low as b")))
        edges, following = keep(spark, edges_next, "links")
        drop(spark, [path])
        path = following
        found = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1000003)).first()
        if tuple(found) == state:
            break
        state = tuple(found)
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component"))


def _ordered(pairs: DataFrame) -> DataFrame:
    """Distinct pairs with a < b."""
    return pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _verified(pairs: DataFrame, signatures: DataFrame, sets: DataFrame) -> DataFrame:
    """The (a, b) pairs whose full sets pass the test."""

    @F.pandas_udf("double")
    def equal_share(a: pd.Series, b: pd.Series) -> pd.Series:
        x = np.frombuffer(b"".join(a), np.uint8).reshape(len(a), -1)
        y = np.frombuffer(b"".join(b), np.uint8).reshape(len(b), -1)
        return pd.Series((x == y).mean(axis=1))

    left = signatures.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sig").alias("siga"))
    right = signatures.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sigb"))
    near = (
        pairs.join(left, "a")
        .join(right, "b")
        .where(100 * F.least("na", "nb") >= SIMILARITY * F.greatest("na", "nb"))
        .where(equal_share("siga", "sigb") >= LEAST_EQUAL)
        .select("a", "b")
    )
    first = sets.select(F.col("node").alias("a"), F.col("grams").alias("x"))
    second = sets.select(F.col("node").alias("b"), F.col("grams").alias("y"))
    shared = F.size(F.array_intersect("x", "y"))
    return near.join(first, "a").join(second, "b").where(
        100 * shared >= SIMILARITY * (F.size("x") + F.size("y") - shared)
    ).select("a", "b")


def link(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per document."""
    rows = documents.where(F.col("doc_id").isNotNull()).select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    signed = rows.mapInPandas(_signed, f"doc_id {kind}, n long, digest binary, bands array<bigint>, sig binary")
    base, _ = keep(spark, signed, "minhash")
    one = base.groupBy("doc_id").agg(F.min(F.struct("digest", "n")).alias("m")).select("doc_id", "m.digest", "m.n")
    # Written, so that documents meet their class between plain tables and the
    # copies of one text can be split over tasks.
    classes, _ = keep(spark, one.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("node")), "class-heads")
    reps = base.join(classes.withColumnRenamed("digest", "__digest"), (F.col("doc_id") == F.col("node")) & (F.col("digest") == F.col("__digest")))
    reps, reps_path = keep(spark, reps.dropDuplicates(["node"]).select("node", "digest", "n", "bands", "sig"), "classes")

    spread = reps.select("node", F.explode("bands").alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.count("*").alias("k")).where("k > 1").select("bucket")
    members, _ = keep(spark, spread.join(shared, "bucket"), "buckets")
    nodes = members.select("node").distinct()
    signatures, _ = keep(spark, reps.join(nodes, "node").select("node", "digest", "n", "sig"), "signatures")
    texts = rows.join(signatures.select("node", "digest"), rows["doc_id"] == signatures["node"]).select("node", "digest", "text")
    sets, _ = keep(spark, texts.mapInPandas(_shingled, f"node {kind}, grams array<bigint>").dropDuplicates(["node"]), "sets")
    drop(spark, [reps_path])

    placed = members.select("bucket", "node", F.col("node").alias("component"))
    tested, labels = None, None
    for _ in range(2):
        pairs = _star_pairs(placed)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs, _ = keep(spark, pairs, "candidates")
        tested = pairs
        labels = _joined(spark, labels, _verified(pairs, signatures, sets))
        placed = _placed(members, labels)
    labels = _joined(spark, labels, _tiled_links(placed, sets))
    joined = one.join(classes, "digest", "left").join(labels, "node", "left")
    component = F.coalesce("component", "node", "doc_id")
    return joined.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), (F.col("doc_id") == component).alias("kept")
    )


def _open_buckets(placed: DataFrame) -> DataFrame:
    """Buckets that span several components, with their smallest member."""
    return (
        placed.groupBy("bucket")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min(F.struct("component", "node")).alias("first"))
        .where("low <> high")
        .select("bucket", F.col("first.component").alias("first_component"), F.col("first.node").alias("first_node"))
    )


def _star_pairs(placed: DataFrame) -> DataFrame:
    """Each member with its bucket's smallest, unless they are linked already."""
    return _ordered(
        placed.join(_open_buckets(placed), "bucket")
        .where("component <> first_component")
        .select(F.col("first_node").alias("a"), F.col("node").alias("b"))
    )


def _joined(spark: SparkSession, labels: DataFrame | None, found: DataFrame) -> DataFrame:
    """Components of the links so far and the newly found ones."""
    found = found.select("a", "b")
    if labels is not None:
        found = found.union(labels.select(F.col("component").alias("a"), F.col("node").alias("b")))
    return components(spark, found)


def _placed(members: DataFrame, labels: DataFrame) -> DataFrame:
    return members.join(labels, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component"))


def _tiled_links(placed: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) of members outside a bucket's largest component with its others.

    Small buckets share a group of about ``TILE`` members; one with more is cut
    into tiles, in which each slice of its outsiders meets each slice of its
    members. The number of groups follows the members.
    """
    sizes = placed.groupBy("bucket", "component").agg(F.count("*").alias("k"))
    bulk = (
        sizes.groupBy("bucket")
        .agg(F.max(F.struct("k", "component")).alias("m"), F.count("*").alias("parts"), F.sum("k").alias("k"))
        .where("parts > 1")
        .select("bucket", F.col("m.component").alias("bulk"), "k", F.ceil(F.col("k") / TILE).cast("int").alias("slices"))
    )
    members = bulk.agg(F.sum("k")).first()[0] or 0
    opened = placed.join(bulk.drop("k"), "bucket").join(sets, "node")
    outsider, slice_of = F.col("component") != F.col("bulk"), F.pmod(F.hash("node"), F.col("slices"))
    columns = ["bucket", "node", "component", "grams"]
    small = opened.where("slices = 1").select(
        F.pmod(F.xxhash64("bucket"), F.lit(members // TILE + 1)).alias("tile"), F.lit(-1).alias("other"), *columns, outsider.alias("asks"), F.lit(True).alias("asked")
    )
    others = F.explode(F.sequence(F.lit(0), F.col("slices") - 1))
    large = opened.where("slices > 1")
    asks = large.where(outsider).select(F.xxhash64("bucket", slice_of).alias("tile"), others.alias("other"), *columns, F.lit(True).alias("asks"), F.lit(False).alias("asked"))
    asked = large.withColumn("tile", others).select(F.xxhash64("bucket", "tile").alias("tile"), slice_of.alias("other"), *columns, F.lit(False).alias("asks"), F.lit(True).alias("asked"))
    kind = placed.schema["node"].dataType.simpleString()
    return small.unionByName(asks).unionByName(asked).groupBy("tile", "other").applyInPandas(_linked, f"a {kind}, b {kind}").distinct()


def _linked(tile: pd.DataFrame) -> pd.DataFrame:
    """For each asking member, its first link to every other component of the bucket."""
    out = []
    for _, bucket in tile.groupby("bucket", sort=False):
        asks, asked = bucket[bucket["asks"]], bucket[bucket["asked"]].sort_values("node")
        if not len(asks) or not len(asked):
            continue
        sizes = asked["grams"].map(len).to_numpy()
        grams = np.concatenate(asked["grams"].to_numpy())
        order = np.argsort(grams, kind="stable")
        owners = np.repeat(np.arange(len(asked)), sizes)[order]
        known, begins, counts = np.unique(grams[order], return_index=True, return_counts=True)
        nodes, components_of = asked["node"].to_numpy(), asked["component"].to_numpy()
        for node, component, mine in zip(asks["node"], asks["component"], asks["grams"]):
            at = np.searchsorted(known, mine)
            at[at == len(known)] = 0
            at = at[known[at] == mine]
            shared = np.bincount(owners[spans(begins[at], counts[at])], minlength=len(asked))
            near = (100 * shared >= SIMILARITY * (len(mine) + sizes - shared)) & (components_of != component)
            seen = set()
            for other in np.flatnonzero(near):
                if components_of[other] not in seen:
                    seen.add(components_of[other])
                    out.append((node, nodes[other]))
    return pd.DataFrame(out, columns=["a", "b"])


def keep_representatives(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """One document of each group: the one with the smallest id, all its columns.

    Every row is judged by its own text. Where ids are unique they name the rows;
    else written row numbers do, and rows of one id with different texts and rows
    with a null id are documents of their own. A null id counts as the largest.
    Rows without words are groups of one.
    """
    if documents.groupBy("doc_id").agg(F.count("*").alias("n")).where("doc_id is null or n > 1").isEmpty():
        kept = link(spark, documents).where("kept").select(F.col("doc_id").alias("__kept_id"))
        return documents.join(kept, documents["doc_id"] == kept["__kept_id"], "left_semi")
    numbered, _ = keep(spark, documents.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    linked = link(spark, numbered.select(F.col("__row").alias("doc_id"), "text"))
    members = linked.select(F.col("doc_id").alias("__row"), F.col("component_id").alias("__group")).join(numbered.select("__row", "doc_id"), "__row")
    smallest = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "__row")).alias("m")
    chosen = members.groupBy("__group").agg(smallest).select(F.col("m.__row").alias("__row"))
    return numbered.join(chosen, "__row", "left_semi").drop("__row")
