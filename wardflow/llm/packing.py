"""Best-fit packing of documents into training sequences under conflicts.

A sequence holds ``capacity`` words. A longer document fills whole sequences of
its own and leaves a remainder; remainders and shorter documents are packed by
decreasing length. The open sequences of a shard are ordered by what is left in
them, and each carries a bitmap of its sources and one of its duplicate clusters.
A document looks up the sequence with the least sufficient room and goes on to
its successors until one holds neither its source nor its cluster; if none does,
it opens a new one.

Documents are dealt to shards of about ``shard_docs`` by a hash of a written row
number, so that one source, cluster or id with a third of all rows is spread over
all shards; only lengths, sources and digests are written and shuffled.

Defined cases: a text that is null or without words takes no room, its row has
length 0 and no sequence; a null source conflicts with nothing; repeated rows are
packed each on their own, and never into one sequence, as they are copies; ties
in length go by doc_id, nulls first; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm.common import keep

CAPACITY = 2048
SHARD_DOCS = 4096
WORD = r"[^\x20\x09-\x0D]+"


def content_cluster(text: Column) -> Column:
    """Digest that equal texts share, whatever their case and white space."""
    return F.xxhash64(F.trim(F.regexp_replace(F.lower(text), r"[\x20\x09-\x0D]+", " ")))


def place(lengths: list[int], sources: list, clusters: list, capacity: int) -> list[int]:
    """The sequence number of each item, which come by decreasing length."""
    bits: dict = {}
    shared: dict = {}
    rooms: list[tuple[int, int]] = []  # (room left, sequence), in order
    source_maps: list[int] = []
    cluster_maps: list[int] = []
    placed = []
    for length, source, cluster in zip(lengths, sources, clusters):
        mine = 0 if source is None else 1 << bits.setdefault(source, len(bits))
        alike = 1 << shared.setdefault(cluster, len(shared)) if cluster is not None else 0
        at = bisect_left(rooms, (length, -1))
        while at < len(rooms) and (source_maps[rooms[at][1]] & mine or cluster_maps[rooms[at][1]] & alike):
            at += 1
        if at < len(rooms):
            room, number = rooms.pop(at)
        else:
            room, number = capacity, len(source_maps)
            source_maps.append(0)
            cluster_maps.append(0)
        source_maps[number] |= mine
        cluster_maps[number] |= alike
        if room > length:
            insort(rooms, (room - length, number))
        placed.append(number)
    return placed


def pack(
    spark: SparkSession,
    documents: DataFrame,
    capacity: int = CAPACITY,
    shard_docs: int = SHARD_DOCS,
    cluster: Column | None = None,
) -> DataFrame:
    """(doc_id, piece, begin, length, sequence_id, position): where each piece of a document goes.

    ``begin`` is the piece's first word; ``position`` its first word's place in
    the sequence. ``cluster`` names the duplicate group, by default equal texts.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = documents.select(
        "doc_id",
        F.col("source").cast("string").alias("source") if "source" in documents.columns else F.lit(None).cast("string").alias("source"),
        (content_cluster(F.col("text")) if cluster is None else F.xxhash64(cluster)).alias("cluster"),
        words.alias("n"),
    )
    # Rows are dealt by written numbers, so that equal rows and those without an
    # id are spread like any others; rows without words need no sequence.
    numbered, _ = keep(spark, rows.withColumn("row", F.monotonically_increasing_id()), "lengths")
    empty, worded = numbered.where("n = 0"), numbered.where("n > 0")
    shards = max(1, -(-worded.count() // shard_docs))
    dealt = worded.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards))).drop("row")

    def packed(group: pd.DataFrame) -> pd.DataFrame:
        shard = int(group["shard"].iloc[0]) << 32
        ids = group["doc_id"].astype(object)
        ids = ids.where(ids.notna(), None)
        order = sorted(range(len(group)), key=lambda i: (ids.iloc[i] is not None, ids.iloc[i] if ids.iloc[i] is not None else 0))
        lengths, sources, clusters = (group[c].tolist() for c in ("n", "source", "cluster"))
        out = []
        rest = []
        sequence = 0
        for i in order:
            whole, left = divmod(lengths[i], capacity)
            for piece in range(whole):
                out.append((ids.iloc[i], piece, piece * capacity, capacity, shard + sequence, 0))
                sequence += 1
            if left:
                rest.append((left, i, whole))
        rest.sort(key=lambda item: -item[0])
        counts: dict = {}
        for _, i, _ in rest:
            counts[clusters[i]] = counts.get(clusters[i], 0) + 1
        numbers = place(
            [left for left, _, _ in rest],
            [sources[i] for _, i, _ in rest],
            [clusters[i] if counts[clusters[i]] > 1 else None for _, i, _ in rest],
            capacity,
        )
        filled: dict[int, int] = {}
        for (left, i, whole), number in zip(rest, numbers):
            at = filled.get(number, 0)
            filled[number] = at + left
            out.append((ids.iloc[i], whole, whole * capacity, left, shard + sequence + number, at))
        frame = pd.DataFrame(out, columns=["doc_id", "piece", "begin", "length", "sequence_id", "position"])
        for column in ("doc_id", "sequence_id", "position"):
            frame[column] = frame[column].astype(object).where(frame[column].notna(), None)
        return frame

    schema = f"doc_id {kind}, piece long, begin long, length long, sequence_id long, position long"
    nothing = empty.select("doc_id", *[F.lit(0).cast("long").alias(c) for c in ("piece", "begin", "length")], *[F.lit(None).cast("long").alias(c) for c in ("sequence_id", "position")])
    return dealt.groupBy("shard").applyInPandas(packed, schema).unionByName(nothing)


def sequences(packed: DataFrame, documents: DataFrame) -> DataFrame:
    """(sequence_id, doc_ids, text): each sequence's documents in order and their words."""
    texts = documents.select("doc_id", "text").dropDuplicates(["doc_id"])
    pieces = packed.where("sequence_id is not null").join(texts, "doc_id")
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    cut = F.array_join(F.slice(words, (F.col("begin") + 1).cast("int"), F.col("length").cast("int")), " ")
    return (
        pieces.select("sequence_id", F.struct("position", "doc_id", cut.alias("text")).alias("p"))
        .groupBy("sequence_id")
        .agg(F.sort_array(F.collect_list("p")).alias("p"))
        .select("sequence_id", F.col("p.doc_id").alias("doc_ids"), F.array_join("p.text", "\n").alias("text"))
    )
