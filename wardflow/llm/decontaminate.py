"""Benchmark decontamination with DataFrame functions only.

Benchmark items are cut into windows of ``n`` words (shorter items are one
window). The distinct windows, as 64-bit hashes, form a hash set that goes to
every task; each document is scanned once, every window of it is looked up, and
a hit is verified on the words themselves. Nothing of a document is shuffled.

Defined cases: a null or empty text has no words and is clean; items without
words are ignored; an item or window that occurs twice counts once; repeated
document rows are judged each on their own; extra columns are ignored by
:func:`judge` and carried through by :func:`remove_contaminated`; with an empty
benchmark every document is clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm.common import keep

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Everything in ASCII that is neither a digit nor a lower-case letter.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Most windows looked up as a hash set inside the scan; 16 bytes each.
SET_LIMIT = 100_000


def words(text: Column) -> Column:
    """Normalised words, in order."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(lowered, SEPARATORS), lambda w: w != "")


def bound(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is computed once a row.

    A plain column would be copied into every lambda that uses it and computed
    again for each element; a one-element explode keeps it apart.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def windows(benchmark: DataFrame, n: int = 13) -> DataFrame:
    """(item_id, size, gram, h): the distinct windows of every item."""
    items = bound(benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text"), "w", words(F.col("text")))
    items = items.where(F.size("w") > 0).withColumn("size", F.least(F.size("w"), F.lit(n)))
    starts = F.sequence(F.lit(1), F.expr("size(w) - size + 1"))
    grams = F.transform(starts, lambda i: F.array_join(F.slice("w", i, F.col("size")), " "))
    return (
        items.select("item_id", "size", F.explode(F.array_distinct(grams)).alias("gram"))
        .withColumn("h", window_hash(F.split(F.col("gram"), " ")))
        .distinct()
    )


def window_hash(gram_words: Column) -> Column:
    """Hash of a window, made of the hashes of its words."""
    return F.xxhash64(F.transform(gram_words, lambda w: F.xxhash64(w)))


def _spots(size: int, fields: str, where: str = "") -> Column:
    """Structs of ``fields`` at each position ``i`` where a window of ``size`` words fits."""
    starts = f"if(size(w) >= {size}, sequence(1, size(w) - {size} + 1), cast(array() as array<int>))"
    if where:
        starts = f"filter({starts}, i -> {where})"
    return F.expr(f"transform({starts}, i -> named_struct('pos', i, 'size', {size}, {fields}))")


def _hash_at(size: int) -> str:
    return f"xxhash64(slice(wh, i, {size}))"


def _hits_in_scan(scanned: DataFrame, by_size: dict[int, list[int]]) -> DataFrame:
    """Adds ``found``: struct(pos, size, gram) wherever a window's hash is in the set."""
    parts = [
        _spots(
            size,
            f"'gram', array_join(slice(w, i, {size}), ' ')",
            f"{_hash_at(size)} in ({', '.join(f'{h}L' if h > -(2**63) else f'({h + 1}L - 1L)' for h in hashes)})",
        )
        for size, hashes in sorted(by_size.items())
    ]
    return scanned.withColumn("found", F.concat(*parts))


def _hits_by_join(scanned: DataFrame, grams: DataFrame, sizes: list[int]) -> DataFrame:
    """The same through a join on the window hash, for sets beyond SET_LIMIT."""
    spots = F.concat(*[_spots(size, f"'h', {_hash_at(size)}") for size in sizes])
    hits = (
        scanned.select("row", F.explode(spots).alias("s"))
        .select("row", "s.*")
        .join(grams.select("size", "h").distinct(), ["size", "h"])
        .groupBy("row")
        .agg(F.collect_list(F.struct("pos", "size")).alias("spots"))
    )
    found = F.expr(
        "transform(coalesce(spots, cast(array() as array<struct<pos:int,size:int>>)), "
        "s -> named_struct('pos', s.pos, 'size', s.size, 'gram', array_join(slice(w, s.pos, s.size), ' ')))"
    )
    return scanned.join(hits, "row", "left").withColumn("found", found)


def scan(documents: DataFrame, benchmark: DataFrame, n: int = 13, set_limit: int = SET_LIMIT) -> DataFrame:
    """(doc_id, version, n_words, spans, items) of every row; ``version`` is the text's MD5 digest.

    ``spans`` are the merged word ranges [begin, end), from 0, that windows
    cover, in order; ``items`` the sorted ids of the items with occurring
    windows. The benchmark's windows are counted first: up to ``set_limit`` of
    them are looked up inside the scan, more are joined by hash.
    """
    spark = documents.sparkSession
    grams, _ = keep(spark, windows(benchmark, n), "benchmark-windows")
    by_size: dict[int, list[int]] = {}
    small = grams.select("size", "h").distinct().count() <= set_limit
    if small:
        for r in grams.select("size", "h").distinct().collect():
            by_size.setdefault(r["size"], []).append(r["h"])
    else:
        by_size = {r["size"]: [] for r in grams.select("size").distinct().collect()}
    rows = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", F.md5("text").alias("version"))
    scanned = bound(rows, "w", words(F.col("text"))).drop("text")
    scanned = bound(scanned, "wh", F.transform("w", lambda w: F.xxhash64(w)))
    if not by_size:
        scanned = scanned.withColumn("found", F.expr("cast(array() as array<struct<pos:int,size:int,gram:string>>)"))
    elif small:
        scanned = _hits_in_scan(scanned, by_size)
    else:
        scanned = _hits_by_join(scanned, grams, sorted(by_size))
    found, _ = keep(spark, scanned.select("row", "doc_id", "version", F.size("w").cast("long").alias("n_words"), "found"), "window-hits")
    listed = grams.groupBy("gram").agg(F.collect_set("item_id").alias("ids"))
    hits = found.select("row", F.explode("found").alias("f")).select("row", "f.*")
    spans = merged_spans(hits.join(F.broadcast(listed) if small else listed, "gram"))
    return found.select("row", "doc_id", "version", "n_words").join(spans, "row", "left").select(
        "doc_id",
        "version",
        "n_words",
        F.coalesce("spans", F.expr("cast(array() as array<struct<begin:int,end:int>>)")).alias("spans"),
        F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"),
    )


def merged_spans(hits: DataFrame) -> DataFrame:
    """(row, spans, items) from verified hits (row, pos, size, ids).

    A hit opens a span where it begins after the largest end before it.
    """
    in_order = Window.partitionBy("row").orderBy("pos", "size")
    end = F.col("pos") + F.col("size")
    reach = F.max(end).over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    opened = hits.withColumn("opens", (reach.isNull() | (F.col("pos") > reach)).cast("int"))
    numbered = opened.withColumn("span", F.sum("opens").over(in_order))
    return (
        numbered.groupBy("row", "span")
        .agg((F.min("pos") - 1).alias("begin"), (F.max(end) - 1).alias("end"), F.flatten(F.collect_set("ids")).alias("ids"))
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("items"))
    )


def judge(documents: DataFrame, benchmark: DataFrame, n: int = 13, share: int = 20) -> DataFrame:
    """Contamination of every row: it is so when ``share * n_hit >= n_words`` and something is hit."""
    n_hit = F.aggregate("spans", F.lit(0), lambda total, s: total + s["end"] - s["begin"]).cast("long")
    return scan(documents, benchmark, n).withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))
    )


def remove_contaminated(documents: DataFrame, benchmark: DataFrame, n: int = 13, share: int = 20) -> DataFrame:
    """Documents without the contaminated ones, each row judged by its own text."""
    bad = judge(documents, benchmark, n, share).where("contaminated")
    bad = bad.select(F.col("doc_id").alias("__bad_id"), F.col("version").alias("__bad_version")).distinct()
    same = documents["doc_id"].eqNullSafe(bad["__bad_id"]) & (F.md5(documents["text"]) == bad["__bad_version"])
    return documents.join(bad, same, "left_anti")


def remove_spans(documents: DataFrame, benchmark: DataFrame, n: int = 13) -> DataFrame:
    """(doc_id, text) with the hit words taken out: the other normalised words, joined by a blank."""
    spans = scan(documents, benchmark, n).where(F.size("spans") > 0).drop("n_words", "items").dropDuplicates(["doc_id", "version"])
    rows = documents.select(F.col("doc_id").alias("id"), "text", F.md5("text").alias("v"))
    joined = rows.join(spans, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("v") == F.col("version")), "left")
    joined = bound(joined.select(F.col("id").alias("doc_id"), "text", "spans"), "w", words(F.col("text")))
    outside = F.filter("w", lambda w, i: ~F.exists("spans", lambda s: (s["begin"] <= i) & (i < s["end"])))
    return joined.select("doc_id", F.when(F.col("spans").isNull(), F.col("text")).otherwise(F.array_join(outside, " ")).alias("text"))
