"""Validation split, quarantine, quality summaries and schema versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.config import LINEAGE_COLUMNS, LAYOUT_RULES, PASS_RATE_WARN, VALIDATION_RULES
from wardflow.functions.staffing import breaks_a_rule, validation_reasons
from wardflow.operators.dedup import latest_per_key


def with_reasons(records: DataFrame) -> DataFrame:
    """Records with the array of validator rules they break; a record with more
    cells than its header breaks a rule of its own."""
    reasons = validation_reasons(records.columns)
    if "_surplus" in records.columns:
        layout = F.when(F.col("_surplus").isNotNull(), F.array(F.lit("SURPLUS_CELLS"))).otherwise(F.expr("cast(array() as array<string>)"))
        reasons = F.concat(layout, reasons)
    return records.withColumn("reasons", reasons)


def split_valid(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, bad): each record is judged alone, so a bad one never takes
    its batch along. Both sides are filters over the same scan; only bad
    records carry the array of reasons."""
    broken = breaks_a_rule(records.columns)
    if "_surplus" in records.columns:
        broken = broken | F.col("_surplus").isNotNull()
    return records.filter(~broken), with_reasons(records.filter(broken))


def quarantine_index(bad: DataFrame, raw_columns: list[str]) -> DataFrame:
    """One row per bad record, with its raw cells as JSON."""
    return bad.select(
        F.col("_source_file").alias("source_file"),
        F.col("_ingested_at").alias("ingestion_timestamp"),
        F.col("reasons").alias("quarantine_reason"),
        "facility_id",
        F.to_json(F.struct(*raw_columns)).alias("raw_record"),
        F.lit(False).alias("resolved"),
    ).withColumn("record_hash", F.sha2("raw_record", 256))


def _message() -> Column:
    return F.concat_ws("|", "source_file", F.array_join("quarantine_reason", ","), "raw_record")


def quarantine_queue(index: DataFrame) -> DataFrame:
    """First arrival of each distinct message (file, record, reasons).

    The message carries its source file, so equal rows of two files stay apart
    while a retried file enqueues nothing new.
    """
    return latest_per_key(
        index.withColumn("message_hash", F.sha2(_message(), 256)),
        ["message_hash"],
        [F.col("ingestion_timestamp").asc()],
    )


def _message_key() -> Column:
    return F.xxhash64("source_file", F.array_join("quarantine_reason", ","), "raw_record")


def repeated_messages(index: DataFrame) -> DataFrame:
    """64-bit hashes of messages that come more than once: all that is moved is such a hash."""
    return index.groupBy(_message_key().alias("message_key")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("message_key")


def queue_of_batch(index: DataFrame, repeated: DataFrame) -> DataFrame:
    """:func:`quarantine_queue` where most messages come once: those go on as
    they lie, and only rows of the ``repeated`` hashes are brought together and
    compared by the whole message."""
    keyed = index.withColumn("message_key", _message_key())
    once = keyed.join(repeated, "message_key", "left_anti").drop("message_key")
    often = keyed.join(repeated, "message_key", "left_semi").drop("message_key")
    return once.withColumn("message_hash", F.sha2(_message(), 256)).unionByName(quarantine_queue(often))


def pass_rate(valid: str = "valid_records", total: str = "total_records") -> Column:
    """Valid share in percent; NULL without records."""
    return F.try_divide(F.col(valid) * 100.0, F.col(total))


def quality_status(total: str = "total_records", quarantined: str = "quarantined") -> Column:
    rate = F.col(total) - F.col(quarantined)
    return (
        F.when(F.col(quarantined) == 0, F.lit("PASS"))
        .when(rate * 100 >= F.col(total) * PASS_RATE_WARN, F.lit("WARN"))
        .otherwise(F.lit("FAIL"))
    )


def dq_summary(judged: DataFrame, by: list[str]) -> DataFrame:
    """Counts, pass rate, status and rule counts per group.

    The rule set is fixed, so every rule is one conditional count in the same
    aggregate: one shuffle of at most one row per task and group, with no
    explode. ``error_summary`` keeps only rules that fired.
    """
    rules = [*VALIDATION_RULES, *LAYOUT_RULES]
    rule_counts = [F.count_if(F.array_contains("reasons", rule)).alias(f"_n_{rule}") for rule in rules]
    counted = judged.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.size("reasons") == 0).alias("valid_records"),
        F.count_if(F.size("reasons") > 0).alias("quarantined"),
        *rule_counts,
    )
    summary = F.map_from_arrays(
        F.array(*[F.lit(r) for r in rules]),
        F.array(*[F.col(f"_n_{r}") for r in rules]),
    )
    return counted.select(
        *by,
        "total_records",
        "valid_records",
        "quarantined",
        pass_rate().alias("pass_rate"),
        quality_status().alias("quality_status"),
        F.map_filter(summary, lambda _, n: n > 0).alias("error_summary"),
    )


def resolve_remediated(index: DataFrame, remediated: DataFrame, keys: list[str]) -> DataFrame:
    """Index with ``resolved`` set where a corrected record has re-entered."""
    marks = remediated.select(*[F.col(k).alias(f"_fixed_{k}") for k in keys]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_fixed_{k}")) for k in keys]
    hit = marks.withColumn("_hit", F.lit(True))
    return (
        index.join(hit, same, "left")
        .withColumn("resolved", F.col("resolved") | F.coalesce("_hit", F.lit(False)))
        .drop("_hit", *[f"_fixed_{k}" for k in keys])
    )


def schema_version(columns: str | Column) -> Column:
    """``v_`` and eight hex digits of the MD5 of the sorted column list."""
    joined = F.concat_ws(",", F.array_sort(columns))
    return F.concat(F.lit("v_"), F.substring(F.md5(joined), 1, 8))


def new_schema_versions(headers: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """Versions of ``headers(dataset_name, columns, seen_at)`` not registered
    yet, each with the time it was first seen."""
    found = (
        headers.withColumn("schema_version", schema_version("columns"))
        .groupBy("dataset_name", "schema_version")
        .agg(F.min("seen_at").alias("registered_at"), F.min(F.array_sort("columns")).alias("columns"))
    )
    if registry is None:
        return found
    return found.join(registry.select("dataset_name", "schema_version"), ["dataset_name", "schema_version"], "left_anti")


def schema_drift(registry: DataFrame) -> DataFrame:
    """Datasets with several versions, and the columns not present in all."""
    per_column = (
        registry.select("dataset_name", "schema_version", F.explode("columns").alias("column_name"))
        .groupBy("dataset_name", "column_name")
        .agg(F.count(F.lit(1)).alias("in_versions"))
    )
    versions = registry.groupBy("dataset_name").agg(F.count(F.lit(1)).alias("versions")).filter("versions > 1")
    return (
        versions.join(per_column, "dataset_name")
        .groupBy("dataset_name", "versions")
        .agg(F.array_sort(F.collect_list(F.when(F.col("in_versions") < F.col("versions"), F.col("column_name"))))
             .alias("drifted_columns"))
    )


def schema_changes(registry: DataFrame) -> DataFrame:
    """(dataset_name, version, added, missing, seen_at): what each version of a
    dataset adds to, or lacks of, the columns of all versions before it.

    Versions are in order of arrival; the first one is what the others are held
    against. The first version that has a column is found once for each column,
    so the work grows with the versions, not with their square.
    """
    place = F.struct(F.col("registered_at").alias("at"), F.col("schema_version").alias("v"))
    numbered = registry.select("dataset_name", "schema_version", "registered_at", "columns", place.alias("place"))
    columns = (
        numbered.select("dataset_name", "place", F.explode("columns").alias("name"))
        .groupBy("dataset_name", "name")
        .agg(F.min("place").alias("first"))
        .groupBy("dataset_name")
        .agg(F.array_sort(F.collect_list(F.struct("name", "first"))).alias("known"), F.min("first").alias("base"))
    )
    added = F.transform(F.filter("known", lambda k: k["first"] == F.col("place")), lambda k: k["name"])
    held = F.transform(F.filter("known", lambda k: k["first"] < F.col("place")), lambda k: k["name"])
    return numbered.join(columns, "dataset_name").select(
        "dataset_name",
        F.col("schema_version").alias("version"),
        F.when(F.col("place") == F.col("base"), F.array().cast("array<string>")).otherwise(added).alias("added"),
        F.array_except(held, "columns").alias("missing"),
        F.col("registered_at").alias("seen_at"),
    )


def raw_columns_of(records: DataFrame) -> list[str]:
    """The data columns of a Bronze frame, without lineage and verdict."""
    skip = {*LINEAGE_COLUMNS, "reasons", "_bad", "_ingest_date", "_ingest_batch"}
    return [c for c in records.columns if c not in skip]
