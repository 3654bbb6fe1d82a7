"""Slowly changing facility dimension: versions, expiry and audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.config import TRACKED_ATTRIBUTES
from wardflow.operators.dedup import require_unique

DIM_COLUMNS = ["facility_key", "facility_id", *TRACKED_ATTRIBUTES, "is_current", "effective_from", "effective_to"]


def known_facilities(*frames: DataFrame) -> DataFrame:
    """Distinct facility ids over all frames (batch Silver, event Silver).

    Each frame is reduced to its distinct ids before the union.
    """
    ids = [f.select("facility_id").filter(F.col("facility_id").isNotNull()).distinct() for f in frames]
    out = ids[0]
    for other in ids[1:]:
        out = out.unionByName(other)
    return out.distinct() if len(ids) > 1 else out


def facility_source(ids: DataFrame, attributes: DataFrame) -> DataFrame:
    """Every known facility, with attributes where an attribute row exists.

    Rows without an id name no facility and are left out; equal rows count
    once, and two that contradict each other are refused.
    """
    attributes = attributes.select("facility_id", *TRACKED_ATTRIBUTES).filter("facility_id is not null").distinct()
    require_unique(attributes, ["facility_id"])
    return ids.filter("facility_id is not null").join(attributes.select("facility_id", *TRACKED_ATTRIBUTES), "facility_id", "full_outer")


def facility_key(facility_id: str | Column = "facility_id", effective_from: str | Column = "effective_from") -> Column:
    """Surrogate key: a hash, so no task has to hand out numbers."""
    return F.xxhash64(facility_id, effective_from)


def first_load(source: DataFrame, run_date: str) -> DataFrame:
    """Every facility as a current version starting at ``run_date``."""
    return (
        source.select("facility_id", *TRACKED_ATTRIBUTES)
        .withColumns(
            {
                "is_current": F.lit(True),
                "effective_from": F.lit(run_date).cast("date"),
                "effective_to": F.lit(None).cast("date"),
            }
        )
        .withColumn("facility_key", facility_key())
        .select(*DIM_COLUMNS)
    )


def unseen_facilities(source: DataFrame, dim: DataFrame) -> DataFrame:
    """Source facilities that the dimension has never held."""
    return source.join(dim.select("facility_id"), "facility_id", "left_anti")


def _changed(old: str, new: str) -> Column:
    """Any tracked attribute given anew and different; NULL means no news."""
    tests = [
        F.col(f"{new}.{a}").isNotNull() & ~F.col(f"{new}.{a}").eqNullSafe(F.col(f"{old}.{a}"))
        for a in TRACKED_ATTRIBUTES
    ]
    out = tests[0]
    for test in tests[1:]:
        out = out | test
    return out


def changed_facilities(source: DataFrame, dim: DataFrame) -> DataFrame:
    """Current facilities whose tracked attributes differ, old beside new."""
    current = dim.filter("is_current")
    return (
        current.alias("d")
        .join(source.alias("s"), F.col("d.facility_id") == F.col("s.facility_id"))
        .filter(_changed("d", "s"))
        .select(
            "d.facility_id",
            *[F.col(f"d.{a}").alias(f"old_{a}") for a in TRACKED_ATTRIBUTES],
            *[F.coalesce(f"s.{a}", f"d.{a}").alias(f"new_{a}") for a in TRACKED_ATTRIBUTES],
        )
    )


def apply_changes(dim: DataFrame, source: DataFrame, run_date: str) -> DataFrame:
    """The dimension after a run: history, expired, renewed and new versions.

    One outer join of current rows to the source settles all cases; each match
    expands to the one or two versions it yields. A second run on the same
    source finds no difference and changes nothing. A version opened on the
    run date itself is replaced, since it was current for no whole day: every
    facility has one version a day, and its key is unique.
    """
    today = F.lit(run_date).cast("date")
    none = F.lit(None).cast("date")
    history = dim.filter(~F.col("is_current")).select(*DIM_COLUMNS)
    pair = (
        dim.filter("is_current")
        .alias("d")
        .join(source.alias("s"), F.col("d.facility_id") == F.col("s.facility_id"), "full_outer")
    )
    seen = F.col("d.facility_id").isNotNull()
    differs = seen & F.coalesce(_changed("d", "s"), F.lit(False))
    replaced = differs & (F.col("d.effective_from") == today)
    changed = differs & ~replaced
    tracked = [
        F.when(replaced, F.coalesce(f"s.{a}", f"d.{a}")).otherwise(F.col(f"d.{a}")).alias(a) for a in TRACKED_ATTRIBUTES
    ]
    renewed = [F.coalesce(f"s.{a}", f"d.{a}").alias(a) for a in TRACKED_ATTRIBUTES]
    old_version = F.when(
        seen,
        F.struct(
            F.col("d.facility_key").alias("facility_key"),
            F.col("d.facility_id").alias("facility_id"),
            *tracked,
            (~changed).alias("is_current"),
            F.col("d.effective_from").alias("effective_from"),
            F.when(changed, today).otherwise(none).alias("effective_to"),
        ),
    )
    new_id = F.coalesce("d.facility_id", "s.facility_id")
    new_version = F.when(
        changed | ~seen,
        F.struct(
            facility_key(new_id, today).alias("facility_key"),
            new_id.alias("facility_id"),
            *renewed,
            F.lit(True).alias("is_current"),
            today.alias("effective_from"),
            none.alias("effective_to"),
        ),
    )
    versions = pair.select(F.inline(F.array_compact(F.array(old_version, new_version))))
    return history.unionByName(versions)


def audit_rows(source: DataFrame, dim: DataFrame, run_date: str) -> DataFrame:
    """One row per changed facility with the old and new values as maps."""

    def values(prefix: str) -> Column:
        cells = [x for a in TRACKED_ATTRIBUTES for x in (F.lit(a), F.col(f"{prefix}_{a}").cast("string"))]
        return F.create_map(*cells)

    return changed_facilities(source, dim).select(
        "facility_id",
        F.lit(run_date).cast("date").alias("changed_on"),
        values("old").alias("old_values"),
        values("new").alias("new_values"),
    )
