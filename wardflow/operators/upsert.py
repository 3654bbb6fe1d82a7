"""Upserts without a transactional table format.

A key of every partitioned table contains its partition column, or the day whose
month its folders are named by, so a row never moves between folders: an upsert
rewrites only the folders its batch touches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardflow.functions.staffing import all_of
from wardflow.operators.dedup import require_unique
from wardflow.schemas import MONTH, Table
from wardflow.sources.tables import (
    drop_folder,
    in_folders,
    overwrite_folders,
    path_exists,
    read_snapshot,
    read_stored,
    snapshot_folder,
    staged,
    write_snapshot,
    write_table,
)


def merge_rows(target: DataFrame, batch: DataFrame, keys: list[str], cleared: DataFrame | None = None) -> DataFrame:
    """``target`` with the rows of ``batch`` replacing or joining its own, and
    without the rows whose keys are in ``cleared``.

    Only batch keys meet the target (NULL keys match), so target rows are not
    shuffled when the batch keys are small enough for Spark to broadcast.
    """
    leaving = batch.select(*keys) if cleared is None else batch.select(*keys).union(cleared.select(*keys))
    renamed = leaving.select(*[F.col(k).alias(f"_batch_{k}") for k in keys])
    same = all_of([F.col(k).eqNullSafe(F.col(f"_batch_{k}")) for k in keys])
    return target.join(renamed, same, "left_anti").unionByName(batch, allowMissingColumns=True)


def touched_slice(target: DataFrame, batch: DataFrame, column: str) -> DataFrame:
    """Rows of ``target`` in partitions the batch touches.

    The partitions are named in the scan filter, whatever their number: they
    are days or months, so the calendar bounds them, and the scan opens no
    other folder.
    """
    named = [r[0] for r in batch.select(column).distinct().collect()]
    values = [v for v in named if v is not None]
    hit = F.col(column).isin(values) if values else F.lit(False)
    return target.filter(hit | F.col(column).isNull()) if None in named else target.filter(hit)


def with_folder(rows: DataFrame, table: Table) -> DataFrame:
    """``rows``, which hold the table's day, with the column its folders are named by."""
    return rows.withColumn(MONTH, table.month()) if table.day else rows


def touched_folders(spark: SparkSession, table: Table, root: str, batch: DataFrame) -> DataFrame:
    """Rows of the folders that a batch touches, whole."""
    return touched_slice(read_stored(spark, table, root), with_folder(batch, table), table.folders[0])


def touched_days(spark: SparkSession, table: Table, root: str, batch: DataFrame) -> DataFrame:
    """Rows of the days that a batch touches; in their folders, other days are skipped."""
    rows = touched_folders(spark, table, root, batch)
    return (touched_slice(rows, batch, table.day) if table.day else rows).select(*table.struct.names)


def newer_than_stored(batch: DataFrame, target: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows of ``batch`` that no stored row of their key comes after.

    A batch that arrives out of order must not put older rows in place of newer.
    """
    held = target.select(*[F.col(k).alias(f"_held_{k}") for k in keys], F.struct(*order).alias("_held_order"))
    same = all_of([F.col(k).eqNullSafe(F.col(f"_held_{k}")) for k in keys])
    return batch.join(held, same & (F.col("_held_order") > F.struct(*order)), "left_anti")


def upsert_table(
    spark: SparkSession,
    table: Table,
    root: str,
    batch: DataFrame,
    cleared: DataFrame | None = None,
    newest_by: list[str] | None = None,
) -> None:
    """Merge ``batch`` (unique on the table's key) into a stored table.

    The batch is staged as a written table first: it is used several times,
    and a lost executor must not make the uses differ. Running the same batch
    again leaves the same table, which is also the way to finish an upsert
    that failed between partition commits. ``cleared`` holds keys whose rows
    leave the table. With ``newest_by`` a batch row gives way to a stored row
    of its key that is newer by these columns.
    """
    path = table.path(root)
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in table.struct]
    with staged(spark, batch) as rows:
        require_unique(rows, table.keys)
        if not table.folders:
            target = read_snapshot(spark, table, root)
            kept = rows if newest_by is None else newer_than_stored(rows, target, table.keys, newest_by)
            write_snapshot(spark, merge_rows(target, kept, table.keys, cleared).select(*columns), path)
            return
        if not path_exists(spark, path):
            write_table(rows.select(*columns), table, root)
            return
        day, folder = table.day or table.folders[0], table.folders[0]
        touched = rows.select(day) if cleared is None else rows.select(day).union(cleared.select(day))
        target = touched_folders(spark, table, root, touched)
        kept = rows if newest_by is None else newer_than_stored(rows, target, table.keys, newest_by)
        with staged(spark, merge_rows(target, kept, table.keys, cleared).select(*columns), "merged") as merged:
            write_table(merged, table, root)
            if cleared is not None:
                # A folder that lost its last row has nothing to overwrite it with.
                gone, left = ({r[0] for r in with_folder(x, table).select(folder).distinct().collect()} for x in (cleared, merged))
                for value in gone - left:
                    drop_folder(spark, f"{path}/{folder}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}")


def merge_into_version(spark: SparkSession, table: Table, root: str, batch: DataFrame) -> None:
    """Merge ``batch`` into the current version of a table that :func:`write_snapshot` wrote.

    Only the folders the batch touches are read and replaced.
    """
    folder = snapshot_folder(spark, table.path(root))
    stored = spark.read.schema(StructType.fromDDL(table.stored_ddl)).parquet(folder)
    with staged(spark, batch.select(*table.struct.names), "batch") as rows:
        require_unique(rows, table.keys)
        target = touched_slice(stored, with_folder(rows, table), table.folders[0]).select(*table.struct.names)
        with staged(spark, merge_rows(target, rows, table.keys), "merged") as merged:
            overwrite_folders(in_folders(merged, table), folder, table.folders)
