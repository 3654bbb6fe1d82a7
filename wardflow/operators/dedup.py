"""Latest-row selection, uniqueness checks and high-water marks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardflow.config import EPOCH


def latest_per_key(df: DataFrame, keys: list[str], newest_first: list[str | Column]) -> DataFrame:
    """The newest row of each key.

    ``row_number() = 1`` plans as a group limit on both sides of the shuffle:
    each task sends at most one row per key, so one key holding a third of the
    input costs one row per task downstream, not a third of the data.
    """
    order = [c if isinstance(c, Column) else F.col(c).desc() for c in newest_first]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def require_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` itself, after checking that no key repeats."""
    if not duplicate_keys(df, keys).isEmpty():
        raise ValueError(f"duplicate rows remain for key ({', '.join(keys)})")
    return df


def watermark(df: DataFrame, ts_column: str = "_ingested_at") -> DataFrame:
    """One row: the newest ``ts_column``, or the epoch for an empty table."""
    return df.agg(F.coalesce(F.max(ts_column), F.lit(EPOCH).cast("timestamp")).alias("watermark"))


def get_watermark(spark: SparkSession, table: str, ts_column: str = "_ingested_at") -> str:
    """The watermark of a table as text; the epoch when the table is absent."""
    if not spark.catalog.tableExists(table):
        return EPOCH
    mark = watermark(spark.table(table), ts_column).select(F.col("watermark").cast("string"))
    return mark.first()[0]


def newer_than(df: DataFrame, mark: str, ts_column: str = "_ingested_at") -> DataFrame:
    """Rows strictly after the mark; the filter reaches the parquet scan."""
    return df.filter(F.col(ts_column) > F.lit(mark).cast("timestamp"))
