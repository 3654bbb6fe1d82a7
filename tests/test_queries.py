"""Every registered query against its oracle on the smallest tables."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from check import connect, difference
from wardflow.plans import queries as plans
from wardflow.plans.queries import QUERIES, raw
from wardflow.schemas import TABLES

SF = "/root/testdata/sf0.001"

@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    assert difference(spark, duck, SF, name) is None


def test_oracles_belong_to_queries():
    assert oracle_sql().keys() <= queries().keys()
    assert QUERIES.keys() <= oracle_sql().keys()


def test_entry(spark):
    assert entry(spark).count() > 0


def test_late_batch_takes_rows_of_other_months(spark, tmp_path):
    folder, con = str(tmp_path), connect(SF)
    for (table,) in con.execute("select view_name from duckdb_views() where not internal").fetchall():
        keep = "where o_orderdate between date '1998-07-08' and date '1998-07-16'" if table == "orders" else ""
        con.execute(f"copy (select * from {table} {keep}) to '{folder}/{table}.parquet' (format parquet)")
    months = {r.m for r in raw(spark, folder).select(F.month("_ingested_at").alias("m")).distinct().collect()}
    assert 7 in months and difference(spark, connect(folder), folder, "late_batch_silver") is None


def test_a_batch_of_one_day_is_split_over_tasks(spark, tmp_path):
    rows = spark.range(200_000).select(F.uuid().alias("facility_id"), F.lit("1997-06-01").cast("timestamp").alias("_ingested_at"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        plans._bronze_batch(spark, str(tmp_path), rows, "b-1")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    stored = spark.read.parquet(TABLES["stg_staffing"].path(str(tmp_path)))
    assert stored.count() == 200_000 and len(stored.inputFiles()) > 2
