"""Event streams: envelopes to Bronze, Bronze to Silver, Silver to census."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wardflow.functions.adt import ENVELOPE_DDL, bronze_events, decode_payload, parse_payload, standardize_events
from wardflow.functions.staffing import all_of, validation_reasons
from wardflow.operators.census import census_from, closing_balances, later_hours, opening_balances, touched_hours, touched_units
from wardflow.operators.dedup import latest_per_key
from wardflow.operators.quality import quarantine_index
from wardflow.operators.upsert import touched_slice, upsert_table
from wardflow.schemas import TABLES
from wardflow.sources.tables import (
    append_batch,
    overwrite_folders,
    partition_values,
    path_exists,
    read_days,
    read_table,
    require_rows,
    staged,
)
from wardflow.streaming.ingest import stream_id


def file_envelopes(spark: SparkSession, source: str, max_files: int = 1000) -> DataFrame:
    """Envelope stream from JSON-lines files, oldest first."""
    return spark.readStream.schema(ENVELOPE_DDL).option("maxFilesPerTrigger", max_files).json(source)


def kafka_envelopes(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Envelope stream from a Kafka topic, from its beginning on first run.

    Needs Spark's own Kafka package on the class path.
    """
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .load()
    )
    return envelope_of_kafka(raw)


def envelope_of_kafka(raw: DataFrame) -> DataFrame:
    """Kafka record columns under the envelope's names."""
    return raw.select(
        F.concat_ws("-", "topic", "partition").alias("partitionKey"),
        F.col("offset").cast("string").alias("sequenceNumber"),
        F.col("timestamp").alias("approximateArrivalTimestamp"),
        F.col("value").cast("string").alias("data"),
    )


def append_available(df: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None) -> StreamingQuery:
    """Append all input available now to Parquet files, then stop."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.option("path", path).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def input_rows(query: StreamingQuery) -> int:
    """Rows a finished query took in, as its micro-batches reported them."""
    return sum(p["numInputRows"] for p in query.recentProgress)


def run_bronze_events(envelopes: DataFrame, root: str, checkpoint: str) -> int:
    """Decode envelopes into Bronze events; returns the number of envelopes."""
    return input_rows(append_available(bronze_events(envelopes), TABLES["adt_events_raw"].path(root), checkpoint))


def run_silver_events(spark: SparkSession, root: str, checkpoint: str, drop_replays: bool = False) -> int:
    """Standardise Bronze events into Silver, reading Bronze as a stream; returns
    the number of Bronze events taken in.

    With ``drop_replays`` an event that Silver already holds is dropped on the
    way, however long ago it came: each micro-batch is compared with Silver in
    the days it touches, undated events with the undated ones. An event arrives
    late or undated for the first time as any other. A table is written in one
    of the two ways for good, since only the plain one keeps a sink log.
    """
    bronze = TABLES["adt_events_raw"]
    silver = TABLES["adt_events_standardized"]
    require_rows(read_table(spark, bronze, root), "NO_BRONZE_DATA")
    target = silver.path(root)
    logged = path_exists(spark, f"{target}/_spark_metadata")
    if path_exists(spark, target) and logged == drop_replays:
        raise ValueError(f"{target} was begun with drop_replays={not drop_replays}")
    events = standardize_events(spark.readStream.schema(bronze.struct).parquet(bronze.path(root)))
    if not drop_replays:
        return input_rows(append_available(events, target, checkpoint, silver.partition_by))

    def batch(df: DataFrame, _: int) -> None:
        once = latest_per_key(df, ["event_id"], [F.col("_kinesis_timestamp").asc(), F.col("_kinesis_sequence").asc()])
        with staged(spark, once.select(*silver.struct.names), "events") as rows:
            held = touched_slice(read_table(spark, silver, root), rows, "event_date").select("event_id")
            # A retry after a commit finds its own events held and adds nothing.
            with staged(spark, rows.join(held, "event_id", "left_anti"), "fresh") as fresh:
                fresh.hint("rebalance", "event_date").write.mode("append").partitionBy("event_date").parquet(target)

    query = (
        events.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return input_rows(query)


def run_validated_events(spark: SparkSession, envelopes: DataFrame, root: str, checkpoint: str) -> None:
    """Validate events and fan them out: valid records as JSON by date, bad
    ones to quarantine, one audit line per batch and facility.

    Outputs carry the batch id in their folder; a retried batch replaces its
    own folders. An envelope that does not decode counts as bad.
    """

    def batch(df: DataFrame, batch_id: int) -> None:
        key = f"{stream_id(spark, checkpoint)}-{batch_id:08d}"
        with staged(spark, judge_events(df), "events") as judged:
            day = F.to_date("_ingested_at").alias("date")
            valid = judged.filter(F.size("reasons") == 0).select("event.*", day, F.lit(key).alias("batch"))
            overwrite_folders(valid, f"{root}/bronze/realtime_json", ["date", "batch"], "json")
            bad = judged.filter(F.size("reasons") > 0).select(
                "raw", "reasons", "_source_file", "_ingested_at", "event.facility_id"
            )
            append_batch(quarantine_index(bad, ["raw"]), TABLES["quarantine_index"].path(root), key)
            audit = judged.groupBy(day, F.col("event.facility_id").alias("facility_id")).agg(
                F.count(F.lit(1)).alias("total_records"),
                F.count_if(F.size("reasons") > 0).alias("quarantined"),
            )
            overwrite_folders(
                audit.withColumn("batch", F.lit(key)), f"{root}/audit/realtime", ["date", "batch"], "json"
            )

    query = (
        envelopes.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def judge_events(envelopes: DataFrame) -> DataFrame:
    """Envelopes with the parsed event and the rules it breaks."""
    text = decode_payload("data")
    parsed = envelopes.select(
        F.coalesce(text, "data").alias("raw"),
        parse_payload(text).alias("event"),
        F.col("partitionKey").alias("_source_file"),
        F.col("approximateArrivalTimestamp").alias("_ingested_at"),
    )
    judged = parsed.withColumn("facility_id", F.col("event.facility_id"))
    unreadable = F.when(F.col("event.event_type").isNull(), F.array(F.lit("EVENT_NOT_READABLE")))
    return judged.withColumn("reasons", F.coalesce(unreadable, validation_reasons(["facility_id"]))).drop("facility_id")


def stored_days(spark: SparkSession, path: str) -> list[date]:
    """The days a table stored by ``event_date`` has folders of."""
    return [date.fromisoformat(d) for d in partition_values(spark, path, "event_date") if d[:1].isdigit()]


def openings_of(spark: SparkSession, root: str, units: DataFrame) -> DataFrame:
    """Balances before the units' earliest touched days.

    First the month of the earliest day and the one before are read; only for
    units without an event there, such as new ones, the months before.
    """
    table = TABLES["census_balance"]
    bounds = units.agg(F.min("from_day"), F.max("from_day")).first()
    start = (bounds[0].replace(day=1) - timedelta(days=1)).replace(day=1)
    near = opening_balances(read_days(spark, table, root, str(start), str(bounds[1])), units)
    key = ["t_facility_id", "t_unit_id"]
    without = units.join(near.select(*[F.col(c).alias(f"n_{c}") for c in key]), all_of([F.col(c).eqNullSafe(F.col(f"n_{c}")) for c in key]), "left_anti")
    far = opening_balances(read_days(spark, table, root, "0001-01-01", str(start - timedelta(days=1))), without)
    return near.unionByName(far)


def held_after(spark: SparkSession, root: str, day: date) -> DataFrame:
    """Census rows of the stored days after ``day``; their folders alone are read."""
    fact = TABLES["fact_census_realtime"]
    later = [d for d in stored_days(spark, fact.path(root)) if d > day]
    return read_table(spark, fact, root).filter(F.col("event_date").isin(later) if later else F.lit(False))


def update_census(spark: SparkSession, batch: DataFrame, root: str) -> None:
    """Bring the census fact and its closing balances up to date with a batch of Silver events.

    Silver is read in the days the batch has events of, the fact only in later
    days that are stored. A late event moves every later hour of its unit, so
    those are formed anew from their own admits and discharges, and rows whose
    census stays are not rewritten. Nothing is added to a stored census: running
    a batch again, whole or after it broke off between two folders, gives the
    same rows. The balances are written last and only from the earliest touched
    day on, so the opening ones are those before the batch.
    """
    fact, silver = TABLES["fact_census_realtime"], TABLES["adt_events_standardized"]
    days = [r[0] for r in batch.select("event_date").filter("event_date is not null").distinct().collect()]
    if not days:
        return
    touched = read_table(spark, silver, root).filter(F.col("event_date").isin(days))
    held = held_after(spark, root, min(days))
    with staged(spark, touched_units(batch), "units") as units, staged(spark, touched_hours(batch, touched), "hours") as fresh:
        hours = fresh.withColumn("held", F.lit(None).cast("bigint")).unionByName(later_hours(held, units, fresh))
        with staged(spark, census_from(hours, openings_of(spark, root, units)), "census") as rows:
            moved = rows.filter(~F.col("census").eqNullSafe(F.col("held"))).drop("held")
            upsert_table(spark, fact, root, moved)
            upsert_table(spark, TABLES["census_balance"], root, closing_balances(rows))


def run_census_stream(spark: SparkSession, root: str, checkpoint: str) -> int:
    """Hourly census kept current from the Silver event stream; returns the
    number of events taken in.

    Each micro-batch upserts the hours it changes, so the newest hours are
    never held back the way an append-mode window would.
    """
    silver = TABLES["adt_events_standardized"]
    events = spark.readStream.schema(silver.struct).parquet(silver.path(root))

    def batch(df: DataFrame, _: int) -> None:
        with staged(spark, df, "events") as rows:
            update_census(spark, rows, root)

    query = (
        events.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return input_rows(query)
