"""Incremental ingestion of staffing files into Bronze."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.operators.control import append_registry, registry_rows
from wardflow.operators.quality import (
    dq_summary,
    new_schema_versions,
    quarantine_index,
    queue_of_batch,
    raw_columns_of,
    repeated_messages,
    split_valid,
)
from wardflow.operators.remediation import resolve_by_batch
from wardflow.schemas import TABLES
from wardflow.sources.landing import SURPLUS, file_lines, file_manifest, literal_path, new_files, read_by_header, readable_header
from wardflow.sources.tables import append_batch, overwrite_folder, overwrite_folders, read_batch, read_table, staged

BINARY_FILE_DDL = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """Identity of a checkpoint; a new checkpoint gets a new one."""
    return spark.read.schema("id STRING").json(f"{checkpoint}/metadata").first()[0]


def facility_of_path(path: str = "path"):
    """The folder a file lies in, which names the sending facility."""
    return F.element_at(F.split(path, "/"), -2)


def file_outcomes(manifest: DataFrame, judged: DataFrame, dataset: str, at) -> DataFrame:
    """One row per file with its counts; a file without rows counts zero."""
    counts = dq_summary(judged, ["_source_file"])
    joined = manifest.join(counts, F.col("path") == F.col("_source_file"), "left")
    zero = F.lit(0).cast("bigint")
    return joined.select(
        "file_checksum",
        F.col("path").alias("source_file"),
        "columns",
        F.lit(dataset).alias("dataset_name"),
        at.alias("run_timestamp"),
        F.coalesce("total_records", zero).alias("total_records"),
        F.coalesce("valid_records", zero).alias("valid_records"),
        F.coalesce("quarantined", zero).alias("quarantined"),
        "pass_rate",
        F.coalesce("quality_status", F.lit("PASS")).alias("quality_status"),
        "error_summary",
    )


def _write_control(spark: SparkSession, outcomes: DataFrame, root: str, batch: str, at, bronze_path: str) -> None:
    """Schema versions, DQ results, audit and registry; the ledger last, so a
    batch that fails half-way is not taken for done."""
    usable = outcomes.filter(readable_header())
    headers = usable.select("dataset_name", "columns", F.col("run_timestamp").alias("seen_at"))
    known = read_table(spark, TABLES["schema_registry"], root)
    versions = new_schema_versions(headers, known).select(*TABLES["schema_registry"].struct.names)
    append_batch(versions, TABLES["schema_registry"].path(root), batch)
    results = outcomes.select(*TABLES["data_quality_results"].struct.names)
    append_batch(results, TABLES["data_quality_results"].path(root), batch)

    audit = outcomes.drop("columns").withColumns({"date": F.to_date("run_timestamp"), "batch": F.lit(batch)})
    overwrite_folders(audit, f"{root}/audit/ingestion", ["date", "batch"], "json")

    files = outcomes.select(
        "file_checksum",
        F.col("source_file").alias("source_path"),
        F.lit(bronze_path).alias("bronze_path"),
        facility_of_path("source_file").alias("hospital_id"),
        F.to_date("run_timestamp").alias("file_date"),
        F.col("total_records").alias("record_count"),
        F.col("quarantined").alias("quarantine_count"),
        F.lit(batch).alias("bronze_run_id"),
    )
    append_registry(registry_rows(files, at), root, batch)
    ledger = files.select(
        "file_checksum", "source_path", "bronze_path", "record_count", "quarantine_count", at.alias("recorded_at")
    )
    append_batch(ledger, TABLES["ingestion_ledger"].path(root), batch)


def ingest_files(spark: SparkSession, paths: list[str], root: str, dataset: str, batch: str, at_text: str) -> int:
    """Validate one batch of files and write every output under its batch id;
    returns the number of files taken in.

    Running it again with the same id replaces the same folders, so a retried
    micro-batch adds nothing twice.
    """
    at = F.lit(at_text).cast("timestamp")
    ledger = read_table(spark, TABLES["ingestion_ledger"], root)
    # The only pass over the landing files: headers, digests and rows come from it.
    with staged(spark, file_lines(spark, paths), "lines") as lines, staged(
        spark, new_files(file_manifest(spark, paths, lines), ledger), "manifest"
    ) as manifest:
        files = manifest.count()
        if not files:
            return 0
        known = readable_header()
        lineage = {"_ingested_at": at, "_record_index": F.expr("uuid()")}
        valid, bad = split_valid(read_by_header(lines, manifest.filter(known)).withColumns(lineage))
        # A file whose header cannot be used counts as one bad record, which
        # shows the header; the other files of the batch go on.
        unreadable = manifest.filter(~known).select(
            F.col("path").alias("_source_file"),
            F.to_json(F.struct("columns")).alias(SURPLUS),
            F.array(F.lit("HEADER_NOT_READABLE")).alias("reasons"),
        )
        # Each row is written once, to the side it belongs to, as its task lies;
        # nothing wide is sorted by its folder or kept a second time.
        valid = _write_valid(spark, valid.drop(SURPLUS), root, at_text[:10], batch)
        bad = bad.unionByName(unreadable.withColumns(lineage), allowMissingColumns=True)
        with staged(spark, bad, "bad") as bad:
            resolve_by_batch(spark, root, valid, at, batch)
            _write_quarantine(spark, bad, root, batch)
            none = F.array().cast("array<string>").alias("reasons")
            judged = valid.select("_source_file", none).unionByName(bad.select("_source_file", "reasons"))
            with staged(spark, file_outcomes(manifest, judged, dataset, at), "outcomes") as outcomes:
                _write_control(spark, outcomes, root, batch, at, TABLES["stg_staffing"].path(root))
    return files


def _write_valid(spark: SparkSession, valid: DataFrame, root: str, day: str, batch: str) -> DataFrame:
    """Valid rows to the batch's one folder of Bronze; returns them as stored."""
    folder = f"{TABLES['stg_staffing'].path(root)}/_ingest_date={day}/_ingest_batch={batch}"
    overwrite_folder(valid, folder)
    return spark.read.schema(valid.schema).parquet(folder)


def _write_quarantine(spark: SparkSession, bad: DataFrame, root: str, batch: str) -> None:
    """Bad rows to the quarantine index, and from there to the queue."""
    index, path = quarantine_index(bad, raw_columns_of(bad)), TABLES["quarantine_index"].path(root)
    append_batch(index, path, batch)
    written = read_batch(spark, path, batch, index.schema)
    with staged(spark, repeated_messages(written), "repeated") as repeated:
        overwrite_folder(queue_of_batch(written, repeated).drop("resolved"), f"{root}/quarantine/queue/_batch={batch}")


def ingest_bronze(
    spark: SparkSession,
    source: str,
    root: str,
    checkpoint: str,
    dataset: str = "sftp_staffing",
    max_files: int = 10000,
) -> int:
    """Ingest every file not seen before, then stop; returns how many there were.

    The stream delivers paths only (the file content is pruned from its scan),
    at most ``max_files`` per micro-batch; the batch time is fixed in the
    checkpoint and so equal on a retry.
    """

    def batch(paths: DataFrame, batch_id: int) -> None:
        rows = paths.collect()
        if rows:
            key = f"{stream_id(spark, checkpoint)}-{batch_id:08d}"
            taken.append(ingest_files(spark, [literal_path(r.path) for r in rows], root, dataset, key, rows[0].at))

    taken: list[int] = []
    files = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE_DDL)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.{csv,tsv,gz}")
        .option("maxFilesPerTrigger", max_files)
        .load(source)
        .select("path", F.current_timestamp().cast("string").alias("at"))
    )
    query = (
        files.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(taken)


def bronze_columns(spark: SparkSession, root: str) -> list[str]:
    """Every data column any ingested file has had, from the registry."""
    registry = read_table(spark, TABLES["schema_registry"], root)
    found = registry.select(F.explode("columns").alias("c")).distinct().orderBy("c")
    return [r.c for r in found.collect()]


def read_bronze(spark: SparkSession, root: str) -> DataFrame:
    """Bronze staffing with all columns seen so far; NULL where not sent."""
    return read_table(spark, TABLES["stg_staffing"], root, bronze_columns(spark, root))
