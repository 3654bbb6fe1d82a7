"""Staffing files as they land: headers, checksums and header-safe reading."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardflow.config import STAFFING_COLUMNS
from wardflow.operators.dedup import latest_per_key
from wardflow.sources.tables import stage

# The modulus of the line sums; products of two residues fit a BIGINT.
PRIME = 2**31 - 1

SURPLUS = "_surplus"

DEFAULT_SCHEMA_HINTS = ", ".join(f"{c} STRING" for c in STAFFING_COLUMNS)


def get_schema_hints(spark: SparkSession, table: str, db: str) -> str:
    """``column STRING`` for every column of a catalog table, or the expected
    staffing columns when the catalog cannot answer."""
    try:
        columns = [c.name for c in spark.catalog.listColumns(f"`{db}`.`{table}`")]
    except Exception:
        return DEFAULT_SCHEMA_HINTS
    return ", ".join(f"{c} STRING" for c in columns) or DEFAULT_SCHEMA_HINTS


def literal_path(path: str) -> str:
    """A path as a reader takes it when no part of it is meant as a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def separator_of(path: Column) -> Column:
    """Tab for ``.tsv`` and ``.tsv.gz``, comma otherwise."""
    return F.when(F.lower(path).rlike(r"\.tsv(\.gz)?$"), F.lit("\t")).otherwise(F.lit(","))


def header_columns(line: Column, path: Column) -> Column:
    """Column names of a header line in lower case; quotes, blanks, CR and BOM removed."""
    clean = F.lower(F.regexp_replace(line, "[\r\ufeff\"]", ""))
    names = F.when(separator_of(path) == "\t", F.split(clean, "\t")).otherwise(F.split(clean, ","))
    return F.transform(names, lambda name: F.trim(name))


def readable_header(columns: str | Column = "columns") -> Column:
    """Whether rows can be put under these names: none is empty or comes twice."""
    names = F.col(columns) if isinstance(columns, str) else columns
    return (F.size(F.array_distinct(names)) == F.size(names)) & ~F.array_contains(names, "")


def _listing(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, length) of each file; the content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    return files.select(F.col("_metadata.file_path").alias("path"), "length")


def file_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The lines of the files, split over tasks; ``position`` counts within one."""
    lines = spark.read.option("recursiveFileLookup", "true").text(paths)
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("position"),
    )


def file_contents(lines: DataFrame) -> DataFrame:
    """(path, first, line_count, line_sums): the position of a file's first line,
    and what its lines and their order give.

    Each line has four residues of its hashes. A file's sums of them, and its
    sums of them times the line's number, are put together from sums by block,
    so the result is the same however the file is split over tasks, and any
    change of a line or of the order changes it. Positions grow within a task,
    and a file's first block is read by one task. All that is aggregated are
    numbers, so lines are hashed by file and never sorted.
    """
    halves = [F.xxhash64("value", F.lit(seed)) for seed in (1, 2)]
    residues = [F.pmod(F.shiftright(h, shift), F.lit(PRIME)) for h in halves for shift in (0, 32)]
    named = lines.select("path", "block_start", "position", *[r.alias(f"r{i}") for i, r in enumerate(residues)])
    plain = [F.sum(f"r{i}").alias(f"s{i}") for i in range(4)]
    # A residue times a position below 2 ** 33 would not fit.
    placed = [F.sum(F.pmod(F.col(f"r{i}") * F.pmod("position", F.lit(PRIME)), F.lit(PRIME))).alias(f"p{i}") for i in range(4)]
    blocks = named.groupBy("path", "block_start").agg(
        F.count(F.lit(1)).alias("n"), F.min("position").alias("top"), *plain, *placed
    )
    before = F.coalesce(
        F.sum("n").over(Window.partitionBy("path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    shift = F.pmod(before - F.col("top"), F.lit(PRIME))
    moved = [
        F.pmod(F.pmod(f"p{i}", F.lit(PRIME)) + F.pmod(f"s{i}", F.lit(PRIME)) * shift, F.lit(PRIME)).alias(f"p{i}") for i in range(4)
    ]
    sums = [F.pmod(F.sum(f"{kind}{i}"), F.lit(PRIME)) for kind in "sp" for i in range(4)]
    opening = F.when(F.col("block_start") == 0, F.col("top")).alias("top")
    return (
        blocks.select("path", "n", opening, *[F.pmod(f"s{i}", F.lit(PRIME)).alias(f"s{i}") for i in range(4)], *moved)
        .groupBy("path")
        .agg(F.max("top").alias("first"), F.sum("n").alias("line_count"), F.concat_ws("|", *sums).alias("line_sums"))
    )


def first_positions(lines: DataFrame) -> DataFrame:
    """(path, first) of each file."""
    return lines.filter("block_start = 0").groupBy("path").agg(F.min("position").alias("first"))


def with_first_lines(lines: DataFrame, files: DataFrame) -> DataFrame:
    """``files(path, first)``, those without lines left out, with the line that stands there.

    The files are written first: Spark then knows how few they are and sends
    them to the lines, which stay where they lie.
    """
    known = stage(lines.sparkSession, files, "files")
    opening = lines.filter("block_start = 0").select(F.col("path").alias("_path"), "position", F.col("value").alias("line"))
    return known.join(opening, (F.col("path") == F.col("_path")) & (F.col("first") == F.col("position"))).drop("_path", "position")


def _columns() -> Column:
    return header_columns(F.coalesce("line", F.lit("")), F.col("path")).alias("columns")


def file_headers(spark: SparkSession, paths: str | list[str], lines: DataFrame | None = None) -> DataFrame:
    """(path, length, columns, first) of each file that is not empty."""
    lines = file_lines(spark, paths) if lines is None else lines
    first = with_first_lines(lines, first_positions(lines))
    return _listing(spark, paths).join(first, "path", "left").select("path", "length", _columns(), "first")


def file_manifest(spark: SparkSession, paths: str | list[str], lines: DataFrame | None = None) -> DataFrame:
    """(path, length, file_checksum, columns, first) of each file.

    The checksum is one digest for files of every size: the MD5 of the length,
    the number of lines and the sums of :func:`file_contents`. Lines are read in
    parallel, so no task holds a large file; ``lines`` are those of
    :func:`file_lines`, where they were kept.
    """
    lines = file_lines(spark, paths) if lines is None else lines
    contents = with_first_lines(lines, file_contents(lines))
    found = _listing(spark, paths).join(contents, "path", "left")
    content = F.concat_ws("|", F.col("length"), F.coalesce("line_count", F.lit(0)), F.coalesce("line_sums", F.lit("")))
    return found.select("path", "length", F.md5(content.cast("binary")).alias("file_checksum"), _columns(), "first")


def new_files(manifest: DataFrame, ledger: DataFrame) -> DataFrame:
    """One file per content not in the ledger; copies within the batch fall
    to the first path."""
    first = latest_per_key(manifest, ["file_checksum"], [F.col("path").asc()])
    return first.join(ledger.select("file_checksum"), "file_checksum", "left_anti")


def line_cells(value: Column, separator: str, most: int) -> Column:
    """The cells of a line as they stand in it; of a line with a quote, as a CSV parser reads them.

    Only a line with a quote needs one; its first ``most`` cells count.
    """
    names = [f"c{i}" for i in range(most)]
    parsed = F.from_csv(value, ", ".join(f"{n} STRING" for n in names), {"sep": separator})
    return F.when(~F.contains(value, F.lit('"')), F.split(value, separator)).otherwise(F.array(*[parsed[n] for n in names]))


def read_by_header(lines: DataFrame, headers: DataFrame) -> DataFrame:
    """The rows of all files of ``headers(path, columns, first)`` as one all-text frame.

    Headers are data: every line meets its file's header, and a column's cell is
    looked up by the place that the header gives it. So there is one scan of
    ``lines`` however many layouts there are; reordered headers stay right and a
    column that a file lacks is NULL there. The driver sees the distinct column
    names. A cell beyond the header, or the line if there are several, is the
    row's surplus.
    """
    known = headers.agg(F.coalesce(F.array_sort(F.array_distinct(F.flatten(F.collect_set("columns")))), F.array()).alias("names"), F.max(F.size("columns")).alias("widest")).first()
    names = [*STAFFING_COLUMNS, *[n for n in known.names if n not in STAFFING_COLUMNS]]
    places = F.transform(F.array(*[F.lit(n) for n in names]), lambda n: (F.array_position("columns", n) - 1).cast("int"))
    layout = headers.select(F.col("path").alias("_source_file"), "first", F.size("columns").alias("width"), places.alias("places"), separator_of(F.col("path")).alias("sep"))
    rows = lines.withColumnRenamed("path", "_source_file").join(layout, "_source_file")
    # Neither the header nor a blank line is a record.
    records = rows.filter(~((F.col("block_start") == 0) & (F.col("position") == F.col("first"))) & F.col("value").rlike("[^\\x00-\\x20]"))
    most = (known.widest or 0) + 2
    cells = F.when(F.col("sep") == "\t", line_cells(F.col("value"), "\t", most)).otherwise(line_cells(F.col("value"), ",", most))
    cut = records.withColumn("cells", cells)
    beyond = F.slice("cells", F.col("width") + 1, F.greatest(F.size("cells") - F.col("width"), F.lit(0)))
    quoted = F.contains("value", F.lit('"'))
    several = F.when(quoted, F.exists(F.slice(beyond, 2, F.lit(most)), lambda c: c.isNotNull())).otherwise(F.size(beyond) > 1)

    def filled(cell: Column) -> Column:
        # Empty is null, looked at where a cell is taken: a lambda over all of them is not compiled.
        return F.when(quoted | (cell != ""), cell)

    surplus = F.when(several, F.col("value")).otherwise(filled(F.get(beyond, F.lit(0))))
    found = [F.when(F.get("places", F.lit(i)) >= 0, filled(F.get("cells", F.get("places", F.lit(i))))).alias(n) for i, n in enumerate(names)]
    return cut.select(*found, "_source_file", surplus.alias(SURPLUS))


def read_landing(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Every ``.csv``, ``.tsv`` and gzipped file below ``paths``, all text.

    Files whose header names a column twice or not at all are left out;
    ingestion lists them.
    """
    # Kept, as several steps look at them: a packed file is unpacked once, by one task.
    lines = stage(spark, file_lines(spark, paths), "lines")
    headers = stage(spark, file_headers(spark, paths, lines).filter(readable_header()), "headers")
    return read_by_header(lines, headers).drop(SURPLUS)
