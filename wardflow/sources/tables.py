"""Stored tables: reading, partitioned writes, snapshots, staging, guards."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StructType

from wardflow.schemas import MONTH, Table


# Rows written to be read again are packed closely: hashes and ids, which the
# default leaves as they are, take half the bytes.
PACKED = "zstd"


class NothingToDo(Exception):
    """A job found no input; ``code`` says which kind."""

    def __init__(self, code: str):
        super().__init__(code)
        self.code = code


def require_rows(df: DataFrame, code: str) -> DataFrame:
    """``df`` itself, or :class:`NothingToDo` when it holds no row."""
    if df.isEmpty():
        raise NothingToDo(code)
    return df


def work_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the session's checkpoint folder.

    Only a local session without one gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="wardflow-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return f"{work_root(spark)}/wardflow/{label}-{uuid.uuid4().hex}"


def stage(spark: SparkSession, df: DataFrame, label: str = "stage") -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Used where a result feeds several outputs: it is computed once, its
    lineage ends here, and it survives the loss of any executor.
    """
    path = scratch_path(spark, label)
    df.write.option("compression", PACKED).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staged(spark: SparkSession, df: DataFrame, label: str = "stage") -> Iterator[DataFrame]:
    """:func:`stage` for the length of a block; the folder goes with it."""
    path = scratch_path(spark, label)
    try:
        df.write.option("compression", PACKED).parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        drop_folder(spark, path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, without listing what lies below it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def read_table(
    spark: SparkSession,
    table: Table,
    root: str,
    extra_columns: list[str] | None = None,
) -> DataFrame:
    """A stored table under its declared schema; empty when never written.

    The declared schema spares the footer inference over all files, and gives
    NULL for columns that older files lack. ``extra_columns`` are text columns
    that arrived later.
    """
    schema = table.struct
    for column in extra_columns or []:
        if column not in schema.names:
            schema = schema.add(column, "string")
    return read_stored(spark, table, root, schema).select(*schema.names)


def read_stored(spark: SparkSession, table: Table, root: str, schema: StructType | None = None) -> DataFrame:
    """A stored table with its folder column."""
    path = table.path(root)
    stored = StructType(list((schema or table.struct).fields))
    if table.day:
        stored = stored.add(MONTH, IntegerType())
    if not path_exists(spark, path):
        return spark.createDataFrame([], stored)
    if path_exists(spark, f"{path}/{FOLDS}"):
        return _read_folded(spark, path, stored)
    return spark.read.schema(stored).parquet(path)


# Folders of a compacted log; names that begin so are no data to other readers.
FOLDS, GENERATIONS = "_folds", "_generations"
FOLD_DDL = "number BIGINT, generation STRING, folded ARRAY<STRING>"


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The data files below a folder, hidden folders left out."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    found, files = target.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(target, True), []
    while found.hasNext():
        file = found.next().getPath().toString()
        if not any(part.startswith(("_", ".")) for part in file[file.index(path) + len(path) :].split("/")):
            files.append(file)
    return sorted(files)


def _last_fold(spark: SparkSession, path: str):
    folds = spark.read.schema(FOLD_DDL).json(f"{path}/{FOLDS}") if path_exists(spark, f"{path}/{FOLDS}") else None
    return folds.orderBy(F.desc("number")).first() if folds is not None else None


def _read_folded(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The last generation and the files that came after it."""
    fold = _last_fold(spark, path)
    rows = spark.read.schema(schema).parquet(f"{path}/{GENERATIONS}/{fold.generation}")
    later = sorted(set(data_files(spark, path)) - set(fold.folded))
    if not later:
        return rows
    return rows.unionByName(spark.read.schema(schema).option("basePath", path).parquet(*later).select(*schema.names))


def compact_log(spark: SparkSession, table: Table, root: str, order: list[str], kept: Column | None = None) -> int:
    """Fold the files of an append-only table into one sorted generation; returns how many there were.

    With ``kept`` only rows it holds for are taken over.

    The rows go to a folder that nobody reads yet. One written line then names
    it and the files it stands for, and from that moment readers take it in
    their place. The files themselves go with the next fold, so a reader that
    began before has until then to finish. A fold that breaks off before its
    line changes nothing; after it, what it left behind goes with the next one.
    """
    path = table.path(root)
    if not path_exists(spark, path):
        return 0
    before, files, generation = _last_fold(spark, path), data_files(spark, path), uuid.uuid4().hex
    fresh = sorted(set(files) - set(before.folded)) if before else files
    rows = read_stored(spark, table, root)
    if not fresh and (kept is None or rows.filter(~kept).isEmpty()):
        return 0
    if kept is not None:
        rows = rows.filter(kept)
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows.write.partitionBy(*table.folders).parquet(f"{path}/{GENERATIONS}/{generation}")
    line = spark.createDataFrame([((before.number if before else 0) + 1, generation, files)], FOLD_DDL)
    line.coalesce(1).write.mode("append").json(f"{path}/{FOLDS}")
    if before:
        for file in before.folded:
            drop_folder(spark, file)
    for name in _other_generations(spark, path, {generation, before.generation if before else ""}):
        drop_folder(spark, f"{path}/{GENERATIONS}/{name}")
    return len(fresh)


def _other_generations(spark: SparkSession, path: str, kept: set[str]) -> list[str]:
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{GENERATIONS}")
    names = [f.getPath().getName() for f in target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)]
    return [n for n in names if n not in kept]


def read_days(spark: SparkSession, table: Table, root: str, first: str, last: str) -> DataFrame:
    """Rows of a table stored by month from the day ``first`` to ``last`` (yyyy-mm-dd).

    Only the folders of these months are listed and read, and in their files
    only the parts that hold these days.
    """
    rows = read_stored(spark, table, root)
    kind = table.struct[table.day].dataType
    low, high = (d if isinstance(kind, DateType) else int(d.replace("-", "")) for d in (first, last))
    months = F.col(MONTH).between(*(int(d[:4] + d[5:7]) for d in (first, last)))
    return rows.filter(months & F.col(table.day).between(F.lit(low).cast(kind), F.lit(high).cast(kind))).select(*table.struct.names)


def in_folders(df: DataFrame, table: Table) -> DataFrame:
    """``df`` as ``table`` stores it: folder column added, a folder's rows gathered in order.

    The rebalance hint gathers rows into files of the advisory size: small
    folders get one file, and a large one is split over tasks, by whole days
    where folders are months.
    """
    if not table.day:
        return df.hint("rebalance", *table.folders)
    return df.withColumn(MONTH, table.month()).hint("rebalance", MONTH, table.day).sortWithinPartitions(MONTH, table.day)


def write_table(df: DataFrame, table: Table, root: str) -> None:
    """Replace exactly the folders that ``df`` has rows in."""
    overwrite_folders(in_folders(df, table), table.path(root), table.folders)


def write_snapshot(spark: SparkSession, df: DataFrame, path: str, table: Table | None = None, keep: int = 3) -> str:
    """Full replacement, new schema allowed, while readers keep the old one.

    The rows go to a new version folder, laid out as ``table`` is; one appended line then names it as
    the current version. Of the versions named so, the last ``keep`` stay, so a
    reader has that many replacements to finish in. Returns the folder.
    """
    version = uuid.uuid4().hex
    folder = f"{path}/version={version}"
    if table is not None and table.folders:
        in_folders(df, table).write.partitionBy(*table.folders).parquet(folder)
    else:
        df.hint("rebalance").write.parquet(folder)
    number = 1
    if path_exists(spark, f"{path}.versions"):
        number += spark.read.schema("number BIGINT, version STRING").json(f"{path}.versions").agg(F.max("number")).first()[0]
    pointer = spark.range(1).select(F.lit(number).cast("bigint").alias("number"), F.lit(version).alias("version"))
    pointer.write.mode("append").json(f"{path}.versions")
    pointers = spark.read.schema("number BIGINT, version STRING").json(f"{path}.versions")
    for row in pointers.filter(F.col("number") <= number - keep).collect():
        drop_folder(spark, f"{path}/version={row.version}")
    return folder


def snapshot_folder(spark: SparkSession, path: str) -> str | None:
    """Folder of the current version, or None before the first write."""
    if not path_exists(spark, f"{path}.versions"):
        return None
    pointers = spark.read.schema("number BIGINT, version STRING").json(f"{path}.versions")
    version = pointers.agg(F.max_by("version", "number")).first()[0]
    return f"{path}/version={version}"


def read_snapshot(spark: SparkSession, table: Table, root: str) -> DataFrame:
    """Current version of a snapshot table; empty before the first write."""
    folder = snapshot_folder(spark, table.path(root))
    if folder is None:
        return spark.createDataFrame([], table.struct)
    return spark.read.schema(table.struct).parquet(folder).select(*table.struct.names)


def overwrite_folders(df: DataFrame, path: str, partition_by: list[str], file_format: str = "parquet") -> None:
    """Replace the partition folders present in ``df``, as its tasks lie."""
    packed = {"compression": PACKED} if file_format == "parquet" else {}
    (
        df.write.mode("overwrite")
        .options(partitionOverwriteMode="dynamic", **packed)
        .partitionBy(*partition_by)
        .format(file_format)
        .save(path)
    )


def overwrite_folder(df: DataFrame, folder: str) -> None:
    """Replace the one folder that all of ``df`` belongs in. As it is named, rows are not sorted by it."""
    df.write.mode("overwrite").option("compression", PACKED).parquet(folder)


def append_batch(df: DataFrame, path: str, batch: str, partition_by: tuple[str, ...] = ()) -> None:
    """Append under a batch id; writing the same batch again replaces it."""
    overwrite_folders(df.withColumn("_batch", F.lit(batch)), path, [*partition_by, "_batch"])


def read_batch(spark: SparkSession, path: str, batch: str, schema: StructType) -> DataFrame:
    """What :func:`append_batch` wrote under a batch id; only that folder is listed."""
    folder = f"{path}/_batch={batch}"
    return spark.read.schema(schema).parquet(folder) if path_exists(spark, folder) else spark.createDataFrame([], schema)


def register_table(spark: SparkSession, name: str, path: str, partitioned: bool = False) -> None:
    """Make stored files known to the catalog under ``name`` if absent."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{path}'")
    if partitioned:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a table's first partition column, from its folder names."""
    if not path_exists(spark, path):
        return []
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)
    names = [f.getPath().getName() for f in found]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{column}="))


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder and everything in it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
