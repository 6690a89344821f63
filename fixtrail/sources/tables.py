"""The eight tables on storage, snapshots and reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession

from ..operators.shaping import distinct_on
from ..schemas import TABLES


MANIFEST = "manifest"


def write_manifest(spark: SparkSession, root: str, earlier: Mapping[str, Sequence[str]]) -> None:
    """Name the folders of earlier runs that belong to tables of ``root`` beside those below it."""
    rows = [(name, folder) for name, folders in earlier.items() for folder in folders]
    spark.createDataFrame(rows, "name string, folder string").coalesce(1).write.mode("errorifexists") \
        .json(f"{root}/{MANIFEST}")


def live_folders(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """The folders of each table of ``root``, those of earlier runs first, as full paths."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    folders: dict[str, list[str]] = {name: [] for name in TABLES}
    if system.exists(path(f"{root}/{MANIFEST}")):
        # One row per table and run.
        for row in spark.read.schema("name string, folder string").json(f"{root}/{MANIFEST}").collect():
            folders[row["name"]].append(row["folder"])
    for name, listed in folders.items():
        listed.append(system.makeQualified(path(f"{root}/{name}")).toString())
    return folders


def load_tables(spark: SparkSession, root: str, views: bool = False) -> dict[str, DataFrame]:
    """All eight tables of ``root``, by its manifest if it has one; ``views`` also registers them for SQL."""
    tables = {name: spark.read.schema(TABLES[name]).parquet(*folders)
              for name, folders in live_folders(spark, root).items()}
    if views:
        for name, table in tables.items():
            table.createOrReplaceTempView(name)
    return tables


# Join keys of the stored tables; tables bucketed alike by a key join on it without a shuffle.
BUCKET_KEYS = {
    "fixes": "hash", "commits": "hash", "file_change": "hash", "method_change": "file_change_id",
    "cve": "cve_id", "cwe_classification": "cve_id",
}


def write_table(df: DataFrame, target: str, mode: str = "overwrite", partition_by: Sequence[str] = (),
                buckets: int | None = None, bucket_by: str | None = None) -> None:
    """Write a Parquet folder (a target with a slash) or a catalogue table, the latter bucketed on request.

    One file per bucket needs the rows laid out by the key before they are written.
    """
    if "/" in target:
        df.write.mode(mode).partitionBy(*partition_by).parquet(target)
        return
    if buckets:
        key = bucket_by or BUCKET_KEYS[target.rsplit(".", 1)[-1]]
        writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    else:
        writer = df.write
    writer.mode(mode).partitionBy(*partition_by).saveAsTable(target)


def write_tables(tables: Mapping[str, DataFrame], root: str) -> None:
    """Write all tables below a new ``root``; tables read from elsewhere stay as they are."""
    for name, table in tables.items():
        write_table(table, f"{root}/{name}", mode="errorifexists")


def publish(spark: SparkSession, staged: str, root: str) -> None:
    """Give checked tables their final place: the whole folder is renamed at once, by Spark's file system."""
    paths = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    source, target = paths(staged), paths(root)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if system.exists(target):
        raise FileExistsError(root)
    if target.getParent() is not None:
        system.mkdirs(target.getParent())
    if not system.rename(source, target):
        raise OSError(f"{staged} could not become {root}")


def table_exists(spark: SparkSession, target: str) -> bool:
    """Whether a Parquet folder or a catalogue table is there."""
    if "/" not in target:
        return spark.catalog.tableExists(target)
    try:
        spark.read.parquet(target).schema
    except AnalysisException:
        return False
    return True


def absent_rows(df: DataFrame, existing: DataFrame, key: str, order: Sequence[Column | str]) -> DataFrame:
    """Rows whose key the existing table lacks, one per key."""
    fresh = df.join(existing.select(key).distinct(), key, "left_anti").select(*df.columns)
    return distinct_on(fresh, [key], order)


def insert_if_absent(df: DataFrame, target: str, key: str, order: Sequence[Column | str]) -> None:
    """Append the rows of new keys; a missing target is created."""
    spark = df.sparkSession
    if not table_exists(spark, target):
        write_table(distinct_on(df, [key], order), target)
        return
    existing = spark.read.parquet(target) if "/" in target else spark.table(target)
    write_table(absent_rows(df, existing, key, order), target, mode="append")


def export_jsonl(df: DataFrame, root: str, stamp: str, name: str = "advisories") -> str:
    """I8: gzip JSON lines in a folder stamped with the feed date; returns the folder."""
    target = f"{root}/{name}-{stamp}.jsonl"
    df.write.mode("overwrite").option("compression", "gzip").json(target)
    return target


def write_report(df: DataFrame, path: str, order: Sequence[Column | str], limit: int | None = 10) -> None:
    """The first ``limit`` rows as one CSV file with a header.

    Without a limit all rows are written, sorted by ranges into several files, whose names go in the same order.
    """
    if limit is None:
        ranged = df.orderBy(*order) if order else df
        ranged.write.mode("overwrite").option("header", True).csv(path)
        return
    top = (df.orderBy(*order) if order else df).limit(limit).coalesce(1)
    top.write.mode("overwrite").option("header", True).csv(path)
