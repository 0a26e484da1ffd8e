"""Rows leave Parquet tables file by file: only files that hold such rows are written anew.

For tables without a partition per day. A file is replaced under its own name by one rename, so a reader meets
each file as it was or as it is to be, never both and never neither; files without such rows keep their name and bytes.
"""

from __future__ import annotations

import hashlib
import uuid

from py4j.java_gateway import JavaObject
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_FILE = "_faresettle_file"
# New files are written to such a folder of the table's own: its name hides it from scans, and renames stay on one file system.
_REWRITES = "_faresettle_rewrite_"


def require_parquet(spark: SparkSession, table: str) -> None:
    """Raise unless the table's rows lie in Parquet files of its own."""
    facts = {row.col_name: row.data_type for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if facts.get("Type") not in ("MANAGED", "EXTERNAL") or facts.get("Provider", "").lower() != "parquet":
        raise ValueError(f"{table} is no Parquet table, so its rows can't be deleted file by file")


def files_with(spark: SparkSession, table: str, condition: Column) -> list[str]:
    """Files that hold a row that meets the condition. The scan skips files and row groups whose statistics exclude it.

    Names of such files reach the driver, which holds the list of a table's files anyway when it plans a scan.
    """
    found = spark.table(table).filter(condition).select(F.col("_metadata.file_path").alias(_FILE)).distinct()
    return sorted(row[_FILE] for row in found.collect())


def remaining(spark: SparkSession, table: str, files: list[str], condition: Column) -> DataFrame:
    """The rows of these files that stay: those that don't meet the condition, and those for which it is null."""
    here = spark.table(table).select("*", F.col("_metadata.file_path").alias(_FILE)).filter(F.col(_FILE).isin(files))
    return here.filter(~F.coalesce(condition, F.lit(False)))


def delete_rows(spark: SparkSession, table: str, condition: Column) -> int:
    """Delete the rows that meet the condition and return how many files that changed.

    All files are written anew elsewhere before the first is replaced. After a crash between two of them a rerun deletes
    the rest. A file that is left without rows is deleted. Renames replace a file at once on HDFS and on local disks; on an object store
    use a lake format.
    """
    require_parquet(spark, table)
    files = files_with(spark, table, condition)
    if files:
        swap(spark, table, written(spark, table, files, condition))
        drop_rewrites(spark, table)
    return len(files)


def replace_rows(batch: DataFrame, table: str, condition: Column) -> None:
    """Append ``batch`` and delete the rows that met the condition before.

    What the deletion needs is written first, then the batch is appended, so a load that fails leaves the old rows.
    """
    spark = batch.sparkSession
    require_parquet(spark, table)
    files = files_with(spark, table, condition)
    fresh = written(spark, table, files, condition) if files else {}
    batch.write.insertInto(table)
    swap(spark, table, fresh)
    drop_rewrites(spark, table)


def written(spark: SparkSession, table: str, files: list[str], condition: Column) -> dict[str, str | None]:
    """For each file, the file that is to take its place, or None if no row stays.

    The rows of a file meet in one task, as they did when it was written. What a crashed run left is deleted first.
    """
    drop_rewrites(spark, table)
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    stay = remaining(spark, table, files, condition).drop(*parts)
    folder = f"{location(spark, table)}/{_REWRITES}{uuid.uuid4().hex}"
    named = stay.withColumn(_FILE, F.sha2(_FILE, 256))
    named.repartition(_FILE).write.option("maxRecordsPerFile", 0).partitionBy(_FILE).parquet(folder)
    found: dict[str, str] = {}
    for path in listed(spark, f"{folder}/{_FILE}=*/*.parquet"):
        name = path.getParent().getName().split("=", 1)[1]
        if name in found:
            raise RuntimeError(f"rows of one file were written to two: {path}")
        found[name] = path.toString()
    return {file: found.get(hashlib.sha256(file.encode()).hexdigest()) for file in files}


def drop_rewrites(spark: SparkSession, table: str) -> None:
    """Delete the folders of new files, those of a crashed run too."""
    for path in listed(spark, f"{location(spark, table)}/{_REWRITES}*"):
        delete_path(spark, path.toString())


def location(spark: SparkSession, table: str) -> str:
    facts = {row.col_name: row.data_type for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    return path_of(spark, facts["Location"]).rstrip("/")


def listed(spark: SparkSession, pattern: str) -> list[JavaObject]:
    path = hadoop_path(spark, pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return [status.getPath() for status in found or []]


def swap(spark: SparkSession, table: str, fresh: dict[str, str | None]) -> None:
    """Put each new file in its old one's place, or delete the old one."""
    jvm = spark.sparkContext._jvm
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    for old, new in fresh.items():
        target = path_of(spark, old)
        if new is None:
            delete_path(spark, target)
        else:
            path = hadoop_path(spark, target)
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
            context.rename(hadoop_path(spark, new), path, over)
    spark.catalog.refreshTable(table)


def hadoop_path(spark: SparkSession, path: str) -> JavaObject:
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def path_of(spark: SparkSession, uri: str) -> str:
    """The plain path of a file name as Spark shows it, with its escapes undone."""
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext._jvm.java.net.URI(uri)).toString()


def delete_path(spark: SparkSession, path: str) -> None:
    folder = hadoop_path(spark, path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
