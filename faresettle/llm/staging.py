"""Cutting lineage in the folder that all executors share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from faresettle.session import scratch_path

_STAGED: dict[str, list[str]] = {}


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write `df` as Parquet to the shared folder and read it back.

    What reads it neither recomputes `df` nor depends on the executors that made it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{label}")
    df.write.option("compression", "zstd").parquet(path)
    _STAGED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_for(df: DataFrame, label: str) -> tuple[DataFrame, Callable[[], None]]:
    """`stage`, and what deletes the table once nothing is to read it any more."""
    staged = stage(df, label)
    held = _STAGED[df.sparkSession.sparkContext.applicationId]
    path = held[-1]

    def drop() -> None:
        _delete(df.sparkSession, path)
        if path in held:
            held.remove(path)

    return staged, drop


def drop_staged(spark: SparkSession) -> int:
    """Delete what this application has staged, once its results are read; returns the number of folders."""
    paths = _STAGED.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        _delete(spark, path)
    return len(paths)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """`stage` for the small tables of iterative jobs: one pass, and `drop_staged` deletes it."""
    return stage(df, "checkpoint")


class Rounds:
    """The table of an iterative job, staged once a round. Only the last two are kept: a round reads the one before it."""

    def __init__(self, label: str) -> None:
        self.label = label
        self.drops: list[Callable[[], None]] = []

    def stage(self, df: DataFrame) -> DataFrame:
        staged, drop = stage_for(df, self.label)
        self.drops.append(drop)
        if len(self.drops) > 2:
            self.drops.pop(0)()
        return staged
