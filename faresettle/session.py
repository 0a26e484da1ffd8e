"""Session settings and the shared folder for staged data."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

# Settings of sessions made here; they are for speed, no result depends on them.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Capturing a call site for every column costs more than building the plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # The JVM does not compile methods above 8000 bytes, and aggregates of many
    # decimals generate such; Spark then runs them in smaller pieces.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# A runtime filter passes about one foreign key in a hundred at this many bits a key.
FILTER_BITS_PER_KEY = 10
# 8 MB, as every task makes a filter of full size and one merges them. Beyond 6.7 million keys the filter passes more, the
# result stays the same; details landed in buckets need no filter.
MAX_FILTER_BITS = 2**26
_FILTER = "spark.sql.optimizer.runtime.bloomFilter"


def local_session(cores: int = 8, shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("faresettle")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def runtime_filter_for(spark: SparkSession, keys: int) -> Iterator[None]:
    """Within this block, joins are planned with runtime filters of the right size.

    Spark sizes its filters by settings, not by the join: without them a filter made for a
    million keys stops filtering at ten. The caller knows how many keys the small side has.
    """
    bits = str(max(1024, min(MAX_FILTER_BITS, FILTER_BITS_PER_KEY * keys)))
    wanted = {
        "enabled": "true",
        "expectedNumItems": str(max(1, keys)),
        "maxNumItems": str(max(1, keys)),
        "numBits": bits,
        "maxNumBits": bits,
        # The side that makes the filter has been counted, so its raw size says nothing.
        "creationSideThreshold": "1024TB",
    }
    before = {name: spark.conf.get(f"{_FILTER}.{name}") for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(f"{_FILTER}.{name}", value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(f"{_FILTER}.{name}", value)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A machine-local folder is only a fallback for a local master.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder(spark.sparkContext.applicationId)


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"faresettle-{application}-")


# What each application has made in the shared folder: paths, and databases.
_PATHS: dict[str, list[str]] = {}
_DATABASES: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, until ``drop_scratch``."""
    path = f"{shared_folder(spark)}/faresettle-{label}-{uuid.uuid4().hex}"
    _PATHS.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def drop_scratch(spark: SparkSession) -> int:
    """Delete this application's scratch paths and staging databases, once no result reads them any more.

    Returns how many there were. Results that are still unread fail afterwards.
    """
    application = spark.sparkContext.applicationId
    databases, paths = _DATABASES.pop(application, []), _PATHS.pop(application, [])
    for database in databases:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for path in map(hadoop, paths):
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return len(databases) + len(paths)


class Staging:
    """Intermediate tables in the shared folder, dropped together.

    What reads a staged table neither recomputes it nor depends on the executors
    that produced it.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.database = f"faresettle_{uuid.uuid4().hex}"
        spark.sql(f"CREATE DATABASE {self.database} LOCATION '{shared_folder(spark)}/{self.database}'")
        _DATABASES.setdefault(spark.sparkContext.applicationId, []).append(self.database)

    def write(self, df: DataFrame, name: str, buckets: tuple[int, str] | None = None) -> DataFrame:
        """Stage ``df`` as a table; with ``buckets``, a number and a column, in buckets of that column, each written by one task."""
        table = f"{self.database}.{name}"
        if buckets is None:
            df.write.saveAsTable(table)
        else:
            number, key = buckets
            df.repartition(number, key).write.bucketBy(number, key).sortBy(key).saveAsTable(table)
        return self.spark.table(table)

    def write_counted(self, df: DataFrame, name: str, buckets: tuple[int, str] | None = None) -> tuple[DataFrame, int]:
        """``write``, and the number of rows, counted by the job that writes them."""
        seen = Observation(f"faresettle_{name}")
        staged = self.write(df.observe(seen, F.count(F.lit(1)).alias("rows")), name, buckets)
        return staged, seen.get["rows"]

    def read(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.database}.{name}")

    def drop(self) -> None:
        self.spark.sql(f"DROP DATABASE IF EXISTS {self.database} CASCADE")

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *error: object) -> None:
        self.drop()
