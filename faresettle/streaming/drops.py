"""Loading a folder of weekly drops as they arrive, each file once.

The checkpoint remembers which files were loaded. Every micro-batch owns one
``load_id`` partition level and overwrites only that, so a batch that runs again
after a failure replaces its own rows instead of repeating them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from faresettle.operators.export import export_csv
from faresettle.operators.tables import PARTITION_COLUMN, create_table, overwrite_partitions
from faresettle.plans.contract import REPORT_SCHEMA
from faresettle.sources.files import CSV_OPTIONS, split_bad_rows, text_schema, typed

LOAD_ID = "load_id"


def create_drop_table(spark: SparkSession, table: str, schema: StructType = REPORT_SCHEMA) -> None:
    with_id = StructType([*schema.fields, StructField(LOAD_ID, LongType())])
    create_table(spark, table, with_id, (LOAD_ID, PARTITION_COLUMN))


def load_batch(batch: DataFrame, batch_id: int, table: str, schema: StructType, quarantine: str | None = None) -> None:
    """Write one micro-batch as the only content of its ``load_id``; with ``quarantine``, bad rows go to a folder of theirs."""
    if quarantine is None:
        rows = typed(batch, schema)
    else:
        rows, bad = split_bad_rows(batch, schema)
        export_csv(bad, f"{quarantine}/{LOAD_ID}={batch_id}", sep=";")
    overwrite_partitions(rows.withColumn(LOAD_ID, F.lit(batch_id).cast("bigint")), table)


def load_new_drops(
    spark: SparkSession, files: str, table: str, checkpoint: str, schema: StructType = REPORT_SCHEMA, quarantine: str | None = None
) -> None:
    """Load the files matching ``files`` that no earlier call has loaded, then stop.

    A bad row fails its batch, and later calls try it again, unless ``quarantine`` names a folder for bad rows.
    Then a row with too few or too many fields goes there too, as far as it can be told apart, and later files load.
    """
    options = CSV_OPTIONS if quarantine is None else CSV_OPTIONS | {"mode": "PERMISSIVE"}
    drops = spark.readStream.options(**options).schema(text_schema(schema)).csv(files)
    query = (
        drops.writeStream.foreachBatch(lambda batch, batch_id: load_batch(batch, batch_id, table, schema, quarantine))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
