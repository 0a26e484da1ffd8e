from pyspark.sql import functions as F

from faresettle.catalog.queries import scratch_table
from faresettle.functions.windows import DateWindow
from faresettle.operators import tables
from faresettle.session import scratch_path
from faresettle.sources.files import text_schema
from faresettle.plans.contract import REPORT_SCHEMA
from faresettle.streaming import drops
from tests.test_tables import content, rows_of


def write_drop(df, folder):
    df.write.mode("append").options(sep=";", header=True, escape='"').csv(folder)


def test_each_drop_is_loaded_once(spark):
    folder, checkpoint, table = scratch_path(spark, "in"), scratch_path(spark, "progress"), scratch_table(spark)
    drops.create_drop_table(spark, table)
    write_drop(rows_of(spark, "2025-09-10", "2025-09-11"), folder)
    for _ in range(2):
        drops.load_new_drops(spark, folder, table, checkpoint)
    assert content(spark, table) == {("2025-09-10", 1): 1, ("2025-09-11", 1): 1}
    write_drop(rows_of(spark, "2025-09-11", amount=2), folder)
    drops.load_new_drops(spark, folder, table, checkpoint)
    assert content(spark, table) == {("2025-09-10", 1): 1, ("2025-09-11", 1): 1, ("2025-09-11", 2): 1}
    tables.delete_range(spark, [table], DateWindow.of("2025-09-11", "2025-09-16"))
    assert content(spark, table) == {("2025-09-10", 1): 1}


def test_a_bad_drop_does_not_block_later_ones(spark):
    folder, checkpoint, table, aside = scratch_path(spark, "in"), scratch_path(spark, "progress"), scratch_table(spark), scratch_path(spark, "bad")
    drops.create_drop_table(spark, table)
    bad = rows_of(spark, "2025-09-11").withColumn("Fare", F.lit("1,5"))
    for drop in (rows_of(spark, "2025-09-10"), bad, rows_of(spark, "2025-09-12")):
        write_drop(drop, folder)
        drops.load_new_drops(spark, folder, table, checkpoint, quarantine=aside)
    assert content(spark, table) == {("2025-09-10", 1): 1, ("2025-09-12", 1): 1}
    rows = spark.read.options(sep=";", header=True).csv(f"{aside}/*")
    assert [(r.TrxDate, r.Fare) for r in rows.collect()] == [("2025-09-11", "1,5")]


def test_a_batch_that_runs_again_replaces_its_rows(spark):
    table = scratch_table(spark)
    drops.create_drop_table(spark, table)
    text = rows_of(spark, "2025-09-10").selectExpr(*[f"CAST({f.name} AS STRING) AS {f.name}" for f in text_schema(REPORT_SCHEMA)])
    for batch_id in (0, 1, 1):
        drops.load_batch(text, batch_id, table, REPORT_SCHEMA)
    assert content(spark, table) == {("2025-09-10", 1): 2}
