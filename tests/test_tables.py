"""Load laws of the date-partitioned tables."""

from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from faresettle.catalog.queries import scratch_table
from faresettle.functions.windows import DateWindow
from faresettle.operators import export, tables
from faresettle.operators.classify import ExpressionRule
from faresettle.plans import jobs
from faresettle.plans.contract import MEASURES, REPORT_COLUMNS, REPORT_SCHEMA
from faresettle.session import scratch_path
from tests.test_settlement import ONE, frames, issue, payment, refund

AUGUST = DateWindow.of("2025-08-01", "2025-08-31")


def rows_of(spark, *days, amount=1):
    """One report row per day, every measure equal to ``amount``."""
    values = [(f"Sale-{n}", day) for n, day in enumerate(days)]
    base = spark.createDataFrame(values, "Type string, TrxDate string")
    columns = [
        F.col(c) if c in ("Type", "TrxDate") else F.lit(amount).cast(REPORT_SCHEMA[c].dataType).alias(c) if c in MEASURES else F.lit("x").alias(c)
        for c in REPORT_COLUMNS
    ]
    return base.select(columns)


def content(spark, table):
    return Counter((r.TrxDate, int(r.Fare)) for r in spark.table(table).select("TrxDate", "Fare").collect())


@pytest.fixture()
def loaded(spark, table):
    tables.append(rows_of(spark, "2025-07-31", "2025-08-01", "2025-08-15", "2025-08-31", "2025-09-01", None), table)
    return table


OUTSIDE = Counter({("2025-07-31", 1): 1, ("2025-09-01", 1): 1, (None, 1): 1})


def test_append_repeats_rows(spark, table):
    batch = rows_of(spark, "2025-08-01")
    tables.append(batch, table)
    tables.append(batch, table)
    assert content(spark, table) == {("2025-08-01", 1): 2}


def test_append_matches_columns_by_name(spark, table):
    shuffled = rows_of(spark, "2025-08-01", amount=3).select(*reversed(REPORT_COLUMNS)).withColumn("extra", F.lit(1))
    tables.append(shuffled, table)
    row = spark.table(table).first()
    assert (row.TrxDate, row.Net_COA, row.Source) == ("2025-08-01", 3, "x")
    with pytest.raises(ValueError, match="Net_COA"):
        tables.append(shuffled.drop("Net_COA"), table)


def test_delete_range_keeps_other_and_null_days(spark, loaded):
    tables.delete_range(spark, [loaded], AUGUST)
    assert content(spark, loaded) == OUTSIDE
    tables.delete_range(spark, [loaded], AUGUST)
    assert content(spark, loaded) == OUTSIDE


def test_replace_is_rerunnable_and_drops_days_without_new_rows(spark, loaded):
    batch = rows_of(spark, "2025-08-15", "2025-08-20", amount=5)
    expected = OUTSIDE + Counter({("2025-08-15", 5): 1, ("2025-08-20", 5): 1})
    for _ in range(2):
        tables.window_replace(batch, loaded, AUGUST)
        assert content(spark, loaded) == expected


def test_empty_batch_empties_the_window(spark, loaded):
    tables.window_replace(rows_of(spark, "2025-08-01").limit(0), loaded, AUGUST)
    assert content(spark, loaded) == OUTSIDE


def test_batch_may_read_the_table_it_replaces(spark, loaded):
    halved = spark.table(loaded).filter(AUGUST.contains_text(F.col("TrxDate"))).withColumn("Fare", F.lit(9))
    tables.window_replace(halved, loaded, AUGUST)
    assert content(spark, loaded) == OUTSIDE + Counter({(d, 9): 1 for d in ("2025-08-01", "2025-08-15", "2025-08-31")})


@pytest.mark.parametrize("day", ["2025-09-01", "2025-08-1x", None])
def test_batch_outside_the_window_changes_nothing(spark, loaded, day):
    before = content(spark, loaded)
    with pytest.raises(ValueError, match="outside the window"):
        tables.window_replace(rows_of(spark, "2025-08-02", day), loaded, AUGUST)
    assert content(spark, loaded) == before


def test_failing_extract_changes_nothing(spark, loaded):
    before = content(spark, loaded)
    failing = rows_of(spark, "2025-08-02").withColumn("Source", F.raise_error(F.lit("extract failed")).cast("string"))
    with pytest.raises(Exception, match="extract failed"):
        tables.window_replace(failing, loaded, AUGUST)
    assert content(spark, loaded) == before


def test_replace_restores_the_overwrite_mode(spark, loaded):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    tables.window_replace(rows_of(spark, "2025-08-15"), loaded, AUGUST)
    assert spark.conf.get(key) == before


@pytest.fixture()
def external(spark):
    """An external table and its folder."""
    path, name = scratch_path(spark, "external"), scratch_table(spark)
    rows = rows_of(spark, "2025-07-31", "2025-08-01", "2025-08-02", "2025-09-01", None)
    rows.write.partitionBy("TrxDate").option("path", path).saveAsTable(name)
    return name, path


def files_content(spark, path):
    frame = spark.read.schema(REPORT_SCHEMA).parquet(path)
    return Counter((r.TrxDate, int(r.Fare)) for r in frame.select("TrxDate", "Fare").collect())


def test_external_window_equals_batch(spark, external):
    """A day that the batch lacks goes, and so do its files."""
    name, path = external
    for _ in range(2):
        tables.window_replace(rows_of(spark, "2025-08-01", amount=5), name, AUGUST)
        assert content(spark, name) == files_content(spark, path) == OUTSIDE + Counter({("2025-08-01", 5): 1})


def test_external_delete_and_promotion(spark, external):
    name, path = external
    final = scratch_table(spark, REPORT_SCHEMA)
    tables.promote_final(rows_of(spark, "2025-08-15", amount=7), final, name, AUGUST)
    assert content(spark, final) == {("2025-08-15", 7): 1}
    assert content(spark, name) == files_content(spark, path) == OUTSIDE


def test_external_monthly_job(spark, external):
    name, path = external
    sources = frames(spark, {"payt": [payment(1, "A1")], "emis": [issue("A1")], "para": ONE})
    rule = ExpressionRule(lambda ticket, isoc: F.lit("I"))
    jobs.monthly_settlement(sources, AUGUST, rule, scratch_path(spark, "lake"), name, scratch_table(spark, REPORT_SCHEMA))
    assert content(spark, name) == files_content(spark, path) == OUTSIDE + Counter({("2025-08-05", 10): 1})


def test_refusal_changes_nothing_in_an_external_table(spark, external):
    name, path = external
    before = files_content(spark, path)
    with pytest.raises(ValueError, match="outside the window"):
        tables.window_replace(rows_of(spark, "2025-08-01", "2025-09-09"), name, AUGUST)
    assert content(spark, name) == files_content(spark, path) == before


def test_lake_tables_get_row_level_statements(spark, loaded):
    assert not tables.is_lake_table(spark, loaded)
    assert tables.delete_statement("lake.sales", AUGUST) == (
        "DELETE FROM lake.sales WHERE `TrxDate` BETWEEN '2025-08-01' AND '2025-08-31'"
    )
    frame = rows_of(spark, "2025-07-31", "2025-08-10", None)
    assert [r.TrxDate for r in frame.filter(tables.range_condition(AUGUST)).collect()] == ["2025-08-10"]


def test_lake_branch_is_taken_by_format(spark, loaded, monkeypatch):
    said = []
    monkeypatch.setattr(tables, "is_lake_table", lambda spark, table: True)
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: said.append(text))
    tables.delete_range(spark, ["lake.final", "lake.recent"], AUGUST)
    assert said == [tables.delete_statement(t, AUGUST) for t in ("lake.final", "lake.recent")]


def test_promotion_retires_preliminary_rows(spark, loaded):
    final = scratch_table(spark, REPORT_SCHEMA)
    tables.promote_final(rows_of(spark, "2025-08-15", amount=7), final, loaded, AUGUST)
    assert content(spark, final) == {("2025-08-15", 7): 1}
    assert content(spark, loaded) == OUTSIDE


def test_monthly_job_end_to_end(spark, loaded):
    final, root = scratch_table(spark, REPORT_SCHEMA), scratch_path(spark, "lake")
    sources = frames(spark, {"payt": [payment(1, "A1")], "emis": [issue("A1")], "rmbt": [refund(1, "A1")], "para": ONE})
    rule = ExpressionRule(lambda ticket, isoc: F.lit("I"))
    for _ in range(2):
        path = jobs.monthly_settlement(sources, AUGUST, rule, root, final, loaded)
        assert path.endswith("sales/sales_refund_20250801_20250831.parquet")
        assert content(spark, final) == {("2025-08-05", 10): 1, ("2025-08-06", -4): 1}
        assert content(spark, loaded) == OUTSIDE
    jobs.load_parquet(spark, AUGUST, root, final)
    assert content(spark, final) == {("2025-08-05", 10): 2, ("2025-08-06", -4): 2}


def test_weekly_job_replaces_or_appends(spark, table):
    root = scratch_path(spark, "drops")
    week = DateWindow(date(2025, 9, 10), date(2025, 9, 16))
    export.export_csv(rows_of(spark, "2025-09-10", "2025-09-16"), week.path(root, jobs.RECENT_PREFIX, "csv"), sep=";")
    once = {("2025-09-10", 1): 1, ("2025-09-16", 1): 1}
    for _ in range(2):
        jobs.weekly_recent(spark, week, root, table)
        assert content(spark, table) == once
    jobs.weekly_recent(spark, week, root, table, replace=False)
    assert content(spark, table) == {key: 2 for key in once}


def test_weekly_job_sets_bad_rows_aside(spark, table):
    root, aside = scratch_path(spark, "drops"), scratch_path(spark, "bad")
    week = DateWindow(date(2025, 9, 10), date(2025, 9, 16))
    path = week.path(root, jobs.RECENT_PREFIX, "csv")
    bad = rows_of(spark, "2025-09-12").withColumn("Fare", F.lit("1,5"))
    good = rows_of(spark, "2025-09-10").withColumn("Fare", F.col("Fare").cast("string"))
    export.export_csv(good.unionByName(bad), path, sep=";")
    with pytest.raises(Exception, match="not a plain amount"):
        jobs.weekly_recent(spark, week, root, table)
    assert content(spark, table) == {}
    for _ in range(2):
        jobs.weekly_recent(spark, week, root, table, quarantine=aside)
        assert content(spark, table) == {("2025-09-10", 1): 1}
        assert spark.read.options(sep=";", header=True).csv(week.path(aside, jobs.RECENT_PREFIX, "csv")).count() == 1
