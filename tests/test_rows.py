"""Windows of tables without a partition per day: rows leave file by file."""

import hashlib
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from faresettle.catalog.queries import scratch_table
from faresettle.operators import rows, tables
from faresettle.plans.contract import REPORT_SCHEMA
from faresettle.session import scratch_path
from tests.test_tables import AUGUST, OUTSIDE, content, rows_of

DAYS = ("2025-07-31", "2025-08-01", "2025-08-15", "2025-08-31", "2025-09-01", None)


def files(spark, table):
    """Bytes of the table's files, by name."""
    found = spark.table(table).select("_metadata.file_path").distinct().collect()
    paths = [Path(rows.path_of(spark, r.file_path).removeprefix("file:")) for r in found]
    return {str(p): hashlib.md5(p.read_bytes()).hexdigest() for p in paths}


@pytest.fixture(params=[(), ("Source",), ("Type", "Source")], ids=["plain", "source", "type-source"])
def loaded(spark, request):
    """A table of six days in three files: two hold days of August, one of them other days too."""
    table = scratch_table(spark, REPORT_SCHEMA, request.param)
    for days in (DAYS[:2], DAYS[2:4], DAYS[4:]):
        tables.aligned(rows_of(spark, *days).withColumn("Type", F.lit("Sale")), table).coalesce(1).write.insertInto(table)
    return table


def test_delete_keeps_other_and_null_days(spark, loaded):
    for _ in range(2):
        tables.delete_range(spark, [loaded], AUGUST)
        assert content(spark, loaded) == OUTSIDE


def test_untouched_files_keep_name_and_bytes(spark, loaded):
    before = files(spark, loaded)
    assert len(before) == 3
    touched = rows.files_with(spark, loaded, F.expr(tables.range_condition(AUGUST)))
    tables.delete_range(spark, [loaded], AUGUST)
    after = files(spark, loaded)
    assert len(touched) == 2 and len(after) == 2 and set(after) < set(before)
    assert sum(after[name] == before[name] for name in after) == 1
    assert spark.table(loaded).filter("Source = 'x'").count() == 3


def test_replace_is_rerunnable(spark, loaded):
    batch = rows_of(spark, "2025-08-15", "2025-08-20", amount=5)
    expected = OUTSIDE + Counter({("2025-08-15", 5): 1, ("2025-08-20", 5): 1})
    for _ in range(2):
        tables.window_replace(batch, loaded, AUGUST)
        assert content(spark, loaded) == expected
    tables.window_replace(batch.limit(0), loaded, AUGUST)
    assert content(spark, loaded) == OUTSIDE


def test_batch_may_read_the_table_it_replaces(spark, loaded):
    halved = spark.table(loaded).filter(AUGUST.contains_text(F.col("TrxDate"))).withColumn("Fare", F.lit(9))
    tables.window_replace(halved, loaded, AUGUST)
    assert content(spark, loaded) == OUTSIDE + Counter({(d, 9): 1 for d in ("2025-08-01", "2025-08-15", "2025-08-31")})


def test_batch_outside_the_window_changes_nothing(spark, loaded):
    before = files(spark, loaded)
    with pytest.raises(ValueError, match="outside the window"):
        tables.window_replace(rows_of(spark, "2025-08-02", "2025-09-09"), loaded, AUGUST)
    assert files(spark, loaded) == before


def test_crash_before_the_first_swap_changes_nothing(spark, loaded, monkeypatch):
    before = files(spark, loaded)

    def crash(*args):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(rows, "swap", crash)
        with pytest.raises(RuntimeError, match="killed"):
            tables.delete_range(spark, [loaded], AUGUST)
    spark.catalog.refreshTable(loaded)
    assert files(spark, loaded) == before and sum(content(spark, loaded).values()) == 6
    tables.delete_range(spark, [loaded], AUGUST)
    assert content(spark, loaded) == OUTSIDE
    assert rows.listed(spark, f"{rows.location(spark, loaded)}/{rows._REWRITES}*") == []


def test_rerun_converges_after_a_crash_between_swaps(spark, loaded, monkeypatch):
    real = rows.swap

    def half(spark, table, fresh):
        real(spark, table, dict(list(fresh.items())[:1]))
        raise RuntimeError("killed")

    batch = rows_of(spark, "2025-08-15", amount=5)
    with monkeypatch.context() as patch:
        patch.setattr(rows, "swap", half)
        with pytest.raises(RuntimeError, match="killed"):
            tables.window_replace(batch, loaded, AUGUST)
    assert OUTSIDE <= content(spark, loaded)
    tables.window_replace(batch, loaded, AUGUST)
    assert content(spark, loaded) == OUTSIDE + Counter({("2025-08-15", 5): 1})


def test_failing_load_keeps_the_old_rows(spark, loaded, monkeypatch):
    batch = rows_of(spark, "2025-08-15", amount=5)
    before = files(spark, loaded)
    bad = tables.aligned(batch, loaded).withColumn("Fare", F.raise_error(F.lit("load failed")).cast(REPORT_SCHEMA["Fare"].dataType))
    with pytest.raises(Exception, match="load failed"):
        rows.replace_rows(bad, loaded, F.expr(tables.range_condition(AUGUST)))
    spark.catalog.refreshTable(loaded)
    assert files(spark, loaded) == before


def test_promotion_and_external_tables(spark):
    path, name, final = scratch_path(spark, "external"), scratch_table(spark), scratch_table(spark, REPORT_SCHEMA, ())
    rows_of(spark, *DAYS).write.option("path", path).saveAsTable(name)
    tables.promote_final(rows_of(spark, "2025-08-15", amount=7), final, name, AUGUST)
    assert content(spark, final) == {("2025-08-15", 7): 1}
    assert content(spark, name) == OUTSIDE
    assert spark.read.parquet(path).count() == 3


def test_days_of_type_date(spark):
    name = scratch_table(spark)
    rows_of(spark, *DAYS).withColumn("TrxDate", F.col("TrxDate").cast("date")).write.saveAsTable(name)
    tables.window_replace(rows_of(spark, "2025-08-15", amount=7), name, AUGUST)
    tables.delete_range(spark, [name], tables.DateWindow.of("2025-08-31", "2025-08-31"))
    left = Counter((str(r.TrxDate), int(r.Fare)) for r in spark.table(name).collect())
    assert left == {("2025-07-31", 1): 1, ("2025-09-01", 1): 1, ("None", 1): 1, ("2025-08-15", 7): 1}


# What is refused is refused before the first write.


@pytest.fixture(params=["no-day", "csv", "view"])
def refused(spark, request):
    name = scratch_table(spark)
    frame = rows_of(spark, *DAYS)
    if request.param == "no-day":
        frame.withColumnRenamed("TrxDate", "Day").write.saveAsTable(name)
    elif request.param == "csv":
        frame.write.format("csv").saveAsTable(name)
    else:
        name = "refused_rows"
        frame.createOrReplaceTempView(name)
    return name


def test_tables_without_windows_are_refused(spark, refused, loaded):
    before = files(spark, loaded)
    with pytest.raises(ValueError):
        tables.delete_range(spark, [loaded, refused], AUGUST)
    with pytest.raises(ValueError):
        tables.window_replace(rows_of(spark, "2025-08-02"), refused, AUGUST)
    with pytest.raises(ValueError):
        tables.promote_final(rows_of(spark, "2025-08-02"), loaded, refused, AUGUST)
    assert files(spark, loaded) == before
    assert spark.table(refused).count() == 6


def test_other_partitions_of_a_replaced_day_go_too(spark):
    """Partitioned by day and source: a source that the new batch lacks is gone from the day."""
    table = scratch_table(spark, REPORT_SCHEMA, ("TrxDate", "Source"))
    old = rows_of(spark, "2025-08-01", "2025-08-02", "2025-09-01")
    tables.append(old.unionByName(old.withColumn("Source", F.lit("a/b=c %"))).unionByName(old.withColumn("Source", F.lit(None).cast("string"))), table)
    for publish in (tables.OVERWRITE, tables.SWITCH):
        tables.window_replace(rows_of(spark, "2025-08-01", amount=5), table, AUGUST, publish=publish)
        assert content(spark, table) == {("2025-08-01", 5): 1, ("2025-09-01", 1): 3}


def test_partitions_without_files_are_found(spark, table):
    spark.sql(f"ALTER TABLE {table} ADD PARTITION (TrxDate = '2025-08-07')")
    assert tables.partitions_in(spark, table, AUGUST) == [{"TrxDate": "2025-08-07"}]
    tables.delete_range(spark, [table], AUGUST)
    assert tables.partitions_in(spark, table, AUGUST) == []
