import json
from decimal import Decimal
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from faresettle import session
from faresettle.functions.values import blank_to_null, checked_decimal, iso_date, iso_text
from faresettle.functions.windows import DateWindow
from faresettle.operators import export, quality, roster
from faresettle.plans.contract import MONEY
from faresettle.session import Staging, scratch_path, shared_folder
from faresettle.sources import files, jdbc, payloads
from pyspark.sql.types import StringType, StructField, StructType

SCHEMA = StructType([StructField("TrxDate", StringType()), StructField("Source", StringType()), StructField("Fare", MONEY)])


def drop(spark, *lines, header="TrxDate;Source;Fare"):
    path = scratch_path(spark, "csv")
    spark.createDataFrame([("\n".join([header, *lines]),)], "value string").coalesce(1).write.text(path)
    return path


def test_csv_round_trip_keeps_awkward_text(spark):
    rows = [("2025-08-01", 'a;b "quoted"', Decimal("1.50")), ("2025-08-02", "", Decimal("-2.00")), (None, None, None)]
    path = scratch_path(spark, "csv")
    export.export_csv(spark.createDataFrame(rows, SCHEMA), path, sep=";")
    assert sorted(map(tuple, files.read_recent_csv(spark, path, SCHEMA).collect()), key=str) == sorted(rows, key=str)


@pytest.mark.parametrize("amount", ["1,5", "1.005", "1e3", "abc", "1.5.0", "12345678901234567.00"])
def test_csv_amounts_that_are_not_plain_fail(spark, amount):
    with pytest.raises(Exception, match="not a plain amount"):
        files.read_recent_csv(spark, drop(spark, f"2025-08-01;S;{amount}"), SCHEMA).collect()


@pytest.mark.parametrize("day", ["20250801", "2025-13-01", "2025-8-1", "01-08-2025"])
def test_csv_dates_that_are_not_iso_fail(spark, day):
    with pytest.raises(Exception, match="not an ISO date"):
        files.read_recent_csv(spark, drop(spark, f"{day};S;1.00"), SCHEMA).collect()


def test_csv_bad_rows_can_be_quarantined(spark):
    text = files.read_csv_text(spark, drop(spark, "2025-08-01;S;1.50", "2025-08-02;S;1,5", "x;S;2", ";S;"), SCHEMA)
    good, bad = files.split_bad_rows(text, SCHEMA)
    assert {(r.TrxDate, r.Fare) for r in good.collect()} == {("2025-08-01", Decimal("1.50")), (None, None)}
    assert {r.Fare for r in bad.collect()} == {"1,5", "2"}


def test_csv_header_must_match(spark):
    with pytest.raises(Exception, match="(?i)header"):
        files.read_recent_csv(spark, drop(spark, "2025-08-01;S;1", header="TrxDate;Fare;Source"), SCHEMA).collect()


def test_csv_with_a_missing_field_fails(spark):
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_recent_csv(spark, drop(spark, "2025-08-01;S"), SCHEMA).collect()


def test_scalar_functions(spark):
    row = spark.sql("SELECT 'FA  ' AS padded, '' AS empty").select(
        blank_to_null(F.col("padded")), blank_to_null(F.col("empty")), iso_text(iso_date(F.lit("2025-08-31"))),
        checked_decimal(F.lit("-0012.50"), MONEY),
    ).first()
    assert list(row) == ["FA", None, "2025-08-31", Decimal("-12.50")]


def test_jdbc_options_split_the_read():
    options = jdbc.table_options("jdbc:x", "payt", "sqnu", (0, 100), 8, user="someone")
    assert (options["partitionColumn"], options["numPartitions"], options["user"]) == ("sqnu", "8", "someone")
    assert "dbtable" not in jdbc.query_options("jdbc:x", "select 1 from dual")
    with pytest.raises(ValueError):
        jdbc.table_options("jdbc:x", "payt", "sqnu", (5, 5), 8)


def test_jdbc_day_predicates_cover_the_window_once(spark):
    window = DateWindow.of("2025-08-30", "2025-09-01")
    predicates = jdbc.day_predicates("d", window)
    moments = spark.sql(
        "SELECT explode(sequence(timestamp'2025-08-29 00:00:00', timestamp'2025-09-02 00:00:00', interval 6 hours)) AS d")
    hits = sum((F.expr(p).cast("int") for p in predicates), F.lit(0))
    assert moments.filter(hits != window.contains(F.col("d")).cast("int")).count() == 0


def test_jdbc_codes_are_cleaned(spark):
    frame = spark.createDataFrame([("FA ", "x"), ("  ", "y")], "vat_type string, note string")
    assert [r.vat_type for r in jdbc.codes_cleaned(frame, "vat_type").collect()] == ["FA", None]


GOOD = json.dumps({"number": 2, "people": [{"craft": "Red", "name": "Ann"}, {"craft": "Blue", "name": "Bob"}]})


def test_rosters_fall_back_when_unusable(spark):
    bad = [None, "", "not json", '{"number": 1, "people": [', '{"people": []}', '{"number": 3}']
    frame = spark.createDataFrame([(0, GOOD), (1, '{"number": 0, "people": []}'), *[(n + 2, p) for n, p in enumerate(bad)]],
                                  "id int, payload string")
    numbers = {r.id: (r.number, len(r.people)) for r in payloads.read_rosters(frame).collect()}
    assert numbers == {0: (2, 2), 1: (0, 0), **{n + 2: (12, 12) for n in range(len(bad))}}
    parsed = payloads.read_rosters(frame, fallback=False)
    assert {r.id for r in parsed.filter("number IS NULL").collect()} == set(range(2, 8))


def test_roster_lines_and_count(spark):
    frame = spark.createDataFrame([(GOOD,), (GOOD.replace("2", "5"),)], "payload string")
    rosters = payloads.read_rosters(frame)
    lines = [r.line for r in roster.roster_lines(roster.explode_people(rosters)).collect()]
    assert lines[0] == "Ann is currently in space flying on the Red! Hello! :)" and len(lines) == 4
    assert [(r.number, r.listed) for r in quality.count_mismatch(rosters).collect()] == [(5, 2)]


def test_roster_files_and_empty_folder(spark):
    path = scratch_path(spark, "rosters")
    spark.createDataFrame([(GOOD,)], "value string").coalesce(1).write.text(path)
    assert payloads.read_roster_files(spark, path).select("number").collect() == [(2,)]
    empty = scratch_path(spark, "rosters")
    spark.createDataFrame([], "value string").write.text(empty)
    assert [r.number for r in payloads.read_roster_files(spark, empty).collect()] == [12]


class Session:
    """A session as far as ``shared_folder`` asks."""

    def __init__(self, **settings):
        self.conf = settings
        self.sparkContext = SimpleNamespace(applicationId="application-1")


def test_shared_folder_is_the_clusters():
    assert shared_folder(Session(**{"spark.checkpoint.dir": "hdfs:///shared/"})) == "hdfs:///shared"


def test_scratch_is_dropped(spark, monkeypatch):
    monkeypatch.setattr(session, "_PATHS", {})
    monkeypatch.setattr(session, "_DATABASES", {})
    path, staging = scratch_path(spark, "gone"), Staging(spark)
    spark.range(3).write.parquet(path)
    staging.write(spark.range(3).toDF("x"), "rows")
    assert session.drop_scratch(spark) == 2 and session.drop_scratch(spark) == 0
    assert not Path(path.removeprefix("file:")).exists() and not spark.catalog.databaseExists(staging.database)


def test_shared_folder_falls_back_on_a_local_master_only():
    local = Session(**{"spark.master": "local[4]"})
    assert shared_folder(local) == shared_folder(local)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session(**{"spark.master": "yarn"}))
