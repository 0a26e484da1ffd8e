"""Many windows from one job, and detail sums landed in buckets."""

import re
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from faresettle.catalog import bindings, queries
from faresettle.functions.windows import DateWindow, previous_month, wed_tue_week
from faresettle.operators.classify import TicketCountryRule
from faresettle.operators.details import Details
from faresettle.operators.landing import LandedDetails
from faresettle.plans import settlement
from faresettle.plans.backfill import in_windows, settlement_backfill
from faresettle.plans.contract import REPORT_COLUMNS
from faresettle.session import Staging, runtime_filter_for
from tests.test_plans import SF_DIR, every_scan_is_large, explained, filtered_columns, lake, without_broadcast  # noqa: F401

MONTHS = [previous_month(date(1997 + (7 + k) // 12, (7 + k) % 12 + 1, 3)) for k in range(24)]
WEEKS = [wed_tue_week(date(1998, 3, 1) + timedelta(days=7 * k)) for k in range(6)]


def frame(spark, windows):
    return spark.createDataFrame([(w.start, w.end) for w in windows], "window_start date, window_end date")


def rows(df):
    return Counter(tuple(r) for r in df.select(*REPORT_COLUMNS).collect())


def test_backfill_equals_single_window_reports(spark, lake):  # noqa: F811
    windows = [*MONTHS, *WEEKS, WEEKS[0], DateWindow.of("1998-03-05", "1998-03-05"), DateWindow.of("2030-01-01", "2030-02-01")]
    with Staging(spark) as staging:
        reports = settlement_backfill(lake[0], frame(spark, windows), lake[1], staging).cache()
        assert {r.window_key for r in reports.select("window_key").distinct().collect()} <= {w.key for w in windows}
        for window in (MONTHS[0], MONTHS[5], MONTHS[23], WEEKS[0], WEEKS[3], windows[-2], windows[-1]):
            single = settlement.settlement_report(lake[0], window, lake[1])
            assert rows(reports.filter(F.col("window_key") == window.key)) == rows(single)
        reports.unpersist()


def test_no_window_no_rows(spark, lake):  # noqa: F811
    backwards = spark.sql("SELECT date'2025-02-01' AS window_start, date'2025-01-01' AS window_end UNION ALL SELECT NULL, date'2025-01-01'")
    for windows in (backwards, backwards.limit(0)):
        with Staging(spark) as staging:
            report = settlement_backfill(lake[0], windows, lake[1], staging)
            assert report.columns == ["window_key", "window_start", "window_end", *REPORT_COLUMNS]
            assert report.collect() == []


class Recording(Staging):
    """Staging that keeps the plans it has run."""

    def __init__(self, spark, capsys):
        super().__init__(spark)
        self.plans, self.capsys = [], capsys

    def write(self, df, name, buckets=None):
        self.plans.append(explained(df, self.capsys))
        return super().write(df, name, buckets)


def test_backfill_reads_each_source_once(spark, lake, capsys):  # noqa: F811
    with Recording(spark, capsys) as staging:
        reports = settlement_backfill(lake[0], frame(spark, [*MONTHS, *WEEKS]), lake[1], staging)
        plans = "\n".join([*staging.plans, explained(reports, capsys)])
    for name in ("payt", "emis", "payt_vatc", "payt_txca", "rmbt", "rmbt_vatc", "rmbt_txca"):
        read = rf"Location: InMemoryFileIndex[^\n]*/{name}\]|Location: CatalogFileIndex[^\n]*/{name}\]"
        assert len(re.findall(read, plans)) == 1, name


@pytest.mark.parametrize("bin_days", [1, 7, 400])
def test_interval_join_equals_all_pairs(spark, bin_days):
    days = [date(2025, 1, 1) + timedelta(days=3 * k) for k in range(60)]
    windows = [(days[a], days[b]) for a, b in ((0, 59), (3, 3), (5, 20), (19, 40), (50, 10))] + [(date(1969, 12, 30), date(2025, 1, 4))]
    left = spark.createDataFrame([(d,) for d in [*days, None]], "day date")
    right = spark.createDataFrame(windows, "window_start date, window_end date")
    found = in_windows(left, "day", right, bin_days)
    expected = Counter((d, s, e) for d in days for s, e in windows if s <= d <= e)
    assert Counter((r.day, r.window_start, r.window_end) for r in found.collect()) == expected


# Landed detail sums


@pytest.fixture()
def landed(spark, lake):  # noqa: F811
    with Staging(spark) as staging:
        both = LandedDetails(spark, f"{staging.database}.vat", f"{staging.database}.tax", "payt_sqnu", 5)
        details = Details(lake[0].payt_vatc, lake[0].payt_txca, "payt_sqnu")
        half = [Details(details.vat.filter(c), details.tax.filter(c), "payt_sqnu") for c in ("payt_sqnu % 3 <> 0", "payt_sqnu % 3 = 0")]
        for batch, part in (("a", half[0]), ("b", half[1]), ("a", half[0])):
            both.land(part, batch)
        yield both, details


def test_landed_sums_equal_plain_ones(spark, lake, landed):  # noqa: F811
    both, details = landed
    headers = lake[0].payt.select("sqnu")
    plain = details.lines().add_to(headers, "sqnu")
    assert Counter(both.add_to(headers, "sqnu").select(plain.columns).collect()) == Counter(plain.collect())


def test_landed_details_and_bucketed_headers_meet_without_exchange(spark, lake, landed, without_broadcast, capsys):  # noqa: F811
    with Staging(spark) as staging:
        headers, count = settlement.staged_headers(lake[0].payt.select("sqnu"), landed[0], queries.MONTH_WINDOW, staging, "headers")
        assert count == lake[0].payt.count()
        plan = explained(settlement.with_details(headers, landed[0], queries.MONTH_WINDOW), capsys, "simple")
    assert plan.count("SortMergeJoin") == 2
    assert "Exchange" not in plan and "might_contain" not in plan
    assert plan.count("Bucketed: true") == 3


def test_a_parent_with_many_lines_lands_as_one_row(spark, landed):
    both = landed[0]
    vat = spark.range(50_000).selectExpr(
        "1L AS payt_sqnu", "'FA' AS vat_type", "'x' AS vat_type_deta", "CAST(1 AS DECIMAL(18,2)) AS vatc", "CAST(2 AS DECIMAL(18,2)) AS vatf"
    )
    tax = spark.range(10).selectExpr("1L AS payt_sqnu", "'YR' AS tmft", "CAST(1 AS DECIMAL(18,2)) AS tmfa", "CAST(NULL AS DECIMAL(18,2)) AS tmff")
    both.land(Details(vat, tax, "payt_sqnu"), "hot")
    assert [(r.vatcf, r.vatff) for r in spark.table(both.vat).filter("batch = 'hot'").collect()] == [(50_000, 100_000)]
    assert [(r.yr_tmfa, r.yr_tmff) for r in spark.table(both.tax).filter("batch = 'hot'").collect()] == [(10, 0)]


# The label's lookup


def test_lookup_is_cut_to_the_tickets_asked_for(spark, lake, without_broadcast, every_scan_is_large, capsys):  # noqa: F811
    """The staged lookup holds the window's tickets only, and a filter made of them cuts the scan before its shuffle."""
    rule = lake[1]
    with Staging(spark) as staging:
        asked = lake[0].rmbt.filter(queries.MONTH_WINDOW.contains(F.col("daut"))).selectExpr("utnr AS ticket")
        reduced = rule.reduced_to(asked, staging)
        wanted = {r.ticket for r in asked.collect()}
        assert 0 < len(wanted) < rule.tickets.count()
        assert {r.ticket for r in reduced.tickets.collect()} == wanted
        with runtime_filter_for(spark, len(wanted)):
            plan = explained(rule.of(staging.read("tickets_asked")), capsys, "simple")
        assert "ticket" in filtered_columns(plan)
        labels = {tuple(r) for r in rule.prepare(asked).collect()}
        assert {tuple(r) for r in reduced.prepare(asked).collect()} == labels


def test_lookup_with_repeats_nulls_and_strangers(spark):
    tickets = spark.createDataFrame([("a", "KR"), ("a", "DE"), (None, "FR"), ("b", None)], "ticket string, country string")
    asked = spark.createDataFrame([("a",), ("a",), ("b",), ("z",), (None,)], "ticket string")
    with Staging(spark) as staging:
        rule = TicketCountryRule(tickets)
        expected = Counter(rule.prepare(asked).collect())
        assert Counter(rule.reduced_to(asked, staging).prepare(asked).collect()) == expected
