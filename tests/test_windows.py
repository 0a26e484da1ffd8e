from datetime import date, datetime, timedelta

import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F

from faresettle.functions.windows import (
    DateWindow,
    override_columns,
    previous_month,
    previous_month_columns,
    wed_tue_week,
    wed_tue_week_columns,
    window_key_column,
)

DAYS = [date(2024, 1, 1) + timedelta(days=n) for n in range(731)]


@given(st.dates(date(1950, 1, 1), date(2100, 1, 1)))
def test_previous_month_is_the_month_before(as_of):
    window = previous_month(as_of)
    assert window.start.day == 1
    assert window.end + timedelta(days=1) == as_of.replace(day=1)


@given(st.dates(date(1950, 1, 1), date(2100, 1, 1)), st.integers(1, 10))
def test_week_runs_wednesday_to_tuesday(as_of, weeks_back):
    window = wed_tue_week(as_of, weeks_back)
    assert (window.start.weekday(), window.end.weekday()) == (2, 1)
    assert 0 <= (as_of - window.start).days - 7 * weeks_back <= 6


@pytest.mark.parametrize(
    ("as_of", "start"),
    [
        ("2025-09-22", "2025-09-10"),
        ("2025-09-23", "2025-09-10"),
        ("2025-09-24", "2025-09-17"),
        ("2025-09-28", "2025-09-17"),
        ("2025-09-29", "2025-09-17"),
    ],
)
def test_mondays_and_tuesdays_give_the_last_completed_week(as_of, start):
    assert wed_tue_week(date.fromisoformat(as_of)).start.isoformat() == start


def test_column_windows_agree_with_scalar_ones(spark):
    days = spark.createDataFrame([(d,) for d in DAYS], "d date")
    columns = [
        *previous_month_columns(F.col("d")),
        *wed_tue_week_columns(F.col("d")),
        *wed_tue_week_columns(F.col("d"), 4),
        window_key_column(*previous_month_columns(F.col("d"))),
    ]
    for row in days.select("d", *columns).collect():
        d = row[0]
        windows = (previous_month(d), wed_tue_week(d), wed_tue_week(d, 4))
        assert list(row[1:7]) == [bound for w in windows for bound in (w.start, w.end)]
        assert row[7] == previous_month(d).key


def test_override_and_key():
    window = previous_month(date(2025, 9, 6))
    assert window.key == "20250801_20250831"
    assert window.override(end="2025-08-15").iso == ("2025-08-01", "2025-08-15")
    assert window.path("/lake/", "sales/sales_refund", "parquet") == "/lake/sales/sales_refund_20250801_20250831.parquet"
    with pytest.raises(ValueError):
        window.override(end="2025-07-31")


def test_override_columns_reject_reversed_windows(spark):
    rows = spark.sql("SELECT date'2025-08-01' AS a, date'2025-07-01' AS b")
    start, _ = override_columns((F.col("a"), F.col("a")), end=F.col("b"))
    with pytest.raises(Exception, match="window starts after it ends"):
        rows.select(start).collect()


def test_window_ends_at_midnight(spark):
    window = DateWindow.of("2025-08-01", "2025-08-31")
    moments = spark.createDataFrame(
        [(datetime(2025, 8, 1),), (datetime(2025, 8, 31),), (datetime(2025, 8, 31, 10),), (None,)], "t timestamp"
    )
    assert moments.filter(window.contains(F.col("t"))).count() == 2
