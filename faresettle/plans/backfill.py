"""The settlement reports of many windows from one job."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, functions as F

from faresettle.functions.values import iso_text
from faresettle.functions.windows import DateWindow, window_key_column
from faresettle.operators.classify import DomIntRule
from faresettle.plans.contract import REPORT_COLUMNS
from faresettle.plans.settlement import SettlementSources, settlement_report
from faresettle.session import Staging

# Days of a bin: a day lies in one, a window in as many as it touches.
BIN_DAYS = 32
# Days that windows may cover together and still be broadcast: a thousand years.
MOST_DAYS = 366_000


def _bin(day: Column, days: int) -> Column:
    return F.floor(F.unix_date(day) / days)


def in_windows(rows: DataFrame, day: str, windows: DataFrame, bin_days: int = BIN_DAYS) -> DataFrame:
    """Each row once per window that holds its ``day``; ``windows`` has ``window_start`` and ``window_end``, both inclusive.

    An interval join by bins: windows are repeated per bin they touch, rows are not repeated, and only rows and windows of a bin meet.
    Windows that end before they start, or have a null bound, hold nothing.
    """
    bins = F.sequence(_bin(F.col("window_start"), bin_days), _bin(F.col("window_end"), bin_days))
    touched = windows.filter("window_start <= window_end").withColumn("_bin", F.explode(bins))
    met = rows.withColumn("_bin", _bin(F.col(day), bin_days)).join(touched, "_bin")
    return met.filter(F.col(day).between(F.col("window_start"), F.col("window_end"))).drop("_bin")


def covered_days(windows: DataFrame) -> DataFrame:
    """Each day that lies in any window, as ``day``."""
    days = F.explode(F.sequence("window_start", "window_end"))
    return windows.filter("window_start <= window_end").select(days.alias("day")).distinct()


def settlement_backfill(
    sources: SettlementSources, windows: DataFrame, dom_int: DomIntRule, staging: Staging, *, distinct: bool = True
) -> DataFrame:
    """The report of every window, with its ``window_key``, ``window_start`` and ``window_end``; windows may overlap, equal ones count once.

    Every report group belongs to one day, and so do the rows that collapse, so each covered day is settled once and its rows then
    meet the windows that hold it. Each source is scanned once, whatever the number of windows; days that no window covers
    are dropped before anything is joined.
    """
    windows = windows.select("window_start", "window_end").filter("window_start <= window_end").distinct()
    bounds = windows.agg(F.min("window_start").alias("first"), F.max("window_end").alias("last")).first()
    if bounds["first"] is None:
        # No window: a report of no day, for its columns.
        none = settlement_report(sources, DateWindow.of("1900-01-01", "1900-01-01"), dom_int, distinct=distinct, date_as_text=False)
        return _keyed(in_windows(none, "TrxDate", windows))
    span = DateWindow.of(bounds["first"], bounds["last"])
    days = covered_days(windows)
    if (span.end - span.start).days < MOST_DAYS:
        days = F.broadcast(days)
    covered = replace(
        sources,
        emis=sources.emis.join(days, F.col("dais") == F.col("day"), "left_semi"),
        rmbt=sources.rmbt.join(days, F.col("daut") == F.col("day"), "left_semi"),
    )
    report = settlement_report(covered, span, dom_int, distinct=distinct, date_as_text=False, staging=staging)
    return _keyed(in_windows(report, "TrxDate", windows))


def _keyed(rows: DataFrame) -> DataFrame:
    key = window_key_column(F.col("window_start"), F.col("window_end"))
    text = {"TrxDate": iso_text(F.col("TrxDate")).alias("TrxDate")}
    return rows.select(key.alias("window_key"), "window_start", "window_end", *[text.get(c, c) for c in REPORT_COLUMNS])
