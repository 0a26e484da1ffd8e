"""The scheduled jobs: monthly settlement, weekly drop, Parquet load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from faresettle.functions.windows import DateWindow
from faresettle.operators.classify import DomIntRule
from faresettle.operators.export import export_csv, write_parquet_window
from faresettle.operators.quality import Gate
from faresettle.operators.tables import OVERWRITE, append, delete_range, layout, publishing, replace_from_files, window_replace
from faresettle.plans.backfill import settlement_backfill
from faresettle.plans.contract import REPORT_SCHEMA
from faresettle.plans.settlement import SettlementSources, settlement_report
from faresettle.session import Staging
from faresettle.sources.files import read_csv_text, read_parquet_window, read_recent_csv, split_bad_rows

# The prefixes of window-named files.
FINAL_PREFIX = "sales/sales_refund"
RECENT_PREFIX = "sales/sales_recent"
TRIAL_PREFIX = "sales/sales_refund_test"
# Ours: where the reports of many windows lie, a folder for each.
BACKFILL_FOLDER = "sales/sales_refund_backfill"


def monthly_settlement(
    sources: SettlementSources,
    window: DateWindow,
    dom_int: DomIntRule,
    root: str,
    final: str,
    recent: str,
    gate: Gate | None = None,
    publish: str = OVERWRITE,
) -> str:
    """Write the window's Parquet, replace it in ``final``, retire it in ``recent``.

    The tables change only after the report has been written in full and, if there is a ``gate``, has passed its tests, which
    are counted by the job that writes it. Tables that have no windows are refused before anything is computed.
    """
    spark = sources.payt.sparkSession
    way = publishing(spark, final, publish)
    layout(spark, recent)
    gate = gate or Gate({})
    with Staging(spark) as staging:
        report, seen = gate.watched(settlement_report(sources, window, dom_int, staging=staging))
        path = write_parquet_window(report, root, FINAL_PREFIX, window)
    written = gate.require(seen, read_parquet_window(spark, root, FINAL_PREFIX, window, REPORT_SCHEMA))
    replace_from_files(written, final, window, publish, way)
    delete_range(spark, [recent], window)
    return path


def backfill_reports(
    sources: SettlementSources, windows: DataFrame, dom_int: DomIntRule, root: str
) -> str:
    """Write the reports of many windows from one job, a folder per window key, and return where they are."""
    path = f"{root.rstrip('/')}/{BACKFILL_FOLDER}"
    with Staging(sources.payt.sparkSession) as staging:
        reports = settlement_backfill(sources, windows, dom_int, staging).drop("window_start", "window_end")
        reports.hint("rebalance", "window_key").write.mode("overwrite").partitionBy("window_key").parquet(path)
    return path


def weekly_report(sources: SettlementSources, window: DateWindow, dom_int: DomIntRule, root: str) -> str:
    """Write the window's report with dates as dates, under a key of its own."""
    with Staging(sources.payt.sparkSession) as staging:
        report = settlement_report(sources, window, dom_int, date_as_text=False, staging=staging)
        return write_parquet_window(report, root, TRIAL_PREFIX, window)


def weekly_recent(
    spark: SparkSession, window: DateWindow, root: str, recent: str, replace: bool = True, quarantine: str | None = None
) -> None:
    """Load the window's drop. Plain append repeats its rows when run again.

    A bad row fails the load, unless ``quarantine`` names a folder for bad rows: each load writes its own
    there, as text, under the window's key, and replaces those of an earlier run.
    """
    path = window.path(root, RECENT_PREFIX, "csv")
    if quarantine is None:
        drop = read_recent_csv(spark, path)
    else:
        drop, bad = split_bad_rows(read_csv_text(spark, path))
        export_csv(bad, window.path(quarantine, RECENT_PREFIX, "csv"), sep=";")
    if replace:
        window_replace(drop, recent, window)
    else:
        append(drop, recent)


def load_parquet(spark: SparkSession, window: DateWindow, root: str, table: str) -> None:
    """Append the window's Parquet to a table, columns matched by name."""
    append(read_parquet_window(spark, root, FINAL_PREFIX, window), table)
