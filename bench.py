"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR   folder of the driver tables   (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores                   (default 8)
    BENCH_RUNS     timed runs after one warm-up  (default 5)
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable
from dataclasses import fields, replace

from pyspark.sql import DataFrame, SparkSession

from faresettle.catalog import bindings
from faresettle.catalog.queries import MONTH_WINDOW as MONTH
from faresettle.functions.windows import DateWindow
from faresettle.operators import details, tables
from faresettle.operators.classify import TicketCountryRule
from faresettle.operators.facts import amount_columns
from faresettle.operators.landing import LandedDetails
from faresettle.plans import models, settlement
from faresettle.plans.backfill import settlement_backfill
from faresettle.plans.contract import IDENTITIES, REPORT_SCHEMA
from faresettle.session import Staging, local_session

YEAR = DateWindow.of("1998-01-01", "1998-12-31")


def run_all(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def landed(sources: settlement.SettlementSources, lake: Staging) -> settlement.SettlementSources:
    """The source tables as they would lie in a lake: own files, decimal amounts."""
    return replace(sources, **{
        field.name: lake.write(getattr(sources, field.name).repartition(8), field.name) for field in fields(sources)
    })


def plain_sql(sources: settlement.SettlementSources, tickets: DataFrame, window: DateWindow) -> str:
    """The report as one would write it by hand: two branches, each with its own joins and grouping, and UNION."""
    for name, frame in [(f.name, getattr(sources, f.name)) for f in fields(sources)] + [("tickets", tickets)]:
        frame.createOrReplaceTempView(name)
    start, end = window.iso

    def branch(kind: str, header: str, parent: str, joins: str, day: str, source: str, currency: str, ticket: str) -> str:
        sign = "-" if kind == "Refund" else ""
        amounts = amount_columns("refund" if kind == "Refund" else "sale")
        sums = ", ".join(f"{sign}sum(coalesce({column}, 0)) AS {name}" for name, column in amounts.items())
        tests = ", ".join(f"sum(CASE WHEN {test} THEN {amount} ELSE 0 END) AS {name}" for name, (test, amount) in details.VAT_BUCKETS.items())
        return f"""
        SELECT '{kind}' AS Type, {source} AS Source, h.peri AS RptPeriod, date_format({day}, 'yyyy-MM-dd') AS TrxDate,
               CASE WHEN t.country = p.isoc THEN 'D' ELSE 'I' END AS DomInt, h.fptp AS FOP, {currency} AS CCY, p.cutp AS COA, {sums}
        FROM (SELECT * FROM {header}) h {joins}
        LEFT JOIN (SELECT {parent}, {tests} FROM {header}_vatc GROUP BY {parent}) v ON v.{parent} = h.sqnu
        LEFT JOIN (SELECT {parent}, sum(coalesce(tmfa, 0)) AS yr_tmfa, sum(coalesce(tmff, 0)) AS yr_tmff
                   FROM {header}_txca WHERE tmft = 'YR' GROUP BY {parent}) y ON y.{parent} = h.sqnu
        LEFT JOIN tickets t ON t.ticket = h.{ticket} LEFT JOIN para p ON true
        WHERE {day} BETWEEN DATE '{start}' AND DATE '{end}'
        GROUP BY {source}, h.peri, {day}, t.country = p.isoc, h.fptp, {currency}, p.isoc, p.cutp"""

    sale = branch("Sale", "payt", "payt_sqnu", "JOIN emis e ON e.tdnr = h.tdnr", "e.dais", "e.srci", "h.cuop", "tdnr")
    refund = branch("Refund", "rmbt", "rmbt_id", "", "h.daut", "h.srci", "h.cutp", "utnr")
    derived = ", ".join(f"{settlement.signed_sum(terms)} AS {name}" for name, terms in IDENTITIES.items())
    return f"SELECT *, {derived} FROM ({sale} UNION {refund})"


def headline(spark: SparkSession, sf_dir: str, lake: Staging) -> dict[str, Callable[[], None]]:
    sources = landed(bindings.settlement_sources(spark, sf_dir), lake)
    rule = TicketCountryRule(lake.write(bindings.dom_int_stand_in(spark, sf_dir).tickets, "tickets"))
    sales = bindings.driver_table(spark, sf_dir, "orders").selectExpr(
        "CAST(o_orderdate AS DATE) AS date", "CAST(o_totalprice AS DECIMAL(18,2)) AS amt"
    )

    def report(window: DateWindow, staging: Staging | None = None) -> DataFrame:
        return settlement.settlement_report(sources, window, rule, staging=staging)

    def staged_report(window: DateWindow) -> None:
        with Staging(spark) as staging:
            run_all(report(window, staging))

    all_days = bindings.all_days(spark, sf_dir)
    table = f"{lake.database}.sales"
    tables.create_table(spark, table, REPORT_SCHEMA)
    tables.append(report(all_days), table)
    month = lake.write(report(MONTH), "month")
    unpartitioned = f"{lake.database}.sales_rows"
    tables.create_table(spark, unpartitioned, REPORT_SCHEMA, ())
    tables.append(report(all_days), unpartitioned)
    details_of = (("payt_sqnu", sources.payt_vatc, sources.payt_txca), ("rmbt_id", sources.rmbt_vatc, sources.rmbt_txca))
    both = [LandedDetails(spark, f"{lake.database}.{parent}_vat", f"{lake.database}.{parent}_tax", parent, 8) for parent, _, _ in details_of]
    for kept, (parent, vat, tax) in zip(both, details_of):
        kept.land(details.Details(vat, tax, parent), "all")
    in_buckets = settlement.LandedSources(*sources.__dict__.values(), *both)
    months = spark.sql(
        "SELECT add_months(date'1996-08-01', CAST(id AS INT)) AS window_start, last_day(add_months(date'1996-08-01', CAST(id AS INT))) AS window_end FROM range(24)"
    )

    def landed_report() -> None:
        with Staging(spark) as staging:
            run_all(settlement.settlement_report(in_buckets, MONTH, rule, staging=staging))

    def backfilled() -> None:
        with Staging(spark) as staging:
            run_all(settlement_backfill(sources, months, rule, staging))

    return {
        "plain_sql_month": lambda: run_all(spark.sql(plain_sql(sources, rule.tickets, MONTH))),
        "plain_sql_all_years": lambda: run_all(spark.sql(plain_sql(sources, rule.tickets, all_days))),
        "settlement_report_month": lambda: run_all(report(MONTH)),
        "settlement_report_year": lambda: run_all(report(YEAR)),
        "settlement_report_all_years": lambda: run_all(report(all_days)),
        "settlement_report_month_staged": lambda: staged_report(MONTH),
        "settlement_report_year_staged": lambda: staged_report(YEAR),
        "vat_by_parent": lambda: run_all(details.vat_by_parent(sources.payt_vatc, "payt_sqnu")),
        "yr_tax_by_parent": lambda: run_all(details.yr_tax_by_parent(sources.payt_txca, "payt_sqnu")),
        "recent_sale": lambda: run_all(models.recent_sale(sales)),
        "window_replace_month": lambda: tables.window_replace(month, table, MONTH),
        "window_replace_month_switched": lambda: tables.window_replace(month, table, MONTH, publish=tables.SWITCH),
        "window_replace_month_rows": lambda: tables.window_replace(month, unpartitioned, MONTH),
        "settlement_report_month_landed": landed_report,
        "settlement_backfill_24_months": backfilled,
    }


def median_seconds(run: Callable[[], None], runs: int) -> float:
    run()
    times = []
    for _ in range(runs):
        started = time.perf_counter()
        run()
        times.append(time.perf_counter() - started)
    return round(statistics.median(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    with Staging(spark) as lake:
        seconds = {name: median_seconds(run, runs) for name, run in headline(spark, sf_dir, lake).items()}
    print(json.dumps({
        "metric": "sum of median query seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
