"""Every operator as a query over the driver tables.

Amounts leave as DOUBLE and days as text, so that both engines agree on types.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from faresettle.catalog.bindings import all_days, dom_int_stand_in, driver_table, settlement_sources
from faresettle.catalog.sql import DAY_IN_NEXT_WEEK, MONTH
from faresettle.functions.values import iso_date, iso_text
from faresettle.functions.windows import (
    DateWindow,
    override_columns,
    previous_month_columns,
    wed_tue_week,
    wed_tue_week_columns,
    window_key_column,
)
from faresettle.operators import details, export, facts, parameters, quality, roster, tables
from faresettle.operators.landing import LandedDetails
from faresettle.operators.setops import union_all
from faresettle.plans import backfill, jobs, models, settlement
from faresettle.plans.contract import MEASURES, MONEY, REPORT_COLUMNS, REPORT_SCHEMA
from faresettle.session import Staging, scratch_path
from faresettle.sources import files, payloads
from faresettle.streaming import drops

Query = Callable[[SparkSession, str], DataFrame]

MONTH_WINDOW = DateWindow.of(*MONTH)

_REGISTRY: dict[str, Query] = {}


def query(run: Query) -> Query:
    _REGISTRY[run.__name__] = run
    return run


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def _doubles(df: DataFrame, *columns: str) -> DataFrame:
    kept = [f"CAST({c} AS DOUBLE) AS {c}" if c in columns else f"`{c}`" for c in df.columns]
    return df.selectExpr(*kept)


def _plain(report: DataFrame) -> DataFrame:
    return _doubles(report.select(*REPORT_COLUMNS), *MEASURES)


def _report(
    spark: SparkSession, sf_dir: str, window: DateWindow | None = None, two_rows: bool = False, credit_only: bool = False, **options
) -> DataFrame:
    """The report of a window, by default of all days that have orders."""
    sources = settlement_sources(spark, sf_dir, two_rows, credit_only)
    window = window or all_days(spark, sf_dir)
    return settlement.settlement_report(sources, window, dom_int_stand_in(spark, sf_dir), **options)


def scratch_table(spark: SparkSession, schema: StructType | None = None, partition_by: tuple[str, ...] = (tables.PARTITION_COLUMN,)) -> str:
    """A new managed table of report rows in the shared folder. It stays there,
    since a query hands back a frame that still has to read it."""
    table = f"{Staging(spark).database}.sales"
    if schema is not None:
        tables.create_table(spark, table, schema, partition_by)
    return table


# The report


@query
def settlement_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settlement.in_report_order(_plain(_report(spark, sf_dir)))


@query
def settlement_report_credit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments of customers in debit have no issue and vanish."""
    return _plain(_report(spark, sf_dir, credit_only=True))


@query
def settlement_report_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_report(spark, sf_dir, MONTH_WINDOW))


@query
def settlement_report_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_report(spark, sf_dir, MONTH_WINDOW, staging=Staging(spark)))


def landed_sources(spark: SparkSession, sf_dir: str, buckets: int = 8) -> settlement.LandedSources:
    """The sources with their detail sums landed in two batches, the first of them twice, as by a rerun."""
    sources, database = settlement_sources(spark, sf_dir), Staging(spark).database
    landed = []
    for parent, vat, tax in (("payt_sqnu", sources.payt_vatc, sources.payt_txca), ("rmbt_id", sources.rmbt_vatc, sources.rmbt_txca)):
        both = LandedDetails(spark, f"{database}.{parent}_vat", f"{database}.{parent}_tax", parent, buckets)
        for batch, small in (("small", True), ("small", True), ("large", False)):
            lines = details.Details(vat.filter((F.col("vatc") < 20) == small), tax.filter((F.coalesce("tmfa", F.lit(0)) < 20) == small), parent)
            both.land(lines, batch)
        landed.append(both)
    return settlement.LandedSources(*sources.__dict__.values(), *landed)


@query
def settlement_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The month's report from detail sums landed in buckets."""
    sources, rule = landed_sources(spark, sf_dir), dom_int_stand_in(spark, sf_dir)
    return _plain(settlement.settlement_report(sources, MONTH_WINDOW, rule, staging=Staging(spark)))


@query
def settlement_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reports of each month before and each week before a day with orders, from one job."""
    days = _as_of(spark, sf_dir).select("as_of").distinct()
    spans = [previous_month_columns(F.col("as_of")), wed_tue_week_columns(F.col("as_of"))]
    windows = union_all([days.select(start.alias("window_start"), end.alias("window_end")) for start, end in spans])
    sources, rule = settlement_sources(spark, sf_dir), dom_int_stand_in(spark, sf_dir)
    reports = backfill.settlement_backfill(sources, windows, rule, Staging(spark))
    return _doubles(reports.select("window_key", *REPORT_COLUMNS), *MEASURES)


@query
def settlement_sale(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = settlement_sources(spark, sf_dir)
    sales = settlement.sales(sources, all_days(spark, sf_dir))
    return _plain(settlement.shown(settlement.settle([sales], sources.para, dom_int_stand_in(spark, sf_dir)), distinct=False))


@query
def settlement_refund(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = settlement_sources(spark, sf_dir)
    refunds = settlement.refunds(sources, all_days(spark, sf_dir))
    return _plain(settlement.shown(settlement.settle([refunds], sources.para, dom_int_stand_in(spark, sf_dir)), distinct=False))


@query
def settlement_by_domint(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = _report(spark, sf_dir).groupBy("Type", "DomInt").agg(
        F.expr("sum(Fare) AS fare"), F.expr("sum(Net) AS net"), F.expr("count(1) AS `rows`")
    )
    return _doubles(totals, "fare", "net")


@query
def settlement_hidden_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_report(spark, sf_dir, two_rows=True, distinct=False))


@query
def settlement_collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    collapsed = settlement.collapsed_groups(
        settlement_sources(spark, sf_dir, two_rows=True), all_days(spark, sf_dir), dom_int_stand_in(spark, sf_dir)
    )
    return _doubles(collapsed.select("Type", "TrxDate", "Source", "DomInt", "FOP", "CCY", "Fare", "groups"), "Fare")


@query
def settlement_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a report read back from text, as another program could have written it."""
    return _doubles(quality.identity_summary(files.read_recent_csv(spark, _csv_drop(spark, _report(spark, sf_dir), sf_dir))), "total")


@query
def union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_report(spark, sf_dir, two_rows=True))


@query
def report_net_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doubles(settlement.net_total(_report(spark, sf_dir)), "net")


@query
def report_file_net_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the report that the weekly job has written, one file for all days."""
    sources, rule = settlement_sources(spark, sf_dir), dom_int_stand_in(spark, sf_dir)
    path = jobs.weekly_report(sources, all_days(spark, sf_dir), rule, scratch_path(spark, "net"))
    return _doubles(settlement.net_total(spark.read.parquet(path)), "net")


# Its parts


@query
def vat_by_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    vat = settlement_sources(spark, sf_dir).payt_vatc
    return _doubles(details.vat_by_parent(vat, "payt_sqnu"), "vatcf", "vatff", "vatcyr", "vatfyr")


@query
def yr_tax_by_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    tax = settlement_sources(spark, sf_dir).payt_txca
    return _doubles(details.yr_tax_by_parent(tax, "payt_sqnu"), "yr_tmfa", "yr_tmff")


def _emis_as_text(emis: DataFrame) -> DataFrame:
    return emis.select("tdnr", "srci", iso_text(F.col("dais")).alias("dais"))


@query
def filter_date_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    emis = settlement_sources(spark, sf_dir).emis
    return _emis_as_text(emis.filter(MONTH_WINDOW.contains(F.col("dais"))))


@query
def filter_date_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The window's bounds and the days as text, made dates before they are compared."""
    emis = _emis_as_text(settlement_sources(spark, sf_dir).emis)
    start, end = (iso_date(F.lit(bound)) for bound in MONTH)
    return emis.filter(iso_date(F.col("dais")).between(start, end))


@query
def join_parameter_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = settlement_sources(spark, sf_dir, two_rows=True)
    joined = parameters.join_parameter_row(sources.payt.select("sqnu", "fpam"), sources.para)
    return _doubles(joined, "fpam")


@query
def join_payment_issue(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = settlement_sources(spark, sf_dir, credit_only=True)
    joined = facts.join_payment_issue(sources.payt, sources.emis, all_days(spark, sf_dir))
    return _doubles(joined.select("tdnr", "fptp", "srci", iso_text(F.col("dais")).alias("dais"), "fpam"), "fpam")


@query
def join_vat_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = settlement_sources(spark, sf_dir)
    vat = details.vat_by_parent(sources.payt_vatc, "payt_sqnu")
    return _doubles(details.add_details(sources.payt.select("sqnu"), vat, "sqnu", "payt_sqnu"), *details.VAT_BUCKETS)


@query
def join_yr_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = settlement_sources(spark, sf_dir)
    tax = details.yr_tax_by_parent(sources.payt_txca, "payt_sqnu")
    return _doubles(details.add_details(sources.payt.select("sqnu"), tax, "sqnu", "payt_sqnu"), "yr_tmfa", "yr_tmff")


@query
def preview_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _emis_as_text(export.preview(settlement_sources(spark, sf_dir).emis, 2, "tdnr"))


# Dates and windows, for every order


def _as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return driver_table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("as_of"))


def _windows(as_of: DataFrame, window: tuple) -> DataFrame:
    start, end = window
    return as_of.select("o_orderkey", iso_text(start).alias("window_start"), iso_text(end).alias("window_end"))


@query
def fmt_trx_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_of(spark, sf_dir).select("o_orderkey", iso_text(F.col("as_of")).alias("TrxDate"))


@query
def window_prev_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(_as_of(spark, sf_dir), previous_month_columns(F.col("as_of")))


@query
def window_wed_tue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(_as_of(spark, sf_dir), wed_tue_week_columns(F.col("as_of")))


@query
def window_wed_tue_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(_as_of(spark, sf_dir), wed_tue_week_columns(F.col("as_of"), weeks_back=3))


@query
def window_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = previous_month_columns(F.col("as_of"))
    return _windows(_as_of(spark, sf_dir), override_columns(month, end=F.col("as_of")))


@query
def window_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = previous_month_columns(F.col("as_of"))
    return _as_of(spark, sf_dir).select("o_orderkey", window_key_column(*month).alias("window_key"))


# Files


@query
def src_parquet_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A foreign file: columns in another order, and one more."""
    root, window = scratch_path(spark, "parquet"), all_days(spark, sf_dir)
    foreign = _report(spark, sf_dir).select(F.lit("x").alias("Extra"), *reversed(REPORT_COLUMNS))
    export.write_parquet_window(foreign, root, jobs.FINAL_PREFIX, window)
    return _plain(files.read_parquet_window(spark, root, jobs.FINAL_PREFIX, window, REPORT_SCHEMA))


@query
def write_parquet_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written twice under one key: the second write replaces the first."""
    root, window = scratch_path(spark, "replaced"), all_days(spark, sf_dir)
    report = Staging(spark).write(_report(spark, sf_dir), "report")
    export.write_parquet_window(report.filter("Type = 'Sale'"), root, jobs.FINAL_PREFIX, window)
    path = export.write_parquet_window(report, root, jobs.FINAL_PREFIX, window)
    return _plain(spark.read.schema(REPORT_SCHEMA).parquet(path))


@query
def weekly_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    week = wed_tue_week(date.fromisoformat(DAY_IN_NEXT_WEEK))
    sources, rule = settlement_sources(spark, sf_dir), dom_int_stand_in(spark, sf_dir)
    report = spark.read.parquet(jobs.weekly_report(sources, week, rule, scratch_path(spark, "week")))
    return _plain(report.withColumn("TrxDate", iso_text(F.col("TrxDate"))))


def _csv_drop(spark: SparkSession, report: DataFrame, sf_dir: str, root: str | None = None) -> str:
    path = all_days(spark, sf_dir).path(root or scratch_path(spark, "drop"), jobs.RECENT_PREFIX, "csv")
    export.export_csv(report, path, sep=";")
    return path


def _spoiled(report: DataFrame) -> DataFrame:
    """The report as text, with a comma for the decimal point in the fares of the month's sales."""
    text = report.select([F.col(c).cast("string").alias(c) for c in REPORT_COLUMNS])
    bad = (F.col("Type") == "Sale") & MONTH_WINDOW.contains_text(F.col("TrxDate"))
    return text.withColumn("Fare", F.when(bad, F.translate("Fare", ".", ",")).otherwise(F.col("Fare")))


def _loaded_and_set_aside(loaded: DataFrame, bad: DataFrame) -> DataFrame:
    counts = [
        rows.groupBy("Type").agg(F.expr("count(1) AS `rows`")).selectExpr(f"'{outcome}' AS outcome", "Type", "`rows`")
        for outcome, rows in (("loaded", loaded), ("bad", bad))
    ]
    return union_all(counts)


@query
def src_csv_semicolon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(files.read_recent_csv(spark, _csv_drop(spark, _report(spark, sf_dir), sf_dir)))


@query
def export_users_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = driver_table(spark, sf_dir, "customer").select("*")
    path = scratch_path(spark, "users")
    export.export_csv(users, path)
    copied = files.read_csv_text(spark, path, users.schema, sep=",")
    return _doubles(copied, "c_acctbal")


# Tables


@query
def load_append_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A foreign file: columns in another order, and one more."""
    root, window = scratch_path(spark, "load"), all_days(spark, sf_dir)
    table = scratch_table(spark, REPORT_SCHEMA)
    foreign = _report(spark, sf_dir).select(*reversed(REPORT_COLUMNS), F.lit(1).alias("Extra"))
    export.write_parquet_window(foreign, root, jobs.FINAL_PREFIX, window)
    jobs.load_parquet(spark, window, root, table)
    return _plain(spark.table(table))


@query
def load_append_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "load")
    table = scratch_table(spark, REPORT_SCHEMA)
    _csv_drop(spark, _report(spark, sf_dir), sf_dir, root)
    jobs.weekly_recent(spark, all_days(spark, sf_dir), root, table, replace=False)
    return _plain(spark.table(table))


@query
def load_csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A drop with bad rows: the good ones load, the bad ones are set aside."""
    root, window = scratch_path(spark, "load"), all_days(spark, sf_dir)
    table = scratch_table(spark, REPORT_SCHEMA)
    _csv_drop(spark, _spoiled(_report(spark, sf_dir)), sf_dir, root)
    jobs.weekly_recent(spark, window, root, table, quarantine=f"{root}/bad")
    return _loaded_and_set_aside(spark.table(table), files.read_csv_text(spark, window.path(f"{root}/bad", jobs.RECENT_PREFIX, "csv")))


@query
def stream_recent_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded by two calls; the second finds nothing new."""
    table = scratch_table(spark)
    drops.create_drop_table(spark, table)
    path = _csv_drop(spark, _report(spark, sf_dir), sf_dir)
    checkpoint = scratch_path(spark, "progress")
    drops.load_new_drops(spark, path, table, checkpoint)
    drops.load_new_drops(spark, path, table, checkpoint)
    return _plain(spark.table(table))


@query
def delete_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = scratch_table(spark, REPORT_SCHEMA)
    tables.append(_report(spark, sf_dir), table)
    tables.delete_range(spark, [table], MONTH_WINDOW)
    return _plain(spark.table(table))


@query
def window_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table whose window holds stale amounts, replaced by the right ones."""
    table = scratch_table(spark, REPORT_SCHEMA)
    report = _report(spark, sf_dir)
    stale = F.when(MONTH_WINDOW.contains_text(F.col("TrxDate")), F.col("Fare") + 1).otherwise(F.col("Fare"))
    tables.append(report.withColumn("Fare", stale), table)
    tables.window_replace(_report(spark, sf_dir, MONTH_WINDOW), table, MONTH_WINDOW)
    return _plain(spark.table(table))


@query
def window_replace_external(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An external table; the new batch lacks the days of the month's second half, which go with their files."""
    path = scratch_path(spark, "external")
    table = scratch_table(spark)
    _report(spark, sf_dir).write.partitionBy("TrxDate").option("path", path).saveAsTable(table)
    first_half = _report(spark, sf_dir, DateWindow.of(MONTH[0], MONTH[0][:8] + "15"))
    tables.window_replace(first_half, table, MONTH_WINDOW)
    return _plain(spark.read.schema(REPORT_SCHEMA).parquet(path))


ROW_LAYOUTS = {"plain": (), "by_source": ("Source",)}


def _layouts(spark: SparkSession, by_layout: dict[str, str]) -> DataFrame:
    return union_all([_plain(spark.table(table)).withColumn("layout", F.lit(name)) for name, table in by_layout.items()])


@query
def delete_range_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables without partitions and with others than days: the month's rows go, file by file."""
    by_layout = {name: scratch_table(spark, REPORT_SCHEMA, columns) for name, columns in ROW_LAYOUTS.items()}
    report = Staging(spark).write(_report(spark, sf_dir), "report")
    for table in by_layout.values():
        tables.append(report, table)
    tables.delete_range(spark, list(by_layout.values()), MONTH_WINDOW)
    return _layouts(spark, by_layout)


@query
def window_replace_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stale amounts in tables without partitions and with others than days, replaced by the right ones."""
    by_layout = {name: scratch_table(spark, REPORT_SCHEMA, columns) for name, columns in ROW_LAYOUTS.items()}
    report = Staging(spark).write(_report(spark, sf_dir), "report")
    inside = MONTH_WINDOW.contains_text(F.col("TrxDate"))
    stale = F.when(inside, F.col("Fare") + 1).otherwise(F.col("Fare"))
    for table in by_layout.values():
        tables.append(report.withColumn("Fare", stale), table)
        tables.window_replace(report.filter(inside), table, MONTH_WINDOW)
    return _layouts(spark, by_layout)


@query
def window_replace_switched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two windows published by switching folders: stale amounts first, then the right ones for the month's first half."""
    table = scratch_table(spark, REPORT_SCHEMA)
    report = Staging(spark).write(_report(spark, sf_dir), "report")
    inside = MONTH_WINDOW.contains_text(F.col("TrxDate"))
    tables.append(report, table)
    tables.window_replace(report.filter(inside).withColumn("Fare", F.col("Fare") + 1), table, MONTH_WINDOW, publish=tables.SWITCH)
    first_half = inside & (F.col("TrxDate") <= MONTH[0][:8] + "15")
    tables.window_replace(report.filter(first_half), table, MONTH_WINDOW, publish=tables.SWITCH)
    return _plain(spark.table(table))


@query
def dq_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of the month before a table of its other days: the good one loads, the bad one is refused with what it failed."""
    report = Staging(spark).write(_report(spark, sf_dir), "report")
    inside = MONTH_WINDOW.contains_text(F.col("TrxDate"))
    good, sale = report.filter(inside), F.col("Type") == "Sale"
    bad = good.withColumn("Net", F.when(sale, F.col("Net") + 1).otherwise(F.col("Net")))
    bad = bad.withColumn("Type", F.when(sale | (F.col("FOP") != "1-URGENT"), F.col("Type")))
    frames = []
    for name, batch in (("good", good), ("bad", bad)):
        table, found = scratch_table(spark, REPORT_SCHEMA), {}
        tables.append(report.filter(~inside), table)
        try:
            tables.window_replace(batch, table, MONTH_WINDOW, gate=quality.report_gate())
        except quality.DataTestFailed as failed:
            found = failed.found
        frames.append(spark.table(table).agg(F.count(F.lit(1)).alias("n")).selectExpr(f"'{name}' AS batch", "'loaded' AS test", "n"))
        frames += [spark.sql(f"SELECT '{name}' AS batch, '{test}' AS test, {n}L AS n") for test, n in found.items()]
    return union_all(frames)


def _per_day(spark: SparkSession, final: str, recent: str) -> DataFrame:
    frames = [
        spark.table(table)
        .groupBy("TrxDate")
        .agg(F.expr("count(1) AS `rows`"), F.expr("CAST(sum(Net_COA) AS DOUBLE) AS net"))
        .selectExpr(f"'{name}' AS `table`", "TrxDate", "`rows`", "net")
        for name, table in (("final", final), ("recent", recent))
    ]
    return union_all(frames)


@query
def promote_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stale final rows and preliminary rows, both put right for the month."""
    final, recent = scratch_table(spark, REPORT_SCHEMA), scratch_table(spark, REPORT_SCHEMA)
    month = Staging(spark).write(_report(spark, sf_dir, MONTH_WINDOW), "month")
    tables.append(month.withColumn("Net_COA", F.col("Net_COA") + 1), final)
    tables.append(_report(spark, sf_dir), recent)
    tables.promote_final(month, final, recent, MONTH_WINDOW)
    return _per_day(spark, final, recent)


@query
def monthly_settlement(spark: SparkSession, sf_dir: str) -> DataFrame:
    final, recent = scratch_table(spark, REPORT_SCHEMA), scratch_table(spark, REPORT_SCHEMA)
    sources, rule = settlement_sources(spark, sf_dir), dom_int_stand_in(spark, sf_dir)
    tables.append(_report(spark, sf_dir), recent)
    jobs.monthly_settlement(sources, MONTH_WINDOW, rule, scratch_path(spark, "month"), final, recent)
    return _per_day(spark, final, recent)


# Models


@query
def recent_sale(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = driver_table(spark, sf_dir, "orders")
    sales = orders.select(F.col("o_orderdate").cast("date").alias("date"), F.col("o_totalprice").cast(MONEY).alias("amt"))
    days = models.recent_sale(sales)
    return days.select(iso_text(F.col("date")).alias("date"), "cnt", F.col("total_sales").cast("double").alias("total_sales"))


@query
def src_literal_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = union_all([spark.sql(f"SELECT '{flag}' AS l_returnflag, '{code}' AS vat_type") for flag, code in
                       (("A", "FA"), ("N", "TA"), ("R", "ZZ"))])
    lines = driver_table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.expr("count(1) AS lines"))
    return lines.join(codes, "l_returnflag").select("vat_type", "lines")


def _ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_all([
        driver_table(spark, sf_dir, "orders").selectExpr("o_orderkey AS id"),
        driver_table(spark, sf_dir, "customer").selectExpr("c_custkey AS id"),
    ])


def _first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.materialize(models.first_model(_ids(spark, sf_dir)), scratch_table(spark), "table")


def _second(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"second_{uuid.uuid4().hex}"
    return models.materialize(models.second_model(_first(spark, sf_dir)), name, "view")


@query
def model_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _first(spark, sf_dir)


@query
def model_first_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The starter model over ids some of which are null, which it leaves out."""
    ids = _ids(spark, sf_dir).select(F.nullif(F.col("id") % 5, F.lit(0)).alias("id"))
    return models.materialize(models.first_model(ids, drop_null_ids=True), scratch_table(spark), "table")


@query
def model_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _second(spark, sf_dir)


@query
def model_second_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second model as a view of the catalog, read from another session."""
    first = scratch_table(spark)
    models.materialize(models.first_model(_ids(spark, sf_dir)), first, "table")
    second = models.SqlModel(f"{first}_second", "SELECT id FROM {first} WHERE id = 2", {"first": first})
    models.keep_models(spark, [second])
    return spark.newSession().table(second.name)


@query
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.not_unique(_ids(spark, sf_dir), "id")


@query
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.is_null(settlement_sources(spark, sf_dir).payt, "cort_spam").select("sqnu")


@query
def dq_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = models.first_model(_ids(spark, sf_dir))
    return quality.failing_models({"first": first, "second": models.second_model(first)})


# Rosters


def _payloads(spark: SparkSession, sf_dir: str, usable: bool = False) -> DataFrame:
    """One payload per customer; large accounts list a guest that the number leaves out. Unless ``usable``,
    customers in debit have none and furniture payloads are cut short."""
    person = "named_struct('craft', c_mktsegment, 'name', c_name)"
    guest = "named_struct('craft', concat('NATION_', c_nationkey), 'name', 'Guest')"
    people = f"if(c_acctbal > 5000, array({person}, {guest}), array({person}))"
    payload = f"to_json(named_struct('number', 1, 'people', {people}))"
    if usable:
        return driver_table(spark, sf_dir, "customer").selectExpr("c_custkey", f"{payload} AS payload")
    return driver_table(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        f"CASE WHEN c_acctbal < 0 THEN NULL WHEN c_mktsegment = 'FURNITURE' THEN left({payload}, 20)"
        f" ELSE {payload} END AS payload",
    )


def _roster_facts(rosters: DataFrame) -> DataFrame:
    return rosters.selectExpr(
        "c_custkey", "CAST(number AS DOUBLE) AS number", "CAST(size(people) AS DOUBLE) AS listed", "people[0].name AS first_name"
    )


@query
def src_json_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _roster_facts(payloads.read_rosters(_payloads(spark, sf_dir, usable=True), fallback=False))


@query
def src_json_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed documents, one for the customers of each nation; and a folder where nothing has landed."""
    people = "sort_array(collect_list(named_struct('craft', c_mktsegment, 'name', c_name)))"
    customers = driver_table(spark, sf_dir, "customer")
    documents = customers.groupBy("c_nationkey").agg(F.expr(f"to_json(named_struct('number', count(1), 'people', {people})) AS value"))
    landed, nothing = scratch_path(spark, "landed"), scratch_path(spark, "nothing")
    documents.write.partitionBy("c_nationkey").text(landed)
    customers.select("c_name").limit(0).write.text(nothing)
    frames = [
        payloads.read_roster_files(spark, path).selectExpr(f"'{folder}' AS folder", "CAST(number AS DOUBLE) AS number", "explode(people) AS person")
        for folder, path in (("landed", f"{landed}/*"), ("nothing", nothing))
    ]
    return union_all(frames).selectExpr("folder", "number", "person.craft", "person.name")


@query
def src_json_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _roster_facts(payloads.read_rosters(_payloads(spark, sf_dir)))


def _drifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads whose form differs from customer to customer: unknown fields, missing ones, others of another type."""
    person = "named_struct('craft', c_mktsegment, 'name', c_name)"
    forms = [
        f"to_json(named_struct('number', 1, 'people', array(named_struct('craft', c_mktsegment, 'name', c_name, 'seat', c_nationkey)),"
        " 'station', named_struct('id', c_custkey)))",
        f"to_json(named_struct('number', 1, 'people', array({person})))",
        f"to_json(named_struct('number', '1', 'people', array({person})))",
        f"to_json(named_struct('people', array({person})))",
        f"to_json(named_struct('number', 1, 'people', {person}))",
        "to_json(named_struct('number', 1, 'people', array(named_struct('craft', c_mktsegment))))",
        f"left(to_json(named_struct('number', 1, 'people', array({person}))), 20)",
        "CAST(NULL AS STRING)",
    ]
    cases = " ".join(f"WHEN {k} THEN {form}" for k, form in enumerate(forms))
    return driver_table(spark, sf_dir, "customer").selectExpr("c_custkey", f"CASE c_custkey % {len(forms)} {cases} END AS payload")


@query
def src_json_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drifting payloads: unknown fields survive, unusable payloads come back from the quarantine with the reason."""
    good, bad = payloads.split_rosters(_drifted(spark, sf_dir))
    path = scratch_path(spark, "rosters-bad")
    payloads.quarantine_rosters(bad, path)
    usable = good.selectExpr(
        "c_custkey", "'ok' AS outcome", "CAST(number AS DOUBLE) AS number", "people[0].name AS name",
        "element_at(extra, 'station') AS station", "element_at(people[0].extra, 'seat') AS seat",
    )
    unusable = spark.read.parquet(path).selectExpr(
        "c_custkey", "reason AS outcome", "CAST(NULL AS DOUBLE) AS number", "CAST(NULL AS STRING) AS name",
        "CAST(NULL AS STRING) AS station", "CAST(NULL AS STRING) AS seat",
    )
    return union_all([usable, unusable])


@query
def roster_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roster.explode_people(payloads.read_rosters(_payloads(spark, sf_dir, usable=True), fallback=False), "c_custkey")


@query
def roster_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = roster.explode_people(payloads.read_rosters(_payloads(spark, sf_dir)), "c_custkey")
    return roster.roster_lines(people).select("c_custkey", "line")


@query
def roster_count_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    mismatches = quality.count_mismatch(payloads.read_rosters(_payloads(spark, sf_dir)))
    return mismatches.select("c_custkey", "number", "listed")
