"""The source tables, bound to the driver tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from faresettle.functions.windows import DateWindow
from faresettle.operators.classify import TicketCountryRule
from faresettle.plans.contract import MONEY
from faresettle.plans.settlement import SettlementSources


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _money(amount: Column) -> Column:
    return amount.cast(MONEY)


def _with_twins(**amounts: Column) -> list[Column]:
    """Each amount under its name, and twice the amount under its settlement name."""
    twins = {"fpam": "fpaf", "fptx": "fptf", "cpvl": "cpvf", "tmfa": "tmff", "vatc": "vatf",
             "cort_coam": "cort_coaf", "cort_spam": "cort_spaf"}
    columns = []
    for name, amount in amounts.items():
        columns += [_money(amount).alias(name), _money(_money(amount) * 2).alias(twins[name])]
    return columns


def _commissions() -> dict[str, Column]:
    key = F.col("o_orderkey")
    return {
        "cort_coam": key % 31,
        "cort_spam": F.nullif(key % 13, F.lit(0)),
        "vatc": key % 7,
    }


def payt(orders: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    return orders.filter("o_orderstatus <> 'F'").select(
        key.alias("sqnu"),
        key.alias("tdnr"),
        F.date_format("o_orderdate", "yyyyMM").alias("peri"),
        F.col("o_orderpriority").alias("fptp"),
        F.when(F.col("o_orderstatus") == "O", "KRW").otherwise("USD").alias("cuop"),
        *_with_twins(fpam=F.col("o_totalprice"), fptx=key % 97, **_commissions()),
    )


def emis(orders: DataFrame, customer: DataFrame, credit_only: bool = False) -> DataFrame:
    """Issues of all orders; with ``credit_only``, payments of customers in debit have none."""
    issuing = customer.filter("c_acctbal >= 0") if credit_only else customer
    return orders.join(issuing, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("tdnr"),
        F.col("c_mktsegment").alias("srci"),
        F.col("o_orderdate").cast("date").alias("dais"),
    )


def para(nation: DataFrame, two_rows: bool = False) -> DataFrame:
    """One parameter row; with ``two_rows``, two that differ in the country only."""
    if two_rows:
        return nation.filter("n_nationkey in (0, 1)").select(F.col("n_nationkey").alias("isoc"), F.lit("SET").alias("cutp"))
    return nation.filter("n_nationkey = 0").select(F.col("n_nationkey").alias("isoc"), F.col("n_name").alias("cutp"))


def vatc(lineitem: DataFrame, parent: str) -> DataFrame:
    return lineitem.select(
        F.col("l_orderkey").alias(parent),
        F.when(F.col("l_returnflag") == "A", "FA").when(F.col("l_returnflag") == "N", "TA").otherwise("ZZ").alias("vat_type"),
        F.when(F.col("l_linestatus") == "O", "K-ITYR-1").otherwise("OTHER").alias("vat_type_deta"),
        *_with_twins(vatc=F.col("l_quantity")),
    )


def txca(lineitem: DataFrame, parent: str) -> DataFrame:
    return lineitem.select(
        F.col("l_orderkey").alias(parent),
        F.when(F.col("l_linestatus") == "O", "YR").otherwise("XT").alias("tmft"),
        *_with_twins(tmfa=F.nullif(F.col("l_quantity"), F.lit(1.0))),
    )


def rmbt(orders: DataFrame, customer: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    refunds = orders.filter("o_orderstatus = 'F'").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return refunds.select(
        key.alias("sqnu"),
        key.alias("utnr"),
        F.date_format("o_orderdate", "yyyyMM").alias("peri"),
        F.col("o_orderdate").cast("date").alias("daut"),
        F.col("c_mktsegment").alias("srci"),
        F.col("o_orderpriority").alias("fptp"),
        F.lit("KRW").alias("cutp"),
        *_with_twins(cpvl=F.col("o_totalprice"), tmfa=key % 97, **_commissions()),
    )


def tickets(orders: DataFrame, customer: DataFrame) -> DataFrame:
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("ticket"), F.col("c_nationkey").alias("country")
    )


def all_days(spark: SparkSession, sf_dir: str) -> DateWindow:
    """The window from the first order's day to the last one's."""
    day = F.col("o_orderdate").cast("date")
    bounds = driver_table(spark, sf_dir, "orders").agg(F.min(day).alias("first"), F.max(day).alias("last")).first()
    return DateWindow.of(bounds["first"], bounds["last"])


def settlement_sources(spark: SparkSession, sf_dir: str, two_rows: bool = False, credit_only: bool = False) -> SettlementSources:
    orders, customer, lineitem, nation = (
        driver_table(spark, sf_dir, name) for name in ("orders", "customer", "lineitem", "nation")
    )
    return SettlementSources(
        payt=payt(orders),
        emis=emis(orders, customer, credit_only),
        para=para(nation, two_rows),
        payt_vatc=vatc(lineitem, "payt_sqnu"),
        payt_txca=txca(lineitem, "payt_sqnu"),
        rmbt=rmbt(orders, customer),
        rmbt_vatc=vatc(lineitem, "rmbt_id"),
        rmbt_txca=txca(lineitem, "rmbt_id"),
    )


def dom_int_stand_in(spark: SparkSession, sf_dir: str) -> TicketCountryRule:
    """Our stand-in for the label rule, which the source database owns: domestic
    when the customer's nation is the parameter row's."""
    return TicketCountryRule(tickets(driver_table(spark, sf_dir, "orders"), driver_table(spark, sf_dir, "customer")))
