"""The settlement report: sales and refunds, 32 columns, per date window."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from faresettle.functions.values import ISO_DATE
from faresettle.functions.windows import DateWindow
from faresettle.operators.classify import DomIntRule
from faresettle.operators.details import Details
from faresettle.operators.facts import (
    issues_by_ticket,
    payments_in_window,
    payments_of,
    refund_fact,
    refunds_in_window,
    sale_fact,
)
from faresettle.operators.landing import LandedDetails
from faresettle.operators.parameters import attach_parameters
from faresettle.operators.setops import union_all
from faresettle.operators.sums import are_parts, part_names, whole_amounts
from faresettle.plans.contract import AMOUNTS, IDENTITIES, KEYS, MONEY_SUM, REPORT_COLUMNS
from faresettle.session import Staging, runtime_filter_for


@dataclass(frozen=True)
class SettlementSources:
    payt: DataFrame
    emis: DataFrame
    para: DataFrame
    payt_vatc: DataFrame
    payt_txca: DataFrame
    rmbt: DataFrame
    rmbt_vatc: DataFrame
    rmbt_txca: DataFrame

    def payment_details(self) -> Details | LandedDetails:
        return Details(self.payt_vatc, self.payt_txca, "payt_sqnu").lines()

    def refund_details(self) -> Details | LandedDetails:
        return Details(self.rmbt_vatc, self.rmbt_txca, "rmbt_id").lines()


@dataclass(frozen=True)
class LandedSources(SettlementSources):
    """Sources whose detail sums have been landed in buckets; these are read in place of the detail tables."""

    payt_landed: LandedDetails
    rmbt_landed: LandedDetails

    def payment_details(self) -> LandedDetails:
        return self.payt_landed

    def refund_details(self) -> LandedDetails:
        return self.rmbt_landed


def sales(sources: SettlementSources, window: DateWindow, staging: Staging | None = None) -> DataFrame:
    """With ``staging``, the window's issues are written once, and cut the payments as well as join them."""
    details = sources.payment_details()
    issues = issues_by_ticket(sources.emis, window)
    if not staging:
        return sale_fact(details.add_parts_to(payments_in_window(sources.payt, sources.emis, window), "sqnu"), issues)
    issues, count = staging.write_counted(keyed(issues, window), "issues")
    with runtime_filter_for(staging.spark, count):
        payments, count = staged_headers(payments_of(sources.payt, of_window(issues, window)), details, window, staging, "payments")
    return sale_fact(staged_details(payments, count, details, window, staging, "payments"), of_window(issues, window))


def refunds(sources: SettlementSources, window: DateWindow, staging: Staging | None = None) -> DataFrame:
    headers = refunds_in_window(sources.rmbt, window)
    details = sources.refund_details()
    if not staging:
        return refund_fact(details.add_parts_to(headers, "sqnu"))
    headers, count = staged_headers(headers, details, window, staging, "refunds")
    return refund_fact(staged_details(headers, count, details, window, staging, "refunds"))


def keyed(headers: DataFrame, window: DateWindow) -> DataFrame:
    return headers.withColumn("window_key", F.lit(window.key))


def of_window(headers: DataFrame, window: DateWindow) -> DataFrame:
    """Staged rows are read back by their window key: a predicate on that side is what lets Spark
    make a runtime filter of it."""
    return headers.filter(F.col("window_key") == window.key).drop("window_key")


def staged_headers(
    headers: DataFrame, details: Details | LandedDetails, window: DateWindow, staging: Staging, name: str
) -> tuple[DataFrame, int]:
    """Headers as staged, in the buckets of landed details if there are such, and how many they are."""
    buckets = (details.buckets, "sqnu") if isinstance(details, LandedDetails) else None
    return staging.write_counted(keyed(headers, window), name, buckets)


def staged_details(
    headers: DataFrame, count: int, details: Details | LandedDetails, window: DateWindow, staging: Staging, name: str
) -> DataFrame:
    """Staged headers with their detail sums, staged too.

    Landed sums are joined bucket by bucket. For plain detail tables the number of headers is known now, so the runtime
    filter that drops other parents' lines while they are scanned has the right size.
    """
    if isinstance(details, LandedDetails):
        return staging.write(with_details(headers, details, window), f"{name}_with_details")
    with runtime_filter_for(staging.spark, count):
        return staging.write(with_details(headers, details, window), f"{name}_with_details")


def with_details(headers: DataFrame, details: Details | LandedDetails, window: DateWindow) -> DataFrame:
    return details.add_parts_to(of_window(headers, window), "sqnu")


def window_tickets(staging: Staging) -> DataFrame:
    """Tickets of the staged issues and refunds: all that a label can be asked for."""
    issued, refunded = staging.read("issues").selectExpr("tdnr AS ticket"), staging.read("refunds").selectExpr("utnr AS ticket")
    return union_all([issued, refunded])


def settle(facts: list[DataFrame], para: DataFrame, dom_int: DomIntRule) -> DataFrame:
    """Sum facts of one or both types to report groups: keys and base sums.

    Facts are summed to all that a report row and its label depend on before the parameter rows are
    attached, so these meet sums and not facts. Amounts are summed in whole numbers and unweighted, by the number of equal issues,
    which then weights the sums. The result has ``isoc`` and the day itself, which
    the report groups by but does not show.
    """
    parts = all(are_parts(fact, AMOUNTS) for fact in facts)
    names = part_names(AMOUNTS) if parts else AMOUNTS
    rows = dom_int.prepare(union_all(facts if parts else [whole_amounts(fact, AMOUNTS) for fact in facts]))
    keys = ("Type", "Source", "RptPeriod", "trx_day", "FOP", "CCY")
    sums = whole_amounts(rows.groupBy(*keys, *dom_int.inputs, "copies").agg(*[F.sum(name).alias(name) for name in names]), AMOUNTS)
    labelled = attach_parameters(sums, para).withColumn("DomInt", dom_int.label(F.col("ticket"), F.col("isoc")))
    copies = "(copies * coalesce(para_copies, 1))"
    return labelled.groupBy(*keys, "DomInt", "isoc", "cutp").agg(
        *[F.expr(f"{_weighted_sum(name, copies)} AS {name}") for name in AMOUNTS]
    )


def _weighted_sum(amount: str, copies: str) -> str:
    """Sum of an amount that counts once per equal issue or parameter row."""
    return f"sum(CASE WHEN {copies} = 1 THEN {amount} ELSE {amount} * {copies} END)"


def signed_sum(terms: dict[str, int]) -> str:
    return " ".join(f"{'+' if sign > 0 else '-'} {name}" for name, sign in terms.items()).removeprefix("+ ")


def settlement_report(
    sources: SettlementSources,
    window: DateWindow,
    dom_int: DomIntRule,
    *,
    distinct: bool = True,
    date_as_text: bool = True,
    staging: Staging | None = None,
) -> DataFrame:
    """The report of one window.

    With ``distinct``, groups that look the same collapse into one row, as under
    a SQL UNION; ``collapsed_groups`` shows what that loses.
    With ``staging``, the window's issues, payments and refunds are written there first, so that the detail
    tables and the label's lookup are reduced to the window while they are scanned, and each source is read once.
    """
    facts = [sales(sources, window, staging), refunds(sources, window, staging)]
    if staging:
        dom_int = dom_int.reduced_to(window_tickets(staging), staging)
    return shown(settle(facts, sources.para, dom_int), distinct, date_as_text)


def shown(groups: DataFrame, distinct: bool, date_as_text: bool = True) -> DataFrame:
    """Report rows of settled groups: refunds negated, measures derived.

    Derived measures follow from the rest of the row, so duplicates are removed
    before they widen it.
    """
    money = MONEY_SUM.simpleString()
    day = f"date_format(trx_day, '{ISO_DATE}')" if date_as_text else "trx_day"
    rows = groups.selectExpr(
        *[key for key in KEYS if key != "TrxDate"],
        f"{day} AS TrxDate",
        "cutp AS COA",
        *[f"CAST(coalesce(if(Type = 'Refund', -{name}, {name}), 0) AS {money}) AS {name}" for name in AMOUNTS],
    )
    rows = rows.distinct() if distinct else rows
    derived = {name: f"CAST({signed_sum(terms)} AS {money}) AS {name}" for name, terms in IDENTITIES.items()}
    return rows.selectExpr(*[derived.get(name, name) for name in REPORT_COLUMNS])


def collapsed_groups(sources: SettlementSources, window: DateWindow, dom_int: DomIntRule) -> DataFrame:
    """Report rows that stand for more than one group, with the group count."""
    report = settlement_report(sources, window, dom_int, distinct=False)
    return report.groupBy(*REPORT_COLUMNS).agg(F.count(F.lit(1)).alias("groups")).filter("groups > 1")


def in_report_order(report: DataFrame) -> DataFrame:
    """Sales before refunds. The other keys only break ties, so that the sort
    spreads over more tasks than there are types."""
    return report.orderBy(F.desc("Type"), "TrxDate", "Source", "RptPeriod", "FOP", "CCY", "DomInt")


def net_total(report: DataFrame) -> DataFrame:
    return report.agg(F.sum("DiscFareNetVAT_COA").alias("net"))
