"""Sales and refunds brought to one shape: keys, ticket, 16 amounts in whole numbers, copies."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from faresettle.functions.windows import DateWindow
from faresettle.operators.details import null_safe_sums
from faresettle.operators.sums import in_parts
from faresettle.plans.contract import AMOUNTS, BASE_MEASURES


def amount_columns(branch: str) -> dict[str, str]:
    """Report amount -> source column, for ``branch`` ``sale`` or ``refund``."""
    pairs = [(m, getattr(m, branch)) for m in BASE_MEASURES]
    inputs = [tx for _, (tx, _) in pairs] + [coa for _, (_, coa) in pairs]
    return dict(zip(AMOUNTS, inputs))


def header_columns(branch: str) -> list[str]:
    """The amounts that the payment or refund row itself carries."""
    return sorted({column for m in BASE_MEASURES if not m.from_details for column in getattr(m, branch)})


def amount_parts(rows: DataFrame, branch: str) -> dict[str, str]:
    """The branch's amounts in whole numbers, column -> expression over ``rows``; plain amounts where they are too wide."""
    from_details = frozenset(column for m in BASE_MEASURES if m.from_details for column in getattr(m, branch))
    return in_parts(rows, amount_columns(branch), from_details)


def issued_in_window(emis: DataFrame, window: DateWindow) -> DataFrame:
    return emis.filter(window.contains(F.col("dais"))).select("tdnr")


def payments_in_window(payt: DataFrame, emis: DataFrame, window: DateWindow) -> DataFrame:
    """Payments whose ticket was issued in the window, each once.

    A payment has no date of its own, so this is what shrinks the payment table
    before its rows meet anything else.
    """
    return payments_of(payt, issued_in_window(emis, window))


def payments_of(payt: DataFrame, issued: DataFrame) -> DataFrame:
    """Payments whose ticket is among the issued ones, each once."""
    columns = ["sqnu", "tdnr", "peri", "fptp", "cuop", *header_columns("sale")]
    return payt.select(*columns).join(issued.select("tdnr"), "tdnr", "left_semi")


def refunds_in_window(rmbt: DataFrame, window: DateWindow) -> DataFrame:
    columns = ["sqnu", "utnr", "peri", "daut", "srci", "fptp", "cutp", *header_columns("refund")]
    return rmbt.filter(window.contains(F.col("daut"))).select(*columns)


def issues_by_ticket(emis: DataFrame, window: DateWindow) -> DataFrame:
    """In-window issues, with equal ones counted rather than repeated."""
    return (
        emis.filter(window.contains(F.col("dais")))
        .groupBy("tdnr", "srci", "dais")
        .agg(F.count(F.lit(1)).alias("copies"))
    )


def sale_fact(payments: DataFrame, issues: DataFrame) -> DataFrame:
    """Join payments, with their detail sums, to issues by ticket.

    Both sides are first summed to the columns the report groups by, so a ticket
    with very many payments and issues yields no more rows than report groups.
    Amounts are in whole numbers (``sums``), as are those of refunds.
    """
    parts = amount_parts(payments, "sale")
    payments = payments.groupBy("tdnr", "peri", "fptp", "cuop").agg(*null_safe_sums(parts))
    return payments.join(issues, "tdnr").selectExpr(
        "'Sale' AS Type",
        "srci AS Source",
        "peri AS RptPeriod",
        "dais AS trx_day",
        "fptp AS FOP",
        "cuop AS CCY",
        "tdnr AS ticket",
        *parts,
        "copies",
    )


def refund_fact(refunds: DataFrame) -> DataFrame:
    """Refunds with their detail sums."""
    return refunds.selectExpr(
        "'Refund' AS Type",
        "srci AS Source",
        "peri AS RptPeriod",
        "daut AS trx_day",
        "fptp AS FOP",
        "cutp AS CCY",
        "utnr AS ticket",
        *[f"{part} AS {name}" for name, part in amount_parts(refunds, "refund").items()],
        "1L AS copies",
    )


def join_payment_issue(payt: DataFrame, emis: DataFrame, window: DateWindow) -> DataFrame:
    """The row-level join: payments without an issue in the window vanish."""
    return payt.join(emis.filter(window.contains(F.col("dais"))), "tdnr")
