"""VAT and tax detail lines, summed per parent before any join.

Summing first keeps details from multiplying the parent's own amounts, and the
map-side part of the sum keeps a parent with very many lines from landing whole
in one task.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F

from faresettle.operators.sums import fits, part_names, split, whole_amounts

# Codes of the detail lines that the report counts.
FARE_VAT = "FA"
TAX_VAT = "TA"
YR_MARK = "ITYR"
YR_TAX = "YR"

_IS_FARE_VAT = f"vat_type = '{FARE_VAT}'"
_IS_YR_VAT = f"vat_type = '{TAX_VAT}' AND instr(vat_type_deta, '{YR_MARK}') > 0"
VAT_BUCKETS = {
    "vatcf": (_IS_FARE_VAT, "vatc"),
    "vatff": (_IS_FARE_VAT, "vatf"),
    "vatcyr": (_IS_YR_VAT, "vatc"),
    "vatfyr": (_IS_YR_VAT, "vatf"),
}


@dataclass(frozen=True)
class Details:
    """The two detail tables of a header table, and their column naming it."""

    vat: DataFrame
    tax: DataFrame
    parent: str

    def lines(self) -> Details:
        """The lines that can count. Others would add zero, or join to nothing,
        so they need not leave the scan."""
        named = f"{self.parent} IS NOT NULL"
        vat = self.vat.filter(f"{named} AND vat_type IN ('{FARE_VAT}', '{TAX_VAT}') AND ({_IS_FARE_VAT} OR {_IS_YR_VAT})")
        return replace(self, vat=vat, tax=self.tax.filter(f"{named} AND tmft = '{YR_TAX}'"))

    def add_to(self, headers: DataFrame, key: str) -> DataFrame:
        """Left joins: headers without details stay, with null sums.

        Both sums are partitioned by the parent, so the second join reuses the
        partitioning of the first.
        """
        with_vat = add_details(headers, vat_by_parent(self.vat, self.parent), key, self.parent)
        return add_details(with_vat, yr_tax_by_parent(self.tax, self.parent), key, self.parent)

    def add_parts_to(self, headers: DataFrame, key: str) -> DataFrame:
        """``add_to`` with sums in whole numbers (``sums``), if the lines' amounts fit."""
        with_vat = add_details(headers, vat_parts(self.vat, self.parent), key, self.parent)
        return add_details(with_vat, yr_tax_parts(self.tax, self.parent), key, self.parent)


# Digits of a sum of amounts.
SUM_PRECISION = 28


def vat_by_parent(vat: DataFrame, parent: str) -> DataFrame:
    """Fare VAT and YR VAT per parent, in both currencies."""
    return whole_amounts(vat_parts(vat, parent), tuple(VAT_BUCKETS), SUM_PRECISION)


def vat_parts(vat: DataFrame, parent: str) -> DataFrame:
    """``vat_by_parent`` in whole numbers, if the amounts fit."""
    sums = {}
    for name, (test, amount) in VAT_BUCKETS.items():
        whole = fits(vat, amount)
        columns = zip(part_names((name,)), split(amount)) if whole else [(name, amount)]
        sums |= {column: f"sum(CASE WHEN {test} THEN {value} ELSE 0 END) AS {column}" for column, value in columns}
    return vat.groupBy(parent).agg(*map(F.expr, sums.values()))


YR_SUMS = {"yr_tmfa": "tmfa", "yr_tmff": "tmff"}


def yr_tax_by_parent(tax: DataFrame, parent: str) -> DataFrame:
    """YR tax per parent, in both currencies."""
    return whole_amounts(yr_tax_parts(tax, parent), tuple(YR_SUMS), SUM_PRECISION)


def yr_tax_parts(tax: DataFrame, parent: str) -> DataFrame:
    """``yr_tax_by_parent`` in whole numbers, if the amounts fit."""
    parts = {}
    for name, amount in YR_SUMS.items():
        parts |= dict(zip(part_names((name,)), split(amount))) if fits(tax, amount) else {name: amount}
    return tax.filter(f"tmft = '{YR_TAX}'").groupBy(parent).agg(*null_safe_sums(parts))


def add_details(headers: DataFrame, details: DataFrame, key: str, parent: str) -> DataFrame:
    return headers.join(details.withColumnRenamed(parent, key), key, "left")


def null_safe_sums(columns: dict[str, str]) -> list[Column]:
    return [F.expr(f"sum(coalesce({column}, 0)) AS {name}") for name, column in columns.items()]
