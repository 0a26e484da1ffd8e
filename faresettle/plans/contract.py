"""The 32-column settlement report as data: keys, measures, order, types."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import DecimalType, StringType, StructField, StructType

MONEY = DecimalType(18, 2)
MONEY_SUM = DecimalType(28, 2)


@dataclass(frozen=True)
class Measure:
    """One base sum in transaction and in settlement currency.

    ``sale`` and ``refund`` name the input columns of the two currencies.
    """

    name: str
    coa_name: str
    sale: tuple[str, str]
    refund: tuple[str, str]
    from_details: bool = False


# The report's column names and the source columns behind them.
BASE_MEASURES = (
    Measure("Fare", "Fare_COA", ("fpam", "fpaf"), ("cpvl", "cpvf")),
    Measure("StdCom", "StdCom_COA", ("cort_coam", "cort_coaf"), ("cort_coam", "cort_coaf")),
    Measure("SupplCom", "SupplCom_COA", ("cort_spam", "cort_spaf"), ("cort_spam", "cort_spaf")),
    Measure("VatCom", "VatCom_COA", ("vatc", "vatf"), ("vatc", "vatf")),
    Measure("Tax", "Tax_COA", ("fptx", "fptf"), ("tmfa", "tmff")),
    Measure("YR", "YR_COA", ("yr_tmfa", "yr_tmff"), ("yr_tmfa", "yr_tmff"), True),
    Measure("Vatf", "VatFare_COA", ("vatcf", "vatff"), ("vatcf", "vatff"), True),
    Measure("VatYR", "VatYR_COA", ("vatcyr", "vatfyr"), ("vatcyr", "vatfyr"), True),
)
DERIVED_MEASURES = {
    "TotalCom": {"StdCom": 1, "SupplCom": 1},
    "DiscFareNetVAT": {"Fare": 1, "SupplCom": -1, "Vatf": -1},
    "YRNetVAT": {"YR": 1, "VatYR": -1},
    "Net": {"Fare": 1, "Tax": 1, "StdCom": -1, "SupplCom": -1, "VatCom": -1},
}
KEYS = ("Type", "Source", "RptPeriod", "TrxDate", "DomInt", "FOP", "CCY")
MEASURE_ORDER = (
    "Fare", "StdCom", "SupplCom", "TotalCom", "VatCom", "Tax",
    "YR", "Vatf", "VatYR", "DiscFareNetVAT", "YRNetVAT", "Net",
)

_COA_NAMES = {m.name: m.coa_name for m in BASE_MEASURES}


def coa(name: str) -> str:
    """The settlement-currency twin of a measure's column name."""
    return _COA_NAMES.get(name, f"{name}_COA")


AMOUNTS = tuple(m.name for m in BASE_MEASURES) + tuple(m.coa_name for m in BASE_MEASURES)
IDENTITIES = {
    **DERIVED_MEASURES,
    **{coa(name): {coa(term): sign for term, sign in terms.items()} for name, terms in DERIVED_MEASURES.items()},
}
MEASURES = MEASURE_ORDER + tuple(coa(name) for name in MEASURE_ORDER)
REPORT_COLUMNS = KEYS + MEASURE_ORDER + ("COA",) + tuple(coa(name) for name in MEASURE_ORDER)

REPORT_SCHEMA = StructType(
    [StructField(name, MONEY_SUM if name in MEASURES else StringType()) for name in REPORT_COLUMNS]
)
