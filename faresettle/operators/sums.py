"""Sums of money in whole numbers: exact as those of decimals, at a fraction of their cost.

A sum of DECIMAL(18, 2) is a DECIMAL(28, 2), which no machine word holds, so every addition makes big numbers. Here the hundredths of an
amount are split into a high and a low whole number. These are summed apart, over any number of steps, and put together at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import DecimalType

# The low number counts hundredths below 2^31. So neither sum passes 64 bits before 2^32 amounts of DECIMAL(18, 2) are in one.
LOW_BITS = 31
SCALE = 2
_UNIT = "21474836.48BD"
# Digits before the point of an amount as it comes, and of a sum of such amounts.
AMOUNT_DIGITS = 16
SUM_DIGITS = 26


def high(name: str) -> str:
    return f"{name}_high"


def low(name: str) -> str:
    return f"{name}_low"


def part_names(names: tuple[str, ...]) -> list[str]:
    return [part for name in names for part in (high(name), low(name))]


def fits(rows: DataFrame, column: str, digits: int = AMOUNT_DIGITS) -> bool:
    """Whether a column is a decimal of hundredths at most, with no more digits before its point."""
    kind = rows.schema[column].dataType
    return isinstance(kind, DecimalType) and kind.scale <= SCALE and kind.precision - kind.scale <= digits


def split(column: str) -> tuple[str, str]:
    """The high and the low number of an amount."""
    hundredths = f"CAST({column} * 100 AS BIGINT)"
    return f"shiftright({hundredths}, {LOW_BITS})", f"({hundredths} & {2**LOW_BITS - 1}L)"


def in_parts(rows: DataFrame, amounts: dict[str, str], sums: frozenset[str] = frozenset()) -> dict[str, str]:
    """Column -> expression: both parts of each of ``amounts`` (name -> column), of which ``sums`` are sums already, or come in parts.

    If any is no decimal of such size, as where a source has wider ones, all come back as amounts.
    """
    parts: dict[str, str] = {}
    for name, column in amounts.items():
        if are_parts(rows, (column,)):
            parts |= {high(name): high(column), low(name): low(column)}
        elif fits(rows, column):
            parts |= dict(zip(part_names((name,)), split(column)))
        elif column in sums and fits(rows, column, SUM_DIGITS):
            parts |= {high(name): f"({column} div {_UNIT})", low(name): f"CAST(({column} % {_UNIT}) * 100 AS BIGINT)"}
        else:
            return {name: put_together(column) if are_parts(rows, (column,)) else column for name, column in amounts.items()}
    return parts


def put_together(name: str, digits: int = 38) -> str:
    """The amount of both parts."""
    return f"CAST((CAST({high(name)} AS DECIMAL(19,0)) * {2**LOW_BITS}BD + CAST({low(name)} AS DECIMAL(19,0))) * 0.01BD AS DECIMAL({digits},{SCALE}))"


def are_parts(rows: DataFrame, names: tuple[str, ...]) -> bool:
    return set(part_names(names)) <= set(rows.columns)


def whole_amounts(rows: DataFrame, names: tuple[str, ...], digits: int = 38) -> DataFrame:
    """Rows with amounts in place of their parts; rows without parts as they are."""
    if not are_parts(rows, names):
        return rows
    parts, columns = set(part_names(names)), []
    for column in rows.columns:
        if column not in parts:
            columns.append(f"`{column}`")
        elif column in map(high, names):
            name = column.removesuffix(high(""))
            columns.append(f"{put_together(name, digits)} AS {name}")
    return rows.selectExpr(*columns)
