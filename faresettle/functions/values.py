"""Scalar column functions of the settlement queries."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DecimalType

ISO_DATE = "yyyy-MM-dd"


def iso_text(day: Column) -> Column:
    return F.date_format(day, ISO_DATE)


def iso_date(text: Column) -> Column:
    return F.to_date(text, ISO_DATE)


def blank_to_null(text: Column) -> Column:
    """Blank-padded and empty codes as they compare in the source database."""
    trimmed = F.rtrim(text)
    return F.when(trimmed != "", trimmed)


def is_decimal_text(text: Column, money: DecimalType) -> Column:
    """True for a plain number that ``money`` holds without losing digits."""
    whole = money.precision - money.scale
    pattern = rf"^-?0*\d{{1,{whole}}}(\.\d{{1,{money.scale}}}0*)?$"
    return text.rlike(pattern)


def checked_decimal(text: Column, money: DecimalType) -> Column:
    """Cast amount text, failing the job on anything but a plain number.

    Spark's own reader takes ``1,5`` for 15, so the text is checked first.
    """
    return (
        F.when(text.isNull(), F.lit(None).cast(money))
        .when(is_decimal_text(text, money), text.cast(money))
        .otherwise(F.raise_error(F.concat(F.lit("not a plain amount: "), text)).cast(money))
    )


def checked_iso_text(text: Column) -> Column:
    """Date text that is a real ISO day, failing the job otherwise."""
    return (
        F.when(text.isNull(), F.lit(None).cast("string"))
        .when(is_iso_day(text), text)
        .otherwise(F.raise_error(F.concat(F.lit("not an ISO date: "), text)).cast("string"))
    )


def is_iso_day(text: Column) -> Column:
    return text.rlike(r"^\d{4}-\d{2}-\d{2}$") & F.try_to_date(text, ISO_DATE).isNotNull()


def sql_text(value: str) -> str:
    """A text as a SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
