"""Window-named Parquet folders and ``;``-separated drops."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType, StringType, StructField, StructType

from faresettle.functions.values import checked_decimal, checked_iso_text, is_decimal_text, is_iso_day
from faresettle.functions.windows import DateWindow
from faresettle.plans.contract import REPORT_SCHEMA

DATE_COLUMNS = ("TrxDate",)
# Names must match the header; quotes inside values are doubled. A field without
# text is null and a quoted empty one is empty, which needs a null mark no text has.
CSV_OPTIONS = {
    "sep": ";",
    "header": True,
    "mode": "FAILFAST",
    "enforceSchema": False,
    "escape": '"',
    "nullValue": "\u0000",
}


def read_parquet_window(
    spark: SparkSession, root: str, prefix: str, window: DateWindow, schema: StructType | None = None
) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(window.path(root, prefix, "parquet"))


def text_schema(schema: StructType) -> StructType:
    return StructType([StructField(f.name, StringType()) for f in schema])


def read_csv_text(spark: SparkSession, path: str, schema: StructType = REPORT_SCHEMA, sep: str = ";") -> DataFrame:
    """The file with every column as text, for the checks below."""
    return spark.read.options(**{**CSV_OPTIONS, "sep": sep}).schema(text_schema(schema)).csv(path)


def typed(text: DataFrame, schema: StructType = REPORT_SCHEMA, date_columns: tuple[str, ...] = DATE_COLUMNS) -> DataFrame:
    """Cast text columns to ``schema``; the job fails on a bad amount or date."""
    return text.select([_checked(f, date_columns).alias(f.name) for f in schema])


def _checked(field: StructField, date_columns: tuple[str, ...]):
    column = F.col(field.name)
    if isinstance(field.dataType, DecimalType):
        return checked_decimal(column, field.dataType)
    return checked_iso_text(column) if field.name in date_columns else column.cast(field.dataType)


def read_recent_csv(spark: SparkSession, path: str, schema: StructType = REPORT_SCHEMA) -> DataFrame:
    """A weekly drop, typed; the job fails on a row that is not plain."""
    return typed(read_csv_text(spark, path, schema), schema)


def split_bad_rows(
    text: DataFrame, schema: StructType = REPORT_SCHEMA, date_columns: tuple[str, ...] = DATE_COLUMNS
) -> tuple[DataFrame, DataFrame]:
    """Typed good rows, and the other rows as text for a quarantine."""
    good = F.lit(True)
    for field in schema:
        column = F.col(field.name)
        if isinstance(field.dataType, DecimalType):
            good = good & (column.isNull() | is_decimal_text(column, field.dataType))
        elif field.name in date_columns:
            good = good & (column.isNull() | is_iso_day(column))
    return typed(text.filter(good), schema, date_columns), text.filter(~good)
