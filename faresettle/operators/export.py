"""Exports: a query result to Parquet or CSV, replacing what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame

from faresettle.functions.windows import DateWindow


def write_parquet_window(df: DataFrame, root: str, prefix: str, window: DateWindow) -> str:
    """Write the window's folder and return its path."""
    path = window.path(root, prefix, "parquet")
    df.write.mode("overwrite").parquet(path)
    return path


def export_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True) -> None:
    """Every column as text, quotes doubled inside quoted values."""
    df.write.mode("overwrite").options(sep=sep, header=header, escape='"').csv(path)


def preview(df: DataFrame, rows: int, *order_by: str) -> DataFrame:
    """The first rows; without an order they are any rows."""
    return (df.orderBy(*order_by) if order_by else df).limit(rows)
