"""Readers for source databases. Credentials come from the caller's options."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from faresettle.functions.values import blank_to_null
from faresettle.functions.windows import DateWindow

FETCH_SIZE = "10000"


def query_options(url: str, query: str, **options: str) -> dict[str, str]:
    """One session in the database runs the query: for results of modest size."""
    return {"url": url, "query": query, "fetchsize": FETCH_SIZE, **options}


def table_options(
    url: str, table: str, key: str, bounds: tuple[int, int], partitions: int, **options: str
) -> dict[str, str]:
    """A parallel read, split by ranges of a numeric key.

    The bounds only place the splits; rows outside them are still read.
    """
    low, high = bounds
    if low >= high or partitions < 1:
        raise ValueError("a parallel read needs low < high and at least one partition")
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": key,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(partitions),
        "fetchsize": FETCH_SIZE,
        **options,
    }


def day_predicates(column: str, window: DateWindow) -> list[str]:
    """One predicate per day, for a parallel read of a date-keyed table.

    Half-open days, but the last one ends at its midnight like the window does.
    """
    days = [window.start + timedelta(days=n) for n in range((window.end - window.start).days)]
    spans = [f"{column} >= {_day(d)} AND {column} < {_day(d + timedelta(days=1))}" for d in days]
    return [*spans, f"{column} = {_day(window.end)}"]


def _day(value: date) -> str:
    return f"DATE '{value.isoformat()}'"


def read_query(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    return spark.read.format("jdbc").options(**query_options(url, query, **options)).load()


def read_table(
    spark: SparkSession, url: str, table: str, key: str, bounds: tuple[int, int], partitions: int, **options: str
) -> DataFrame:
    return spark.read.format("jdbc").options(**table_options(url, table, key, bounds, partitions, **options)).load()


def read_window(spark: SparkSession, url: str, table: str, column: str, window: DateWindow, **options: str) -> DataFrame:
    properties = {"fetchsize": FETCH_SIZE, **options}
    return spark.read.jdbc(url, table, predicates=day_predicates(column, window), properties=properties)


def codes_cleaned(df: DataFrame, *columns: str) -> DataFrame:
    """Code columns as their database compares them: no padding, empty is null."""
    return df.withColumns({name: blank_to_null(df[name]) for name in columns})
