"""Data tests as queries for failing rows: a passing test returns none."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F

from faresettle.operators.setops import union_all
from faresettle.plans.contract import IDENTITIES
from faresettle.plans.settlement import signed_sum
from faresettle.session import Staging


class DataTestFailed(AssertionError):
    """``found`` holds the failing rows per test, where these were counted."""

    def __init__(self, message: str, found: dict[str, int] | None = None) -> None:
        super().__init__(message)
        self.found = found or {}


def not_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; null is not a value."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def is_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def require(failing: DataFrame, test: str) -> None:
    """Raise if a data test found anything."""
    if not failing.isEmpty():
        raise DataTestFailed(test)


@dataclass(frozen=True)
class Gate:
    """Data tests that a batch has to pass before a table takes it.

    ``failing`` holds row tests by name, each a condition that a bad row meets. They are counted while the batch is
    staged, in the job that writes it. ``unique`` names columns whose values may come once; that needs rows of equal values
    to meet, so it reads these columns of the staged files, and nothing else.
    """

    failing: dict[str, Column]
    unique: tuple[str, ...] = ()

    def watched(self, batch: DataFrame) -> tuple[DataFrame, Observation]:
        """The batch with its rows counted as the next job reads them: all, and per test those that fail."""
        seen = Observation(f"faresettle_gate_{uuid.uuid4().hex}")
        tests = [F.count(F.when(condition, 1)).alias(test) for test, condition in self.failing.items()]
        return batch.observe(seen, F.count(F.lit(1)).alias(ROWS), *tests), seen

    def found(self, seen: Observation, written: DataFrame) -> dict[str, int]:
        """Per test the rows, or values, that fail, and under ``rows`` the number of rows; ``written`` is the watched batch as written."""
        return dict(seen.get) | {f"unique {column}": not_unique(written.select(column), column).count() for column in self.unique}

    def require(self, seen: Observation, written: DataFrame) -> DataFrame:
        """The written batch; raises ``DataTestFailed``, with the number of bad rows, if a test found any."""
        found = self.found(seen, written)
        bad = {test: n for test, n in found.items() if n and test != ROWS}
        if bad:
            raise DataTestFailed(", ".join(f"{test}: {n}" for test, n in bad.items()) + f" of {found[ROWS]} rows", bad)
        return written

    def staged(self, batch: DataFrame, staging: Staging, name: str) -> DataFrame:
        """The batch as staged, if it passes."""
        watched, seen = self.watched(batch)
        return self.require(seen, staging.write(watched, name))

    def counted(self, batch: DataFrame, staging: Staging, name: str) -> tuple[DataFrame, dict[str, int]]:
        """The batch as staged, whether it passes or not, and what was found."""
        watched, seen = self.watched(batch)
        staged = staging.write(watched, name)
        return staged, self.found(seen, staged)


# The name under which a gate counts all rows.
ROWS = "rows"


def report_gate(unique: tuple[str, ...] = ()) -> Gate:
    """The tests of report rows: type and day are there, and derived measures follow from the base sums."""
    tests = {"not_null Type": F.col("Type").isNull(), "not_null TrxDate": F.col("TrxDate").isNull()}
    return Gate(tests | {name: F.expr(f"{name} <> {signed_sum(terms)}") for name, terms in IDENTITIES.items()}, unique)


def broken_identities(report: DataFrame) -> DataFrame:
    """Report rows whose derived measures do not follow from the base sums."""
    return report.filter(" OR ".join(f"{name} <> {signed_sum(terms)}" for name, terms in IDENTITIES.items()))


def identity_summary(report: DataFrame) -> DataFrame:
    """Per identity: rows checked, rows broken, and the measure's total; one pass."""
    wide = report.agg(
        F.expr("count(1) AS checked"),
        *[F.expr(f"count_if({name} <> {signed_sum(terms)}) AS {name}_broken") for name, terms in IDENTITIES.items()],
        *[F.expr(f"sum({name}) AS {name}_total") for name in IDENTITIES],
    )
    rows = ", ".join(f"'{name}', checked, {name}_broken, {name}_total" for name in IDENTITIES)
    return wide.selectExpr(f"stack({len(IDENTITIES)}, {rows}) AS (identity, checked, broken, total)")


def count_mismatch(rosters: DataFrame) -> DataFrame:
    """Payloads whose declared number differs from the length of their list."""
    listed = F.coalesce(F.size("people"), F.lit(0))
    return rosters.withColumn("listed", listed).filter(~F.col("number").eqNullSafe(F.col("listed")))


def failing_models(models: dict[str, DataFrame], column: str = "id") -> DataFrame:
    """``unique`` and ``not_null`` of one column over several models, each read once."""
    value, n = F.col(column), F.col("n")
    frames = []
    for name, model in models.items():
        counts = model.groupBy(column).agg(F.count(F.lit(1)).alias("n")).agg(
            F.count(F.when(value.isNotNull() & (n > 1), 1)).alias("unique"),
            F.coalesce(F.sum(F.when(value.isNull(), n)), F.lit(0)).alias("not_null"),
        )
        tests = "stack(2, 'unique', unique, 'not_null', not_null) AS (test, failures)"
        frames.append(counts.selectExpr(f"'{name}' AS model", tests))
    return union_all(frames)
