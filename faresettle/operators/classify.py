"""The domestic / international label of a ticket.

The rule behind the label belongs to the source database, so it is an argument:
either an expression over ticket and country, or a lookup table by ticket.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from typing import Protocol

from pyspark.sql import Column, DataFrame, functions as F

from faresettle.session import Staging, runtime_filter_for


class DomIntRule(Protocol):
    inputs: tuple[str, ...]
    """The columns of prepared rows that ``label`` needs."""

    def prepare(self, rows: DataFrame) -> DataFrame:
        """Add what ``label`` needs to rows that have a ``ticket``."""

    def label(self, ticket: Column, isoc: Column) -> Column:
        """The label, as an expression over prepared rows."""

    def reduced_to(self, tickets: DataFrame, staging: Staging) -> DomIntRule:
        """The same rule for these tickets only, after which the lookup costs what they cost."""


@dataclass(frozen=True)
class ExpressionRule:
    """A rule that needs nothing but the ticket and the parameter's country."""

    expression: Callable[[Column, Column], Column]
    inputs: tuple[str, ...] = ("ticket",)

    def prepare(self, rows: DataFrame) -> DataFrame:
        return rows

    def label(self, ticket: Column, isoc: Column) -> Column:
        return self.expression(ticket, isoc)

    def reduced_to(self, tickets: DataFrame, staging: Staging) -> ExpressionRule:
        return self


@dataclass(frozen=True)
class TicketCountryRule:
    """``D`` when the ticket's country is the parameter's, else ``I``.

    ``tickets`` has ``ticket`` and ``country``. It may be as large as the ticket
    tables, so it is joined by key and Spark chooses how.
    """

    tickets: DataFrame
    inputs: tuple[str, ...] = ("ticket_country",)

    def prepare(self, rows: DataFrame) -> DataFrame:
        countries = (
            self.tickets.filter(F.col("ticket").isNotNull())
            .groupBy("ticket")
            .agg(F.min("country").alias("ticket_country"))
        )
        return rows.join(countries, "ticket", "left")

    def label(self, ticket: Column, isoc: Column) -> Column:
        return F.when(F.col("ticket_country") == isoc, "D").otherwise("I")

    def reduced_to(self, tickets: DataFrame, staging: Staging) -> TicketCountryRule:
        """The tickets asked for are staged and counted, so a runtime filter of the right size cuts the lookup while
        it is scanned: no more of it is shuffled than those tickets, and the few others that the filter lets through."""
        distinct = tickets.filter(F.col("ticket").isNotNull()).distinct().withColumn("asked", F.lit(1))
        asked, count = staging.write_counted(distinct, "tickets_asked")
        with runtime_filter_for(staging.spark, count):
            return replace(self, tickets=staging.write(self.of(asked), "ticket_countries"))

    def of(self, asked: DataFrame) -> DataFrame:
        """Each asked ticket's country. The predicate is what lets Spark make a runtime filter of that side."""
        found = self.tickets.join(asked.filter("asked = 1").select("ticket"), "ticket", "left_semi")
        return found.groupBy("ticket").agg(F.min("country").alias("country"))
