"""Rosters: one payload with a list of people, one line per person."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# The sentence and the greeting of a roster line.
SENTENCE = "%s is currently in space flying on the %s! %s"
GREETING = "Hello! :)"


def explode_people(rosters: DataFrame, *keep: str) -> DataFrame:
    return rosters.select(*keep, F.explode("people").alias("person")).select(*keep, "person.craft", "person.name")


def roster_lines(people: DataFrame, greeting: str = GREETING) -> DataFrame:
    return people.withColumn("line", F.format_string(SENTENCE, "name", "craft", F.lit(greeting)))
