"""Landed JSON payloads with a nested list, and what stands in for bad ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ROSTER_TYPE = "struct<number: int, people: array<struct<craft: string, name: string>>>"

# The roster used when a payload is missing or unusable.
DEFAULT_NUMBER = 12
DEFAULT_PEOPLE = (
    ("ISS", "Oleg Kononenko"),
    ("ISS", "Nikolai Chub"),
    ("ISS", "Tracy Caldwell Dyson"),
    ("ISS", "Matthew Dominick"),
    ("ISS", "Michael Barratt"),
    ("ISS", "Jeanette Epps"),
    ("ISS", "Alexander Grebenkin"),
    ("ISS", "Butch Wilmore"),
    ("ISS", "Sunita Williams"),
    ("Tiangong", "Li Guangsu"),
    ("Tiangong", "Li Cong"),
    ("Tiangong", "Ye Guangfu"),
)


def default_roster() -> Column:
    people = [F.struct(F.lit(craft).alias("craft"), F.lit(name).alias("name")) for craft, name in DEFAULT_PEOPLE]
    return F.struct(F.lit(DEFAULT_NUMBER).alias("number"), F.array(*people).alias("people")).cast(ROSTER_TYPE)


def parse_roster(payload: Column) -> Column:
    """The payload as a struct; null where it is not JSON or lacks a key."""
    keys = F.json_object_keys(payload)
    complete = F.array_contains(keys, "number") & F.array_contains(keys, "people")
    return F.when(complete, F.from_json(payload, ROSTER_TYPE))


def read_rosters(payloads: DataFrame, column: str = "payload", fallback: bool = True) -> DataFrame:
    """Parse a column of payloads, with the default roster for unusable ones."""
    parsed = parse_roster(F.col(column))
    if fallback:
        parsed = F.coalesce(parsed, default_roster())
    others = [name for name in payloads.columns if name != column]
    return payloads.select(*others, parsed.alias("roster")).select(*others, "roster.number", "roster.people")


def read_roster_files(spark: SparkSession, path: str) -> DataFrame:
    """One roster per landed file; the default roster if the folder has no file."""
    payloads = spark.read.text(path, wholetext=True).select(F.col("value").alias("payload"))
    nothing = spark.range(1).select(F.lit(None).cast("string").alias("payload")).where(~payloads.exists())
    return read_rosters(payloads.union(nothing))


# Why a payload goes to the quarantine, by the first test that it fails.
NOT_JSON, NO_OBJECT, NO_NUMBER, BAD_NUMBER, NO_PEOPLE, BAD_PEOPLE, BAD_PERSON = (
    "not json", "not an object", "no number", "number is not whole", "no people", "people is not a list", "person without name or craft",
)


def split_rosters(payloads: DataFrame, column: str = "payload") -> tuple[DataFrame, DataFrame]:
    """Usable payloads, parsed, and the others with the reason.

    Payloads are parsed as VARIANT, so that what the roster's type doesn't know survives: usable ones have ``number``, ``people``
    and ``extra``, a map of all other fields to their JSON; each person has ``craft``, ``name`` and ``extra`` alike. A payload is set aside, as it is,
    with a ``reason`` if it isn't JSON or is null, lacks a field or has one of another type: ``number`` has to be a whole number, ``people`` a list of
    objects with text for ``name`` and ``craft``.
    """
    others = [name for name in payloads.columns if name != column]
    doc = payloads.withColumn("_doc", F.expr(f"try_parse_json(`{column}`)"))
    facts = doc.select(
        *others, column, "_doc",
        F.expr("try_variant_get(_doc, '$', 'map<string, variant>')").alias("_fields"),
        F.expr("try_variant_get(_doc, '$.people', 'array<variant>')").alias("_people"),
    )
    kind = "schema_of_variant(_fields['{}'])"
    person = "try_variant_get(p, '$', 'map<string, variant>')"
    text = "coalesce(schema_of_variant({}['{}']) = 'STRING', false)"
    whole_person = f"{person} IS NOT NULL AND {text.format(person, 'name')} AND {text.format(person, 'craft')}"
    reason = F.expr(
        f"CASE WHEN _doc IS NULL THEN '{NOT_JSON}' WHEN _fields IS NULL THEN '{NO_OBJECT}'"
        f" WHEN NOT map_contains_key(_fields, 'number') THEN '{NO_NUMBER}'"
        f" WHEN coalesce({kind.format('number')}, '') <> 'BIGINT' OR try_variant_get(_fields['number'], '$', 'int') IS NULL THEN '{BAD_NUMBER}'"
        f" WHEN NOT map_contains_key(_fields, 'people') THEN '{NO_PEOPLE}' WHEN _people IS NULL THEN '{BAD_PEOPLE}'"
        f" WHEN exists(_people, p -> NOT ({whole_person})) THEN '{BAD_PERSON}' END"
    )
    judged = facts.withColumn("reason", reason)
    parsed = (
        "transform(_people, p -> named_struct('craft', try_variant_get(p, '$.craft', 'string'), 'name', try_variant_get(p, '$.name', 'string'),"
        f" 'extra', {_fields_but(person, 'craft', 'name')})) AS people"
    )
    good = judged.filter("reason IS NULL").selectExpr(
        *[f"`{name}`" for name in others],
        "try_variant_get(_fields['number'], '$', 'int') AS number",
        parsed,
        f"{_fields_but('_fields', 'number', 'people')} AS extra",
    )
    return good, judged.filter("reason IS NOT NULL").select(*others, column, "reason")


def _fields_but(fields: str, *known: str) -> str:
    """The other fields of a map of variants, as JSON."""
    names = ", ".join(f"'{name}'" for name in known)
    return f"transform_values(map_filter({fields}, (k, v) -> k NOT IN ({names})), (k, v) -> to_json(v))"


def quarantine_rosters(bad: DataFrame, path: str) -> None:
    """Payloads that were set aside, as Parquet by reason; replaces those of an earlier run."""
    bad.write.mode("overwrite").partitionBy("reason").parquet(path)
