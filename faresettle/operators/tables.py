"""Loading and maintaining tables of report rows: appends, range deletes, window replacement.

Tables of a lake format get row-level statements. Of others, those partitioned by ``TrxDate`` are
kept by partition, and the rest file by file (``rows``). Work is proportional to the window, not the table.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from faresettle.functions.values import is_iso_day, sql_text
from faresettle.functions.windows import DateWindow
from faresettle.operators import rows
from faresettle.operators.quality import Gate
from faresettle.session import Staging

PARTITION_COLUMN = "TrxDate"
# How partition names spell null.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def create_table(
    spark: SparkSession, table: str, schema: StructType, partition_by: tuple[str, ...] = (PARTITION_COLUMN,)
) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    partitions = ", ".join(f"`{name}`" for name in partition_by)
    layout = f"PARTITIONED BY ({partitions})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet {layout}")


def aligned(df: DataFrame, table: str) -> DataFrame:
    """``df`` in the table's column order and types, matched by name.

    A column the table has and ``df`` lacks is an error. Rows are gathered by
    partition value so that a load writes few files per day; Spark splits a day
    that is too large for one task.
    """
    schema = df.sparkSession.table(table).schema
    missing = [name for name in schema.names if name not in df.columns]
    if missing:
        raise ValueError(f"{table} needs columns that the load lacks: {', '.join(missing)}")
    return df.select([F.col(f.name).cast(f.dataType) for f in schema]).hint("rebalance", PARTITION_COLUMN)


def append(df: DataFrame, table: str) -> None:
    aligned(df, table).write.insertInto(table)


def overwrite_partitions(df: DataFrame, table: str) -> None:
    """Replace exactly the partitions that ``df`` has rows for.

    The overwrite mode is a setting of the session, so a session of its own does it; other writes
    in the caller's session don't see it.
    """
    spark, view = df.sparkSession, f"faresettle_{uuid.uuid4().hex}"
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and own.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    df.createGlobalTempView(view)
    try:
        aligned(own.table(f"global_temp.{view}"), table).write.insertInto(table, overwrite=True)
    finally:
        spark.catalog.dropGlobalTempView(view)
    # The caller's session may remember the files that are gone.
    spark.catalog.refreshTable(table)


def partitions_in(spark: SparkSession, table: str, window: DateWindow) -> list[dict[str, str | None]]:
    """Partition specs whose ``TrxDate`` lies in the window; never the null one.

    The catalog names the partitions, also those without files, and no file is read. Only the window's names reach the driver.
    """
    day = F.regexp_extract("partition", rf"(?:^|/){PARTITION_COLUMN}=([^/]*)", 1)
    named = spark.sql(f"SHOW PARTITIONS {table}").filter(window.contains_text(day))
    return [_spec(row["partition"]) for row in named.collect()]


def _spec(name: str) -> dict[str, str | None]:
    parts = (part.split("=", 1) for part in name.split("/"))
    return {unquote(column): None if value == NO_VALUE else unquote(value) for column, value in parts}


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def drop_partitions(spark: SparkSession, table: str, specs: list[dict[str, str | None]]) -> None:
    """Drop partitions with their files; an external table keeps files of dropped partitions, so these are emptied first."""
    if not specs:
        return
    if spark.catalog.getTable(table).tableType != "MANAGED":
        nothing = ", ".join(f"CAST(NULL AS {c.dataType})" for c in spark.catalog.listColumns(table) if not c.isPartition)
        for spec in specs:
            spark.sql(f"INSERT OVERWRITE TABLE {table} {partition_clause(spec)} SELECT {nothing} WHERE false")
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(map(partition_clause, specs))}")


def partition_clause(spec: dict[str, str | None]) -> str:
    values = (f"`{name}` = {'null' if value is None else sql_text(value)}" for name, value in spec.items())
    return f"PARTITION ({', '.join(values)})"


# Catalogs whose tables delete rows and replace them in one commit.
LAKE_PROVIDERS = ("iceberg", "delta", "hudi", "paimon")
LAKE, BY_DAY, BY_ROW = "lake", "day", "row"


def table_facts(spark: SparkSession, table: str) -> dict[str, str]:
    """What the catalog says of a table: ``Provider``, ``Location``, ``Type`` and the like."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return {row.col_name: row.data_type for row in described}


def is_lake_table(spark: SparkSession, table: str) -> bool:
    """Whether the table's format takes row-level statements."""
    return table_facts(spark, table).get("Provider", "").lower() in LAKE_PROVIDERS


def layout(spark: SparkSession, table: str) -> str:
    """How the table's windows are kept: ``lake``, ``day`` or ``row``.

    A table that can't be kept in any of these ways raises ``ValueError``; every change asks this before its first write.
    """
    if is_lake_table(spark, table):
        return LAKE
    if PARTITION_COLUMN not in spark.table(table).columns:
        raise ValueError(f"{table} has no column {PARTITION_COLUMN}, so it has no windows")
    if PARTITION_COLUMN in partition_columns(spark, table):
        return BY_DAY
    rows.require_parquet(spark, table)
    return BY_ROW


def range_condition(window: DateWindow) -> str:
    start, end = window.iso
    return f"`{PARTITION_COLUMN}` BETWEEN {sql_text(start)} AND {sql_text(end)}"


def delete_statement(table: str, window: DateWindow) -> str:
    return f"DELETE FROM {table} WHERE {range_condition(window)}"


def delete_range(spark: SparkSession, tables: list[str], window: DateWindow) -> None:
    """Delete the window's days from each table; rows without a date stay.

    All tables are looked at before the first is changed. Tables not partitioned by ``TrxDate`` lose the window's rows file by file.
    """
    kept_by = {table: layout(spark, table) for table in tables}
    for table, way in kept_by.items():
        if way == LAKE:
            spark.sql(delete_statement(table, window))
        elif way == BY_DAY:
            drop_partitions(spark, table, partitions_in(spark, table, window))
        else:
            rows.delete_rows(spark, table, F.expr(range_condition(window)))


OVERWRITE, SWITCH = "overwrite", "switch"


def window_replace(df: DataFrame, table: str, window: DateWindow, gate: Gate | None = None, publish: str = OVERWRITE) -> None:
    """Make the table's window equal to ``df``, rerunnable.

    The batch is staged and checked before the table is touched, so a failing extract, a batch that ``gate`` refuses
    or a table that has no windows changes nothing. In a table partitioned by day, days are then replaced one by one, and days that
    the new batch lacks are dropped last; ``publish="switch"`` writes all days first and then only switches their folders.
    After a crash a rerun converges.
    """
    way = publishing(df.sparkSession, table, publish)
    with Staging(df.sparkSession) as staging:
        batch = staging.write(df, "batch") if gate is None else gate.staged(df, staging, "batch")
        replace_from_files(batch, table, window, publish, way)


def publishing(spark: SparkSession, table: str, publish: str) -> str:
    """The table's layout, if its windows can be published so; else ``ValueError``."""
    way = layout(spark, table)
    if publish not in (OVERWRITE, SWITCH) or (publish == SWITCH and way != BY_DAY):
        raise ValueError(f"{table} can't be published by {publish}")
    return way


def replace_from_files(batch: DataFrame, table: str, window: DateWindow, publish: str = OVERWRITE, way: str | None = None) -> None:
    """``window_replace`` for a batch that only reads files already written; ``way`` is the table's layout, if known."""
    spark = batch.sparkSession
    way = way or publishing(spark, table, publish)
    day = F.col(PARTITION_COLUMN).cast("string")
    inside = F.coalesce(is_iso_day(day) & window.contains_text(day), F.lit(False))
    if not batch.filter(~inside).isEmpty():
        raise ValueError(f"the batch has rows outside the window {window.iso}")
    if way == LAKE:
        aligned(batch, table).writeTo(table).overwrite(F.expr(range_condition(window)))
    elif way == BY_ROW:
        rows.replace_rows(aligned(batch, table), table, F.expr(range_condition(window)))
    elif publish == SWITCH:
        _switch_window(batch, table, window)
    else:
        columns = partition_columns(spark, table)
        overwrite_partitions(batch, table)
        new = {tuple(row) for row in batch.select([F.col(c).cast("string") for c in columns]).distinct().collect()}
        drop_partitions(spark, table, [s for s in partitions_in(spark, table, window) if tuple(s[c] for c in columns) not in new])


VERSIONS = "_versions"


def _switch_window(batch: DataFrame, table: str, window: DateWindow) -> None:
    """Write all days of the batch to new folders, then let the table's partitions name these, then delete what they named before.

    Until the first switch a reader sees the old window, and each partition changes whole. New folders lie in the table's own, where names
    that begin with an underscore are no data; so the table is to be read by its name, not by its path.
    """
    spark = batch.sparkSession
    fill = partition_columns(spark, table)
    root = rows.location(spark, table)
    written = f"{root}/{VERSIONS}/{uuid.uuid4().hex}"
    aligned(batch, table).write.partitionBy(*fill).parquet(written)
    schema = spark.table(table).schema
    folders = spark.read.schema(schema).parquet(written).select(
        *[F.col(c).cast("string").alias(c) for c in fill], F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("_folder")
    )
    new = {tuple(row)[:-1]: rows.path_of(spark, row["_folder"]) for row in folders.distinct().collect()}
    old = {tuple(spec[c] for c in fill): _folder(spark, table, spec) for spec in partitions_in(spark, table, window)}
    switch_partitions(spark, table, fill, new, old)
    for folder in set(old.values()) - set(new.values()):
        rows.delete_path(spark, folder)
        version = folder.removeprefix(f"{root}/{VERSIONS}/").split("/")[0]
        if folder.startswith(f"{root}/{VERSIONS}/") and not rows.listed(spark, f"{root}/{VERSIONS}/{version}/*=*"):
            rows.delete_path(spark, f"{root}/{VERSIONS}/{version}")
    spark.catalog.refreshTable(table)


def drop_unused_versions(spark: SparkSession, table: str) -> int:
    """Delete folders of versions that no partition names, as a job killed before its switch leaves them; returns how many.

    It asks the catalog for every partition's folder, so it is for maintenance, not for each load.
    """
    used = [_folder(spark, table, _spec(row["partition"])) for row in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    versions = [path.toString() for path in rows.listed(spark, f"{rows.location(spark, table)}/{VERSIONS}/*")]
    unused = [version for version in versions if not any(folder.startswith(f"{version}/") for folder in used)]
    for version in unused:
        rows.delete_path(spark, version)
    return len(unused)


def switch_partitions(
    spark: SparkSession, table: str, fill: list[str], new: dict[tuple, str], old: dict[tuple, str]
) -> None:
    """The statements of a switch: partitions that stay, then those that come, then those that go."""
    clause = {key: partition_clause(dict(zip(fill, key))) for key in {*new, *old}}
    for key in sorted(new.keys() & old.keys(), key=str):
        spark.sql(f"ALTER TABLE {table} {clause[key]} SET LOCATION {sql_text(new[key])}")
    added = [f"{clause[key]} LOCATION {sql_text(new[key])}" for key in sorted(new.keys() - old.keys(), key=str)]
    if added:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(added)}")
    gone = [clause[key] for key in sorted(old.keys() - new.keys(), key=str)]
    if gone:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(gone)}")


def _folder(spark: SparkSession, table: str, spec: dict[str, str | None]) -> str:
    """Where a partition's files lie."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {partition_clause(spec)}").filter("col_name = 'Location'").collect()
    return rows.path_of(spark, described[0].data_type)


def promote_final(df: DataFrame, final: str, recent: str, window: DateWindow, gate: Gate | None = None, publish: str = OVERWRITE) -> None:
    """Load the window's final rows and retire its preliminary ones; both tables are looked at first."""
    layout(df.sparkSession, recent)
    window_replace(df, final, window, gate, publish)
    delete_range(df.sparkSession, [recent], window)
