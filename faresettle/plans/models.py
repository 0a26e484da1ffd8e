"""Named models: functions over frames, kept as a table or a view."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F


def recent_sale(sales: DataFrame) -> DataFrame:
    """Sales per day. A day without any amount has a null total."""
    return sales.groupBy("date").agg(F.count(F.lit(1)).alias("cnt"), F.sum("amt").alias("total_sales"))


def first_model(source_data: DataFrame, drop_null_ids: bool = False) -> DataFrame:
    return source_data.filter(F.col("id").isNotNull()) if drop_null_ids else source_data


def second_model(first: DataFrame, id_value: int = 2) -> DataFrame:
    return first.filter(F.col("id") == id_value)


def materialize(model: DataFrame, name: str, kind: str) -> DataFrame:
    """Keep a model under ``name`` as a ``table`` or a ``view`` and refer to it."""
    if kind == "table":
        model.write.mode("overwrite").saveAsTable(name)
    elif kind == "view":
        model.createOrReplaceTempView(name)
    else:
        raise ValueError(f"a model is kept as table or view, not {kind}")
    return model.sparkSession.table(name)


@dataclass(frozen=True)
class SqlModel:
    """A model as SQL text; ``{name}`` in it stands for the table or view that ``refs`` gives for that name."""

    name: str
    text: str
    refs: dict[str, str] = field(default_factory=dict)

    def sql(self) -> str:
        return self.text.format(**{ref: quoted(table) for ref, table in self.refs.items()})


def quoted(name: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def keep_view(spark: SparkSession, model: SqlModel) -> DataFrame:
    """Keep a model as a view of the catalog, which outlives this session, and refer to it.

    The view is computed when it is read, from what its refs hold then. A ref that the catalog lacks, or that
    is temporary and so gone with its session, raises ``ValueError`` before a view is made or replaced.
    """
    for ref, table in model.refs.items():
        if not spark.catalog.tableExists(table):
            raise ValueError(f"{model.name} refers to {ref}, but there is no {table}")
        if spark.catalog.getTable(table).isTemporary:
            raise ValueError(f"{model.name} refers to {ref}, but {table} is temporary")
    spark.sql(f"CREATE OR REPLACE VIEW {quoted(model.name)} AS {model.sql()}")
    return spark.table(model.name)


def keep_models(spark: SparkSession, models: list[SqlModel]) -> dict[str, DataFrame]:
    """Keep models as views, each after those it refers to; a circle raises ``ValueError``."""
    todo, kept = {model.name: model for model in models}, {}
    while todo:
        ready = [model for model in todo.values() if not todo.keys() & set(model.refs.values())]
        if not ready:
            raise ValueError(f"models refer to each other in a circle: {', '.join(sorted(todo))}")
        for model in ready:
            kept[model.name] = keep_view(spark, model)
            del todo[model.name]
    return kept


def broken_models(spark: SparkSession, models: list[SqlModel]) -> list[str]:
    """Names of kept views that can't be read any more, as a table they refer to has gone or lost a column."""
    broken = []
    for model in models:
        try:
            spark.table(model.name).schema
        except AnalysisException:
            broken.append(model.name)
    return broken
