"""The parameter table, attached to every row without a key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# The table is expected to hold one row; more than this many are a mistake, not parameters.
MAX_PARAMETER_ROWS = 1000


def attach_parameters(rows: DataFrame, para: DataFrame, most: int = MAX_PARAMETER_ROWS) -> DataFrame:
    """Add ``isoc``, ``cutp`` and ``para_copies`` to every row.

    Equal parameter rows are counted, not repeated: amounts are to be multiplied
    by ``para_copies`` when summed. Without any parameter row all three are null.

    The parameter rows are counted first and broadcast, so ``rows`` do not move; more
    than ``most`` of them raise ``ValueError``.
    """
    if para.select("isoc", "cutp").limit(most + 1).count() > most:
        raise ValueError(f"the parameter table has more than {most} rows, and each would repeat every row")
    pairs = para.groupBy("isoc", "cutp").agg(F.expr("count(1) AS para_copies"))
    return rows.join(F.broadcast(pairs), F.lit(True), "left")


def join_parameter_row(rows: DataFrame, para: DataFrame) -> DataFrame:
    """The unconditional left join itself: *n* parameter rows repeat a row *n* times."""
    attached = attach_parameters(rows, para)
    repeats = F.sequence(F.lit(1), F.coalesce("para_copies", F.lit(1)))
    return attached.withColumn("_copy", F.explode(repeats)).drop("_copy", "para_copies")
