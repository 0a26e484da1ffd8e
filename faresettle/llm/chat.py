"""Chat logs: cumulative snapshots collapse into the longest one, then turns are rendered. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from faresettle.llm.staging import stage


def _hash(salt: str, *columns: Column) -> Column:
    return F.xxhash64(F.lit(salt), *columns)


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """`conv_id`, `block`, `at` (from 0), `role`, `text`, `one` and `two` (hashes of the turn at its place) per turn.

    Turns are ordered by `turn` (nulls first), then by role and text, so repeated rows are turns of their
    own and ties have one order. Null roles and texts are told apart from empty ones. All turns are dealt by ranges of that order, repeated rows too, and
    a conversation is numbered range by range: so no task orders a long conversation, with turn numbers or without.
    """
    order = ["conv_id", "turn", "role", "text"]
    dealt = conversations.select(*order).withColumn("copy", F.monotonically_increasing_id()).repartitionByRange(*order, "copy")
    turns = stage(dealt.drop("copy").withColumn("block", F.spark_partition_id()), "chat-ranges")
    sizes = turns.groupBy("conv_id", "block").agg(F.count("*").alias("size"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("conv_id").alias("_conv"), F.col("block").alias("_block"), F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start")
    )
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block"))
    placed = turns.withColumn("inside", F.row_number().over(inside) - 1).join(starts, same)
    at = (F.col("start") + F.col("inside")).cast("long")
    null = F.concat(F.col("role").isNull().cast("string"), F.col("text").isNull().cast("string"))
    return placed.select("conv_id", "block", at.alias("at"), "role", "text").withColumns(
        {name: _hash(name, F.col("at"), null, F.col("role"), F.col("text")) for name in ("one", "two")}
    )


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """`conv_id`, `size`, `one`, `two`: a row for each prefix of each conversation, with its rolling hash.

    The hash of a prefix is the exclusive or of its turns' hashes, each of which holds the turn's place; so
    it rolls over blocks of turns that are summed up by themselves.
    """
    blocks = turns.groupBy("conv_id", "block").agg(*(F.bit_xor(c).alias(c) for c in ("one", "two")))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(
        F.col("conv_id").alias("_conv"), F.col("block").alias("_block"),
        *(F.coalesce(F.bit_xor(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("one", "two")),
    )
    inside = Window.partitionBy("conv_id", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    rolled = turns.select("conv_id", "block", "at", *(F.bit_xor(c).over(inside).alias(c) for c in ("one", "two")))
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block"))
    return rolled.join(starts, same).select(
        "conv_id", (F.col("at") + 1).alias("size"), *(F.col(c).bitwiseXOR(F.col(f"{c}_before")).alias(c) for c in ("one", "two"))
    )


def maximal(prefixes: DataFrame) -> DataFrame:
    """`conv_id`, `n_turns`, `n_same` of the conversations that are no proper prefix of another; of equal ones that with the smallest id.

    `n_same` counts the equal ones. Prefixes are made distinct before they meet, so the first turn that
    very many conversations share is one row.
    """
    sizes = prefixes.groupBy("conv_id").agg(F.max_by(F.struct("one", "two"), "size").alias("hash"), F.max("size").alias("size"))
    whole = sizes.select("conv_id", "size", "hash.one", "hash.two")
    # A conversation's own prefixes but the whole one; equal conversations agree in them.
    full = whole.select(F.col("conv_id").alias("_conv"), F.col("size").alias("n_turns"))
    proper = prefixes.join(full, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("size") < F.col("n_turns"))).select("size", "one", "two").distinct()
    ends = whole.groupBy("size", "one", "two").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_same"))
    return ends.join(proper, ["size", "one", "two"], "left_anti").select("conv_id", F.col("size").alias("n_turns"), "n_same")


def rendered(turn: str = "role", text: str = "text") -> Column:
    """A turn in the template: a head with its role, its text, an end mark."""
    role = F.coalesce(F.col(turn), F.lit("unknown"))
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), F.coalesce(F.col(text), F.lit("")), F.lit("<|im_end|>\n"))


def format_chats(conversations: DataFrame) -> DataFrame:
    """`conv_id`, `part`, `n_turns`, `n_same`, `text`: the maximal conversations, rendered.

    A logged conversation whose turns are the first turns of a longer one (same roles and texts, in order) is a
    snapshot of it and goes; of equal ones that with the smallest id stays. Text is whole, however many turns it has, and `part` is 0. A null role is rendered as
    `unknown`, a null text as empty, but both differ from these in comparisons. A null id is a conversation like
    any other, which stays only if no equal one has an id. Other columns are ignored; an empty table gives no rows.
    """
    turns = stage(numbered_turns(conversations), "chat-turns")
    kept = maximal(stage(prefix_hashes(turns), "chat-prefixes")).withColumnRenamed("conv_id", "_conv")
    lines = turns.join(kept, F.col("conv_id").eqNullSafe(F.col("_conv"))).select("conv_id", "block", "n_turns", "n_same", "at", rendered().alias("line"))
    blocks = lines.groupBy("conv_id", "n_turns", "n_same", "block").agg(_in_order("at", "line").alias("text"))
    return blocks.groupBy("conv_id", "n_turns", "n_same").agg(_in_order("block", "text").alias("text")).select("conv_id", F.lit(0).alias("part"), "n_turns", "n_same", "text")


def _in_order(place: str, text: str) -> Column:
    """Texts of a group, one after the other by their places."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(place, text))), lambda x: x[text])
    return F.concat_ws("", ordered)
