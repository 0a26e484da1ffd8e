"""Balanced label propagation: documents into shards of equal counts, linked ones together."""

from __future__ import annotations

from heapq import heapify, heappop, heappush
from itertools import count as count_from

from pyspark.sql import DataFrame, Row, Window, functions as F

from faresettle.llm.staging import Rounds, checkpointed, stage

SHARDS = 8
# Propagation ends after so many rounds in a row without fewer cut links.
IDLE_ROUNDS = 2
# Rows that one task ranks at a time.
RANK_BLOCK = 20_000


def ranked(rows: DataFrame, group: list[str], order: list[str], count: int, name: str) -> DataFrame:
    """`rows` with a gapless rank from 0 in each group, as a long column `name`.

    The rows of a group are dealt to blocks by a hash of `order`, which must tell rows apart; a block is
    ranked in one task and begins where the blocks before it end, so no task holds a group.
    """
    blocks = max(1, -(-count // RANK_BLOCK))
    dealt = rows.withColumn("_block", F.pmod(F.xxhash64(*order), F.lit(blocks)))
    sizes = dealt.groupBy(*group, "_block").agg(F.count("*").alias("_size"))
    before = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*group, "_block", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy(*group, "_block").orderBy(*order)) - 1
    return dealt.withColumn("_inside", inside).join(starts, [*group, "_block"]).withColumn(name, F.col("_start") + F.col("_inside")).drop("_block", "_start", "_inside")


# A text of more than this share of all rows is common; there are no more of these than that.
COMMON = 4096


def group_links(documents: DataFrame, count: int) -> DataFrame:
    """Edges `a`, `b` of `row` ids: documents of equal text to the first of them, a star for each group.

    Groups are counted with a map-side part. Rows of a common text then meet their first one by a broadcast and don't move, others are joined by the text's key.
    """
    firsts = stage(documents.groupBy("text_key").agg(F.min("row").alias("a"), F.count("*").alias("n")).where("n > 1"), "shard-firsts")
    common = F.broadcast(firsts.where(F.col("n") * COMMON > count).select("text_key", "a"))
    rows = documents.select("text_key", F.col("row").alias("b"))
    near = rows.join(common, "text_key")
    far = rows.join(common.select("text_key"), "text_key", "left_anti").join(firsts.where(F.col("n") * COMMON <= count).select("text_key", "a"), "text_key")
    return near.unionByName(far).where("a <> b").select("a", "b")


def propagate(edges: DataFrame, quotas: list[int]) -> DataFrame:
    """`row`, `shard` for the rows of `edges` (`a`, `b`, each pair once): linked rows in the same shard, as far as the quotas let them.

    Rows start in turns. In each round every second row, by a hash, may move to the shard that most of its
    neighbours are in (a draw among equals), if more than in its own. Rows change places around rings of shards, and then as many move as
    the target's quota leaves room for; those that gain most go first. So no shard ever exceeds its quota. Ends when no row wants to move, or
    when rounds no longer leave fewer links cut.

    A round is one written table, which holds each row's shard and wish, and one count of it; the next round's shards are an expression over it.
    """
    both = checkpointed(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    nodes = both.select(F.col("a").alias("row")).distinct()
    count = nodes.count()
    if not count:
        return nodes.select("row", F.lit(0).alias("shard"))
    held = _even(quotas, count)
    labels = checkpointed(ranked(nodes, [], ["row"], count, "rank").select("row", _shard_of("rank", held).alias("shard")))
    rounds, least, idle = Rounds("propagate"), None, 0
    for turn in count_from(0):
        wishes = rounds.stage(_wishes(both, labels, len(quotas), turn))
        cells = _cells(wishes, turn)
        cut = sum(r["lost"] for r in cells)
        if not any(r["wish"] for r in cells):
            break
        least, idle = (cut, 0) if least is None or cut < least else (least, idle + 1)
        if idle == IDLE_ROUNDS:
            break
        wanted: dict[tuple[int, int], int] = {}
        for r in cells:
            if r["n"]:
                wanted[r["source"], r["target"]] = wanted.get((r["source"], r["target"]), 0) + r["n"]
        allowed = _allowed(wanted, [quota - n for quota, n in zip(quotas, held)])
        taken, moved = _taken(cells, allowed)
        for (source, target), n in moved.items():
            held[source] -= n
            held[target] += n
        labels = wishes.select("row", _moved(taken, turn).alias("shard"))
    return wishes.select("row", "shard")


def _wishes(both: DataFrame, labels: DataFrame, shards: int, turn: int) -> DataFrame:
    """Of each row its `shard` and `target`, what moving would `gain`, and how many of its links are `lost`, that is cut.

    Votes are counted in a column per shard, so neighbours of a row are summed up before they are shuffled to it.
    """
    votes = both.join(labels.select(F.col("row").alias("b"), "shard"), "b").groupBy(F.col("a").alias("row")).agg(
        *[F.count(F.when(F.col("shard") == s, 1)).alias(f"v{s}") for s in range(shards)]
    )
    draws = [F.struct(F.col(f"v{s}").alias("votes"), F.xxhash64("row", F.lit(s), F.lit(turn)).alias("draw"), F.lit(s).alias("to")) for s in range(shards)]
    own = F.element_at(F.array(*[F.col(f"v{s}") for s in range(shards)]), F.col("shard") + 1)
    joined = labels.join(votes, "row").select("row", "shard", F.greatest(*draws).alias("best") if shards > 1 else draws[0].alias("best"), own.alias("own"), sum(F.col(f"v{s}") for s in range(shards)).alias("degree"))
    return joined.select(
        "row", "shard", F.col("best.to").alias("target"), (F.col("best.votes") - F.col("own")).alias("gain"), (F.col("degree") - F.col("own")).alias("lost")
    )


# Wishes of a way between shards are dealt to cells, by the power of two of their gain and a hash; a cell moves whole or stays.
CELLS = 256


def _gain_class() -> F.Column:
    return F.floor(F.log2(F.greatest("gain", F.lit(1)))).cast("int")


def _cell(turn: int) -> F.Column:
    return F.pmod(F.xxhash64("row", F.lit(turn), F.lit("cell")), F.lit(CELLS)).cast("int")


def _may(turn: int) -> F.Column:
    return (F.pmod(F.xxhash64("row", F.lit(turn)), F.lit(2)) == 0) & (F.col("gain") > 0)


def _cells(wishes: DataFrame, turn: int) -> list[Row]:
    """Counts by way, class of gain and cell: at most `CELLS` x 64 classes x ways of them, whatever the number of rows."""
    facts = [F.count(F.when(_may(turn), 1)).alias("n"), F.count(F.when(F.col("gain") > 0, 1)).alias("wish"), F.sum("lost").alias("lost")]
    wish = F.col("gain") > 0
    key = [F.col("shard").alias("source"), F.when(wish, F.col("target")).otherwise(F.col("shard")).alias("target"), F.when(wish, _gain_class()).otherwise(-1).alias("class"), F.when(wish, _cell(turn)).otherwise(-1).alias("cell")]
    return wishes.where("lost > 0").groupBy(*key).agg(*facts).collect()


def _taken(cells: list[Row], allowed: dict[tuple[int, int], int]) -> tuple[dict[tuple[int, int], tuple[int, int] | None], dict[tuple[int, int], int]]:
    """Per way the class and cell before which all move, or None if all of the way do, and how many rows that is: those of most gain first, as far as the way allows."""
    before: dict[tuple[int, int], tuple[int, int] | None] = {}
    moved: dict[tuple[int, int], int] = {}
    for r in sorted(cells, key=lambda r: (-r["class"], r["cell"])):
        way = r["source"], r["target"]
        if not r["n"] or before.setdefault(way, None) is not None:
            continue
        if moved.get(way, 0) + r["n"] <= allowed.get(way, 0):
            moved[way] = moved.get(way, 0) + r["n"]
        else:
            before[way] = (r["class"], r["cell"])
    return {way: end for way, end in before.items() if moved.get(way)}, moved


def _moved(taken: dict[tuple[int, int], tuple[int, int] | None], turn: int) -> F.Column:
    """A row's shard after the round."""
    moves = F.lit(False)
    for (source, target), end in taken.items():
        way = (F.col("shard") == source) & (F.col("target") == target)
        if end is not None:
            way &= (_gain_class() > end[0]) | ((_gain_class() == end[0]) & (_cell(turn) < end[1]))
        moves |= way
    return F.when(_may(turn) & moves, F.col("target")).otherwise(F.col("shard"))


def settle(edges: DataFrame, labels: DataFrame, quotas: list[int]) -> DataFrame:
    """`labels` with every group whole in one shard, where the quotas hold it; `edges` are stars, from a group's first row `a`.

    Groups are packed by size, the largest first, into the shard most of their rows are in, else into the fullest that holds them
    whole. One that no shard holds any more is cut into as few pieces as the room allows. Only counts by size and shard reach the driver.
    """
    members = edges.select(F.col("a").alias("group"), F.col("b").alias("row"))
    members = members.unionByName(edges.select(F.col("a").alias("group"), F.col("a").alias("row")).distinct())
    parts = members.join(labels, "row").groupBy("group", "shard").agg(F.count("*").alias("n"))
    groups = checkpointed(
        parts.groupBy("group").agg(F.sum("n").alias("whole"), F.max(F.struct("n", "shard"))["shard"].alias("main"), F.count("*").alias("parts"))
    )
    counted = groups.groupBy("whole", "main").agg(F.count("*").alias("n"), F.max("parts").alias("parts"), F.sum("whole").alias("rows")).collect()
    if all(r["parts"] == 1 for r in counted):
        return labels
    spark, rows = edges.sparkSession, sum(r["rows"] for r in counted)
    pieces = spark.createDataFrame(
        _pack({(r["whole"], r["main"]): r["n"] for r in counted}, quotas), "whole long, main int, low long, high long, begin long, end long, target int"
    )
    placed = ranked(groups, ["whole", "main"], ["group"], rows, "place").join(F.broadcast(pieces), ["whole", "main"])
    placed = checkpointed(placed.where("place >= low AND place < high AND (parts > 1 OR target <> main OR end - begin < whole)"))
    moves = members.join(placed.where("end - begin = whole").select("group", "target"), "group").select("row", "target")
    # A cut group's first row lies in its first piece, which is the largest.
    cut = placed.where("end - begin < whole").select("group", "begin", "end", "target")
    inside = ranked(members.where("row <> group").join(F.broadcast(cut.select("group").distinct()), "group"), ["group"], ["row"], rows, "rank")
    inside = inside.select("group", "row", (F.col("rank") + 1).alias("rank")).unionByName(cut.where("begin = 0").selectExpr("group", "group AS row", "0L AS rank"))
    split = inside.join(F.broadcast(cut), "group").where("rank >= begin AND rank < end").select("row", "target")
    moves = moves.unionByName(split)
    return checkpointed(labels.join(moves, "row", "left").select("row", F.coalesce("target", "shard").alias("shard")))


def _pack(counts: dict[tuple[int, int], int], quotas: list[int]) -> list[tuple[int, int, int, int, int, int, int]]:
    """Where groups go, by their size and main shard: of the groups ranked `low` to `high`, the rows `begin` to `end` go to a shard."""
    room, out = list(quotas), []
    todo = [(-size, main, 0, n, 0, size) for (size, main), n in counts.items()]
    heapify(todo)
    while todo:
        size, equal = -todo[0][0], []
        while todo and -todo[0][0] == size:
            equal.append(list(heappop(todo)[1:]))

        def put(item: list[int], n: int, shard: int) -> None:
            main, low, _, begin, whole = item
            if n:
                out.append((whole, main, low, low + n, begin, begin + size, shard))
                room[shard] -= n * size
                item[1], item[2] = low + n, item[2] - n

        for item in equal:
            if item[3] == 0:
                put(item, min(item[2], room[item[0]] // size), item[0])
        for shard in sorted(range(len(room)), key=lambda s: (room[s], s)):
            for item in equal:
                put(item, min(item[2], room[shard] // size), shard)
        # Fewer groups than shards are left, as all rows together fit.
        for main, low, n, begin, whole in equal:
            for rank in range(low, low + n):
                shard = max(range(len(room)), key=lambda s: (room[s], s == main))
                piece = room[shard]
                out.append((whole, main, rank, rank + 1, begin, begin + piece, shard))
                room[shard] = 0
                heappush(todo, (piece - size, main, rank, 1, begin + piece, whole))
    return out


def _allowed(wanted: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], int]:
    """How many rows may move from a shard to another: those that change places around a ring, and then what the room lets in."""
    allowed, left = dict.fromkeys(wanted, 0), dict(wanted)
    while ring := _ring(left):
        n = min(left[way] for way in ring)
        for way in ring:
            left[way] -= n
            allowed[way] += n
    for way in sorted(left):
        n = min(left[way], room[way[1]])
        room[way[1]] -= n
        allowed[way] += n
    return allowed


def _ring(ways: dict[tuple[int, int], int]) -> list[tuple[int, int]]:
    """A shortest ring of ways that are wanted, or nothing."""
    onward: dict[int, list[int]] = {}
    for (a, b), n in sorted(ways.items()):
        if n:
            onward.setdefault(a, []).append(b)
    best: list[int] = []
    for start in sorted(onward):
        trails, seen = [[start]], {start}
        while trails and not (best and len(trails[0]) >= len(best)):
            trail = trails.pop(0)
            for b in onward.get(trail[-1], ()):
                if b == start:
                    best = [*trail, start]
                    trails = []
                    break
                if b not in seen:
                    seen.add(b)
                    trails.append([*trail, b])
    return list(zip(best, best[1:]))


def _even(quotas: list[int], count: int) -> list[int]:
    """How many of `count` rows each shard begins with: its share, never more than its quota."""
    total, starts = max(1, sum(quotas)), []
    for quota in quotas:
        starts.append(min(quota, count * quota // total))
    for shard, quota in enumerate(quotas):
        add = min(quota - starts[shard], count - sum(starts))
        starts[shard] += add
    return starts


def _shard_of(rank: str, sizes: list[int]) -> F.Column:
    """The shard of a rank when shards take `sizes` of consecutive ranks."""
    shard, end = F.lit(len(sizes) - 1), sum(sizes)
    for s in range(len(sizes) - 2, -1, -1):
        end -= sizes[s + 1]
        shard = F.when(F.col(rank) < end, s).otherwise(shard)
    return shard.cast("int")


def shard_documents(
    documents: DataFrame, shards: int = SHARDS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """`doc_id`, `size`, `text_crc32`, `law`, `shard`, `slot`, `grown_shard`, `cut` for each row of `documents`.

    The law is `rows`: counts of shards differ by one at most. Documents of equal text are linked; balanced
    label propagation brings them together, groups it leaves apart are settled, and documents without links fill what the quotas leave. `cut`
    says that a linked document lies apart from the first of its text. A null text is empty: size 1,
    checksum 0, and linked with empty texts. Repeated rows are documents of their own, null ids are kept,
    other columns are ignored, an empty table gives no rows. A group larger than a shard is cut, for the law.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = stage(
        documents.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_column).alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("text_key"),
        ),
        "shard-rows",
    )
    count = rows.count()
    quotas = [count // shards + (s < count % shards) for s in range(shards)]
    edges = stage(group_links(rows, count), "shard-links")
    labels = settle(edges, propagate(edges, quotas), quotas)
    held = {r["shard"]: r["n"] for r in labels.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    free = rows.join(labels, "row", "left_anti").select("row")
    sizes = [quota - held.get(s, 0) for s, quota in enumerate(quotas)]
    filled = ranked(free, [], ["row"], count, "rank").select("row", _shard_of("rank", sizes).alias("shard"))
    placed = stage(rows.join(labels.unionByName(filled), "row"), "shard-placed")
    heads = labels.withColumnsRenamed({"row": "a", "shard": "head"})
    apart = edges.join(heads, "a").join(labels.withColumnRenamed("row", "b"), "b").where("head <> shard").select(F.col("b").alias("row"), F.lit(True).alias("cut"))
    return (
        ranked(placed, ["shard"], ["row"], count, "slot")
        .join(apart, "row", "left")
        .select(
            "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"), F.coalesce("cut", F.lit(False)).alias("cut"),
        )
    )
