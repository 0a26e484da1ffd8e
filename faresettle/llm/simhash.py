"""SimHash near-duplicates by a self-join of binary tries."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from faresettle.llm.components import Forest, connected_components
from faresettle.llm.staging import stage
from faresettle.llm.utf8 import values

SHINGLE_WORDS = 3
MOST_BITS = 3
SEED = 42
# A trie whose root holds more fingerprints than this is split over tasks, at its next levels.
TRIE_ROOT = 50_000
SPLIT_BITS = 6
# Node pairs that one step of a traversal holds in memory.
FRONTIER = 1 << 17
# Two nodes with this many pairs of fingerprints or fewer are compared at once.
SMALL = 16


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of UTF-8 text, signed; shingles count as often as they occur."""
    tokens = text.lower().split()
    if not tokens:
        return 0
    line = b" ".join(tokens)
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    span = min(words, len(tokens))
    first = np.concatenate(([0], gaps + 1))[: len(tokens) - span + 1].tolist()
    last = np.concatenate((gaps, [len(line)]))[span - 1 :].tolist()
    hashed = partial(xxhash.xxh64_intdigest, seed=SEED)
    ones = np.zeros(64, np.int64)
    for low in range(0, len(first), 65536):
        hashes = np.fromiter((hashed(line[a:b]) for a, b in zip(first[low : low + 65536], last[low : low + 65536])), np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(first), bitorder="little").view(np.int64)[0])


def fingerprints(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """`doc_id`, `bits` (a signed long) per row of `documents`; a null text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [fingerprint(text, words) for text in values(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits, pa.int64())], ["doc_id", "bits"])

    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(run, "doc_id long, bits long")


def trie_pairs(
    bits: np.ndarray, nodes: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], depth: int, budget: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indexes of pairs of `bits` at `budget` or fewer differing bits, below the given pairs of trie nodes.

    `bits` (unsigned) are sorted within each node, a node being a range of them that agrees in its
    first `depth` bits. A pair of nodes is low and high of the one, low and high of the other, and the
    bits in which the two prefixes differ; a node paired with itself yields each pair once.
    """
    waiting = [(depth, nodes)]
    while waiting:
        depth, (low1, high1, low2, high2, off) = waiting.pop()
        if len(low1) > FRONTIER:
            half = len(low1) // 2
            for part in (slice(half, None), slice(half)):
                waiting.append((depth, tuple(x[part] for x in (low1, high1, low2, high2, off))))
            continue
        size1, size2 = high1 - low1, high2 - low2
        # A node paired with itself at the last bit holds equal fingerprints only.
        done = (size1 * size2 <= SMALL) | (depth == 64)
        if done.any():
            yield from _compare(bits, low1[done], size1[done], low2[done], size2[done], budget)
        if depth == 64 or done.all():
            continue
        low1, high1, low2, high2, off = (x[~done] for x in (low1, high1, low2, high2, off))
        mid1, mid2 = _split(bits, low1, high1, depth), _split(bits, low2, high2, depth)
        one = low1 == low2
        children = [
            (low1, mid1, low2, mid2, off),
            (mid1, high1, mid2, high2, off),
            (low1, mid1, mid2, high2, off + 1),
            tuple(x[~one] for x in (mid1, high1, low2, mid2, off + 1)),
        ]
        merged = tuple(np.concatenate(x) for x in zip(*children))
        kept = (merged[0] < merged[1]) & (merged[2] < merged[3]) & (merged[4] <= budget)
        kept &= ~((merged[0] == merged[2]) & (merged[1] - merged[0] < 2))
        if kept.any():
            waiting.append((depth + 1, tuple(x[kept] for x in merged)))


def _split(bits: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int) -> np.ndarray:
    """Where the ones of bit `depth` (from the left) begin in each range."""
    one = np.uint64(1 << (63 - depth))
    low, high = low.copy(), high.copy()
    while (open_ := low < high).any():
        middle = (low + high) >> 1
        zero = (bits[np.minimum(middle, len(bits) - 1)] & one) == 0
        low = np.where(open_ & zero, middle + 1, low)
        high = np.where(open_ & ~zero, middle, high)
    return low


def _compare(bits, low1, size1, low2, size2, budget) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    products = size1 * size2
    ends = np.cumsum(products)
    begin = 0
    while begin < len(products):
        stop = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + 4 * FRONTIER, "right")))
        part = slice(begin, stop)
        of = np.repeat(np.arange(begin, stop), products[part])
        rank = np.arange(len(of)) - np.repeat(ends[part] - products[part] - (ends[begin - 1] if begin else 0), products[part])
        left, right = low1[of] + rank // size2[of], low2[of] + rank % size2[of]
        near = (np.bitwise_count(bits[left] ^ bits[right]) <= budget) & ((low1[of] != low2[of]) | (left < right))
        yield left[near], right[near]
        begin = stop


def _links(batches: Iterator[pa.RecordBatch], budget: int, blocks: int) -> Iterator[pa.RecordBatch]:
    """Stars of the near pairs in one partition: each row is a fingerprint in a rotation, below a pair of nodes."""
    table = pa.Table.from_batches(batches) if (batches := list(batches)) else None
    if table is None or not table.num_rows:
        return
    turn, node1, node2 = (table.column(x).to_numpy() for x in ("turn", "node1", "node2"))
    bits = table.column("turned").to_numpy().view(np.uint64)
    width = 64 // blocks
    order = np.lexsort((bits, node2, node1, bits >> np.uint64(64 - width), turn))
    turn, node1, node2, bits = turn[order], node1[order], node2[order], bits[order]
    head = bits >> np.uint64(64 - width)
    new = np.ones(len(bits), bool)
    new[1:] = (turn[1:] != turn[:-1]) | (head[1:] != head[:-1]) | (node1[1:] != node1[:-1]) | (node2[1:] != node2[:-1])
    low = np.flatnonzero(new)
    high = np.append(low[1:], len(bits))
    forest = Forest(len(bits))
    whole = node1[low] == node2[low]
    many = high - low > 1
    a, b = low[whole & many], high[whole & many]
    for left, right in trie_pairs(bits, (a, b, a, b, np.zeros(len(a), np.int64)), width, budget):
        forest.add(left, right)
    if not whole.all():
        # Pairs of different nodes: the smaller node's fingerprints come first.
        a, b = low[~whole & many], high[~whole & many]
        below = (bits >> np.uint64(64 - width - SPLIT_BITS)) & np.uint64((1 << SPLIT_BITS) - 1)
        middle = a + np.array([int(np.searchsorted(below[x:y], node2[x])) for x, y in zip(a, b)], np.int64)
        apart = np.bitwise_count((node1[a] ^ node2[a]).astype(np.uint64)).astype(np.int64)
        for left, right in trie_pairs(bits, (a, middle, middle, b, apart), width + SPLIT_BITS, budget):
            forest.add(left, right)
    back = (turn * width).astype(np.uint64)
    plain = ((bits >> back) | np.where(back == 0, np.uint64(0), bits << ((np.uint64(64) - back) & np.uint64(63)))).view(np.int64)
    linked = np.flatnonzero(forest.label != np.arange(len(bits)))
    yield pa.RecordBatch.from_arrays([pa.array(plain[linked]), pa.array(plain[forest.label[linked]])], ["a", "b"])


def near_links(bits: DataFrame, most_bits: int = MOST_BITS, trie_root: int = TRIE_ROOT) -> DataFrame:
    """Edges `a`, `b` that join the same fingerprints as all pairs of `bits` at `most_bits` or fewer do.

    Two such fingerprints agree in one of `most_bits` + 1 blocks at least. For each block the bits
    are rotated so that it comes first; then tries whose first levels may not differ are joined
    with themselves, one task holding many of them. A trie with more than `trie_root` fingerprints is
    cut at its next levels, and every pair of nodes there that is within the budget becomes work
    of its own; the links are the same. Equal fingerprints count once and null ones link with nothing; other columns are ignored, an empty
    table gives no edges.
    """
    blocks = 1 << most_bits.bit_length()
    width = 64 // blocks
    turned = F.expr(f"shiftleft(bits, turn * {width}) | IF(turn = 0, 0L, shiftrightunsigned(bits, 64 - turn * {width}))")
    rows = (
        bits.where("bits IS NOT NULL")
        .select("bits")
        .distinct()
        .select("bits", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("turn"))
        .select(F.col("turn").cast("long").alias("turn"), turned.alias("turned"))
        .withColumn("head", F.shiftrightunsigned("turned", 64 - width))
    )
    large = rows.groupBy("turn", "head").count().where(F.col("count") > trie_root).select("turn", "head")
    plain = F.lit(-1).cast("long")
    work = rows.withColumns({"node1": plain, "node2": plain})
    if not large.isEmpty():
        node = F.expr(f"shiftrightunsigned(turned, {64 - width - SPLIT_BITS}) & {(1 << SPLIT_BITS) - 1}")
        near = F.expr(f"filter(sequence(0L, {(1 << SPLIT_BITS) - 1}L), x -> bit_count(x ^ node) <= {most_bits})")
        split = (
            rows.join(large, ["turn", "head"], "left_semi")
            .withColumn("node", node)
            .withColumn("other", F.explode(near))
            .withColumns({"node1": F.least("node", "other"), "node2": F.greatest("node", "other")})
        )
        work = rows.join(large, ["turn", "head"], "left_anti").withColumns({"node1": plain, "node2": plain})
        work = work.unionByName(split.select(*work.columns))
    return work.repartition("turn", "head", "node1", "node2").select("turn", "turned", "node1", "node2").mapInArrow(
        lambda batches: _links(batches, most_bits, blocks), "a long, b long"
    )


def near_duplicates(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = SHINGLE_WORDS,
    most_bits: int = MOST_BITS,
    trie_root: int = TRIE_ROOT,
) -> DataFrame:
    """`doc_id`, `fingerprint` (16 hex digits), `component_id` per row of `documents`.

    `component_id` is the smallest id reachable over fingerprints that differ in `most_bits` or fewer.
    Null and empty texts and texts of white space have the fingerprint zero and link as any other;
    repeated rows come out repeated, a null id stays null and never is a component's id unless
    all ids there are null; other columns are ignored; an empty table gives no rows.
    """
    rows, classes = _classified(documents, id_column, text_column, words, most_bits, trie_root)
    digits = F.lower(F.lpad(F.hex("bits"), 16, "0"))
    return rows.join(classes, "bits").select("doc_id", digits.alias("fingerprint"), "component_id")


def _classified(documents, id_column, text_column, words, most_bits, trie_root) -> tuple[DataFrame, DataFrame]:
    """`doc_id`, `bits` per row; `bits`, `root`, `component_id` per fingerprint, `root` being the same in a component."""
    rows = stage(fingerprints(documents, id_column, text_column, words), "simhash")
    distinct = rows.groupBy("bits").agg(F.min("doc_id").alias("first_id"))
    stars = connected_components(near_links(rows, most_bits, trie_root))
    roots = distinct.join(stars.withColumnRenamed("node", "bits"), "bits", "left").withColumn("root", F.coalesce("root", "bits"))
    smallest = roots.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rows, roots.join(smallest, "root").select("bits", "root", "component_id")


def keep_one(
    documents: DataFrame, words: int = SHINGLE_WORDS, most_bits: int = MOST_BITS, trie_root: int = TRIE_ROOT
) -> DataFrame:
    """The rows of `documents` (`doc_id`, `text`, any others that can be ordered) less near-duplicates: one of each component stays.

    It is the row with the smallest id; among rows that share that id, or have none in a component
    without ids, the smallest by text and the other columns.
    """
    rows, classes = _classified(documents, "doc_id", "text", words, most_bits, trie_root)
    classes = stage(classes, "simhash-classes")
    # All rows of an id count: one that leads its component may share its id with rows of others.
    leads = F.count(F.when(F.col("doc_id").eqNullSafe(F.col("component_id")), 1))
    kept = rows.join(classes, "bits").groupBy("doc_id").agg(F.count("*").alias("n"), leads.alias("leads")).where("leads > 0").drop("leads")
    kept = stage(kept, "simhash-kept")
    # The kept ids grow with the documents, so they are never broadcast; the texts move once.
    firsts = kept.where("n = 1 AND doc_id IS NOT NULL").select("doc_id").hint("merge")
    single = documents.join(firsts, "doc_id", "left_semi")
    several_id = max([c for c in documents.columns if c.startswith("_")], default="") + "_id"
    several = kept.where("n > 1 OR doc_id IS NULL").select(F.col("doc_id").alias(several_id))
    if several.isEmpty():
        return single.select(*documents.columns)
    odd = documents.join(several, F.col("doc_id").eqNullSafe(F.col(several_id)), "left_semi")
    bits = F.pandas_udf(lambda texts: texts.map(lambda text: fingerprint((text or "").encode(), words)), "long")
    ordered = F.struct("text", *(F.col(f"`{c}`") for c in documents.columns if c != "text"))
    one = (
        odd.select(ordered.alias("_row"), bits("text").alias("bits"))
        .join(classes, "bits")
        .where("_row.doc_id <=> component_id")
        .groupBy("root")
        .agg(F.min("_row").alias("_row"))
        .select("_row.*")
    )
    return single.select(*documents.columns).unionByName(one.select(*documents.columns))
