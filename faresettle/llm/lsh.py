"""Embedding near-duplicates: cross-polytope hashing after fast Hadamard rotations, multiprobe buckets, verified pairs."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, DoubleType, FloatType, MapType, StructType, TimestampType, VariantType

from faresettle.llm.components import Forest, connected_components
from faresettle.llm.staging import stage

LEAST_COSINE = 0.98
SEED = 20240517
ROTATIONS = 3
PROBES = 4
# Vectors of one bucket that one task compares; larger buckets are dealt to blocks, and each pair of blocks is a task's work.
BUCKET_BLOCK = 400
# Vectors a bucket should hold by chance, from which the number of hashes in a bucket's name follows.
BUCKET_AIM = 1


def hadamard(rows: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row; the width is a power of two."""
    width, step = rows.shape[1], 1
    while step < width:
        halves = rows.reshape(len(rows), -1, 2, step)
        rows = np.stack((halves[:, :, 0] + halves[:, :, 1], halves[:, :, 0] - halves[:, :, 1]), axis=2).reshape(len(rows), width)
        step *= 2
    return rows


def buckets(vectors: np.ndarray, tables: int, hashes: int, probes: int) -> np.ndarray:
    """Buckets as longs, (vectors, tables, probes): the vector's own first, then those nearest in order.

    A hash is the axis, with its sign, nearest to the rotated vector. The other probes exchange one hash
    of the bucket's name for its second or third nearest axis, those that lose least first.
    """
    width = 1 << max(1, (vectors.shape[1] - 1).bit_length())
    padded = np.zeros((len(vectors), width))
    padded[:, : vectors.shape[1]] = vectors
    rng = np.random.default_rng(SEED)
    out = np.empty((len(vectors), tables, probes), np.int64)
    near = min(3, width)
    for table in range(tables):
        names = np.empty((len(vectors), hashes, near), np.int64)
        losses = np.empty((len(vectors), hashes, near))
        for k in range(hashes):
            turned = padded
            for _ in range(ROTATIONS):
                turned = hadamard(turned * rng.choice((-1.0, 1.0), width)) / math.sqrt(width)
            size = np.abs(turned)
            axes = np.argsort(-size, axis=1, kind="stable")[:, :near]
            top = np.take_along_axis(size, axes, 1)
            names[:, k] = axes * 2 + (np.take_along_axis(turned, axes, 1) < 0)
            losses[:, k] = top[:, :1] - top
        weight = (2 * width) ** np.arange(hashes, dtype=np.int64)
        own = (names[:, :, 0] * weight).sum(1)
        out[:, table, 0] = own
        changed = (own[:, None, None] + (names[:, :, 1:] - names[:, :, :1]) * weight[None, :, None]).reshape(len(own), -1)
        order = np.argsort(losses[:, :, 1:].reshape(len(own), -1), axis=1, kind="stable")[:, : probes - 1]
        out[:, table, 1:] = np.take_along_axis(changed, order, 1) if order.shape[1] == probes - 1 else own[:, None]
    return out


def _units(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows with as many components each, and their vectors scaled to length one in double precision."""
    sizes = np.diff(np.asarray(column.offsets))
    for dim in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == dim)
        vectors = np.asarray(column.take(pa.array(rows)).flatten(), np.float64).reshape(-1, dim)
        scaled = vectors / np.abs(vectors).max(1, keepdims=True)
        yield rows, scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


ENTRY = "tab int, bucket long, own boolean, key long, label string, dim int"


def _entries(batches: Iterator[pa.RecordBatch], tables: int, hashes: int, probes: int) -> Iterator[pa.RecordBatch]:
    """The buckets that each vector owns or probes, without the vectors."""
    for batch in batches:
        for rows, unit in _units(batch.column(2)):
            names = buckets(unit, tables, hashes, probes)
            # Probes that are none (few axes) repeat the own bucket.
            new = (names != names[:, :, :1]) | (np.arange(probes) == 0)
            of, table, probe = np.nonzero(new)
            pick = pa.array(rows[of])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(table.astype(np.int32)), pa.array(names[new]), pa.array(probe == 0), batch.column(0).take(pick), batch.column(1).take(pick),
                    pa.array(np.full(len(of), unit.shape[1], np.int32)),
                ],
                [x.split()[0] for x in ENTRY.split(", ")],
            )


def _pairs(batches: Iterator[pa.RecordBatch], tables: int, hashes: int, probes: int, least: float, block: int) -> Iterator[pa.RecordBatch]:
    """`key`, `weight` (of its partners), `root`: what the buckets of one partition link."""
    batches = list(batches)
    if not batches:
        return
    table = pa.Table.from_batches(batches).combine_chunks()
    column = {c: table.column(c).to_numpy() for c in ("tab", "bucket", "dim", "low", "high", "part", "own", "key", "weight")}
    column["label"] = _whole(table.column("label")).dictionary_encode().indices.to_numpy()
    order = np.lexsort(tuple(column[c] for c in ("high", "low", "bucket", "tab", "dim", "label")))
    sorted_by = [column[c][order] for c in ("high", "low", "bucket", "tab", "dim", "label")]
    new = np.ones(len(order), bool)
    new[1:] = np.any([x[1:] != x[:-1] for x in sorted_by], axis=0)
    keys, local = np.unique(column["key"], return_inverse=True)
    weights = np.zeros(len(keys), np.int64)
    weights[local] = column["weight"]
    partners, forest = np.zeros(len(keys), np.int64), Forest(len(keys))
    # Each vector once, however many buckets it came with.
    _, once = np.unique(column["key"], return_index=True)
    units: list[np.ndarray] = [np.zeros(0)] * len(keys)
    names = np.zeros((len(keys), tables, probes), np.int64)
    for rows, unit in _units(_whole(table.column("embedding").take(pa.array(once)))):
        names[rows] = buckets(unit, tables, hashes, probes)
        for row, vector in zip(rows.tolist(), unit):
            units[row] = vector
    ends = np.append(np.flatnonzero(new)[1:], len(order))
    for begin, end in zip(np.flatnonzero(new).tolist(), ends.tolist()):
        rows = order[begin:end]
        own = column["own"][rows]
        if end - begin < 2 or not own.any():
            continue
        unit = np.stack([units[k] for k in local[rows].tolist()])
        name = names[local[rows]]
        low, high, part = (int(column[c][rows[0]]) if c != "part" else column[c][rows] for c in ("low", "high", "part"))
        at, key = int(column["tab"][rows[0]]), column["key"][rows]
        members = np.flatnonzero(own)
        for step in range(0, len(rows), block):
            left = np.arange(step, min(step + block, len(rows)))
            a, b = np.nonzero(unit[left] @ unit[members].T >= least)
            a, b = left[a], members[b]
            # Two members meet once; in a pair of blocks, rows of different blocks only.
            kept = np.where(own[a], key[a] < key[b], key[a] != key[b])
            if low != high:
                kept &= part[a] != part[b]
            a, b = a[kept], b[kept]
            # Members of one bucket, or the first's probe; the other's probe comes here too if its bucket isn't this one.
            if len(a):
                for low_pair in range(0, len(a), 1 << 18):
                    x, y = a[low_pair : low_pair + (1 << 18)], b[low_pair : low_pair + (1 << 18)]
                    first = _first_meeting(name[x], name[y], at, key[x] < key[y], own[x])
                    x, y = local[rows[x[first]]], local[rows[y[first]]]
                    np.add.at(partners, x, weights[y])
                    np.add.at(partners, y, weights[x])
                    forest.add(x, y)
    linked = np.flatnonzero(partners)
    yield pa.RecordBatch.from_arrays(
        [pa.array(keys[linked]), pa.array(partners[linked]), pa.array(keys[forest.label[linked]])], ["key", "weight", "root"]
    )


def _whole(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)


def _first_meeting(x: np.ndarray, y: np.ndarray, table: int, smaller: np.ndarray, both_own: np.ndarray) -> np.ndarray:
    """Whether pairs (`x` probes or owns the bucket, `y` owns it) meet nowhere before; each pair counts once over all buckets."""
    first = np.ones(len(x), bool)
    for earlier in range(table):
        meet = (x[:, earlier] == y[:, earlier, :1]).any(1) | (y[:, earlier] == x[:, earlier, :1]).any(1)
        first &= ~meet
    # In this table the pair meets in y's bucket and perhaps also in x's, where y probes.
    also = (y[:, table] == x[:, table, :1]).any(1) & ~both_own
    return first & (~also | smaller)


def label_text(label: str, kind: DataType) -> Column:
    """A label of any type as text that is equal where labels are: zeros of both signs are one, instants go by their number."""
    if isinstance(kind, (FloatType, DoubleType)):
        return (F.col(label) + F.lit(0.0)).cast("string")
    if isinstance(kind, TimestampType):
        return F.unix_micros(label).cast("string")
    if isinstance(kind, BinaryType):
        return F.hex(label)
    return F.to_json(label) if isinstance(kind, (ArrayType, MapType, StructType, VariantType)) else F.col(label).cast("string")


def near_vectors(
    embeddings: DataFrame, least_cosine: float = LEAST_COSINE, probes: int = PROBES, bucket_block: int = BUCKET_BLOCK, hashes: int | None = None
) -> DataFrame:
    """`vec_id`, `n_links`, `component_id`, `kept` per row of `embeddings` (`vec_id`, `embedding`, `label`).

    Vectors link if their labels, of any type, are equal and not null, they have equal numbers of components, and their cosine is
    `least_cosine` or more in double precision. Vectors that are null, empty or zero, or hold null or non-finite components,
    link with nothing. Equal vectors are compared once and count as often as they occur; repeated rows are vectors of
    their own. Null ids stay null and are a component's id only if all its ids are null. Other columns are ignored; an empty table
    gives no rows. Pairs below the threshold are never linked; pairs above it are found if they share a bucket among
    the probes of any table, which tests measure against all pairs.
    """
    doubles = F.transform("embedding", lambda x: x.cast("double"))
    valid = F.coalesce(
        F.col("label").isNotNull()
        & F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
        & F.exists("embedding", lambda x: x != 0),
        F.lit(False),
    )
    rows = embeddings.select("vec_id", label_text("label", embeddings.schema["label"].dataType).alias("label"), doubles.alias("embedding"), valid.alias("valid"))
    marks = [F.when(F.col("valid"), F.xxhash64(F.lit(k), "embedding")).alias(f"mark{k}") for k in (1, 2)]
    rows = rows.select("vec_id", "label", "embedding", "valid", *marks)
    same = ["label", "mark1", "mark2"]
    classes = (
        rows.where("valid")
        .groupBy(*same)
        .agg(F.first("embedding").alias("embedding"), F.count("*").alias("weight"), F.min("vec_id").alias("smallest"))
        .select(F.monotonically_increasing_id().alias("key"), *same, "embedding", "weight", "smallest")
    )
    classes = stage(classes, "vector-classes")
    count, width = classes.agg(F.count("*"), F.max(F.size("embedding"))).first()
    if hashes is None:
        hashes = max(2, math.ceil(math.log(max(2.0, count / BUCKET_AIM)) / math.log(2 * max(2, width or 2))))
    # The name of a bucket has to fit in a long.
    hashes = min(hashes, 62 // (1 + max(1, ((width or 2) - 1).bit_length())))
    tables = 2 * hashes
    entries = stage(classes.select("key", "label", "embedding").mapInArrow(lambda x: _entries(x, tables, hashes, probes), ENTRY), "vector-buckets")
    place = ["tab", "bucket", "label", "dim"]
    # Most buckets hold one vector or are only probed; the vectors themselves go to the others.
    shared = entries.groupBy(*place).agg(F.count("*").alias("n"), F.max("own").alias("owned")).where("n > 1 AND owned")
    shared = shared.select(*place, F.ceil(F.col("n") / bucket_block).cast("int").alias("blocks"))
    dealt = entries.join(shared, place).withColumn("part", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("against", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"low": F.least("part", "against"), "high": F.greatest("part", "against")}).drop("blocks", "against")
    dealt = dealt.join(classes.select("key", "weight", "embedding"), "key")
    found = stage(
        dealt.repartition(*place, "low", "high").mapInArrow(
            lambda x: _pairs(x, tables, hashes, probes, least_cosine, bucket_block), "key long, weight long, root long"
        ),
        "vector-links",
    )
    links = found.groupBy("key").agg(F.sum("weight").alias("links"))
    stars = connected_components(found.select(F.col("key").alias("a"), F.col("root").alias("b")))
    rooted = classes.join(links, "key", "left").join(stars.withColumnRenamed("node", "key"), "key", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "key"))
    smallest = rooted.groupBy("root").agg(F.min("smallest").alias("component_id"))
    facts = rooted.join(smallest, "root").select(
        *same, (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id"
    )
    out = rows.select("vec_id", "valid", *same).join(facts, same, "left")
    component = F.when(F.col("valid"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
