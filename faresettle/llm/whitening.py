"""Whitening by Golub-Kahan-Lanczos bidiagonalisation of the centred vectors, which stay distributed."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from faresettle.llm.staging import stage

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
# Vectors of a block, and so of a matrix product in a task.
BLOCK = 8_192
# Up to this width the bidiagonal form is complete; beyond, it ends when the wanted components have converged.
WHOLE = 256
# So many numbers are summed up as columns of one row.
ONE_ROW = 300
CONVERGED = 1e-13
# Variances below this share of the largest are rounding, not components.
NOTHING = 1e-12
# Entries of 64 c beyond this are out of range: n x stays a long for any n below 2^32.
LARGEST = 2.0**31
SEED = 13

BLOCKS = "ids array<bigint>, width int, x binary"
OUTPUT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def _rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Flat entries as doubles, where each vector begins, and which vectors are whole: not null, every entry finite and in range."""
    vectors = batch.column("vector")
    vectors = vectors.cast(pa.large_list(pa.float64()))
    offsets = vectors.offsets.to_numpy()
    flat = vectors.values.slice(offsets[0], offsets[-1] - offsets[0]).to_numpy(zero_copy_only=False)
    begin = offsets - offsets[0]
    with np.errstate(invalid="ignore", over="ignore"):
        bad = np.concatenate([[0], np.cumsum(~(np.abs(flat * SCALE) <= LARGEST))])
    good = (bad[begin[1:]] == bad[begin[:-1]]) & ~vectors.is_null().to_numpy(zero_copy_only=False)
    return flat, begin, good


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole vectors as blocks of one width, their entries floor(64 c) + 1000000 as bytes."""
    schema = pa.schema([("ids", pa.list_(pa.int64())), ("width", pa.int32()), ("x", pa.binary())])
    for batch in batches:
        flat, begin, good = _rows(batch)
        ids, widths = batch.column("vec_id"), np.diff(begin)
        for width in np.unique(widths[good]):
            rows = np.flatnonzero(good & (widths == width))
            for low in range(0, len(rows), BLOCK):
                some = rows[low : low + BLOCK]
                x = np.floor(flat[begin[some][:, None] + np.arange(width)] * SCALE).astype(np.int64) + SHIFT
                yield pa.RecordBatch.from_pylist([{"ids": ids.take(pa.array(some)).to_pylist(), "width": int(width), "x": x.tobytes()}], schema)


def fit_list(embeddings: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """Blocks of the vectors that count, staged: those without null, non-finite or immense entries, of the commonest width, of equal ones the widest."""
    vectors = embeddings.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector"))
    blocks = stage(vectors.mapInArrow(_pack, BLOCKS), "whiten-blocks")
    widths = blocks.where("width > 0").groupBy("width").agg(F.sum(F.size("ids")).alias("n")).orderBy(F.desc("n"), F.desc("width")).first()
    return blocks.where(F.col("width") == (widths["width"] if widths else -1))


class Centred:
    """The centred vectors as an operator: products with them are Spark jobs, of which only vectors of the width reach the driver."""

    def __init__(self, blocks: DataFrame) -> None:
        self.blocks = blocks
        facts = blocks.agg(F.sum(F.size("ids")).alias("n"), F.max("width").alias("width")).first()
        self.n, self.width = facts["n"] or 0, facts["width"] or 0
        self.sums = np.zeros(self.width, np.int64)
        if self.n:
            self.sums = self._added(lambda x: x.sum(0), self.width, "bigint", np.int64)

    def _added(self, of: Callable[[np.ndarray], np.ndarray], size: int, kind: str = "double", dtype: type = np.float64) -> np.ndarray:
        """The sum over blocks of the `size` numbers that `of` makes of each; summed up in executors.

        Few numbers are columns of one row, so that a step is a job without shuffled keys.
        """
        width = self.width

        def total(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
            out = None
            for batch in batches:
                for x in batch.column("x"):
                    part = of(np.frombuffer(x.as_buffer(), np.int64).reshape(-1, width))
                    out = part if out is None else out + part
            return out

        def one_row(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if (out := total(batches)) is not None:
                yield pa.RecordBatch.from_pydict({"value": [out.tolist()]})

        def row_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if (out := total(batches)) is not None:
                yield pa.RecordBatch.from_pydict({"at": np.arange(size, dtype=np.int32), "value": out})

        x = self.blocks.select("x")
        if size <= ONE_ROW:
            sums = x.mapInArrow(one_row, f"value array<{kind}>").agg(*[F.sum(F.col("value")[k]).alias(f"v{k}") for k in range(size)]).first()
            return np.array([v or 0 for v in sums], dtype)
        sums = x.mapInArrow(row_each, f"at int, value {kind}").groupBy("at").agg(F.sum("value").alias("value")).toArrow()
        out = np.zeros(size, dtype)
        out[sums["at"].to_numpy()] = sums["value"].to_numpy()
        return out

    def rows_of(self) -> Callable[[np.ndarray], np.ndarray]:
        """From a block to its centred rows: n x - S in whole numbers, then over n."""
        n, sums = self.n, self.sums
        return lambda x: (n * x - sums) / n

    def there_and_back(self, y: np.ndarray) -> tuple[np.ndarray, float]:
        """u = Xy, of which the rows stay in their tasks, then X'u and the square of u's length."""
        rows = self.rows_of()

        def product(x: np.ndarray) -> np.ndarray:
            a = rows(x)
            u = a @ y
            return np.append(a.T @ u, u @ u)

        out = self._added(product, self.width + 1)
        return out[:-1], float(out[-1])

    def total_squares(self) -> float:
        rows = self.rows_of()
        return float(self._added(lambda x: np.array([np.square(rows(x)).sum()]), 1)[0])


def bidiagonalise(centred: Centred, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Singular values of the centred rows, falling, and right singular vectors as columns.

    Each step takes u = Xv less its part along earlier left vectors, then w = X'u less its part along earlier right vectors. Left vectors are as
    long as the table: they are never held, but made anew in each task as X y from the short y that the driver keeps, so
    a lost executor loses nothing. u's part along an earlier left vector is v times X'u of that one, which is known. When w
    vanishes, a fresh direction goes on, so that equal singular values are found as often as they come.
    """
    width = centred.width
    rng = np.random.default_rng(SEED)
    right, ys, backs, alphas, betas = np.zeros((width, 0)), np.zeros((width, 0)), np.zeros((width, 0)), [], []
    scale, v = np.sqrt(centred.total_squares()), None
    if not scale:
        return np.zeros(0), np.zeros((width, 0))
    fresh = True
    while right.shape[1] < width:
        if fresh:
            v = _orthogonal(rng.standard_normal(width), right)
            v /= np.linalg.norm(v)
        right = np.column_stack([right, v])
        # Xv without its part along the left vectors, told as X y; its own length and way back are measured.
        y = v - ys @ (backs.T @ v)
        back, square = centred.there_and_back(y)
        left = backs.T @ y
        if square > 0 and np.abs(left).max(initial=0) > 1e-10 * np.sqrt(square):
            y = y - ys @ left
            back, square = centred.there_and_back(y)
        alpha = np.sqrt(square)
        if alpha <= 1e-14 * scale:
            y, back, alpha = np.zeros(width), np.zeros(width), 0.0
        else:
            y, back = y / alpha, back / alpha
        ys, backs = np.column_stack([ys, y]), np.column_stack([backs, back])
        alphas.append(alpha)
        w = _orthogonal(back, right)
        beta = np.linalg.norm(w)
        fresh = beta <= 1e-14 * scale
        betas.append(0.0 if fresh else beta)
        v = None if fresh else w / beta
        if width > WHOLE and len(alphas) >= wanted and len(alphas) % 8 == 0:
            p, sigma, _ = np.linalg.svd(_bidiagonal(alphas, betas))
            if (np.abs(betas[-1] * p[-1, :wanted]) <= CONVERGED * sigma[0]).all():
                break
    _, sigma, q = np.linalg.svd(_bidiagonal(alphas, betas))
    return sigma, right @ q.T


def _bidiagonal(alphas: list[float], betas: list[float]) -> np.ndarray:
    return np.diag(alphas) + np.diag(betas[: len(alphas) - 1], 1)


def _orthogonal(w: np.ndarray, right: np.ndarray) -> np.ndarray:
    """`w` without its part along the columns of `right`; twice, as once leaves rounding."""
    for _ in range(2):
        w = w - right @ (right.T @ w)
    return w


def whitener(centred: Centred, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, float]:
    """Projections as columns, already over the deviations; each one's share of the variance; the greatest entry of the measured covariance less one."""
    sigma, vectors = bidiagonalise(centred, components)
    keep = min(components, int((np.square(sigma) > NOTHING * np.square(sigma).max(initial=0)).sum()))
    sigma, vectors = sigma[:keep], vectors[:, :keep]
    if not keep:
        return np.zeros((centred.width, 0)), np.zeros(0), 0.0
    project = vectors / (sigma / np.sqrt(centred.n))
    rows = centred.rows_of()

    def products(x: np.ndarray) -> np.ndarray:
        white = rows(x) @ project
        return (white.T @ white).ravel()

    covariance = centred._added(products, keep * keep).reshape(keep, keep) / centred.n
    return project, np.square(sigma) / centred.total_squares(), float(np.abs(covariance - np.eye(keep)).max())


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Of each row, the sum of (n x - S)^2; exact, null where a long doesn't hold it."""
    differ = n * x - sums
    most = int(np.abs(differ).max(initial=0))
    if most * most * differ.shape[1] < 1 << 63:
        return np.square(differ).sum(1).tolist()
    exact = (differ.astype(object) ** 2).sum(1).tolist()
    return [d if d < 1 << 63 else None for d in exact]


def whiten(embeddings: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """`vec_id`, `component`, `n`, `deviation`, `whitened`, `explained`, `identity_error` for each vector and each of the first components.

    Entries c count as x = floor(64 c) + 1000000. Vectors that are null, hold null, NaN or infinite entries, or entries beyond 2^25, are left out, and so are those
    that have another width than most (ties: the widest stays) or none. Components are numbered from 1 by falling variance; directions without variance are none, so equal vectors or a
    single one give no rows, as does an empty table. Null ids stay null, repeated rows count each time, other columns are ignored. A
    `deviation` beyond a long is null.
    """
    blocks = fit_list(embeddings, id_column, vector_column)
    centred = Centred(blocks)
    project, explained, error = whitener(centred, components)
    n, sums, width, keep = centred.n, centred.sums, centred.width, project.shape[1]
    rows = centred.rows_of()

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, data in zip(batch.column("ids"), batch.column("x")):
                x = np.frombuffer(data.as_buffer(), np.int64).reshape(-1, width)
                if not keep:
                    continue
                ids = ids.values
                count = len(x)
                each = pa.array(np.repeat(np.arange(count), keep))
                yield pa.RecordBatch.from_pydict({
                    "vec_id": ids.take(each),
                    "component": np.tile(np.arange(1, keep + 1, dtype=np.int32), count),
                    "n": np.full(count * keep, n, np.int64),
                    "deviation": pa.array(_deviations(x, n, sums), pa.int64()).take(each),
                    "whitened": (rows(x) @ project).ravel(),
                    "explained": np.tile(explained, count),
                    "identity_error": np.full(count * keep, error),
                })

    return blocks.select("ids", "x").mapInArrow(emit, OUTPUT)
