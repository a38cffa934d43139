"""Embedding whitening by hierarchical merging of singular value decompositions.

Entries become integers first, so means and deviations are exact. Each partition folds its vectors, a chunk at a time, into a
state: their number, the exact sums (hence means), and all singular values and right singular vectors of the centred vectors. Two states merge
by stacking their scaled vectors, with one row more that corrects for the distance of their means, and
decomposing the stack anew: sqrt(n m / (n + m)) (mean - mean'). Nothing is truncated, so the merge loses no dimension and its
singular values are those of all vectors together. States meet ``fanout`` at a time, level by level, each level written to the shared
folder; a state has at most d * d + 2 d numbers whatever the number of vectors, and no task sees more than ``fanout`` of them.

Components are the right singular vectors by falling singular value; the sign makes the entry of largest magnitude positive. Equal
eigenvalues leave their components' directions open.

Defined results: a null vector, and one with a null or non-finite entry or one beyond 2**52 in magnitude (1024 times it is no long), is left out;
so is one that has not the length most of the rest have (of equally frequent ones the shortest). A null id stays, rows that repeat are rows each.
Where a component's variance is zero to rounding, ``whitened`` is null and the component takes no part in ``identity_error``; without any variance
``explained`` and ``identity_error`` are null. Without vectors, and for vectors without entries, the result is empty. Other columns are not read.
"""

from __future__ import annotations

from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatledger.llm.common import batches, discard, materialise, read_table

#: Entries c become floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 1024, 100_000
#: Largest magnitude of an entry.
LIMIT = float(2**52)
LOW_BITS = 20
STATE = pa.schema([("node", pa.int64()), ("n", pa.int64()), ("sums", pa.list_(pa.decimal128(38, 0))), ("scales", pa.binary()), ("axes", pa.binary())])
STATE_DDL = "node long, n long, sums array<decimal(38,0)>, scales binary, axes binary"
RESULT_DDL = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double"


class State(NamedTuple):
    """Centred vectors folded: their number, exact sums, singular values, right singular vectors as rows."""

    n: int
    sums: list[int]
    scales: np.ndarray
    axes: np.ndarray


class Model(NamedTuple):
    """What whitening needs: number and exact sums of the vectors, leading components and their scales, and the trace."""

    n: int
    sums: list[int]
    axes: np.ndarray
    scales: np.ndarray
    total: float


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows (vec_id, v) whose entries are all there, finite and within the limit."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.filter(F.forall("v", lambda c: F.coalesce(F.abs(c) <= LIMIT, F.lit(False))) & (F.size("v") > 0))


def integers(column: pa.Array, dim: int) -> np.ndarray:
    """The entries of equally long lists as integers, a row a list."""
    c = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    return np.floor(SCALE * c).astype(np.int64) + OFFSET


def exact_sums(x: np.ndarray) -> list[int]:
    """Sums of each column, in parts that cannot pass 64 bits."""
    high, low = (x >> LOW_BITS).sum(axis=0).tolist(), (x & ((1 << LOW_BITS) - 1)).sum(axis=0).tolist()
    return [(h << LOW_BITS) + a for h, a in zip(high, low, strict=True)]


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums exactly: in longs where they suffice, else as Python's integers."""
    whole, rest = [s // n for s in sums], [s % n for s in sums]
    if all(abs(w) < 1 << 61 for w in whole) and n < 1 << 61 and np.abs(x).max(initial=0) < 1 << 61:
        gap = x - np.array(whole, np.int64)
        if int(np.abs(gap).max(initial=0)) * n < 1 << 61:
            return n * gap - np.array(rest, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def squares(d: np.ndarray) -> list[int]:
    """Sum of squares of each row, exactly."""
    if d.dtype != object and int(np.abs(d).max(initial=0)) ** 2 * d.shape[1] < 1 << 63:
        return (d * d).sum(axis=1).tolist()
    d = d.astype(object)
    return (d * d).sum(axis=1).tolist()


def decomposed(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Singular values and right singular vectors of all dimensions the rows span at most."""
    if rows.shape[0] > rows.shape[1]:
        rows = np.linalg.qr(rows, mode="r")
    _, scales, axes = np.linalg.svd(rows, full_matrices=False)
    return scales, axes


def folded(x: np.ndarray) -> State:
    sums = exact_sums(x)
    return State(len(x), sums, *decomposed(deviations(x, len(x), sums).astype(float) / len(x)))


def merged(a: State, b: State) -> State:
    """The state of the vectors of both."""
    gap = np.array([(s * b.n - t * a.n) / (a.n * b.n) for s, t in zip(a.sums, b.sums, strict=True)])
    correction = gap * np.sqrt(a.n * b.n / (a.n + b.n))
    stack = np.vstack([a.scales[:, None] * a.axes, b.scales[:, None] * b.axes, correction[None]])
    return State(a.n + b.n, [s + t for s, t in zip(a.sums, b.sums, strict=True)], *decomposed(stack))


def _row(node: int, s: State) -> pa.RecordBatch:
    columns = [[node], [s.n], [[Decimal(x) for x in s.sums]], [s.scales.tobytes()], [np.ascontiguousarray(s.axes).tobytes()]]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, STATE, strict=True)], schema=STATE)


def _state(n: int, sums: list, scales: bytes, axes: bytes) -> State:
    return State(n, [int(s) for s in sums], np.frombuffer(scales), np.frombuffer(axes).reshape(-1, len(sums)))


def _fold(dim: int, chunk_values: int):
    """The state of each partition's vectors."""
    rows = max(2, chunk_values // dim)

    def run(items):
        state = None
        for b in batches(items):
            for at in range(0, b.num_rows, rows):
                new = folded(integers(b.column(0).slice(at, rows), dim))
                state = new if state is None else merged(state, new)
        if state is not None:
            yield _row(TaskContext.get().partitionId(), state)

    return run


def _merge(key, table):
    state = None
    for r in table.sort_by("node").to_pylist():
        new = _state(r["n"], r["sums"], r["scales"], r["axes"])
        state = new if state is None else merged(state, new)
    return pa.Table.from_batches([_row(key[0].as_py(), state)])


def _leading(count: int):
    """Of a state, the leading components and the sum of all squared scales in place of the rest."""

    def run(items):
        for b in batches(items):
            for r in b.to_pylist():
                s = _state(r["n"], r["sums"], r["scales"], r["axes"])
                axes = s.axes[:count].copy()
                top = axes[np.arange(len(axes)), np.abs(axes).argmax(axis=1)]
                axes[top < 0] *= -1
                yield _row(0, State(s.n, s.sums, np.append(s.scales[:count], np.sum(s.scales**2)), axes))

    return run


def fit(rows: DataFrame, dim: int, count: int, chunk_values: int, fanout: int) -> Model | None:
    """The model of all rows (v); None without rows."""
    states = materialise(rows.select("v").mapInArrow(_fold(dim, chunk_values), STATE_DDL), "whitening-states")
    while states.count() > 1:
        up = states.groupBy(F.expr(f"node div {fanout}").alias("up")).applyInArrow(_merge, STATE_DDL)
        below, states = states, materialise(up, "whitening-states")
        discard(below)
    top = states.mapInArrow(_leading(count), STATE_DDL).first()
    discard(states)
    if top is None:
        return None
    sums = [int(s) for s in top.sums]
    scales = np.frombuffer(bytes(top.scales))
    return Model(top.n, sums, np.frombuffer(bytes(top.axes)).reshape(-1, dim), scales[:-1], float(scales[-1]))


def projected(x: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Deviations n * x - sums, and the whitened coordinates, NaN where a component has no variance."""
    d = deviations(x, model.n, model.sums)
    dead = model.scales <= model.scales[0] * 8 * np.finfo(float).eps * max(x.shape[1], 1)
    scale = np.where(dead, np.nan, model.scales / np.sqrt(model.n))
    return d, (d.astype(float) / model.n) @ model.axes.T / scale


def _moments(dim: int, model: Model):
    """Rows (cell, value): number, sums and centred products of each batch's whitened coordinates, and what centring took out."""

    def run(items):
        for b in batches(items):
            _, w = projected(integers(b.column(0), dim), model)
            n, mean = len(w), w.mean(axis=0)
            c = w - mean
            values = np.concatenate(([n], n * mean, (c.T @ c).reshape(-1), (n * np.outer(mean, mean)).reshape(-1)))
            yield pa.RecordBatch.from_pydict({"cell": pa.array(range(len(values)), pa.int32()), "value": values})

    return run


def identity_error(rows: DataFrame, dim: int, model: Model) -> float | None:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""
    k = len(model.axes)
    sums = rows.select("v").mapInArrow(_moments(dim, model), "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect()
    flat = np.array([r.value for r in sorted(sums, key=lambda r: r.cell)])
    n, mean = flat[0], flat[1 : k + 1] / flat[0]
    within, between = flat[k + 1 : k + 1 + k * k].reshape(k, k), flat[k + 1 + k * k :].reshape(k, k)
    off = np.abs((within + between) / n - np.outer(mean, mean) - np.eye(k))
    return None if np.isnan(off).all() else float(np.nanmax(off))


def _whiten(dim: int, model: Model):
    """A row for each vector and component."""
    k = len(model.axes)
    explained = pa.array(model.scales**2 / model.total if model.total > 0 else np.full(k, np.nan), from_pandas=True)

    def run(items):
        for b in batches(items):
            d, w = projected(integers(b.column(1), dim), model)
            each = np.repeat(np.arange(len(w)), k)
            squared = pa.array([Decimal(s) if s < 10**38 else None for s in squares(d)], pa.decimal128(38, 0))
            component = np.tile(np.arange(k, dtype=np.int32), len(w))
            columns = [b.column(0).take(each), component + 1, np.full(len(each), model.n), squared.take(each), pa.array(w.reshape(-1), from_pandas=True), explained.take(component)]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=["vec_id", "component", "n", "deviation", "whitened", "explained"])

    return run


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 8, chunk_values: int = 1 << 20, fanout: int = 8) -> DataFrame:
    """Rows (vec_id, component, n, deviation, whitened, explained, identity_error) for each usable vector and leading component.

    ``deviation`` is a decimal of 38 digits, null beyond them.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    most = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if most is None:
        return spark.createDataFrame([], RESULT_DDL + ", identity_error double")
    rows = rows.filter(F.size("v") == most.dim)
    model = fit(rows, most.dim, components, chunk_values, fanout)
    error = identity_error(rows, most.dim, model)
    return rows.mapInArrow(_whiten(most.dim, model), RESULT_DDL).withColumn("identity_error", F.lit(error).cast("double"))


def op12_whitening(spark, sf_dir: str) -> DataFrame:
    """Whole ``embeddings``: the columns of ``whiten``, ``deviation`` as a long (null beyond 64 bits)."""
    return whiten(read_table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").try_cast("long"))
