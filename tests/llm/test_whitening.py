import random

import numpy as np
import pytest

from heatledger.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def slow(vectors, count=8):
    """n, exact deviations, whitened coordinates and explained shares by one covariance of all vectors."""
    x = [[int(np.floor(1024 * float(np.float32(c)))) + 100_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    dev = [[n * c - s for c, s in zip(v, sums, strict=True)] for v in x]
    centred = np.array([[c / n for c in v] for v in dev])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:count]
    return n, [sum(c * c for c in v) for v in dev], centred @ axes[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def compare(out, ids, vectors, count=8):
    n, dev, whitened, explained = slow(vectors, count)
    rows = {(r.vec_id, r.component): r for r in out.collect()}
    assert len(rows) == len(vectors) * min(count, len(vectors[0]))
    for c in range(min(count, len(vectors[0]))):
        mine = np.array([rows[i, c + 1].whitened for i in ids])
        sign = np.sign(mine @ whitened[:, c])
        assert np.allclose(sign * mine, whitened[:, c], atol=1e-7)
        assert abs(rows[ids[0], c + 1].explained / explained[c] - 1) < 1e-9
    assert [int(rows[i, 1].deviation) for i in ids] == dev
    assert {r.n for r in rows.values()} == {n}
    assert len({r.identity_error for r in rows.values()}) == 1 and next(iter(rows.values())).identity_error < 1e-9


@pytest.mark.parametrize("parts,chunk,fanout", [(1, 1 << 20, 8), (13, 40, 2), (9, 64, 3)])
def test_equals_one_covariance_of_all(spark, parts, chunk, fanout):
    r = np.random.default_rng(parts)
    vectors = (r.normal(size=(300, 12)) * np.linspace(3, 0.2, 12) + r.normal(size=12) * 5).astype(np.float32)
    vectors[50:150] = vectors[50]  # a hot group of copies
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(vectors)], SCHEMA).repartition(parts)
    compare(whitening.whiten(df, chunk_values=chunk, fanout=fanout), list(range(300)), vectors.tolist())


def test_merge_is_lossless_in_any_shape():
    r = np.random.default_rng(5)
    x = r.integers(99_000, 101_000, size=(200, 7))
    whole = whitening.folded(x)
    cuts = sorted(random.Random(5).sample(range(1, 200), 9))
    parts = [whitening.folded(p) for p in np.split(x, cuts)]
    while len(parts) > 1:
        parts = [whitening.merged(parts[i], parts[i + 1]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    assert parts[0].sums == whole.sums and parts[0].n == 200
    assert np.allclose(parts[0].scales, whole.scales, rtol=1e-12)


def test_unusable_vectors_and_other_columns(spark):
    good = [[1.0, 2.0, 0.5], [0.0, -1.0, 2.0], [3.0, 0.25, 1.0], [1.5, 1.0, -2.0]]
    bad = [None, [1.0, None, 2.0], [float("nan"), 0.0, 1.0], [float("inf"), 0.0, 1.0], [1.0, 2.0], [], [1e30, 0.0, 0.0]]
    rows = [(None, good[0], 1), (1, good[1], None), (1, good[1], 2), (2, good[2], 3), (3, good[3], 3)] + [(10 + i, v, 0) for i, v in enumerate(bad)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int")
    out = whitening.whiten(df).collect()
    assert len(out) == 5 * 3 and {r.vec_id for r in out} == {None, 1, 2, 3}
    assert out[0].n == 5


def test_without_variance_or_rows(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [], 0), (2, None, 0)], SCHEMA)).collect() == []
    out = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)], SCHEMA)).collect()
    assert len(out) == 4 and all(r.whitened is None and r.explained is None and r.identity_error is None and r.deviation == 0 for r in out)
    flat = whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i], 0) for i in range(9)], SCHEMA)).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in flat) and flat[0].identity_error < 1e-9


def test_numbers_beyond_longs():
    x = np.array([[2**61, 5], [-(2**61), 7], [2**60, -9]])
    sums = whitening.exact_sums(x)
    assert sums == [2**60, 3]
    d = whitening.deviations(x, 3, sums)
    assert whitening.squares(d) == [sum((3 * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]


def test_query_on_its_table(spark):
    import pandas as pd

    table = pd.read_parquet("/root/testdata/sf0.001/embeddings.parquet")
    out = whitening.op12_whitening(spark, "/root/testdata/sf0.001")
    assert dict(out.dtypes)["deviation"] == "bigint"
    compare(out, table.vec_id.tolist(), [v.tolist() for v in table.embedding])
