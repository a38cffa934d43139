"""Keyed tables, run logs and the control helpers."""

import base64
import json

from pyspark.sql import functions as F

from heatledger.functions import exprs as E
from heatledger.sources import tables


def test_upsert_replaces_keys_and_leaves_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = lambda *rows: spark.createDataFrame(list(rows), "d string, k int, v int")
    tables.upsert(path, frame(("a", 1, 1), ("a", 2, 2), ("b", 1, 3)), ["d", "k"], "d")
    for _ in range(2):
        tables.upsert(path, frame(("a", 2, 20), ("c", 1, 4)), ["d", "k"], "d")
        assert sorted((r.d, r.k, r.v) for r in spark.read.parquet(path).collect()) == [("a", 1, 1), ("a", 2, 20), ("b", 1, 3), ("c", 1, 4)]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_upsert_computes_what_comes_in_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(frames):
        for f in frames:
            seen.add(len(f))
            yield f

    rows = spark.createDataFrame([(f"p{i % 3}", i, i) for i in range(30)], "d string, k int, v int").mapInPandas(counted, "d string, k int, v int")
    for n in (1, 2):
        tables.upsert(str(tmp_path / "t"), rows, ["d", "k"], "d")
        assert seen.value == 30 * n
    assert spark.read.parquet(str(tmp_path / "t")).count() == 30


def test_prunable_and_rates(spark):
    names = spark.createDataFrame([(x,) for x in ("2020-01-01", "2020-01-02", "2020-01-03", "manifest.json", "2020-99-01")], "name string")
    assert [r.name for r in tables.prunable(names, 2).collect()] == ["2020-01-01"]
    rate = lambda oks: tables.failure_rate(spark.createDataFrame([(x,) for x in oks], "ok boolean"), 0.2).first()
    assert (rate([True] * 4 + [False]).acceptable, rate([True, False]).acceptable, rate([]).acceptable) == (True, False, True)


def test_run_log(spark):
    started = spark.createDataFrame([(1,), (2,)], "run int")
    finished = spark.createDataFrame([(1, 5, "partial"), (1, 9, "succeeded")], "run int, finished_at int, status string")
    assert {r.run: r.status for r in tables.run_log(started, finished).collect()} == {1: "succeeded", 2: "running"}


def test_tokens_boxes_and_texts(spark):
    token = lambda d: "h." + base64.urlsafe_b64encode(json.dumps(d).encode()).decode().rstrip("=") + ".s"
    rows = spark.createDataFrame([(token({"exp": 1600000000}),), (token({}),), ("junk",), (None,)], "t string").coalesce(1)
    got = [None if r.e is None else int(r.e) for r in rows.select(F.unix_timestamp(E.token_expiry(F.col("t"))).alias("e")).collect()]
    assert got == [1600000000, None, None, None]
    lit = lambda *x: [F.lit(v).cast("double") for v in x]
    ts = lambda s: F.lit(s).cast("timestamp")
    r = spark.range(1).select(
        E.bbox_problem(*lit(170, -1, -170, 1)), E.bbox_problem(*lit(1, 2, 3, 2)), E.bbox_problem(*lit(1, 2, 300, 3)), E.bbox_problem(*lit(1, 2, None, 3)), E.bbox_text(*lit(1.5, -2, 3.25, 4.1234)),
        E.expiry_state(ts("2020-01-20"), ts("2020-01-01")), E.expiry_state(ts("2020-01-10"), ts("2020-01-01")), E.expiry_state(ts("2020-01-01"), ts("2020-01-01")), E.temperature_text(F.lit(100.0), "F"), E.record_label(F.lit("air"), F.lit("avg_annual")),
    ).first()
    assert list(r) == [None, "south must be below north", "off the globe", "four numbers are needed", "1.5,-2,3.25,4.123", "ok", "renew", "expired", "212.0 °F", "air avg"]


def test_entry_points():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
