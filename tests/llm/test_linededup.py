import hashlib
import os
import random
import re

from helpers import SCHEMA, awkward, frame

from heatledger.llm import linededup
from heatledger.llm.linededup import dedup_lines


def brute(rows, least=10):
    def key(line):
        return re.sub(r"[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))

    owners = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least and d is not None:
                owners.setdefault(key(line), set()).add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if d is None or len(owners.get(key(x), ())) < 2 or min(owners[key(x)]) == d]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in df.collect()), key=repr)


def test_random_lines_against_brute_force(spark):
    rng = random.Random(5)
    pool = ["same line in many places", "  Same LINE in many places\t", "short", "ÀÉ accent line kept", "àé accent line kept", "exactly10c", "ninechars", ""]
    pool += [f"a line that some share {i}" for i in range(12)]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randint(0, 6))) for _ in range(60)]
    docs = frame(spark, texts).repartition(5)
    for n_batches, fanout in ((1, 2), (4, 2), (5, 3)):
        assert result(dedup_lines(docs, n_batches=n_batches, fanout=fanout)) == brute(list(enumerate(texts)))


def test_awkward_rows_and_clashing_columns(spark):
    docs = awkward(spark).selectExpr("*", "1 AS n_lines", "2 AS H1", "3 AS d", "4 AS gone")
    got = dedup_lines(docs)
    assert [c for c in got.columns if c.lower() == "n_lines"] == ["n_lines"]
    assert result(got) == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert {(r.H1, r.d, r.gone) for r in got.collect()} == {(2, 3, 4)}


def test_empty_table(spark):
    assert dedup_lines(spark.createDataFrame([], SCHEMA)).collect() == []


def test_digest_is_of_utf8(spark):
    assert hashlib.sha256("é".encode()).hexdigest() == frame(spark, ["é"]).selectExpr("sha2(cast(text as binary), 256) s").first().s


def test_runs_are_read_as_they_lie(spark):
    """A batch meets the runs in merge joins that neither shuffle nor sort them, with and without adaptive execution and whatever broadcasts are allowed."""
    runs = linededup.Runs(spark, fanout=2)
    row = "h1 long, h2 long, owner long"
    keys = [(i * 7919 % 1009, i * 104729 % 997, i) for i in range(3000)]
    try:
        for part in (keys[:1000], keys[1000:2000]):
            runs.add(spark.createDataFrame(part, row))
        for adaptive in ("true", "false"):
            spark.conf.set("spark.sql.adaptive.enabled", adaptive)
            with linededup.sorted_buckets(spark):
                df = runs.unseen(spark.createDataFrame(keys[1500:], row))
                df.collect()
                plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
            assert plan.count("SortMergeJoin") == 2 and plan.count("Bucketed: true") == 2
            assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1  # the batch alone
            assert sorted(map(tuple, df.collect())) == sorted(keys[2000:])
        runs.compact()
        assert [len(level) for level in runs.levels] == [0, 1] and len(runs.paths) == 3
        assert spark.table(runs.levels[1][0]).count() == 2000
        assert len({p for p in runs.paths.values() if os.path.exists(p)}) == 1
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        runs.drop()
    assert not any(os.path.exists(p) for p in runs.paths.values())


def test_more_batches_where_one_would_grow(spark):
    rng = random.Random(8)
    texts = ["\n".join(f"a line that some share {rng.randrange(40)}" for _ in range(5)) for _ in range(40)]
    docs = frame(spark, texts)
    assert result(dedup_lines(docs, n_batches=1, batch_lines=30)) == brute(list(enumerate(texts)))
