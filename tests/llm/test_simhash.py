import random
import re
from itertools import combinations

import numpy as np
import xxhash
from helpers import SCHEMA, awkward, frame
from pyspark.sql import functions as F

from heatledger.llm.simhash import cell_links, components, fingerprint, links, masks, near_duplicates, thermo, thermometer


def brute_fp(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def roots(nodes, pairs):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute_components(rows):
    fps = [(d, brute_fp(t)) for d, t in rows]
    group = roots({f for _, f in fps}, [(a, b) for a, b in combinations({f for _, f in fps}, 2) if (a ^ b).bit_count() <= 4])
    best = {}
    for d, f in fps:
        if d is not None:
            best[group[f]] = min(d, best.get(group[f], d))
    return sorted(((d, f"{f:016x}", best.get(group[f])) for d, f in fps), key=repr)


def result(df):
    return sorted(((r.d, f"{r.fp % (1 << 64):016x}", r.component_id) for r in df.collect()), key=repr)


def test_fingerprint_matches_sparks_hash(spark):
    text = "one two three four"
    assert fingerprint(text.encode()) % (1 << 64) == spark.range(1).select(F.xxhash64(F.lit(text)).alias("h")).first().h % (1 << 64)
    for t in ("", "A b", "é É É a b", "a b c d e f g a b c d", "\x1c x \x85 y z w v"):
        assert fingerprint(t.encode()) == brute_fp(t)


def test_documents_against_brute_force(spark):
    rng = random.Random(3)
    base = [" ".join(rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(rng.randint(20, 200))) for _ in range(25)]
    texts = []
    for t in base:
        words = t.split()
        for k in (0, 0, 1, 2):
            texts.append(" ".join(w if rng.random() > k / len(words) else "edit" for w in words))
    texts += ["", None, "one", "ONE"]
    docs = frame(spark, texts).repartition(4)
    for chunk in (4096, 2):
        assert result(near_duplicates(docs, chunk=chunk)) == brute_components(list(enumerate(texts)))


def test_awkward_and_empty(spark):
    docs = awkward(spark).selectExpr("*", "1 AS fp", "2 AS component_id", "3 AS d")
    assert result(near_duplicates(docs)) == brute_components([(r.doc_id, r.text) for r in docs.collect()])
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_embedding_is_a_lower_bound_and_grid_finds_all(spark):
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    flips = np.array([sum(1 << int(i) for i in rng.choice(64, rng.integers(1, 5), replace=False)) for _ in a], dtype=np.uint64)
    b = a ^ flips
    assert (np.bitwise_count(thermo(a) ^ thermo(b)) <= np.bitwise_count(flips)).all()
    ms = [m % (1 << 64) for m in masks(7, 4)]
    for x, y in zip(thermo(a).tolist(), thermo(b).tolist(), strict=True):
        assert any((x ^ y) & m == 0 for m in ms)
    both = np.concatenate((a, b)).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in both], "fp long")
    assert [r.t for r in df.select(thermometer(F.col("fp")).alias("t")).collect()] == thermo(np.array(both).view(np.uint64)).view(np.int64).tolist()
    got = roots(both, [(r.u, r.v) for r in links(df.distinct(), chunk=8).collect()])
    want = roots(both, [(x, y) for x, y in combinations(both, 2) if ((x ^ y) % (1 << 64)).bit_count() <= 4])
    assert got == want


def test_cell_links_are_a_forest():
    fps = np.arange(64, dtype=np.uint64)
    us, vs = cell_links(fps, 4)
    assert len(us) == 63 and len(set(roots(range(64), zip(us, vs, strict=True)).values())) == 1


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 1001)], "u long, v long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, 1001: 1000}


def test_no_table_of_fingerprints_goes_through_the_driver(spark, monkeypatch):
    from heatledger.llm import simhash

    plans = []

    def kept(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return materialise(df, name)

    materialise = simhash.materialise
    monkeypatch.setattr(simhash, "materialise", kept)
    docs = frame(spark, ["a b c d e f", "a b c d e f", "g h i j k l", "one", None])
    plans.append(near_duplicates(docs)._jdf.queryExecution().executedPlan().toString())
    assert any("SortMergeJoin" in p for p in plans) and not any("Broadcast" in p for p in plans)
