import random

from helpers import SCHEMA, awkward

from heatledger.llm import packing
from heatledger.llm.simhash import fingerprint


def brute(lengths, sources, clusters, capacity, per_source):
    bins = []
    out = []
    for n, s, c in zip(lengths, sources, clusters, strict=True):
        fit = [(capacity - sum(x[0] for x in b), i) for i, b in enumerate(bins)]
        fit = [(left, i) for left, i in fit if left >= n and left > 0 and not (c >= 0 and any(x[2] == c for x in bins[i])) and not (s >= 0 and sum(x[1] == s for x in bins[i]) >= per_source)]
        i = min(fit)[1] if fit else len(bins)
        if not fit:
            bins.append([])
        bins[i].append((n, s, c))
        out.append(i)
    return out


def test_best_fit_against_brute_force():
    rng = random.Random(3)
    for _ in range(60):
        n = rng.randint(0, 60)
        args = [sorted((rng.randint(1, 30) for _ in range(n)), reverse=True), [rng.randint(-1, 3) for _ in range(n)], [rng.randint(-1, 8) for _ in range(n)]]
        assert packing.best_fit(*args, 30, 2) == brute(*args, 30, 2)


def valid(pieces, docs, capacity, per_source):
    bins, whole = {}, {}
    for p in pieces:
        bins.setdefault(p.bin_id, []).append(p)
        whole.setdefault(p.doc_id, []).append(p)
    for b in bins.values():
        assert sum(p.n_tokens for p in b) <= capacity
        assert sorted(p.slot for p in b) == list(range(len(b)))
        for key, most in (("source", per_source), ("cluster", 1)):
            values = [getattr(p, key) for p in b if getattr(p, key) is not None]
            assert all(values.count(v) <= most for v in values)
    want = {}
    for r in docs:
        want[r.doc_id] = want.get(r.doc_id, 0) + len((r.text or "").split()) + 1
    assert {d: sum(p.n_tokens for p in ps) for d, ps in whole.items()} == want


def test_documents(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdef") for _ in range(rng.choice([0, 1, 5, 20, 99, 100, 250]))) for _ in range(200)]
    texts += [texts[3], texts[3].upper(), texts[7] + "\n"]
    docs = spark.createDataFrame([(i, t, "en", f"s{min(3, rng.randrange(9))}", 0) for i, t in enumerate(texts)], SCHEMA)
    for shard_rows in (1000, 20):
        pieces = packing.pack_documents(docs, 100, 2, shard_rows).collect()
        valid(pieces, docs.collect(), 100, 2)
        starts = {}
        for p in pieces:
            starts.setdefault(p.doc_id, []).append((p.start_token, p.n_tokens))
        for spans in starts.values():
            at = 0
            for s, n in sorted(spans):
                assert s == at
                at += n
    assert packing.efficiency(packing.pack_documents(docs, 100, 50), 100).first().filled > 0.9


def test_awkward_and_empty(spark):
    docs = awkward(spark).selectExpr("*", "1 AS bin_id", "2 AS N", "3 AS shard", "4 AS cluster")
    valid(packing.pack_documents(docs, 1000).collect(), docs.collect(), 1000, 4)
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA)).collect() == []


def test_near_copies_never_share_a_bin(spark):
    rng = random.Random(6)
    words = [rng.choice("abcdefghijklmnopqrst") * 3 + str(rng.randrange(900)) for _ in range(300)]
    near = [*words[:150], "changed", *words[151:]]
    texts = [" ".join(words), " ".join(near), "some other text", "one more text here"]
    docs = spark.createDataFrame([(i, t, "en", f"s{i}", 0) for i, t in enumerate(texts)], SCHEMA)
    got = {p.doc_id: p for p in packing.pack_documents(docs, 2048).collect()}
    assert got[0].bin_id != got[1].bin_id
    assert [got[i].cluster for i in range(4)] == [0, 0, None, None]


def test_clusters_of_documents_against_brute_force(spark):
    """Clusters are the components of fingerprints that more than one document has a part in, also of documents without an id; equal texts conflict besides."""
    rng = random.Random(7)
    base = [[rng.choice("abcdefghijklmnopqrst") * 3 + str(rng.randrange(900)) for _ in range(200)] for _ in range(4)]
    rows = []
    for k, words in enumerate(base):
        for c in range(4):
            copy = list(words)
            copy[100] = f"edit{c}"
            rows.append((None if (k, c) in ((0, 1), (0, 2), (1, 3)) else 10 * k + c, " ".join(copy)))
    rows += [(90, "alone in its kind of text here"), (None, "alone too but without an id"), (91, ""), (92, None)]
    docs = spark.createDataFrame([(d, t, "en", f"s{i}", 0) for i, (d, t) in enumerate(rows)], SCHEMA)
    pieces = {p.source: p for p in packing.pack_documents(docs, 4096, 50).collect()}
    prints = [fingerprint((t or "").encode()) for _, t in rows]
    group = list(range(len(rows)))
    for _ in rows:
        group = [min(group[j] for j in range(len(rows)) if (prints[i] ^ prints[j]).bit_count() <= 4 and (rows[i][1] or "").strip() and (rows[j][1] or "").strip()) if (rows[i][1] or "").strip() else i for i in range(len(rows))]
    for i in range(len(rows)):
        mates = [j for j in range(len(rows)) if group[j] == group[i]]
        assert (pieces[f"s{i}"].cluster is not None) == (len(mates) > 1)
        for j in mates:
            assert pieces[f"s{i}"].cluster == pieces[f"s{j}"].cluster
            assert i == j or pieces[f"s{i}"].bin_id != pieces[f"s{j}"].bin_id
    assert sum(len([j for j in range(len(rows)) if group[j] == group[i]]) > 1 for i in range(len(rows))) >= 12


def test_rows_that_repeat_an_id_fill_many_shards(spark):
    docs = spark.range(400).selectExpr("CAST(5 AS LONG) AS doc_id", "'src' AS source", "CAST(NULL AS LONG) AS cluster", "CAST(NULL AS LONG) AS copy", "CAST(7 AS LONG) AS n")
    pieces = packing.pack(docs, 100, 50, 20).collect()
    assert len(pieces) == 400 and len({p.bin_id // packing.STRIDE for p in pieces}) > 15
