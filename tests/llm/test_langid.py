import random

import numpy as np
import pytest
from helpers import SCHEMA, awkward

from heatledger.llm import langid

WORDS = {
    "en": "the of and to in is that for with was on are this by from have not they been which".split(),
    "de": "der die und das ist nicht ein eine mit auf für von dem den sich wird auch über nach".split(),
    "fr": "le la les des est une dans que pour avec sur pas plus par qui être cette sont mais".split(),
}


def corpus(spark, n=150, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(WORDS))
        rows.append((i, " ".join(rng.choice(WORDS[lang]) for _ in range(rng.randint(3, 60))), lang, f"{lang}{i % 4}.example.{lang}", 0))
    return spark.createDataFrame(rows, SCHEMA)


def test_held_out_accuracy_and_rejection(spark):
    junk = spark.createDataFrame([(1000, "#$%^ 1234 &*() ~~~ {}[] 99", "en", "en0.example.en", 0), (1001, "", "en", "a.b", 0), (1002, None, None, None, None)], SCHEMA)
    held = corpus(spark, 60, 9).selectExpr("doc_id + 2000 AS doc_id", "text", "CAST(NULL AS STRING) AS lang", "source", "n_chars")
    docs = corpus(spark).unionByName(junk).unionByName(held)
    got = {r.id: r for r in langid.fuse(langid.document_evidence(docs)).collect()}
    truth = {r.doc_id + 2000: r.lang for r in corpus(spark, 60, 9).collect()}
    assert sum(got[i].lang == lang for i, lang in truth.items()) >= 0.97 * len(truth)
    assert [got[i].kept for i in (1000, 1001, 1002)] == [False] * 3
    assert all(got[i].kept for i in range(150))
    kept = {r.doc_id for r in langid.keep_identified(docs).collect()}
    assert kept == {i for i, r in got.items() if r.kept}


def test_other_evidence_decides_short_texts(spark):
    rows = [(i, r.text, r.lang, r.source, 0) for i, r in enumerate(corpus(spark).collect())]
    rows += [(900, "in", "de", "de1.example.de", 0), (901, "in", "en", "en1.example.en", 0)]
    got = {r.id: r.lang for r in langid.fuse(langid.document_evidence(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert (got[900], got[901]) == ("de", "en")


def test_scores_against_brute_force(spark):
    docs = corpus(spark, 20)
    langs, table = langid.fit(langid.document_evidence(docs))
    assert langs == [*sorted(WORDS), "und"]
    model = type("Fixed", (), {"value": table})
    import pyarrow as pa

    texts = [r.text for r in docs.collect()] + ["", "ab", None, "é"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(len(texts)))], names=["text", "id"])
    out = next(iter(langid._score(model, 10)(iter([batch])))).to_pylist()
    for text, row in zip(texts, out, strict=True):
        grams = langid.trigrams(np.frombuffer((text or "").encode(), np.uint8))
        scale = min(len(grams), 10) / max(1, len(grams))
        assert row["n"] == len(grams) and row["ll"] == pytest.approx([scale * float(t[grams].astype(float).sum()) for t in table])


def test_awkward_and_empty(spark):
    docs = awkward(spark).selectExpr("*", "1 AS id", "2 AS host", "3 AS P0")
    rows = langid.fuse(langid.document_evidence(docs)).collect()
    assert len(rows) == 10 and not any(r.kept for r in rows if r.n_grams == 0)
    assert langid.keep_identified(docs).count() == sum(r.kept for r in rows) >= 2
    assert langid.fuse(langid.document_evidence(spark.createDataFrame([], SCHEMA))).collect() == []


def test_page_evidence(spark):
    pages = spark.createDataFrame([(1, "https://www.a.example.de/x?y", '<html lang="de-AT"><script>x="</p>"</script><p>der die das</p>'), (2, None, None)], "page_id long, url string, html string")
    a, b = langid.page_evidence(pages).orderBy("id").collect()
    assert (a.declared, a.suffix, a.host, a.domain, a.text.split()) == ("de", "de", "www.a.example.de", "example.de", ["der", "die", "das"])
    assert (b.declared, b.host, b.suffix) == (None, None, None)


def test_rare_language_has_a_class(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(WORDS[lang]) for _ in range(30)), lang, "a.b", 0) for i in range(600) for lang in [("en", "de")[i % 2]]]
    rows += [(700 + i, " ".join(rng.choice(WORDS["fr"]) for _ in range(30)), "fr", "a.b", 0) for i in range(3)]
    rows += [(0, rows[0][1], "en", "a.b", 0)] * 50  # one row, many times
    evidence = langid.document_evidence(spark.createDataFrame(rows, SCHEMA))
    assert {r.label: r["count"] for r in langid.training_rows(evidence, 20).groupBy("label").count().collect()} == {"en": 20, "de": 20, "fr": 3}
    assert langid.fit(evidence, max_train=20)[0] == ["de", "en", "fr", "und"]
    got = {r.id: r for r in langid.fuse(evidence, max_train=20).collect()}
    assert all(got[700 + i].lang == "fr" and got[700 + i].declared == "fr" and got[700 + i].kept for i in range(3))


def slow_fusion(rows, max_train=4000, evidence=60, strength=20.0, least=0.5):
    """The posterior of each (id, text, label, declared, suffix, host, domain) by dictionaries, row by row."""
    import math
    import re
    from collections import Counter, defaultdict

    texts = [(r[1] or "").encode() for r in rows]
    grams = [langid.trigrams(np.frombuffer(t, np.uint8)).tolist() for t in texts]
    seen = {(r[2], r[0], t): g for r, t, g in zip(rows, texts, grams, strict=True) if r[2] is not None and len(t) >= 3}
    counts = defaultdict(Counter)
    for (label, _, _), g in seen.items():
        counts[label].update(g)
    langs = [*sorted(set(counts) - {"und"}), "und"]
    weight = {lang: {k: math.log(0.9 * n / sum(c.values()) + 0.1 / langid.BUCKETS) for k, n in c.items()} for lang, c in counts.items()}
    unseen = math.log(0.1 / langid.BUCKETS)
    letters = [any(b >= 128 or chr(b).isalpha() for b in t) for t in texts]
    ll, p = [], []
    for g in grams:
        scale = min(len(g), evidence) / max(1, len(g))
        ll.append([scale * (sum(weight[lang].get(x, unseen) for x in g) if lang != "und" else -len(g) * math.log(langid.BUCKETS)) for lang in langs])
        top = max(ll[-1])
        share = [math.exp(x - top) for x in ll[-1]]
        p.append([x / sum(share) for x in share])
    code = [None if r[3] is None else (m[1].lower() if (m := re.match(r"\s*([A-Za-z]{2,3})\b", r[3])) and m[1].lower() in langs else "other") for r in rows]
    use = [i for i in range(len(rows)) if letters[i]]
    k = range(len(langs))
    total = [sum(p[i][j] for i in use) for j in k]
    base = [(c + 1) / (sum(total) + len(langs)) for c in total]

    def grouped(key):
        out = defaultdict(lambda: [0.0] * len(langs))
        for i in use:
            if key(i) is not None:
                out[key(i)] = [a + b for a, b in zip(out[key(i)], p[i], strict=True)]
        return out

    smooth = lambda c, above: [(c[j] + strength * above[j]) / (sum(c) + strength) for j in k]
    domains = {d: smooth(c, base) for d, c in grouped(lambda i: rows[i][6]).items()}
    hosts = {h: smooth(c, domains.get(h[1], base)) for h, c in grouped(lambda i: (rows[i][5], rows[i][6]) if rows[i][5] is not None else None).items()}
    tables = [(grouped(key), key) for key in (lambda i: rows[i][4], lambda i: code[i])]
    out = []
    for i in range(len(rows)):
        logs = [ll[i][j] + math.log(hosts.get((rows[i][5], rows[i][6]), base)[j]) for j in k]
        for table, key in tables:
            if key(i) in table:
                logs = [x + math.log((table[key(i)][j] + 0.5) / (total[j] + 1)) for j, x in enumerate(logs)]
        top = max(logs)
        confidence = 1 / sum(math.exp(x - top) for x in logs)
        lang = langs[logs.index(top)] if letters[i] and confidence >= least else "und"
        out.append((rows[i][0], lang, round(confidence, 5), lang != "und"))
    return sorted(out, key=repr)


def pages(spark):
    """Web pages whose tags, suffixes and hosts sometimes speak against each other, some of few words."""
    rng = random.Random(21)
    rows = []
    for i in range(160):
        lang = rng.choice(list(WORDS))
        said = rng.choice([lang] * 6 + ["en", "xx", None])
        host = rng.choice([f"www.{lang}{i % 3}.{lang}", f"m.{lang}{i % 3}.{lang}", "shared.org", "localhost"])
        words = " ".join(rng.choice(WORDS[lang]) for _ in range(rng.choice([1, 2, 30])))
        rows.append((i, f"https://{host}/{i}?x", f"<html{'' if said is None else f' lang={said}'}><script>var the = 1</script><p>{words}</p></html>"))
    rows += [(500, None, None), (501, "no address", "<p>der die das</p>"), (502, "http://a.de/", ""), (502, "http://a.de/", ""), (None, "http://b.fr/", "<html lang='fr'><p>le la les des</p>"), (503, "http://c.de", "<html lang=de>12 % 34")]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_fusion_against_brute_force(spark):
    evidence = langid.page_evidence(pages(spark))
    rows = [tuple(r) for r in evidence.select("id", "text", "label", "declared", "suffix", "host", "domain").collect()]
    got = sorted(((r.id, r.lang, round(r.confidence, 5), r.kept) for r in langid.fuse(evidence).collect()), key=repr)
    want = slow_fusion(rows)
    assert [(g[0], g[1], g[3]) for g in got] == [(w[0], w[1], w[3]) for w in want]
    assert all(abs(g[2] - w[2]) < 2e-3 for g, w in zip(got, want, strict=True))  # the table is of single precision
    assert len({g[1] for g in got}) >= 4


def test_pages_query_end_to_end(spark, tmp_path):
    pages(spark).write.parquet(f"{tmp_path}/pages.parquet")
    out = langid.language_id_pages(spark, str(tmp_path)).collect()
    assert len(out) == pages(spark).count() and {r.page_id for r in out if not r.kept} >= {500, 502, 503}
    rows = [tuple(r) for r in langid.page_evidence(pages(spark)).select("id", "text", "label", "declared", "suffix", "host", "domain").collect()]
    assert sorted(((r.page_id, r.lang) for r in out), key=repr) == sorted(((w[0], w[1]) for w in slow_fusion(rows)), key=repr)


def test_commonest_labels_are_the_classes(spark):
    rows = [(i, f"some text number {i}", ("en", "de", "fr")[min(2, i % 6 // 2 if i < 60 else 0)], "a.b", 0) for i in range(70)]
    evidence = langid.document_evidence(spark.createDataFrame(rows, SCHEMA))
    assert langid.fit(evidence, max_classes=2)[0] == ["de", "en", "und"]
    assert langid.fit(evidence)[0] == ["de", "en", "fr", "und"]
