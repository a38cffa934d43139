import random
import re
from collections import Counter

import numpy as np
import pytest
from helpers import awkward

from heatledger.llm import phrases


def slow(rows, least, longest, percent, top):
    counts, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n-\r]", lowered):
            words = tuple(re.findall(r"[^ \t]+", piece))
            total[lang] += len(words)
            for size in range(1, longest + 1):
                counts.update((lang, words[i : i + size]) for i in range(len(words) - size + 1))
    cands = {k: n for k, n in counts.items() if len(k[1]) > 1 and n >= least}
    found = []
    for (lang, p), a in cands.items():
        score, k = min((1_000_000 * a * a // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p)))
        inside = [n for (g, q), n in cands.items() if g == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
        if not any(100 * n >= percent * a for n in inside):
            found.append((lang, score, a, " ".join(p), counts[lang, p[:k]], counts[lang, p[k:]]))
    out = []
    for lang in {f[0] for f in found}:
        mine = sorted((f for f in found if f[0] == lang), key=lambda f: (-f[1], -f[2], f[3].encode()))[:top]
        out += [(lang, i + 1, f[3], f[2], f[4], f[5], total[lang], f[1]) for i, f in enumerate(mine)]
    return sorted(out)


def texts(seed, n):
    r = random.Random(seed)
    common = ["the", "of", "New", "York", "city", "é", "straße", "a", "x y", "b\x1cc", "n'est", "0"]
    rows = []
    for i in range(n):
        words = [r.choice(common) if r.random() < 0.8 else f"w{r.randrange(30)}" for _ in range(r.randrange(60))]
        text = "".join(w + r.choice([" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "?!", " "]) for w in words)
        rows.append((r.choice(["en", "en", "de", None, ""]), text if i % 17 else None))
    return rows


@pytest.mark.parametrize("seed,longest,block,split_at,top", [(1, 3, 16 << 20, 1 << 21, 2000), (2, 3, 150, 40, 25), (3, 4, 400, 15, 2000), (4, 2, 64, 1, 7), (5, 5, 90, 3, 2000)])
def test_equals_slow(spark, seed, longest, block, split_at, top):
    rows = texts(seed, 60) + [("en", "the of new york " * 300), ("en", "solid" * 500)]
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows], "lang string, text string, n int, phrase string").repartition(3)
    out = phrases.collocations(df, least=5, longest=longest, top=top, block_bytes=block, split_at=split_at)
    assert sorted(map(tuple, out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())) == slow(rows, 5, longest, 50, top)


def test_awkward_and_empty(spark):
    docs = awkward(spark)
    rows = [(r.lang, r.text) for r in docs.collect()]
    out = phrases.collocations(docs, least=2, block_bytes=5000, split_at=100)
    assert sorted(map(tuple, out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())) == slow(rows, 2, 3, 50, 2000)
    assert phrases.collocations(docs.limit(0)).collect() == []


def test_rows_that_do_not_fit_a_key():
    r = np.random.default_rng(1)
    columns = [r.integers(0, 3, 500) * (1 << 40) for _ in range(3)]
    weights = r.integers(1, 9, 500)
    expected = Counter()
    for *c, n in zip(*columns, weights, strict=True):
        expected[tuple(map(int, c))] += int(n)
    out, sums = phrases.tally(columns, weights)
    assert [(*map(int, row[:-1]), int(row[-1])) for row in zip(*out, sums, strict=True)] == [(*k, n) for k, n in sorted(expected.items())]
    packed = phrases.unpack(phrases.pack(columns, weights > 4, weights))
    assert all((a == b).all() for a, b in zip(packed[0], columns, strict=True)) and (packed[1] == (weights > 4)).all() and (packed[2] == weights).all()


def test_scores_are_exact_beyond_longs(spark):
    words = spark.createDataFrame([(1, "en", "a", 10**13 + 7), (2, "en", "b", 10**13 + 9)], "id long, lang string, word string, f long")
    out = phrases.scored(spark.createDataFrame([([1, 2], 10**13 - 3)], "ids array<long>, a long"), words).first()
    assert out.score == 1_000_000 * (10**13 - 3) ** 2 // ((10**13 + 7) * (10**13 + 9))


def test_query_equals_its_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.sql("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.01/documents.parquet'")
    out = phrases.op11_collocations(spark, "/root/testdata/sf0.01")
    names = "lang, rank, phrase, a, l, r, n, score"
    assert sorted(map(tuple, out.select(*names.split(", ")).collect())) == sorted(con.sql(f"SELECT {names} FROM ({phrases.ORACLE})").fetchall())
    assert [t for _, t in out.select("rank", "a", "l", "r", "n", "score").dtypes] == ["bigint"] * 6
