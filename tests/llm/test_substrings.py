import random
from collections import Counter

import numpy as np
from helpers import SCHEMA, awkward

from heatledger.llm.cover import COVERS, byte_names, digests, period_for
from heatledger.llm.substrings import levels, remove_repeats


def brute(rows, length=400):
    texts = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(t[i : i + length] for _, t in texts for i in range(len(t) - length + 1))
    out = []
    for d, t in texts:
        gone = np.zeros(len(t) + 1, np.int64)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        hit = np.cumsum(gone[:-1]) > 0
        spans = int((np.diff(np.concatenate(([0], hit.astype(int)))) == 1).sum())
        out.append((d, len(t), int(hit.sum()), spans, bytes(b for b, h in zip(t, hit, strict=True) if not h)))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect()), key=repr)


def test_planted_repeats_against_brute_force(spark):
    rng = random.Random(11)
    fresh = lambda n: "".join(rng.choice("abcdefgh é\n") for _ in range(n))
    passages = [fresh(n) for n in (300, 395, 400, 401, 450, 700, 2500)]
    texts = [fresh(rng.randint(0, 900)) + rng.choice(passages) + fresh(rng.randint(0, 300)) + rng.choice(passages)[rng.randint(0, 80) :] + fresh(rng.randint(0, 200)) for _ in range(40)]
    for t in texts[:8]:  # near copies
        for _ in range(3):
            i = rng.randrange(len(t))
            texts.append(t[:i] + "X" + t[i + 1 :])
    texts += [texts[0], texts[1][5:], "ab" * 1500, "ab" * 900 + "c", "z" * 2000, "z" * 399, "z" * 400, fresh(900) * 2, "", None]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], SCHEMA).repartition(5)
    want = brute(list(enumerate(texts)))
    assert result(remove_repeats(docs, block_bytes=5000, piece_bytes=450)) == want
    got = result(remove_repeats(docs))
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert got == want


def test_awkward_and_empty(spark):
    docs = awkward(spark).selectExpr("*", "1 AS d", "2 AS T", "3 AS spans")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = [w for w in brute([(d, t if t is None or len(t) < 9999 else "") for d, t in rows]) if w[0] not in (4, 5)]
    long = [t for d, t in rows if d in (4, 5)][0].encode()
    want += [(d, len(long), len(long), 1, b"") for d in (4, 5)]
    assert result(remove_repeats(docs)) == sorted(want, key=repr)
    assert remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []


def test_covers_and_names():
    for period, cover in COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))
    assert [(period_for(n), levels(n, period_for(n))) for n in (400, 50, 20, 11, 6)] == [(91, 1), (7, 1), (3, 1), (3, 1), (3, 0)]
    data = np.random.default_rng(3).integers(97, 100, 3000).astype(np.uint8)
    data[2000:2600] = data[100:700]
    for size in (1, 3, 7, 8, 9, 16, 91, 500):
        every = {}
        for at, name in enumerate(byte_names(data, np.arange(len(data) - size + 1), size).tolist()):
            assert every.setdefault(name, bytes(data[at : at + size])) == bytes(data[at : at + size])
        assert len(every) == len({bytes(data[i : i + size]) for i in range(len(data) - size + 1)})
    rows = digests(data, [2000, 100, 100, 101], [2500, 600, 600, 601], [7, 7, 8, 7]).tolist()
    assert rows[0] == rows[1] and len({tuple(r) for r in rows}) == 3


def test_other_lengths_and_pieces(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) for _ in range(60)] + ["ab" * 40, "é" * 30]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], SCHEMA).repartition(3)
    for length, block, piece in ((5, 100, 7), (12, 1 << 20, 20), (40, 300, 1 << 20)):
        assert result(remove_repeats(docs, length=length, block_bytes=block, piece_bytes=piece)) == brute(list(enumerate(texts)), length)


def thue_morse(n, letters):
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


def test_patterns_that_defeat_powers_of_two(spark):
    """Sums of powers modulo 2**64 are equal for a Thue-Morse word and its complement; the texts share no long string."""
    shared = "".join(chr(97 + i % 26) for i in range(100))
    one, two = (thue_morse(2048, x) + shared + thue_morse(2048, x[::-1]) for x in ("0@", "@0"))
    rng = random.Random(9)
    texts = [one, "".join(chr(112 - ord(c)) if c in "0@" else c for c in two), "".join(rng.choice("xyz") for _ in range(50)) + one[:2300]]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], SCHEMA)
    assert result(remove_repeats(docs)) == brute(list(enumerate(texts)))
    a, b = thue_morse(1024, "0@"), thue_morse(1024, "@0")
    x, y = a[:300] + "-" + a[300:600], b[:300] + "-" + b[300:600]
    docs = spark.createDataFrame([(0, x, "en", "s", 0), (1, y, "en", "s", 0)], SCHEMA)
    assert [r[2] for r in result(remove_repeats(docs))] == [w[2] for w in brute([(0, x), (1, y)])]
