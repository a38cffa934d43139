import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import SCHEMA, awkward, frame

from heatledger.llm.blocks import packed, unpacked
from heatledger.llm.ngrams import END, PIECE, automaton, cut_pieces, held_out, lanes_of, score_documents, walk


def words(t):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None]


def held(d):
    return d is not None and zlib.crc32(str(d).encode()) % 7 == 2


class SlowAutomaton:
    """States are tuples of words; None is the end of a text, and as a history its start."""

    def __init__(self, texts, prior):
        self.count, self.prior = Counter(), prior
        for w in texts:
            row = [None, *w]
            for i in range(1, len(row)):
                for order in (1, 2, 3):
                    if i - order + 1 >= 0:
                        self.count[tuple(row[i - order + 1 : i + 1])] += 1
        self.n = sum(c for k, c in self.count.items() if len(k) == 1)
        self.v = sum(len(k) == 1 for k in self.count)

    def weight(self, history, word):
        """Probability of the arc, None where there is none."""
        if not history:
            return (self.count[word,] + 1) / (self.n + self.v + 1)
        if not self.count[(*history, word)]:
            return None
        lower = self.weight(history[1:], word)
        return (self.count[(*history, word)] + self.prior * lower) / (self.count[history] + self.prior)

    def fail(self, history):
        return self.prior / (self.count[history] + self.prior)

    def longest(self, history):
        while history and not self.count[history]:
            history = history[1:]
        return history

    def walk(self, w):
        state, score, failures = self.longest((None,)), 0.0, 0
        for word in w:
            while (p := self.weight(state, word)) is None:
                score += math.log10(self.fail(state))
                failures += 1
                state = state[1:]
            score += math.log10(p)
            state = self.longest((*state[-1:], word))
        return score, failures


def brute(rows, prior):
    slow = SlowAutomaton([words(t) for d, t in rows if not held(d)], prior)
    out = []
    for d, t in rows:
        w = words(t)
        base = sum(math.log10((slow.count[x,] + 1) / (slow.n + slow.v + 1)) for x in w)
        score, failures = slow.walk(w)
        out.append((d, held(d), len(w), sum(slow.count[x,] > 0 for x in w), slow.n, base, score, failures))
    return sorted(out, key=repr)


def check(df, rows, prior=4.0):
    got = sorted((tuple(r) for r in df.collect()), key=repr)
    want = brute(rows, prior)
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert a[:5] == b[:5] and a[7] == b[7] and a[5:7] == pytest.approx(b[5:7], rel=1e-9)


def random_texts(rng, n, longest=40):
    pool = "the The a cat dog É sat on mat\x85 x\x1cy".split(" ")
    return [" ".join(rng.choice(pool) + rng.choice(["", "", str(rng.randrange(9))]) for _ in range(rng.randint(0, longest))) for _ in range(n)]


def test_against_a_slow_walk(spark):
    texts = random_texts(random.Random(2), 80)
    docs = frame(spark, texts).repartition(3)
    for block_bytes, piece_bytes in ((1 << 25, 1 << 16), (500, 1 << 16), (700, 1), (500, 23)):
        check(score_documents(docs, block_bytes=block_bytes, piece_bytes=piece_bytes), list(enumerate(texts)))


def test_probabilities_of_each_state_sum_to_one():
    texts = [words(t) for t in random_texts(random.Random(5), 60)]
    slow = SlowAutomaton(texts, 4.0)
    vocabulary = [k[0] for k in slow.count if len(k) == 1] + ["never seen"]

    def probability(state, word):
        p = slow.weight(state, word)
        return slow.fail(state) * probability(state[1:], word) if p is None else p

    states = [k for k in slow.count if len(k) < 3 and (k[-1] is not None or len(k) == 1)] + [()]
    assert len(states) > 100
    for state in states:
        assert sum(probability(state, w) for w in vocabulary) == pytest.approx(1)


def test_a_block_walks_like_the_slow_automaton():
    """Every word after every history, unseen ones too, within one block."""
    base = [b"a b c", b"b c a b", b"c c a"]
    vocabulary = [b"a", b"b", b"c", b"zz"]
    rows = [p for i, t in enumerate(base) for p in cut_pieces(99)(i, (0, t))]  # id 0 is learnt from
    assert not held_out(0)
    tried = next(d for d in range(99) if held_out(d))
    tests = [b" ".join([*h, w]) for h in ([], [b"a"], [b"a", b"b"], [b"b", b"c"], [b"zz"], [b"a", b"zz"]) for w in vocabulary]
    tests += [b" ".join(h) for h in ([], [b"a"], [b"a", b"b"], [b"b", b"c"], [b"zz"], [b"a", b"zz"])]
    rows += [p for i, t in enumerate(tests) for p in cut_pieces(99)(9 + i, (tried, t))]
    table = pa.table([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(PIECE)], schema=PIECE)
    lanes = lanes_of(table)
    counts = [c for _, c in lanes.distinct.values()]
    n, v = int(counts[0].sum()), int((counts[0] > 0).sum())
    assert END in lanes.distinct[0][0] and n == 3 + 4 + 3 + 3
    score, _ = walk(lanes, automaton(lanes, counts, n, v, 4.0))
    slow = SlowAutomaton([words(t.decode()) for t in base], 4.0)
    for r, s in zip(rows, score, strict=True):
        assert slow.walk(words(r[5].decode()))[0] == pytest.approx(s)


def test_packing_of_counts():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 1000):
        keys = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        values = rng.integers(0, 300, len(keys))
        k, v = unpacked(packed(keys, values))
        assert (k == keys).all() and (v == values).all()


def test_pieces_bring_their_context():
    text = b"one two  three\nfour five"
    assert [r[2:] for r in cut_pieces(99)(0, (7, text))] == [(0, True, True, text)]
    cut = list(cut_pieces(4)(0, (7, text)))
    assert [w for r in cut for w in r[5].split()[r[2] :]] == text.split()
    for before, r in zip(cut, cut[1:], strict=False):
        assert r[5].split()[: r[2]] == before[5].split()[-2:] and r[3] == (len(before[5].split()) < 2)
    assert [r[4] for r in cut] == [False] * (len(cut) - 1) + [True]


def test_longer_histories_help_on_held_out_text(spark):
    texts = ["one two three four five six seven eight nine ten " * (1 + i % 4) for i in range(60)]
    rows = [r for r in score_documents(frame(spark, texts)).collect() if r.held_out]
    assert rows and all(r.score > r.base_score + 5 for r in rows)
    assert {r.doc_id for r in rows} == {i for i in range(60) if held_out(i)}


def test_awkward_and_empty(spark):
    docs = awkward(spark).selectExpr("*", "1 AS block", "2 AS h", "3 AS Total")
    check(score_documents(docs), [(r.doc_id, r.text) for r in docs.collect()])
    assert score_documents(spark.createDataFrame([], SCHEMA)).collect() == []
    only = spark.createDataFrame([(d, "a b", "en", "s", 0) for d in range(100) if held_out(d)], SCHEMA)
    check(score_documents(only), [(r.doc_id, r.text) for r in only.collect()])
