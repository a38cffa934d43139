import random
import re
from itertools import product

import numpy as np
from helpers import SCHEMA, awkward

from heatledger.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = text.split("\n")
    dup = sum(1 for i, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", x) and x in lines[:i])
    wins = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    cover = {i + k for i, w in enumerate(wins) if wins.count(w) > 1 for k in range(3)}
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(cover)]


def test_counts_against_brute_force():
    rng = random.Random(4)
    alphabet = ["a", "b", "É", "c#", "|", " ", "\n", "\t", "\x85", "\x1c", "d e f", "\n\n", "***"]
    for _ in range(200):
        text = "".join(rng.choice(alphabet) + rng.choice(["", " "]) for _ in range(rng.randint(0, 40)))
        assert quality.describe(text.encode())[0] == brute(text)


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(0)
    for n in range(1, 7):
        emit, move = rng.normal(size=(n, 2)), rng.normal(size=(2, 2))
        best = max(product((0, 1), repeat=n), key=lambda p: sum(emit[i, k] for i, k in enumerate(p)) + sum(move[a, b] for a, b in zip(p, p[1:])))
        assert quality.viterbi(emit, move).tolist() == list(best)


def test_gradient_fit_separates():
    good = [np.column_stack([np.ones(4), *np.zeros((len(quality.FEATURES) - 1, 4))]) for _ in range(5)]
    bad = [x.copy() for x in good]
    for x in bad:
        x[:, 4] = 0.5
    weight, move = quality.fit_field(good + bad, [1] * 5 + [0] * 5)
    assert all(quality.viterbi(x @ weight.T, move).all() for x in good)
    assert not any(quality.viterbi(x @ weight.T, move).any() for x in bad)


def test_gradient_against_differences():
    rng = np.random.default_rng(2)
    x, on = rng.normal(size=(6, 5, len(quality.FEATURES))), np.ones((6, 5))
    on[0, 2:] = on[3, 1:] = 0
    x *= on[:, :, None]
    evidence = np.log(np.where(rng.random((6, 1)) < 0.5, [0.8, 0.2], [0.2, 0.8]))
    expected = rng.random((6, 5, 1)) * np.array([1, -1]) + np.array([0, 1])
    at = [rng.normal(size=(2, len(quality.FEATURES))), rng.normal(size=(2, 2))]
    for goal, told in ((quality.likelihood, evidence), (quality.agreement, expected * on[:, :, None])):
        _, *grad = goal(*at, x, on, told)
        for k in (0, 1):
            for i in np.ndindex(at[k].shape):
                near = []
                for step in (1e-5, -1e-5):
                    moved = [a.copy() for a in at]
                    moved[k][i] += step
                    near.append(goal(*moved, x, on, told)[0])
                assert abs((near[0] - near[1]) / 2e-5 - grad[k][i]) < 1e-6


def test_likelihood_against_all_label_sequences():
    rng = np.random.default_rng(3)
    x, weight, move = rng.normal(size=(1, 4, len(quality.FEATURES))), rng.normal(size=(2, len(quality.FEATURES))), rng.normal(size=(2, 2))
    told = np.array([0.3, 0.7])
    weigh = {p: np.exp(sum((x[0, i] @ weight[k]) for i, k in enumerate(p)) + sum(move[a, b] for a, b in zip(p, p[1:]))) for p in product((0, 1), repeat=4)}
    want = sum(w * np.prod(told[list(p)]) for p, w in weigh.items()) / sum(weigh.values())
    value, *_ = quality.likelihood(weight, move, x, np.ones((1, 4)), np.log(told)[None, :], ridge=0.0)
    assert abs(value - np.log(want) / 4) < 1e-9


def test_a_footer_of_a_good_text_is_boilerplate():
    rng = random.Random(8)
    line = lambda: " ".join("word" + "abcdefghij"[rng.randrange(10)] for _ in range(9)) + "."
    junk = lambda: " | ".join("MENU#" + str(rng.randrange(99)) for _ in range(4))
    good = ["\n".join([line() for _ in range(6)] + [junk() for _ in range(i % 3)]) for i in range(30)]
    bad = ["\n".join([junk() for _ in range(7)] + [line() for _ in range(i % 2)]) for i in range(30)]
    weight, move = quality.fit_field([quality.describe(t.encode())[1] for t in good + bad], [1] * 30 + [0] * 30)
    mixed = quality.describe("\n".join([line(), line(), line(), line(), junk(), junk(), junk()]).encode())[1]
    assert quality.viterbi(mixed @ weight.T, move).tolist() == [1, 1, 1, 1, 0, 0, 0]
    assert all(quality.verdict(t.encode(), weight, move)[-1] for t in good)
    assert not any(quality.verdict(t.encode(), weight, move)[-1] for t in bad)


def test_training_sees_lines_far_down(spark):
    text = "\n".join(f"plain line number {i} of the text." for i in range(300))
    docs = spark.createDataFrame([(1, text, "en", "s", 0), (1, None, "en", "s", 0)], SCHEMA)
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    found = []
    held, quality.fit_field = quality.fit_field, lambda docs, labels: found.extend(docs) or held(docs, labels)
    try:
        quality.train(docs, labels)
    finally:
        quality.fit_field = held
    assert sum(map(len, found)) == 300


def test_held_out_documents(spark):
    rng = random.Random(7)

    def doc(good):
        words = [["alpha", "beta", "gamma", "delta"][rng.randrange(4)] + str(rng.randrange(999)) * (not good) for _ in range(80)]
        return ". ".join(" ".join(words[i : i + 8]) for i in range(0, 80, 8)) + "." if good else "\n".join(" | ".join(w.upper() + "***" for w in words[i : i + 8]) for i in range(0, 80, 8))

    truth = [i % 2 for i in range(120)]
    docs = spark.createDataFrame([(i, doc(t), "en", "s", 0) for i, t in enumerate(truth)], SCHEMA)
    labels = spark.createDataFrame([(i, t, 0) for i, t in enumerate(truth[:60])] + [(0, truth[0], 0), (None, 1, 1), (3, None, 1)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.judge(docs, labels).collect()}
    assert len(got) == 120
    assert all((got[i].content_share >= 0.5) == bool(truth[i]) for i in range(60, 120))
    assert all(got[i].kept == (bool(truth[i]) and not got[i].base_failed) for i in range(60, 120))


def test_awkward_and_empty(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = awkward(spark).selectExpr("*", "1 AS kept", "2 AS N_words", "3 AS y")
    rows = quality.judge(docs, labels).collect()
    assert sorted([r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words] for r in rows) == sorted(brute(r.text) if r.text is None or len(r.text) < 999 else [30000, len(r.text) - 29999, 0, 0, 30000] for r in docs.collect())
    assert not any(r.kept for r in rows)
    assert quality.judge(spark.createDataFrame([], SCHEMA), labels).collect() == []
