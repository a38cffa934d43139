import random
import re

import pytest
from helpers import SCHEMA, awkward

from heatledger.llm.licenses import TEMPLATES, scan


def words(t):
    return [w for w in re.split(r"[^\w]+|_", (t or "").lower()) if w]


def brute(text, templates, least=0.8):
    """Templates whose containment at some place reaches ``least``, with the best containment."""
    doc, found = words(text), {}
    for i, (_, t) in enumerate(templates):
        w = words(t)
        k = min(5, len(w))
        own = [tuple(w[j : j + k]) for j in range(len(w) - k + 1)]
        spots = [tuple(doc[j : j + k]) for j in range(len(doc))]
        slack = -(-len(own) // 4)
        best = 0.0
        for start in range(-len(own), len(spots)):
            a = max(0, start - slack)
            here = set(spots[a : max(a + 1, start + len(own) + slack)]) if k == 5 else set(spots[max(0, start) : start + 1])
            if here & set(own):
                best = max(best, len(here & set(own)) / len(set(own)))
        if best >= least:
            found[i] = best
    return found


def test_planted_notices_against_brute_force(spark):
    rng = random.Random(6)
    vocabulary = "the of licensed under license version alpha beta gamma this work is free software all rights".split()
    pad = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    texts = [pad(rng.randint(0, 60)) + "\n" + t + "\n" + pad(rng.randint(0, 60)) for _, t in TEMPLATES for _ in range(2)]
    for _, t in TEMPLATES[2:7]:  # a word changed, words missing at the end
        w = t.split()
        texts.append(pad(20) + " " + " ".join([*w[: len(w) // 3], "changed", *w[len(w) // 3 + 1 :]]))
        texts.append(pad(20) + " " + " ".join(w[: int(len(w) * 0.9)]))
    texts += [pad(200), "", None, "All rights", "ALL RIGHTS\nRESERVED"]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], SCHEMA)
    got = {}
    for r in scan(docs).collect():
        got.setdefault(r.doc_id, {})[r.template] = r.containment
    want = {i: f for i, t in enumerate(texts) if (f := brute(t, TEMPLATES))}
    assert {i: set(f) for i, f in got.items()} == {i: set(f) for i, f in want.items()}
    for i, f in want.items():
        assert got[i] == pytest.approx(f)


def test_band_settings():
    from heatledger.llm.licenses import BANDS

    assert 1 - (1 - 0.5) ** BANDS > 0.99


def test_awkward_and_empty(spark):
    docs = awkward(spark).selectExpr("*", "1 AS template", "2 AS Words", "3 AS v")
    assert scan(docs).collect() == []
    assert scan(docs.limit(0)).collect() == []
    got = scan(docs, [("X", "alpha beta gamma delta epsilon zeta"), ("Y", "")]).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.license, r.containment) for r in got) == [(False, 0, "X", 1.0), (False, 1, "X", 1.0), (True, 0, "X", 1.0)]
