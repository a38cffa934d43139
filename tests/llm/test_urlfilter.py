import math
import re
from collections import Counter

import pytest

from heatledger.llm import urlfilter
from heatledger.llm.urlfilter import Rule

SCHEMA = "page_id long, url string, html string, host string, words string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)


def cut(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def slow_split(run, counts, total):
    """The best split by trying all of them, shortest first word last."""
    def weight(w):
        return math.log10(counts[w] / total) if w in counts else 1 - math.log10(total) - len(w)

    best = max((weight(run[:k]) + (slow_split(run[k:], counts, total)[0] if k < len(run) else 0.0), k) for k in range(1, len(run) + 1))
    k = best[1]
    return best[0], [run[:k], *(slow_split(run[k:], counts, total)[1] if k < len(run) else [])]


def slow(rows, seeds, smoothing=1000.0):
    """Verdicts of the model by plain Python over all rows."""
    counts = Counter(seeds)
    letters = r"[^\W\d_]+"
    for _, url, html in rows:
        host, path = cut(url)
        text = " ".join([re.sub(r"<[^<>]*>", " ", html or "").lower(), path.lower(), *[x for x in host.split(".") if "-" in x]])
        counts.update(w for w in re.findall(letters, text) if len(w) <= urlfilter.MAX_WORD)
    total = sum(counts.values())
    known = {w: math.log10(n) - math.log10(total) for w, n in counts.items()}
    split = lambda r: urlfilter.segment(r, {(i, j): known[r[i:j]] for i in range(len(r)) for j in range(i + 1, len(r) + 1) if r[i:j] in known}, 1 - math.log10(total))
    tokens, words = [], []
    for _, url, _ in rows:
        host, path = cut(url)
        hw = [w for r in re.findall(letters, host) for i in range(0, len(r), 63) for w in split(r[i : i + 63])]
        pw = ["0" if t.isdigit() else t for t in re.findall(r"[^\W_]+", path.lower())]
        words.append(" ".join(hw))
        tokens.append(([("h", w) for w in hw] + [("p", w) for w in pw], bool((set(hw) | set(pw)) & set(seeds))))
    n = {c: Counter(t for ts, s in tokens if s == c for t in ts) for c in (False, True)}
    size = {c: sum(n[c].values()) for c in n}
    docs = Counter(s for _, s in tokens)
    scores = []
    for ts, _ in tokens:
        odds = math.log(docs[True] + 1) - math.log(docs[False] + 1)
        for t in ts:
            share = (n[True][t] + n[False][t]) / (size[True] + size[False])
            odds += math.log((n[True][t] + smoothing * share) / (size[True] + smoothing)) - math.log((n[False][t] + smoothing * share) / (size[False] + smoothing))
        scores.append(odds)
    return words, scores


def test_split_is_the_best_of_all():
    counts = {"the": 50, "them": 10, "theme": 3, "me": 20, "park": 5, "a": 30, "rk": 1, "par": 4, "kin": 2, "king": 3, "parking": 2, "g": 1}
    total = sum(counts.values())
    for run in ("thepark", "themepark", "parking", "theparking", "qzx", "themeparkinga", "g", "xthey"):
        known = {(i, j): math.log10(counts[run[i:j]]) - math.log10(total) for i in range(len(run)) for j in range(i + 1, len(run) + 1) if run[i:j] in counts}
        mine = urlfilter.segment(run, known, 1 - math.log10(total))
        weight = sum(math.log10(counts[w] / total) if w in counts else 1 - math.log10(total) - len(w) for w in mine)
        assert "".join(mine) == run and math.isclose(weight, slow_split(run, counts, total)[0])


@pytest.fixture(scope="module")
def rows():
    text = "<p>best online casino games and cheap pills</p> the garden book shop " * 30
    urls = ["http://bestcasinogames.com/en/1", "https://www.cheappills.org/shop/2?x=1", "http://thegardenbook.org/read/77", "http://gardenshop.org/fr/7", "http://a.net/q", "http://EXAMPLE.net/en/x#y",
            "http://example.com/de/3", "http://cheap-onlinegames.com/", "no scheme", None, "http://", "x://?q", "http://" + "gardenbook" * 30 + ".com/" + "word/" * 3000, "http://münchenbuch.de/straße/٣"]
    return [(i, u, text if i % 2 else None) for i, u in enumerate(urls)] + [(0, urls[0], None), (None, urls[2], "x")]


def test_equals_slow(spark, rows):
    seeds = ("casino", "pills")
    out = urlfilter.judge(frame(spark, rows), rules=(), seeds=seeds, buckets=1 << 22).collect()
    words, scores = slow(rows, seeds)
    assert sorted((r.page_id is None, r.page_id or 0, r.host, r.path, r.host_words, round(r.score, 6)) for r in out) == sorted((i is None, i or 0, *cut(u), w, round(s, 6)) for (i, u, _), w, s in zip(rows, words, scores, strict=True))
    assert {r.page_id: r.host_words for r in out}[0] == "best casino games com"
    assert all((r.verdict == "block") == (r.score > 0) for r in out) and {r.verdict for r in out if r.page_id in (0, 1)} == {"block"}
    assert all(r.rule is None for r in out)


def test_rules(spark):
    cases = {"http://a.net/": ("net/", "block"), "http://net/x": ("net/", "block"), "http://a.net": (None, "allow"), "http://s.example.net/en/1": ("example.net/en/", "allow"), "http://example.net/fr/": ("net/", "block"),
             "http://notexample.com/de/": (None, "allow"), "http://b.example.com/de/9": ("example.com/de/", "block"), "http://example.com/DE/": (None, "allow"), "http://x.ORG/fr/?a": ("org/fr/", "allow"), "http://x.net:80/": (None, "allow")}
    out = urlfilter.judge(frame(spark, [(i, u, None) for i, u in enumerate(cases)])).collect()
    assert {r.page_id: (r.rule, r.verdict) for r in out} == dict(enumerate(cases.values()))
    tied = urlfilter.judge(frame(spark, [(1, "http://ab.c/de", None)]), rules=(Rule("allow", "c", "/de"), Rule("block", "ab.c", "/"))).collect()
    assert tied[0].rule == "ab.c/"


def test_learns_words_it_was_not_told(spark):
    """Hosts of one class share words; a host with these and no seed gets the class of the others."""
    bad = [(i, f"http://casino{w}farm{i}.com/deal/{i}", None) for i, w in enumerate(["lucky", "mega", "super"] * 20)]
    good = [(100 + i, f"http://{w}garden{i}.org/story/{i}", None) for i, w in enumerate(["lovely", "quiet", "green"] * 40)]
    new = [(900, "http://megaluckyfarm.com/deal/5", "<b>lucky mega super farm garden lovely quiet green deal story</b>"), (901, "http://quietlovelygarden.org/story/1", None)]
    out = {r.page_id: r for r in urlfilter.judge(frame(spark, bad + good + new), rules=()).collect()}
    assert out[900].host_words == "mega lucky farm com" and out[900].verdict == "block" and out[901].verdict == "allow"
    assert all(out[i].verdict == "block" for i, _, _ in bad) and all(out[i].verdict == "allow" for i, _, _ in good)


def test_empty_and_query(spark):
    assert urlfilter.judge(frame(spark, [])).collect() == []
    out = urlfilter.op13_url_filter(spark, "/root/testdata/sf0.001").collect()
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    assert sorted((r.page_id, r.host, r.path) for r in out) == sorted((p.page_id, *cut(p.url)) for p in pages)
    ruled = lambda h, p: next((n for n, ok in (("example.net/en/", (h + "/").endswith("example.net/") and p.startswith("/en/")), ("example.com/de/", h.endswith("example.com") and p.startswith("/de/")), ("org/fr/", h.endswith(".org") and p.startswith("/fr/")), ("net/", h.endswith(".net") and p.startswith("/"))) if ok), None)
    assert all(r.rule == ruled(r.host, r.path) for r in out)
