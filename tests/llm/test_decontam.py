import random

import pytest
from helpers import SCHEMA, awkward

from heatledger.llm import decontam
from heatledger.llm.decontam import contaminated, drop_contaminated, template, window_hashes

ITEMS = [
    (0, "A baker sold 48 loaves to Maria and then 12 loaves to Jonas before noon came around. How many loaves were sold to Maria"),
    (1, "the quick river runs past seven silent mills and turns north near the old stone bridge"),
    (2, "short item of five words"),
    (3, None),
    (4, ""),
    (None, "the quick river runs past seven silent mills"),
]
ITEM_SCHEMA = "item_id long, text string"


def run(spark, texts, **kw):
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], SCHEMA)
    return {(r.doc_id, r.item_id): r for r in contaminated(docs, spark.createDataFrame(ITEMS, ITEM_SCHEMA), **kw).collect()}


def test_template():
    tokens, slots = template(b"Anna met Bob 3.5 km away, 20kg. The cat's 7% rise")
    assert tokens == [b"anna", b"met", b"<name>", b"<num>", b"<unit>", b"away", b"<num>", b"<unit>", b"the", b"cat's", b"<num>", b"rise"]
    assert slots[2] == b"Bob" and slots[3] == b"3.5" and slots[7] == b"kg" and slots[8] is None
    assert window_hashes([b"a", b"b", b"c"], 2) == [window_hashes([b"a", b"b"], 2)[0], window_hashes([b"b", b"c"], 2)[0]]


@pytest.mark.parametrize("bound", [2_000_000, 0])
def test_planted_items(spark, bound):
    words = random.Random(0)
    pad = lambda: " ".join(words.choice("lorem ipsum dolor sit amet elit sed do".split()) for _ in range(30))
    item = ITEMS[0][1]
    texts = [
        pad() + ". " + item + ". " + pad(),  # 0 exact
        pad() + ". " + item.replace("48", "96").replace("12", "31").replace("Maria", "Ingrid").replace("Jonas", "Pavel") + "? " + pad(),  # 1 other slots
        pad() + ". " + item.replace("Maria", "Ingrid", 1) + ". " + pad(),  # 2 one name for two
        pad(),  # 3 clean
        "The quick RIVER runs past seven silent mills",  # 4 less than half of the windows
        pad() + " the quick river runs past seven silent mills and turns north near the old well " + pad(),  # 5 most of an item
        "Short item of five words",  # 6
        None,
        "",
    ]
    got = run(spark, texts, filter_bound=bound)
    assert set(got) == {(0, 0), (1, 0), (5, 1), (6, 2)}
    assert got[0, 0].coverage == 1 and got[0, 0].n_changed == 0
    assert got[1, 0].n_changed == 4
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], SCHEMA)
    assert {r.doc_id for r in drop_contaminated(docs, spark.createDataFrame(ITEMS, ITEM_SCHEMA)).collect()} == {2, 3, 4, 7, 8}


def test_every_item_planted_is_found(spark):
    rng = random.Random(1)
    vocabulary = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(3, 40)))) for i in range(30)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(50)) + "\n" + items[i % 30][1] + "\n" + " ".join(rng.choice(vocabulary) for _ in range(50)) for i in range(60)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], SCHEMA)
    got = {(r.doc_id, r.item_id) for r in contaminated(docs, spark.createDataFrame(items, ITEM_SCHEMA)).collect()}
    assert got >= {(i, i % 30) for i in range(60)}
    assert all(items[b][1] in texts[a] for a, b in got)


def test_awkward_and_empty(spark):
    items = spark.createDataFrame([*ITEMS, (9, "alpha beta gamma delta epsilon zeta")], ITEM_SCHEMA).selectExpr("*", "1 AS h", "2 AS POS")
    docs = awkward(spark).selectExpr("*", "1 AS item_id", "2 AS Shift")
    assert sorted((r.doc_id, r.item_id) for r in contaminated(docs, items).collect()) == [(0, 9), (1, 9)]
    none = spark.createDataFrame([], SCHEMA)
    assert contaminated(none, items).collect() == []
    assert contaminated(docs, spark.createDataFrame([], ITEM_SCHEMA)).collect() == []
    assert drop_contaminated(docs, items).count() == 7


def test_partial_edited_and_coinciding_copies(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    passage, split, replaced = [[word() for _ in range(n)] for n in (60, 30, 20)]
    slots = "the baker sold 48 warm loaves to one crowd and after that sold 12 warm loaves to another crowd nearby"
    items = [(0, " ".join(passage)), (1, " ".join(split)), (2, slots), (3, " ".join(replaced))]
    pad = " ".join(word() for _ in range(20))
    texts = [
        f"{pad} {' '.join(passage[10:34])} {pad}",  # 24 of 60 tokens in a row
        f"{pad} {' '.join([*split[:15], 'inserted', *split[15:]])} {pad}",  # 8 windows of 23 at either shift
        f"{pad} {slots.replace('48', '7').replace('12', '7')} {pad}",  # two values that coincide
        f"{pad} {' '.join([*replaced[:9], *replaced[11:]])} {pad}",  # two words deleted, 2 windows of 13 at either shift
        f"{pad} {' '.join(passage[10:20])} {pad} {' '.join(passage[20:30])} {pad}",  # only short pieces
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], SCHEMA)
    got = {(r.doc_id, r.item_id): r for r in contaminated(docs, spark.createDataFrame(items, ITEM_SCHEMA)).collect()}
    assert set(got) == {(0, 0), (1, 1), (2, 2), (3, 3)}
    assert (got[0, 0].coverage, got[1, 1].coverage, got[3, 3].coverage) == (17 / 53, 16 / 23, 4 / 13)
    assert (got[2, 2].n_slots, got[2, 2].n_changed) == (2, 2)


@pytest.mark.parametrize("bound", [2_000_000, 0])
def test_verbatim_copies_of_slot_rich_items(spark, bound):
    mixed = "count 1 2 3 4 5 6 7 8 9 and then every child of the village sings one more song at dusk"
    items = [(0, "What comes next: 2, 4, 8, 16, 32, 64"), (1, "born 1879 Ulm"), (2, mixed), (3, "Short item of words")]
    pad = "lorem ipsum dolor sit amet elit sed do"
    texts = [
        f"{pad}. {items[0][1]}? {pad}",
        f"{pad} {items[0][1]} {pad}",  # inside a sentence
        f"{pad}. What comes next: 3, 9, 27, 81, 243, 729? {pad}",  # other values of a window that is all but slots
        f"{pad} born 1879 Ulm {pad}",
        f"{pad} born 1880 Ulm {pad}",
        f"{pad} {mixed.replace('9', '14').replace('1 ', '6 ')} {pad}",  # found by the windows that other values may fill
        f"{pad} Short item of words {pad}",  # the first word looks like a name
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], SCHEMA)
    got = {(r.doc_id, r.item_id): r for r in contaminated(docs, spark.createDataFrame(items, ITEM_SCHEMA), filter_bound=bound).collect()}
    assert set(got) == {(0, 0), (1, 0), (3, 1), (5, 2), (6, 3)}
    assert (got[0, 0].coverage, got[0, 0].n_changed) == (1, 0)


def test_names_of_any_script_are_slots():
    tokens, slots = template("Then José gave Zoë 3 apples; Élan vital, über 5 km. Straße".encode())
    assert [t for t, s in zip(tokens, slots, strict=True) if s is not None] == [b"<name>", b"<name>", b"<num>", b"<name>", b"<num>", b"<unit>"]
    assert [s.decode() for s in slots if s is not None][:2] == ["José", "Zoë"]
    assert "straße".encode() in tokens


def align_hits(hits: list[tuple], n_windows: int, width: int, n_open: int | None = None) -> tuple[float, int, int, int, int]:
    """Of matched windows (position in document, in item, slot pairs, whether open): share, slots and changed slots of the best chain, most tokens of a chain and of a run.

    The share is that of all ``n_windows``, or of the ``n_open`` that other values may fill if that is greater.
    """
    n_open = n_windows if n_open is None else n_open
    shifts: dict[int, dict[int, list]] = {}
    is_open: dict[int, bool] = {}
    for doc_pos, pos, pairs, *flag in hits:
        shifts.setdefault(doc_pos - pos, {})[pos] = pairs
        is_open[pos] = flag != [False]

    def share(n: int, opened: int) -> float:
        return max(n / n_windows, opened / max(1, n_open))

    runs: list[tuple[int, int, list]] = []  # first window in document and item, pairs of each window
    chains: list[tuple] = []
    for shift, at in shifts.items():
        slots = decontam._mapping(p for pairs in at.values() for p in pairs)
        if slots is None:
            continue
        chains.append((share(len(at), sum(is_open[pos] for pos in at)), slots))
        for pos in sorted(at):
            if pos - 1 in at:
                runs[-1][2].append(at[pos])
            else:
                runs.append((shift + pos, pos, [at[pos]]))
    runs.sort(key=lambda r: r[:2])
    reach = n_windows + width - 1
    ends: list[tuple[tuple[int, int], dict, int]] = []  # the best chain that ends with each run: windows and open ones, slots, tokens
    for j, (doc, pos, windows) in enumerate(runs):
        opened = [is_open[p] for p in range(pos, pos + len(windows))]
        best = ((len(windows), sum(opened)), decontam._mapping(p for pairs in windows for p in pairs), len(windows) + width - 1)
        for i in range(j - 1, -1, -1):
            before_doc, before_pos, before = runs[i]
            if doc - before_doc > reach + n_windows:
                break
            if doc - before_doc - len(before) > reach:
                continue
            skip = max(0, before_doc + len(before) - doc, before_pos + len(before) - pos)
            both = (ends[i][0][0] + len(windows) - skip, ends[i][0][1] + sum(opened[skip:]))
            if skip >= len(windows) or share(*both) <= share(*best[0]):
                continue
            slots = decontam._mapping((p for pairs in windows[skip:] for p in pairs), ends[i][1])
            if slots is not None:
                twice = max(0, max(before_doc - doc, before_pos - pos) + len(before) + width - 1 - skip)
                best = (both, slots, ends[i][2] + max(0, len(windows) - skip + width - 1 - twice))
        ends.append(best)
    if not runs:
        return 0, 0, 0, 0, 0
    chains += [(share(*n), slots) for n, slots, _ in ends]
    most, fewest, n_slots = max((part, -sum(a != b for a, b in slots.items()), len(slots)) for part, slots in chains)
    return most, n_slots, -fewest, max(e[2] for e in ends), max(len(r[2]) for r in runs) + width - 1


def brute(docs, items, width=8, literals=4, coverage=0.5, passage=13):
    """Every window of every document against every window of every item, token by token; alignment from single windows."""
    out = {}
    for item, text in {(i, t) for i, t in items if i is not None and t}:
        tokens, slots = decontam.template(text.encode())
        w = min(width, len(tokens))
        if not w:
            continue
        spelt = [t if v is None else v.lower() for t, v in zip(tokens, slots, strict=True)]
        literal = [sum(v is None for v in slots[i : i + w]) for i in range(len(tokens) - w + 1)]
        is_open = [n >= min(literals, w) for n in literal]
        for doc, body in docs:
            if doc is None:
                continue
            words, values = decontam.template((body or "").encode())
            said = [t if v is None else v.lower() for t, v in zip(words, values, strict=True)]
            hits = {}
            for j in range(len(words) - w + 1):
                for i in range(len(literal)):
                    own = sum(v is None for v in values[j : j + w])
                    # template or words of the one against template or words of the other: a name that begins a sentence is a word
                    of_item = [tokens[i : i + w]] * is_open[i] + [spelt[i : i + w]] * (literal[i] < w)
                    of_doc = [words[j : j + w]] * (own >= min(literals, w)) + [said[j : j + w]] * (own < w)
                    if any(x in of_doc for x in of_item):
                        hits[j, i] = [(a.decode(), b.decode()) for a, b in zip(slots[i : i + w], values[j : j + w], strict=True) if a is not None and b is not None]
            part, n_slots, changed, chain, longest = align_hits([(j, i, pairs, is_open[i]) for (j, i), pairs in hits.items()], len(literal), w, sum(is_open))
            length = len(literal) + w - 1
            if part and (part >= coverage or longest >= passage or (chain >= passage and chain / length >= coverage)):
                out[doc, item] = max(out.get((doc, item), (0,)), (part, -changed, n_slots))
    return {k: (round(v[0], 9), v[2], -v[1]) for k, v in out.items()}


def test_against_brute_force(spark):
    """Copies with other values, edits, cuts and repeats of items full of slots and of few words, all documents against all items."""
    import random

    rng = random.Random(12)
    vocabulary = ["train", "leaves", "at", "for", "with", "apples", "each", "and", "how", "many", "km", "Paris", "Rome", "7", "12", "3.5", "red", "does", "cost"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([3, 9, 14, 25])))) for i in range(14)]
    items += [(20, "say it again say it again say it again say it again now"), (3, "another text under the id three of twelve plain words in all here"), (None, "no id"), (21, None), (22, ""), items[0]]
    docs = []
    for n in range(70):
        parts = [rng.choice(vocabulary) for _ in range(rng.randrange(12))]
        for _ in range(rng.randrange(3)):
            words = (rng.choice(items)[1] or "").split()
            words = [rng.choice(["8", "31", "Oslo", "Bonn"]) if (x[0].isdigit() or x[0].isupper()) and rng.random() < 0.5 else x for x in words]
            if words and rng.random() < 0.4:
                words[rng.randrange(len(words))] = "zzz"
            low = rng.randrange(4) if rng.random() < 0.3 else 0
            parts += words[low:]
        docs.append((n % 66 if n % 13 else None, " ".join(parts)))
    docs += [(90, "say it again " * 40), (91, None), (92, "")]
    docs = [(d, t) for d, t in {d: (d, t) for d, t in docs if d is not None}.values()] + [(None, "say it again " * 9)]
    frame = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in docs], SCHEMA)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert len(want) > 15
    for bound in (2_000_000, 0):
        got = {(r.doc_id, r.item_id): (round(r.coverage, 9), r.n_slots, r.n_changed) for r in decontam.contaminated(frame, bench, filter_bound=bound).collect()}
        assert {k: (got.get(k), want.get(k)) for k in got.keys() | want.keys() if got.get(k) != want.get(k)} == {}


def test_repeated_phrases_stay_runs(spark):
    """A text that repeats an item's own repeated phrase is judged from as many runs as there are diagonals."""
    phrase = "round and round the little wheel goes "
    docs = spark.createDataFrame([(1, phrase * 500, "en", "s", 0), (2, "nothing of it", "en", "s", 0)], SCHEMA)
    bench = spark.createDataFrame([(1, phrase * 50)], "item_id long, text string")
    out = decontam.contaminated(docs, bench).collect()
    assert [(r.doc_id, r.coverage) for r in out] == [(1, 1.0)]
