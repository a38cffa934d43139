"""Benchmark decontamination by template canonicalisation.

A text becomes a sequence of template tokens: words in lower case without the punctuation around them, with
numbers, units that follow a number and capitalised names inside a sentence replaced by ``<num>``,
``<unit>`` and ``<name>``. Windows of ``width`` template tokens of the benchmark are hash-joined with
those of the documents. Matches of one document and item that share a shift are an alignment; it counts when
its slots are consistent, that is, every slot value of the item stands for one value in the document wherever
it occurs. Runs of windows of such alignments that follow each other in both texts, at most the item's length apart
in the document, are summed along the best chain that stays consistent, so inserted, deleted and replaced words cost only
the windows they touch. A document holds an item when a chain covers enough of its windows, when it has enough of its tokens
and at least ``passage``, or when one run is a passage of so many tokens. A copy that is edited so often that no
``width`` tokens in a row are left is not found. So a question asked again with other numbers or names is caught, and a text
that only has the item's shape is not.

A window meets windows of the same template when ``literals`` of its tokens at least are not slots, and windows of the same
words, values included, always. So a window made mostly of numbers or names matches its copies alone, and a verbatim copy is
found whatever the item is made of and wherever a sentence begins.

Items shorter than ``width`` are windows of their own length. While the benchmark's windows are no more
than ``filter_bound`` (counted first), tasks hold their hashes and send only document windows that can
match; beyond it every document window goes through the join. Both give the same rows. A passage
that very many documents share meets few windows of the benchmark, so the join makes a row for each
occurrence and window, never pairs of documents.

Defined results: null or empty texts and items match nothing; repeated rows are one document; null ids
are never reported; empty tables give empty results; only named columns are read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heatledger.llm.common import as_bytes, batches, materialise

#: Units that make a slot after a number.
UNITS = frozenset(
    b"mm cm m km in ft yd mi miles mile meters metres kilometers inches feet g kg mg lb lbs oz pounds grams kilograms ml l liters litres gallons cups "
    b"s sec seconds min minutes h hr hours days weeks months years kmh mph % percent dollars cents euros usd eur c f k j kj w kw v a hz mb gb kb".split()
)
EDGE = b"\"'()[]{}<>.,;:!?*_`-"
NUMBER = re.compile(rb"[+-]?[$]?\d[\d.,:/]*%?$")
GLUED = re.compile(rb"([+-]?\d[\d.,]*)([A-Za-z%]{1,4})$")
NUM, UNIT, NAME = b"<num>", b"<unit>", b"<name>"


def template(text: bytes) -> tuple[list[bytes], list[bytes | None]]:
    """Template tokens and the value of each slot (None for literal tokens)."""
    tokens: list[bytes] = []
    slots: list[bytes | None] = []
    starts = True  # of a sentence
    for word in text.split():
        core = word.strip(EDGE)
        if core:
            # letters of any script tell about names and case, bytes do only where all are ASCII
            seen = core if core.isascii() else core.decode("utf-8", "replace")
            if seen.isalpha() and seen.islower():
                if tokens and tokens[-1] is NUM and core in UNITS:
                    tokens.append(UNIT)
                    slots.append(core)
                else:
                    tokens.append(core)
                    slots.append(None)
            elif NUMBER.match(core):
                tokens.append(NUM)
                slots.append(core.rstrip(b".,:/"))
            elif (glued := GLUED.match(core)) and glued[2].lower() in UNITS:
                tokens += [NUM, UNIT]
                slots += [glued[1], glued[2].lower()]
            elif not starts and seen[:1].isupper() and seen[1:].islower() and seen.isalpha():
                tokens.append(NAME)
                slots.append(core)
            elif tokens and tokens[-1] is NUM and core.lower() in UNITS:
                tokens.append(UNIT)
                slots.append(core.lower())
            else:
                tokens.append(core.lower() if seen is core else seen.lower().encode())
                slots.append(None)
            starts = False
        if word[-1:] in b".!?:":
            starts = True
    return tokens, slots


def window_hashes(tokens: list[bytes], width: int) -> list[int]:
    """Signed hash of each window of ``width`` tokens."""
    digest = xxhash.xxh3_64_intdigest
    joined = b" ".join(tokens)
    ends, at = [], -1
    for t in tokens:
        at += len(t) + 1
        ends.append(at)
    begins = [0, *[e + 1 for e in ends[:-1]]]
    return np.array([digest(joined[a:b]) for a, b in zip(begins, ends[width - 1 :], strict=False)], np.uint64).view(np.int64).tolist()


ITEM = "item long, n_windows int, n_open int, pos int, open boolean, h long, width int, slots array<string>"
FOUND = "doc_id long, item long, coverage double, n_slots long, n_changed long"
HIT = "doc_id long, pos int, h long, width int, slots array<string>"


def _values(slots, i, width):
    return [None if v is None else v.decode("utf-8", "replace") for v in slots[i : i + width]]


def window_keys(tokens: list[bytes], slots: list[bytes | None], widths: list[int], literals: int, words=None):
    """(width, position, hash): of each window's template if enough of it is literal, and of its words if it has slots.

    If ``words`` is given, only windows whose tokens are all in it.
    """
    digest = xxhash.xxh3_64_intdigest
    filled = np.concatenate(([0], np.cumsum([v is not None for v in slots], dtype=np.int64)))
    spelt = [t if v is None else v.lower() for t, v in zip(tokens, slots, strict=True)] if filled[-1] else tokens
    for seq in (tokens, spelt) if filled[-1] else (tokens,):
        miss = None if words is None else np.concatenate(([0], np.cumsum([t not in words for t in seq], dtype=np.int64)))
        for w in widths:
            if len(tokens) < w:
                continue
            n = filled[w:] - filled[:-w]
            wanted = n <= w - min(literals, w) if seq is tokens else n > 0
            if miss is None:
                hashes = window_hashes(seq, w)
                yield from ((w, i, hashes[i]) for i in np.flatnonzero(wanted).tolist())
                continue
            for i in np.flatnonzero(wanted & (miss[w:] == miss[:-w])).tolist():
                h = digest(b" ".join(seq[i : i + w]))
                yield w, i, h - (1 << 64) if h >> 63 else h


def _item_windows(width: int, literals: int):
    schema = pa.schema([("item", pa.int64()), ("n_windows", pa.int32()), ("n_open", pa.int32()), ("pos", pa.int32()), ("open", pa.bool_()), ("h", pa.int64()), ("width", pa.int32()), ("slots", pa.list_(pa.string()))])

    def run(items):
        for b in batches(items):
            rows = []
            for item, text in zip(b.column(0).to_pylist(), as_bytes(b.column(1)), strict=True):
                tokens, slots = template(text)
                w = min(width, len(tokens))
                if item is None or not w:
                    continue
                is_open = [sum(v is None for v in slots[i : i + w]) >= min(literals, w) for i in range(len(tokens) - w + 1)]
                rows += [(item, len(is_open), sum(is_open), i, is_open[i], h, w, _values(slots, i, w)) for _, i, h in window_keys(tokens, slots, [w], literals)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)

    return run


def _doc_windows(widths: list[int], literals: int, known):
    """Windows of documents; only those whose hash is ``known`` if that is given as (words, {width: hashes})."""
    schema = pa.schema([("doc_id", pa.int64()), ("pos", pa.int32()), ("h", pa.int64()), ("width", pa.int32()), ("slots", pa.list_(pa.string()))])

    def pack(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)

    def run(items):
        words, hashes = known.value if known is not None else (None, None)
        rows: list[tuple] = []
        for b in batches(items):
            for doc, text in zip(b.column(0).to_pylist(), as_bytes(b.column(1)), strict=True):
                if doc is None:
                    continue
                tokens, slots = template(text)
                rows += [(doc, i, h, w, _values(slots, i, w)) for w, i, h in window_keys(tokens, slots, widths, literals, words) if hashes is None or h in hashes[w]]
                if len(rows) > 20000:
                    yield pack(rows)
                    rows = []
        if rows:
            yield pack(rows)

    return run


def _mapping(pairs, known=()) -> dict | None:
    """``known`` with the (item value, document value) ``pairs``; None if an item value would stand for two."""
    out = dict(known)
    for a, b in pairs:
        if out.setdefault(a, b) != b:
            return None
    return out


def align(runs: list[tuple], open_at: set, n_windows: int, width: int, n_open: int | None = None) -> tuple[float, int, int, int, int]:
    """Of runs of matched windows (position in document, in item, number, slot values as (token of the item, item's value, document's value)) the share,
    slots and changed slots of the best chain, most tokens of a chain and of a run. ``open_at`` are the item's windows that other values may fill.

    The share is that of all ``n_windows``, or of the ``n_open`` open ones if that is greater. Among chains of equal share that with the fewest changed slots counts, then that with the most slots.
    """
    n_open = n_windows if n_open is None else n_open
    before = [0]
    for pos in range(n_windows):
        before.append(before[-1] + (pos in open_at))

    def opened(pos: int, n: int) -> int:
        return before[pos + n] - before[pos]

    def share(n: int, n_opened: int) -> float:
        return max(n / n_windows, n_opened / max(1, n_open))

    shifts: dict[int, list[tuple]] = {}
    for run in runs:
        shifts.setdefault(run[0] - run[1], []).append(run)
    chains: list[tuple] = []
    kept: list[tuple] = []
    for own in shifts.values():
        slots = _mapping((a, b) for _, _, _, pairs in own for _, a, b in pairs)
        if slots is None:
            continue
        chains.append((share(sum(r[2] for r in own), sum(opened(r[1], r[2]) for r in own)), slots))
        kept += own
    kept.sort(key=lambda r: r[:2])
    reach = n_windows + width - 1
    ends: list[tuple[tuple[int, int], dict, int]] = []  # the best chain that ends with each run: windows and open ones, slots, tokens
    for j, (doc, pos, n, pairs) in enumerate(kept):
        best = ((n, opened(pos, n)), _mapping((a, b) for _, a, b in pairs), n + width - 1)
        for i in range(j - 1, -1, -1):
            last_doc, last_pos, last_n, _ = kept[i]
            if doc - last_doc > reach + n_windows:
                break
            if doc - last_doc - last_n > reach:
                continue
            skip = max(0, last_doc + last_n - doc, last_pos + last_n - pos)
            if skip >= n:
                continue
            both = (ends[i][0][0] + n - skip, ends[i][0][1] + opened(pos + skip, n - skip))
            if share(*both) <= share(*best[0]):
                continue
            slots = _mapping(((a, b) for t, a, b in pairs if t >= pos + skip), ends[i][1])
            if slots is not None:
                twice = max(0, max(last_doc - doc, last_pos - pos) + last_n + width - 1 - skip)
                best = (both, slots, ends[i][2] + max(0, n - skip + width - 1 - twice))
        ends.append(best)
    if not kept:
        return 0, 0, 0, 0, 0
    chains += [(share(*n), slots) for n, slots, _ in ends]
    most, fewest, n_slots = max((part, -sum(a != b for a, b in slots.items()), len(slots)) for part, slots in chains)
    return most, n_slots, -fewest, max(e[2] for e in ends), max(r[2] for r in kept) + width - 1


def _judge(coverage: float, passage: int):
    schema = pa.schema([("doc_id", pa.int64()), ("item", pa.int64()), ("coverage", pa.float64()), ("n_slots", pa.int64()), ("n_changed", pa.int64())])

    def run(items):
        for b in batches(items):
            rows = []
            for r in b.to_pylist():
                runs = [(x["doc_pos"], x["pos"], x["n"], [(p["t"], p["a"], p["b"]) for p in x["pairs"]]) for x in r["runs"]]
                part, slots, changed, tokens, longest = align(runs, set(r["open_at"] or ()), r["n_windows"], r["width"], r["n_open"])
                length = r["n_windows"] + r["width"] - 1
                if part and (part >= coverage or longest >= passage or (tokens >= passage and tokens / length >= coverage)):
                    rows.append((r["doc_id"], r["item"], part, slots, changed))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)

    return run


def _vocabulary():
    schema = pa.schema([("word", pa.binary())])

    def run(items):
        for b in batches(items):
            words = {t for text in as_bytes(b.column(0)) for seq in zip(*template(text), strict=True) for t in (seq[0], (seq[1] or b"").lower()) if t}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(words), pa.binary())], schema=schema)

    return run


def contaminated(docs: DataFrame, items: DataFrame, width: int = 8, literals: int = 4, coverage: float = 0.5, filter_bound: int = 2_000_000, passage: int = 13) -> DataFrame:
    """Rows (doc_id, item_id, coverage, n_slots, n_changed) of documents that hold a benchmark item.

    ``coverage`` is the share of the item's windows in the best chain, or that of its open windows if it is greater: those
    in which ``literals`` tokens at least are not slots, so that other values may fill them. It must reach the parameter,
    unless ``passage`` tokens in a row match, or as many in the chain that are this share of the item's. ``n_changed`` counts
    slot values that differ.
    """
    spark = docs.sparkSession
    bench = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("item_id IS NOT NULL").distinct()
    # texts under one id are items of their own until the end
    bench = bench.withColumn("item", F.xxhash64("item_id", "text"))
    windows = materialise(bench.select("item", "text").mapInArrow(_item_windows(width, literals), ITEM), "benchmark-windows")
    widths = sorted(r.width for r in windows.select("width").distinct().collect())
    known = None
    if windows.count() <= filter_bound:
        words = {bytes(r.word) for r in bench.select("text").mapInArrow(_vocabulary(), "word binary").distinct().collect()}
        by_width: dict[int, set] = {w: set() for w in widths}
        for r in windows.select("width", "h").distinct().collect():
            by_width[r.width].add(r.h)
        known = spark.sparkContext.broadcast((words, by_width))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = texts.mapInArrow(_doc_windows(widths, literals, known), HIT).dropDuplicates(["doc_id", "pos", "width", "h"])
    found = found.withColumnRenamed("slots", "doc_slots").withColumnRenamed("pos", "doc_pos")
    met = found.join(windows, ["h", "width"])
    values = F.transform(F.arrays_zip(F.col("slots").alias("a"), F.col("doc_slots").alias("b")), lambda x, i: F.struct((F.col("pos") + i).alias("t"), x["a"].alias("a"), x["b"].alias("b")))
    placed = met.select("doc_id", "item", "n_windows", "n_open", "width", "pos", (F.col("doc_pos") - F.col("pos")).alias("shift"), F.filter(values, lambda x: x["a"].isNotNull() & x["b"].isNotNull()).alias("pairs"))
    # windows next to each other on a diagonal become one run, so a text that repeats a phrase of an item brings its runs together, not all pairs of windows
    diagonal = Window.partitionBy("doc_id", "item", "shift").orderBy("pos")
    island = placed.withColumn("island", F.col("pos") - F.dense_rank().over(diagonal))
    item = ["doc_id", "item", "n_windows", "n_open", "width"]
    runs = island.groupBy(*item, "shift", "island").agg(F.min("pos").alias("pos"), (F.max("pos") - F.min("pos") + 1).alias("n"), F.array_distinct(F.flatten(F.collect_list("pairs"))).alias("pairs"))
    at = runs.groupBy(*item).agg(F.collect_list(F.struct((F.col("pos") + F.col("shift")).alias("doc_pos"), "pos", "n", "pairs")).alias("runs"))
    openings = windows.filter("open").groupBy(F.col("item").alias("of")).agg(F.collect_set("pos").alias("open_at"))
    judged = at.join(openings, F.col("item") == F.col("of"), "left").drop("of").mapInArrow(_judge(coverage, passage), FOUND)
    best = F.struct("coverage", (-F.col("n_changed")).alias("same"), "n_slots", "n_changed")
    return judged.join(bench.select("item", "item_id"), "item").groupBy("doc_id", "item_id").agg(F.max(best).alias("best")).select("doc_id", "item_id", "best.coverage", "best.n_slots", "best.n_changed")


def op4_decontamination(spark, sf_dir: str) -> DataFrame:
    """Whole ``documents`` against whole ``benchmark``: a row for each document and item that it holds."""
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item."""
    lost = materialise(contaminated(docs, items).select(F.col("doc_id").alias("_dc_id")).distinct(), "contaminated")
    return docs.join(lost, F.col("doc_id").cast("long") == F.col("_dc_id"), "left_anti")
