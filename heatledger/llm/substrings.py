"""Exact removal of long repeated byte strings by a distributed difference-cover algorithm.

Positions whose residue modulo the period v is in a difference cover are the samples: any two windows of ``length``
bytes have samples at one same offset below v. Suffixes need to be told apart to that length only, so

1. the samples are sorted by their first v bytes, and equal neighbours get one name;
2. recursion on names: samples are sorted by triples of names, those at the sample, v and 2 v bytes on, which makes names of 3 v bytes, and so forth
   while the name lies in every window that begins less than v bytes before the sample;
3. the remaining suffixes, those of the up to v windows that begin before a sample and hold it first, are merged in by
   the name of the sample and the bytes around it;
4. neighbours in this order are compared to the full length: a window is repeated if a neighbour has the same bytes.

Only equality of neighbours matters, not which of two suffixes is first, so the order is that of hash values: a name is a
hash of the bytes, and sorting brings equal ones together as the order of the bytes would. A sample whose name is unique has no
repeated window and is discarded after each step. Names of steps 1 and 2 are only a sieve, which loses no equal pair;
in steps 3 and 4 strings are equal if their 128-bit cryptographic digests are.

Steps 3 and 4 take the windows of a sample together at first: runs of windows with the same bytes from the first to the last
are all repeated, and one of them goes on, as it may share some windows with a run that is otherwise different; runs that share
no more than the bytes common to all their windows are cut into shorter ones, down to single windows.

Equal texts are one text that occurs more than once; a passage shared by many texts goes on from one of them. Texts are
cut into pieces that own disjoint windows, and pieces packed into blocks, so no text makes a task large.

Defined results: null text is empty; texts shorter than ``length`` stay; rows that repeat an id with the same text
are two documents, so their long strings are repeated; null ids are documents like others; an empty table gives an
empty result; only the named columns are read.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatledger.llm.blocks import SENT, SENT_DDL, answer, batch_of, bundle, messages, tallied, totals, unpack_table, with_answers
from heatledger.llm.common import batches, byte_slices, discard, materialise
from heatledger.llm.cover import COVERS, byte_names, digests, period_for, scrambled, sketches

#: Bits of the sieve's names; other than equal ones meet with a chance of the number of samples in 2**48.
SIEVE = 48

#: A piece of a text: the text's digest and length, whether it occurs more than once, the windows it owns, the bytes of these.
PIECE = pa.schema([("t", pa.binary()), ("n", pa.int64()), ("multi", pa.bool_()), ("own_from", pa.int64()), ("own_to", pa.int64()), ("data", pa.binary())])
#: A run of windows from lo to hi of the text t, in piece i of a block; a is the sample, near names what all windows share.
RUNS = pa.schema([("block", pa.int64()), ("i", pa.int32()), ("t", pa.binary()), ("a", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64()), ("multi", pa.bool_()), ("near", pa.int64()), ("full1", pa.int64()), ("full2", pa.int64())])
RUNS_DDL = "block long, i int, t binary, a long, lo long, hi long, multi boolean, near long, full1 long, full2 long"


def cut_pieces(length: int, piece_bytes: int):
    """Pieces of a text (t, copies, text), as rows of ``PIECE``."""

    def cut(_, fields):
        t, copies, text = fields
        n_windows = len(text) - length + 1
        for at in range(0, max(0, n_windows), piece_bytes):
            to = min(at + piece_bytes, n_windows)
            yield t, len(text), copies > 1, at, to, text[at : to - 1 + length]

    return cut


class Samples(NamedTuple):
    """Samples of a block, in order: the piece of each, its position in the text, its name."""

    piece: np.ndarray
    at: np.ndarray
    name: np.ndarray


def levels(length: int, period: int) -> int:
    """How many times names of three can be made of names."""
    n, reach = 0, period
    while 3 * reach <= length - period + 1:
        n, reach = n + 1, 3 * reach
    return n


def first_names(pieces: pa.Table, period: int) -> Samples:
    """Samples named by their first ``period`` bytes."""
    cover = np.array(COVERS[period])
    begin = pieces.column("own_from").to_numpy()
    found = [], [], []
    for first, data, offsets in byte_slices(pieces.column("data").combine_chunks(), 2 << 20):
        n = np.diff(offsets)
        starts = begin[first : first + len(n)]
        # all residues of the cover in each piece, in order of position
        low, high = starts // period, (starts + n - period) // period
        each = np.maximum(0, high - low + 1)
        row = np.repeat(np.arange(len(n)), each)
        turn = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each) + low[row]
        at = (turn[:, None] * period + cover).ravel()
        row = np.repeat(row, len(cover))
        there = (at >= starts[row]) & (at + period <= starts[row] + n[row])
        row, at = row[there], at[there]
        local = at - starts[row] + offsets[row]
        found[0].append(first + row)
        found[1].append(at)
        found[2].append(byte_names(data, local, period))
    return Samples(*(np.concatenate(x) for x in found))


def recursed(samples: Samples, told: list | None, step: int, order: int) -> Samples:
    """Samples whose name, and those ``step`` samples and twice as many on, occur elsewhere, named by the three."""
    key, _, place = tallied(sieve(samples), np.zeros(len(samples.name), bool))
    again = answer(told, order)[place] > 1
    n = max(0, len(again) - 2 * step)
    ok = again[:n] & again[step : step + n] & again[2 * step :] & (samples.piece[:n] == samples.piece[2 * step :])
    at = np.flatnonzero(ok)
    one, two, three = samples.name[at], samples.name[at + step], samples.name[at + 2 * step]
    with np.errstate(over="ignore"):
        name = scrambled(scrambled(one * np.uint64(3)) + two) ^ three
    return Samples(samples.piece[at], samples.at[at], scrambled(name))


def sieve(samples: Samples) -> np.ndarray:
    return scrambled(samples.name) >> np.uint64(64 - SIEVE)


def named(pieces: pa.Table, told: list | None, period: int, upto: int) -> Samples:
    """Samples of a block named by the ``upto``-th level of names."""
    samples = first_names(pieces, period)
    if upto:
        # discarded samples would break the steps of v bytes, so each level starts from all samples of the one before
        step, kept = len(COVERS[period]), samples
        for order in range(upto):
            every = kept
            kept = recursed(every, told, step, order)
            if order + 1 < upto:
                kept = _spread(every, kept)
                step *= 3
        return kept
    return samples


def _spread(every: Samples, kept: Samples) -> Samples:
    """All samples of ``every``; those that were discarded have a name of their own."""
    where = np.searchsorted(_place(every.piece, every.at), _place(kept.piece, kept.at))
    name = scrambled(_place(every.piece, every.at).astype(np.uint64) + np.uint64(1))
    name[where] = kept.name
    return Samples(every.piece, every.at, name)


def _place(piece: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (piece.astype(np.int64) << 36) + at


def _send(period: int, order: int, parts: int):
    """Messages about the names of level ``order`` of blocks (block, data, told)."""

    def run(items):
        for batch in batches(items):
            for k in range(batch.num_rows):
                pieces = unpack_table(batch.column(1)[k].as_py())
                samples = named(pieces, batch.column(2)[k].as_py(), period, order)
                weight = 1 + pieces.column("multi").to_numpy(zero_copy_only=False).astype(np.int64)
                keys, counts, _ = tallied(sieve(samples), weight[samples.piece])
                rows = messages(order, batch.column(0)[k].as_py(), keys, np.minimum(counts, 2), parts, SIEVE)
                if rows:
                    yield batch_of(rows, SENT)

    return run


def _runs_of(block: int, pieces: pa.Table, piece: np.ndarray, a: np.ndarray, lo: np.ndarray, hi: np.ndarray, multi: np.ndarray, near: tuple[np.ndarray, np.ndarray] | None, salt: np.ndarray, length: int):
    """Batches of rows of ``RUNS`` for runs given by piece, in order of pieces; ``near``, none for single windows, and the windows are positions in texts."""
    begin = pieces.column("own_from").to_numpy()
    texts = pieces.column("t").combine_chunks()
    for first, data, offsets in byte_slices(pieces.column("data").combine_chunks(), 2 << 20):
        f, e = np.searchsorted(piece, [first, first + len(offsets) - 1])
        if f == e:
            continue
        shift = offsets[piece[f:e] - first] - begin[piece[f:e]]
        # what is alike for single windows needs no name besides the full one
        common = sketches(data, (near[0][f:e] + shift).tolist(), (near[1][f:e] + shift).tolist(), salt[f:e].tolist()) if near is not None else np.zeros(e - f, np.int64)
        full = digests(data, (lo[f:e] + shift).tolist(), (hi[f:e] + length + shift).tolist(), (salt[f:e] * 65536 + (near[0][f:e] - lo[f:e] if near is not None else 0)).tolist())
        columns = [np.full(e - f, block), piece[f:e].astype(np.int32), texts.take(pa.array(piece[f:e])), a[f:e], lo[f:e], hi[f:e], multi[f:e], common, full[:, 0], full[:, 1]]
        yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, g.type) for c, g in zip(columns, RUNS, strict=True)], schema=RUNS)


def _merge(length: int, period: int, order: int):
    """The windows that begin before a sample left by the last level of names, as one run each."""

    def run(items):
        for batch in batches(items):
            for k in range(batch.num_rows):
                pieces, told = unpack_table(batch.column(1)[k].as_py()), batch.column(2)[k].as_py()
                samples = named(pieces, told, period, order)
                _, _, place = tallied(sieve(samples), np.zeros(len(samples.name), bool))
                left = np.flatnonzero(answer(told, order)[place] > 1)
                piece, a = samples.piece[left], samples.at[left]
                col = {c: pieces.column(c).to_numpy(zero_copy_only=False)[piece] for c in ("n", "own_from", "own_to", "multi")}
                lo, hi = np.maximum(col["own_from"], a - period + 1), np.minimum(np.minimum(a, col["n"] - length), col["own_to"] - 1)
                ok = lo <= hi
                piece, a, lo, hi, multi = piece[ok], a[ok], lo[ok], hi[ok], col["multi"][ok]
                yield from _runs_of(batch.column(0)[k].as_py(), pieces, piece, a, lo, hi, multi, (a, a - period + 1 + length), np.zeros(len(a), np.int64), length)

    return run


def _cut(length: int, size: int):
    """Runs of at most ``size`` windows of blocks (block, data, found), cut at multiples of it as counted back from the sample."""

    def run(items):
        for batch in batches(items):
            for k in range(batch.num_rows):
                found = batch.column(2)[k].values
                pieces = unpack_table(batch.column(1)[k].as_py())
                col = {f.name: found.field(f.name).to_numpy(zero_copy_only=False) for f in found.type}
                order = np.argsort(col["i"], kind="stable")
                col = {c: x[order] for c, x in col.items()}
                low, high = (col["a"] - col["hi"]) // size, (col["a"] - col["lo"]) // size
                each = high - low + 1
                at = np.repeat(np.arange(len(each)), each)
                j = np.arange(len(at)) - np.repeat(np.cumsum(each) - each, each) + low[at]
                last = col["a"][at] - j * size
                lo, hi = np.maximum(col["lo"][at], last - size + 1), np.minimum(col["hi"][at], last)
                # single windows are alike whatever sample led to them
                salt = j + 1 if size > 1 else np.zeros(len(at), np.int64)
                yield from _runs_of(batch.column(0)[k].as_py(), pieces, col["i"][at], col["a"][at], lo, hi, col["multi"][at], (last, last - size + 1 + length) if size > 1 else None, salt, length)

    return run


def sift(rows: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Spans (t, s, e) of the runs whose bytes repeat, and the runs (block, i, a, lo, hi, multi) that go on.

    ``multi`` marks a run that stands for several. One run of each full name goes on, and only where its near
    name has several full ones of which some run stands for itself alone.
    """
    names = ["near", "full1", "full2"]
    # one run of each, that of the smallest hash: in numbers, so that groups are hashed and not sorted
    place, one = ("block", "i", "a", "lo", "hi"), F.xxhash64("block", "i", "a", "lo", "hi")
    each = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("n"), F.max("multi").alias("multi"), *[F.min_by(c, one).alias(c) for c in place])
    each = materialise(each.withColumn("multi", F.col("multi") | (F.col("n") > 1)), "substring-names")
    repeated = each.filter("n > 1").select(*names)
    spans = rows.filter("NOT multi").join(repeated, names).select("t", F.col("lo").alias("s"), (F.col("hi") + length).alias("e"))
    mixed = each.groupBy("near").agg(F.count(F.lit(1)).alias("m"), F.max(~F.col("multi")).alias("alone")).filter("m > 1 AND alone")
    onward = each.join(mixed.select("near"), ["near"], "left_semi").select(*place, "multi")
    spans, onward = materialise(spans, "substring-spans"), materialise(onward, "substring-runs")
    discard(each)
    return spans, onward


def _again(blocks: DataFrame, onward: DataFrame) -> DataFrame:
    """Rows (block, data, found): the blocks that have runs to be cut."""
    lists = onward.groupBy(F.col("block").alias("run_block")).agg(F.collect_list(F.struct("i", "a", "lo", "hi", "multi")).alias("found"))
    return blocks.join(lists, F.col("block") == F.col("run_block")).select("block", "data", "found")


def _whole(length: int):
    """Spans of the texts that occur more than once."""
    schema = pa.schema([("t", pa.binary()), ("s", pa.int64()), ("e", pa.int64())])

    def run(items):
        for batch in batches(items):
            for data in batch.column(1):
                pieces = unpack_table(data.as_py()).filter(pc.field("multi") & (pc.field("own_from") == 0))
                yield pa.RecordBatch.from_arrays([pieces.column("t").combine_chunks(), pa.array(np.zeros(len(pieces), np.int64)), pieces.column("n").combine_chunks()], schema=schema)

    return run


def repeated_spans(rows: DataFrame, length: int = 400, block_bytes: int = 8 << 20, piece_bytes: int = 1 << 20) -> DataFrame:
    """Rows (t, spans): for each text (t, text) with repeated strings, the windows that repeat as [s, e); t is the text's digest."""
    if length < 5:
        raise ValueError("a difference cover of 3 asks for a length of 5 at least")
    period = period_for(length)
    last = levels(length, period)
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    parts = 4 * (int(size // block_bytes) + 1)
    texts = rows.filter(F.octet_length("text") >= length).groupBy("t").agg(F.count(F.lit(1)).alias("copies"), F.first("text").alias("text"))
    blocks = materialise(bundle(texts.select("t", "copies", "text"), cut_pieces(length, piece_bytes), PIECE, block_bytes), "substring-blocks")
    told = []
    sent = blocks.select("block", "data", F.expr("CAST(NULL AS ARRAY<STRUCT<kind: INT, part: INT, data: BINARY>>)").alias("told"))
    for order in range(last + 1):
        told.append(materialise(totals(sent.mapInArrow(_send(period, order, parts), SENT_DDL)), "substring-totals"))
        known = told[0]
        for more in told[1:]:
            known = known.unionByName(more)
        sent = with_answers(blocks, known)
    runs = materialise(sent.mapInArrow(_merge(length, period, last), RUNS_DDL), "substring-merged")
    discard(*told)
    found = [materialise(blocks.mapInArrow(_whole(length), "t binary, s long, e long"), "substring-whole")]
    spans, onward = sift(runs, length)
    found.append(spans)
    shorter = materialise(_again(blocks, onward).mapInArrow(_cut(length, max(2, period // 7)), RUNS_DDL), "substring-shorter")
    discard(runs, onward)
    spans, onward = sift(shorter, length)
    found.append(spans)
    windows = materialise(_again(blocks, onward).mapInArrow(_cut(length, 1), RUNS_DDL), "substring-windows")
    discard(shorter, onward, blocks)
    # a window may come from several samples; two places have different hashes
    places = F.xxhash64("t", "lo"), F.xxhash64("lo", "t")
    keys = windows.groupBy("full1", "full2").agg(F.max("multi").alias("multi"), *[f(p).alias(f"{n}{i}") for i, p in enumerate(places) for n, f in (("low", F.min), ("high", F.max))])
    keys = keys.filter("multi OR low0 <> high0 OR low1 <> high1").select("full1", "full2")
    spans = windows.filter("NOT multi").join(keys, ["full1", "full2"]).select("t", F.col("lo").alias("s"), (F.col("lo") + length).alias("e")).distinct()
    found.append(materialise(spans, "substring-spans"))
    discard(windows)
    union = found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])
    out = materialise(union.groupBy("t").agg(F.collect_set(F.struct("s", "e")).alias("spans")), "substring-found")
    discard(*found)
    return out


def merged(found: list) -> list[list[int]]:
    """Spans without overlaps or contacts, in order."""
    out: list[list[int]] = []
    for s, e in sorted((x["s"], x["e"]) for x in found):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def _remove():
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("spans", pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))), ("kept", pa.binary())])

    def run(items):
        for b in batches(items):
            texts, found = b.column(1).cast(pa.binary()), b.column(2)
            hit = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
            # only texts with spans are touched one by one, the others stay where they are
            which, n_removed, n_spans = np.arange(len(texts)), np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
            spans, kept = [[]] * len(texts), []
            for k in hit.tolist():
                text, cuts = texts[k].as_py(), merged(found[k].as_py())
                edges = [0, *(x for cut in cuts for x in cut), len(text)]
                which[k] = len(texts) + len(kept)
                kept.append(b"".join(text[s:e] for s, e in zip(edges[::2], edges[1::2], strict=True)))
                n_removed[k], n_spans[k] = sum(e - s for s, e in cuts), len(cuts)
                spans[k] = [{"s": s, "e": e} for s, e in cuts]
            rest = pa.concat_arrays([texts, pa.array(kept, pa.binary())]).take(pa.array(which)) if kept else texts
            columns = [b.column(0), pc.binary_length(texts).cast(pa.int64()), pa.array(n_removed), pa.array(n_spans), pa.array(spans, schema.field("spans").type), rest]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, **sizes: int) -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, spans, kept) for every document; kept is the bytes that stay."""
    text = F.encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "UTF-8")
    rows = docs.select(F.col(id_col).cast("long").alias("d"), text.alias("text")).withColumn("t", F.unhex(F.substring(F.sha2("text", 256), 1, 32)))
    spans = repeated_spans(rows.select("t", "text"), length, **sizes).select(F.col("t").alias("st"), "spans")
    joined = rows.join(spans, F.col("t") == F.col("st"), "left").select("d", "text", "spans")
    return joined.mapInArrow(_remove(), "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<struct<s:long,e:long>>, kept binary")


def op8_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Whole ``documents``: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    out = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
