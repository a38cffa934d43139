"""Conflict-constrained best-fit packing of documents into sequences.

A document longer than the capacity gives full pieces, each a bin of its own, and a rest; rests and short
documents are packed. A bin never holds two pieces of one duplicate cluster, and no more than
``per_source`` pieces of one source. A cluster is a component of near duplicates by SimHash; texts that are the same but for
case and white space conflict as well, whatever their component. Each bin carries a bitmap of the sources that are full in it and one of its
clusters; open bins are kept ordered by residual, and for each piece, longest first, the search starts at the
smallest residual that fits and goes to the next larger until a bin has neither bit set.

Pieces are dealt by a hash of the id into shards of about ``shard_rows``, so a hot source or cluster
spreads evenly over all shards, and each shard is packed by itself in a task. Only ids, sources, cluster
hashes and lengths are shuffled. Two pieces of a cluster in different shards are in different bins anyway.

Defined results: null or empty texts have the end token alone; a null source conflicts with no other piece;
a null id is packed like any other and reported as null, near copies with null ids conflict like others; rows that repeat an id are packed each; an
empty table gives no bins; only named columns are read.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatledger.llm.common import as_bytes, batches, materialise
from heatledger.llm.simhash import near_duplicates

PIECE = "doc_id long, piece long, bin_id long, slot int, start_token long, n_tokens long, source string, cluster long"
SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int64()), ("bin_id", pa.int64()), ("slot", pa.int32()), ("start_token", pa.int64()), ("n_tokens", pa.int64()), ("source", pa.string()), ("cluster", pa.int64())]
)
#: Bins of a shard have ids from shard * STRIDE.
STRIDE = 1 << 32


def best_fit(lengths: list[int], sources: list[int], clusters: list[int], capacity: int, per_source: int, copies: list[int] | None = None) -> list[int]:
    """Bin of each piece, in the order given; negative sources, clusters and copies conflict with nothing. ``copies`` are a second kind of cluster."""
    copies = copies or [-1] * len(lengths)
    above = max(clusters, default=-1) + 1  # bits of clusters
    order: list[tuple[int, int]] = []  # (residual, bin)
    full: list[int] = []  # bitmap of each bin's sources that take no more
    inside: list[int] = []  # bitmap of its clusters
    count: list[dict[int, int]] = []
    bins: list[int] = []
    for n, s, c, x in zip(lengths, sources, clusters, copies, strict=True):
        s_bit = 1 << s if s >= 0 else 0
        c_bit = (1 << c if c >= 0 else 0) | (1 << (above + x) if x >= 0 else 0)
        at = bisect_left(order, (n, -1))
        while at < len(order) and (full[order[at][1]] & s_bit or inside[order[at][1]] & c_bit):
            at += 1
        if at < len(order):
            left, b = order.pop(at)
        else:
            left, b = capacity, len(full)
            full.append(0)
            inside.append(0)
            count.append({})
        inside[b] |= c_bit
        if s >= 0:
            count[b][s] = count[b].get(s, 0) + 1
            if count[b][s] >= per_source:
                full[b] |= s_bit
        if left > n:
            insort(order, (left - n, b))
        bins.append(b)
    return bins


def _ranks(values: list) -> list[int]:
    """Small numbers for the values that occur twice or more, -1 for the rest and for null: only those can conflict."""
    counts: dict = {}
    for v in values:
        counts[v] = counts.get(v, 0) + 1
    ranks = {v: i for i, v in enumerate(v for v, n in counts.items() if n > 1 and v is not None)}
    return [ranks.get(v, -1) for v in values]


def _pack(capacity: int, per_source: int):
    def run(key, table):
        shard = key[0].as_py()
        rows = sorted(table.select(["doc_id", "n", "source", "cluster", "copy"]).to_pylist(), key=lambda r: (-(r["n"] % capacity), r["doc_id"] is None, r["doc_id"] or 0, r["n"], r["cluster"] or 0, r["copy"] or 0))
        rests = [r for r in rows if r["n"] % capacity]
        bins = best_fit([r["n"] % capacity for r in rests], _ranks([r["source"] for r in rests]), _ranks([r["cluster"] for r in rests]), capacity, per_source, _ranks([r["copy"] for r in rests]))
        used: dict[int, int] = {}
        out = []
        for r, b in zip(rests, bins, strict=True):
            whole = r["n"] // capacity
            out.append((r["doc_id"], whole, shard * STRIDE + b, used.get(b, 0), whole * capacity, r["n"] % capacity, r["source"], r["cluster"]))
            used[b] = used.get(b, 0) + 1
        b = len(used)
        for r in rows:
            for k in range(r["n"] // capacity):
                out.append((r["doc_id"], k, shard * STRIDE + b, 0, k * capacity, capacity, r["source"], r["cluster"]))
                b += 1
        return pa.table([pa.array([x[i] for x in out], f.type) for i, f in enumerate(SCHEMA)], schema=SCHEMA)

    return run


def measure(text: bytes) -> tuple[int, int | None]:
    """Words of a text and an end token, and a hash of its words without regard to case, none for a text without words; equal texts but for case and white space have the same."""
    words = text.split()
    if not words:
        return 1, None
    joined = b" ".join(words)
    folded = joined.lower() if joined.isascii() else joined.decode("utf-8", "replace").lower().encode()
    return len(words) + 1, int.from_bytes(xxhash.xxh3_64_digest(folded), "big", signed=True)


def _measured():
    """Rows (doc_id, name, source, copy, n) of rows (doc_id, name, source, text)."""

    def run(items):
        for b in batches(items):
            n, copy = zip(*map(measure, as_bytes(b.column(3))), strict=True)
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(3)], pa.array(copy, pa.int64()), pa.array(n, pa.int64())], names=["doc_id", "name", "source", "copy", "n"])

    return run


def pack(rows: DataFrame, capacity: int = 2048, per_source: int = 4, shard_rows: int = 2048) -> DataFrame:
    """Pieces with their bins for ``rows`` (doc_id, source, cluster, copy, n): columns of ``PIECE``."""
    shards = max(1, -(-rows.count() // shard_rows))
    # rows without an id, and those that repeat one, are told apart by their place in the table, so that they make no shard large
    again = rows.groupBy(F.col("doc_id").alias("_id")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1 AND _id IS NOT NULL").select("_id")
    marked = rows.join(again, F.col("doc_id") == F.col("_id"), "left")
    place = F.when(F.col("doc_id").isNull() | F.col("_id").isNotNull(), F.monotonically_increasing_id()).otherwise(0)
    shard = F.pmod(F.xxhash64("doc_id", "n", place), F.lit(shards)).cast("long")
    return marked.withColumn("shard", shard).drop("_id").groupBy("shard").applyInArrow(_pack(capacity, per_source), PIECE)


def pack_documents(docs: DataFrame, capacity: int = 2048, per_source: int = 4, shard_rows: int = 2048) -> DataFrame:
    """``pack`` for documents: whole texts counted in words, clusters by SimHash (null for documents without near duplicates), copies by text."""
    text = F.col("text")
    # a document without an id takes part in clusters under a name made of its text, below all ids one meets
    name = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(text).bitwiseOR(F.lit(-(1 << 63))))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), name.alias("name"), F.col("source").cast("string").alias("source"), text.cast("string").alias("text"))
    rows = rows.mapInArrow(_measured(), "doc_id long, name long, source string, copy long, n long")
    marks = near_duplicates(docs.select(name.alias("doc_id"), "text").filter(text.cast("string").rlike(r"\S"))).groupBy("d").agg(F.min("component_id").alias("component"))
    shared = marks.filter("component <> d")
    shared = shared.unionByName(shared.select(F.col("component").alias("d"), "component")).groupBy("d").agg(F.min("component").alias("component"))
    near = rows.join(shared, F.col("name") == F.col("d"), "left")
    near = near.select("doc_id", "source", F.when(F.col("copy").isNotNull(), F.col("component")).alias("cluster"), "copy", "n")
    return pack(materialise(near, "lengths"), capacity, per_source, shard_rows)


def op7_packing(spark, sf_dir: str) -> DataFrame:
    """Whole ``documents``: doc_id, piece, bin_id, slot, start_token, n_tokens, source, cluster."""
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def efficiency(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """One row: bins, tokens and the share of the bins' room that is filled."""
    return pieces.agg(F.count_distinct("bin_id").alias("bins"), F.sum("n_tokens").alias("tokens")).withColumn("filled", F.col("tokens") / (F.col("bins") * np.int64(capacity).item()))
