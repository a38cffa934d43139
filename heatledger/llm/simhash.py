"""SimHash near-dedup through a segment-popcount embedding.

A fingerprint of 64 bits maps to the bit counts of its 32 two-bit segments. The Manhattan distance of
two such vectors never exceeds the Hamming distance of the fingerprints, so fingerprints that link lie
within ``distance`` of each other in that space. The space is cut into ``blocks`` groups of segments;
where at most ``distance`` of them can differ, at least ``blocks - distance`` agree exactly, so a grid
cell is a choice of that many groups with their counts, and every linked pair meets in a cell. Within a
cell the Manhattan bound comes first and the exact Hamming distance decides.

A cell yields links along a search tree, at most one fewer than it has members, never all its pairs. Cells with more
than ``chunk`` members are dealt over pairs of chunks. Only distinct fingerprints enter the grid, and
components come from alternating star contractions in Spark, written to the shared folder each round.

All joins here shuffle both sides: their tables have a row for each fingerprint or link, and a table below Spark's broadcast limit
would pass whole through the driver, where those of all rounds stay until its heap is collected.

Defined results: null text is empty, with fingerprint zero; null ids get the component of their
fingerprint and never name one (null if no other id is there); rows that repeat an id repeat its result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatledger.llm.common import as_bytes, batches, discard, materialise

#: Seed of the shingle hash.
SEED = 42
#: Low bit of each two-bit segment, as a signed long.
LOW = 0x5555555555555555


def fingerprint(text: bytes, width: int = 4) -> int:
    """Unsigned SimHash of the text's word shingles."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < width:
        return xxhash.xxh64_intdigest(joined, SEED)  # one shingle: each bit is set in all or none
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = np.concatenate(([0], gaps + 1))[: len(words) - width + 1].tolist()
    ends = np.concatenate((gaps, [len(joined)]))[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for k in range(0, len(starts), 1 << 16):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[k : k + (1 << 16)], ends[k : k + (1 << 16)], strict=True)], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view(np.uint64)[0])


def _fingerprints(width: int):
    schema = pa.schema([("d", pa.int64()), ("fp", pa.int64())])

    def run(items):
        for b in batches(items):
            fps = np.array([fingerprint(t, width) for t in as_bytes(b.column(1))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], schema=schema)

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """Rows (d, fp) of every document; fp is the fingerprint as a signed long."""
    rows = docs.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_fingerprints(width), "d long, fp long")


def thermometer(fp):
    """Segment counts 0, 1, 2 written as 00, 01, 11, so that Manhattan distance is a bit count of an xor."""
    high = F.shiftrightunsigned(fp, 1)
    low = F.lit(LOW).cast("long")
    return fp.bitwiseOR(high).bitwiseAND(low).bitwiseOR(F.shiftleft(fp.bitwiseAND(high).bitwiseAND(low), 1))


def masks(blocks: int, distance: int) -> list[int]:
    """Signed bit masks of each choice of blocks that may agree."""
    cuts = [round(i * 32 / blocks) for i in range(blocks + 1)]
    one = [sum(3 << (2 * s) for s in range(cuts[i], cuts[i + 1])) for i in range(blocks)]
    sums = [sum(x) for x in combinations(one, blocks - distance)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in sums]


def thermo(fps: np.ndarray) -> np.ndarray:
    """``thermometer`` for an array of unsigned fingerprints."""
    low, one = np.uint64(LOW), np.uint64(1)
    return ((fps | (fps >> one)) & low) | ((fps & (fps >> one) & low) << one)


def cell_links(fps: np.ndarray, distance: int) -> tuple[list[int], list[int]]:
    """Links that join all fingerprints of a cell that are reachable within it, one for each newly reached."""
    left, grid = fps, thermo(fps)
    us: list[int] = []
    vs: list[int] = []
    while len(left):
        queue = [(left[0], grid[0])]
        left, grid = left[1:], grid[1:]
        while queue and len(left):
            f, t = queue.pop()
            near = np.flatnonzero(np.bitwise_count(grid ^ t) <= distance)
            near = near[np.bitwise_count(left[near] ^ f) <= distance]
            if len(near):
                us += [int(f)] * len(near)
                vs += left[near].tolist()
                queue += list(zip(left[near], grid[near], strict=True))
                rest = np.ones(len(left), bool)
                rest[near] = False
                left, grid = left[rest], grid[rest]
    return us, vs


def _links(distance: int):
    """Rows (u, v) from rows (cell, part, fp) that are grouped and sorted by cell and part."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def done(fps: np.ndarray):
        us, vs = cell_links(np.unique(fps), distance)
        u, v = np.array(us, np.uint64).view(np.int64), np.array(vs, np.uint64).view(np.int64)
        return np.minimum(u, v), np.maximum(u, v)

    def run(items):
        held: list[np.ndarray] = []
        key = None
        for b in batches(items):
            cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            fps = cols[3].view(np.uint64)
            keys = np.stack([np.asarray(c, np.int64) for c in cols[:3]], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            out: list = []
            for a, z in zip(np.concatenate(([0], cuts)), np.concatenate((cuts, [len(fps)])), strict=True):
                if key is not None and tuple(keys[a]) != key:
                    out.append(done(np.concatenate(held)))
                    held = []
                key = tuple(keys[a])
                held.append(fps[a:z])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[i] for x in out])) for i in (0, 1)], schema=schema)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in done(np.concatenate(held))], schema=schema)

    return run


def links(fps: DataFrame, distance: int = 4, blocks: int = 8, chunk: int = 4096) -> DataFrame:
    """Rows (u, v), u < v: links that connect the distinct fingerprints ``fps`` (column fp) as all links would."""
    # fingerprints are a few bytes each, so their files are few; their copies need all tasks
    fps = fps.repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    t = thermometer(F.col("fp"))
    cells = fps.select("fp", F.posexplode(F.array(*[t.bitwiseAND(F.lit(m).cast("long")) for m in masks(blocks, distance)])).alias("grid", "cell"))
    sizes = cells.groupBy("grid", "cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = cells.join(sizes.hint("merge"), ["grid", "cell"])
    parts = F.ceil(F.col("n") / chunk).cast("int")
    own = F.pmod(F.xxhash64("fp"), parts).cast("int")
    dealt = met.withColumn("k", parts).withColumn("own", own).select(
        "grid", "cell", "fp", F.explode(F.transform(F.sequence(F.lit(0), F.col("k") - 1), lambda j: F.least(j, F.col("own")) * F.col("k") + F.greatest(j, F.col("own")))).alias("part")
    )
    ordered = dealt.select("grid", "cell", "part", "fp").repartition("grid", "cell", "part").sortWithinPartitions("grid", "cell", "part")
    return ordered.mapInArrow(_links(distance), "u long, v long").distinct()


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """Rows (node, root): root is the smallest node that can be reached; only nodes that have a link.

    Large-star and small-star steps alternate until nothing changes; each round is written to the shared
    folder. The number of rounds grows with the logarithm of the nodes.
    """
    edges = materialise(edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).filter("u < v").distinct(), "links")
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nearest = materialise(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "large-star")
        large = both.filter("v > u").join(nearest.hint("merge"), "u").select(F.col("m").alias("u"), "v").filter("u < v").distinct()
        large = materialise(large, "links")
        lowest = large.groupBy(F.col("v").alias("w")).agg(F.min("u").alias("m"))
        lowest = materialise(lowest, "small-star")
        small = large.join(lowest.hint("merge"), large["v"] == lowest["w"]).select("m", F.explode(F.array("u", "v")).alias("x")).filter("m < x")
        small = materialise(small.select(F.col("m").alias("u"), F.col("x").alias("v")).distinct(), "links")
        same = small.join(edges.hint("merge"), ["u", "v"], "left_anti").isEmpty() and edges.join(small.hint("merge"), ["u", "v"], "left_anti").isEmpty()
        discard(edges, nearest, large, lowest)
        edges = small
        if same:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = materialise(edges.groupBy(F.col("v").alias("node")).agg(F.min("u").alias("root")), "components")
    discard(edges)
    return roots


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, distance: int = 4, blocks: int = 8, chunk: int = 4096) -> DataFrame:
    """Rows (d, fp, component_id), one for each row of ``docs``."""
    marks = materialise(fingerprints(docs, id_col, text_col, width), "fingerprints")
    firsts = materialise(marks.groupBy("fp").agg(F.min("d").alias("first")), "distinct-fingerprints")
    roots = components(links(firsts.select("fp"), distance, blocks, chunk))
    both = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct()).distinct()
    linked = firsts.join(both.hint("merge"), firsts["fp"] == both["node"], "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    named = materialise(linked.select("fp", "root").join(lowest.hint("merge"), "root").select("fp", "component_id"), "fingerprint-components")
    discard(firsts, roots)
    return marks.join(named.hint("merge"), "fp").select("d", "fp", "component_id")


def op10_simhash(spark, sf_dir: str) -> DataFrame:
    """Whole ``documents``: doc_id, fingerprint, component_id."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs).select(F.col("d").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
