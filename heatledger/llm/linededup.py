"""Line dedup with levelled sorted runs of line hashes.

Documents are dealt into batches of ascending id, at least ``n_batches`` and more where a batch would pass ``batch_lines`` hashes. Every
batch brings its line hashes, each with its smallest document; they are merge-anti-joined against the runs of earlier batches, and what is
new becomes a run of its own. Runs are tables bucketed by both halves of the hash, one sorted file a bucket, in the shared folder: a join reads them as they
lie, without a shuffle or a sort, and only the new batch is shuffled. When a level holds ``fanout`` runs they are compacted into one run of the
next level. A line stays where the run of its own batch names its document as the owner.

The text itself is read twice, once for the hashes and once to rebuild it; only 128-bit hashes and
ids go through the runs. No step joins on the line hash alone against rows that repeat it, so a line
held by a third of all documents is no heavier than any other.

Defined results: null text counts as one empty line; null ids keep every line and own none; rows that
repeat an id are one document and all keep what that document keeps; an empty table gives an empty
result; columns of the input named like the result's are replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatledger.llm.common import as_bytes, batches, discard, dropping_shuffles, fresh_path, materialise, remove, without

#: Whether the order of a bucket of one file counts.
BUCKET_ORDER = "spark.sql.legacy.bucketedTableScan.outputOrdering"
#: White space stripped at both ends of a line.
BLANKS = b" \t\n\x0b\x0c\r"


def line_key(line: bytes) -> bytes:
    """The line without white space at its ends and with A-Z lower-cased."""
    return line.strip(BLANKS).lower()


def long_enough(key: bytes, least: int) -> bool:
    """Whether the key has at least ``least`` code points."""
    if len(key) < least or len(key) >= 4 * least:
        return len(key) >= least
    return len(key) - sum(0x80 <= b < 0xC0 for b in key) >= least


def key_hash(key: bytes) -> tuple[int, int]:
    """128 bits of the key as two signed longs."""
    h = xxhash.xxh3_128_digest(key)
    return int.from_bytes(h[:8], "big", signed=True), int.from_bytes(h[8:], "big", signed=True)


def _hashes(min_chars: int):
    """Rows (d, h1, h2): the distinct long keys of every document."""
    schema = pa.schema([("d", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64())])

    def run(items):
        for b in batches(items):
            out: list[list] = [[], [], []]
            for d, text in zip(b.column(0).to_pylist(), as_bytes(b.column(1)), strict=True):
                if d is None:
                    continue
                keys = {k for x in text.split(b"\n") if long_enough(k := line_key(x), min_chars)}
                hs = [key_hash(k) for k in keys]
                out[0] += [d] * len(hs)
                out[1] += [h[0] for h in hs]
                out[2] += [h[1] for h in hs]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(out, schema, strict=True)], schema=schema)

    return run


def _rebuild(min_chars: int):
    """Rows (text, n_lines, n_dropped, kept columns as they are) without the lines whose hashes are listed."""

    def run(items):
        for b in batches(items):
            texts, n_lines, n_dropped = [], [], []
            for text, gone in zip(as_bytes(b.column("_ld_text")), b.column("_ld_gone").to_pylist(), strict=True):
                lines = text.split(b"\n")
                if gone:
                    drop = {(g["h1"], g["h2"]) for g in gone}
                    kept = [x for x in lines if not (long_enough(k := line_key(x), min_chars) and key_hash(k) in drop)]
                else:
                    kept = lines
                texts.append(text if len(kept) == len(lines) else b"\n".join(kept))
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(kept))
            rest = [i for i, n in enumerate(b.schema.names) if n not in ("_ld_text", "_ld_gone")]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(i) for i in rest], pa.array(texts, pa.binary()).cast(pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                names=[*[b.schema.names[i] for i in rest], "_ld_text", "n_lines", "n_dropped"],
            )

    return run


@contextmanager
def sorted_buckets(spark) -> Iterator[None]:
    """Queries planned within take a bucket of one sorted file to be sorted, which Spark does on demand only."""
    before = spark.conf.get(BUCKET_ORDER)
    spark.conf.set(BUCKET_ORDER, "true")
    try:
        yield
    finally:
        spark.conf.set(BUCKET_ORDER, before)


class Runs:
    """Levelled runs of (h1, h2, owner): bucketed, sorted tables in the shared folder."""

    def __init__(self, spark, fanout: int):
        self.spark, self.fanout, self.levels = spark, fanout, [[]]
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.paths: dict[str, str] = {}

    def _write(self, df: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        self.paths[name] = fresh_path(self.spark, "line-run")
        with dropping_shuffles(self.spark), sorted_buckets(self.spark):
            # a task writes one bucket, so a bucket is one file
            dealt = df.repartition(self.buckets, "h1", "h2")
            dealt.write.format("parquet").option("path", self.paths[name]).bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").saveAsTable(name)
        return name

    def unseen(self, df: DataFrame) -> DataFrame:
        """Rows of ``df`` whose hash no run has."""
        for name in (n for level in self.levels for n in level):
            df = df.join(self.spark.table(name).select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")
        return df

    def add(self, df: DataFrame) -> DataFrame:
        """``df`` as a run of level 0; the run as a frame."""
        name = self._write(df)
        self.levels[0].append(name)
        return self.spark.table(name)

    def compact(self) -> None:
        """Merge the runs of each full level into one of the next."""
        for k in range(len(self.levels)):
            if len(self.levels[k]) < self.fanout:
                continue
            merged = None
            for name in self.levels[k]:
                merged = self.spark.table(name) if merged is None else merged.unionByName(self.spark.table(name))
            new = self._write(merged)
            for name in self.levels[k]:
                self._drop(name)
            self.levels[k] = []
            if k + 1 == len(self.levels):
                self.levels.append([])
            self.levels[k + 1].append(new)

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE {name}")
        remove(self.spark, self.paths[name])

    def drop(self) -> None:
        for name in (n for level in self.levels for n in level):
            self._drop(name)


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, n_batches: int = 4, fanout: int = 2, batch_lines: int = 1 << 34) -> DataFrame:
    """Rows (d, gone): for each document that loses lines, the hashes of their keys."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).cast("string").alias("text"))
    hashes = materialise(rows.mapInArrow(_hashes(min_chars), "d long, h1 long, h2 long"), "line-hashes")
    n_batches = max(n_batches, -(-hashes.count() // batch_lines))
    cuts = [i / n_batches for i in range(1, n_batches)]
    splits = sorted(set(hashes.select("d").approxQuantile("d", cuts, 0.1 / n_batches))) if cuts else []
    runs, parts = Runs(spark, fanout), []
    try:
        for low, high in zip([None, *splits], [*splits, None], strict=True):
            inside = F.lit(True) if low is None else F.col("d") > low
            own = hashes.filter(inside if high is None else inside & (F.col("d") <= high))
            best = own.groupBy("h1", "h2").agg(F.min("d").alias("owner"))
            fresh = runs.add(runs.unseen(best))
            lost = own.join(fresh.withColumnRenamed("owner", "d"), ["h1", "h2", "d"], "left_anti")
            parts.append(materialise(lost, "lines-lost"))
            runs.compact()
    finally:
        runs.drop()
        discard(hashes)
    gone = parts[0]
    for part in parts[1:]:
        gone = gone.unionByName(part)
    lists = materialise(gone.groupBy("d").agg(F.collect_set(F.struct("h1", "h2")).alias("gone")), "lines-gone")
    discard(*parts)
    return lists


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, n_batches: int = 4, fanout: int = 2, batch_lines: int = 1 << 34) -> DataFrame:
    """``docs`` with repeated lines gone from the text, and columns n_lines (before) and n_dropped.

    A line's key is the line stripped and with A-Z lower-cased; a key of ``min_chars`` code points or
    more that at least two documents hold stays only in the document with the smallest id.
    """
    lists = repeated_lines(docs, id_col, text_col, min_chars, n_batches, fanout, batch_lines).select(F.col("d").alias("_ld_id"), F.col("gone").alias("_ld_gone"))
    rest = without(docs, "n_lines", "n_dropped")
    names = rest.columns
    shaped = rest.select(*[F.col(f"`{c}`").alias(f"_ld_c{i}") for i, c in enumerate(names) if c != text_col], F.col(text_col).cast("string").alias("_ld_text"), F.col(id_col).cast("long").alias("_ld_d"))
    joined = shaped.join(lists, F.col("_ld_d") == F.col("_ld_id"), "left").drop("_ld_id", "_ld_d")
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in joined.schema if f.name not in ("_ld_text", "_ld_gone")] + ["_ld_text string, n_lines long, n_dropped long"])
    out = joined.mapInArrow(_rebuild(min_chars), schema)
    return out.select(*[F.col("_ld_text").alias(c) if c == text_col else F.col(f"_ld_c{i}").alias(c) for i, c in enumerate(names)], "n_lines", "n_dropped")


def op9_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Whole ``documents``: doc_id, n_lines, n_dropped, kept_sha256."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


#: The same rows in DuckDB.
ORACLE = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
g AS (SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
m AS (SELECT k.doc_id, k.pos, k.line, g.key IS NOT NULL AND g.owner <> k.doc_id AS gone FROM k LEFT JOIN g ON k.key = g.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
