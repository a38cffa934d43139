"""WARC archives: a writer with payload revisits and a splittable reader.

Every record is a gzip member of its own. The reader cuts each archive into byte ranges; a task looks
for gzip magic inside its range, takes a candidate for a member only if it inflates to a WARC header and
its checksum holds, and owns the records that start in the range, reading past the end for the last of
them. A candidate found by search, not by following the member before it, must also be followed by
another member or the end of the file, so that archives stored inside a record are not taken for records.

Writer tasks put their files under names that no other attempt uses and report them; only files that
the written report lists are read, so a retried or lost task leaves no trace. Paths go through
``pyarrow.fs`` (local paths, file, hdfs, s3, gs).

Defined results: null html is an empty payload; a null url leaves out the target; a null page_id is
written as ``none`` and read back as null, and is a response unless a record with an id has its payload;
rows that repeat the largest page_id of a payload are all responses; an empty table gives no archives.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heatledger.llm.common import batches, fresh_path, materialise

MAGIC = b"\x1f\x8b\x08"
#: Bytes that are inflated at once.
STEP = 1 << 16
REPORT = pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())])
RECORD = pa.schema(
    [
        ("path", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()),
        ("refers_to", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("digest_ok", pa.bool_()), ("payload", pa.binary()),
    ]
)


def base32_sha1(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, level: int = 1) -> bytes:
    """One WARC record as a gzip member; a revisit keeps the HTTP header and leaves out the payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    body = http if kind == "revisit" else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:x-page:{'none' if page_id is None else page_id}>", "WARC-Date: 2024-01-01T00:00:00Z"]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe="".join(map(chr, range(33, 127)))))
    if kind == "revisit":
        lines += [f"WARC-Refers-To: <urn:x-page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += [f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + pack.flush()


def store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI."""
    return pafs.FileSystem.from_uri(re.sub("^s3a?n?:", "s3:", uri))


def _write(root: str, roll_bytes: int, level: int):
    def run(items):
        out, name, size, count = None, "", 0, 0
        report: list[tuple] = []
        for b in batches(items):
            column = {name: b.column(i) for i, name in enumerate(b.schema.names)}
            for i in range(b.num_rows):  # a page at a time, as a batch of long ones is large enough as it is
                row = {name: c[i].as_py() for name, c in column.items()}
                if out is None:
                    fs, base = store(root)
                    fs.create_dir(base, recursive=True)
                    file = f"pages-{uuid.uuid4().hex}.warc.gz"
                    out, name, size, count = fs.open_output_stream(f"{base}/{file}", compression=None), f"{root}/{file}", 0, 0
                member = record(row["kind"], row["page_id"], row["url"], (row["html"] or "").encode(), row["refers_to"], level)
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= roll_bytes:
                    out.close()
                    report.append((name, size, count))
                    out = None
        if out is not None:
            out.close()
            report.append((name, size, count))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in report], f.type) for i, f in enumerate(REPORT)], schema=REPORT)

    return run


def write_archives(pages: DataFrame, roll_bytes: int = 1 << 30, level: int = 1) -> DataFrame:
    """Write a record for each row of ``pages`` (page_id, url, html); rows (path, bytes, records) of the archives.

    Equal payloads share one response, that with the largest page_id; the others revisit it. Digests are grouped with partial
    sums and joined with ids, without html; what comes of it, a row for each page that revisits, meets the pages by id and digest, so a
    payload shared by many pages is no hot key. Where few pages revisit, Spark sends these rows to all tasks and the html is not shuffled at all.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    digest = F.unhex(F.sha1(F.coalesce(F.col("html"), F.lit("")).cast("binary")))
    digests = materialise(rows.select("page_id", digest.alias("digest")), "warc-digests")
    shared = digests.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("first")).filter("n > 1 AND first IS NOT NULL").select("digest", "first")
    again = digests.join(shared, "digest").filter(~F.col("first").eqNullSafe(F.col("page_id"))).distinct()
    again = materialise(again.select(F.col("page_id").alias("again_id"), F.col("digest").alias("again_digest"), "first"), "warc-revisits")
    joined = rows.withColumn("digest", digest).join(again, F.col("page_id").eqNullSafe(F.col("again_id")) & (F.col("digest") == F.col("again_digest")), "left")
    records = joined.select("page_id", "url", "html", F.when(F.col("first").isNotNull(), "revisit").otherwise("response").alias("kind"), F.col("first").alias("refers_to"))
    root = fresh_path(spark, "warc")
    return materialise(records.mapInArrow(_write(root, roll_bytes, level), "path string, bytes long, records long"), "warc-report")


def member(data: memoryview, at: int, more) -> tuple[bytes, int] | None:
    """Inflated bytes of the member at ``at`` and where it ends, None if there is no WARC record.

    ``more(n)`` gives ``data`` with at least ``n`` bytes, or all there are.
    """
    inflate = zlib.decompressobj(31)
    parts: list[bytes] = []
    size, step = 0, 512
    try:
        while not inflate.eof:
            if at + size + step > len(data):
                data = more(at + size + step)
            chunk = data[at + size : at + size + step]
            if not chunk:
                return None
            parts.append(inflate.decompress(chunk))
            size += len(chunk)
            if step == 512:
                if not parts[0].startswith(b"WARC/1."):
                    return None
                step = STEP
    except zlib.error:
        return None
    return b"".join(parts), at + size - len(inflate.unused_data)


def fields(head: bytes) -> dict[str, str]:
    """Named fields of a header block, names in lower case."""
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def parse(path: str, offset: int, data: bytes, keep_payload: bool) -> tuple:
    """A row of ``RECORD``."""
    head, _, block = data.partition(b"\r\n\r\n")
    f = fields(head)
    block = block[: int(f.get("content-length", len(block)))]
    kind = f.get("warc-type", "")
    http, _, payload = block.partition(b"\r\n\r\n") if "application/http" in f.get("content-type", "") else (b"", b"", block)
    said = f.get("warc-payload-digest", "").rpartition(":")[2] or None
    if kind == "revisit":
        n, digest, ok, payload = int(fields(http).get("content-length", 0)), said, True, None
    else:
        n, digest = len(payload), base32_sha1(payload)
        ok = said is None or said == digest
    return path, offset, kind, f.get("warc-record-id", "").strip("<>"), f.get("warc-target-uri"), f.get("warc-refers-to", "").strip("<>") or None, n, digest, ok, payload if keep_payload else None


def range_records(path: str, start: int, end: int, keep_payload: bool = True):
    """Rows of the records that start in [start, end) of an archive."""
    fs, name = store(path)
    with fs.open_input_file(name) as f:
        total = f.size()
        held = bytearray()

        def more(n: int) -> memoryview:
            want = min(start + n, total) - start - len(held)
            if want > 0:
                f.seek(start + len(held))
                # a long record beyond the range is read in growing steps, so that copies of what is held add up to a few times its size
                beyond = max(STEP, len(held) - (end - start))
                held.extend(f.read(max(want, min(beyond, total - start - len(held)))))
            return memoryview(bytes(held)) if len(held) < STEP else memoryview(held[:])

        data = more(end - start + len(MAGIC))
        at, chained = 0, False
        while start + at < end:
            if not chained or bytes(data[at : at + 3]) != MAGIC:
                at = data.obj.find(MAGIC, at)
                chained = False
                if at < 0 or start + at >= end:
                    return
            found = member(data, at, more)
            if found and not chained and start + found[1] < total:
                after = more(found[1] + 3)[found[1] : found[1] + 3]
                found = found if bytes(after) == MAGIC else None
            if found is None:
                at, chained = at + 1, False
                continue
            yield parse(path, start + at, found[0], keep_payload)
            at, chained = found[1], True


def _read(keep_payload: bool, rows_per_batch: int = 256):
    def pack(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(RECORD)], schema=RECORD)

    def run(items):
        rows: list[tuple] = []
        for b in batches(items):
            for x in b.to_pylist():
                for r in range_records(x["path"], x["start"], x["end"], keep_payload):
                    rows.append(r)
                    if len(rows) >= rows_per_batch:
                        yield pack(rows)
                        rows = []
        if rows:
            yield pack(rows)

    return run


def read_archives(archives: DataFrame, split_bytes: int = 16 << 20, keep_payload: bool = True, max_tasks: int = 20_000) -> DataFrame:
    """Records of the archives listed as rows (path, bytes), read by ranges of ``split_bytes``: a task each, or runs of ranges where there are more than ``max_tasks``."""
    starts = archives.filter("bytes > 0").select("path", "bytes", F.explode(F.expr(f"sequence(0L, bytes - 1, {split_bytes}L)")).alias("start"))
    ranges = starts.select("path", "start", F.least(F.col("start") + split_bytes, F.col("bytes")).alias("end"))
    dealt = ranges.repartitionByRange(max(1, min(ranges.count(), max_tasks)), "path", "start")
    schema = "path string, offset long, record_type string, record_id string, target_uri string, refers_to string, payload_bytes long, payload_digest string, digest_ok boolean, payload binary"
    return dealt.mapInArrow(_read(keep_payload), schema)


def page_of(column: str):
    """The page id of a record id."""
    return F.expr(f"try_cast(regexp_extract({column}, '^urn:x-page:(-?[0-9]+)$', 1) AS BIGINT)")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``pages`` written and read back: page_id, payload_bytes, payload_digest, record_type, refers_to, target_uri, digest_ok."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    found = read_archives(write_archives(pages), keep_payload=False)
    return found.select(page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page_of("refers_to").alias("refers_to"), "target_uri", "digest_ok")
