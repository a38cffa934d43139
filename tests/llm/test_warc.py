import base64
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from heatledger.llm import warc

SCHEMA = "page_id long, url string, html string"


def want(rows):
    best = {}
    for p, _, h in rows:
        if p is not None:
            best[h or ""] = max(p, best.get(h or "", p))
    out = []
    for p, _, h in rows:
        body = (h or "").encode()
        first = best.get(h or "")
        again = first is not None and first != p
        out.append((p, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


def got(df):
    cols = df.select(warc.page_of("record_id").alias("p"), "payload_bytes", "payload_digest", "record_type", warc.page_of("refers_to").alias("r"))
    return sorted((tuple(r) for r in cols.collect()), key=repr)


def pages():
    rng = random.Random(2)
    rows = [(i, f"http://a.example/{i}\r\nX: é", "".join(rng.choice("abcdé<> ") for _ in range(rng.randint(0, 4000)))) for i in range(60)]
    rows += [(100 + i, None, "the same page") for i in range(20)] + [(200, "u", ""), (201, "u", None), (200, "u", ""), (None, "u", "the same page"), (None, None, "only here"), (None, None, None)]
    return rows


@pytest.mark.parametrize("split", [997, 1 << 20])
def test_round_trip_over_splits(spark, split):
    rows = pages()
    archives = warc.write_archives(spark.createDataFrame(rows, SCHEMA).withColumn("kind", F.lit(1)).repartition(3), roll_bytes=20000)
    back = warc.read_archives(archives, split)
    assert got(back) == want(rows)
    assert back.filter("NOT digest_ok").isEmpty()
    texts = {h for p, _, h in rows if p is not None and p < 60}
    assert {bytes(r.payload).decode() for r in back.filter("record_type = 'response'").collect()} >= texts


def test_false_magic_nested_archive_and_damage(spark, tmp_path):
    inner = warc.record("response", 900, None, b"inner", None)
    noise = bytes(random.Random(1).randrange(256) for _ in range(3000))
    members = [warc.record("response", i, None, b"x" * i + warc.MAGIC + inner + noise, None, level=0) for i in range(12)]
    broken = bytearray(members[5])
    broken[-6] ^= 255
    blob = b"".join([*members[:5], bytes(broken), *members[6:]])
    path = tmp_path / "a.warc.gz"
    path.write_bytes(blob)
    for split in (50, 501, 100000):
        found = [r for s in range(0, len(blob), split) for r in warc.range_records(str(path), s, min(s + split, len(blob)))]
        assert sorted(int(r[3].rpartition(":")[2]) for r in found) == [0, 1, 2, 3, 4, 6, 7, 8, 9, 10, 11]


def test_empty_table(spark):
    archives = warc.write_archives(spark.createDataFrame([], SCHEMA))
    assert warc.read_archives(archives).collect() == []


def test_member_is_plain_gzip():
    assert zlib.decompress(warc.record("response", 1, "u", b"p", None), 31).endswith(b"p\r\n\r\n")


def test_tasks_are_bounded(spark):
    archives = warc.write_archives(spark.createDataFrame(pages(), SCHEMA).repartition(3), roll_bytes=20000)
    many, few = (warc.read_archives(archives, 100, True, most) for most in (20_000, 3))
    assert few.rdd.getNumPartitions() <= 3 < many.rdd.getNumPartitions()
    key = lambda df: sorted((r.path, r.offset, r.record_id, r.payload_digest, r.digest_ok) for r in df.collect())
    assert key(few) == key(many)


def test_html_is_not_shuffled_for_a_few_revisits(spark):
    rows = [(i, f"http://a/{i}", "same text" if i in (3, 5, 9) else f"text {i}") for i in range(300)] + [(None, "http://n", "same text"), (9, "http://again", "same text")]
    pages_df = spark.createDataFrame(rows, SCHEMA)
    written = []
    real = warc.materialise
    warc.materialise = lambda df, name: written.append((name, df)) or real(df, name)
    try:
        archives = warc.write_archives(pages_df)
    finally:
        warc.materialise = real
    plan = dict(written)["warc-report"]._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    found = {}
    for r in warc.read_archives(archives).collect():
        found.setdefault(r.record_id, []).append((r.record_type, r.refers_to))
    assert found["urn:x-page:3"] == found["urn:x-page:5"] == [("revisit", "urn:x-page:9")]
    assert found["urn:x-page:9"] == [("response", None)] * 2
    assert sum(r == [("revisit", "urn:x-page:9")] for r in found.values()) == 3 and sum(len(r) for r in found.values()) == len(rows)


def test_a_payload_of_200_mb(spark):
    big = spark.range(1).selectExpr("id AS page_id", "'http://big' AS url", "repeat('0123456789abcdef', 12500000) AS html")
    archives = warc.write_archives(big)
    out = warc.read_archives(archives, keep_payload=False).collect()
    assert [(r.payload_bytes, r.digest_ok) for r in out] == [(200_000_000, True)]
