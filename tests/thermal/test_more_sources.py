"""Vents from JSON, foreign PNG tiles, complete days, log lines."""

import json
import struct
import zlib

from pyspark.sql import functions as F

from heatledger.operators import archive, raster, readmodel, screens
from heatledger.sources import logs, vents


def test_a_malformed_vent_is_left_out(spark, tmp_path):
    good = {"slug": "a", "name": "A", "lat": 13.6, "lon": "40.67", "notes": "n"}
    entries = [good, {**good, "slug": "b", "radius_km": 10}, {"name": "no slug", "lat": 1, "lon": 1}, {**good, "lat": None}, {**good, "lat": "north"}, {**good, "radius_km": "wide"}, 7]
    path = tmp_path / "vents.json"
    path.write_text(json.dumps(entries))
    rows = sorted((r.slug, r.country, r.vent_lat, r.vent_lon, r.radius_km, r.source_name, r.notes) for r in vents.read(spark, str(path)).collect())
    assert rows == [("a", "", 13.6, 40.67, 7.0, "", "n"), ("b", "", 13.6, 40.67, 10.0, "", "n")]


def test_nearest_vent_keeps_every_pixel_once(spark):
    pixels = spark.createDataFrame([(1, 13.60, 40.67), (1, 13.60, 40.67), (2, 13.61, 40.68), (3, 50.0, 40.0)], "pixel int, lat double, lon double")
    pixels = pixels.select("*", F.floor("lat").cast("int").alias("tile_lat"), F.floor("lon").cast("int").alias("tile_lon"))
    listed = spark.createDataFrame([("near", 13.60, 40.67, 7.0), ("wide", 13.70, 40.67, 40.0), ("wide2", 13.70, 40.67, 40.0)], "vent string, vent_lat double, vent_lon double, radius_km double")
    got = sorted((r.pixel, r.near.vent if r.near else None) for r in screens.with_nearest_vent(pixels, listed).collect())
    assert got == [(1, "near"), (1, "near"), (2, "near"), (3, None)]
    assert all(r.near is None for r in screens.with_nearest_vent(pixels, listed.filter("false")).collect())


def image(rows, depth, width):
    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    head = struct.pack(">IIBBBBB", width, len(rows), depth, 3, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(b"".join(rows))) + chunk(b"IEND", b"")


def test_foreign_tiles_with_filters_and_depths():
    plain = [[0, 1, 2, 3], [4, 5, 0, 1], [2, 2, 5, 5], [1, 0, 3, 4], [5, 4, 4, 1]]
    rows, above = [], [0] * 4
    for kind, row in enumerate(plain):  # each row by another filter
        def paeth(a, b, c):
            p = a + b - c
            return min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]

        left = lambda i, row=row: row[i - 1] if i else 0
        corner = lambda i, above=above: above[i - 1] if i else 0
        guess = [(0, left(i), above[i], (left(i) + above[i]) // 2, paeth(left(i), above[i], corner(i)))[kind] for i in range(4)]
        rows.append(bytes([kind, *[(x - g) & 255 for x, g in zip(row, guess, strict=True)]]))
        above = row
    want = [(x, y, v) for y, row in enumerate(plain) for x, v in enumerate(row) if v]
    assert raster.png_ranks(image(rows, 8, 4)) == want
    assert raster.png_ranks(image([bytes([0, 0x01, 0x23]), bytes([0, 0x45, 0x01])], 4, 4)) == [(1, 0, 1), (2, 0, 2), (3, 0, 3), (0, 1, 4), (1, 1, 5), (3, 1, 1)]
    assert raster.png_ranks(raster.png([(3, 7, 5), (255, 255, 1)])) == [(3, 7, 5), (255, 255, 1)]


def test_days_wait_for_both_satellites(spark):
    rows = spark.createDataFrame([("1", "a", 1.0), ("1", "b", 2.0), ("2", "a", 3.0), ("2", "a", 4.0), ("3", "c", 5.0)], "d string, product string, max_c double")
    assert sorted(r.max_c for r in readmodel.complete_days(rows, ["a", "b"]).collect()) == [1.0, 2.0]


def test_log_lines(spark):
    codes = spark.createDataFrame([("2020-01-02", "b", 0), ("2020-01-02", "a", 3)], "d string, product string, code int").withColumn("d", F.to_date("d"))
    line = logs.lines(codes).first().line
    assert line == "2020-01-02 a=3 b=0"


def test_batches_in_any_order_make_one_archive(spark):
    rows = [("2020-01-02", "b", 50.0), ("2020-01-01", "a", 50.0), ("2020-01-01", "b", 50.0), ("2020-01-03", "a", 49.0)]
    frame = spark.createDataFrame([(d, p, 1, 1, c, 1.5, 1.5) for d, p, c in rows], "d string, product string, tile_lat int, tile_lon int, max_c double, max_lat double, max_lon double").withColumn("d", F.to_date("d"))
    whole = archive.records(frame).collect()
    for order in (["2020-01-01", "2020-01-02", "2020-01-03"], ["2020-01-03", "2020-01-02", "2020-01-01"]):
        kept = archive.records(frame.filter("false"))
        for d in order:
            kept = archive.merge(kept, frame.filter(F.col("d") == d))
        assert kept.select(*archive.records(frame).columns).collect() == whole
