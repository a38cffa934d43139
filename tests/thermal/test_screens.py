"""Boundaries and laws of the screens and reductions."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from heatledger import schema as S
from heatledger.functions import exprs as E
from heatledger.operators import archive, corroborate, reduce, screens
from heatledger.plans import bindings

PIXEL = "pixel long, seq int, product string, d date, raw long, qc long, lat double, lon double"
DAY = date(2020, 7, 15)


def raw(c):
    return round((c + 273.15) / 0.02)


def px(spark, *rows):
    """Rows (c, qc, lat, lon)."""
    return spark.createDataFrame([(i, 1, "MOD11_L2", DAY, raw(c) if c is not None else 0, qc, lat, lon) for i, (c, qc, lat, lon) in enumerate(rows)], PIXEL)


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_quality_bits(spark):
    got = {r.qc for r in spark.range(256).select(F.col("id").alias("qc")).filter(E.qc_keep(F.col("qc"))).collect()}
    assert got == {q for q in range(256) if q & 3 <= 1 and q >> 6 & 3 <= 1}


def test_decode_drops_fill_and_out_of_range(spark):
    rows = px(spark, (26.85, 0, 0.0, 0.0), (None, 0, 0.0, 0.0), (-200.0, 0, 0.0, 0.0), (199.99, 0, 0.0, 0.0), (200.01, 0, 0.0, 0.0))
    assert sorted(round(r.c, 2) for r in screens.decode(rows).collect()) == [26.85, 199.99]


def test_geolocation_bounds_are_inclusive_and_nan_fails(spark):
    rows = px(spark, *[(30.0, 0, lat, lon) for lat, lon in ((90.0, 180.0), (-90.0, -180.0), (90.01, 0.0), (-999.0, -999.0), (float("nan"), 0.0), (0.0, float("nan")))])
    assert sorted((r.tile_lat, r.tile_lon) for r in screens.clean(rows).collect()) == [(-90, -180), (89, 179)]


def test_latitude_screen_is_strict_on_both_sides(spark):
    got = one(spark, *[E.plausible(F.lit(lat), F.lit(c)).alias(f"x{i}") for i, (lat, c) in enumerate(((50.0, 70.0), (50.01, 60.0), (50.01, 60.01), (-50.01, 61.0)))])
    assert tuple(got) == (True, True, False, False)


def test_volcano_wins_over_fire_and_radius_is_inclusive(spark):
    vents = spark.createDataFrame([("a", 13.60, 40.67, 7.0), ("b", 13.60, 40.67, 7.0), ("far", 0.0, 179.99, 10.0)], "vent string, vent_lat double, vent_lon double, radius_km double")
    rows = screens.clean(px(spark, (60.0, 0, 13.60, 40.67), (60.0, 0, 13.70, 40.67), (60.0, 0, 0.0, -179.95), (60.0, 0, 13.50, 40.60), (80.0, 0, 20.01, 20.01), (61.0, 0, 60.0, 20.0)))
    bins = screens.fire_bins(spark.createDataFrame([(13.60, 40.67), (20.03, 20.03)], "lat double, lon double"))
    got = {r.pixel: (r.route, r.vent) for r in screens.route(rows, vents, bins).collect()}
    assert got == {0: ("volcanic", "a"), 1: ("weather", None), 2: ("volcanic", "far"), 3: ("weather", None), 4: ("wildfire", None), 5: ("implausible", None)}


def test_vents_of_one_place_are_one_circle_and_cells_are_small(spark):
    listed = [(f"v{i:04d}", 10.05 + i % 20 / 10 % 1, 20.05 + i % 20 // 10 / 2, 7.0 + i % 2) for i in range(2000)] + [("pole", 89.99, 0.0, 9.0), ("edge", 0.0, 179.99, 9.0)]
    vents = spark.createDataFrame(listed, "vent string, vent_lat double, vent_lon double, radius_km double")
    assert screens.vents_by_cell(vents).agg(F.max(F.size("vents_here")).alias("n")).first().n <= 4  # of 2,000 in one tile
    at = [(10 + i / 37 % 1, 20 + i / 53 % 1) for i in range(200)] + [(90.0, 100.0), (89.95, -180.0), (0.0, -179.97), (0.0, 180.0)]
    rows = screens.clean(px(spark, *[(60.0, 0, lat, lon) for lat, lon in at]))
    near = F.min(F.when(E.flat_km(F.col("lat"), F.col("lon"), F.col("vent_lat"), F.col("vent_lon")) <= F.col("radius_km"), F.struct(E.flat_km(F.col("lat"), F.col("lon"), F.col("vent_lat"), F.col("vent_lon")).alias("km"), F.col("vent")))).alias("near")
    want = {r.pixel: r.near for r in rows.crossJoin(vents).groupBy("pixel").agg(near).collect()}
    assert {r.pixel: r.near for r in screens.with_nearest_vent(rows, vents).collect()} == want
    assert {want[200].vent, want[202].vent, want[203].vent} == {"pole", "edge"}


def test_guard_ring_has_nine_bins_and_floors_negative_coordinates(spark):
    bins = {r.bin for r in screens.fire_bins(spark.createDataFrame([(-0.01, -0.01)], "lat double, lon double")).collect()}
    assert bins == {(-1 + y) * 20000 - 1 + x for y in (-1, 0, 1) for x in (-1, 0, 1)}


def test_notes_come_in_order_and_sets_are_disjoint(spark):
    vents = spark.createDataFrame([("a", 55.5, 20.5, 7.0)], "vent string, vent_lat double, vent_lon double, radius_km double")
    rows = screens.clean(px(spark, (59.0, 0, 55.5, 20.5), (75.0, 0, 55.9, 20.9), (65.0, 0, 55.2, 20.2), (40.0, 0, 55.1, 20.8)))
    routed = screens.route(rows, vents, screens.fire_bins(spark.createDataFrame([(55.9, 20.9)], "lat double, lon double")))
    (tile,) = reduce.routed_maxima(routed, "d", "product").collect()
    assert round(tile.max_c) == 40 and tile.qc_note == S.QC_NOTE + S.VOLCANIC_MASKED_NOTE + S.FIRE_MASKED_NOTE + S.HIGH_LATITUDE_NOTE
    assert {(r.cause, round(r.max_c), r.source) for r in reduce.anomalies(routed, "d", "product").collect()} == {("volcanic", 59, "a"), ("wildfire", 75, None)}


def tiles(spark, *rows):
    """Rows (product, tile_lat, max_c)."""
    return spark.createDataFrame([(DAY, p, lat, 29, c, lat + 0.5, 29.5) for p, lat, c in rows], "d date, product string, tile_lat int, tile_lon int, max_c double, max_lat double, max_lon double")


def test_corroboration(spark):
    judged = corroborate.verdicts(tiles(spark, ("T", 1, 77.9), ("T", 2, 78.0), ("T", 3, 90.0), ("A", 3, 78.0), ("T", 4, 90.02), ("A", 4, 78.01), ("T", 5, 85.73), ("A", 5, 57.77), ("T", 6, 95.0), ("A", 6, 80.0)))
    assert {r.tile_lat: r.verdict for r in judged.collect()} == {1: "ordinary", 2: "lone", 3: "agree", 4: "both_out", 5: "rejected", 6: "both_out"}
    assert {r.tile_lat: r.max_c for r in corroborate.weather(judged).collect()} == {1: 77.9, 3: 90.0, 5: 57.77}
    assert {r.tile_lat: r.ceiling for r in corroborate.ceilings(judged).collect()} == {2: 77.99, 4: 77.99, 5: 57.77, 6: 77.99}
    assert sorted((r.tile_lat, r.cause[0], r.max_c) for r in corroborate.screened_out(judged).collect()) == [(2, "u", 78.0), (4, "f", 90.02), (4, "u", 78.01), (5, "f", 85.73), (6, "f", 95.0), (6, "u", 80.0)]


def test_selection_is_the_longer_prefix(spark):
    day = tiles(spark, *[("T", i, 30.0 + i) for i in range(15)])
    assert reduce.reported(day, 40.0, 3).count() == 5
    assert reduce.reported(day, 60.0, 3).count() == 3
    assert reduce.reported(day, 60.0, 99).count() == 15


def test_day_merge_keeps_the_earlier_granule_on_ties(spark):
    rows = None
    for seq, c in ((3, 50.0), (2, 50.0), (1, 49.0)):
        part = tiles(spark, ("T", 1, c)).withColumn("seq", F.lit(seq))
        rows = part if rows is None else rows.unionByName(part)
    assert reduce.day_merge(rows).first().seq == 2


def test_archive_laws(spark):
    day = tiles(spark, ("T", 1, 50.0), ("A", 1, 50.0), ("T", 2, 60.0))
    old = archive.records(day)
    assert {(r.tile_lat, r.max_c, r.product) for r in old.collect()} == {(1, 50.0, "A"), (2, 60.0, "T")}
    again = archive.merge(old, day)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, old.select(again.columns).collect()))
    assert archive.cutoff(old, 55.0, 1).first().cutoff == 60.0 and archive.cutoff(old, 40.0, 1).first().cutoff == 50.0
    assert archive.cutoff(old.limit(0), 40.0, 10).first().cutoff == 40.0
    ups = archive.upserts(old, tiles(spark, ("T", 1, 50.0), ("T", 2, 61.0), ("T", 3, 10.0)), 40.0, 2)
    assert [(r.tile_lat, r.max_c) for r in ups.collect()] == [(2, 61.0)]


def test_scalars(spark):
    got = one(
        spark, E.tile_lat(F.lit(90.0)), E.tile_lon(F.lit(180.0)), E.centi(F.lit(0.125)), E.centi(F.lit(0.135)), E.centi(F.lit(999.0)), E.palette_rank(F.lit(None).cast("int")), E.palette_rank(F.lit(5000)),
        E.mercator_py(F.lit(89.0)), E.mercator_py(F.lit(-89.0)), E.mercator_px(F.lit(180.0)), E.wrapped(F.lit(-359.0)), E.place_cell(F.lit(13.25)), E.place_cell(F.lit(-0.1)), E.continent(F.lit(23.0), F.lit(10.0)), E.coordinates(F.lit(-1.25), F.lit(3.0)),
        E.escape_html(F.lit("<a href='x'>&\"")), E.overpass_stamp(F.lit("MOD11_L2.A2020197.0920.061.hdf")), E.overpass_stamp(F.lit("x")), E.product_of_granule(F.lit("MOD11_L2.A1")), E.product_of_granule(F.lit("X.A1")),
    )
    assert [str(x) for x in got] == ["89", "179", "12", "14", "32767", "0", "2", "0", "32767", "32767", "1.0", "13.5", "0.0", "africa", "1.3°S 3.0°E", "&lt;a href=&#39;x&#39;&gt;&amp;&quot;", "A2020197.0920", "None", "MOD11_L2", "None"]


def test_registered_sql_functions(spark):
    assert "lst_celsius" in E.register(spark)
    r = spark.sql("SELECT lst_celsius(15000) c, qc_keep(64, 1) k, tile_of(-0.5D, -90, 89) t, palette_rank(7400) p, fahrenheit(100D) f").first()
    assert (round(r.c, 2), r.k, r.t, r.p, r.f) == (26.85, True, -1, 5, 212.0)


def test_index_map_covers_the_coarse_grid(spark):
    fine = spark.range(100).selectExpr("CAST(id AS INT) AS row", "0 AS col")
    geo = spark.range(20).selectExpr("CAST(id AS INT) AS srow", "0 AS scol", "CAST(id AS DOUBLE) AS lat", "0D AS lon")
    got = {r.row: r.srow for r in screens.expand_geolocation(fine, geo, (20, 1, 100, 1)).collect()}
    assert len(got) == 100 and all(abs(got[i] - i // 5) <= 1 for i in got) and set(got.values()) == set(range(20))


def test_scaling_is_checked(spark):
    from heatledger.sources.granules import checked_scaling

    good = spark.createDataFrame([({"scale_factor": 0.02},)], "attrs map<string,double>")
    assert checked_scaling(good).first().fill == 0.0
    with pytest.raises(Exception, match="scale_factor"):
        checked_scaling(spark.createDataFrame([({"scale_factor": 0.05},)], "attrs map<string,double>")).collect()


def _method_bytes(spark, rows):
    """Size of the largest generated method, without the adaptive plan, which has none before it runs."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = spark._jvm.PythonSQLUtils.explainString(rows._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    return max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text))


@pytest.mark.parametrize("name", ["clean", "nearest", "routed"])
def test_screens_stay_below_the_size_java_compiles(spark, name):
    """Java interprets methods beyond 8,000 bytes, which made the screens seven times slower."""
    sf = "/root/testdata/sf0.001"
    clean, vents = screens.clean(bindings.pixels(spark, sf)), bindings.vents(spark, sf)
    rows = {"clean": lambda: clean, "nearest": lambda: screens.with_nearest_vent(clean, vents), "routed": lambda: screens.route(clean, vents, screens.fire_bins(bindings.fires(spark, sf)))}[name]()
    assert _method_bytes(spark, rows) < 8000


def test_vent_without_a_place_or_radius_catches_nothing(spark):
    vents = spark.createDataFrame([(1, None, 10.0, 7.0), (2, 10.0, None, 7.0), (3, 10.0, 10.0, None)], "vent long, vent_lat double, vent_lon double, radius_km double")
    assert screens.vents_by_cell(vents).count() == 0
    rows = screens.located(px(spark, (30.0, 0, 10.0, 10.0), (30.0, 0, 90.0, 180.0)).withColumn("c", E.celsius(F.col("raw"))))
    assert screens.vent_matches(rows, vents).count() == 0
