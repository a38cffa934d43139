"""Raster, grid, worklist, places, read side, feeds, logs and the streaming archive."""

import json
import random
from datetime import date

from pyspark.sql import functions as F

from heatledger.operators import grid, places, raster, readmodel, reduce, worklist
from heatledger.sources import feed, logs

DAY = date(2020, 7, 15)


def test_png_keeps_ranks():
    rng = random.Random(1)
    px = sorted({(rng.randrange(256), rng.randrange(256)): rng.randint(1, 5) for _ in range(500)}.items(), key=lambda p: (p[0][1], p[0][0]))
    px = [(x, y, r) for (x, y), r in px]
    assert raster.png_ranks(raster.png(px)) == px


def test_tiles_and_pyramid(spark):
    base = spark.createDataFrame([(0, 0, 4100), (1, 1, 7500), (32767, 32767, 5000)], "px int, py int, centi int")
    levels = raster.pyramid(base)
    assert {r.centi for r in levels.filter("z = 0").collect()} == {7500, 5000}
    images = {r.path: r.image for r in raster.tiles(levels).collect()}
    assert len(images) == 15 and raster.png_ranks(bytes(images["7/0/0.png"])) == [(0, 0, 1), (1, 1, 5)]


def test_incremental_refresh_equals_rebuild(spark):
    rng = random.Random(2)
    rows = lambda n: spark.createDataFrame([(rng.randrange(32768), rng.randrange(32768), rng.randint(4000, 8000)) for _ in range(n)], "px int, py int, centi int").groupBy("px", "py").agg(F.max("centi").alias("centi"))
    old, new = rows(50).cache(), rows(10).cache()
    merged, changed = raster.merge_state(old, new)
    got = raster.refresh(raster.pyramid(old), merged, changed)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, raster.pyramid(merged).select(got.columns).collect()))


def brute_boxes(boxes, reach):
    boxes = list(boxes)
    while True:
        for i in range(len(boxes)):
            for j in range(i):
                a, b = boxes[i], boxes[j]
                if max(a[0], b[0]) - min(a[2], b[2]) <= reach and max(a[1], b[1]) - min(a[3], b[3]) <= reach:
                    boxes[j] = (min(a[0], b[0]), min(a[1], b[1]), max(a[2], b[2]), max(a[3], b[3]))
                    del boxes[i]
                    break
            else:
                continue
            break
        else:
            return sorted(boxes)


def test_clustering_does_not_depend_on_order():
    rng = random.Random(3)
    for _ in range(40):
        points = [(rng.uniform(0, 20), rng.uniform(0, 20)) for _ in range(rng.randint(1, 60))]
        boxes = [(x, y, x + 0.05, y + 0.05) for x, y in points]
        want = brute_boxes(boxes, 1.0)
        rng.shuffle(boxes)
        assert sorted(worklist.merge_boxes(boxes, 1.0)) == want


def test_split_and_jobs(spark):
    cells = spark.createDataFrame([(DAY, "T", 10.0, 179.9, 71.0), (DAY, "T", 10.0, 179.95, 72.0), (DAY, "T", 10.0, -179.9, 70.0)], "d date, product string, lat double, lon double, max_c double")
    got = sorted((round(r.west, 3), round(r.east, 3)) for r in worklist.boxes(cells, 0.5, 0.1).collect())
    assert got == [(-180.0, -179.925), (-180.0, -179.775), (179.775, 180.0), (179.975, 180.0)]
    (job,) = worklist.jobs(cells, 0.5, 0.1).collect()
    assert (job.cells, job.cmg_max_c, len(job.bboxes)) == (3, 72.0, 4)
    assert worklist.granule_estimate(worklist.jobs(cells, 0.5, 0.1), 2).first().asDict() == {"least": 8, "most": 32}


def test_a_box_of_the_globe_is_few_rows(spark):
    box = "array<struct<west:double,south:double,east:double,north:double>>"
    work = spark.createDataFrame([(date(2020, 1, 1), [(-180.0, -90.0, 180.0, 90.0)]), (date(2020, 1, 2), [(-20.0, -10.0, -10.0, 5.5), (170.0, 80.0, 180.0, 90.0)])], f"d date, bboxes {box}")
    assert worklist.box_tiles(work).filter("jd = DATE '2020-01-01'").count() < 1000
    at = [(90.0, 180.0), (-90.0, -180.0), (-10.0, -20.0), (5.5, -10.0), (5.51, -10.0), (0.0, 0.0), (80.0, 169.99)]
    pixels = spark.createDataFrame([(date(2020, 1, d), i, *p) for d in (1, 2, 3) for i, p in enumerate(at)], "d date, i int, lat double, lon double")
    assert sorted((r.d.day, r.i) for r in worklist.inside(pixels, work).collect()) == [(1, i) for i in range(7)] + [(2, 0), (2, 2), (2, 3)]


def test_job_validation(spark):
    box = {"west": 1, "south": 1, "east": 2, "north": 2}
    lines = [{"date": "2020-01-01", "bboxes": [box]}, {"bboxes": [box]}, {"date": "2020-01-01", "bboxes": []}, {"date": "2020-01-01", "bboxes": [{"west": 1}]}, {"date": "2020-01-01", "bboxes": [box | {"west": 3}]}, {"date": "2020-01-01", "bboxes": [box | {"east": 200}]}]
    rows = spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(lines)], "i int, value string").orderBy("i")
    assert [r.problem for r in worklist.parse_jobs(rows).collect()] == [None, "no date", "no boxes", "not four numbers", "inverted box", "off the globe"]


def test_candidate_files_survive_damage(spark, tmp_path):
    found = spark.createDataFrame([("T", DAY, 10.025, 20.025, 61.5), ("A", date(2019, 1, 1), -1.0, 2.0, 60.0)], "product string, d date, cell_lat double, cell_lon double, max_c double")
    path = str(tmp_path / "c")
    grid.write_candidates(found, path)
    extra = tmp_path / "c" / "product=T" / "year=2020" / "cut.csv"
    extra.write_text("day,cell_lat,cell_lon,max_c\n2020-07-15,10.0\nnot,a,row,x\n2020-07-16,1.000,2.000,63.00\n")
    got = sorted((str(r.d), r.max_c) for r in grid.read_candidates(spark, path).collect())
    assert got == [("2019-01-01", 60.0), ("2020-07-15", 61.5), ("2020-07-16", 63.0)]


def test_grid_keeps_the_earlier_day(spark):
    rows = spark.createDataFrame([("T", date(2020, 1, 2), 1.0, 1.0, 60.004), ("T", date(2020, 1, 1), 1.0, 1.0, 60.0), ("T", date(2020, 1, 3), 1.0, 1.0, 59.0)], "product string, d date, lat double, lon double, c double")
    (cell,) = grid.fold(grid.cells(rows)).collect()
    assert (cell.max_centi, cell.record_date) == (6000, date(2020, 1, 1))


READING = "d date, product string, tile_lat int, tile_lon int, max_c double, max_lat double, max_lon double"


def test_places(spark):
    rows = spark.createDataFrame([(DAY, "T", 13, 40, 60.0, 13.24, 40.1, "volcanic"), (DAY, "T", 13, 41, 61.0, 13.25, 40.1, "wildfire"), (DAY, "T", 1, 1, 62.0, 1.0, 1.0, None)], READING + ", cause string")
    dim = spark.createDataFrame([("13.0", "40.0", "South", "X"), ("13.5", "40.0", None, "X")], "cell_lat string, cell_lon string, place_name string, country string").selectExpr("CAST(cell_lat AS DECIMAL(5,1)) cell_lat", "CAST(cell_lon AS DECIMAL(5,1)) cell_lon", "place_name", "country")
    got = {r.max_c: (r.place_name, r.country) for r in places.named(rows, dim).collect()}
    assert got == {60.0: (None, None), 61.0: (None, "X"), 62.0: (None, None)}
    assert [(float(r.cell_lat), r.max_c) for r in places.unnamed_cells(rows, dim).collect()] == [(1.0, 62.0)]
    back = places.backfill(rows.withColumns({"place_name": F.when(F.col("max_c") == 62.0, "kept"), "country": F.lit(None).cast("string")}), dim)
    assert {r.max_c: (r.place_name, r.country) for r in back.collect()} == {60.0: ("South", "X"), 61.0: (None, "X"), 62.0: ("kept", None)}


def test_resolving_names_falls_back_to_the_coarser_reply(spark):
    replies = [('{"address":{"state":"Eastern","country":"Land"}}', None, "Eastern, Land"), ('{"address":{"state":"City","country":"City"}}', None, "City"), ('{"error":"x"}', '{"address":{"county":"C","country":"Land"}}', "C, Land"), (None, None, None)]
    rows = spark.createDataFrame([(i, 0, p, f) for i, (p, f, _) in enumerate(replies)], "cell_lat int, cell_lon int, payload string, fallback string")
    assert [r.place_name for r in places.resolve(rows).orderBy("cell_lat").collect()] == [x[2] for x in replies]


def test_limit_before_filter_matters(spark):
    rows = spark.createDataFrame([(DAY, "T", i, 0, 100.0 - i, 0.0, 0.0, "wildfire") for i in range(60)], READING + ", cause string")
    assert readmodel.anomaly_panel(rows, F.col("tile_lat") >= 55).count() == 0
    assert readmodel.anomaly_panel(rows, F.col("tile_lat") >= 48).count() == 2


def test_areas_and_periods(spark):
    rows = spark.createDataFrame([(date(2019, 1, 1), "T", 0, 0, 1.0, 10.0, 179.0), (date(2021, 1, 1), "T", 0, 0, 2.0, -10.0, -179.0)], READING)
    count = lambda c: rows.filter(c).count()
    assert [count(readmodel.in_area(a)) for a in ("everywhere", "view", "north", "south", "oceania")] == [2, 2, 1, 1, 0]
    assert count(readmodel.in_area("view", (178.0, -20.0, -178.0, 20.0))) == 2 and count(readmodel.in_area("view", (-178.0, -20.0, 178.0, 20.0))) == 0
    assert [count(readmodel.in_period(p, "2021-06-01")) for p in ("all", "2020s", "2010s", "year")] == [2, 1, 1, 1]


def test_feed_rules(spark):
    link = lambda host, rel="x/data#", **kw: {"rel": rel, "href": f"https://{host}/a.hdf", "inherited": False} | kw
    entries = [
        {"producer_granule_id": "a", "time_start": "t", "links": [link("nasa.gov.evil.org"), link("data.nasa.gov", inherited=True), link("x.NASA.gov")]},
        {"title": "b", "updated": "u", "links": [link("nasa.gov"), {"rel": "s3#", "href": "s3://lp-prod-public/a.hdf"}, {"rel": "z/s3#", "href": "s3://lp-prod-public/b.hdf"}]},
        {"title": "no link", "updated": "u", "links": []}, {"title": "no time", "links": [link("nasa.gov")]},
    ]
    refs = feed.parse(spark.createDataFrame([(1, json.dumps({"feed": {"entry": entries}}))], "feed int, body string")).orderBy("pos").collect()
    assert [(r.granule_id, r.observed_at, r.s3_url) for r in refs] == [("a", "t", None), ("b", "u", "s3://lp-prod-public/b.hdf")]


def test_logs(spark):
    lines = spark.createDataFrame([(x,) for x in ("2020-01-01 A=0 B=0", "2020-01-02 A=0 B=1", "2020-01-03", "# 2020-01-04 A=0", "", "2020-01-05 A=x", "2020-13-01 A=0", " 2020-01-06  A=0 ")], "value string")
    assert sorted(str(r.d) for r in logs.succeeded_days(lines).collect()) == ["2020-01-01", "2020-01-06"]
    assert [str(r.d) for r in logs.done_days(lines).collect()] == ["2020-01-03"]
    assert logs.calendar(spark, "2020-01-02", "2020-01-01").count() == 0
    assert [str(r.d) for r in logs.pending(logs.calendar(spark, "2020-01-01", "2020-01-04"), logs.succeeded_days(lines), 2).collect()] == ["2020-01-02", "2020-01-03"]


def test_boxes_of_a_day_are_merged_by_coarse_tiles(spark):
    """The same boxes as by one list, for scattered cells, chains over many tiles, diagonals and boxes that grow into reach of others."""
    import random

    rng = random.Random(4)
    days = {
        date(2020, 1, 1): [(rng.uniform(-60, 60), rng.uniform(-170, 170)) for _ in range(150)],
        date(2020, 1, 2): [(-40 + 0.5 * i, -100 + 0.5 * i) for i in range(150)] + [(10.0, -100.0)],
        date(2020, 1, 3): [(rng.gauss(0, 3), rng.gauss(20, 3)) for _ in range(200)] + [(0.0, -179.9), (0.0, 179.9)],
    }
    rows = [(d, round(round(a / 0.05) * 0.05 + 0.025, 3), round(round(o / 0.05) * 0.05 + 0.025, 3)) for d, cells in days.items() for a, o in cells]
    cells = spark.createDataFrame(rows, "d date, lat double, lon double")
    for reach, side in ((0.5, 5.0), (3.0, 1.0), (0.0, 40.0)):
        got = {}
        for b in worklist.cluster(cells, reach, side).collect():
            got.setdefault(b.d, []).append(tuple(b)[1:])
        for d in days:
            points = {(a, o) for x, a, o in rows if x == d}
            want = worklist.merge_boxes([(o - 0.025, a - 0.025, o + 0.025, a + 0.025) for a, o in points], reach)
            assert sorted(got[d]) == sorted(want)
    most = worklist.touched(worklist.strips(cells, 0.5), 0.5, 5.0).groupBy("d", "tx", "ty").count().agg({"count": "max"}).first()[0]
    assert most < 100  # a task holds a tile's boxes, not the day's


def test_one_grouping_serves_tiles_and_anomalies(spark):
    rows = [("T", DAY, k % 3, k, float(40 + k * 7 % 50), 1.1 * k, 2.0, k % 2, 5, ("weather", "volcanic", "wildfire", "implausible")[k % 4], "v" if k % 4 == 1 else None) for k in range(60)]
    routed = spark.createDataFrame(rows, "product string, d date, seq int, pixel long, c double, lat double, lon double, tile_lat int, tile_lon int, route string, vent string")
    summed = reduce.summary(routed, "d", "product", "seq")
    same = lambda a, b: sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(*a.columns).collect()))
    assert same(reduce.tiles_of(summed, "d", "product", "seq"), reduce.tile_maxima(routed, "d", "product", "seq"))
    assert sorted(map(str, reduce.anomalies_of(summed, "d", "product").collect())) == sorted(map(str, reduce.anomalies(routed, "d", "product").collect()))
