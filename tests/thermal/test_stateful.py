"""Streams and stored tables that keep state between batches."""

import os
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from heatledger.operators import archive, corroborate, places, publish, raster
from heatledger.sources import granules as G
from heatledger.sources.versions import Versions
from heatledger.streaming import archive as stream
from heatledger.streaming import barrier

READING = "d date, product string, tile_lat int, tile_lon int, max_c double, max_lat double, max_lon double"
DAY = date(2020, 7, 15)


def reading(product, lat, lon, c, day=DAY):
    return day, product, lat, lon, float(c), lat + 0.5, lon + 0.5


def size_of(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_versions_show_all_or_nothing(spark, tmp_path):
    v = Versions(spark, str(tmp_path / "t"))
    assert v.current() == (-1, {})
    folder = v.fresh("part")
    spark.range(3).write.parquet(v.at(folder))
    assert v.current() == (-1, {})  # written but not committed
    v.commit(0, {"parts": [folder]})
    with pytest.raises(FileExistsError):
        v.commit(0, {"parts": []})
    for n in (1, 2):
        other = v.fresh("part")
        spark.range(n).write.parquet(v.at(other))
        v.commit(n, {"parts": [other]})
    v.clean(keep=2)
    assert v.numbers() == [1, 2] and v.current()[1]["parts"] == [other]
    assert not os.path.exists(v.at(folder)) and len(os.listdir(tmp_path / "t" / "data")) == 2


def test_ledger_equals_records_in_any_order(spark, tmp_path):
    batches = [[("T", 1, 1, 50, date(2020, 1, 2)), ("A", 2, 2, 40)], [("T", 1, 1, 50, date(2019, 1, 1)), ("A", 85, -180, 30)], [], [("A", 1, 1, 49), ("A", -90, 0, 61)], [("A", 1, 1, 50, date(2019, 1, 1))]]
    frames = [spark.createDataFrame([reading(*r) for r in b], READING) for b in batches]
    ledger = stream.Ledger(spark, str(tmp_path / "a"))
    assert ledger.read().count() == 0
    for n, f in enumerate(frames):
        ledger.fold(f, n)
        ledger.fold(f, n)  # run again after a failure
    union = frames[0]
    for f in frames[1:]:
        union = union.unionByName(f)
    assert sorted(map(tuple, ledger.read().collect())) == sorted(map(tuple, archive.records(union).collect()))
    union.repartition(3).write.parquet(str(tmp_path / "in"))
    live = spark.readStream.schema(READING).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    stream.start(live, str(tmp_path / "b"), str(tmp_path / "k")).awaitTermination()
    assert sorted(map(tuple, stream.Ledger(spark, str(tmp_path / "b")).read().collect())) == sorted(map(tuple, archive.records(union).collect()))


def test_ledger_writes_follow_the_batch(spark, tmp_path):
    ledger = stream.Ledger(spark, str(tmp_path / "a"))
    globe = spark.range(180 * 360).selectExpr("DATE '2020-01-01' AS d", "'T' AS product", "CAST(id DIV 360 - 90 AS INT) AS tile_lat", "CAST(id % 360 - 180 AS INT) AS tile_lon", "40.0D + id % 17 AS max_c", "0.5D AS max_lat", "0.5D AS max_lon")
    ledger.fold(globe, 0)
    whole = size_of(ledger.versions.root)
    before, seen = whole, set(os.listdir(f"{ledger.versions.root}/data"))
    for n in range(1, 13):
        ledger.fold(spark.createDataFrame([reading("A", 5, n, 70 + n)], READING), n)
        new = set(os.listdir(f"{ledger.versions.root}/data")) - seen
        seen |= new
        assert sum(size_of(f"{ledger.versions.root}/data/{x}") for x in new) < whole / 20  # also where runs are merged
    number, content = ledger.versions.current()
    runs = content["runs"]["0"]
    assert number == 12 and all(a[1] > 2 * b[1] for a, b in zip(runs, runs[1:], strict=False))
    assert {r.max_c for r in ledger.read().filter("tile_lat = 5 AND tile_lon BETWEEN 1 AND 12").collect()} == {70.0 + n for n in range(1, 13)}
    assert ledger.read().count() == 180 * 360 and before == whole


def test_barrier_holds_then_rules_again(spark, tmp_path):
    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / name))

    def go():
        live = lambda name, schema: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name))
        barrier.start(live("tiles", READING), live("ends", "d date, product string"), ["A", "T"], str(tmp_path / "v"), str(tmp_path / "k")).awaitTermination()
        return {(r.d, r.tile_lat): (r.verdict, r.winner_max_c, r.witness_max_c) for r in barrier.verdicts(spark, str(tmp_path / "v")).collect()}

    other = date(2020, 7, 16)
    put("tiles", [reading("T", 1, 1, 80), reading("T", 45, 2, 81), reading("T", 1, 1, 60, other)], READING)
    put("ends", [(DAY, "T"), (other, "T")], "d date, product string")
    assert go() == {}  # held: the other satellite has not closed
    put("tiles", [reading("A", 1, 1, 79)], READING)
    put("ends", [(DAY, "A")], "d date, product string")
    assert go() == {(DAY, 1): ("agree", 80.0, 79.0), (DAY, 45): ("lone", 81.0, None)}
    put("tiles", [reading("A", 45, 2, 50), reading("A", 1, 1, 70)], READING)  # one late, one cooler than what is held
    put("ends", [(DAY, "A")], "d date, product string")
    late = go()
    assert late == {(DAY, 1): ("agree", 80.0, 79.0), (DAY, 45): ("rejected", 81.0, 50.0)}
    put("ends", [(other, "A")], "d date, product string")
    put("tiles", [reading("T", 45, 2, 81)], READING)  # a repeated reading changes nothing
    assert go() == late | {(other, 1): ("ordinary", 60.0, None)}
    everything = spark.read.schema(READING).parquet(str(tmp_path / "tiles"))
    best = everything.groupBy("d", "product", "tile_lat", "tile_lon").agg({"max_c": "max", "max_lat": "max", "max_lon": "max"}).toDF("d", "product", "tile_lat", "tile_lon", "max_lon", "max_c", "max_lat").select(*everything.columns)
    assert {(r.d, r.tile_lat): (r.verdict, r.winner_max_c, r.witness_max_c) for r in corroborate.verdicts(best).collect()} == go()


def test_only_blocks_of_changed_tiles_are_read(spark, tmp_path):
    """A change of one base tile reads the blocks on its path to the top, whatever else the store holds."""
    # a pixel in each eighth tile of the base
    old = spark.createDataFrame([(x * 2048 + 5, y * 2048 + 7, 4500) for x in range(16) for y in range(16)], "px int, py int, centi int")
    raster.write_levels(raster.ranks(raster.pyramid(old)).drop("centi"), str(tmp_path / "l"))
    new = spark.createDataFrame([(9 * 2048 + 5, 3 * 2048 + 7, 7600), (9 * 2048 + 300, 3 * 2048 + 7, 5100)], "px int, py int, centi int")
    state, changed = raster.merge_state(old, new)
    stored = spark.read.parquet(str(tmp_path / "l"))
    levels, tiles = raster.changed_levels(state, changed, stored)
    found = {(r.z, r.tx, r.ty): r.created for r in tiles.collect()}
    assert len(found) == 9 and [k for k, v in found.items() if v] == [(7, 73, 24)]
    full = raster.ranks(raster.pyramid(state))
    inside = {(r.z, r.px, r.py, r.rank) for r in full.collect() if (r.z, r.px >> 8, r.py >> 8) in found}
    assert {(r.z, r.px, r.py, r["rank"]) for r in levels.collect()} == inside
    # files of other blocks are damaged now; nothing opens them
    wanted = {f"z={z}/bx={x // 8}/by={y // 8}" for z, x, y in found}
    for folder, _, names in os.walk(tmp_path / "l"):
        for name in names:
            if name.endswith(".parquet") and os.path.relpath(folder, tmp_path / "l") not in wanted:
                open(os.path.join(folder, name), "wb").close()
    assert {(r.z, r.px, r.py, r["rank"]) for r in raster.changed_levels(state, changed, stored)[0].collect()} == inside
    with pytest.raises(Exception, match="(?i)parquet"):
        stored.agg({"rank": "max"}).collect()
    assert raster.changed_levels(state, changed.filter("tx < 0"), stored)[1].collect() == []


def test_both_halves_of_the_days_take_one_pass(spark, monkeypatch):
    from heatledger.plans import catalogue, stateful

    passes = spark.sparkContext.accumulator(0)
    schema = "d date, lat double, lon double, c double"

    def counted(frames):
        for f in frames:
            passes.add(len(f))
            yield f

    rows = spark.createDataFrame([(date(1998, m, 1), 1.0 + m, 2.0, 50.0 + m) for m in (1, 9, 10, 12)], schema)
    monkeypatch.setattr(catalogue, "_clean", lambda *_: rows.mapInPandas(counted, schema))
    old, new = stateful._halves(spark, None)
    want = [raster.base(rows.filter(f"d {sign} DATE '1998-10-01'")) for sign in ("<", ">=")]
    for got, sure in zip((old, new), want, strict=True):
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, sure.collect())) and got.count() == 2
    assert passes.value == 4


def test_a_stop_leaves_a_whole_version(spark, tmp_path):
    """The day fails after each of its steps; readers see the day before until the pointer is there, and the day run again gives the same as without a stop."""
    pixels = "px int, py int, centi int"
    first = spark.createDataFrame([(5, 5, 4100), (300, 5, 4200), (20000, 9000, 5000)], pixels)
    second = spark.createDataFrame([(5, 5, 4000), (301, 5, 7700), (9000, 9000, 5200)], pixels)
    weather = [spark.createDataFrame([reading("T", 1, 1, 50 + n, date(2020, 1, 1 + n)), reading("A", 2, n, 41)], READING) for n in (0, 1)]

    def shown(store):
        levels, state, rows, manifest = publish.read(store)
        return sorted(map(tuple, levels.select("z", "px", "py", "rank").collect())), sorted(map(tuple, state.collect())), sorted(map(tuple, rows.collect())), manifest

    whole = Versions(spark, str(tmp_path / "whole"))
    publish.fold_day(whole, first, weather[0], "2020-01-02")
    before = shown(whole)
    publish.fold_day(whole, second, weather[1], "2020-01-01")
    after = shown(whole)
    state = first.unionByName(second).groupBy("px", "py").agg(F.max("centi").alias("centi"))
    full = raster.ranks(raster.pyramid(state))
    assert after[0] == sorted((r.z, r.px, r.py, r["rank"]) for r in full.collect()) and after[1] == sorted(map(tuple, state.collect()))
    tiles = len({(z, x >> 8, y >> 8) for z, x, y, _ in after[0]})
    assert after[3] == {"since": "2020-01-01", "through": "2020-01-02", "tile_count": tiles}

    class Stop(Exception):
        pass

    for step in ("levels", "state", "rows"):
        store = Versions(spark, str(tmp_path / step))
        publish.fold_day(store, first, weather[0], "2020-01-02")

        def stop(done, at=step):
            if done == at:
                raise Stop

        with pytest.raises(Stop):
            publish.fold_day(store, second, weather[1], "2020-01-01", stop)
        assert shown(store) == before
        publish.fold_day(store, second, weather[1], "2020-01-01")
        assert shown(store) == after
        store.clean(keep=1)  # also what the stopped run wrote
        assert shown(store) == after and len(store._names("data")) <= 5
    publish.fold_day(whole, second, weather[1], "2020-01-01")  # a day again changes nothing
    assert shown(whole) == after
    blocks = whole.content(1)["levels"]
    assert [k for k, v in whole.content(2)["levels"].items() if blocks[k] != v] == []


def test_update_of_names_leaves_other_files(spark, tmp_path):
    row = "tile_lat int, tile_lon int, max_c double, max_lat double, max_lon double, cause string, place_name string, country string"
    rows = [(lat, 10, 50.0, lat + 0.1, 10.1, cause, name, None) for lat in range(0, 80, 2) for cause, name in (("wildfire", None), ("volcanic", None), ("wildfire", "kept"))]
    store = Versions(spark, str(tmp_path / "t"))
    places.put_rows(store, spark.createDataFrame(rows, row), 8)
    files = store.current()[1]["files"]
    known = spark.createDataFrame([(Decimal("4.0"), Decimal("10.0"), "Here", "C"), (Decimal("6.0"), Decimal("10.0"), None, "C"), (Decimal("-50.0"), Decimal("10.0"), "Far", "C")], "cell_lat decimal(5,1), cell_lon decimal(5,1), place_name string, country string")
    assert places.name_rows(store, known) == 1
    after = store.current()[1]["files"]
    assert len(set(files) & set(after)) == len(files) - 1
    got = {(r.tile_lat, r.cause, r.place_name, r.country) for r in places.rows_of(store).filter("place_name IS NOT NULL AND place_name <> 'kept' OR country IS NOT NULL").collect()}
    assert got == {(4, "wildfire", "Here", "C")} and places.rows_of(store).count() == len(rows)
    assert places.name_rows(store, known) == 0 and store.current()[1]["files"] == after and store.current()[0] == 1


def test_answers_are_kept_and_silence_is_not(spark, tmp_path):
    cell = lambda i: (Decimal(f"{i}.0"), Decimal("10.0"))
    key = "cell_lat decimal(5,1), cell_lon decimal(5,1)"
    wanted = spark.createDataFrame([cell(i) for i in range(7)] + [cell(0)], key)
    named, empty = '{"address":{"state":"S","country":"C"}}', '{"error":"x"}'
    replies = spark.createDataFrame([
        (*cell(0), "fine", 200, named), (*cell(1), "fine", 200, empty), (*cell(1), "coarse", 200, '{"address":{"country":"C"}}'), (*cell(2), "fine", 200, empty), (*cell(2), "coarse", 200, "[]"),
        (*cell(3), "fine", 503, named), (*cell(4), "fine", 200, "<html>"), (*cell(5), "fine", 200, empty), (*cell(5), "coarse", 429, named)], key + ", level string, status int, payload string")
    store = Versions(spark, str(tmp_path / "c"))

    def ask():
        out = places.look_up(wanted, places.cached(store), replies)
        return out, {int(r.cell_lat): (r.state, r.place_name, r.requests) for r in out.collect()}

    out, found = ask()
    assert found == {0: ("named", "S, C", 1), 1: ("named", "C", 2), 2: ("nameless", None, 2), 3: ("unanswered", None, 1), 4: ("unanswered", None, 1), 5: ("unanswered", None, 2), 6: ("unanswered", None, 1)}
    places.remember(store, out)
    first = store.current()[1]["answers"]
    again, found = ask()
    assert {k: v[0] for k, v in found.items()} == {0: "cached", 1: "cached", 2: "cached", 3: "unanswered", 4: "unanswered", 5: "unanswered", 6: "unanswered"} and found[2] == ("cached", None, 0)
    places.remember(store, again)
    assert store.current()[1]["answers"][:1] == first


def test_scaling_of_grids(spark):
    grids = [("ok", {"scale_factor": 0.02}, [7500.0, 65535.0]), ("free", {"scale_factor": 0.02, "_FillValue": 9.0, "add_offset": 1.0}, None), ("none", {}, None), ("far", {"scale_factor": 0.021}, None), ("short", {"scale_factor": 0.02}, [1.0]), ("turned", {"scale_factor": 0.02}, [9.0, 1.0])]
    scaling = G.grid_scaling(spark.createDataFrame(grids, "granule_id string, attrs map<string, double>, valid_range array<double>"))
    assert {r.granule_id: r.problem for r in scaling.collect()} == {"ok": None, "free": None, "none": "no scale_factor", "far": "scale_factor is not 0.02", "short": "valid_range has 1 entries", "turned": "valid_range is inverted"}
    cells = spark.createDataFrame([(g, raw) for g, _, _ in grids for raw in (0, 9, 7499, 7500, 15000, 65535)], "granule_id string, raw int")
    kept = {}
    for r in G.decode_grid(cells, scaling).collect():
        kept.setdefault(r.granule_id, []).append((r.raw, round(r.c, 2)))
    assert {k: sorted(v) for k, v in kept.items()} == {"ok": [(7500, -123.15), (15000, 26.85)], "free": [(7499, -122.17), (7500, -122.15), (15000, 27.85)]}
