"""Readers of granule files, with dictionaries in the place of files."""

import numpy as np
import pytest

from heatledger.sources import granules as G


#: Parts of datasets that were read.
GOT: list = []


class Dataset:
    def __init__(self, values, **attrs):
        self.values, self.attrs = np.asarray(values), attrs

    def get(self, start=None, count=None):
        if not self.values.size:
            raise AssertionError("got a dataset without values")
        if start is None:
            return self.values
        GOT.append((start, count))
        return self.values[tuple(slice(a, a + n) for a, n in zip(start, count, strict=True))]

    def info(self):
        return "name", self.values.ndim, list(self.values.shape), 0, 0

    def attributes(self):
        return self.attrs


class File(dict):
    def datasets(self):
        return dict(self)

    def select(self, name):
        return self[name]

    def end(self):
        self["ended"] = True


def rows(reader, **datasets):
    file = File(datasets)
    return [r for b in reader({"paths": "x", "splits": "1"}).batches(file, "g.hdf", 0) for r in b.to_pylist()]


LST = Dataset(np.array([[14000, 0, 15000]], np.uint16), scale_factor=0.02, _FillValue=0, units="K")
QC = Dataset(np.array([[0, 1, 65]], np.uint8))
PLACE = {"Latitude": Dataset([[1.5]]), "Longitude": Dataset([[-2.5]])}


def test_swath():
    got = rows(G.SwathReader, LST=LST, QC=QC, **PLACE)
    assert [(r["granule_id"], r["row"], r["col"], r["raw"], r["qc"]) for r in got] == [("g.hdf", 0, 0, 14000, 0), ("g.hdf", 0, 1, 0, 1), ("g.hdf", 0, 2, 15000, 65)]
    assert dict(got[0]["attrs"]) == {"scale_factor": 0.02, "_FillValue": 0.0}
    assert rows(G.LocationReader, LST=LST, QC=QC, **PLACE) == [{"granule_id": "g.hdf", "row": 0, "col": 0, "lat": 1.5, "lon": -2.5}]
    with pytest.raises(ValueError, match="lacks the datasets Latitude, QC"):
        rows(G.SwathReader, LST=LST, Longitude=PLACE["Longitude"])
    with pytest.raises(ValueError, match="qc is .1, 2., not .1, 3."):
        rows(G.SwathReader, LST=LST, QC=Dataset([[1, 2]]), **PLACE)


def test_batches_hold_all_pixels_in_order(monkeypatch):
    monkeypatch.setattr(G, "BATCH_PIXELS", 7)
    many = np.arange(60).reshape(6, 10)
    got = rows(G.SwathReader, LST=Dataset(many, _FillValue=0), QC=Dataset(many % 4), **PLACE)
    assert [(r["row"] * 10 + r["col"], r["raw"], r["qc"]) for r in got] == [(i, i, i % 4) for i in range(60)]


def test_fires():
    assert rows(G.FireReader) == rows(G.FireReader, FP_latitude=Dataset([1.0])) == []
    assert rows(G.FireReader, FP_latitude=Dataset([]), FP_longitude=Dataset([])) == []
    assert [(r["fire_lat"], r["fire_lon"]) for r in rows(G.FireReader, FP_latitude=Dataset([1.0, 2.0]), FP_longitude=Dataset([3.0, 4.0]))] == [(1.0, 3.0), (2.0, 4.0)]
    with pytest.raises(ValueError, match="1 fire latitudes, 0 longitudes"):
        rows(G.FireReader, FP_latitude=Dataset([1.0]), FP_longitude=Dataset([]))


def test_daily_grid_through_spark(spark):
    with pytest.raises(ValueError, match="raw is"):
        rows(G.GridReader, LST_Day_CMG=LST, QC_Day=QC)

    data, make = {"LST_Day_CMG": (LST.values, LST.attrs), "QC_Day": (QC.values, {})}, (File, Dataset)

    class Reader(G.GridReader):
        shape = (1, 3)

        def opened(self, path):
            found = {k: make[1](v, **a) for k, (v, a) in data.items()}
            if "timed" in path:
                found["Day_view_time"] = make[1](np.array([[60, 255, 0]], np.uint8))
            return make[0](found)

    class Source(G.GridSource):
        reads = Reader

    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(Source)
    got = spark.read.format("daily_grid").option("paths", "/a/plain.hdf,/a/timed.hdf").load()
    shown = got.select("granule_id", "col", "raw", "qc", G.view_hours(got["view"]).alias("hours"), "attrs").orderBy("granule_id", "col").collect()
    assert [(r.granule_id, r.col, r.raw, r.qc) for r in shown[:3]] == [("plain.hdf", 0, 14000, 0), ("plain.hdf", 1, 0, 1), ("plain.hdf", 2, 15000, 65)]
    assert [r.hours for r in shown] == [None, None, None, 12.0, None, 0.0]
    scaled = G.checked_scaling(got).select("scale", "offset", "fill").distinct().collect()
    assert [tuple(r) for r in scaled] == [(0.02, 0.0, 0.0)]


def by_value():
    """Have this module's classes sent to Python workers whole."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    return File, Dataset


def test_splits_read_their_rows_only():
    values = np.arange(7 * 4).reshape(7, 4)
    reader = G.SwathReader({"paths": "a.hdf", "splits": "3"})
    GOT.clear()
    parts = [[(r["row"], r["col"], r["raw"]) for b in reader.batches(File(LST=Dataset(values, _FillValue=0), QC=Dataset(values), **PLACE), "a.hdf", k) for r in b.to_pylist()] for k in range(3)]
    assert [p for part in parts for p in part] == [(i // 4, i % 4, i) for i in range(28)]
    assert [len(p) for p in parts] == [8, 8, 12] and max(n for _, (n, _) in GOT) == 3


def test_filters_reach_the_reader(spark):
    from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, In, LessThan

    class Pushed(G.Pushing, G.GridReader):
        pass

    reader = Pushed({"paths": "/x/a.hdf,/x/b.hdf"})
    assert len(reader.partitions()) == 30  # 240 rows each
    passed = list(reader.pushFilters([In(("granule_id",), ("b.hdf", "c.hdf")), GreaterThanOrEqual(("row",), 300), LessThan(("row",), 500), EqualTo(("qc",), 0)]))
    assert len(passed) == 4  # Spark checks again
    assert [p.value for p in reader.partitions()] == [("/x/b.hdf", 1), ("/x/b.hdf", 2)]
    assert [reader.row_span(3600, k) for k in (1, 2)] == [(300, 480), (480, 500)]

    file, dataset = by_value()

    class Reader(G.GridReader):
        shape, splits = (40, 3), 8

        def opened(self, path):
            if self.filters != [("row", GreaterThanOrEqual, 12), ("raw", G.GreaterThan, 50)] or not path.endswith("b.hdf"):
                raise AssertionError("filters or files were not pushed")
            values = np.arange(120).reshape(40, 3)
            return file({"LST_Day_CMG": dataset(values, _FillValue=0), "QC_Day": dataset(values % 2)})

    class Source(G.GridSource):
        reads = Reader

        @classmethod
        def name(cls):
            return "small_grid"

    spark.dataSource.register(Source)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        got = spark.read.format("small_grid").option("paths", "/x/a.hdf,/x/b.hdf").option("pushdown", "true").load().filter("granule_id = 'b.hdf' AND row >= 12 AND raw > 50")
        assert sorted(r.raw for r in got.collect()) == list(range(51, 120)) and got.rdd.getNumPartitions() == 6
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_damaged_files_are_rows_or_errors(spark):
    file, dataset = by_value()

    def opened(self, path):
        if "bad" in path:
            raise ValueError("not a swath")
        if "none" in path:
            return file()
        if "uneven" in path:
            return file({"FP_latitude": dataset([1.0]), "FP_longitude": dataset([1.0, 2.0])})
        values = np.array([[14000, 15000]])
        return file({"FP_latitude": dataset([1.0, 2.0]), "FP_longitude": dataset([3.0, 4.0]), "LST": dataset(values, _FillValue=0), "QC": dataset(values % 2), "Latitude": dataset([[1.5]]), "Longitude": dataset([[2.5]])})

    class Status(G.FireStatusSource):
        reads = type("R", (G.FireStatusReader,), {"opened": opened})

    class Swaths(G.SwathSource):
        reads = type("R", (G.SwathReader,), {"opened": opened})

    spark.dataSource.register(Status)
    spark.dataSource.register(Swaths)
    statuses = spark.read.format("swath_fire_status").option("paths", "/a/fires.hdf,/a/none.hdf,/a/bad.hdf,/a/uneven.hdf").load()
    found = {r.granule_id: (r.status, None if r.fires is None else [tuple(f) for f in r.fires], r.error) for r in statuses.collect()}
    assert found == {"fires.hdf": ("applied", [(1.0, 3.0), (2.0, 4.0)], None), "none.hdf": ("none", [], None), "bad.hdf": ("unavailable", None, "ValueError: not a swath"), "uneven.hdf": ("unavailable", None, "ValueError: uneven.hdf: 1 fire latitudes, 2 longitudes")}
    granules = spark.createDataFrame([("g1", "fires.hdf"), ("g2", "none.hdf"), ("g3", "bad.hdf"), ("g4", "gone.hdf"), ("g5", None)], "granule_id string, fire_id string")
    notes = {r.granule_id: r.qc_note.endswith("; fire mask unavailable") for r in G.with_fire_status(granules, statuses).collect()}
    assert notes == {"g1": False, "g2": False, "g3": True, "g4": True, "g5": True}

    swaths = lambda: spark.read.format("swath").option("paths", "/a/good.hdf,/a/bad.hdf").option("splits", "2")
    rows = swaths().option("damaged", "report").load().collect()
    assert sorted((r.granule_id, r.raw, r.error) for r in rows if r.error is None) == [("good.hdf", 14000, None), ("good.hdf", 15000, None)]
    assert [(r.granule_id, r.raw, r.error) for r in rows if r.error] == [("bad.hdf", None, "ValueError: not a swath")]
    with pytest.raises(Exception, match="not a swath"):
        swaths().load().collect()


def test_fire_swaths_as_text(spark):
    texts = ['{"FP_latitude":[1.0,2.5],"FP_longitude":[3.0,4.0]}', "{}", '{"FP_latitude":[],"FP_longitude":[]}', '{"FP_latitude":[1.0]}', '{"FP_latitude":[1.0],"FP_longitude":[]}', '{"FP_latitude":[1.0', "", None, '{"FP_latitude":["x"],"FP_longitude":[1.0]}', "[]"]
    rows = G.fire_status_of_text(spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "granule_id string, content string")).collect()
    assert [(r.status, None if r.fires is None else len(r.fires)) for r in sorted(rows, key=lambda r: int(r.granule_id))] == [
        ("applied", 2), ("none", 0), ("none", 0), ("none", 0), ("unavailable", None), ("unavailable", None), ("unavailable", None), ("unavailable", None), ("unavailable", None), ("unavailable", None)]
