"""Granule attributes and optional readers of HDF4 swaths, fire swaths and daily grids; Parquet is the working format.

A file is read in ``splits`` tasks of its rows, each of which gets its own rows from the file only. Filters on the granule's name, on rows and columns and on stored
values reach the reader with the option ``pushdown`` = ``true``, which needs Spark's setting ``spark.sql.python.filterPushdown.enabled``: files and splits that
cannot match are no tasks, other rows are not read and other pixels not sent. With the option ``damaged`` = ``report`` a file that cannot be read is one row with its name and what was wrong with it (column ``error``)
instead of a failed job; fire swaths have a status of their own, see ``FireStatusSource``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from heatledger import schema as S

#: Fixed names of datasets: temperature and quality of a swath and of a daily grid, its view time, a swath's coordinates, fire pixels.
SWATH = ("LST", "QC", "Latitude", "Longitude")
GRID, VIEW_TIME = ("LST_Day_CMG", "QC_Day"), "Day_view_time"
FIRES = ("FP_latitude", "FP_longitude")
#: Fixed size of a daily grid.
GRID_SHAPE = (3600, 7200)
#: Pixels of an Arrow batch.
BATCH_PIXELS = 1 << 16


def checked_scaling(granules: DataFrame) -> DataFrame:
    """Granules (attrs map) with scale, offset and fill; an absent or unexpected scale is an error, not a guess."""
    scale = F.col("attrs")["scale_factor"]
    close = F.abs(scale - S.SCALE) <= 1e-6 * F.greatest(F.abs(scale), F.lit(S.SCALE))
    checked = F.when(close, scale).otherwise(F.raise_error(F.lit("scale_factor is absent or not 0.02")).cast("double"))
    return granules.withColumns({"scale": checked, "offset": F.coalesce(F.col("attrs")["add_offset"], F.lit(0.0)), "fill": F.coalesce(F.col("attrs")["_FillValue"], F.lit(0.0))})


def grid_scaling(granules: DataFrame) -> DataFrame:
    """Daily grids (granule_id, attrs map, valid_range array) with scale, offset, fill, the valid counts low and high, and ``problem``: NULL, or why the grid is refused.

    A scale that is absent or unexpected, a range without two ends and an inverted one are refused; a grid without a range accepts all counts.
    """
    a, r = F.col("attrs"), F.col("valid_range")
    scale = a["scale_factor"]
    far = F.abs(scale - S.SCALE) > 1e-6 * F.greatest(F.abs(scale), F.lit(S.SCALE))
    low, high = F.get(r, F.lit(0)).cast("long"), F.get(r, F.lit(1)).cast("long")
    problem = (
        F.when(scale.isNull(), "no scale_factor").when(far, "scale_factor is not 0.02")
        .when(F.size(r) != 2, F.concat(F.lit("valid_range has "), F.size(r).cast("string"), F.lit(" entries"))).when(low > high, "valid_range is inverted")
    )
    return granules.withColumns({"scale": scale, "offset": F.coalesce(a["add_offset"], F.lit(0.0)), "fill": F.coalesce(a["_FillValue"], F.lit(0.0)).cast("long"), "low": low, "high": high, "problem": problem})


def decode_grid(cells: DataFrame, scaling: DataFrame) -> DataFrame:
    """Cells (granule_id, raw, ...) of accepted grids with a temperature ``c``: no fill, within the grid's own range and within the physical one."""
    use = scaling.filter("problem IS NULL").select("granule_id", "scale", "offset", "fill", "low", "high")
    c = F.col("raw") * F.col("scale") + F.col("offset") + S.OFFSET
    inside = F.coalesce(F.col("raw").between(F.col("low"), F.col("high")), F.lit(True))
    met = cells.join(use, "granule_id").filter((F.col("raw") != F.col("fill")) & inside).withColumn("c", c)
    return met.filter(F.col("c").between(S.VALID_MIN, S.VALID_MAX)).drop("scale", "offset", "fill", "low", "high")


def view_hours(raw):
    """Hours of a raw view time; 255 is unknown."""
    return F.when(raw != 255, raw * 0.2)


def _present(file, name: str, wanted: tuple[str, ...]) -> None:
    gone = sorted(set(wanted) - set(file.datasets()))
    if gone:
        raise ValueError(f"{name} lacks the datasets {', '.join(gone)}")


def _attributes(dataset) -> list[tuple[str, float]]:
    """Numeric attributes; the fill value comes from the file's own record where no attribute states it."""
    found = {k: float(v) for k, v in dataset.attributes().items() if isinstance(v, int | float | np.number)}
    if "_FillValue" not in found:
        from pyhdf.error import HDF4Error

        try:
            found["_FillValue"] = float(dataset.getfillvalue())
        except HDF4Error:
            pass  # no fill value was recorded; checked_scaling takes 0
    return sorted(found.items())


def _pixels(name: str, arrays: dict[str, np.ndarray], attrs: dict, schema: pa.Schema, first_row: int = 0, keep=None):
    """Batches of the pixels of equally shaped arrays in row order, each with the granule's name and ``attrs``; ``first_row`` is the number of the arrays' first row.

    ``keep`` tells which of some pixels, given as a dictionary of columns, are wanted.
    """
    height, width = next(iter(arrays.values())).shape
    flat = {k: a.reshape(-1) for k, a in arrays.items()}
    for at in range(0, height * width, BATCH_PIXELS):
        place = np.arange(at, min(at + BATCH_PIXELS, height * width))
        known = {"row": first_row + place // width, "col": place % width} | {k: a[place] for k, a in flat.items()}
        if keep is not None:
            wanted = keep(known)
            known = {k: a[wanted] for k, a in known.items()}
        n = len(known["row"])
        if not n:
            continue
        known["granule_id"] = pa.repeat(name, n)
        known |= {k: pa.repeat(pa.scalar(v, schema.field(k).type), n) for k, v in attrs.items() if k in schema.names}
        columns = [known.get(f.name, pa.nulls(n, f.type)) for f in schema]
        yield pa.RecordBatch.from_arrays([(c if isinstance(c, pa.Array) else pa.array(c)).cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_ATTRS = ("attrs", pa.map_(pa.string(), pa.float64()))
#: How filters of Spark compare a column.
_COMPARE = {EqualTo: np.equal, GreaterThan: np.greater, GreaterThanOrEqual: np.greater_equal, LessThan: np.less, LessThanOrEqual: np.less_equal}


def base_name(path: str) -> str:
    return path.rpartition("/")[2]


class FileReader(DataSourceReader):
    """A split of a file is a partition; subclasses turn its rows into Arrow batches of ``fields``."""

    fields: pa.Schema
    #: Tasks a file is read in.
    splits = 1
    #: Columns that a pushed filter may compare pixel by pixel.
    compared = ("row", "col", "raw", "qc")

    def __init__(self, options: dict):
        self.paths = options["paths"].split(",")
        self.splits = int(options.get("splits", self.splits))
        self.report = options.get("damaged", "fail") == "report"
        self.filters: list = []
        self.granules: list[set] = []

    def row_span(self, height: int | None, k: int) -> tuple[int, int]:
        """First and past-last row of split ``k``, without the rows that filters rule out."""
        low, high = height * k // self.splits, height * (k + 1) // self.splits
        for column, kind, value in self.filters:
            if column == "row":
                low = max(low, {EqualTo: value, GreaterThan: value + 1, GreaterThanOrEqual: value}.get(kind, low))
                high = min(high, {EqualTo: value + 1, LessThan: value, LessThanOrEqual: value + 1}.get(kind, high))
        return low, max(low, high)

    #: Rows of every file, where the format fixes them.
    height: int | None = None

    def partitions(self):
        files = [p for p in self.paths if all(base_name(p) in g for g in self.granules)]
        pieces = [(p, k) for p in files for k in range(self.splits)]
        if self.height is not None:  # the first split of a file stays in any case where damage is reported
            pieces = [(p, k) for p, k in pieces if self.row_span(self.height, k)[0] < self.row_span(self.height, k)[1] or (self.report and k == 0)]
        return [InputPartition(x) for x in pieces]

    def wanted(self, columns: dict[str, np.ndarray]) -> np.ndarray:
        """Which pixels pass the filters."""
        out = np.ones(len(columns["row"]), bool)
        for column, kind, value in self.filters:
            if column in columns:
                out &= _COMPARE[kind](columns[column], value)
        return out

    def read(self, partition):
        path, k = partition.value
        try:
            file = self.opened(path)
            try:
                yield from self.batches(file, base_name(path), k)
            finally:
                file.end()
        except ImportError:
            raise
        except Exception as error:
            if not self.report:
                raise
            if k == 0:  # each split meets the damage; the first tells it
                yield self.damage(base_name(path), f"{type(error).__name__}: {error}")

    def damage(self, name: str, error: str) -> pa.RecordBatch:
        """The row about a damaged file."""
        known = {"granule_id": name, "error": error}
        schema = self.fields.append(pa.field("error", pa.string())) if self.report else self.fields
        return pa.RecordBatch.from_arrays([pa.array([known.get(f.name)], f.type) for f in schema], schema=schema)

    def pixels(self, name: str, arrays: dict[str, np.ndarray], attrs: list, first_row: int, valid_range: list | None = None):
        schema = self.fields.append(pa.field("error", pa.string())) if self.report else self.fields
        return _pixels(name, arrays, {"attrs": attrs, "valid_range": valid_range}, schema, first_row, self.wanted if self.filters else None)

    def rows_of(self, file, names: dict[str, str], k: int, name: str, shape: tuple[int, int] | None = None) -> tuple[int, dict[str, np.ndarray]]:
        """The first row of split ``k`` and its rows of equally shaped datasets; only these are read."""
        sets = {column: file.select(dataset) for column, dataset in names.items()}
        shapes = {column: tuple(d.info()[2]) if not isinstance(d.info()[2], int) else (d.info()[2],) for column, d in sets.items()}
        first = next(iter(shapes))
        for column, found in shapes.items():
            if found != (shape or shapes[first]):
                raise ValueError(f"{name}: {column} is {found}, not {shape or shapes[first]}")
        low, high = self.row_span(shapes[first][0], k)
        width = shapes[first][1]
        return low, {column: np.asarray(d.get(start=(low, 0), count=(high - low, width))) if high > low else np.zeros((0, width)) for column, d in sets.items()}

    def opened(self, path: str):
        from pyhdf.SD import SD  # an optional library

        return SD(path)

    def batches(self, file, name: str, k: int):
        raise NotImplementedError


class Pushing:
    """Put before a reader's class, takes up the filters that Spark pushes. Spark refuses such a reader where its setting is off."""

    def pushFilters(self, filters):
        """Take up filters; all go back to Spark as well, since rows about damaged files pass whatever they say."""
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column == "granule_id" and isinstance(f, EqualTo | In):
                self.granules.append({f.value} if isinstance(f, EqualTo) else set(f.value))
            elif column in self.compared and type(f) in _COMPARE and isinstance(f.value, int):
                self.filters.append((column, type(f), f.value))
            yield f


class SwathReader(FileReader):
    """Pixels of swaths."""

    fields = pa.schema([("granule_id", pa.string()), ("row", pa.int32()), ("col", pa.int32()), ("raw", pa.int32()), ("qc", pa.int32()), _ATTRS])

    def batches(self, file, name, k):
        _present(file, name, SWATH)
        first, arrays = self.rows_of(file, {"raw": SWATH[0], "qc": SWATH[1]}, k, name)
        return self.pixels(name, arrays, _attributes(file.select(SWATH[0])), first)


class LocationReader(FileReader):
    """Coordinates of swaths, on their coarser grid."""

    fields = pa.schema([("granule_id", pa.string()), ("row", pa.int32()), ("col", pa.int32()), ("lat", pa.float64()), ("lon", pa.float64())])
    compared = ("row", "col")

    def batches(self, file, name, k):
        _present(file, name, SWATH)
        first, arrays = self.rows_of(file, {"lat": SWATH[2], "lon": SWATH[3]}, k, name)
        return self.pixels(name, arrays, [], first)


class GridReader(FileReader):
    """Cells of daily grids; without a view time in the file it is null. A split is 240 of the 3,600 rows by default."""

    fields = pa.schema([("granule_id", pa.string()), ("row", pa.int32()), ("col", pa.int32()), ("raw", pa.int32()), ("qc", pa.int32()), ("view", pa.int32()), _ATTRS, ("valid_range", pa.list_(pa.float64()))])
    compared = ("row", "col", "raw", "qc")
    shape = GRID_SHAPE
    splits = 15

    @property
    def height(self):
        return self.shape[0]

    def batches(self, file, name, k):
        _present(file, name, GRID)
        names = {"raw": GRID[0], "qc": GRID[1]} | ({"view": VIEW_TIME} if VIEW_TIME in file.datasets() else {})
        first, arrays = self.rows_of(file, names, k, name, self.shape)
        declared = file.select(GRID[0]).attributes().get("valid_range")
        span = None if declared is None else [float(x) for x in np.asarray(declared).reshape(-1)]
        return self.pixels(name, arrays, _attributes(file.select(GRID[0])), first, span)


def fire_pixels(file, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Latitudes and longitudes of a fire swath; a file without the datasets, or with empty ones, saw no fire."""
    if not set(FIRES) <= set(file.datasets()):
        return np.zeros(0), np.zeros(0)
    found = []
    for dataset in map(file.select, FIRES):
        empty = not np.all(dataset.info()[2])  # the library cannot get a dataset without values
        found.append(np.zeros(0) if empty else np.asarray(dataset.get(), np.float64).reshape(-1))
    if len(found[0]) != len(found[1]):
        raise ValueError(f"{name}: {len(found[0])} fire latitudes, {len(found[1])} longitudes")
    return found[0], found[1]


class FireReader(FileReader):
    """Fire pixels, a row each."""

    fields = pa.schema([("granule_id", pa.string()), ("fire_lat", pa.float64()), ("fire_lon", pa.float64())])
    compared = ()

    def batches(self, file, name, k):
        lat, lon = fire_pixels(file, name)
        if len(lat):
            schema = self.fields.append(pa.field("error", pa.string())) if self.report else self.fields
            columns = [pa.repeat(name, len(lat)), pa.array(lat), pa.array(lon), *([pa.nulls(len(lat), pa.string())] if self.report else [])]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)


class FireStatusReader(FileReader):
    """A row for each fire swath: ``applied`` with its fires, ``none`` for one that was read and saw no fire, ``unavailable`` for one that cannot be read."""

    fields = pa.schema([("granule_id", pa.string()), ("status", pa.string()), ("fires", pa.list_(pa.struct([("lat", pa.float64()), ("lon", pa.float64())]))), ("error", pa.string())])
    compared = ()

    def __init__(self, options: dict):
        super().__init__(options)
        self.report, self.splits = True, 1

    def row(self, name: str, status: str, fires: list | None, error: str | None) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((name, status, fires, error), self.fields, strict=True)], schema=self.fields)

    def damage(self, name, error):
        return self.row(name, "unavailable", None, error)

    def batches(self, file, name, k):
        lat, lon = fire_pixels(file, name)
        yield self.row(name, "applied" if len(lat) else "none", [{"lat": a, "lon": o} for a, o in zip(lat.tolist(), lon.tolist(), strict=True)], None)


class SwathSource(DataSource):
    """``spark.dataSource.register(SwathSource)``, then ``spark.read.format("swath").option("paths", "a.hdf,b.hdf").load()``."""

    reads: type[FileReader] = SwathReader
    ddl = "granule_id string, row int, col int, raw int, qc int, attrs map<string, double>"

    @classmethod
    def name(cls):
        return "swath"

    def schema(self):
        return self.ddl + (", error string" if self.options.get("damaged", "fail") == "report" and "error string" not in self.ddl else "")

    def reader(self, schema):
        pushed = self.options.get("pushdown", "false") == "true"
        return (type(self.reads.__name__, (Pushing, self.reads), {}) if pushed else self.reads)(self.options)


class LocationSource(SwathSource):
    """Coordinates of swaths, as format ``swath_locations``."""

    reads, ddl = LocationReader, "granule_id string, row int, col int, lat double, lon double"

    @classmethod
    def name(cls):
        return "swath_locations"


class GridSource(SwathSource):
    """Daily grids, as format ``daily_grid``."""

    reads, ddl = GridReader, "granule_id string, row int, col int, raw int, qc int, view int, attrs map<string, double>, valid_range array<double>"

    @classmethod
    def name(cls):
        return "daily_grid"


class FireSource(SwathSource):
    """Fire pixels of swaths, as format ``swath_fires``."""

    reads, ddl = FireReader, "granule_id string, fire_lat double, fire_lon double"

    @classmethod
    def name(cls):
        return "swath_fires"


class FireStatusSource(SwathSource):
    """What became of each fire swath, as format ``swath_fire_status``."""

    reads, ddl = FireStatusReader, "granule_id string, status string, fires array<struct<lat: double, lon: double>>, error string"

    @classmethod
    def name(cls):
        return "swath_fire_status"


FIRE_LISTS = f"{FIRES[0]} array<double>, {FIRES[1]} array<double>"


def fire_status_of_text(files: DataFrame) -> DataFrame:
    """The rows of ``FireStatusSource`` for fire swaths as JSON texts (granule_id, content), in column expressions.

    A text that is no JSON object, has values that are no numbers, or lists of different lengths is ``unavailable``; one without the lists, or with empty ones, is ``none``.
    """
    body = F.from_json("content", f"{FIRE_LISTS}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    rows = files.select("granule_id", "content", body.alias("b"))
    lat, lon = (F.coalesce(f"b.{c}", F.array().cast("array<double>")) for c in FIRES)
    both = F.col(f"b.{FIRES[0]}").isNotNull() & F.col(f"b.{FIRES[1]}").isNotNull()
    broken = F.col("content").isNull() | F.col("b").isNull() | F.col("b._bad").isNotNull()
    uneven = both & (F.size(lat) != F.size(lon))
    error = F.when(broken, "not readable").when(uneven, F.concat(F.size(lat).cast("string"), F.lit(" fire latitudes, "), F.size(lon).cast("string"), F.lit(" longitudes")))
    fires = F.when(error.isNull(), F.when(both, F.transform(F.arrays_zip(lat.alias("lat"), lon.alias("lon")), lambda x: F.struct(x["lat"].alias("lat"), x["lon"].alias("lon")))).otherwise(F.array().cast("array<struct<lat: double, lon: double>>")))
    status = F.when(error.isNotNull(), "unavailable").when(F.size(fires) > 0, "applied").otherwise("none")
    return rows.select("granule_id", status.alias("status"), fires.alias("fires"), error.alias("error"))


def with_fire_status(granules: DataFrame, statuses: DataFrame) -> DataFrame:
    """Granules (fire_id, ...) with the status of their fire swath and the quality note it earns.

    A granule without a fire swath, and one whose swath is not among the statuses, is ``unavailable`` as well: it goes in unmasked, and says so.
    """
    known = statuses.select(F.col("granule_id").alias("_fire"), "status", "fires")
    joined = granules.join(known, F.col("fire_id") == F.col("_fire"), "left").drop("_fire")
    status = F.coalesce("status", F.lit("unavailable"))
    note = F.concat(F.lit(S.QC_NOTE), F.when(status == "unavailable", S.FIRE_UNAVAILABLE_NOTE).otherwise(""))
    return joined.withColumns({"status": status, "qc_note": note})
