"""Screens: decode, quality, geolocation, volcanoes, fires, latitude, in this order.

A pixel is a row (pixel, seq, product, d, raw, qc, lat, lon); each screen sees only what the one before it left. All screens but the two
joins are column expressions of one scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heatledger import schema as S
from heatledger.functions import exprs as E


def decode(pixels: DataFrame, fill: int = 0) -> DataFrame:
    """Pixels with a valid temperature ``c``."""
    c = E.celsius(F.col("raw"))
    return pixels.filter(F.col("raw") != fill).withColumn("c", c).filter(F.col("c").between(S.VALID_MIN, S.VALID_MAX))


def quality(pixels: DataFrame, max_error_class: int = 1) -> DataFrame:
    return pixels.filter(E.qc_keep(F.col("qc"), max_error_class))


def located(pixels: DataFrame) -> DataFrame:
    """Pixels on the globe, with their one-degree tile."""
    on = pixels.filter(E.on_globe(F.col("lat"), F.col("lon")))
    return on.withColumns({"tile_lat": E.tile_lat(F.col("lat")), "tile_lon": E.tile_lon(F.col("lon"))})


def clean(pixels: DataFrame, max_error_class: int = 1) -> DataFrame:
    """Decoded, quality-screened and located pixels."""
    return located(quality(decode(pixels), max_error_class))


#: Cells along an edge of a one-degree tile, in which pixels meet vents; a cell is about as wide as most circles.
VENT_CELLS = 8


def _cell_lat(lat: Column) -> Column:
    """The cell's row; of NULL some row at the edge, where no distance holds."""
    return F.greatest(F.lit(-90 * VENT_CELLS), F.least(F.lit(90 * VENT_CELLS - 1), F.floor(lat * VENT_CELLS))).cast("int")


def _cell_lon(lon: Column) -> Column:
    return F.greatest(F.lit(-180 * VENT_CELLS), F.least(F.lit(180 * VENT_CELLS - 1), F.floor(lon * VENT_CELLS))).cast("int")


def vent_cells(vents: DataFrame) -> DataFrame:
    """Vents (vent, vent_lat, vent_lon, radius_km) once for each cell that their circle may touch, with a margin for rounding."""
    margin, half = 1e-9, 180 * VENT_CELLS
    dlat = F.col("radius_km") / S.KM_PER_DEGREE + margin
    dlon = F.col("radius_km") / (S.KM_PER_DEGREE * F.greatest(F.cos(F.radians("vent_lat")), E.dbl(1e-6))) + margin
    placed = vents.filter("vent_lat IS NOT NULL AND vent_lon IS NOT NULL AND radius_km IS NOT NULL")
    rows = placed.withColumn("at_lat", F.explode(F.sequence(_cell_lat(F.col("vent_lat") - dlat), _cell_lat(F.col("vent_lat") + dlat))))
    west, east = F.floor((F.col("vent_lon") - dlon) * VENT_CELLS), F.floor((F.col("vent_lon") + dlon) * VENT_CELLS)
    around = F.transform(F.sequence(west, F.greatest(west, east)), lambda x: (F.pmod(x + half, F.lit(2 * half)) - half).cast("int"))
    steps = F.when(east - west >= 2 * half - 1, F.sequence(F.lit(-half), F.lit(half - 1))).otherwise(around)
    return rows.withColumn("at_lon", F.explode(F.array_distinct(steps)))


def vent_matches(pixels: DataFrame, vents: DataFrame) -> DataFrame:
    """Distinct pixels within a vent's radius, with the nearest vent (the smallest name of equals)."""
    return with_nearest_vent(pixels, vents).filter("near IS NOT NULL").select(*pixels.columns, F.col("near.vent").alias("vent"), F.col("near.km").alias("km")).distinct()


def vents_by_cell(vents: DataFrame) -> DataFrame:
    """Rows (at_lat, at_lon, vents_here): the vents whose circles may touch a cell.

    Of vents with one place and radius only the smallest name can be the nearest, so an array is as long as there are different circles that touch its cell.
    """
    circles = vents.groupBy("vent_lat", "vent_lon", "radius_km").agg(F.min(F.struct("vent")).alias("v")).select("v.vent", "vent_lat", "vent_lon", "radius_km")
    return vent_cells(circles).groupBy("at_lat", "at_lon").agg(F.collect_list(F.struct("vent", "vent_lat", "vent_lon", "radius_km")).alias("vents_here"))


def with_nearest_vent(pixels: DataFrame, vents: DataFrame) -> DataFrame:
    """Pixels with ``near``: the nearest vent within its radius (km, vent), NULL for most.

    The vents of a cell of an eighth of a degree are one array, so each pixel meets at most one row: an equi-join that neither multiplies nor regroups pixels.
    A distance is computed once a pixel and vent.
    """
    there = pixels.join(vents_by_cell(vents), (_cell_lat(F.col("lat")) == F.col("at_lat")) & (_cell_lon(F.col("lon")) == F.col("at_lon")), "left")
    measured = F.transform("vents_here", lambda v: F.struct(E.flat_km(F.col("lat"), F.col("lon"), v["vent_lat"], v["vent_lon"]).alias("km"), v["vent"].alias("vent"), v["radius_km"].alias("radius_km")))
    inside = F.filter(measured, lambda v: v["km"] <= v["radius_km"])
    near = F.array_min(F.transform(inside, lambda v: F.struct(v["km"].alias("km"), v["vent"].alias("vent"))))
    return there.withColumn("near", near).drop("at_lat", "at_lon", "vents_here")


def fire_bins(fires: DataFrame) -> DataFrame:
    """Distinct bins of fire detections (lat, lon) and of their eight neighbours."""
    base = fires.select(E.fire_bin(F.col("lat"), F.col("lon")).alias("bin")).distinct()
    offsets = F.array(*[F.lit(dy * S.FIRE_STRIDE + dx).cast("long") for dy in (-1, 0, 1) for dx in (-1, 0, 1)])
    return base.select(F.explode(F.transform(offsets, lambda o: F.col("bin") + o)).alias("bin")).distinct()


def route(pixels: DataFrame, vents: DataFrame, bins: DataFrame) -> DataFrame:
    """Clean pixels with ``route``: volcanic, wildfire, implausible or weather, and the vent of volcanic ones."""
    marked = with_nearest_vent(pixels, vents).withColumn("vent", F.col("near.vent")).drop("near")
    burning = bins.select(F.col("bin").alias("fire_bin"))
    marked = marked.join(burning, E.fire_bin(F.col("lat"), F.col("lon")) == F.col("fire_bin"), "left")
    kind = F.when(F.col("vent").isNotNull(), "volcanic").when(F.col("fire_bin").isNotNull(), "wildfire").when(~E.plausible(F.col("lat"), F.col("c")), "implausible").otherwise("weather")
    return marked.withColumn("route", kind).drop("fire_bin")


def drop_counters(pixels: DataFrame) -> DataFrame:
    """Counts of each screen for each day and product."""
    good, fine = E.qc_keep(F.col("qc")), E.plausible(F.col("lat"), F.col("c"))
    return decode(pixels).groupBy("product", "d").agg(F.count(F.lit(1)).alias("valid"), F.count_if(~good).alias("qc_dropped"), F.count_if(good & ~fine).alias("implausible"))


def expand_geolocation(fine: DataFrame, geo: DataFrame, sizes: tuple[int, int, int, int]) -> DataFrame:
    """Fine pixels (row, col) with the coordinates of the nearest coarse point (srow, scol, lat, lon).

    ``sizes``: coarse rows and columns, fine rows and columns. The coarse index is computed, so this is an equi-join.
    """
    nr, nc, fr, fc = sizes

    def index(i, source: int, target: int):
        return E.clip(F.rint((i + 0.5) * source / target - 0.5), 0, source - 1).cast("int")

    keyed = fine.withColumns({"srow": index(F.col("row"), nr, fr), "scol": index(F.col("col"), nc, fc)})
    return keyed.join(geo, ["srow", "scol"])
