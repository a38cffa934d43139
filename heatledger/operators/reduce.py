"""Arg-max reductions of pixels to tiles, and the daily selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heatledger import schema as S

READING = ["max_c", "max_lat", "max_lon"]


def tile_maxima(pixels: DataFrame, *keys: str) -> DataFrame:
    """The hottest pixel of each tile and ``keys``; of equals that with the largest pixel number.

    A max over a struct is a partial aggregation, so only one row a tile and task is shuffled.
    """
    best = F.max(F.struct("c", "pixel", "lat", "lon")).alias("best")
    rows = pixels.groupBy(*keys, "tile_lat", "tile_lon").agg(best)
    return rows.select(*keys, "tile_lat", "tile_lon", F.col("best.c").alias("max_c"), F.col("best.lat").alias("max_lat"), F.col("best.lon").alias("max_lon"))


def routed_maxima(routed: DataFrame, *keys: str) -> DataFrame:
    """Weather maxima with the note of what other pixels of the tile were screened out."""
    weather = F.col("route") == "weather"
    best = F.max(F.when(weather, F.struct("c", "pixel", "lat", "lon"))).alias("best")
    flags = {"volcanic": S.VOLCANIC_MASKED_NOTE, "wildfire": S.FIRE_MASKED_NOTE, "implausible": S.HIGH_LATITUDE_NOTE}
    rows = routed.groupBy(*keys, "tile_lat", "tile_lon").agg(best, *[F.bool_or(F.col("route") == name).alias(name) for name in flags]).filter("best IS NOT NULL")
    note = F.concat(F.lit(S.QC_NOTE), *[F.when(F.col(name), text).otherwise("") for name, text in flags.items()])
    return rows.select(*keys, "tile_lat", "tile_lon", F.col("best.c").alias("max_c"), F.col("best.lat").alias("max_lat"), F.col("best.lon").alias("max_lon"), note.alias("qc_note"))


def day_merge(granules: DataFrame) -> DataFrame:
    """Tile maxima of granules folded into days; of equal maxima the granule processed first stays."""
    order = F.struct(F.col("max_c"), (-F.col("seq")).alias("first"), *READING[1:])
    rows = granules.groupBy("d", "product", "tile_lat", "tile_lon").agg(F.max(order).alias("best"))
    return rows.select("d", "product", "tile_lat", "tile_lon", F.col("best.max_c").alias("max_c"), (-F.col("best.first")).cast("int").alias("seq"), F.col("best.max_lat").alias("max_lat"), F.col("best.max_lon").alias("max_lon"))


def reported(tiles: DataFrame, threshold: float = 40.0, top: int = 10) -> DataFrame:
    """Tiles of each day and product at or above the threshold, and the hottest ``top`` in any case.

    Both sets are prefixes of one order. A day has at most 64,800 tiles, so a window's partition is bounded.
    """
    day = Window.partitionBy("d", "product")
    ranked = day.orderBy(F.desc("max_c"), "tile_lat", "tile_lon")
    marked = tiles.withColumns({"place": F.row_number().over(ranked), "hot": F.count_if(F.col("max_c") >= threshold).over(day)})
    return marked.filter(F.col("place") <= F.greatest(F.col("hot"), F.lit(top))).drop("hot")


def anomalies(routed: DataFrame, *keys: str) -> DataFrame:
    """Hottest excluded pixel of each tile and cause, where it reaches the cause's floor."""
    floor = F.when(F.col("cause") == "volcanic", S.VOLCANIC_FLOOR).otherwise(S.WILDFIRE_FLOOR)
    apart = routed.filter(F.col("route").isin("volcanic", "wildfire")).withColumn("cause", F.col("route"))
    best = F.max(F.struct("c", "pixel", "lat", "lon", "vent")).alias("best")
    rows = apart.groupBy(*keys, "tile_lat", "tile_lon", "cause").agg(best)
    out = rows.select(*keys, "tile_lat", "tile_lon", "cause", F.col("best.c").alias("max_c"), F.col("best.lat").alias("max_lat"), F.col("best.lon").alias("max_lon"), F.when(F.col("cause") == "volcanic", F.col("best.vent")).alias("source"))
    return out.filter(F.col("max_c") >= floor)


def summary(routed: DataFrame, *keys: str) -> DataFrame:
    """What tiles and anomalies need of routed pixels, in one grouping: the hottest pixel of each tile and ``keys``, and the hottest volcanic and burning ones."""
    pixel = F.struct("c", "pixel", "lat", "lon", "vent")
    of = {"best": pixel} | {name: F.when(F.col("route") == name, pixel) for name in ("volcanic", "wildfire")}
    return routed.groupBy(*keys, "tile_lat", "tile_lon").agg(*[F.max(x).alias(name) for name, x in of.items()])


def tiles_of(summed: DataFrame, *keys: str) -> DataFrame:
    """The rows of ``tile_maxima`` for a summary."""
    return summed.select(*keys, "tile_lat", "tile_lon", F.col("best.c").alias("max_c"), F.col("best.lat").alias("max_lat"), F.col("best.lon").alias("max_lon"))


def anomalies_of(summed: DataFrame, *keys: str) -> DataFrame:
    """The rows of ``anomalies`` for a summary by ``keys`` and others."""
    apart = F.filter(F.array(*[F.struct(F.lit(c).alias("route"), F.col(c).alias("p")) for c in ("volcanic", "wildfire")]), lambda x: x["p"].isNotNull())
    rows = summed.select(*keys, "tile_lat", "tile_lon", F.explode(apart).alias("x")).select(*keys, "tile_lat", "tile_lon", "x.route", "x.p.*")
    return anomalies(rows, *keys)
