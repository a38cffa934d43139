"""The permanent archive: all-time maxima by tile, its history and its daily changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

def records(readings: DataFrame) -> DataFrame:
    """The all-time maximum of each tile; of equals the earliest day, then the smallest product."""
    best = F.min(F.struct((-F.col("max_c")).alias("m"), F.col("d"), F.col("product"), F.col("max_lat"), F.col("max_lon"))).alias("best")
    rows = readings.groupBy("tile_lat", "tile_lon").agg(best)
    return rows.select("tile_lat", "tile_lon", (-F.col("best.m")).alias("max_c"), F.col("best.d").alias("record_date"), F.col("best.product").alias("product"), F.col("best.max_lat").alias("max_lat"), F.col("best.max_lon").alias("max_lon"))


def cutoff(archive: DataFrame, threshold: float = 40.0, top: int = 10) -> DataFrame:
    """One row: the coolest maximum that still earns a row, ``threshold`` for an empty archive.

    An archive has at most 64,800 tiles. The hot ones are a prefix of the order, so the answer is the minimum of the
    hot values or the ``top``-th value, whichever is lower.
    """
    hot = archive.agg(F.count_if(F.col("max_c") >= threshold).alias("n"), F.min(F.when(F.col("max_c") >= threshold, F.col("max_c"))).alias("low"))
    last = archive.orderBy(F.desc("max_c")).limit(top).agg(F.min("max_c").alias("tenth"))
    value = F.when(F.col("n") >= top, F.col("low")).otherwise(F.coalesce("tenth", F.lit(threshold)))
    return hot.join(last, F.lit(True)).select(value.alias("cutoff"))


def upserts(archive: DataFrame, today: DataFrame, threshold: float = 40.0, top: int = 10) -> DataFrame:
    """Today's readings that beat their tile's record and clear the archive's bar."""
    old = archive.select("tile_lat", "tile_lon", F.col("max_c").alias("old_c"))
    both = today.join(old, ["tile_lat", "tile_lon"], "left")
    improved = both.filter(F.col("old_c").isNull() | (F.col("max_c") > F.col("old_c"))).drop("old_c")
    merged = archive.select("tile_lat", "tile_lon", "max_c").unionByName(today.select("tile_lat", "tile_lon", "max_c")).groupBy("tile_lat", "tile_lon").agg(F.max("max_c").alias("max_c"))
    return improved.join(F.broadcast(cutoff(merged, threshold, top)), F.col("max_c") >= F.col("cutoff")).drop("cutoff")


def running(readings: DataFrame) -> DataFrame:
    """Every day's archive in one pass: each tile's maximum up to each of its days, and whether that day set a record."""
    days = readings.groupBy("tile_lat", "tile_lon", "d").agg(F.max("max_c").alias("max_c"))
    order = Window.partitionBy("tile_lat", "tile_lon").orderBy("d")
    before = F.max("max_c").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return days.withColumns({"alltime_c": F.max("max_c").over(order.rowsBetween(Window.unboundedPreceding, 0)), "is_record": before.isNull() | (F.col("max_c") > before)})


def merge(archive: DataFrame, incoming: DataFrame) -> DataFrame:
    """The archive after folding readings in, in the order of ``records``: equal to that of all readings at once, in whatever batches they came.

    Folding again changes nothing. An equal maximum of a later day never replaces the one that is stored.
    """
    old = archive.select("tile_lat", "tile_lon", F.col("max_c"), F.col("record_date").alias("d"), "product", "max_lat", "max_lon")
    new = incoming.select("tile_lat", "tile_lon", "max_c", "d", "product", "max_lat", "max_lon")
    order = F.struct((-F.col("max_c")).alias("m"), F.col("d"), F.col("product"), F.col("max_lat"), F.col("max_lon"))
    best = old.unionByName(new).groupBy("tile_lat", "tile_lon").agg(F.min(order).alias("best"))
    return best.select("tile_lat", "tile_lon", (-F.col("best.m")).alias("max_c"), F.col("best.d").alias("record_date"), F.col("best.product").alias("product"), F.col("best.max_lat").alias("max_lat"), F.col("best.max_lon").alias("max_lon"))


def manifest(archive: DataFrame, prior_since: str | None, prior_through: str | None, target: str) -> DataFrame:
    """One row of bookkeeping: dates never move inward, malformed earlier ones count as absent."""
    day = F.lit(target).cast("date")
    since = F.least(day, F.coalesce(F.try_to_date(F.lit(prior_since)), day)) if prior_since is not None else day
    through = F.greatest(day, F.coalesce(F.try_to_date(F.lit(prior_through)), day)) if prior_through is not None else day
    return archive.agg(F.count(F.lit(1)).alias("tiles"), F.max("max_c").alias("max_c")).withColumns({"since": since, "through": through})


def daily_manifest(levels: DataFrame, day: str, generated_at: str, template: str, zooms: tuple[int, int] = (0, 7)) -> DataFrame:
    """One row (manifest): a day's manifest as JSON with its number of tiles; the keys and their order are fixed."""
    tiles = levels.select("z", F.shiftright("px", 8), F.shiftright("py", 8)).distinct().agg(F.count(F.lit(1)).alias("tile_count"))
    fields = {"date": day, "generated_at": generated_at, "min_zoom": zooms[0], "max_zoom": zooms[1], "tile_url_template": template}
    return tiles.select(F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in fields.items()], "tile_count")).alias("manifest"))
