"""The read side: latest run, leaderboards, filters, the anomaly panel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heatledger.functions import exprs as E
from heatledger.operators.places import named


def latest_run(runs: DataFrame) -> DataFrame:
    """The newest succeeded run."""
    return runs.filter("status = 'succeeded'").orderBy(F.desc("reading_date"), F.desc("started_at"), "id").limit(1)


def by_tile(readings: DataFrame) -> DataFrame:
    """One reading for each day and tile, the hottest; of equals the smaller product."""
    order = Window.partitionBy("d", "tile_lat", "tile_lon").orderBy(F.desc("max_c"), "product")
    return readings.withColumn("place", F.row_number().over(order)).filter("place = 1").drop("place")


def in_area(area: str, view: tuple[float, float, float, float] | None = None) -> Column:
    """Filter of an area: everywhere, view, north, south or a continent."""
    lat, lon = F.col("max_lat"), F.col("max_lon")
    if area == "everywhere" or (area == "view" and view is None):
        return F.lit(True)
    if area == "view":
        return E.in_box(lat, lon, *view)
    if area in ("north", "south"):
        return lat >= 0 if area == "north" else lat < 0
    return F.coalesce(E.continent(lat, lon) == area, F.lit(False))


def in_period(period: str, today: str | None = None) -> Column:
    """Filter of a period: all, a decade such as 2010s, or year (the twelve months up to ``today``)."""
    if period == "all":
        return F.lit(True)
    if period == "year":
        return F.col("d") >= F.add_months(F.lit(today).cast("date") if today else F.current_date(), -12)
    start = int(period[:4])
    return F.year("d").between(start, start + 9)


def leaderboard(readings: DataFrame, *conditions: Column, top: int = 10) -> DataFrame:
    """The hottest readings that pass all conditions."""
    for c in conditions:
        readings = readings.filter(c)
    return readings.orderBy(F.desc("max_c"), "tile_lat", "tile_lon", "d", "product").limit(top)


def leaderboards(readings: DataFrame, board: Column, top: int = 10) -> DataFrame:
    """The hottest readings of each value of ``board`` at once; rows without a value are on none."""
    order = Window.partitionBy("board").orderBy(F.desc("max_c"), "tile_lat", "tile_lon", "d", "product")
    return readings.withColumn("board", board).filter("board IS NOT NULL").withColumn("place", F.row_number().over(order)).filter(F.col("place") <= top).drop("place")


def anomaly_panel(anomalies: DataFrame, condition: Column, loaded: int = 50, shown: int = 5) -> DataFrame:
    """The panel's rows: the hottest ``loaded`` first, then the filter, then the hottest ``shown``; limit and filter do not commute."""
    order = [F.desc("max_c"), "cause", "tile_lat", "tile_lon", "d", "product"]
    return anomalies.orderBy(*order).limit(loaded).filter(condition).orderBy(*order).limit(shown)


def with_vent(anomalies: DataFrame, vents: DataFrame) -> DataFrame:
    """Anomalies with the vent's name and country and the name to show: vent, place, or coordinates."""
    v = vents.select(F.col("vent"), F.col("name").alias("vent_name"), F.col("country").alias("vent_country"))
    joined = anomalies.join(v, F.col("source") == F.col("vent"), "left")
    place = F.col("place_name") if "place_name" in anomalies.columns else F.lit(None).cast("string")
    shown = F.coalesce(F.concat("vent_name", F.lit(", "), "vent_country"), place, E.coordinates(F.col("max_lat"), F.col("max_lon")))
    return joined.withColumn("display_name", shown).drop("vent")


def extent(readings: DataFrame) -> DataFrame:
    """One row: the box around the readings and their number."""
    return readings.agg(F.min("max_lon").alias("west"), F.min("max_lat").alias("south"), F.max("max_lon").alias("east"), F.max("max_lat").alias("north"), F.count(F.lit(1)).alias("shown"))


def reading_rows(readings: DataFrame) -> DataFrame:
    """Readings as the store keeps them: two decimals of temperature, six of position, the product's satellite."""
    return readings.select(
        F.col("d").alias("reading_date"), E.product_value(F.col("product"), 1).alias("satellite"), "product", F.col("tile_lat").cast("smallint").alias("tile_lat"), F.col("tile_lon").cast("smallint").alias("tile_lon"),
        F.col("max_c").cast("decimal(5,2)").alias("max_c"), F.round("max_lat", 6).alias("max_lat"), F.round("max_lon", 6).alias("max_lon"),
    )


def anomaly_rows(anomalies: DataFrame, places: DataFrame, vents: DataFrame) -> DataFrame:
    """Anomalies as the store keeps them: the measurement as in ``reading_rows``, cause, the vent's slug where it is volcanic, else the place of its cell."""
    slugs = vents.select(F.col("vent").alias("_vent"), F.col("slug"))
    joined = named(anomalies, places).join(slugs, (F.col("source") == F.col("_vent")) & (F.col("cause") == "volcanic"), "left")
    return joined.select(
        F.col("d").alias("reading_date"), E.product_value(F.col("product"), 1).alias("satellite"), "product", F.col("tile_lat").cast("smallint").alias("tile_lat"), F.col("tile_lon").cast("smallint").alias("tile_lon"),
        F.col("max_c").cast("decimal(5,2)").alias("max_c"), F.round("max_lat", 6).alias("max_lat"), F.round("max_lon", 6).alias("max_lon"), "place_name", "country", "cause", F.col("slug").alias("source_slug"),
    )


def geojson(readings: DataFrame) -> DataFrame:
    """A closed one-degree square for each reading, as GeoJSON text."""
    lat, lon = F.col("tile_lat"), F.col("tile_lon")
    ring = F.array(*[F.array(lon + dx, lat + dy) for dx, dy in ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))])
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"), F.struct("max_c", "product").alias("properties"))
    return readings.select("d", "product", "tile_lat", "tile_lon", F.to_json(feature).alias("feature"))


def stale(latest: Column, now: Column, days: float = 2.5) -> Column:
    """Whether the midnight that starts the latest day is more than ``days`` ago."""
    return (F.unix_timestamp(now) - F.unix_timestamp(latest.cast("timestamp"))) > days * 86400


def complete_days(readings: DataFrame, products: list[str]) -> DataFrame:
    """Readings of the days that have all products: corroboration of a day waits for both satellites."""
    whole = readings.filter(F.col("product").isin(products)).groupBy("d").agg(F.count_distinct("product").alias("n")).filter(F.col("n") == len(products))
    return readings.join(whole.select("d"), "d", "left_semi")
