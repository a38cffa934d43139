"""Captured catalogue feeds: nested JSON to granule references, first of each id, paired with fire granules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heatledger.functions import exprs as E

LINK = "struct<rel:string,href:string,inherited:boolean>"
ENTRY = f"struct<producer_granule_id:string,title:string,time_start:string,updated:string,links:array<{LINK}>>"
#: Fixed allow-list of storage buckets.
BUCKETS = ("lp-prod-protected", "lp-prod-public")


def _host_ok(href: Column) -> Column:
    host = F.lower(F.try_parse_url(href, F.lit("HOST")))
    return F.coalesce((host == "nasa.gov") | host.endswith(".nasa.gov"), F.lit(False))


def data_link(link: Column) -> Column:
    """An own HTTP link to an HDF file on an allowed host."""
    href = F.lower(link["href"])
    return ~F.coalesce(link["inherited"], F.lit(False)) & link["rel"].endswith("/data#") & href.startswith("http") & href.endswith(".hdf") & _host_ok(link["href"])


def s3_link(link: Column) -> Column:
    bucket = F.regexp_extract(link["href"], "^s3://([^/]+)/", 1)
    return ~F.coalesce(link["inherited"], F.lit(False)) & (link["rel"].endswith("/data#") | link["rel"].endswith("/s3#")) & F.lower(link["href"]).endswith(".hdf") & bucket.isin(*BUCKETS)


def parse(feeds: DataFrame) -> DataFrame:
    """Rows (feed, pos, granule_id, url, observed_at, s3_url) of feeds (feed, body), without entries that have no link or time."""
    body = F.from_json("body", f"feed struct<entry:array<{ENTRY}>>")
    rows = feeds.select("feed", F.posexplode(body["feed"]["entry"]).alias("pos", "e"))
    url = F.get(F.filter("e.links", data_link), F.lit(0))["href"]
    blank = lambda c: F.nullif(F.col(c), F.lit(""))
    out = rows.withColumn("url", url).filter("url IS NOT NULL")
    name = F.coalesce(blank("e.producer_granule_id"), blank("e.title"), F.element_at(F.split("url", "/"), -1))
    return out.select("feed", "pos", name.alias("granule_id"), "url", F.coalesce(blank("e.time_start"), blank("e.updated")).alias("observed_at"), F.get(F.filter("e.links", s3_link), F.lit(0))["href"].alias("s3_url")).filter("observed_at IS NOT NULL")


#: Fixed relation of a grid's own data link.
DATA_REL = "http://esipfed.org/ns/fedsearch/1.1/data#"


def parse_grids(feeds: DataFrame) -> DataFrame:
    """Rows (feed, pos, granule_id, url, time_start) of feeds (feed, body) of daily grids: links match the data relation exactly, entries need no time, the first of each id in a feed counts."""
    body = F.from_json("body", f"feed struct<entry:array<{ENTRY}>>")
    rows = feeds.select("feed", F.posexplode(body["feed"]["entry"]).alias("pos", "e"))
    own = lambda link: data_link(link) & (link["rel"] == DATA_REL)
    out = rows.withColumn("url", F.get(F.filter("e.links", own), F.lit(0))["href"]).filter("url IS NOT NULL")
    blank = lambda c: F.nullif(F.col(c), F.lit(""))
    name = F.coalesce(blank("e.producer_granule_id"), blank("e.title"), F.element_at(F.split("url", "/"), -1))
    refs = out.select("feed", "pos", name.alias("granule_id"), "url", F.coalesce("e.time_start", F.lit("")).alias("time_start"))
    return refs.withColumn("nth", F.row_number().over(Window.partitionBy("feed", "granule_id").orderBy("pos"))).filter("nth = 1").drop("nth")


def grid_of_day(refs: DataFrame) -> DataFrame:
    """The one grid of each feed, the first listed; feeds of days without a grid have no row."""
    return refs.groupBy("feed").agg(F.min_by(F.struct("pos", "granule_id", "url", "time_start"), "pos").alias("r")).select("feed", "r.*")


def first_of_each(refs: DataFrame, key: str = "granule_id") -> DataFrame:
    """The first row of each key in feed order."""
    order = Window.partitionBy(key).orderBy("feed", "pos")
    return refs.filter(F.col(key).isNotNull()).withColumn("nth", F.row_number().over(order)).filter("nth = 1").drop("nth")


def pair_fires(refs: DataFrame, fires: DataFrame | None) -> DataFrame:
    """Granules with their fire granule by overpass stamp and ``fire_status``: off, unavailable or applied."""
    stamped = refs.withColumn("stamp", E.overpass_stamp(F.col("granule_id")))
    if fires is None:
        return stamped.withColumns({"fire_id": F.lit(None).cast("string"), "fire_status": F.lit("off")})
    stamps = first_of_each(fires.withColumn("stamp", E.overpass_stamp(F.col("granule_id"))), "stamp")
    joined = stamped.join(stamps.select("stamp", F.col("granule_id").alias("fire_id")), "stamp", "left")
    return joined.withColumn("fire_status", F.when(F.col("fire_id").isNull(), "unavailable").otherwise("applied"))


def at_most(refs: DataFrame, n: int | None) -> DataFrame:
    """The first ``n`` granules in feed order, all for None."""
    return refs if n is None else refs.orderBy("feed", "pos").limit(n)
