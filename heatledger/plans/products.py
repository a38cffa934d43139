"""Registered queries of formats, manifests, dimensions and round trips, and their DuckDB counterparts."""

from __future__ import annotations

from pyspark.sql import functions as F

from heatledger.functions import exprs as E
from heatledger.operators import archive, grid, places, raster, readmodel, reduce, worklist
from heatledger.plans import bindings as B
from heatledger.plans import catalogue as C
from heatledger.plans import sql as Q
from heatledger.plans.catalogue import _FEED, _FIRST, _HOT, GRID, RECORDS, TILES, P, query
from heatledger.sources import feed, granules, logs, tables, vents


@query("vents_parse", """SELECT 'v' || s_suppkey AS slug, s_name AS name, CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE 'c' || s_nationkey END AS country, s_suppkey % 90 + 0.5E0 AS vent_lat, s_suppkey % 180 + 0.25E0 AS vent_lon,
CASE WHEN s_suppkey % 3 = 0 THEN 7.0E0 ELSE s_suppkey % 9 + 1.0E0 END AS radius_km FROM supplier WHERE s_suppkey % 11 <> 0 AND s_suppkey % 13 <> 0""")
def _(spark, sf):
    """Suppliers as JSON entries, some without a slug, some with a latitude that is no number."""
    k = F.col("s_suppkey")
    lat = F.when(k % 13 == 0, "north").otherwise(F.format_string("%.1f", k % 90 + 0.5))
    entry = F.to_json(F.struct(
        F.when(k % 11 != 0, F.concat(F.lit("v"), k)).alias("slug"), F.col("s_name").alias("name"), F.when(k % 4 != 0, F.concat(F.lit("c"), "s_nationkey")).alias("country"),
        lat.alias("lat"), (k % 180 + 0.25).alias("lon"), F.when(k % 3 != 0, k % 9 + 1).alias("radius_km")))
    return vents.parse(B.table(spark, sf, "supplier").select(entry.alias("value"))).select("slug", "name", "country", "vent_lat", "vent_lon", "radius_km")


@query("anomaly_places", Q.ctes(P, Q.FIRES, Q.VENTS, Q.ROUTED, Q.ANOMALIES, Q.PLACES) + f"""SELECT d, product, tile_lat, tile_lon, cause, max_c, place_name, country FROM anomalies
LEFT JOIN places ON cause <> 'volcanic' AND {Q.cell('max_lat')} = cell_lat AND {Q.cell('max_lon')} = cell_lon""")
def _(spark, sf):
    rows = places.named(reduce.anomalies(C._routed(spark, sf), "d", "product"), B.places(spark, sf))
    return rows.select("d", "product", "tile_lat", "tile_lon", "cause", "max_c", "place_name", "country")


@query("daily_manifest", Q.ctes(P, Q.RASTER.replace("FROM k WHERE c >= 40", "FROM k WHERE c >= 40 AND d = DATE '2000-01-01'")) + """SELECT '{"date":"2000-01-01","generated_at":"2000-01-02T00:00:00+00:00","min_zoom":0,"max_zoom":7,"tile_url_template":"{z}/{x}/{y}.png","tile_count":' || (SELECT count(*) FROM (SELECT DISTINCT z, px >> 8, py >> 8 FROM levels)) || '}' AS manifest""")
def _(spark, sf):
    day = raster.pyramid(raster.base(C._clean(spark, sf).filter("d = DATE '2000-01-01'")))
    return archive.daily_manifest(day, "2000-01-01", "2000-01-02T00:00:00+00:00", "{z}/{x}/{y}.png")


@query("format_values", """SELECT event_id, printf('%.1f', value + 0.003E0) || ' °C' AS celsius, printf('%.1f', (value + 0.003E0)*1.8E0 + 32) || ' °F' AS fahrenheit, strftime(ts, '%b %-d, %Y') AS day, strftime(ts, '%b %-d') || ', ' || strftime(ts, '%H:%M') || ' UTC' AS moment, strftime(ts, '%b %Y') AS month FROM events""")
def _(spark, sf):
    c, at = F.col("value") + E.dbl(0.003), F.col("ts").cast("timestamp")
    return B.table(spark, sf, "events").select("event_id", E.temperature_text(c).alias("celsius"), E.temperature_text(c, "F").alias("fahrenheit"), E.day_text(at).alias("day"), E.moment_text(at).alias("moment"), E.month_text(at).alias("month"))


@query("format_coordinates", TILES + "SELECT d, product, tile_lat, tile_lon, printf('%.1f', abs(max_lat)) || CASE WHEN max_lat >= 0 THEN '°N ' ELSE '°S ' END || printf('%.1f', abs(max_lon)) || CASE WHEN max_lon >= 0 THEN '°E' ELSE '°W' END AS shown FROM tiles")
def _(spark, sf):
    return C._days(spark, sf).select("d", "product", "tile_lat", "tile_lon", E.coordinates(F.col("max_lat"), F.col("max_lon")).alias("shown"))


@query("bbox_text", "SELECT o_orderkey, (o_orderkey % 360 - 180) || ',' || (o_orderkey % 90) || '.5,' || (o_orderkey % 360 - 179) || ',' || (o_orderkey % 90 + 1) || '.25' AS arg FROM orders")
def _(spark, sf):
    k = F.col("o_orderkey")
    return B.table(spark, sf, "orders").select("o_orderkey", E.bbox_text(k % 360 - 180.0, k % 90 + 0.5, k % 360 - 179.0, k % 90 + 1.25).alias("arg"))


@query("granule_products", Q.ctes(_FEED) + "SELECT feed, pos, CASE WHEN split_part(granule_id, '.', 1) IN ('MOD11_L2', 'MYD11_L2') THEN split_part(granule_id, '.', 1) END AS product FROM refs")
def _(spark, sf):
    return feed.parse(B.feeds(spark, sf)).select("feed", "pos", E.product_of_granule(F.col("granule_id")).alias("product"))


@query("max_granules", Q.ctes(_FEED) + _FIRST + " SELECT feed, pos, granule_id FROM firsts ORDER BY feed, pos LIMIT 25")
def _(spark, sf):
    """The first granules in feed order, as many as a run may take; the limit is what is asked for."""
    return feed.at_most(feed.first_of_each(feed.parse(B.feeds(spark, sf))), 25).select("feed", "pos", "granule_id")


@query("view_time_hours", "SELECT event_id, CASE WHEN user_id % 256 <> 255 THEN CAST(user_id % 256 AS DOUBLE)*0.2E0 END AS hours FROM events")
def _(spark, sf):
    return B.table(spark, sf, "events").select("event_id", granules.view_hours((F.col("user_id") % 256).cast("double")).alias("hours"))


@query("scaling_resolve", "SELECT event_id, 0.02E0 AS scale, CASE WHEN event_id % 2 = 0 THEN -1.5E0 ELSE 0.0E0 END AS \"offset\", 0.0E0 AS fill FROM events")
def _(spark, sf):
    k = F.col("event_id")
    attrs = F.create_map(F.lit("scale_factor"), E.dbl(0.02), F.when(k % 2 == 0, "add_offset").otherwise("unit"), E.dbl(-1.5))
    return granules.checked_scaling(B.table(spark, sf, "events").select("event_id", attrs.alias("attrs"))).select("event_id", "scale", "offset", "fill")


@query("hotspot_markers", TILES + "SELECT d, product, tile_lat, tile_lon, max_c FROM tiles ORDER BY max_c DESC, tile_lat, tile_lon, d, product LIMIT 3")
def _(spark, sf):
    return readmodel.leaderboard(C._days(spark, sf), top=3).select("d", "product", "tile_lat", "tile_lon", "max_c")


@query("header_records", RECORDS + "SELECT tile_lat, tile_lon, max_c, record_date, product FROM records ORDER BY max_c DESC, tile_lat, tile_lon LIMIT 3")
def _(spark, sf):
    rows = C._archive(spark, sf).withColumnRenamed("record_date", "d")
    return readmodel.leaderboard(rows, top=3).select("tile_lat", "tile_lon", "max_c", F.col("d").alias("record_date"), "product")


@query("job_log_lines", """SELECT strftime(d, '%Y-%m-%d') || ' ' || string_agg(product || '=' || code, ' ' ORDER BY product) AS line FROM (SELECT CAST(ts AS DATE) AS d, event_type AS product, max(user_id % 3) AS code FROM events GROUP BY ALL) GROUP BY d""")
def _(spark, sf):
    codes = B.table(spark, sf, "events").groupBy(F.col("ts").cast("date").alias("d"), F.col("event_type").alias("product")).agg(F.max(F.col("user_id") % 3).alias("code"))
    return logs.lines(codes).select("line")


@query("run_log_close", """SELECT s.user_id AS run, coalesce(f.status, 'running') AS status FROM (SELECT DISTINCT user_id FROM events) s
LEFT JOIN (SELECT user_id, arg_max(event_type, (ts, event_type)) AS status FROM events WHERE event_type <> 'view' GROUP BY ALL) f USING (user_id)""")
def _(spark, sf):
    ev = B.table(spark, sf, "events").withColumnRenamed("user_id", "run")
    done = ev.filter("event_type <> 'view'").groupBy("run", F.col("ts").alias("finished_at")).agg(F.max("event_type").alias("status"))
    return tables.run_log(ev.select("run").distinct(), done).select("run", "status")


@query("days_both_flew", TILES + """SELECT d, product, tile_lat, tile_lon, max_c FROM tiles WHERE d IN (SELECT d FROM tiles GROUP BY d HAVING count(DISTINCT product) = 2)""")
def _(spark, sf):
    return readmodel.complete_days(C._days(spark, sf), ["MOD11_L2", "MYD11_L2"]).select("d", "product", "tile_lat", "tile_lon", "max_c")


@query("candidate_csv_round_trip", GRID + ", cand AS (SELECT product, d, \"row\", col, max(centi) AS centi FROM g WHERE centi >= 6000 GROUP BY ALL) SELECT product, d, round(89.975E0 - \"row\"*0.05E0, 3) AS cell_lat, round(-179.975E0 + col*0.05E0, 3) AS cell_lon, centi/100 AS max_c FROM cand")
def _(spark, sf):
    path = tables.scratch(spark, "candidates")
    grid.write_candidates(grid.candidates(grid.cells(C._clean(spark, sf, True)), 60.0), path)
    return grid.read_candidates(spark, path)


@query("tile_png_round_trip", Q.ctes(Q.pix(), Q.RASTER) + """SELECT z, CAST(px AS INT) AS px, CAST(py AS INT) AS py, CASE WHEN centi < 5000 THEN 1 WHEN centi < 5800 THEN 2 WHEN centi < 6600 THEN 3 WHEN centi < 7400 THEN 4 ELSE 5 END AS rank FROM levels""")
def _(spark, sf):
    return raster.read_tiles(raster.tiles(raster.pyramid(raster.base(C._clean(spark, sf)))))


@query("granule_estimate", GRID.replace("WITH ", "WITH RECURSIVE ", 1) + _HOT + C._BOXES + " SELECT CAST(count(*) AS BIGINT) * 2 AS least, CAST(count(*) AS BIGINT) * 8 AS most FROM split")
def _(spark, sf):
    return worklist.granule_estimate(worklist.jobs(worklist.hot_cells(C._grid(spark, sf), 75.0), 5.0, 0.1), 2)
