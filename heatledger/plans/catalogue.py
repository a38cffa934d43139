"""Registered queries of the thermal engine and their DuckDB counterparts."""

from __future__ import annotations

from pyspark.sql import functions as F

from heatledger import schema as S
from heatledger.functions import exprs as E
from heatledger.operators import archive, corroborate, grid, places, raster, readmodel, reduce, screens, worklist
from heatledger.plans import bindings as B
from heatledger.plans import sql as Q
from heatledger.sources import feed, logs, tables

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
READ = ["d", "product", "tile_lat", "tile_lon", "max_c", "max_lat", "max_lon"]


def query(name: str, sql: str | None = None):
    """Register a query and its SQL."""

    def put(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return put


def _clean(spark, sf, globe=False):
    return screens.clean(B.pixels(spark, sf, globe))


def _routed(spark, sf, globe=False):
    return screens.route(_clean(spark, sf, globe), B.vents(spark, sf), screens.fire_bins(B.fires(spark, sf)))


def _days(spark, sf, globe=False):
    return reduce.day_merge(reduce.tile_maxima(_clean(spark, sf, globe), "d", "product", "seq"))


def _judged(spark, sf):
    return corroborate.verdicts(_days(spark, sf))


def _archive(spark, sf):
    return archive.records(corroborate.weather(_judged(spark, sf)))


def _grid(spark, sf):
    return grid.fold(grid.cells(_clean(spark, sf, True)))


P, G = Q.pix(), Q.pix(True)
TILES = Q.ctes(P, Q.GRANULES, Q.DAYS)
GTILES = Q.ctes(G, Q.GRANULES, Q.DAYS)
JUDGED = Q.ctes(P, Q.GRANULES, Q.DAYS, Q.JUDGED)
WEATHER = Q.ctes(P, Q.GRANULES, Q.DAYS, Q.JUDGED, Q.WEATHER)
RECORDS = Q.ctes(P, Q.GRANULES, Q.DAYS, Q.JUDGED, Q.WEATHER, Q.RECORDS)
ROUTED = Q.ctes(P, Q.FIRES, Q.VENTS, Q.ROUTED)
GROUTED = Q.ctes(G, Q.FIRES, Q.VENTS, Q.ROUTED)
GRID = Q.ctes(G, Q.GRID)
RASTER = Q.ctes(G, Q.RASTER)


@query("decode_celsius", Q.ctes(P) + "SELECT product, count(*) AS n, min(c) AS low, max(c) AS high, sum(raw) AS counts FROM v WHERE c BETWEEN -150 AND 200 GROUP BY product")
def _(spark, sf):
    return screens.decode(B.pixels(spark, sf)).groupBy("product").agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("low"), F.max("c").alias("high"), F.sum("raw").alias("counts"))


@query("qc_keep", Q.ctes(P) + "SELECT qc, (qc & 3) <= 1 AND ((qc >> 6) & 3) <= 1 AS strict_keep, (qc & 3) <= 1 AND ((qc >> 6) & 3) <= 3 AS lax_keep, count(*) AS n FROM pix GROUP BY ALL")
def _(spark, sf):
    qc = F.col("qc")
    return B.pixels(spark, sf).groupBy("qc", E.qc_keep(qc).alias("strict_keep"), E.qc_keep(qc, 3).alias("lax_keep")).agg(F.count(F.lit(1)).alias("n"))


@query("geo_valid_tiles", Q.ctes(G) + "SELECT tile_lat, tile_lon, count(*) AS n FROM k GROUP BY ALL")
def _(spark, sf):
    return _clean(spark, sf, True).groupBy("tile_lat", "tile_lon").agg(F.count(F.lit(1)).alias("n"))


@query("plausibility_drop", Q.ctes(G) + "SELECT pixel, product, d, lat, c FROM k WHERE abs(lat) > 50 AND c > 60")
def _(spark, sf):
    return _clean(spark, sf, True).filter(~E.plausible(F.col("lat"), F.col("c"))).select("pixel", "product", "d", "lat", "c")


@query("drop_counters", Q.ctes(G) + "SELECT product, d, count(*) AS valid, count_if(NOT keep) AS qc_dropped, count_if(keep AND abs(lat) > 50 AND c > 60) AS implausible FROM (SELECT *, (qc & 3) <= 1 AND ((qc >> 6) & 3) <= 1 AS keep FROM v WHERE c BETWEEN -150 AND 200) GROUP BY ALL")
def _(spark, sf):
    return screens.drop_counters(B.pixels(spark, sf, True))


@query("tile_maxima", Q.ctes(P, Q.GRANULES) + "SELECT d, product, seq, tile_lat, tile_lon, max_c, max_lat, max_lon FROM granules")
def _(spark, sf):
    return reduce.tile_maxima(_clean(spark, sf), "d", "product", "seq")


@query("tile_notes", GROUTED + f"""SELECT d, product, tile_lat, tile_lon, arg_max(c, (c, pixel)) FILTER (WHERE route = 'weather') AS max_c,
  '{S.QC_NOTE}' || CASE WHEN bool_or(route = 'volcanic') THEN '{S.VOLCANIC_MASKED_NOTE}' ELSE '' END || CASE WHEN bool_or(route = 'wildfire') THEN '{S.FIRE_MASKED_NOTE}' ELSE '' END || CASE WHEN bool_or(route = 'implausible') THEN '{S.HIGH_LATITUDE_NOTE}' ELSE '' END AS qc_note
  FROM routed GROUP BY ALL HAVING count_if(route = 'weather') > 0""")
def _(spark, sf):
    return reduce.routed_maxima(_routed(spark, sf, True), "d", "product").select("d", "product", "tile_lat", "tile_lon", "max_c", "qc_note")


@query("day_merge_argmax", TILES + "SELECT * FROM tiles")
def _(spark, sf):
    return _days(spark, sf)


@query("reported_tiles_threshold_topn", GTILES + """, r AS (SELECT *, row_number() OVER (PARTITION BY d, product ORDER BY max_c DESC, tile_lat, tile_lon) AS place, count_if(max_c >= 62) OVER (PARTITION BY d, product) AS hot FROM tiles)
SELECT d, product, tile_lat, tile_lon, max_c, seq, max_lat, max_lon, CAST(place AS INT) AS place FROM r WHERE place <= greatest(hot, 10)""")
def _(spark, sf):
    return reduce.reported(_days(spark, sf, True), 62.0, 10)


@query("fire_guard_ring_bins", Q.ctes(Q.FIRES) + "SELECT bin FROM bins")
def _(spark, sf):
    return screens.fire_bins(B.fires(spark, sf))


@query("fire_masked_pixels", Q.ctes(P, Q.FIRES) + "SELECT pixel, d, product, c, bin FROM k WHERE bin IN (SELECT bin FROM bins)")
def _(spark, sf):
    px = _clean(spark, sf).withColumn("bin", E.fire_bin(F.col("lat"), F.col("lon")))
    return px.join(screens.fire_bins(B.fires(spark, sf)), "bin", "left_semi").select("pixel", "d", "product", "c", "bin")


@query("fire_clean_pixels", Q.ctes(P, Q.FIRES) + "SELECT product, d, count(*) AS n, max(c) AS max_c FROM k WHERE bin NOT IN (SELECT bin FROM bins) GROUP BY ALL")
def _(spark, sf):
    px = _clean(spark, sf).withColumn("bin", E.fire_bin(F.col("lat"), F.col("lon")))
    return px.join(screens.fire_bins(B.fires(spark, sf)), "bin", "left_anti").groupBy("product", "d").agg(F.count(F.lit(1)).alias("n"), F.max("c").alias("max_c"))


@query("vent_containment_nearest", Q.ctes(P, Q.VENTS) + "SELECT pixel, d, seq, product, best[2] AS vent, round(best[1], 6) AS km FROM near")
def _(spark, sf):
    return screens.vent_matches(_clean(spark, sf), B.vents(spark, sf)).select("pixel", "d", "seq", "product", "vent", F.round("km", 6).alias("km"))


@query("route_pixels", GROUTED + "SELECT product, d, route, count(*) AS n, max(c) AS max_c FROM routed GROUP BY ALL")
def _(spark, sf):
    return _routed(spark, sf, True).groupBy("product", "d", "route").agg(F.count(F.lit(1)).alias("n"), F.max("c").alias("max_c"))


@query("volcanic_anomalies", Q.ctes(P, Q.FIRES, Q.VENTS, Q.ROUTED, Q.ANOMALIES) + "SELECT d, product, tile_lat, tile_lon, max_c, max_lat, max_lon, source FROM anomalies WHERE cause = 'volcanic'")
def _(spark, sf):
    return reduce.anomalies(_routed(spark, sf), "d", "product").filter("cause = 'volcanic'").drop("cause")


@query("wildfire_anomalies", Q.ctes(P, Q.FIRES, Q.VENTS, Q.ROUTED, Q.ANOMALIES) + "SELECT d, product, tile_lat, tile_lon, max_c, max_lat, max_lon FROM anomalies WHERE cause = 'wildfire'")
def _(spark, sf):
    return reduce.anomalies(_routed(spark, sf), "d", "product").filter("cause = 'wildfire'").drop("cause", "source")


@query("anomaly_merge", Q.ctes(P, Q.FIRES, Q.VENTS, Q.ROUTED, Q.ANOMALIES) + "SELECT d, tile_lat, tile_lon, cause, max(max_c) AS max_c, count(*) AS products FROM anomalies GROUP BY ALL")
def _(spark, sf):
    return reduce.anomalies(_routed(spark, sf), "d", "product").groupBy("d", "tile_lat", "tile_lon", "cause").agg(F.max("max_c").alias("max_c"), F.count(F.lit(1)).alias("products"))


@query("corroborate_verdicts", JUDGED + "SELECT d, tile_lat, tile_lon, winner_product, winner_max_c, witness_product, witness_max_c, verdict, ceiling FROM judged")
def _(spark, sf):
    return _judged(spark, sf).select("d", "tile_lat", "tile_lon", "winner_product", "winner_max_c", "witness_product", "witness_max_c", "verdict", "ceiling")


@query("corroborated_weather", WEATHER + "SELECT * FROM weather")
def _(spark, sf):
    return corroborate.weather(_judged(spark, sf))


@query("corroboration_ceilings", JUDGED + "SELECT d, tile_lat, tile_lon, ceiling FROM judged WHERE ceiling IS NOT NULL")
def _(spark, sf):
    return corroborate.ceilings(_judged(spark, sf))


@query("all_anomalies_union", Q.ctes(P, Q.FIRES, Q.VENTS, Q.ROUTED, Q.ANOMALIES, Q.GRANULES, Q.DAYS, Q.JUDGED, Q.OUT) + """, u AS (SELECT d, product, tile_lat, tile_lon, cause, max_c, max_lat, max_lon FROM anomalies UNION ALL SELECT * FROM screened),
m AS (SELECT d, product, tile_lat, tile_lon, cause, max((max_c, max_lat, max_lon)) AS b FROM u GROUP BY ALL)
SELECT d, product, tile_lat, tile_lon, cause, b[1] AS max_c, b[2] AS max_lat, b[3] AS max_lon FROM m""")
def _(spark, sf):
    path = tables.scratch(spark, "summary")  # one pass over the pixels serves anomalies and corroboration
    reduce.summary(_routed(spark, sf), "d", "product", "seq").write.parquet(path)
    summed = spark.read.parquet(path)
    judged = corroborate.verdicts(reduce.day_merge(reduce.tiles_of(summed, "d", "product", "seq")))
    return corroborate.all_anomalies(reduce.anomalies_of(summed, "d", "product"), judged)


@query("alltime_records", RECORDS + "SELECT * FROM records")
def _(spark, sf):
    return _archive(spark, sf)


@query("alltime_cutoff", RECORDS + "SELECT CASE WHEN count_if(max_c >= 78) >= 10 THEN min(max_c) FILTER (WHERE max_c >= 78) ELSE (SELECT min(max_c) FROM (SELECT max_c FROM records ORDER BY max_c DESC LIMIT 10)) END AS cutoff FROM records")
def _(spark, sf):
    return archive.cutoff(_archive(spark, sf), 78.0, 10)


@query("alltime_upserts_for_day", Q.ctes(P, Q.GRANULES, Q.DAYS, Q.JUDGED, Q.WEATHER) + """, old AS (SELECT tile_lat, tile_lon, max(max_c) AS max_c FROM weather WHERE d < DATE '2000-01-01' GROUP BY ALL),
tod AS (SELECT * FROM weather WHERE d = DATE '2000-01-01'), mrg AS (SELECT tile_lat, tile_lon, max(max_c) AS max_c FROM (SELECT tile_lat, tile_lon, max_c FROM old UNION ALL SELECT tile_lat, tile_lon, max_c FROM tod) GROUP BY ALL),
cut AS (SELECT CASE WHEN count_if(max_c >= 70) >= 10 THEN min(max_c) FILTER (WHERE max_c >= 70) ELSE (SELECT min(max_c) FROM (SELECT max_c FROM mrg ORDER BY max_c DESC LIMIT 10)) END AS cutoff FROM mrg)
SELECT tod.tile_lat, tod.tile_lon, tod.product, tod.max_c FROM tod LEFT JOIN old USING (tile_lat, tile_lon), cut WHERE (old.max_c IS NULL OR tod.max_c > old.max_c) AND tod.max_c >= cutoff""")
def _(spark, sf):
    path = tables.scratch(spark, "weather")  # read by the records, the bar and the day itself
    corroborate.weather(_judged(spark, sf)).filter("d <= DATE '2000-01-01'").write.parquet(path)
    seen = spark.read.parquet(path)
    old, today = archive.records(seen.filter("d < DATE '2000-01-01'")), seen.filter("d = DATE '2000-01-01'")
    return archive.upserts(old, today, 70.0, 10).select("tile_lat", "tile_lon", "product", "max_c")


@query("running_alltime_by_day", WEATHER + ", x AS (SELECT tile_lat, tile_lon, d, max(max_c) AS max_c FROM weather GROUP BY ALL) SELECT tile_lat, tile_lon, d, max_c, max(max_c) OVER (PARTITION BY tile_lat, tile_lon ORDER BY d) AS alltime_c FROM x")
def _(spark, sf):
    return archive.running(corroborate.weather(_judged(spark, sf))).drop("is_record")


@query("record_breaking_days", WEATHER + """, x AS (SELECT tile_lat, tile_lon, d, max(max_c) AS max_c FROM weather GROUP BY ALL), y AS (SELECT *, max(max_c) OVER (PARTITION BY tile_lat, tile_lon ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM x)
SELECT d, count(*) AS records, max(max_c) AS max_c FROM y WHERE before IS NULL OR max_c > before GROUP BY d""")
def _(spark, sf):
    return archive.running(corroborate.weather(_judged(spark, sf))).filter("is_record").groupBy("d").agg(F.count(F.lit(1)).alias("records"), F.max("max_c").alias("max_c"))


@query("alltime_merge_refold", RECORDS + "SELECT tile_lat, tile_lon, max_c, record_date FROM records")
def _(spark, sf):
    seen = corroborate.weather(_judged(spark, sf))
    half = archive.records(seen.filter("d < DATE '1998-06-01'"))
    return archive.merge(archive.merge(half, seen), seen).select("tile_lat", "tile_lon", "max_c", "record_date")


@query("alltime_manifest", RECORDS + "SELECT count(*) AS tiles, max(max_c) AS max_c, DATE '1999-05-01' AS since, DATE '2000-01-01' AS through FROM records")
def _(spark, sf):
    return archive.manifest(_archive(spark, sf), "1999-05-01", "not a date", "2000-01-01")


@query("raster_base", RASTER + "SELECT * FROM base")
def _(spark, sf):
    return raster.base(_clean(spark, sf, True))


@query("raster_pyramid_counts", RASTER + "SELECT z, count(*) AS pixels, count(DISTINCT (px >> 8, py >> 8)) AS tiles, max(centi) AS max_centi FROM levels GROUP BY z")
def _(spark, sf):
    levels = raster.pyramid(raster.base(_clean(spark, sf, True)))
    return levels.groupBy("z").agg(F.count(F.lit(1)).alias("pixels"), F.count_distinct(F.shiftright("px", 8), F.shiftright("py", 8)).alias("tiles"), F.max("centi").alias("max_centi"))


_RANK = "CASE WHEN centi < 5000 THEN 1 WHEN centi < 5800 THEN 2 WHEN centi < 6600 THEN 3 WHEN centi < 7400 THEN 4 ELSE 5 END"


@query("raster_rank_histogram", RASTER + f"SELECT z, {_RANK} AS rank, count(*) AS n FROM levels GROUP BY ALL")
def _(spark, sf):
    return raster.ranks(raster.pyramid(raster.base(_clean(spark, sf, True)))).groupBy("z", "rank").agg(F.count(F.lit(1)).alias("n"))


@query("rank_pool_equivalence", RASTER + f", r AS (SELECT z, px >> 1 AS px, py >> 1 AS py, max({_RANK}) AS pooled FROM levels WHERE z > 0 GROUP BY ALL) SELECT r.z - 1 AS z, count(*) AS n, count_if(pooled <> {_RANK}) AS differing FROM r JOIN levels l ON l.z = r.z - 1 AND l.px = r.px AND l.py = r.py GROUP BY ALL")
def _(spark, sf):
    levels = raster.ranks(raster.pyramid(raster.base(_clean(spark, sf, True))))
    pooled = levels.filter("z > 0").groupBy((F.col("z") - 1).alias("z"), F.shiftright("px", 1).alias("px"), F.shiftright("py", 1).alias("py")).agg(F.max("rank").alias("pooled"))
    return pooled.join(levels, ["z", "px", "py"]).groupBy("z").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("pooled") != F.col("rank")).alias("differing"))


_RASTER_D = Q.RASTER.replace("SELECT CAST(least(greatest(floor((lon", "SELECT d, CAST(least(greatest(floor((lon").partition("\nlevels")[0].rstrip(",")


@query("raster_ceiling_drop", Q.ctes(P, Q.GRANULES, Q.DAYS, Q.JUDGED, _RASTER_D) + """, placed AS (SELECT *, CAST(floor(degrees(atan(sinh(pi()*(1 - 2*(py+0.5E0)/32768))))) AS INT) AS tile_lat, CAST(floor((px+0.5E0)/32768*360 - 180) AS INT) AS tile_lon FROM base),
lim AS (SELECT d, tile_lat, tile_lon, CAST(round_even(ceiling*100, 0) AS INT) AS l FROM judged WHERE ceiling IS NOT NULL)
SELECT placed.d, count(*) AS kept, max(centi) AS max_centi FROM placed LEFT JOIN lim USING (d, tile_lat, tile_lon) WHERE l IS NULL OR centi <= l GROUP BY placed.d""")
def _(spark, sf):
    base = raster.base(_clean(spark, sf), 40.0, "d")
    return raster.drop_above(base, corroborate.ceilings(_judged(spark, sf)), "d").groupBy("d").agg(F.count(F.lit(1)).alias("kept"), F.max("centi").alias("max_centi"))


@query("raster_incremental_refresh", RASTER + "SELECT * FROM levels")
def _(spark, sf):
    px = _clean(spark, sf, True)
    old, new = raster.base(px.filter("d < DATE '1998-06-01'")), raster.base(px.filter("d >= DATE '1998-06-01'"))
    merged, changed = raster.merge_state(old, new)
    return raster.refresh(raster.pyramid(old), merged, changed)


@query("grid_fold", GRID + "SELECT * FROM grid")
def _(spark, sf):
    return _grid(spark, sf)


@query("grid_global_max", GRID + ', m AS (SELECT product, min((-max_centi, "row", col, record_date)) AS b FROM grid GROUP BY product) SELECT product, CAST(-b[1] AS INT) AS max_centi, b[2] AS "row", b[3] AS col, b[4] AS record_date FROM m')
def _(spark, sf):
    return grid.global_max(_grid(spark, sf))


@query("grid_counts_by_bar", GRID + "SELECT product, count(*) AS observed, " + ", ".join(f"count_if(max_centi >= {b}00) AS at_{b}" for b in (50, 55, 60, 65, 70)) + " FROM grid GROUP BY product")
def _(spark, sf):
    return grid.counts_by_bar(_grid(spark, sf))


_CAND = ', cand AS (SELECT product, d, "row", col, round(89.975E0 - "row"*0.05E0, 3) AS cell_lat, round(-179.975E0 + col*0.05E0, 3) AS cell_lon, max(centi)/100 AS max_c FROM g WHERE centi >= 6000 GROUP BY ALL)'


@query("candidates_at_bar", GRID + _CAND + " SELECT * FROM cand")
def _(spark, sf):
    return grid.candidates(grid.cells(_clean(spark, sf, True)), 60.0)


@query("candidates_dedupe_topk", GRID + _CAND + " SELECT d, cell_lat, cell_lon, max(max_c) AS max_c FROM cand GROUP BY ALL ORDER BY max_c DESC, d, cell_lat DESC, cell_lon LIMIT 20")
def _(spark, sf):
    return grid.top(grid.dedupe(grid.candidates(grid.cells(_clean(spark, sf, True)), 60.0)), 20)


@query("grid_day_maximum", GRID + ', m AS (SELECT d, min((-centi, "row", col)) AS b FROM g GROUP BY d) SELECT d, CAST(-b[1] AS INT) AS max_centi, b[2] AS "row", b[3] AS col FROM m')
def _(spark, sf):
    return grid.day_maximum(grid.cells(_clean(spark, sf, True)))


@query("scan_summary", GRID + _CAND + " SELECT count(*) AS candidates, count(DISTINCT d) AS days, max(max_c) AS hottest, (SELECT count(*) FROM grid) AS cells, (SELECT max(max_centi) FROM grid) AS max_centi FROM cand")
def _(spark, sf):
    return grid.summary(grid.candidates(grid.cells(_clean(spark, sf, True)), 60.0), _grid(spark, sf))


_HOT = ', hot AS (SELECT record_date AS d, product, round(89.975E0 - "row"*0.05E0, 3) AS lat, round(-179.975E0 + col*0.05E0, 3) AS lon, max_centi/100 AS max_c FROM grid WHERE max_centi >= 7500)'


@query("worklist_hot_cells", GRID + _HOT + " SELECT * FROM hot")
def _(spark, sf):
    return worklist.hot_cells(_grid(spark, sf), 75.0)


#: Boxes grow to the union of all within reach, a day until a round changes none of its boxes.
_BOXES = """, places_hot AS (SELECT DISTINCT d, lat, lon FROM hot), grown(i, d, lat, lon, w, s, e, n) AS (
  SELECT 0, d, lat, lon, lon - 0.025E0, lat - 0.025E0, lon + 0.025E0, lat + 0.025E0 FROM places_hot
  UNION ALL SELECT i + 1, d, lat, lon, w2, s2, e2, n2 FROM (SELECT *, bool_or(w2 <> w OR s2 <> s OR e2 <> e OR n2 <> n) OVER (PARTITION BY d) AS moved FROM (
    SELECT a.i, a.d, a.lat, a.lon, a.w, a.s, a.e, a.n, min(b.w) AS w2, min(b.s) AS s2, max(b.e) AS e2, max(b.n) AS n2 FROM grown a JOIN grown b ON a.d = b.d
    AND greatest(a.w, b.w) - least(a.e, b.e) <= 5 AND greatest(a.s, b.s) - least(a.n, b.n) <= 5 GROUP BY a.i, a.d, a.lat, a.lon, a.w, a.s, a.e, a.n)) WHERE moved),
merged AS (SELECT DISTINCT d, w - 0.1E0 AS w, greatest(-90, s - 0.1E0) AS s, e + 0.1E0 AS e, least(90, n + 0.1E0) AS n FROM (SELECT *, max(i) OVER (PARTITION BY d) AS last FROM grown) WHERE i = last),
split AS (SELECT d, -180.0E0 AS west, s AS south, 180.0E0 AS east, n AS north FROM merged WHERE e - w >= 360
  UNION ALL SELECT d, CASE WHEN w < -180 THEN w + 360 ELSE w END, s, CASE WHEN e > 180 OR w < -180 THEN 180 ELSE e END, n FROM merged WHERE e - w < 360
  UNION ALL SELECT d, -180, s, CASE WHEN e > 180 THEN e - 360 ELSE e END, n FROM merged WHERE e - w < 360 AND (e > 180 OR w < -180))"""
#: A day's boxes as text, from west to east.
_JOBS = """, jb AS (SELECT d, string_agg(printf('%.3f,%.3f,%.3f,%.3f', round(west, 3), round(south, 3), round(east, 3), round(north, 3)), ';' ORDER BY round(west, 3), round(south, 3), round(east, 3), round(north, 3)) AS bboxes FROM split GROUP BY d),
js AS (SELECT d, count(*) AS cells, max(max_c) AS cmg_max_c FROM hot GROUP BY d)"""


def _boxes_text(boxes):
    return F.array_join(F.transform(boxes, lambda b: F.format_string("%.3f,%.3f,%.3f,%.3f", b["west"], b["south"], b["east"], b["north"])), ";")


@query("worklist_boxes", GRID.replace("WITH ", "WITH RECURSIVE ", 1) + _HOT + _BOXES + " SELECT d, west, south, east, north FROM split")
def _(spark, sf):
    return worklist.boxes(worklist.hot_cells(_grid(spark, sf), 75.0), 5.0, 0.1)


@query("worklist_jobs", GRID.replace("WITH ", "WITH RECURSIVE ", 1) + _HOT + _BOXES + _JOBS + " SELECT d, bboxes, cells, cmg_max_c FROM jb JOIN js USING (d)")
def _(spark, sf):
    """A job for each day, its boxes as text."""
    return worklist.jobs(worklist.hot_cells(_grid(spark, sf), 75.0), 5.0, 0.1).withColumn("bboxes", _boxes_text(F.col("bboxes")))


@query("worklist_parse_jobs", GRID.replace("WITH ", "WITH RECURSIVE ", 1) + _HOT + _BOXES + _JOBS + """ SELECT d, strftime(d, '%Y-%m-%d') AS date, CASE WHEN month(d) = 3 THEN NULL ELSE bboxes END AS bboxes, cells, round(cmg_max_c, 2) AS cmg_max_c,
CASE WHEN month(d) = 3 THEN 'no boxes' END AS problem FROM jb JOIN js USING (d)""")
def _(spark, sf):
    """The jobs as JSON lines read back; those of March have lost their boxes."""
    work = worklist.jobs(worklist.hot_cells(_grid(spark, sf), 75.0), 5.0, 0.1)
    text = worklist.payload(work, 75.0, ["MOD11_L2"])
    damaged = F.when(F.month("day") == 3, F.regexp_replace("json", r'"bboxes":\[.*?\]', '"bboxes":[]')).otherwise(F.col("json"))
    out = worklist.parse_jobs(text.select(damaged.alias("value")))
    return out.select("d", "date", F.when(F.size("bboxes") > 0, _boxes_text(F.col("bboxes"))).alias("bboxes"), "cells", "cmg_max_c", "problem")


@query("bbox_pad_split", GRID + _HOT + """, b AS (SELECT d, lat, lon, product, lon-5 AS w, greatest(-90, lat-5) AS s, lon+5 AS e, least(90, lat+5) AS n FROM hot)
SELECT d, product, lat, lon, 0 AS piece, CASE WHEN w < -180 THEN w+360 ELSE w END AS west, s AS south, CASE WHEN e > 180 OR w < -180 THEN 180 ELSE e END AS east, n AS north FROM b
UNION ALL SELECT d, product, lat, lon, 1, -180, s, CASE WHEN e > 180 THEN e-360 ELSE e END, n FROM b WHERE e > 180 OR w < -180""")
def _(spark, sf):
    hot = worklist.hot_cells(_grid(spark, sf), 75.0)
    boxed = hot.select("d", "product", "lat", "lon", F.col("lon").alias("west"), F.col("lat").alias("south"), F.col("lon").alias("east"), F.col("lat").alias("north"))
    return worklist.split(boxed.select("d", "product", "lat", "lon", *worklist.padded(5.0)))


@query("job_box_semi_join", GRID.replace("WITH ", "WITH RECURSIVE ", 1) + _HOT + _BOXES + """ SELECT pixel, d, product, lat, lon, c FROM k WHERE EXISTS (SELECT 1 FROM split b WHERE b.d = k.d
  AND k.lat BETWEEN round(b.south, 3) AND round(b.north, 3) AND k.lon BETWEEN round(b.west, 3) AND round(b.east, 3))""")
def _(spark, sf):
    path = tables.scratch(spark, "hot")  # read by the boxes and by the jobs
    worklist.hot_cells(_grid(spark, sf), 75.0).write.parquet(path)
    work = worklist.jobs(spark.read.parquet(path), 5.0, 0.1)
    return worklist.inside(_clean(spark, sf, True), work).select("pixel", "d", "product", "lat", "lon", "c")


_RUNS = "runs AS (SELECT event_id AS id, CAST(ts AS DATE) AS reading_date, ts AS started_at, CASE event_type WHEN 'click' THEN 'succeeded' WHEN 'view' THEN 'partial' WHEN 'error' THEN 'failed' ELSE 'running' END AS status, user_id, value FROM events)"


@query("latest_run", Q.ctes(_RUNS) + "SELECT id, reading_date, status FROM runs WHERE status = 'succeeded' ORDER BY reading_date DESC, started_at DESC, id LIMIT 1")
def _(spark, sf):
    return readmodel.latest_run(B.runs(spark, sf)).select("id", "reading_date", "status")


@query("readings_for_date_dedupe", TILES + ", r AS (SELECT *, row_number() OVER (PARTITION BY d, tile_lat, tile_lon ORDER BY max_c DESC, product) AS rn FROM tiles) SELECT d, product, tile_lat, tile_lon, max_c, max_lat, max_lon FROM r WHERE rn = 1 AND d = DATE '1998-03-01'")
def _(spark, sf):
    return readmodel.by_tile(_days(spark, sf).filter("d = DATE '1998-03-01'")).select(*READ)


def _board(where: str, n: int = 10) -> str:
    return GTILES + f"SELECT d, product, tile_lat, tile_lon, max_c, max_lat, max_lon FROM tiles WHERE {where} ORDER BY max_c DESC, tile_lat, tile_lon, d, product LIMIT {n}"


@query("leaderboard_topk", _board("true"))
def _(spark, sf):
    return readmodel.leaderboard(_days(spark, sf, True)).select(*READ)


@query("leaderboard_area_continent", GTILES + f", a AS (SELECT *, {Q.CONTINENT} AS continent FROM tiles), r AS (SELECT *, row_number() OVER (PARTITION BY continent ORDER BY max_c DESC, tile_lat, tile_lon, d, product) AS place FROM a WHERE continent IS NOT NULL) SELECT continent, d, product, tile_lat, tile_lon, max_c FROM r WHERE place <= 10")
def _(spark, sf):
    boards = readmodel.leaderboards(_days(spark, sf, True), E.continent(F.col("max_lat"), F.col("max_lon")))
    return boards.select(F.col("board").alias("continent"), "d", "product", "tile_lat", "tile_lon", "max_c")


@query("leaderboard_view_antimeridian", _board("max_lat BETWEEN -40 AND 40 AND (max_lon >= 170 OR max_lon <= -170)"))
def _(spark, sf):
    return readmodel.leaderboard(_days(spark, sf, True), readmodel.in_area("view", (170.0, -40.0, -170.0, 40.0))).select(*READ)


@query("leaderboard_period", _board("d >= DATE '1997-08-01' AND d <= DATE '2009-12-31' AND d >= DATE '2000-01-01' AND max_lat < 0"))
def _(spark, sf):
    tiles = _days(spark, sf, True).filter("d >= DATE '1997-08-01'")
    return readmodel.leaderboard(tiles, readmodel.in_period("2000s"), readmodel.in_area("south")).select(*READ)


@query("leaderboard_past_year", _board("d >= DATE '2000-11-01'"))
def _(spark, sf):
    return readmodel.leaderboard(_days(spark, sf, True), readmodel.in_period("year", "2001-11-01")).select(*READ)


@query("leaderboard_search", Q.ctes(P, Q.GRANULES, Q.DAYS, Q.PLACES) + f"""SELECT d, product, tile_lat, tile_lon, max_c, place_name, country FROM tiles LEFT JOIN places ON {Q.cell('max_lat')} = cell_lat AND {Q.cell('max_lon')} = cell_lon
WHERE contains(lower(coalesce(place_name, '')), 'asi') OR contains(lower(coalesce(country, '')), 'asi') ORDER BY max_c DESC, tile_lat, tile_lon, d, product LIMIT 10""")
def _(spark, sf):
    rows = places.named(_days(spark, sf), B.places(spark, sf))
    return readmodel.leaderboard(rows, E.matches(" aSi ", F.col("place_name"), F.col("country"))).select("d", "product", "tile_lat", "tile_lon", "max_c", "place_name", "country")


@query("anomaly_panel_limit_then_filter", Q.ctes(P, Q.FIRES, Q.VENTS, Q.ROUTED, Q.ANOMALIES) + """, l AS (SELECT * FROM anomalies ORDER BY max_c DESC, cause, tile_lat, tile_lon, d, product LIMIT 50)
SELECT l.d, l.product, tile_lat, tile_lon, cause, max_c, v.name AS vent_name, coalesce(v.name || ', ' || v.country, printf('%.1f', abs(max_lat)) || CASE WHEN max_lat >= 0 THEN '°N ' ELSE '°S ' END || printf('%.1f', abs(max_lon)) || CASE WHEN max_lon >= 0 THEN '°E' ELSE '°W' END) AS display_name
FROM l LEFT JOIN vents v ON l.source = v.vent WHERE tile_lat >= 15 ORDER BY max_c DESC, cause, tile_lat, tile_lon, l.d, l.product LIMIT 5""")
def _(spark, sf):
    shown = readmodel.anomaly_panel(reduce.anomalies(_routed(spark, sf), "d", "product"), F.col("tile_lat") >= 15)
    return readmodel.with_vent(shown, B.vents(spark, sf)).select("d", "product", "tile_lat", "tile_lon", "cause", "max_c", "vent_name", "display_name")


@query("view_extent", GTILES + "SELECT min(max_lon) AS west, min(max_lat) AS south, max(max_lon) AS east, max(max_lat) AS north, count(*) AS shown FROM tiles WHERE max_c >= 70")
def _(spark, sf):
    return readmodel.extent(_days(spark, sf, True).filter("max_c >= 70"))


_STEP = lambda x, e: f"CASE WHEN {x} < {e[0]} THEN 1 WHEN {x} < {e[1]} THEN 2 WHEN {x} < {e[2]} THEN 3 WHEN {x} < {e[3]} THEN 4 ELSE 5 END"


@query("air_estimate_bands", GTILES + f"SELECT {_STEP('(0.6443E0*max_c + 3.1876E0)', S.AIR_STEPS)} AS band, max_c > 62 AS extrapolated, count(*) AS n, round(max(0.6443E0*max_c + 3.1876E0), 6) AS hottest FROM tiles GROUP BY ALL")
def _(spark, sf):
    air = E.air_estimate(F.col("max_c"))
    return _days(spark, sf, True).groupBy(E.step(air, S.AIR_STEPS).alias("band"), (F.col("max_c") > S.AIR_FIT_LIMIT).alias("extrapolated")).agg(F.count(F.lit(1)).alias("n"), F.round(F.max(air), 6).alias("hottest"))


@query("heat_step_ramp", GTILES + f"SELECT product, {_STEP('max_c', S.HEAT_STEPS)} AS step, count(*) AS n FROM tiles GROUP BY ALL")
def _(spark, sf):
    return _days(spark, sf, True).groupBy("product", E.step(F.col("max_c"), S.HEAT_STEPS).alias("step")).agg(F.count(F.lit(1)).alias("n"))


@query("unit_convert", TILES + "SELECT d, product, tile_lat, tile_lon, round(max_c*1.8E0 + 32, 6) AS max_f FROM tiles")
def _(spark, sf):
    return _days(spark, sf).select("d", "product", "tile_lat", "tile_lon", F.round(E.fahrenheit(F.col("max_c")), 6).alias("max_f"))


@query("reading_rows", TILES + "SELECT d AS reading_date, CASE product WHEN 'MOD11_L2' THEN 'Terra' ELSE 'Aqua' END AS satellite, product, CAST(tile_lat AS SMALLINT) AS tile_lat, CAST(tile_lon AS SMALLINT) AS tile_lon, CAST(max_c AS DECIMAL(5,2)) AS max_c, round(max_lat, 6) AS max_lat, round(max_lon, 6) AS max_lon FROM tiles")
def _(spark, sf):
    return readmodel.reading_rows(_days(spark, sf))


@query("geojson_features", TILES + """SELECT d, product, tile_lat, tile_lon, '{"type":"Feature","geometry":{"type":"Polygon","coordinates":[[[' || tile_lon || ',' || tile_lat || '],[' || (tile_lon+1) || ',' || tile_lat || '],[' || (tile_lon+1) || ',' || (tile_lat+1) || '],[' || tile_lon || ',' || (tile_lat+1) || '],[' || tile_lon || ',' || tile_lat || ']]]}' AS geometry FROM tiles""")
def _(spark, sf):
    rows = readmodel.geojson(_days(spark, sf))
    return rows.select("d", "product", "tile_lat", "tile_lon", F.substring_index("feature", ',"properties"', 1).alias("geometry"))


_FEED = """o AS (SELECT (o_custkey % 50)*1000000000 + o_orderkey // 4096 AS feed, o_orderkey AS k, o_orderstatus AS s, row_number() OVER (PARTITION BY (o_custkey % 50)*1000000000 + o_orderkey // 4096 ORDER BY o_orderkey) - 1 AS pos FROM orders),
refs AS (SELECT feed, CAST(pos AS INT) AS pos, k, coalesce(CASE WHEN k % 11 = 0 THEN NULL ELSE CASE WHEN k % 2 = 0 THEN 'MOD11_L2' ELSE 'MYD11_L2' END || '.A2020' || lpad(CAST(k % 366 AS VARCHAR), 3, '0') || '.' || lpad(CAST(k % 24 AS VARCHAR), 2, '0') || '05.061.hdf' END,
  CASE WHEN k % 22 = 0 THEN NULL ELSE 't' || k END, k || '.hdf') AS granule_id, 'https://data.nasa.gov/' || k || '.hdf' AS url,
  coalesce(CASE WHEN k % 13 = 0 THEN NULL ELSE '2020-01-01T' || lpad(CAST(k % 24 AS VARCHAR), 2, '0') || ':05:00Z' END, CASE WHEN k % 26 = 0 THEN NULL ELSE '2021-01-01T00:00:00Z' END) AS observed_at,
  CASE WHEN s = 'F' THEN 's3://lp-prod-public/' || k || '.hdf' END AS s3_url FROM o WHERE k % 5 <> 0 AND NOT (k % 13 = 0 AND k % 26 = 0))"""


@query("granule_feed_parse", Q.ctes(_FEED) + "SELECT feed, pos, granule_id, url, observed_at, s3_url FROM refs")
def _(spark, sf):
    return feed.parse(B.feeds(spark, sf))


_FIRST = ", firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY granule_id ORDER BY feed, pos) AS rn FROM refs) WHERE rn = 1)"


@query("granule_dedupe_keep_first", Q.ctes(_FEED) + _FIRST + " SELECT feed, pos, granule_id, url FROM firsts")
def _(spark, sf):
    return feed.first_of_each(feed.parse(B.feeds(spark, sf))).select("feed", "pos", "granule_id", "url")


@query("fire_pairing_left_join", Q.ctes(_FEED) + _FIRST + r""", st AS (SELECT *, nullif(regexp_extract(granule_id, '\.(A\d{7}\.\d{4})\.', 1), '') AS stamp FROM firsts),
fi AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY stamp ORDER BY feed, pos) AS n FROM st WHERE stamp IS NOT NULL AND feed < 10000000000) WHERE n = 1)
SELECT st.granule_id, st.stamp, fi.granule_id AS fire_id, CASE WHEN fi.granule_id IS NULL THEN 'unavailable' ELSE 'applied' END AS fire_status FROM st LEFT JOIN fi ON st.stamp = fi.stamp WHERE st.feed >= 10000000000""")
def _(spark, sf):
    refs = feed.first_of_each(feed.parse(B.feeds(spark, sf)))
    return feed.pair_fires(refs.filter("feed >= 10000000000"), refs.filter("feed < 10000000000")).select("granule_id", "stamp", "fire_id", "fire_status")


@query("run_status", "SELECT event_id, CASE WHEN event_type = 'error' OR user_id % 7 = 0 OR user_id % 7 < 1 THEN 'failed' WHEN least(user_id % 7, event_id % 5) = 0 THEN 'failed' WHEN least(user_id % 7, event_id % 5) < user_id % 7 THEN 'partial' ELSE 'succeeded' END AS status FROM events")
def _(spark, sf):
    ev = B.table(spark, sf, "events")
    total = F.col("user_id") % 7
    return ev.select("event_id", E.run_status(total, F.least(total, F.col("event_id") % 5), F.when(F.col("event_type") == "error", "boom")).alias("status"))


_LINES = "lines AS (SELECT DISTINCT CASE WHEN event_id % 17 = 0 THEN '# note' WHEN event_id % 19 = 0 THEN '' WHEN event_id % 23 = 0 THEN '2024-01-' ELSE strftime(CAST(ts AS DATE) + CAST(event_id % 900 AS INT), '%Y-%m-%d') || ' MOD11_L2=' || (event_id % 3) || ' MYD11_L2=' || CASE WHEN event_id % 29 = 0 THEN 'x' ELSE CAST(user_id % 2 AS VARCHAR) END END AS value, event_id, user_id FROM events)"


def _lines(spark, sf):
    day = F.date_format(F.date_add(F.col("ts").cast("date"), (F.col("event_id") % 900).cast("int")), "yyyy-MM-dd")
    code = F.when(F.col("event_id") % 29 == 0, "x").otherwise((F.col("user_id") % 2).cast("string"))
    text = F.when(F.col("event_id") % 17 == 0, "# note").when(F.col("event_id") % 19 == 0, "").when(F.col("event_id") % 23 == 0, "2024-01-")
    return B.table(spark, sf, "events").select(text.otherwise(F.concat(day, F.lit(" MOD11_L2="), (F.col("event_id") % 3).cast("string"), F.lit(" MYD11_L2="), code)).alias("value"))


_DONE = _LINES + ", done AS (SELECT DISTINCT CAST(value[1:10] AS DATE) AS d FROM lines WHERE regexp_matches(value, '^[0-9-]{10} MOD11_L2=0 MYD11_L2=0$'))"


@query("backfill_log_success", Q.ctes(_DONE) + "SELECT d FROM done")
def _(spark, sf):
    return logs.succeeded_days(_lines(spark, sf))


@query("pending_days_antijoin", Q.ctes(_DONE) + "SELECT CAST(r AS DATE) AS d FROM range(DATE '2024-01-01', DATE '2026-08-01', INTERVAL 1 DAY) AS t(r) WHERE CAST(r AS DATE) NOT IN (SELECT d FROM done) ORDER BY 1 LIMIT 100")
def _(spark, sf):
    return logs.pending(logs.calendar(spark, "2024-01-01", "2026-07-31"), logs.succeeded_days(_lines(spark, sf)), 100)


@query("products_flying", """WITH days AS (SELECT DISTINCT o_orderdate + INTERVAL 2922 DAY AS d FROM orders), p AS (SELECT DISTINCT CASE WHEN l_returnflag = 'A' THEN 'OTHER' WHEN l_linestatus = 'O' THEN 'MOD11_L2' ELSE 'MYD11_L2' END AS product FROM lineitem)
SELECT CAST(d AS DATE) AS d, product FROM days, p WHERE d >= CASE product WHEN 'MOD11_L2' THEN DATE '2000-02-24' WHEN 'MYD11_L2' THEN DATE '2002-07-04' ELSE DATE '0001-01-01' END""")
def _(spark, sf):
    """Order days, eight years on, with the products that flew then; one product is unknown."""
    days = B.table(spark, sf, "orders").select(F.date_add("o_orderdate", 2922).alias("d")).distinct()
    product = F.when(F.col("l_returnflag") == "A", "OTHER").when(F.col("l_linestatus") == "O", "MOD11_L2").otherwise("MYD11_L2")
    return logs.flying(days, B.table(spark, sf, "lineitem").select(product.alias("product")).distinct())


@query("place_cell_join", Q.ctes(P, Q.GRANULES, Q.DAYS, Q.PLACES) + f"SELECT d, product, tile_lat, tile_lon, max_c, {Q.cell('max_lat')} AS cell_lat, {Q.cell('max_lon')} AS cell_lon, place_name, country FROM tiles LEFT JOIN places ON {Q.cell('max_lat')} = cell_lat AND {Q.cell('max_lon')} = cell_lon")
def _(spark, sf):
    return places.named(_days(spark, sf), B.places(spark, sf)).select("d", "product", "tile_lat", "tile_lon", "max_c", "cell_lat", "cell_lon", "place_name", "country")


@query("place_unnamed_backfill", Q.ctes(P, Q.GRANULES, Q.DAYS, Q.PLACES) + f", w AS (SELECT {Q.cell('max_lat')} AS cell_lat, {Q.cell('max_lon')} AS cell_lon, max(max_c) AS max_c FROM tiles GROUP BY ALL) SELECT w.* FROM w ANTI JOIN places USING (cell_lat, cell_lon)")
def _(spark, sf):
    return places.unnamed_cells(_days(spark, sf), B.places(spark, sf))


_REPLY = "reply AS (SELECT n_nationkey AS k, CASE WHEN n_nationkey % 6 = 5 THEN '{\"error\":\"none\"}' ELSE '{\"address\":{' || CASE WHEN n_nationkey % 2 = 0 THEN '\"state\":\" ' || n_name || ' \",' ELSE '' END || CASE WHEN n_nationkey % 3 = 0 THEN '\"county\":\"County ' || n_nationkey || '\",' ELSE '' END || '\"country\":\"' || CASE WHEN n_nationkey % 4 = 0 THEN n_name ELSE r_name END || '\"}}' END AS payload, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey)"


@query("display_name_policy", Q.ctes(_REPLY) + """SELECT k, CASE WHEN k % 6 = 5 THEN NULL WHEN k % 2 = 0 AND k % 4 <> 0 AND n_name <> r_name THEN n_name || ', ' || r_name WHEN k % 3 = 0 THEN 'County ' || k || ', ' || CASE WHEN k % 4 = 0 THEN n_name ELSE r_name END
  ELSE CASE WHEN k % 4 = 0 THEN n_name ELSE r_name END END AS place_name, CASE WHEN k % 6 = 5 THEN NULL WHEN k % 4 = 0 THEN n_name ELSE r_name END AS country FROM reply""")
def _(spark, sf):
    both = B.table(spark, sf, "nation").join(F.broadcast(B.table(spark, sf, "region")), F.col("n_regionkey") == F.col("r_regionkey"))  # 5 regions
    text = F.expr("CASE WHEN n_nationkey % 6 = 5 THEN '{\"error\":\"none\"}' ELSE concat('{\"address\":{', CASE WHEN n_nationkey % 2 = 0 THEN concat('\"state\":\" ', n_name, ' \",') ELSE '' END, CASE WHEN n_nationkey % 3 = 0 THEN concat('\"county\":\"County ', n_nationkey, '\",') ELSE '' END, '\"country\":\"', CASE WHEN n_nationkey % 4 = 0 THEN n_name ELSE r_name END, '\"}}') END")
    return both.select(F.col("n_nationkey").alias("k"), E.display_name(text).alias("place_name"), E.place_country(text).alias("country"))


_RINT = "CAST(least(greatest(round_even(({i} + 0.5E0)*{s}/{t} - 0.5E0, 0), 0), {s} - 1) AS INT)"


@query("geolocation_expand", f"""WITH fine AS (SELECT DISTINCT l_linenumber AS granule, CAST(l_orderkey % 50 AS INT) AS "row", CAST(l_partkey % 75 AS INT) AS col FROM lineitem),
geo AS (SELECT CAST(p_partkey % 10 AS INT) AS srow, CAST(p_partkey // 10 % 15 AS INT) AS scol, min(p_size) + 0.5E0 AS lat, -max(p_size) - 0.5E0 AS lon FROM part GROUP BY ALL),
x AS (SELECT *, {_RINT.format(i='"row"', s=10, t=50)} AS srow, {_RINT.format(i='col', s=15, t=75)} AS scol FROM fine)
SELECT granule, "row", col, srow, scol, lat, lon FROM x JOIN geo USING (srow, scol)""")
def _(spark, sf):
    """Pixels of granules, the line numbers, on a grid of 50 by 75 with the coordinates of the nearest of 10 by 15 points, each of some parts."""
    fine = B.table(spark, sf, "lineitem").selectExpr("l_linenumber AS granule", "CAST(l_orderkey % 50 AS INT) AS row", "CAST(l_partkey % 75 AS INT) AS col").distinct()
    geo = B.table(spark, sf, "part").groupBy(F.expr("CAST(p_partkey % 10 AS INT)").alias("srow"), F.expr("CAST(p_partkey DIV 10 % 15 AS INT)").alias("scol")).agg((F.min("p_size") + F.lit(0.5)).alias("lat"), (-F.max("p_size") - F.lit(0.5)).alias("lon"))
    return screens.expand_geolocation(fine, geo, (10, 15, 50, 75)).select("granule", "row", "col", "srow", "scol", "lat", "lon")


@query("streaming_alltime", RECORDS + "SELECT * FROM records")
def _(spark, sf):
    """The archive folded from the daily weather by a stream; equal to ``alltime_records``."""
    from heatledger.streaming import archive as stream

    root = tables.scratch(spark, "stream")
    corroborate.weather(_judged(spark, sf)).repartition(4).write.parquet(f"{root}/in")
    rows = spark.read.parquet(f"{root}/in")
    live = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/in")
    stream.start(live, f"{root}/archive", f"{root}/checkpoint").awaitTermination()
    return stream.Ledger(spark, f"{root}/archive").read()


@query("upsert_daily_readings", Q.ctes(_RUNS) + """, old AS (SELECT reading_date, user_id, max(value) AS v FROM runs WHERE id % 2 = 0 GROUP BY ALL), new AS (SELECT reading_date, user_id, max(value) AS v FROM runs WHERE id % 2 = 1 GROUP BY ALL)
SELECT reading_date, user_id, v FROM new UNION ALL SELECT reading_date, user_id, v FROM old ANTI JOIN new USING (reading_date, user_id)""")
def _(spark, sf):
    rows = B.runs(spark, sf)
    daily = lambda c: rows.filter(c).groupBy("reading_date", "user_id").agg(F.max("value").alias("v"))
    return tables.merged(daily("id % 2 = 0"), daily("id % 2 = 1"), ["reading_date", "user_id"])


@query("prunable_dates", "WITH n AS (SELECT DISTINCT CASE WHEN event_id % 3 = 0 THEN 'tmp' ELSE strftime(ts, '%Y-%m-%d') END AS name FROM events) SELECT name FROM n WHERE name <> 'tmp' AND name NOT IN (SELECT name FROM n WHERE name <> 'tmp' ORDER BY name DESC LIMIT 5)")
def _(spark, sf):
    name = F.when(F.col("event_id") % 3 == 0, "tmp").otherwise(F.date_format("ts", "yyyy-MM-dd"))
    return tables.prunable(B.table(spark, sf, "events").select(name.alias("name")).distinct(), 5)


@query("job_failure_rate", Q.ctes(_RUNS) + "SELECT count(*) AS attempted, count_if(status = 'failed') AS failed, count_if(status = 'failed')/count(*) AS rate, count_if(status = 'failed')/count(*) <= 0.2 AS acceptable FROM runs")
def _(spark, sf):
    return tables.failure_rate(B.runs(spark, sf).select((F.col("status") != "failed").alias("ok")), 0.2)


@query("place_cell_bounds", Q.ctes(Q.PLACES) + "SELECT cell_lat, cell_lon, CAST(cell_lat AS DOUBLE) - 0.25 AS lat_min, CAST(cell_lat AS DOUBLE) + 0.25 AS lat_max, CAST(cell_lon AS DOUBLE) - 0.25 AS lon_min, CAST(cell_lon AS DOUBLE) + 0.25 AS lon_max FROM places")
def _(spark, sf):
    (a, b), (c, d) = E.place_bounds(F.col("cell_lat")), E.place_bounds(F.col("cell_lon"))
    return B.places(spark, sf).select("cell_lat", "cell_lon", a.alias("lat_min"), b.alias("lat_max"), c.alias("lon_min"), d.alias("lon_max"))


@query("html_escape", """SELECT event_id, replace(replace(replace(replace(replace(t, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), chr(39), '&#39;') AS safe FROM (SELECT event_id, props || '<a href=' || chr(39) || '/u?id=' || user_id || '&t=1' || chr(39) || '>' || event_type || '</a>' AS t FROM events)""")
def _(spark, sf):
    text = F.concat("props", F.lit("<a href='/u?id="), "user_id", F.lit("&t=1'>"), "event_type", F.lit("</a>"))
    return B.table(spark, sf, "events").select("event_id", E.escape_html(text).alias("safe"))


@query("record_labels", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'air' ELSE 'surface' END || CASE event_id % 3 WHEN 1 THEN ' swing' WHEN 2 THEN ' avg' ELSE '' END AS label FROM events")
def _(spark, sf):
    k = F.col("event_id")
    kind = F.when(k % 3 == 1, "diurnal_range").when(k % 3 == 2, "avg_annual").otherwise("all_time_max")
    return B.table(spark, sf, "events").select("event_id", E.record_label(F.when(k % 2 == 0, "air").otherwise("land_surface"), kind).alias("label"))


@query("cause_labels", Q.ctes(P, Q.FIRES, Q.VENTS, Q.ROUTED, Q.ANOMALIES) + "SELECT CASE cause WHEN 'volcanic' THEN 'Volcanic' ELSE 'Wildfire' END AS label, count(*) AS n FROM anomalies GROUP BY ALL")
def _(spark, sf):
    return reduce.anomalies(_routed(spark, sf), "d", "product").groupBy(E.cause_label(F.col("cause")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query("bbox_arguments", GRID + _HOT + " SELECT d, product, lat, lon, CASE WHEN lat + 1 > 90 OR lon + 1 > 180 OR lon < -180 THEN 'off the globe' END AS problem FROM hot")
def _(spark, sf):
    hot = worklist.hot_cells(_grid(spark, sf), 75.0)
    return hot.select("d", "product", "lat", "lon", E.bbox_problem(F.col("lon"), F.col("lat"), F.col("lon") + 1, F.col("lat") + 1).alias("problem"))


@query("stale_days", "SELECT DISTINCT CAST(ts AS DATE) AS d, epoch(TIMESTAMP '2024-01-20 12:00:00') - epoch(CAST(CAST(ts AS DATE) AS TIMESTAMP)) > 2.5*86400 AS stale FROM events")
def _(spark, sf):
    days = B.table(spark, sf, "events").select(F.col("ts").cast("date").alias("d")).distinct()
    return days.select("d", readmodel.stale(F.col("d"), F.lit("2024-01-20 12:00:00").cast("timestamp")).alias("stale"))


from heatledger.plans import products, stateful  # noqa: E402, F401 - register their queries
