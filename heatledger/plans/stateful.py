"""Registered queries of what keeps state: streams, stored levels, stored rows; and their DuckDB counterparts."""

from __future__ import annotations

from pyspark.sql import functions as F

from heatledger import schema as S
from heatledger.functions import exprs as E
from heatledger.operators import archive, corroborate, places, publish, raster, readmodel, reduce
from heatledger.plans import bindings as B
from heatledger.plans import catalogue as C
from heatledger.plans import sql as Q
from heatledger.plans.catalogue import _FEED, _FIRST, JUDGED, RASTER, RECORDS, TILES, G, P, query
from heatledger.sources import feed, granules, logs, tables
from heatledger.sources.versions import Versions


@query("streaming_barrier", JUDGED + "SELECT d, tile_lat, tile_lon, winner_product, winner_max_c, witness_product, witness_max_c, verdict, ceiling FROM judged")
def _(spark, sf):
    """Verdicts by a stream to which one product comes first, some tiles of the other after both have closed, and some rows twice; equal to ``corroborate_verdicts``."""
    from heatledger.streaming import barrier

    root, both = tables.scratch(spark, "barrier"), ["MOD11_L2", "MYD11_L2"]
    C._days(spark, sf).select(*C.READ).write.parquet(f"{root}/days")
    tiles = spark.read.parquet(f"{root}/days")
    late = F.pmod(F.col("tile_lat") + F.col("tile_lon"), F.lit(5)) == 0
    first, second = (F.col("product") == p for p in both)
    days = tiles.select("d").distinct()
    # a file a step, in the order in which the source takes them up
    for rows in (tiles.filter(second), tiles.filter(first & ~late), tiles.filter(late), tiles.filter(second & ~late)):
        rows.coalesce(1).write.mode("append").parquet(f"{root}/tiles")
    for product in reversed(both):
        days.select("d", F.lit(product).alias("product")).coalesce(1).write.mode("append").parquet(f"{root}/closings")
    live = lambda name: spark.readStream.schema(spark.read.parquet(f"{root}/{name}").schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/{name}")
    barrier.start(live("tiles"), live("closings"), both, f"{root}/verdicts", f"{root}/checkpoint").awaitTermination()
    return barrier.verdicts(spark, f"{root}/verdicts").select("d", "tile_lat", "tile_lon", "winner_product", "winner_max_c", "witness_product", "witness_max_c", "verdict", "ceiling")


_SPLIT = "DATE '1998-10-01'"
_LEVELS = f""", o AS (SELECT CAST(least(greatest(floor((lon+180)/360*32768), 0), 32767) AS INT) AS px,
  CAST(least(greatest(floor((1 - asinh(tan(radians(greatest(-85.05112878E0, least(85.05112878E0, lat)))))/pi())/2*32768), 0), 32767) AS INT) AS py, CAST(round_even(c*100, 0) AS INT) AS centi, d < {_SPLIT} AS early FROM k WHERE c >= 40),
b AS (SELECT px, py, max(centi) AS centi, max(centi) FILTER (WHERE early) AS old FROM o GROUP BY ALL),
zs AS (SELECT CAST(z AS INT) AS z FROM range(0, 8) AS r(z)),
dirty AS (SELECT DISTINCT z, px >> (15-z) AS x, py >> (15-z) AS y FROM b, zs WHERE old IS NULL OR centi > old),
had AS (SELECT DISTINCT z, px >> (15-z) AS x, py >> (15-z) AS y FROM b, zs WHERE old IS NOT NULL),
lv AS (SELECT z, px >> (7-z) AS px, py >> (7-z) AS py, max({C._RANK}) AS rank FROM b, zs GROUP BY ALL)"""


def _halves(spark, sf):
    """Base rasters of the days before the split and of those from it on, by one pass over the pixels."""
    path = tables.scratch(spark, "base")
    raster.base(C._clean(spark, sf, True).withColumn("early", F.expr(f"d < {_SPLIT}")), 40.0, "early").write.parquet(path)
    both = spark.read.parquet(path)
    return tuple(both.filter(F.col("early") == early).drop("early") for early in (True, False))


@query("alltime_levels_changed", Q.ctes(G) + _LEVELS + """ SELECT dirty.z, dirty.x, dirty.y, had.z IS NULL AS created, count(*) AS pixels, max(rank) AS max_rank, CAST(sum(rank) AS BIGINT) AS rank_sum
FROM dirty LEFT JOIN had ON had.z = dirty.z AND had.x = dirty.x AND had.y = dirty.y JOIN lv ON lv.z = dirty.z AND lv.px >> 8 = dirty.x AND lv.py >> 8 = dirty.y GROUP BY ALL""")
def _(spark, sf):
    """Tiles of the stored levels that the last months change or create, with what stands in them then."""
    old, new = _halves(spark, sf)
    path = tables.scratch(spark, "levels")
    raster.write_levels(raster.ranks(raster.pyramid(old)).drop("centi"), path)
    state, changed = raster.merge_state(old, new)
    levels, tiles = raster.changed_levels(state, changed, spark.read.parquet(path))
    sums = levels.groupBy("z", F.shiftright("px", 8).alias("tx"), F.shiftright("py", 8).alias("ty")).agg(F.count(F.lit(1)).alias("pixels"), F.max("rank").alias("max_rank"), F.sum("rank").alias("rank_sum"))
    return tiles.join(sums, ["z", "tx", "ty"]).select("z", F.col("tx").alias("x"), F.col("ty").alias("y"), "created", "pixels", "max_rank", "rank_sum")


@query("fire_status_by_granule", Q.ctes(_FEED) + _FIRST + r""", st AS (SELECT *, nullif(regexp_extract(granule_id, '\.(A\d{7}\.\d{4})\.', 1), '') AS stamp FROM firsts),
fi AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY stamp ORDER BY feed, pos) AS n FROM st WHERE stamp IS NOT NULL AND feed < 10000000000) WHERE n = 1),
fk AS (SELECT granule_id, CAST(regexp_extract(url, '(\d+)\.hdf', 1) AS BIGINT) AS k, stamp FROM fi),
j AS (SELECT st.granule_id, fk.granule_id AS fire_id, fk.k FROM st LEFT JOIN fk ON st.stamp = fk.stamp WHERE st.feed >= 10000000000)
SELECT granule_id, fire_id, CASE WHEN k IS NULL OR k % 7 IN (1, 2) THEN 'unavailable' WHEN k % 7 = 0 THEN 'none' ELSE 'applied' END AS status,
  CASE WHEN k % 7 = 0 THEN 0 WHEN k % 7 NOT IN (1, 2) THEN CAST(k % 5 AS INT) END AS fires,
  CASE WHEN k % 7 NOT IN (0, 1, 2) THEN (k*37 + 1) % 90 + 0.25E0 END AS first_lat, """ + f"""'{S.QC_NOTE}' || CASE WHEN k IS NULL OR k % 7 IN (1, 2) THEN '{S.FIRE_UNAVAILABLE_NOTE}' ELSE '' END AS qc_note FROM j""")
def _(spark, sf):
    """Swaths with what their fire swath could tell: fires, none, or nothing, as it is missing or cannot be read."""
    refs = feed.first_of_each(feed.parse(B.feeds(spark, sf)))
    fires = refs.filter("feed < 10000000000")
    paired = feed.pair_fires(refs.filter("feed >= 10000000000"), fires).select("granule_id", "fire_id")
    out = granules.with_fire_status(paired, granules.fire_status_of_text(B.fire_texts(fires)))
    return out.select("granule_id", "fire_id", "status", F.size("fires").alias("fires"), F.get("fires", F.lit(0))["lat"].alias("first_lat"), "qc_note")


@query("alltime_published", RASTER + f"SELECT z, px, py, {C._RANK} AS rank FROM levels")
def _(spark, sf):
    """Display levels after folding the days up to a date and those after it, the latter twice, into a store of versions; equal to one pyramid of all days."""
    store, path = Versions(spark, tables.scratch(spark, "published")), tables.scratch(spark, "days")
    C._days(spark, sf).select(*C.READ).write.parquet(path)
    days, (old, new) = spark.read.parquet(path), _halves(spark, sf)
    for early, day in ((True, "1998-09-30"), (False, "1998-12-31"), (False, "1998-12-31")):
        when = f"d < {_SPLIT}" if early else f"d >= {_SPLIT}"
        publish.fold_day(store, old if early else new, days.filter(when), day)
    return publish.read(store)[0]


_NAMED_ROWS = """, r AS (SELECT d, product, tile_lat, tile_lon, cause, max_c, max_lat, max_lon, CASE WHEN (tile_lat + tile_lon) % 3 = 0 THEN 'kept' END AS place_name, CASE WHEN (tile_lat + tile_lon) % 2 = 0 THEN 'K' END AS country FROM anomalies)"""


@query("place_backfill_update", Q.ctes(P, Q.FIRES, Q.VENTS, Q.ROUTED, Q.ANOMALIES, Q.PLACES) + _NAMED_ROWS + f""" SELECT d, product, tile_lat, tile_lon, cause, max_c, coalesce(r.place_name, p.place_name) AS place_name, CASE WHEN p.place_name IS NULL THEN r.country ELSE p.country END AS country
FROM r LEFT JOIN places p ON r.place_name IS NULL AND cause <> 'volcanic' AND p.place_name IS NOT NULL AND {Q.cell('max_lat')} = p.cell_lat AND {Q.cell('max_lon')} = p.cell_lon""")
def _(spark, sf):
    """Stored anomalies, some named before, after an update that names the rest by their cells; the update runs twice."""
    store = Versions(spark, tables.scratch(spark, "anomalies"))
    staged = tables.scratch(spark, "staged")  # dealing rows by ranges reads them twice
    reduce.anomalies(C._routed(spark, sf), "d", "product").drop("source").write.parquet(staged)
    rows = spark.read.parquet(staged)
    at = F.col("tile_lat") + F.col("tile_lon")
    places.put_rows(store, rows.withColumns({"place_name": F.when(at % 3 == 0, "kept"), "country": F.when(at % 2 == 0, "K")}), 8)
    for _ in range(2):
        places.name_rows(store, B.places(spark, sf))
    return places.rows_of(store).select("d", "product", "tile_lat", "tile_lon", "cause", "max_c", "place_name", "country")


@query("place_resolver_states", TILES.rstrip() + ",\n" + Q.PLACES + f""", want AS (SELECT DISTINCT {Q.cell('max_lat')} AS cell_lat, {Q.cell('max_lon')} AS cell_lon FROM tiles),
c AS (SELECT want.*, h.h, n_name, p.cell_lat IS NOT NULL AS held, p.place_name AS cached_name, p.country AS cached_country, h.h % 11 <> 0 AND h.h % 5 <> 1 AS fine_ok, h.h % 5 <> 0 AS fine_named, h.h % 7 <> 0 AS coarse_ok, h.h % 3 <> 0 AS coarse_named
  FROM want JOIN (SELECT cell_lat, cell_lon, CAST(cell_lat*2 AS BIGINT)*31 + CAST(cell_lon*2 AS BIGINT)*17 AS h FROM want) h USING (cell_lat, cell_lon) JOIN nation ON n_nationkey = h.h % 25
  LEFT JOIN places p ON p.cell_lat = want.cell_lat AND p.cell_lon = want.cell_lon AND CAST(p.cell_lat*2 AS BIGINT) % 2 = 0)
SELECT cell_lat, cell_lon, CASE WHEN held THEN 'cached' WHEN NOT fine_ok THEN 'unanswered' WHEN fine_named THEN 'named' WHEN NOT coarse_ok THEN 'unanswered' WHEN coarse_named THEN 'named' ELSE 'nameless' END AS state,
  CASE WHEN held THEN cached_name WHEN NOT fine_ok THEN NULL WHEN fine_named THEN 'S' || h || ', ' || n_name WHEN coarse_ok AND coarse_named THEN n_name END AS place_name,
  CASE WHEN held THEN cached_country WHEN NOT fine_ok THEN NULL WHEN fine_named THEN n_name WHEN coarse_ok AND coarse_named THEN n_name END AS country,
  CASE WHEN held THEN 0 WHEN fine_ok AND NOT fine_named THEN 2 ELSE 1 END AS requests FROM c""")
def _(spark, sf):
    """What a run learns of the cells of the day tiles from a cache and captured replies at two levels."""
    wanted = places.with_cell(C._days(spark, sf)).select("cell_lat", "cell_lon").distinct()
    cache = B.places(spark, sf).filter("CAST(cell_lat*2 AS BIGINT) % 2 = 0")
    keyed = wanted.withColumn("h", F.expr("CAST(cell_lat*2 AS BIGINT)*31 + CAST(cell_lon*2 AS BIGINT)*17")).withColumn("nk", F.expr("h % 25"))
    named = keyed.join(B.table(spark, sf, "nation"), F.col("nk") == F.col("n_nationkey"))
    fine = named.selectExpr("cell_lat", "cell_lon", "'fine' AS level", "CASE WHEN h % 11 = 0 THEN 503 ELSE 200 END AS status",
        """CASE h % 5 WHEN 0 THEN '{"error":"none"}' WHEN 1 THEN 'oops' ELSE concat('{"address":{"state":"S', h, '","country":"', n_name, '"}}') END AS payload""")  # fmt: skip
    coarse = named.selectExpr("cell_lat", "cell_lon", "'coarse' AS level", "CASE WHEN h % 7 = 0 THEN 429 ELSE 200 END AS status",
        """CASE WHEN h % 3 = 0 THEN '{"address":{}}' ELSE concat('{"address":{"country":"', n_name, '"}}') END AS payload""")  # fmt: skip
    return places.look_up(wanted, cache, fine.unionByName(coarse))


@query("grid_scaling_by_granule", Q.ctes(G) + """, gr AS (SELECT DISTINCT product || '.' || d AS granule_id, (month(d)*3 + CASE WHEN product = 'MOD11_L2' THEN 1 ELSE 0 END + year(d)) % 7 AS k FROM pix),
pr AS (SELECT granule_id, k, CASE k WHEN 0 THEN 'no scale_factor' WHEN 1 THEN 'scale_factor is not 0.02' WHEN 2 THEN 'valid_range is inverted' WHEN 3 THEN 'valid_range has 1 entries' END AS problem FROM gr)
SELECT pr.granule_id, problem, count(v.c) AS cells, min(v.c) AS low_c, max(v.c) AS high_c FROM pr LEFT JOIN v ON v.product || '.' || v.d = pr.granule_id AND problem IS NULL AND c BETWEEN -150 AND 200 AND (k = 4 OR raw BETWEEN 15000 AND 17000) GROUP BY ALL""")
def _(spark, sf):
    """Cells that each daily grid yields by its own scaling and range, or why it is refused."""
    px = B.pixels(spark, sf, True).withColumn("granule_id", F.concat_ws(".", "product", "d"))
    k = F.expr("(month(d)*3 + CASE WHEN product = 'MOD11_L2' THEN 1 ELSE 0 END + year(d)) % 7")
    grids = px.select("granule_id", k.alias("k")).distinct().select(
        "granule_id", F.expr("CASE k WHEN 0 THEN map('_FillValue', 0.0D) WHEN 1 THEN map('scale_factor', 0.05D) ELSE map('scale_factor', 0.02D) END").alias("attrs"),
        F.expr("CASE k WHEN 2 THEN array(16500.0D, 14500.0D) WHEN 3 THEN array(7500.0D) WHEN 5 THEN array(15000.0D, 17000.0D) WHEN 6 THEN array(15000.0D, 17000.0D) END").alias("valid_range"))
    scaling = granules.grid_scaling(grids)
    kept = granules.decode_grid(px, scaling).groupBy("granule_id").agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("low_c"), F.max("c").alias("high_c"))
    return scaling.join(kept, "granule_id", "left").select("granule_id", "problem", F.coalesce("n", F.lit(0)).alias("cells"), "low_c", "high_c")


@query("grid_feed_of_day", Q.ctes(_FEED) + """, g AS (SELECT feed, CAST(pos AS INT) AS pos, k, coalesce(CASE WHEN k % 11 = 0 THEN NULL ELSE CASE WHEN k % 2 = 0 THEN 'MOD11_L2' ELSE 'MYD11_L2' END || '.A2020' || lpad(CAST(k % 366 AS VARCHAR), 3, '0') || '.' || lpad(CAST(k % 24 AS VARCHAR), 2, '0') || '05.061.hdf' END,
  CASE WHEN k % 22 = 0 THEN NULL ELSE 't' || k END, k || '.hdf') AS granule_id, 'https://data.nasa.gov/' || k || '.hdf' AS url, coalesce(CASE WHEN k % 13 = 0 THEN NULL ELSE '2020-01-01T' || lpad(CAST(k % 24 AS VARCHAR), 2, '0') || ':05:00Z' END, '') AS time_start FROM o WHERE k % 5 <> 0 AND feed % 3 <> 0)
SELECT feed, arg_min(pos, pos) AS pos, arg_min(granule_id, pos) AS granule_id, arg_min(url, pos) AS url, arg_min(time_start, pos) AS time_start FROM g GROUP BY feed""")
def _(spark, sf):
    """The grid of each feed; every third feed has links of another relation that ends alike, and so none."""
    other = F.when(F.col("feed") % 3 == 0, F.replace("body", F.lit("fedsearch/1.1/data#"), F.lit("fedsearch/2.0/data#"))).otherwise(F.col("body"))
    return feed.grid_of_day(feed.parse_grids(B.feeds(spark, sf).withColumn("body", other)))


@query("object_paths", RASTER + """, t AS (SELECT DISTINCT z, px >> 8 AS x, py >> 8 AS y FROM levels)
SELECT z, x, y, '2000-01-01/' || z || '/' || x || '/' || y || '.png' AS day_path, 'alltime/' || z || '/' || x || '/' || y || '.png' AS alltime_path, CASE WHEN z = 7 THEN 'alltime-state/' || x || '/' || y || '.npy' END AS state_path FROM t""")
def _(spark, sf):
    """Where the tiles of the pyramid and the state of its base lie."""
    levels = raster.pyramid(raster.base(C._clean(spark, sf, True)))
    t = levels.select("z", F.shiftright("px", 8).alias("x"), F.shiftright("py", 8).alias("y")).distinct()
    at = F.col("z"), F.col("x"), F.col("y")
    state = F.when(F.col("z") == S.BASE_ZOOM, raster.object_path("state", *at))
    return t.select("z", "x", "y", raster.object_path("day", *at, F.lit("2000-01-01").cast("date")).alias("day_path"), raster.object_path("alltime", *at).alias("alltime_path"), state.alias("state_path"))


@query("token_expiry_states", """WITH t AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(floor(epoch(ts)) AS BIGINT) + event_id % 5 * 864000 END AS exp FROM events)
SELECT event_id, CAST(make_timestamp(exp * 1000000) AS TIMESTAMP) AS expires, CASE WHEN exp IS NULL THEN 'unknown' WHEN exp <= epoch(TIMESTAMP '2024-02-01 00:00:00') THEN 'expired' WHEN exp - epoch(TIMESTAMP '2024-02-01 00:00:00') <= 14*86400 THEN 'renew' ELSE 'ok' END AS state FROM t""")
def _(spark, sf):
    """Web tokens made of event times, every seventh without an expiry, and what a run on the first of February makes of them."""
    exp = F.unix_timestamp("ts") + F.col("event_id") % 5 * 864000
    claims = F.when(F.col("event_id") % 7 == 0, F.lit('{"sub":"x"}')).otherwise(F.concat(F.lit('{"exp":'), exp, F.lit(',"uid":"?>~"}')))
    body = F.rtrim(F.translate(F.base64(F.encode(claims, "UTF-8")), "+/", "-_"), F.lit("="))
    token = B.table(spark, sf, "events").select("event_id", F.concat_ws(".", F.lit("e30"), body, F.lit("sig")).alias("token"))
    expires = E.token_expiry(F.col("token"))
    return token.select("event_id", expires.alias("expires"), E.expiry_state(expires, F.lit("2024-02-01 00:00:00").cast("timestamp")).alias("state"))


@query("done_log_parse", """WITH l AS (SELECT CASE event_id % 9 WHEN 0 THEN '# ' || strftime(ts, '%Y-%m-%d') WHEN 1 THEN '' WHEN 2 THEN '2024-13-45' WHEN 3 THEN strftime(ts, '%Y-%m-%d') || ' ok' WHEN 4 THEN '  ' || strftime(CAST(ts AS DATE) + CAST(event_id % 700 AS INT), '%Y-%m-%d') || ' ' ELSE strftime(CAST(ts AS DATE) + CAST(event_id % 700 AS INT), '%Y-%m-%d') END AS value FROM events)
SELECT DISTINCT CAST(trim(value) AS DATE) AS d FROM l WHERE regexp_full_match(trim(value), '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND value <> '2024-13-45'""")
def _(spark, sf):
    """Days named by a log of done days with comments, blanks, impossible days and other text."""
    k, day = F.col("event_id") % 9, F.date_format("ts", "yyyy-MM-dd")
    later = F.date_format(F.date_add(F.col("ts").cast("date"), (F.col("event_id") % 700).cast("int")), "yyyy-MM-dd")
    text = F.when(k == 0, F.concat(F.lit("# "), day)).when(k == 1, "").when(k == 2, "2024-13-45").when(k == 3, F.concat(day, F.lit(" ok"))).when(k == 4, F.concat(F.lit("  "), later, F.lit(" "))).otherwise(later)
    return logs.done_days(B.table(spark, sf, "events").select(text.alias("value")))


@query("json_staging_round_trip", Q.ctes(P, Q.FIRES, Q.VENTS, Q.ROUTED, Q.ANOMALIES, Q.GRANULES, Q.DAYS) + """SELECT 'reading' AS kind, product, d, tile_lat, tile_lon, max_c, NULL AS cause FROM tiles WHERE d = DATE '1998-03-01'
UNION ALL SELECT 'anomaly', product, d, tile_lat, tile_lon, max_c, cause FROM anomalies WHERE d = DATE '1998-03-01'""")
def _(spark, sf):
    """A day's readings and anomalies staged as JSON and read back."""
    path, day = tables.scratch(spark, "staged"), F.col("d") == F.lit("1998-03-01").cast("date")
    tables.stage_json(C._days(spark, sf).filter(day), reduce.anomalies(C._routed(spark, sf), "d", "product").filter(day), path)
    back = lambda kind, cause: spark.read.schema(f"d date, tile_lat int, tile_lon int, max_c double, {cause} product string").json(f"{path}/{kind}")
    readings = back("readings", "").select(F.lit("reading").alias("kind"), "product", "d", "tile_lat", "tile_lon", "max_c", F.lit(None).cast("string").alias("cause"))
    return readings.unionByName(back("anomalies", "cause string,").select(F.lit("anomaly").alias("kind"), "product", "d", "tile_lat", "tile_lon", "max_c", "cause"))


@query("sql_functions_in_sql", Q.ctes(G) + f"""SELECT product, tile_lat, tile_lon, count(*) AS n, max(c) AS max_c, max({C._RANK.replace('centi', 'CAST(round_even(c*100, 0) AS INT)')}) AS max_rank, round(max(0.6443E0*c + 3.1876E0), 6) AS air, round(max(c*1.8E0 + 32), 6) AS max_f FROM k GROUP BY ALL""")
def _(spark, sf):
    """Day tiles by SQL text alone: every function of the SQL surface over a view of the pixels."""
    E.register(spark)
    B.pixels(spark, sf, True).createOrReplaceTempView("surface_pixels")
    return spark.sql("""
        SELECT product, tile_of(lat, -90, 89) AS tile_lat, tile_of(lon, -180, 179) AS tile_lon, count(*) AS n, max(lst_celsius(raw)) AS max_c,
               max(palette_rank(CAST(rint(lst_celsius(raw) * 100) AS INT))) AS max_rank, round(max(air_estimate(lst_celsius(raw))), 6) AS air, round(max(fahrenheit(lst_celsius(raw))), 6) AS max_f
        FROM surface_pixels WHERE raw <> 0 AND qc_keep(qc, 1) AND lst_celsius(raw) BETWEEN -150 AND 200 GROUP BY 1, 2, 3""")


@query("anomaly_rows", Q.ctes(P, Q.FIRES, Q.VENTS, Q.ROUTED, Q.ANOMALIES, Q.PLACES) + f"""SELECT d AS reading_date, CASE product WHEN 'MOD11_L2' THEN 'Terra' ELSE 'Aqua' END AS satellite, product, CAST(tile_lat AS SMALLINT) AS tile_lat, CAST(tile_lon AS SMALLINT) AS tile_lon,
CAST(max_c AS DECIMAL(5,2)) AS max_c, round(max_lat, 6) AS max_lat, round(max_lon, 6) AS max_lon, p.place_name, p.country, cause, CASE WHEN cause = 'volcanic' THEN 'vent-' || source END AS source_slug
FROM anomalies LEFT JOIN places p ON cause <> 'volcanic' AND {Q.cell('max_lat')} = p.cell_lat AND {Q.cell('max_lon')} = p.cell_lon""")
def _(spark, sf):
    vents = B.vents(spark, sf).withColumn("slug", F.concat(F.lit("vent-"), "vent"))
    return readmodel.anomaly_rows(reduce.anomalies(C._routed(spark, sf), "d", "product"), B.places(spark, sf), vents)


@query("upsert_stored_anomalies", Q.ctes(P, Q.FIRES, Q.VENTS, Q.ROUTED, Q.ANOMALIES) + """SELECT d, product, tile_lat, tile_lon, cause, CASE WHEN month(d) % 2 = 0 THEN max_c ELSE max_c - 1 END AS max_c FROM anomalies WHERE month(d) % 2 = 0 OR cause = 'volcanic'""")
def _(spark, sf):
    """A stored table, a partition a day: volcanic anomalies a degree too cool come first, then all of every second month, twice."""
    path, keys = tables.scratch(spark, "anomalies"), ["d", "product", "tile_lat", "tile_lon", "cause"]
    staged = tables.scratch(spark, "staged")  # one pass over the pixels serves all updates
    reduce.anomalies(C._routed(spark, sf), "d", "product").select(*keys, "max_c").write.parquet(staged)
    rows = spark.read.parquet(staged)
    tables.upsert(path, rows.filter("cause = 'volcanic'").withColumn("max_c", F.col("max_c") - 1), keys, "d")
    for _ in range(2):
        tables.upsert(path, rows.filter("month(d) % 2 = 0"), keys, "d")
    return spark.read.parquet(path).select(*keys, "max_c")


@query("upsert_alltime_rows", RECORDS + """, e AS (SELECT tile_lat, tile_lon, min((-max_c, d, product)) AS b FROM weather WHERE d < DATE '1996-01-01' GROUP BY ALL)
SELECT r.tile_lat, r.tile_lon, r.max_c, r.record_date, r.product, CASE WHEN e.tile_lat IS NULL OR r.max_c > -e.b[1] THEN 'later' ELSE 'early' END AS written FROM records r LEFT JOIN e USING (tile_lat, tile_lon)""")
def _(spark, sf):
    """Stored all-time rows, a partition a row of tiles: the records of the early years, then of all years where they are higher; each row says which run wrote it."""
    path = tables.scratch(spark, "alltime")
    seen = corroborate.weather(C._judged(spark, sf))
    pick = ["tile_lat", "tile_lon", "max_c", "record_date", "product", "written"]
    early = archive.records(seen.filter("d < DATE '1996-01-01'")).withColumn("written", F.lit("early")).select(*pick)
    tables.upsert(path, early, ["tile_lat", "tile_lon"], "tile_lat")
    stored = spark.read.parquet(path)
    later = archive.records(seen).withColumn("written", F.lit("later")).select(*pick)
    old = stored.select("tile_lat", "tile_lon", F.col("max_c").alias("old_c"))
    higher = later.join(old, ["tile_lat", "tile_lon"], "left").filter("old_c IS NULL OR max_c > old_c").select(*pick)
    staged = tables.scratch(spark, "higher")  # the update must not read what it writes
    higher.write.parquet(staged)
    tables.upsert(path, spark.read.parquet(staged), ["tile_lat", "tile_lon"], "tile_lat")
    return spark.read.parquet(path).select(*pick)


@query("stream_daily_maxima", """WITH m AS (SELECT max(ts) - INTERVAL 2 DAY AS mark FROM events)
SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, user_id % 50 AS key, max(value) AS max_value FROM events, m WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= mark GROUP BY ALL""")
def _(spark, sf):
    """Daily maxima of a stream of events, those of days that the watermark has closed."""
    from heatledger.streaming import archive as stream

    root = tables.scratch(spark, "daily")
    B.table(spark, sf, "events").select((F.col("user_id") % 50).alias("key"), F.col("ts").cast("timestamp").alias("ts"), "value").coalesce(1).write.parquet(f"{root}/in")
    live = spark.readStream.schema(spark.read.parquet(f"{root}/in").schema).parquet(f"{root}/in")
    out = stream.daily_maxima(live).select(F.col("window.start").alias("day"), "key", "max_value")
    out.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{root}/out")
