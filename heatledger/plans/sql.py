"""DuckDB fragments that the counterparts of the queries share."""

from __future__ import annotations

_H = "l_orderkey*7919 + l_partkey*104729 + l_suppkey*15485863 + l_linenumber*1299709 + CAST(l_quantity AS BIGINT)*611953"


def pix(globe: bool = False) -> str:
    """CTEs pix (raw), k (clean)."""
    lat, lon = ("(pixel*13+1) % 1000 + 1000", "(pixel*7+11) % 2000 + 2000") if not globe else ("(pixel*13+1) % 18000 - 9000", "(pixel*7+11) % 36000 - 18000")
    return f"""p0 AS (SELECT {_H} AS pixel, * FROM lineitem),
pix AS (SELECT pixel, l_linenumber AS seq, CASE WHEN l_linestatus = 'O' THEN 'MOD11_L2' ELSE 'MYD11_L2' END AS product, CAST(date_trunc('month', l_shipdate) AS DATE) AS d,
  14000 + (pixel*31+7) % 4600 AS raw, (pixel*17+3) % 256 AS qc, CAST({lat} AS DOUBLE)/100.0E0 + 0.005E0 AS lat, CAST({lon} AS DOUBLE)/100.0E0 + 0.005E0 AS lon FROM p0),
v AS (SELECT *, CAST(raw AS DOUBLE)*0.02E0 - 273.15E0 AS c FROM pix WHERE raw <> 0),
k AS (SELECT *, CAST(least(greatest(floor(lat), -90), 89) AS INT) AS tile_lat, CAST(least(greatest(floor(lon), -180), 179) AS INT) AS tile_lon,
  CAST(floor(lat/0.02E0) AS BIGINT)*20000 + CAST(floor(lon/0.02E0) AS BIGINT) AS bin FROM v WHERE c BETWEEN -150 AND 200 AND (qc & 3) <= 1 AND ((qc >> 6) & 3) <= 1)"""


FIRES = """fires AS (SELECT DISTINCT CAST(floor((CAST(1000 + (o_orderkey*37+o_custkey*11) % 1000 AS DOUBLE)/100.0E0)/0.02E0) AS BIGINT)*20000
  + CAST(floor((CAST(2000 + (o_orderkey*53+o_custkey*29) % 2000 AS DOUBLE)/100.0E0)/0.02E0) AS BIGINT) AS b FROM orders WHERE o_orderstatus = 'P'),
bins AS (SELECT DISTINCT b + dy*20000 + dx AS bin FROM fires, (VALUES (-1), (0), (1)) AS y(dy), (VALUES (-1), (0), (1)) AS x(dx))"""

VENTS = """vents AS (SELECT s_suppkey AS vent, s_name AS name, CAST(s_nationkey AS VARCHAR) AS country, CAST(1000 + (s_suppkey*389) % 1000 AS DOUBLE)/100.0E0 AS vent_lat,
  CAST(2000 + (s_suppkey*761) % 2000 AS DOUBLE)/100.0E0 AS vent_lon, 7.0E0 + CAST(s_suppkey % 10 AS DOUBLE) AS radius_km FROM supplier),
hits AS (SELECT k.*, vent, sqrt(((lat-vent_lat)*111.195E0)*((lat-vent_lat)*111.195E0) + ((lon-vent_lon)*111.195E0*cos(radians(vent_lat)))*((lon-vent_lon)*111.195E0*cos(radians(vent_lat)))) AS km, radius_km FROM k, vents
  WHERE abs(lat-vent_lat) < 0.2 AND abs(lon-vent_lon) < 0.25),
near AS (SELECT pixel, seq, product, d, raw, qc, lat, lon, c, tile_lat, tile_lon, min((km, vent)) AS best FROM hits WHERE km <= radius_km GROUP BY ALL)"""

ROUTED = """vhit AS (SELECT pixel, d, min(best[2]) AS vent FROM near GROUP BY ALL),
routed AS (SELECT k.*, vhit.vent AS vent, CASE WHEN vhit.vent IS NOT NULL THEN 'volcanic' WHEN bins.bin IS NOT NULL THEN 'wildfire' WHEN abs(lat) > 50 AND c > 60 THEN 'implausible' ELSE 'weather' END AS route
  FROM k LEFT JOIN vhit ON k.pixel = vhit.pixel AND k.d = vhit.d LEFT JOIN bins ON k.bin = bins.bin)"""

GRANULES = "granules AS (SELECT d, product, seq, tile_lat, tile_lon, arg_max(c, (c, pixel)) AS max_c, arg_max(lat, (c, pixel)) AS max_lat, arg_max(lon, (c, pixel)) AS max_lon FROM k GROUP BY ALL)"
DAYS = "days AS (SELECT d, product, tile_lat, tile_lon, max((max_c, -seq, max_lat, max_lon)) AS b FROM granules GROUP BY ALL), tiles AS (SELECT d, product, tile_lat, tile_lon, b[1] AS max_c, CAST(-b[2] AS INT) AS seq, b[3] AS max_lat, b[4] AS max_lon FROM days)"
JUDGED = """ranked AS (SELECT *, row_number() OVER (PARTITION BY d, tile_lat, tile_lon ORDER BY max_c DESC, product) AS rn FROM tiles),
pairs AS (SELECT a.d, a.tile_lat, a.tile_lon, a.product AS winner_product, a.max_c AS winner_max_c, a.max_lat AS winner_max_lat, a.max_lon AS winner_max_lon,
  b.product AS witness_product, b.max_c AS witness_max_c, b.max_lat AS witness_max_lat, b.max_lon AS witness_max_lon
  FROM (SELECT * FROM ranked WHERE rn = 1) a LEFT JOIN (SELECT * FROM ranked WHERE rn = 2) b USING (d, tile_lat, tile_lon)),
j0 AS (SELECT *, CASE WHEN winner_max_c < 78.0 THEN 'ordinary' WHEN witness_max_c IS NULL THEN 'lone' WHEN winner_max_c - witness_max_c <= 12.0 THEN 'agree' WHEN witness_max_c >= 78.0 THEN 'both_out' ELSE 'rejected' END AS verdict FROM pairs),
judged AS (SELECT *, CASE WHEN verdict IN ('lone', 'both_out') THEN 77.99E0 WHEN verdict = 'rejected' THEN witness_max_c END AS ceiling FROM j0)"""
WEATHER = """weather AS (SELECT d, tile_lat, tile_lon, winner_product AS product, winner_max_c AS max_c, winner_max_lat AS max_lat, winner_max_lon AS max_lon FROM judged WHERE verdict IN ('ordinary', 'agree')
  UNION ALL SELECT d, tile_lat, tile_lon, witness_product, witness_max_c, witness_max_lat, witness_max_lon FROM judged WHERE verdict = 'rejected')"""
OUT = """screened AS (SELECT d, winner_product AS product, tile_lat, tile_lon, 'failed corroboration' AS cause, winner_max_c AS max_c, winner_max_lat AS max_lat, winner_max_lon AS max_lon FROM judged WHERE verdict IN ('rejected', 'both_out')
  UNION ALL SELECT d, winner_product, tile_lat, tile_lon, 'uncorroborated', winner_max_c, winner_max_lat, winner_max_lon FROM judged WHERE verdict = 'lone'
  UNION ALL SELECT d, witness_product, tile_lat, tile_lon, 'uncorroborated', witness_max_c, witness_max_lat, witness_max_lon FROM judged WHERE verdict = 'both_out')"""
ANOMALIES = """a0 AS (SELECT d, product, tile_lat, tile_lon, route AS cause, max((c, pixel, lat, lon, vent)) AS b FROM routed WHERE route IN ('volcanic', 'wildfire') GROUP BY ALL),
anomalies AS (SELECT d, product, tile_lat, tile_lon, cause, b[1] AS max_c, b[3] AS max_lat, b[4] AS max_lon, CASE WHEN cause = 'volcanic' THEN b[5] END AS source FROM a0 WHERE b[1] >= CASE WHEN cause = 'volcanic' THEN 50 ELSE 70 END)"""
RECORDS = "rec AS (SELECT tile_lat, tile_lon, min((-max_c, d, product, max_lat, max_lon)) AS b FROM weather GROUP BY ALL), records AS (SELECT tile_lat, tile_lon, -b[1] AS max_c, b[2] AS record_date, b[3] AS product, b[4] AS max_lat, b[5] AS max_lon FROM rec)"
GRID = """g AS (SELECT *, CAST(least(greatest(floor((90-lat)/0.05E0), 0), 3599) AS INT) AS "row", CAST(least(greatest(floor((lon+180)/0.05E0), 0), 7199) AS INT) AS col, CAST(round_even(c*100, 0) AS INT) AS centi FROM k),
fold0 AS (SELECT product, "row", col, min((-centi, d)) AS b FROM g GROUP BY ALL), grid AS (SELECT product, "row", col, CAST(-b[1] AS INT) AS max_centi, b[2] AS record_date FROM fold0)"""
RASTER = """base AS (SELECT CAST(least(greatest(floor((lon+180)/360*32768), 0), 32767) AS INT) AS px,
  CAST(least(greatest(floor((1 - asinh(tan(radians(greatest(-85.05112878E0, least(85.05112878E0, lat)))))/pi())/2*32768), 0), 32767) AS INT) AS py, max(CAST(round_even(c*100, 0) AS INT)) AS centi FROM k WHERE c >= 40 GROUP BY ALL),
levels AS (SELECT CAST(z AS INT) AS z, px >> (7-z) AS px, py >> (7-z) AS py, max(centi) AS centi FROM base, range(0, 8) AS r(z) GROUP BY ALL)"""
CONTINENT = """CASE WHEN max_lon BETWEEN 110 AND 180 AND max_lat BETWEEN -50 AND -8 THEN 'oceania' WHEN max_lon BETWEEN -170 AND -50 AND max_lat BETWEEN 12 AND 75 THEN 'north-america'
  WHEN max_lon BETWEEN -120 AND -50 AND max_lat >= 7 AND max_lat < 12 THEN 'north-america' WHEN max_lon BETWEEN -82 AND -34 AND max_lat >= -56 AND max_lat < 12 THEN 'south-america'
  WHEN max_lat BETWEEN -35 AND 37 AND max_lon >= -18 AND max_lon < 34 THEN 'africa' WHEN max_lat >= -35 AND max_lat < 30 AND max_lon BETWEEN 34 AND 52 THEN 'africa'
  WHEN max_lat >= 40 AND max_lon >= -10 AND max_lon < 30 THEN 'europe' WHEN max_lon >= 25 AND max_lat > -10 THEN 'asia' WHEN max_lon BETWEEN 90 AND 180 AND max_lat > -8 AND max_lat <= 10 THEN 'asia' END"""
PLACES = """cells AS (SELECT CAST(i.i/2.0E0 AS DECIMAL(5,1)) AS cell_lat, CAST(j.j/2.0E0 AS DECIMAL(5,1)) AS cell_lon, i.i AS i, j.j AS j FROM range(20, 41) AS i(i), range(40, 81) AS j(j)),
places AS (SELECT cell_lat, cell_lon, CASE WHEN (i + j) % 5 = 0 THEN NULL ELSE n_name END AS place_name, r_name AS country FROM cells JOIN nation ON (i*31 + j) % 25 = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE (i + j) % 7 <> 3)"""


def cell(x: str) -> str:
    return f"CAST(floor({x}/0.5E0 + 0.5E0)*0.5E0 AS DECIMAL(5,1))"


def ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"
