"""The test tables seen as thermal data: line items are pixels, suppliers vents, orders fires, events runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_H = "l_orderkey*7919 + l_partkey*104729 + l_suppkey*15485863 + l_linenumber*1299709 + CAST(l_quantity AS BIGINT)*611953"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pixels(spark: SparkSession, sf_dir: str, globe: bool = False) -> DataFrame:
    """Raw pixels (pixel, seq, product, d, raw, qc, lat, lon) of a region of 10 by 20 degrees, or of the globe."""
    lat, lon = ("pixel*13+1) % 1000 + 1000", "pixel*7+11) % 2000 + 2000") if not globe else ("pixel*13+1) % 18000 - 9000", "pixel*7+11) % 36000 - 18000")
    rows = table(spark, sf_dir, "lineitem").selectExpr(f"{_H} AS pixel", "l_linenumber AS seq", "l_linestatus", "l_shipdate")
    return rows.selectExpr(
        "pixel", "seq", "CASE WHEN l_linestatus = 'O' THEN 'MOD11_L2' ELSE 'MYD11_L2' END AS product", "CAST(date_trunc('month', l_shipdate) AS DATE) AS d",
        "14000 + (pixel*31+7) % 4600 AS raw", "(pixel*17+3) % 256 AS qc", f"CAST(({lat} AS DOUBLE)/100.0D + 0.005D AS lat", f"CAST(({lon} AS DOUBLE)/100.0D + 0.005D AS lon",
    )


def fires(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").selectExpr("CAST(1000 + (o_orderkey*37+o_custkey*11) % 1000 AS DOUBLE)/100.0D AS lat", "CAST(2000 + (o_orderkey*53+o_custkey*29) % 2000 AS DOUBLE)/100.0D AS lon")


def vents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS vent", "s_name AS name", "CAST(s_nationkey AS STRING) AS country",
        "CAST(1000 + (s_suppkey*389) % 1000 AS DOUBLE)/100.0D AS vent_lat", "CAST(2000 + (s_suppkey*761) % 2000 AS DOUBLE)/100.0D AS vent_lon", "7.0D + CAST(s_suppkey % 10 AS DOUBLE) AS radius_km",
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.expr("CASE event_type WHEN 'click' THEN 'succeeded' WHEN 'view' THEN 'partial' WHEN 'error' THEN 'failed' ELSE 'running' END")
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("ts").cast("date").alias("reading_date"), F.col("ts").alias("started_at"), status.alias("status"), "user_id", "value")


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half-degree cells of the pixel region with names of nations and regions; some names are NULL, a cached answer."""
    cells = spark.range(20, 41).selectExpr("CAST(id/2.0D AS DECIMAL(5,1)) AS cell_lat", "CAST(id AS INT) AS i").crossJoin(F.broadcast(spark.range(40, 81).selectExpr("CAST(id/2.0D AS DECIMAL(5,1)) AS cell_lon", "CAST(id AS INT) AS j")))  # 861 cells
    names = table(spark, sf_dir, "nation").join(F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))  # 5 regions
    keyed = cells.filter("(i + j) % 7 <> 3").withColumn("k", F.expr("(i*31 + j) % 25")).join(F.broadcast(names), F.col("k") == F.col("n_nationkey"))  # 25 nations
    return keyed.select("cell_lat", "cell_lon", F.expr("CASE WHEN (i + j) % 5 = 0 THEN NULL ELSE n_name END").alias("place_name"), F.col("r_name").alias("country"))


def feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue feeds (feed, body): pages of orders as entries, 4,096 order keys a page at most, some without link, time or id."""
    o = table(spark, sf_dir, "orders").selectExpr("(o_custkey % 50)*1000000000 + o_orderkey DIV 4096 AS feed", "o_orderkey AS k", "o_orderstatus AS s")
    entry = F.expr("""named_struct(
        'producer_granule_id', CASE WHEN k % 11 = 0 THEN NULL ELSE concat(CASE WHEN k % 2 = 0 THEN 'MOD11_L2' ELSE 'MYD11_L2' END, '.A2020', lpad(CAST(k % 366 AS STRING), 3, '0'), '.', lpad(CAST(k % 24 AS STRING), 2, '0'), '05.061.hdf') END,
        'title', CASE WHEN k % 22 = 0 THEN '' ELSE concat('t', CAST(k AS STRING)) END,
        'time_start', CASE WHEN k % 13 = 0 THEN NULL ELSE concat('2020-01-01T', lpad(CAST(k % 24 AS STRING), 2, '0'), ':05:00Z') END,
        'updated', CASE WHEN k % 26 = 0 THEN NULL ELSE '2021-01-01T00:00:00Z' END,
        'links', array(
            named_struct('rel', 'http://esipfed.org/ns/fedsearch/1.1/data#', 'href', concat('https://archive.example.org/', CAST(k AS STRING), '.hdf'), 'inherited', false),
            named_struct('rel', 'http://esipfed.org/ns/fedsearch/1.1/data#', 'href', concat('https://data.nasa.gov/', CAST(k AS STRING), '.hdf'), 'inherited', k % 5 = 0),
            named_struct('rel', 'http://esipfed.org/ns/fedsearch/1.1/s3#', 'href', concat('s3://', CASE WHEN s = 'F' THEN 'lp-prod-public' ELSE 'other' END, '/', CAST(k AS STRING), '.hdf'), 'inherited', false)))""")
    return o.withColumn("e", entry).groupBy("feed").agg(F.to_json(F.struct(F.struct(F.transform(F.array_sort(F.collect_list(F.struct("k", "e"))), lambda x: x["e"]).alias("entry")).alias("feed"))).alias("body"))


def fire_texts(refs: DataFrame) -> DataFrame:
    """Fire swaths (granule_id, content) as JSON texts, one for each granule of a feed; some empty, some cut off, some with lists of different lengths."""
    k = F.regexp_extract("url", r"(\d+)\.hdf", 1).cast("long")
    lists = F.expr("to_json(named_struct('FP_latitude', transform(sequence(1L, k % 5), i -> (k*37 + i) % 90 + 0.25D), 'FP_longitude', transform(sequence(1L, k % 5 + CASE WHEN k % 7 = 2 THEN 1L ELSE 0L END), i -> (k*53 + i) % 180 + 0.75D)))")
    whole = refs.select("granule_id", k.alias("k")).withColumn("whole", lists)
    return whole.select("granule_id", F.expr("CASE WHEN k % 7 = 0 THEN '{}' WHEN k % 7 = 1 THEN substring(whole, 1, CAST(length(whole) DIV 2 AS INT)) ELSE whole END").alias("content"))
