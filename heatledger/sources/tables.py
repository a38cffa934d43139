"""Keyed tables on plain Parquet: upserts by partition, snapshots behind a pointer, and JSON staging."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, else one below the warehouse."""
    return (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/_shared").rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in whatever file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def merged(stored: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Stored rows whose key does not come in, and the incoming rows."""
    return stored.join(incoming.select(*keys).distinct(), keys, "left_anti").unionByName(incoming)


def upsert(path: str, incoming: DataFrame, keys: list[str], partition: str) -> None:
    """Merge rows into a table partitioned by ``partition``; incoming rows replace stored ones with their key.

    Only partitions that rows come in for are read and written. What comes in is staged first, so that it is computed once though it is read
    several times; so is what goes out, as Spark must not overwrite what it reads. Running it again with the same rows changes nothing. Rows are dealt
    to tasks by ranges of the partition and the keys, so tasks write few files and a large partition has several.
    """
    spark = incoming.sparkSession
    staging = f"{path.rstrip('/')}_staging_{uuid.uuid4().hex}"
    incoming.write.parquet(f"{staging}/incoming")
    incoming = spark.read.schema(incoming.schema).parquet(f"{staging}/incoming")
    ranged = lambda rows: rows.repartitionByRange(partition, *[k for k in keys if k != partition])
    if not exists(spark, path):
        ranged(incoming).write.partitionBy(partition).parquet(path)
    else:
        stored = spark.read.parquet(path)
        touched = stored.join(incoming.select(partition).distinct(), partition, "left_semi").select(*incoming.columns)
        merged(touched, incoming, keys).write.parquet(f"{staging}/merged")
        out = spark.read.schema(incoming.schema).parquet(f"{staging}/merged")
        ranged(out).write.partitionBy(partition).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
    remove(spark, staging)


def stage_json(readings: DataFrame, anomalies: DataFrame, path: str) -> None:
    """A day's readings and anomalies as JSON, a folder for each product."""
    readings.write.partitionBy("product").mode("overwrite").json(f"{path}/readings")
    anomalies.write.partitionBy("product").mode("overwrite").json(f"{path}/anomalies")


def prunable(dates: DataFrame, keep: int) -> DataFrame:
    """Date-named prefixes (name) but the newest ``keep``; other names are never listed."""
    days = dates.select("name", F.try_to_date(F.when(F.col("name").rlike(r"^\d{4}-\d{2}-\d{2}$"), F.col("name")), "yyyy-MM-dd").alias("d")).filter("d IS NOT NULL")
    newest = days.select("d").distinct().orderBy(F.desc("d")).limit(keep)
    return days.join(newest, "d", "left_anti").select("name")


def run_log(started: DataFrame, finished: DataFrame) -> DataFrame:
    """Runs with what closed them; a run that nothing closed is still running."""
    order = Window.partitionBy("run").orderBy(F.desc("finished_at"))
    last = finished.withColumn("nth", F.row_number().over(order)).filter("nth = 1").drop("nth")
    return started.join(last, "run", "left").withColumn("status", F.coalesce("status", F.lit("running")))


def failure_rate(attempts: DataFrame, allowed: float) -> DataFrame:
    """One row: attempts, failures (``ok`` false), their share, and whether it is within ``allowed``."""
    out = attempts.agg(F.count(F.lit(1)).alias("attempted"), F.count_if(~F.col("ok")).alias("failed"))
    rate = F.when(F.col("attempted") > 0, F.col("failed") / F.col("attempted")).otherwise(0.0)
    return out.withColumn("rate", rate).withColumn("acceptable", F.col("rate") <= allowed)
