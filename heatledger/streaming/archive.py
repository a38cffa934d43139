"""The all-time archive kept by a stream of readings, as sorted-out runs that grow with what comes in.

Each micro-batch is reduced to a row a tile and becomes a run of each band of latitudes it has tiles in. A run takes in the runs before it that are not more than
twice as large, so a band has a run for each doubling of its size at most, and a row is written again only when its run grows by half: what a batch writes follows
the batch, not the archive. A reader folds the runs of each band. Batches commit by a pointer with their number, so one that is run again after a
failure changes nothing. Maxima do not depend on order, so late readings need no watermark and are never dropped.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heatledger.operators import archive
from heatledger.sources.versions import Versions

SCHEMA = "tile_lat int, tile_lon int, max_c double, record_date date, product string, max_lat double, max_lon double"
#: Degrees of latitude of a band.
BAND = 10


class Ledger:
    """The archive below a folder that all machines share: content (batch, runs: {band: [[folder, rows], ...], largest first})."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.versions = spark, Versions(spark, root)

    def _runs(self, wanted: dict[str, list[str]]) -> DataFrame:
        """Rows of some bands of some folders."""
        out = self.spark.createDataFrame([], SCHEMA)
        for folder, bands in sorted(wanted.items()):
            rows = self.spark.read.schema(f"{SCHEMA}, band int").parquet(self.versions.at(folder)).filter(F.col("band").isin([int(b) for b in bands]))
            out = out.unionByName(rows.drop("band"))
        return out

    def read(self) -> DataFrame:
        """The archive as of the newest version; empty before the first batch."""
        wanted = defaultdict(list)
        for band, runs in self.versions.current()[1].get("runs", {}).items():
            for folder, _ in runs:
                wanted[folder].append(band)
        return archive.records(self._runs(wanted).withColumnRenamed("record_date", "d"))

    def fold(self, batch: DataFrame, batch_id: int) -> None:
        """Add the readings of a micro-batch."""
        number, content = self.versions.current()
        if content.get("batch", -1) >= batch_id:
            return
        band = F.floor(F.col("tile_lat") / BAND).cast("int").alias("band")
        fresh = archive.records(batch).persist()
        try:
            sizes = {str(r.band): r["count"] for r in fresh.groupBy(band).count().collect()}  # 18 bands
            runs, taken = content.get("runs", {}), defaultdict(list)
            for b, size in sizes.items():
                while runs.get(b) and runs[b][-1][1] <= 2 * size:
                    folder, rows = runs[b].pop()
                    taken[folder].append(b)
                    size += rows
            folder = self.versions.fresh("run")
            both = archive.records(self._runs(taken).unionByName(fresh).withColumnRenamed("record_date", "d"))
            both.select("*", band).write.partitionBy("band").parquet(self.versions.at(folder))
        finally:
            fresh.unpersist()
        if sizes:
            for r in self.spark.read.parquet(self.versions.at(folder)).groupBy("band").count().collect():
                runs.setdefault(str(r.band), []).append([folder, r["count"]])
        self.versions.commit(number + 1, {"batch": batch_id, "runs": runs})
        self.versions.clean()


def start(readings: DataFrame, root: str, checkpoint: str):
    """Start folding a stream of readings (d, product, tile_lat, tile_lon, max_c, max_lat, max_lon)."""
    ledger = Ledger(readings.sparkSession, root)
    return readings.writeStream.foreachBatch(ledger.fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def daily_maxima(events: DataFrame, delay: str = "2 days") -> DataFrame:
    """Maxima of each key and day of a stream (key, ts, value) by event-time windows with a watermark, for append-only sinks."""
    return events.withWatermark("ts", delay).groupBy(F.window("ts", "1 day"), "key").agg(F.max("value").alias("max_value"))
