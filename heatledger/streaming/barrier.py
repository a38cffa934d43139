"""Day barrier of the stream: a day's tiles are held until every satellite has closed the day, and ruled on again when one comes late.

Two streams come in: day tiles of each product, and closings, a row (d, product) when a product's run for a day has ended. State is kept
for each day and band of latitudes, so a band has at most ``BAND`` times 360 tiles a product and no key holds a whole day; a
closing goes to all bands. Once all expected products have closed, the band's tiles are released together; what comes later releases the tiles it changes
anew, with all products' readings of them, so each release can be ruled on by itself. The ruling is ``corroborate.verdicts`` over each micro-batch.

Defined results: of several readings of a product and tile the hottest counts, of equals that at the larger position, so neither order nor
repetition changes the outcome. Days that a product never closes stay held. State has no expiry, as history may be filled in years later; it lives in the
checkpoint. With many days choose Spark's RocksDB state store, which keeps it on disk.
"""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from heatledger.operators import corroborate

#: Degrees of latitude of a band.
BAND = 10
READING = "d date, product string, tile_lat int, tile_lon int, max_c double, max_lat double, max_lon double"
#: Closed products, whether the band was released, and the hottest reading of each product and tile in parallel lists.
STATE = "closed array<string>, released boolean, product array<string>, tile_lat array<int>, tile_lon array<int>, max_c array<double>, max_lat array<double>, max_lon array<double>"


def _hold(expected: frozenset):
    """Readings to release for a band of a day."""

    def run(key, frames: Iterable[pd.DataFrame], state: GroupState):
        closed, released, *lists = state.get if state.exists else ([], False, [], [], [], [], [], [])
        closed = set(closed)
        best = {(p, a, o): r for p, a, o, *r in zip(*lists, strict=True)}
        changed = set()
        for frame in frames:
            closed.update(frame.loc[frame.closes, "product"])
            rows = frame[~frame.closes]
            for p, a, o, *r in zip(*[rows[c].tolist() for c in ("product", "tile_lat", "tile_lon", "max_c", "max_lat", "max_lon")], strict=True):
                if (p, a, o) not in best or r > best[p, a, o]:
                    best[p, a, o] = r
                    changed.add((a, o))
        out = []
        if expected <= closed:
            out = [(key[0], *k, *r) for k, r in best.items() if not released or k[1:] in changed]
            released = True
        flat = [list(x) for x in zip(*[(*k, *r) for k, r in best.items()], strict=True)] or [[]] * 6
        state.update((sorted(closed), released, *flat))
        if out:
            yield pd.DataFrame(out, columns=["d", "product", "tile_lat", "tile_lon", "max_c", "max_lat", "max_lon"])

    return run


def released(tiles: DataFrame, closings: DataFrame, products: list[str]) -> DataFrame:
    """The stream of readings let through, of streams of day tiles and of closings (d, product)."""
    names = ["d", "product", "tile_lat", "tile_lon", "max_c", "max_lat", "max_lon"]
    band = F.floor(F.col("tile_lat") / BAND).cast("int")
    held = tiles.select(*names, F.lit(False).alias("closes"), band.alias("band"))
    bands = F.sequence(F.lit(-90 // BAND), F.lit(89 // BAND))
    ends = closings.select("d", "product", *[F.lit(0).cast(t).alias(c) for c, t in (("tile_lat", "int"), ("tile_lon", "int"), ("max_c", "double"), ("max_lat", "double"), ("max_lon", "double"))], F.lit(True).alias("closes"), F.explode(bands).alias("band"))
    keyed = held.unionByName(ends).groupBy("d", "band")
    return keyed.applyInPandasWithState(_hold(frozenset(products)), READING, STATE, "append", GroupStateTimeout.NoTimeout)


def start(tiles: DataFrame, closings: DataFrame, products: list[str], root: str, checkpoint: str):
    """Start ruling on days as they close. Verdicts of micro-batch n are in ``root``/revision=n; a batch run again writes the same again."""

    def rule(batch: DataFrame, batch_id: int) -> None:
        corroborate.verdicts(batch).write.mode("overwrite").parquet(f"{root}/revision={batch_id}")

    return released(tiles, closings, products).writeStream.foreachBatch(rule).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def verdicts(spark: SparkSession, root: str) -> DataFrame:
    """The verdicts that stand: of each day and tile those of the latest revision."""
    rows = spark.read.option("basePath", root).parquet(f"{root}/revision=*")
    keys = ["d", "tile_lat", "tile_lon"]
    rest = [c for c in rows.columns if c not in (*keys, "revision")]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "revision").alias("last"))
    return last.select(*keys, "last.*")
