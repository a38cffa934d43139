"""Cross-satellite corroboration of a day's maxima, with one window over (day, tile) instead of a self-join."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heatledger import schema as S

POLICY = S.Policy()


def verdicts(tiles: DataFrame, policy: S.Policy = POLICY) -> DataFrame:
    """Winner and witness of each day and tile, and what the screen decided.

    ``ordinary`` winners are below record tier, ``agree`` ones have a witness within tolerance, ``lone`` ones have
    none, ``rejected`` ones are contradicted, and ``both_out`` ones as well by a witness that is itself record-tier.
    """
    day = Window.partitionBy("d", "tile_lat", "tile_lon").orderBy(F.desc("max_c"), "product")
    ranked = tiles.withColumn("place", F.row_number().over(day)).filter("place <= 2")
    pick = lambda c, k: F.max(F.when(F.col("place") == k, F.col(c)))
    cols = ("product", "max_c", "max_lat", "max_lon")
    both = ranked.groupBy("d", "tile_lat", "tile_lon").agg(*[pick(c, k).alias(f"{who}_{c}") for k, who in ((1, "winner"), (2, "witness")) for c in cols])
    w, v = F.col("winner_max_c"), F.col("witness_max_c")
    verdict = F.when(w < policy.record_threshold, "ordinary").when(v.isNull(), "lone").when(w - v <= policy.record_tolerance, "agree").when(v >= policy.record_threshold, "both_out").otherwise("rejected")
    ceiling = F.when(F.col("verdict").isin("lone", "both_out"), policy.uncorroborated_ceiling).when(F.col("verdict") == "rejected", v)
    return both.withColumn("verdict", verdict).withColumn("ceiling", ceiling)


def _reading(rows: DataFrame, who: str) -> DataFrame:
    return rows.select("d", "tile_lat", "tile_lon", *[F.col(f"{who}_{c}").alias(c) for c in ("product", "max_c", "max_lat", "max_lon")])


def weather(judged: DataFrame) -> DataFrame:
    """What may enter the archive: winners that stand, and the witness where it takes a rejected winner's place."""
    stands = judged.filter(F.col("verdict").isin("ordinary", "agree"))
    return _reading(stands, "winner").unionByName(_reading(judged.filter("verdict = 'rejected'"), "witness"))


def ceilings(judged: DataFrame) -> DataFrame:
    """The highest temperature a tile's raster may show on a day the screen ruled on it."""
    return judged.filter("ceiling IS NOT NULL").select("d", "tile_lat", "tile_lon", "ceiling")


def screened_out(judged: DataFrame) -> DataFrame:
    """Anomalies of the screen, with their notes."""
    failed = _reading(judged.filter(F.col("verdict").isin("rejected", "both_out")), "winner").withColumns({"cause": F.lit("failed corroboration"), "note": F.lit(S.REJECTED_NOTE)})
    lone = _reading(judged.filter("verdict = 'lone'"), "winner").unionByName(_reading(judged.filter("verdict = 'both_out'"), "witness"))
    return failed.unionByName(lone.withColumns({"cause": F.lit("uncorroborated"), "note": F.lit(S.UNCORROBORATED_NOTE)}))


def all_anomalies(granule_level: DataFrame, judged: DataFrame) -> DataFrame:
    """One row for each day, product, tile and cause: the hottest of what masks and corroboration set aside."""
    cols = ["d", "product", "tile_lat", "tile_lon", "cause", "max_c", "max_lat", "max_lon"]
    union = granule_level.select(*cols).unionByName(screened_out(judged).select(*cols))
    best = union.groupBy(*cols[:5]).agg(F.max(F.struct(*cols[5:])).alias("best"))
    return best.select(*cols[:5], "best.*")
