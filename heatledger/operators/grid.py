"""The historical grid: all-time maxima of 0.05-degree cells and record candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatledger.functions import exprs as E


def cells(pixels: DataFrame) -> DataFrame:
    """Pixels with their grid cell and hundredths."""
    return pixels.withColumns({"row": E.grid_row(F.col("lat")), "col": E.grid_col(F.col("lon")), "centi": E.centi(F.col("c"))})


def fold(gridded: DataFrame) -> DataFrame:
    """All-time maximum of each product's cell and the earliest day that reached it: the whole history in one aggregation."""
    best = F.min(F.struct((-F.col("centi")).alias("m"), F.col("d"))).alias("best")
    rows = gridded.groupBy("product", "row", "col").agg(best)
    return rows.select("product", "row", "col", (-F.col("best.m")).alias("max_centi"), F.col("best.d").alias("record_date"))


def global_max(grid: DataFrame) -> DataFrame:
    """The hottest cell of each product; of equals the northernmost, then the westernmost."""
    best = F.min(F.struct((-F.col("max_centi")).alias("m"), "row", "col", "record_date")).alias("best")
    rows = grid.groupBy("product").agg(best)
    return rows.select("product", (-F.col("best.m")).alias("max_centi"), F.col("best.row").alias("row"), F.col("best.col").alias("col"), F.col("best.record_date").alias("record_date"))


def counts_by_bar(grid: DataFrame, bars: tuple[int, ...] = (50, 55, 60, 65, 70)) -> DataFrame:
    """Observed cells of each product and how many reach each bar."""
    return grid.groupBy("product").agg(F.count(F.lit(1)).alias("observed"), *[F.count_if(F.col("max_centi") >= bar * 100).alias(f"at_{bar}") for bar in bars])


def candidates(gridded: DataFrame, bar: float) -> DataFrame:
    """Each day's hottest value of a cell at the bar or above, at the cell's centre."""
    best = gridded.filter(F.col("centi") >= int(round(bar * 100))).groupBy("product", "d", "row", "col").agg(F.max("centi").alias("centi"))
    return best.select("product", "d", "row", "col", E.cell_lat(F.col("row")).alias("cell_lat"), E.cell_lon(F.col("col")).alias("cell_lon"), (F.col("centi") / 100).alias("max_c"))


def dedupe(found: DataFrame) -> DataFrame:
    """One row for each day and cell, the hotter product's."""
    return found.groupBy("d", "cell_lat", "cell_lon").agg(F.max("max_c").alias("max_c"))


def top(found: DataFrame, n: int) -> DataFrame:
    if n < 0:
        raise ValueError("n must not be negative")
    return found.orderBy(F.desc("max_c"), "d", F.desc("cell_lat"), "cell_lon").limit(n)


def day_maximum(gridded: DataFrame) -> DataFrame:
    """The hottest cell of each day; of equals the first in row-major order."""
    best = F.min(F.struct((-F.col("centi")).alias("m"), "row", "col")).alias("best")
    rows = gridded.groupBy("d").agg(best)
    return rows.select("d", (-F.col("best.m")).alias("max_centi"), F.col("best.row").alias("row"), F.col("best.col").alias("col"))


def summary(found: DataFrame, grid: DataFrame) -> DataFrame:
    """One row: candidate counts and grid statistics."""
    left = found.agg(F.count(F.lit(1)).alias("candidates"), F.count_distinct("d").alias("days"), F.max("max_c").alias("hottest"))
    right = grid.agg(F.count(F.lit(1)).alias("cells"), F.max("max_centi").alias("max_centi"))
    return left.join(right, F.lit(True))


def write_candidates(found: DataFrame, path: str) -> None:
    """Candidates as CSV, one folder for each product and year, days as ISO dates and fixed decimals."""
    rows = found.select("product", F.year("d").alias("year"), F.date_format("d", "yyyy-MM-dd").alias("day"), F.format_string("%.3f", "cell_lat").alias("cell_lat"), F.format_string("%.3f", "cell_lon").alias("cell_lon"), F.format_string("%.2f", "max_c").alias("max_c"))
    rows.write.partitionBy("product", "year").mode("append").csv(path, header=True)


def read_candidates(spark, path: str) -> DataFrame:
    """Candidates of all years; lines that are cut off or malformed are skipped."""
    raw = spark.read.csv(path, header=True, schema="day string, cell_lat string, cell_lon string, max_c string, product string, year int")
    parsed = raw.select("product", F.try_to_date("day", "yyyy-MM-dd").alias("d"), *[F.expr(f"try_cast({c} AS DOUBLE)").alias(c) for c in ("cell_lat", "cell_lon", "max_c")])
    return parsed.dropna(subset=["d", "cell_lat", "cell_lon", "max_c"])
