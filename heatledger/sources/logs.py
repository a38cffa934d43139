"""Text logs of finished work, and what is still to do."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatledger import schema as S


def done_days(lines: DataFrame) -> DataFrame:
    """Days named by lines (value); blanks, comments and other text are skipped."""
    text = F.trim("value")
    day = F.try_to_date(F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text), "yyyy-MM-dd")
    return lines.select(day.alias("d")).filter("d IS NOT NULL").distinct()


def succeeded_days(lines: DataFrame) -> DataFrame:
    """Days with a line ``date product=code ...`` that has codes, all of them zero."""
    words = F.filter(F.split(F.trim("value"), r"\s+"), lambda w: w != "")
    parsed = lines.select(words.alias("w")).filter(F.size("w") > 1)
    first = F.get("w", F.lit(0))
    day = F.try_to_date(F.when(first.rlike(r"^\d{4}-\d{2}-\d{2}$"), first), "yyyy-MM-dd")
    ok = F.forall(F.slice("w", F.lit(2), F.size("w")), lambda x: F.coalesce(F.regexp_extract(x, r"^[^=]*=([+-]?\d+)$", 1).rlike(r"^[+-]?0+$"), F.lit(False)))
    return parsed.filter(ok).select(day.alias("d")).filter("d IS NOT NULL").distinct()


def calendar(spark, start: str, end: str) -> DataFrame:
    """Days from start to end; none if they are reversed."""
    rows = spark.createDataFrame([(start, end)], "a string, b string").select(F.col("a").cast("date").alias("a"), F.col("b").cast("date").alias("b")).filter("a <= b")
    return rows.select(F.explode(F.sequence("a", "b")).alias("d"))


def pending(days: DataFrame, done: DataFrame, limit: int | None = None) -> DataFrame:
    """Days that are not done, in order; the limit counts days left over."""
    left = days.join(done, "d", "left_anti").orderBy("d")
    return left if limit is None else left.limit(limit)


def flying(days: DataFrame, products: DataFrame) -> DataFrame:
    """Days crossed with the products (product) that flew on them; an unknown product is kept."""
    start = F.when(F.lit(False), F.lit(None).cast("date"))
    for name, _, _, first in S.PRODUCTS:
        start = start.when(F.col("product") == name, F.lit(first).cast("date"))
    dim = products.select("product", F.coalesce(start, F.lit("0001-01-01").cast("date")).alias("first"))
    return days.join(F.broadcast(dim), F.col("d") >= F.col("first")).drop("first")  # a product dimension has a handful of rows


def lines(codes: DataFrame) -> DataFrame:
    """Done-log lines (d, line) of exit codes (d, product, code): the day, then product=code by product."""
    each = F.array_sort(F.collect_list(F.struct("product", F.concat_ws("=", "product", F.col("code").cast("string")).alias("text"))))
    days = codes.groupBy("d").agg(each.alias("each"))
    return days.select("d", F.concat_ws(" ", F.date_format("d", "yyyy-MM-dd"), F.transform("each", lambda x: x["text"])).alias("line"))
