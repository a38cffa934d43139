"""Refinement work: record cells of each day become padded boxes, and boxes become jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heatledger.functions import exprs as E
from heatledger.sources.tables import remove, scratch

BOX = "struct<west:double,south:double,east:double,north:double>"


def hot_cells(grid: DataFrame, bar: float) -> DataFrame:
    """Dated record cells at the bar or above, at their centres; a cell of both products counts twice."""
    hot = grid.filter((F.col("max_centi") >= int(round(bar * 100))) & F.col("record_date").isNotNull())
    return hot.select(F.col("record_date").alias("d"), "product", E.cell_lat(F.col("row")).alias("lat"), E.cell_lon(F.col("col")).alias("lon"), (F.col("max_centi") / 100).alias("max_c"))


def merge_boxes(boxes: list[tuple], reach: float) -> list[tuple]:
    """Boxes (west, south, east, north) merged while two are within ``reach`` on both axes.

    Boxes only grow, so the result does not depend on the order. A sweep from west to east compares a box only with those whose east edge is still
    within reach, and is repeated until it changes nothing.
    """
    changed = True
    while changed:
        changed = False
        out: list[tuple] = []
        active: list[tuple] = []
        for box in sorted(set(boxes)):
            near: list[tuple] = []
            for other in active:
                if box[0] - other[2] > reach:
                    out.append(other)
                else:
                    near.append(other)
            grown = box
            active = []
            for other in near:
                gap_x = max(0.0, max(grown[0], other[0]) - min(grown[2], other[2]))
                gap_y = max(0.0, max(grown[1], other[1]) - min(grown[3], other[3]))
                if gap_x <= reach and gap_y <= reach:
                    grown = (min(grown[0], other[0]), min(grown[1], other[1]), max(grown[2], other[2]), max(grown[3], other[3]))
                    changed = True
                else:
                    active.append(other)
            active.append(grown)
        boxes = out + active
    return boxes


def strips(cells: DataFrame, reach: float) -> DataFrame:
    """Boxes (d, west, south, east, north) of cells of one row joined where gaps are within reach."""
    half = 0.025
    points = cells.select("d", "lat", "lon").distinct()
    row = Window.partitionBy("d", "lat").orderBy("lon")
    # the same sums and differences as for single cells, so strips end exactly where those would
    gap = (F.col("lon") - half) - (F.lag("lon").over(row) + half)
    numbered = points.withColumn("new", F.coalesce((gap > reach).cast("int"), F.lit(1))).withColumn("strip", F.sum("new").over(row.rowsBetween(Window.unboundedPreceding, 0)))
    ends = numbered.groupBy("d", "lat", "strip").agg(F.min("lon").alias("first"), F.max("lon").alias("last"))
    return ends.select("d", (F.col("first") - half).alias("west"), (F.col("lat") - half).alias("south"), (F.col("last") + half).alias("east"), (F.col("lat") + half).alias("north"))


def touched(boxes: DataFrame, reach: float, side: float) -> DataFrame:
    """Boxes once for each coarse tile (tx, ty) of ``side`` degrees that they come within half the reach of; two boxes within reach share one."""
    grown = reach / 2 + 1e-6
    axis = lambda low, high: F.sequence(F.floor((F.col(low) - grown) / side), F.floor((F.col(high) + grown) / side))
    return boxes.withColumn("tx", F.explode(axis("west", "east"))).withColumn("ty", F.explode(axis("south", "north")))


def cluster(cells: DataFrame, reach: float = 0.5, side: float = 30.0) -> DataFrame:
    """Rows (d, west, south, east, north): the merged footprints of each day's cells.

    Cells of a row become strips first. Then, round by round, the boxes of a day and coarse tile are merged by a task, and the next round has what
    came out of all tiles: a box that two tiles made differently is there in both forms, which overlap and so merge then. Boxes only grow, and a merged one
    reaches into the tiles around, so clusters at least double in extent with each round; the last one changes nothing. No task holds a day, only the boxes of one coarse
    tile. Rounds are written to the shared folder.
    """
    import pyarrow as pa

    names = ("west", "south", "east", "north")
    schema = pa.schema([("d", pa.date32()), *[(n, pa.float64()) for n in names], ("changed", pa.bool_())])
    spark, side = cells.sparkSession, max(side, 2 * reach)

    def merged_in(key: tuple, given: set) -> list[tuple]:
        boxes = merge_boxes(list(given), reach)
        return [(key[0], *b, b not in given or len(boxes) < len(given)) for b in boxes]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    def run(items):
        # rows come in order of day and tile, so that one task's many small tiles cost no call each
        key, given, out = None, set(), []
        for b in items:
            for d, tx, ty, *box in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if (d, tx, ty) != key:
                    out += merged_in(key, given) if given else []
                    key, given = (d, tx, ty), set()
                given.add(tuple(box))
            if len(out) > 1 << 14:
                yield batch(out)
                out = []
        yield batch(out + (merged_in(key, given) if given else []))

    boxes, last = strips(cells, reach), None
    while True:
        dealt = touched(boxes, reach, side).select("d", "tx", "ty", *names).repartition("d", "tx", "ty").sortWithinPartitions("d", "tx", "ty")
        merged = dealt.mapInArrow(run, "d date, west double, south double, east double, north double, changed boolean")
        path = scratch(spark, "boxes")
        merged.groupBy("d", *names).agg(F.bool_or("changed").alias("changed")).write.parquet(path)
        if last is not None:
            remove(spark, last)
        boxes, last = spark.read.parquet(path), path
        if boxes.filter("changed").isEmpty():
            return boxes.select("d", *names)


def padded(pad: float) -> list[Column]:
    """Columns of a box grown on all sides, latitude clamped to the poles."""
    return [(F.col("west") - pad).alias("west"), F.greatest(E.dbl(-90), F.col("south") - pad).alias("south"), (F.col("east") + pad).alias("east"), F.least(E.dbl(90), F.col("north") + pad).alias("north")]


def split(boxes: DataFrame) -> DataFrame:
    """Boxes cut at the antimeridian, the western piece first (``piece`` 0)."""
    box = lambda w, e: F.struct(w.cast("double").alias("west"), F.col("south"), e.cast("double").alias("east"), F.col("north"))
    w, e = F.col("west"), F.col("east")
    pieces = (
        F.when(e - w >= 360, F.array(box(F.lit(-180), F.lit(180))))
        .when(e > 180, F.array(box(w, F.lit(180)), box(F.lit(-180), e - 360)))
        .when(w < -180, F.array(box(w + 360, F.lit(180)), box(F.lit(-180), e)))
        .otherwise(F.array(box(w, e)))
    )
    rest = [c for c in boxes.columns if c not in ("west", "south", "east", "north")]
    return boxes.select(*rest, F.posexplode(pieces).alias("piece", "b")).select(*rest, "piece", "b.west", "b.south", "b.east", "b.north")


def boxes(cells: DataFrame, reach: float = 0.5, pad: float = 0.1) -> DataFrame:
    """Final boxes of each day."""
    return split(cluster(cells, reach).select("d", *padded(pad))).drop("piece")


def jobs(cells: DataFrame, reach: float = 0.5, pad: float = 0.1) -> DataFrame:
    """One job for each day: its boxes from west to east, its cells and its hottest value."""
    listed = boxes(cells, reach, pad).groupBy("d").agg(F.array_sort(F.collect_list(F.struct(*[F.round(c, 3).alias(c) for c in ("west", "south", "east", "north")]))).alias("bboxes"))
    stats = cells.groupBy("d").agg(F.count(F.lit(1)).alias("cells"), F.max("max_c").alias("cmg_max_c"))
    return stats.join(listed, "d").select("d", "bboxes", "cells", "cmg_max_c")


def payload(work: DataFrame, bar: float, products: list[str], reach: float = 0.5, pad: float = 0.1) -> DataFrame:
    """Rows (day, json): the jobs as JSON lines with their provenance."""
    fields = F.struct(F.lit(bar).alias("bar_c"), F.array(*[F.lit(p) for p in products]).alias("source_products"), F.lit(reach).alias("merge_degrees"), F.lit(pad).alias("pad_degrees"), F.col("d").cast("string").alias("date"), "bboxes", "cells", F.round("cmg_max_c", 2).alias("cmg_max_c"))
    return work.select(F.col("d").alias("day"), F.to_json(fields).alias("json"))


def parse_jobs(lines: DataFrame) -> DataFrame:
    """Jobs of JSON lines (value) with ``problem``: NULL, or what is wrong with the job."""
    parsed = lines.select(F.from_json("value", f"date string, bboxes array<{BOX}>, cells long, cmg_max_c double").alias("j")).select("j.*")
    day = F.try_to_date("date", "yyyy-MM-dd")
    bad = lambda test: F.exists(F.col("bboxes"), test)
    missing = bad(lambda b: b.isNull() | b["west"].isNull() | b["south"].isNull() | b["east"].isNull() | b["north"].isNull())
    problem = (
        F.when(day.isNull(), "no date").when(F.coalesce(F.size("bboxes"), F.lit(0)) <= 0, "no boxes").when(missing, "not four numbers")
        .when(bad(lambda b: (b["west"] >= b["east"]) | (b["south"] >= b["north"])), "inverted box")
        .when(bad(lambda b: (b["west"] < -180) | (b["east"] > 180) | (b["south"] < -90) | (b["north"] > 90)), "off the globe")
    )
    return parsed.withColumns({"d": day, "problem": problem})


def box_tiles(work: DataFrame, side: int = 10) -> DataFrame:
    """Boxes (jd, west, south, east, north) of jobs once for each coarse tile (jlat, jlon) of ``side`` degrees that they touch."""
    axis = lambda low, high: F.sequence(F.floor(F.col(low) / side), F.floor(F.col(high) / side))
    flat = work.select("d", F.explode("bboxes").alias("b")).select("d", "b.*")
    at = flat.withColumn("jlat", F.explode(axis("south", "north"))).withColumn("jlon", F.explode(axis("west", "east")))
    return at.select(F.col("d").alias("jd"), "jlat", "jlon", "west", "south", "east", "north")


def inside(pixels: DataFrame, work: DataFrame, side: int = 10) -> DataFrame:
    """Pixels of each job's day within one of its boxes: boxes go to the coarse tiles they touch, then an equi-join.

    A day's boxes are apart by their reach, so a tile has few, and a box of the whole globe is some 700 rows.
    """
    on = (F.col("d") == F.col("jd")) & (F.floor(F.col("lat") / side) == F.col("jlat")) & (F.floor(F.col("lon") / side) == F.col("jlon"))
    return pixels.join(box_tiles(work, side), on & F.col("lat").between(F.col("south"), F.col("north")) & F.col("lon").between(F.col("west"), F.col("east")), "left_semi")


def granule_estimate(work: DataFrame, products: int) -> DataFrame:
    """One row: the least and most granules the jobs may take, one to four for each box and product."""
    return work.agg((F.sum(F.size("bboxes")) * products).alias("least")).withColumn("most", F.col("least") * 4)
