"""The permanent archive as one versioned store: display levels, base state, table rows and manifest change together or not at all.

Levels and state are kept by blocks of 8 by 8 tiles, a folder each, so a day writes the blocks it changes and no others; a version's pointer names the
folder of every block. The steps of a day write new folders in the order levels, state, rows; the pointer, which carries the manifest, comes last. A stop between two
steps leaves the version before it, and running the day again merges to the same answer, as maxima are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatledger import schema as S
from heatledger.operators import archive, raster
from heatledger.sources.versions import Versions

SIDE = S.TILE_PIXELS * raster.BLOCK_TILES
LEVEL, STATE = "z int, px int, py int, rank int", "z int, px int, py int, centi int"
ROWS = "tile_lat int, tile_lon int, max_c double, record_date date, product string, max_lat double, max_lon double"


def _blocked(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"bx": F.expr(f"px DIV {SIDE}").cast("int"), "by": F.expr(f"py DIV {SIDE}").cast("int")})


def read_blocks(store: Versions, blocks: dict[str, str], schema: str, wanted: list[str] | None = None) -> DataFrame:
    """Rows of some blocks, all for None; a block is named ``z/bx/by`` and has its own folder."""
    names = blocks if wanted is None else [w for w in wanted if w in blocks]
    paths = [store.at(blocks[n]) for n in names]
    return store.spark.read.schema(schema).parquet(*paths) if paths else store.spark.createDataFrame([], schema)


def _write_blocks(store: Versions, name: str, rows: DataFrame) -> dict[str, str]:
    """Write rows by block and tell each block's folder; 341 blocks of levels and 256 of state at most."""
    folder = store.fresh(name)
    keyed = _blocked(rows).withColumn("zoom", F.col("z"))  # z itself stays in the files, which are read one block at a time
    keyed.repartition("zoom", "bx", "by").write.partitionBy("zoom", "bx", "by").parquet(store.at(folder))
    written = store.spark.read.parquet(store.at(folder)).select("zoom", "bx", "by").distinct().collect()
    return {f"{r.zoom}/{r.bx}/{r.by}": f"{folder}/zoom={r.zoom}/bx={r.bx}/by={r.by}" for r in written}


def _names(tiles: DataFrame) -> list[str]:
    """Blocks of tiles (z, tx, ty)."""
    n = raster.BLOCK_TILES
    return [f"{r.z}/{r.bx}/{r.by}" for r in tiles.select("z", F.expr(f"tx DIV {n}").cast("int").alias("bx"), F.expr(f"ty DIV {n}").cast("int").alias("by")).distinct().collect()]


def fold_day(store: Versions, today: DataFrame, weather: DataFrame, day: str, after: Callable[[str], None] = lambda step: None) -> None:
    """Fold a day's base raster (px, py, centi) and readings (d, product, tile_lat, tile_lon, max_c, max_lat, max_lon) into the archive.

    ``after`` is told the name of each step when it is done.
    """
    number, content = store.current()
    levels, state = dict(content.get("levels", {})), dict(content.get("state", {}))
    base = F.lit(S.BASE_ZOOM)
    at = lambda rows: rows.withColumns({"tx": F.shiftright("px", 8), "ty": F.shiftright("py", 8)})
    today = today.select("px", "py", "centi").persist()
    touched = _names(at(today).select(base.alias("z"), "tx", "ty").distinct())
    stored = read_blocks(store, state, STATE, touched).select("px", "py", "centi")
    merged, _ = raster.merge_state(stored, today)
    merged = merged.persist()
    changed = at(merged.join(stored, ["px", "py", "centi"], "left_anti")).select("tx", "ty").distinct().persist()
    try:
        created = 0
        dirty = raster.dirty_tiles(changed)
        blocks = _names(dirty)
        if blocks:
            shown = read_blocks(store, levels, LEVEL, blocks)
            fresh, tiles = raster.changed_levels(merged, changed, _blocked(shown))
            others = at(shown).join(dirty, ["z", "tx", "ty"], "left_anti").select("z", "px", "py", "rank")
            created = tiles.filter("created").count()
            levels |= _write_blocks(store, "levels", fresh.select("z", "px", "py", "rank").unionByName(others))
            after("levels")
            state |= _write_blocks(store, "state", merged.select(base.alias("z"), "px", "py", "centi"))
            after("state")
    finally:
        for held in (changed, merged, today):
            held.unpersist()
    rows = store.fresh("rows")
    old = store.spark.read.schema(ROWS).parquet(store.at(content["rows"])) if "rows" in content else store.spark.createDataFrame([], ROWS)
    archive.merge(old, weather).write.parquet(store.at(rows))
    after("rows")
    prior = content.get("manifest", {})
    manifest = {"since": min(day, prior.get("since", day)), "through": max(day, prior.get("through", day)), "tile_count": prior.get("tile_count", 0) + created}
    store.commit(number + 1, {"levels": levels, "state": state, "rows": rows, "manifest": manifest})
    after("manifest")


def read(store: Versions) -> tuple[DataFrame, DataFrame, DataFrame, dict]:
    """Levels, state, rows and manifest of the newest version."""
    _, content = store.current()
    rows = store.spark.read.schema(ROWS).parquet(store.at(content["rows"])) if content else store.spark.createDataFrame([], ROWS)
    state = read_blocks(store, content.get("state", {}), STATE).select("px", "py", "centi")
    return read_blocks(store, content.get("levels", {}), LEVEL), state, rows, content.get("manifest", {})
