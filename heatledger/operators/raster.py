"""A sparse raster pyramid: rows (z, px, py, centi) instead of dense tiles; a pixel without a row was not observed."""

from __future__ import annotations

import struct
import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heatledger import schema as S
from heatledger.functions import exprs as E


def base(pixels: DataFrame, least: float = 40.0, *keys: str) -> DataFrame:
    """Hottest value of each base pixel (and ``keys``), of pixels (lat, lon, c) at ``least`` or more."""
    hot = pixels.filter(F.col("c") >= least).select(*keys, E.mercator_px(F.col("lon")).alias("px"), E.mercator_py(F.col("lat")).alias("py"), E.centi(F.col("c")).alias("centi"))
    return hot.groupBy(*keys, "px", "py").agg(F.max("centi").alias("centi"))


def pyramid(raster: DataFrame, *keys: str) -> DataFrame:
    """All zooms by max-pooling: each base pixel goes to its ancestor at every zoom, and one aggregation pools them."""
    up = raster.select(*keys, "px", "py", "centi", F.explode(F.sequence(F.lit(0), F.lit(S.BASE_ZOOM))).alias("z"))
    shift = F.lit(S.BASE_ZOOM) - F.col("z")
    return up.select(*keys, "z", F.expr(f"shiftright(px, {S.BASE_ZOOM} - z)").alias("px"), F.expr(f"shiftright(py, {S.BASE_ZOOM} - z)").alias("py"), "centi", shift.alias("s")).groupBy(*keys, "z", "px", "py").agg(F.max("centi").alias("centi"))


def ranks(levels: DataFrame) -> DataFrame:
    return levels.withColumn("rank", E.palette_rank(F.col("centi")))


def drop_above(raster: DataFrame, ceilings: DataFrame, *keys: str) -> DataFrame:
    """Base pixels that a tile's ceiling still allows; the tile is that of the pixel's centre. Dropped, never clamped."""
    limit = ceilings.select(*keys, F.col("tile_lat").alias("c_lat"), F.col("tile_lon").alias("c_lon"), E.centi(F.col("ceiling")).alias("limit"))
    placed = raster.withColumns({"c_lat": E.tile_lat(E.pixel_lat(F.col("py"))), "c_lon": E.tile_lon(E.pixel_lon(F.col("px")))})
    joined = placed.join(limit, [*keys, "c_lat", "c_lon"], "left")
    return joined.filter(F.col("limit").isNull() | (F.col("centi") <= F.col("limit"))).select(*raster.columns)


def merge_state(stored: DataFrame, today: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Base rasters folded by maximum, and the base tiles (tx, ty) that changed."""
    merged = stored.unionByName(today).groupBy("px", "py").agg(F.max("centi").alias("centi"))
    changed = merged.join(stored, ["px", "py", "centi"], "left_anti")
    return merged, changed.select(F.shiftright("px", 8).alias("tx"), F.shiftright("py", 8).alias("ty")).distinct()


def refresh(levels: DataFrame, merged: DataFrame, changed: DataFrame) -> DataFrame:
    """The pyramid after a change: only ancestors of changed base tiles are pooled anew, other rows stay."""
    tiles = changed.select("tx", "ty", F.explode(F.sequence(F.lit(0), F.lit(S.BASE_ZOOM))).alias("z"))
    dirty = tiles.select("z", F.expr(f"shiftright(tx, {S.BASE_ZOOM} - z)").alias("ax"), F.expr(f"shiftright(ty, {S.BASE_ZOOM} - z)").alias("ay")).distinct()

    def at(df: DataFrame) -> DataFrame:
        return df.withColumns({"ax": F.shiftright("px", 8), "ay": F.shiftright("py", 8)})

    # a dirty ancestor at any zoom pools every base pixel below it
    below = merged.select("px", "py", "centi", F.explode(F.sequence(F.lit(0), F.lit(S.BASE_ZOOM))).alias("z"))
    below = below.select("z", F.expr(f"shiftright(px, {S.BASE_ZOOM} - z)").alias("px"), F.expr(f"shiftright(py, {S.BASE_ZOOM} - z)").alias("py"), "centi")
    fresh = at(below).join(dirty, ["z", "ax", "ay"], "left_semi").groupBy("z", "px", "py").agg(F.max("centi").alias("centi"))
    kept = at(levels).join(dirty, ["z", "ax", "ay"], "left_anti").select("z", "px", "py", "centi")
    return kept.unionByName(fresh)


#: Tiles along an edge of a block, the unit in which stored levels are read.
BLOCK_TILES = 8


def write_levels(levels: DataFrame, path: str) -> None:
    """Store rank rows (z, px, py, rank) in a folder for each zoom and block of 8 by 8 tiles."""
    side = S.TILE_PIXELS * BLOCK_TILES
    keyed = levels.withColumns({"bx": F.expr(f"px DIV {side}").cast("int"), "by": F.expr(f"py DIV {side}").cast("int")})
    keyed.repartition("z", "bx", "by").write.partitionBy("z", "bx", "by").parquet(path)


def dirty_tiles(changed: DataFrame) -> DataFrame:
    """The changed base tiles (tx, ty) and all their ancestors as (z, tx, ty); 21,845 tiles at most, as the base has 128 by 128."""
    up = changed.select("tx", "ty", F.explode(F.sequence(F.lit(0), F.lit(S.BASE_ZOOM))).alias("z"))
    return up.select("z", F.expr(f"shiftright(tx, {S.BASE_ZOOM} - z)").alias("tx"), F.expr(f"shiftright(ty, {S.BASE_ZOOM} - z)").alias("ty")).distinct()


def read_levels(stored: DataFrame, dirty: DataFrame) -> DataFrame:
    """Stored rank rows of dirty tiles; ``stored`` is partitioned as ``write_levels`` does.

    The blocks of the dirty tiles, 341 of them at most, become a filter on the partition columns, so other blocks' files are not opened.
    """
    blocks = dirty.select("z", F.expr(f"tx DIV {BLOCK_TILES}").cast("int").alias("bx"), F.expr(f"ty DIV {BLOCK_TILES}").cast("int").alias("by")).distinct().collect()
    by_column: dict[tuple[int, int], list[int]] = {}
    for b in blocks:
        by_column.setdefault((b.z, b.bx), []).append(b.by)
    wanted = F.lit(False)
    for (z, bx), bys in sorted(by_column.items()):
        wanted |= (F.col("z") == z) & (F.col("bx") == bx) & F.col("by").isin(sorted(bys))
    rows = stored.filter(wanted).select("z", "px", "py", "rank", F.shiftright("px", 8).alias("tx"), F.shiftright("py", 8).alias("ty"))
    return rows.join(dirty, ["z", "tx", "ty"], "left_semi")


def changed_levels(state: DataFrame, changed: DataFrame, stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What a change of base tiles does to the stored levels: rank rows (z, px, py, rank) of all tiles to be rewritten, and
    these tiles (z, tx, ty, created), created where the store has no pixel of them yet.

    Ranks rise with the temperature, so the rank of a maximum is the maximum of ranks, and a parent is its stored ranks raised by its changed children. Only
    pixels of changed base tiles (of ``state``, px, py, centi) are pooled, and only blocks of the store with dirty tiles are read.
    """
    dirty = dirty_tiles(changed)
    own = state.join(changed.select("tx", "ty").distinct(), (F.shiftright("px", 8) == F.col("tx")) & (F.shiftright("py", 8) == F.col("ty")), "left_semi")
    pooled = ranks(pyramid(own.select("px", "py", "centi"))).select("z", "px", "py", "rank")
    old = read_levels(stored, dirty)
    levels = pooled.unionByName(old.select("z", "px", "py", "rank")).groupBy("z", "px", "py").agg(F.max("rank").alias("rank"))
    had = old.select("z", "tx", "ty").distinct().withColumn("had", F.lit(True))
    return levels, dirty.join(had, ["z", "tx", "ty"], "left").select("z", "tx", "ty", F.col("had").isNull().alias("created"))


#: Fixed heat colours of ranks 1 to 5.
COLOURS = ("C9B896", "C79B5B", "BC7431", "9A4E17", "6E3410")


def png(pixels: list[tuple[int, int, int]], size: int = S.TILE_PIXELS) -> bytes:
    """A palette PNG of (x, y, rank); rank 0, transparent, elsewhere."""
    rows = [bytearray(size + 1) for _ in range(size)]  # each row begins with filter type 0
    for x, y, rank in pixels:
        rows[y][x + 1] = rank

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    head = struct.pack(">IIBBBBB", size, size, 8, 3, 0, 0, 0)
    palette = b"\0\0\0" + b"".join(bytes.fromhex(c) for c in COLOURS)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"PLTE", palette) + chunk(b"tRNS", b"\0") + chunk(b"IDAT", zlib.compress(b"".join(rows))) + chunk(b"IEND", b"")


def _unfiltered(rows: bytes, stride: int, step: int) -> list[bytearray]:
    """Rows of an image without their row filters; ``step`` is the distance to the pixel on the left in bytes."""
    out: list[bytearray] = []
    above = bytearray(stride)
    for at in range(0, len(rows), stride + 1):
        kind, row = rows[at], bytearray(rows[at + 1 : at + 1 + stride])
        for i in range(stride if kind else 0):
            left, up, corner = (row[i - step] if i >= step else 0), above[i], (above[i - step] if i >= step else 0)
            guess = left + up - corner
            nearest = min((abs(guess - left), 0, left), (abs(guess - up), 1, up), (abs(guess - corner), 2, corner))[2]
            row[i] = (row[i] + (0, left, up, (left + up) // 2, nearest)[kind]) & 255
        out.append(row)
        above = row
    return out


def png_ranks(data: bytes) -> list[tuple[int, int, int]]:
    """The pixels (x, y, rank) with a rank of a palette PNG of any bit depth and row filters; other images are an error."""
    at, packed, width, depth = 8, b"", 0, 8
    while at < len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + n]
        if kind == b"IHDR":
            width, _, depth, colour, _, _, interlaced = struct.unpack(">IIBBBBB", body[:13])
            if colour != 3 or interlaced:
                raise ValueError("not a palette image without interlacing")
        packed += body if kind == b"IDAT" else b""
        at += 12 + n
    each, mask = 8 // depth, (1 << depth) - 1
    rows = _unfiltered(zlib.decompress(packed), -(-width // each), 1)
    ranks = ((x, y, row[x // each] >> (8 - depth * (x % each + 1)) & mask) for y, row in enumerate(rows) for x in range(width))
    return [r for r in ranks if r[2]]


def read_tiles(images: DataFrame) -> DataFrame:
    """Rows (z, px, py, rank) of tiles (z, x, y, image)."""
    import pyarrow as pa

    schema = pa.schema([(n, pa.int32()) for n in ("z", "px", "py", "rank")])

    def decode(items):
        for b in items:
            for z, x, y, image in zip(*[c.to_pylist() for c in b.columns], strict=True):
                found = png_ranks(image)
                columns = [[z] * len(found), [x * S.TILE_PIXELS + i for i, _, _ in found], [y * S.TILE_PIXELS + j for _, j, _ in found], [r for _, _, r in found]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()) for c in columns], schema=schema)

    return images.select("z", "x", "y", "image").mapInArrow(decode, "z int, px int, py int, rank int")


def object_path(kind: str, z: Column, x: Column, y: Column, day: Column | None = None) -> Column:
    """Where an object lies: a day's tile, a tile of all time or the state of a base tile (``day``, ``alltime``, ``state``)."""
    if kind == "day":
        return F.concat_ws("/", F.date_format(day, "yyyy-MM-dd"), z, x, F.concat(y.cast("string"), F.lit(".png")))
    if kind == "alltime":
        return F.concat_ws("/", F.lit("alltime"), z, x, F.concat(y.cast("string"), F.lit(".png")))
    return F.concat_ws("/", F.lit("alltime-state"), x, F.concat(y.cast("string"), F.lit(".npy")))


def tiles(levels: DataFrame) -> DataFrame:
    """Rows (z, x, y, path, image): a PNG for each tile with a pixel; a tile has 65,536 pixels at most."""
    import pyarrow as pa

    schema = pa.schema([("z", pa.int32()), ("x", pa.int32()), ("y", pa.int32()), ("path", pa.string()), ("image", pa.binary())])

    def encode(key, table):
        z, x, y = (k.as_py() for k in key)
        found = list(zip(table.column("i").to_pylist(), table.column("j").to_pylist(), table.column("rank").to_pylist(), strict=True))
        return pa.table([[z], [x], [y], [f"{z}/{x}/{y}.png"], [png(found)]], schema=schema)

    rows = ranks(levels).select("z", F.shiftright("px", 8).alias("x"), F.shiftright("py", 8).alias("y"), (F.col("px") % 256).alias("i"), (F.col("py") % 256).alias("j"), "rank")
    return rows.groupBy("z", "x", "y").applyInArrow(encode, "z int, x int, y int, path string, image binary")
