"""Place names by half-degree cell, from captured geocoder replies; no network."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatledger.functions import exprs as E
from heatledger.sources.versions import Versions


def with_cell(readings: DataFrame) -> DataFrame:
    return readings.withColumns({"cell_lat": E.place_cell(F.col("max_lat")), "cell_lon": E.place_cell(F.col("max_lon"))})


def named(readings: DataFrame, places: DataFrame) -> DataFrame:
    """Readings with the name and country of their cell; those of volcanic rows stay NULL, where there is a cause."""
    left = with_cell(readings)
    on = (left["cell_lat"] == places["cell_lat"]) & (left["cell_lon"] == places["cell_lon"])
    if "cause" in readings.columns:
        on = on & (F.coalesce(left["cause"], F.lit("")) != "volcanic")
    return left.join(places.select("cell_lat", "cell_lon", "place_name", "country"), on, "left").select(left["*"], "place_name", "country")


def unnamed_cells(readings: DataFrame, places: DataFrame) -> DataFrame:
    """Cells of readings that no lookup has answered, hottest first; a cached NULL name is an answer."""
    wanted = with_cell(readings).groupBy("cell_lat", "cell_lon").agg(F.max("max_c").alias("max_c"))
    return wanted.join(places, ["cell_lat", "cell_lon"], "left_anti")


def resolve(replies: DataFrame) -> DataFrame:
    """Replies (cell_lat, cell_lon, payload, fallback) to names: the finer reply first, then the coarser."""
    name = F.coalesce(E.display_name(F.col("payload")), E.display_name(F.col("fallback")))
    country = F.coalesce(E.place_country(F.col("payload")), E.place_country(F.col("fallback")))
    return replies.select("cell_lat", "cell_lon", name.alias("place_name"), country.alias("country"))


def backfill(rows: DataFrame, places: DataFrame) -> DataFrame:
    """Rows whose name is NULL get their cell's; other rows keep theirs."""
    found = places.select("cell_lat", "cell_lon", F.col("place_name").alias("found_name"), F.col("country").alias("found_country"))
    joined = with_cell(rows).join(found, ["cell_lat", "cell_lon"], "left")
    fill = F.col("place_name").isNull()
    return joined.withColumns({"country": F.when(fill, F.coalesce("found_country", "country")).otherwise(F.col("country")), "place_name": F.coalesce("place_name", "found_name")}).select(*rows.columns)


def rows_of(store: Versions) -> DataFrame:
    """The rows of a table kept as files that a version lists."""
    files = store.current()[1]["files"]
    return store.spark.read.parquet(*[store.at(f) for f in files])


def put_rows(store: Versions, rows: DataFrame, files: int) -> None:
    """Make ``rows`` the table's first version, dealt over files by place, so that an update of some cells finds them in few files."""
    folder = store.fresh("rows")
    rows.repartitionByRange(files, "tile_lat", "tile_lon").write.parquet(store.at(folder))
    store.commit(store.current()[0] + 1, {"files": _files(store, folder)})


def _files(store: Versions, folder: str) -> list[str]:
    return [f"{folder}/{n}" for n in store._names(f"data/{folder}") if n.endswith(".parquet")]


def name_rows(store: Versions, places: DataFrame) -> int:
    """Give stored rows without a name that of their cell, as far as ``places`` has one; the number of files written anew.

    Only files that hold such a row are read again and rewritten, the next version lists all others as they are. Volcanic rows, which are known by their vent, stay unnamed.
    Once all names are in, another run finds nothing and makes no version.
    """
    number, content = store.current()
    table = rows_of(store)
    known = places.filter("place_name IS NOT NULL").select(F.col("cell_lat").alias("_lat"), F.col("cell_lon").alias("_lon"), F.col("place_name").alias("_name"), F.col("country").alias("_country"))
    here = F.col("place_name").isNull() & ((F.coalesce("cause", F.lit("")) != "volcanic") if "cause" in table.columns else F.lit(True))
    on = (F.col("cell_lat") == F.col("_lat")) & (F.col("cell_lon") == F.col("_lon"))
    open_rows = with_cell(table.select("*", F.col("_metadata.file_path").alias("_file")).filter(here))
    hit = {r[0].rpartition("/data/")[2] for r in open_rows.join(known, on, "left_semi").select("_file").distinct().collect()}
    stale = [f for f in content["files"] if f in hit]
    if not stale:
        return 0
    rows = with_cell(store.spark.read.parquet(*[store.at(f) for f in stale])).join(known, on & here, "left")
    found = F.col("_name").isNotNull()
    named_rows = rows.withColumns({"place_name": F.coalesce("_name", "place_name"), "country": F.when(found, F.col("_country")).otherwise(F.col("country"))}).select(*table.columns)
    folder = store.fresh("rows")
    named_rows.repartitionByRange(len(stale), "tile_lat", "tile_lon").write.parquet(store.at(folder))
    store.commit(number + 1, {"files": [f for f in content["files"] if f not in hit] + _files(store, folder)})
    return len(stale)


def look_up(wanted: DataFrame, cache: DataFrame, replies: DataFrame) -> DataFrame:
    """What is known of each wanted cell (cell_lat, cell_lon): place_name, country, state and the requests it took.

    ``cache`` rows are answers, also those without a name. Other cells are looked for in ``replies`` (cell_lat, cell_lon, level, status, payload): first at the ``fine``
    level, then, if that was an answer without a name, at the ``coarse`` one. A reply is an answer if its status is 200 and its payload JSON. The states: ``cached``,
    ``named``, ``nameless`` (an answer to keep, so that nobody asks again) and ``unanswered`` (no knowledge; the next run asks again).
    """
    key = ["cell_lat", "cell_lon"]
    cells = wanted.select(*key).distinct()
    held = cells.join(cache.select(*key, "place_name", "country"), key).select(*key, "place_name", "country", F.lit("cached").alias("state"), F.lit(0).alias("requests"))
    ok = (F.col("status") == 200) & F.get_json_object("payload", "$").isNotNull()
    answers = replies.select(*key, "level", F.when(ok, F.struct(E.display_name(F.col("payload")).alias("name"), E.place_country(F.col("payload")).alias("country"))).alias("a"))
    both = answers.groupBy(*key).agg(*[F.max_by(F.when(F.col("level") == k, F.col("a")), F.when(F.col("level") == k, 1)).alias(k) for k in ("fine", "coarse")])
    asked = cells.join(cache.select(*key), key, "left_anti").join(both, key, "left")
    again = F.col("fine").isNotNull() & F.col("fine.name").isNull()
    last = F.when(again, F.col("coarse")).otherwise(F.col("fine"))
    out = asked.select(*key, last.alias("last"), F.when(again, 2).otherwise(1).alias("requests"))
    state = F.when(F.col("last").isNull(), "unanswered").when(F.col("last.name").isNull(), "nameless").otherwise("named")
    return held.unionByName(out.select(*key, F.col("last.name").alias("place_name"), F.col("last.country").alias("country"), state.alias("state"), "requests"))


def remember(store: Versions, found: DataFrame) -> None:
    """Add the new answers of ``look_up`` to the cache as a folder of their own; what was cached is not written again."""
    number, content = store.current()
    folder = store.fresh("answers")
    found.filter(F.col("state").isin("named", "nameless")).select("cell_lat", "cell_lon", "place_name", "country").write.parquet(store.at(folder))
    store.commit(number + 1, {"answers": [*content.get("answers", []), folder]})


def cached(store: Versions) -> DataFrame:
    """All answers kept so far."""
    folders = store.current()[1].get("answers", [])
    schema = "cell_lat decimal(5,1), cell_lon decimal(5,1), place_name string, country string"
    return store.spark.read.schema(schema).parquet(*[store.at(f) for f in folders]) if folders else store.spark.createDataFrame([], schema)
