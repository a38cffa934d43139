"""The curated list of vents, from JSON; a malformed entry is left out, it does not fail the load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed radius of an entry that states none.
DEFAULT_RADIUS_KM = 7.0
FIELDS = ("slug", "name", "country", "lat", "lon", "radius_km", "source_name", "source_url", "notes")


def parse(entries: DataFrame) -> DataFrame:
    """Vents of JSON objects (value): those with a slug, a name and two coordinates that are numbers; texts default to empty, the radius to 7 km."""
    field = {f: F.get_json_object("value", f"$.{f}") for f in FIELDS}
    number: dict[str, Column] = {f: field[f].try_cast("double") for f in ("lat", "lon", "radius_km")}
    radius = F.coalesce(number["radius_km"], F.when(field["radius_km"].isNull(), F.lit(DEFAULT_RADIUS_KM)))
    text = [F.coalesce(field[f], F.lit("")).alias(f) for f in ("country", "source_name", "source_url")]
    out = entries.select(field["slug"].alias("slug"), field["name"].alias("name"), text[0], number["lat"].alias("vent_lat"), number["lon"].alias("vent_lon"), radius.alias("radius_km"), *text[1:], field["notes"].alias("notes"))
    return out.filter("slug IS NOT NULL AND name IS NOT NULL AND vent_lat IS NOT NULL AND vent_lon IS NOT NULL AND radius_km IS NOT NULL")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Vents of files that each hold one JSON array."""
    whole = spark.read.text(path, wholetext=True)
    return parse(whole.select(F.explode(F.from_json("value", "array<string>")).alias("value")))
