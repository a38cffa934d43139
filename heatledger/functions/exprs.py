"""Scalar functions as native column expressions, and the same as SQL functions.

All are NULL for NULL input; none calls Python for a row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from heatledger import schema as S


def dbl(value: float) -> Column:
    """A DOUBLE literal; a bare decimal in SQL would be a DECIMAL."""
    return F.lit(float(value))


def clip(x: Column, low: float, high: float) -> Column:
    return F.when(x.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), x)))


def celsius(raw: Column) -> Column:
    return raw.cast("double") * dbl(S.SCALE) + dbl(S.OFFSET)


def qc_keep(qc: Column, max_error_class: int = 1) -> Column:
    return (qc.bitwiseAND(F.lit(3)) <= 1) & (F.shiftright(qc, 6).bitwiseAND(F.lit(3)) <= max_error_class)


def on_globe(lat: Column, lon: Column) -> Column:
    """Valid coordinates; NaN compares as larger than any number in Spark, so it is none.

    Each is named once: a filter is pushed below the columns it reads, with their whole computation for each mention, and Java leaves
    methods beyond 8,000 bytes of code uncompiled.
    """
    return (F.abs(lat) <= 90) & (F.abs(lon) <= 180)


def plausible(lat: Column, c: Column) -> Column:
    return ~((F.abs(lat) > S.HIGH_LATITUDE) & (c > S.HIGH_LATITUDE_MAX))


def tile_lat(lat: Column) -> Column:
    return clip(F.floor(lat), -90, 89).cast("int")


def tile_lon(lon: Column) -> Column:
    return clip(F.floor(lon), -180, 179).cast("int")


def fire_bin(lat: Column, lon: Column) -> Column:
    return F.floor(lat / dbl(S.FIRE_BIN)) * S.FIRE_STRIDE + F.floor(lon / dbl(S.FIRE_BIN))


def centi(c: Column) -> Column:
    """Hundredths, halves to even, within a short."""
    return clip(F.rint(c * 100), -32767, 32767).cast("int")


def palette_rank(hundredths: Column) -> Column:
    out = F.when(hundredths.isNull(), 0)
    for k, step in enumerate(S.HEAT_STEPS, 1):
        out = out.when(hundredths < int(step * 100), k)
    return out.otherwise(5)


def world(zoom: int) -> int:
    """Pixels across the world."""
    return S.TILE_PIXELS << zoom


def mercator_px(lon: Column, zoom: int = S.BASE_ZOOM) -> Column:
    return clip(F.floor((lon + 180) / 360 * world(zoom)), 0, world(zoom) - 1).cast("int")


def mercator_py(lat: Column, zoom: int = S.BASE_ZOOM) -> Column:
    bounded = F.greatest(dbl(-S.MERCATOR_MAX_LAT), F.least(dbl(S.MERCATOR_MAX_LAT), lat))
    return clip(F.floor((1 - F.asinh(F.tan(F.radians(bounded))) / math.pi) / 2 * world(zoom)), 0, world(zoom) - 1).cast("int")


def pixel_lon(px: Column, zoom: int = S.BASE_ZOOM) -> Column:
    return (px + 0.5) / world(zoom) * 360 - 180


def pixel_lat(py: Column, zoom: int = S.BASE_ZOOM) -> Column:
    return F.degrees(F.atan(F.sinh(math.pi * (1 - 2 * (py + 0.5) / world(zoom)))))


def wrapped(degrees: Column) -> Column:
    """Longitude difference in [-180, 180); floored modulo."""
    return F.pmod(degrees + 180, dbl(360)) - 180


def flat_km(lat: Column, lon: Column, at_lat: Column, at_lon: Column) -> Column:
    """Equirectangular distance at ``at_lat``."""
    north = (lat - at_lat) * S.KM_PER_DEGREE
    east = wrapped(lon - at_lon) * S.KM_PER_DEGREE * F.cos(F.radians(at_lat))
    return F.sqrt(north * north + east * east)


def grid_row(lat: Column) -> Column:
    return clip(F.floor((90 - lat) / dbl(S.CELL_DEGREES)), 0, 3599).cast("int")


def grid_col(lon: Column) -> Column:
    return clip(F.floor((lon + 180) / dbl(S.CELL_DEGREES)), 0, 7199).cast("int")


def cell_lat(row: Column) -> Column:
    return F.round(dbl(89.975) - row * dbl(S.CELL_DEGREES), 3)


def cell_lon(col: Column) -> Column:
    return F.round(dbl(-179.975) + col * dbl(S.CELL_DEGREES), 3)


def place_cell(x: Column) -> Column:
    """Nearest half degree, halves up; an exact decimal, so that it can be a join key."""
    return (F.floor(x / S.PLACE_DEGREES + 0.5) * S.PLACE_DEGREES).cast("decimal(5,1)")


def continent(lat: Column, lon: Column) -> Column:
    """Rough boxes; the first that holds the point wins (fixed values)."""
    boxes = [
        (lon.between(110, 180) & lat.between(-50, -8), "oceania"),
        (lon.between(-170, -50) & lat.between(12, 75), "north-america"),
        (lon.between(-120, -50) & (lat >= 7) & (lat < 12), "north-america"),
        (lon.between(-82, -34) & (lat >= -56) & (lat < 12), "south-america"),
        (lat.between(-35, 37) & (lon >= -18) & (lon < 34), "africa"),
        ((lat >= -35) & (lat < 30) & lon.between(34, 52), "africa"),
        ((lat >= 40) & (lon >= -10) & (lon < 30), "europe"),
        ((lon >= 25) & (lat > -10), "asia"),
        (lon.between(90, 180) & (lat > -8) & (lat <= 10), "asia"),
    ]
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for inside, name in boxes:
        out = out.when(inside, name)
    return out


def fahrenheit(c: Column) -> Column:
    return c * dbl(1.8) + 32


def air_estimate(c: Column) -> Column:
    return c * dbl(S.AIR_SLOPE) + dbl(S.AIR_INTERCEPT)


def step(x: Column, edges: tuple[float, ...]) -> Column:
    """1 below the first edge, one more from each edge on."""
    out = F.when(x.isNull(), None)
    for k, edge in enumerate(edges, 1):
        out = out.when(x < edge, k)
    return out.otherwise(len(edges) + 1)


def coordinates(lat: Column, lon: Column) -> Column:
    return F.concat(F.format_string("%.1f", F.abs(lat)), F.when(lat >= 0, "°N ").otherwise("°S "), F.format_string("%.1f", F.abs(lon)), F.when(lon >= 0, "°E").otherwise("°W"))


def escape_html(text: Column) -> Column:
    for plain, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def product_value(product: Column, field: int) -> Column:
    """Another column of the product dimension; NULL for an unknown product."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for row in S.PRODUCTS:
        out = out.when(product == row[0], row[field])
    return out


def product_of_granule(granule_id: Column) -> Column:
    first = F.split_part(granule_id, F.lit("."), F.lit(1))
    return F.when(first.isin([p[0] for p in S.PRODUCTS]), first)


def overpass_stamp(granule_id: Column) -> Column:
    return F.nullif(F.regexp_extract(granule_id, r"\.(A\d{7}\.\d{4})\.", 1), F.lit(""))


def run_status(total: Column, processed: Column, error: Column) -> Column:
    bad = error.isNotNull() | (total == 0) | (processed == 0)
    return F.when(bad, "failed").when(processed < total, "partial").otherwise("succeeded")


def cause_label(cause: Column) -> Column:
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, label in S.CAUSES.items():
        out = out.when(cause == name, label)
    return out


def display_name(payload: Column) -> Column:
    """'Region, country' from a geocoder's JSON reply, with the county and then the country alone as fallbacks."""

    def first(*keys: str) -> Column:
        return F.coalesce(*[F.nullif(F.trim(F.get_json_object(payload, f"$.address.{k}")), F.lit("")) for k in keys])

    region, county, country = first("state", "province", "region", "state_district"), first("county", "municipality", "district"), first("country")
    with_country = [F.when(part.isNotNull() & country.isNotNull() & (part != country), F.concat(part, F.lit(", "), country)) for part in (region, county)]
    failed = F.coalesce(F.nullif(F.get_json_object(payload, "$.error"), F.lit("")), F.lit("")) != ""
    return F.when(~failed, F.coalesce(*with_country, country, region, county))


def place_country(payload: Column) -> Column:
    failed = F.coalesce(F.nullif(F.get_json_object(payload, "$.error"), F.lit("")), F.lit("")) != ""
    return F.when(~failed, F.nullif(F.trim(F.get_json_object(payload, "$.address.country")), F.lit("")))


def matches(query: str, *fields: Column) -> Column:
    """Whether any field holds the query, whatever its case; an empty query matches all."""
    q = query.strip().lower()
    out = F.lit(not q)
    for f in fields:
        out = out | F.contains(F.lower(F.coalesce(f, F.lit(""))), F.lit(q))
    return out


def in_box(lat: Column, lon: Column, west: float, south: float, east: float, north: float) -> Column:
    """Inside a box that may cross the antimeridian (west > east)."""
    across = (lon >= west) & (lon <= east) if west <= east else (lon >= west) | (lon <= east)
    return lat.between(south, north) & across


#: SQL functions: signature and body.
SQL_FUNCTIONS = {
    "lst_celsius(raw BIGINT) RETURNS DOUBLE": "CAST(raw AS DOUBLE) * 0.02D - 273.15D",
    "qc_keep(qc BIGINT, max_error_class INT) RETURNS BOOLEAN": "(qc & 3) <= 1 AND (shiftright(qc, 6) & 3) <= max_error_class",
    "tile_of(degrees DOUBLE, low INT, high INT) RETURNS INT": "CAST(greatest(low, least(high, floor(degrees))) AS INT)",
    "palette_rank(centi INT) RETURNS INT": "CASE WHEN centi IS NULL THEN 0 WHEN centi < 5000 THEN 1 WHEN centi < 5800 THEN 2 WHEN centi < 6600 THEN 3 WHEN centi < 7400 THEN 4 ELSE 5 END",
    "air_estimate(c DOUBLE) RETURNS DOUBLE": "0.6443D * c + 3.1876D",
    "fahrenheit(c DOUBLE) RETURNS DOUBLE": "c * 1.8D + 32",
}


def register(spark: SparkSession) -> list[str]:
    """Create the SQL functions in the session; their names."""
    for head, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    return [head.partition("(")[0] for head in SQL_FUNCTIONS]


def place_bounds(cell: Column) -> tuple[Column, Column]:
    """Half-open bounds of a half-degree cell along one axis."""
    return cell.cast("double") - S.PLACE_DEGREES / 2, cell.cast("double") + S.PLACE_DEGREES / 2


def record_label(measurement: Column, kind: Column) -> Column:
    """Short label of a curated record; a range or a mean never reads as an absolute record."""
    base = F.when(measurement == "air", "air").when(measurement == "land_surface", "surface")
    return F.when(kind == "diurnal_range", F.concat(base, F.lit(" swing"))).when(kind == "avg_annual", F.concat(base, F.lit(" avg"))).otherwise(base)


def temperature_text(c: Column, unit: str = "C") -> Column:
    return F.concat(F.format_string("%.1f", fahrenheit(c) if unit == "F" else c), F.lit(f" °{unit}"))


def day_text(at: Column) -> Column:
    return F.date_format(at, "MMM d, yyyy")


def moment_text(at: Column) -> Column:
    return F.date_format(at, "MMM d, HH:mm 'UTC'")


def month_text(at: Column) -> Column:
    return F.date_format(at, "MMM yyyy")


def token_expiry(token: Column) -> Column:
    """Expiry of a web token's payload as a timestamp; NULL where it cannot be read."""
    body = F.translate(F.split_part(token, F.lit("."), F.lit(2)), "-_", "+/")
    padded = F.rpad(body, (F.ceil(F.length(body) / 4) * 4).cast("int"), F.lit("="))
    exp = F.get_json_object(F.try_to_binary(padded, F.lit("base64")).cast("string"), "$.exp")
    return F.timestamp_seconds(exp.try_cast("bigint"))


def expiry_state(expires: Column, now: Column, window_days: int = 14) -> Column:
    """unknown, expired, renew or ok; only an expired token stops a run."""
    return F.when(expires.isNull(), "unknown").when(expires <= now, "expired").when(F.unix_timestamp(expires) - F.unix_timestamp(now) <= window_days * 86400, "renew").otherwise("ok")


def plain_number(x: Column) -> Column:
    """A number without trailing zeros."""
    return F.regexp_replace(F.regexp_replace(F.format_string("%.6f", x), r"0+$", ""), r"\.$", "")


def bbox_text(west: Column, south: Column, east: Column, north: Column) -> Column:
    return F.concat_ws(",", *[plain_number(F.round(x, 3)) for x in (west, south, east, north)])


def bbox_problem(west: Column, south: Column, east: Column, north: Column) -> Column:
    """NULL for a valid box; west may be larger than east, which crosses the antimeridian."""
    bad = west.isNull() | south.isNull() | east.isNull() | north.isNull()
    return F.when(bad, "four numbers are needed").when(~west.between(-180, 180) | ~east.between(-180, 180) | ~south.between(-90, 90) | ~north.between(-90, 90), "off the globe").when(south >= north, "south must be below north")
