"""Fixed values of the record policy, in one place."""

from __future__ import annotations

from dataclasses import dataclass

#: Temperatures in Celsius, distances in kilometres, sizes in degrees.
SCALE, OFFSET = 0.02, -273.15
VALID_MIN, VALID_MAX = -150.0, 200.0
HIGH_LATITUDE, HIGH_LATITUDE_MAX = 50.0, 60.0
FIRE_BIN, FIRE_STRIDE = 0.02, 20000
KM_PER_DEGREE = 111.195
VOLCANIC_FLOOR, WILDFIRE_FLOOR = 50.0, 70.0
HEAT_STEPS = (50.0, 58.0, 66.0, 74.0)
AIR_STEPS = (35.0, 40.0, 45.0, 50.0)
AIR_SLOPE, AIR_INTERCEPT, AIR_FIT_LIMIT = 0.6443, 3.1876, 62.0
MERCATOR_MAX_LAT, TILE_PIXELS, BASE_ZOOM = 85.05112878, 256, 7
CELL_DEGREES, PLACE_DEGREES = 0.05, 0.5

#: Fixed notes, appended to a reading in this order.
QC_NOTE = "mandatory QA 00/01; LST error flag <= 2K"
VOLCANIC_MASKED_NOTE = "; volcanic source excluded"
FIRE_MASKED_NOTE = "; fire-masked"
FIRE_UNAVAILABLE_NOTE = "; fire mask unavailable"
HIGH_LATITUDE_NOTE = "; high-latitude outlier excluded"
REJECTED_NOTE = "; rejected by cross-satellite corroboration"
UNCORROBORATED_NOTE = "; single-satellite, uncorroborated"

#: Fixed causes of an anomaly and their labels.
CAUSES = {"volcanic": "Volcanic", "wildfire": "Wildfire", "failed corroboration": "Failed cross-check", "uncorroborated": "Unverified"}

#: Fixed product dimension: product, satellite, fire product, first day.
PRODUCTS = (("MOD11_L2", "Terra", "MOD14", "2000-02-24"), ("MYD11_L2", "Aqua", "MYD14", "2002-07-04"))


@dataclass(frozen=True)
class Policy:
    """Thresholds a caller may set."""

    max_error_class: int = 1
    report_threshold: float = 40.0
    report_top: int = 10
    record_threshold: float = 78.0
    record_tolerance: float = 12.0

    @property
    def uncorroborated_ceiling(self) -> float:
        return self.record_threshold - 0.01
