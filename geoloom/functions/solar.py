"""Sun position by the almanac's low-precision formula, in Column expressions.

Good to 0.01 degrees between 1950 and 2050 (Michalsky 1988). Refraction follows Saemundsson. The
session time zone must be UTC, as timestamps are taken as instants.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SOLAR_MODEL_VERSION = "almanac-1988"
J2000_SECONDS = 946_728_000  # 2000-01-01 12:00 UTC


def _within(angle: Column, full: float) -> Column:
    return angle - full * F.floor(angle / full)


def with_solar_angles(df: DataFrame, *, at: str, latitude: str, longitude: str) -> DataFrame:
    """Add elevation, apparent elevation, zenith and azimuth (from north, clockwise), in degrees.

    Each step is a projection of its own, so that values used twice are computed once.
    """
    v = F.col
    days = (F.unix_seconds(v(at).cast("timestamp")) - J2000_SECONDS) / 86400.0
    steps = [
        {"__so_days": days},
        {"__so_mean": _within(280.460 + 0.9856474 * v("__so_days"), 360.0), "__so_anomaly": F.radians(_within(357.528 + 0.9856003 * v("__so_days"), 360.0)), "__so_tilt": F.radians(23.439 - 0.0000004 * v("__so_days"))},
        {"__so_long": F.radians(_within(v("__so_mean") + 1.915 * F.sin("__so_anomaly") + 0.020 * F.sin(2 * v("__so_anomaly")), 360.0)), "__so_clock": _within(v("__so_days") + 0.5, 1.0) * 24.0},
        {
            "__so_ascension": F.atan2(F.cos("__so_tilt") * F.sin("__so_long"), F.cos("__so_long")),
            "__so_declination": F.asin(F.sin("__so_tilt") * F.sin("__so_long")),
            "__so_sidereal": _within(6.697375 + 0.0657098242 * v("__so_days") + v("__so_clock"), 24.0),
            "__so_lat": F.radians(v(latitude)),
        },
        {"__so_hour": F.radians(v("__so_sidereal") * 15.0 + v(longitude)) - v("__so_ascension")},
        {
            "solar_elevation_deg": F.degrees(F.asin(F.sin("__so_declination") * F.sin("__so_lat") + F.cos("__so_declination") * F.cos("__so_lat") * F.cos("__so_hour"))),
            "__so_turn": F.degrees(F.atan2(-F.cos("__so_declination") * F.sin("__so_hour"), F.sin("__so_declination") * F.cos("__so_lat") - F.cos("__so_declination") * F.sin("__so_lat") * F.cos("__so_hour"))),
        },
    ]
    out = df
    for step in steps:
        out = out.withColumns(step)
    elevation = v("solar_elevation_deg")
    bent = elevation + 1.02 / 60 / F.tan(F.radians(elevation + 10.3 / (elevation + 5.11)))
    final = out.withColumns({"apparent_solar_elevation_deg": F.when(elevation >= -0.575, bent).otherwise(elevation), "solar_zenith_deg": 90.0 - elevation, "solar_azimuth_deg": _within(v("__so_turn"), 360.0)})
    return final.drop(*(n for step in steps for n in step if n.startswith("__so_")))


#: Least elevation of each class, in falling order; below all is night.
LIGHTING_CLASSES = (("daylight", 0.0), ("civil_twilight", -6.0), ("nautical_twilight", -12.0), ("astronomical_twilight", -18.0))


def lighting_class(elevation: Column) -> Column:
    out = F.lit("night")
    for name, least in reversed(LIGHTING_CLASSES):
        out = F.when(elevation >= least, name).otherwise(out)
    return F.when(elevation.isNotNull() & ~F.isnan(elevation), out)
