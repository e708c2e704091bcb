"""Scalar functions as column expressions: all run inside whole-stage code generation."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

# --- fixed values of the domain ---
EARTH_RADIUS_KM = 6371.0
GRAVITY = 9.81
ML_SLOPE, ML_INTERCEPT = 0.7018, 1.1715
SITE_CUTS = (("A", 1500.0), ("B", 760.0), ("C", 360.0), ("D", 180.0))
SCALE_GROUPS = {"moment_magnitude": ("mw", "mww", "mwc", "mwr", "mwb"), "duration_magnitude": ("md",), "local_magnitude": ("ml",), "body_wave_magnitude": ("mb", "mblg"), "surface_wave_magnitude": ("ms",)}
OTHER_SCALE = "diger"
UNKNOWN_INSTRUMENT = "bilinmiyor"
INSTRUMENTS = {"H": "broadband", "N": "strong_motion", "E": "short_period", "L": "short_period"}
HIGHPASS = ((6.5, 0.03), (5.5, 0.05))
HIGHPASS_SMALL, HIGHPASS_UNKNOWN = 0.1, 0.05


def np_round(x: Column, places: int) -> Column:
    """Round as numpy does: half to even on the scaled value."""
    scale = float(10**places)
    return F.rint(x * F.lit(scale)) / F.lit(scale)


def log10(x: Column) -> Column:
    """As numpy and the SQL have it: -inf at zero, where Spark's own gives NULL and aggregates skip the row."""
    return F.when(x == 0, F.lit(-math.inf)).otherwise(F.log10(x))


def null_nan(df: DataFrame, *names: str) -> DataFrame:
    """NaN to NULL, so that comparisons and maxima treat it as missing."""
    pick = names or [f.name for f in df.schema.fields if isinstance(f.dataType, DoubleType | FloatType)]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in pick})


def haversine_term(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """The monotone part of the distance: enough to compare, without a square root or arc sine."""
    a, b = F.sin(F.radians(lat2 - lat1) / 2), F.sin(F.radians(lon2 - lon1) / 2)
    return a * a + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * b * b


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    return term_km(haversine_term(lat1, lon1, lat2, lon2))


def term_km(term: Column) -> Column:
    """Distance of a haversine term; NULL stays NULL (``least`` alone would skip it)."""
    return F.when(term.isNotNull(), F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(term, F.lit(1.0)))))


def hypocentral_km(epicentral: Column, depth: Column) -> Column:
    z = F.coalesce(depth, F.lit(0.0))
    return F.sqrt(epicentral * epicentral + z * z)


def scale_group(mag_type: Column) -> Column:
    """Group of a magnitude type; NULL and unknown types are the other group."""
    name = F.lower(F.coalesce(mag_type, F.lit("")))
    out = F.lit(OTHER_SCALE)
    for group, names in SCALE_GROUPS.items():
        out = F.when(name.isin(*names), F.lit(group)).otherwise(out)
    return out


def estimate_mw(group: Column, magnitude: Column) -> Column:
    """Moment magnitude: kept, converted from local, or NULL."""
    return F.when(group == "moment_magnitude", magnitude).when(group == "local_magnitude", np_round(magnitude * ML_SLOPE + ML_INTERCEPT, 2))


def site_class(vs30: Column) -> Column:
    ok = vs30.isNotNull() & ~F.isnan(vs30) & (vs30 > 0) & (vs30 < F.lit(math.inf))
    out = F.lit("E")
    for name, cut in reversed(SITE_CUTS):
        out = F.when(vs30 > cut, F.lit(name)).otherwise(out)
    return F.when(ok, out)


def instrument_type(channel: Column) -> Column:
    letter = F.substring(channel, 2, 1)
    out = F.lit(UNKNOWN_INSTRUMENT)
    for k, v in INSTRUMENTS.items():
        out = F.when(letter == k, F.lit(v)).otherwise(out)
    return out


def instrument_types(channels: Column) -> Column:
    """Sorted distinct types of a channel list, comma-joined; unknown letters are left out."""
    known = F.array_sort(F.array_distinct(F.filter(F.transform(channels, instrument_type), lambda t: t != UNKNOWN_INSTRUMENT)))
    return F.when(F.size(known) > 0, F.array_join(known, ",")).otherwise(F.lit(UNKNOWN_INSTRUMENT))


def has_strong_motion(channels: Column) -> Column:
    return F.exists(channels, lambda c: F.substring(c, 2, 1) == "N")


def sanitize_id(event_id: Column) -> Column:
    """A file-safe id; :func:`desanitize_id` undoes it."""
    return F.replace(F.replace(F.replace(event_id, F.lit(":"), F.lit("-c-")), F.lit("/"), F.lit("-s-")), F.lit("="), F.lit("-e-"))


def desanitize_id(safe: Column) -> Column:
    return F.replace(F.replace(F.replace(safe, F.lit("-e-"), F.lit("=")), F.lit("-s-"), F.lit("/")), F.lit("-c-"), F.lit(":"))


def split_file_name(name: Column) -> tuple[Column, Column]:
    """Event and station of ``<event>_<station>``: the last underscore divides."""
    return F.regexp_extract(name, "^(.*)_([^_]+)$", 1), F.regexp_extract(name, "^(.*)_([^_]+)$", 2)


def highpass_corner(magnitude: Column) -> Column:
    out = F.lit(HIGHPASS_SMALL)
    for cut, corner in reversed(HIGHPASS):
        out = F.when(magnitude >= cut, F.lit(corner)).otherwise(out)
    return F.when(magnitude.isNull() | F.isnan(magnitude), F.lit(HIGHPASS_UNKNOWN)).otherwise(out)


def seconds(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1e6)


def clip(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))
