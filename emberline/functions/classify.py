"""Column expressions on detections: instruments, confidence, footprints, weights, classes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import params as P


def by_instrument(values: dict, instrument: Column | None = None, default=None) -> Column:
    """The value for the row's instrument; others get the default, or VIIRS's."""
    c = F.col("instrument") if instrument is None else instrument
    return F.when(c == "MODIS", F.lit(values["MODIS"])).otherwise(F.lit(values["VIIRS"] if default is None else default))


def normal_instrument(c: Column) -> Column:
    up = F.upper(F.trim(F.coalesce(c, F.lit(""))))
    return F.when(up.contains("VIIRS"), "VIIRS").when(up.contains("MODIS"), "MODIS").otherwise(up)


def causal_instrument(c: Column) -> Column:
    """As the causal step has it: upper case only, nothing trimmed or looked for."""
    return F.upper(F.coalesce(c, F.lit("")))


def displayed(level: Column, cells: Column, before: Column) -> Column:
    """Whether a projection is shown: of a level that says enough, and larger than the mask it starts from."""
    return level.isin("moyenne", "élevée") & (cells != before)


def confident() -> Column:
    """VIIRS n or h, MODIS 30 or more; anything else fails."""
    text = F.lower(F.trim("confidence"))
    number = F.expr("try_cast(confidence AS double)")
    return F.coalesce(((F.col("instrument") == "VIIRS") & text.isin("n", "h")) | ((F.col("instrument") == "MODIS") & (number >= 30)), F.lit(False))


def pixel_area() -> Column:
    area = F.col("scan") * F.col("track")
    return F.when(area > 0, area).otherwise(by_instrument(P.DEFAULT_AREA))


def mapped(c: Column, values: dict[str, float], default: float) -> Column:
    pairs = list(values.items())
    return reduce(lambda w, kv: w.when(c == kv[0], kv[1]), pairs[1:], F.when(c == pairs[0][0], pairs[0][1])).otherwise(default)


def clip(c: Column, lo: Column | float, hi: Column | float) -> Column:
    """Null stays null, unlike with greatest and least alone."""
    a, b = (v if isinstance(v, Column) else F.lit(v) for v in (lo, hi))
    return F.when(c.isNotNull(), F.greatest(a, F.least(b, c)))


def age_class(hours: Column) -> Column:
    """Six classes of 8 hours; exactly 48 hours is the last."""
    return F.when((hours >= 0) & (hours <= 48), F.least(F.floor(hours / 8) + 1, F.lit(6)))
