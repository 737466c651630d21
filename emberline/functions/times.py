"""Times as text and as hours: UTC with Z, local time, elapsed and remaining hours."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = "Europe/Paris"
_EPOCH = "TIMESTAMP_NTZ'2024-01-01 00:00:00'"


def at_minute(m: str = "m") -> Column:
    """The time, without a zone, of a column of minutes since 2024-01-01."""
    return F.expr(f"timestampadd(MINUTE, {m}, {_EPOCH})")


def iso_utc(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def z_suffix(text: Column) -> Column:
    """An offset of zero written as Z."""
    return F.regexp_replace(text, r"\+00:00$", "Z")


def parsed_utc(text: Column) -> Column:
    """Text with or without a zone; without one it is UTC. Null where it is no time."""
    zoned = F.when(text.rlike(r"(Z|[+-]\d\d:?\d\d)$"), text).otherwise(F.concat(text, F.lit("Z")))
    return F.try_to_timestamp(zoned)


def local(ts: Column, zone: str = ZONE) -> Column:
    return F.from_utc_timestamp(ts, zone)


def hours_between(later: Column, earlier: Column) -> Column:
    return (later - earlier) / 60.0


def since(ts: Column, start: str) -> Column:
    """Whether ts is at start or later; start "auto" takes all, and a start without a zone is UTC."""
    return F.lit(True) if start == "auto" else ts >= parsed_utc(F.lit(start))


def denaned(c: Column) -> Column:
    """NaN becomes null."""
    return F.when(~F.isnan(c), c)
