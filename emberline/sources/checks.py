"""Checks on tables: required columns, and what is known of land-cover tiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bounds in degrees (left, bottom, right, top) of the tiles that are accepted, and what each must be.
TILE_BOUNDS = {"N42W003": (-3.0, 42.0, 0.0, 45.0), "N45W003": (-3.0, 45.0, 0.0, 48.0)}
TILE_FORMAT = {"driver": "GTiff", "crs": "EPSG:4326", "width": 36000, "height": 36000, "bands": 1, "dtype": "uint8", "nodata": 0}


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """df, or an error that names the columns it lacks."""
    if missing := missing_columns(df, required):
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def tile_checks(tiles: DataFrame) -> DataFrame:
    """(tile, check, passed): a row for each check of each tile. tiles: tile, the columns of TILE_FORMAT and left, bottom,
    right, top. A value that is missing fails; a tile that isn't known fails on its bounds."""
    sides = ("left", "bottom", "right", "top")
    known = F.create_map(*[x for t, b in TILE_BOUNDS.items() for x in (F.lit(t), F.array(*map(F.lit, b)))])
    near = [F.abs(F.col(s) - F.get(F.try_element_at(known, F.col("tile")), F.lit(i))) <= 1e-9 for i, s in enumerate(sides)]
    checks = {c: F.col(c) == F.lit(v) for c, v in TILE_FORMAT.items()} | {"bounds": near[0] & near[1] & near[2] & near[3]}
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("check"), F.coalesce(ok, F.lit(False)).alias("passed")) for c, ok in checks.items()]))
    return tiles.select("tile", rows.alias("x")).select("tile", "x.*")
