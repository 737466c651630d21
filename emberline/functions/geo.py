"""Lambert-93 (EPSG:2154) as column expressions: the public formulae for a conformal conic on GRS80."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

E, LON0 = 0.08181919104281579, math.radians(3.0)
X0, YS = 700000.0, 12655612.049875986
N, C = 0.7256077650532695, 11754255.426096004


def forward(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Metres (x, y) of degrees."""
    phi, lam = F.radians(lat), F.radians(lon)
    s = F.sin(phi) * E
    t = F.tan(math.pi / 4 - phi / 2) / F.pow((1 - s) / (1 + s), F.lit(E / 2))
    rho = F.pow(t, F.lit(N)) * C
    angle = (lam - LON0) * N
    return rho * F.sin(angle) + X0, F.lit(YS) - rho * F.cos(angle)


def inverse(x: Column, y: Column, steps: int = 5) -> tuple[Column, Column]:
    """Degrees (lon, lat) of metres, by fixed-point steps."""
    dx, dy = x - X0, F.lit(YS) - y
    lam = F.atan2(dx, dy) / N + LON0
    t = F.pow(F.sqrt(dx * dx + dy * dy) / C, F.lit(1 / N))
    phi = math.pi / 2 - 2 * F.atan(t)
    for _ in range(steps):
        s = F.sin(phi) * E
        phi = math.pi / 2 - 2 * F.atan(t * F.pow((1 - s) / (1 + s), F.lit(E / 2)))
    return F.degrees(lam), F.degrees(phi)
