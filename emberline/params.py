"""Every constant of the detection engine, in one place. Results depend on them."""

from __future__ import annotations

SAME_PASS_RADIUS = {"VIIRS": 750, "MODIS": 1500}
TEMPORAL_RADIUS = {"VIIRS": 1000, "MODIS": 1750}
TEMPORAL_MINUTES = 90
SUPPORT_WEIGHT = {"same_pass": 1.0, "temporal_only": 0.75, "past_confirmed": 0.75, "isolated": 0.25}
PASS_GAP_MINUTES = 15
P75_CLIP = (250.0, 2000.0)
REFERENCE_DISTANCE = {"VIIRS": 430.0, "MODIS": 1112.0}
DISTANCE_BOUNDS = {"VIIRS": (300.0, 800.0), "MODIS": (700.0, 1500.0)}
SHRINK = 30.0
CLUSTER_RADIUS, CLUSTER_MIN, CLUSTER_MAX = 750, 15, 2
CELL, PADDING, SIGMA_CELLS = 250, 3000, 2.4
HALF_LIFE_HOURS = 12.0
EVIDENCE_RELATIVE, EVIDENCE_ABSOLUTE = 0.35, 0.04
ADVANCE_CELLS, CONFIRM_CELLS, CONFIRM_HOURS = 8, 6, 8.0
MIN_COMPONENT = 4
CELL_AREA_KM2 = 0.0625
DEFAULT_AREA = {"MODIS": 1.0, "VIIRS": 0.140625}
FRONT_MAX_GAP_H, FRONT_MIN_POINTS = 3.0, 10
FRONT_MAX_M, SPEED_SCALE = 2000.0, 0.25
FALLBACK_DISTANCE = 600.0
CORRESPONDENCE_FACTOR, CORRESPONDENCE_M = 1.5, (1000.0, 2500.0)
SPEED_SIGMA_CELLS, MIN_COHERENT, UNCERTAINTY_FACTOR = 1.5, 0.25, 0.5
SNAPSHOT_HOURS = 6
CONTINUITY_M, FOOTPRINT = 3000.0, {"VIIRS": 300.0, "MODIS": 750.0}
LAND_FRACTION = 0.50
ALERT_KM2 = 0.01
ENVELOPE_CELL, CLOSING_M = 50, 100
