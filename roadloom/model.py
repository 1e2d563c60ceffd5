"""Vocabularies, limits and schemas that the rules share.

The word lists and numbers below are fixed values: results depend on them.
"""

from __future__ import annotations

PASS, FAIL, SKIP, WARN = "PASS", "FAIL", "SKIP", "WARN"

# Words.
DRIVABLE = ["road", "road_shoulder"]
PEDESTRIAN = ["walkway", "crosswalk"]
REPAIRABLE_OWNERS = ["walkway", "road_shoulder"]
BOUNDARY_TYPES = ["line_thin", "line_thick", "road_border"]
SMOOTH_TYPES = ["line_thin", "line_thick", "road_border", "curbstone"]
PHYSICAL_BORDERS = ["road_border", "curbstone", "guard_rail", "wall", "fence"]
PAINTED = ["line_thin", "line_thick"]
FEATURE_WAYS = ["light_bulbs", "crosswalk_polygon", "intersection_area"]
KEPT_NODE_TAGS = ["color", "arrow"]
PROJECTORS = ["MGRS", "TransverseMercator", "LocalCartesianUTM", "local"]

# Metres, degrees, ratios.
MAX_STRAIGHT, MAX_CURVED = 100.0, 20.0
CURVE_WINDOW, CURVE_TURN = 20.0, 4.0
SPLIT_RATIO = 0.9
KINK_DEGREES = 60.0
WIDTH_RATIO = 2.5
OVERLAP_TOL, OVERLAP_ELE, OVERLAP_GRID = 0.5, 0.5, 5.0
RESAMPLE_STEP = 1.0
COINCIDENT_TOL, SAME_LINE_TOL = 0.5, 0.05
MIN_BOUNDARY = 1.0
STOP_LINE_RANGE = 6.0
CONNECTOR_SHARE = 0.1
CUT_SAMPLES = 400
SNAP = 0.1
DOWNSAMPLE_ANGLE, DOWNSAMPLE_DISTANCE = 179.9, 3.0
EARTH_RADIUS, EARTH_RADIUS_REPAIR = 6378000.0, 6378137.0
TELEPORT = 30.0
LENGTH_SUM_TOL, CONTINUITY_TOL = 1e-3, 0.05
STUB_LENGTH, STUB_FRACTION = 2.0, 0.5
ADJACENCY_TOL = 0.05
FIT_WARN, FIT_ACCEPT = 0.01, 0.05
ROUNDTRIP_STEP = 0.5
UTM_SCALE = 0.9996

# Names of the checks as reports show them.
CHECK_NAMES = {
    "vm-01-01": "Lanelet basics tags",
    "vm-01-02": "Boundary line tags",
    "vm-01-03": "Linestring sharing",
    "vm-01-04": "Opposing centerline sharing",
    "vm-01-05": "Lane geometry smooth",
    "vm-01-16": "Road/shoulder sharing",
    "vm-01-21": "Forward/backward connectivity",
    "vm-01-24": "Lanelet splitting",
    "vm-03-01": "Intersection area",
    "vm-03-02": "Turn direction",
    "vm-03-03": "Intersection width/shape",
    "vm-03-07": "Adjacent connector sharing",
    "vm-03-08": "Intersection area range",
    "vm-03-09": "Stop-line-bounded range",
    "vm-03-10": "Right of way",
    "vm-04-01": "Traffic light basics",
    "vm-05-01": "Crosswalk basics",
    "vm-07-04": "Ellipsoidal height",
    "vm-07-06": "Junction lanelet completeness",
    "vm-07-08": "Overlapping lanes",
    "xodr-01": "header",
    "xodr-02": "geoReference parses",
    "xodr-03": "road ids unique",
    "xodr-04": "planView consistent",
    "xodr-05": "geometry continuity",
    "xodr-06": "lane sections",
    "xodr-07": "road link targets exist",
    "xodr-08": "lane link targets exist",
    "xodr-09": "junction connections",
    "xodr-10": "connecting roads referenced",
    "xodr-11": "numeric attributes finite",
}

RESULT = "map_id, req_id, name, status, detail, offenders, total"
