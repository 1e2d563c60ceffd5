"""Distances on the globe, map projections and the texts that describe them.

Projection formulas are written once over a namespace of functions, so the same series runs as Spark expressions inside
the JVM and as numpy or plain numbers on the driver. Transverse Mercator is the Krueger series to the fourth order,
good to well under a millimetre within a few degrees of the central meridian.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, replace
from types import SimpleNamespace

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from roadloom import model as M

COLUMNS = SimpleNamespace(sin=F.sin, cos=F.cos, sinh=F.sinh, cosh=F.cosh, atanh=F.atanh, atan2=F.atan2, asin=F.asin, sqrt=F.sqrt, tan=F.tan, log=F.log, exp=F.exp, atan=F.atan)
NUMBERS = SimpleNamespace(sin=np.sin, cos=np.cos, sinh=np.sinh, cosh=np.cosh, atanh=np.arctanh, atan2=np.arctan2, asin=np.arcsin, sqrt=np.sqrt, tan=np.tan, log=np.log, exp=np.exp, atan=np.arctan)

_RAD = math.pi / 180
# The WGS84 ellipsoid.
WGS84_A, WGS84_F = 6378137.0, 1 / 298.257223563
_N = WGS84_F / (2 - WGS84_F)
_RECTIFY = WGS84_A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
# The series' coefficients.
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180, 13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440, 61 * _N**3 / 240 - 103 * _N**4 / 140, 49561 * _N**4 / 161280)
_BETA = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360, _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440, 17 * _N**3 / 480 - 37 * _N**4 / 840, 4397 * _N**4 / 161280)
_DELTA = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3 + 116 * _N**4 / 45, 7 * _N**2 / 3 - 8 * _N**3 / 5 - 227 * _N**4 / 45, 56 * _N**3 / 15 - 136 * _N**4 / 35, 4279 * _N**4 / 630)
WEB_MERCATOR = "+proj=merc +a=6378137 +b=6378137 +lat_ts=0 +lon_0=0 +x_0=0 +y_0=0 +k=1 +units=m +no_defs"


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = M.EARTH_RADIUS) -> Column:
    half = lambda a, b: F.pow(F.sin(F.radians(b - a) / 2), 2)
    return 2 * radius * F.asin(F.sqrt(half(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lon1, lon2)))


def equirectangular(lat: Column, lon: Column, radius: float = M.EARTH_RADIUS) -> tuple[Column, Column]:
    return F.radians(lon) * radius * F.cos(F.radians(lat)), F.radians(lat) * radius


def web_mercator(lat, lon, m=COLUMNS):
    return WGS84_A * _RAD * lon, WGS84_A * m.log(m.tan(math.pi / 4 + lat * (_RAD / 2)))


def wrap_angle(a: Column) -> Column:
    """An angle in [-pi, pi)."""
    return F.pmod(a + math.pi, F.lit(2 * math.pi)) - math.pi


def utm_zone(lon: Column) -> Column:
    return F.floor((lon + 180) / 6).cast("int") + 1


def central_meridian(zone):
    return zone * 6 - 183


def lane_id_parts(text: Column) -> Column:
    """Road, section and lane of an encoded lane id: the first three parts between dots; null for fewer."""
    parts = F.split(text, r"\.")
    return F.when(F.size(parts) >= 3, F.slice(parts, 1, 3))


@dataclass(frozen=True)
class Tmerc:
    """A transverse Mercator projection of the WGS84 ellipsoid."""

    lat_0: float = 0.0
    lon_0: float = 0.0
    k: float = 1.0
    x_0: float = 0.0
    y_0: float = 0.0

    @property
    def text(self) -> str:
        return f"+proj=tmerc +lat_0={self.lat_0:.10g} +lon_0={self.lon_0:.10g} +k={self.k:.10g} +x_0={self.x_0:.10g} +y_0={self.y_0:.10g} +datum=WGS84 +units=m +no_defs"

    @staticmethod
    def utm(zone: int, south: bool = False, dx: float = 0.0, dy: float = 0.0) -> Tmerc:
        return Tmerc(0.0, float(central_meridian(zone)), M.UTM_SCALE, 500000.0 + dx, (10000000.0 if south else 0.0) + dy)

    def _base(self) -> float:
        """The northing of the origin's latitude."""
        return float(_grid(self.lat_0, 0.0, NUMBERS)[1]) if self.lat_0 else 0.0

    def forward(self, lat, lon, m=COLUMNS):
        east, north = _grid(lat, lon - self.lon_0, m)
        return self.x_0 + self.k * east, self.y_0 + self.k * (north - self._base())

    def inverse(self, x, y, m=COLUMNS):
        eta = (x - self.x_0) / (self.k * _RECTIFY)
        xi = ((y - self.y_0) / self.k + self._base()) / _RECTIFY
        e = eta - sum(b * m.cos(2 * j * xi) * m.sinh(2 * j * eta) for j, b in enumerate(_BETA, 1))
        n = xi - sum(b * m.sin(2 * j * xi) * m.cosh(2 * j * eta) for j, b in enumerate(_BETA, 1))
        chi = m.asin(m.sin(n) / m.cosh(e))
        lat = chi + sum(d * m.sin(2 * j * chi) for j, d in enumerate(_DELTA, 1))
        return lat / _RAD, self.lon_0 + m.atan2(m.sinh(e), m.cos(n)) / _RAD


def _grid(lat, dlon, m):
    """Unscaled easting and northing from the equator and the central meridian."""
    phi, lam, ecc = lat * _RAD, dlon * _RAD, 2 * math.sqrt(_N) / (1 + _N)
    t = m.sinh(m.atanh(m.sin(phi)) - ecc * m.atanh(ecc * m.sin(phi)))
    xi, eta = m.atan2(t, m.cos(lam)), m.atanh(m.sin(lam) / m.sqrt(1 + t * t))
    east = eta + sum(a * m.cos(2 * j * xi) * m.sinh(2 * j * eta) for j, a in enumerate(_ALPHA, 1))
    north = xi + sum(a * m.sin(2 * j * xi) * m.cosh(2 * j * eta) for j, a in enumerate(_ALPHA, 1))
    return _RECTIFY * east, _RECTIFY * north


def proj_params(text: str) -> dict[str, str]:
    """The +key=value pairs of a projection text; a key without value is empty, a repeated one takes its last."""
    return {k: v or "" for k, v in re.findall(r"\+(\w+)(?:=(\S+))?", text)}


def proj_param(text: Column, key: str) -> Column:
    """One number of a projection text; null if absent or unreadable."""
    return F.nullif(F.regexp_extract(text, rf"\+{key}=([^\s]+)", 1), F.lit("")).try_cast("double")


def parse_tmerc(text: str) -> Tmerc | None:
    """The projection of a tmerc or utm text; none for others."""
    p = proj_params(text)
    get = lambda k, d: float(p[k]) if p.get(k) else d
    if p.get("proj") == "utm" and p.get("zone"):
        return Tmerc.utm(int(p["zone"]), "south" in p)
    if p.get("proj") == "tmerc":
        return Tmerc(get("lat_0", 0.0), get("lon_0", 0.0), get("k", get("k_0", 1.0)), get("x_0", 0.0), get("y_0", 0.0))
    return None


def crs_is_valid(text: Column) -> Column:
    """Whether a text is a description of a reference system in a form that is supported: a projection text with a
    projection and only key=value parts, an authority code, or well-known text."""
    proj = text.rlike(r"^(\+\w+(=\S+)?\s*)+$") & text.rlike(r"\+proj=(utm|tmerc|merc|lcc|longlat|stere|laea|aea|eqc|etmerc|omerc|geocent)(\s|$)")
    proj = proj & (~text.rlike(r"\+proj=utm(\s|$)") | text.rlike(r"\+zone=([1-9]|[1-5][0-9]|60)(\s|$)") | text.rlike(r"\+lon_0="))
    return proj | text.rlike(r"^(?i)(epsg|esri|ogc):\w+$") | text.rlike(r"^(PROJCS|GEOGCS|PROJCRS|GEOGCRS|GEODCRS|COMPD_CS)\[.*\]$")


@dataclass(frozen=True)
class Origin:
    """What a map's reference text says about its place."""

    latitude: float = 0.0
    longitude: float = 0.0
    scale_factor: float = M.UTM_SCALE
    vertical_datum: str = "WGS84"
    projector_type: str = "TransverseMercator"
    source: str = "default-missing"
    proj_string: str | None = None
    warnings: tuple[str, ...] = ()

    @property
    def bare(self) -> bool:
        """Whether the text lacks a projection and has to be rewritten before use."""
        return self.source == "proj4" and self.proj_string is not None and "+proj=" not in self.proj_string

    @property
    def normalized(self) -> str:
        return f"+proj=tmerc +lat_0={self.latitude} +lon_0={self.longitude} +k={self.scale_factor} +x_0=0 +y_0=0 +datum={self.vertical_datum} +units=m +no_defs"


def origin_of(text: str | None) -> Origin:
    """The origin that a reference text stands for. In a utm text explicit values win over the zone's, with a warning
    each; without a projection, latitude and longitude alone stand for transverse Mercator at the usual scale."""
    if text is None or not text.strip():
        return Origin()
    text = text.strip()
    p = proj_params(text)

    def number(key: str) -> float | None:
        try:
            return float(p[key])
        except (KeyError, ValueError):
            return None

    kind, lat, lon, k = p.get("proj", "").lower(), number("lat_0"), number("lon_0"), number("k")
    k = number("k_0") if k is None else k
    said: list[str] = []
    scale = 1.0 if kind == "tmerc" else M.UTM_SCALE
    if kind == "utm":
        zone = number("zone")
        middle = None if zone is None or zone != int(zone) else float(central_meridian(int(zone)))
        if middle is not None and lon is not None and abs(lon - middle) > 1e-6:
            said.append(f"lon_0 {lon} differs from the zone's {middle}")
        if lat is not None and abs(lat) > 1e-6:
            said.append(f"lat_0 {lat} differs from the zone's 0")
        if k is not None and abs(k - M.UTM_SCALE) > 1e-6:
            said.append(f"scale {k} differs from the zone's {M.UTM_SCALE}")
        lon = middle if lon is None else lon
    elif kind != "tmerc" and lat is None and lon is None:
        return Origin(source="default-invalid", proj_string=text)
    return Origin(lat or 0.0, lon or 0.0, scale if k is None else k, p.get("datum") or "WGS84", source="proj4", proj_string=text, warnings=tuple(said))


# Letters of the military grid, without I and O.
_ROWS, _COLUMNS, _BANDS = "ABCDEFGHJKLMNPQRSTUV", "ABCDEFGHJKLMNPQRSTUVWXYZ", "CDEFGHJKLMNPQRSTUVWX"


def mgrs_corner(square: str) -> tuple[int, bool, float, float]:
    """Zone, southern half, easting and northing of the south-west corner of a 100 km square such as 51RUH."""
    found = re.fullmatch(rf"\s*(\d{{1,2}})([{_BANDS}])([{_COLUMNS}])([{_ROWS}])\s*", square.upper())
    if not found or not 1 <= int(found[1]) <= 60:
        raise ValueError(f"no grid square: {square!r}")
    zone, band = int(found[1]), _BANDS.index(found[2])
    easting = (_COLUMNS.index(found[3]) % 8 + 1) * 100000.0
    if _COLUMNS.index(found[3]) // 8 != (zone - 1) % 3:
        raise ValueError(f"column {found[3]} is not in zone {zone}")
    row = (_ROWS.index(found[4]) - (5 if zone % 2 == 0 else 0)) % 20
    south = band < 10
    floor_ = float(Tmerc.utm(zone, south).forward(-80.0 + 8 * band, float(central_meridian(zone)), NUMBERS)[1])
    turns = math.ceil((floor_ - 100000.0 - row * 100000.0) / 2000000.0)
    return zone, south, easting, row * 100000.0 + max(turns, 0) * 2000000.0


@dataclass(frozen=True)
class Projection:
    """A map's projection and where it came from."""

    proj_string: str
    native: str
    source: str
    origin_lat: float | None = None
    origin_lon: float | None = None
    scale_factor: float | None = None
    mgrs_grid: str | None = None
    fit_rmse: float | None = None
    frame: str | None = None
    max_node_error: float | None = None
    nodes_checked: int | None = None


def _from(t: Tmerc, source: str, **more) -> Projection:
    return Projection(t.text, t.text, source, t.lat_0, t.lon_0, t.k, **more)


def from_projector_info(info: dict) -> Projection | None:
    """The projection of a projector record; none for a local one; an error for an unknown type or missing parts."""
    kind = str(info.get("projector_type", "")).strip()
    origin = info.get("map_origin") or {}
    lat, lon = origin.get("latitude"), origin.get("longitude")
    if kind in ("local", ""):
        return None
    if kind not in M.PROJECTORS:
        raise ValueError(f"unknown projector type {kind!r}")
    if kind == "MGRS":
        if not info.get("mgrs_grid"):
            raise ValueError("an MGRS projector needs its grid square")
        zone, south, e, n = mgrs_corner(str(info["mgrs_grid"]))
        return _from(Tmerc.utm(zone, south, -e, -n), f"projector_info-{kind}", mgrs_grid=str(info["mgrs_grid"]).strip())
    if lat is None or lon is None:
        raise ValueError(f"a {kind} projector needs the latitude and longitude of its origin")
    if kind == "TransverseMercator":
        return _from(Tmerc(float(lat), float(lon), float(info.get("scale_factor", M.UTM_SCALE))), f"projector_info-{kind}")
    zone = int(math.floor((float(lon) + 180) / 6)) + 1
    base = Tmerc.utm(zone, float(lat) < 0)
    e, n = base.forward(float(lat), float(lon), NUMBERS)
    return _from(replace(base, x_0=base.x_0 - float(e), y_0=base.y_0 - float(n)), f"projector_info-{kind}")


def fallback_utm(lat: float | None, lon: float | None) -> Projection:
    """Plain UTM of the mean place; of 0, 0 where there is none."""
    return _from(Tmerc.utm(int(math.floor(((lon or 0.0) + 180) / 6)) + 1, (lat or 0.0) < 0), "fallback-utm")


def local_frame(lat: float, lon: float) -> Tmerc:
    return Tmerc(lat, lon)
