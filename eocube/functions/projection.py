"""Map projections in closed form.

A projection is a list of steps; each takes the values so far and returns new
ones, written against a small maths namespace ``m``.  With ``math`` the steps
compute plain floats, for grid planning.  With ``pyspark.sql.functions`` each
step becomes a projection of the DataFrame: intermediate values are columns of
one generated stage instead of being repeated inside an ever larger expression.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache
from types import SimpleNamespace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Coordinate reference systems and the constants they define.
LONLAT = "EPSG:4326"
WEB_MERCATOR = "EPSG:3857"
MOLLWEIDE = "ESRI:54009"
EQUIDISTANT_EU = "+proj=aeqd +lat_0=53 +lon_0=24 +x_0=5837287.81977 +y_0=2121415.69617 +datum=WGS84 +units=m +no_defs"
WGS84_RADIUS = 6378137.0
WGS84_FLATTENING = 1 / 298.257223563
#: The continental equidistant grids of the flood archive by their two letters.
EQUI7_GRIDS = {
    "AF": "+proj=aeqd +lat_0=8.5 +lon_0=21.5 +x_0=5621452.01998 +y_0=5990638.42298 +datum=WGS84 +units=m +no_defs",
    "AN": "+proj=aeqd +lat_0=-90 +lon_0=0 +x_0=3714266.97719 +y_0=3402016.50625 +datum=WGS84 +units=m +no_defs",
    "AS": "+proj=aeqd +lat_0=47 +lon_0=94 +x_0=4340913.84808 +y_0=4812712.92347 +datum=WGS84 +units=m +no_defs",
    "EU": EQUIDISTANT_EU,
    "NA": "+proj=aeqd +lat_0=52 +lon_0=-97.5 +x_0=8264722.17686 +y_0=4867518.35323 +datum=WGS84 +units=m +no_defs",
    "OC": "+proj=aeqd +lat_0=-19.5 +lon_0=131.5 +x_0=6988408.5356 +y_0=7654884.53733 +datum=WGS84 +units=m +no_defs",
    "OZ": "+proj=aeqd +lat_0=-19.5 +lon_0=131.5 +x_0=6988408.5356 +y_0=7654884.53733 +datum=WGS84 +units=m +no_defs",
    "SA": "+proj=aeqd +lat_0=-14 +lon_0=-60.5 +x_0=7257179.23559 +y_0=5592024.44605 +datum=WGS84 +units=m +no_defs",
}

DEG = math.pi / 180.0
NEWTON_STEPS = 12

#: Projections where x depends on longitude alone and y on latitude alone.
SEPARABLE = frozenset({LONLAT, WEB_MERCATOR})


# Derived from the ellipsoid.
E2 = WGS84_FLATTENING * (2 - WGS84_FLATTENING)
MOLLWEIDE_X = 2 * math.sqrt(2) / math.pi * WGS84_RADIUS
MOLLWEIDE_Y = math.sqrt(2) * WGS84_RADIUS


def _ratio(num, den, at_zero, m):
    """``num / den``, with the limit ``at_zero`` where the denominator is 0."""
    if m is math:
        return at_zero if den == 0 else num / den
    return F.coalesce(F.try_divide(num, den), F.lit(at_zero))


_MERCATOR = [
    lambda p, m: {
        "x": p.lon * (DEG * WGS84_RADIUS),
        "y": m.log(m.tan(p.lat * (DEG / 2) + math.pi / 4)) * WGS84_RADIUS,
    }
]
_MERCATOR_INVERSE = [
    lambda p, m: {
        "lon": p.x * (1 / (DEG * WGS84_RADIUS)),
        "lat": (m.atan(m.exp(p.y * (1 / WGS84_RADIUS))) * 2 - math.pi / 2) * (1 / DEG),
    }
]

@lru_cache
def _azimuthal(crs: str) -> tuple[list, list]:
    """Forward and inverse steps of an equidistant map given as ``+proj=aeqd`` with its centre and false origin.

    Ellipsoidal form for a fixed centre (Snyder 1987, USGS PP 1395, p. 199).  It
    measures along normal sections, which differs from geodesics by less than
    80 m over Italy; a sphere would be off by 4 km there.
    """
    given = dict(re.findall(r"\+(\w+)=(\S+)", crs))
    if given.get("datum") != "WGS84" or given.get("units") != "m":
        raise ValueError(f"only WGS84 in metres is supported: {crs!r}")
    lat0, lon0, x0, y0 = (float(given[k]) for k in ("lat_0", "lon_0", "x_0", "y_0"))
    sin0, cos0 = math.sin(lat0 * DEG), math.cos(lat0 * DEG)
    n0 = WGS84_RADIUS / math.sqrt(1 - E2 * sin0**2)
    g0 = math.sqrt(E2 / (1 - E2)) * sin0
    forward = [
        lambda p, m: {"phi": p.lat * DEG, "lam": (p.lon - lon0) * DEG},
        lambda p, m: {
            "psi": m.atan(
                m.tan(p.phi) * (1 - E2)
                + m.sqrt(1 - m.sin(p.phi) * m.sin(p.phi) * E2) * (E2 * n0 * sin0 / WGS84_RADIUS) / m.cos(p.phi)
            )
        },
        lambda p, m: {
            "u": m.cos(p.psi) * m.sin(p.lam),
            "v": m.sin(p.psi) * cos0 - m.cos(p.psi) * m.cos(p.lam) * sin0,
            "w": m.sin(p.psi) * sin0 + m.cos(p.psi) * m.cos(p.lam) * cos0,
        },
        lambda p, m: {"side": m.sqrt(p.u * p.u + p.v * p.v)},
        lambda p, m: {"s": m.atan2(p.side, p.w), "h": _ratio(p.v, p.side, 1.0, m) * (math.sqrt(E2 / (1 - E2)) * cos0)},
        lambda p, m: {"h2": p.h * p.h, "s2": p.s * p.s},
        lambda p, m: {
            "c": p.s * n0 * (
                1
                - p.s2 * p.h2 * (1 - p.h2) / 6
                + p.s2 * p.s * p.h * (1 - p.h2 * 2) * (g0 / 8)
                + p.s2 * p.s2 * (p.h2 * (4 - p.h2 * 7) - (1 - p.h2 * 7) * (3 * g0**2)) / 120
                - p.s2 * p.s2 * p.s * p.h * (g0 / 48)
            )
        },
        lambda p, m: {"k": _ratio(p.c, p.side, 0.0, m)},
        lambda p, m: {"x": p.u * p.k + x0, "y": p.v * p.k + y0},
    ]
    inverse = [
        lambda p, m: {"u": p.x - x0, "v": p.y - y0},
        lambda p, m: {"c": m.sqrt(p.u * p.u + p.v * p.v)},
        lambda p, m: {"sin_az": _ratio(p.u, p.c, 0.0, m), "cos_az": _ratio(p.v, p.c, 1.0, m), "d": p.c / n0},
        lambda p, m: {"a": p.cos_az * p.cos_az * (-E2 * cos0**2 / (1 - E2))},
        lambda p, m: {"b": (1 - p.a) * p.cos_az * (3 * E2 * sin0 * cos0 / (1 - E2))},
        lambda p, m: {"e": p.d - p.a * (p.a + 1) * p.d * p.d * p.d / 6 - p.b * (p.a * 3 + 1) * p.d * p.d * p.d * p.d / 24},
        lambda p, m: {
            "f": 1 - p.a * p.e * p.e / 2 - p.b * p.e * p.e * p.e / 6,
            "east": p.sin_az * m.sin(p.e),
            "north": m.cos(p.e) * cos0 - m.sin(p.e) * p.cos_az * sin0,
            "sin_psi": m.cos(p.e) * sin0 + m.sin(p.e) * p.cos_az * cos0,
        },
        lambda p, m: {
            "lon": m.atan2(p.east, p.north) * (1 / DEG) + lon0,
            "lat": m.atan((p.sin_psi - p.f * (E2 * sin0)) / (m.sqrt(p.east * p.east + p.north * p.north) * (1 - E2))) * (1 / DEG),
        },
    ]
    return forward, inverse


def _newton(p, m):
    """One step on ``u + sin u = pi sin(phi)``; stays put at the poles."""
    slope = m.cos(p.u) + 1.0
    if m is math:
        return {"u": p.u if slope < 1e-12 else p.u - (p.u + math.sin(p.u) - p.target) / slope}
    moved = p.u - (p.u + F.sin(p.u) - p.target) / F.greatest(slope, F.lit(1e-12))
    return {"u": F.when(slope < 1e-12, p.u).otherwise(moved)}


_MOLLWEIDE = [
    lambda p, m: {"u": p.lat * (2 * DEG), "target": m.sin(p.lat * DEG) * math.pi},
    *[_newton] * NEWTON_STEPS,
    lambda p, m: {"x": p.lon * DEG * m.cos(p.u / 2) * MOLLWEIDE_X, "y": m.sin(p.u / 2) * MOLLWEIDE_Y},
]
_MOLLWEIDE_INVERSE = [
    lambda p, m: {"t": m.asin(p.y * (1 / MOLLWEIDE_Y))},
    lambda p, m: {
        "lat": m.asin((p.t * 2 + m.sin(p.t * 2)) * (1 / math.pi)) * (1 / DEG),
        "lon": _ratio(p.x, m.cos(p.t) * MOLLWEIDE_X, 0.0, m) * (1 / DEG),
    },
]

_TO_XY = [lambda p, m: {"x": p.lon, "y": p.lat}]
_TO_LONLAT = [lambda p, m: {"lon": p.x, "lat": p.y}]
_FORWARD = {LONLAT: _TO_XY, WEB_MERCATOR: _MERCATOR, MOLLWEIDE: _MOLLWEIDE}
_INVERSE = {
    LONLAT: _TO_LONLAT,
    WEB_MERCATOR: _MERCATOR_INVERSE,
    MOLLWEIDE: _MOLLWEIDE_INVERSE,
}


def _steps(src: str, dst: str) -> list:
    for crs in (src, dst):
        if crs not in _FORWARD and not is_azimuthal(crs):
            raise ValueError(f"unsupported coordinate reference system: {crs!r}")
    if src == dst:
        return []
    back = _azimuthal(src)[1] if is_azimuthal(src) else _INVERSE[src]
    there = _azimuthal(dst)[0] if is_azimuthal(dst) else _FORWARD[dst]
    return [*back, *there]


def is_azimuthal(crs: str) -> bool:
    return "+proj=aeqd" in crs.split()


def project(df: DataFrame, x: Column, y: Column, src: str, dst: str, to: tuple[str, str]) -> DataFrame:
    """Add the coordinates ``(x, y)`` transformed from one system to another.

    Long transformations end in a one-row ``inline``.  Without it, a later
    filter or join on the coordinates would be pushed below the steps, written
    out as one expression that repeats every step many times over.
    """
    keep = [c for c in df.columns if c not in to]
    name = "_p_{}".format
    df = df.withColumns({name("x"): x, name("y"): y})
    p = SimpleNamespace(x=F.col(name("x")), y=F.col(name("y")))
    steps = _steps(src, dst)
    for step in steps:
        new = step(p, F)
        df = df.withColumns({name(k): v for k, v in new.items()})
        for k in new:
            setattr(p, k, F.col(name(k)))
    out = p.x.alias(to[0]), p.y.alias(to[1])
    return df.select(*keep, *(out if len(steps) <= 2 else [F.inline(F.array(F.struct(*out)))]))


def project_point(x: float, y: float, src: str, dst: str) -> tuple[float, float]:
    """The same transformation for one point."""
    p = SimpleNamespace(x=x, y=y)
    for step in _steps(src, dst):
        for k, v in step(p, math).items():
            setattr(p, k, v)
    return p.x, p.y


def separable(src: str, dst: str) -> bool:
    """True when the two axes transform independently of each other."""
    return src == dst or (src in SEPARABLE and dst in SEPARABLE)
