"""Pieces of checking SQL: grids, projections and polygon edges written out."""

from __future__ import annotations

from eocube.model import GridSpec

R_MERC = "6378137e0"
DEG = "(pi() / 180e0)"


def num(v: float) -> str:
    return f"({v!r}::double)"


def center(spec: GridSpec, axis: str, idx: str) -> str:
    origin, step = (spec.x0, spec.dx) if axis == "x" else (spec.y0, spec.dy)
    return f"({num(origin)} + ({idx} + 0.5e0) * {num(step)})"


def mercator_lon(x: str) -> str:
    return f"({x} / {R_MERC} / {DEG})"


def mercator_lat(y: str) -> str:
    return f"((2 * atan(exp({y} / {R_MERC})) - pi() / 2) / {DEG})"


def cells(spec: GridSpec) -> str:
    return f"select cast(i as bigint) as y_idx, cast(j as bigint) as x_idx from range({spec.ny}) a(i), range({spec.nx}) b(j)"


def mercator_lookup(src: GridSpec, dst: GridSpec) -> str:
    """Target cells of a web-mercator grid with their position (ax, ay) in a lon-lat grid."""
    lon = mercator_lon(center(dst, "x", "x_idx"))
    lat = mercator_lat(center(dst, "y", "y_idx"))
    return f"""
      select * from (
        select y_idx, x_idx, ({lon} - {num(src.x0)}) / {num(src.dx)} as ax, ({lat} - {num(src.y0)}) / {num(src.dy)} as ay
        from ({cells(dst)}))
      where ax >= 0 and ax < {src.nx} and ay >= 0 and ay < {src.ny}"""


_E2 = "((1 / 298.257223563e0) * (2 - 1 / 298.257223563e0))"
_S0, _C0 = "sin(radians(53e0))", "cos(radians(53e0))"
_N0 = f"({R_MERC} / sqrt(1 - {_E2} * {_S0} * {_S0}))"
_G = f"(sqrt({_E2}) * {_S0} / sqrt(1 - {_E2}))"


def aeqd(inner: str) -> str:
    """Add east and north of a relation's lon and lat: azimuth and distance from the centre."""
    return f"""
      select *, 5837287.81977e0 + c * sin(az) as east, 2121415.69617e0 + c * cos(az) as north from (
        select *, {_N0} * s * (1 - pow(s, 2) * pow(h, 2) * (1 - pow(h, 2)) / 6 + pow(s, 3) / 8 * {_G} * h * (1 - 2 * pow(h, 2))
          + pow(s, 4) / 120 * (pow(h, 2) * (4 - 7 * pow(h, 2)) - 3 * pow({_G}, 2) * (1 - 7 * pow(h, 2))) - pow(s, 5) / 48 * {_G} * h) as c from (
          select *, sqrt({_E2}) * {_C0} * cos(az) / sqrt(1 - {_E2}) as h from (
            select *, atan2(cos(psi) * sin(lam), {_C0} * sin(psi) - {_S0} * cos(psi) * cos(lam)) as az,
                   acos({_S0} * sin(psi) + {_C0} * cos(psi) * cos(lam)) as s from (
              select *, radians(lon - 24e0) as lam,
                     atan((1 - {_E2}) * tan(radians(lat)) + {_E2} * {_N0} * {_S0} * sqrt(1 - {_E2} * pow(sin(radians(lat)), 2)) / ({R_MERC} * cos(radians(lat)))) as psi
              from ({inner})))))"""


def aeqd_inverse(inner: str) -> str:
    """Add lon and lat of a relation's east and north."""
    return f"""
      select *, 24e0 + degrees(asin(sin(az) * sin(e) / cos(psi))) as lon,
             degrees(atan((1 - {_E2} * (1 - a * pow(e, 2) / 2 - b * pow(e, 3) / 6) * {_S0} / sin(psi)) * tan(psi) / (1 - {_E2}))) as lat from (
        select *, asin({_S0} * cos(e) + {_C0} * sin(e) * cos(az)) as psi from (
          select *, d - a * (1 + a) * pow(d, 3) / 6 - b * (1 + 3 * a) * pow(d, 4) / 24 as e from (
            select *, 3 * {_E2} * (1 - a) * {_S0} * {_C0} * cos(az) / (1 - {_E2}) as b from (
              select *, -{_E2} * pow({_C0}, 2) * pow(cos(az), 2) / (1 - {_E2}) as a from (
                select *, sqrt(pow(east - 5837287.81977e0, 2) + pow(north - 2121415.69617e0, 2)) / {_N0} as d,
                       atan2(east - 5837287.81977e0, north - 2121415.69617e0) as az from ({inner}))))))"""


def nearest(lookup: str, src: str, keys: str, value: str) -> str:
    """Nearest sampling of ``src`` through a lookup."""
    k = "".join(f"s.{c}, " for c in keys.split(",") if c)
    return f"""
      select {k}d.y_idx, d.x_idx, s.{value} from ({lookup}) d
      join {src} s on s.x_idx = floor(d.ax) and s.y_idx = floor(d.ay)"""


def bilinear(lookup: str, src: str, keys: str, value: str) -> str:
    """Bilinear sampling of ``src`` through a lookup, missing corners left out."""
    k = "".join(f"s.{c}, " for c in keys.split(",") if c)
    w = (
        "(case when r.i = 0 then 1 - (d.ax - 0.5e0 - floor(d.ax - 0.5e0)) else d.ax - 0.5e0 - floor(d.ax - 0.5e0) end"
        " * case when b.i = 0 then 1 - (d.ay - 0.5e0 - floor(d.ay - 0.5e0)) else d.ay - 0.5e0 - floor(d.ay - 0.5e0) end)"
    )
    return f"""
      select {k}d.y_idx, d.x_idx,
             sum(case when s.{value} is not null then {w} * s.{value} end)
             / nullif(sum(case when s.{value} is not null then {w} else 0 end), 0) as {value}
      from ({lookup}) d, range(2) r(i), range(2) b(i), {src} s
      where s.x_idx = floor(d.ax - 0.5e0) + r.i and s.y_idx = floor(d.ay - 0.5e0) + b.i
      group by {k}d.y_idx, d.x_idx"""


def coarse(src: str, value: str, k: int, spec: GridSpec, agg: str) -> str:
    """Dense block reduction: every block of the trimmed grid."""
    out = spec.coarsen(k)
    return f"""
      select g.y_idx, g.x_idx, {agg} as {value} from ({cells(out)}) g
      left join {src} s on floor(s.y_idx / {k}) = g.y_idx and floor(s.x_idx / {k}) = g.x_idx
      group by g.y_idx, g.x_idx"""


def flag(value: str) -> str:
    return f"(case when coalesce(median(s.{value}) > 0, false) then 1e0 else 0e0 end)"


def edges(polygons) -> str:
    rows = []
    for p, ring in enumerate(polygons):
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            rows.append(f"({p}, {x1}::double, {y1}::double, {x2}::double, {y2}::double)")
    return f"(values {', '.join(rows)}) e(poly, x1, y1, x2, y2)"


def inside(polygons, cx: str, cy: str) -> str:
    """True when a centre lies in any polygon, by crossing parity per polygon."""
    tests = []
    for ring in polygons:
        crossings = " + ".join(
            f"(case when ({y1}::double > {cy}) <> ({y2}::double > {cy}) and {cx} < {x1}::double + ({cy} - {y1}::double) * ({x2}::double - {x1}::double) / ({y2}::double - {y1}::double) then 1 else 0 end)"
            for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1])
            if y1 != y2
        )
        tests.append(f"(({crossings}) % 2 = 1)")
    return "(" + " or ".join(tests) + ")"


def bins(view: str, keys: str, value: str, every: int, time: str = "time") -> str:
    """Gap-filled calendar bins from the first day of the whole view."""
    on = " and ".join(f"b.{k} = g.{k}" for k in keys.split(","))
    return f"""
      select cast(cast(g.first + cast(g.bin * {every} as integer) as date) as timestamp) as {time}, {", ".join("g." + k for k in keys.split(","))}, b.v as {value}
      from (select * from (select distinct {keys} from {view}),
              (select cast(min({time}) as date) as first, cast(max({time}) as date) as last from {view}),
              range(100) n(bin) where bin <= floor((last - first) / {every})) g
      left join (select {keys}, cast(floor((cast({time} as date) - (select cast(min({time}) as date) from {view})) / {every}) as bigint) as bin, avg({value}) as v
                 from {view} group by all) b on {on} and b.bin = g.bin"""


def stretched(inner: str, value: str, others: str) -> str:
    """0..1 over the whole relation; a constant one becomes missing."""
    return f"""
      select {others}, ({value} - lo) / nullif(hi - lo, 0) as {value}
      from ({inner}) c, (select min({value}) as lo, max({value}) as hi from ({inner}))"""
