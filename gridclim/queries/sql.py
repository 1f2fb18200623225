"""Shared pieces of the SQL twins."""

from __future__ import annotations

LAT = "30 + CAST(0.25 AS DOUBLE) * (({k} // 24) % 181)"
LON = "-30 + CAST(0.25 AS DOUBLE) * (({k} // 6) % 4 + 4 * (({k} // 4344) % 80))"


def lat(k: str) -> str:
    return "(" + LAT.format(k=k) + ")"


def lon(k: str) -> str:
    return "(" + LON.format(k=k) + ")"


GRID = f"""grid AS (
  SELECT CAST(l_shipdate AS DATE) AS time, {lat('l_suppkey')} AS lat, {lon('l_suppkey')} AS lon,
         avg(l_quantity) - 9 AS tas, min(l_quantity) - 10 AS tasmin, max(l_quantity) - 8 AS tasmax,
         round(sum(l_tax) * 150, 6) AS pr
  FROM lineitem GROUP BY 1, 2, 3)"""

WIND = f"""wind AS (
  SELECT CAST(l_shipdate AS DATE) AS time, {lat('l_suppkey')} AS lat, {lon('l_suppkey')} AS lon,
         max(l_discount) * 100 - 5 AS u10, max(l_tax) * 100 - 3 AS v10
  FROM lineitem GROUP BY 1, 2, 3)"""

PSL = f"""psl AS (
  SELECT CAST(o_orderdate AS DATE) AS time, {lat('(o_custkey % 48)')} AS lat, {lon('(o_custkey % 48)')} AS lon,
         max(o_totalprice) AS psl
  FROM orders GROUP BY 1, 2, 3)"""

OBS = """obs AS (
  SELECT ts, 30 + CAST(0.25 AS DOUBLE) * (user_id % 16) AS lat,
         -30 + CAST(0.25 AS DOUBLE) * ((user_id // 16) % 4) AS lon,
         CASE event_type WHEN 'view' THEN 'tas' WHEN 'click' THEN 'tasmax' WHEN 'signup' THEN 'tasmin'
           WHEN 'purchase' THEN 'pr' WHEN 'error' THEN 'sfcWind' END AS variable, value
  FROM events)"""


def month(t: str = "time") -> str:
    return f"CAST(date_trunc('month', {t}) AS DATE)"


def season(t: str = "time") -> str:
    return f"CAST(date_trunc('quarter', {t} + INTERVAL 1 MONTH) - INTERVAL 1 MONTH AS DATE)"


def year(t: str = "time") -> str:
    return f"CAST(date_trunc('year', {t}) AS DATE)"


STARTS = {"MS": month, "QS-DEC": season, "YS": year}


def start(freq: str, t: str = "time") -> str:
    return STARTS[freq](t)


def filter_name(freq: str = "freq", t: str = "time") -> str:
    return (
        f"CASE {freq} WHEN 'YS' THEN 'Annual' WHEN 'QS-DEC' THEN CASE month({t}) WHEN 12 THEN 'DecFeb' "
        f"WHEN 3 THEN 'MarMay' WHEN 6 THEN 'JunAug' WHEN 9 THEN 'SepNov' END ELSE strftime({t}, '%b') END"
    )


def reference(freq: str = "freq", t: str = "time") -> str:
    return (
        f"CASE WHEN {freq} = 'QS-DEC' AND month({t}) = 12 THEN make_date(year({t}) + 1, 1, 1) ELSE {t} END"
    )


EXPECTED = "expected AS (SELECT * FROM (VALUES ('MS', 31), ('QS-DEC', 92), ('YS', 365)) v(freq, expected))"


def periods(axis: str = "grid") -> str:
    """``periods(freq, time, n)`` of the time axis of a relation."""
    parts = " UNION ALL ".join(
        f"SELECT '{f}' AS freq, {fn('time')} AS time FROM axis" for f, fn in STARTS.items()
    )
    return (
        f"axis AS (SELECT DISTINCT time FROM {axis}), "
        f"periods AS (SELECT freq, time, count(*) AS n FROM ({parts}) GROUP BY 1, 2)"
    )


COMPLETE = (
    EXPECTED
    + """, complete AS (SELECT p.freq, p.time FROM periods p JOIN expected e ON p.freq = e.freq
  WHERE n >= expected * CAST(0.8 AS DOUBLE))"""
)


def _box(x0: str, y0: str, x1: str, y1: str) -> str:
    pts = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
    return "[" + ", ".join(f"{{'x': CAST({x} AS DOUBLE), 'y': CAST({y} AS DOUBLE)}}" for x, y in pts) + "]"


def _near(*pts: tuple[float, float]) -> str:
    k = "s_suppkey"
    return "[" + ", ".join(
        f"{{'x': {lon(k)} + CAST({dx} AS DOUBLE), 'y': {lat(k)} + CAST({dy} AS DOUBLE)}}" for dx, dy in pts
    ) + "]"


def _near_box(w: float, e: float, s: float, n: float) -> str:
    return _near((w, s), (e, s), (e, n), (w, n), (w, s))


_LOW = "CAST(29.875 AS DOUBLE) + 9 * r_regionkey"
_X = "(CAST(-30.125 AS DOUBLE) + CAST(0.2 AS DOUBLE) * (n_nationkey % 5))"
_Y = "(CAST(29.875 AS DOUBLE) + CAST(0.25 AS DOUBLE) * (n_nationkey // 5))"
_W = "CASE WHEN n_nationkey % 11 = 10 THEN CAST(0.02 AS DOUBLE) ELSE CAST(0.3 AS DOUBLE) END"
_RLAT, _RLON = lat("(row_no * 24)"), lon("(row_no * 24)")
_Q = "CAST(0.125 AS DOUBLE)"

REGIONS = f"""regions AS (
  SELECT 'NUTS-0' AS region_set, 'B' || r_regionkey AS region, r_name AS name, r_name AS country,
    CASE WHEN r_regionkey = 0 THEN [{_box('-30.125', _LOW, '50.125', _LOW + ' + 9')}, {_box('-29.9', '30.4', '-29.6', '30.6')}]
    ELSE [{_box('-30.125', _LOW, '50.125', _LOW + ' + 9')}] END AS rings
  FROM region
  UNION ALL
  SELECT 'NUTS-1', 'N' || n_nationkey, n_name, r_name,
    [{_box(_X, _Y, f'{_X} + {_W}', f'{_Y} + CAST(0.25 AS DOUBLE)')}]
  FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL
  SELECT 'NUTS-2', 'R' || row_no, 'Row ' || (row_no % 3), 'C' || (row_no % 2),
    [{_box(f'{_RLON} - {_Q}', f'{_RLAT} - {_Q}', f'{_RLON} + CAST(0.875 AS DOUBLE)', f'{_RLAT} + {_Q}')}]
  FROM (SELECT DISTINCT s_suppkey // 24 AS row_no FROM supplier)
  UNION ALL
  SELECT 'NUTS-3', 'S' || s_suppkey, 'Area ' || (s_suppkey // 2), n_name,
    CASE s_suppkey % 6
      WHEN 0 THEN [{_near_box(-0.15, 0.15, -0.15, 0.15)}]
      WHEN 1 THEN [{_near_box(-0.15, 0.55, -0.15, 0.15)}]
      WHEN 2 THEN [{_near_box(0.05, 0.06, -0.1, 0.1)}]
      WHEN 3 THEN [{_near((-0.3, -0.2), (0.9, -0.2), (-0.3, 0.9), (-0.3, -0.2))}]
      WHEN 4 THEN [{_near_box(-0.35, 0.35, -0.35, 0.35)}, {_near_box(-0.1, 0.1, -0.1, 0.1)}]
      ELSE [{_near_box(-0.1, 0.1, -0.6, 0.6)}] END
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""

CELLS = f"""cells AS (
  SELECT DISTINCT {lat('l_suppkey')} AS lat, {lon('l_suppkey')} AS lon FROM lineitem)"""

INSIDE = """ring AS (SELECT region_set, region, unnest(rings) AS r FROM regions),
edge AS (SELECT region_set, region, r[i] AS p, r[i + 1] AS q FROM ring, unnest(range(1, len(r))) AS t(i)),
inside AS (
  SELECT region_set, region, lat, lon FROM cells, edge
  WHERE (p.y > lat) <> (q.y > lat) AND lon < p.x + (lat - p.y) * (q.x - p.x) / (q.y - p.y)
  GROUP BY 1, 2, 3, 4 HAVING count(*) % 2 = 1)"""

NEAREST = """empty_regions AS (
  SELECT * FROM regions r WHERE NOT EXISTS (
    SELECT 1 FROM inside i WHERE i.region_set = r.region_set AND i.region = r.region)),
centre AS (
  SELECT region_set, region, (min(p.y) + max(p.y)) / 2 AS cy, (min(p.x) + max(p.x)) / 2 AS cx
  FROM (SELECT region_set, region, unnest(flatten(rings)) AS p FROM empty_regions) GROUP BY 1, 2),
nearest AS (
  SELECT region_set, region,
    (SELECT lat FROM (SELECT DISTINCT lat FROM cells) ORDER BY abs(lat - cy), lat DESC LIMIT 1) AS lat,
    (SELECT lon FROM (SELECT DISTINCT lon FROM cells) ORDER BY abs(lon - cx), lon DESC LIMIT 1) AS lon
  FROM centre)"""

XWALK = (
    ", ".join([CELLS, REGIONS, INSIDE, NEAREST])
    + """, xwalk AS (
  SELECT region_set, region, lat, lon, cos(radians(lat)) AS w, 0 AS filled FROM inside
  UNION ALL SELECT region_set, region, lat, lon, 1.0, 1 FROM nearest)"""
)


def union(*parts: str) -> str:
    return " UNION ALL ".join(parts)


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
