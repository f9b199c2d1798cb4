"""DuckDB SQL with the expected result of each query, written independently of the operators.

The SQL spells out the plain definition: rasterising tests every cell against every
edge, morphology compares cells pairwise by key, ranks use unsplit windows.
"""

from __future__ import annotations

_DN = """dn AS (
  SELECT CAST(l_suppkey % 5 AS INT) AS zone, CAST((l_partkey - 1) // 50 AS INT) AS r,
         CAST(l_orderkey % 40 AS INT) AS c, l_shipdate AS ts, CAST(year(l_shipdate) AS INT) AS scene,
         l_tax * 125000 AS dn_b02, l_discount * 100000 AS dn_b03, l_extendedprice / 10 AS dn_b04,
         (l_discount * 100000 + l_extendedprice / 10) / 2 AS dn_b05,
         CAST((l_partkey * 7 + l_orderkey) % 9001 AS DOUBLE) AS dn_b06,
         CAST((l_orderkey * 13 + l_linenumber * 101) % 10001 AS DOUBLE) AS dn_b07,
         (l_quantity - 1) * 204 AS dn_b8a,
         CAST((l_suppkey * 37 + l_partkey) % 8001 AS DOUBLE) AS dn_b11,
         CAST((l_orderkey + l_partkey) % 7001 AS DOUBLE) AS dn_b12,
         CAST((l_orderkey + l_linenumber) % 12 AS INT) AS scl
  FROM lineitem)"""

_BANDS = ["b02", "b03", "b04", "b05", "b06", "b07", "b8a", "b11", "b12"]
_SCALED = ", ".join(f"least(greatest(dn_{b} / 1e4, 0e0), 1e0) AS {b}" for b in _BANDS)

_PX = f"""{_DN}, bands AS (SELECT zone, r, c, ts, scene, scl, {_SCALED} FROM dn),
px AS (
  SELECT *, CASE WHEN b8a + b04 = 0 THEN 0e0 ELSE (b8a - b04) / (b8a + b04) END AS ndvi,
            CASE WHEN b03 + b8a = 0 THEN 0e0 ELSE (b03 - b8a) / (b03 + b8a) END AS ndwi
  FROM bands),
obs AS (SELECT * FROM px WHERE b02 <> 0)"""

_EXTENT = f"""{_PX},
extent AS (SELECT zone, max(r) + 1 AS height, max(c) + 1 AS width FROM dn GROUP BY zone)"""

_GEO = f"""{_EXTENT},
geo AS (SELECT zone, height, width, 0.0002e0 AS a, -0.0002e0 AS e, -75e0 + zone * 0.1e0 AS x0,
               CASE WHEN zone = 4 THEN 20e0 ELSE 6e0 + zone * 0.1e0 END AS y0 FROM extent)"""

_EDGES = f"""{_EXTENT},
corner(layer, base_id, seq, x, y0) AS (VALUES
  ('forest', 1, 0, 2.3e0, 3.1e0), ('forest', 1, 1, 30.2e0, 5.4e0),
  ('forest', 1, 2, 25.7e0, 33.6e0), ('forest', 1, 3, 6.4e0, 28.9e0),
  ('forest', 2, 0, 20.1e0, 20.2e0), ('forest', 2, 1, 38.3e0, 22.7e0),
  ('forest', 2, 2, 36.9e0, 37.4e0), ('forest', 2, 3, 22.8e0, 35.3e0),
  ('perimeter', 3, 0, 0.2e0, 1.3e0), ('perimeter', 3, 1, 39.1e0, 0.7e0),
  ('perimeter', 3, 2, 38.8e0, 36.2e0), ('perimeter', 3, 3, 1.7e0, 39.4e0)),
block AS (SELECT zone, CAST(unnest(range(0, CAST(ceil(height / 40e0) AS BIGINT))) AS INT) AS block FROM extent),
vertex AS (SELECT zone, layer, block * 10 + base_id AS poly_id, seq, x, y0 + block * 40e0 AS y
           FROM block CROSS JOIN corner),
edge AS (
  SELECT zone, layer, poly_id, seq, x AS x1, y AS y1,
         coalesce(lead(x) OVER w, first_value(x) OVER w) AS x2,
         coalesce(lead(y) OVER w, first_value(y) OVER w) AS y2
  FROM vertex WINDOW w AS (PARTITION BY zone, layer, poly_id ORDER BY seq))"""

_CELLS = f"""{_EDGES},
grid AS (SELECT e.zone, CAST(rr.r AS INT) AS r, CAST(cc.c AS INT) AS c, width
         FROM extent e, LATERAL (SELECT unnest(range(0, e.height)) AS r) rr,
              LATERAL (SELECT unnest(range(0, e.width)) AS c) cc),
crossing AS (
  SELECT zone, layer, poly_id, seq, x1, y1, x2, y2,
         CAST(unnest(range(CAST(floor(least(y1, y2)) AS BIGINT), CAST(ceil(greatest(y1, y2)) AS BIGINT) + 1)) AS INT) AS r
  FROM edge),
inside AS (
  SELECT g.zone, k.layer, k.poly_id, g.r, g.c
  FROM grid g JOIN crossing k ON k.zone = g.zone AND k.r = g.r
  WHERE (k.y1 > g.r + 0.5e0) <> (k.y2 > g.r + 0.5e0)
    AND g.c + 0.5e0 < (k.x2 - k.x1) * (g.r + 0.5e0 - k.y1) / (k.y2 - k.y1) + k.x1
  GROUP BY ALL HAVING count(*) % 2 = 1),
cell AS (SELECT DISTINCT zone, layer, r, c FROM inside)"""


def _eroded(source: str, radius: int) -> str:
    need = 1 + 2 * radius * (radius + 1)
    return f"""(SELECT a.zone, a.r, a.c FROM {source} a JOIN {source} b
      ON a.zone = b.zone AND b.r BETWEEN a.r - {radius} AND a.r + {radius}
      AND abs(a.r - b.r) + abs(a.c - b.c) <= {radius}
      GROUP BY ALL HAVING count(*) = {need})"""


_LABELS = f"""{_CELLS},
wood AS (SELECT zone, r, c FROM cell WHERE layer = 'forest'),
farm AS (SELECT zone, r, c FROM cell WHERE layer = 'perimeter'),
core AS {_eroded("wood", 1)},
labels_grid AS (
  SELECT g.zone, g.r, g.c, CAST(CASE WHEN f.zone IS NULL THEN -1 WHEN k.zone IS NULL THEN 0 ELSE 1 END AS SMALLINT) AS label
  FROM grid g LEFT JOIN farm f USING (zone, r, c) LEFT JOIN core k USING (zone, r, c))"""

_PIXEL_LABELS = f"""{_LABELS},
pixel AS (SELECT DISTINCT zone, r, c FROM obs),
pixel_label AS (
  SELECT p.zone, p.r, p.c, CAST(coalesce(l.label, -1) AS SMALLINT) AS label
  FROM pixel p LEFT JOIN labels_grid l USING (zone, r, c))"""


def _nearest(column: str, q: float) -> str:
    values = f"list_sort(list({column}))"
    return f"{values}[CAST(floor((count(*) - 1) * {q}e0 + 0.5e0) AS BIGINT) + 1]"


def _medians(bands, digits: int = 9) -> str:
    return ", ".join(f"round(median({b}), {digits}) AS {b}_med" for b in bands)


def _composite(source: str, bands, keys: str = "zone, r, c") -> str:
    spread = ""
    if "ndvi" in bands:
        low, high = _nearest("ndvi", 0.1), _nearest("ndvi", 0.9)
        spread = (
            f", round({low}, 9) AS ndvi_p10, round({high}, 9) AS ndvi_p90, "
            f"round({high} - {low}, 9) AS ndvi_range"
        )
    return f"SELECT {keys}, {_medians(bands)}{spread}, count(*) AS n_obs FROM {source} GROUP BY ALL"


_ALL = [*_BANDS, "ndvi", "ndwi"]


def _flags(water: bool) -> str:
    bad = "3, 8, 9, 10, 11" + (", 6" if water else "")
    return f"""{_PX},
m1 AS (SELECT *, CASE WHEN scl IN ({bad}) THEN 0 ELSE 1 END AS clear1 FROM px),
bright AS (SELECT zone, scene, quantile_cont(b8a, 0.8) FILTER (clear1 = 1) AS p80 FROM m1 GROUP BY ALL),
m2 AS (SELECT m1.*, CASE WHEN clear1 = 1 AND NOT coalesce(ndvi < 0.1e0 AND b8a > p80, false) THEN 1 ELSE 0 END AS clear2
       FROM m1 JOIN bright USING (zone, scene)),
dark AS (SELECT zone, scene, quantile_cont(b8a, 0.2) FILTER (clear2 = 1) AS p20 FROM m2 GROUP BY ALL),
m3 AS (SELECT m2.*, CASE WHEN clear2 = 1 AND NOT coalesce(ndvi < 0.05e0 AND b8a < p20, false) THEN 1 ELSE 0 END AS clear3
       FROM m2 JOIN dark USING (zone, scene))"""


def _mask(water: bool = False) -> str:
    return f"""{_flags(water)},
bad AS (SELECT DISTINCT zone, scene, r, c FROM m3 WHERE clear3 = 0),
grown AS (SELECT DISTINCT b.zone, b.scene, b.r + o.dr AS r, b.c + o.dc AS c
          FROM bad b CROSS JOIN (VALUES (0, 0), (1, 0), (-1, 0), (0, 1), (0, -1)) o(dr, dc)),
mask AS (SELECT p.zone, p.scene, p.r, p.c, CASE WHEN g.zone IS NULL THEN 1 ELSE 0 END AS clear
         FROM (SELECT DISTINCT zone, scene, r, c FROM px) p LEFT JOIN grown g USING (zone, scene, r, c))"""


_NAMED = """named AS (
  SELECT *, 'zone' || (l_suppkey % 5) AS zone,
         CASE l_suppkey % 3 WHEN 0 THEN '18NWL' WHEN 1 THEN '18LWL' ELSE '19NBA' END AS tile,
         strftime(l_shipdate, '%Y%m%dT%H%M%S') AS stamp
  FROM lineitem),
product AS (
  SELECT *, 'S2' || CASE WHEN l_orderkey % 2 = 0 THEN 'A' ELSE 'B' END || '_MSIL2A_' || stamp || '_N0500_R'
            || lpad(CAST(l_suppkey % 143 AS VARCHAR), 3, '0') || '_T' || tile || '_' || stamp AS product,
         ['B02','B03','B04','B05','B06','B07','B8A','B11','B12'][l_linenumber + l_orderkey % 3] AS band,
         CASE WHEN l_quantity >= 46 THEN 60 ELSE 20 END AS res
  FROM named),
paths AS (
  SELECT zone, product, tile, stamp, band, res,
         zone || '/' || product || '.SAFE/GRANULE/L2A_T' || tile || '/IMG_DATA/R' || res || 'm/T' || tile || '_'
         || stamp || '_' || band || '_' || res || 'm.jp2' AS path
  FROM product)"""

_META = f"""{_NAMED},
meta AS (
  SELECT zone, product, tile,
         CASE WHEN max(l_partkey) % 5 = 0 THEN 'EPSG:32617' WHEN tile = '18LWL' THEN 'EPSG:32718'
              WHEN tile = '19NBA' THEN 'EPSG:32619' ELSE 'EPSG:32618' END AS file_crs,
         CASE tile WHEN '18LWL' THEN 'EPSG:32718' WHEN '19NBA' THEN 'EPSG:32619' ELSE 'EPSG:32618' END AS expected_crs,
         max(l_suppkey) % 7 <> 0 AS lon_valid,
         NOT (zone = 'zone4' AND max(l_partkey) % 2 = 0) AS lat_valid,
         count(*) FILTER (l_quantity > 5) AS n_overlap, min(l_tax) >= 0.08e0 AS clip_failed
  FROM product GROUP BY zone, product, tile),
flagged AS (
  SELECT *, file_crs <> expected_crs AS i1, NOT (lat_valid AND lon_valid) AS i2, n_overlap = 0 AS i3, clip_failed AS i4
  FROM meta),
issue AS (
  SELECT *, CASE WHEN i3 THEN 'no_overlap' WHEN i1 AND NOT i2 AND NOT i4 THEN 'crs_mismatch'
                 WHEN i2 AND NOT i1 AND NOT i4 THEN 'bounds_invalid' ELSE 'multiple_issues' END AS issue_type
  FROM flagged WHERE i1 OR i2 OR i3 OR i4)"""

_SCORED = f"""{_PX},
scored AS (SELECT CASE WHEN b04 > 0.5 THEN 1 ELSE 0 END AS label, round(b04 * 0.3e0 + b8a * 0.7e0, 3) AS score FROM px),
pred AS (SELECT *, CASE WHEN score >= 0.5e0 THEN 1 ELSE 0 END AS prediction FROM scored),
conf AS (SELECT count(*) FILTER (label = 0 AND prediction = 0) AS tn, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
                count(*) FILTER (label = 1 AND prediction = 0) AS fn, count(*) FILTER (label = 1 AND prediction = 1) AS tp FROM pred),
rates AS (SELECT *, tn / (tn + fn) AS p0, tn / (tn + fp) AS r0, tp / (tp + fp) AS p1, tp / (tp + fn) AS r1,
                 tn + fp AS n0, fn + tp AS n1 FROM conf),
f AS (SELECT *, 2 * p0 * r0 / (p0 + r0) AS f0, 2 * p1 * r1 / (p1 + r1) AS f1 FROM rates),
by_score AS (SELECT score, CAST(sum(label) AS BIGINT) AS p, count(*) AS n FROM scored GROUP BY score),
cum AS (SELECT score, p, n, sum(p) OVER d AS tp, sum(n) OVER d AS np, sum(p) OVER () AS pa, sum(n) OVER () AS na
        FROM by_score WINDOW d AS (ORDER BY score DESC)),
pairs AS (SELECT sum((1 - label) * 1e0) AS neg, sum(label * 1e0) AS pos,
                 sum(CASE WHEN label = 1 THEN rk ELSE 0 END) AS rank_sum
          FROM (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2e0 AS rk FROM scored)),
step AS (SELECT *, tp / np AS prec, coalesce(lag(tp / np) OVER (ORDER BY score DESC), tp / np) AS prec_before FROM cum)"""

_A, _F, _K0 = "6378137e0", "(1 / 298.257223563e0)", "0.9996e0"
_UTM = f"""{_EXTENT},
el AS (SELECT {_F} * (2 - {_F}) AS e2),
ell AS (SELECT e2, e2 / (1 - e2) AS ep, (1 - sqrt(1 - e2)) / (1 + sqrt(1 - e2)) AS e1,
               1 - e2 / 4 - 3 * e2 ** 2 / 64 - 5 * e2 ** 3 / 256 AS m0 FROM el),
scn AS (SELECT zone, height, width, 6 * (18 + zone % 2) - 183 AS lon_c, CASE WHEN zone >= 3 THEN 1e7 ELSE 0e0 END AS fn,
               5e5 + zone * 2e4 AS e0, CASE WHEN zone >= 3 THEN 9.9e6 ELSE 6e5 END AS n0 FROM extent),
cor AS (SELECT scn.*, ell.*, (n0 - j * 20e0 * height - fn) / ({_K0} * {_A} * m0) AS mu, e0 + i * 20e0 * width - 5e5 AS de
        FROM scn, ell, (VALUES (0), (1)) a(i), (VALUES (0), (1)) b(j)),
foot AS (SELECT *, mu + (1.5e0 * e1 - 27 * e1 ** 3 / 32) * sin(2 * mu) + (21 * e1 ** 2 / 16 - 55 * e1 ** 4 / 32) * sin(4 * mu)
                + 151 * e1 ** 3 / 96 * sin(6 * mu) + 1097 * e1 ** 4 / 512 * sin(8 * mu) AS ph FROM cor),
aux AS (SELECT *, ep * cos(ph) ** 2 AS cc, tan(ph) ** 2 AS tt, {_A} / sqrt(1 - e2 * sin(ph) ** 2) AS nn,
               {_A} * (1 - e2) / (1 - e2 * sin(ph) ** 2) ** 1.5e0 AS rr FROM foot),
off AS (SELECT *, de / (nn * {_K0}) AS d FROM aux),
geog AS (SELECT *, degrees(ph - nn * tan(ph) / rr * (d ** 2 / 2 - (5 + 3 * tt + 10 * cc - 4 * cc ** 2 - 9 * ep) * d ** 4 / 24
                  + (61 + 90 * tt + 298 * cc + 45 * tt ** 2 - 252 * ep - 3 * cc ** 2) * d ** 6 / 720)) AS lat,
                lon_c + degrees((d - (1 + 2 * tt + cc) * d ** 3 / 6
                  + (5 - 2 * cc + 28 * tt - 3 * cc ** 2 + 8 * ep + 24 * tt ** 2) * d ** 5 / 120) / cos(ph)) AS lon FROM off),
box AS (SELECT zone, height, width, lon_c, fn, e0, n0, e2, ep, m0, min(lon) AS lon0, max(lon) AS lon1, max(lat) AS lat0, min(lat) AS lat1
        FROM geog GROUP BY ALL),
net AS (SELECT *, sqrt((lon1 - lon0) ** 2 + (lat0 - lat1) ** 2) / sqrt(height ** 2 + width ** 2) AS st FROM box),
row_t AS (SELECT *, unnest(range(0, CAST(greatest(1, floor((lat0 - lat1) / st + 0.5e0)) AS BIGINT))) AS r FROM net),
tgt AS (SELECT *, unnest(range(0, CAST(greatest(1, floor((lon1 - lon0) / st + 0.5e0)) AS BIGINT))) AS c FROM row_t),
ang AS (SELECT *, radians(lat0 - st * (r + 0.5e0)) AS ph, radians(lon0 + st * (c + 0.5e0) - lon_c) AS lam FROM tgt),
fwd AS (SELECT *, {_A} / sqrt(1 - e2 * sin(ph) ** 2) AS nn, tan(ph) ** 2 AS tt, ep * cos(ph) ** 2 AS cc, cos(ph) * lam AS aa,
               {_A} * (m0 * ph - (3 * e2 / 8 + 3 * e2 ** 2 / 32 + 45 * e2 ** 3 / 1024) * sin(2 * ph)
                 + (15 * e2 ** 2 / 256 + 45 * e2 ** 3 / 1024) * sin(4 * ph) - 35 * e2 ** 3 / 3072 * sin(6 * ph)) AS mm FROM ang),
utm AS (SELECT zone, r, c, e0, n0,
               5e5 + {_K0} * nn * (aa + (1 - tt + cc) * aa ** 3 / 6 + (5 - 18 * tt + tt ** 2 + 72 * cc - 58 * ep) * aa ** 5 / 120) AS east,
               fn + {_K0} * (mm + nn * tan(ph) * (aa ** 2 / 2 + (5 - tt + 9 * cc + 4 * cc ** 2) * aa ** 4 / 24
                 + (61 - 58 * tt + tt ** 2 + 600 * cc - 330 * ep) * aa ** 6 / 720)) AS north FROM fwd),
pos AS (SELECT zone, r, c, (n0 - north) / 20 - 0.5e0 AS fr, (east - e0) / 20 - 0.5e0 AS fc FROM utm)"""


# Georeferenced rings: cut into short pieces, projected end by end, tested cell by cell.
_OCTAGON = ((1.0, 0.0), (0.7, 0.7), (0.0, 1.0), (-0.7, 0.7), (-1.0, 0.0), (-0.7, -0.7), (0.0, -1.0), (0.7, -0.7))
_CORNERS = ", ".join(f"({i}, {dx}e0, {dy}e0)" for i, (dx, dy) in enumerate(_OCTAGON))


def _utm_of(source: str, name: str, lon: str, lat: str, x: str, y: str) -> str:
    """CTEs that add UTM coordinates of the row's own zone (``lon_c``, ``fn``) to a relation."""
    return f"""{name}1 AS (SELECT s.*, ell.e2, ell.ep, ell.m0, radians({lat}) AS ph, radians({lon} - lon_c) AS lam FROM {source} s, ell),
{name}2 AS (SELECT *, {_A} / sqrt(1 - e2 * sin(ph) ** 2) AS nn, tan(ph) ** 2 AS tt, ep * cos(ph) ** 2 AS cc, cos(ph) * lam AS aa,
   {_A} * (m0 * ph - (3 * e2 / 8 + 3 * e2 ** 2 / 32 + 45 * e2 ** 3 / 1024) * sin(2 * ph)
     + (15 * e2 ** 2 / 256 + 45 * e2 ** 3 / 1024) * sin(4 * ph) - 35 * e2 ** 3 / 3072 * sin(6 * ph)) AS mm FROM {name}1),
{name} AS (SELECT * EXCLUDE (e2, ep, m0, ph, lam, nn, tt, cc, aa, mm),
   5e5 + {_K0} * nn * (aa + (1 - tt + cc) * aa ** 3 / 6 + (5 - 18 * tt + tt ** 2 + 72 * cc - 58 * ep) * aa ** 5 / 120) AS {x},
   fn + {_K0} * (mm + nn * tan(ph) * (aa ** 2 / 2 + (5 - tt + 9 * cc + 4 * cc ** 2) * aa ** 4 / 24
     + (61 - 58 * tt + tt ** 2 + 600 * cc - 330 * ep) * aa ** 6 / 720)) AS {y} FROM {name}2)"""


_PLACED = f"""{_EDGES},
el AS (SELECT {_F} * (2 - {_F}) AS e2),
ell AS (SELECT e2, e2 / (1 - e2) AS ep, 1 - e2 / 4 - 3 * e2 ** 2 / 64 - 5 * e2 ** 3 / 256 AS m0 FROM el),
scn AS (SELECT zone, height, width, 6 * (18 + zone % 2) - 183 AS lon_c, CASE WHEN zone >= 3 THEN 1e7 ELSE 0e0 END AS fn,
               5e5 + zone * 2e4 AS e0, CASE WHEN zone >= 3 THEN 9.9e6 ELSE 6e5 END AS n0 FROM extent),
parcel AS (
  SELECT scn.*, s_suppkey, h.ring, o.seq,
         s_suppkey * 29 % width + 0.41e0 + (1.7e0 + s_nationkey % 6) * h.scale * o.dx AS px,
         s_suppkey * 13 % height + 0.37e0 + (1.7e0 + s_nationkey % 6) * h.scale * o.dy AS py
  FROM supplier JOIN scn ON scn.zone = s_suppkey % 5, (VALUES (0, 1e0), (1, 0.4e0)) h(ring, scale), (VALUES {_CORNERS}) o(seq, dx, dy)
  WHERE h.ring = 0 OR s_suppkey % 3 = 0),
degree AS (SELECT *, -75e0 + zone % 2 * 6 + zone * 0.18e0 + px * 0.00018e0 AS lon,
                  CASE WHEN zone >= 3 THEN -0.9045e0 ELSE 5.4284e0 END - py * 0.00018e0 AS lat FROM parcel),
side AS (
  SELECT *, coalesce(lead(lon) OVER w, first_value(lon) OVER w) AS lon2, coalesce(lead(lat) OVER w, first_value(lat) OVER w) AS lat2
  FROM degree WINDOW w AS (PARTITION BY s_suppkey, ring ORDER BY seq)),
sliced AS (SELECT *, greatest(1, ceil(greatest(abs(lon2 - lon), abs(lat2 - lat)) / (20e0 / 111320e0 * 4e0))) AS n FROM side),
slice AS (SELECT *, unnest(range(0, CAST(n AS BIGINT))) AS k FROM sliced),
bit AS (SELECT zone, s_suppkey, ring, seq, k, lon_c, fn, e0, n0,
   lon + (lon2 - lon) * k / n AS u1, lat + (lat2 - lat) * k / n AS v1,
   CASE WHEN k + 1 = n THEN lon2 ELSE lon + (lon2 - lon) * (k + 1) / n END AS u2,
   CASE WHEN k + 1 = n THEN lat2 ELSE lat + (lat2 - lat) * (k + 1) / n END AS v2 FROM slice),
{_utm_of("bit", "head", "u1", "v1", "ea", "na")},
{_utm_of("head", "tail", "u2", "v2", "eb", "nb")},
placed AS (
  SELECT zone, 'forest' AS layer, CAST(s_suppkey AS INT) AS poly_id, ring,
         (ea - e0) / 20 AS x1, (na - n0) / -20 AS y1, (eb - e0) / 20 AS x2, (nb - n0) / -20 AS y2 FROM tail
  UNION ALL SELECT zone, layer, poly_id, 0, x1, y1, x2, y2 FROM edge WHERE layer = 'perimeter')"""

_PLACED_CELLS = f"""{_PLACED},
grid AS (SELECT e.zone, CAST(rr.r AS INT) AS r, CAST(cc.c AS INT) AS c
         FROM extent e, LATERAL (SELECT unnest(range(0, e.height)) AS r) rr, LATERAL (SELECT unnest(range(0, e.width)) AS c) cc),
reach AS (SELECT *, CAST(unnest(range(CAST(floor(least(y1, y2)) AS BIGINT), CAST(ceil(greatest(y1, y2)) AS BIGINT) + 1)) AS INT) AS r FROM placed),
hit AS (
  SELECT g.zone, k.layer, k.poly_id, g.r, g.c FROM grid g JOIN reach k ON k.zone = g.zone AND k.r = g.r
  WHERE (k.y1 > g.r + 0.5e0) <> (k.y2 > g.r + 0.5e0) AND g.c + 0.5e0 < (k.x2 - k.x1) * (g.r + 0.5e0 - k.y1) / (k.y2 - k.y1) + k.x1
  GROUP BY ALL HAVING count(*) % 2 = 1),
cell AS (SELECT DISTINCT zone, layer, r, c FROM hit)"""


def _interpolated(digits: int) -> str:
    """Weighted mean of the up to four ``src`` cells around every ``pos`` row."""
    weight = "(1 - abs(fr - s.r)) * (1 - abs(fc - s.c))"
    means = ", ".join(f"round(sum({weight} * s.{b}) / sum({weight}), {digits}) AS {b}" for b in _ALL)
    return f"""SELECT p.zone, CAST(p.r AS INT) AS r, CAST(p.c AS INT) AS c, {means}
            FROM pos p JOIN src s ON s.zone = p.zone AND s.r BETWEEN floor(fr) AND floor(fr) + 1
             AND s.c BETWEEN floor(fc) AND floor(fc) + 1
            WHERE abs(fr - s.r) < 1 AND abs(fc - s.c) < 1 GROUP BY p.zone, p.r, p.c"""


_SRC = f"src AS (SELECT zone, r, c, {', '.join(f'max({b}) AS {b}' for b in _ALL)} FROM px GROUP BY ALL)"

_RANKED = """cls AS (SELECT doc_id, quality AS label FROM labels),
ranked AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42-' || doc_id), doc_id) AS rn FROM cls),
size AS (SELECT label, count(*) AS n, sum(count(*)) OVER () AS na, min(count(*)) OVER () AS smallest,
                max(count(*)) OVER () AS largest FROM cls GROUP BY label)"""


def _share(source: str, pool: str, fraction: str, name: str) -> str:
    """Largest-remainder shares of ceil(total * fraction)."""
    return f"""
  SELECT * EXCLUDE (goal, quota, base), base + CASE WHEN row_number() OVER (ORDER BY quota - base DESC, label)
         <= goal - sum(base) OVER () THEN 1 ELSE 0 END AS {name}
  FROM (SELECT *, floor(quota) AS base FROM (SELECT *, {pool} * goal / all_rows AS quota FROM (
    SELECT *, ceil(all_rows * {fraction}) AS goal FROM (SELECT *, sum({pool}) OVER () AS all_rows FROM {source}))))"""


def oracle_sql() -> dict[str, str]:
    found = _oracles()
    return found | {"json_read_back": found["quarantine"]}


def _oracles() -> dict[str, str]:
    highest = ", ".join(f"round(max({b}), 9) AS {b}" for b in _ALL)
    sums = ", ".join(f"round(sum({b}), 6) AS {b}_sum" for b in _BANDS)
    ends = ", ".join(f"round(min({b}), 6) AS {b}_min, round(max({b}), 6) AS {b}_max" for b in _BANDS)
    counts = "count(*) AS n_total, count(*) FILTER (label = 1) AS n_forest, count(*) FILTER (label = 0) AS n_nonforest"
    ratio = "round(n_nonforest / nullif(n_forest, 0), 9)"
    return {
        "product_catalog": f"WITH {_NAMED} SELECT DISTINCT zone, product FROM paths",
        "scene_catalog": f"""WITH {_NAMED}
            SELECT DISTINCT zone, product, date_trunc('second', l_shipdate) AS acquired,
                   'EPSG:32' || CASE WHEN substr(tile, 3, 1) < 'N' THEN '7' ELSE '6' END || substr(tile, 1, 2) AS epsg
            FROM product""",
        "band_file_lookup": f"""WITH {_NAMED} SELECT zone, product, band, min(path) AS path FROM paths
            WHERE res = 20 GROUP BY ALL""",
        "missing_bands": f"""WITH {_NAMED},
            have AS (SELECT zone, product, coalesce(list(DISTINCT band) FILTER (res = 20), []) AS bands FROM paths GROUP BY zone, product)
            SELECT zone, product, len(bands) = 0 AS unusable,
                   unnest([b FOR b IN ['B02','B03','B04','B05','B06','B07','B8A','B11','B12'] IF NOT list_contains(bands, b)]) AS band
            FROM have""",
        "eligible_zones": """SELECT 'zone' || n_nationkey AS zone,
              (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey AND c_acctbal > 0) AS n_rasters
            FROM nation
            WHERE EXISTS (SELECT 1 FROM customer WHERE c_nationkey = n_nationkey AND c_acctbal > 0)
              AND EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = n_nationkey AND s_suppkey % 3 = 0)
              AND EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = n_nationkey AND s_suppkey % 3 = 1)""",
        "tile_crs": f"""WITH {_NAMED}
            SELECT zone, 'EPSG:32' || CASE WHEN substr(tile, 3, 1) < 'N' THEN '7' ELSE '6' END || substr(tile, 1, 2) AS epsg,
                   count(DISTINCT product) AS n_products, date_trunc('second', min(l_shipdate)) AS first_acquired
            FROM product GROUP BY ALL""",
        "raster_to_pixels": """WITH flat AS (
              SELECT vec_id AS block, unnest(embedding) AS band_1, unnest(list_reverse(embedding)) AS band_2,
                     unnest(range(0, len(embedding))) AS k FROM embeddings)
            SELECT block, CAST(k // 8 AS INT) AS r, CAST(k % 8 AS INT) AS c,
                   CAST(band_1 AS DOUBLE) AS band_1, CAST(band_2 AS DOUBLE) AS band_2 FROM flat WHERE band_1 <> 0""",
        "read_union_by_name": """SELECT doc_id, quality, toxic, text, lang, source, n_chars FROM labels FULL JOIN documents USING (doc_id) WHERE false
            UNION ALL SELECT doc_id, quality, toxic, NULL, NULL, NULL, NULL FROM labels
            UNION ALL SELECT doc_id, NULL, NULL, text, lang, source, n_chars FROM documents""",
        "polygon_edges": f"""WITH {_EDGES} SELECT zone, layer, poly_id, seq, round(x1, 9) AS x1, round(y1, 9) AS y1,
            round(x2, 9) AS x2, round(y2, 9) AS y2 FROM edge""",
        "place_edges": f"""WITH {_PLACED} SELECT zone, layer, poly_id, ring, count(*) AS n_edges, round(min(x1), 5) AS x1_min,
            round(min(y1), 5) AS y1_min, round(max(x2), 5) AS x2_max, round(max(y2), 5) AS y2_max, round(sum(x1 * y2 - x2 * y1), 5) AS area2
            FROM placed GROUP BY ALL""",
        "place_layers": f"WITH {_PLACED_CELLS} SELECT zone, layer, r, c FROM cell",
        "dissolve_round_trip": f"WITH {_PLACED_CELLS} SELECT zone, layer, r, c FROM cell",
        "dissolved_rings": f"""WITH {_CELLS},
            quad AS (SELECT zone, layer, r + dr AS r, c + dc AS c, count(*) AS n,
                            count(*) = 2 AND max(dr) <> min(dr) AND max(dc) <> min(dc) AND
                            max(dr * 2 + dc) - min(dr * 2 + dc) IN (1, 3) AS diagonal
                     FROM cell, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) o(dr, dc) GROUP BY ALL),
            corner_count AS (SELECT zone, layer, count(*) FILTER (n = 1) AS q1, count(*) FILTER (n = 3) AS q3, count(*) FILTER (diagonal) AS qd
                             FROM quad GROUP BY ALL),
            side_count AS (SELECT zone, layer, count(*) AS area, sum(4 - (SELECT count(*) FROM cell b WHERE b.zone = a.zone AND b.layer = a.layer
                             AND abs(a.r - b.r) + abs(a.c - b.c) = 1)) AS perimeter FROM cell a GROUP BY ALL)
            SELECT zone, layer, CAST((q1 - q3 + 2 * qd) // 4 AS BIGINT) AS outer_less_holes, CAST(q1 + q3 + 2 * qd AS BIGINT) AS n_corners,
                   CAST(perimeter AS BIGINT) AS perimeter, area FROM corner_count JOIN side_count USING (zone, layer)""",
        "label_grid_placed": f"""WITH {_PLACED_CELLS},
            wood AS (SELECT zone, r, c FROM cell WHERE layer = 'forest'), farm AS (SELECT zone, r, c FROM cell WHERE layer = 'perimeter'),
            core AS {_eroded("wood", 1)}
            SELECT g.zone, g.r, g.c, CAST(CASE WHEN f.zone IS NULL THEN -1 WHEN k.zone IS NULL THEN 0 ELSE 1 END AS SMALLINT) AS label
            FROM grid g LEFT JOIN farm f USING (zone, r, c) LEFT JOIN core k USING (zone, r, c)""",
        "scale_reflectance": f"WITH {_PX} SELECT zone, scene, {ends}, {sums} FROM bands GROUP BY ALL",
        "spectral_indices": f"""WITH {_PX} SELECT zone, r, c, ts, round(b03, 9) AS b03, round(b04, 9) AS b04,
            round(b8a, 9) AS b8a, round(ndvi, 9) AS ndvi, round(ndwi, 9) AS ndwi FROM px""",
        "spectral_indices_ext": f"""WITH {_PX},
            med AS (SELECT zone, r, c, median(b02) AS b, median(b04) AS red, median(b8a) AS nir, median(b11) AS sw FROM obs GROUP BY ALL)
            SELECT zone, r, c, round(CASE WHEN sw + nir = 0 THEN 0 ELSE (sw - nir) / (sw + nir) END, 9) AS ndbi,
                   round(CASE WHEN sw + nir = 0 THEN 0 ELSE (nir - sw) / (nir + sw) END, 9) AS ndmi,
                   round(CASE WHEN nir + 6 * red - 7.5e0 * b + 1 = 0 THEN 0 ELSE 2.5e0 * (nir - red) / (nir + 6 * red - 7.5e0 * b + 1) END, 9) AS evi,
                   round(1.5e0 * (nir - red) / (nir + red + 0.5e0), 9) AS savi FROM med""",
        "pixel_centers": f"""WITH {_GEO} SELECT zone, r, c, ts, round(x0 + a * (c + 0.5e0), 9) AS x,
            round(y0 + e * (r + 0.5e0), 9) AS y FROM px JOIN geo USING (zone)""",
        "grid_address": f"""WITH {_GEO} SELECT zone, r, c, ts,
              CAST(least(greatest(r + (r + c) % 7 - 3, 0), height - 1) AS INT) AS row_idx,
              CAST(least(greatest(c + (r + c) % 7 - 3, 0), width - 1) AS INT) AS col_idx
            FROM px JOIN geo USING (zone)""",
        "bounds_check": f"""WITH {_GEO} SELECT zone, y0 + e * height >= -5 AND y0 <= 15 AS lat_valid,
              x0 >= -80 AND x0 + a * width <= -66 AS lon_valid,
              y0 + e * height >= -5 AND y0 <= 15 AND x0 >= -80 AND x0 + a * width <= -66 AS valid FROM geo""",
        "clean_features": f"""WITH {_PX} SELECT zone, count(*) AS n, round(sum(b03), 6) AS f1_sum,
              round(sum(CASE WHEN b04 = 1 THEN 0 ELSE b04 END), 6) AS f2_sum, round(sum(b8a), 6) AS f3_sum,
              count(*) FILTER (b03 <> 0 AND b8a <> 0) AS n_kept FROM px GROUP BY zone""",
        "stack_bands": f"WITH {_PX} SELECT zone, scene, r, c, {highest} FROM px GROUP BY ALL",
        "regrid_bilinear": f"""WITH {_EXTENT}, {_SRC},
            dim AS (SELECT *, greatest(1, height * 3 // 4) AS th, greatest(1, width * 3 // 4) AS tw FROM extent),
            tr AS (SELECT *, unnest(range(0, th)) AS r FROM dim), t AS (SELECT *, unnest(range(0, tw)) AS c FROM tr),
            pos AS (SELECT zone, r, c, (r + 0.5e0) * height / th - 0.5e0 AS fr, (c + 0.5e0) * width / tw - 0.5e0 AS fc FROM t)
            {_interpolated(12)}""",
        "regrid_nearest": f"""WITH {_EXTENT}, cls AS (SELECT zone, r, c, max(scl) AS scl FROM px GROUP BY ALL),
            dim AS (SELECT *, greatest(1, height * 3 // 4) AS th, greatest(1, width * 3 // 4) AS tw FROM extent),
            tr AS (SELECT *, unnest(range(0, th)) AS tr FROM dim), t AS (SELECT *, unnest(range(0, tw)) AS tc FROM tr)
            SELECT t.zone, CAST(tr AS INT) AS r, CAST(tc AS INT) AS c, scl FROM t JOIN cls ON cls.zone = t.zone
             AND cls.r = CAST(floor((tr + 0.5e0) * height / th) AS INT) AND cls.c = CAST(floor((tc + 0.5e0) * width / tw) AS INT)""",
        "reproject_bilinear": f"WITH {_UTM}, {_SRC} {_interpolated(4)}",
        "valid_observations": f"WITH {_PX} SELECT zone, r, c, ts, {', '.join(f'round({b}, 9) AS {b}' for b in _BANDS)} FROM obs",
        "clear_mask": f"WITH {_mask()} SELECT * FROM mask",
        "clear_mask_no_water": f"WITH {_mask(True)} SELECT * FROM mask",
        "clear_thresholds": f"""WITH {_flags(False)},
            n AS (SELECT zone, scene, CAST(sum(clear3) AS BIGINT) AS n_clear, count(*) AS n_total FROM m3 GROUP BY ALL)
            SELECT n.*, round(p80, 9) AS p80, round(p20, 9) AS p20 FROM n LEFT JOIN bright USING (zone, scene) LEFT JOIN dark USING (zone, scene)""",
        "clear_whitelist": f"WITH {_PX} SELECT zone, r, c, ts, scl FROM px WHERE scl IN (4, 5, 6)",
        "dilate_mask": f"""WITH {_PX}, o AS (SELECT dr, dc FROM range(-2, 3) a(dr), range(-2, 3) b(dc) WHERE abs(dr) + abs(dc) <= 2)
            SELECT DISTINCT zone, scene, CAST(r + dr AS INT) AS r, CAST(c + dc AS INT) AS c FROM px, o WHERE scl IN (8, 9)""",
        "dilate_far": f"""WITH {_PX},
            cloud AS (SELECT DISTINCT zone, scene, r, c FROM px WHERE scl IN (8, 9)),
            step AS (SELECT CAST(a AS INT) AS dr, CAST(b AS INT) AS dc FROM range(-12, 13) x(a), range(-12, 13) y(b) WHERE abs(a) + abs(b) <= 12)
            SELECT zone, scene, r + dr AS r, c + dc AS c, min(abs(dr) + abs(dc)) AS distance FROM cloud, step GROUP BY ALL""",
        "erode_far": f"""WITH {_CELLS}, wood AS (SELECT zone, r, c FROM cell WHERE layer = 'forest')
            SELECT * FROM {_eroded("wood", 7)}""",
        "forest_depth": f"""WITH {_CELLS}, wood AS (SELECT zone, r, c FROM cell WHERE layer = 'forest'),
            step AS (SELECT CAST(a AS INT) AS dr, CAST(b AS INT) AS dc FROM range(-15, 16) x(a), range(-15, 16) y(b) WHERE abs(a) + abs(b) <= 15),
            around AS (SELECT zone, r, c, r + dr AS rr, c + dc AS cc, abs(dr) + abs(dc) AS d FROM wood, step)
            SELECT a.zone, a.r, a.c, CAST(least(15, coalesce(min(d) FILTER (w.zone IS NULL), 15)) AS INT) AS depth
            FROM around a LEFT JOIN wood w ON w.zone = a.zone AND w.r = a.rr AND w.c = a.cc GROUP BY ALL""",
        "erode_mask": f"""WITH {_CELLS}, wood AS (SELECT zone, r, c FROM cell WHERE layer = 'forest')
            SELECT * FROM {_eroded("wood", 2)}""",
        "clear_stats": f"""WITH {_mask()} SELECT zone, scene, CAST(sum(clear) AS BIGINT) AS n_clear, count(*) AS n_total,
            round(sum(clear) / count(*) * 100, 9) AS pct_clear FROM mask GROUP BY ROLLUP (zone, scene)""",
        "masked_composite": f"""WITH {_mask()},
            kept AS (SELECT px.* FROM px JOIN mask USING (zone, scene, r, c) WHERE clear = 1 AND b02 <> 0)
            {_composite("kept", _ALL)}""",
        "min_support": f"""WITH {_PX},
            n AS (SELECT zone, r, c, count(*) AS n_obs FROM obs GROUP BY ALL HAVING count(*) >= 3)
            SELECT * FROM n WHERE zone IN (SELECT zone FROM n GROUP BY zone HAVING count(*) >= 100)""",
        "enough_per_class": """SELECT doc_id, quality AS label FROM labels
            WHERE quality IN (SELECT quality FROM labels GROUP BY quality HAVING count(*) >= 100)""",
        "zone_subset": f"WITH {_PX} SELECT zone, count(*) AS n FROM px WHERE zone IN (0, 1, 3) GROUP BY zone",
        "clip_pruned": f"""WITH {_PLACED_CELLS} SELECT zone, r, c, ts, {', '.join(f'round({b}, 9) AS {b}' for b in _ALL)}
            FROM px SEMI JOIN (SELECT * FROM hit WHERE layer = 'forest' AND poly_id % 10 IN (2, 7)) k USING (zone, r, c)""",
        "training_table_stored": f"""WITH {_PIXEL_LABELS}, comp AS ({_composite("obs", _ALL)})
            SELECT comp.*, label FROM comp JOIN pixel_label USING (zone, r, c) WHERE label <> -1""",
        "masked_composite_stored": f"""WITH {_mask()},
            kept AS (SELECT px.* FROM px JOIN mask USING (zone, scene, r, c) WHERE clear = 1 AND b02 <> 0)
            {_composite("kept", _ALL)}""",
        "scene_blocks": f"""WITH {_PX}, {_SRC},
            placed_cell AS (SELECT *, ((r % 256) * 256 + c % 256) % 97 + 1 AS w FROM src)
            SELECT zone, CAST(r // 256 AS INT) AS tile_r, CAST(c // 256 AS INT) AS tile_c, 65536 AS n_cells,
                   {', '.join(f'round(sum({b} * w), 4) AS {b}_sum' for b in _ALL)} FROM placed_cell GROUP BY ALL""",
        "scene_blocks_read": f"""WITH {_PX}, {_SRC} SELECT zone, r, c, {', '.join(f'round({b}, 9) AS {b}' for b in _ALL)}
            FROM src WHERE b02 <> 0""",
        "sketched_thresholds": f"""WITH {_PX} SELECT zone, scene, count(*) AS n_clear, true AS bright_within, true AS dark_within
            FROM px WHERE scl NOT IN (3, 8, 9, 10, 11) GROUP BY ALL""",
        "clip_perimeter": f"""WITH {_CELLS} SELECT zone, r, c, ts, {', '.join(f'round({b}, 9) AS {b}' for b in _ALL)}
            FROM px SEMI JOIN (SELECT * FROM cell WHERE layer = 'perimeter') k USING (zone, r, c)""",
        "clip_outcome": f"""WITH {_CELLS}, wood AS (SELECT zone, r, c FROM cell WHERE layer = 'forest'),
            m AS (SELECT px.zone, px.r, px.c, ts, CAST(ts AS DATE) AS day, ndvi, w.zone IS NOT NULL AS inside FROM px LEFT JOIN wood w USING (zone, r, c)),
            s AS (SELECT *, bool_or(inside) OVER (PARTITION BY zone, day) AS met FROM m)
            SELECT zone, r, c, ts, day, round(ndvi, 9) AS ndvi, NOT met AS no_overlap FROM s WHERE inside OR NOT met""",
        "clip_reduction": f"""WITH {_CELLS}, p AS (SELECT DISTINCT zone, r, c FROM px),
            n AS (SELECT p.zone, count(*) AS n_original, count(k.zone) AS n_clipped
                  FROM p LEFT JOIN (SELECT * FROM cell WHERE layer = 'perimeter') k USING (zone, r, c) GROUP BY p.zone)
            SELECT *, round((1 - n_clipped / n_original) * 100, 9) AS reduction_pct FROM n""",
        "temporal_composite": f"WITH {_PX} {_composite('obs', _ALL)}",
        "ndvi_quantiles": "WITH " + _PX + " SELECT zone, r, c, " + ", ".join(
            f"round({_nearest('ndvi', q)}, 9) AS ndvi_p{round(q * 100)}, "
            f"round(quantile_cont(ndvi, {q}), 9) AS ndvi_p{round(q * 100)}_linear"
            for q in (0.1, 0.25, 0.75, 0.9)
        ) + ", count(*) AS n_obs FROM obs GROUP BY ALL",
        "composite_stats": f"WITH {_PX} SELECT zone, r, c, " + ", ".join(
            f"round(avg({b}), 12) AS {b}_mean, round(stddev_samp({b}), 8) AS {b}_std, "
            f"round(min({b}), 12) AS {b}_min, round(max({b}), 12) AS {b}_max"
            for b in _ALL
        ) + ", count(*) AS n_obs FROM obs GROUP BY ALL",
        "composite_requested": "WITH " + _PX + " SELECT zone, r, c, " + ", ".join(
            [f"round({fn}({b}), 12) AS {b}_{name}" for b, names in (("b8a", ("mean", "min", "max", "median")), ("ndvi", ("mean", "min", "max", "median")), ("b04", ("median",)))
             for name in names for fn in [{"mean": "avg"}.get(name, name)]]
            + [f"round(stddev_samp({b}), 8) AS {b}_std" for b in ("b8a", "ndvi")]
            + [f"round({_nearest(b, q / 100)}, 12) AS {b}_p{q}" for b, q in (("b04", 25), ("b04", 75), ("ndvi", 25), ("ndvi", 75), ("ndwi", 10))]
        ) + ", count(*) AS n_obs FROM obs GROUP BY ALL",
        "composite_30d": f"""WITH {_PX},
            w AS (SELECT *, time_bucket(INTERVAL '30 days', ts, TIMESTAMP '1970-01-01') AS window_start FROM obs)
            {_composite("w", _ALL, "zone, window_start")}""",
        "composite_annual": f"""WITH {_PX}, w AS (SELECT *, CAST(year(ts) AS INT) AS year FROM obs)
            {_composite("w", _ALL, "zone, r, c, year")}""",
        "observation_profile": f"""WITH {_PX} SELECT count(*) AS n_rows, count(DISTINCT CAST(ts AS DATE)) AS n_dates,
            count(DISTINCT (zone, r, c)) AS n_pixels FROM obs""",
        "support_profile": f"""WITH {_PX}, n AS (SELECT zone, r, c, count(*) AS k FROM obs GROUP BY ALL)
            SELECT zone, min(k) AS min_obs, max(k) AS max_obs, round(avg(k), 6) AS mean_obs, count(*) AS n_pixels FROM n GROUP BY zone""",
        "rasterize_polygons": f"WITH {_CELLS} SELECT * FROM cell",
        "label_grid": f"WITH {_LABELS} SELECT * FROM labels_grid",
        "label_grid_open": f"""WITH {_LABELS} SELECT g.zone, g.r, g.c,
            CAST(CASE WHEN k.zone IS NULL THEN 0 ELSE 1 END AS SMALLINT) AS label FROM grid g LEFT JOIN core k USING (zone, r, c)""",
        "label_stats": f"""WITH {_LABELS},
            n AS (SELECT zone, {counts}, count(*) FILTER (label = -1) AS n_ignored FROM labels_grid GROUP BY zone)
            SELECT zone, n_forest, n_nonforest, n_ignored, n_total, round(n_forest / n_total * 100, 9) AS pct_forest,
                   round(n_nonforest / n_total * 100, 9) AS pct_nonforest, round(n_ignored / n_total * 100, 9) AS pct_ignored,
                   {ratio} AS ratio, CASE WHEN n_forest > 0 AND n_nonforest > 0 THEN
                     CASE WHEN n_nonforest / n_forest > 10 THEN 'significant' WHEN n_nonforest / n_forest > 3 THEN 'moderate'
                     ELSE 'reasonable' END END AS balance FROM n""",
        "erosion_stats": f"""WITH {_LABELS},
            n AS (SELECT w.zone, count(*) AS n_before, count(k.zone) AS n_after FROM wood w LEFT JOIN core k USING (zone, r, c) GROUP BY w.zone)
            SELECT *, n_before - n_after AS n_removed, round((n_before - n_after) / n_before * 100, 9) AS pct_removed FROM n""",
        "training_table": f"""WITH {_PIXEL_LABELS}, comp AS ({_composite("obs", _ALL)})
            SELECT comp.*, label FROM comp JOIN pixel_label USING (zone, r, c) WHERE label <> -1""",
        "training_clamped": f"""WITH {_PIXEL_LABELS},
            moved AS (SELECT zone, r + c % 3 - 1 AS r, c + 2 AS c FROM pixel)
            SELECT m.zone, CAST(m.r AS INT) AS r, CAST(m.c AS INT) AS c, l.label
            FROM moved m JOIN extent e USING (zone) JOIN labels_grid l ON l.zone = m.zone
             AND l.r = least(greatest(m.r, 0), height - 1) AND l.c = least(greatest(m.c, 0), width - 1)""",
        "label_distribution": f"""WITH {_PIXEL_LABELS} SELECT label, count(*) AS n,
            round(count(*) / sum(count(*)) OVER () * 100, 9) AS pct FROM pixel_label GROUP BY label""",
        "class_balance": f"""WITH {_PIXEL_LABELS}, n AS (SELECT zone, {counts} FROM pixel_label WHERE label <> -1 GROUP BY zone)
            SELECT *, CASE WHEN n_nonforest > 0 THEN {ratio} END AS ratio, CASE WHEN n_forest > 0 AND n_nonforest > 0 THEN
              CASE WHEN n_nonforest / n_forest > 10 OR n_nonforest / n_forest < 0.1e0 THEN 'significant' ELSE 'reasonable' END END AS balance FROM n""",
        "consolidate_zones": f"""WITH {_PIXEL_LABELS}, comp AS ({_composite("obs", _ALL)})
            SELECT comp.*, label FROM comp JOIN pixel_label USING (zone, r, c) WHERE label <> -1""",
        "zone_status": f"""WITH {_PIXEL_LABELS} SELECT CAST(zone AS VARCHAR) AS zone, CAST(0 AS BIGINT) AS n_unreadable,
            count(*) AS n_rows, 'ok' AS status FROM pixel_label GROUP BY zone""",
        "zone_stats": f"""WITH {_PIXEL_LABELS},
            n AS (SELECT zone, {counts}, CAST(grouping(zone) AS INT) AS is_total FROM pixel_label WHERE label <> -1 GROUP BY ROLLUP (zone))
            SELECT *, coalesce({ratio}, 0) AS ratio, round(n_forest / n_total * 100, 9) AS pct_forest FROM n""",
        "dataset_checks": f"""WITH {_PIXEL_LABELS},
            t AS (SELECT *, CAST('0x' || substr(md5('42-' || zone || '-' || r || '-' || c), 1, 6) AS BIGINT) / 16777216e0 AS u
                  FROM pixel_label WHERE label <> -1),
            n AS (SELECT {counts}, avg(label) FILTER (u < 0.7e0) AS st, avg(label) FILTER (u >= 0.85e0) AS sv FROM t)
            SELECT n_total, CAST(0 AS BIGINT) AS n_incomplete, CAST(0 AS BIGINT) AS n_not_binary, n_total > 5000 AS enough_rows,
                   coalesce(greatest(n_forest, n_nonforest) / nullif(least(n_forest, n_nonforest), 0) < 5, false) AS balanced, true AS complete,
                   true AS binary_labels, coalesce(abs(st - sv) < 0.05e0, false) AS similar_split FROM n""",
        "empty_zones": f"""WITH {_PIXEL_LABELS} SELECT DISTINCT CAST(user_id % 15 AS INT) AS zone FROM events
            WHERE CAST(user_id % 15 AS INT) NOT IN (SELECT zone FROM pixel_label WHERE label <> -1)""",
        "quarantine": f"""WITH {_META} SELECT zone, product, issue_type,
              concat_ws(',', CASE WHEN i1 THEN 'crs_mismatch' END, CASE WHEN i2 THEN 'bounds_invalid' END,
                        CASE WHEN i3 THEN 'no_overlap' END, CASE WHEN i4 THEN 'clip_error' END) AS issues,
              '{{' || concat_ws(',',
                CASE WHEN i1 THEN '"crs_mismatch":{{"file_crs":"' || file_crs || '","expected_crs":"' || expected_crs || '"}}' END,
                CASE WHEN i2 THEN '"bounds_invalid":{{"lat_valid":' || lat_valid || ',"lon_valid":' || lon_valid || '}}' END,
                CASE WHEN i3 THEN '"no_overlap":{{"n_overlap":0}}' END,
                CASE WHEN i4 THEN '"clip_error":{{"clip_failed":true}}' END) || '}}' AS details
            FROM issue""",
        "clean_products": f"WITH {_META} SELECT zone, product, file_crs FROM flagged WHERE NOT (i1 OR i2 OR i3 OR i4)",
        "clean_products_tolerant": f"WITH {_META} SELECT zone, product, file_crs FROM flagged WHERE NOT (i2 OR i3 OR i4)",
        "quarantine_summary": f"""WITH {_META} SELECT zone, count(*) AS n_quarantined, """ + ", ".join(
            f"count(*) FILTER (issue_type = '{n}') AS {n}" for n in ("crs_mismatch", "bounds_invalid", "no_overlap", "multiple_issues")
        ) + " FROM issue GROUP BY zone",
        "zone_run_committed": f"""WITH {_PIXEL_LABELS},
            z AS (SELECT DISTINCT CAST(user_id % 15 AS INT) AS zone FROM events),
            n AS (SELECT z.zone, (SELECT count(*) FROM pixel p WHERE p.zone = z.zone) AS a,
                         (SELECT count(*) FROM labels_grid g WHERE g.zone = z.zone AND label <> -1) AS b,
                         (SELECT count(*) FROM pixel_label p WHERE p.zone = z.zone AND label <> -1) AS c FROM z)
            SELECT zone, a AS n_features, CASE WHEN a > 0 THEN b ELSE 0 END AS n_labels, CASE WHEN a > 0 AND b > 0 THEN c ELSE 0 END AS n_union,
                   CASE WHEN a = 0 THEN '03_features' WHEN b = 0 THEN '04_labels' WHEN c = 0 THEN '05_union' END AS failed_step,
                   CASE WHEN a > 0 AND b > 0 AND c > 0 THEN 'success' ELSE 'error' END AS status FROM n""",
        "zone_run": f"""WITH {_PIXEL_LABELS},
            z AS (SELECT DISTINCT CAST(user_id % 15 AS INT) AS zone FROM events),
            n AS (SELECT z.zone, (SELECT count(*) FROM pixel p WHERE p.zone = z.zone) AS n_features,
                         (SELECT count(*) FROM labels_grid g WHERE g.zone = z.zone AND label <> -1) AS n_labels,
                         (SELECT count(*) FROM pixel_label p WHERE p.zone = z.zone AND label <> -1) AS n_union FROM z)
            SELECT *, CASE WHEN n_features = 0 THEN '03_features' WHEN n_labels = 0 THEN '04_labels' WHEN n_union = 0 THEN '05_union' END AS failed_step,
                   CASE WHEN n_features > 0 AND n_labels > 0 AND n_union > 0 THEN 'success' ELSE 'error' END AS status,
                   CAST(NULL AS DOUBLE) AS duration FROM n""",
        "run_report": """SELECT CAST(user_id % 15 AS INT) AS zone, count(*) AS n_runs,
              count(*) FILTER (event_type NOT IN ('error', 'signup', 'purchase')) AS n_success,
              count(*) FILTER (event_type = 'error') AS n_error, count(*) FILTER (event_type = 'signup') AS n_timeout,
              count(*) FILTER (event_type = 'purchase') AS n_exception, round(sum(value), 4) AS total_duration,
              min(CASE WHEN event_type = 'error' THEN ['03_features', '04_labels', '05_union'][event_id % 3 + 1] END) AS first_failed_step
            FROM events GROUP BY ROLLUP (CAST(user_id % 15 AS INT))""",
        "class_weights": f"WITH {_RANKED} SELECT label, n, round(na / ((SELECT count(*) FROM size) * n), 9) AS weight FROM size",
        "class_weighted": f"""WITH {_RANKED} SELECT doc_id, label, round(na / ((SELECT count(*) FROM size) * n), 9) AS class_weight
            FROM cls JOIN size USING (label)""",
        "hash_split": f"""WITH {_PX}, p AS (SELECT DISTINCT zone, r, c FROM obs),
            u AS (SELECT *, CAST('0x' || substr(md5('42-' || zone || '-' || r || '-' || c), 1, 6) AS BIGINT) / 16777216e0 AS u FROM p)
            SELECT zone, r, c, CASE WHEN u < 0.7e0 THEN 'train' WHEN u < 0.85e0 THEN 'val' ELSE 'test' END AS split FROM u""",
        "stratified_split": f"""WITH {_RANKED}, s1 AS ({_share("size", "n", "0.15e0", "n_test")}),
            s2 AS ({_share("(SELECT * EXCLUDE (all_rows), n - n_test AS n_rest FROM s1)", "n_rest", "0.176e0", "n_val")})
            SELECT doc_id, label, CASE WHEN rn <= n_test THEN 'test' WHEN rn <= n_test + n_val THEN 'val' ELSE 'train' END AS split
            FROM ranked JOIN s2 USING (label)""",
        "zone_split": f"""WITH {_PIXEL_LABELS} SELECT CASE WHEN zone = 3 THEN 'test' ELSE 'train' END AS split, label, count(*) AS n
            FROM pixel_label WHERE label <> -1 GROUP BY ALL""",
        "undersample": f"WITH {_RANKED} SELECT doc_id, label FROM ranked JOIN size USING (label) WHERE rn <= floor(smallest / 0.5e0)",
        "oversample": f"""WITH {_RANKED}, goal AS (SELECT *, CAST(greatest(n, ceil(largest * 0.5e0)) AS BIGINT) AS goal FROM size)
            SELECT doc_id, label, CAST(unnest(range(1, goal // n + CASE WHEN rn <= goal % n THEN 1 ELSE 0 END + 1)) AS INT) AS copy
            FROM ranked JOIN goal USING (label)""",
        "grouped_folds": f"""WITH {_PIXEL_LABELS}, p AS (SELECT *, r // 8 AS br, c // 8 AS bc FROM pixel_label WHERE label <> -1),
            b AS (SELECT zone, br, bc, count(*) AS n, CAST(floor(4 * count(*) FILTER (label = 1) / count(*)) AS INT) AS kind FROM p GROUP BY ALL),
            k AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY n DESC, md5('42-' || zone || '-' || br || '-' || bc)) - 1 AS k FROM b)
            SELECT p.zone, p.r, p.c, p.label, CAST(CASE WHEN (k.k // 5 + kind) % 2 = 1 THEN 4 - k.k % 5 ELSE k.k % 5 END AS INT) AS fold
            FROM p JOIN k USING (zone, br, bc)""",
        "oversample_interpolated": f"""WITH {_PX},
            comp AS (SELECT zone, r, c, round(median(b03), 9) AS b03, round(median(b04), 9) AS b04, round(median(ndvi), 9) AS ndvi FROM obs GROUP BY ALL),
            lab AS (SELECT *, CASE WHEN ndvi > 0.25e0 THEN 1 ELSE 0 END AS label, zone || '-' || r || '-' || c AS name FROM comp),
            ranked AS (SELECT *, md5('42-' || name) AS key, row_number() OVER (PARTITION BY label ORDER BY md5('42-' || name)) AS rn FROM lab),
            size AS (SELECT label, count(*) AS n, CAST(greatest(count(*), ceil(max(count(*)) OVER () * 0.8e0)) AS BIGINT) AS goal FROM lab GROUP BY label),
            copies AS (SELECT ranked.*, unnest(range(2, goal // n + CASE WHEN rn <= goal % n THEN 1 ELSE 0 END + 1)) AS copy
                       FROM ranked JOIN size USING (label)),
            wanted AS (SELECT DISTINCT label FROM copies),
            pair AS (SELECT a.key, b.b03, b.b04, b.ndvi, row_number() OVER (PARTITION BY a.key ORDER BY
                       (a.b03 - b.b03) * (a.b03 - b.b03) + (a.b04 - b.b04) * (a.b04 - b.b04) + (a.ndvi - b.ndvi) * (a.ndvi - b.ndvi), b.key) - 1 AS k
                     FROM ranked a JOIN ranked b ON a.label = b.label AND a.key <> b.key WHERE a.label IN (SELECT label FROM wanted)),
            drawn AS (SELECT c.*, CAST('0x' || substr(md5('45-' || name || '-' || copy), 1, 6) AS BIGINT) % (SELECT least(3, n - 1) FROM size s WHERE s.label = c.label) AS k,
                             CAST('0x' || substr(md5('46-' || name || '-' || copy), 1, 6) AS BIGINT) / 16777216e0 AS u FROM copies c)
            SELECT zone, r, c, label, round(b03, 10) AS b03, round(b04, 10) AS b04, round(ndvi, 10) AS ndvi, 1 AS copy FROM lab
            UNION ALL SELECT d.zone, d.r, d.c, d.label, round(d.b03 + u * (p.b03 - d.b03), 10), round(d.b04 + u * (p.b04 - d.b04), 10),
                             round(d.ndvi + u * (p.ndvi - d.ndvi), 10), CAST(copy AS INT) FROM drawn d JOIN pair p ON p.key = d.key AND p.k = d.k""",
        "vote_scores": f"""WITH {_PX},
            s AS (SELECT zone, CASE WHEN b04 > 0.5e0 THEN 1 ELSE 0 END AS label, CASE WHEN scl NOT IN (1, 3) THEN round(b03, 6) END AS a,
                         CASE WHEN scl > 1 THEN round(b8a, 6) END AS b FROM px),
            v AS (SELECT *, CASE WHEN a IS NULL THEN b WHEN b IS NULL THEN a ELSE (a + b) / 2 END AS score FROM s)
            SELECT zone, label, round(sum(score), 4) AS score, count(*) FILTER (score >= 0.4e0) AS n_positive,
                   count(*) FILTER (score IS NULL) AS n_without FROM v GROUP BY ALL""",
        "ranked_features": f"""WITH {_PX}, f AS ({' UNION ALL '.join(f"SELECT '{b}' AS feature, round(stddev_pop({b}), 6) AS importance FROM px" for b in _ALL)})
            SELECT * FROM f ORDER BY importance DESC, feature LIMIT 10""",
        "family_choices": f"""WITH {_PX},
            s AS (SELECT zone, b04 > 0.5e0 AS y, b03 AS a, b8a AS b FROM px WHERE scl NOT IN (0, 1, 3)),
            m AS (SELECT zone, round(avg(CASE WHEN (round(a, 6) >= 0.5e0) = y THEN 1e0 ELSE 0 END), 1) AS rf,
                         round(avg(CASE WHEN (round(b, 6) >= 0.5e0) = y THEN 1e0 ELSE 0 END), 1) AS gbt FROM s GROUP BY zone)
            SELECT zone, CASE WHEN gbt >= rf THEN 'GBT' ELSE 'RandomForest' END AS winner, greatest(rf, gbt) AS metric FROM m""",
        "leaderboard_saved": f"""WITH {_SCORED}
            SELECT 'RandomForest' AS winner, 15 AS n_features, round(avg(CASE WHEN label = prediction THEN 1e0 ELSE 0 END), 9) AS accuracy,
                   round(avg(label), 9) AS weighted_f1, round(avg(score), 9) AS roc_auc FROM pred GROUP BY CAST(floor(score * 10) AS BIGINT) % 3""",
        "csv_read_back": f"""WITH {_PIXEL_LABELS},
            n AS (SELECT zone, {counts}, CAST(grouping(zone) AS INT) AS is_total FROM pixel_label WHERE label <> -1 GROUP BY ROLLUP (zone))
            SELECT *, coalesce({ratio}, 0) AS ratio, round(n_forest / n_total * 100, 9) AS pct_forest FROM n""",
        "scene_read_back": f"""WITH {_PX} SELECT zone, r, c, scene, ts, {', '.join(f'round({b}, 9) AS {b}' for b in _ALL)} FROM px
            WHERE zone = 2 AND scene = (SELECT max(scene) FROM px WHERE zone = 2)""",
        "feature_names": f"""WITH {_PIXEL_LABELS}, f(place, feature) AS (VALUES
            {', '.join(f"({i}, '{n}')" for i, n in enumerate([*(f'{b}_med' for b in _ALL), 'ndvi_p10', 'ndvi_p90', 'n_obs', 'ndvi_range']))})
            SELECT place, feature, (SELECT count(*) FROM pixel_label WHERE label <> -1) AS n_rows FROM f""",
        "report_lines": f"""WITH {_SCORED},
            spread AS ({' UNION ALL '.join(f"SELECT '{b}' AS feature, stddev_pop({b}) AS x FROM px" for b in _ALL)})
            SELECT 'counts' AS part, 'tn' AS name, CAST(tn AS VARCHAR) AS value FROM conf UNION ALL SELECT 'counts', 'fp', CAST(fp AS VARCHAR) FROM conf
            UNION ALL SELECT 'counts', 'fn', CAST(fn AS VARCHAR) FROM conf UNION ALL SELECT 'counts', 'tp', CAST(tp AS VARCHAR) FROM conf
            {' '.join(f"UNION ALL SELECT 'class {k}', '{n}_{k}', format('{{:.4f}}', {c}{k}) FROM f" for k in (0, 1) for n, c in (('precision', 'p'), ('recall', 'r'), ('f1', 'f')))}
            UNION ALL SELECT CAST(row_number() OVER (ORDER BY x DESC, feature) AS VARCHAR), feature, format('{{:.4f}}', x) FROM spread""",
        "confusion_matrix": f"WITH {_SCORED} SELECT * FROM conf",
        "weighted_metrics": f"""WITH {_SCORED} SELECT round((tn + tp) / (n0 + n1), 9) AS accuracy,
            round((p0 * n0 + p1 * n1) / (n0 + n1), 9) AS weighted_precision, round((r0 * n0 + r1 * n1) / (n0 + n1), 9) AS weighted_recall,
            round((f0 * n0 + f1 * n1) / (n0 + n1), 9) AS weighted_f1 FROM f""",
        "class_metrics": f"""WITH {_SCORED} SELECT 0 AS class, round(p0, 9) AS precision, round(r0, 9) AS recall, round(f0, 9) AS f1, n0 AS support FROM f
            UNION ALL SELECT 1, round(p1, 9), round(r1, 9), round(f1, 9), n1 FROM f""",
        "roc_auc": f"WITH {_SCORED} SELECT round((rank_sum - pos * (pos + 1) / 2) / (pos * neg), 9) AS roc_auc FROM pairs",
        "average_precision": f"WITH {_SCORED} SELECT round(sum(tp / np * p) / max(pa), 9) AS average_precision FROM cum",
        "area_under_pr": f"WITH {_SCORED} SELECT round(sum((prec + prec_before) / 2 * p) / max(pa), 9) AS area_under_pr FROM step",
        "roc_curve": f"""WITH {_SCORED} SELECT round(score, 9) AS score, round((np - tp) / (na - pa), 9) AS fpr, round(tp / pa, 9) AS tpr FROM cum""",
        "pr_curve": f"""WITH {_SCORED} SELECT round(score, 9) AS score, round(tp / np, 9) AS precision, round(tp / pa, 9) AS recall FROM cum""",
        "threshold_sweep": f"""WITH {_SCORED}, t AS (SELECT unnest(range(0, 21)) / 20e0 AS threshold),
            k AS (SELECT threshold, count(*) FILTER (label = 0 AND score < threshold) AS tn, count(*) FILTER (label = 0 AND score >= threshold) AS fp,
                         count(*) FILTER (label = 1 AND score < threshold) AS fn, count(*) FILTER (label = 1 AND score >= threshold) AS tp
                  FROM scored CROSS JOIN t GROUP BY threshold)
            SELECT round(threshold, 9) AS threshold, tn, fp, fn, tp, round(coalesce(tp / nullif(tp + fp, 0), 0), 9) AS precision,
                   round(coalesce(tp / nullif(tp + fn, 0), 0), 9) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 9) AS f1 FROM k""",
        "metric_grades": f"""WITH {_SCORED}, v AS (SELECT (rank_sum - pos * (pos + 1) / 2) / (pos * neg) AS auc, r1, fp, tp FROM pairs, f)
            SELECT CASE WHEN auc > 0.9e0 THEN 'excellent' WHEN auc > 0.8e0 THEN 'good' ELSE 'moderate' END AS auc_grade,
                   CASE WHEN r1 > 0.8e0 THEN 'good' ELSE 'needs_improvement' END AS recall_grade,
                   concat_ws(',', CASE WHEN r1 < 0.7e0 THEN 'low_recall' END, CASE WHEN auc > 0.9e0 THEN 'ready_for_production' END,
                             CASE WHEN fp > 2 * tp THEN 'many_false_positives' END) AS recommendations FROM v""",
    }
