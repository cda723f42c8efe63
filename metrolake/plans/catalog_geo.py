"""Registered points-to-zones query.

Zone outlines are derived from the suppliers (an L, or a diamond, some with a hole or
a second part) and coordinates of the older trips from the line items, on a grid so coarse
that many points fall on edges. The oracle tests every outline for every point.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from metrolake.operators import geo
from metrolake.plans import gold
from metrolake.plans.catalog import register
from metrolake.plans.catalog_files import run_dir
from metrolake.sources import surrogates as S

CELL = 0.75
ZONES_BEFORE = 1996           # trips before it have coordinates, later ones a zone id

# Corners of the two shapes, of a hole and of a second part, in units of the zone's size.
L_SHAPE = [(0, 0), (1, 0), (1, 0.5), (0.5, 0.5), (0.5, 1), (0, 1)]
DIAMOND = [(0.5, 0), (1, 0.5), (0.5, 1), (0, 0.5)]
HOLE = [(0.125, 0.125), (0.375, 0.125), (0.25, 0.375)]
PART = [(1.5, 0), (2, 0), (1.75, 0.5)]


def outlines(spark: SparkSession, d: str) -> DataFrame:
    """Rings per supplier: (zone_id, ring)."""
    k = F.col("s_suppkey")
    x0, y0, size = (k * 37 % 97) / F.lit(4.0), (k * 53 % 89) / F.lit(4.0), (1 + k % 5).cast("double")

    def ring(corners):
        return F.array(*[F.struct((x0 + size * F.lit(float(x))).alias("x"), (y0 + size * F.lit(float(y))).alias("y")) for x, y in corners])

    first = F.when(k % 3 == 0, ring(DIAMOND)).otherwise(ring(L_SHAPE))
    rings = F.array_compact(F.array(first, F.when((k % 4 == 0) & (k % 3 != 0), ring(HOLE)), F.when(k % 5 == 0, ring(PART))))
    return S.table(spark, d, "supplier").select(k.cast("int").alias("zone_id"), F.explode(rings).alias("ring"))


def positioned_trips(spark: SparkSession, d: str) -> DataFrame:
    """Line items with coordinates before 1996 and zone ids after."""
    li = S.table(spark, d, "lineitem")
    old = F.year("l_shipdate") < ZONES_BEFORE
    place = lambda c, n, step: F.when(old & (F.col("l_linenumber") != 6), (c % n) / F.lit(step))
    return li.select("l_orderkey", "l_linenumber", *[c for c in S.trips_l_columns(li)],
                     place(F.col("l_partkey") * 13 + F.col("l_linenumber"), 401, 16.0).alias("pickup_lon"),
                     place(F.col("l_orderkey") * 7 + F.col("l_suppkey"), 369, 16.0).alias("pickup_lat"),
                     place(F.col("l_orderkey") * 5, 409, 16.0).alias("dropoff_lon"),
                     place(F.col("l_partkey") * 3, 377, 16.0).alias("dropoff_lat"))


def _corners_sql(corners) -> str:
    return "[" + ", ".join(f"{{'x': {float(x)}, 'y': {float(y)}}}" for x, y in corners) + "]"


E4_SQL = f"""
WITH shape AS (
  SELECT s_suppkey AS k, (s_suppkey * 37 % 97) / 4.0::DOUBLE AS x0, (s_suppkey * 53 % 89) / 4.0::DOUBLE AS y0, CAST(1 + s_suppkey % 5 AS DOUBLE) AS size FROM supplier),
rings AS (
  SELECT *, CASE WHEN k % 3 = 0 THEN {_corners_sql(DIAMOND)} ELSE {_corners_sql(L_SHAPE)} END AS c FROM shape
  UNION ALL SELECT *, {_corners_sql(HOLE)} FROM shape WHERE k % 4 = 0 AND k % 3 <> 0
  UNION ALL SELECT *, {_corners_sql(PART)} FROM shape WHERE k % 5 = 0),
edge AS (
  SELECT k, x0 + size * c[i].x AS x1, y0 + size * c[i].y AS y1, x0 + size * c[i % len(c) + 1].x AS x2, y0 + size * c[i % len(c) + 1].y AS y2
  FROM rings, range(1, len(c) + 1) r(i)),
trips AS (
  SELECT l_orderkey, l_linenumber, year(l_shipdate) < {ZONES_BEFORE} AS old,
    CASE WHEN year(l_shipdate) < {ZONES_BEFORE} THEN NULL ELSE CAST(l_suppkey % 265 + 1 AS INT) END AS pu,
    CASE WHEN year(l_shipdate) < {ZONES_BEFORE} OR l_partkey % 29 = 0 THEN NULL ELSE CAST(l_partkey % 265 + 1 AS INT) END AS du,
    CASE WHEN year(l_shipdate) < {ZONES_BEFORE} AND l_linenumber <> 6 THEN ((l_partkey * 13 + l_linenumber) % 401) / 16.0::DOUBLE END AS px,
    CASE WHEN year(l_shipdate) < {ZONES_BEFORE} AND l_linenumber <> 6 THEN ((l_orderkey * 7 + l_suppkey) % 369) / 16.0::DOUBLE END AS py,
    CASE WHEN year(l_shipdate) < {ZONES_BEFORE} AND l_linenumber <> 6 THEN ((l_orderkey * 5) % 409) / 16.0::DOUBLE END AS dx,
    CASE WHEN year(l_shipdate) < {ZONES_BEFORE} AND l_linenumber <> 6 THEN ((l_partkey * 3) % 377) / 16.0::DOUBLE END AS dy
  FROM lineitem),
points AS (SELECT DISTINCT px AS x, py AS y FROM trips WHERE px IS NOT NULL UNION SELECT DISTINCT dx, dy FROM trips WHERE dx IS NOT NULL),
tested AS (
  SELECT x, y, k, count(*) FILTER (WHERE (y1 <= y AND y < y2 AND side > 0) OR (y2 <= y AND y < y1 AND side < 0)) % 2 = 1
    OR bool_or(side = 0 AND x BETWEEN least(x1, x2) AND greatest(x1, x2) AND y BETWEEN least(y1, y2) AND greatest(y1, y2)) AS hit
  FROM (SELECT x, y, edge.*, (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1) AS side FROM points, edge) GROUP BY x, y, k),
placed AS (SELECT x, y, min(k) FILTER (WHERE hit) AS zone FROM tested GROUP BY x, y)
SELECT l_orderkey, l_linenumber, CAST(coalesce(pu, a.zone) AS INT) AS pulocation_id, CAST(coalesce(du, b.zone) AS INT) AS dolocation_id
FROM trips LEFT JOIN placed a ON a.x = px AND a.y = py LEFT JOIN placed b ON b.x = dx AND b.y = dy
"""


@register("E4_points_to_zones", E4_SQL)
def q_e4(spark, d):
    index = gold.materialize(geo.grid_index(outlines(spark, d), CELL), f"{run_dir(spark)}/zone_grid")
    return geo.fill_zones(positioned_trips(spark, d), index, CELL).select("l_orderkey", "l_linenumber", "pulocation_id", "dolocation_id")
