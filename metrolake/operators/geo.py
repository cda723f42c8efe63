"""Points to zones, so trips with coordinates and trips with zone ids share one notion of zone.

Zone outlines are a table of rings: (zone_id, ring), ring an array of vertices (x, y) in
order, closed implicitly. A zone may have several rings (parts and holes): a point
is inside where a ray from it crosses an odd number of the zone's edges. Points on
an edge belong to the zone, points in several zones to the smallest id.

A grid turns the range join into an equi-join: every cell lists the zones that reach into it,
marked as whole where no edge passes through. The smallest zone wins, so a list ends with
its first whole zone: where zones overlap, lists do not grow with their number, but in cells
that no zone fills. A point looks up its own cell and tests the listed zones in order, until one holds it, in column arithmetic on the
edges that can matter there; in whole cells nothing is left to test. The index has one row per
cell, so the lookup never multiplies points and a crowded zone needs no regrouping.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Edges that may be broadcast with the index (32 bytes each); beyond it the lookup is a shuffle join.
MAX_EDGES = 1_000_000
#: Cells of the grid's bounding box up to which the first whole zone of each cell is broadcast while the index is built.
MAX_CELLS = 1_000_000
#: Zone and cell pairs a task tests while the index is built.
PAIRS = 50_000
#: Lengths of the runs of a cell's list that are tested one after the other.
RUNS = (4, 12, 48, 192)
FAR = 1e12


def edges(ring: Column) -> Column:
    """The edges of a ring as an array of (x1, y1, x2, y2); rings of fewer than three vertices have none."""
    n = F.size(ring)
    near = F.transform(ring, lambda p, i: F.struct(
        p["x"].cast("double").alias("x1"), p["y"].cast("double").alias("y1"),
        F.get(ring, (i + 1) % n)["x"].cast("double").alias("x2"), F.get(ring, (i + 1) % n)["y"].cast("double").alias("y2")))
    return F.when(n >= 3, near).otherwise(F.array().cast("array<struct<x1:double,y1:double,x2:double,y2:double>>"))


def _side(e: Column, x: Column, y: Column) -> Column:
    return (e["x2"] - e["x1"]) * (y - e["y1"]) - (x - e["x1"]) * (e["y2"] - e["y1"])


def contains(lines: Column, x: Column, y: Column) -> Column:
    """Whether the point lies inside (an odd number of edges to its right) or on an edge."""
    def crossed(e: Column) -> Column:
        up, down = (e["y1"] <= y) & (y < e["y2"]), (e["y2"] <= y) & (y < e["y1"])
        return (up & (_side(e, x, y) > 0)) | (down & (_side(e, x, y) < 0))

    def on(e: Column) -> Column:
        return ((_side(e, x, y) == 0) & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
                & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])))

    return (F.size(F.filter(lines, crossed)) % 2 == 1) | F.exists(lines, on)


def grid_index(outlines: DataFrame, cell: float) -> DataFrame:
    """One row per cell (cx, cy) that a zone reaches: zones, an array of (zone_id, whole, edges) by zone id.
    ``cell`` is the side of a cell; a zone costs as many rows as its bounding box has cells."""
    vertices = F.filter("ring", lambda p: p["x"].isNotNull() & p["y"].isNotNull())
    shapes = (outlines.where("zone_id is not null and ring is not null").select("zone_id", edges(vertices).alias("e"))
              .groupBy("zone_id").agg(F.flatten(F.collect_list("e")).alias("e")).where(F.size("e") > 0))
    lo = lambda axis: F.floor(F.array_min(F.transform("e", lambda e: e[axis + "1"])) / cell)
    hi = lambda axis: F.floor(F.array_max(F.transform("e", lambda e: e[axis + "1"])) / cell)
    boxes = shapes.select("zone_id", "e", lo("x").alias("x0"), hi("x").alias("x1"), lo("y").alias("y0"), hi("y").alias("y1"))
    area = lambda a, b, c, d: (b - a + 1).cast("double") * (d - c + 1)
    extent = boxes.agg(F.sum(area(F.col("x0"), F.col("x1"), F.col("y0"), F.col("y1"))).alias("pairs"),
                       area(F.min("x0"), F.max("x1"), F.min("y0"), F.max("y1")).alias("cells")).first()
    boxes = boxes.repartition(int(1 + (extent["pairs"] or 0) // PAIRS), "zone_id")
    cells = boxes.select("zone_id", "e", "y0", "y1", F.explode(F.sequence("x0", "x1")).alias("cx")) \
        .select("zone_id", "e", "cx", F.explode(F.sequence("y0", "y1")).alias("cy"))
    left, low = F.col("cx") * F.lit(float(cell)), F.col("cy") * F.lit(float(cell))
    right, high = (F.col("cx") + 1) * F.lit(float(cell)), (F.col("cy") + 1) * F.lit(float(cell))
    beside = F.filter("e", lambda e: (F.least(e["y1"], e["y2"]) <= high) & (F.greatest(e["y1"], e["y2"]) >= low) & (F.greatest(e["x1"], e["x2"]) >= left))
    through = F.exists("beside", lambda e: F.least(e["x1"], e["x2"]) <= right)
    none = F.array().cast("array<struct<x1:double,y1:double,x2:double,y2:double>>")

    def tested(some: DataFrame) -> DataFrame:
        return (some.withColumn("beside", beside).withColumn("whole", ~through)
                .where(~F.col("whole") | contains(F.col("beside"), (left + right) / 2, (low + high) / 2)))

    first = tested(cells).where("whole").groupBy("cx", "cy").agg(F.min("zone_id").alias("first"))
    first = F.broadcast(first) if (extent["cells"] or 0) <= MAX_CELLS else first
    near = tested(cells.join(first, ["cx", "cy"], "left").where("first is null or zone_id <= first"))
    listed = F.struct("zone_id", "whole", F.when(F.col("whole"), none).otherwise(F.col("beside")).alias("edges"))
    return near.groupBy("cx", "cy").agg(F.sort_array(F.collect_list(listed)).alias("zones"))


def zones_of_points(points: DataFrame, index: DataFrame, x: str, y: str, cell: float, out: str = "zone_id") -> DataFrame:
    """``points`` with column ``out``: the smallest zone that holds (x, y); null outside all zones and for
    null or non-finite coordinates. ``index`` is a :func:`grid_index` of the same ``cell``, best a written
    table: it is read once for its size, and broadcast below ``MAX_EDGES`` edges."""
    size = index.agg(F.sum(F.aggregate("zones", F.lit(1), lambda n, z: n + F.size(z["edges"]) + 1)).cast("long")).first()[0] or 0
    side = index.select(F.col("cx").alias("_cx"), F.col("cy").alias("_cy"), F.col("zones").alias("_zones"))
    side = F.broadcast(side) if size <= MAX_EDGES else side
    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    there = (F.abs(px) < FAR) & (F.abs(py) < FAR)
    joined = points.join(side, (F.when(there, F.floor(px / cell)) == F.col("_cx")) & (F.when(there, F.floor(py / cell)) == F.col("_cy")), "left")
    found, start = [], 1
    for n in (*RUNS, 2 ** 30):  # a run is tested only where the ones before hold no zone of the point
        hits = F.filter(F.slice("_zones", start, n), lambda z: z["whole"] | contains(z["edges"], px, py))
        found.append(F.get(hits, F.lit(0))["zone_id"])
        start += n
    return joined.withColumn(out, F.coalesce(*found)).drop("_cx", "_cy", "_zones")


def fill_zones(trips: DataFrame, index: DataFrame, cell: float) -> DataFrame:
    """Trips whose pickup and dropoff zones are filled from their coordinates where the zone id is
    missing (older layouts); zone ids that are there stay."""
    for zone, lon, lat in (("pulocation_id", "pickup_lon", "pickup_lat"), ("dolocation_id", "dropoff_lon", "dropoff_lat")):
        found = zones_of_points(trips, index, lon, lat, cell, "_found")
        trips = found.withColumn(zone, F.coalesce(zone, F.col("_found").cast("int"))).drop("_found")
    return trips
