"""Points to zones (E4): edges, holes, overlaps, points outside, and the plan."""
import random

import pytest
from pyspark.sql import functions as F

from metrolake.operators import geo
from metrolake.plans import catalog_geo as C

SF = "/root/testdata/sf0.001"
OUTLINES = [(7, [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]), (7, [(1.0, 1.0), (3.0, 1.0), (3.0, 3.0), (1.0, 3.0)]),     # a square with a hole
            (3, [(3.5, 0.0), (8.0, 2.0), (3.5, 4.0)]), (9, [(10.0, 10.0), (11.0, 10.0)]), (8, None), (None, [(0.0, 0.0), (1.0, 0.0), (0.0, 1.0)]),
            (2, [(-5.25, -5.0), (-1.0, -5.25), (-3.0, -0.5), (-3.5, -3.0)])]


def _outlines(spark):
    return spark.createDataFrame(OUTLINES, "zone_id int, ring array<struct<x:double,y:double>>")


def _inside(rings, x, y):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]]):
            side = (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1)
            if side == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return True
            if (y1 <= y < y2 and side > 0) or (y2 <= y < y1 and side < 0):
                odd = not odd
    return odd


def _zone(x, y):
    zones = {}
    for k, ring in OUTLINES:
        if k is not None and ring and len(ring) > 2:
            zones.setdefault(k, []).append(ring)
    return min((k for k, rings in zones.items() if _inside(rings, x, y)), default=None)


@pytest.mark.parametrize("cell", [0.3, 1.0, 50.0])
@pytest.mark.parametrize("most", [geo.MAX_EDGES, 0])
def test_every_point_equals_the_test_of_every_outline(spark, monkeypatch, cell, most):
    monkeypatch.setattr(geo, "MAX_EDGES", most)                  # 0: the shuffle join
    r = random.Random(4)
    points = [(r.randint(-24, 36) / 4, r.randint(-24, 20) / 4) for _ in range(800)] + [(r.uniform(-6, 9), r.uniform(-6, 5)) for _ in range(800)]
    df = spark.createDataFrame([(*p, 1, "x") for p in points], "x double, y double, zone_id int, cx string")
    index = geo.grid_index(_outlines(spark), cell)
    got = geo.zones_of_points(df, index, "x", "y", cell, "found")
    assert got.columns == ["x", "y", "zone_id", "cx", "found"] and got.count() == len(points)
    rows = [(r["x"], r["y"], r["found"]) for r in got.collect()]
    assert {r[:2] for r in rows} == set(points)
    assert [r for r in rows if r[2] != _zone(*r[:2])] == []
    assert {r[2] for r in rows} == {None, 2, 3, 7}


def test_named_points(spark):
    points = {"on an edge": (4.0, 0.1), "on an edge of two": (3.5, 0.0), "in the hole": (2.0, 2.0), "on the hole's edge": (1.0, 2.0),
              "nowhere": (20.0, 0.0), "null": (None, 1.0), "nan": (float("nan"), 1.0), "far": (1e300, float("inf"))}
    df = spark.createDataFrame([(n, *p) for n, p in points.items()], "name string, x double, y double")
    found = geo.zones_of_points(df, geo.grid_index(_outlines(spark), 1.0), "x", "y", 1.0).collect()
    assert {r["name"]: r["zone_id"] for r in found} == {"on an edge": 7, "on an edge of two": 3, "in the hole": None, "on the hole's edge": 7,
                                                       "nowhere": None, "null": None, "nan": None, "far": None}
    empty = geo.grid_index(_outlines(spark).limit(0), 1.0)
    assert {r["zone_id"] for r in geo.zones_of_points(df, empty, "x", "y", 1.0).collect()} == {None}


def test_lookup_has_no_cross_join_and_keeps_zone_ids(spark):
    index = geo.grid_index(C.outlines(spark, SF), C.CELL)
    trips = C.positioned_trips(spark, SF)
    out = geo.fill_zones(trips, index, C.CELL)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    assert out.columns == trips.columns
    kept = trips.where("pulocation_id is not null").count()
    filled = out.where("pulocation_id is not null").count()
    assert kept < filled < out.count()
    assert out.where((F.col("year") >= C.ZONES_BEFORE) & F.col("pulocation_id").isNull()).count() == 0


def test_lists_end_with_the_first_whole_zone(spark):
    square = [(0.25, 0.25), (5.75, 0.25), (5.75, 5.75), (0.25, 5.75)]              # 40 zones over the same ground
    index = geo.grid_index(spark.createDataFrame([(k, square) for k in range(40)], "zone_id int, ring array<struct<x:double,y:double>>"), 1.0)
    sizes = {(r["cx"], r["cy"]): len(r["zones"]) for r in index.collect()}
    assert {sizes[x, y] for x in range(1, 5) for y in range(1, 5)} == {1} and sizes[0, 0] == 40
    points = spark.createDataFrame([(2.5, 2.5), (0.5, 0.5), (0.1, 0.1)], "x double, y double")
    assert [r["zone_id"] for r in geo.zones_of_points(points, index, "x", "y", 1.0).collect()] == [0, 0, None]


def test_every_zone_of_a_long_list_is_tested(spark):
    corners = [(k, k * 0.01) for k in range(400)]                                   # 400 small zones in one cell, none fills it
    rings = spark.createDataFrame([(k, [(c, 0.0), (c + 0.008, 0.0), (c + 0.008, 1.0), (c, 1.0)]) for k, c in corners],
                                  "zone_id int, ring array<struct<x:double,y:double>>")
    points = spark.createDataFrame([(k, c + 0.004, 0.5) for k, c in corners] + [(None, c + 0.009, 0.5) for _, c in corners], "k int, x double, y double")
    got = geo.zones_of_points(points, geo.grid_index(rings, 10.0), "x", "y", 10.0).collect()
    assert len(got) == 800 and [r for r in got if r["k"] != r["zone_id"]] == []
