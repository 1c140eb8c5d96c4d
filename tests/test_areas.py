"""Points in polygons against a plain ray cast, and the cells that cover an area."""

import math
import random

import pytest
from pyspark.sql import functions as F

from helpers import rows
from ripplekit.operators import areas as AR

RINGS = "area bigint, ring int, vertices array<struct<x: double, y: double>>"


def inside(x, y, rings):
    n = 0
    for ring in rings:
        for (xa, ya), (xb, yb) in zip(ring, ring[1:] + ring[:1]):
            (x1, y1), (x2, y2) = sorted(((xa, ya), (xb, yb)), key=lambda p: p[1])
            n += y1 <= y < y2 and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1
    return n % 2 == 1


def shapes(rng):
    found = {1: [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)], [(1.0, 1.0), (3.0, 1.0), (3.0, 3.0), (1.0, 3.0)]]}  # a hole
    found[2] = [[(4.0, 0.0), (8.0, 0.0), (8.0, 4.0), (4.0, 4.0)]]  # shares a border with the first
    found[3] = [[(-50.0, -20.0), (50.0, 19.9), (50.0, 20.0)]]  # long and thin
    found[4] = [[(2.0, 2.0), (2.0, 9.0), (2.0000001, 9.0)]]  # thinner than any cell
    found[5] = [[(0.0, 0.0), (2.0, 2.0), (0.0, 2.0), (2.0, 0.0)]]  # crosses itself
    for area in range(6, 12):
        middle, size = (rng.uniform(-9, 9), rng.uniform(-9, 9)), rng.choice([0.01, 1, 30])
        turns = sorted(rng.uniform(0, 2 * math.pi) for _ in range(rng.randint(3, 40)))
        found[area] = [[(middle[0] + size * rng.uniform(0.2, 1) * math.cos(a), middle[1] + size * rng.uniform(0.2, 1) * math.sin(a)) for a in turns]]
    return found


def test_points_equal_ray_casts(spark):
    rng = random.Random(8)
    areas = shapes(rng)
    corners = [p for rings in areas.values() for ring in rings for p in ring]
    points = corners + [((a[0] + b[0]) / 2, (a[1] + b[1]) / 2) for a, b in zip(corners, corners[1:])]
    points += [(rng.uniform(-12, 12), rng.uniform(-12, 12)) for _ in range(1500)] + [(x / 2, y / 2) for x in range(-4, 20) for y in range(-4, 20)]
    points += [(x, 0.4 * x + rng.uniform(-0.1, 0.1)) for x in (rng.uniform(-50, 50) for _ in range(300))] + points[:20]
    frame = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "id bigint, lon double, lat double")
    rings = spark.createDataFrame([(a, i, ring) for a, rs in areas.items() for i, ring in enumerate(rs)], RINGS)
    want = sorted((i, a) for i, (x, y) in enumerate(points) for a, rs in areas.items() if inside(x, y, rs))
    assert len({a for _, a in want}) >= 9
    assert sorted(rows(AR.in_areas(frame, rings), "id", "area")) == want


def test_a_thin_area_has_few_cells(spark):
    ring = [(0.0, 0.0), (64.0, 63.9), (64.0, 64.0)]
    rings = spark.createDataFrame([(1, 0, ring)], RINGS)
    cover = AR.cell_cover(AR.row_edges(AR.edges_of(rings)))
    assert cover.count() < 600  # of 64 x 64 in its box
    square = spark.createDataFrame([(1, 0, [(0.0, 0.0), (64.0, 0.0), (64.0, 64.0), (0.0, 64.0)])], RINGS)
    kinds = {r[0]: r[1] for r in AR.cell_cover(AR.row_edges(AR.edges_of(square))).groupBy("whole").count().collect()}
    assert kinds[True] >= 60 * 60  # most of a square needs no ray


def test_rings_with_faults_bound_nothing(spark):
    data = [(1, 0, None), (2, 0, []), (3, 0, [(0.0, 0.0), (1.0, 1.0), (0.0, 0.0)]), (4, 0, [(0.0, None), (1.0, 1.0), (2.0, 0.0)]),
            (5, 0, [(0.0, 0.0), (float("nan"), 1.0), (2.0, 0.0)]), (6, 0, [(0.0, 0.0), (4.0, 0.0), (0.0, 4.0)])]
    rings = spark.createDataFrame(data, RINGS)
    assert rows(AR.ring_faults(rings)) == [(1, 0, "empty"), (2, 0, "empty"), (3, 0, "corners"), (4, 0, "not finite"), (5, 0, "not finite")]
    points = spark.createDataFrame([(1.0, 1.0), (None, 1.0), (float("inf"), 0.5), (1.0, float("nan"))], "lon double, lat double")
    assert rows(AR.in_areas(points, rings), "area") == [(6,)]
    assert AR.in_areas(points, rings.limit(0)).count() == 0 and AR.in_areas(points.limit(0), rings).count() == 0


@pytest.mark.parametrize("name", ["area", "cx", "scale", "n"])
def test_columns_of_points_stay(spark, name):
    points = spark.createDataFrame([(1.0, 1.0, 7)], f"lon double, lat double, {'v' if name == 'area' else name} int")
    rings = spark.createDataFrame([(6, 0, [(0.0, 0.0), (4.0, 0.0), (0.0, 4.0)])], RINGS)
    got = AR.in_areas(points, rings)
    assert got.columns == [*points.columns, "area"] and got.select(F.col(points.columns[2])).first()[0] == 7
