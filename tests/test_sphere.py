"""Distance joins in metres against all pairs."""

import math
import random

import pytest
from groundsheet.operators import sphere


def metres(a, b):
    (x, y), (u, v) = ([math.radians(c) for c in p] for p in (a, b))
    h = math.sin((y - v) / 2) ** 2 + math.cos(y) * math.cos(v) * math.sin((x - u) / 2) ** 2
    return 2 * sphere.RADIUS * math.asin(min(1, math.sqrt(h)))


def pairs(spark, a, b, within, **kw):
    left = spark.createDataFrame([(k, *p) for k, p in enumerate(a)], "id int, lon double, lat double")
    right = spark.createDataFrame([(k, *p) for k, p in enumerate(b)], "id int, lon double, lat double")
    rows = sphere.distance_join_metres(left, right, within, **kw).collect()
    assert len({(r.id, r.b_id) for r in rows}) == len(rows)
    return {(r.id, r.b_id): r.metres for r in rows}


@pytest.mark.parametrize("within,cell_rows", [(50_000, 10**6), (2_000_000, 20), (25_000_000, 10**6)])
def test_all_pairs(spark, within, cell_rows):
    draw = random.Random(within)
    spot = lambda: (draw.choice([179.9, -179.9, 0.0, 359.95]) + draw.uniform(-1, 1), draw.choice([89.8, -89.5, 0.0, 60.0]) + draw.uniform(-0.2, 0.2))
    a, b = [spot() for _ in range(150)], [spot() for _ in range(150)]
    got = pairs(spark, a, b, within, cell_rows=cell_rows)
    want = {(i, j): d for i, p in enumerate(a) for j, q in enumerate(b) if (d := metres(p, q)) <= within}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1 for k in want)


def test_odd_coordinates_and_repeats(spark):
    odd = [(None, 1.0), (1.0, None), (float("nan"), 0.0), (float("inf"), 0.0), (0.0, 90.5), (5.0, 5.0), (5.0, 5.0)]
    assert pairs(spark, odd, [(5.0, 5.0), (None, None)], 0).keys() == {(5, 0), (6, 0)}
    assert pairs(spark, odd, [(5.0, 5.0)], -1) == {}
    assert pairs(spark, odd[:1], [], 10) == {}


def test_poles_are_one_place(spark):
    assert len(pairs(spark, [(0.0, 90.0), (120.0, 90.0)], [(-60.0, 90.0), (0.0, -90.0)], 1)) == 2
