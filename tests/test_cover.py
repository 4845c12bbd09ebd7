"""Cells of several sizes: numbers, covers and joins against plain Python, and a cell with a third of all points."""

import math
import random

import pytest
from pyspark.sql import functions as F

from millrace.functions import geo
from millrace.operators import cover, spatial

SQUARE = [(-3.0, -3.0), (60.0, -3.0), (60.0, 61.0), (-3.0, 61.0)]
STAR = [(10 + (9 if k % 2 else 30) * math.cos(k * math.pi / 9), 10 + (9 if k % 2 else 30) * math.sin(k * math.pi / 9)) for k in range(18)]
HOLE = [(20.0, 20.0), (20.0, 40.0), (44.0, 30.0)]


def odd_crossings(rings, x, y):
    n = 0
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
            if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                n += 1
    return n % 2 == 1


@pytest.fixture(scope="module")
def zones(spark):
    rows = [("square with a hole", [SQUARE, HOLE]), ("star", [STAR]), ("speck", [[(0.1, 0.1), (0.3, 0.1), (0.2, 0.3)]])]
    return spark.createDataFrame([(z, [[{"x": x, "y": y} for x, y in r] for r in rings]) for z, rings in rows],
                                 "zone string, ring array<array<struct<x: double, y: double>>>"), dict(rows)


def test_numbers_hold_their_place(spark):
    rng = random.Random(1)
    points = [(rng.uniform(-900, 900), rng.uniform(-900, 900)) for _ in range(200)] + [(0.0, 0.0), (-0.0, -1e-9), (None, 1.0)]
    df = spark.createDataFrame(points, "x double, y double").withColumn("c", cover.cell(geo.point("x", "y"), 0.5))
    ix, iy = cover.steps_of(F.col("c"))
    for r in df.select("x", "y", "c", ix.alias("ix"), iy.alias("iy"), *[cover.parent(F.col("c"), k).alias(f"p{k}") for k in (1, 4)],
                       *[cover.number(F.floor(F.col("x") / 0.5 / 2**k).cast("bigint"), F.floor(F.col("y") / 0.5 / 2**k).cast("bigint"), k).alias(f"n{k}") for k in (1, 4)]).collect():
        if r.x is None:
            assert r.c is None
            continue
        assert (r.ix, r.iy) == (math.floor(r.x / 0.5), math.floor(r.y / 0.5))
        assert r.p1 == r.n1 == r.c >> 2 and r.p4 == r.n4 == r.c >> 8
    with pytest.raises(Exception, match="outside the cells"):
        spark.range(1).select(cover.cell(geo.point(F.lit(1e12), F.lit(0.0)), 0.5)).collect()


@pytest.mark.parametrize("up,step", [(6, 2), (4, 1), (5, 3), (0, 2)])
def test_cover_is_that_of_the_even_grid(spark, zones, up, step):
    made = cover.cover(zones[0], "ring", 2.0, up, step)
    ix, iy = cover.steps_of(F.col("cell"))
    got = sorted(map(tuple, cover.flat(made).select("zone", geo.cell_at(ix, iy).alias("cell"), "is_core").collect()))
    want = sorted(map(tuple, spatial.tessellate(zones[0], "ring", 2.0).select("zone", "cell", "is_core").collect()))
    assert got == want
    if up == 6:
        large = made.filter("is_core AND up > 0").count()
        assert large > 0 and made.count() < 0.6 * len(want)
        assert made.filter("NOT is_core AND up > 0").isEmpty()  # only the finest need the exact test
        assert made.filter("chip IS NOT NULL").agg(F.max(F.size("chip"))).first()[0] < 7 + 18


def test_points_are_found_in_all_their_zones(spark, zones):
    rng = random.Random(2)
    points = [(i, rng.uniform(-30, 70), rng.uniform(-30, 70)) for i in range(1500)] + [(2000, None, 3.0)]
    df = spark.createDataFrame(points, "id int, x double, y double").select("id", geo.point("x", "y").alias("at"))
    want = {(i, z) for i, x, y in points if x is not None for z, rings in zones[1].items() if odd_crossings(rings, x, y)}
    cells = cover.cover(zones[0], "ring", 1.5)
    for max_rows in (1_000_000, 5):
        rows = cover.located(df, "at", cells, 1.5, max_rows=max_rows).select("id", "zone").collect()
        assert {tuple(r) for r in rows} == want and len(rows) == len(want)
    assert {z for _, z in want} >= {"square with a hole", "star"}


def test_a_cell_with_a_third_of_all_points(spark, zones):
    """No task gets more than twice the mean, for all that a third of the points share one cell."""
    n = 24_000
    away = spark.range(n).select(F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(30.5)).otherwise(F.rand(3) * 57).alias("x"),
                                 F.when(F.col("id") % 3 == 0, F.lit(5.5) + F.rand(5) * 0.4).otherwise(F.rand(4) * 57).alias("y"))
    points = away.select("id", geo.point("x", "y").alias("at"))
    cells = cover.cover(zones[0].filter("zone LIKE 'square%'"), "ring", 1.0, 2, 2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        most = {}
        for max_rows in (1_000_000, 500):
            found = cover.located(points, "at", cells, 1.0, up=2, step=2, max_rows=max_rows)
            sizes = [r["count"] for r in found.groupBy(F.spark_partition_id().alias("p")).count().collect()]
            most[max_rows] = max(sizes) / (sum(sizes) / 8)
            assert sum(sizes) > 0.8 * n
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert most[500] <= 2 < most[1_000_000]


def test_the_first_end_of_trips_is_joined_once(spark, zones):
    """The zones of the pickups are written, so the count and the join of the dropoffs do not make them again."""
    rng = random.Random(9)
    ends = [(i, *(rng.uniform(-5, 65) for _ in range(4))) for i in range(300)]
    trips = spark.createDataFrame(ends, "id int, pickup_longitude double, pickup_latitude double, dropoff_longitude double, dropoff_latitude double")
    trips = trips.withColumns({c: F.lit("2024-01-02 03:04:05").cast("timestamp") for c in ("pickup_datetime", "dropoff_datetime")})
    cells = cover.cover(zones[0], "ring", 1.5)
    hold = lambda x, y: [z for z, rings in zones[1].items() if odd_crossings(rings, x, y)]
    want = sorted((i, a, b) for i, px, py, dx, dy in ends for a in hold(px, py) for b in hold(dx, dy))
    for max_rows in (1_000_000, 4):
        found = cover.trips_between(trips, cells, 1.5, max_rows=max_rows).select("id", "pickup_zone", "dropoff_zone")
        assert sorted(map(tuple, found.collect())) == want
    plain = cover.trips_between(trips, cells, 1.5)
    assert plain._jdf.queryExecution().optimizedPlan().toString().count("LeftSemi") == 1
