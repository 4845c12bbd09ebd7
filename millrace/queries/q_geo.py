"""Zone and trip queries. A zone is a supplier drawn on a board 25 fields wide, a trip is an event."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import geo
from millrace.operators import cover, quality, spatial
from millrace.queries.registry import query
from millrace.queries.staging import finished
from millrace.scratch import materialise

SIZE = 2.0

# corner offsets inside a 10 x 10 field; a zone has one of four shapes: convex, notched, convex with a hole, and two polygons
CONVEX = [(1, 1), (9, 2), (8, 9), (2, 8), (1, 1)]
NOTCHED = [(1, 1), (9, 1), (9, 9), (5, 4), (1, 9), (1, 1)]
HOLE = [(3, 3), (3, 6), (6, 5), (3, 3)]
ISLAND = [(4, 7), (6, 7), (5, 9), (4, 7)]
SHAPES = [[CONVEX], [NOTCHED], [CONVEX, HOLE], [NOTCHED, ISLAND]]
VENDOR = "purchase"


WIDTH = 25


def zone_features(t):
    """GeoJSON-shaped features built from the suppliers, numbered in blocks of 1000 per region."""
    x0 = (F.col("s_suppkey") % WIDTH * 10).cast("double")
    y0 = (F.floor(F.col("s_suppkey") / WIDTH) * 10).cast("double")

    def ring(points):
        return F.array(*[F.array(x0 + float(x), y0 + float(y)) for x, y in points])

    kind = F.col("s_suppkey") % 4
    polygon = F.when(kind == 0, F.array(ring(CONVEX))).when(kind == 1, F.array(ring(NOTCHED))).when(kind == 2, F.array(ring(CONVEX), ring(HOLE)))
    # coordinates nest one deeper in a MultiPolygon, so a feature is put together as text
    coordinates = F.coalesce(F.to_json(polygon), F.to_json(F.array(F.array(ring(NOTCHED)), F.array(ring(ISLAND)))))
    feature = F.concat(
        F.lit('{"properties":'), F.to_json(F.struct(F.col("s_name").alias("zone"), F.col("s_suppkey").alias("zone_id"))),
        F.lit(',"geometry":{"type":"'), F.when(kind == 3, "MultiPolygon").otherwise("Polygon"), F.lit('","coordinates":'), coordinates, F.lit("}}"))
    return (
        t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("r_name").alias("region"), F.floor(F.col("s_suppkey") / 1000).alias("block"), feature.alias("feature"))
    )


def collections(t, **json_options):
    """One GeoJSON text per region and block, so a text holds at most 1000 features."""
    gap = F.lit("\n") if json_options.get("pretty") else F.lit("")
    return zone_features(t).groupBy("region", "block").agg(F.collect_list("feature").alias("features")).select(
        "region", "block", F.concat(F.lit('{"type":"'), "region", F.lit('",'), gap, F.lit('"features":['), gap,
                                    F.array_join("features", ",\n" if json_options.get("pretty") else ","), gap, F.lit("]}")).alias("value"))


def zones(t):
    """Parsed from GeoJSON text."""
    return geo.features(collections(t)).select("zone", "zone_id", geo.rings().alias("ring"))


def trips(t):
    e, u = F.col("event_id"), F.col("user_id")
    height = t.supplier.agg((F.ceil(F.count("*") / WIDTH) * 1000).cast("bigint")).scalar()  # of the board, in hundredths
    k = F.get_json_object("props", "$.k").cast("int")
    return t.events.select(
        "event_id", F.col("event_type").alias("vendor_id"), F.col("ts").alias("pickup_datetime"),
        F.timestamp_add("MINUTE", k - 5, F.col("ts")).alias("dropoff_datetime"),
        ((e * 37 + u) % (WIDTH * 1000) / 100.0).cast("double").alias("pickup_longitude"),
        ((e * 91 + u * 7) % height / 100.0).cast("double").alias("pickup_latitude"),
        ((e * 53 + u * 3) % (WIDTH * 1000) / 100.0).cast("double").alias("dropoff_longitude"),
        ((e * 71 + u * 11) % height / 100.0).cast("double").alias("dropoff_latitude"),
        (F.col("value") - 0.5).alias("trip_distance"), F.col("value").alias("fare_amount"),
        (F.col("value") + (k % 7) - 1).alias("total_amount"))


def _values(points):
    return ", ".join(f"({i}, {x}, {y})" for i, (x, y) in enumerate(points))


ZONES_SQL = f"""
corner AS ({' UNION ALL '.join(f"SELECT {k} AS kind, {p} AS part, * FROM (VALUES {_values(r)}) v(i, ox, oy)" for k, rs in enumerate(SHAPES) for p, r in enumerate(rs))}),
ring AS (SELECT s_name AS zone, s_suppkey AS zone_id, part, i, CAST(s_suppkey % {WIDTH} * 10 + ox AS DOUBLE) AS x,
                CAST(s_suppkey // {WIDTH} * 10 + oy AS DOUBLE) AS y FROM supplier JOIN corner ON s_suppkey % 4 = kind),
side AS (SELECT a.zone, a.zone_id, a.x AS a_x, a.y AS a_y, b.x AS b_x, b.y AS b_y FROM ring a JOIN ring b
         ON a.zone_id = b.zone_id AND a.part = b.part AND b.i = a.i + 1)"""

TRIPS_SQL = f"""
board AS (SELECT CAST(ceil(count(*) / {WIDTH}) * 1000 AS BIGINT) AS height FROM supplier),
trip AS (
  SELECT event_id, event_type AS vendor_id, ts AS pickup_datetime,
         ts + to_minutes(CAST(json_extract_string(props, '$.k') AS INTEGER) - 5) AS dropoff_datetime,
         (event_id * 37 + user_id) % {WIDTH * 1000} / 100.0 AS px, (event_id * 91 + user_id * 7) % height / 100.0 AS py,
         (event_id * 53 + user_id * 3) % {WIDTH * 1000} / 100.0 AS dx, (event_id * 71 + user_id * 11) % height / 100.0 AS dy,
         value - 0.5 AS trip_distance, value AS fare_amount,
         value + CAST(json_extract_string(props, '$.k') AS INTEGER) % 7 - 1 AS total_amount
  FROM events, board)"""


def in_zone_sql(name, x, y):
    """(event_id, zone) pairs b_y counting crossed sides."""
    return f"""{name} AS (
  SELECT event_id, zone FROM trip, side
  WHERE (a_y > {y}) <> (b_y > {y}) AND {x} < (b_x - a_x) * ({y} - a_y) / (b_y - a_y) + a_x
  GROUP BY event_id, zone HAVING count(*) % 2 = 1)"""


TURNS = [f"((b_x - a_x) * ({y} - a_y) - (b_y - a_y) * ({x} - a_x))" for x in ("x0", "x1") for y in ("y0", "y1")]
CELLS_SQL = f"""
box AS (
  SELECT zone, zone_id, ix, iy, ix * {SIZE} AS x0, iy * {SIZE} AS y0, (ix + 1) * {SIZE} AS x1, (iy + 1) * {SIZE} AS y1
  FROM (SELECT zone, zone_id, ix, unnest(generate_series(lo_y, hi_y)) AS iy FROM (
    SELECT zone, zone_id, lo_y, hi_y, unnest(generate_series(lo_x, hi_x)) AS ix FROM (
      SELECT zone, zone_id, CAST(floor(min(x) / {SIZE}) AS BIGINT) AS lo_x, CAST(floor(max(x) / {SIZE}) AS BIGINT) AS hi_x,
             CAST(floor(min(y) / {SIZE}) AS BIGINT) AS lo_y, CAST(floor(max(y) / {SIZE}) AS BIGINT) AS hi_y
      FROM ring GROUP BY ALL)))),
tested AS (
  SELECT b.zone, b.zone_id, ix, iy,
         bool_or(greatest(a_x, b_x) >= x0 AND least(a_x, b_x) <= x1 AND greatest(a_y, b_y) >= y0 AND least(a_y, b_y) <= y1
                 AND NOT (least({', '.join(TURNS)}) > 0 OR greatest({', '.join(TURNS)}) < 0)) AS edge,
         count(*) FILTER ((a_y > (y0 + y1) / 2) <> (b_y > (y0 + y1) / 2)
                          AND (x0 + x1) / 2 < (b_x - a_x) * ((y0 + y1) / 2 - a_y) / (b_y - a_y) + a_x) % 2 = 1 AS mid
  FROM box b JOIN side s ON b.zone_id = s.zone_id GROUP BY ALL),
cells AS (SELECT zone, zone_id, (ix + 1073741824) * 2147483648 + (iy + 1073741824) AS cell, NOT edge AS is_core FROM tested WHERE edge OR mid)"""

CELL_OF = lambda x, y: (f"(CAST(floor({x} / {SIZE}) AS BIGINT) + 1073741824) * 2147483648 + CAST(floor({y} / {SIZE}) AS BIGINT) + 1073741824")


@query("g1_geojson_features", f"""
WITH {ZONES_SQL} SELECT zone, zone_id, count(*) AS points, min(x) AS min_x, max(y) AS max_y FROM ring GROUP BY ALL""")
def g1(t):
    return zones(t).select(
        "zone", "zone_id", F.size(F.flatten("ring")).cast("bigint").alias("points"),
        F.array_min(F.transform(F.flatten("ring"), lambda p: p["x"])).alias("min_x"),
        F.array_max(F.transform(F.flatten("ring"), lambda p: p["y"])).alias("max_y"))


@query("g2_points_and_lines", f"""
WITH {TRIPS_SQL} SELECT event_id, px AS from_x, py AS from_y, dx AS to_x, dy AS to_y,
       sqrt((dx - px) * (dx - px) + (dy - py) * (dy - py)) AS line_length FROM trip""")
def g2(t):
    a = geo.point("pickup_longitude", "pickup_latitude")
    b = geo.point("dropoff_longitude", "dropoff_latitude")
    rows = trips(t).select("event_id", geo.line(a, b).alias("trip_line"))
    p, q = F.col("trip_line")[0], F.col("trip_line")[1]
    dx, dy = q["x"] - p["x"], q["y"] - p["y"]
    return rows.select("event_id", p["x"].alias("from_x"), p["y"].alias("from_y"), q["x"].alias("to_x"),
                       q["y"].alias("to_y"), F.sqrt(dx * dx + dy * dy).alias("line_length"))


@query("g3_tessellate", f"""
WITH {ZONES_SQL}, {CELLS_SQL} SELECT zone, cell, is_core FROM cells""")
def g3(t):
    return spatial.tessellate(zones(t), "ring", SIZE).select("zone", "cell", "is_core")


def zone_cover(t):
    """The zones' cells of several sizes, written once for all joins."""
    return finished(t, "zone-cover", lambda: materialise(cover.cover(zones(t), "ring", SIZE), "cover"))


@query("g3_cover_of_several_sizes", f"""
WITH {ZONES_SQL}, {CELLS_SQL} SELECT zone, cell, is_core FROM cells""")
def g3_cover(t):
    """Large cells cut down to the finest size are the cells of the even grid."""
    ix, iy = cover.steps_of(F.col("cell"))
    return cover.flat(zone_cover(t)).select("zone", geo.cell_at(ix, iy).alias("cell"), "is_core")


@query("g4_cells_of_several_sizes", f"""
WITH {TRIPS_SQL} SELECT event_id, CAST(floor(px / {SIZE}) AS BIGINT) AS ix, CAST(floor(py / {SIZE}) AS BIGINT) AS iy,
       CAST(floor(px / {8 * SIZE}) AS BIGINT) AS wide_ix, CAST(floor(py / {8 * SIZE}) AS BIGINT) AS wide_iy FROM trip""")
def g4_sizes(t):
    """A point's finest cell and the one three levels above it, back as steps."""
    at = cover.cell(geo.point("pickup_longitude", "pickup_latitude"), SIZE)
    rows = trips(t).select("event_id", at.alias("cell")).withColumn("first", cover.parent(F.col("cell"), 3) * 64)
    (ix, iy), (wx, wy) = cover.steps_of(F.col("cell")), cover.steps_of(F.col("first"))
    return rows.select("event_id", ix.alias("ix"), iy.alias("iy"), F.floor(wx / 8).alias("wide_ix"), F.floor(wy / 8).alias("wide_iy"))


@query("g4_point_to_cell", f"""
WITH {TRIPS_SQL} SELECT event_id, {CELL_OF('px', 'py')} AS cell FROM trip""")
def g4(t):
    return trips(t).select("event_id", geo.cell(geo.point("pickup_longitude", "pickup_latitude"), SIZE).alias("cell"))


@query("g5_point_in_polygon", f"""
WITH {ZONES_SQL}, {TRIPS_SQL}, {in_zone_sql('found', 'px', 'py')} SELECT event_id, zone FROM found""")
def g5(t):
    points = trips(t).select("event_id", geo.point("pickup_longitude", "pickup_latitude").alias("at"))
    return cover.located(points, "at", zone_cover(t), SIZE).select("event_id", "zone")


@query("j11_spatial_join_counts", f"""
WITH {ZONES_SQL}, {TRIPS_SQL}, {in_zone_sql('found', 'dx', 'dy')} SELECT zone, count(*) AS dropoffs FROM found GROUP BY 1""")
def j11(t):
    points = trips(t).select("event_id", geo.point("dropoff_longitude", "dropoff_latitude").alias("at"))
    return cover.located(points, "at", zone_cover(t), SIZE).groupBy("zone").agg(F.count("*").alias("dropoffs"))


RULES_SQL = f"""
good AS (SELECT * FROM trip WHERE dropoff_datetime >= pickup_datetime AND trip_distance >= 0
         AND total_amount >= fare_amount AND total_amount >= 0 AND vendor_id = '{VENDOR}')"""

BETWEEN_SQL = f"""
{ZONES_SQL}, {TRIPS_SQL}, {RULES_SQL}, {in_zone_sql('p', 'px', 'py')}, {in_zone_sql('d', 'dx', 'dy')},
joined AS (SELECT g.*, p.zone AS pickup_zone, d.zone AS dropoff_zone,
                  date_sub('minute', pickup_datetime, dropoff_datetime) AS time_elapsed, strftime(pickup_datetime, '%Y%m') AS month_id
           FROM good g JOIN p USING (event_id) JOIN d USING (event_id))"""


def good_trips(t):
    return quality.drop_failing(trips(t), spatial.trip_rules(VENDOR))


def between(t, mode="exact"):
    if mode == "exact":
        return cover.trips_between(good_trips(t), zone_cover(t), SIZE)
    return spatial.trips_between_zones(good_trips(t), spatial.tessellate(zones(t), "ring", SIZE), SIZE, mode)


@query("g6_trips_between_zones", f"""
WITH {BETWEEN_SQL} SELECT event_id, pickup_zone, dropoff_zone, time_elapsed, month_id FROM joined""")
def g6(t):
    return between(t).select("event_id", "pickup_zone", "dropoff_zone", "time_elapsed", "month_id")


@query("g6_trips_between_zones_published", f"""
WITH {BETWEEN_SQL}, {CELLS_SQL}
SELECT g.event_id, cp.zone AS pickup_zone, cd.zone AS dropoff_zone
FROM good g JOIN cells cp ON cp.cell = {CELL_OF('px', 'py')} JOIN cells cd ON cd.cell = {CELL_OF('dx', 'dy')}
LEFT JOIN p ON p.event_id = g.event_id AND p.zone = cp.zone LEFT JOIN d ON d.event_id = g.event_id AND d.zone = cd.zone
WHERE cp.is_core OR p.zone IS NOT NULL OR cd.is_core OR d.zone IS NOT NULL""")
def g6_published(t):
    return between(t, "reference").select("event_id", "pickup_zone", "dropoff_zone")


TOTALS_SQL = """
  CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_taxi_revenue,
  CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_fare,
  CAST(sum(CAST(trip_distance AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_distance,
  avg(time_elapsed) AS avg_time_elapsed_mins, max(trip_distance) AS max_distance, max(time_elapsed) AS max_time_elapsed_mins"""


@query("g7_zone_month_summary", f"WITH {BETWEEN_SQL} SELECT pickup_zone, month_id, {TOTALS_SQL} FROM joined GROUP BY ALL")
def g7(t):
    return spatial.zone_month_summary(between(t))


@query("g7_daily_summary", f"""
WITH {BETWEEN_SQL} SELECT strftime(pickup_datetime, '%Y-%m-%d') AS pickup_date, {TOTALS_SQL} FROM joined GROUP BY 1""")
def g7_daily(t):
    return spatial.daily_summary(between(t))


@query("x6_cells_per_zone", f"""
WITH {ZONES_SQL}, {CELLS_SQL}, {TRIPS_SQL}
SELECT zone, count(DISTINCT cell) AS cells, count(DISTINCT cell) FILTER (is_core) AS core, count(*) FILTER (event_id IS NOT NULL) AS points
FROM cells LEFT JOIN trip ON cell = {CELL_OF('px', 'py')} GROUP BY 1""")
def x6(t):
    """The cells a polygon explodes into, with the points that fall into them."""
    cells = spatial.tessellate(zones(t), "ring", SIZE).select("zone", "cell", "is_core")
    hits = trips(t).groupBy(geo.cell(geo.point("pickup_longitude", "pickup_latitude"), SIZE).alias("cell")).agg(
        F.count("*").alias("n"))
    return cells.join(hits, "cell", "left").groupBy("zone").agg(
        F.count("*").alias("cells"), F.count(F.when(F.col("is_core"), 1)).alias("core"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("points"))
