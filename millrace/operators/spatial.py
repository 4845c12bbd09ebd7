"""Point-in-polygon joins: filter by grid cell, refine by the exact test."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import geo
from millrace.session import task_count


def _boxes(rows: DataFrame, lo_x: Column, hi_x: Column, lo_y: Column, hi_y: Column) -> DataFrame:
    return rows.withColumn("_ix", F.explode(F.sequence(lo_x, hi_x))).withColumn(
        "_iy", F.explode(F.sequence(lo_y, hi_y)))


def _classify(rows: DataFrame, size: float) -> DataFrame:
    """Keep the boxes a polygon touches; ``_edge`` tells whether a side runs through the box."""
    x0, y0 = F.col("_ix") * size, F.col("_iy") * size
    x1, y1 = (F.col("_ix") + 1) * size, (F.col("_iy") + 1) * size
    edge = F.exists("_sides", lambda e: geo.meets_box(e, x0, y0, x1, y1))
    middle = geo.point((x0 + x1) / 2, (y0 + y1) / 2)
    return rows.withColumn("_edge", edge).filter(F.col("_edge") | geo.contains(F.col("_sides"), middle))


def tessellate(zones: DataFrame, ring: str, size: float, coarse: int = 8) -> DataFrame:
    """Cells of a square grid covering each zone; ``ring`` holds one ring or an array of rings.

    ``is_core`` cells lie wholly inside. Other cells carry as ``chip`` the sides
    that a ray to the right from inside the cell can meet, which is all the
    exact test needs. Polygons are first cut into blocks of ``coarse`` x
    ``coarse`` cells that are spread over the cluster, so one large polygon is
    not expanded by a single task, and blocks wholly inside need no further test.
    """
    others = [c for c in zones.columns if c != ring]
    block = size * coarse
    several = dict(zones.dtypes)[ring].startswith("array<array")
    points = F.flatten(ring) if several else F.col(ring)
    sides = F.flatten(F.transform(ring, geo.edges)) if several else geo.edges(F.col(ring))
    shaped = zones.select(*others, sides.alias("_sides"), F.transform(points, lambda p: p["x"]).alias("_xs"),
                          F.transform(points, lambda p: p["y"]).alias("_ys"))
    blocks = _boxes(
        shaped, geo.step(F.array_min("_xs"), block), geo.step(F.array_max("_xs"), block),
        geo.step(F.array_min("_ys"), block), geo.step(F.array_max("_ys"), block)).drop("_xs", "_ys")
    blocks = _classify(blocks, block).select(
        *others, "_sides", F.col("_edge").alias("_block_edge"), F.col("_ix").alias("_bx"), F.col("_iy").alias("_by"))
    blocks = blocks.repartition(task_count(zones.sparkSession), "_bx", "_by")
    first_x, first_y = F.col("_bx") * coarse, F.col("_by") * coarse
    cells = _boxes(blocks, first_x, first_x + (coarse - 1), first_y, first_y + (coarse - 1))
    inside = cells.filter(~F.col("_block_edge")).withColumn("_edge", F.lit(False))
    tested = _classify(cells.filter("_block_edge"), size)
    both = inside.unionByName(tested)
    y0, y1, x0 = F.col("_iy") * size, (F.col("_iy") + 1) * size, F.col("_ix") * size
    reach = F.filter("_sides", lambda e: (
        (F.greatest(e["a"]["y"], e["b"]["y"]) >= y0) & (F.least(e["a"]["y"], e["b"]["y"]) <= y1)
        & (F.greatest(e["a"]["x"], e["b"]["x"]) >= x0)))
    return both.select(
        *others, geo.cell_at(F.col("_ix"), F.col("_iy")).alias("cell"), (~F.col("_edge")).alias("is_core"),
        F.when(F.col("_edge"), reach).alias("chip"))


def inside(cells: str, point: str | Column) -> Column:
    """Exact test of a point that shares a cell with a polygon."""
    p = F.col(point) if isinstance(point, str) else point
    return F.col(f"{cells}.is_core") | geo.contains(F.col(f"{cells}.chip"), p)


def points_in_zones(points: DataFrame, point: str, cells: DataFrame, size: float) -> DataFrame:
    """Points joined to the zones that contain them."""
    keyed = points.withColumn("_cell", geo.cell(F.col(point), size)).alias("p")
    found = keyed.join(cells.alias("c"), F.col("p._cell") == F.col("c.cell")).filter(inside("c", f"p.{point}"))
    zone_columns = [c for c in cells.columns if c not in ("cell", "is_core", "chip")]
    return found.select(*[F.col(f"p.{c}") for c in points.columns], *[F.col(f"c.{c}") for c in zone_columns])


def trips_between_zones(trips: DataFrame, cells: DataFrame, size: float, mode: str = "exact") -> DataFrame:
    """Trips with the zone of their pickup and of their dropoff.

    ``exact`` tests both ends. ``reference`` keeps the published condition, in
    which one passing end lets the other end through.
    """
    start = geo.point("pickup_longitude", "pickup_latitude")
    end = geo.point("dropoff_longitude", "dropoff_latitude")
    keyed = trips.withColumn("_from", geo.cell(start, size)).withColumn("_to", geo.cell(end, size)).withColumn(
        "_start", start).withColumn("_end", end).alias("t")
    both = keyed.join(cells.alias("p"), F.col("t._from") == F.col("p.cell")).join(
        cells.alias("d"), F.col("t._to") == F.col("d.cell"))
    if mode == "exact":
        keep = inside("p", "t._start") & inside("d", "t._end")
    elif mode == "reference":
        keep = inside("p", "t._start") | inside("d", "t._end")
    else:
        raise ValueError(f"unknown mode {mode}")
    return both.filter(keep).select(
        *[F.col(f"t.{c}") for c in trips.columns],
        F.col("p.zone").alias("pickup_zone"), F.col("d.zone").alias("dropoff_zone"),
        F.timestamp_diff("MINUTE", F.col("t.pickup_datetime"), F.col("t.dropoff_datetime")).alias("time_elapsed"),
        F.date_format(F.col("t.pickup_datetime"), "yyyyMM").alias("month_id"))


def trip_rules(vendor: str = "VTS") -> dict[str, str]:
    return {
        "valid_times": "dropoff_datetime >= pickup_datetime and trip_distance >= 0",
        "valid_amounts": "total_amount >= fare_amount and total_amount >= 0",
        "one_vendor": f"vendor_id = '{vendor}'",
    }


def _trip_totals() -> list[Column]:
    revenue = F.sum(F.col("total_amount").cast("decimal(18,2)"))
    distance = F.sum(F.col("trip_distance").cast("decimal(18,2)"))
    return [
        revenue.alias("total_taxi_revenue"),
        (revenue.cast("double") / F.count("total_amount")).alias("avg_fare"),
        (distance.cast("double") / F.count("trip_distance")).alias("avg_distance"),
        F.avg("time_elapsed").alias("avg_time_elapsed_mins"),
        F.max("trip_distance").alias("max_distance"),
        F.max("time_elapsed").alias("max_time_elapsed_mins"),
    ]


def zone_month_summary(trips: DataFrame) -> DataFrame:
    return trips.groupBy("pickup_zone", "month_id").agg(*_trip_totals())


def daily_summary(trips: DataFrame) -> DataFrame:
    return trips.groupBy(F.date_format("pickup_datetime", "yyyy-MM-dd").alias("pickup_date")).agg(*_trip_totals())
