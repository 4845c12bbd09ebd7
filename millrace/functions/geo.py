"""Points, polygons and grid cells as plain columns.

A point is ``struct<x,y>``, a ring ``array<struct<x,y>>`` (closed or not), a zone one
ring or the array of all rings of its polygons, outer ones and holes alike: a point is
inside if it lies within an odd number of them. A cell is a bigint on a square grid
of a given size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

FEATURE_SCHEMA = """struct<properties: struct<zone: string, zone_id: bigint>,
    geometry: struct<type: string, coordinates: string>>"""
COLLECTION_SCHEMA = f"type string, features array<{FEATURE_SCHEMA}>"

CELL_SPAN = 1 << 31  # cells per row of the grid; a step beyond half of it either way is refused


def features(collections: DataFrame, column: str = "value") -> DataFrame:
    """GeoJSON feature collections (text) to one row per feature."""
    parsed = collections.select(F.from_json(column, COLLECTION_SCHEMA).alias("c"))
    return parsed.select(F.col("c.type").alias("collection"), F.explode("c.features").alias("f")).select(
        "collection", "f.properties.*", F.col("f.geometry").alias("geometry"))


def rings(geometry: str = "geometry") -> Column:
    """All rings of a GeoJSON Polygon or MultiPolygon; another type of geometry raises."""
    kind, text = F.col(f"{geometry}.type"), F.col(f"{geometry}.coordinates")
    lists = "array<array<array<double>>>"
    found = (F.when(kind == "Polygon", F.from_json(text, lists))
             .when(kind == "MultiPolygon", F.flatten(F.from_json(text, f"array<{lists}>")))
             .otherwise(F.raise_error(F.concat(F.lit("not a polygon: "), F.coalesce(kind, F.lit("no type")))).cast(lists)))
    return F.transform(found, lambda r: F.transform(r, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))


def point(x: str | Column, y: str | Column) -> Column:
    x = F.col(x) if isinstance(x, str) else x
    y = F.col(y) if isinstance(y, str) else y
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def line(a: Column, b: Column) -> Column:
    return F.array(a, b)


def step(v: Column, size: float) -> Column:
    """Grid step of a coordinate."""
    return F.floor(v / F.lit(float(size))).cast("bigint")


def cell_at(ix: Column, iy: Column) -> Column:
    """One number per cell; two cells never share it."""
    half = CELL_SPAN // 2
    inside = ix.between(-half, half - 1) & iy.between(-half, half - 1)
    number = (ix + half) * F.lit(CELL_SPAN).cast("bigint") + (iy + half)
    return F.when(ix.isNull() | iy.isNull(), F.lit(None).cast("bigint")).when(inside, number).otherwise(
        F.raise_error(F.lit("a coordinate lies outside the grid; use larger cells")).cast("bigint"))


def cell(p: Column, size: float) -> Column:
    """Cell of a point."""
    return cell_at(step(p["x"], size), step(p["y"], size))


def edges(r: Column) -> Column:
    """A ring as ``array<struct<a,b>>`` of its sides, closing it if needed."""
    following = F.concat(F.slice(r, F.lit(2), F.size(r)), F.slice(r, F.lit(1), F.lit(1)))
    return F.zip_with(r, following, lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def contains(sides: Column, p: Column) -> Column:
    """Ray casting: an odd number of sides crosses the ray to the right of the point."""
    def crosses(e: Column) -> Column:
        a, b = e["a"], e["b"]
        spans = (a["y"] > p["y"]) != (b["y"] > p["y"])
        at = F.try_divide((b["x"] - a["x"]) * (p["y"] - a["y"]), b["y"] - a["y"]) + a["x"]
        return spans & (p["x"] < at)

    return F.size(F.filter(sides, crosses)) % 2 == 1


def meets_box(e: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Does a side touch an axis-parallel box? Its bounds overlap the box and the
    corners of the box do not all lie strictly on one side of its line."""
    a, b = e["a"], e["b"]

    def turn(x: Column, y: Column) -> Column:
        return (b["x"] - a["x"]) * (y - a["y"]) - (b["y"] - a["y"]) * (x - a["x"])

    turns = [turn(x, y) for x in (x0, x1) for y in (y0, y1)]
    overlap = (
        (F.greatest(a["x"], b["x"]) >= x0) & (F.least(a["x"], b["x"]) <= x1)
        & (F.greatest(a["y"], b["y"]) >= y0) & (F.least(a["y"], b["y"]) <= y1)
    )
    return overlap & ~((F.least(*turns) > 0) | (F.greatest(*turns) < 0))
