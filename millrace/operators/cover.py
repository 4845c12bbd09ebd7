"""Zones covered by square cells of several sizes, and points joined to them.

A cell's number holds its place bit by bit: a leading 1, then two bits a level, so the parent of a cell is the number without its last two bits. A
zone is covered from large cells down: a cell wholly inside stays as it is, one outside goes, and one that a side runs through is cut into
smaller ones, down to the finest size. Each cell on the way carries only the sides that a ray to the right from inside it can meet,
so neither the test of a small cell nor the exact test of a point looks at the whole polygon.

All of it is one pass over the zones, without a shuffle but the one that spreads the large cells. A point is looked up by the cells of
all sizes around it; where one cell holds very many points, they are dealt over tasks and that cell's rows are repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import geo
from millrace.operators.tables import hot_keys, salted_join
from millrace.scratch import materialise
from millrace.session import task_count

BITS = 29  # of a step either way from the origin, at the finest size
UP, STEP = 6, 2  # the largest cells are 2**UP times as wide as the finest, and 2**STEP times as wide as the next


def _spread(v: Column) -> Column:
    """The lowest 32 bits of a number at every second place."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
    return v


def number(ix: Column, iy: Column, up: Column | int = 0) -> Column:
    """The cell at steps (ix, iy) of a grid 2**up times as wide as the finest."""
    up = F.lit(up) if isinstance(up, int) else up
    half = F.pow(F.lit(2.0), F.lit(BITS) - up).cast("bigint")
    whole = ix.between(-half, half - 1) & iy.between(-half, half - 1)
    lead = F.pow(F.lit(2.0), F.lit(2 * BITS + 2) - 2 * up).cast("bigint")
    code = lead.bitwiseOR(F.shiftleft(_spread(ix + half), 1)).bitwiseOR(_spread(iy + half))
    return F.when(ix.isNull() | iy.isNull(), F.lit(None).cast("bigint")).when(whole, code).otherwise(
        F.raise_error(F.lit("a coordinate lies outside the cells; use larger ones")).cast("bigint"))


def cell(p: Column, size: float) -> Column:
    """The finest cell of a point."""
    return number(geo.step(p["x"], size), geo.step(p["y"], size))


def parent(c: Column, up: int = 1) -> Column:
    return F.shiftrightunsigned(c, 2 * up)


def levels(up: int = UP, step: int = STEP) -> list[int]:
    """Sizes in use, as powers of two of the finest, largest first."""
    return [*range(up, 0, -step), 0]


def _box(size: float) -> tuple[Column, Column, Column, Column]:
    wide = F.lit(float(size)) * F.pow(F.lit(2.0), F.col("_up"))
    return F.col("_ix") * wide, F.col("_iy") * wide, (F.col("_ix") + 1) * wide, (F.col("_iy") + 1) * wide


def _tested(rows: DataFrame, size: float) -> DataFrame:
    """Cells that a zone touches, with their own sides; ``_core`` ones have none."""
    x0, y0, x1, y1 = _box(size)
    reach = F.filter("_sides", lambda e: (
        (F.greatest(e["a"]["y"], e["b"]["y"]) >= y0) & (F.least(e["a"]["y"], e["b"]["y"]) <= y1) & (F.greatest(e["a"]["x"], e["b"]["x"]) >= x0)))
    rows = rows.withColumn("_sides", F.when(~F.col("_core"), reach))
    edge = F.exists("_sides", lambda e: geo.meets_box(e, x0, y0, x1, y1))
    middle = geo.contains(F.col("_sides"), geo.point((x0 + x1) / 2, (y0 + y1) / 2))
    rows = rows.withColumn("_edge", F.when(F.col("_core"), False).otherwise(edge))
    rows = rows.filter(F.col("_core") | F.col("_edge") | middle).withColumn("_core", ~F.col("_edge"))
    return rows.withColumn("_sides", F.when(~F.col("_core"), F.col("_sides"))).drop("_edge")


def cover(zones: DataFrame, ring: str, size: float, up: int = UP, step: int = STEP) -> DataFrame:
    """(zone columns, cell, up, is_core, chip): cells covering each zone; ``ring`` holds one ring or an array of rings.

    ``is_core`` cells lie wholly inside, of whatever size; the others are of the finest size and carry the sides of the exact test.
    """
    others = [c for c in zones.columns if c != ring]
    several = dict(zones.dtypes)[ring].startswith("array<array")
    points = F.flatten(ring) if several else F.col(ring)
    sides = F.flatten(F.transform(ring, geo.edges)) if several else geo.edges(F.col(ring))
    wide = float(size) * 2**up
    shaped = zones.select(*others, sides.alias("_sides"), F.transform(points, lambda p: p["x"]).alias("_xs"), F.transform(points, lambda p: p["y"]).alias("_ys"))
    span = lambda c: F.sequence(geo.step(F.array_min(c), wide), geo.step(F.array_max(c), wide))
    rows = (shaped.withColumn("_ix", F.explode(span("_xs"))).withColumn("_iy", F.explode(span("_ys"))).drop("_xs", "_ys")
            .withColumn("_up", F.lit(up)).withColumn("_core", F.lit(False)))
    rows = _tested(rows, size).repartition(task_count(zones.sparkSession), "_ix", "_iy")
    for above, below in zip(levels(up, step), levels(up, step)[1:]):
        n = 2 ** (above - below)
        own = F.struct(F.col("_ix").alias("x"), F.col("_iy").alias("y"))
        within = F.array(*[F.struct((F.col("_ix") * n + i).alias("x"), (F.col("_iy") * n + j).alias("y")) for i in range(n) for j in range(n)])
        rows = rows.withColumn("_at", F.explode(F.when(F.col("_core"), F.array(own)).otherwise(within)))
        rows = rows.withColumns({"_ix": F.col("_at.x"), "_iy": F.col("_at.y"), "_up": F.when(F.col("_core"), F.col("_up")).otherwise(F.lit(below))}).drop("_at")
        rows = _tested(rows, size)
    return rows.select(*others, number(F.col("_ix"), F.col("_iy"), F.col("_up")).alias("cell"), F.col("_up").alias("up"),
                       F.col("_core").alias("is_core"), F.col("_sides").alias("chip"))


def flat(cells: DataFrame) -> DataFrame:
    """The same cover in cells of the finest size."""
    n = F.pow(F.lit(4.0), F.col("up")).cast("bigint")
    first = F.col("cell") * n
    return cells.withColumn("cell", F.explode(F.sequence(first, first + n - 1))).withColumn("up", F.lit(0))


def steps_of(c: Column) -> tuple[Column, Column]:
    """The steps (ix, iy) of a finest cell."""
    def gathered(v: Column) -> Column:
        v = v.bitwiseAND(F.lit(0x5555555555555555))
        for shift, mask in ((1, 0x3333333333333333), (2, 0x0F0F0F0F0F0F0F0F), (4, 0x00FF00FF00FF00FF), (8, 0x0000FFFF0000FFFF), (16, 0x00000000FFFFFFFF)):
            v = v.bitwiseOR(F.shiftrightunsigned(v, shift)).bitwiseAND(F.lit(mask))
        return v

    code = c.bitwiseAND(F.lit((1 << (2 * BITS + 2)) - 1))
    return gathered(F.shiftrightunsigned(code, 1)) - (1 << BITS), gathered(code) - (1 << BITS)


def located(rows: DataFrame, point: str, cells: DataFrame, size: float, prefix: str = "", up: int = UP, step: int = STEP,
            max_rows: int = 1_000_000) -> DataFrame:
    """Rows with the zone columns of each zone that holds their point; zone columns get the prefix.

    Cells with more than ``max_rows`` of the points are dealt over tasks.
    """
    zone = [c for c in cells.columns if c not in ("cell", "up", "is_core", "chip")]
    around = F.array(*[parent(F.col("_finest"), k) if k else F.col("_finest") for k in levels(up, step)])
    keyed = rows.withColumn("_finest", cell(F.col(point), size)).withColumn("_cell", F.explode(around)).drop("_finest")
    held = cells.select(F.col("cell").alias("_cell"), F.col("is_core").alias("_c_core"), F.col("chip").alias("_c_chip"),
                        *[F.col(c).alias(f"{prefix}{c}") for c in zone])
    some = held.select("_cell").distinct()
    kept = keyed.join(some, "_cell", "left_semi")  # most of the sizes around a point hold no cell
    full = hot_keys(keyed.select("_cell"), ["_cell"], max_rows)  # counted before the join, so that no point is shuffled for it
    hot = None if full is None else full.join(some, "_cell", "left_semi")
    hot = None if hot is None or hot.isEmpty() else materialise(hot, "hot-cells")
    plain = [c for c in rows.columns if c != point]
    found = salted_join(kept, held, ["_cell"], "inner", hot, plain or [point])
    return found.filter(F.col("_c_core") | geo.contains(F.col("_c_chip"), F.col(point))).drop("_cell", "_c_core", "_c_chip")


def trips_between(trips: DataFrame, cells: DataFrame, size: float, max_rows: int = 1_000_000, **sizes: int) -> DataFrame:
    """Trips with the zone of their pickup and of their dropoff; both ends are tested."""
    zone = cells.select("zone", "cell", "up", "is_core", "chip")
    rows = trips.withColumn("_start", geo.point("pickup_longitude", "pickup_latitude")).withColumn("_end", geo.point("dropoff_longitude", "dropoff_latitude"))
    started = materialise(located(rows, "_start", zone, size, "pickup_", max_rows=max_rows, **sizes), "started")  # read by a count and a join
    both = located(started, "_end", zone, size, "dropoff_", max_rows=max_rows, **sizes)
    return both.select(
        *trips.columns, "pickup_zone", "dropoff_zone",
        F.timestamp_diff("MINUTE", F.col("pickup_datetime"), F.col("dropoff_datetime")).alias("time_elapsed"),
        F.date_format(F.col("pickup_datetime"), "yyyyMM").alias("month_id"))
