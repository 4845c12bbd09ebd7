"""Aggregate, share and window operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace.operators.tables import hot_keys, keyed_join
from millrace.scratch import materialise


def share_of_total(df: DataFrame, within: Sequence[str], value: str, name: str) -> DataFrame:
    """``value`` divided by its total within the group.

    The totals are aggregated first and joined back, so a hot group is one
    small row on the other side of the join rather than one window partition.
    """
    totals = df.groupBy(*within).agg(F.sum(value).cast("double").alias("_total"))
    return (
        keyed_join(df, totals, within)
        .withColumn(name, F.try_divide(F.col(value).cast("double"), F.col("_total")))
        .drop("_total")
    )


def exact_cuts(df: DataFrame, column: str, steps: int = 6) -> list[float]:
    """The exact order statistics at 1/steps .. (steps-1)/steps.

    The rank is ``ceil(p * n)``. Ranks come from a count per distinct value, so
    the cost follows the number of distinct values and not of rows: value counts are
    narrowed to the wanted ranks, and only a few hundred counters reach the driver.
    """
    counts = (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("double").alias("v")).agg(F.count("*").alias("n"))
    )
    counts = materialise(counts, "value-counts")  # read once per narrowing pass
    n = counts.agg(F.sum("n")).first()[0]
    if not n:
        return []
    ranks = [-(-n * i // steps) for i in range(1, steps)]
    return values_at_ranks(counts, ranks)


def values_at_ranks(counts: DataFrame, ranks: Sequence[int]) -> list[float]:
    """Values at 1-based ranks of a (v, n) table, by narrowing value ranges.

    Each pass counts rows per equal-width slice of the still open ranges, one
    aggregate job for all ranks; a range closes when it holds one value. Values
    are ordered as Spark orders them: -Infinity, numbers, Infinity, NaN.
    """
    inf = float("inf")
    number = ~F.isnan("v") & (F.col("v") > -inf) & (F.col("v") < inf)
    ends = counts.agg(F.min(F.when(number, F.col("v"))).alias("lo"), F.max(F.when(number, F.col("v"))).alias("hi"),
                      *[F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).alias(k) for k, c in (
                          ("low", F.col("v") == -inf), ("finite", number), ("high", F.col("v") == inf))]).first()
    found: dict[int, float] = {}
    todo = {}  # rank -> (low, high, rows below low)
    for r in ranks:
        if r <= ends.low:
            found[r] = -inf
        elif r <= ends.low + ends.finite:
            todo[r] = (ends.lo, ends.hi, ends.low)
        else:
            found[r] = inf if r <= ends.low + ends.finite + ends.high else float("nan")
    while todo:
        open_ranges = sorted({(lo, hi, below) for lo, hi, below in todo.values()})
        tagged = None
        for i, (lo, hi, _) in enumerate(open_ranges):
            inside = (F.col("v") >= F.lit(lo)) & (F.col("v") <= F.lit(hi))
            width = hi / 2 - lo / 2  # halves, as the whole may exceed the largest double
            slot = F.lit(0) if lo == hi else F.least(
                F.lit(255), F.floor((F.col("v") / 2 - F.lit(lo / 2)) / F.lit(max(width, 5e-324)) * 256).cast("int"))
            pair = F.struct(F.lit(i).alias("i"), slot.cast("int").alias("slot"))
            hit = F.when(inside, pair)
            tagged = [hit] if tagged is None else [*tagged, hit]
        rows = (
            counts.select("v", "n", F.explode(F.array_compact(F.array(*tagged))).alias("h"))
            .groupBy("h.i", "h.slot")
            .agg(F.sum("n").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
            .collect()  # at most 256 slots per open range
        )
        by_range: dict[int, list] = {}
        for r in sorted(rows, key=lambda r: (r["i"], r["slot"])):
            by_range.setdefault(r["i"], []).append(r)
        nxt = {}
        for rank, (lo, hi, below) in todo.items():
            at = below
            for r in by_range[open_ranges.index((lo, hi, below))]:
                if at + r["n"] >= rank:
                    if r["lo"] == r["hi"]:
                        found[rank] = r["lo"]
                    elif (r["lo"], r["hi"]) == (lo, hi):
                        raise RuntimeError(f"values from {lo} to {hi} cannot be told apart")
                    else:
                        nxt[rank] = (r["lo"], r["hi"], at)
                    break
                at += r["n"]
        todo = nxt
    return [found[r] for r in ranks]


def quantile_cuts(df: DataFrame, column: str, steps: int = 6, error: float = 0.0) -> list[float]:
    """Cut points at 1/steps .. (steps-1)/steps; ``error`` > 0 uses the mergeable sketch."""
    if error == 0.0:
        return exact_cuts(df, column, steps)
    probs = [i / steps for i in range(1, steps)]
    return df.approxQuantile(column, probs, error)


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    """Rows per equal-width bin and their percentage; bins 0 and bins+1 hold the outside."""
    slot = F.width_bucket(F.col(column).cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(bins))
    counted = df.filter(F.col(column).isNotNull()).groupBy(slot.alias("bin")).agg(F.count("*").alias("n"))
    total = counted.agg(F.sum("n")).scalar()
    return counted.withColumn("percent", F.round(F.col("n") * 100.0 / total, 6))


def neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    previous: dict[str, str] | None = None,
    following: dict[str, str] | None = None,
    max_rows: int = 5_000_000,
    hot: DataFrame | None | str = "look",
) -> DataFrame:
    """``lag``/``lead`` by one row over (keys, order) that holds up under a hot key.

    ``previous``/``following`` map a new column name to the column it reads;
    ``order`` must be unique within a key. A plain window puts all rows of a key
    in one task, which is right for keys up to ``max_rows``. Rows of keys beyond
    it are range-partitioned by key and order into slices of about ``max_rows``;
    neighbours are then taken inside a slice and the slice edges are stitched
    through a table that has one row per hot key and slice. ``order`` may have any
    type that can be sorted. A caller that knows the hot keys passes them in.
    """
    previous, following = previous or {}, following or {}
    held = F.struct(*[F.col(c) for c in sorted({*previous.values(), *following.values()})])

    def look(rows: DataFrame, by: Sequence[str]) -> DataFrame:
        span = W.partitionBy(*by).orderBy(order)
        return rows.select("*", F.lag(held).over(span).alias("_prev"), F.lead(held).over(span).alias("_next"))

    def finish(rows: DataFrame, prev: Column, nxt: Column) -> DataFrame:
        made = [prev.getField(src).alias(new) for new, src in previous.items()]
        made += [nxt.getField(src).alias(new) for new, src in following.items()]
        return rows.select(*df.columns, *made)

    hot = hot_keys(df, keys, max_rows) if isinstance(hot, str) else hot
    if hot is None:
        return finish(look(df, keys), F.col("_prev"), F.col("_next"))

    marked = keyed_join(df, hot, keys, "left")
    n_hot = hot.agg(F.sum("_n")).first()[0]
    slices = int(-(-n_hot // max_rows) + 1)
    dealt = (marked.filter("_n is not null").repartitionByRange(slices, *keys, order)
             .withColumn("_slice", F.spark_partition_id()))
    dealt = materialise(dealt, "slices")  # written, so that a row's slice never changes
    sliced = dealt.unionByName(marked.filter("_n is null").withColumn("_slice", F.lit(-1)))
    edges = sliced.filter("_n is not null").groupBy(*keys, "_slice").agg(
        F.min_by(held, F.col(order)).alias("_first"), F.max_by(held, F.col(order)).alias("_last"))
    across = W.partitionBy(*keys).orderBy("_slice")
    edges = edges.select(
        *keys, "_slice",
        F.lag("_last").over(across).alias("_before"), F.lead("_first").over(across).alias("_after"))
    joined = keyed_join(look(sliced, [*keys, "_slice"]), edges, [*keys, "_slice"], "left")
    return finish(joined, F.coalesce("_prev", "_before"), F.coalesce("_next", "_after"))


def days_ahead_sum(df: DataFrame, keys: Sequence[str], day: str, value: str, first: int, last: int,
                   name: str) -> DataFrame:
    """Sum of ``value`` over the days ``first`` .. ``last`` after each row's day (range frame).

    Days are pre-aggregated per key first, so a frame holds calendar days, not rows.
    """
    daily = df.groupBy(*keys, day).agg(F.sum(value).alias("_v"))
    # the row's own day number drives the frame
    frame = W.partitionBy(*keys).orderBy(F.unix_date(F.col(day))).rangeBetween(first, last)
    ahead = daily.select(*keys, day, F.sum("_v").over(frame).alias(name))
    return ahead


def conditional_count(condition: Column) -> Column:
    """Rows meeting a condition; NULL, not 0, when none does."""
    return F.sum(F.when(condition, F.lit(1)))
