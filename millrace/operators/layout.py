"""File layout that lets a scan skip on several columns at once."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def interleave(columns: Sequence[Column], bits: int = 8) -> Column:
    """Bits of several small integers woven into one bigint, highest bits first."""
    parts = []
    for b in range(bits):
        for i, c in enumerate(columns):
            bit = F.shiftright(c.cast("bigint"), b).bitwiseAND(F.lit(1))
            parts.append(F.shiftleft(bit, b * len(columns) + len(columns) - 1 - i))
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def with_zone(df: DataFrame, columns: Sequence[str], bits: int = 8, name: str = "zone") -> DataFrame:
    """Each numeric column scaled to ``bits`` bits between its minimum and maximum, then interleaved."""
    top = 2 ** bits - 1
    ends = df.agg(F.struct(*[x for c in columns for x in (
        F.min(F.col(c).cast("double")).alias(f"lo_{c}"), F.max(F.col(c).cast("double")).alias(f"hi_{c}"))]))
    scaled = df.withColumn("_ends", ends.scalar())
    for i, c in enumerate(columns):
        low, high = F.col(f"_ends.lo_{c}"), F.col(f"_ends.hi_{c}")
        step = F.floor(F.try_divide(F.col(c).cast("double") - low, high - low) * top)
        scaled = scaled.withColumn(f"_z{i}", F.coalesce(step, F.lit(0)))
    woven = interleave([F.col(f"_z{i}") for i in range(len(columns))], bits)
    return scaled.select(*df.columns, woven.alias(name))


def with_rank_zone(df: DataFrame, columns: Sequence[str], bits: int = 6, name: str = "zone") -> DataFrame:
    """As ``with_zone``, but the steps are quantiles: one outlier does not put all other rows into one step.

    The driver holds 2**bits - 1 cut points per column.
    """
    shares = [i / 2 ** bits for i in range(1, 2 ** bits)]
    cuts = df.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, 10_000).alias(c) for c in columns]).first()

    def step(c: str) -> Column:
        points = sorted(set(cuts[c] or []))
        if not points:
            return F.lit(0)
        return F.when(F.col(c).isNull(), 0).otherwise(F.size(F.filter(F.array(*map(F.lit, points)), lambda p: p < F.col(c).cast("double"))))

    return df.select(*df.columns, interleave([step(c) for c in columns], bits).alias(name))


def write_clustered(df: DataFrame, columns: Sequence[str], path: str, files: int, bits: int = 6) -> None:
    """Range-partition on the interleaved quantiles, so each file covers a small box of values.

    The columns themselves break ties, so that rows of one zone can still be split over files.
    """
    (
        with_rank_zone(df, columns, bits, "_zone")
        .repartitionByRange(files, "_zone", *columns)
        .sortWithinPartitions("_zone", *columns)
        .drop("_zone")
        .write.mode("overwrite").parquet(path)
    )
