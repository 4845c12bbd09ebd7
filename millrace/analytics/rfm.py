"""Recency, frequency and value of customers, holdout split and scores.

Input columns: customer_id, invoice_date (date), sales_amount (decimal).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.aggregates import quantile_cuts
from millrace.scratch import materialise


def daily_spend(orders: DataFrame) -> DataFrame:
    """One row per customer and day; combined map-side, so hot customers shrink before the shuffle."""
    return (
        orders.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id", "invoice_date")
        .agg(F.sum("sales_amount").alias("amount"))
    )


def _cents(total: Column, n: Column) -> Column:
    """A mean, floored at 0 and rounded half up in decimal arithmetic."""
    mean = F.try_divide(total.cast("decimal(24,2)"), n)
    return F.round(F.greatest(F.coalesce(mean, F.lit(0)), F.lit(0)), 2).cast("double")


def _summarise(daily: DataFrame, until: Column) -> DataFrame:
    repeat = F.sum("amount") - F.min_by("amount", "invoice_date")
    days = F.count("*") - 1
    return daily.groupBy("customer_id").agg(
        days.cast("float").alias("frequency"),
        F.datediff(F.max("invoice_date"), F.min("invoice_date")).cast("float").alias("recency"),
        F.datediff(F.max(until), F.min("invoice_date")).cast("float").alias("T"),
        _cents(repeat, days).alias("monetary_value"),
    )


def rfm(orders: DataFrame) -> DataFrame:
    """frequency: days with a purchase after the first; recency: first to last purchase;
    T: first purchase to the newest date of all orders; monetary_value: mean of the later days."""
    now = orders.agg(F.max("invoice_date")).scalar()
    return _summarise(daily_spend(orders).withColumn("_until", now), F.col("_until"))


def rfm_holdout(orders: DataFrame, holdout_days: int = 90) -> DataFrame:
    """The same summary before a cut, next to what the same customers did after it.

    Customers whose first purchase lies in the holdout are absent.
    """
    now = orders.agg(F.max("invoice_date")).scalar()
    daily = daily_spend(orders).withColumn("_cut", F.date_sub(now, holdout_days))
    before = _summarise(daily.filter(F.col("invoice_date") < F.col("_cut")), F.col("_cut"))
    after = daily.filter(F.col("invoice_date") >= F.col("_cut")).groupBy("customer_id").agg(
        F.count("*").cast("double").alias("_n"),
        _cents(F.sum("amount"), F.count("*")).alias("_mean"))
    names = ("frequency", "recency", "T", "monetary_value")
    return before.join(after, "customer_id", "left").select(
        "customer_id", *[F.col(c).alias(f"{c}_cal") for c in names],
        F.coalesce("_n", F.lit(0.0)).alias("frequency_holdout"),
        F.coalesce("_mean", F.lit(0.0)).alias("monetary_value_holdout"),
        F.lit(float(holdout_days)).alias("duration_holdout"))


def score(column: str | Column, cuts: Sequence[float], higher_is_better: bool) -> Column:
    """1..5 by the first four cut points.

    Rising scores use strict comparisons, falling scores inclusive ones.
    """
    c = F.col(column) if isinstance(column, str) else column
    marks = list(enumerate(cuts[:4]))[::-1]
    if higher_is_better:
        out = None
        for i, q in marks:
            out = F.when(c > q, i + 2) if out is None else out.when(c > q, i + 2)
        return out.otherwise(1)
    out = None
    for i, q in marks:
        out = F.when(c >= q, 4 - i) if out is None else out.when(c >= q, 4 - i)
    return out.otherwise(5)


# recency falls by default, as published, although the accompanying text says otherwise
DIRECTIONS: Mapping[str, bool] = {"recency": False, "frequency": True, "monetary_value": True}


def rfm_scores(summary: DataFrame, directions: Mapping[str, bool] = DIRECTIONS, error: float = 0.0) -> DataFrame:
    summary = materialise(summary, "customer-summary")  # far smaller than the orders, read per score
    cuts = {c: quantile_cuts(summary, c, 6, error) for c in directions}
    return summary.select(
        "*", *[score(c, cuts[c], up).cast("int").alias(f"{c}_score") for c, up in directions.items()])


def calibration_curve(predicted: DataFrame, since: str, actual: str, expected: str, width: int = 30) -> DataFrame:
    """Mean actual and expected purchases by time since the last purchase."""
    return predicted.groupBy((F.floor(F.col(since) / width) * width).cast("bigint").alias("days_since")).agg(
        F.count("*").alias("customers"), F.avg(actual).alias("actual"), F.avg(expected).alias("expected"))
