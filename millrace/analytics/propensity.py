"""Household features, ratios and purchase labels for propensity models.

Input columns: household_key, basket_id, day (date), product_id, commodity_desc,
units and the amounts made by ``clean.normalise_transactions``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F

from millrace.scratch import materialise
from millrace.session import task_count

AMOUNTS = ["amount_list", "instore_discount", "campaign_coupon_discount", "manuf_coupon_discount",
           "total_coupon_discount", "amount_paid"]
DISCOUNTS = ["instore_discount", "campaign_coupon_discount", "manuf_coupon_discount", "total_coupon_discount"]
TOTALS = ["days", "baskets", "products", "line_items", *AMOUNTS]
SHARES = ["campaign_coupon_discount", "manuf_coupon_discount", "total_coupon_discount", "amount_paid"]
LAST = "_last_day"


@dataclass(frozen=True)
class Window:
    """Days ``oldest`` .. ``newest`` counted back from the last day, both included."""

    name: str
    oldest: int
    newest: int = 0

    @property
    def days(self) -> int:
        return self.oldest - self.newest + 1

    def holds(self, day: str = "day") -> Column:
        back = F.datediff(F.col(LAST), F.col(day))
        return (back <= self.oldest) & (back >= self.newest)


WINDOWS = {
    "30d": Window("30d", 29),
    "60d": Window("60d", 59),
    "90d": Window("90d", 89),
    # a month a year ago, not a whole year
    "365d": Window("365d", 364, 335),
}


def with_last_day(tx: DataFrame, windows: Sequence[str] | None = None) -> DataFrame:
    """Stamp the last day on every row. With ``windows`` only the days they can reach are kept;
    the bounds are constants, so the scan can skip older row groups."""
    last = tx.agg(F.max("day")).first()[0]
    if windows is not None and last is not None:
        oldest = last - timedelta(days=max(WINDOWS[w].oldest for w in windows))
        tx = tx.filter((F.col("day") >= F.lit(oldest)) & (F.col("day") <= F.lit(last)))
    return tx.withColumn(LAST, F.lit(last).cast("date"))


def _used(flag: str) -> Column:
    return F.coalesce(F.max(F.when(F.col(flag) > 0, 1)), F.lit(0)).alias(flag)


def summary_features(tx: DataFrame, keys: Sequence[str], windows: Sequence[str] = ("30d", "60d")) -> DataFrame:
    """26 summary values and 4 days-since values per key and window; NULL where a window is empty.

    ``tx`` carries the last day (``with_last_day``). Distinct days, baskets and
    products come from three pre-aggregated branches whose partial results are
    summed. All windows share the branches, so the input is shuffled three times
    in combined form instead of being copied once per distinct count.
    """
    spans = [WINDOWS[w] for w in windows]
    back = F.datediff(F.col(LAST), F.col("day"))
    near = [(back <= w.oldest) & (back >= w.newest) for w in spans]
    wanted = near[0]
    for c in near[1:]:
        wanted = wanted | c
    rows = tx.filter(wanted)
    by = [*keys, LAST]

    # everything but distinct baskets and products is a sum or maximum over days
    daily = rows.groupBy(*by, "day").agg(
        F.count("*").alias("line_items"), F.count("product_id").alias("products"),
        *[F.sum(c).alias(f"sum_{c}") for c in AMOUNTS],
        *[F.sum(F.when(F.col(d) > 0, 1)).alias(f"lines_{d}") for d in DISCOUNTS],
        *[_used(d) for d in DISCOUNTS])
    day_parts = daily.groupBy(*by).agg(*[
        x for w in spans for x in _day_level(w)])

    def reach(thing: str, names: str, with_total: bool) -> DataFrame:
        per = rows.groupBy(*by, thing).agg(*[
            x for w in spans for x in [
                F.max(F.when(w.holds(), 1)).alias(f"any_{w.name}"),
                *[F.max(F.when(w.holds() & (F.col(d) > 0), 1)).alias(f"{d}_{w.name}") for d in DISCOUNTS]]])
        per = per.filter(F.col(thing).isNotNull())
        return per.groupBy(*by).agg(*[
            x for w in spans for x in [
                *([F.count(f"any_{w.name}").alias(f"{names}_{w.name}")] if with_total else []),
                *[F.count(f"{d}_{w.name}").alias(f"{names}_with_{d}_{w.name}") for d in DISCOUNTS]]])

    parts = day_parts.unionByName(reach("basket_id", "baskets", True), allowMissingColumns=True)
    parts = parts.unionByName(reach("product_id", "products", False), allowMissingColumns=True)
    whole = parts.groupBy(*by).agg(*[F.max(c).alias(c) for c in parts.columns if c not in by])
    out = []
    for w in spans:
        some = F.col(f"line_items_{w.name}").isNotNull()
        for c in feature_names():
            v = F.col(f"{c}_{w.name}")
            if c == "baskets" or c.startswith(("baskets_with", "products_with")):
                v = F.when(some, F.coalesce(v, F.lit(0)))
            out.append(v.cast("double").alias(f"{c}_{w.name}"))
    return whole.select(*keys, *out)


def feature_names() -> list[str]:
    return [*TOTALS,
            *[f"{n}_with_{d}" for n in ("days", "baskets", "products", "line_items") for d in DISCOUNTS],
            *[f"days_since_{d}" for d in DISCOUNTS]]


def _day_level(w: Window) -> list[Column]:
    inside = w.holds()
    some = F.count(F.when(inside, 1)) > 0

    def total(c: str) -> Column:
        return F.sum(F.when(inside, F.col(c)))

    cols = [F.when(some, F.count(F.when(inside, 1))).alias(f"days_{w.name}"),
            total("products").alias(f"products_{w.name}"),
            total("line_items").alias(f"line_items_{w.name}")]
    cols += [total(f"sum_{c}").alias(f"{c}_{w.name}") for c in AMOUNTS]
    for d in DISCOUNTS:
        used = inside & (F.col(d) == 1)
        since = F.datediff(F.max(LAST), F.max(F.when(used, F.col("day")))) - w.newest
        cols += [
            F.when(some, F.count(F.when(used, 1))).alias(f"days_with_{d}_{w.name}"),
            total(f"lines_{d}").alias(f"line_items_with_{d}_{w.name}"),
            F.when(some, F.coalesce(since, F.lit(w.days - 1))).alias(f"days_since_{d}_{w.name}"),
        ]
    return cols


def with_ratios(features: DataFrame, keys: Sequence[str], windows: Sequence[str] = ("30d", "60d")) -> DataFrame:
    """14 values over 5 denominators and 4 shares of the list price, per window."""
    made = []
    over = {"per_day": "days", "per_basket": "baskets", "per_product": "products", "per_line_item": "line_items"}
    for name in windows:
        w = WINDOWS[name]
        for c in [*TOTALS, *[f"days_with_{d}" for d in DISCOUNTS]]:
            top = F.col(f"{c}_{name}")
            made.append((top / F.lit(float(w.days))).alias(f"{c}_per_days_in_set_{name}"))
            made += [F.try_divide(top, F.col(f"{den}_{name}")).alias(f"{c}_{label}_{name}")
                     for label, den in over.items()]
        made += [F.try_divide(F.col(f"{c}_{name}"), F.col(f"amount_list_{name}")).alias(f"{c}_to_amount_list_{name}")
                 for c in SHARES]
    return features.select("*", *made)


def featureset(tx: DataFrame, pairs: DataFrame, windows: Sequence[str] = ("30d", "60d"),
               ratios: bool = True, fill: float | None = None, as_of: Column | None = None) -> DataFrame:
    """Household features next to household-and-commodity features (suffix ``_cmd``).

    ``pairs`` anchors the result: its keys are all present, with NULLs (or
    ``fill``) where nothing was bought in a window.
    """
    both = []
    for keys, suffix in ((["household_key"], ""), (["household_key", "commodity_desc"], "_cmd")):
        f = summary_features(tx, keys, windows)
        f = with_ratios(f, keys, windows) if ratios else f
        both.append(f.select(*keys, *[
            F.col(c).alias(_suffixed(c, suffix, windows)) for c in f.columns if c not in keys]))
    anchor = pairs.select("household_key", "commodity_desc").distinct()
    out = anchor.join(both[0], ["household_key"], "left").join(both[1], ["household_key", "commodity_desc"], "left")
    return out if fill is None else out.fillna(fill)


def _suffixed(column: str, suffix: str, windows: Sequence[str]) -> str:
    for w in windows:
        if column.endswith(f"_{w}"):
            return f"{column[:-len(w) - 1]}{suffix}_{w}"
    return column + suffix


# ---- labels --------------------------------------------------------------------------------

def week_bucket(day: str | Column) -> Column:
    """The Saturday before the day's week (day of week runs from Sunday = 1)."""
    c = F.col(day) if isinstance(day, str) else day
    return F.date_add(c, -F.dayofweek(c))


def purchase_weeks(tx: DataFrame) -> DataFrame:
    return tx.groupBy("household_key", "commodity_desc", week_bucket("day").alias("day")).agg(
        F.sum("units").alias("units"))


def labels(tx: DataFrame, pairs: DataFrame, days: Sequence[date] | None = None) -> DataFrame:
    """For each pair and week: was any unit bought in the 30 days after it?

    The last week is not part of the spine, and a week with no later week in
    the spine has a NULL label. Only pairs are shuffled: each carries the sorted
    weeks in which it bought, and the weekly spine is expanded after the join
    inside the task, which replaces a window over the zero-filled table. With
    ``days`` only the labels of these weeks are expanded, from the same purchases.
    """
    weeks = purchase_weeks(tx)
    lo, hi = tx.agg(F.min(week_bucket("day")), F.max(week_bucket("day"))).first()
    # one entry per calendar week, so an array is as long as the calendar at most
    bought = weeks.filter("units <> 0").groupBy("household_key", "commodity_desc").agg(
        F.collect_list(F.struct("day", "units")).alias("_weeks"))
    # a pair is a few bytes but becomes hundreds of rows: keep the partitions from being coalesced
    keyed = (
        pairs.select("household_key", "commodity_desc")
        .repartition(task_count(tx.sparkSession), "household_key", "commodity_desc").distinct()
        .join(bought, ["household_key", "commodity_desc"], "left")
        .withColumn("_lo", F.lit(lo).cast("date"))
        .withColumn("_hi", F.lit(hi).cast("date"))
    )
    # weeks whose following 30 days sum to more than nothing, worked out once per pair
    keyed = keyed.withColumn("_positive", F.expr("""
        filter(
            array_distinct(flatten(transform(_weeks, w -> transform(sequence(1, 4), k -> date_sub(w.day, 7 * k))))),
            d -> aggregate(filter(_weeks, w -> w.day > d and w.day <= date_add(d, 30) and w.day < _hi),
                           0L, (a, w) -> a + w.units) > 0)""")).drop("_weeks")
    # the spine stops before the last week
    spine = F.expr("if(_hi > _lo, sequence(_lo, date_sub(_hi, 1), interval 7 days), cast(array() as array<date>))")
    if days is not None:
        spine = F.array_intersect(spine, F.array(*[F.lit(d) for d in days]).cast("array<date>"))
    flagged = F.transform(spine, lambda d: F.struct(
        d.alias("day"), F.coalesce(F.array_contains("_positive", d), F.lit(False)).alias("_hit")))
    rows = keyed.select("household_key", "commodity_desc", "_hi", F.inline(flagged))
    has_later = F.date_add("day", 7) < F.col("_hi")
    return rows.select(
        "household_key", "commodity_desc", "day",
        F.when(has_later, F.col("_hit").cast("int")).alias("will_by_in_30_days"))


# ---- backfill and training sets ------------------------------------------------------------

def backfill(tx: DataFrame, pairs: DataFrame, weeks: int = 2, lag_days: int = 28,
             windows: Sequence[str] = ("30d", "60d"), ratios: bool = True, stamp: str = "as_of") -> DataFrame:
    """Features as they were on several past week days, in one job.

    Each transaction is given to every as-of day whose windows can reach it. The
    rows are stamped with the as-of day; ``stamp='reference'`` stamps the last
    transaction day up to it, as published, which a weekly lookup can miss.
    """
    longest = max(WINDOWS[w].oldest for w in windows)
    newest = tx.agg(F.max(week_bucket("day"))).first()[0]
    as_ofs = [newest - timedelta(days=lag_days + 7 * n) for n in range(weeks)]
    # last transaction day up to each as-of day: one row with a column per as-of day
    lasts = tx.agg(*[F.max(F.when(F.col("day") <= F.lit(d), F.col("day"))) for d in as_ofs]).first()
    known = [(d, last) for d, last in zip(as_ofs, lasts) if last is not None]
    if stamp != "as_of":  # as-of days that share their last transaction day are one feature day
        known = [(d, last) for last, d in {last: d for d, last in known}.items()]
    if not known:
        raise ValueError("no transactions up to the first as-of day")
    anchors = F.array(*[
        F.struct(F.lit(d).alias("as_of"), F.lit(last).alias(LAST)) for d, last in known])
    first, final = min(last for _, last in known), max(last for _, last in known)
    reach = tx.filter((F.col("day") >= F.lit(first - timedelta(days=longest))) & (F.col("day") <= F.lit(final)))
    spread = reach.select("*", F.inline(anchors)).filter(
        (F.col("day") <= F.col(LAST)) & (F.datediff(LAST, "day") <= longest))
    spread = spread.select(*tx.columns, LAST, (F.col("as_of") if stamp == "as_of" else F.col(LAST)).alias("feature_day"))
    days_each = F.array_distinct(F.array(*[F.lit(d if stamp == "as_of" else last) for d, last in known]))
    both = []
    for keys, suffix in ((["household_key"], ""), (["household_key", "commodity_desc"], "_cmd")):
        by = [*keys, "feature_day"]
        f = summary_features(spread, by, windows)
        f = with_ratios(f, by, windows) if ratios else f
        both.append(f.select(*by, *[F.col(c).alias(_suffixed(c, suffix, windows)) for c in f.columns if c not in by]))
    anchor = pairs.select("household_key", "commodity_desc").distinct().withColumn("feature_day", F.explode(days_each))
    out = anchor.join(both[0], ["household_key", "feature_day"], "left").join(
        both[1], ["household_key", "commodity_desc", "feature_day"], "left")
    return out.withColumnRenamed("feature_day", "day")


def training_set(features: DataFrame, label_rows: DataFrame, commodity: str) -> DataFrame:
    """Features looked up for one commodity's labels by primary key; the keys are dropped."""
    keys = ["household_key", "commodity_desc", "day"]
    wanted = label_rows.filter(
        (F.col("commodity_desc") == commodity) & F.col("will_by_in_30_days").isNotNull())
    return wanted.join(features, keys, "left").drop(*keys)


FEATURE_KEYS = ("household_key", "commodity_desc", "day")


def merge_features(features: DataFrame, path: str, keys: Sequence[str] = FEATURE_KEYS) -> None:
    """Feature rows into a stored table that is partitioned by day: rows of a known key are replaced, others added.

    Only the days at hand are read and written again.
    """
    spark = features.sparkSession
    new = materialise(features, "features")
    days = [r.day for r in new.select("day").distinct().collect()]  # the backfilled weeks
    try:
        old = spark.read.parquet(path).filter(F.col("day").isin(days))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        merged = new
    else:
        kept = old.join(new.select(*keys), list(keys), "left_anti")
        merged = materialise(new.unionByName(kept, allowMissingColumns=True), "merged")
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def look_up(wanted: DataFrame, path: str, keys: Sequence[str] = FEATURE_KEYS) -> DataFrame:
    """The stored features of the wanted keys, absent ones as NULL; only the wanted days are read."""
    stored = wanted.sparkSession.read.parquet(path)
    return wanted.join(stored, list(keys), "left")
