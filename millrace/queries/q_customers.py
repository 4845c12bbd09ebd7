"""Customer value, feature and label queries."""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import functions as F

from millrace.analytics import propensity as pro, rfm
from millrace.functions import clean
from millrace.operators.tables import grid
from millrace.queries import inputs
from millrace.queries.inputs import ORDERS_SQL, TRANSACTIONS_SQL
from millrace.queries.registry import query
from millrace.scratch import scratch_path
from millrace.queries.staging import portions, staged
from millrace.session import task_count


def cents_mean(total, n):
    """A non-negative mean rounded half up to cents in whole numbers, so ties agree between engines."""
    return (f"coalesce(CAST((2 * CAST(({total}) * 100 AS BIGINT) + {n}) // nullif(2 * {n}, 0) AS DOUBLE) / 100, 0)")


RFM_SQL = f"""
{ORDERS_SQL},
daily AS (SELECT customer_id, d, sum(amount) AS amount FROM sales WHERE customer_id IS NOT NULL GROUP BY ALL),
firsts AS (SELECT customer_id, min(d) AS first_day, max(d) AS last_day, count(*) AS n FROM daily GROUP BY 1),
rfm AS (
  SELECT customer_id, CAST(f.n - 1 AS FLOAT) AS frequency,
         CAST(date_diff('day', first_day, last_day) AS FLOAT) AS recency,
         CAST(date_diff('day', first_day, (SELECT max(d) FROM sales)) AS FLOAT) AS "T",
         {cents_mean("sum(amount) FILTER (d <> first_day)", "(f.n - 1)")} AS monetary_value
  FROM daily JOIN firsts f USING (customer_id) GROUP BY customer_id, f.n, first_day, last_day)"""


@query("m1_rfm", f"""WITH {RFM_SQL}
SELECT customer_id, frequency, recency, "T", monetary_value FROM rfm""")
def m1(t):
    return rfm.rfm(inputs.customer_orders(t))


@query("m2_rfm_holdout", f"""
WITH {ORDERS_SQL},
cut AS (SELECT max(d) - 90 AS cut FROM sales),
daily AS (SELECT customer_id, d, sum(amount) AS amount FROM sales GROUP BY ALL),
cal AS (SELECT daily.* FROM daily, cut WHERE d < cut),
firsts AS (SELECT customer_id, min(d) AS first_day, max(d) AS last_day, count(*) AS n FROM cal GROUP BY 1),
before AS (
  SELECT customer_id, CAST(f.n - 1 AS FLOAT) AS frequency_cal, CAST(date_diff('day', first_day, last_day) AS FLOAT) AS recency_cal,
         CAST(date_diff('day', first_day, (SELECT cut FROM cut)) AS FLOAT) AS "T_cal",
         {cents_mean("sum(amount) FILTER (d <> first_day)", "(f.n - 1)")} AS monetary_value_cal
  FROM cal JOIN firsts f USING (customer_id) GROUP BY customer_id, f.n, first_day, last_day),
later AS (SELECT customer_id, count(*) AS n, {cents_mean("sum(amount)", "count(*)")} AS mean FROM daily, cut WHERE d >= cut GROUP BY 1)
SELECT before.*, CAST(coalesce(n, 0) AS DOUBLE) AS frequency_holdout,
       coalesce(mean, 0) AS monetary_value_holdout, CAST(90 AS DOUBLE) AS duration_holdout
FROM before LEFT JOIN later USING (customer_id)""")
def m2(t):
    return rfm.rfm_holdout(inputs.customer_orders(t))


def _score_sql(c, rising):
    cuts = [f"(SELECT v FROM cuts WHERE name = '{c}' AND step = {i})" for i in range(1, 5)]
    if rising:
        return " ".join(["CASE", *[f"WHEN {c} > {cuts[i]} THEN {i + 2}" for i in (3, 2, 1, 0)], "ELSE 1 END"])
    return " ".join(["CASE", *[f"WHEN {c} >= {cuts[i]} THEN {4 - i}" for i in (3, 2, 1, 0)], "ELSE 5 END"])


@query("m3_rfm_scores", f"""
WITH {RFM_SQL},
long AS (SELECT 'recency' AS name, CAST(recency AS DOUBLE) AS v FROM rfm UNION ALL SELECT 'frequency', CAST(frequency AS DOUBLE) FROM rfm
         UNION ALL SELECT 'monetary_value', monetary_value FROM rfm),
ranked AS (SELECT name, v, row_number() OVER (PARTITION BY name ORDER BY v) AS r, count(*) OVER (PARTITION BY name) AS n FROM long),
cuts AS (SELECT name, step, v FROM ranked, (SELECT unnest([1, 2, 3, 4, 5]) AS step) WHERE r = (n * step + 5) // 6)
SELECT customer_id, CAST({_score_sql('recency', False)} AS INTEGER) AS recency_score,
       CAST({_score_sql('frequency', True)} AS INTEGER) AS frequency_score,
       CAST({_score_sql('monetary_value', True)} AS INTEGER) AS monetary_value_score FROM rfm""")
def m3(t):
    scored = rfm.rfm_scores(rfm.rfm(inputs.customer_orders(t)))
    return scored.select("customer_id", "recency_score", "frequency_score", "monetary_value_score")


# ---- household features --------------------------------------------------------------------

def tx(t):
    """The normalised transactions as a table, written once and ordered by day, so that the many
    passes over it neither repeat the joins nor read days outside their window.

    The joins hash their smaller side, so no order line is sorted for them; days are dealt to parts by
    number, because finding ranges by sampling would run the joins twice; and parts follow the size of
    the input, so that one is sorted in memory.
    """
    def write(path):
        part = t.part.hint("shuffle_hash") if portions(t.part, 1) > 1 else t.part
        raw = inputs.raw_transactions(SimpleNamespace(lineitem=t.lineitem, orders=t.orders.hint("shuffle_hash"), part=part))
        parts = portions(raw, task_count(t.spark), width=2)
        lo, hi = t.orders.agg(F.min(F.col("o_orderdate").cast("date")), F.max(F.col("o_orderdate").cast("date"))).first()
        span = (hi - lo).days + 1 if lo is not None else 1
        number = F.coalesce(F.floor(F.datediff("day", F.lit(lo).cast("date")) * parts / F.lit(span)), F.lit(0)).cast("int")
        clean.normalise_transactions(raw.repartitionById(parts, number).sortWithinPartitions("day")).write.parquet(path)

    return t.spark.read.parquet(staged(t, "transactions", write))


def pairs(t):
    """Every household with every commodity."""
    base = tx(t)
    return grid(base.select("household_key").distinct(), base.select("commodity_desc").distinct())


DAYS = {"30d": (29, 0), "60d": (59, 0), "90d": (89, 0), "365d": (364, 335)}


def summary_sql(keys, windows, source="tx", last="(SELECT max(day) FROM tx)", suffix=""):
    """The published definition spelled out: one filtered aggregate per window, joined to the keys."""
    parts = []
    k = ", ".join(keys)
    for w in windows:
        lo, hi = DAYS[w]
        s = f"{suffix}_{w}"
        cols = [f"count(DISTINCT day) AS days{s}", f"count(DISTINCT basket_id) AS baskets{s}",
                f"count(product_id) AS products{s}", f"count(*) AS line_items{s}"]
        cols += [f"sum({c}) AS {c}{s}" for c in pro.AMOUNTS]
        for n, c in (("days", "day"), ("baskets", "basket_id"), ("products", "product_id")):
            cols += [f"count(DISTINCT CASE WHEN {d} > 0 THEN {c} END) AS {n}_with_{d}{s}" for d in pro.DISCOUNTS]
        cols += [f"sum(CASE WHEN {d} > 0 THEN 1 END) AS line_items_with_{d}{s}" for d in pro.DISCOUNTS]
        cols += [f"min(date_diff('day', CASE WHEN {d} > 0 THEN day ELSE {last} - {lo} END, {last} - {hi})) AS days_since_{d}{s}"
                 for d in pro.DISCOUNTS]
        parts.append(f"w{w} AS (SELECT {k}, {', '.join(cols)} FROM {source} "
                     f"WHERE day BETWEEN {last} - {lo} AND {last} - {hi} GROUP BY {k})")
    return ", ".join(parts)


def features_sql(keys, windows, with_ratios=False):
    k = ", ".join(keys)
    out = []
    for w in windows:
        cols = pro.feature_names()
        out += [f"CAST({c}_{w} AS DOUBLE) AS {c}_{w}" for c in cols]
        if with_ratios:
            lo, hi = DAYS[w]
            for c in [*pro.TOTALS, *[f"days_with_{d}" for d in pro.DISCOUNTS]]:
                top = f"CAST({c}_{w} AS DOUBLE)"
                out.append(f"{top} / {lo - hi + 1} AS {c}_per_days_in_set_{w}")
                for label, den in (("per_day", "days"), ("per_basket", "baskets"), ("per_product", "products"),
                                   ("per_line_item", "line_items")):
                    out.append(f"{top} / nullif(CAST({den}_{w} AS DOUBLE), 0) AS {c}_{label}_{w}")
            out += [f"CAST({c}_{w} AS DOUBLE) / nullif(CAST(amount_list_{w} AS DOUBLE), 0) AS {c}_to_amount_list_{w}"
                    for c in pro.SHARES]
    joins = " ".join(f"LEFT JOIN w{w} USING ({k})" for w in windows)
    return (f"WITH {TRANSACTIONS_SQL}, keys AS (SELECT DISTINCT {k} FROM tx), {summary_sql(keys, windows)} "
            f"SELECT {k}, {', '.join(out)} FROM keys {joins}")


def _anchored(t, keys, windows, ratios=False):
    rows = tx(t)
    f = pro.summary_features(pro.with_last_day(rows, windows), keys, windows)
    f = pro.with_ratios(f, keys, windows) if ratios else f
    return rows.select(*keys).distinct().join(f, list(keys), "left")


ALL = ["30d", "60d", "90d", "365d"]


@query("m19_household_features", features_sql(["household_key"], ALL))
def m19(t):
    return _anchored(t, ["household_key"], ALL)


@query("m19_household_commodity_features", features_sql(["household_key", "commodity_desc"], ["30d", "60d"]))
def m19_cmd(t):
    return _anchored(t, ["household_key", "commodity_desc"], ["30d", "60d"])


@query("m20_feature_ratios", features_sql(["household_key"], ["30d", "60d"], with_ratios=True))
def m20(t):
    return _anchored(t, ["household_key"], ["30d", "60d"], ratios=True)


@query("m21_days_since_discount", f"""
WITH {TRANSACTIONS_SQL}, {summary_sql(["household_key"], ["90d"])}
SELECT household_key, {', '.join(f"CAST(days_since_{d}_90d AS DOUBLE) AS days_since_{d}_90d" for d in pro.DISCOUNTS)} FROM w90d""")
def m21(t):
    f = pro.summary_features(pro.with_last_day(tx(t), ["90d"]), ["household_key"], ["90d"])
    return f.select("household_key", *[f"days_since_{d}_90d" for d in pro.DISCOUNTS])


# ---- labels --------------------------------------------------------------------------------

LABEL_SQL = f"""
{TRANSACTIONS_SQL},
weekly AS (SELECT household_key, commodity_desc, day - CAST(dayofweek(day) + 1 AS INTEGER) AS day, sum(units) AS units FROM tx GROUP BY ALL),
ends AS (SELECT min(day) AS lo, max(day) AS hi FROM weekly),
spine AS (SELECT CAST(d AS DATE) AS day FROM (SELECT unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP) - INTERVAL 1 DAY, INTERVAL 7 DAY)) AS d FROM ends)),
pairs AS (SELECT * FROM (SELECT DISTINCT household_key FROM tx) CROSS JOIN (SELECT DISTINCT commodity_desc FROM tx)),
dense AS (SELECT household_key, commodity_desc, day, coalesce(units, 0) AS units
          FROM pairs CROSS JOIN spine LEFT JOIN weekly USING (household_key, commodity_desc, day)),
labels AS (SELECT household_key, commodity_desc, day, CAST(sum(units) OVER (
             PARTITION BY household_key, commodity_desc ORDER BY day
             RANGE BETWEEN INTERVAL 1 DAY FOLLOWING AND INTERVAL 30 DAY FOLLOWING) > 0 AS INTEGER) AS will_by_in_30_days FROM dense)"""


@query("m22_weekly_spine", f"""
WITH {LABEL_SQL} SELECT strftime(day, '%Y-%m-%d') AS day, count(*) AS pairs, min(household_key) AS lowest, max(household_key) AS highest FROM dense GROUP BY 1""")
def m22(t):
    """The whole spine, summarised per week."""
    rows = pro.labels(tx(t), pairs(t))
    return rows.groupBy("day").agg(F.count("*").alias("pairs"), F.min("household_key").alias("lowest"),
                                   F.max("household_key").alias("highest"))


@query("m23_purchase_labels", f"""
WITH {LABEL_SQL} SELECT household_key, commodity_desc, count(*) AS weeks, CAST(coalesce(sum(will_by_in_30_days), 0) AS BIGINT) AS positive,
       count(*) FILTER (will_by_in_30_days IS NULL) AS unknown,
       strftime(max(day) FILTER (will_by_in_30_days = 1), '%Y-%m-%d') AS last_positive,
       strftime(min(day) FILTER (will_by_in_30_days = 1), '%Y-%m-%d') AS first_positive
FROM labels GROUP BY ALL""")
def m23(t):
    """Labels of every pair and week, summarised per pair."""
    y = F.col("will_by_in_30_days")
    return pro.labels(tx(t), pairs(t)).groupBy("household_key", "commodity_desc").agg(
        F.count("*").alias("weeks"), F.coalesce(F.sum(y), F.lit(0)).alias("positive"),
        F.count(F.when(y.isNull(), 1)).alias("unknown"),
        F.max(F.when(y == 1, F.col("day"))).alias("last_positive"),
        F.min(F.when(y == 1, F.col("day"))).alias("first_positive"))


def backfill_sql(weeks=(0, 1)):
    out = []
    names = pro.feature_names()
    for n in weeks:
        asof = f"((SELECT max(day - CAST(dayofweek(day) + 1 AS INTEGER)) FROM tx) - 28 - {7 * n})"
        last = f"(SELECT max(day) FROM tx WHERE day <= {asof})"
        hh = summary_sql(["household_key"], ["30d"], last=last).replace("w30d AS", "h AS")
        cm = summary_sql(["household_key", "commodity_desc"], ["30d"], last=last, suffix="_cmd").replace("w30d AS", "c AS")
        cols = [f"CAST({c}_30d AS DOUBLE) AS {c}_30d" for c in names]
        cols += [f"CAST({c}_cmd_30d AS DOUBLE) AS {c}_cmd_30d" for c in names]
        out.append(f"SELECT * FROM (WITH {hh}, {cm} SELECT household_key, commodity_desc, strftime({asof}, '%Y-%m-%d') AS day, "
                   f"{', '.join(cols)} FROM pairs LEFT JOIN h USING (household_key) LEFT JOIN c USING (household_key, commodity_desc))")
    return (f"WITH {TRANSACTIONS_SQL}, pairs AS (SELECT * FROM (SELECT DISTINCT household_key FROM tx) "
            f"CROSS JOIN (SELECT DISTINCT commodity_desc FROM tx)) " + " UNION ALL ".join(out))


@query("m24_feature_backfill", backfill_sql())
def m24(t):
    return pro.backfill(tx(t), pairs(t), weeks=2, windows=["30d"], ratios=False)


@query("m24_stored_features", backfill_sql((0, 1, 2)))
def m24_stored(t):
    """Two backfills whose weeks overlap, merged into one stored table: one row per key."""
    path = scratch_path(t.spark, "feature-table")
    rows, keys = tx(t), pairs(t)
    newest = rows.agg(F.max(pro.week_bucket("day"))).first()[0]
    for known in (rows.filter(pro.week_bucket("day") < F.lit(newest)), rows):
        pro.merge_features(pro.backfill(known, keys, weeks=2, windows=["30d"], ratios=False), path)
    return pro.look_up(t.spark.read.parquet(path).select(*pro.FEATURE_KEYS), path)


TRAIN_SQL = f"""
WITH {LABEL_SQL}, past AS (SELECT hi - 28 AS day FROM ends),
f AS (SELECT household_key, count(*) AS line_items_30d FROM tx, past
      WHERE tx.day <= past.day AND date_diff('day', tx.day, (SELECT max(tx.day) FROM tx, past WHERE tx.day <= past.day)) <= 29 GROUP BY 1)
SELECT will_by_in_30_days, CAST(line_items_30d AS DOUBLE) AS line_items_30d, count(*) AS n
FROM labels JOIN past USING (day) LEFT JOIN f USING (household_key)
WHERE commodity_desc = (SELECT min(p_type) FROM part) AND will_by_in_30_days IS NOT NULL GROUP BY ALL"""


@query("m25_training_set", TRAIN_SQL)
def m25(t):
    """Labels of one commodity on the newest backfilled day with features looked up by key."""
    return training(t).groupBy("will_by_in_30_days", "line_items_30d").agg(F.count("*").alias("n"))


def training(t):
    commodity = t.part.agg(F.min("p_type")).first()[0]
    rows, keys = tx(t), pairs(t)
    features = pro.backfill(rows, keys, weeks=1, windows=["30d"], ratios=False)
    newest = rows.agg(F.date_sub(F.max(pro.week_bucket("day")), 28)).first()[0]
    wanted = pro.labels(rows, keys, [newest])
    return pro.training_set(features, wanted, commodity)


@query("m28_transaction_totals", f"""
WITH {TRANSACTIONS_SQL}
SELECT commodity_desc, CAST(sum(amount_list) AS DOUBLE) AS amount_list, CAST(sum(amount_paid) AS DOUBLE) AS amount_paid,
       CAST(sum(campaign_coupon_discount) AS DOUBLE) AS campaign, CAST(sum(manuf_coupon_discount) AS DOUBLE) AS manuf,
       CAST(sum(total_coupon_discount) AS DOUBLE) AS total_coupon, CAST(sum(instore_discount) AS DOUBLE) AS instore
FROM tx GROUP BY 1""")
def m28(t):
    return clean.normalise_transactions(inputs.raw_transactions(t)).groupBy("commodity_desc").agg(
        F.sum("amount_list").alias("amount_list"), F.sum("amount_paid").alias("amount_paid"),
        F.sum("campaign_coupon_discount").alias("campaign"), F.sum("manuf_coupon_discount").alias("manuf"),
        F.sum("total_coupon_discount").alias("total_coupon"), F.sum("instore_discount").alias("instore"))


@query("j12_feature_lookup", TRAIN_SQL.replace("will_by_in_30_days, CAST", "commodity_desc, will_by_in_30_days, CAST")
       .replace("commodity_desc = (SELECT min(p_type) FROM part) AND ", ""))
def j12(t):
    rows, keys = tx(t), pairs(t)
    features = pro.backfill(rows, keys, weeks=1, windows=["30d"], ratios=False)
    newest = rows.agg(F.date_sub(F.max(pro.week_bucket("day")), 28)).first()[0]
    wanted = pro.labels(rows, keys, [newest]).filter("will_by_in_30_days is not null")
    return wanted.join(features, ["household_key", "commodity_desc", "day"], "left").groupBy(
        "commodity_desc", "will_by_in_30_days", "line_items_30d").agg(F.count("*").alias("n"))
