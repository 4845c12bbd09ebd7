"""Facts about fitted models that SQL can state: totals that must add up, optima that no neighbour beats, rows that must be there."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from millrace.analytics import clv, forecast as fc, segments as seg, textclass as txt
from millrace.queries import inputs
from millrace.queries.inputs import ORDERS_SQL, SALES_SQL, calendar_sql
from millrace.queries.q_models import METRICS, SCORES, WEEKDAYS, classified, customer_metrics, holdout, scored_customers
from millrace.queries.registry import query
from millrace.scratch import materialise


@query("x3_item_forecast_facts", f"""
WITH {calendar_sql("item")}
SELECT item, count(*) + 90 AS rows_out, sum(y) AS sold, CAST(1 AS DOUBLE) AS level, CAST(0 AS BIGINT) AS apart FROM full_days GROUP BY item""")
def x3_facts(t):
    """Rows, history, level, and days on which trend and seasons do not make up the forecast."""
    rows = fc.forecast(inputs.sales(t), ["item"], horizon=90)
    made = F.col("trend") * (1 + F.col("weekly")) * (1 + F.col("yearly"))
    past = F.col("y").isNotNull()
    return rows.groupBy("item").agg(
        F.count("*").alias("rows_out"), F.sum("y").alias("sold"), F.round(F.sum("y") / F.sum(F.when(past, F.col("yhat"))), 6).alias("level"),
        F.count(F.when(F.abs(made - F.col("yhat")) > 1e-6 * (1 + F.col("yhat")), 1)).alias("apart"))


@query("m12_allocation_adds_up", f"""
WITH {SALES_SQL} SELECT item, CAST(90 AS BIGINT) AS days, count(DISTINCT store) AS stores, CAST(0 AS BIGINT) AS wrong FROM sales GROUP BY item""")
def m12_adds_up(t):
    """The stores' shares of a future day make up the item's forecast of that day."""
    sales = inputs.sales(t)
    parts = fc.allocated_forecast(sales).filter("sales is null").groupBy("item", F.col("date").alias("ds")).agg(
        F.sum("forecast").alias("total"), F.count("*").alias("stores"))
    whole = fc.forecast(sales, ["item"]).filter("y is null").select("item", "ds", "yhat")
    wrong = F.abs(F.col("total") - F.col("yhat")) > 1e-9 * (1 + F.col("yhat"))
    return parts.join(whole, ["item", "ds"]).groupBy("item").agg(
        F.count("*").alias("days"), F.max("stores").alias("stores"), F.count(F.when(wrong, 1)).alias("wrong"))


@query("m13_backtest_rows", f"""
WITH {calendar_sql("item")},
cuts AS (SELECT item, hi - 180 - 90 * CAST(k AS INTEGER) AS cutoff FROM ends, range(0, 200) r(k) WHERE hi - 180 - 90 * CAST(k AS INTEGER) >= lo + 730)
SELECT CAST(ceil((date - cutoff) / 30.0) * 30 AS INTEGER) AS days_ahead, count(*) AS n, sum(y) AS sold
FROM cuts JOIN full_days USING (item) WHERE date > cutoff AND date <= cutoff + 180 GROUP BY 1""")
def m13_rows(t):
    """Every later day of every origin is there, with what was sold."""
    errors = fc.backtest(inputs.sales(t), ["item"])
    return errors.groupBy((F.ceil(F.col("lead") / 30) * 30).cast("int").alias("days_ahead")).agg(F.count("*").alias("n"), F.sum("y").alias("sold"))


@query("m13_backtest_of_weekday_means", f"""
WITH {calendar_sql("item")},
cuts AS (SELECT item, lo, hi - 180 - 90 * CAST(k AS INTEGER) AS cutoff FROM ends, range(0, 200) r(k) WHERE hi - 180 - 90 * CAST(k AS INTEGER) >= lo + 730),
means AS (SELECT c.item, cutoff, isodow(date) AS d, avg(y) AS mean FROM cuts c JOIN full_days f ON f.item = c.item AND date <= cutoff GROUP BY ALL)
SELECT CAST(ceil((date - c.cutoff) / 30.0) * 30 AS INTEGER) AS days_ahead, count(*) AS n, round(sqrt(avg((y - mean) * (y - mean))) + 1e-9, 5) AS rmse
FROM cuts c JOIN full_days f ON f.item = c.item AND date > c.cutoff AND date <= c.cutoff + 180
JOIN means m ON m.item = c.item AND m.cutoff = c.cutoff AND m.d = isodow(date) GROUP BY 1""")
def m13_weekdays(t):
    """The errors of a model that SQL can fit too: weekday means of the days up to each origin."""
    rows = fc.rmse_by_lead(fc.backtest(inputs.sales(t), ["item"], settings=WEEKDAYS))
    return rows.select("days_ahead", "n", F.round(F.col("rmse") + 1e-9, 5).alias("rmse"))


@query("m13_beats_the_year_before", f"""
WITH {calendar_sql("store")} SELECT store, true AS better FROM ends WHERE date_diff('day', lo, hi) >= 910""")
def m13_better(t):
    """Stores in which the backtest error is below that of the same weekday a year before."""
    sales = inputs.sales(t)
    model = fc.rmse_by_lead(fc.backtest(sales, ["store"], period=180), ["store"], 180).select("store", "rmse")
    naive = fc.seasonal_naive(sales, ["store"]).groupBy("store").agg(F.sqrt(F.avg(F.pow(F.col("y") - F.col("yhat"), 2))).alias("year_before"))
    return model.join(naive, "store").select("store", (F.col("rmse") < F.col("year_before")).alias("better"))


@query("m14_best_trials", f"WITH {SALES_SQL} SELECT DISTINCT store, CAST({len(fc.GRID)} AS BIGINT) AS trials, true AS is_least FROM sales")
def m14_best(t):
    tried = materialise(fc.search(inputs.sales(t), ["store"], period=180), "trials")
    best = fc.best_trial(tried, ["store"]).select("store", F.col("rmse").alias("chosen"))
    return tried.join(best, "store").groupBy("store").agg(
        F.count("*").alias("trials"), (F.min("rmse") == F.max("chosen")).alias("is_least"))


def nearest(rows, model, columns, scaled):
    """Customers, and those that another centre is nearer to than their own."""
    centres = seg.centres(model)
    at = [F.col(c).cast("double") for c in columns]
    if scaled:  # as the model's scaler did: every column to 0..10
        ends = rows.agg(*[f(c) for c in columns for f in (F.min, F.max)]).first()
        at = [(a - float(ends[2 * i])) / float(ends[2 * i + 1] - ends[2 * i]) * 10 for i, a in enumerate(at)]
    far = [sum(((a - F.lit(float(v))) ** 2 for a, v in zip(at, c)), F.lit(0.0)) for c in centres]
    own = F.array(*far)[F.col("cluster")]
    return seg.assign(model, rows).agg(F.count("*").alias("customers"), F.count(F.when(own > F.least(*far) + 1e-9, 1)).alias("misplaced"),
                                       F.count_distinct("cluster").alias("clusters"))


@query("m4_nearest_centres", f"WITH {ORDERS_SQL} SELECT count(DISTINCT customer_id) AS customers, CAST(0 AS BIGINT) AS misplaced, CAST(4 AS BIGINT) AS clusters FROM sales")
def m4_nearest(t):
    scored = scored_customers(t)
    return nearest(scored, seg.fit_segments(scored, SCORES, k=4, scale=False), SCORES, False)


@query("m6_nearest_centres", f"WITH {ORDERS_SQL} SELECT count(DISTINCT customer_id) AS customers, CAST(0 AS BIGINT) AS misplaced, CAST(4 AS BIGINT) AS clusters FROM sales")
def m6_nearest(t):
    rows = customer_metrics(t)
    return nearest(rows, seg.fit_segments(rows, METRICS, k=4), METRICS, True)


@query("m8_retention_optimum", """
SELECT parameter, true AS is_peak FROM (VALUES ('r'), ('alpha'), ('s'), ('beta')) v(parameter)""")
def m8_optimum(t):
    """No parameter does better 5 % up or down: the likelihood, less its penalty, has its peak there (a parameter at the
    end of its range cannot go on)."""
    rows = holdout(t)
    scale = 10.0 / float(rows.agg(F.max("T_cal")).first()[0])  # the fit's unit of time
    stats = materialise(rows.groupBy(F.col("frequency_cal").cast("double").alias("x"), (F.col("recency_cal").cast("double") * scale).alias("tx"),
                                     (F.col("T_cal").cast("double") * scale).alias("T")).agg(F.count("*").cast("double").alias("n")), "triples")
    model = clv.fit_retention(rows, 1.0, "frequency_cal", "recency_cal", "T_cal")
    names = ["r", "alpha", "s", "beta"]
    at = np.log([model[k] * (scale if k in ("alpha", "beta") else 1.0) for k in names])
    points = [np.clip(p, -clv.LIMIT, clv.LIMIT) for p in (at, *(at + sign * s for sign in (1, -1) for s in np.eye(4) * np.log(1.05)))]
    got = clv.summed(stats, clv.pareto_nbd_loglik, points) - np.array([np.sum(np.exp(p) ** 2) for p in points])
    peak = [bool(got[0] >= max(got[1 + i], got[5 + i]) - 1e-6) for i in range(4)]
    each = F.array(*[F.struct(F.lit(k).alias("parameter"), F.lit(p).alias("is_peak")) for k, p in zip(names, peak)])
    return t.spark.range(1).select(F.inline(each))


@query("m16_test_rows", """
SELECT lang AS actual, count(*) AS n FROM documents WHERE substr(sha1(CAST(doc_id AS VARCHAR)), 1, 7) < '547ae14' GROUP BY 1""")
def m16_rows(t):
    """The confusion table holds every test row once; the share is 0.33 of 16**7."""
    model, _, test = classified(t)
    return txt.confusion(txt.predict_labels(model, test, "lang"), "lang").groupBy("actual").agg(F.sum("n").alias("n"))
