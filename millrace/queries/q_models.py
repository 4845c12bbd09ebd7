"""Model queries: forecasts, segments, lifetime value, classifiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.analytics import clv, forecast as fc, propensity as pro, rfm, segments as seg, textclass as txt
from millrace.queries import inputs, q_customers
from millrace.queries.inputs import calendar_sql
from millrace.queries.registry import query

# ---- forecasts -----------------------------------------------------------------------------

FORECAST_CHECK_SQL = f"""
WITH {calendar_sql("store", "item")}
SELECT store, item, count(*) + {{h}} AS rows_out, count(*) AS observed, sum(y) AS sold,
       strftime(max(date) + {{h}}, '%Y-%m-%d') AS last_ds, CAST(0 AS BIGINT) AS out_of_order, CAST(1 AS DOUBLE) AS level FROM full_days GROUP BY ALL"""


def _checked(rows, keys):
    """Per series: rows, history, last day, how many intervals do not enclose the forecast, and observed by expected total of the history."""
    bad = (F.col("yhat_lower") > F.col("yhat")) | (F.col("yhat") > F.col("yhat_upper")) | F.isnan("yhat")
    past = F.col("y").isNotNull()
    return rows.groupBy(*keys).agg(
        F.count("*").alias("rows_out"), F.count("y").alias("observed"), F.sum("y").alias("sold"),
        F.max("ds").alias("last_ds"), F.count(F.when(bad, 1)).alias("out_of_order"),
        F.round(F.sum("y") / F.sum(F.when(past, F.col("yhat"))), 6).alias("level"))


@query("m11_series_forecast", FORECAST_CHECK_SQL.format(h=90))
def m11(t):
    return _checked(fc.forecast(inputs.sales(t), ["store", "item"], horizon=90), ["store", "item"])


# without trend and year, and with nothing shrunk, the model is the mean of each weekday: a forecast that SQL can state
# (1e-9 keeps means that end in a 5 from being rounded either way)
WEEKDAYS = fc.Settings(weekly=3, yearly=0, ridge=0.0, growth=False, form="demand")
WEEKDAY_SQL = """
weekday AS (SELECT store, item, CASE WHEN date_diff('day', lo, hi) >= 13 THEN isodow(date) ELSE 0 END AS d, avg(y) AS mean FROM full_days GROUP BY ALL)"""


@query("m11_weekday_forecast", f"""
WITH {calendar_sql("store", "item")}, {WEEKDAY_SQL},
later AS (SELECT store, item, lo, hi, hi + CAST(k AS INTEGER) AS ds FROM ends, range(1, 29) r(k))
SELECT store, item, strftime(ds, '%Y-%m-%d') AS ds, round(coalesce(a.mean, b.mean) + 1e-9, 4) AS yhat FROM later
LEFT JOIN weekday a USING (store, item) LEFT JOIN (SELECT store AS s, item AS i, mean FROM weekday WHERE d = 0) b ON s = store AND i = item
WHERE a.d = isodow(ds) OR a.d = 0""")
def m11_weekdays(t):
    """Four weeks to come of each series, days without sales counted as such."""
    rows = fc.forecast(inputs.sales(t), ["store", "item"], horizon=28, settings=WEEKDAYS).filter("y IS NULL")
    return rows.select("store", "item", "ds", F.round(F.col("yhat") + 1e-9, 4).alias("yhat"))


@query("x2_grouped_forecast_30_days", FORECAST_CHECK_SQL.format(h=30))
def x2(t):
    return _checked(fc.forecast(inputs.sales(t), ["store", "item"], horizon=30), ["store", "item"])


@query("x3_item_forecast")
def x3(t):
    rows = fc.forecast(inputs.sales(t), ["item"], horizon=90)
    return rows.select("item", "ds", "y", "yhat", "yhat_lower", "yhat_upper", "trend", "weekly", "yearly")


@query("m12_allocated_forecast", f"""
WITH {calendar_sql("item")},
share AS (SELECT store, item, CAST(sum(sales) AS DOUBLE) / CAST(sum(sum(sales)) OVER (PARTITION BY item) AS DOUBLE) AS ratio FROM sales GROUP BY store, item)
SELECT store, item, count(*) AS days, min(y * ratio) AS lowest, max(y * ratio) AS highest,
       strftime(max(date), '%Y-%m-%d') AS last_day FROM full_days JOIN share USING (item) GROUP BY ALL""")
def m12(t):
    """The history side of the allocation, summarised per store and item."""
    rows = fc.allocated_forecast(inputs.sales(t)).filter("sales is not null")
    return rows.groupBy("store", "item").agg(
        F.count("*").alias("days"), F.min("sales").alias("lowest"), F.max("sales").alias("highest"),
        F.max("date").alias("last_day"))


@query("m12_allocated_forecast_totals")
def m12_future(t):
    rows = fc.allocated_forecast(inputs.sales(t)).filter("sales is null")
    return rows.groupBy("store", "item").agg(F.count("*").alias("days"), F.round(F.sum("forecast"), 3).alias("forecast"))


@query("m13_backtest_rmse")
def m13(t):
    errors = fc.backtest(inputs.sales(t), ["item"])
    return fc.rmse_by_lead(errors)


@query("m14_parameter_search")
def m14(t):
    return fc.best_trial(fc.search(inputs.sales(t), ["store"], period=180), ["store"])


@query("m15_forecast_table_report", f"""
WITH {calendar_sql("store", "item")}, {WEEKDAY_SQL},
days AS (SELECT store, item, lo, hi, date, y FROM full_days UNION ALL
         SELECT store, item, lo, hi, hi + CAST(k AS INTEGER), NULL FROM ends, range(1, 31) r(k))
SELECT store, item, strftime(date, '%Y-%m-%d') AS ds, y, round(mean + 1e-9, 4) AS yhat, '2024-06-30' AS training_date FROM days JOIN weekday USING (store, item)
WHERE (d = 0 OR d = isodow(date)) AND item = (SELECT min(p_partkey % 50) FROM part) ORDER BY ds, store""")
def m15(t):
    """One item out of the forecast table, stamped with the training date and ordered."""
    rows = fc.forecast(inputs.sales(t), ["store", "item"], horizon=30, settings=WEEKDAYS).withColumn(
        "training_date", F.lit("2024-06-30").cast("date"))
    first = t.part.agg(F.min(F.col("p_partkey") % 50)).scalar()
    return rows.filter(F.col("item") == first).select(
        "store", "item", "ds", "y", F.round(F.col("yhat") + 1e-9, 4).alias("yhat"), "training_date").orderBy("ds", "store")


# ---- segments ------------------------------------------------------------------------------

SCORES = ["recency_score", "frequency_score", "monetary_value_score"]


def scored_customers(t):
    return rfm.rfm_scores(rfm.rfm(inputs.customer_orders(t)))


@query("m4_score_clusters")
def m4(t):
    scored = scored_customers(t)
    model = seg.fit_segments(scored, SCORES, k=4, scale=False)
    names = seg.name_by_rank(model, 2, ["bronze", "silver", "gold", "platinum"])
    return seg.profile(seg.assign(model, scored, names), SCORES, by="segment").select(
        "segment", "customers", *[F.round(c, 6).alias(c) for c in SCORES])


def customer_metrics(t):
    summary = rfm.rfm(inputs.customer_orders(t))
    return t.customer.select(F.col("c_custkey").alias("customer_id"), "c_acctbal").join(summary, "customer_id")


METRICS = ["c_acctbal", "frequency", "monetary_value"]


@query("m5_elbow")
def m5(t):
    return seg.elbow(customer_metrics(t), METRICS, range(2, 10))


@query("m6_segment_profiles")
def m6(t):
    rows = customer_metrics(t)
    model = seg.fit_segments(rows, METRICS, k=4)
    names = seg.name_by_rank(model, 2, ["low", "mid", "high", "top"])
    return seg.profile(seg.assign(model, rows, names), METRICS, by="segment").select(
        "segment", "customers", *[F.round(c, 4).alias(c) for c in METRICS])


@query("a17_cluster_means", """
WITH k AS (SELECT c_mktsegment, CAST(c_acctbal AS DECIMAL(18,2)) AS b, c_nationkey AS n FROM customer)
SELECT c_mktsegment AS cluster, count(*) AS customers, CAST(sum(b) AS DOUBLE) / count(*) AS balance, CAST(sum(n) AS DOUBLE) / count(*) AS nation FROM k GROUP BY 1""")
def a17(t):
    rows = t.customer.select(F.col("c_mktsegment").alias("cluster"), F.col("c_acctbal").cast("decimal(18,2)").alias("b"), "c_nationkey")
    return rows.groupBy("cluster").agg(
        F.count("*").alias("customers"), (F.sum("b").cast("double") / F.count("*")).alias("balance"),
        F.avg("c_nationkey").alias("nation"))


# ---- lifetime value ------------------------------------------------------------------------

def holdout(t):
    return rfm.rfm_holdout(inputs.customer_orders(t))


@query("m7_spend_model")
def m7(t):
    rows = holdout(t)
    model = clv.fit_spend(rows, 0.003, "frequency_cal", "monetary_value_cal")
    repeat = rows.filter("frequency_cal > 0 and monetary_value_cal > 0 and frequency_holdout > 0").withColumn(
        "expected", clv.expected_spend(model, "frequency_cal", "monetary_value_cal"))
    return repeat.agg(
        F.count("*").alias("customers"), F.round(clv.rmse(repeat, "monetary_value_holdout", "expected"), 2).alias("rmse"),
        *[F.lit(round(v, 4)).alias(k) for k, v in model.items()])


def retention(t, rows):
    model = clv.fit_retention(rows, 1.0, "frequency_cal", "recency_cal", "T_cal")
    predict = clv.expected_purchases(model, 90.0)
    cols = [F.col(c).cast("double") for c in ("frequency_cal", "recency_cal", "T_cal")]
    return model, rows.withColumn("expected", predict(*cols))


@query("m8_retention_model")
def m8(t):
    model, rows = retention(t, holdout(t))
    return rows.agg(
        F.count("*").alias("customers"), F.round(clv.rmse(rows, "frequency_holdout", "expected"), 4).alias("rmse"),
        F.round(F.sum("expected"), 3).alias("expected"), F.sum("frequency_holdout").alias("actual"),
        *[F.lit(round(v, 4)).alias(k) for k, v in model.items()])


@query("m9_lifetime_value")
def m9(t):
    summary = rfm.rfm(inputs.customer_orders(t))
    spend = clv.fit_spend(summary)
    keep = clv.fit_retention(summary)
    value = clv.lifetime_value(keep, spend)
    repeat = summary.filter("frequency > 0")
    return repeat.select("customer_id", value(*[
        F.col(c).cast("double") for c in ("recency", "frequency", "monetary_value", "T")]).alias("clv"))


@query("m10_calibration_curve")
def m10(t):
    _, rows = retention(t, holdout(t))
    since = rows.withColumn("quiet", F.col("T_cal") - F.col("recency_cal"))
    return rfm.calibration_curve(since, "quiet", "frequency_holdout", "expected")


# ---- classifiers ---------------------------------------------------------------------------

def classified(t):
    rows = t.documents.select("doc_id", "text", "source", F.col("n_chars").cast("double").alias("n_chars"), "lang")
    train, test = txt.split_by_key(rows, "doc_id", 0.33)
    model = txt.fit_text_model(train, ["text", "source"], ["n_chars"], "lang")
    return model, rows, test


@query("m16_text_classification")
def m16(t):
    model, _, test = classified(t)
    return txt.confusion(txt.predict_labels(model, test, "lang"), "lang")


@query("m17_label_codes", """
SELECT doc_id, lang, CAST(dense_rank() OVER (ORDER BY lang) - 1 AS DOUBLE) AS code FROM documents""")
def m17(t):
    return txt.encode_labels(t.documents.select("doc_id", "lang"), "lang", "code")


@query("m18_batch_inference")
def m18(t):
    model, rows, _ = classified(t)
    return txt.predict_labels(model, rows, "lang").select("doc_id", "lang", "predicted")


def propensity_training(t):
    """Labelled household and commodity rows of two past weeks with their 30-day features."""
    rows, keys = q_customers.tx(t), q_customers.pairs(t)
    features = pro.backfill(rows, keys, weeks=2, windows=["30d"], ratios=False)
    names = [c for c in features.columns if c not in ("household_key", "commodity_desc", "day")]
    days = [r[0] for r in features.select("day").distinct().collect()]  # the two backfilled days
    label = pro.labels(rows, keys, days).filter(F.col("will_by_in_30_days").isNotNull())
    return features.join(label, ["household_key", "commodity_desc", "day"]), features, names


@query("m26_classifier_selection")
def m26(t):
    rows, _, names = propensity_training(t)
    best, _, trials = txt.select_classifier(rows, "household_key", names, "will_by_in_30_days")
    each = F.array(*[F.struct(F.lit(n).alias("classifier"), F.lit(round(a, 6)).alias("auc"), F.lit(n == best).alias("chosen"))
                     for n, a in trials])
    return t.spark.range(1).select(F.inline(each))


@query("m27_propensity_scores")
def m27(t):
    rows, features, names = propensity_training(t)
    _, model, _ = txt.select_classifier(rows, "household_key", names, "will_by_in_30_days")
    return txt.scores(model, features, ["household_key", "commodity_desc", "day"], names)


@query("x5_probability_of_one")
def x5(t):
    """Class-1 probability for labelled documents."""
    rows = t.documents.join(t.labels, "doc_id").select(
        "doc_id", F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split("text", "\n")).cast("double").alias("lines"), F.col("quality").cast("double").alias("quality"))
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    model = Pipeline(stages=[
        VectorAssembler(inputCols=["n_chars", "lines"], outputCol="_features"),
        LogisticRegression(labelCol="quality", featuresCol="_features", maxIter=20)]).fit(rows)
    return txt.scores(txt.without_summary(model), rows, ["doc_id"], ["n_chars", "lines"], "probability")
