"""Properties of fitted models."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.analytics import clv, forecast as fc, rfm, segments as seg, textclass as txt
from millrace.queries import inputs
from millrace.scratch import scratch_path


def test_log_gamma():
    x = np.array([1e-3, 0.3, 1.0, 2.5, 7.9, 8.0, 55.5, 1e4])
    assert np.allclose(clv.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-12, atol=1e-12)


def test_pareto_nbd_integral_against_fine_steps():
    r, alpha, s, beta, x, tx, T = 0.6, 3.0, 0.8, 5.0, 4.0, 20.0, 60.0
    y = np.linspace(tx, T, 400001)
    f = (alpha + y) ** -(r + x) * (beta + y) ** -(s + 1)
    fine = math.log(s * float(((f[1:] + f[:-1]) / 2 * np.diff(y)).sum()))
    got = clv._log_dead(np.array([x]), np.array([tx]), np.array([T]), r, alpha, s, beta)[0]
    assert abs(got - fine) < 1e-8


def test_retention_parameters_are_recovered(spark):
    """Simulated customers: the fitted model predicts the next period of the same process."""
    rng = np.random.default_rng(7)
    n, T, ahead = 4000, 300.0, 90.0
    lam, mu = rng.gamma(1.2, 1 / 40.0, n), rng.gamma(1.5, 1 / 400.0, n)
    life = rng.exponential(1 / mu)
    data, later = [], 0
    for i in range(n):
        times = np.cumsum(rng.exponential(1 / lam[i], 400))
        times = times[times < min(life[i], T + ahead)]
        seen = times[times <= T]
        later += int((times > T).sum())
        data.append((float(len(seen)), float(seen[-1]) if len(seen) else 0.0, T))
    df = spark.createDataFrame(data, "frequency double, recency double, T double")
    model = clv.fit_retention(df, penalty=0.0)
    total = df.select(F.sum(clv.expected_purchases(model, ahead)("frequency", "recency", "T"))).first()[0]
    assert abs(total - later) / later < 0.08
    alive = df.select(clv.probability_alive(model)("frequency", "recency", "T").alias("p")).agg(F.min("p"), F.max("p")).first()
    assert 0 <= alive[0] <= alive[1] <= 1


def test_spend_model_recovers_the_mean(spark):
    rng = np.random.default_rng(3)
    n, p, q, v = 3000, 6.0, 4.0, 15.0
    x = rng.integers(1, 8, n)
    nu = rng.gamma(q, 1 / v, n)
    m = rng.gamma(p * x, 1 / (nu * x))
    df = spark.createDataFrame(pd.DataFrame({"frequency": x.astype(float), "monetary_value": m}))
    model = clv.fit_spend(df, penalty=0.0)
    assert abs(model["p"] * model["v"] / (model["q"] - 1) - p * v / (q - 1)) / (p * v / (q - 1)) < 0.1


def test_lifetime_value_rises_with_spend(spark):
    keep, spend = {"r": 0.5, "alpha": 60.0, "s": 0.5, "beta": 300.0}, {"p": 4.0, "q": 5.0, "v": 100.0}
    df = spark.createDataFrame([(200.0, 5.0, float(m), 220.0) for m in (10, 50, 250)], "r double, f double, m double, T double")
    got = [r[0] for r in df.select(clv.lifetime_value(keep, spend)("r", "f", "m", "T")).collect()]
    assert 0 <= got[0] < got[1] < got[2]


def test_forecast_shape_and_skill(spark):
    days = pd.date_range("2020-01-01", periods=1200, freq="D")
    t = np.arange(1200)
    rng = np.random.default_rng(0)
    base = (50 + 0.03 * t) * (1 + 0.3 * np.sin(2 * np.pi * t / 7)) * (1 + 0.2 * np.cos(2 * np.pi * t / 365.25))
    pdf = pd.concat([pd.DataFrame({"store": s, "item": 1, "date": days.date, "sales": np.round(base * s + rng.normal(0, 2, 1200)).astype(int)}) for s in (1, 2)])
    sales = spark.createDataFrame(pdf, "store int, item int, date date, sales int")
    out = fc.forecast(sales, ["store", "item"], horizon=30)
    assert out.count() == 2 * 1230 and out.filter("y is null").count() == 60
    assert out.filter("not (yhat_lower <= yhat and yhat <= yhat_upper)").count() == 0
    error = fc.rmse_by_lead(fc.backtest(sales, ["store"]), ["store"], 180).orderBy("store").collect()
    naive = fc.seasonal_naive(sales, ["store"]).groupBy("store").agg(
        F.sqrt(F.avg(F.pow(F.col("y") - F.col("yhat"), 2))).alias("e")).orderBy("store").collect()
    assert all(a["rmse"] < 1.6 * b["e"] for a, b in zip(error, naive))
    assert error[0]["rmse"] < 6


def one_series(spark, values, start="2020-01-01"):
    days = pd.date_range(start, periods=len(values), freq="D")
    rows = [(d.date(), int(v)) for d, v in zip(days, values) if v]  # days without sales have no row
    return spark.createDataFrame([(1, *r) for r in rows], "item int, date date, sales int")


def test_days_without_sales_count_as_such(spark):
    """70 a week on one day are 280 in four weeks, and they stand on that day, whichever form is fitted."""
    sales = one_series(spark, [70 if i % 7 == 3 else 0 for i in range(704)])
    for form in ("auto", "sparse", "demand"):
        rows = fc.forecast(sales, ["item"], 28, fc.Settings(form=form)).orderBy("ds").collect()
        later = [r for r in rows if r.y is None]
        assert abs(sum(r.yhat for r in later) - 280) < 3 and len(later) == 28
        assert [r.ds.weekday() for r in later if r.yhat > 35] == [rows[0].ds.weekday()] * 4
        assert sum(r.y for r in rows if r.y is not None) == 70 * 101 and all((b.ds - a.ds).days == 1 for a, b in zip(rows, rows[1:]))


def test_size_and_spacing_apart():
    rng = np.random.default_rng(3)
    day = np.arange(2000.0)
    y = np.where(rng.random(2000) < 0.1, rng.integers(20, 40, 2000), 0).astype(float)
    m = fc.SeriesModel(day, y, fc.Settings())
    out = m.predict(np.concatenate([day, 2000 + np.arange(60.0)]))
    assert m.sparse and not fc.SeriesModel(day, y + 1, fc.Settings()).sparse
    assert abs(out["yhat"][:2000].sum() / y.sum() - 1) < 1e-9 and 0.5 < out["yhat"][2000:].mean() / y.mean() < 2
    inside = (y >= out["yhat_lower"][:2000]) & (y <= out["yhat_upper"][:2000])
    assert inside.mean() > 0.93 and (out["yhat_upper"] >= out["yhat"]).all() and (out["yhat_lower"] == 0).all()
    assert out["yhat_upper"][2000:].mean() > 25  # a sale has its size, not the mean over all days


def test_trend_turns_where_it_did():
    rng = np.random.default_rng(1)
    t = np.arange(1200.0)
    level = np.where(t < 700, 50 + 0.05 * t, 85 + 0.2 * (t - 700))
    y = np.maximum(0, np.round(level + rng.normal(0, 3, 1200)))
    later = 1199 + np.arange(1, 61.0)
    truth = 85 + 0.2 * (later - 700)
    bent, straight = (fc.SeriesModel(t, y, fc.Settings(changes=n)) for n in (12, 0))
    assert np.abs(bent.mean(later) / truth - 1).max() < 0.05 < np.abs(straight.mean(later) / truth - 1).max()
    assert (np.abs(bent.turns) > 0.3).sum() <= 4 and len(bent.turns) == 12  # the others are shrunk to nothing
    wide, narrow = (m.predict(later) for m in (bent, straight))
    assert (wide["yhat_upper"] - wide["yhat_lower"]).iloc[-1] > (wide["yhat_upper"] - wide["yhat_lower"]).iloc[0]


def test_short_and_empty_series():
    for y in ([0.0] * 40, [5.0], [5.0, 0.0, 7.0], [4.0] * 30, [-3.0, 2.0, 0.0]):
        out = fc.SeriesModel(np.arange(float(len(y))), np.array(y), fc.Settings()).predict(np.arange(float(len(y) + 3)))
        assert np.isfinite(out.to_numpy()).all() and (out["yhat"] >= 0).all()
        assert abs(out["yhat"][:len(y)].sum() - np.maximum(y, 0).sum()) < 1e-6
    with pytest.raises(ValueError):
        fc.SeriesModel(np.arange(3.0), np.ones(3), fc.Settings(form="other"))


def test_backtest_beats_the_year_before(spark):
    rng = np.random.default_rng(5)
    t = np.arange(1500)
    busy = rng.poisson(20 * (1 + 0.4 * np.sin(2 * np.pi * t / 7)) * (1 + 0.3 * np.cos(2 * np.pi * t / 365.25)))
    slow = rng.poisson(0.15 * (1 + 0.4 * np.sin(2 * np.pi * t / 7))) * rng.integers(1, 9, 1500)
    slow[0] = slow[-1] = 1
    for values in (busy, slow):
        sales = one_series(spark, values)
        error = fc.rmse_by_lead(fc.backtest(sales, ["item"]), (), 180).first()["rmse"]
        naive = fc.seasonal_naive(sales, ["item"])
        assert naive.count() == 1500 - 364
        assert error < 0.85 * naive.select(F.sqrt(F.avg(F.pow(F.col("y") - F.col("yhat"), 2)))).first()[0]


def test_cutoffs_leave_room():
    cuts = fc.cutoffs(0, 1500, 730, 90, 180)
    assert cuts[0] == 1320 and cuts[-1] >= 730 and all(a - b == 90 for a, b in zip(cuts, cuts[1:]))
    assert fc.cutoffs(0, 800, 730, 90, 180) == []


def test_best_trial_is_the_smallest(spark):
    df = spark.createDataFrame([(1, 0, 3.0), (1, 1, 2.0), (2, 0, None), (2, 1, 9.0)], "s int, trial int, rmse double")
    assert sorted(map(tuple, fc.best_trial(df, ["s"]).collect())) == [(1, 1, 2.0), (2, 1, 9.0)]


def test_allocation_adds_up(t):
    out = fc.allocated_forecast(inputs.sales(t), horizon=10)
    whole = fc.forecast(inputs.sales(t), ["item"], horizon=10)
    a = out.groupBy("item").agg(F.sum("forecast").alias("f")).orderBy("item").collect()
    b = whole.groupBy("item").agg(F.sum("yhat").alias("f")).orderBy("item").collect()
    assert all(abs(x["f"] - y["f"]) < 1e-6 * max(1, y["f"]) for x, y in zip(a, b))


def test_elbow_falls_with_more_clusters(t):
    rows = t.customer.select(F.col("c_acctbal").alias("a"), F.col("c_nationkey").cast("double").alias("b"))
    best = [min(r) for r in zip(*[[x["inertia"] for x in seg.elbow(rows, ["a", "b"], range(2, 6), seed).orderBy("k").collect()] for seed in (1, 2)])]
    assert all(x >= y for x, y in zip(best, best[1:]))


def test_nearest_centre_equals_model(t):
    rows = t.customer.select("c_custkey", F.col("c_acctbal").alias("a"), F.col("c_nationkey").cast("double").alias("b"))
    model = seg.fit_segments(rows, ["a", "b"], k=3, scale=False)
    both = seg.assign(model, rows).withColumn("mine", seg.nearest_centre(seg.centres(model))("a", "b"))
    assert both.filter("cluster <> mine").count() == 0


def test_score_directions(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 13)], "x double")
    cuts = [2.0, 4.0, 6.0, 8.0, 10.0]
    got = df.select("x", rfm.score("x", cuts, True).alias("up"), rfm.score("x", cuts, False).alias("down")).collect()
    assert [r["up"] for r in got] == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5, 5, 5]
    assert [r["down"] for r in got] == [5, 4, 4, 3, 3, 2, 2, 1, 1, 1, 1, 1]


def test_text_classifier_beats_the_majority(t):
    rows = t.documents.select("doc_id", "text", "source", F.col("n_chars").cast("double").alias("n_chars"), "lang")
    train, test = txt.split_by_key(rows, "doc_id", 0.33)
    model = txt.fit_text_model(train, ["text", "source"], ["n_chars"], "lang", words=256, trees=10)
    guessed = txt.predict_labels(model, test, "lang")
    most = test.groupBy("lang").count().agg(F.max("count") / F.sum("count")).first()[0]
    assert txt.micro_f1(guessed) > most
    assert txt.confusion(guessed, "lang").agg(F.sum("n")).first()[0] == test.count()


def test_classifier_choice_and_scores(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 2))
    y = (x[:, 0] + 0.3 * rng.normal(size=600) > 0).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"id": range(600), "a": x[:, 0], "b": x[:, 1], "y": y}))
    best, model, trials = txt.select_classifier(df, "id", ["a", "b"], "y")
    assert dict(trials)[best] == max(a for _, a in trials) > 0.9
    s = txt.scores(model, df, ["id"], ["a", "b"]).agg(F.min("propensity_score"), F.max("propensity_score"), F.count("*")).first()
    assert 0 <= s[0] < s[1] <= 1 and s[2] == 600


def test_forest_rows_do_not_grow_with_the_vocabulary(spark):
    """Every word counts, but a row of the forest holds a number per class and numeric column only."""
    rows = [(f"{'red' if i % 2 else 'blue'} w{i % 400} v{i % 37}", "web", float(i % 5), "a" if i % 2 else "b") for i in range(800)]
    df = spark.createDataFrame(rows, "text string, source string, n double, lang string")
    model = txt.fit_text_model(df, ["text", "source"], ["n"], "lang", trees=5)
    assert len(model.stages[3].vocabulary) > 400
    assert model.stages[-1].numFeatures <= 3 + 1  # two labels, that of rows without one, and n
    assert txt.micro_f1(txt.predict_labels(model, df, "lang")) == 1.0


def test_training_rows_of_a_task_are_bounded(spark):
    """Rows that pack well do not all go to the few tasks of a scan; few rows stay as they are."""
    path = scratch_path(spark, "packed")
    spark.range(20_000).selectExpr("id AS household_key", "0.0D AS x").coalesce(1).write.parquet(path)
    rows = spark.read.parquet(path)
    sizes = [r["count"] for r in txt.dealt(rows, "household_key", 500).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 20_000 and len(sizes) == 40 and max(sizes) < 2 * 500
    assert txt.dealt(rows, "household_key", 50_000) is rows


def test_classifiers_share_one_kept_table(spark, monkeypatch):
    """Vectors are made and dealt before the fits, which read them from disk, and nothing stays kept afterwards."""
    seen = []
    plain = txt.candidates

    class Watched:
        def __init__(self, classifier):
            self.classifier = classifier

        def fit(self, rows):
            plan = rows._jdf.queryExecution().executedPlan().toString()
            seen.append(("InMemoryTableScan" in plan, "_features" in rows.columns))
            return self.classifier.fit(rows)

    monkeypatch.setattr(txt, "candidates", lambda *a: {n: Watched(c) for n, c in plain(*a).items()})
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    df = spark.createDataFrame([(i, float(i % 7), None if i % 5 else 1.0, int(i % 7 > 3)) for i in range(300)], "id long, a double, b double, y int")
    _, model, _ = txt.select_classifier(df, "id", ["a", "b"], "y")
    assert seen == [(True, True)] * 3
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
    assert txt.scores(model, df, ["id"], ["a", "b"]).count() == 300


def test_classifiers_after_observed_metrics(spark):
    """A session that has observed metrics cannot be sent to tasks, so no model may hold it."""
    from pyspark.sql import Observation
    rows = spark.range(200).selectExpr("id", "cast(id % 2 AS double) AS y", "id % 2 + (id % 7) / 7 AS x", "id % 5 AS z")
    rows.observe(Observation(), F.count(F.lit(1)).alias("n")).collect()
    name, model, trials = txt.select_classifier(rows, "id", ["x", "z"], "y")
    assert len(trials) > 1 and model.transform(rows).count() == 200
