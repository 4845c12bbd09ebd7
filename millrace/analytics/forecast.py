"""Many small demand forecasts: one model per series, fitted inside Spark tasks.

A series is its calendar: days without sales are zeros, from its first day to its last. Expected demand is the product of a trend, a weekly
and a yearly factor, fitted by quasi-Poisson regression on the logarithm of the mean, so zeros need no special care, trend and seasons
act as factors, and expected and observed totals of the history agree. The trend is piecewise linear with change points that are
shrunk towards none (a Laplace prior, by reweighted least squares).

Series that sell on fewer than ``SPARSE`` of their days are fitted in two parts: how often they sell (spacing) and how much they sell then (size),
each with the same kind of regression.

Intervals: for history days the spread around the mean; for later days also trend changes drawn as often and as large as those found.
Input columns: the series keys, ``date`` and ``sales``.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from millrace.operators.aggregates import share_of_total
from millrace.operators.tables import keyed_join
from millrace.session import task_count

YEAR, WEEK = 365.25, 7.0
TAIL = 0.025  # beyond each end of a 95 % interval
Z95 = NormalDist().inv_cdf(1 - TAIL)
SPARSE = 0.5
FORMS = ("auto", "demand", "sparse")
_LEVELS = np.linspace(0.0005, 0.9995, 2000)
_NORMAL = np.array([NormalDist().inv_cdf(p) for p in _LEVELS])


@dataclass(frozen=True)
class Settings:
    weekly: int = 3
    yearly: int = 4
    ridge: float = 1.0
    growth: bool = True
    changes: int = 12  # places where the trend may turn, over the first four fifths of the history
    flexibility: float = 0.05  # scale of a turn; smaller means a straighter trend
    form: str = "auto"
    paths: int = 300  # drawn futures


def daily_series(sales: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Daily totals. A series then has one row per calendar day at most, however many sales it had."""
    return sales.groupBy(*keys, "date").agg(F.sum("sales").cast("double").alias("sales"))


def calendar(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Day numbers from the first to the last day of a series, and the sales of each; days without rows have none."""
    day = _days(pdf["date"])
    every = np.arange(day.min(), day.max() + 1)
    sold = np.zeros(len(every))
    np.add.at(sold, (day - day.min()).astype(int), np.nan_to_num(pdf["sales"].to_numpy(dtype="float64")))
    return every, sold


class Terms:
    """Columns of the regression for any day: level, trend and its turns, weekly and yearly waves."""

    def __init__(self, first: float, last: float, s: Settings):
        self.first, self.span = first, max(last - first, 1.0)
        self.weekly = s.weekly if last - first + 1 >= 2 * WEEK else 0
        self.yearly = s.yearly if last - first + 1 >= 2 * YEAR else 0  # from a shorter history a year is no season
        turns = min(s.changes, int(self.span // 28)) if s.growth else 0
        self.turns = np.linspace(0, 0.8, turns + 2)[1:-1]
        self.n_trend = 1 + (1 + turns if s.growth else 0)
        self.n_weekly = self.n_trend + 2 * self.weekly
        self.growth = s.growth

    def __call__(self, day: np.ndarray) -> np.ndarray:
        at = (day - self.first) / self.span
        cols = [np.ones_like(day)]
        if self.growth:
            cols += [at, *[np.maximum(0.0, at - c) for c in self.turns]]
        for period, order in ((WEEK, self.weekly), (YEAR, self.yearly)):
            for k in range(1, order + 1):
                angle = 2 * np.pi * k * day / period
                cols += [np.sin(angle), np.cos(angle)]
        return np.column_stack(cols)


class Regression:
    """exp(x @ beta) as the mean of y >= 0, variance in proportion to the mean."""

    def __init__(self, x: np.ndarray, y: np.ndarray, terms: Terms, s: Settings):
        p = x.shape[1]
        total = y.sum()
        self.beta, self.spread, self.covariance = np.zeros(p), 1.0, np.zeros((p, p))
        if total <= 0:
            self.beta[0] = -30.0
            return
        turn = slice(2, terms.n_trend) if s.growth else slice(0, 0)
        weight = np.full(p, s.ridge)
        weight[0] = 0.0  # the level is never shrunk, so totals agree
        weight[turn] = 1.0 / s.flexibility
        beta = np.zeros(p)
        beta[0] = np.log(total / len(y))
        spread = max(float(((y - y.mean()) ** 2 / y.mean()).mean()), 1e-9)
        for step in range(60):
            mu = np.exp(np.clip(x @ beta, -30, 30))
            gram = (x * (mu / spread)[:, None]).T @ x
            move = np.linalg.solve(gram + np.diag(weight + 1e-12), x.T @ (y - mu) / spread - weight * beta)
            move *= min(1.0, 2.0 / max(np.abs(x @ move).max(), 1e-300))  # no day moves by more than a factor of e ** 2
            beta = beta + move
            if step < 8:  # then prior and spread stay, and the steps converge
                weight[turn] = 1.0 / (s.flexibility * np.maximum(np.abs(beta[turn]), 1e-3))
                spread = max(float(((y - mu) ** 2 / np.maximum(mu, 1e-12)).sum() / max(len(y) - p, 1)), 1e-9)
            elif np.abs(x @ move).max() < 1e-9:
                break
        self.beta, self.spread = beta, spread
        mu = np.exp(np.clip(x @ beta, -30, 30))
        self.covariance = np.linalg.pinv((x * (mu / spread)[:, None]).T @ x + np.diag(weight + 1e-9))

    def log_mean(self, x: np.ndarray) -> np.ndarray:
        return np.clip(x @ self.beta, -30, 30)


def _quantile(mean: np.ndarray, spread: float, z: np.ndarray | float) -> np.ndarray:
    """Quantiles of a quantity whose root varies evenly: a variance in proportion to the mean."""
    return np.maximum(0.0, np.sqrt(mean) + z * np.sqrt(spread) / 2) ** 2


def _normal(level: np.ndarray) -> np.ndarray:
    return np.interp(level, _LEVELS, _NORMAL)


class SeriesModel:
    """One fitted series: every day of its calendar with its sales."""

    def __init__(self, day: np.ndarray, y: np.ndarray, s: Settings, seed: int = 0):
        if s.form not in FORMS:
            raise ValueError(f"unknown form {s.form}")
        self.s, self.seed, self.last = s, seed, day[-1]
        y = np.maximum(y, 0.0)
        self.terms = Terms(day[0], day[-1], s)
        x = self.terms(day)
        sold = y > 0
        self.sparse = s.form == "sparse" or (s.form == "auto" and sold.mean() < SPARSE)
        if self.sparse:
            self.parts = [Regression(x, sold.astype(float), self.terms, s), Regression(x[sold], y[sold], self.terms, s) if sold.any() else Regression(x, y, self.terms, s)]
        else:
            self.parts = [Regression(x, y, self.terms, s)]
        made = np.exp(sum(r.log_mean(x) for r in self.parts)).sum()
        self.factor = float(y.sum() / made) if made > 0 else 0.0  # 1 but for rounding where one part is fitted
        self.turns = sum(r.beta[2: self.terms.n_trend] for r in self.parts) if s.growth else np.zeros(0)

    def _part(self, x: np.ndarray, a: int, b: int) -> np.ndarray:
        return sum(x[:, a:b] @ r.beta[a:b] for r in self.parts)

    def predict(self, day: np.ndarray) -> pd.DataFrame:
        t, x = self.terms, self.terms(day)
        yhat = self.factor * np.exp(sum(r.log_mean(x) for r in self.parts))
        lower, upper = self._spread(x, np.zeros((1, len(day))))
        later = np.flatnonzero(day > self.last)
        if len(later):
            lower[later], upper[later] = self._drawn(x[later], day[later])
        return pd.DataFrame({
            "trend": self.factor * np.exp(np.clip(self._part(x, 0, t.n_trend), -60, 60)),
            "weekly": np.expm1(self._part(x, t.n_trend, t.n_weekly)),
            "yearly": np.expm1(self._part(x, t.n_weekly, x.shape[1])),
            "yhat": yhat, "yhat_lower": np.minimum(lower, yhat), "yhat_upper": np.maximum(upper, yhat),
        })

    def mean(self, day: np.ndarray) -> np.ndarray:
        return self.factor * np.exp(sum(r.log_mean(self.terms(day)) for r in self.parts))

    def _spread(self, x: np.ndarray, moved: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ends of the interval without trend changes to come; ``moved`` shifts the logarithm of the mean."""
        size = self.parts[-1]
        mean = np.exp(size.log_mean(x) + moved[0])
        unsure = np.sqrt(np.maximum(np.einsum("ij,jk,ik->i", x, size.covariance, x), 0.0))
        if not self.sparse:
            spread = size.spread + 4 * mean * (unsure / 2) ** 2
            return self.factor * _quantile(mean, spread, -Z95), self.factor * _quantile(mean, spread, Z95)
        chance = np.clip(np.exp(self.parts[0].log_mean(x)), 1e-12, 1.0)
        low = np.where(1 - chance >= TAIL, 0.0, _quantile(mean, size.spread, _normal(np.clip((TAIL - (1 - chance)) / chance, 0, 1))))
        high = np.where(chance <= TAIL, 0.0, _quantile(mean, size.spread, _normal(np.clip(1 - TAIL / chance, 0, 1))))
        return self.factor * low, self.factor * high

    def _drawn(self, x: np.ndarray, day: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ends of the interval over drawn futures, in which the trend turns as often and as much as it did."""
        rng = np.random.default_rng(self.seed)
        n, paths = len(day), self.s.paths
        ahead = (day - self.last) / self.terms.span
        bent = np.zeros((paths, n))
        if len(self.turns):
            # the whole span holds as many turns as there are places for them
            rate = len(self.turns) / 0.8 / self.terms.span
            turn = rng.random((paths, n)) < rate
            slope = np.where(turn, rng.laplace(0.0, max(float(np.abs(self.turns).mean()), 1e-12), (paths, n)), 0.0)
            bent = np.cumsum(np.cumsum(slope, axis=1) * np.diff(ahead, prepend=0.0), axis=1)
        size = self.parts[-1]
        values, vectors = np.linalg.eigh(size.covariance)
        noise = x @ (vectors * np.sqrt(np.maximum(values, 0.0))) @ rng.standard_normal((x.shape[1], paths))
        mean = np.exp(np.clip(size.log_mean(x) + bent + noise.T, -30, 30))
        y = self.factor * _quantile(mean, size.spread, rng.standard_normal((paths, n)))
        if self.sparse:
            y *= rng.random((paths, n)) < np.exp(self.parts[0].log_mean(x))
        return np.quantile(y, TAIL, axis=0), np.quantile(y, 1 - TAIL, axis=0)


def _seed(keys: Sequence) -> int:
    """The same draws for a series wherever and whenever it is fitted."""
    return zlib.crc32("|".join(map(str, keys)).encode())


def _days(dates: pd.Series) -> np.ndarray:
    return (pd.to_datetime(dates) - pd.Timestamp("1970-01-01")).dt.days.to_numpy(dtype="float64")


def _key_ddl(df: DataFrame, keys: Sequence[str]) -> str:
    kinds = dict(df.dtypes)
    return ", ".join(f"{k} {kinds[k]}" for k in keys)


def _tasks(df: DataFrame, tasks: int | None) -> int:
    return tasks or task_count(df.sparkSession)


def forecast(sales: DataFrame, keys: Sequence[str], horizon: int = 90, settings: Settings = Settings(),
             tasks: int | None = None) -> DataFrame:
    """Every calendar day of the history and the next ``horizon`` days of every series.

    The explicit partition count keeps many cheap-to-move, expensive-to-fit
    groups from being coalesced into a few tasks.
    """
    series = daily_series(sales, keys)
    keys = list(keys)
    out = ["trend", "weekly", "yearly", "yhat", "yhat_lower", "yhat_upper"]

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        day, sold = calendar(pdf)
        model = SeriesModel(day, sold, settings, _seed([pdf[k].iloc[0] for k in keys]))
        all_days = np.concatenate([day, day[-1] + np.arange(1, horizon + 1)])
        res = model.predict(all_days)
        res.insert(0, "y", np.concatenate([sold, np.full(horizon, np.nan)]))
        res["y"] = res["y"].astype(object).where(res["y"].notna(), None)
        res.insert(0, "ds", (pd.Timestamp("1970-01-01") + pd.to_timedelta(all_days, unit="D")).date)
        for k in reversed(keys):
            res.insert(0, k, pdf[k].iloc[0])
        return res

    ddl = f"{_key_ddl(series, keys)}, ds date, y double, " + ", ".join(f"{c} double" for c in out)
    return series.repartition(_tasks(series, tasks), *keys).groupBy(*keys).applyInPandas(fit, ddl)


def allocated_forecast(sales: DataFrame, item: str = "item", store: str = "store", horizon: int = 90,
                       settings: Settings = Settings()) -> DataFrame:
    """Forecast per item, spread over stores by their share of the item's sales."""
    by_item = forecast(sales, [item], horizon, settings)
    sold = sales.groupBy(store, item).agg(F.sum("sales").alias("_sold"))
    shares = share_of_total(sold, [item], "_sold", "_ratio").drop("_sold")
    return keyed_join(by_item, shares, [item]).select(
        F.col("ds").alias("date"), store, item, (F.col("y") * F.col("_ratio")).alias("sales"),
        (F.col("yhat") * F.col("_ratio")).alias("forecast"))


def cutoffs(first: float, last: float, initial: int, period: int, horizon: int) -> list[float]:
    """Rolling origins, newest first, that leave ``horizon`` days after and ``initial`` days before."""
    out = []
    at = last - horizon
    while at >= first + initial:
        out.append(at)
        at -= period
    return out


def _errors(day, y, s: Settings, initial, period, horizon) -> pd.DataFrame:
    parts = []
    for cut in cutoffs(day[0], day[-1], initial, period, horizon):
        past, ahead = day <= cut, (day > cut) & (day <= cut + horizon)
        if not ahead.any():
            continue
        yhat = SeriesModel(day[past], y[past], s).mean(day[ahead])
        parts.append(pd.DataFrame({"cutoff": cut, "lead": day[ahead] - cut, "y": y[ahead], "yhat": yhat}))
    return pd.concat(parts) if parts else pd.DataFrame({"cutoff": [], "lead": [], "y": [], "yhat": []})


def backtest(sales: DataFrame, keys: Sequence[str], initial: int = 730, period: int = 90, horizon: int = 180,
             settings: Settings = Settings(), tasks: int | None = None) -> DataFrame:
    """One row per series, rolling origin and later day: the forecast next to what was sold.

    The origins of a series are walked inside its group, so its history is not
    copied once per origin through the shuffle.
    """
    series, keys = daily_series(sales, keys), list(keys)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        res = _errors(*calendar(pdf), settings, initial, period, horizon)
        res = res.assign(cutoff=(pd.Timestamp("1970-01-01") + pd.to_timedelta(res["cutoff"], unit="D")).dt.date,
                         lead=res["lead"].astype("int32"))
        for k in reversed(keys):
            res.insert(0, k, pdf[k].iloc[0])
        return res

    ddl = f"{_key_ddl(series, keys)}, cutoff date, lead int, y double, yhat double"
    return series.repartition(_tasks(series, tasks), *keys).groupBy(*keys).applyInPandas(run, ddl)


def rmse_by_lead(errors: DataFrame, keys: Sequence[str] = (), bucket: int = 30) -> DataFrame:
    """Root mean squared error by days ahead."""
    lead = (F.ceil(F.col("lead") / bucket) * bucket).cast("int").alias("days_ahead")
    return errors.groupBy(*keys, lead).agg(
        F.count("*").alias("n"), F.sqrt(F.avg(F.pow(F.col("y") - F.col("yhat"), 2))).alias("rmse"))


GRID = [Settings(w, y, r) for w in (2, 3) for y in (2, 6) for r in (0.1, 1.0, 10.0)]


def search(sales: DataFrame, keys: Sequence[str], grid: Sequence[Settings] = GRID, initial: int = 730,
           period: int = 90, horizon: int = 180, tasks: int | None = None) -> DataFrame:
    """Backtest error of every setting for every series; trials of a series run in parallel."""
    series, keys = daily_series(sales, keys), list(keys)
    tried = list(grid)
    spread = series.withColumn("trial", F.explode(F.array(*[F.lit(i) for i in range(len(tried))])))
    by = [*keys, "trial"]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        head = pdf.iloc[0]
        s = tried[int(head["trial"])]
        e = _errors(*calendar(pdf), s, initial, period, horizon)
        res = pd.DataFrame({"rmse": [float(np.sqrt(((e["y"] - e["yhat"]) ** 2).mean())) if len(e) else None],
                            "weekly": [s.weekly], "yearly": [s.yearly], "ridge": [s.ridge]})
        for k in reversed(by):
            res.insert(0, k, head[k])
        return res

    ddl = f"{_key_ddl(spread, by)}, rmse double, weekly int, yearly int, ridge double"
    return spread.repartition(_tasks(series, tasks), *by).groupBy(*by).applyInPandas(run, ddl)


def best_trial(results: DataFrame, keys: Sequence[str]) -> DataFrame:
    rest = [c for c in results.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct("rmse", "trial"))
    return results.filter("rmse is not null").groupBy(*keys).agg(best.alias("_b")).select(
        *keys, *[F.col(f"_b.{c}").alias(c) for c in rest])


def seasonal_naive(sales: DataFrame, keys: Sequence[str], lag_days: int = 364) -> DataFrame:
    """The same weekday a year before, as a yardstick, for every calendar day that has one in its series."""
    series = daily_series(sales, keys)
    ends = series.groupBy(*keys).agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    every = (ends.filter(F.date_add("lo", lag_days) <= F.col("hi"))
             .select(*keys, F.explode(F.sequence(F.date_add("lo", lag_days), "hi")).alias("date")))
    past = series.select(*keys, F.date_add("date", lag_days).alias("date"), F.col("sales").alias("_past"))
    return (keyed_join(keyed_join(every, series, [*keys, "date"], "left"), past, [*keys, "date"], "left")
            .select(*keys, "date", F.coalesce("sales", F.lit(0.0)).alias("y"), F.coalesce("_past", F.lit(0.0)).alias("yhat")))
