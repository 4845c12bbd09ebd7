"""Customer lifetime value: spend and retention models fitted with sums made in Spark.

Published models: Gamma-Gamma for the mean spend, Pareto/NBD for purchases
while a customer is alive. Each step of the parameter search is one Spark
aggregate over the customers that returns one number per candidate.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from millrace.scratch import materialise
from millrace.session import task_count

LogLik = Callable[[pd.DataFrame, np.ndarray], np.ndarray]


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling series after lifting the argument above 8."""
    x = np.asarray(x, dtype="float64")
    shift = np.zeros_like(x)
    z = x.copy()
    for _ in range(8):
        low = z < 8.0
        shift = shift - np.where(low, np.log(np.where(low, z, 1.0)), 0.0)
        z = np.where(low, z + 1.0, z)
    i = 1.0 / z
    i2 = i * i
    series = i * (1 / 12 - i2 * (1 / 360 - i2 * (1 / 1260 - i2 * (1 / 1680 - i2 / 1188))))
    return shift + (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + series


def gamma_gamma_loglik(rows: pd.DataFrame, params: np.ndarray) -> np.ndarray:
    p, q, v = params
    x, m = rows["x"].to_numpy(), rows["m"].to_numpy()
    return (log_gamma(p * x + q) - log_gamma(p * x) - log_gamma(np.array(q)) + q * np.log(v)
            + (p * x - 1) * np.log(m) + p * x * np.log(x) - (p * x + q) * np.log(x * m + v))


LIMIT = 10.0  # log parameters stay within +-LIMIT
NODES, WEIGHTS = np.polynomial.legendre.leggauss(40)


def _log_dead(x, tx, T, r, alpha, s, beta) -> np.ndarray:
    """log of the integral over the unobserved end of activity between the last purchase and now.

    s * int (alpha+y)^-(r+x) (beta+y)^-(s+1) dy by Gauss-Legendre on u = log(alpha+y).
    """
    lo, hi = np.log(alpha + tx), np.log(alpha + T)
    half, mid = (hi - lo) / 2, (hi + lo) / 2
    u = mid[:, None] + half[:, None] * NODES[None, :]
    y = np.exp(u) - alpha
    logs = (1 - (r + x))[:, None] * u - (s + 1) * np.log(beta + y)
    top = logs.max(axis=1)
    total = (np.exp(logs - top[:, None]) * WEIGHTS[None, :]).sum(axis=1)
    with np.errstate(divide="ignore"):
        return np.log(s) + top + np.log(np.maximum(half * total, 0.0))


def pareto_nbd_loglik(rows: pd.DataFrame, params: np.ndarray) -> np.ndarray:
    r, alpha, s, beta = params
    x, tx, T = (rows[c].to_numpy() for c in ("x", "tx", "T"))
    alive = -(r + x) * np.log(alpha + T) - s * np.log(beta + T)
    dead = _log_dead(x, tx, T, r, alpha, s, beta)
    return (log_gamma(r + x) - log_gamma(np.array(r)) + r * np.log(alpha) + s * np.log(beta)
            + np.logaddexp(alive, dead))


def summed(stats: DataFrame, loglik: LogLik, candidates: Sequence[np.ndarray]) -> np.ndarray:
    """Mean log-likelihood of every candidate in one pass; ``stats`` carries a weight ``n``."""
    tried = [np.exp(c) for c in candidates]

    def part(batches):
        totals = np.zeros(len(tried))
        weight = 0.0
        for rows in batches:
            if len(rows) == 0:
                continue
            w = rows["n"].to_numpy(dtype="float64")
            weight += w.sum()
            with np.errstate(all="ignore"):
                totals += [float((w * loglik(rows, p)).sum()) for p in tried]
        yield pd.DataFrame({"i": range(len(tried)), "total": totals, "weight": weight})

    rows = stats.mapInPandas(part, "i int, total double, weight double").groupBy("i").agg(
        F.sum("total").alias("total"), F.sum("weight").alias("weight")).collect()  # one row per candidate
    out = np.full(len(tried), -np.inf)
    for row in rows:
        if row["weight"] and np.isfinite(row["total"]):
            out[row["i"]] = row["total"] / row["weight"]
    return out


def _spread(stats: DataFrame, label: str) -> DataFrame:
    """Written once for all passes, in enough files to keep every core busy on little data."""
    return materialise(stats, label, task_count(stats.sparkSession))


def maximise(stats: DataFrame, loglik: LogLik, start: Sequence[float], penalty: float,
             rounds: int = 100, tolerance: float = 1e-7) -> np.ndarray:
    """Damped Newton search over log parameters; derivatives and step lengths are batched.

    A search that still gains after ``rounds`` steps raises.
    """
    d, h = len(start), 1e-3
    unit = np.eye(d) * h
    pairs = [(i, j) for i in range(d) for j in range(i + 1, d)]

    def value(points):
        return summed(stats, loglik, points) - penalty * np.array([np.sum(np.exp(p) ** 2) for p in points])

    def around(p):
        return [*[p + unit[i] for i in range(d)], *[p - unit[i] for i in range(d)],
                *[p + unit[i] + unit[j] for i, j in pairs]]

    at = np.log(np.asarray(start, dtype="float64"))
    f = value([at, *around(at)])
    for _ in range(rounds):
        here, up, down, cross = f[0], f[1:d + 1], f[d + 1:2 * d + 1], f[2 * d + 1:]
        slope = (up - down) / (2 * h)
        curve = np.diag((up - 2 * here + down) / h ** 2)
        for (i, j), c in zip(pairs, cross):
            curve[i, j] = curve[j, i] = (c - up[i] - up[j] + here) / h ** 2
        values, vectors = np.linalg.eigh(-curve)
        step = vectors @ ((vectors.T @ slope) / np.maximum(np.abs(values), 1e-4))
        step *= min(1.0, 2.0 / max(np.linalg.norm(step), 1e-12))
        uphill = slope / max(np.linalg.norm(slope), 1e-12)
        moves = [*[step * k for k in (1.0, 0.5, 0.2, 0.05)], *[uphill * k for k in (0.5, 0.1, 0.02)]]
        tries = [np.clip(at + m, -LIMIT, LIMIT) for m in moves]
        # the derivatives at the full step are asked for in the same pass: it is the usual winner
        g = value([*tries, *around(tries[0])])
        pick = int(np.argmax(g[:len(tries)]))
        gain = g[pick] - here
        if not gain > 0:
            break
        at = tries[pick]
        if gain < tolerance * (1.0 + abs(here)):
            break
        f = np.concatenate([g[:1], g[len(tries):]]) if pick == 0 else value([at, *around(at)])
    else:
        raise RuntimeError(f"no convergence in {rounds} steps; gradient {np.linalg.norm(slope):.3g}, gain {gain:.3g}")
    if not np.isfinite(f[0]):
        raise RuntimeError("the search found no finite likelihood")
    return np.exp(at)


# ---- spend ---------------------------------------------------------------------------------

def fit_spend(summary: DataFrame, penalty: float = 0.003, frequency: str = "frequency",
              value: str = "monetary_value") -> dict[str, float]:
    """Gamma-Gamma over repeat customers. Spend is divided by its mean while fitting, so that the
    penalty does not depend on the currency."""
    repeat = summary.filter((F.col(frequency) > 0) & (F.col(value) > 0)).select(
        F.col(frequency).cast("double").alias("x"), F.col(value).cast("double").alias("m"))
    unit = repeat.agg(F.avg("m")).first()[0]
    stats = _spread(repeat.select("x", (F.col("m") / unit).alias("m"), F.lit(1.0).alias("n")), "spend-stats")
    p, q, v = maximise(stats, gamma_gamma_loglik, [2.0, 2.0, 1.0], penalty)
    return {"p": float(p), "q": float(q), "v": float(v * unit)}


def expected_spend(model: dict[str, float], frequency: str | Column, value: str | Column) -> Column:
    """Expected mean spend given the purchases seen; a closed form, so no UDF."""
    x, m = (F.col(c) if isinstance(c, str) else c for c in (frequency, value))
    p, q, v = model["p"], model["q"], model["v"]
    return (F.lit(p) * (F.lit(v) + x * m) / (F.lit(p) * x + F.lit(q - 1.0))).cast("double")


# ---- retention -----------------------------------------------------------------------------

def fit_retention(summary: DataFrame, penalty: float = 1.0, frequency: str = "frequency",
                  recency: str = "recency", age: str = "T") -> dict[str, float]:
    """Pareto/NBD over the distinct (purchases, last purchase, age) triples with their counts."""
    longest = float(summary.agg(F.max(age)).first()[0] or 1.0)
    scale = 10.0 / max(longest, 1.0)
    triples = summary.groupBy(
        F.col(frequency).cast("double").alias("x"), (F.col(recency).cast("double") * scale).alias("tx"),
        (F.col(age).cast("double") * scale).alias("T")).agg(F.count("*").cast("double").alias("n"))
    stats = _spread(triples, "retention-stats")
    r, alpha, s, beta = maximise(stats, pareto_nbd_loglik, [1.0, 1.0, 1.0, 1.0], penalty)
    return {"r": float(r), "alpha": float(alpha / scale), "s": float(s), "beta": float(beta / scale)}


def _alive_and_rate(model, x, tx, T):
    r, alpha, s, beta = (model[k] for k in ("r", "alpha", "s", "beta"))
    alive = -(r + x) * np.log(alpha + T) - s * np.log(beta + T)
    dead = _log_dead(x, tx, T, r, alpha, s, beta)
    return 1.0 / (1.0 + np.exp(dead - alive)), (r + x) * (beta + T) / (alpha + T)


def purchases(model: dict[str, float], x, tx, T, t: float) -> np.ndarray:
    """Expected purchases in the next ``t`` days."""
    s, beta = model["s"], model["beta"]
    alive, rate = _alive_and_rate(model, x, tx, T)
    log_ratio = np.log((beta + T) / (beta + T + t))
    k = s - 1.0
    grown = -log_ratio if abs(k) < 1e-9 else -np.expm1(k * log_ratio) / k
    return alive * rate * grown


def expected_purchases(model: dict[str, float], days: float):
    """A vectorised function of (frequency, recency, T)."""
    @F.pandas_udf("double")
    def predict(frequency: pd.Series, recency: pd.Series, age: pd.Series) -> pd.Series:
        x, tx, T = (c.to_numpy(dtype="float64") for c in (frequency, recency, age))
        return pd.Series(purchases(model, x, tx, T, days))

    return predict


def probability_alive(model: dict[str, float]):
    @F.pandas_udf("double")
    def predict(frequency: pd.Series, recency: pd.Series, age: pd.Series) -> pd.Series:
        x, tx, T = (c.to_numpy(dtype="float64") for c in (frequency, recency, age))
        return pd.Series(_alive_and_rate(model, x, tx, T)[0])

    return predict


def lifetime_value(retention: dict[str, float], spend: dict[str, float], months: int = 36, discount: float = 0.01):
    """A vectorised function of (recency, frequency, monetary_value, T): discounted value of the
    expected purchases of each 30-day month."""
    @F.pandas_udf("double")
    def value(recency: pd.Series, frequency: pd.Series, monetary: pd.Series, age: pd.Series) -> pd.Series:
        tx, x, m, T = (c.to_numpy(dtype="float64") for c in (recency, frequency, monetary, age))
        p, q, v = spend["p"], spend["q"], spend["v"]
        each = p * (v + x * m) / (p * x + q - 1.0)
        total, before = np.zeros_like(x), np.zeros_like(x)
        for i in range(1, months + 1):
            now = purchases(retention, x, tx, T, 30.0 * i)
            total += each * (now - before) / (1.0 + discount) ** i
            before = now
        return pd.Series(np.round(total, 2))

    return value


def rmse(df: DataFrame, actual: str, predicted: str) -> Column:
    return F.sqrt(F.avg(F.pow(F.col(actual) - F.col(predicted), 2)))
