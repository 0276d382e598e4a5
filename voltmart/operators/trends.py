"""Piecewise trend with day, week and year seasons, and backtests at many cutoffs from one pass over the series.

Both reduce each task's rows to matrices of products, which add up: a fit needs the sum over its rows, not the rows. So one
pass serves any number of cutoffs (the sum up to a cutoff is a difference of prefix sums), and no task holds a series.
"""

from __future__ import annotations

import datetime as dt
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from voltmart.functions.quantile import join_small
from voltmart.operators.forecasting import (
    INTERVAL_Z, _design, _design_columns, backtest_metrics, future_steps,
)
from voltmart.session import materialize

#: (period in days, number of sine and cosine pairs)
SEASONS = ((1.0, 4), (7.0, 3), (365.25, 10))
KNOTS, KNOT_RANGE = 25, 0.8
_DAY = 86400.0


def _sums(rows: DataFrame, keys: Sequence[str], design: Callable[[pd.DataFrame], np.ndarray], fan_in: int = 64) -> DataFrame:
    """``keys, n, products``: per key the matrix of products of the design's columns and ``y``, row by row in an array.

    Each task sends a matrix per key, and those are added in two levels.
    """
    kinds = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)
    schema = f"{kinds}, part long, n long, products array<double>"

    def reduce_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, sums = TaskContext.get().partitionId(), {}

        def flush() -> pd.DataFrame:
            out = pd.DataFrame(list(sums), columns=list(keys))
            out["part"], out["n"] = part, [s[0] for s in sums.values()]
            out["products"] = [s[1].ravel() for s in sums.values()]
            sums.clear()
            return out

        for batch in batches:
            for key, group in batch.groupby(list(keys), dropna=False):
                m = np.column_stack([design(group), group["y"].to_numpy()])
                entry = sums.setdefault(key, [0, 0.0])
                entry[0] += len(group)
                entry[1] = entry[1] + m.T @ m
            if len(sums) > 1000:
                yield flush()
        if sums:
            yield flush()

    def add(group: pd.DataFrame) -> pd.DataFrame:
        out = group.iloc[:1].copy()
        out["n"], out["products"] = [int(group["n"].sum())], [np.sum(np.stack(group["products"].to_numpy()), axis=0)]
        return out

    partial = rows.mapInPandas(reduce_rows, schema)
    lanes = partial.groupBy(*keys, (F.col("part") % fan_in).alias("_lane")).applyInPandas(add, schema)
    return lanes.groupBy(*keys).applyInPandas(add, schema).drop("part")


def _square(products: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    size = int(round(np.sqrt(len(products))))
    both = np.asarray(products).reshape(size, size)
    return both[:-1, :-1], both[:-1, -1], float(both[-1, -1])


# ---------------------------------------------------------------------------
# Piecewise trend
# ---------------------------------------------------------------------------


def _angles(seasons) -> list[float]:
    return [2.0 * np.pi * k / period for period, order in seasons for k in range(1, order + 1)]


def _piecewise(days: np.ndarray, first: float, last: float, knots: np.ndarray, seasons) -> np.ndarray:
    """Constant, place in the training range, what lies behind each knot, sine and cosine pairs."""
    u = (days - first) / (last - first)
    waves = [f(a * (days - first)) for a in _angles(seasons) for f in (np.sin, np.cos)]
    return np.column_stack([np.ones_like(u), u, np.maximum(0.0, u[:, None] - knots), *waves])


def knot_places(count: int = KNOTS) -> np.ndarray:
    """Evenly over the first part of the training range, without its beginning."""
    return KNOT_RANGE * np.arange(1, count + 1) / count if count else np.zeros(0)


def sparse_solution(
    gram: np.ndarray, moment: np.ndarray, ridge: np.ndarray, sparse: np.ndarray, share: float, sweeps: int = 20_000
) -> tuple[np.ndarray, float, float]:
    """(coefficients, penalty, residual) of least squares with ``ridge`` on squares and a penalty on absolute values.

    ``sparse`` marks the columns under the absolute penalty, which is ``share`` of the least penalty that makes all of
    them zero. The other columns are eliminated first; the rest is solved by coordinate descent until the optimality
    conditions hold. ``residual`` is the largest violation of those, relative to the largest moment.
    """
    free = ~sparse
    full = gram + np.diag(ridge)
    inner = np.linalg.solve(full[np.ix_(free, free)], np.column_stack([full[np.ix_(free, sparse)], moment[free]]))
    g = full[np.ix_(sparse, sparse)] - full[np.ix_(sparse, free)] @ inner[:, :-1]
    c = moment[sparse] - full[np.ix_(sparse, free)] @ inner[:, -1]
    penalty = share * float(np.abs(c).max(initial=0.0))
    change, scale = np.zeros(len(c)), float(np.abs(moment).max(initial=1e-300))
    for sweep in range(sweeps):
        for j in range(len(c)):
            rest = c[j] - g[j] @ change + g[j, j] * change[j]
            change[j] = np.sign(rest) * max(abs(rest) - penalty, 0.0) / g[j, j] if g[j, j] > 0 else 0.0
        if sweep % 20 == 0 and _violation(c - g @ change, change, penalty) <= 1e-9 * scale:
            break
    coef = np.empty(len(moment))
    coef[sparse], coef[free] = change, inner[:, -1] - inner[:, :-1] @ change
    slope = moment - full @ coef
    worst = max(_violation(slope[sparse], change, penalty), float(np.abs(slope[free]).max(initial=0.0)))
    return coef, penalty, worst / scale


def _violation(slope: np.ndarray, change: np.ndarray, penalty: float) -> float:
    """How far the slopes are from the penalty's sign where a change is there, or beyond the penalty where none is."""
    off = np.where(change != 0, np.abs(slope - penalty * np.sign(change)), np.maximum(np.abs(slope) - penalty, 0.0))
    return float(off.max(initial=0.0))


def fit_piecewise(
    df: DataFrame, ts: str, value: str, min_rows: int = 100, knots: int = KNOTS, share: float = 0.02, ridge: float = 1e-3,
    seasons: Sequence[tuple[float, int]] = SEASONS,
) -> DataFrame:
    """Per zone: ``zone, n, first, last, coef, sigma, change, residual``; zones with fewer than ``min_rows`` values drop out.

    The trend may bend at ``knots`` places in the first four fifths of the zone's own range; an absolute penalty leaves few
    bends (``change``: their mean size). Seasons get a small ridge. NULL values and stamps are left out.
    """
    days = (F.col(ts).cast("timestamp").cast("double") / _DAY).alias("d")
    rows = materialize(df.select("zone", days, F.col(value).cast("double").alias("y")).filter("y IS NOT NULL AND d IS NOT NULL"))
    bounds = rows.groupBy("zone").agg(F.min("d").alias("first"), F.max("d").alias("last"), F.count("*").alias("_n"))
    usable = materialize(bounds.filter((F.col("_n") >= min_rows) & (F.col("last") > F.col("first"))))
    places, seasons = knot_places(knots), tuple(seasons)
    width = 2 + len(places) + 2 * len(_angles(seasons))
    sparse = np.arange(width)
    sparse = (sparse >= 2) & (sparse < 2 + len(places))

    def design(group: pd.DataFrame) -> np.ndarray:
        return _piecewise(group["d"].to_numpy(), group["first"].iloc[0], group["last"].iloc[0], places, seasons)

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        n = int(group["n"].iloc[0])
        gram, moment, energy = _square(group["products"].iloc[0])
        penalty = np.where(np.arange(width) >= 2 + len(places), ridge, 1e-9)
        coef, _, residual = sparse_solution(gram / n, moment / n, penalty, sparse, share)
        rss = max(0.0, energy - 2 * coef @ moment + coef @ gram @ coef)
        return pd.DataFrame(
            {"zone": [group["zone"].iloc[0]], "n": [n], "coef": [coef], "sigma": [float(np.sqrt(rss / n))],
             "change": [float(np.abs(coef[sparse]).mean()) if len(places) else 0.0], "residual": [residual]}
        )

    sums = _sums(join_small(rows, usable.drop("_n"), ["zone"]), ["zone"], design)
    solved = sums.groupBy("zone").applyInPandas(
        solve, "zone string, n long, coef array<double>, sigma double, change double, residual double"
    )
    return solved.join(usable.drop("_n"), "zone")


def _piecewise_columns(ts: str, knots: int, seasons) -> Column:
    d = F.col(ts).cast("timestamp").cast("double") / _DAY - F.col("first")
    u = d / (F.col("last") - F.col("first"))
    bends = [F.greatest(F.lit(0.0), u - F.lit(float(k))) for k in knot_places(knots)]
    return F.array(F.lit(1.0), u, *bends, *[f(F.lit(a) * d) for a in _angles(seasons) for f in (F.sin, F.cos)])


def predict_piecewise(
    df: DataFrame, model: DataFrame, ts: str, knots: int = KNOTS, seasons: Sequence[tuple[float, int]] = SEASONS
) -> DataFrame:
    """Add ``yhat`` and the 80 % band of the noise; the dot product runs in the JVM. Zones without a model drop out."""
    joined = join_small(df, model.select("zone", "first", "last", "coef", "sigma"), ["zone"])
    products = F.zip_with("coef", _piecewise_columns(ts, knots, seasons), lambda a, b: a * b)
    yhat = F.aggregate(products, F.lit(0.0), lambda a, x: a + x)
    return joined.withColumn("yhat", yhat).withColumns(
        {
            "yhat_lower": F.col("yhat") - INTERVAL_Z * F.col("sigma"),
            "yhat_upper": F.col("yhat") + INTERVAL_Z * F.col("sigma"),
        }
    ).drop("first", "last", "coef", "sigma")


def forecast_piecewise(
    df: DataFrame, model: DataFrame, ts: str, steps: int = 96, minutes: int = 15, paths: int = 400, seed: int = 42,
    knots: int = KNOTS, seasons: Sequence[tuple[float, int]] = SEASONS,
) -> DataFrame:
    """``zone, ts, step, yhat, yhat_lower, yhat_upper`` for the ``steps`` stamps behind each zone's last one.

    The band is simulated: the trend may bend again as often and as much as it did in the past (bends at random places,
    Laplace sizes of the mean past size), and noise is added; its ends are the 10 % and 90 % quantiles over ``paths``
    paths. Random numbers depend on the seed and the zone only. A task holds the steps of one zone.
    """
    grid = predict_piecewise(future_steps(df, ts, steps, minutes), model, ts, knots, seasons).select("zone", ts, "step", "yhat")
    spread = materialize(model.select("zone", "last", (F.col("last") - F.col("first")).alias("span"), "sigma", "change"))
    joined = join_small(grid.withColumn("d", F.col(ts).cast("timestamp").cast("double") / _DAY), spread, ["zone"])

    def simulate(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("step")
        one = group.iloc[0]
        rng = np.random.default_rng([seed, zlib.crc32(str(one["zone"]).encode())])
        ahead = np.maximum(0.0, (group["d"].to_numpy() - one["last"]) / one["span"])
        total = np.zeros((paths, len(group)))
        for path in total:
            bends = rng.uniform(0.0, ahead[-1], rng.poisson(knots / KNOT_RANGE * ahead[-1]))
            path += rng.laplace(0.0, one["change"], len(bends)) @ np.maximum(0.0, ahead - bends[:, None])
            path += rng.normal(0.0, one["sigma"], len(group))
        low, high = np.quantile(total, [0.1, 0.9], axis=0)
        out = group[["zone", ts, "step", "yhat"]].copy()
        out["yhat_lower"], out["yhat_upper"] = out["yhat"] + np.minimum(low, 0.0), out["yhat"] + np.maximum(high, 0.0)
        return out

    kind = grid.schema[ts].dataType.simpleString()
    return joined.groupBy("zone").applyInPandas(
        simulate, f"zone string, `{ts}` {kind}, step int, yhat double, yhat_lower double, yhat_upper double"
    )


# ---------------------------------------------------------------------------
# Backtests at many cutoffs
# ---------------------------------------------------------------------------


def fit_cutoffs(
    daily: DataFrame, cutoffs: Sequence[dt.date], window: int | None = None, min_rows: int = 60, ridge: float = 1e-3
) -> DataFrame:
    """``zone, cutoff, n, coef, sigma``: the trend model on the days up to each cutoff, or on the last ``window`` of them.

    ``daily`` (zone, ds, y) is read once. Its days fall into the stretches between all bounds; a zone's matrices per
    stretch are summed from the first one on, and a fit's matrix is the difference of two such sums. Fits with fewer than
    ``min_rows`` days are left out.
    """
    cutoffs = sorted(set(cutoffs))
    starts = [c - dt.timedelta(days=window) for c in cutoffs] if window else []
    bounds = sorted({*cutoffs, *starts})
    rows = daily.filter(F.col("y").isNotNull() & (F.col("ds") <= F.lit(cutoffs[-1]))).select(
        "zone", (F.col("ds").cast("timestamp").cast("double") / _DAY).alias("d"), F.col("y").cast("double").alias("y"),
        F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b < F.col("ds"))).alias("stretch"),
    )
    width = len(_design(np.zeros(1))[0])

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros(len(bounds), dtype=np.int64)
        products = np.zeros((len(bounds), (width + 1) ** 2))
        at = group["stretch"].to_numpy()
        counts[at], products[at] = group["n"].to_numpy(), np.stack(group["products"].to_numpy())
        counts, products = counts.cumsum(), products.cumsum(axis=0)
        found = []
        for cutoff in cutoffs:
            i = bounds.index(cutoff)
            n, both = int(counts[i]), products[i]
            if window:
                before = bounds.index(cutoff - dt.timedelta(days=window))
                n, both = n - int(counts[before]), both - products[before]
            if n < min_rows:
                continue
            gram, moment, energy = _square(both)
            penalty = np.diag([0.0, 0.0] + [ridge * n] * (width - 2)) + np.eye(width) * 1e-9 * n
            coef = np.linalg.solve(gram + penalty, moment)
            rss = max(0.0, energy - 2 * coef @ moment + coef @ gram @ coef)
            found.append((group["zone"].iloc[0], cutoff, n, coef, float(np.sqrt(rss / n))))
        return pd.DataFrame(found, columns=["zone", "cutoff", "n", "coef", "sigma"])

    sums = _sums(rows, ["zone", "stretch"], lambda g: _design(g["d"].to_numpy()))
    return sums.groupBy("zone").applyInPandas(solve, "zone string, cutoff date, n long, coef array<double>, sigma double")


def backtest_cutoffs(
    daily: DataFrame, cutoffs: Sequence[dt.date], horizon: int = 7, window: int | None = None, min_rows: int = 60
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(prediction rows, metrics per zone and cutoff, models) for the ``horizon`` days behind each cutoff.

    Rows: zone, cutoff, date, y, yhat, band, absolute error. A day belongs to every cutoff that it lies within the horizon of.
    """
    daily = materialize(daily.select("zone", "ds", "y"))
    models = materialize(fit_cutoffs(daily, cutoffs, window, min_rows))
    marks = F.array(*[F.lit(c) for c in sorted(set(cutoffs))])
    due = F.filter(marks, lambda c: (c < F.col("ds")) & (F.col("ds") <= F.date_add(c, horizon)))
    tested = daily.filter(F.col("y").isNotNull()).select("zone", "ds", "y", F.explode(due).alias("cutoff"))
    joined = join_small(tested, models.select("zone", "cutoff", "coef", "sigma"), ["zone", "cutoff"])
    products = F.zip_with("coef", _design_columns("ds"), lambda a, b: a * b)
    rows = joined.withColumn("yhat", F.aggregate(products, F.lit(0.0), lambda a, x: a + x)).select(
        "zone", "cutoff", F.col("ds").alias("date"), "y", "yhat",
        (F.col("yhat") - INTERVAL_Z * F.col("sigma")).alias("yhat_lower"),
        (F.col("yhat") + INTERVAL_Z * F.col("sigma")).alias("yhat_upper"),
        F.abs(F.col("y") - F.col("yhat")).alias("absolute_error"),
    )
    return rows, backtest_metrics(rows, "y", "yhat", ["zone", "cutoff"]), models
