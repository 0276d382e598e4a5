"""Forecasts and backtests: rolling mean, seasonal robust, trend with seasonality, error metrics."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from voltmart.functions.keys import join_null_safe
from voltmart.functions.quantile import join_small
from voltmart.functions.rolling import chunk_window, drop_halo, with_row_chunks
from voltmart.session import materialize

STEP_MINUTES = 15


def rolling_forecast(
    df: DataFrame, value: str, window: int = 3, keys: Sequence[str] = ("zone",), ts: str = "timestamp_utc"
) -> DataFrame:
    """Mean of the previous ``window`` values (the value itself in the first row) and the error."""
    if window <= 0:
        raise ValueError("window must be positive")
    rows = with_row_chunks(df, list(keys), ts, window, max(4096, window))
    current = F.coalesce(F.col(value), F.lit(0.0))
    before = F.avg(current).over(chunk_window(list(keys)).rowsBetween(-window, -1))
    guess = F.coalesce(before, current)
    return drop_halo(
        rows.withColumns({"forecast_value": F.round(guess, 6), "forecast_error": F.round(current - guess, 6)})
    )


def _median(values: Column) -> Column:
    """Median of a short array."""
    ordered, n = F.array_sort(values), F.size(values)
    low = F.get(ordered, F.floor((n - 1) / 2).cast("int"))
    high = F.get(ordered, F.floor(n / 2).cast("int"))
    return (low + high) / 2


def seasonal_forecast(
    series: DataFrame, value: str, horizon: int = 96, season_lag: int = 96, window: int = 96,
    keys: Sequence[str] = ("zone",), ts: str = "timestamp_utc",
) -> DataFrame:
    """``horizon`` steps of 15 minutes: 0.65 x value one season back + 0.35 x mean of the last ``window`` values.

    The band is max(5, 1.96 x 1.4826 x MAD); the mean replaces a seasonal value before the start of the series. Rows
    per series and day are counted first; only the newest days that hold max(season_lag, window) values are ordered.
    """
    keys, need = list(keys), max(season_lag, window)
    dated = series.select(
        *keys, ts, F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias("_v"), F.to_date(ts).alias("_day")
    )
    later = Window.partitionBy(*keys).orderBy(F.col("_day").desc()).rowsBetween(Window.unboundedPreceding, -1)
    days = dated.groupBy(*keys, "_day").agg(F.count("*").alias("_n")).withColumn(
        "_later", F.coalesce(F.sum("_n").over(later), F.lit(0))
    )
    newest_days = materialize(days.filter(F.col("_later") < need).select(*keys, "_day"))
    newest = Window.partitionBy(*keys).orderBy(F.col(ts).desc())
    recent = (
        join_null_safe(dated, newest_days, [*keys, "_day"], "left_semi")
        .withColumn("_rn", F.row_number().over(newest))
        .filter(F.col("_rn") <= need)
    )
    last = recent.groupBy(*keys).agg(
        F.max(ts).alias("_last"),
        F.sort_array(F.collect_list(F.struct("_rn", "_v"))).alias("_s"),
    )
    back = F.col("_s._v")
    tail = F.slice(back, 1, window)
    last = last.withColumns(
        {"_back": back, "_mean": F.aggregate(tail, F.lit(0.0), lambda a, x: a + x) / F.size(tail),
         "_med": _median(tail)}
    ).withColumn("_mad", _median(F.transform(F.slice("_back", 1, window), lambda x: F.abs(x - F.col("_med")))))
    steps = last.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    season = F.get("_back", (season_lag - 1 - (F.col("step") - 1) % season_lag).cast("int"))
    yhat = 0.65 * F.coalesce(season, F.col("_mean")) + 0.35 * F.col("_mean")
    band = F.greatest(F.lit(5.0), 1.4826 * F.col("_mad") * 1.96)
    return steps.select(
        *keys, "step",
        F.timestamp_add("MINUTE", F.col("step") * STEP_MINUTES, "_last").alias("forecast_timestamp_utc"),
        F.round(yhat, 4).alias("yhat"),
        F.round(yhat - band, 4).alias("yhat_lower"),
        F.round(yhat + band, 4).alias("yhat_upper"),
    )


def choose_target(features: DataFrame) -> DataFrame:
    """Per zone the series to forecast: non-zero prices, else non-zero generation, else a single zero."""
    options = F.array(
        F.struct(F.lit("price_eur_mwh").alias("forecast_target"), F.col("price_eur_mwh").alias("value")),
        F.struct(F.lit("generation_mw").alias("forecast_target"), F.col("generation_mw").alias("value")),
    )
    long = features.select("zone", "timestamp_utc", F.inline(options)).filter(F.coalesce("value", F.lit(0.0)) != 0.0)
    chosen = features.groupBy("zone").agg(
        F.max(F.coalesce("price_eur_mwh", F.lit(0.0)) != 0.0).alias("_priced"),
        F.max(F.coalesce("generation_mw", F.lit(0.0)) != 0.0).alias("_generating"),
        F.max("timestamp_utc").alias("timestamp_utc"),
    ).withColumn("forecast_target", F.when(F.col("_priced"), "price_eur_mwh").otherwise("generation_mw"))
    series = join_small(long, chosen.select("zone", "forecast_target"), ["zone", "forecast_target"], "left_semi")
    silent = chosen.filter(~F.col("_priced") & ~F.col("_generating")).select(
        "zone", "timestamp_utc", "forecast_target", F.lit(0.0).alias("value")
    )
    return series.select("zone", "timestamp_utc", "forecast_target", "value").unionByName(silent)


def forecast_target(features: DataFrame, horizon: int = 96) -> DataFrame:
    """Seasonal forecast of each zone's target series with target and model name."""
    out = seasonal_forecast(choose_target(features), "value", horizon, keys=("zone", "forecast_target"))
    kind = F.when(F.col("forecast_target") == "price_eur_mwh", "price").otherwise("generation")
    return out.withColumn("model_name", F.concat(kind, F.lit("_simple_robust_seasonal_forecaster")))


def forecast_risk(df: DataFrame, high: float = 200.0, negative: float = 0.0) -> DataFrame:
    yhat = F.coalesce("yhat", F.lit(0.0))
    upper, lower = F.coalesce("yhat_upper", yhat), F.coalesce("yhat_lower", yhat)
    return df.withColumns(
        {
            "forecast_risk_label": F.when(upper >= high, "PRICE_SPIKE_RISK")
            .when(lower < negative, "NEGATIVE_PRICE_RISK").otherwise("NORMAL"),
            "forecast_confidence_band_width": F.round(upper - lower, 4),
        }
    )


# ---------------------------------------------------------------------------
# Trend with weekly and yearly seasonality
# ---------------------------------------------------------------------------
WEEKLY_ORDER, YEARLY_ORDER = 3, 10
INTERVAL_Z = 1.2815515655446004  # 80 % band
_EPOCH_DAYS = 18262.0  # 2020-01-01


def _design(days: np.ndarray) -> np.ndarray:
    """Constant, trend in years, Fourier pairs of the week and the year."""
    t = days - _EPOCH_DAYS
    parts = [np.ones_like(t), t / 365.25]
    for period, order in ((7.0, WEEKLY_ORDER), (365.25, YEARLY_ORDER)):
        for k in range(1, order + 1):
            angle = 2.0 * np.pi * k * t / period
            parts += [np.sin(angle), np.cos(angle)]
    return np.column_stack(parts)


def _design_columns(ts: str) -> Column:
    t = F.col(ts).cast("timestamp").cast("double") / 86400.0 - F.lit(_EPOCH_DAYS)
    parts = [F.lit(1.0), t / 365.25]
    for period, order in ((7.0, WEEKLY_ORDER), (365.25, YEARLY_ORDER)):
        for k in range(1, order + 1):
            angle = F.lit(2.0 * np.pi * k / period) * t
            parts += [F.sin(angle), F.cos(angle)]
    return F.array(*parts)


def fit_trend(
    df: DataFrame, ts: str, value: str, min_rows: int = 100, ridge: float = 1e-3, fan_in: int = 64
) -> DataFrame:
    """Least squares per zone: ``zone, n, coef, sigma``; zones with fewer than ``min_rows`` rows are left out.

    Each task reduces its rows to one small matrix of products per zone, and those are added in two levels, so no
    task holds a zone's rows.
    """
    p = len(_design(np.array([_EPOCH_DAYS]))[0])
    days = (F.col(ts).cast("timestamp").cast("double") / 86400.0).alias("d")
    rows = df.filter(F.col(value).isNotNull()).select("zone", days, F.col(value).cast("double").alias("y"))
    schema = "zone string, part long, n long, products array<double>"

    def reduce_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        sums: dict[str, list] = {}

        def flush() -> pd.DataFrame:
            out = pd.DataFrame(
                {"zone": list(sums), "part": part, "n": [s[0] for s in sums.values()],
                 "products": [s[1].ravel() for s in sums.values()]}
            )
            sums.clear()
            return out

        for batch in batches:
            for zone, group in batch.groupby("zone"):
                m = np.column_stack([_design(group["d"].to_numpy()), group["y"].to_numpy()])
                entry = sums.setdefault(zone, [0, np.zeros((p + 1, p + 1))])
                entry[0] += len(group)
                entry[1] += m.T @ m
            if len(sums) > 1000:
                yield flush()
        if sums:
            yield flush()

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = np.sum(np.stack(group["products"].to_numpy()), axis=0)
        return pd.DataFrame(
            {"zone": [group["zone"].iloc[0]], "part": [0], "n": [int(group["n"].sum())], "products": [total]}
        )

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        n = int(group["n"].sum())
        if n < min_rows:
            return pd.DataFrame({"zone": "", "n": 0, "coef": [[]], "sigma": 0.0}).iloc[:0]
        both = np.sum(np.stack(group["products"].to_numpy()), axis=0).reshape(p + 1, p + 1)
        gram, moment, energy = both[:p, :p], both[:p, p], both[p, p]
        penalty = np.diag([0.0, 0.0] + [ridge * n] * (p - 2)) + np.eye(p) * 1e-9 * n
        coef = np.linalg.solve(gram + penalty, moment)
        rss = max(0.0, energy - 2 * coef @ moment + coef @ gram @ coef)
        return pd.DataFrame(
            {"zone": [group["zone"].iloc[0]], "n": [n], "coef": [coef], "sigma": [float(np.sqrt(rss / n))]}
        )

    partial = rows.mapInPandas(reduce_rows, schema)
    merged = partial.groupBy("zone", (F.col("part") % fan_in).alias("_lane")).applyInPandas(add, schema)
    return merged.groupBy("zone").applyInPandas(solve, "zone string, n long, coef array<double>, sigma double")


def predict_trend(df: DataFrame, model: DataFrame, ts: str) -> DataFrame:
    """Add yhat and its band; the dot product runs in the JVM. Zones without a model drop out."""
    joined = join_small(df, model.select("zone", "coef", "sigma"), ["zone"])
    products = F.zip_with("coef", _design_columns(ts), lambda a, b: a * b)
    yhat = F.aggregate(products, F.lit(0.0), lambda a, x: a + x)
    return joined.withColumn("yhat", yhat).withColumns(
        {
            "yhat_lower": F.col("yhat") - INTERVAL_Z * F.col("sigma"),
            "yhat_upper": F.col("yhat") + INTERVAL_Z * F.col("sigma"),
        }
    ).drop("coef", "sigma")


def future_steps(df: DataFrame, ts: str, steps: int = 48, minutes: int = 60) -> DataFrame:
    """``zone, ts`` of the ``steps`` stamps that follow each zone's last one, for ``predict_trend``."""
    last = df.groupBy("zone").agg(F.max(ts).alias("_last"))
    step = F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step")
    seconds = F.lit(60 * minutes) * F.col("step")
    return last.select("zone", "_last", step).select(
        "zone", F.timestamp_seconds(F.unix_timestamp("_last") + seconds).alias(ts), "step"
    )


def daily_prices(prices: DataFrame, start: str, end: str) -> DataFrame:
    """Mean price per zone and day within inclusive dates, NULL means dropped."""
    day = F.to_date("timestamp_utc")
    inside = prices.filter(
        (F.col("timestamp_utc") >= F.lit(start).cast("timestamp"))
        & (F.col("timestamp_utc") < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp"))
    )
    return inside.groupBy("zone", day.alias("ds")).agg(F.avg("price_eur_mwh").alias("y")).filter(F.col("y").isNotNull())


def backtest_rows(actual: DataFrame, forecast: DataFrame) -> DataFrame:
    """Actual against predicted per (zone, day), 4 places."""
    joined = actual.join(forecast.select("zone", "ds", "yhat", "yhat_lower", "yhat_upper"), ["zone", "ds"])
    return joined.select(
        "zone", F.col("ds").alias("date"),
        F.round("y", 4).alias("actual_price_eur_mwh"),
        F.round("yhat", 4).alias("predicted_price_eur_mwh"),
        F.round("yhat_lower", 4).alias("predicted_lower"),
        F.round("yhat_upper", 4).alias("predicted_upper"),
        F.round(F.abs(F.col("y") - F.col("yhat")), 4).alias("absolute_error"),
    )


def backtest_metrics(
    pairs: DataFrame, actual: str = "actual", predicted: str = "predicted", keys: Sequence[str] = ()
) -> DataFrame:
    """MAE, RMSE, MAPE (zero actuals skipped), sMAPE (both zero skipped), count; no rows at all is an error."""
    a, p = F.col(actual), F.col(predicted)
    gap, scale = F.abs(a - p), F.abs(a) + F.abs(p)
    out = pairs.groupBy(*keys).agg(
        F.avg(gap).alias("mae"),
        F.sqrt(F.avg(gap * gap)).alias("rmse"),
        (F.coalesce(F.avg(F.when(a != 0, gap / F.abs(F.nullif(a, F.lit(0.0))))), F.lit(0.0)) * 100.0).alias("mape_pct"),
        (F.coalesce(F.avg(F.when(scale > 0, 2 * gap / F.nullif(scale, F.lit(0.0)))), F.lit(0.0)) * 100.0)
        .alias("smape_pct"),
        F.count(gap).alias("actual_count"),
    )
    empty = F.raise_error(F.lit("backtest metrics need at least one pair")).cast("long")
    return out.withColumns(
        {c: F.round(c, 6) for c in ("mae", "rmse", "mape_pct", "smape_pct")}
    ).withColumn("actual_count", F.when(F.col("actual_count") > 0, F.col("actual_count")).otherwise(empty))


def trend_backtest(
    prices: DataFrame, train: tuple[str, str], test: tuple[str, str], min_rows: int = 60
) -> tuple[DataFrame, DataFrame]:
    """(prediction rows, metrics per zone) of the trend model on daily means."""
    model = fit_trend(daily_prices(prices, *train), "ds", "y", min_rows)
    actual = daily_prices(prices, *test)
    forecast = predict_trend(actual, model, "ds")
    rows = backtest_rows(actual, forecast)
    pairs = forecast.select("zone", F.col("y").alias("actual"), F.col("yhat").alias("predicted"))
    return rows, backtest_metrics(pairs, keys=["zone"])
