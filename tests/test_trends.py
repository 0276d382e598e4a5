"""Piecewise trend and many-cutoff backtests against numpy and separate fits."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltmart.operators import forecasting, trends

T0 = dt.datetime(2024, 1, 1)


def hourly(spark, n=24 * 120, zones=("NL", "DE")):
    rows = []
    for z, zone in enumerate(zones):
        for i in range(n):
            u = i / n
            y = 50 + 30 * u - 60 * max(0.0, u - 0.4) + 8 * np.sin(2 * np.pi * i / 24) + (i * 7919 % 101) / 50 + z
            rows.append((zone, T0 + dt.timedelta(hours=i), float(y)))
    return spark.createDataFrame(rows, "zone string, t timestamp, y double").repartition(5)


def test_solution_meets_the_optimality_conditions():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 12))
    y = x[:, 3] * 2 - x[:, 7] + rng.normal(size=300) * 0.1
    gram, moment, ridge = x.T @ x / 300, x.T @ y / 300, np.full(12, 1e-3)
    sparse = np.arange(12) >= 2
    coef, penalty, residual = trends.sparse_solution(gram, moment, ridge, sparse, 0.1)
    slope = moment - gram @ coef - ridge * coef
    assert residual < 1e-8 and np.abs(slope[:2]).max() < 1e-8
    assert (np.abs(slope[2:]) <= penalty + 1e-8).all()
    some = coef[2:] != 0
    assert np.allclose(slope[2:][some], penalty * np.sign(coef[2:][some]), atol=1e-8)
    assert set(np.flatnonzero(coef)) >= {3, 7} and (coef == 0).sum() >= 5
    nothing, _, _ = trends.sparse_solution(gram, moment, ridge, sparse, 1.0)
    assert not nothing[2:].any()


def test_piecewise_fit_equals_numpy_and_finds_the_bend(spark):
    df = hourly(spark)
    model = trends.fit_piecewise(df, "t", "y").collect()
    assert {r.zone for r in model} == {"NL", "DE"} and all(r.residual < 1e-6 and r.n == 2880 for r in model)
    one = next(r for r in model if r.zone == "NL")
    rows = sorted((r.t, r.y) for r in df.filter("zone = 'NL'").collect())
    days = np.array([(t - dt.datetime(1970, 1, 1)).total_seconds() / 86400 for t, _ in rows])
    x = trends._piecewise(days, days[0], days[-1], trends.knot_places(), trends.SEASONS)
    y = np.array([v for _, v in rows])
    places = np.arange(x.shape[1])
    sparse = (places >= 2) & (places < 2 + trends.KNOTS)
    want, _, _ = trends.sparse_solution(
        x.T @ x / len(y), x.T @ y / len(y), np.where(places >= 2 + trends.KNOTS, 1e-3, 1e-9), sparse, 0.02
    )
    assert np.allclose(x @ np.array(one.coef), x @ want, atol=1e-4)
    assert one.sigma < 1.5 and np.sqrt(np.mean((x @ np.array(one.coef) - y) ** 2)) == pytest.approx(one.sigma, rel=1e-3)
    bends = np.array(one.coef)[sparse]
    assert abs(trends.knot_places()[np.argmin(bends)] - 0.4) < 0.1 and (bends == 0).sum() > 10


def test_prediction_is_the_design_times_the_coefficients(spark):
    df = hourly(spark, 24 * 30, ("NL",))
    model = trends.fit_piecewise(df, "t", "y")
    one = model.first()
    got = trends.predict_piecewise(df, model, "t").orderBy("t").collect()
    days = np.array([(r.t - dt.datetime(1970, 1, 1)).total_seconds() / 86400 for r in got])
    x = trends._piecewise(days, one["first"], one["last"], trends.knot_places(), trends.SEASONS)
    assert np.allclose([r.yhat for r in got], x @ np.array(one.coef), atol=1e-6)


def test_simulated_bands_widen_and_repeat(spark):
    df = hourly(spark, 24 * 60)
    model = trends.fit_piecewise(df, "t", "y")
    got = trends.forecast_piecewise(df, model, "t", 24 * 20, 60).orderBy("zone", "step").collect()
    assert [r.step for r in got] == [*range(1, 481)] * 2 and got[0].t == T0 + dt.timedelta(days=60)
    width = np.array([r.yhat_upper - r.yhat_lower for r in got]).reshape(2, -1)
    assert (width > 0).all() and (width[:, -48:].mean(axis=1) > 1.2 * width[:, :48].mean(axis=1)).all()
    again = trends.forecast_piecewise(df.repartition(2), model, "t", 24 * 20, 60).orderBy("zone", "step").collect()
    assert np.allclose([r.yhat_lower for r in again], [r.yhat_lower for r in got], atol=1e-9)


def test_short_constant_and_empty_series(spark):
    df = hourly(spark, 99, ("NL",))
    assert trends.fit_piecewise(df, "t", "y").count() == 0 and trends.fit_piecewise(df.limit(0), "t", "y").count() == 0
    flat = df.withColumn("y", F.lit(5.0)).union(df.limit(3).withColumn("y", F.lit(None).cast("double")))
    model = trends.fit_piecewise(flat, "t", "y", 50)
    got = trends.predict_piecewise(df, model, "t").collect()
    assert np.allclose([r.yhat for r in got], 5.0, atol=1e-3) and model.first().n == 99


@pytest.fixture(scope="module")
def daily(spark):
    rows = [(z, T0.date() + dt.timedelta(days=i), float(40 + 0.05 * i + k * 3 * np.sin(i) + (i * 31 % 17) / 5))
            for k, z in enumerate(("NL", "DE")) for i in range(200 if z == "NL" else 90) if i % 11]
    rows += [("NL", T0.date() + dt.timedelta(days=11), None)]
    return spark.createDataFrame(rows, "zone string, ds date, y double").repartition(4)


@pytest.mark.parametrize("window", [None, 70])
def test_cutoffs_equal_separate_fits(daily, window):
    cutoffs = [T0.date() + dt.timedelta(days=d) for d in (59, 70, 85, 120, 150)]
    rows, metrics, models = trends.backtest_cutoffs(daily, cutoffs, 10, window)
    got = {(r.zone, r.cutoff, r.date): r for r in rows.collect()}
    scored = {(r.zone, r.cutoff): r for r in metrics.collect()}
    fits = {(r.zone, r.cutoff): r for r in models.collect()}
    expected = set()
    for cutoff in cutoffs:
        train = daily.filter((F.col("ds") <= F.lit(cutoff)))
        if window:
            train = train.filter(F.col("ds") > F.lit(cutoff - dt.timedelta(days=window)))
        model = forecasting.fit_trend(train, "ds", "y", 60)
        test = daily.filter((F.col("ds") > F.lit(cutoff)) & (F.col("ds") <= F.lit(cutoff + dt.timedelta(days=10)))).dropna()
        for r in forecasting.predict_trend(test, model, "ds").collect():
            found = got[r.zone, cutoff, r.ds]
            assert found.yhat == pytest.approx(r.yhat, abs=1e-5) and found.yhat_lower == pytest.approx(r.yhat_lower, abs=1e-5)
            expected.add((r.zone, cutoff, r.ds))
        for r in model.collect():
            assert fits[r.zone, cutoff].n == r.n >= 60
    assert set(got) == expected and len(fits) >= 4
    for key, row in scored.items():
        errors = [r.absolute_error for k, r in got.items() if k[:2] == key]
        assert row.actual_count == len(errors) and row.mae == pytest.approx(np.mean(errors), abs=1e-5)
