"""Scores and forecasts: examples, invariants, comparison with numpy."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltmart.functions.quantile import exact_quantile
from voltmart.operators import forecasting, intelligence, scoring

T0 = dt.datetime(2024, 1, 1)


def at(i):
    return T0 + dt.timedelta(minutes=15 * i)


def test_rolling_forecast(spark):
    df = spark.createDataFrame([("NL", at(i), v) for i, v in enumerate([10.0, 20.0, 40.0])], "zone string, timestamp_utc timestamp, v double")
    rows = forecasting.rolling_forecast(df, "v", 2).orderBy("timestamp_utc").collect()
    assert [r["forecast_value"] for r in rows] == [10.0, 10.0, 15.0]
    assert rows[2]["forecast_error"] == 25.0
    with pytest.raises(ValueError):
        forecasting.rolling_forecast(df, "v", 0)


def test_seasonal_forecast_formula(spark):
    values = [50.0 + i for i in range(24)]
    df = spark.createDataFrame([("NL", at(i), v) for i, v in enumerate(values)], "zone string, timestamp_utc timestamp, v double")
    rows = forecasting.seasonal_forecast(df, "v", 4, 4, 8).orderBy("step").collect()
    recent = values[-8:]
    mad = np.median(np.abs(np.array(recent) - np.median(recent)))
    band = max(5.0, 1.4826 * mad * 1.96)
    for step, row in enumerate(rows, start=1):
        yhat = 0.65 * values[len(values) - 4 + (step - 1) % 4] + 0.35 * np.mean(recent)
        assert row["yhat"] == pytest.approx(yhat, abs=1e-4)
        assert row["yhat_upper"] == pytest.approx(yhat + band, abs=1e-4)
        assert row["forecast_timestamp_utc"] == at(23) + dt.timedelta(minutes=15 * step)
    short = forecasting.seasonal_forecast(df.limit(2), "v", 1, 96, 96).first()
    assert short["yhat"] == pytest.approx(0.65 * 50.5 + 0.35 * 50.5)


def test_risk_labels(spark):
    df = spark.createDataFrame([(150.0, 90.0, 210.0), (5.0, -1.0, 11.0), (50.0, 40.0, 60.0)], "yhat double, yhat_lower double, yhat_upper double")
    rows = forecasting.forecast_risk(df).collect()
    assert [r["forecast_risk_label"] for r in rows] == ["PRICE_SPIKE_RISK", "NEGATIVE_PRICE_RISK", "NORMAL"]
    assert rows[0]["forecast_confidence_band_width"] == 120.0


def test_metrics(spark):
    df = spark.createDataFrame([(10.0, 12.0), (20.0, 18.0), (30.0, 33.0)], "actual double, predicted double")
    row = forecasting.backtest_metrics(df).first()
    assert row["mae"] == 2.333333 and row["actual_count"] == 3
    assert row["rmse"] == pytest.approx(np.sqrt(17 / 3), abs=1e-6)
    zero = spark.createDataFrame([(0.0, 0.0)], "actual double, predicted double")
    assert forecasting.backtest_metrics(zero).first()["mape_pct"] == 0.0
    with pytest.raises(Exception, match="at least one pair"):
        forecasting.backtest_metrics(df.limit(0)).collect()


def test_trend_fit_equals_numpy(spark):
    days = [T0 + dt.timedelta(days=i) for i in range(400)]
    y = [40 + 0.02 * i + 5 * np.sin(2 * np.pi * i / 7) + (i * 7919 % 13) / 10 for i in range(400)]
    rows = [("NL", d, float(v)) for d, v in zip(days, y)] + [("RO", days[0], 1.0)]
    df = spark.createDataFrame(rows, "zone string, ds timestamp, y double").repartition(5)
    model = forecasting.fit_trend(df, "ds", "y", 60)
    got = forecasting.predict_trend(df, model, "ds").orderBy("ds").collect()
    assert {r["zone"] for r in got} == {"NL"}
    x = forecasting._design(np.array([(d - dt.datetime(1970, 1, 1)).total_seconds() / 86400 for d in days]))
    n, p = x.shape
    penalty = np.diag([0.0, 0.0] + [1e-3 * n] * (p - 2)) + np.eye(p) * 1e-9 * n
    want = x @ np.linalg.solve(x.T @ x + penalty, x.T @ np.array(y))
    assert np.allclose([r["yhat"] for r in got], want, atol=1e-6)
    assert all(r["yhat_lower"] < r["yhat"] < r["yhat_upper"] for r in got)


@pytest.mark.parametrize("n", [600, 6])
def test_forest_flags_outliers(spark, n):
    rng = np.random.default_rng(3)
    rows = [("NL", at(i), float(a), float(b)) for i, (a, b) in enumerate(rng.normal(50, 5, (n, 2)))]
    rows.append(("NL", at(n), 350.0, 1900.0))
    df = spark.createDataFrame(rows, "zone string, timestamp_utc timestamp, a double, b double")
    first = scoring.fit_forest(df, ["a", "b"], trees=50)
    again = scoring.fit_forest(df.repartition(3), ["a", "b"], trees=50)
    assert np.array_equal(first.threshold, again.threshold)  # same trees whatever the partitioning
    scored = scoring.forest_anomalies(scoring.isolation_scores(df, first)).orderBy(F.desc("anomaly_score")).collect()
    assert scored[0]["b"] == 1900.0 and scored[0]["anomaly_score"] == pytest.approx(1.0, abs=1e-6)
    assert 0.0 <= scored[-1]["anomaly_score"] < 0.5
    flags = scoring.flag_contamination(scoring.isolation_scores(df, first), 0.1).filter("is_anomaly").collect()
    assert any(r["b"] == 1900.0 for r in flags) and len(flags) <= 0.1 * (n + 1) + 1


def test_large_table_sampling_path(spark):
    df = spark.range(20000).select(F.lit("NL").alias("zone"), F.col("id").alias("timestamp_utc"), (F.col("id") % 97).cast("double").alias("a"))
    sample = scoring.tree_samples(df, 20000, ["a"], ["zone", "timestamp_utc"], 5, 256, 42)
    counts = [r["count"] for r in sample.groupBy("tree_id").count().collect()]
    assert len(counts) == 5 and all(200 < c <= 256 for c in counts)


def test_intelligence_run_shapes(spark):
    prices = spark.createDataFrame([("NL", at(i), 50.0 + i % 12) for i in range(120)], "zone string, timestamp_utc timestamp, price_eur_mwh double")
    gen = spark.createDataFrame([("NL", at(i), 100.0 + i % 8) for i in range(120)], "zone string, timestamp_utc timestamp, generation_mw double")
    load = spark.createDataFrame([("NL", at(i), 1000.0 + i, 990.0 + i) for i in range(120)],
                                 "zone string, timestamp_utc timestamp, actual_load_mw double, forecast_load_mw double")
    result = intelligence.run(prices, gen, load, horizon=8)
    row = result.summary.first()
    assert (row["feature_row_count"], row["anomaly_row_count"], row["forecast_row_count"]) == (120, 120, 8)
    assert result.risks.count() == 8


def test_scaler(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "a double")
    scaled = scoring.scale(df, scoring.fit_scaler(df, ["a"]))
    assert sorted(r["a"] for r in scaled.collect()) == [-1.0, 1.0]


@pytest.mark.parametrize("n", [1, 7, 199, 200, 201, 1000])
@pytest.mark.parametrize("q", [0.0, 0.5, 0.9, 0.95, 1.0])
def test_exact_quantile_on_both_sides_of_its_small_groups(spark, n, q):
    values = [float((i * 7919) % 1009) for i in range(n)]
    df = spark.createDataFrame([("NL", v) for v in values], "zone string, v double")
    row = exact_quantile(df, ["zone"], "v", q, accuracy=20).first()
    assert row["n"] == n and row["quantile"] == pytest.approx(np.quantile(values, q))


def test_future_steps_follow_each_zone(spark):
    df = spark.createDataFrame([("NL", at(0)), ("NL", at(4)), ("DE", at(8))], "zone string, t timestamp")
    rows = forecasting.future_steps(df, "t", 3).orderBy("zone", "step").collect()
    assert [(r["zone"], r["t"]) for r in rows] == [("DE", at(12)), ("DE", at(16)), ("DE", at(20)), ("NL", at(8)), ("NL", at(12)), ("NL", at(16))]


def test_seasonal_forecast_beyond_a_thousand_steps(spark):
    df = spark.createDataFrame([("NL", at(i), float(i)) for i in range(3000)], "zone string, timestamp_utc timestamp, v double")
    row = forecasting.seasonal_forecast(df, "v", 1, 2000, 1500).first()
    assert row["yhat"] == pytest.approx(0.65 * 1000 + 0.35 * np.mean(range(1500, 3000)), abs=1e-3)
