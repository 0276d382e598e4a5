"""Queries over scoring, forecasting and backtest operators."""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from voltmart.functions.quantile import exact_median, exact_quantile
from voltmart.operators import ensembles, features as feat, forecasting, gold, intelligence, models, scoring, trends
from voltmart.plans import market_views as views
from voltmart.plans.core import latest_load, latest_prices, local_features, silver_generation, silver_prices
from voltmart.plans.registry import CTES, oracle, query, r, rounded
from voltmart.session import materialize, scratch_path, shared_dir
from voltmart.sinks import tables as sinks

CTES["training"] = """SELECT p.zone, p.timestamp_utc, p.price_eur_mwh, p.price_z_score,
    coalesce(g.renewable_share_pct, 0.0) AS renewable_share_pct, coalesce(abs_forecast_error_mw, 0.0) AS abs_forecast_error_mw
    FROM s_prices p
    LEFT JOIN (SELECT zone, timestamp_utc, avg(renewable_share_pct) AS renewable_share_pct FROM s_generation
      GROUP BY ALL) g ON p.zone = g.zone AND p.timestamp_utc = g.timestamp_utc
    LEFT JOIN s_load l ON p.zone = l.zone AND p.timestamp_utc = l.timestamp_utc
    WHERE p.timestamp_utc BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '2024-01-20 00:00:00'"""
_RF = scoring.REGIME_FEATURES


def training(spark: SparkSession, sf: str) -> DataFrame:
    prices = silver_prices(spark, sf).select("zone", "timestamp_utc", "price_eur_mwh", "price_z_score")
    return scoring.training_set(
        prices, silver_generation(spark, sf), latest_load(spark, sf), "2024-01-01 00:00:00", "2024-01-20 00:00:00"
    )


@query(oracle(f"SELECT zone, timestamp_utc, {', '.join(r(c) for c in _RF)} FROM training"))
def training_set(spark, sf):
    return rounded(training(spark, sf), *_RF)


@query(oracle("""SELECT zone, timestamp_utc, price_eur_mwh, CASE WHEN price_eur_mwh < 0 THEN 'NEGATIVE'
    WHEN price_eur_mwh > 200 THEN 'SPIKE' WHEN least(abs(price_z_score) / 3.0, 1.0) > 0.6 THEN 'STRESS' ELSE 'NORMAL' END
    AS regime_label FROM s_prices"""))
def regime_labels(spark, sf):
    prices = silver_prices(spark, sf)
    score = F.least(F.abs("price_z_score") / 3.0, F.lit(1.0))
    return prices.select(
        "zone", "timestamp_utc", "price_eur_mwh",
        gold.regime_label(F.col("price_eur_mwh"), score).alias("regime_label"),
    )


@query(oracle("SELECT zone, timestamp_utc, " + ", ".join(
    r(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()", 6, c) for c in _RF) + " FROM training"))
def standardised_features(spark, sf):
    rows = training(spark, sf)
    return rounded(scoring.scale(rows, scoring.fit_scaler(rows, _RF)), *_RF)


def _regime_model(spark: SparkSession, sf: str, rows: DataFrame):
    """The stored regime forest over a table folder; the first query that needs it fits it, the others load it."""
    def fit():
        return ensembles.fit(rows, _RF, key="model_key", trees=100), rows.count()

    store = f"{shared_dir(spark).rstrip('/')}/models-{hashlib.sha256(sf.encode()).hexdigest()[:16]}"
    return models.load_or_fit(spark, store, "regime", "1", fit, "fit-1", sf)


def _regime_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Training rows with the regime forest's scores and lineage."""
    rows = materialize(training(spark, sf).withColumn("model_key", F.lit("regime")))
    model, record = _regime_model(spark, sf, rows)
    return models.with_lineage(ensembles.anomalies(rows, model, "model_key"), record).drop("model_key")


def _as_ruled(label: str = "regime_label"):
    """Whether a label follows from price and score."""
    price, score = F.coalesce("price_eur_mwh", F.lit(0.0)), F.col("anomaly_score")
    return F.col(label) == F.when(price < 0, "NEGATIVE").when(price > 200, "SPIKE").when(score > 0.6, "STRESS").otherwise("NORMAL")


def _in_range():
    return F.col("anomaly_score").between(0.0, 1.0).alias("score_in_range")


@query(oracle("""SELECT zone, timestamp_utc, price_eur_mwh, true AS score_in_range, true AS flag_follows_score,
    true AS label_follows_rule, 'isolation_forest' AS model_type, 'regime' AS model_name, '1' AS model_version,
    'fit-1' AS model_run_id FROM training"""))
def isolation_forest_scores(spark, sf):
    """Every training row scored by the stored forest; scores of sampled trees have no SQL, what follows from them has."""
    labelled = scoring.label_anomalies(_regime_scores(spark, sf), "isolation_forest")
    return labelled.select(
        "zone", "timestamp_utc", "price_eur_mwh", _in_range(),
        (F.col("is_anomaly") == (F.col("anomaly_score") >= 0.6)).alias("flag_follows_score"),
        _as_ruled().alias("label_follows_rule"), "model_type", "model_name", "model_version", "model_run_id",
    )


@query()
def isolation_forest_rows(spark, sf):
    """The scores themselves: rows-only check here, invariants in the tests."""
    labelled = scoring.label_anomalies(_regime_scores(spark, sf), "isolation_forest")
    return labelled.select("zone", "timestamp_utc", "anomaly_score", "is_anomaly", "regime_label", "model_type")


@query(oracle("SELECT count(*) AS scored_rows, 0.0 AS least_score, 1.0 AS greatest_score FROM training"))
def isolation_forest_range(spark, sf):
    return _regime_scores(spark, sf).agg(
        F.count("*").alias("scored_rows"), F.min("anomaly_score").alias("least_score"),
        F.max("anomaly_score").alias("greatest_score"),
    )


@query(oracle("""SELECT zone, count(*) AS scored_rows, true AS flag_follows_margin,
    (SELECT count(*) FROM training) AS all_rows, true AS within_contamination FROM training GROUP BY zone"""))
def isolation_forest_flags(spark, sf):
    """Per zone the rows scored; the rows flagged in all are those ranked above the contamination's cut."""
    flagged = materialize(scoring.flag_contamination(_regime_scores(spark, sf).drop("anomaly_score"), 0.05))
    total = flagged.agg(F.count("*").alias("n"), F.count_if("is_anomaly").alias("hits")).first()
    return flagged.groupBy("zone").agg(
        F.count("*").alias("scored_rows"),
        F.min(F.col("is_anomaly") == (F.col("anomaly_score") > 0) | (F.col("anomaly_score") == 0)).alias("flag_follows_margin"),
    ).select(
        "zone", "scored_rows", "flag_follows_margin", F.lit(total["n"]).alias("all_rows"),
        F.lit(total["hits"] <= 0.05 * (total["n"] - 1) + 1).alias("within_contamination"),
    )


CTES["regime_rows"] = """SELECT md5(t.zone || CAST(t.timestamp_utc AS VARCHAR)) AS signal_id, t.zone, t.timestamp_utc,
    t.price_eur_mwh, t.price_z_score, 0.85 AS regime_confidence, '1' AS model_version, 'fit-1' AS model_run_id,
    h.price_eur_mwh AS feature_lag_1h, d.price_eur_mwh AS feature_lag_24h, t.renewable_share_pct AS feature_res_share
    FROM training t
    LEFT JOIN training h ON h.zone = t.zone AND h.timestamp_utc + INTERVAL 1 HOUR = t.timestamp_utc
    LEFT JOIN training d ON d.zone = t.zone AND d.timestamp_utc + INTERVAL 24 HOUR = t.timestamp_utc"""
_REGIME = ["price_eur_mwh", "price_z_score", "feature_lag_1h", "feature_lag_24h", "feature_res_share"]
_REGIME_SQL = f"""SELECT signal_id, zone, timestamp_utc, {', '.join(r(c) for c in _REGIME)}, true AS score_in_range,
    true AS label_follows_rule, regime_confidence, model_version, model_run_id FROM regime_rows"""


def _signals(spark: SparkSession, sf: str) -> DataFrame:
    scored = gold.with_price_lags(materialize(_regime_scores(spark, sf)))
    return gold.regime_signals(scored, "1", "fit-1")


def _checked_signals(signals: DataFrame) -> DataFrame:
    return rounded(signals, *_REGIME).select(
        "signal_id", "zone", "timestamp_utc", *_REGIME, _in_range(),
        _as_ruled().alias("label_follows_rule"), "regime_confidence", "model_version", "model_run_id",
    )


@query(oracle(_REGIME_SQL))
def regime_signals(spark, sf):
    """All declared columns; of score and label, whether they are in range and follow the rule."""
    return _checked_signals(_signals(spark, sf))


@query(oracle(_REGIME_SQL))
def regime_mart(spark, sf):
    """The signals upserted by zone and timestamp in overlapping batches; a repeated batch changes nothing."""
    signals = materialize(_signals(spark, sf).withColumn("event_date", F.to_date("timestamp_utc")))
    path = scratch_path(spark, "regime")
    early, late = signals.filter("day(timestamp_utc) <= 12"), signals.filter("day(timestamp_utc) >= 10")
    for batch in (early, late, early):
        sinks.upsert(batch, path, ["zone", "timestamp_utc"], "scored_at", ["event_date"])
    return _checked_signals(sinks.read_like(spark, path, signals))


_FEATURES = feat.FEATURE_CANDIDATES
CTES["robust_long"] = " UNION ALL ".join(
    f"SELECT zone, timestamp_utc, '{c}' AS feature, {c} AS value FROM local_feat" for c in _FEATURES
)
CTES["robust_stat"] = """SELECT zone, feature, any_value(med) AS median, median(abs(value - med)) AS mad,
    stddev_pop(value) AS stddev, max(abs(value)) > 0 AS active
    FROM (SELECT *, median(value) OVER (PARTITION BY zone, feature) AS med FROM robust_long) GROUP BY zone, feature"""
CTES["robust_score"] = """SELECT zone, timestamp_utc,
    avg(least(abs(value - median) / greatest(stddev, 1.4826 * mad, 1e-9) / 3.0, 1.0)) AS anomaly_score
    FROM robust_long JOIN robust_stat USING (zone, feature) WHERE active GROUP BY zone, timestamp_utc"""


@query(oracle("""SELECT zone, count(*) AS scored_rows, 0.0 AS least_score, 1.0 AS greatest_score, true AS label_follows_rule,
    any_value(feature_cols) AS feature_cols, 'isolation_forest' AS model_type FROM local_feat JOIN (SELECT zone AS of_zone,
    string_agg(feature, ',' ORDER BY feature) AS feature_cols FROM robust_stat WHERE active GROUP BY zone)
    ON zone = of_zone GROUP BY zone"""))
def zone_forest_scores(spark, sf):
    """The local job's forest option: a forest per zone over the zone's active features, scores from 0 to 1 in each."""
    rows = materialize(local_features(spark, sf))
    scored = intelligence.score_zones(rows, "isolation_forest", trees=50)
    found = scored.groupBy("zone").agg(
        F.count("*").alias("scored_rows"), F.min("anomaly_score").alias("least_score"),
        F.max("anomaly_score").alias("greatest_score"), F.min(_as_ruled()).alias("label_follows_rule"),
        F.max("model_type").alias("model_type"),
    )
    used = feat.active_features(rows).select("zone", F.array_join(F.sort_array("feature_cols"), ",").alias("feature_cols"))
    return found.join(used, "zone")


@query(oracle(f"SELECT zone, feature, {r('median')}, {r('mad')}, {r('stddev')} FROM robust_stat"))
def robust_statistics(spark, sf):
    stats = scoring.robust_stats(materialize(local_features(spark, sf)))
    return rounded(stats, "median", "mad", "stddev")


_ROBUST = oracle(f"""SELECT zone, timestamp_utc, price_eur_mwh, {r('round(anomaly_score, 6)', 5, 'anomaly_score')},
    anomaly_score >= 0.6 AS is_anomaly, CASE WHEN price_eur_mwh < 0 THEN 'NEGATIVE' WHEN price_eur_mwh > 200 THEN 'SPIKE'
    WHEN anomaly_score > 0.6 THEN 'STRESS' ELSE 'NORMAL' END AS regime_label, 'robust_zscore_fallback' AS model_type
    FROM robust_score JOIN local_feat USING (zone, timestamp_utc)""")


@query(_ROBUST)
def robust_anomaly_scores(spark, sf):
    scored = scoring.robust_scores(materialize(local_features(spark, sf)))
    labelled = scoring.label_anomalies(scored, "robust_zscore_fallback")
    return rounded(labelled, "anomaly_score", digits=5).select(
        "zone", "timestamp_utc", "price_eur_mwh", "anomaly_score", "is_anomaly", "regime_label", "model_type"
    )


@query(oracle(f"""SELECT zone, count(price_eur_mwh) AS n, {r('median(price_eur_mwh)', 6, 'median')},
    {r('quantile_cont(price_eur_mwh, 0.9)', 6, 'p90')} FROM prices WHERE price_eur_mwh IS NOT NULL GROUP BY zone"""))
def exact_quantiles(spark, sf):
    prices = views.prices(spark, sf)
    median = exact_median(prices, ["zone"], "price_eur_mwh")
    p90 = exact_quantile(prices, ["zone"], "price_eur_mwh", 0.9).select("zone", F.col("quantile").alias("p90"))
    return rounded(median.join(p90, "zone"), "median", "p90")


CTES["rolled"] = """SELECT zone, timestamp_utc, price_eur_mwh, coalesce(avg(price_eur_mwh) OVER (PARTITION BY zone
    ORDER BY timestamp_utc ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), price_eur_mwh) AS guess FROM latest_prices"""


@query(oracle(f"""SELECT zone, timestamp_utc, {r('guess', 5, 'forecast_value')},
              {r('price_eur_mwh - guess', 5, 'forecast_error')} FROM rolled"""))
def rolling_mean_forecast(spark, sf):
    out = forecasting.rolling_forecast(latest_prices(spark, sf), "price_eur_mwh")
    return rounded(out, "forecast_value", "forecast_error", digits=5).select(
        "zone", "timestamp_utc", "forecast_value", "forecast_error"
    )


CTES.update(
    {
        "tail_rows": """SELECT * FROM (SELECT zone, timestamp_utc, price_eur_mwh AS v, row_number() OVER (
            PARTITION BY zone ORDER BY timestamp_utc DESC) AS rn FROM latest_prices) WHERE rn <= 96""",
        "tail_stat": """SELECT zone, max(timestamp_utc) AS last, avg(v) AS m, any_value(mad) AS mad FROM (
            SELECT *, median(abs(v - med)) OVER (PARTITION BY zone) AS mad FROM (
            SELECT *, median(v) OVER (PARTITION BY zone) AS med FROM tail_rows)) GROUP BY zone""",
        "seasonal": """SELECT s.zone, step, last + to_minutes(CAST(15 * step AS INTEGER)) AS forecast_timestamp_utc,
            0.65 * coalesce(v, m) + 0.35 * m AS yhat, greatest(5.0, 1.4826 * mad * 1.96) AS band
            FROM tail_stat s CROSS JOIN (SELECT unnest(generate_series(1, 96)) AS step) h
            LEFT JOIN tail_rows t ON t.zone = s.zone AND t.rn = 96 - (step - 1) % 96""",
    }
)
_YHAT = f"{r('yhat', 3)}, {r('yhat - band', 3, 'yhat_lower')}, {r('yhat + band', 3, 'yhat_upper')}"
_Y = ["yhat", "yhat_lower", "yhat_upper"]


@query(oracle(f"SELECT zone, CAST(step AS INTEGER) AS step, forecast_timestamp_utc, {_YHAT} FROM seasonal"))
def seasonal_forecast(spark, sf):
    return rounded(forecasting.seasonal_forecast(latest_prices(spark, sf), "price_eur_mwh"), *_Y, digits=3)


@query(oracle(f"""SELECT zone, forecast_timestamp_utc, CASE WHEN yhat + band >= 200 THEN 'PRICE_SPIKE_RISK'
    WHEN yhat - band < 0 THEN 'NEGATIVE_PRICE_RISK' ELSE 'NORMAL' END AS forecast_risk_label,
    {r('round(yhat + band, 4) - round(yhat - band, 4)', 3, 'forecast_confidence_band_width')} FROM seasonal"""))
def forecast_risk(spark, sf):
    risks = forecasting.forecast_risk(
        forecasting.seasonal_forecast(latest_prices(spark, sf), "price_eur_mwh")
    )
    return rounded(risks, "forecast_confidence_band_width", digits=3).select(
        "zone", "forecast_timestamp_utc", "forecast_risk_label", "forecast_confidence_band_width"
    )


CTES["target_rows"] = """SELECT zone, CASE WHEN zone IN ('NL', 'DE') THEN 'generation_mw' ELSE 'price_eur_mwh' END
    AS forecast_target, timestamp_utc FROM local_feat WHERE CASE WHEN zone IN ('NL', 'DE') THEN generation_mw
    ELSE price_eur_mwh END <> 0"""


@query(oracle("SELECT zone, forecast_target, count(*) AS series_rows FROM target_rows GROUP BY ALL"))
def forecast_target_choice(spark, sf):
    """Two zones are stripped of prices so that both branches are used."""
    rows = materialize(local_features(spark, sf)).withColumn(
        "price_eur_mwh", F.when(~F.col("zone").isin("NL", "DE"), F.col("price_eur_mwh")).otherwise(F.lit(0.0))
    )
    return forecasting.choose_target(rows).groupBy("zone", "forecast_target").agg(F.count("*").alias("series_rows"))


@query(oracle(f"""SELECT zone, CAST(timestamp_utc AS DATE) AS ds, {r('avg(price_eur_mwh)', 6, 'y')} FROM latest_prices
    WHERE timestamp_utc >= DATE '2024-01-03' AND timestamp_utc < DATE '2024-01-26' GROUP BY ALL"""))
def daily_price_resample(spark, sf):
    return rounded(forecasting.daily_prices(latest_prices(spark, sf), "2024-01-03", "2024-01-25"), "y")


@query()
def trend_forecast(spark, sf):
    """Own least-squares model: rows-only check here, compared with numpy in the tests."""
    prices = latest_prices(spark, sf)
    model = forecasting.fit_trend(prices, "timestamp_utc", "price_eur_mwh", 100)
    return rounded(forecasting.predict_trend(prices, model, "timestamp_utc"), *_Y, digits=4).select(
        "zone", "timestamp_utc", "price_eur_mwh", *_Y
    )


@query(oracle("""SELECT zone, timestamp_utc + to_hours(CAST(step AS INTEGER)) AS timestamp_utc, CAST(step AS INTEGER) AS step
    FROM (SELECT zone, max(timestamp_utc) AS timestamp_utc FROM latest_prices WHERE price_eur_mwh IS NOT NULL
    GROUP BY zone HAVING count(*) >= 100), range(1, 49) s(step)"""))
def trend_future_steps(spark, sf):
    """The 48 hourly steps after each modelled zone's last price; every step has a forecast inside its band."""
    prices = materialize(latest_prices(spark, sf).filter("price_eur_mwh IS NOT NULL"))
    model = forecasting.fit_trend(prices, "timestamp_utc", "price_eur_mwh", 100)
    steps = forecasting.predict_trend(forecasting.future_steps(prices, "timestamp_utc"), model, "timestamp_utc")
    return steps.filter("yhat_lower <= yhat AND yhat <= yhat_upper").select("zone", "timestamp_utc", "step")


#: The generated prices cover one month; backtests need more days, so they run on order values: priority as zone.
CTES["order_days"] = """SELECT o_orderpriority AS zone, CAST(o_orderdate AS DATE) AS ds, avg(o_totalprice) AS y FROM orders
    GROUP BY ALL"""
CUTOFFS = [dt.date(year, month, 1) for year in (1997, 1998, 1999, 2000) for month in (1, 4, 7, 10)]


def order_values(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/orders.parquet").select(
        F.col("o_orderpriority").alias("zone"), F.col("o_orderdate").cast("timestamp").alias("timestamp_utc"),
        F.col("o_totalprice").cast("double").alias("price_eur_mwh"),
    )


def _order_days(spark: SparkSession, sf: str) -> DataFrame:
    return forecasting.daily_prices(order_values(spark, sf), "1900-01-01", "2100-01-01")


_LONG = (("1998-01-01", "1999-12-31"), ("2000-01-01", "2000-01-31"))


@query()
def trend_backtest(spark, sf):
    """Values of a least-squares fit: rows-only check here, compared with numpy in the tests."""
    return forecasting.trend_backtest(order_values(spark, sf), *_LONG)[0]


@query()
def trend_backtest_metrics(spark, sf):
    return forecasting.trend_backtest(order_values(spark, sf), *_LONG)[1]


_CUTS = ", ".join(f"DATE '{c}'" for c in CUTOFFS)
_TRAINED = f"""SELECT zone, cutoff, count(*) AS training_days FROM order_days, (SELECT unnest([{_CUTS}]) AS cutoff)
    WHERE ds <= cutoff AND ds > cutoff - INTERVAL 730 DAY GROUP BY zone, cutoff HAVING count(*) >= 60"""


@query(oracle(f"""SELECT zone, cutoff, ds AS date, {r('y', 4)}, true AS error_is_distance, true AS band_in_order FROM order_days
    JOIN ({_TRAINED}) USING (zone) WHERE ds > cutoff AND ds <= cutoff + INTERVAL 30 DAY"""))
def backtest_at_cutoffs(spark, sf):
    """Sixteen backtests of two years each from one pass; what SQL can't say is compared with separate fits in the tests."""
    rows, _, _ = trends.backtest_cutoffs(_order_days(spark, sf), CUTOFFS, 30, 730)
    distance = F.abs(F.col("absolute_error") - F.abs(F.col("y") - F.col("yhat"))) < 1e-9
    return rounded(
        rows.withColumn("error_is_distance", distance), "y", digits=4
    ).select("zone", "cutoff", "date", "y", "error_is_distance", (F.col("yhat_lower") <= F.col("yhat_upper")).alias("band_in_order"))


@query(oracle(f"""SELECT zone, cutoff, training_days, (SELECT count(*) FROM order_days d WHERE d.zone = t.zone
    AND ds > cutoff AND ds <= cutoff + INTERVAL 30 DAY) AS actual_count, true AS rmse_above_mae FROM ({_TRAINED}) t
    WHERE actual_count > 0"""))
def backtest_cutoff_metrics(spark, sf):
    _, metrics, fits = trends.backtest_cutoffs(_order_days(spark, sf), CUTOFFS, 30, 730)
    return metrics.join(fits.select("zone", "cutoff", F.col("n").alias("training_days")), ["zone", "cutoff"]).select(
        "zone", "cutoff", "training_days", "actual_count", (F.col("rmse") >= F.col("mae") - 1e-6).alias("rmse_above_mae"),
    )


@query(oracle("""SELECT zone, count(*) AS training_rows, true AS optimal FROM latest_prices WHERE price_eur_mwh IS NOT NULL
    GROUP BY zone HAVING count(*) >= 100"""))
def piecewise_trend(spark, sf):
    """Every zone's fit meets the conditions of the penalised least squares that it solves."""
    model = trends.fit_piecewise(latest_prices(spark, sf), "timestamp_utc", "price_eur_mwh")
    return model.select("zone", F.col("n").alias("training_rows"), (F.col("residual") <= 1e-6).alias("optimal"))


@query(oracle("""SELECT zone, timestamp_utc + to_minutes(CAST(15 * step AS INTEGER)) AS timestamp_utc, CAST(step AS INTEGER) AS step
    FROM (SELECT zone, max(timestamp_utc) AS timestamp_utc FROM latest_prices WHERE price_eur_mwh IS NOT NULL
    GROUP BY zone HAVING count(*) >= 100), range(1, 97) s(step)"""))
def piecewise_forecast(spark, sf):
    """The 96 quarter hours after each zone's last price; every step has a forecast inside its simulated band."""
    prices = materialize(latest_prices(spark, sf).filter("price_eur_mwh IS NOT NULL"))
    model = materialize(trends.fit_piecewise(prices, "timestamp_utc", "price_eur_mwh"))
    steps = trends.forecast_piecewise(prices, model, "timestamp_utc")
    return steps.filter("yhat_lower <= yhat AND yhat <= yhat_upper").select("zone", "timestamp_utc", "step")


CTES["daily_mean"] = """SELECT zone, CAST(timestamp_utc AS DATE) AS ds, avg(price_eur_mwh) AS y FROM latest_prices
    GROUP BY ALL"""
CTES["naive_pairs"] = """SELECT t.zone, t.ds, t.y, b.y AS yhat FROM daily_mean t
    LEFT JOIN daily_mean b ON t.zone = b.zone AND t.ds = b.ds + 1"""


def naive_forecast(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Yesterday's mean as today's forecast."""
    actual = forecasting.daily_prices(latest_prices(spark, sf), "2024-01-01", "2024-01-30")
    yhat = F.col("y")
    forecast = actual.select(
        "zone", F.date_add("ds", 1).alias("ds"), yhat.alias("yhat"), (yhat - 5.0).alias("yhat_lower"),
        (yhat + 5.0).alias("yhat_upper"),
    )
    return actual, forecast


@query(oracle(f"""SELECT zone, ds AS date, {r('round(y, 4)', 3, 'actual_price_eur_mwh')},
    {r('round(yhat, 4)', 3, 'predicted_price_eur_mwh')}, {r('round(yhat - 5.0, 4)', 3, 'predicted_lower')},
    {r('round(yhat + 5.0, 4)', 3, 'predicted_upper')}, {r('round(abs(y - yhat), 4)', 3, 'absolute_error')}
    FROM naive_pairs WHERE yhat IS NOT NULL"""))
def backtest_join(spark, sf):
    rows = forecasting.backtest_rows(*naive_forecast(spark, sf))
    return rounded(rows, *[c for c in rows.columns if c not in ("zone", "date")], digits=3)


@query(oracle(f"""SELECT zone, {r('round(avg(abs(y - yhat)), 6)', 5, 'mae')},
    {r('round(sqrt(avg((y - yhat) * (y - yhat))), 6)', 5, 'rmse')},
    {r('round(100 * avg(abs((y - yhat) / nullif(y, 0))), 6)', 5, 'mape_pct')},
    {r('round(100 * avg(2 * abs(y - yhat) / nullif(abs(y) + abs(yhat), 0)), 6)', 5, 'smape_pct')},
    count(*) AS actual_count
    FROM naive_pairs WHERE yhat IS NOT NULL GROUP BY zone"""))
def backtest_metrics(spark, sf):
    actual, forecast = naive_forecast(spark, sf)
    pairs = actual.join(forecast, ["zone", "ds"])
    out = forecasting.backtest_metrics(pairs, "y", "yhat", ["zone"])
    return rounded(out, "mae", "rmse", "mape_pct", "smape_pct", digits=5)


@query(oracle("""SELECT 'regime' AS model_name, '1' AS version, 'fit-1' AS run_id, count(*) AS training_rows FROM training"""))
def model_lineage(spark, sf):
    """The record of the stored regime model."""
    _, record = _regime_model(spark, sf, materialize(training(spark, sf).withColumn("model_key", F.lit("regime"))))
    return spark.createDataFrame([record]).select("model_name", "version", "run_id", "training_rows")


@query(oracle("""SELECT zone, 'price_eur_mwh' AS forecast_target, count(*) AS feature_row_count,
    count(*) AS anomaly_row_count, count(*) FILTER (anomaly_score >= 0.6) AS anomaly_count,
    CAST(96 AS BIGINT) AS forecast_row_count FROM robust_score GROUP BY zone"""))
def intelligence_summary(spark, sf):
    result = intelligence.run(latest_prices(spark, sf), silver_generation(spark, sf), latest_load(spark, sf))
    return result.summary.drop("feature_cols")
