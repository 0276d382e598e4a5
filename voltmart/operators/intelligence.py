"""End-to-end scoring job: features, anomaly scores, forecasts and forecast risks for all zones."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from voltmart.operators import ensembles
from voltmart.operators.features import active_features, local_features
from voltmart.operators.forecasting import forecast_risk, forecast_target
from voltmart.operators.scoring import label_anomalies, robust_scores
from voltmart.session import materialize


@dataclass(frozen=True)
class Intelligence:
    features: DataFrame
    anomalies: DataFrame
    forecasts: DataFrame
    risks: DataFrame
    summary: DataFrame


#: The scoring models of ``run``.
MODELS = ("robust_zscore_fallback", "isolation_forest")


def score_zones(features: DataFrame, model_type: str = MODELS[0], trees: int = 100) -> DataFrame:
    """``features`` (stored) with anomaly score, flag, label and model type by the zone's own active features.

    The robust scores measure the distance to the zone's median; the forest isolates rows by the zone's own trees.
    """
    if model_type == "isolation_forest":
        scored = ensembles.anomalies(features, materialize(ensembles.fit(features, trees=trees)))
        return label_anomalies(scored.drop("isolation_score"), model_type)
    if model_type != MODELS[0]:
        raise ValueError(f"model type {model_type} is none of {MODELS}")
    return label_anomalies(robust_scores(features), model_type)


def run(
    prices: DataFrame, generation: DataFrame, load: DataFrame, horizon: int = 96, model_type: str = MODELS[0]
) -> Intelligence:
    """Feature rows are stored once; every later pass reads the stored table."""
    features = materialize(local_features(prices, generation, load))
    anomalies = score_zones(features, model_type)
    forecasts = forecast_target(features, horizon)
    risks = forecast_risk(forecasts.filter("forecast_target = 'price_eur_mwh'")).unionByName(
        forecasts.filter("forecast_target <> 'price_eur_mwh'"), allowMissingColumns=True
    )
    counts = features.groupBy("zone").agg(F.count("*").alias("feature_row_count"))
    steps = forecasts.groupBy("zone", "forecast_target").agg(F.count("*").alias("forecast_row_count"))
    flagged = anomalies.groupBy("zone").agg(
        F.count("*").alias("anomaly_row_count"), F.count_if("is_anomaly").alias("anomaly_count")
    )
    summary = counts.join(flagged, "zone").join(steps, "zone").join(active_features(features), "zone")
    return Intelligence(features, anomalies, forecasts, risks, summary)
