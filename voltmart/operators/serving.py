"""Ready queries over the marts. Limits are part of each report; ties are broken by the remaining key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def top_stress(stress: DataFrame, n: int = 20) -> DataFrame:
    return stress.select(
        F.col("country_code").alias("zone"), "event_date", "stress_score", "stress_label", "main_driver",
        "finding_summary",
    ).orderBy(F.desc("event_date"), F.desc("stress_score"), "zone").limit(n)


def top_renewable(stability: DataFrame, n: int = 20) -> DataFrame:
    return stability.select(
        "zone", "event_date", "renewable_share_pct", "renewable_volatility_index", "renewable_dip_flag"
    ).orderBy(F.desc("event_date"), F.desc("renewable_volatility_index"), "zone").limit(n)


def newest_spikes(spikes: DataFrame, n: int = 50) -> DataFrame:
    return (
        spikes.filter(F.col("price_spike_flag") | F.col("negative_price_flag"))
        .select(
            "zone", "timestamp_utc", "price_eur_mwh", "price_z_score", "price_spike_flag", "negative_price_flag"
        )
        .orderBy(F.desc("timestamp_utc"), "zone")
        .limit(n)
    )


def latest_summary(summary: DataFrame, n: int = 20) -> DataFrame:
    return summary.orderBy(F.desc("summary_date"), "zone").limit(n)


def run_dashboard(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.desc("started_at"), "run_id", "task_name").select(
        "pipeline_name", "task_name", "status", "rows_read", "rows_written"
    )


def spike_dashboard(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("is_price_spike")).select("zone", "price_eur_mwh", "is_price_spike")


def stability_dashboard(rows: DataFrame) -> DataFrame:
    return rows.select("country_code", "total_generation", "volatility_index").orderBy(
        F.desc("total_generation"), "country_code"
    )


def report_stress_days(stress: DataFrame, n: int = 10) -> DataFrame:
    return stress.select(
        F.col("country_code").alias("zone"), "event_date", "stress_label", "stress_score", "main_driver",
        "finding_summary",
    ).orderBy(F.desc("event_date"), F.desc("stress_score"), "zone").limit(n)


def report_scenarios(scenarios: DataFrame, n: int = 10) -> DataFrame:
    return scenarios.select(
        "scenario_id", "zone", "event_date", "baseline_stress_score", "simulated_stress_score", "stress_delta",
        "recommendation",
    ).orderBy("event_date", "zone", "scenario_id").limit(n)


def report_recommendations(recommendations: DataFrame, n: int = 10) -> DataFrame:
    return recommendations.select("severity", "category", "zone", "event_date", "recommendation").orderBy(
        "event_date", "zone", "category"
    ).limit(n)
