"""Platinum: carbon-adjusted prices, arbitrage, serving summary, what-if table, recommendations."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from voltmart.operators.gold import corridor_prices, score_stress
from voltmart.schemas import ARBITRAGE_CORRIDORS


def carbon_adjusted_prices(
    summary: DataFrame, stability: DataFrame, co2_eur_t: float = 60.0, fossil_kg_mwh: float = 400.0
) -> DataFrame:
    """Mean daily price plus the carbon cost of the fossil share (50 % where the share is unknown)."""
    share = stability.select("zone", F.col("event_date").alias("summary_date"), "renewable_share_pct")
    return (
        summary.join(share, ["zone", "summary_date"], "left")
        .withColumn("fossil_share_pct", F.coalesce(100.0 - F.col("renewable_share_pct"), F.lit(50.0)))
        .withColumn("carbon_premium_eur_mwh", F.col("fossil_share_pct") / 100.0 * co2_eur_t * fossil_kg_mwh / 1000.0)
        .withColumns(
            {
                "carbon_adjusted_price_avg": F.col("price_avg") + F.col("carbon_premium_eur_mwh"),
                "co2_price_eur_t": F.lit(co2_eur_t),
                "_platinum_ts": F.current_timestamp(),
            }
        )
    )


def arbitrage(
    prices: DataFrame, corridors: Sequence[tuple[str, str]] = ARBITRAGE_CORRIDORS, threshold: float = 5.0
) -> DataFrame:
    """Absolute price difference per corridor and interval; viable above the threshold."""
    spread = F.col("spread_eur_mwh")
    return (
        corridor_prices(prices, corridors)
        .withColumn("spread_eur_mwh", F.abs(F.col("price_a") - F.col("price_b")))
        .withColumn("is_viable", spread > threshold)
        .withColumns(
            {
                "arbitrage_potential_eur_mwh": F.when(F.col("is_viable"), spread).otherwise(F.lit(0.0)),
                "_platinum_ts": F.current_timestamp(),
            }
        )
    )


def serving_summary(stability: DataFrame, carbon: DataFrame, weather: DataFrame, fx: DataFrame) -> DataFrame:
    """Daily rows with mean carbon intensity, wind and radiation of their zone, and the newest exchange rate.

    The rate is one value, read as a scalar subquery.
    """
    by_zone = carbon.groupBy(F.col("zone").alias("country_code")).agg(
        F.avg("carbon_intensity_gco2_kwh").alias("carbon_intensity_gco2_kwh")
    )
    climate = weather.groupBy(F.col("zone").alias("country_code")).agg(
        F.avg("wind_speed_m_s").alias("wind_speed_m_s_avg"),
        F.avg("solar_radiation_w_m2").alias("solar_radiation_w_m2_avg"),
    )
    rate = fx.agg(F.max_by("fx_rate", F.col("timestamp").cast("string"))).scalar()
    total = F.coalesce("total_generation", F.lit(0.0))
    spread = F.coalesce("volatility_index", F.lit(0.0))
    intensity = F.col("carbon_intensity_gco2_kwh")
    return (
        stability.join(by_zone, "country_code", "left")
        .join(climate, "country_code", "left")
        .withColumns(
            {
                "fx_rate_to_eur": rate,
                "stability_score": F.round(F.greatest(F.lit(0.0), total - spread), 3),
                "carbon_efficiency_score": F.when(
                    intensity.isNotNull(), F.round(total / F.greatest(intensity, F.lit(1.0)), 6)
                ),
            }
        )
    )


@dataclass(frozen=True)
class Scenario:
    name: str
    wind_drop_pct: float = 0.0
    solar_drop_pct: float = 0.0
    load_increase_pct: float = 0.0
    import_constraint_pct: float = 0.0
    price_shock_eur_mwh: float = 0.0


# The four default what-if cases.
DEFAULT_SCENARIOS = [
    Scenario("wind_drop_20pct", wind_drop_pct=20.0),
    Scenario("load_increase_10pct", load_increase_pct=10.0),
    Scenario("import_constraint_30pct", import_constraint_pct=30.0),
    Scenario(
        "combined_stress_case", wind_drop_pct=20.0, load_increase_pct=10.0, import_constraint_pct=20.0,
        price_shock_eur_mwh=50.0,
    ),
]


def scenario_array(scenarios: Sequence[Scenario] = DEFAULT_SCENARIOS) -> Column:
    """The parameter table as an array literal: rows are multiplied in place, without a join."""
    return F.array(
        *[F.struct(*[F.lit(v).alias(k) for k, v in vars(s).items()]) for s in scenarios]
    )


def scenario_inputs(stress: DataFrame, scenarios: Sequence[Scenario] = DEFAULT_SCENARIOS) -> DataFrame:
    """Every (zone, day) with every scenario's parameters."""
    return stress.select("country_code", "event_date", F.inline(scenario_array(scenarios)))


def what_if(stress: DataFrame, scenarios: Sequence[Scenario] = DEFAULT_SCENARIOS) -> DataFrame:
    """Stress re-scored under each scenario. Load and price shocks move inputs the score does not use."""
    cases = stress.withColumnRenamed("stress_score", "_keep_baseline").select(
        "*", F.inline(scenario_array(scenarios))
    )
    penalty = F.col("wind_drop_pct") * 0.7 + F.col("solar_drop_pct") * 0.3
    shock = F.col("price_shock_eur_mwh")
    changed = cases.withColumns(
        {
            "renewable_share_pct": F.greatest(F.lit(0.0), F.col("renewable_share_pct") * (1 - penalty / 100.0)),
            "avg_load_mw": F.col("avg_load_mw") * (1 + F.col("load_increase_pct") / 100.0),
            "avg_price_eur_mwh": F.col("avg_price_eur_mwh") + shock,
            "max_price_eur_mwh": F.col("max_price_eur_mwh") + shock,
            "renewable_volatility_index": F.col("renewable_volatility_index")
            + F.col("import_constraint_pct") / 100.0,
            "_keep_name": F.col("name"),
        }
    )
    score, base = F.col("stress_score"), F.col("_keep_baseline")
    return score_stress(changed).select(
        F.md5(F.concat_ws("|", "_keep_name", "country_code", "event_date")).alias("scenario_id"),
        F.col("_keep_name").alias("name"),
        F.col("country_code").alias("zone"),
        "event_date",
        base.alias("baseline_stress_score"),
        score.alias("simulated_stress_score"),
        F.round(score - base, 4).alias("stress_delta"),
        F.col("stress_label").alias("simulated_label"),
        _advice().alias("recommendation"),
        F.current_timestamp().alias("generated_at_utc"),
    )


# Advice texts.
_ADVICE = {
    "LOW_RENEWABLE_SHARE": "Inspect renewable shortfall, import capacity, and reserve margins.",
    "PRICE_SPIKES": "Trigger price-spike review and compare spikes against renewable dips.",
    "LOAD_FORECAST_ERROR": "Review load forecast drift and weather assumptions.",
}
_NO_ADVICE = "No urgent action. Continue monitoring."
_SHORTFALL_TEXT = "Review renewable shortfall versus imports, load, and price spikes."
_SPIKE_TEXT = (
    "Produce a price-spike explanation and compare against renewable share and load forecast error."
)


def _advice() -> Column:
    urgent = F.col("stress_label").isin("CRITICAL", "HIGH")
    options = [F.when(urgent & (F.col("main_driver") == d), F.lit(text)) for d, text in _ADVICE.items()]
    return F.coalesce(*options, F.lit(_NO_ADVICE))


def recommendations(stress: DataFrame) -> DataFrame:
    """Zero to three rows per stress row: market stress, renewable shortfall, price spike."""
    label = F.col("stress_label")
    urgent = label.isin("HIGH", "CRITICAL")

    def item(severity: Column, category: str, text: Column, evidence: Sequence[str]) -> Column:
        return F.struct(
            severity.alias("severity"), F.lit(category).alias("category"), text.alias("recommendation"),
            F.to_json(F.struct(*evidence)).alias("evidence"),
        )

    items = F.array(
        F.when(
            urgent,
            item(
                label, "MARKET_STRESS",
                F.format_string(
                    "Investigate %s as the primary cause of %s stress.", "main_driver", F.lower(label)
                ),
                ["stress_score", "stress_label", "main_driver", "finding_summary"],
            ),
        ),
        F.when(
            F.coalesce("renewable_share_pct", F.lit(0.0)) < 35.0,
            item(
                F.when(label == "LOW", "MEDIUM").otherwise(label), "RENEWABLE_SHORTFALL", F.lit(_SHORTFALL_TEXT),
                ["renewable_share_pct", "stress_score"],
            ),
        ),
        F.when(
            F.coalesce("price_spike_count", F.lit(0)) > 0,
            item(
                F.when(urgent, "HIGH").otherwise("MEDIUM"), "PRICE_SPIKE", F.lit(_SPIKE_TEXT),
                ["price_spike_count", "max_price_eur_mwh"],
            ),
        ),
    )
    return stress.select(
        F.col("country_code").alias("zone"), "event_date",
        F.inline(F.filter(items, lambda i: i.isNotNull())),
    ).withColumns(
        {
            "recommendation_id": F.md5(F.concat_ws("|", "category", "zone", "event_date")),
            "created_at_utc": F.current_timestamp(),
        }
    )
