"""Declared schemas, contracts, quality rules and reference data.

Everything here is plain data. Bronze readers always apply these schemas, so no job infers types from values.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
}


def struct(spec: str) -> T.StructType:
    """Build a StructType from ``"name type[!], ..."``; a trailing ``!`` marks a required column."""
    fields = []
    for part in spec.split(","):
        name, type_name = part.split()
        fields.append(T.StructField(name, _TYPES[type_name.rstrip("!")], not type_name.endswith("!")))
    return T.StructType(fields)


# ---------------------------------------------------------------------------
# Row schemas.
# ---------------------------------------------------------------------------
PRICE_SCHEMA = struct(
    "zone string!, timestamp_utc timestamp!, price_eur_mwh double, resolution_minutes integer!, "
    "_source string!, _fetched_at timestamp!"
)
GENERATION_SCHEMA = struct(
    "zone string!, timestamp_utc timestamp!, psr_type string!, generation_mw double, is_renewable boolean!, "
    "_source string!, _fetched_at timestamp!"
)
LOAD_SCHEMA = struct(
    "zone string!, timestamp_utc timestamp!, actual_load_mw double, forecast_load_mw double, "
    "forecast_error_mw double, _source string!, _fetched_at timestamp!"
)
FLOW_SCHEMA = struct(
    "zone_from string!, zone_to string!, timestamp_utc timestamp!, flow_mw double, direction string!, "
    "_source string!, _fetched_at timestamp!"
)
DQ_STATS_SCHEMA = struct(
    "run_id string!, rule_set_name string!, target_table string!, total_rows long!, passed_rows long!, "
    "failed_rows long!, pass_rate double!, validated_at timestamp!"
)
PIPELINE_RUN_SCHEMA = struct(
    "run_id string!, pipeline_name string!, task_name string!, started_at timestamp!, finished_at timestamp, "
    "rows_read long!, rows_written long!, rows_quarantined long!, dq_pass_rate double, status string!, "
    "error_message string"
)
INCIDENT_SCHEMA = struct(
    "incident_id string!, detected_at timestamp!, pipeline_run_id string!, severity string!, "
    "affected_clients_est integer, impacted_value_eur double, duration_minutes integer, is_cross_border boolean!, "
    "classification_reason string, eba_reportable boolean!, created_at timestamp!"
)
ERASURE_SCHEMA = struct(
    "erasure_id string!, entity_id string!, requested_at timestamp!, completed_at timestamp, status string!, "
    "bronze_rows_deleted long, silver_rows_deleted long, gold_rows_deleted long, operator string"
)
REGIME_SIGNAL_SCHEMA = struct(
    "signal_id string!, zone string!, timestamp_utc timestamp!, price_eur_mwh double, price_z_score double, "
    "anomaly_score double, regime_label string, regime_confidence double, model_version string, "
    "model_run_id string, feature_lag_1h double, feature_lag_24h double, feature_res_share double, "
    "scored_at timestamp!"
)
WATERMARK_SCHEMA = struct(
    "dataset string!, entity string!, watermark string, rows long, status string, last_error string, "
    "updated_at timestamp"
)

# ---------------------------------------------------------------------------
# Bidding zones, corridors, production types.
# ---------------------------------------------------------------------------
ZONE_EIC = {
    "NL": "10YNL----------L",
    "DE": "10Y1001A1001A83F",
    "DK-1": "10YDK-1--------W",
    "DK-2": "10YDK-2--------M",
    "FR": "10YFR-RTE------C",
    "BE": "10YBE----------2",
    "RO": "10YRO-TEL------P",
    "HU": "10YHU-MAVIR----U",
}
DEFAULT_ZONES = ["NL", "DE", "DK-1", "DK-2", "FR", "BE", "RO"]
FLOW_CORRIDORS = [
    ("NL", "DE"), ("DE", "NL"), ("DE", "DK-1"), ("DK-1", "DE"), ("DK-1", "DK-2"), ("DK-2", "DK-1"),
    ("NL", "FR"), ("FR", "NL"), ("BE", "NL"), ("NL", "BE"), ("BE", "DE"), ("DE", "BE"),
    ("FR", "BE"), ("BE", "FR"), ("RO", "HU"), ("HU", "RO"),
]
SPREAD_CORRIDORS = [("NL", "DE"), ("DE", "DK-1"), ("DK-1", "DK-2"), ("NL", "DK-1")]
ARBITRAGE_CORRIDORS = [
    ("NL", "DE"), ("DE", "DK-1"), ("DK-1", "DK-2"), ("NL", "FR"), ("BE", "NL"), ("BE", "DE"),
]
FLOW_PARTNERS = {
    "RO": "HU", "HU": "RO", "NL": "DE", "DE": "NL", "FR": "BE", "BE": "FR", "DK-1": "DE", "DK-2": "DK-1",
}
RENEWABLE_TYPES = [
    "Solar", "Wind Offshore", "Wind Onshore", "Hydro Water Reservoir", "Hydro Run-of-river and poundage",
    "Biomass", "Geothermal", "Other renewable",
]
PII_NAME_PATTERNS = ["iban", "email", "name", "phone", "address", "bic"]


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: str
    severity: str = "CRITICAL"


def _rules(*rows: tuple[str, ...]) -> list[Rule]:
    return [Rule(*row) for row in rows]


# ---------------------------------------------------------------------------
# Rule sets. CRITICAL rules reject rows, WARNING rules only count.
# ---------------------------------------------------------------------------
RULES: dict[str, list[Rule]] = {
    "bronze_prices": _rules(
        ("zone_not_null", "zone IS NOT NULL"),
        ("timestamp_not_null", "timestamp_utc IS NOT NULL"),
        ("batch_id_not_null", "_batch_id IS NOT NULL", "WARNING"),
    ),
    "silver_prices": _rules(
        ("zone_not_null", "zone IS NOT NULL"),
        ("timestamp_not_null", "timestamp_utc IS NOT NULL"),
        ("price_not_null", "price_eur_mwh IS NOT NULL"),
        ("price_below_cap", "price_eur_mwh < 5000"),
        ("price_above_floor", "price_eur_mwh > -600"),
        ("zone_valid", "zone IN ('NL', 'DE', 'DK-1', 'DK-2', 'FR', 'BE')", "WARNING"),
        ("z_score_not_null", "price_z_score IS NOT NULL", "WARNING"),
    ),
    "silver_generation": _rules(
        ("zone_not_null", "zone IS NOT NULL"),
        ("timestamp_not_null", "timestamp_utc IS NOT NULL"),
        ("psr_type_not_null", "psr_type IS NOT NULL"),
        ("generation_non_neg", "generation_mw IS NULL OR generation_mw >= 0"),
        ("is_renewable_set", "is_renewable IS NOT NULL", "WARNING"),
        ("share_in_range", "renewable_share_pct IS NULL OR renewable_share_pct BETWEEN 0 AND 100", "WARNING"),
    ),
    "silver_load": _rules(
        ("zone_not_null", "zone IS NOT NULL"),
        ("timestamp_not_null", "timestamp_utc IS NOT NULL"),
        ("not_both_null", "NOT (actual_load_mw IS NULL AND forecast_load_mw IS NULL)"),
        ("actual_non_neg", "actual_load_mw IS NULL OR actual_load_mw >= 0", "WARNING"),
        ("forecast_non_neg", "forecast_load_mw IS NULL OR forecast_load_mw >= 0", "WARNING"),
        ("price_reasonable", "actual_load_mw IS NULL OR actual_load_mw < 200000", "WARNING"),
    ),
    "silver_flows": _rules(
        ("zone_from_not_null", "zone_from IS NOT NULL"),
        ("zone_to_not_null", "zone_to IS NOT NULL"),
        ("timestamp_not_null", "timestamp_utc IS NOT NULL"),
        ("flow_not_null", "flow_mw IS NOT NULL"),
        ("flow_physical_range", "abs(flow_mw) < 20000", "WARNING"),
        ("corridor_not_null", "corridor IS NOT NULL", "WARNING"),
    ),
    "PRICE_RULES": _rules(
        ("price_not_null", "price_eur_mwh IS NOT NULL"),
        ("price_below_cap", "price_eur_mwh < 5000"),
        ("price_above_floor", "price_eur_mwh > -600"),
        ("zone_not_null", "zone IS NOT NULL"),
        ("zone_valid", "zone IN ('NL', 'DE', 'DK-1', 'DK-2')"),
        ("timestamp_not_null", "timestamp_utc IS NOT NULL"),
    ),
    "GENERATION_RULES": _rules(
        ("generation_not_negative", "generation_mw >= 0"),
        ("psr_type_not_null", "psr_type IS NOT NULL"),
        ("zone_not_null", "zone IS NOT NULL"),
        ("is_renewable_not_null", "is_renewable IS NOT NULL"),
    ),
    "LOAD_RULES": _rules(
        ("actual_load_non_negative", "actual_load_mw IS NULL OR actual_load_mw >= 0"),
        ("forecast_load_non_negative", "forecast_load_mw IS NULL OR forecast_load_mw >= 0"),
        ("not_both_null", "NOT (actual_load_mw IS NULL AND forecast_load_mw IS NULL)"),
        ("zone_not_null", "zone IS NOT NULL"),
    ),
    "FLOW_RULES": _rules(
        ("flow_not_null", "flow_mw IS NOT NULL"),
        ("flow_in_physical_range", "abs(flow_mw) < 20000"),
        ("zone_from_not_null", "zone_from IS NOT NULL"),
        ("zone_to_not_null", "zone_to IS NOT NULL"),
    ),
}


@dataclass(frozen=True)
class Contract:
    name: str
    keys: tuple[str, ...]
    schema: T.StructType
    freshness_minutes: int | None = 1440


# ---------------------------------------------------------------------------
# Table contracts.
# ---------------------------------------------------------------------------
CONTRACTS: dict[str, Contract] = {
    c.name: c
    for c in [
        Contract(
            "bronze_prices", ("zone", "timestamp_utc", "_batch_id"),
            struct(
                "zone string!, timestamp_utc timestamp!, price_eur_mwh double, resolution_minutes integer!, "
                "_source string!, _ingest_ts timestamp!, _batch_id string!"
            ),
        ),
        Contract(
            "silver_prices", ("zone", "timestamp_utc"),
            struct(
                "zone string!, timestamp_utc timestamp!, price_eur_mwh double, price_z_score double, "
                "is_negative_price boolean!, _silver_ts timestamp!"
            ),
        ),
        Contract(
            "silver_generation", ("zone", "timestamp_utc", "psr_type"),
            struct(
                "zone string!, timestamp_utc timestamp!, psr_type string!, generation_mw double, "
                "is_renewable boolean!, renewable_share_pct double, _silver_ts timestamp!"
            ),
        ),
        Contract(
            "silver_load", ("zone", "timestamp_utc"),
            struct(
                "zone string!, timestamp_utc timestamp!, actual_load_mw double, forecast_load_mw double, "
                "abs_forecast_error_mw double, _silver_ts timestamp!"
            ),
        ),
        Contract(
            "silver_flows", ("zone_from", "zone_to", "timestamp_utc"),
            struct(
                "zone_from string!, zone_to string!, timestamp_utc timestamp!, flow_mw double, corridor string!, "
                "_silver_ts timestamp!"
            ),
        ),
        Contract(
            "gold_renewable_stability", ("zone", "event_date"),
            struct(
                "zone string!, event_date date!, total_generation_mwh double, renewable_generation_mwh double, "
                "renewable_share_pct double, renewable_share_7d_avg double, renewable_volatility_index double, "
                "renewable_dip_flag boolean, record_created_ts timestamp"
            ),
        ),
        Contract(
            "gold_price_spike_analysis", ("zone", "timestamp_utc"),
            struct(
                "zone string!, timestamp_utc timestamp!, price_eur_mwh double, price_24h_avg double, "
                "price_24h_stddev double, price_z_score double, price_spike_flag boolean, "
                "negative_price_flag boolean, record_created_ts timestamp"
            ),
        ),
        Contract(
            "gold_market_summary", ("zone", "summary_date"),
            struct(
                "zone string!, summary_date date!, price_open double, price_close double, price_high double, "
                "price_low double, price_avg double, price_stddev double, negative_price_count integer, "
                "peak_price_avg double, offpeak_price_avg double, total_load_mwh double, "
                "forecast_error_avg_mw double, renewable_share_avg_pct double, record_created_ts timestamp"
            ),
        ),
        # Serving-side contracts checked on rows (types string, double, integer, boolean).
        Contract(
            "generation_load_rows", (),
            struct("zone string!, timestamp_utc string!, quantity double, source_file string!"), None,
        ),
        Contract(
            "import_dependency_rows", (),
            struct("zone string!, imports_mw double, demand_mw double, import_dependency_ratio double"), None,
        ),
        Contract(
            "price_spike_rows", (),
            struct("zone string!, price_eur_mwh double, is_price_spike boolean!"), None,
        ),
        Contract(
            "renewable_stability_rows", (),
            struct(
                "country_code string!, total_generation double, avg_generation double, max_generation double, "
                "min_generation double, volatility_index double"
            ), None,
        ),
        Contract(
            "energy_timeseries_rows", (),
            struct("zone string!, timestamp_utc string!, generation_mw double, renewable_share_pct double"), None,
        ),
    ]
}
