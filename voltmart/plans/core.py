"""Queries over Silver, quality, features, Gold, Platinum and serving operators, with their SQL oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from voltmart.operators import features, gold, platinum, quality, serving, silver
from voltmart.plans import market_views as views
from voltmart.plans.registry import CTES, ORACLES, oracle, query, r, rounded
from voltmart.schemas import ARBITRAGE_CORRIDORS, RULES, SPREAD_CORRIDORS
from voltmart.session import materialize, scratch_path

LATEST = ("_ingest_ts",)

# ---------------------------------------------------------------------------
# Shared inputs in Spark and as SQL
# ---------------------------------------------------------------------------


def silver_prices(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_prices(views.prices(spark, sf))[0].drop("_silver_ts")


def latest_prices(spark: SparkSession, sf: str) -> DataFrame:
    """Deduplicated prices without the z-score, for marts that do not read it."""
    return silver.latest_per_key(
        views.prices(spark, sf).filter("price_eur_mwh IS NOT NULL"), ["zone", "timestamp_utc"], "_ingest_ts"
    )


def silver_generation(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_generation(views.generation(spark, sf), LATEST)[0].drop("_silver_ts")


def latest_load(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_load(views.load(spark, sf), ("_ingest_ts",))[0].drop("_silver_ts")


def silver_flows(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_flows(views.flows(spark, sf))[0].drop("_silver_ts")


CTES.update(
    {
        "latest_prices": """SELECT * FROM prices WHERE price_eur_mwh IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY zone, timestamp_utc ORDER BY _ingest_ts DESC) = 1""",
        "s_prices": """SELECT zone, timestamp_utc, price_eur_mwh, _ingest_ts, price_eur_mwh < 0 AS is_negative_price,
            CASE WHEN sd > 0 THEN (price_eur_mwh - av) / sd ELSE 0.0 END AS price_z_score
            FROM (SELECT *, avg(price_eur_mwh) OVER w AS av, stddev_samp(price_eur_mwh) OVER w AS sd FROM latest_prices
            WINDOW w AS (PARTITION BY zone ORDER BY timestamp_utc
                         RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND CURRENT ROW))""",
        "s_generation": """SELECT *, CASE WHEN sum(generation_mw) OVER w > 0 THEN
            sum(CASE WHEN is_renewable THEN generation_mw ELSE 0.0 END) OVER w / sum(generation_mw) OVER w * 100.0
            ELSE 0.0 END AS renewable_share_pct
            FROM (SELECT * FROM generation WHERE generation_mw IS NOT NULL QUALIFY row_number() OVER (
                PARTITION BY zone, timestamp_utc, psr_type ORDER BY _ingest_ts DESC) = 1)
            WINDOW w AS (PARTITION BY zone, timestamp_utc)""",
        "s_load_all": """SELECT *, abs(actual_load_mw - forecast_load_mw) AS abs_forecast_error_mw FROM load
            WHERE NOT (actual_load_mw IS NULL AND forecast_load_mw IS NULL)""",
        "s_load": """SELECT * FROM s_load_all
            QUALIFY row_number() OVER (PARTITION BY zone, timestamp_utc ORDER BY _ingest_ts DESC) = 1""",
        "s_flows": """SELECT *, least(zone_from, zone_to) || '-' || greatest(zone_from, zone_to) AS corridor
            FROM flows WHERE flow_mw IS NOT NULL""",
        "daily_gen": """SELECT *, CASE WHEN total_generation_mwh > 0
            THEN renewable_generation_mwh / total_generation_mwh * 100.0 ELSE 0.0 END AS renewable_share_pct
            FROM (SELECT zone, CAST(timestamp_utc AS DATE) AS event_date, sum(generation_mw) AS total_generation_mwh,
            sum(CASE WHEN is_renewable THEN generation_mw ELSE 0.0 END) AS renewable_generation_mwh
            FROM s_generation GROUP BY ALL)""",
        "stability": """SELECT *, CASE WHEN renewable_share_7d_avg > 0
            THEN renewable_share_7d_stddev / renewable_share_7d_avg ELSE 0.0 END AS renewable_volatility_index,
            renewable_share_pct < renewable_share_7d_avg - renewable_share_7d_stddev AS renewable_dip_flag
            FROM (SELECT *, avg(renewable_share_pct) OVER w AS renewable_share_7d_avg,
            stddev_samp(renewable_share_pct) OVER w AS renewable_share_7d_stddev FROM daily_gen
            WINDOW w AS (PARTITION BY zone ORDER BY event_date ROWS BETWEEN 7 PRECEDING AND CURRENT ROW))""",
        "spikes": """SELECT *, price_z_score > 2.0 AS price_spike_flag, price_eur_mwh < 0 AS negative_price_flag
            FROM (SELECT zone, timestamp_utc, price_eur_mwh, price_24h_avg, price_24h_stddev,
            CASE WHEN price_24h_stddev > 0 THEN (price_eur_mwh - price_24h_avg) / price_24h_stddev ELSE 0.0 END
            AS price_z_score FROM (SELECT *, avg(price_eur_mwh) OVER w AS price_24h_avg,
            stddev_samp(price_eur_mwh) OVER w AS price_24h_stddev FROM latest_prices
            WINDOW w AS (PARTITION BY zone ORDER BY timestamp_utc
                         RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW)))""",
        "ohlc": """SELECT zone, CAST(timestamp_utc AS DATE) AS summary_date,
            arg_min(price_eur_mwh, timestamp_utc) AS price_open, arg_max(price_eur_mwh, timestamp_utc) AS price_close,
            max(price_eur_mwh) AS price_high, min(price_eur_mwh) AS price_low, avg(price_eur_mwh) AS price_avg,
            stddev_samp(price_eur_mwh) AS price_stddev,
            CAST(count(*) FILTER (price_eur_mwh < 0) AS BIGINT) AS negative_price_count,
            avg(price_eur_mwh) FILTER (hour(timestamp_utc) >= 8 AND hour(timestamp_utc) < 20) AS peak_price_avg,
            avg(price_eur_mwh) FILTER (hour(timestamp_utc) < 8 OR hour(timestamp_utc) >= 20) AS offpeak_price_avg
            FROM latest_prices GROUP BY ALL""",
        "load_daily": """SELECT zone, CAST(timestamp_utc AS DATE) AS event_date, sum(actual_load_mw) AS total_load_mwh,
            avg(abs_forecast_error_mw) AS forecast_error_avg_mw FROM s_load GROUP BY ALL""",
        "gen_shares": """SELECT zone, CAST(timestamp_utc AS DATE) AS event_date,
            avg(renewable_share_pct) AS renewable_share_avg_pct,
            sum(CASE WHEN is_renewable THEN generation_mw ELSE 0.0 END) AS total_renewable_mwh
            FROM s_generation GROUP BY ALL""",
        "m_summary": """SELECT o.*, total_load_mwh, forecast_error_avg_mw, renewable_share_avg_pct FROM ohlc o
            LEFT JOIN load_daily l ON o.zone = l.zone AND o.summary_date = l.event_date
            LEFT JOIN gen_shares g ON o.zone = g.zone AND o.summary_date = g.event_date""",
    }
)

# ---------------------------------------------------------------------------
# Silver
# ---------------------------------------------------------------------------


@query(oracle(f"SELECT zone, timestamp_utc, price_eur_mwh, {r('price_z_score')}, is_negative_price FROM s_prices"),
       name="silver_prices")
def _silver_prices(spark, sf):
    return rounded(silver_prices(spark, sf), "price_z_score").drop("_ingest_ts")


@query(oracle("SELECT zone, timestamp_utc, _ingest_ts, 'null_price' AS _quarantine_reason FROM prices "
              "WHERE price_eur_mwh IS NULL"))
def quarantine_prices(spark, sf):
    invalid = silver.silver_prices(views.prices(spark, sf))[1]
    return silver.tag_quarantine(invalid, "null_price").drop("price_eur_mwh")


@query(oracle(f"""SELECT zone, timestamp_utc, psr_type, generation_mw, is_renewable, {r('renewable_share_pct')}
              FROM s_generation"""), name="silver_generation")
def _silver_generation(spark, sf):
    return rounded(silver_generation(spark, sf), "renewable_share_pct").drop("_ingest_ts")


@query(oracle("SELECT zone, psr_type, count(*) AS quarantined FROM generation WHERE generation_mw IS NULL "
              "GROUP BY ALL"))
def quarantine_generation(spark, sf):
    invalid = silver.silver_generation(views.generation(spark, sf), LATEST)[1]
    return invalid.groupBy("zone", "psr_type").agg(F.count("*").alias("quarantined"))


@query(oracle(f"""SELECT zone, timestamp_utc, _ingest_ts, {r('actual_load_mw')}, {r('forecast_load_mw')},
              {r('abs_forecast_error_mw')} FROM s_load_all"""))
def silver_load(spark, sf):
    valid = silver.silver_load(views.load(spark, sf))[0].drop("_silver_ts")
    return rounded(valid, "actual_load_mw", "forecast_load_mw", "abs_forecast_error_mw")


@query(oracle("SELECT zone_from, zone_to, timestamp_utc, flow_mw, corridor, _ingest_ts FROM s_flows"),
       name="silver_flows")
def _silver_flows(spark, sf):
    return silver_flows(spark, sf)


@query(oracle("""SELECT zone, timestamp_utc, _ingest_ts, price_eur_mwh FROM prices
    QUALIFY row_number() OVER (PARTITION BY zone, timestamp_utc ORDER BY _ingest_ts) = 1"""))
def deduplicate_keep_first(spark, sf):
    return silver.deduplicate(views.prices(spark, sf), ["zone", "timestamp_utc"], "_ingest_ts")


def raw_points(spark: SparkSession, sf: str) -> DataFrame:
    """Raw generation points: country, file, position, value (some negative), arrival number."""
    return views.table(spark, sf, "events").select(
        views.zone_of(F.col("user_id")).alias("country_code"),
        F.concat(F.lit("batch_"), F.date_format("ts", "yyyyMMdd")).alias("source_file"),
        F.when(F.col("event_id") % 13 != 0, (F.hour("ts") * 4 + F.floor(F.minute("ts") / 15) + 1).cast("int"))
        .alias("position"),
        F.when(F.col("event_id") % 101 != 0, F.round(F.col("value") * 2 - 20, 2)).alias("quantity"),
        F.col("event_id").alias("row_no"),
    )


CTES.update(
    {
        "raw_points": """SELECT zone AS country_code, 'batch_' || strftime(ts, '%Y%m%d') AS source_file,
            CASE WHEN event_id % 13 <> 0 THEN CAST(hour(ts) * 4 + minute(ts) // 15 + 1 AS INTEGER) END AS position,
            price_eur_mwh AS quantity, event_id AS row_no FROM events JOIN prices ON event_id = _ingest_ts""",
        "first_points": """SELECT * FROM raw_points QUALIFY row_number() OVER (
            PARTITION BY country_code, position, source_file ORDER BY row_no) = 1""",
    }
)


@query(oracle("SELECT * FROM first_points"))
def deduplicate_generation_points(spark, sf):
    return silver.deduplicate_generation(raw_points(spark, sf), "row_no")


@query(oracle("SELECT row_no, quantity, coalesce(quantity >= 0, false) AS is_valid FROM raw_points"))
def split_measurements(spark, sf):
    valid, bad = silver.split_measurements(raw_points(spark, sf))
    return valid.withColumn("is_valid", F.lit(True)).unionByName(bad.withColumn("is_valid", F.lit(False))).select(
        "row_no", "quantity", "is_valid"
    )


@query(oracle("""SELECT row_no, quantity, CASE WHEN coalesce(quantity >= 0, false) THEN NULL
              ELSE 'invalid_quantity' END AS _quarantine_reason FROM first_points"""))
def silver_generation_points(spark, sf):
    valid, bad = silver.silver_generation_rows(raw_points(spark, sf), "row_no")
    return valid.unionByName(silver.tag_quarantine(bad, "invalid_quantity"), allowMissingColumns=True).select(
        "row_no", "quantity", "_quarantine_reason"
    )


@query(oracle("""SELECT row_no, ts AS event_timestamp_utc, CAST(ts AS DATE) AS event_date FROM (
    SELECT row_no, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(15 * (coalesce(position,
    row_number() OVER (PARTITION BY source_file ORDER BY row_no)) - 1) AS INTEGER)) AS ts FROM raw_points)"""))
def position_timestamps(spark, sf):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return silver.position_timestamps(raw_points(spark, sf), start, "row_no").select(
        "row_no", "event_timestamp_utc", "event_date"
    )


@query(oracle("SELECT _ingest_ts, timestamp_utc < TIMESTAMP '2024-01-10 12:00:00' AS is_late_arrival FROM prices"))
def late_arrivals(spark, sf):
    mark = F.lit("2024-01-10 12:00:00").cast("timestamp")
    return silver.tag_late_arrivals(views.prices(spark, sf), "timestamp_utc", mark).select(
        "_ingest_ts", "is_late_arrival"
    )


@query(oracle(f"SELECT _ingest_ts, {r('actual_load_mw * 1000', 4, 'actual_load_mw')} FROM load"))
def unit_scaling(spark, sf):
    scaled = silver.scale_units(views.load(spark, sf), "actual_load_mw", 1000.0)
    return rounded(scaled, "actual_load_mw", digits=4).select("_ingest_ts", "actual_load_mw")


@query("""SELECT event_id, date_trunc('second', ts) - to_hours(CAST(event_id % 5 AS INTEGER)) AS timestamp_utc
          FROM events""")
def timezone_alignment(spark, sf):
    events = views.table(spark, sf, "events")
    text = F.concat(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+0"), (F.col("event_id") % 5).cast("string"), F.lit(":00")
    )
    return events.select("event_id", silver.to_utc(text).alias("timestamp_utc"))


@query("""SELECT event_id, event_id % 7 <> 0 AND event_type <> 'error' AS is_complete FROM events""")
def required_fields(spark, sf):
    events = views.table(spark, sf, "events")
    payload = F.map_filter(
        F.create_map(
            F.lit("zone"), F.when(F.col("event_id") % 7 != 0, F.lit("NL")),
            F.lit("value"), F.when(F.col("event_type") != "error", F.lit("1")),
        ),
        lambda k, v: v.isNotNull(),
    )
    ok, bad = silver.split_required(events.withColumn("payload", payload), ["zone", "value"], "payload")
    return ok.select("event_id", F.lit(True).alias("is_complete")).unionByName(
        bad.select("event_id", F.lit(False).alias("is_complete"))
    )


@query(oracle("""SELECT zone, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM (
    SELECT zone, CAST(min(timestamp_utc) AS DATE) AS lo, CAST(max(timestamp_utc) AS DATE) AS hi
    FROM prices GROUP BY zone)"""))
def date_range(spark, sf):
    bounds = views.prices(spark, sf).groupBy("zone").agg(
        F.to_date(F.min("timestamp_utc")).alias("lo"), F.to_date(F.max("timestamp_utc")).alias("hi")
    )
    return silver.date_range(bounds, "lo", "hi").select("zone", "day")


# ---------------------------------------------------------------------------
# Quality
# ---------------------------------------------------------------------------


def _sql_rules(rule_set: str, source: str) -> str:
    lines = [
        f"SELECT '{rule.name}' AS rule_name, '{rule.severity}' AS severity, count(*) AS total_rows, "
        f"count(*) FILTER (coalesce({rule.predicate}, false)) AS passed_rows FROM {source}"
        for rule in RULES[rule_set]
    ]
    body = " UNION ALL ".join(lines)
    return oracle(
        f"SELECT rule_name, severity, CAST(total_rows AS BIGINT) AS total_rows, CAST(passed_rows AS BIGINT) AS "
        f"passed_rows, CAST(total_rows - passed_rows AS BIGINT) AS failed_rows, "
        f"{r('CASE WHEN total_rows = 0 THEN 1.0 ELSE CAST(passed_rows AS DOUBLE) / total_rows END', 6, 'pass_rate')} "
        f"FROM ({body})"
    )


CTES["batched_prices"] = "SELECT *, CASE WHEN _ingest_ts % 50 <> 0 THEN 'b1' END AS _batch_id FROM prices"


def batched_prices(spark, sf):
    return views.prices(spark, sf).withColumn("_batch_id", F.when(F.col("_ingest_ts") % 50 != 0, F.lit("b1")))


_RULE_INPUTS = {
    "bronze_prices": (batched_prices, "batched_prices"),
    "silver_prices": (silver_prices, "s_prices"),
    "silver_generation": (silver_generation, "s_generation"),
    "silver_load": (views.load, "load"),
    "silver_flows": (silver_flows, "s_flows"),
    "PRICE_RULES": (views.prices, "prices"),
    "GENERATION_RULES": (views.generation, "generation"),
    "LOAD_RULES": (views.load, "load"),
    "FLOW_RULES": (views.flows, "flows"),
}


def _register_rules() -> None:
    for rule_set, (source, sql_name) in _RULE_INPUTS.items():
        def run(spark, sf, rule_set=rule_set, source=source):
            return rounded(quality.evaluate(source(spark, sf), rule_set), "pass_rate")

        query(_sql_rules(rule_set, sql_name), name=f"dq_evaluate_{rule_set.lower()}")(run)


_register_rules()


def _sql_first_failure(rule_set: str, all_rules: bool) -> str:
    whens = " ".join(
        f"WHEN NOT coalesce({rule.predicate}, false) THEN '{rule.name}'"
        for rule in RULES[rule_set] if all_rules or rule.severity == "CRITICAL"
    )
    return f"CASE {whens} END"


@query(oracle(f"""SELECT _ingest_ts, {_sql_first_failure('silver_prices', False)} AS _failed_rule
    FROM (SELECT *, 0.0 AS price_z_score FROM prices)"""))
def dq_enforce(spark, sf):
    source = views.prices(spark, sf).withColumn("price_z_score", F.lit(0.0))
    valid, failed, _ = quality.enforce(source, "silver_prices")
    return valid.withColumn("_failed_rule", F.lit(None).cast("string")).unionByName(failed).select(
        "_ingest_ts", "_failed_rule"
    )


def _routed(spark: SparkSession, sf: str) -> quality.Routed:
    source = views.prices(spark, sf).withColumn("price_z_score", F.lit(0.0))
    return quality.route(source, "silver_prices", scratch_path(spark, "routed"))


@query(ORACLES["dq_enforce"])
def dq_route_rows(spark, sf):
    """As ``dq_enforce``, from one scan that writes both sides."""
    routed = _routed(spark, sf)
    return routed.valid.withColumn("_failed_rule", F.lit(None).cast("string")).unionByName(routed.quarantined).select(
        "_ingest_ts", "_failed_rule"
    )


@query(oracle(f"""SELECT rule_set_name, target_table, total_rows, passed_rows, total_rows - passed_rows AS failed_rows,
    {r('CAST(passed_rows AS DOUBLE) / total_rows', 6, 'pass_rate')},
    CASE WHEN CAST(passed_rows AS DOUBLE) / total_rows < 0.8 THEN 'CRITICAL'
         WHEN CAST(passed_rows AS DOUBLE) / total_rows < 0.95 THEN 'WARNING' ELSE 'OK' END AS gate
    FROM (SELECT 'PRICE_RULES' AS rule_set_name, 'silver_prices' AS target_table, count(*) AS total_rows,
    count(*) FILTER (({_sql_first_failure('PRICE_RULES', True)}) IS NULL) AS passed_rows FROM prices)"""))
def dq_validate_gate(spark, sf):
    stats = quality.rule_set_stats(views.prices(spark, sf), "PRICE_RULES", "silver_prices", "run")
    return rounded(
        stats.withColumn("gate", quality.gate_status(F.col("pass_rate"))), "pass_rate"
    ).drop("run_id", "validated_at")


@query(oracle(f"""SELECT o_orderkey AS order_id FROM (SELECT _ingest_ts AS o_orderkey, actual_load_mw, forecast_load_mw,
    zone FROM load) WHERE ({_sql_first_failure('LOAD_RULES', True)}) IS NULL"""))
def dq_validate_rows(spark, sf):
    clean, _ = quality.validate(views.load(spark, sf), "LOAD_RULES", "silver_load", "run")
    return clean.select(F.col("_ingest_ts").alias("order_id"))


@query(oracle("""SELECT _ingest_ts, coalesce(price_eur_mwh >= 0, false) AS non_negative,
              price_eur_mwh IS NOT NULL AS present FROM prices"""))
def dq_expectations(spark, sf):
    parts = []
    ok, bad = quality.expect_non_negative(materialize(views.prices(spark, sf)), "price_eur_mwh")
    for side, flag in ((ok, True), (bad, False)):
        present, absent = quality.expect_not_null(side, "price_eur_mwh")
        parts += [
            present.select("_ingest_ts", F.lit(flag).alias("non_negative"), F.lit(True).alias("present")),
            absent.select("_ingest_ts", F.lit(flag).alias("non_negative"), F.lit(False).alias("present")),
        ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query(oracle("""SELECT 'batched_prices' AS source, '_ingest_ts' AS missing_like, count(*) AS row_count
              FROM batched_prices"""))
def contract_columns(spark, sf):
    df = batched_prices(spark, sf).drop("_ingest_ts").withColumns(
        {"resolution_minutes": F.lit(15), "_source": F.lit("events")}
    )
    missing = quality.missing_columns(df, "bronze_prices")
    return df.agg(F.count("*").alias("row_count")).select(
        F.lit("batched_prices").alias("source"), F.lit(",".join(missing)).alias("missing_like"), "row_count"
    )


@query(oracle("""SELECT 'zone' AS key_column, count(*) FILTER (zone IS NULL) AS null_rows FROM batched_prices UNION ALL
    SELECT 'timestamp_utc', count(*) FILTER (timestamp_utc IS NULL) FROM batched_prices UNION ALL
    SELECT '_batch_id', count(*) FILTER (_batch_id IS NULL) FROM batched_prices"""))
def contract_keys(spark, sf):
    return quality.key_violations(batched_prices(spark, sf), "bronze_prices")


@query(oracle("""SELECT 'zone' AS field_name, 'null' AS problem, count(*) AS row_count, min(_ingest_ts) AS first_row
    FROM prices WHERE _ingest_ts % 211 = 0 UNION ALL
    SELECT 'price_eur_mwh', 'type', count(*), min(_ingest_ts) FROM prices
    WHERE price_eur_mwh IS NOT NULL AND _ingest_ts % 103 = 5"""))
def contract_violations(spark, sf):
    dirty = views.prices(spark, sf).select(
        "_ingest_ts",
        F.when(F.col("_ingest_ts") % 211 != 0, F.col("zone")).alias("zone"),
        F.when((F.col("_ingest_ts") % 103 == 5) & F.col("price_eur_mwh").isNotNull(), F.lit("n/a"))
        .otherwise(F.col("price_eur_mwh").cast("string")).alias("price_eur_mwh"),
        F.lit(False).alias("is_price_spike"),
    )
    return quality.contract_violations(dirty, "price_spike_rows", "_ingest_ts", strict=False)


@query(_sql_rules("silver_load", "load").replace("SELECT rule_name, severity,",
                                                 "SELECT 'run-1' AS run_id, 'silver_load' AS rule_set_name, "
                                                 "'silver_load' AS target_table, rule_name, severity,", 1))
def dq_stats_rows(spark, sf):
    stats = quality.dq_stats(views.load(spark, sf), "silver_load", "silver_load", "run-1")
    return rounded(stats, "pass_rate").drop("validated_at")


# ---------------------------------------------------------------------------
# Features
# ---------------------------------------------------------------------------
CTES.update(
    {
        "price_feat": """SELECT *, price_z_score > 2.0 AS price_spike_flag, price_eur_mwh < 0 AS negative_price_flag FROM (
            SELECT zone, timestamp_utc, price_eur_mwh, price_24h_avg, price_24h_stddev, price_lag_1h, price_lag_24h,
            CASE WHEN price_24h_stddev > 0 THEN (price_eur_mwh - price_24h_avg) / price_24h_stddev ELSE 0.0 END
            AS price_z_score FROM (SELECT *, avg(price_eur_mwh) OVER f AS price_24h_avg,
            stddev_samp(price_eur_mwh) OVER f AS price_24h_stddev, lag(price_eur_mwh, 4) OVER o AS price_lag_1h,
            lag(price_eur_mwh, 96) OVER o AS price_lag_24h FROM latest_prices
            WINDOW o AS (PARTITION BY zone ORDER BY timestamp_utc),
            f AS (PARTITION BY zone ORDER BY timestamp_utc ROWS BETWEEN 96 PRECEDING AND CURRENT ROW)))""",
        "gen_slot": """SELECT zone, timestamp_utc, avg(renewable_share_pct) AS renewable_share_pct,
            sum(generation_mw) AS generation_mw,
            sum(CASE WHEN is_renewable THEN generation_mw ELSE 0.0 END) AS total_renewable_mw
            FROM s_generation GROUP BY ALL""",
        "gen_feat": """SELECT *, CASE WHEN generation_24h_avg > 0 THEN generation_24h_stddev / generation_24h_avg
            ELSE 0.0 END AS generation_volatility_ix FROM (SELECT *, avg(generation_mw) OVER f AS generation_24h_avg,
            stddev_samp(generation_mw) OVER f AS generation_24h_stddev FROM gen_slot
            WINDOW f AS (PARTITION BY zone ORDER BY timestamp_utc ROWS BETWEEN 96 PRECEDING AND CURRENT ROW))""",
        "load_feat": """SELECT *, CASE WHEN actual_load_mw > 0 THEN abs_forecast_error_mw / actual_load_mw END
            AS load_error_ratio FROM s_load""",
    }
)
_PF = ["price_24h_avg", "price_24h_stddev", "price_z_score"]
_GF = ["generation_24h_avg", "generation_24h_stddev", "generation_volatility_ix"]


@query(oracle(f"""SELECT zone, timestamp_utc, price_eur_mwh, {', '.join(r(c) for c in _PF)}, price_lag_1h, price_lag_24h,
              price_spike_flag, negative_price_flag FROM price_feat"""))
def price_features(spark, sf):
    return rounded(features.price_features(latest_prices(spark, sf)), *_PF).drop("_ingest_ts")


@query(oracle(f"""SELECT zone, timestamp_utc, {r('generation_mw')}, {r('total_renewable_mw')},
              {r('renewable_share_pct')}, {', '.join(r(c) for c in _GF)} FROM gen_feat"""))
def generation_features(spark, sf):
    slots = features.generation_by_slot(silver_generation(spark, sf))
    return rounded(
        features.generation_features(slots), "generation_mw", "total_renewable_mw", "renewable_share_pct", *_GF
    )


@query(oracle(f"SELECT _ingest_ts, {r('load_error_ratio')} FROM load_feat"))
def load_features(spark, sf):
    return rounded(features.load_features(latest_load(spark, sf)), "load_error_ratio").select(
        "_ingest_ts", "load_error_ratio"
    )


_FV = [
    "price_eur_mwh", *_PF, "price_lag_1h", "price_lag_24h", "renewable_share_pct", "generation_mw",
    "total_renewable_mw", *_GF, "abs_forecast_error_mw", "load_error_ratio",
]


@query(oracle(f"""SELECT p.zone, p.timestamp_utc, price_spike_flag, negative_price_flag,
    {', '.join(r(f'coalesce({c}, 0.0)', 6, c) for c in _FV)} FROM price_feat p
    LEFT JOIN gen_feat g ON p.zone = g.zone AND p.timestamp_utc = g.timestamp_utc
    LEFT JOIN load_feat l ON p.zone = l.zone AND p.timestamp_utc = l.timestamp_utc"""))
def feature_vector(spark, sf):
    vector = features.feature_vector(
        latest_prices(spark, sf), silver_generation(spark, sf), latest_load(spark, sf)
    )
    return rounded(vector, *_FV).drop("_ingest_ts")


CTES.update(
    {
        "import_dep": """SELECT zone, event_date, total_net_import_mw, total_load_mwh, CASE WHEN total_load_mwh > 0
            THEN total_net_import_mw / total_load_mwh ELSE 0.0 END AS import_dependency_pct FROM (
            SELECT zone_to AS zone, CAST(timestamp_utc AS DATE) AS event_date, sum(flow_mw) AS total_net_import_mw
            FROM s_flows GROUP BY ALL) JOIN load_daily USING (zone, event_date)""",
        "local_anchor": """SELECT zone, timestamp_utc, price_eur_mwh AS price, generation, actual_load_mw, forecast_load_mw,
            has_load FROM latest_prices
            LEFT JOIN (SELECT zone, timestamp_utc, sum(generation_mw) AS generation FROM s_generation GROUP BY ALL)
              USING (zone, timestamp_utc)
            LEFT JOIN (SELECT zone, timestamp_utc, actual_load_mw, forecast_load_mw, true AS has_load FROM s_load)
              USING (zone, timestamp_utc)""",
        "gen_hist": """SELECT zone, timestamp_utc, generation, count(*) OVER (PARTITION BY zone ORDER BY timestamp_utc)
            AS place FROM local_anchor WHERE generation IS NOT NULL""",
        "gen_stats": """SELECT zone, place, count(generation) OVER w AS gn, avg(generation) OVER w AS gavg,
            stddev_pop(generation) OVER w AS gstd FROM gen_hist
            WINDOW w AS (PARTITION BY zone ORDER BY place ROWS BETWEEN 95 PRECEDING AND CURRENT ROW)""",
        "local_hist": """SELECT a.*, count(price) OVER w AS pn, avg(price) OVER w AS pavg, stddev_pop(price) OVER w AS pstd,
            count(generation) OVER (PARTITION BY zone ORDER BY timestamp_utc
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM local_anchor a
            WINDOW w AS (PARTITION BY zone ORDER BY timestamp_utc ROWS BETWEEN 96 PRECEDING AND 1 PRECEDING)""",
        "local_feat": """SELECT h.zone, timestamp_utc, CAST(timestamp_utc AS DATE) AS event_date, price AS price_eur_mwh,
            coalesce(pavg, 0.0) AS price_24h_avg, CASE WHEN pn > 1 THEN pstd ELSE 0.0 END AS price_24h_stddev,
            CASE WHEN pn > 1 AND pstd > 0 THEN (price - pavg) / pstd ELSE 0.0 END AS price_z_score,
            price > 200 AS price_spike_flag, price < 0 AS negative_price_flag,
            coalesce(generation, 0.0) AS generation_mw, coalesce(gavg, 0.0) AS generation_24h_avg,
            CASE WHEN gn > 1 THEN gstd ELSE 0.0 END AS generation_24h_stddev,
            CASE WHEN gavg > 0 AND gn > 1 THEN gstd / gavg ELSE 0.0 END AS generation_volatility_ix,
            CASE WHEN has_load THEN actual_load_mw ELSE 0.0 END AS actual_load_mw,
            CASE WHEN has_load THEN forecast_load_mw ELSE 0.0 END AS forecast_load_mw,
            CASE WHEN has_load THEN coalesce(abs(actual_load_mw - forecast_load_mw), 0.0) ELSE 0.0 END
              AS abs_forecast_error_mw
            FROM local_hist h LEFT JOIN gen_stats g ON h.zone = g.zone AND g.place = h.before""",
    }
)
_LF = [
    "price_eur_mwh", "price_24h_avg", "price_24h_stddev", "price_z_score", "generation_mw", "generation_24h_avg",
    "generation_24h_stddev", "generation_volatility_ix", "actual_load_mw", "forecast_load_mw", "abs_forecast_error_mw",
]


def local_features(spark: SparkSession, sf: str) -> DataFrame:
    return features.local_features(latest_prices(spark, sf), silver_generation(spark, sf), latest_load(spark, sf))


@query(oracle(f"""SELECT zone, timestamp_utc, event_date, price_spike_flag, negative_price_flag,
              {', '.join(r(c) for c in _LF)} FROM local_feat"""), name="local_features")
def _local_features(spark, sf):
    return rounded(local_features(spark, sf), *_LF)


@query(oracle("""SELECT zone, CASE WHEN feature_cols = '' THEN 'price_eur_mwh' ELSE feature_cols END AS feature_cols FROM (
    SELECT zone, concat_ws(',', CASE WHEN max(abs(price_eur_mwh)) > 0 THEN 'price_eur_mwh' END,
    CASE WHEN max(abs(price_z_score)) > 0 THEN 'price_z_score' END,
    CASE WHEN max(abs(generation_mw)) > 0 THEN 'generation_mw' END,
    CASE WHEN max(abs(generation_volatility_ix)) > 0 THEN 'generation_volatility_ix' END,
    CASE WHEN max(abs(abs_forecast_error_mw)) > 0 THEN 'abs_forecast_error_mw' END) AS feature_cols
    FROM local_feat GROUP BY zone)"""))
def active_features(spark, sf):
    return features.active_features(local_features(spark, sf)).withColumn(
        "feature_cols", F.concat_ws(",", "feature_cols")
    )


def imports(spark, sf):
    return gold.import_dependency(silver_flows(spark, sf), latest_load(spark, sf)).drop("record_created_ts")


@query(oracle("""SELECT zone, event_date, CASE WHEN import_dependency_pct >= 0.5 THEN 'HIGH'
    WHEN import_dependency_pct >= 0.2 THEN 'MEDIUM' WHEN import_dependency_pct IS NULL THEN 'UNKNOWN' ELSE 'LOW' END
    AS import_dependency_bucket FROM import_dep"""))
def import_dependency_bucket(spark, sf):
    return imports(spark, sf).select(
        "zone", "event_date", features.import_bucket("import_dependency_pct").alias("import_dependency_bucket")
    )


@query(oracle(f"""SELECT zone, timestamp_utc, {r('total_renewable_mw / nullif(generation_mw, 0) * 100', 6,
              'renewable_share')} FROM gen_slot"""))
def renewable_share_feature(spark, sf):
    slots = features.generation_by_slot(silver_generation(spark, sf))
    return rounded(
        slots.select(
            "zone", "timestamp_utc",
            features.renewable_share("total_renewable_mw", "generation_mw").alias("renewable_share"),
        ),
        "renewable_share",
    )


CTES["row_stability"] = """SELECT zone AS country_code, strftime(timestamp_utc, '%Y-%m-%d') AS event_date,
    sum(generation_mw) AS total_generation, avg(generation_mw) AS avg_generation, max(generation_mw) AS max_generation,
    min(generation_mw) AS min_generation, max(generation_mw) - min(generation_mw) AS volatility_index,
    CAST(count(generation_mw) AS DOUBLE) AS interval_count FROM generation WHERE generation_mw IS NOT NULL GROUP BY ALL"""
_RS = ["total_generation", "avg_generation"]


def row_stability(spark, sf):
    rows = views.generation(spark, sf).withColumnRenamed("zone", "country_code")
    return gold.generation_stability_rows(rows)


@query(oracle("""SELECT country_code, event_date, max_generation - min_generation AS volatility_feature
              FROM row_stability"""))
def volatility_feature(spark, sf):
    return row_stability(spark, sf).select(
        "country_code", "event_date", features.volatility_range().alias("volatility_feature")
    )


# ---------------------------------------------------------------------------
# Gold
# ---------------------------------------------------------------------------
_ST = ["renewable_share_pct", "renewable_share_7d_avg", "renewable_share_7d_stddev", "renewable_volatility_index"]


def stability(spark, sf):
    return gold.renewable_stability(silver_generation(spark, sf)).drop("record_created_ts")


@query(oracle(f"""SELECT zone, event_date, total_generation_mwh, renewable_generation_mwh,
              {', '.join(r(c) for c in _ST)}, renewable_dip_flag FROM stability"""))
def renewable_stability(spark, sf):
    return rounded(stability(spark, sf), *_ST)


def spikes(spark, sf):
    return gold.price_spikes(latest_prices(spark, sf)).drop("record_created_ts", "_ingest_ts")


@query(oracle(f"""SELECT zone, timestamp_utc, price_eur_mwh, {', '.join(r(c) for c in _PF)}, price_spike_flag,
              negative_price_flag FROM spikes"""))
def price_spike_analysis(spark, sf):
    return rounded(spikes(spark, sf), *_PF)


_MS = ["price_avg", "price_stddev", "peak_price_avg", "offpeak_price_avg", "total_load_mwh", "forecast_error_avg_mw",
       "renewable_share_avg_pct"]
_OHLC_COLS = "zone, summary_date, price_open, price_close, price_high, price_low, negative_price_count"


def summary(spark, sf):
    return gold.market_summary(
        latest_prices(spark, sf), latest_load(spark, sf), silver_generation(spark, sf)
    ).drop("record_created_ts")


@query(oracle(f"SELECT {_OHLC_COLS}, {', '.join(r(c) for c in _MS)} FROM m_summary"))
def market_summary(spark, sf):
    return rounded(summary(spark, sf), *_MS)


@query(oracle(f"""SELECT zone, event_date, total_net_import_mw, {r('total_load_mwh')}, {r('import_dependency_pct')}
              FROM import_dep"""))
def import_dependency(spark, sf):
    return rounded(imports(spark, sf), "total_load_mwh", "import_dependency_pct")


CTES["fact"] = """SELECT zone, timestamp_utc, price_eur_mwh,
    md5(zone || strftime(timestamp_utc, '%Y-%m-%d %H:%M:%S')) AS price_key, CAST(timestamp_utc AS DATE) AS date,
    CAST(hour(timestamp_utc) AS INTEGER) AS hour, price_eur_mwh < 0 AS is_negative_price,
    price_eur_mwh >= 4000 AS is_price_cap_hit FROM latest_prices"""


@query(oracle("SELECT * FROM fact"))
def fact_power_prices(spark, sf):
    return gold.fact_prices(latest_prices(spark, sf)).drop("_loaded_at", "_ingest_ts")


_DM = [*_MS, "total_renewable_mwh"]


@query(oracle(f"""SELECT o.zone, o.summary_date AS date, price_open, price_close, price_high, price_low,
    negative_price_count, {', '.join(r(c) for c in _DM)} FROM ohlc o
    LEFT JOIN load_daily l ON o.zone = l.zone AND o.summary_date = l.event_date
    LEFT JOIN gen_shares g ON o.zone = g.zone AND o.summary_date = g.event_date"""))
def daily_market_mart(spark, sf):
    mart = gold.daily_market(
        gold.fact_prices(latest_prices(spark, sf)), silver_generation(spark, sf), latest_load(spark, sf)
    )
    return rounded(mart, *_DM).drop("_mart_refreshed_at")


def _sql_corridors(pairs) -> str:
    return ", ".join(f"('{a}', '{b}')" for a, b in pairs)


CTES["pairs4"] = f"""SELECT a.timestamp_utc, za AS zone_a, zb AS zone_b, za || '-' || zb AS corridor,
    a.price_eur_mwh AS price_a, b.price_eur_mwh AS price_b
    FROM (VALUES {_sql_corridors(SPREAD_CORRIDORS)}) c(za, zb) JOIN latest_prices a ON a.zone = za
    JOIN latest_prices b ON b.zone = zb AND a.timestamp_utc = b.timestamp_utc"""
CTES["pairs6"] = CTES["pairs4"].replace(_sql_corridors(SPREAD_CORRIDORS), _sql_corridors(ARBITRAGE_CORRIDORS))


@query(oracle(f"""SELECT corridor, timestamp_utc, zone_a, zone_b, price_a, price_b,
    CASE WHEN price_a >= price_b THEN zone_a ELSE zone_b END AS zone_high,
    CASE WHEN price_a >= price_b THEN zone_b ELSE zone_a END AS zone_low,
    greatest(price_a, price_b) AS price_high, least(price_a, price_b) AS price_low,
    {r('abs(price_a - price_b)', 6, 'spread_eur_mwh')}, {r('''CASE WHEN least(price_a, price_b) <> 0
    THEN abs(price_a - price_b) / least(price_a, price_b) * 100.0 END''', 4, 'spread_pct')},
    md5(corridor || strftime(timestamp_utc, '%Y-%m-%d %H:%M:%S')) AS spread_key FROM pairs4"""))
def price_spreads(spark, sf):
    spreads = gold.price_spreads(latest_prices(spark, sf)).drop("_loaded_at")
    return rounded(rounded(spreads, "spread_eur_mwh"), "spread_pct", digits=4)


@query(oracle(f"SELECT country_code, event_date, {', '.join(r(c) for c in _RS)}, max_generation, min_generation, "
              "volatility_index, interval_count FROM row_stability"))
def generation_stability_rows(spark, sf):
    return rounded(row_stability(spark, sf), *_RS)


@query(oracle("SELECT _ingest_ts, zone, price_eur_mwh, coalesce(price_eur_mwh >= 200, false) AS is_price_spike FROM prices"))
def fixed_price_spikes(spark, sf):
    return views.prices(spark, sf).withColumn("is_price_spike", gold.price_spike_flag()).drop("timestamp_utc")


@query(oracle(f"""SELECT zone, event_date, {r('total_net_import_mw / nullif(total_load_mwh, 0)', 6,
              'import_dependency_ratio')} FROM import_dep"""))
def import_dependency_ratio(spark, sf):
    return rounded(
        imports(spark, sf).select(
            "zone", "event_date",
            gold.import_ratio("total_net_import_mw", "total_load_mwh").alias("import_dependency_ratio"),
        ),
        "import_dependency_ratio",
    )


@query(oracle(f"SELECT zone, event_date, {r('total_net_import_mw - total_load_mwh', 4, 'supply_demand_delta')} "
              "FROM import_dep"))
def supply_demand_delta(spark, sf):
    return rounded(
        imports(spark, sf).select(
            "zone", "event_date",
            gold.supply_demand_delta("total_net_import_mw", "total_load_mwh").alias("supply_demand_delta"),
        ),
        "supply_demand_delta", digits=4,
    )


CTES["stress3"] = """SELECT *, CASE WHEN stress_score >= 0.75 THEN 'CRITICAL' WHEN stress_score >= 0.5 THEN 'HIGH'
    WHEN stress_score >= 0.25 THEN 'MEDIUM' ELSE 'LOW' END AS stress_label,
    CASE WHEN price_risk >= renewable_risk AND price_risk >= load_risk THEN 'PRICE_SPIKES'
    WHEN renewable_risk >= price_risk AND renewable_risk >= load_risk THEN 'LOW_RENEWABLE_SHARE'
    ELSE 'LOAD_FORECAST_ERROR' END AS main_driver
    FROM (SELECT *, round(0.45 * price_risk + 0.35 * renewable_risk + 0.20 * load_risk, 4) AS stress_score FROM (
    SELECT *, greatest(0.0, (60.0 - renewable_share_pct) / 60.0) AS renewable_risk,
    least(1.0, price_spike_count / CAST(8.0 AS DOUBLE)) AS price_risk,
    least(1.0, avg_forecast_error_mw / 1000.0) AS load_risk FROM (
    SELECT p.zone, p.event_date, avg_price_eur_mwh, max_price_eur_mwh, coalesce(price_volatility, 0.0) AS price_volatility,
    price_spike_count, negative_price_count, coalesce(total_generation_mwh, 0.0) AS total_generation_mwh,
    coalesce(renewable_generation_mwh, 0.0) AS renewable_generation_mwh,
    coalesce(renewable_share_pct, 0.0) AS renewable_share_pct, coalesce(avg_load_mw, 0.0) AS avg_load_mw,
    coalesce(avg_forecast_error_mw, 0.0) AS avg_forecast_error_mw FROM (
    SELECT zone, CAST(timestamp_utc AS DATE) AS event_date, avg(price_eur_mwh) AS avg_price_eur_mwh,
    max(price_eur_mwh) AS max_price_eur_mwh, stddev_samp(price_eur_mwh) AS price_volatility,
    count(*) FILTER (price_z_score > 2.0) AS price_spike_count,
    count(*) FILTER (price_eur_mwh < 0) AS negative_price_count FROM s_prices GROUP BY ALL) p
    LEFT JOIN daily_gen g ON p.zone = g.zone AND p.event_date = g.event_date
    LEFT JOIN (SELECT zone, CAST(timestamp_utc AS DATE) AS event_date, avg(actual_load_mw) AS avg_load_mw,
    avg(abs_forecast_error_mw) AS avg_forecast_error_mw FROM s_load GROUP BY ALL) l
    ON p.zone = l.zone AND p.event_date = l.event_date)))"""
_S3 = ["avg_price_eur_mwh", "price_volatility", "renewable_share_pct", "avg_load_mw", "avg_forecast_error_mw",
       "renewable_risk", "price_risk", "load_risk", "stress_score"]


@query(oracle(f"""SELECT zone, event_date, max_price_eur_mwh, price_spike_count, negative_price_count,
    total_generation_mwh, renewable_generation_mwh, {', '.join(r(c) for c in _S3)}, stress_label, main_driver
    FROM stress3"""))
def market_stress_daily(spark, sf):
    stress = gold.market_stress(silver_prices(spark, sf), silver_generation(spark, sf), latest_load(spark, sf))
    return rounded(stress, *_S3).drop("record_created_ts")


CTES["stress_in"] = """SELECT p.zone, p.event_date, avg_price_eur_mwh, max_price_eur_mwh, price_volatility,
    coalesce(price_spike_count, 0) AS price_spike_count, negative_price_count,
    coalesce(renewable_share_pct, 0.0) AS renewable_share_pct,
    coalesce(renewable_volatility_index, 0.0) AS renewable_volatility_index,
    coalesce(avg_load_mw, 0.0) AS avg_load_mw, coalesce(avg_forecast_error_mw, 0.0) AS avg_forecast_error_mw
    FROM (SELECT zone, CAST(timestamp_utc AS DATE) AS event_date, avg(price_eur_mwh) AS avg_price_eur_mwh,
    max(price_eur_mwh) AS max_price_eur_mwh, stddev_pop(price_eur_mwh) AS price_volatility,
    count(*) FILTER (price_eur_mwh < 0) AS negative_price_count FROM latest_prices GROUP BY ALL) p
    LEFT JOIN (SELECT zone, event_date, count(*) AS price_spike_count FROM (
      SELECT zone, CAST(timestamp_utc AS DATE) AS event_date, price_eur_mwh, avg(price_eur_mwh) OVER w AS av,
      stddev_pop(price_eur_mwh) OVER w AS sd, count(*) OVER w AS n FROM latest_prices
      WINDOW w AS (PARTITION BY zone, CAST(timestamp_utc AS DATE)))
      WHERE n > 1 AND (price_eur_mwh - av) / CASE WHEN sd > 0 THEN sd ELSE 1.0 END > 2.0 GROUP BY ALL) s
      ON p.zone = s.zone AND p.event_date = s.event_date
    LEFT JOIN stability g ON p.zone = g.zone AND p.event_date = g.event_date
    LEFT JOIN (SELECT zone, CAST(timestamp_utc AS DATE) AS event_date, arg_max_null(actual_load_mw, timestamp_utc)
      AS avg_load_mw, arg_max_null(abs_forecast_error_mw, timestamp_utc) AS avg_forecast_error_mw
      FROM s_load GROUP BY ALL) l ON p.zone = l.zone AND p.event_date = l.event_date"""


def _sql_stress5(source: str, extra: str = "") -> str:
    def clip(x: str) -> str:
        return f"greatest(0.0, least(1.0, {x}))"

    return f"""SELECT *, format('{{:s}} on {{:s}} had {{:s}} market stress (score={{:.2f}}). Main driver: {{:s}}. '
      || 'Avg price={{:.2f}} EUR/MWh, max price={{:.2f}} EUR/MWh, renewable share={{:.1f}}%, price spikes={{:d}}, '
      || 'negative-price intervals={{:d}}.', country_code, event_date, lower(stress_label), stress_score, main_driver,
      avg_price_eur_mwh, max_price_eur_mwh, renewable_share_pct, price_spike_count, negative_price_count)
      AS finding_summary FROM (
    SELECT *, CASE WHEN stress_score >= 0.75 THEN 'CRITICAL' WHEN stress_score >= 0.5 THEN 'HIGH'
    WHEN stress_score >= 0.25 THEN 'MEDIUM' ELSE 'LOW' END AS stress_label,
    CASE greatest(k0, k1, k2, k3, k4) WHEN k0 THEN 'PRICE_SPIKES' WHEN k1 THEN 'PRICE_VOLATILITY'
    WHEN k2 THEN 'LOW_RENEWABLE_SHARE' WHEN k3 THEN 'RENEWABLE_VOLATILITY' ELSE 'LOAD_FORECAST_ERROR' END AS main_driver
    FROM (SELECT *, round(0.30 * k0 + 0.20 * k1 + 0.25 * k2 + 0.10 * k3 + 0.15 * k4, 4) AS stress_score FROM (
    SELECT zone AS country_code, CAST(event_date AS VARCHAR) AS event_date, avg_price_eur_mwh, max_price_eur_mwh,
    price_volatility, price_spike_count, negative_price_count, renewable_share_pct, renewable_volatility_index,
    avg_load_mw, avg_forecast_error_mw{extra}, {clip('price_spike_count / CAST(8 AS DOUBLE)')} AS k0,
    {clip('price_volatility / 100.0')} AS k1, {clip('(60.0 - renewable_share_pct) / 60.0')} AS k2,
    {clip('renewable_volatility_index')} AS k3, {clip('avg_forecast_error_mw / 1000.0')} AS k4 FROM {source})))"""


CTES["stress5"] = _sql_stress5("stress_in")
_S5 = ["avg_price_eur_mwh", "price_volatility", "renewable_share_pct", "renewable_volatility_index", "avg_load_mw",
       "avg_forecast_error_mw"]


# A mean on the edge of two cents prints either way, depending on summation order; it is compared as a number instead.
_MASK_SQL = "regexp_replace(finding_summary, 'Avg price=[-0-9.]+', 'Avg price=*') AS finding_summary"


def masked(df: DataFrame) -> DataFrame:
    return df.withColumn("finding_summary", F.regexp_replace("finding_summary", "Avg price=[-0-9.]+", "Avg price=*"))


def stress_input(spark, sf):
    return gold.stress_inputs(latest_prices(spark, sf), stability(spark, sf), latest_load(spark, sf))


def stress(spark, sf):
    return gold.score_stress(stress_input(spark, sf))


@query(oracle(f"""SELECT zone, event_date, max_price_eur_mwh, price_spike_count, negative_price_count,
              {', '.join(r(c) for c in _S5)} FROM stress_in"""))
def stress_inputs(spark, sf):
    return rounded(stress_input(spark, sf), *_S5)


@query(oracle(f"""SELECT country_code, event_date, max_price_eur_mwh, price_spike_count, negative_price_count,
    {', '.join(r(c) for c in _S5)}, stress_score, stress_label, main_driver, {_MASK_SQL} FROM stress5"""))
def stress_scores(spark, sf):
    return masked(rounded(stress(spark, sf), *_S5))


@query(oracle(f"SELECT zone, event_date, {r('120.0 - renewable_share_pct', 6, 'price_eur_mwh')} FROM stability"))
def fallback_prices(spark, sf):
    return rounded(gold.fallback_prices(stability(spark, sf)), "price_eur_mwh")


# ---------------------------------------------------------------------------
# Platinum
# ---------------------------------------------------------------------------
_CA = ["fossil_share_pct", "carbon_premium_eur_mwh", "carbon_adjusted_price_avg"]


@query(oracle(f"""SELECT zone, summary_date, co2_price_eur_t, {', '.join(r(c) for c in _CA)} FROM (
    SELECT m.zone, summary_date, CAST(60.0 AS DOUBLE) AS co2_price_eur_t,
    coalesce(100.0 - renewable_share_pct, 50.0) AS fossil_share_pct,
    coalesce(100.0 - renewable_share_pct, 50.0) / 100.0 * 60.0 * 400.0 / 1000.0 AS carbon_premium_eur_mwh,
    price_avg + coalesce(100.0 - renewable_share_pct, 50.0) / 100.0 * 60.0 * 400.0 / 1000.0 AS carbon_adjusted_price_avg
    FROM m_summary m LEFT JOIN stability s ON m.zone = s.zone AND m.summary_date = s.event_date)"""))
def carbon_adjusted_prices(spark, sf):
    df = platinum.carbon_adjusted_prices(summary(spark, sf), stability(spark, sf))
    return rounded(df, *_CA).select("zone", "summary_date", "co2_price_eur_t", *_CA)


@query(oracle(f"""SELECT corridor, zone_a, zone_b, timestamp_utc, price_a, price_b,
    {r('abs(price_a - price_b)', 6, 'spread_eur_mwh')}, abs(price_a - price_b) > 5 AS is_viable,
    {r('CASE WHEN abs(price_a - price_b) > 5 THEN abs(price_a - price_b) ELSE 0.0 END', 6,
       'arbitrage_potential_eur_mwh')} FROM pairs6"""))
def arbitrage_opportunities(spark, sf):
    return rounded(
        platinum.arbitrage(latest_prices(spark, sf)), "spread_eur_mwh", "arbitrage_potential_eur_mwh"
    ).drop("_platinum_ts")


CTES.update(
    {
        "carbon_rows": """SELECT zone, CASE WHEN _ingest_ts % 9 <> 0 AND zone <> 'RO' THEN 100.0 + abs(price_eur_mwh) END
            AS carbon_intensity_gco2_kwh FROM prices""",
        "weather_rows": """SELECT zone, actual_load_mw / 100.0 AS wind_speed_m_s,
            CASE WHEN zone <> 'FR' THEN forecast_load_mw / 10.0 END AS solar_radiation_w_m2 FROM load""",
        "serving": """SELECT s.*, carbon_intensity_gco2_kwh, wind_speed_m_s_avg, solar_radiation_w_m2_avg,
            (SELECT arg_max(1.0 + (event_id % 100) / CAST(1000 AS DOUBLE), event_id) FROM events) AS fx_rate_to_eur,
            round(greatest(0.0, total_generation - volatility_index), 3) AS stability_score,
            CASE WHEN carbon_intensity_gco2_kwh IS NOT NULL THEN
            round(total_generation / greatest(carbon_intensity_gco2_kwh, 1.0), 6) END AS carbon_efficiency_score
            FROM row_stability s
            LEFT JOIN (SELECT zone, avg(carbon_intensity_gco2_kwh) AS carbon_intensity_gco2_kwh FROM carbon_rows
              GROUP BY zone) c ON s.country_code = c.zone
            LEFT JOIN (SELECT zone, avg(wind_speed_m_s) AS wind_speed_m_s_avg,
              avg(solar_radiation_w_m2) AS solar_radiation_w_m2_avg FROM weather_rows GROUP BY zone) w
              ON s.country_code = w.zone""",
    }
)
_SV = ["total_generation", "avg_generation", "carbon_intensity_gco2_kwh", "wind_speed_m_s_avg",
       "solar_radiation_w_m2_avg", "fx_rate_to_eur"]


@query(oracle(f"""SELECT country_code, event_date, max_generation, min_generation, volatility_index, interval_count,
    {', '.join(r(c) for c in _SV)}, stability_score, {r('carbon_efficiency_score', 5)} FROM serving"""))
def serving_market_summary(spark, sf):
    prices, load = views.prices(spark, sf), views.load(spark, sf)
    carbon = prices.select(
        "zone",
        F.when((F.col("_ingest_ts") % 9 != 0) & (F.col("zone") != "RO"), 100.0 + F.abs("price_eur_mwh")).alias("carbon_intensity_gco2_kwh"),
    )
    weather = load.select(
        "zone", (F.col("actual_load_mw") / 100.0).alias("wind_speed_m_s"),
        F.when(F.col("zone") != "FR", F.col("forecast_load_mw") / 10.0).alias("solar_radiation_w_m2"),
    )
    fx = views.table(spark, sf, "events").select(
        F.lpad(F.col("event_id").cast("string"), 20, "0").alias("timestamp"),
        (1.0 + (F.col("event_id") % 100) / 1000.0).alias("fx_rate"),
    )
    out = platinum.serving_summary(row_stability(spark, sf), carbon, weather, fx)
    return rounded(rounded(out, *_SV), "carbon_efficiency_score", digits=5)


_SCEN_SQL = ", ".join(
    f"('{s.name}', {s.wind_drop_pct}, {s.solar_drop_pct}, {s.load_increase_pct}, {s.import_constraint_pct}, "
    f"{s.price_shock_eur_mwh})"
    for s in platinum.DEFAULT_SCENARIOS
)
CTES["scenario"] = f"""SELECT name, CAST(a AS DOUBLE) AS wind_drop_pct, CAST(b AS DOUBLE) AS solar_drop_pct,
    CAST(c AS DOUBLE) AS load_increase_pct, CAST(d AS DOUBLE) AS import_constraint_pct,
    CAST(e AS DOUBLE) AS price_shock_eur_mwh FROM (VALUES {_SCEN_SQL}) t(name, a, b, c, d, e)"""
CTES["what_if_in"] = """SELECT country_code AS zone, event_date, name, stress_score AS baseline,
    avg_price_eur_mwh + price_shock_eur_mwh AS avg_price_eur_mwh,
    max_price_eur_mwh + price_shock_eur_mwh AS max_price_eur_mwh, price_volatility, price_spike_count,
    negative_price_count,
    greatest(0.0, renewable_share_pct * (1 - (wind_drop_pct * 0.7 + solar_drop_pct * 0.3) / 100.0)) AS renewable_share_pct,
    renewable_volatility_index + import_constraint_pct / 100.0 AS renewable_volatility_index,
    avg_load_mw * (1 + load_increase_pct / 100.0) AS avg_load_mw, avg_forecast_error_mw FROM stress5, scenario"""
CTES["what_if_out"] = _sql_stress5("what_if_in", ", name, baseline")
CTES["what_if_rows"] = f"""SELECT md5(name || '|' || country_code || '|' || event_date) AS scenario_id, name,
    country_code AS zone, event_date, baseline AS baseline_stress_score, stress_score AS simulated_stress_score,
    {r('stress_score - baseline', 4, 'stress_delta')}, stress_label AS simulated_label,
    CASE WHEN stress_label IN ('CRITICAL', 'HIGH') AND main_driver = 'LOW_RENEWABLE_SHARE'
      THEN 'Inspect renewable shortfall, import capacity, and reserve margins.'
    WHEN stress_label IN ('CRITICAL', 'HIGH') AND main_driver = 'PRICE_SPIKES'
      THEN 'Trigger price-spike review and compare spikes against renewable dips.'
    WHEN stress_label IN ('CRITICAL', 'HIGH') AND main_driver = 'LOAD_FORECAST_ERROR'
      THEN 'Review load forecast drift and weather assumptions.'
    ELSE 'No urgent action. Continue monitoring.' END AS recommendation FROM what_if_out"""


@query(oracle("SELECT country_code, event_date, scenario.* FROM stress5, scenario"))
def scenario_inputs(spark, sf):
    return platinum.scenario_inputs(stress(spark, sf))


def scenarios(spark, sf):
    return rounded(platinum.what_if(stress(spark, sf)), "stress_delta", digits=4).drop("generated_at_utc")


@query(oracle("SELECT * FROM what_if_rows"))
def what_if_scenarios(spark, sf):
    return scenarios(spark, sf)


CTES["recs"] = """SELECT country_code AS zone, event_date, stress_label AS severity, 'MARKET_STRESS' AS category,
    'Investigate ' || main_driver || ' as the primary cause of ' || lower(stress_label) || ' stress.' AS recommendation
    FROM stress5 WHERE stress_label IN ('HIGH', 'CRITICAL')
    UNION ALL SELECT country_code, event_date, CASE WHEN stress_label = 'LOW' THEN 'MEDIUM' ELSE stress_label END,
    'RENEWABLE_SHORTFALL', 'Review renewable shortfall versus imports, load, and price spikes.' FROM stress5
    WHERE renewable_share_pct < 35
    UNION ALL SELECT country_code, event_date, CASE WHEN stress_label IN ('HIGH', 'CRITICAL') THEN 'HIGH' ELSE 'MEDIUM' END,
    'PRICE_SPIKE', 'Produce a price-spike explanation and compare against renewable share and load forecast error.'
    FROM stress5 WHERE price_spike_count > 0"""


def advice(spark, sf):
    return platinum.recommendations(stress(spark, sf)).drop("created_at_utc")


@query(oracle("""SELECT *, md5(category || '|' || zone || '|' || event_date) AS recommendation_id FROM recs"""))
def recommendations(spark, sf):
    return advice(spark, sf).drop("evidence")


# ---------------------------------------------------------------------------
# Serving
# ---------------------------------------------------------------------------


@query(oracle(f"""SELECT country_code AS zone, event_date, stress_score, stress_label, main_driver, {_MASK_SQL}
    FROM stress5 ORDER BY event_date DESC, stress_score DESC, zone LIMIT 20"""))
def top_stress(spark, sf):
    return masked(serving.top_stress(stress(spark, sf)))


@query(oracle(f"""SELECT zone, event_date, {r('renewable_share_pct')}, {r('renewable_volatility_index')},
    renewable_dip_flag FROM (SELECT * FROM stability ORDER BY event_date DESC, renewable_volatility_index DESC, zone LIMIT 20)"""))
def top_renewable(spark, sf):
    return rounded(
        serving.top_renewable(stability(spark, sf)), "renewable_share_pct", "renewable_volatility_index"
    )


@query(oracle(f"""SELECT zone, timestamp_utc, price_eur_mwh, {r('price_z_score')}, price_spike_flag, negative_price_flag
    FROM (SELECT * FROM spikes WHERE price_spike_flag OR negative_price_flag ORDER BY timestamp_utc DESC, zone LIMIT 50)"""))
def newest_spikes(spark, sf):
    return rounded(serving.newest_spikes(spikes(spark, sf)), "price_z_score")


@query(oracle(f"""SELECT {_OHLC_COLS}, {', '.join(r(c) for c in _MS)}
    FROM (SELECT * FROM m_summary ORDER BY summary_date DESC, zone LIMIT 20)"""))
def latest_summary(spark, sf):
    return rounded(serving.latest_summary(summary(spark, sf)), *_MS)


@query(oracle("SELECT zone, price_eur_mwh, true AS is_price_spike FROM prices WHERE price_eur_mwh >= 200"))
def spike_dashboard(spark, sf):
    return serving.spike_dashboard(views.prices(spark, sf).withColumn("is_price_spike", gold.price_spike_flag()))


@query(oracle(f"SELECT country_code, {r('total_generation')}, volatility_index FROM row_stability"))
def stability_dashboard(spark, sf):
    return rounded(serving.stability_dashboard(row_stability(spark, sf)), "total_generation")


@query(oracle(f"""SELECT country_code AS zone, event_date, stress_label, stress_score, main_driver, {_MASK_SQL}
    FROM stress5 ORDER BY event_date DESC, stress_score DESC, zone LIMIT 10"""))
def report_stress_days(spark, sf):
    return masked(serving.report_stress_days(stress(spark, sf)))


@query(oracle("""SELECT scenario_id, zone, event_date, baseline_stress_score, simulated_stress_score, stress_delta,
    recommendation FROM what_if_rows ORDER BY event_date, zone, scenario_id LIMIT 10"""))
def report_scenarios(spark, sf):
    return serving.report_scenarios(scenarios(spark, sf))


@query(oracle("""SELECT severity, category, zone, event_date, recommendation FROM recs
    ORDER BY event_date, zone, category LIMIT 10"""))
def report_recommendations(spark, sf):
    return serving.report_recommendations(advice(spark, sf))
