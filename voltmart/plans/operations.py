"""Queries over the operational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from voltmart.operators import operations as ops, serving
from voltmart.plans import market_views as views
from voltmart.plans.core import latest_load, latest_prices, silver_flows, silver_generation, silver_prices, stability
from voltmart.plans.inputs import _land_text, watermarks
from voltmart.plans.registry import CTES, oracle, query, r, rounded
from voltmart.schemas import CONTRACTS, PIPELINE_RUN_SCHEMA, WATERMARK_SCHEMA
from voltmart.session import scratch_path
from voltmart.sinks import tables as sinks

AS_OF = "2024-01-31 00:00:00"


def runs(spark: SparkSession, sf: str) -> DataFrame:
    """Ten events make one pipeline run; each event is a task."""
    number = F.floor(F.col("event_id") / 10)
    started = F.date_trunc("second", F.col("ts")).cast("timestamp")
    rows = views.table(spark, sf, "events").select(
        F.concat(F.lit("run_"), number.cast("string")).alias("run_id"),
        F.element_at(
            F.array(F.lit("daily_batch"), F.lit("intraday"), F.lit("backfill")), (number % 3 + 1).cast("int")
        ).alias("pipeline_name"),
        F.concat(F.lit("task_"), (F.col("event_id") % 10).cast("string")).alias("task_name"),
        started.alias("started_at"),
        F.timestamp_seconds(F.unix_timestamp(started) + F.col("event_id") % 300 * 60).alias("finished_at"),
        F.floor("value").alias("rows_read"),
        F.floor(F.col("value") / 2).alias("rows_written"),
        (F.floor("value") % 5).alias("rows_quarantined"),
        F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS").alias("status"),
    )
    return ops.conform(rows, PIPELINE_RUN_SCHEMA)


CTES.update(
    {
        "runs": """SELECT 'run_' || (event_id // 10) AS run_id,
            array_extract(['daily_batch', 'intraday', 'backfill'], (event_id // 10) % 3 + 1) AS pipeline_name,
            'task_' || (event_id % 10) AS task_name, date_trunc('second', ts) AS started_at,
            date_trunc('second', ts) + to_minutes(CAST(event_id % 300 AS INTEGER)) AS finished_at,
            CAST(floor(value) AS BIGINT) AS rows_read, CAST(floor(value / 2) AS BIGINT) AS rows_written,
            CAST(floor(value) AS BIGINT) % 5 AS rows_quarantined,
            CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status FROM events""",
        "run_sums": """SELECT run_id, pipeline_name, count(*) AS tasks, count(*) FILTER (status = 'SUCCESS') AS success,
            count(*) FILTER (status = 'FAILED') AS failed, CAST(sum(rows_read) AS BIGINT) AS rows_read,
            CAST(sum(rows_written) AS BIGINT) AS rows_written, CAST(sum(rows_quarantined) AS BIGINT) AS rows_quarantined,
            max(finished_at) AS created_at FROM runs GROUP BY ALL""",
        "last_runs": """SELECT * FROM run_sums QUALIFY row_number() OVER (
            PARTITION BY pipeline_name ORDER BY created_at DESC, run_id DESC) = 1""",
    }
)


@query(oracle("SELECT run_id, pipeline_name, task_name, started_at, finished_at, rows_read, status FROM runs"))
def run_record_append(spark, sf):
    path = scratch_path(spark, "runs")
    ops.append_runs(runs(spark, sf), path)
    return spark.read.parquet(path).select(
        "run_id", "pipeline_name", "task_name", "started_at", "finished_at", "rows_read", "status"
    )


@query(oracle("SELECT * FROM run_sums"))
def run_summary(spark, sf):
    return ops.run_summary(runs(spark, sf))


@query(oracle("SELECT * FROM last_runs"))
def latest_runs(spark, sf):
    return ops.latest_runs(runs(spark, sf))


@query(oracle(f"""SELECT l.pipeline_name, l.run_id, created_at AS last_run_utc,
    CAST(floor((epoch(TIMESTAMP '{AS_OF}') - epoch(created_at)) / 60) AS BIGINT) AS age_minutes, tasks, success, failed,
    coalesce(stale, '') AS stale_tasks, l.rows_written, l.rows_quarantined FROM last_runs l LEFT JOIN (
    SELECT run_id, pipeline_name, string_agg(task_name, ',' ORDER BY task_name) AS stale FROM runs
    WHERE status <> 'SUCCESS' GROUP BY ALL) s ON l.run_id = s.run_id AND l.pipeline_name = s.pipeline_name"""))
def freshness_report(spark, sf):
    report = ops.freshness_report(runs(spark, sf), F.lit(AS_OF).cast("timestamp"))
    return report.withColumn("stale_tasks", F.concat_ws(",", "stale_tasks"))


_LIMITS = ", ".join(f"('{c.name}', {c.freshness_minutes})" for c in CONTRACTS.values() if c.freshness_minutes)


@query(oracle(f"""SELECT contract, freshness_minutes, age AS age_minutes,
    CASE WHEN age BETWEEN 0 AND freshness_minutes THEN 'OK' ELSE 'STALE' END AS status FROM (
    SELECT CAST(floor((epoch(TIMESTAMP '{AS_OF}') - epoch(max(finished_at))) / 60) AS BIGINT) AS age FROM runs
    WHERE pipeline_name = 'daily_batch'), (VALUES {_LIMITS}) c(contract, freshness_minutes)"""))
def contract_freshness(spark, sf):
    return ops.contract_freshness(runs(spark, sf), F.lit(AS_OF).cast("timestamp"))


@query(oracle(f"""SELECT zone, max(timestamp_utc) AS latest,
    (epoch(TIMESTAMP '{AS_OF}') - epoch(max(timestamp_utc))) / 60 <= 60 AS is_fresh FROM prices GROUP BY zone"""))
def dataset_freshness(spark, sf):
    return ops.dataset_freshness(
        views.prices(spark, sf), "timestamp_utc", F.lit(AS_OF).cast("timestamp"), 60, ["zone"]
    )


@query(oracle(f"SELECT run_id, task_name, {r('rows_read * 0.15', 4, 'cost')} FROM runs"))
def job_cost(spark, sf):
    priced = runs(spark, sf).select("run_id", "task_name", ops.job_cost("rows_read", 0.15).alias("cost"))
    return rounded(priced, "cost", digits=4)


@query(oracle("""SELECT 'prices' AS dataset, zone AS entity, CASE WHEN bad THEN NULL ELSE last END AS watermark, row_count
    AS rows, CASE WHEN bad THEN 'FAILED' ELSE 'SUCCESS' END AS status, CASE WHEN bad THEN 'timeout' END AS last_error
    FROM (SELECT zone, zone = 'RO' AS bad, strftime(max(timestamp_utc), '%Y-%m-%d') AS last,
    CASE WHEN zone <> 'RO' THEN count(*) END AS row_count FROM prices GROUP BY zone)
    UNION ALL SELECT 'prices', 'NL-failed', NULL, NULL, 'FAILED', 'timeout'"""))
def watermark_table(spark, sf):
    path = scratch_path(spark, "watermarks")
    stamp = F.lit("2024-02-01 00:00:00").cast("timestamp")
    loaded = views.prices(spark, sf).groupBy(F.col("zone").alias("entity")).agg(
        F.date_format(F.max("timestamp_utc"), "yyyy-MM-dd").alias("watermark"), F.count("*").alias("rows")
    ).withColumns({"dataset": F.lit("prices"), "updated_at": stamp})
    ops.mark_success(loaded.filter("entity <> 'RO'"), path)
    failed = loaded.filter("entity IN ('RO', 'NL')").select(
        "dataset", F.when(F.col("entity") == "NL", "NL-failed").otherwise(F.col("entity")).alias("entity"),
        F.lit("timeout").alias("last_error"), F.lit("2024-02-02 00:00:00").cast("timestamp").alias("updated_at"),
    )
    ops.mark_failed(failed, spark.read.schema(WATERMARK_SCHEMA).parquet(path), path)
    return spark.read.schema(WATERMARK_SCHEMA).parquet(path).drop("updated_at")


@query(oracle("""SELECT 'prices' AS dataset, zone AS entity, coalesce(watermark, '2020-01-01') AS watermark
    FROM (SELECT DISTINCT zone FROM prices) LEFT JOIN marks ON dataset = 'prices' AND entity = zone"""))
def watermark_with_fallback(spark, sf):
    entities = views.prices(spark, sf).select(F.lit("prices").alias("dataset"), F.col("zone").alias("entity")).distinct()
    return ops.watermark_or(watermarks(spark, sf), entities, "2020-01-01")


@query(oracle("""SELECT d AS dataset, zone AS entity, mark + 1 AS start_date, DATE '2024-01-05' AS end_date,
    date_diff('day', mark, DATE '2024-01-05') AS days FROM (
    SELECT d, zone, coalesce(CAST(watermark AS DATE), DATE '2020-01-01') AS mark FROM (SELECT DISTINCT zone FROM prices),
    (VALUES ('prices'), ('load')) v(d) LEFT JOIN marks ON dataset = d AND entity = zone) WHERE mark < DATE '2024-01-05'"""))
def backfill_gaps(spark, sf):
    entities = views.prices(spark, sf).select(F.col("zone").alias("entity")).distinct()
    return ops.backfill_gaps(entities, watermarks(spark, sf), ["prices", "load"], "2024-01-05", "2020-01-01")


@query(oracle("""SELECT zone AS country, strftime(timestamp_utc, '%Y-%m-%d') AS ingestion_date,
    CAST(count(*) AS BIGINT) AS row_count, true AS whole_files FROM prices GROUP BY ALL"""))
def backfill_plan(spark, sf):
    landed = spark.read.text(_land_text(spark, sf)).select(F.col("_metadata.file_path").alias("source_file"))
    plan = ops.backfill_plan(landed)
    part = lambda name: F.regexp_extract("source_file", rf"/{name}=([^/]+)/", 1).alias(name)
    return plan.groupBy(part("country"), part("ingestion_date")).agg(
        F.sum("row_count").alias("row_count"), F.min(F.col("source_file").endswith(".txt")).alias("whole_files")
    )


CTES["coverage_rows"] = """SELECT zone, day, flow_partner, coalesce(prices, 0) AS prices, coalesce(loads, 0) AS load,
    coalesce(gens, 0) AS generation, coalesce(fl, 0) AS flows,
    coalesce(prices > 0 AND loads > 0 AND gens > 0 AND fl > 0, false) AS all_datasets_have_data FROM (
    SELECT zone, CAST(unnest(generate_series(DATE '2023-12-30', DATE '2024-01-31', INTERVAL 1 DAY)) AS DATE) AS day,
    CASE zone WHEN 'RO' THEN 'HU' WHEN 'NL' THEN 'DE' WHEN 'DE' THEN 'NL' WHEN 'FR' THEN 'BE' WHEN 'BE' THEN 'FR'
    WHEN 'DK-1' THEN 'DE' WHEN 'DK-2' THEN 'DK-1' END AS flow_partner FROM (SELECT DISTINCT zone FROM prices))
    LEFT JOIN (SELECT zone, CAST(timestamp_utc AS DATE) AS day, count(*) AS prices FROM latest_prices GROUP BY ALL)
      USING (zone, day)
    LEFT JOIN (SELECT zone, CAST(timestamp_utc AS DATE) AS day, count(*) AS loads FROM s_load GROUP BY ALL)
      USING (zone, day)
    LEFT JOIN (SELECT zone, CAST(timestamp_utc AS DATE) AS day, count(*) AS gens FROM s_generation GROUP BY ALL)
      USING (zone, day)
    LEFT JOIN (SELECT zone_from AS zone, zone_to AS flow_partner, CAST(timestamp_utc AS DATE) AS day, count(*) AS fl
      FROM s_flows GROUP BY ALL) USING (zone, day, flow_partner)"""


def _coverage(spark, sf):
    zones = views.prices(spark, sf).select("zone").distinct()
    return ops.coverage(
        latest_prices(spark, sf), latest_load(spark, sf), silver_generation(spark, sf), silver_flows(spark, sf),
        zones, "2023-12-30", "2024-01-31",
    )


@query(oracle("SELECT * FROM coverage_rows"))
def coverage(spark, sf):
    return _coverage(spark, sf)


@query(oracle("""SELECT zone, flow_partner, count(*) AS days_checked,
    count(*) FILTER (all_datasets_have_data) AS overlap_day_count, CAST(sum(prices) AS BIGINT) AS prices,
    CAST(sum(load) AS BIGINT) AS load, CAST(sum(generation) AS BIGINT) AS generation, CAST(sum(flows) AS BIGINT) AS flows
    FROM coverage_rows GROUP BY ALL""".replace("sum(load) AS BIGINT) AS load", "sum(coverage_rows.load) AS BIGINT) AS load")))
def coverage_summary(spark, sf):
    return ops.coverage_summary(_coverage(spark, sf))


@query(oracle("""SELECT (SELECT count(*) FROM latest_prices) AS silver_prices,
    (SELECT count(*) FROM s_generation) AS silver_generation, (SELECT count(*) FROM s_load) AS silver_load,
    f.n AS silver_flows, (SELECT count(*) FROM stability) AS gold_renewable_stability,
    true AS usable_for_market_stress, f.n > 0 AS fully_populated_for_cross_border, CASE WHEN f.n > 0 THEN '' ELSE
    'No Silver flows found; import dependency and corridor-based intelligence will be limited.' END AS warnings
    FROM (SELECT count(*) AS n FROM s_flows) f"""))
def input_diagnostics(spark, sf):
    row = ops.input_diagnostics(
        {
            "silver_prices": latest_prices(spark, sf),
            "silver_generation": silver_generation(spark, sf),
            "silver_load": latest_load(spark, sf),
            "silver_flows": silver_flows(spark, sf),
            "gold_renewable_stability": stability(spark, sf),
        }
    )
    return row.withColumn("warnings", F.concat_ws("|", "warnings"))


@query(oracle("""SELECT zone_from || '->' || zone_to AS flow_corridor, count(*) AS row_count FROM flows GROUP BY ALL"""))
def corridor_counts(spark, sf):
    return ops.corridor_counts(views.flows(spark, sf))


@query("""SELECT event_id, CASE WHEN m >= 240 OR c >= 10000 OR v >= 10000000 THEN 'MAJOR'
    WHEN m >= 60 OR c >= 1000 OR v >= 1000000 OR b THEN 'SIGNIFICANT' ELSE 'MINOR' END AS severity,
    m >= 60 OR c >= 1000 OR v >= 1000000 OR b AS eba_reportable,
    CASE WHEN m >= 240 OR c >= 10000 OR v >= 10000000
      THEN 'duration=' || m || 'min clients=' || c || ' value=EUR' || CAST(v AS BIGINT)
    WHEN m >= 60 OR c >= 1000 OR v >= 1000000 OR b THEN 'significant threshold or cross-border impact'
    ELSE 'below all significance thresholds' END AS classification_reason
    FROM (SELECT event_id, event_id % 300 AS m, user_id * 7 AS c, floor(value) * 20000 AS v, event_id % 11 = 0 AS b
    FROM events WHERE event_type = 'error')""")
def incident_severity(spark, sf):
    failures = views.table(spark, sf, "events").filter("event_type = 'error'").select(
        "event_id",
        (F.col("event_id") % 300).alias("duration_minutes"),
        (F.col("user_id") * 7).alias("affected_clients_est"),
        (F.floor("value") * 20000).cast("double").alias("impacted_value_eur"),
        (F.col("event_id") % 11 == 0).alias("is_cross_border"),
    )
    return ops.classify_incidents(failures).select("event_id", "severity", "eba_reportable", "classification_reason")


def erasure_requests(spark: SparkSession, sf: str) -> DataFrame:
    """One request per zone, pending for two of them."""
    zone_rows = views.prices(spark, sf).select("zone").distinct()
    return zone_rows.select(
        F.concat(F.lit("req-"), "zone").alias("erasure_id"), F.col("zone").alias("entity_id"),
        F.lit("2024-02-01 00:00:00").cast("timestamp").alias("requested_at"),
        F.lit(None).cast("timestamp").alias("completed_at"),
        F.when(F.col("zone").isin("NL", "FR"), "PENDING").otherwise("COMPLETED").alias("status"),
    )


@query(oracle("""SELECT 'req-' || z AS erasure_id, z AS entity_id, 'COMPLETED' AS status,
    (SELECT count(*) FROM prices WHERE zone = z) AS bronze_rows_deleted,
    (SELECT count(*) FROM s_flows WHERE zone_from = z OR zone_to = z) AS silver_rows_deleted,
    (SELECT count(*) FROM stability WHERE zone = z) AS gold_rows_deleted FROM (VALUES ('NL'), ('FR')) v(z)"""))
def erasure_audit(spark, sf):
    tables = {
        "prices": ("bronze", views.prices(spark, sf), ["zone"]),
        "flows": ("silver", silver_flows(spark, sf), ["zone_from", "zone_to"]),
        "stability": ("gold", stability(spark, sf), ["zone"]),
    }
    return ops.erasure_counts(tables, erasure_requests(spark, sf)).drop("requested_at", "completed_at")


_ERASED = """SELECT 'prices' AS table_name, zone, count(*) AS row_count FROM prices WHERE zone NOT IN ('NL', 'FR')
    GROUP BY ALL UNION ALL SELECT 'flows', zone_from, count(*) FROM s_flows
    WHERE zone_from NOT IN ('NL', 'FR') AND zone_to NOT IN ('NL', 'FR') GROUP BY ALL
    UNION ALL SELECT 'requests ' || status, 'any', count(*) FROM (SELECT DISTINCT zone, 'COMPLETED' AS status FROM prices)
    GROUP BY ALL"""


def _cascade(spark: SparkSession, sf: str, indexed: bool) -> DataFrame:
    root = scratch_path(spark, "erasure")
    paths = {n: f"{root}/{n}" for n in ("prices", "flows", "requests", "audit")}
    sinks.append_bronze(views.prices(spark, sf), paths["prices"])
    sinks.append(
        silver_flows(spark, sf).withColumn("event_date", F.to_date("timestamp_utc")), paths["flows"], ["event_date"]
    )
    sinks.write_parquet(erasure_requests(spark, sf), paths["requests"])
    ops.process_erasures(
        spark,
        {
            "prices": ("bronze", paths["prices"], ["zone"], ["zone"]),
            "flows": ("silver", paths["flows"], ["zone_from", "zone_to"], ["event_date"]),
        },
        paths["requests"], paths["audit"], "operator",
        {n: f"{root}/{n}_index" for n in ("prices", "flows")} if indexed else None,
    )

    def left(name: str, zone: str) -> DataFrame:
        rows = spark.read.parquet(paths[name])
        return rows.groupBy(F.lit(name).alias("table_name"), F.col(zone).alias("zone")).agg(
            F.count("*").alias("row_count")
        )

    requests = spark.read.parquet(paths["requests"]).groupBy(
        F.concat(F.lit("requests "), "status").alias("table_name"), F.lit("any").alias("zone")
    ).agg(F.count("*").alias("row_count"))
    return left("prices", "zone").unionByName(left("flows", "zone_from")).unionByName(requests)


@query(oracle(_ERASED))
def erasure_cascade(spark, sf):
    return _cascade(spark, sf, False)


@query(oracle(_ERASED))
def erasure_cascade_indexed(spark, sf):
    """The same rows stay when only the files that an index names are read."""
    return _cascade(spark, sf, True)


_PII_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@query("""SELECT 'customer' AS table_name, 'c_name' AS column_name, count(c_name) AS value_count FROM customer
    UNION ALL SELECT 'supplier', 's_name', count(s_name) FROM supplier
    UNION ALL SELECT 'part', 'p_name', count(p_name) FROM part
    UNION ALL SELECT 'nation', 'n_name', count(n_name) FROM nation
    UNION ALL SELECT 'region', 'r_name', count(r_name) FROM region""")
def pii_columns(spark, sf):
    """Columns with personal-data names and how many values they hold."""
    tables = {name: spark.read.parquet(f"{sf}/{name}.parquet") for name in _PII_TABLES}
    found = ops.pii_columns(ops.table_columns(spark, tables))
    named = [(r.table_name, r.column_name) for r in found.collect()]  # names of columns, of schemas alone
    counts = None
    for name in sorted({table for table, _ in named}):
        columns = [c for table, c in named if table == name]
        held = tables[name].agg(*[F.count(c).alias(c) for c in columns]).unpivot(
            [], columns, "column_name", "value_count"
        ).select(F.lit(name).alias("table_name"), "column_name", "value_count")
        counts = held if counts is None else counts.unionByName(held)
    return counts


@query(oracle("SELECT pipeline_name, task_name, status, rows_read, rows_written FROM runs"))
def run_dashboard(spark, sf):
    return serving.run_dashboard(runs(spark, sf))
