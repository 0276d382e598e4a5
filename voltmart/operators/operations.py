"""Operational tables: runs, freshness, watermarks, backfill, coverage, incidents, erasure, PII columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from voltmart.functions.keys import latest_per_key
from voltmart.schemas import (
    CONTRACTS, ERASURE_SCHEMA, FLOW_PARTNERS, PII_NAME_PATTERNS, PIPELINE_RUN_SCHEMA, WATERMARK_SCHEMA,
)
from voltmart.session import materialize
from voltmart.sinks import file_index
from voltmart.sinks.tables import append, exists, finish_swaps, read_files, rewrite_without, swap_files, upsert
from voltmart.sources.tables import next_start


def conform(df: DataFrame, schema) -> DataFrame:
    """Select and cast to a declared schema; columns that are absent become NULL."""
    return df.select(
        *[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    )


def append_runs(runs: DataFrame, path: str) -> None:
    append(conform(runs, PIPELINE_RUN_SCHEMA), path)


def run_summary(runs: DataFrame) -> DataFrame:
    """Per pipeline run: tasks, successes, failures and row totals."""
    return runs.groupBy("run_id", "pipeline_name").agg(
        F.count("*").alias("tasks"),
        F.count_if(F.col("status") == "SUCCESS").alias("success"),
        F.count_if(F.col("status") == "FAILED").alias("failed"),
        F.sum("rows_read").alias("rows_read"),
        F.sum("rows_written").alias("rows_written"),
        F.sum("rows_quarantined").alias("rows_quarantined"),
        F.max("finished_at").alias("created_at"),
    )


def latest_runs(runs: DataFrame) -> DataFrame:
    """Newest run per pipeline (by finish time, then id)."""
    return latest_per_key(run_summary(runs), ["pipeline_name"], ["created_at", "run_id"])


def age_minutes(stamp: str, as_of: Column) -> Column:
    return F.floor((as_of.cast("long") - F.col(stamp).cast("long")) / 60)


def freshness_report(runs: DataFrame, as_of: Column) -> DataFrame:
    """Newest run per pipeline with its age, counts and the names of tasks that did not succeed."""
    newest = latest_runs(runs)
    stale = (
        runs.filter(F.col("status") != "SUCCESS")
        .join(newest.select("run_id", "pipeline_name"), ["run_id", "pipeline_name"], "left_semi")
        .groupBy("pipeline_name")
        .agg(F.sort_array(F.collect_list("task_name")).alias("stale_tasks"))
    )
    none = F.array().cast("array<string>")
    return newest.join(stale, "pipeline_name", "left").select(
        "pipeline_name", "run_id", F.col("created_at").alias("last_run_utc"),
        age_minutes("created_at", as_of).alias("age_minutes"),
        "tasks", "success", "failed", F.coalesce("stale_tasks", none).alias("stale_tasks"),
        "rows_written", "rows_quarantined",
    )


def contract_freshness(runs: DataFrame, as_of: Column, pipeline: str = "daily_batch") -> DataFrame:
    """Every contract with a freshness limit against the newest run of a pipeline; no run counts as age -1."""
    newest = runs.filter(F.col("pipeline_name") == pipeline).agg(F.max("finished_at").alias("_last"))
    lines = F.array(
        *[
            F.struct(F.lit(c.name).alias("contract"), F.lit(c.freshness_minutes).alias("freshness_minutes"))
            for c in CONTRACTS.values() if c.freshness_minutes is not None
        ]
    )
    age = F.coalesce(age_minutes("_last", as_of), F.lit(-1))
    return newest.select(F.inline(lines), age.alias("age_minutes")).withColumn(
        "status",
        F.when((F.col("age_minutes") >= 0) & (F.col("age_minutes") <= F.col("freshness_minutes")), "OK")
        .otherwise("STALE"),
    )


def dataset_freshness(df: DataFrame, ts: str, as_of: Column, max_age_minutes: int, keys: Sequence[str] = ()) -> DataFrame:
    newest = df.groupBy(*keys).agg(F.max(ts).alias("latest"))
    age = (as_of.cast("double") - F.col("latest").cast("double")) / 60
    return newest.withColumn("is_fresh", F.coalesce(age <= max_age_minutes, F.lit(False)))


def job_cost(units: str, rate: str | float) -> Column:
    return F.round(F.col(units) * (F.col(rate) if isinstance(rate, str) else F.lit(rate)), 4)


# ---------------------------------------------------------------------------
# Watermarks and backfill
# ---------------------------------------------------------------------------


def watermark_or(watermarks: DataFrame, entities: DataFrame, fallback: str) -> DataFrame:
    """Stored watermark per (dataset, entity), else the fallback."""
    return entities.join(watermarks, ["dataset", "entity"], "left").select(
        *entities.columns, F.coalesce("watermark", F.lit(fallback)).alias("watermark")
    )


def mark_success(batch: DataFrame, path: str) -> None:
    """``batch``: dataset, entity, watermark, rows, updated_at."""
    done = batch.withColumns({"status": F.lit("SUCCESS"), "last_error": F.lit(None)})
    upsert(conform(done, WATERMARK_SCHEMA), path, ["dataset", "entity"], "updated_at")


def mark_failed(failures: DataFrame, watermarks: DataFrame, path: str) -> None:
    """``failures``: dataset, entity, last_error, updated_at. The stored watermark and row count stay."""
    kept = failures.join(watermarks.select("dataset", "entity", "watermark", "rows"), ["dataset", "entity"], "left")
    failed = kept.withColumn("status", F.lit("FAILED"))
    upsert(conform(failed, WATERMARK_SCHEMA), path, ["dataset", "entity"], "updated_at")


def backfill_gaps(
    entities: DataFrame, watermarks: DataFrame, datasets: Sequence[str], target: str, fallback: str
) -> DataFrame:
    """(dataset, entity, start, end, days) for every pair behind the target date."""
    pairs = entities.select("entity", F.explode(F.array(*[F.lit(d) for d in datasets])).alias("dataset"))
    marks = pairs.join(watermarks.select("dataset", "entity", "watermark"), ["dataset", "entity"], "left")
    goal = F.lit(target).cast("date")
    default = F.lit(fallback).cast("date")
    mark = F.coalesce(F.coalesce("watermark", F.lit(fallback)).try_cast("date"), default)
    return marks.filter(mark < goal).select(
        "dataset", "entity", F.date_add(mark, 1).alias("start_date"), goal.alias("end_date"),
        F.datediff(goal, mark).alias("days"),
    )


def backfill_plan(landed: DataFrame, file: str = "source_file") -> DataFrame:
    """Rows per raw file."""
    return landed.groupBy(file).agg(F.count("*").alias("row_count"))


# ---------------------------------------------------------------------------
# Coverage and diagnostics
# ---------------------------------------------------------------------------
COVERAGE_DATASETS = ["prices", "load", "generation", "flows"]


def flow_partner(zone: str = "zone") -> Column:
    pairs = F.create_map(*[F.lit(x) for pair in FLOW_PARTNERS.items() for x in pair])
    return F.coalesce(F.try_element_at(pairs, F.col(zone)), F.lit("DE"))


def coverage(
    prices: DataFrame, load: DataFrame, generation: DataFrame, flows: DataFrame, zones: DataFrame,
    start: str, end: str,
) -> DataFrame:
    """Points per dataset for every zone and day, with the zone's flow partner, and whether all four have data."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("INTERVAL 1 DAY"))
    grid = zones.select("zone", F.explode(days).alias("day")).withColumn("flow_partner", flow_partner())

    def points(df: DataFrame, name: str) -> DataFrame:
        return df.select("zone", F.to_date("timestamp_utc").alias("day"), F.lit(name).alias("dataset"))

    partner_flows = flows.filter(F.col("zone_to") == flow_partner("zone_from")).withColumnRenamed("zone_from", "zone")
    counted = (
        points(prices, "prices").unionByName(points(load, "load"))
        .unionByName(points(generation, "generation")).unionByName(points(partner_flows, "flows"))
        .groupBy("zone", "day").pivot("dataset", COVERAGE_DATASETS).count()
    )
    filled = grid.join(counted, ["zone", "day"], "left").fillna(0, COVERAGE_DATASETS)
    everything = F.lit(True)
    for name in COVERAGE_DATASETS:
        everything = everything & (F.col(name) > 0)
    return filled.withColumn("all_datasets_have_data", everything)


def coverage_summary(rows: DataFrame) -> DataFrame:
    """Per zone: days checked, days with all datasets, point totals."""
    return rows.groupBy("zone", "flow_partner").agg(
        F.count("*").alias("days_checked"),
        F.count_if("all_datasets_have_data").alias("overlap_day_count"),
        *[F.sum(c).alias(c) for c in COVERAGE_DATASETS],
    )


def dataset_counts(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """One row per dataset with its row count; each count is one partial aggregate, none is run on its own."""
    parts = [df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("dataset"), "row_count")
             for n, df in datasets.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# Warnings by absent dataset.
INPUT_WARNINGS = {
    "silver_prices": "No Silver prices found; market stress may fall back to synthetic price assumptions.",
    "silver_load": "No Silver load found; load-risk outputs may be underpowered.",
    "silver_flows": "No Silver flows found; import dependency and corridor-based intelligence will be limited.",
    "gold_renewable_stability":
        "No Gold renewable stability found; local intelligence runner has no daily generation baseline.",
}
STRESS_INPUTS = ["silver_prices", "silver_generation", "silver_load", "gold_renewable_stability"]


def input_diagnostics(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """One row: counts by dataset, readiness flags and warnings."""
    wide = dataset_counts(datasets).groupBy().pivot("dataset", list(datasets)).agg(F.first("row_count"))
    usable = F.lit(True)
    for name in STRESS_INPUTS:
        usable = usable & (F.col(name) > 0)
    warnings = F.filter(
        F.array(*[F.when(F.col(n) == 0, F.lit(text)) for n, text in INPUT_WARNINGS.items()]),
        lambda w: w.isNotNull(),
    )
    return wide.withColumns(
        {
            "usable_for_market_stress": usable,
            "fully_populated_for_cross_border": usable & (F.col("silver_flows") > 0),
            "warnings": warnings,
        }
    )


def corridor_counts(flows: DataFrame) -> DataFrame:
    known = flows.filter(F.col("zone_from").isNotNull() & F.col("zone_to").isNotNull())
    return known.groupBy(F.concat("zone_from", F.lit("->"), "zone_to").alias("flow_corridor")).agg(
        F.count("*").alias("row_count")
    )


# ---------------------------------------------------------------------------
# Compliance
# ---------------------------------------------------------------------------


def classify_incidents(failures: DataFrame) -> DataFrame:
    """Severity, reason and reportability. Needs duration_minutes, affected_clients_est, impacted_value_eur,
    is_cross_border; missing numbers count as 0."""
    minutes = F.coalesce("duration_minutes", F.lit(0))
    clients = F.coalesce("affected_clients_est", F.lit(0))
    value = F.coalesce("impacted_value_eur", F.lit(0.0))
    border = F.coalesce("is_cross_border", F.lit(False))
    # Thresholds.
    major = (minutes >= 240) | (clients >= 10_000) | (value >= 10_000_000)
    significant = (minutes >= 60) | (clients >= 1_000) | (value >= 1_000_000) | border
    detail = F.format_string("duration=%smin clients=%s value=EUR%.0f", minutes, clients, value)
    return failures.withColumns(
        {
            "severity": F.when(major, "MAJOR").when(significant, "SIGNIFICANT").otherwise("MINOR"),
            "classification_reason": F.when(major, detail)
            .when(significant, "significant threshold or cross-border impact")
            .otherwise("below all significance thresholds"),
            "eba_reportable": major | significant,
        }
    )


def pending(requests: DataFrame) -> DataFrame:
    return requests.filter(F.col("status") == "PENDING")


def erasure_counts(tables: Mapping[str, tuple[str, DataFrame, Sequence[str]]], requests: DataFrame) -> DataFrame:
    """Audit rows for pending requests: matching rows per layer and entity.

    ``tables``: name to (layer, DataFrame, entity columns). A row naming an entity twice counts once.
    """
    ids = pending(requests).select("erasure_id", "entity_id", "requested_at")
    named_ids = ids.select("entity_id").distinct()
    hits = None
    for layer, df, columns in tables.values():
        named = df.select(F.explode(F.array_distinct(F.array(*columns))).alias("entity_id")).join(
            named_ids, "entity_id", "left_semi"
        ).groupBy("entity_id").agg(F.count("*").alias("n"))
        layer_hits = named.select("entity_id", F.lit(layer).alias("layer"), "n")
        hits = layer_hits if hits is None else hits.unionByName(layer_hits)
    per_layer = hits.groupBy("entity_id").pivot("layer", ["bronze", "silver", "gold"]).agg(F.sum("n"))
    return ids.join(per_layer, "entity_id", "left").select(
        "erasure_id", "entity_id", "requested_at", F.current_timestamp().alias("completed_at"),
        F.lit("COMPLETED").alias("status"),
        *[F.coalesce(layer, F.lit(0)).cast("long").alias(f"{layer}_rows_deleted")
          for layer in ("bronze", "silver", "gold")],
    )


def process_erasures(
    spark: SparkSession,
    tables: Mapping[str, tuple[str, str, Sequence[str], Sequence[str]]],
    requests_path: str,
    audit_path: str,
    operator: str,
    indexes: Mapping[str, str] | None = None,
) -> None:
    """Count, rewrite every table without the erased rows, complete the audit, then the requests.

    ``tables``: name to (layer, path, entity columns, partition columns). The counts are stored per erasure_id, with status
    IN_PROGRESS, before the first rewrite. A rerun after a failure at any step finds the requests still pending, keeps the
    stored counts, repeats the rewrites (which then find nothing) and leaves one audit row per request. Requests that are
    appended meanwhile stay pending: only the files read at the start are replaced.

    ``indexes``: name to the path of a table's file index (``sinks/file_index.py``). It is brought up to date first; then only
    files that hold a pending entity are counted and searched. Counts and rows left are those of the full search.
    """
    finish_swaps(spark, requests_path)
    read_requests = spark.read.parquet(requests_path)
    request_files = read_requests.inputFiles()
    requests = materialize(read_requests)
    open_ids = pending(requests).select("erasure_id")

    def stored() -> DataFrame:
        return spark.read.schema(ERASURE_SCHEMA).parquet(audit_path).join(open_ids, "erasure_id", "left_semi")

    fresh = requests
    if exists(spark, audit_path):
        fresh = requests.join(materialize(stored()).select("erasure_id"), "erasure_id", "left_anti")
    held: dict[str, list[str] | None] = {}
    for name, (_, path, columns, partition_by) in tables.items():
        held[name] = None
        if name in (indexes or {}):
            if not partition_by:
                finish_swaps(spark, path)
            file_index.refresh(spark, path, columns, indexes[name])
            held[name] = file_index.candidates(spark, path, indexes[name], pending(requests))
    read = {
        n: (layer, spark.read.parquet(path) if held[n] is None else read_files(spark, path, held[n]), columns)
        for n, (layer, path, columns, _) in tables.items()
    }
    counted = erasure_counts(read, fresh).withColumns(
        {"operator": F.lit(operator), "status": F.lit("IN_PROGRESS"), "completed_at": F.lit(None)}
    )
    append(materialize(conform(counted, ERASURE_SCHEMA)), audit_path)
    for name, (_, path, columns, partition_by) in tables.items():
        rewrite_without(spark, path, columns, pending(requests), partition_by, held[name])
    done = materialize(
        stored().withColumns(
            {"status": F.lit("COMPLETED"), "completed_at": F.coalesce("completed_at", F.current_timestamp())}
        )
    )
    upsert(done, audit_path, ["erasure_id"], "completed_at")
    closed = done.select("erasure_id", F.col("status").alias("_status"), F.col("completed_at").alias("_done"))
    updated = materialize(
        requests.join(closed, "erasure_id", "left").withColumns(
            {"status": F.coalesce("_status", "status"), "completed_at": F.coalesce("_done", "completed_at")}
        ).drop("_status", "_done")
    )
    swap_files(updated, requests_path, request_files)


def is_pii_name(column: str = "column_name") -> Column:
    return F.col(column).rlike("(?i)(" + "|".join(PII_NAME_PATTERNS) + ")")


def table_columns(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, column_name) of the given tables."""
    rows = [(name, column) for name, df in tables.items() for column in df.columns]
    return spark.createDataFrame(rows, "table_name string, column_name string")


def pii_columns(columns: DataFrame) -> DataFrame:
    return columns.filter(is_pii_name())
