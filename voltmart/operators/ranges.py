"""Loaded ranges per (dataset, entity): which days are there, which are to be fetched, and corrections of loaded days.

A watermark is one date: days that failed before it, and days that the source corrects afterwards, are never fetched again.
Here every load and every correction appends a record (``RANGE_SCHEMA``) and the newest record of a day decides. All steps
work on (key, calendar day), pre-aggregated before the shuffle, so however many records a key has, a task holds one row per
calendar day of it. Rows without a key, a date or a known status cover nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from voltmart.functions.quantile import join_small
from voltmart.operators.operations import conform
from voltmart.schemas import DEFAULT_ZONES, struct
from voltmart.session import materialize
from voltmart.sinks.tables import append, finish_swaps, swap_files, with_bronze_metadata
from voltmart.sources.tables import configured

KEYS = ["dataset", "entity"]
LOADED, STALE = "LOADED", "STALE"
RANGE_SCHEMA = struct(
    "dataset string!, entity string!, start_date date!, end_date date!, status string!, recorded_at timestamp!"
)


def newest_days(ranges: DataFrame) -> DataFrame:
    """One row per key and covered day: ``status`` and ``recorded_at`` of its newest record; of equal times STALE wins."""
    named = ranges.filter("dataset IS NOT NULL AND entity IS NOT NULL AND start_date <= end_date")
    stale = F.coalesce(F.col("status") != LOADED, F.lit(True))
    days = named.select(
        *KEYS, F.explode(F.sequence("start_date", "end_date")).alias("day"), F.struct("recorded_at", stale.alias("s")).alias("_r")
    )
    newest = days.groupBy(*KEYS, "day").agg(F.max("_r").alias("_r"))
    return newest.select(
        *KEYS, "day", F.when(F.col("_r.s"), STALE).otherwise(LOADED).alias("status"), F.col("_r.recorded_at").alias("recorded_at")
    )


def covered_days(ranges: DataFrame) -> DataFrame:
    """(dataset, entity, day) whose newest record says LOADED."""
    return newest_days(ranges).filter(F.col("status") == LOADED).select(*KEYS, "day")


def as_ranges(days: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Runs of consecutive days as (``keys``, start_date, end_date). ``days`` has each (``keys``, day) once."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("day"))
    runs = days.select(*keys, "day", F.date_sub("day", place).alias("_run"))
    return runs.groupBy(*keys, "_run").agg(F.min("day").alias("start_date"), F.max("day").alias("end_date")).drop("_run")


def loaded_ranges(ranges: DataFrame) -> DataFrame:
    """(dataset, entity, start_date, end_date): maximal loaded ranges; overlapping and adjacent records are merged."""
    return as_ranges(covered_days(ranges))


def holes(ranges: DataFrame, entities: DataFrame, first: str, target: str) -> DataFrame:
    """(dataset, entity, start_date, end_date, days): maximal ranges from ``first`` to ``target`` that are not loaded.

    ``entities`` names the keys that should be there; one without a record is one hole. Repeated entities count once.
    """
    low, high = F.lit(first).cast("date"), F.lit(target).cast("date")
    wanted = entities.select(*KEYS).dropna().distinct()

    def point(day: Column) -> Column:
        return F.struct(day.alias("start_date"), day.alias("end_date"))

    edges = wanted.select(*KEYS, F.inline(F.array(point(F.date_sub(low, 1)), point(F.date_add(high, 1)))))
    inside = loaded_ranges(ranges).filter((F.col("end_date") >= low) & (F.col("start_date") <= high)).join(
        wanted, KEYS, "left_semi"
    ).select(
        *KEYS, F.greatest("start_date", low).alias("start_date"), F.least("end_date", high).alias("end_date")
    )
    following = F.lead("start_date").over(Window.partitionBy(*KEYS).orderBy("start_date"))
    gaps = edges.unionByName(inside).select(
        *KEYS, F.date_add("end_date", 1).alias("start_date"), F.date_sub(following, 1).alias("end_date")
    )
    return gaps.filter((low <= high) & (F.col("start_date") <= F.col("end_date"))).withColumn(
        "days", F.datediff("end_date", "start_date") + 1
    )


def corrections(changes: DataFrame, ranges: DataFrame, changed_at: str = "changed_at") -> DataFrame:
    """STALE records for loaded days that changed at the source after they were loaded.

    ``changes``: dataset, entity, day and the time of the change. A change that the load already saw makes no record.
    """
    latest = changes.groupBy(*KEYS, "day").agg(F.max(changed_at).alias("_at"))
    loaded = newest_days(ranges).filter(F.col("status") == LOADED)
    late = latest.join(loaded, [*KEYS, "day"]).filter(F.col("_at") > F.col("recorded_at")).select(
        *KEYS, "day", F.col("_at").alias("recorded_at")
    )
    return as_ranges(late, [*KEYS, "recorded_at"]).withColumn("status", F.lit(STALE)).select(*RANGE_SCHEMA.names)


def record(batch: DataFrame, path: str) -> None:
    """Append records (columns of ``RANGE_SCHEMA``). A repeated append changes no answer."""
    append(conform(batch, RANGE_SCHEMA), path)


def read_ranges(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RANGE_SCHEMA).parquet(path)


def compact(spark: SparkSession, path: str) -> None:
    """Replace the records by the newest one of each day, merged over runs of equal status and time.

    Answers stay the same, also for older records that arrive later. Records appended meanwhile are kept.
    """
    finish_swaps(spark, path)
    stored = read_ranges(spark, path)
    files = stored.inputFiles()
    merged = as_ranges(newest_days(stored), [*KEYS, "status", "recorded_at"]).select(*RANGE_SCHEMA.names)
    swap_files(materialize(merged), path, files)


def bronze_holes(
    landed: DataFrame, ranges: DataFrame, dataset: str, batch_id: str, source: str, first: str, end: str,
    zone_list: Sequence[str] = DEFAULT_ZONES,
) -> DataFrame:
    """Landed rows from ``first`` through ``end`` on days that are not loaded, per zone (or corridor ``A>B``).

    The fixed dates filter the scan. The loaded days have one row per entity and day; their size decides how they are joined.
    """
    rows = configured(landed, zone_list).filter(
        (F.col("timestamp_utc") >= F.lit(first).cast("timestamp"))
        & (F.col("timestamp_utc") < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp"))
    )
    entity = F.concat_ws(">", "zone_from", "zone_to") if "zone_from" in rows.columns else F.col("zone")
    done = covered_days(ranges.filter(F.col("dataset") == dataset)).select(
        F.col("entity").alias("_entity"), F.col("day").alias("_day")
    )
    keyed = rows.withColumns({"_entity": entity, "_day": F.to_date("timestamp_utc")})
    due = join_small(keyed, done, ["_entity", "_day"], "left_anti").drop("_entity", "_day")
    return with_bronze_metadata(due, batch_id, source)
