"""Tables, landed files, reference data, incremental starts and the Bronze batch job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from voltmart.functions.quantile import join_small
from voltmart.schemas import DEFAULT_ZONES, FLOW_CORRIDORS, RENEWABLE_TYPES, ZONE_EIC
from voltmart.sinks.tables import with_bronze_metadata


def scan(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table by name, or a Parquet path."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def read_records(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON records with a declared schema; an empty DataFrame when the path does not exist."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def landed_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Path, modification time and size of the files under ``path``; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("path", "modificationTime", "length")
    )


def newest_file(files: DataFrame) -> DataFrame:
    """The newest landed file: latest ``ingestion_date`` in its path, then latest modification, then path."""
    day = F.regexp_extract("path", r"ingestion_date=(\d{4}-\d{2}-\d{2})", 1)
    best = F.max(F.struct(day.alias("ingestion_date"), "modificationTime", "path"))
    return files.agg(best.alias("_b")).select("_b.ingestion_date", "_b.modificationTime", "_b.path")


def zones(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(ZONE_EIC.items()), "zone string, eic string")


def corridors(spark: SparkSession, pairs: Sequence[tuple[str, str]] = FLOW_CORRIDORS) -> DataFrame:
    return spark.createDataFrame(list(pairs), "zone_from string, zone_to string")


def renewable_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(t,) for t in RENEWABLE_TYPES], "psr_type string")


def geography(spark: SparkSession) -> DataFrame:
    return zones(spark).orderBy("zone")


def start_from_target(target: DataFrame, ts: str, fallback: str) -> DataFrame:
    """One row: the day after the newest row of the target, or the fallback date if it is empty."""
    return target.agg(
        F.coalesce(F.date_add(F.to_date(F.max(ts)), 1), F.lit(fallback).cast("date")).alias("start_date")
    )


def next_start(watermark: Column, fallback: str) -> Column:
    """Day after a watermark; an absent watermark is the fallback date, an unreadable one starts at the fallback."""
    default = F.lit(fallback).cast("date")
    parsed = F.coalesce(watermark, F.lit(fallback)).try_cast("date")
    return F.coalesce(F.date_add(parsed, 1), default)


def start_from_watermarks(entities: DataFrame, watermarks: DataFrame, fallback: str) -> DataFrame:
    """Incremental start per (dataset, entity)."""
    return entities.join(
        watermarks.select("dataset", "entity", "watermark"), ["dataset", "entity"], "left"
    ).withColumn("start_date", next_start(F.col("watermark"), fallback))


def configured(df: DataFrame, zone_list: Sequence[str] = DEFAULT_ZONES) -> DataFrame:
    """Rows of configured zones; flows need a known corridor with both ends configured."""
    if "zone_from" not in df.columns:
        return df.filter(F.col("zone").isin(list(zone_list)))
    pairs = [(a, b) for a, b in FLOW_CORRIDORS if a in zone_list and b in zone_list]
    pair = F.concat_ws(">", "zone_from", "zone_to")
    return df.filter(pair.isin([f"{a}>{b}" for a, b in pairs]))


def bronze_batch(
    landed: DataFrame,
    watermarks: DataFrame,
    dataset: str,
    batch_id: str,
    source: str,
    end: str,
    fallback: str,
    zone_list: Sequence[str] = DEFAULT_ZONES,
) -> DataFrame:
    """Incremental slice of landed rows: per zone (or corridor ``A>B``) from its watermark through ``end``.

    The fixed end date filters the scan. The watermark table has one row per (dataset, entity), and its size decides
    how it is joined.
    """
    rows = configured(landed, zone_list).filter(
        F.col("timestamp_utc") < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp")
    )
    entity = F.concat_ws(">", "zone_from", "zone_to") if "zone_from" in rows.columns else F.col("zone")
    marks = watermarks.filter(F.col("dataset") == dataset).select(F.col("entity").alias("_entity"), "watermark")
    due = (
        join_small(rows.withColumn("_entity", entity), marks, ["_entity"], "left")
        .filter(F.col("timestamp_utc") >= next_start(F.col("watermark"), fallback).cast("timestamp"))
        .drop("_entity", "watermark")
    )
    return with_bronze_metadata(due, batch_id, source)
