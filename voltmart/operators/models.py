"""Stored models: the rows of a model in a folder of their own, and a record per version that names the folder.

A version is visible once its record is written, which is the last step, and is never changed afterwards. So a crash leaves
at most a folder nobody reads, and whoever loads a version gets the same rows, and scores to the same bits, each time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from voltmart.sinks.tables import exists

_RECORD = (
    "model_name string, version string, run_id string, training_rows long, trained_from string, folder string, "
    "registered_at timestamp"
)


def records(spark: SparkSession, path: str) -> DataFrame:
    """All records of a model store, none if there is no store yet."""
    place = f"{path.rstrip('/')}/records"
    if not exists(spark, place):
        return spark.createDataFrame([], _RECORD)
    return spark.read.schema(_RECORD).parquet(place)


def find(spark: SparkSession, path: str, name: str, version: str | None = None) -> Row | None:
    """The record of a version, by default of the newest: the greatest number, or else the last one registered."""
    found = records(spark, path).filter(F.col("model_name") == name)
    if version is not None:
        found = found.filter(F.col("version") == version)
    number = F.expr("try_cast(version AS bigint)")
    return found.orderBy(number.desc_nulls_last(), F.col("registered_at").desc()).first()


def save(
    model: DataFrame, path: str, name: str, version: str, run_id: str, training_rows: int, trained_from: str = ""
) -> Row:
    """Store a model under a new version; an existing one is an error. Two writers of one version: the first record counts."""
    spark = model.sparkSession
    if find(spark, path, name, version) is not None:
        raise ValueError(f"model {name} already has a version {version}")
    folder = f"{name}-{uuid.uuid4().hex}"
    model.write.parquet(f"{path.rstrip('/')}/{folder}")
    record = spark.createDataFrame(
        [(name, version, run_id, training_rows, trained_from, folder)], ", ".join(_RECORD.split(", ")[:-1])
    ).withColumn("registered_at", F.current_timestamp())
    record.coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}/records")
    return records(spark, path).filter((F.col("model_name") == name) & (F.col("version") == version)).orderBy(
        "registered_at", "folder"
    ).first()


def load(spark: SparkSession, path: str, name: str, version: str | None = None) -> tuple[DataFrame, Row]:
    """The rows and the record of a stored model; an unknown one is an error."""
    record = find(spark, path, name, version)
    if record is None:
        raise LookupError(f"no model {name} {version or ''} in {path}")
    return spark.read.parquet(f"{path.rstrip('/')}/{record['folder']}"), record


def load_or_fit(
    spark: SparkSession, path: str, name: str, version: str, fit: Callable[[], tuple[DataFrame, int]],
    run_id: str = "local", trained_from: str = "",
) -> tuple[DataFrame, Row]:
    """The stored version, or else what ``fit`` gives (model and number of training rows), stored first."""
    if find(spark, path, name, version) is None:
        model, rows = fit()
        save(model, path, name, version, run_id, rows, trained_from)
    return load(spark, path, name, version)


def with_lineage(scored: DataFrame, record: Row) -> DataFrame:
    """Scored rows that each name the exact model: ``model_name``, ``model_version``, ``model_run_id``, ``scored_at``."""
    return scored.withColumns(
        {
            "model_name": F.lit(record["model_name"]), "model_version": F.lit(record["version"]),
            "model_run_id": F.lit(record["run_id"]), "scored_at": F.current_timestamp(),
        }
    )
