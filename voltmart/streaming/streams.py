"""Structured Streaming jobs: topic routing, streaming Bronze, Silver and Gold, late rows, upserts.

All jobs run with ``availableNow`` by default: they drain what has landed and stop, so the same code serves scheduled
and continuous runs. Pass ``every`` for a processing-time trigger.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from voltmart.operators.silver import renewable_mw, share_pct
from voltmart.sinks.tables import delete_path, upsert, with_bronze_metadata
from voltmart.sources.series import is_renewable

ENVELOPE_SCHEMA = "topic string, key string, payload map<string, string>, event_time timestamp"


def read_landing(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "json") -> DataFrame:
    """Landed files as a stream, with a declared schema."""
    return spark.readStream.schema(schema).format(fmt).load(path)


def topic_events(events: DataFrame, topic: str | None = None) -> DataFrame:
    """Events of one topic, or all of them."""
    return events if topic is None else events.filter(F.col("topic") == topic)


def bronze_stream(landing: DataFrame, batch_id: str, source: str) -> DataFrame:
    return with_bronze_metadata(landing, batch_id, source)


def silver_generation_stream(bronze: DataFrame) -> DataFrame:
    """Rows with a readable timestamp and no negative value; renewable by production type."""
    parsed = bronze.withColumn("timestamp_utc", F.col("timestamp_utc").try_cast("timestamp"))
    ok = F.col("timestamp_utc").isNotNull() & F.coalesce(F.col("generation_mw") >= 0, F.lit(True))
    return parsed.filter(ok).withColumn("is_renewable", is_renewable())


def daily_renewables(silver: DataFrame, delay: str = "1 day") -> DataFrame:
    """Daily totals and renewable share per zone. State is one row per zone and open day."""
    daily = silver.withWatermark("timestamp_utc", delay).groupBy(F.window("timestamp_utc", "1 day"), "zone").agg(
        F.sum("generation_mw").alias("total_generation_mwh"), F.sum(renewable_mw()).alias("renewable_generation_mwh")
    )
    return daily.select(
        "zone", F.to_date("window.start").alias("event_date"), "total_generation_mwh", "renewable_generation_mwh",
        share_pct(F.col("renewable_generation_mwh"), F.col("total_generation_mwh")).alias("renewable_share_pct"),
    )


def _trigger(writer, every: str | None):
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def start_append(
    stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = (), every: str | None = None
) -> StreamingQuery:
    """Append to Parquet through the file sink, exactly once."""
    writer = (
        stream.writeStream.format("parquet").outputMode("append").option("path", path)
        .option("checkpointLocation", checkpoint).partitionBy(*partition_by)
    )
    return _trigger(writer, every).start()


def start_upsert(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], order: str, partition_by: Sequence[str] = (),
    output_mode: str = "append", every: str | None = None,
) -> StreamingQuery:
    """Upsert each micro-batch. A batch repeated after a failure leaves the table as it was."""
    def apply(batch: DataFrame, _: int) -> None:
        upsert(batch, path, keys, order, partition_by)

    return start_batches(stream, apply, checkpoint, output_mode, every)


def start_batches(
    stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str, output_mode: str = "append",
    every: str | None = None,
) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(apply).outputMode(output_mode).option("checkpointLocation", checkpoint)
    return _trigger(writer, every).start()


def start_with_late_rows(
    stream: DataFrame, ts: str, delay_seconds: int, on_time_path: str, late_path: str, marks_path: str,
    checkpoint: str, every: str | None = None,
) -> StreamingQuery:
    """Split each micro-batch: late are rows more than ``delay_seconds`` behind the newest event of earlier batches.

    Each batch keeps the newest event time so far, its own included, so the next one reads that single row; older marks are
    removed, and neither reads nor state grow with the batches. All writes go to a folder named by the batch, so a repeated
    batch overwrites its own output, from the same mark of the batch before.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            earlier = _mark_before(spark, marks_path, batch_id)
            newest = batch.agg(F.greatest(F.max(F.col(ts)), F.timestamp_seconds(F.lit(earlier).cast("double"))).alias("newest"))
            newest.write.mode("overwrite").parquet(f"{marks_path}/batch={batch_id}")
            late = F.lit(False)
            if earlier is not None:
                late = F.coalesce(F.col(ts) < F.timestamp_seconds(F.lit(earlier - delay_seconds)), F.lit(False))
            batch.filter(~late).write.mode("overwrite").parquet(f"{on_time_path}/batch={batch_id}")
            batch.filter(late).write.mode("overwrite").parquet(f"{late_path}/batch={batch_id}")
            # Only the batch before can still be asked for, should this one be repeated.
            delete_path(spark, f"{marks_path}/batch={batch_id - 2}")
        finally:
            batch.unpersist()

    return start_batches(stream, apply, checkpoint, every=every)


def _mark_before(spark: SparkSession, path: str, batch_id: int) -> float | None:
    """Newest event time of all batches before this one, in seconds: the mark of the last of them."""
    if batch_id == 0:
        return None
    mark = spark.read.schema("newest timestamp").parquet(f"{path}/batch={batch_id - 1}")
    return mark.agg(F.max("newest").cast("double")).first()[0]
