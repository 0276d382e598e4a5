"""Streaming queries, drained to the end and read back as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from voltmart.plans import market_views as views
from voltmart.plans.registry import CTES, oracle, query, r, rounded
from voltmart.session import scratch_path
from voltmart.sinks.tables import read_like
from voltmart.streaming import streams


def _land(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).json(path)


def _generation_json(spark: SparkSession, sf: str) -> DataFrame:
    """Landed readings: a few without a readable time, a few negative."""
    key = F.col("_ingest_ts")
    return views.generation(spark, sf).select(
        "zone",
        F.when(key % 1000 == 7, F.lit("not a time"))
        .otherwise(F.date_format("timestamp_utc", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("timestamp_utc"),
        "psr_type",
        F.when(key % 500 == 3, -F.col("generation_mw")).otherwise(F.col("generation_mw")).alias("generation_mw"),
        key.alias("row_id"),
    )


CTES["landed_generation"] = """SELECT zone, CASE WHEN _ingest_ts % 1000 = 7 THEN NULL ELSE timestamp_utc END AS timestamp_utc,
    psr_type, CASE WHEN _ingest_ts % 500 = 3 THEN -generation_mw ELSE generation_mw END AS generation_mw,
    psr_type IN ('Solar', 'Wind Onshore', 'Biomass') AS is_renewable, _ingest_ts AS row_id FROM generation"""
CTES["streamed_generation"] = """SELECT * FROM landed_generation
    WHERE timestamp_utc IS NOT NULL AND coalesce(generation_mw >= 0, true)"""
LANDED = "zone string, timestamp_utc string, psr_type string, generation_mw double, row_id long"


def _landing(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "landing")
    _land(_generation_json(spark, sf), path)
    return path


@query(oracle("""SELECT zone, 'day-' || strftime(timestamp_utc, '%Y-%m-%d') AS key, timestamp_utc AS event_time,
    CAST(_ingest_ts AS VARCHAR) AS event_id FROM prices WHERE _ingest_ts % 2 = 0"""))
def topic_routed_events(spark, sf):
    landing, out = scratch_path(spark, "topics"), scratch_path(spark, "drained")
    envelopes = views.prices(spark, sf).select(
        F.when(F.col("_ingest_ts") % 2 == 0, "prices").otherwise("generation").alias("topic"),
        F.concat(F.lit("day-"), F.date_format("timestamp_utc", "yyyy-MM-dd")).alias("key"),
        F.create_map(F.lit("zone"), F.col("zone"), F.lit("id"), F.col("_ingest_ts").cast("string")).alias("payload"),
        F.col("timestamp_utc").alias("event_time"),
    )
    _land(envelopes, landing)
    events = streams.read_landing(spark, landing, streams.ENVELOPE_SCHEMA)
    streams.start_append(
        streams.topic_events(events, "prices"), out, scratch_path(spark, "cp"), ["topic"]
    ).awaitTermination()
    return spark.read.parquet(out).select(
        F.col("payload.zone").alias("zone"), "key", "event_time", F.col("payload.id").alias("event_id")
    )


@query(oracle("""SELECT zone, row_id, psr_type, generation_mw, 's-1' AS _batch_id, 'landing' AS _source
              FROM landed_generation"""))
def streaming_bronze(spark, sf):
    out = scratch_path(spark, "bronze")
    landing = streams.read_landing(spark, _landing(spark, sf), LANDED)
    streams.start_append(
        streams.bronze_stream(landing, "s-1", "landing"), out, scratch_path(spark, "cp"), ["zone"]
    ).awaitTermination()
    return spark.read.parquet(out).drop("_ingest_ts", "timestamp_utc")


@query(oracle("SELECT zone, timestamp_utc, psr_type, generation_mw, is_renewable, row_id FROM streamed_generation"))
def streaming_silver_generation(spark, sf):
    out = scratch_path(spark, "silver")
    landing = streams.read_landing(spark, _landing(spark, sf), LANDED)
    streams.start_append(
        streams.silver_generation_stream(landing), out, scratch_path(spark, "cp")
    ).awaitTermination()
    return spark.read.parquet(out)


_CLOSED = """SELECT zone, CAST(timestamp_utc AS DATE) AS event_date, sum(generation_mw) AS total_generation_mwh,
    sum(CASE WHEN is_renewable THEN generation_mw ELSE 0.0 END) AS renewable_generation_mwh FROM streamed_generation
    GROUP BY ALL"""


@query(oracle(f"""SELECT *, {r('renewable_generation_mwh / total_generation_mwh * 100.0', 6, 'renewable_share_pct')}
    FROM ({_CLOSED}) WHERE event_date + INTERVAL 1 DAY <=
    (SELECT max(timestamp_utc) - INTERVAL 1 DAY FROM streamed_generation)"""))
def streaming_daily_renewables(spark, sf):
    """Append mode: only days the watermark has closed."""
    out = scratch_path(spark, "gold")
    silver = streams.silver_generation_stream(streams.read_landing(spark, _landing(spark, sf), LANDED))
    streams.start_append(
        streams.daily_renewables(silver, "1 day"), out, scratch_path(spark, "cp")
    ).awaitTermination()
    return rounded(spark.read.parquet(out), "renewable_share_pct")


@query(oracle("""SELECT zone, timestamp_utc, _ingest_ts AS event_id, price_eur_mwh, timestamp_utc <
    (SELECT max(timestamp_utc) FROM prices WHERE _ingest_ts % 10 <> 0) - INTERVAL 2 DAYS AND _ingest_ts % 10 = 0
    AS is_late FROM prices"""))
def streaming_late_rows(spark, sf):
    """A tenth of the rows is held back and lands after the rest."""
    landing, root = scratch_path(spark, "landing"), scratch_path(spark, "late")
    rows = views.prices(spark, sf).withColumnRenamed("_ingest_ts", "event_id")
    checkpoint = scratch_path(spark, "cp")
    for part in (rows.filter("event_id % 10 <> 0"), rows.filter("event_id % 10 = 0")):
        _land(part, landing)
        streams.start_with_late_rows(
            streams.read_landing(spark, landing, rows.schema), "timestamp_utc", 2 * 86400, f"{root}/ok", f"{root}/late",
            f"{root}/marks", checkpoint,
        ).awaitTermination()

    def read(name: str, late: bool) -> DataFrame:
        return spark.read.schema(rows.schema).parquet(f"{root}/{name}").withColumn("is_late", F.lit(late))

    return read("ok", False).unionByName(read("late", True)).select(
        "zone", "timestamp_utc", "event_id", "price_eur_mwh", "is_late"
    )


@query(oracle("""SELECT zone, timestamp_utc, price_eur_mwh, _ingest_ts, CAST(timestamp_utc AS DATE) AS event_date
    FROM prices QUALIFY row_number() OVER (PARTITION BY zone, timestamp_utc ORDER BY _ingest_ts DESC) = 1"""))
def streaming_upsert(spark, sf):
    landing, out, checkpoint = (scratch_path(spark, n) for n in ("landing", "upsert", "cp"))
    rows = views.prices(spark, sf).withColumn("event_date", F.to_date("timestamp_utc"))
    for part in (rows.filter("_ingest_ts % 3 <> 0"), rows.filter("_ingest_ts % 3 = 0")):
        _land(part, landing)
        streams.start_upsert(
            streams.read_landing(spark, landing, rows.schema), out, checkpoint, ["zone", "timestamp_utc"],
            "_ingest_ts", ["event_date"],
        ).awaitTermination()
    return read_like(spark, out, rows)
