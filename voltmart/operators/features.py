"""Window features. Row frames run on chunks of a series, so one long series uses many tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from voltmart.functions.quantile import join_small
from voltmart.functions.rolling import (
    chunk_window, drop_halo, rolling_stats, with_row_chunks, with_running_counts,
)
from voltmart.operators.silver import renewable_mw, z_score
from voltmart.session import materialize

STEPS_PER_HOUR = 4  # 15-minute rows


def price_features(df: DataFrame, price: str = "price_eur_mwh", hours: int = 24, chunk: int = 4096) -> DataFrame:
    """Rolling mean and sample stddev over 4*hours+1 rows, z-score, flags, lags of 4 and 96 rows.

    Frames and lags count rows: they equal hours only for a gapless 15-minute series.
    """
    back = hours * STEPS_PER_HOUR
    rows = with_row_chunks(df, ["zone"], "timestamp_utc", max(back, 96), max(chunk, back, 96))
    order = chunk_window(["zone"])
    frame = order.rowsBetween(-back, 0)
    avg, std = f"price_{hours}h_avg", f"price_{hours}h_stddev"
    out = rows.withColumns(
        {
            avg: F.avg(price).over(frame),
            std: F.stddev(price).over(frame),
            "price_lag_1h": F.lag(price, 4).over(order),
            "price_lag_24h": F.lag(price, 96).over(order),
        }
    ).withColumn("price_z_score", z_score(price, avg, std))
    return drop_halo(out).withColumns(
        {"price_spike_flag": F.col("price_z_score") > 2.0, "negative_price_flag": F.col(price) < 0}
    )


def generation_features(df: DataFrame, hours: int = 24, chunk: int = 4096) -> DataFrame:
    """Rolling mean, sample stddev and coefficient of variation (0.0 unless the mean is positive)."""
    back = hours * STEPS_PER_HOUR
    rows = with_row_chunks(df, ["zone"], "timestamp_utc", back, max(chunk, back))
    frame = chunk_window(["zone"]).rowsBetween(-back, 0)
    avg, std = f"generation_{hours}h_avg", f"generation_{hours}h_stddev"
    return drop_halo(
        rows.withColumns(
            {avg: F.avg("generation_mw").over(frame), std: F.stddev("generation_mw").over(frame)}
        ).withColumn(
            "generation_volatility_ix",
            F.when(F.col(avg) > 0, F.col(std) / F.col(avg)).otherwise(F.lit(0.0)),
        )
    )


def load_features(df: DataFrame) -> DataFrame:
    """Load error ratio, NULL unless the actual load is positive."""
    ratio = F.when(F.col("actual_load_mw") > 0, F.col("abs_forecast_error_mw") / F.col("actual_load_mw"))
    return df.withColumn("load_error_ratio", ratio)


def generation_by_slot(generation: DataFrame) -> DataFrame:
    """Per (zone, timestamp): mean renewable share, total and renewable MW."""
    return generation.groupBy("zone", "timestamp_utc").agg(
        F.avg("renewable_share_pct").alias("renewable_share_pct"),
        F.sum("generation_mw").alias("generation_mw"),
        F.sum(renewable_mw()).alias("total_renewable_mw"),
    )


def feature_vector(prices: DataFrame, generation: DataFrame, load: DataFrame) -> DataFrame:
    """Prices with features, left-joined to generation and load features on (zone, timestamp); numbers default 0.0."""
    keys = ["zone", "timestamp_utc"]
    return (
        price_features(prices)
        .join(generation_features(generation_by_slot(generation)), keys, "left")
        .join(load_features(load).select(*keys, "abs_forecast_error_mw", "load_error_ratio"), keys, "left")
        .fillna(0.0)
    )


def import_bucket(ratio: str = "import_dependency_ratio") -> Column:
    r = F.col(ratio)
    return F.when(r >= 0.5, "HIGH").when(r >= 0.2, "MEDIUM").when(r.isNull(), "UNKNOWN").otherwise("LOW")


def renewable_share(renewable: str, total: str) -> Column:
    """Percent, NULL if the total is 0 or missing."""
    return F.try_divide(F.col(renewable), F.col(total)) * 100.0


def volatility_range(high: str = "max_generation", low: str = "min_generation") -> Column:
    return F.col(high) - F.col(low)


def local_features(prices: DataFrame, generation: DataFrame, load: DataFrame, history: int = 96) -> DataFrame:
    """Feature rows for all zones at once.

    Anchored on price timestamps; zones without any price use generation and load timestamps. Generation is summed
    and load takes its latest row per timestamp. History statistics use the ``history`` previous non-NULL values,
    the current one excluded. ``load`` needs ``_ingest_ts`` only if it holds several rows per timestamp.
    """
    def arrival(df: DataFrame) -> Column:
        return F.col("_ingest_ts").cast("long") if "_ingest_ts" in df.columns else F.lit(0).cast("long")

    keys = ["zone", "timestamp_utc"]
    parts = [
        prices.filter(F.col("price_eur_mwh").isNotNull()).select(
            *keys, F.col("price_eur_mwh").alias("price"), arrival(prices).alias("_price_no")
        ),
        generation.filter(F.col("generation_mw").isNotNull()).select(*keys, F.col("generation_mw").alias("generation")),
        load.select(*keys, "actual_load_mw", "forecast_load_mw", arrival(load).alias("_load_no")),
    ]
    stacked = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    # The three series meet in one aggregate: one shuffle, no join. Stored, because three passes read it.
    merged = materialize(
        stacked.groupBy(*keys).agg(
            F.max_by("price", "_price_no").alias("price"),
            F.sum("generation").alias("generation"),
            F.max_by("actual_load_mw", "_load_no").alias("actual_load_mw"),
            F.max_by("forecast_load_mw", "_load_no").alias("forecast_load_mw"),
            (F.count("_load_no") > 0).alias("_has_load"),
        )
    )
    priced = merged.groupBy("zone").agg(F.max(F.col("price").isNotNull()).alias("_priced"))
    anchored = join_small(merged, priced, ["zone"]).filter("price IS NOT NULL OR NOT _priced").drop("_priced")

    # Place of each value among the key's non-NULL values; a row looks back from the number of values before it.
    out = with_running_counts(
        anchored, ["zone"], "timestamp_utc",
        {f"_before_{c}": f"{c} IS NOT NULL" for c in ("price", "generation")},
    )
    for c in ("price", "generation"):
        # places (before - history, before], as a frame with both ends
        out = rolling_stats(
            out, ["zone"], f"_before_{c}", c, history - 1, history - 1, f"_{c}",
            data_position=f"if({c} IS NOT NULL, _before_{c} + 1, NULL)",
        )

    def mean(c: str) -> Column:
        return F.coalesce(F.col(f"_{c}_avg"), F.lit(0.0))

    def std(c: str) -> Column:
        return F.when(F.col(f"_{c}_n") > 1, F.col(f"_{c}_pstd")).otherwise(F.lit(0.0))

    error = F.when(
        F.col("_has_load"), F.coalesce(F.abs(F.col("actual_load_mw") - F.col("forecast_load_mw")), F.lit(0.0))
    ).otherwise(F.lit(0.0))
    no_load = ~F.col("_has_load")
    return out.select(
        "zone", "timestamp_utc",
        F.to_date("timestamp_utc").alias("event_date"),
        F.coalesce("price", F.lit(0.0)).alias("price_eur_mwh"),
        mean("price").alias("price_24h_avg"),
        std("price").alias("price_24h_stddev"),
        F.when(F.col("price").isNotNull() & (std("price") > 0), (F.col("price") - mean("price")) / std("price"))
        .otherwise(F.lit(0.0)).alias("price_z_score"),
        F.coalesce(F.col("price") > 200.0, F.lit(False)).alias("price_spike_flag"),
        F.coalesce(F.col("price") < 0.0, F.lit(False)).alias("negative_price_flag"),
        F.coalesce("generation", F.lit(0.0)).alias("generation_mw"),
        mean("generation").alias("generation_24h_avg"),
        std("generation").alias("generation_24h_stddev"),
        F.when(mean("generation") > 0, std("generation") / mean("generation")).otherwise(F.lit(0.0))
        .alias("generation_volatility_ix"),
        F.when(no_load, F.lit(0.0)).otherwise(F.col("actual_load_mw")).alias("actual_load_mw"),
        F.when(no_load, F.lit(0.0)).otherwise(F.col("forecast_load_mw")).alias("forecast_load_mw"),
        error.alias("abs_forecast_error_mw"),
    )


# Candidate features in order.
FEATURE_CANDIDATES = [
    "price_eur_mwh", "price_z_score", "generation_mw", "generation_volatility_ix", "abs_forecast_error_mw",
]


def active_features(df: DataFrame, candidates: Sequence[str] = FEATURE_CANDIDATES) -> DataFrame:
    """Per zone the array of candidates with any non-zero value; the first candidate alone if there is none."""
    flags = df.groupBy("zone").agg(*[F.max(F.abs(F.coalesce(F.col(c), F.lit(0.0)))).alias(c) for c in candidates])
    names = F.filter(
        F.array(*[F.when(F.col(c) > 0, F.lit(c)) for c in candidates]), lambda n: n.isNotNull()
    )
    return flags.select(
        "zone",
        F.when(F.size(names) > 0, names).otherwise(F.array(F.lit(candidates[0]))).alias("feature_cols"),
    )
