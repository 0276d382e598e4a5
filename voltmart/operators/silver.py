"""Silver: parse, quarantine, deduplicate, enrich. Pure functions, no I/O, no actions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from voltmart.functions.keys import first_per_key, latest_per_key, split
from voltmart.functions.rolling import DAY, rolling_stats, seconds, with_row_index


def parse_timestamp(df: DataFrame, column: str = "timestamp_utc") -> DataFrame:
    """Any-offset ISO text (or timestamp) to an instant; bad text becomes NULL. The session runs in UTC."""
    return df.withColumn(column, F.col(column).try_cast("timestamp"))


def _stamp(df: DataFrame) -> DataFrame:
    return df.withColumn("_silver_ts", F.current_timestamp())


def _dedup(df: DataFrame, keys: list[str], order: Sequence[str]) -> DataFrame:
    present = [c for c in order if c in df.columns]
    return latest_per_key(df, keys, present) if present else df


def z_score(value: str, mean: str, std: str) -> Column:
    """(value - mean) / std, 0.0 when std is NULL or 0."""
    return F.when(F.col(std) > 0, (F.col(value) - F.col(mean)) / F.col(std)).otherwise(F.lit(0.0))


def silver_prices(
    df: DataFrame, order: Sequence[str] = ("_ingest_ts",), window_days: int = 30, bucket: int = DAY
) -> tuple[DataFrame, DataFrame]:
    """Latest price per (zone, timestamp) with its rolling z-score over the trailing ``window_days``."""
    valid, invalid = split(parse_timestamp(df), F.col("price_eur_mwh").isNotNull())
    valid = _dedup(valid, ["zone", "timestamp_utc"], order)
    rolled = rolling_stats(
        valid, ["zone"], seconds("timestamp_utc"), "price_eur_mwh", window_days * DAY, bucket, "_w"
    )
    valid = _stamp(
        rolled.withColumns(
            {
                "price_z_score": z_score("price_eur_mwh", "_w_avg", "_w_std"),
                "is_negative_price": F.col("price_eur_mwh") < 0,
            }
        ).drop("_w_n", "_w_avg", "_w_std", "_w_pstd")
    )
    return valid, invalid


def silver_generation(
    df: DataFrame, order: Sequence[str] = ("_ingest_ts",)
) -> tuple[DataFrame, DataFrame]:
    """Latest value per (zone, timestamp, type) with the renewable share of its (zone, timestamp).

    After the dedup a (zone, timestamp) group holds one row per production type, so the window groups are tiny.
    """
    valid, invalid = split(parse_timestamp(df), F.col("generation_mw").isNotNull())
    valid = _dedup(valid, ["zone", "timestamp_utc", "psr_type"], order)
    slot = Window.partitionBy("zone", "timestamp_utc")
    total = F.sum("generation_mw").over(slot)
    renewable = F.sum(renewable_mw()).over(slot)
    valid = valid.withColumns({"_total": total, "_ren": renewable}).withColumn(
        "renewable_share_pct", share_pct(F.col("_ren"), F.col("_total"))
    )
    return _stamp(valid.drop("_total", "_ren")), invalid


def renewable_mw() -> Column:
    return F.when(F.col("is_renewable"), F.col("generation_mw")).otherwise(F.lit(0.0))


def share_pct(part: Column, total: Column) -> Column:
    return F.when(total > 0, part / total * 100.0).otherwise(F.lit(0.0))


def silver_load(df: DataFrame, order: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Rows with an actual or a forecast; absolute forecast error, NULL if one side is missing.

    Several rows per key are kept unless ``order`` names the columns that pick the latest one.
    """
    some = F.col("actual_load_mw").isNotNull() | F.col("forecast_load_mw").isNotNull()
    valid, invalid = split(parse_timestamp(df), some)
    valid = _dedup(valid, ["zone", "timestamp_utc"], order)
    error = F.abs(F.col("actual_load_mw") - F.col("forecast_load_mw"))
    return _stamp(valid.withColumn("abs_forecast_error_mw", error)), invalid


def corridor_label(zone_a: str = "zone_from", zone_b: str = "zone_to") -> Column:
    return F.concat_ws("-", F.least(zone_a, zone_b), F.greatest(zone_a, zone_b))


def silver_flows(df: DataFrame, order: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Non-NULL flows with the undirected corridor label."""
    valid, invalid = split(parse_timestamp(df), F.col("flow_mw").isNotNull())
    valid = _dedup(valid, ["zone_from", "zone_to", "timestamp_utc"], order)
    return _stamp(valid.withColumn("corridor", corridor_label())), invalid


def deduplicate(df: DataFrame, keys: list[str], order: str | list[str]) -> DataFrame:
    """Keep the first row per key in arrival order ``order``."""
    return first_per_key(df, keys, order)


def deduplicate_generation(df: DataFrame, order: str | list[str]) -> DataFrame:
    """Keep-first on (country_code, position, source_file), plus series and period where the reader kept them."""
    extra = [c for c in ("series_id", "period_start") if c in df.columns]
    return first_per_key(df, ["country_code", "position", "source_file", *extra], order)


def split_measurements(df: DataFrame, value: str = "quantity") -> tuple[DataFrame, DataFrame]:
    """(numeric and >= 0, everything else)."""
    return split(df, F.col(value).try_cast("double") >= 0)


def silver_generation_rows(df: DataFrame, order: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Raw points: dedup, then split valid from quarantined."""
    return split_measurements(deduplicate_generation(df, order))


def position_timestamps(
    df: DataFrame, period_start: Column, order: str | None = None, keys: Sequence[str] = ("source_file",)
) -> DataFrame:
    """Timestamp = start + (position - 1) * 15 min; a missing position is replaced by the row's place in its file."""
    place = F.col("position")
    if order is not None:
        df = with_row_index(df, list(keys), order, "_place", bucket=65536)
        place = F.coalesce(place, F.col("_place") + 1)
    stamp = F.timestamp_add("MINUTE", (place.cast("int") - 1) * 15, period_start)
    out = df.withColumn("event_timestamp_utc", stamp)
    return out.withColumn("event_date", F.to_date("event_timestamp_utc")).drop("_place")


def tag_late_arrivals(df: DataFrame, column: str, watermark: Column) -> DataFrame:
    """Late when the event time is before the watermark; a missing event time is not late."""
    late = F.coalesce(F.col(column).try_cast("timestamp") < watermark, F.lit(False))
    return df.withColumn("is_late_arrival", late)


def tag_quarantine(df: DataFrame, reason: str | Column) -> DataFrame:
    return df.withColumn("_quarantine_reason", F.lit(reason) if isinstance(reason, str) else reason)


def scale_units(df: DataFrame, column: str, factor: float) -> DataFrame:
    """Multiply numbers; text columns keep what is not a number."""
    if dict(df.dtypes)[column] == "string":
        number = F.col(column).try_cast("double") * factor
        return df.withColumn(column, F.coalesce(number.cast("string"), F.col(column)))
    return df.withColumn(column, F.col(column).cast("double") * factor)


def to_utc(column: str | Column) -> Column:
    """Any-offset ISO text to a UTC instant."""
    return (F.col(column) if isinstance(column, str) else column).try_cast("timestamp")


def split_required(
    df: DataFrame, required: Sequence[str], payload: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows that carry every required field. With a MAP ``payload`` the test is per row, else on the schema."""
    if payload is None:
        return split(df, F.lit(all(c in df.columns for c in required)))
    present = F.lit(True)
    for name in required:
        present = present & F.map_contains_key(F.col(payload), name)
    return split(df, present)


def date_range(bounds: DataFrame, start: str, end: str, out: str = "day") -> DataFrame:
    """One row per day between two date columns, both ends included; none if the end is before the start."""
    ordered = bounds.filter(F.col(start) <= F.col(end))
    return ordered.withColumn(out, F.explode(F.sequence(F.col(start), F.col(end), F.expr("INTERVAL 1 DAY"))))
