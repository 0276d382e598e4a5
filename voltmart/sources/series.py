"""Fetched series to Bronze rows: reshape, convert to UTC, infer resolution, join actual and forecast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from voltmart.functions.keys import join_null_safe
from voltmart.functions.quantile import join_small
from voltmart.schemas import RENEWABLE_TYPES, ZONE_EIC
from voltmart.session import materialize

MARKET_TZ = "Europe/Brussels"


def present(value: str) -> Column:
    return F.col(value).isNotNull() & ~F.isnan(value)


def flat_name(column: str, separator: str = "|") -> str:
    """Two-level header to one: the aggregated series keeps the type name, others append their second level."""
    first, _, second = column.partition(separator)
    return first if second in ("", "Actual Aggregated") else f"{first}_{second}"


def generation_long(df: DataFrame, ids: Sequence[str] = ("zone", "timestamp_utc"), separator: str = "|") -> DataFrame:
    """One column per production type to one row per type; NULL and NaN dropped; renewable by type."""
    flat = df.select(*ids, *[F.col(f"`{c}`").alias(flat_name(c, separator)) for c in df.columns if c not in ids])
    types = [c for c in flat.columns if c not in ids]
    long = flat.unpivot(list(ids), types, "psr_type", "generation_mw")
    return long.filter(present("generation_mw")).withColumn("is_renewable", is_renewable())


def is_renewable(column: str = "psr_type") -> Column:
    return F.col(column).isin(RENEWABLE_TYPES)


def price_series(df: DataFrame, local: str = "timestamp_local", tz: str = MARKET_TZ) -> DataFrame:
    """Local wall time to UTC, NULL and NaN dropped, resolution stamped per zone."""
    rows = (
        df.filter(present("price_eur_mwh"))
        .withColumn("timestamp_utc", F.to_utc_timestamp(local, tz))
        .drop(local)
    )
    return join_small(rows, resolution_minutes(rows), ["zone"], "left")


def resolution_minutes(df: DataFrame, key: str = "zone", ts: str = "timestamp_utc", default: int = 60) -> DataFrame:
    """Minutes between the first two stamps of each series, else ``default``.

    Two partial minima per series: the first stamp, then the first one after it.
    """
    stamps = df.select(key, F.col(ts).alias("_ts"))
    firsts = materialize(stamps.groupBy(key).agg(F.min("_ts").alias("_first")))
    second = stamps.join(firsts, key).filter(F.col("_ts") > F.col("_first")).groupBy(key).agg(F.min("_ts").alias("_second"))
    gap = (F.col("_second").cast("long") - F.col("_first").cast("long")) / 60
    return join_null_safe(firsts, second, [key], "left").select(
        key, F.coalesce(gap.cast("int"), F.lit(default)).alias("resolution_minutes")
    )


def load_series(actual: DataFrame, forecast: DataFrame) -> DataFrame:
    """Full outer join on (zone, timestamp); error rounded to 2 places, NULL if one side is missing."""
    return actual.join(forecast, ["zone", "timestamp_utc"], "full").withColumn(
        "forecast_error_mw", F.round(F.col("actual_load_mw") - F.col("forecast_load_mw"), 2)
    )


def flow_series(df: DataFrame) -> DataFrame:
    return df.filter(present("flow_mw")).withColumn(
        "direction", F.concat("zone_from", F.lit("_TO_"), "zone_to")
    )


def zone_eic(zone: str = "zone") -> Column:
    """Market code of a zone from an eight-entry literal map; an unknown zone is an error."""
    codes = F.create_map(*[F.lit(x) for pair in ZONE_EIC.items() for x in pair])
    unknown = F.raise_error(F.concat(F.lit("unknown zone: "), F.coalesce(F.col(zone), F.lit("NULL"))))
    return F.coalesce(F.try_element_at(codes, F.col(zone)), unknown.cast("string"))


def request_window(start: Column, end: Column, tz: str = MARKET_TZ) -> tuple[Column, Column]:
    """Inclusive local dates to a half-open UTC range, daylight saving aware."""
    first = F.to_utc_timestamp(start.cast("timestamp"), tz)
    after = F.to_utc_timestamp(F.date_add(end.cast("date"), 1).cast("timestamp"), tz)
    return first, after


def in_request_window(df: DataFrame, start: str, end: str, ts: str = "timestamp_utc", tz: str = MARKET_TZ) -> DataFrame:
    first, after = request_window(F.lit(start), F.lit(end), tz)
    return df.filter((F.col(ts) >= first) & (F.col(ts) < after))
