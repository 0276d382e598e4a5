"""Landed XML and JSON payloads to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_POINT = "struct<position: int, quantity: double, `price.amount`: double>"
_SERIES_SCHEMA = (
    "mRID string, MktPSRType struct<psrType: string>, "
    "Period array<struct<timeInterval: struct<start: string, end: string>, resolution: string, "
    f"Point: array<{_POINT}>>>"
)


def _instant(text: Column) -> Column:
    """ISO instant with or without seconds."""
    return F.coalesce(text.try_cast("timestamp"), F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mmX")))


def read_series_xml(spark: SparkSession, path: str, country_code: str | Column | None = None) -> DataFrame:
    """One row per point of every time series in the documents under ``path``, in any namespace.

    Keeps the series id, production type and period start, so points of different series stay apart.
    """
    series = (
        spark.read.format("xml")
        .option("rowTag", "TimeSeries")
        .option("ignoreNamespace", "true")
        .option("recursiveFileLookup", "true")
        .schema(_SERIES_SCHEMA)
        .load(path)
    )
    country = country_code if isinstance(country_code, Column) else F.lit(country_code).cast("string")
    points = series.select(
        F.col("mRID").alias("series_id"),
        F.col("MktPSRType.psrType").alias("psr_code"),
        F.col("_metadata.file_path").alias("source_file"),
        F.explode("Period").alias("_period"),
    )
    return points.select(
        "series_id", "psr_code", "source_file",
        _instant(F.col("_period.timeInterval.start")).alias("period_start"),
        F.col("_period.resolution").alias("resolution"),
        F.explode("_period.Point").alias("_point"),
    ).select(
        "*", country.alias("country_code"), F.col("_point.position").alias("position")
    )


def generation_points(spark: SparkSession, path: str, country_code: str | Column | None = None) -> DataFrame:
    points = read_series_xml(spark, path, country_code)
    return points.withColumns(
        {"quantity": F.col("_point.quantity"), "dataset_name": F.lit("generation")}
    ).drop("_point")


def price_points(spark: SparkSession, path: str, country_code: str | Column | None = None) -> DataFrame:
    points = read_series_xml(spark, path, country_code)
    return points.withColumns(
        {"price_eur_mwh": F.col("_point").getField("price.amount"), "dataset_name": F.lit("prices")}
    ).drop("_point")


WEATHER_SCHEMA = (
    "zone string, hourly struct<time: array<string>, temperature_2m: array<double>, wind_speed_10m: array<double>, "
    "shortwave_radiation: array<double>>"
)


def weather_rows(payloads: DataFrame) -> DataFrame:
    """Parallel arrays to one row per time stamp; values beyond the end of a short array are NULL."""
    hours = payloads.select("zone", "hourly", F.posexplode("hourly.time").alias("_i", "timestamp"))

    def at(field: str) -> Column:
        return F.get(F.col(f"hourly.{field}"), F.col("_i"))

    return hours.select(
        "zone", "timestamp",
        at("temperature_2m").alias("temperature_c"),
        at("wind_speed_10m").alias("wind_speed_m_s"),
        at("shortwave_radiation").alias("solar_radiation_w_m2"),
    )


CARBON_SCHEMA = "zone string, data array<struct<`from`: string, `to`: string, intensity: struct<actual: double, index: string>>>"


def carbon_rows(payloads: DataFrame) -> DataFrame:
    return payloads.select("zone", F.explode("data").alias("_d")).select(
        "zone",
        F.col("_d.from").alias("from_timestamp"),
        F.col("_d.to").alias("to_timestamp"),
        F.col("_d.intensity.actual").cast("double").alias("carbon_intensity_gco2_kwh"),
        F.col("_d.intensity.index").alias("carbon_index"),
    )


FX_SCHEMA = (
    "dataSets array<struct<series: map<string, struct<observations: map<string, array<double>>>>>>, "
    "structure struct<dimensions: struct<observation: array<struct<values: array<struct<id: string>>>>>>"
)
# Fixed value: the series key of a single-currency extract.
FX_SERIES = "0:0:0:0:0"


def fx_rows(payloads: DataFrame, base_currency: str, quote_currency: str) -> DataFrame:
    """Observation map to one row per observation; its date is looked up by index, else the index itself."""
    series = F.get(F.col("dataSets"), F.lit(0))["series"]
    values = F.get(F.col("structure.dimensions.observation"), F.lit(0))["values"]
    kept = [c for c in payloads.columns if c not in ("dataSets", "structure")]
    rows = payloads.select(
        *kept, values.alias("_dates"),
        F.explode(F.try_element_at(series, F.lit(FX_SERIES))["observations"]).alias("_i", "_obs"),
    )
    return rows.select(
        *kept,
        F.lit(base_currency).alias("base_currency"),
        F.lit(quote_currency).alias("quote_currency"),
        F.coalesce(F.get("_dates", F.col("_i").cast("int"))["id"], F.col("_i")).alias("timestamp"),
        F.get("_obs", F.lit(0)).alias("fx_rate"),
    )


def read_payloads(spark: SparkSession, path: str, schema: str, multi_line: bool = True) -> DataFrame:
    """JSON documents with a declared schema."""
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)
