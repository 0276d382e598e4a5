"""Gold marts: daily aggregates, rolling metrics, corridor joins, stress scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from voltmart.functions.rolling import DAY, rolling_stats, seconds
from voltmart.operators.silver import renewable_mw, share_pct, z_score
from voltmart.schemas import SPREAD_CORRIDORS


def _created(df: DataFrame, name: str = "record_created_ts") -> DataFrame:
    return df.withColumn(name, F.current_timestamp())


def _day(df: DataFrame, name: str = "event_date") -> DataFrame:
    return df.withColumn(name, F.to_date("timestamp_utc"))


def _zero_unless_positive(guard: Column, value: Column) -> Column:
    return F.when(guard > 0, value).otherwise(F.lit(0.0))


def daily_generation(generation: DataFrame) -> DataFrame:
    return (
        _day(generation)
        .groupBy("zone", "event_date")
        .agg(
            F.sum("generation_mw").alias("total_generation_mwh"),
            F.sum(renewable_mw()).alias("renewable_generation_mwh"),
        )
        .withColumn(
            "renewable_share_pct", share_pct(F.col("renewable_generation_mwh"), F.col("total_generation_mwh"))
        )
    )


def renewable_stability(generation: DataFrame) -> DataFrame:
    """Daily totals and share; mean and stddev of the share over the current and 7 previous rows; dip flag.

    The window runs on the daily aggregate, one row per zone and day, not on the readings.
    """
    week = Window.partitionBy("zone").orderBy("event_date").rowsBetween(-7, 0)
    avg, std = F.col("renewable_share_7d_avg"), F.col("renewable_share_7d_stddev")
    out = daily_generation(generation).withColumns(
        {
            "renewable_share_7d_avg": F.avg("renewable_share_pct").over(week),
            "renewable_share_7d_stddev": F.stddev("renewable_share_pct").over(week),
        }
    )
    return _created(
        out.withColumns(
            {
                "renewable_volatility_index": _zero_unless_positive(avg, std / avg),
                "renewable_dip_flag": F.col("renewable_share_pct") < avg - std,
            }
        )
    )


def price_spikes(prices: DataFrame, hours: int = 24, bucket: int = DAY) -> DataFrame:
    """z-score against the trailing 24 h (both ends included); spike above 2, negative below 0."""
    rolled = rolling_stats(prices, ["zone"], seconds("timestamp_utc"), "price_eur_mwh", hours * 3600, bucket, "_w")
    out = rolled.withColumnsRenamed({"_w_avg": "price_24h_avg", "_w_std": "price_24h_stddev"}).drop("_w_n", "_w_pstd")
    out = out.withColumn("price_z_score", z_score("price_eur_mwh", "price_24h_avg", "price_24h_stddev"))
    return _created(
        out.withColumns(
            {"price_spike_flag": F.col("price_z_score") > 2.0, "negative_price_flag": F.col("price_eur_mwh") < 0}
        )
    )


def _ohlc() -> list[Column]:
    price, hour = F.col("price_eur_mwh"), F.hour("timestamp_utc")
    peak = (hour >= 8) & (hour < 20)
    return [
        F.min_by(price, "timestamp_utc").alias("price_open"),
        F.max_by(price, "timestamp_utc").alias("price_close"),
        F.max(price).alias("price_high"),
        F.min(price).alias("price_low"),
        F.avg(price).alias("price_avg"),
        F.stddev(price).alias("price_stddev"),
        F.count_if(price < 0).alias("negative_price_count"),
        F.avg(F.when(peak, price)).alias("peak_price_avg"),
        F.avg(F.when(~peak, price)).alias("offpeak_price_avg"),
    ]


def daily_load(load: DataFrame, day: str = "event_date") -> DataFrame:
    return _day(load, day).groupBy("zone", day).agg(
        F.sum("actual_load_mw").alias("total_load_mwh"),
        F.avg("abs_forecast_error_mw").alias("forecast_error_avg_mw"),
    )


def market_summary(prices: DataFrame, load: DataFrame, generation: DataFrame) -> DataFrame:
    """Daily open, close, high, low, mean, spread, peak and off-peak means with load and renewable share."""
    day = "summary_date"
    share = _day(generation, day).groupBy("zone", day).agg(
        F.avg("renewable_share_pct").alias("renewable_share_avg_pct")
    )
    return _created(
        _day(prices, day).groupBy("zone", day).agg(*_ohlc())
        .join(daily_load(load, day), ["zone", day], "left")
        .join(share, ["zone", day], "left")
    )


def import_dependency(flows: DataFrame, load: DataFrame) -> DataFrame:
    """Daily inflow over load. Names follow the mart: the inflow is gross and the "pct" is a ratio."""
    inflow = _day(flows).groupBy(F.col("zone_to").alias("zone"), "event_date").agg(
        F.sum("flow_mw").alias("total_net_import_mw")
    )
    used = daily_load(load).drop("forecast_error_avg_mw")
    total = F.col("total_load_mwh")
    return _created(
        inflow.join(used, ["zone", "event_date"]).withColumn(
            "import_dependency_pct", _zero_unless_positive(total, F.col("total_net_import_mw") / total)
        )
    )


def fact_prices(prices: DataFrame) -> DataFrame:
    return prices.withColumns(
        {
            "price_key": F.md5(F.concat("zone", F.col("timestamp_utc").cast("string"))),
            "date": F.to_date("timestamp_utc"),
            "hour": F.hour("timestamp_utc"),
            "is_negative_price": F.col("price_eur_mwh") < 0,
            "is_price_cap_hit": F.col("price_eur_mwh") >= 4000.0,
            "_loaded_at": F.current_timestamp(),
        }
    )


def daily_market(fact: DataFrame, generation: DataFrame, load: DataFrame) -> DataFrame:
    """Daily mart from the price fact, with total renewable MW, mean share and load."""
    gen = _day(generation, "date").groupBy("zone", "date").agg(
        F.sum(renewable_mw()).alias("total_renewable_mwh"),
        F.avg("renewable_share_pct").alias("renewable_share_avg_pct"),
    )
    return _created(
        fact.groupBy("zone", "date").agg(*_ohlc())
        .join(gen, ["zone", "date"], "left")
        .join(daily_load(load, "date"), ["zone", "date"], "left"),
        "_mart_refreshed_at",
    )


def corridor_prices(prices: DataFrame, corridors: Sequence[tuple[str, str]]) -> DataFrame:
    """One row per (corridor, timestamp) where both zones have a price, for all corridors in one shuffle.

    Each price goes to the corridors its zone belongs to and meets its partner in a partial aggregate, so there is no
    self join and no broadcast. Prices must be unique per (zone, timestamp); a second one raises an error.
    """
    ends = [
        F.when(
            F.col("zone") == zone,
            F.struct(
                F.lit(f"{a}-{b}").alias("corridor"), F.lit(a).alias("zone_a"), F.lit(b).alias("zone_b"),
                F.lit(side).alias("_side"),
            ),
        )
        for a, b in corridors
        for side, zone in (("a", a), ("b", b))
    ]
    member = F.filter(F.array(*ends), lambda e: e.isNotNull())
    rows = prices.select("timestamp_utc", "price_eur_mwh", F.inline(member))
    of = {side: F.when(F.col("_side") == side, F.col("price_eur_mwh")) for side in "ab"}
    paired = rows.groupBy("corridor", "zone_a", "zone_b", "timestamp_utc").agg(
        F.max(of["a"]).alias("price_a"),
        F.max(of["b"]).alias("price_b"),
        F.count_if(F.col("_side") == "a").alias("_na"),
        F.count_if(F.col("_side") == "b").alias("_nb"),
    )
    duplicate = F.raise_error(F.lit("corridor prices must be unique per zone and timestamp")).cast("boolean")
    both = F.when((F.col("_na") > 1) | (F.col("_nb") > 1), duplicate).otherwise(
        (F.col("_na") == 1) & (F.col("_nb") == 1)
    )
    return paired.filter(both).drop("_na", "_nb")


def price_spreads(prices: DataFrame, corridors: Sequence[tuple[str, str]] = SPREAD_CORRIDORS) -> DataFrame:
    """Zone and price at the high and low end of each corridor, spread, spread in % of the low price."""
    a_high = F.col("price_a") >= F.col("price_b")
    low, spread = F.col("price_low"), F.col("spread_eur_mwh")
    return (
        corridor_prices(prices, corridors)
        .withColumns(
            {
                "zone_high": F.when(a_high, F.col("zone_a")).otherwise(F.col("zone_b")),
                "zone_low": F.when(a_high, F.col("zone_b")).otherwise(F.col("zone_a")),
                "price_high": F.greatest("price_a", "price_b"),
                "price_low": F.least("price_a", "price_b"),
            }
        )
        .withColumn("spread_eur_mwh", F.col("price_high") - low)
        .withColumns(
            {
                "spread_pct": F.when(low != 0, spread / low * 100.0),
                "spread_key": F.md5(F.concat("corridor", F.col("timestamp_utc").cast("string"))),
                "_loaded_at": F.current_timestamp(),
            }
        )
    )


def regime_label(price: Column, score: Column) -> Column:
    return (
        F.when(price < 0, "NEGATIVE").when(price > 200, "SPIKE").when(score > 0.6, "STRESS").otherwise("NORMAL")
    )


def with_price_lags(prices: DataFrame, hours: Sequence[int] = (1, 24)) -> DataFrame:
    """``feature_lag_<h>h``: the zone's price exactly ``h`` hours before, NULL if there is none.

    Each price is sent to the stamps that look back at it; they meet in one aggregate, then in one join.
    """
    names = [f"feature_lag_{h}h" for h in hours]
    sent = F.inline(F.array(*[
        F.struct(
            F.timestamp_seconds(F.unix_timestamp("timestamp_utc") + 3600 * h).alias("_at"),
            *[F.when(F.lit(n == m), F.col("price_eur_mwh")).alias(n) for n in names],
        )
        for h, m in zip(hours, names)
    ]))
    back = prices.filter("price_eur_mwh IS NOT NULL").select(F.col("zone").alias("_zone"), sent).groupBy("_zone", "_at").agg(
        *[F.max(n).alias(n) for n in names]
    )
    same = F.col("zone").eqNullSafe(F.col("_zone")) & (F.col("timestamp_utc") == F.col("_at"))
    return prices.join(back, same, "left").drop("_zone", "_at")


def regime_signals(
    scored: DataFrame, model_version: str = "1", model_run_id: str = "local", confidence: float = 0.85
) -> DataFrame:
    """Label, confidence, lineage and key for rows that carry ``anomaly_score``.

    ``renewable_share_pct``, where there is one, becomes ``feature_res_share``; z-score and lags are kept as they are.
    """
    if "renewable_share_pct" in scored.columns:
        scored = scored.withColumnRenamed("renewable_share_pct", "feature_res_share")
    return scored.withColumns(
        {
            "regime_label": regime_label(F.col("price_eur_mwh"), F.col("anomaly_score")),
            "regime_confidence": F.lit(confidence),
            "model_version": F.lit(model_version),
            "model_run_id": F.lit(model_run_id),
            "signal_id": F.md5(F.concat("zone", F.col("timestamp_utc").cast("string"))),
            "scored_at": F.current_timestamp(),
        }
    )


def _first_of(df: DataFrame, names: Sequence[str], default: Column | None = None) -> Column:
    present = [F.col(n) for n in names if n in df.columns]
    parts = present + ([default] if default is not None else [])
    return F.coalesce(*parts) if parts else F.lit(None)


def generation_stability_rows(rows: DataFrame) -> DataFrame:
    """Daily totals of raw readings; rows without a date fall under UNKNOWN_DATE. ``orderBy`` is left to the reader."""
    stamps = ["event_timestamp_utc", "timestamp_utc", "datetime", "timestamp"]
    text = [F.col(c).cast("string") for c in stamps if c in rows.columns]
    values = ["quantity", "generation_mwh", "generation_mw"]
    zone = _first_of(rows, ["country_code"], F.lit("UNKNOWN"))
    day = F.coalesce(F.substring(F.coalesce(*text), 1, 10), F.lit("UNKNOWN_DATE")) if text else F.lit("UNKNOWN_DATE")
    value = _first_of(rows, values).try_cast("double")
    return (
        rows.select(zone.alias("country_code"), day.alias("event_date"), value.alias("_v"))
        .filter(F.col("_v").isNotNull())
        .groupBy("country_code", "event_date")
        .agg(
            F.sum("_v").alias("total_generation"),
            F.avg("_v").alias("avg_generation"),
            F.max("_v").alias("max_generation"),
            F.min("_v").alias("min_generation"),
            (F.max("_v") - F.min("_v")).alias("volatility_index"),
            F.count("_v").cast("double").alias("interval_count"),
        )
    )


def price_spike_flag(price: str = "price_eur_mwh", threshold: float = 200.0) -> Column:
    return F.coalesce(F.col(price) >= threshold, F.lit(False))


def import_ratio(imports: str = "imports_mw", demand: str = "demand_mw") -> Column:
    return F.try_divide(F.col(imports), F.col(demand))


def supply_demand_delta(supply: str, demand: str) -> Column:
    return F.col(supply) - F.col(demand)


def _stress_label(score: Column) -> Column:
    return F.when(score >= 0.75, "CRITICAL").when(score >= 0.5, "HIGH").when(score >= 0.25, "MEDIUM").otherwise("LOW")


def market_stress(prices: DataFrame, generation: DataFrame, load: DataFrame) -> DataFrame:
    """Three-risk daily stress from Silver: spikes 0.45, low renewable share 0.35, load forecast error 0.20."""
    keys = ["zone", "event_date"]
    price = F.col("price_eur_mwh")
    daily = _day(prices).groupBy(*keys).agg(
        F.avg(price).alias("avg_price_eur_mwh"),
        F.max(price).alias("max_price_eur_mwh"),
        F.stddev(price).alias("price_volatility"),
        F.count_if(F.col("price_z_score") > 2.0).alias("price_spike_count"),
        F.count_if(price < 0).alias("negative_price_count"),
    )
    used = _day(load).groupBy(*keys).agg(
        F.avg("actual_load_mw").alias("avg_load_mw"), F.avg("abs_forecast_error_mw").alias("avg_forecast_error_mw")
    )
    joined = daily.join(daily_generation(generation), keys, "left").join(used, keys, "left").fillna(0.0)
    p, r, e = F.col("price_risk"), F.col("renewable_risk"), F.col("load_risk")
    return _created(
        joined.withColumns(
            {
                "renewable_risk": F.greatest(F.lit(0.0), (60.0 - F.col("renewable_share_pct")) / 60.0),
                "price_risk": F.least(F.lit(1.0), F.col("price_spike_count") / 8.0),
                "load_risk": F.least(F.lit(1.0), F.col("avg_forecast_error_mw") / 1000.0),
            }
        )
        .withColumn("stress_score", F.round(0.45 * p + 0.35 * r + 0.20 * e, 4))
        .withColumn("stress_label", _stress_label(F.col("stress_score")))
        .withColumn(
            "main_driver",
            F.when((p >= r) & (p >= e), "PRICE_SPIKES")
            .when((r >= p) & (r >= e), "LOW_RENEWABLE_SHARE")
            .otherwise("LOAD_FORECAST_ERROR"),
        )
    )


def score_stress(rows: DataFrame, spike_count: int = 8, target_pct: float = 60.0, error_mw: float = 1000.0) -> DataFrame:
    """Five-risk score, label, driver (first largest risk) and finding text for daily rows.

    Accepts the column names of either daily mart; missing values count as 0.
    """
    zero = F.lit(0.0)
    out = rows.select(
        _first_of(rows, ["country_code", "zone"], F.lit("UNKNOWN")).alias("country_code"),
        _first_of(rows, ["event_date", "summary_date"]).cast("string").alias("event_date"),
        _first_of(rows, ["avg_price_eur_mwh", "price_avg"], zero).alias("avg_price_eur_mwh"),
        _first_of(
            rows, ["max_price_eur_mwh", "price_high", "avg_price_eur_mwh", "price_avg"], zero
        ).alias("max_price_eur_mwh"),
        _first_of(rows, ["price_volatility", "price_stddev"], zero).alias("price_volatility"),
        _first_of(rows, ["price_spike_count"], F.lit(0)).cast("long").alias("price_spike_count"),
        _first_of(rows, ["negative_price_count"], F.lit(0)).cast("long").alias("negative_price_count"),
        _first_of(rows, ["renewable_share_pct", "renewable_share_avg_pct"], zero).alias("renewable_share_pct"),
        _first_of(rows, ["renewable_volatility_index", "volatility_index"], zero).alias("renewable_volatility_index"),
        _first_of(rows, ["avg_load_mw", "total_load_mwh"], zero).alias("avg_load_mw"),
        _first_of(rows, ["avg_forecast_error_mw", "forecast_error_avg_mw"], zero).alias("avg_forecast_error_mw"),
        *[c for c in rows.columns if c.startswith("_keep_")],
    ).fillna({"event_date": "UNKNOWN_DATE"})

    def clip(x: Column) -> Column:
        return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))

    # Risk names in tie order with their weights.
    risks = [
        ("PRICE_SPIKES", 0.30, clip(F.col("price_spike_count") / F.lit(float(max(1, spike_count))))),
        ("PRICE_VOLATILITY", 0.20, clip(F.col("price_volatility") / 100.0)),
        ("LOW_RENEWABLE_SHARE", 0.25, clip((target_pct - F.col("renewable_share_pct")) / target_pct)),
        ("RENEWABLE_VOLATILITY", 0.10, clip(F.col("renewable_volatility_index"))),
        ("LOAD_FORECAST_ERROR", 0.15, clip(F.col("avg_forecast_error_mw") / error_mw)),
    ]
    out = out.withColumns({f"_risk{i}": risk for i, (_, _, risk) in enumerate(risks)})
    columns = [F.col(f"_risk{i}") for i in range(len(risks))]
    score = sum((F.lit(w) * c for (_, w, _), c in zip(risks, columns)), F.lit(0.0))
    largest = F.greatest(*columns)
    driver = F.coalesce(*[F.when(c == largest, F.lit(name)) for (name, _, _), c in zip(risks, columns)])
    out = out.withColumn("stress_score", F.round(score, 4)).withColumns(
        {"stress_label": _stress_label(F.col("stress_score")), "main_driver": driver}
    )
    def half_even(name: str, digits: int) -> Column:
        """Exact binary halves go to the even digit before printing; only multiples of 1/8 can be such halves."""
        exact = F.col(name) * 8 == F.floor(F.col(name) * 8)
        return F.when(exact, F.bround(name, digits)).otherwise(F.col(name))

    # Fixed value: wording of the finding.
    finding = F.format_string(
        "%s on %s had %s market stress (score=%.2f). Main driver: %s. Avg price=%.2f EUR/MWh, "
        "max price=%.2f EUR/MWh, renewable share=%.1f%%, price spikes=%d, negative-price intervals=%d.",
        "country_code", "event_date", F.lower("stress_label"), half_even("stress_score", 2), "main_driver",
        half_even("avg_price_eur_mwh", 2), half_even("max_price_eur_mwh", 2), half_even("renewable_share_pct", 1),
        "price_spike_count", "negative_price_count",
    )
    return out.withColumn("finding_summary", finding).drop(*[f"_risk{i}" for i in range(len(risks))])


def stress_inputs(prices: DataFrame, generation_daily: DataFrame, load: DataFrame) -> DataFrame:
    """Daily input rows for ``score_stress``: population stddev, spikes within the day, last generation and load row.

    Spikes need the day's mean and stddev first. Those go back to the prices as a small table, so a (zone, day) is
    never held in one task. ``generation_daily`` has one row per (zone, day); ``load`` rows are ordered by timestamp.
    """
    keys = ["zone", "event_date"]
    priced = _day(prices).filter(F.col("price_eur_mwh").isNotNull()).select(*keys, "price_eur_mwh")
    price = F.col("price_eur_mwh")
    stats = priced.groupBy(*keys).agg(
        F.avg(price).alias("avg_price_eur_mwh"),
        F.max(price).alias("max_price_eur_mwh"),
        F.stddev_pop(price).alias("price_volatility"),
        F.count(price).alias("_n"),
        F.count_if(price < 0).alias("negative_price_count"),
    )
    unit = F.when(F.col("price_volatility") > 0, F.col("price_volatility")).otherwise(F.lit(1.0))
    spikes = (
        priced.join(stats.select(*keys, "avg_price_eur_mwh", unit.alias("_unit"), "_n"), keys)
        .filter((F.col("_n") > 1) & ((price - F.col("avg_price_eur_mwh")) / F.col("_unit") > 2.0))
        .groupBy(*keys)
        .agg(F.count("*").alias("price_spike_count"))
    )
    last_load = _day(load).groupBy(*keys).agg(
        F.max_by("actual_load_mw", "timestamp_utc").alias("avg_load_mw"),
        F.max_by("abs_forecast_error_mw", "timestamp_utc").alias("avg_forecast_error_mw"),
    )
    share = generation_daily.select(*keys, "renewable_share_pct", "renewable_volatility_index")
    return (
        stats.join(spikes, keys, "left").join(share, keys, "left").join(last_load, keys, "left").drop("_n")
        .fillna(0)
    )


def fallback_prices(generation_daily: DataFrame) -> DataFrame:
    """Stand-in price series when no prices exist: 120 minus the renewable share."""
    share = F.coalesce("renewable_share_pct", F.lit(0.0))
    return generation_daily.select("zone", "event_date", (120.0 - share).alias("price_eur_mwh"))
