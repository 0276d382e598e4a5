"""Example rows with known results for Silver, features, Gold and Platinum."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from voltmart.operators import features, gold, platinum, silver

T0 = dt.datetime(2024, 1, 1)


def ts(minutes):
    return (T0 + dt.timedelta(minutes=minutes)).strftime("%Y-%m-%dT%H:%M:%SZ")


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def test_prices_quarantine_negative_and_dedup(spark):
    rows = [("NL", ts(0), 45.5, 1), ("NL", ts(15), None, 1), ("NL", ts(30), -5.0, 1), ("NL", ts(0), 46.0, 2)]
    df = spark.createDataFrame(rows, "zone string, timestamp_utc string, price_eur_mwh double, _ingest_ts long")
    valid, bad = silver.silver_prices(df)
    got = valid.orderBy("timestamp_utc").collect()
    assert [(r["price_eur_mwh"], r["is_negative_price"]) for r in got] == [(46.0, False), (-5.0, True)]
    assert got[0]["price_z_score"] == 0.0 and bad.count() == 1
    assert valid.count() + bad.count() + 1 == df.count()


def test_generation_share(spark):
    rows = [("NL", ts(0), "Solar", 100.0, True), ("NL", ts(0), "Fossil Hard coal", 300.0, False),
            ("NL", ts(15), "Solar", None, True)]
    df = spark.createDataFrame(
        rows, "zone string, timestamp_utc string, psr_type string, generation_mw double, is_renewable boolean"
    )
    valid, bad = silver.silver_generation(df)
    assert [r["renewable_share_pct"] for r in valid.collect()] == [25.0, 25.0]
    assert bad.count() == 1


def test_load_error_and_one_sided_rows(spark):
    rows = [("NL", ts(0), 10000.0, 9800.0), ("NL", ts(15), None, None), ("NL", ts(30), 5.0, None)]
    df = spark.createDataFrame(rows, "zone string, timestamp_utc string, actual_load_mw double, forecast_load_mw double")
    valid, bad = silver.silver_load(df)
    assert sorted(r["abs_forecast_error_mw"] or -1 for r in valid.collect()) == [-1, 200.0]
    assert bad.count() == 1


def test_flow_corridor(spark):
    rows = [("NL", "DE", ts(0), 800.0), ("DE", "NL", ts(0), None)]
    df = spark.createDataFrame(rows, "zone_from string, zone_to string, timestamp_utc string, flow_mw double")
    valid, bad = silver.silver_flows(df)
    assert valid.first()["corridor"] == "DE-NL" and bad.count() == 1


def test_raw_generation_points(spark):
    rows = [("DE", 1, "f", 10.0, 0), ("DE", 1, "f", 10.0, 1), ("DE", 2, "f", -5.0, 2), ("DE", 3, "f", None, 3)]
    df = spark.createDataFrame(rows, "country_code string, position int, source_file string, quantity double, n int")
    valid, bad = silver.silver_generation_rows(df, "n")
    assert (valid.count(), bad.count()) == (1, 2)


def test_positions_and_missing_positions(spark):
    df = spark.createDataFrame([("f", 3, 0), ("f", None, 1)], "source_file string, position int, n int")
    got = silver.position_timestamps(df, F.lit("2024-01-01").cast("timestamp"), "n").orderBy("n").collect()
    assert [r["event_timestamp_utc"] for r in got] == [at(30), at(15)]
    assert got[0]["event_date"] == dt.date(2024, 1, 1)


def test_small_silver_helpers(spark):
    df = spark.createDataFrame([(2.5, "2024-01-01T00:00:00+02:00", "x"), (None, None, "2")], "q double, t string, s string")
    assert silver.scale_units(df, "q", 1000.0).first()["q"] == 2500.0
    assert [r["s"] for r in silver.scale_units(df, "s", 10.0).collect()] == ["x", "20.0"]
    late = silver.tag_late_arrivals(df, "t", F.lit("2024-01-01 00:00:00").cast("timestamp")).collect()
    assert [r["is_late_arrival"] for r in late] == [True, False]
    assert df.select(silver.to_utc("t").alias("u")).first()["u"] == dt.datetime(2023, 12, 31, 22)
    ok, bad = silver.split_required(df, ["q", "absent"])
    assert (ok.count(), bad.count()) == (0, 2)


def test_date_range_is_inclusive(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 1, 1), dt.date(2024, 1, 3)), ("b", dt.date(2024, 1, 2), dt.date(2024, 1, 1))],
                               "k string, s date, e date")
    assert silver.date_range(df, "s", "e").count() == 3


def test_spike_flags(spark):
    rows = [("NL", at(15 * i), v) for i, v in enumerate([50.0, 45.0, -5.0])]
    df = spark.createDataFrame(rows, "zone string, timestamp_utc timestamp, price_eur_mwh double")
    out = gold.price_spikes(df).collect()
    assert sum(r["negative_price_flag"] for r in out) == 1


def test_stability_and_market_summary(spark):
    gen = spark.createDataFrame(
        [("NL", at(0), "Solar", 10.0, True, 50.0), ("NL", at(1440), "Coal", 10.0, False, 0.0)],
        "zone string, timestamp_utc timestamp, psr_type string, generation_mw double, is_renewable boolean, "
        "renewable_share_pct double",
    )
    rows = gold.renewable_stability(gen).orderBy("event_date").collect()
    assert [r["renewable_share_pct"] for r in rows] == [100.0, 0.0]
    assert rows[0]["renewable_dip_flag"] is None and rows[1]["renewable_dip_flag"] is False
    prices = spark.createDataFrame(
        [("NL", at(60 * i), v) for i, v in enumerate([20.0, 80.0, -5.0])],
        "zone string, timestamp_utc timestamp, price_eur_mwh double",
    )
    load = spark.createDataFrame([("NL", at(0), 100.0, 5.0)],
                                 "zone string, timestamp_utc timestamp, actual_load_mw double, abs_forecast_error_mw double")
    row = gold.market_summary(prices, load, gen).first()
    assert (row["price_high"], row["price_low"], row["price_open"], row["price_close"]) == (80.0, -5.0, 20.0, -5.0)
    assert row["negative_price_count"] == 1 and row["total_load_mwh"] == 100.0
    assert row["price_avg"] == pytest.approx(31.6667, abs=1e-3)
    fact = gold.daily_market(gold.fact_prices(prices), gen, load).first()
    assert fact["negative_price_count"] == 1 and fact["total_renewable_mwh"] == 10.0


def test_generation_rows(spark):
    rows = [("DE", 10.0), ("DE", 20.0), ("NL", 5.0)]
    got = {r["country_code"]: r for r in gold.generation_stability_rows(
        spark.createDataFrame(rows, "country_code string, quantity double")).collect()}
    de = got["DE"]
    assert (de["event_date"], de["total_generation"], de["avg_generation"], de["volatility_index"], de["interval_count"]) == (
        "UNKNOWN_DATE", 30.0, 15.0, 10.0, 2.0)
    assert got["NL"]["volatility_index"] == 0.0


def test_corridors_join_once_and_reject_duplicates(spark):
    schema = "zone string, timestamp_utc timestamp, price_eur_mwh double"
    df = spark.createDataFrame([("NL", at(0), 50.0), ("DE", at(0), 53.0), ("FR", at(0), 60.0)], schema)
    got = {r["corridor"]: r for r in platinum.arbitrage(df).collect()}
    assert set(got) == {"NL-DE", "NL-FR"}
    assert got["NL-DE"]["spread_eur_mwh"] == 3.0 and not got["NL-DE"]["is_viable"]
    assert got["NL-FR"]["is_viable"] and got["NL-FR"]["arbitrage_potential_eur_mwh"] == 10.0
    spread = {r["corridor"]: r for r in gold.price_spreads(df).collect()}["NL-DE"]
    assert (spread["zone_high"], spread["zone_low"], spread["spread_pct"]) == ("DE", "NL", 6.0)
    plan = gold.price_spreads(df)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1
    with pytest.raises(Exception, match="unique"):
        gold.price_spreads(df.unionByName(df)).collect()


def test_load_ratio_import_bucket_and_flags(spark):
    df = spark.createDataFrame([(10000.0, 500.0), (0.0, 5.0)], "actual_load_mw double, abs_forecast_error_mw double")
    assert [r["load_error_ratio"] for r in features.load_features(df).collect()] == [0.05, None]
    ratios = spark.createDataFrame([(0.6,), (0.2,), (0.1,), (None,)], "import_dependency_ratio double")
    assert [r[0] for r in ratios.select(features.import_bucket()).collect()] == ["HIGH", "MEDIUM", "LOW", "UNKNOWN"]
    prices = spark.createDataFrame([(250.0,), (None,)], "price_eur_mwh double")
    assert [r[0] for r in prices.select(gold.price_spike_flag()).collect()] == [True, False]


def test_regime_labels(spark):
    df = spark.createDataFrame([(-5.0, 0.0), (250.0, 0.0), (50.0, 0.8), (50.0, 0.1)], "p double, s double")
    assert [r[0] for r in df.select(gold.regime_label(F.col("p"), F.col("s"))).collect()] == [
        "NEGATIVE", "SPIKE", "STRESS", "NORMAL"]


def test_stress_driver_what_if_and_recommendations(spark):
    row = spark.createDataFrame(
        [("NL", "2024-01-01", 10.0, 20.0, 100.0, 0)],
        "zone string, event_date string, renewable_share_pct double, price_volatility double, "
        "avg_forecast_error_mw double, price_spike_count int",
    )
    stress = gold.score_stress(row)
    got = stress.first()
    assert got["main_driver"] == "LOW_RENEWABLE_SHARE"
    assert got["stress_score"] == pytest.approx(round(0.2 * 0.2 + 0.25 * 50 / 60 + 0.15 * 0.1, 4))
    cases = {r["name"]: r for r in platinum.what_if(stress).collect()}
    assert len(cases) == 4 and cases["load_increase_10pct"]["stress_delta"] == 0.0
    assert cases["import_constraint_30pct"]["stress_delta"] == pytest.approx(0.03)
    recs = platinum.recommendations(stress).collect()
    assert [r["category"] for r in recs] == ["RENEWABLE_SHORTFALL"]


def test_carbon_premium(spark):
    summary = spark.createDataFrame([("A", dt.date(2024, 1, 1), 10.0), ("B", dt.date(2024, 1, 1), 10.0), ("C", dt.date(2024, 1, 1), 10.0)],
                                    "zone string, summary_date date, price_avg double")
    stability = spark.createDataFrame([("A", dt.date(2024, 1, 1), 100.0), ("B", dt.date(2024, 1, 1), 50.0)],
                                      "zone string, event_date date, renewable_share_pct double")
    got = {r["zone"]: r["carbon_premium_eur_mwh"] for r in platinum.carbon_adjusted_prices(summary, stability).collect()}
    assert got == {"A": 0.0, "B": 12.0, "C": 12.0}


def test_serving_summary(spark):
    gold_rows = spark.createDataFrame([("NL", 100.0, 20.0)], "country_code string, total_generation double, volatility_index double")
    carbon = spark.createDataFrame([("NL", 200.0)], "zone string, carbon_intensity_gco2_kwh double")
    weather = spark.createDataFrame([("NL", 8.0, 25.0)], "zone string, wind_speed_m_s double, solar_radiation_w_m2 double")
    fx = spark.createDataFrame([("2024-01-01", 1.07), ("2024-01-02", 1.08)], "timestamp string, fx_rate double")
    row = platinum.serving_summary(gold_rows, carbon, weather, fx).first()
    assert (row["stability_score"], row["carbon_efficiency_score"], row["fx_rate_to_eur"]) == (80.0, 0.5, 1.08)


def test_local_features_history_excludes_current_row(spark):
    n = 130
    prices = spark.createDataFrame([("NL", at(15 * i), float(i % 12)) for i in range(n)],
                                   "zone string, timestamp_utc timestamp, price_eur_mwh double")
    gen = spark.createDataFrame([("NL", at(15 * i), 100.0 + i) for i in range(0, n, 2)] + [("RO", at(0), 7.0)],
                                "zone string, timestamp_utc timestamp, generation_mw double")
    load = spark.createDataFrame([("NL", at(0), 1000.0, 980.0), ("RO", at(15), 5.0, None)],
                                 "zone string, timestamp_utc timestamp, actual_load_mw double, forecast_load_mw double")
    rows = features.local_features(prices, gen, load).orderBy("zone", "timestamp_utc").collect()
    nl = [r for r in rows if r["zone"] == "NL"]
    assert len(nl) == n and len(rows) == n + 2  # RO has no prices: generation and load anchor it
    import statistics
    for i in (0, 1, 2, 97, 129):
        history = [float(j % 12) for j in range(max(0, i - 96), i)]
        gens = [100.0 + j for j in range(0, i, 2)][-96:]
        assert nl[i]["price_24h_avg"] == pytest.approx(statistics.mean(history) if history else 0.0)
        assert nl[i]["price_24h_stddev"] == pytest.approx(statistics.pstdev(history) if len(history) > 1 else 0.0)
        assert nl[i]["generation_24h_avg"] == pytest.approx(statistics.mean(gens) if gens else 0.0)
    assert nl[0]["abs_forecast_error_mw"] == 20.0 and nl[1]["generation_mw"] == 0.0
