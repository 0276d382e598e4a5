"""Rules, contracts, operational tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from voltmart.operators import operations as ops, quality
from voltmart.schemas import WATERMARK_SCHEMA, Rule


def test_valid_plus_failed_is_input_and_null_fails(spark):
    df = spark.createDataFrame([(1.0,), (-1.0,), (None,)], "quantity double")
    ok, bad = quality.expect_non_negative(df, "quantity")
    assert (ok.count(), bad.count()) == (1, 2)
    rules = [Rule("non_neg", "quantity >= 0"), Rule("small", "quantity < 1", "WARNING")]
    valid, failed, results = quality.enforce(df, rules)
    assert valid.count() == 1 and failed.count() == 2
    got = {r["rule_name"]: r for r in results.collect()}
    assert got["non_neg"]["passed_rows"] == 1 and got["small"]["failed_rows"] == 2


def test_empty_input_has_pass_rate_one(spark):
    df = spark.createDataFrame([], "price_eur_mwh double, zone string, timestamp_utc timestamp")
    assert quality.rule_set_stats(df, "PRICE_RULES", "t", "r").first()["pass_rate"] == 1.0


def test_gate_and_unknown_rule_set(spark):
    rows = [("NL", 45.0, dt.datetime(2024, 1, 1)), ("XX", 50.0, dt.datetime(2024, 1, 1))]
    df = spark.createDataFrame(rows, "zone string, price_eur_mwh double, timestamp_utc timestamp")
    assert quality.tag_failures(df, "PRICE_RULES", True).filter("_failed_rule = 'zone_valid'").count() == 1
    with pytest.raises(quality.QualityGateError):
        quality.validate(df, "PRICE_RULES", "silver_prices", "r")
    clean, _ = quality.validate(df, "PRICE_RULES", "silver_prices", "r", critical=0.5)
    assert clean.count() == 1
    with pytest.raises(ValueError):
        quality.evaluate(df, "NO_RULES")


def test_contracts(spark):
    df = spark.createDataFrame([(None, "30.0", 0), ("NL", None, 1)], "country_code string, total_generation string, n int")
    assert "avg_generation" in quality.missing_columns(df, "renewable_stability_rows")
    with pytest.raises(quality.ContractError):
        quality.require_columns(df, "renewable_stability_rows")
    got = {(r["field_name"], r["problem"]): r["row_count"]
           for r in quality.contract_violations(df, "renewable_stability_rows", "n").collect()}
    assert got == {("country_code", "null"): 1, ("total_generation", "type"): 1}
    loose = quality.contract_violations(df, "renewable_stability_rows", "n", strict=False)
    assert [r["field_name"] for r in loose.collect()] == ["country_code"]
    keyed = spark.createDataFrame([(None, None, "b")], "zone string, timestamp_utc timestamp, _batch_id string")
    assert {r["key_column"]: r["null_rows"] for r in quality.key_violations(keyed, "bronze_prices").collect()} == {
        "zone": 1, "timestamp_utc": 1, "_batch_id": 0}


def test_incidents(spark):
    rows = [(300, 0, 0.0, False), (10, 0, 0.0, True), (5, 0, 0.0, False), (None, 10000, None, None)]
    df = spark.createDataFrame(
        rows, "duration_minutes int, affected_clients_est int, impacted_value_eur double, is_cross_border boolean"
    )
    assert [r["severity"] for r in ops.classify_incidents(df).collect()] == ["MAJOR", "SIGNIFICANT", "MINOR", "MAJOR"]


def test_pii_names(spark):
    df = spark.createDataFrame([("t", c) for c in ("customer_name", "meter_id", "billing_email", "zone")],
                               "table_name string, column_name string")
    assert [r["column_name"] for r in ops.pii_columns(df).collect()] == ["customer_name", "billing_email"]


def test_backfill_gaps(spark):
    entities = spark.createDataFrame([("NL",), ("DE",), ("FR",)], "entity string")
    marks = spark.createDataFrame([("prices", "NL", "2024-01-01"), ("prices", "DE", "2024-01-10"), ("prices", "FR", "?")],
                                  "dataset string, entity string, watermark string")
    got = {r["entity"]: r for r in ops.backfill_gaps(entities, marks, ["prices"], "2024-01-10", "2024-01-05").collect()}
    assert set(got) == {"NL", "FR"}
    assert (got["NL"]["start_date"], got["NL"]["end_date"]) == (dt.date(2024, 1, 2), dt.date(2024, 1, 10))
    assert got["FR"]["start_date"] == dt.date(2024, 1, 6)


def test_watermarks_keep_progress_on_failure(spark, tmp_path):
    path = str(tmp_path / "marks")
    stamp = dt.datetime(2024, 1, 1)
    done = spark.createDataFrame([("prices", "NL", "2024-01-01", 5, stamp)],
                                 "dataset string, entity string, watermark string, rows long, updated_at timestamp")
    ops.mark_success(done, path)
    failed = spark.createDataFrame([("prices", "NL", "boom", dt.datetime(2024, 1, 2))],
                                   "dataset string, entity string, last_error string, updated_at timestamp")
    ops.mark_failed(failed, spark.read.schema(WATERMARK_SCHEMA).parquet(path), path)
    row = spark.read.parquet(path).collect()
    assert len(row) == 1 and row[0]["status"] == "FAILED" and row[0]["watermark"] == "2024-01-01"


def test_freshness_without_runs(spark):
    runs = spark.createDataFrame([], "run_id string, pipeline_name string, finished_at timestamp")
    rows = ops.contract_freshness(runs, F.lit("2024-01-01").cast("timestamp")).collect()
    assert len(rows) == 8 and {(r["age_minutes"], r["status"]) for r in rows} == {(-1, "STALE")}


def test_corridor_counts(spark):
    df = spark.createDataFrame([("RO", "HU"), ("RO", "HU"), (None, "HU")], "zone_from string, zone_to string")
    assert [tuple(r) for r in ops.corridor_counts(df).collect()] == [("RO->HU", 2)]
