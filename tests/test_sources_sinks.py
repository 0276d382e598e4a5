"""Payload parsing and table writers."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from voltmart.plans import inputs
from voltmart.sinks import tables as sinks
from voltmart.sources import payloads, series, tables
from voltmart.streaming import streams

XML = """<?xml version="1.0" encoding="UTF-8"?>
<GL_MarketDocument xmlns="urn:iec62325.351:tc57wg16:451-6:generationloaddocument:3:0">
  <TimeSeries><mRID>1</mRID><MktPSRType><psrType>B16</psrType></MktPSRType>
    <Period><timeInterval><start>2024-01-01T00:00Z</start><end>2024-01-01T01:00Z</end></timeInterval>
      <resolution>PT15M</resolution>
      <Point><position>1</position><quantity>10.0</quantity></Point>
      <Point><position>2</position><quantity>20.0</quantity></Point>
      <Point><position>3</position></Point>
    </Period></TimeSeries>
  <TimeSeries><mRID>2</mRID><Period><Point><position>1</position><price.amount>85.0</price.amount></Point></Period></TimeSeries>
</GL_MarketDocument>"""


def test_xml_points(spark, tmp_path):
    (tmp_path / "a.xml").write_text(XML)
    rows = payloads.generation_points(spark, str(tmp_path), "DE").orderBy("series_id", "position").collect()
    assert [(r["position"], r["quantity"]) for r in rows] == [(1, 10.0), (2, 20.0), (3, None), (1, None)]
    assert rows[0]["period_start"] == dt.datetime(2024, 1, 1) and rows[0]["source_file"].endswith("a.xml")
    prices = payloads.price_points(spark, str(tmp_path), "DE").filter("series_id = '2'").collect()
    assert [(r["position"], r["price_eur_mwh"], r["dataset_name"]) for r in prices] == [(1, 85.0, "prices")]


def test_weather_short_arrays(spark, tmp_path):
    (tmp_path / "w.json").write_text(
        '{"zone": "NL", "hourly": {"time": ["t0", "t1"], "temperature_2m": [1.0, 2.0], "wind_speed_10m": [3.0],\n'
        ' "shortwave_radiation": [0.0, 10.0]}}'
    )
    rows = payloads.weather_rows(payloads.read_payloads(spark, str(tmp_path), payloads.WEATHER_SCHEMA)).collect()
    assert [(r["timestamp"], r["wind_speed_m_s"], r["solar_radiation_w_m2"]) for r in rows] == [("t0", 3.0, 0.0), ("t1", None, 10.0)]


def test_carbon_and_fx(spark, tmp_path):
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "c.json").write_text(
        '{"zone": "GB", "data": [{"from": "a", "to": "b", "intensity": {"actual": 123, "index": "moderate"}}]}'
    )
    row = payloads.carbon_rows(payloads.read_payloads(spark, str(tmp_path / "c"), payloads.CARBON_SCHEMA)).first()
    assert (row["carbon_intensity_gco2_kwh"], row["carbon_index"]) == (123.0, "moderate")
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "f.json").write_text(
        '{"dataSets": [{"series": {"0:0:0:0:0": {"observations": {"0": [1.08], "1": [1.09], "2": [1.1]}}}}],'
        ' "structure": {"dimensions": {"observation": [{"values": [{"id": "2024-01-01"}, {"id": "2024-01-02"}]}]}}}'
    )
    rows = payloads.fx_rows(payloads.read_payloads(spark, str(tmp_path / "f"), payloads.FX_SCHEMA), "EUR", "USD")
    assert [(r["timestamp"], r["fx_rate"]) for r in rows.orderBy("fx_rate").collect()] == [
        ("2024-01-01", 1.08), ("2024-01-02", 1.09), ("2", 1.1)]


def test_wide_to_long_flattens_headers(spark):
    df = spark.createDataFrame([("NL", 1, 5.0, None, float("nan"), 7.0)],
                               "zone string, timestamp_utc int, `Solar|Actual Aggregated` double, x double, "
                               "Nuclear double, `Solar|Actual Consumption` double")
    got = {r["psr_type"]: (r["generation_mw"], r["is_renewable"]) for r in series.generation_long(df).collect()}
    assert got == {"Solar": (5.0, True), "Solar_Actual Consumption": (7.0, False)}


def test_load_outer_join_and_resolution(spark):
    t = [dt.datetime(2024, 1, 1, 0, m) for m in (0, 15, 30)]
    actual = spark.createDataFrame([("NL", t[0], 10.0), ("NL", t[1], 11.0)], "zone string, timestamp_utc timestamp, actual_load_mw double")
    forecast = spark.createDataFrame([("NL", t[1], 10.554), ("NL", t[2], 1.0)], "zone string, timestamp_utc timestamp, forecast_load_mw double")
    got = series.load_series(actual, forecast).orderBy("timestamp_utc").collect()
    assert [r["forecast_error_mw"] for r in got] == [None, 0.45, None]
    one = spark.createDataFrame([("RO", t[0])], "zone string, timestamp_utc timestamp")
    res = series.resolution_minutes(actual.select("zone", "timestamp_utc").unionByName(one)).collect()
    assert {r["zone"]: r["resolution_minutes"] for r in res} == {"NL": 15, "RO": 60}


def test_request_window_follows_daylight_saving(spark):
    lo, hi = series.request_window(F.lit("2024-03-31"), F.lit("2024-03-31"))
    row = spark.range(1).select(lo.alias("lo"), hi.alias("hi")).first()
    assert (row["lo"], row["hi"]) == (dt.datetime(2024, 3, 30, 23), dt.datetime(2024, 3, 31, 22))


def test_unknown_zone_is_an_error(spark):
    df = spark.createDataFrame([("NL",), ("XX",)], "zone string")
    assert df.limit(1).select(series.zone_eic()).first()[0] == "10YNL----------L"
    with pytest.raises(Exception, match="unknown zone"):
        df.select(series.zone_eic()).collect()


def test_missing_records_are_empty(spark, tmp_path):
    assert tables.read_records(spark, str(tmp_path / "none"), "a int").count() == 0


ROWS = "zone string, event_date date, id long, v double, _ingest_ts long"


def day(n):
    return dt.date(2024, 1, n)


def test_upsert_is_idempotent_and_keeps_newer_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("NL", day(1), 1, 1.0, 5), ("NL", day(2), 2, 2.0, 5)], ROWS)
    second = spark.createDataFrame([("NL", day(1), 1, 9.0, 4), ("NL", day(2), 2, 8.0, 6), ("NL", day(3), 3, 3.0, 1), ("NL", day(3), 3, 4.0, 2)], ROWS)
    for batch in (first, second, second):
        sinks.upsert(batch, path, ["id"], "_ingest_ts", ["event_date"])
        untouched = spark.read.parquet(path).filter("event_date = '2024-01-01'").count()
        assert untouched == 1
    got = {r["id"]: r["v"] for r in spark.read.parquet(path).collect()}
    assert got == {1: 1.0, 2: 8.0, 3: 4.0}


def test_replace_window(spark, tmp_path):
    path = str(tmp_path / "w")
    sinks.append(spark.createDataFrame([("NL", day(n), n, 1.0, 0) for n in (1, 2, 3)], ROWS), path, ["event_date"])
    sinks.replace_window(spark.createDataFrame([("NL", day(n), n, 2.0, 0) for n in (1, 3)], ROWS), path, "event_date", "2024-01-02")
    assert sorted((r["id"], r["v"]) for r in spark.read.parquet(path).collect()) == [(1, 1.0), (3, 2.0)]


def test_rewrite_without_drops_rows_and_empty_partitions(spark, tmp_path):
    path = str(tmp_path / "e")
    rows = [("NL", day(1), 1, 1.0, 0), ("NL", day(2), 2, 1.0, 0), ("DE", day(2), 3, 1.0, 0), (None, day(2), 4, 1.0, 0)]
    sinks.append(spark.createDataFrame(rows, ROWS), path, ["event_date"])
    ids = spark.createDataFrame([("NL",)], "entity_id string")
    for _ in range(2):
        sinks.rewrite_without(spark, path, ["zone"], ids, ["event_date"])
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [3, 4]
    assert not (tmp_path / "e" / "event_date=2024-01-01").exists()


def test_quarantine_is_a_no_op_when_empty(spark, tmp_path):
    path = str(tmp_path / "q")
    empty = spark.createDataFrame([], ROWS)
    assert not sinks.append_quarantine(empty, path, "r") and not (tmp_path / "q").exists()


def test_flow_slice_needs_both_ends_configured(spark):
    df = spark.createDataFrame([("RO", "HU"), ("NL", "DE"), ("NL", "RO")], "zone_from string, zone_to string")
    assert [tuple(r) for r in tables.configured(df).collect()] == [("NL", "DE")]


def test_late_rows_read_one_mark_however_many_batches(spark, tmp_path):
    """A newest event in the first batch counts for all later ones, and only two marks are kept."""
    paths = {n: str(tmp_path / n) for n in ("landing", "ok", "late", "marks", "cp")}
    start = dt.datetime(2024, 1, 10)
    hours = [[0, 48], [1, 47], [], [None, 30], [100, 23], [53, 51]]
    newest, want = None, {}
    for number, batch in enumerate(hours):
        rows = [(10 * number + i, None if h is None else start + dt.timedelta(hours=h)) for i, h in enumerate(batch)]
        for (row, _), h in zip(rows, batch):
            want[row] = h is not None and newest is not None and h < newest - 24
        newest = max([h for h in batch if h is not None] + ([] if newest is None else [newest]))
        landed = spark.createDataFrame(rows, "id int, ts timestamp")
        landed.coalesce(1).write.mode("append").json(paths["landing"])
        streams.start_with_late_rows(
            streams.read_landing(spark, paths["landing"], "id int, ts timestamp"), "ts", 86400, paths["ok"], paths["late"],
            paths["marks"], paths["cp"],
        ).awaitTermination()
    read = lambda name: {r.id for r in spark.read.schema("id int").parquet(paths[name]).collect()}
    assert read("late") == {k for k, v in want.items() if v} and read("ok") == {k for k, v in want.items() if not v}
    assert len([p for p in (tmp_path / "marks").iterdir() if p.name.startswith("batch=")]) == 2


def reading_tables(spark, path, n, files=8):
    """Line items, suppliers and parts of ``n`` generation readings, every 89th without a value."""
    spark.range(0, n, 1, files).selectExpr(
        "id AS l_orderkey", "id % 7 AS l_partkey", "id % 5 AS l_suppkey", "1 AS l_linenumber",
        "CAST(id % 50 AS DOUBLE) AS l_quantity", "TIMESTAMP_NTZ'1996-01-01' + make_dt_interval(id % 30) AS l_shipdate",
    ).write.parquet(f"{path}/lineitem.parquet")
    spark.range(5).selectExpr("id AS s_suppkey", "CAST(id AS INT) AS s_nationkey").write.parquet(f"{path}/supplier.parquet")
    spark.range(7).selectExpr("id AS p_partkey", "'LARGE' AS p_type").write.parquet(f"{path}/part.parquet")
    return str(path)


def landed_bytes(path):
    return sum(f.stat().st_size for f in Path(path.removeprefix("file:")).rglob("part-*"))


def test_landed_xml_is_compressed_in_documents_of_bounded_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(inputs, "DOCUMENT_SERIES", 100, raising=False)
    landed = inputs._land_series_xml(spark, reading_tables(spark, tmp_path, 2000))
    assert landed_bytes(landed) < 100 * 2000  # plain XML takes some 500 bytes a reading
    rows = payloads.generation_points(spark, landed, "NL").collect()
    got = {r["series_id"]: r["quantity"] for r in rows}
    want = {f"{(k * 10 + 1) * 64 + k % 50}" + f"-{float(k % 50)}" * bool(k % 89): float(k % 50) if k % 89 else None for k in range(2000)}
    assert got == want and len(rows) == 2000
    documents = [r["source_file"] for r in rows]
    assert max(documents.count(d) for d in set(documents)) <= 100


def test_no_readings_land_no_series(spark, tmp_path):
    landed = inputs._land_series_xml(spark, reading_tables(spark, tmp_path, 0))
    assert payloads.generation_points(spark, landed, "NL").count() == 0


def test_readings_of_many_splits_are_landed_where_they_are(spark, tmp_path):
    sf, cores = reading_tables(spark, tmp_path, 2000, 40), spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        landed = inputs._land_series_xml(spark, sf)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert landed_bytes(landed) < 100 * 2000
    rows = payloads.price_points(spark, landed, "NL").collect()
    assert len({r["source_file"] for r in rows}) == 40 > cores
    want = [(k * 10 + 1) * 64 + k % 50 for k in range(2000)]
    got = {int(r["series_id"].split("-")[0]): r["price_eur_mwh"] for r in rows}
    assert len(rows) == 2000 and got == {i: (k % 50 * 2.0 - 5 if k % 89 else None) for k, i in enumerate(want)}
