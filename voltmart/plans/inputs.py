"""Queries over sources and sinks. Landed files are written from the tables first, so they grow with them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from voltmart.operators import ranges
from voltmart.plans import market_views as views
from voltmart.plans.core import latest_prices, silver_flows, silver_prices, stability
from voltmart.plans.registry import CTES, ORACLES, oracle, query, r, rounded
from voltmart.session import scratch_path
from voltmart.sinks import tables as sinks
from voltmart.sources import payloads, series, tables

# ---------------------------------------------------------------------------
# Payload sources
# ---------------------------------------------------------------------------


# Time series in one landed document: some 70 MB of XML, 4 MB compressed.
DOCUMENT_SERIES = 250_000


def _land_series_xml(spark: SparkSession, sf: str) -> str:
    """Every generation reading as a one-point time series, in gzipped XML documents of ``DOCUMENT_SERIES`` at most.

    Plain XML takes some 500 bytes a reading, thirty times its table. A document is read by one task. Readings of few splits are
    dealt to all cores; others are written where they are, as an exchange keeps one more copy of them on disk.
    """
    rows, cores = views.generation(spark, sf), spark.sparkContext.defaultParallelism
    if views.table(spark, sf, "lineitem").rdd.getNumPartitions() < 2 * cores:
        rows = rows.repartition(cores)
    rows = rows.withColumn(
        "position", (F.hour("timestamp_utc") * 4 + F.floor(F.minute("timestamp_utc") / 15) + 1).cast("int")
    )
    point = F.struct(
        "position", F.col("generation_mw").alias("quantity"),
        (F.col("generation_mw") * 2 - 5).alias("price.amount"),
    )
    period = F.struct(
        F.struct(F.date_format("timestamp_utc", "yyyy-MM-dd'T'00:00'Z'").alias("start")).alias("timeInterval"),
        F.lit("PT15M").alias("resolution"),
        F.array(point).alias("Point"),
    )
    path = scratch_path(spark, "xml")
    rows.select(
        F.concat_ws("-", F.col("_ingest_ts").cast("string"), "generation_mw").alias("mRID"),
        F.struct(F.col("psr_type").alias("psrType")).alias("MktPSRType"),
        F.array(period).alias("Period"),
    ).write.format("xml").option("rootTag", "MarketDocument").option("rowTag", "TimeSeries").option("indent", "").option(
        "compression", "gzip"
    ).option("maxRecordsPerFile", DOCUMENT_SERIES).save(path)
    return path


CTES["xml_points"] = """SELECT concat_ws('-', CAST(_ingest_ts AS VARCHAR), CAST(generation_mw AS VARCHAR)) AS series_id,
    psr_type AS psr_code, 'NL' AS country_code, CAST(timestamp_utc AS DATE) + INTERVAL 0 DAY AS period_start,
    CAST(hour(timestamp_utc) * 4 + minute(timestamp_utc) // 15 + 1 AS INTEGER) AS position, generation_mw,
    'PT15M' AS resolution FROM generation"""
_XML = "series_id, psr_code, country_code, CAST(period_start AS TIMESTAMP) AS period_start, position, resolution"


@query(oracle(f"SELECT {_XML}, generation_mw AS quantity, 'generation' AS dataset_name FROM xml_points"))
def generation_xml_scan(spark, sf):
    return payloads.generation_points(spark, _land_series_xml(spark, sf), "NL").drop("source_file")


@query(oracle(f"SELECT {_XML}, generation_mw * 2 - 5 AS price_eur_mwh, 'prices' AS dataset_name FROM xml_points"))
def price_xml_scan(spark, sf):
    return payloads.price_points(spark, _land_series_xml(spark, sf), "NL").drop("source_file")


def _items_by_order(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with their order's zone; an order has a handful of items, so arrays per order stay short."""
    return views.table(spark, sf, "lineitem").withColumn("zone", views.zone_of(F.col("l_orderkey")))


def _land_json(spark: SparkSession, df: DataFrame) -> str:
    path = scratch_path(spark, "json")
    df.write.json(path)
    return path


CTES["weather_items"] = """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity, l_extendedprice) AS i,
    count(*) OVER (PARTITION BY l_orderkey) AS n, array_extract(['NL', 'DE', 'DK-1', 'DK-2', 'FR', 'BE', 'RO'],
    l_orderkey % 7 + 1) AS zone FROM lineitem"""


@query(oracle("""SELECT zone, l_orderkey || ':' || i AS timestamp, l_quantity AS temperature_c,
    l_extendedprice AS wind_speed_m_s, CASE WHEN i < n OR n = 1 THEN l_discount END AS solar_radiation_w_m2
    FROM weather_items"""))
def weather_json_rows(spark, sf):
    items = F.sort_array(F.collect_list(F.struct("l_linenumber", "l_quantity", "l_extendedprice", "l_discount")))
    docs = _items_by_order(spark, sf).groupBy("l_orderkey", "zone").agg(items.alias("i"))
    count = F.size("i")
    hourly = F.struct(
        F.transform("i", lambda x, k: F.concat(F.col("l_orderkey").cast("string"), F.lit(":"), (k + 1).cast("string")))
        .alias("time"),
        F.col("i.l_quantity").alias("temperature_2m"),
        F.col("i.l_extendedprice").alias("wind_speed_10m"),
        # the last array is one short, except for single-item orders
        F.slice("i.l_discount", F.lit(1), F.greatest(count - 1, F.lit(1))).alias("shortwave_radiation"),
    )
    path = _land_json(spark, docs.select("zone", hourly.alias("hourly")))
    return payloads.weather_rows(payloads.read_payloads(spark, path, payloads.WEATHER_SCHEMA, multi_line=False))


@query("""SELECT array_extract(['NL', 'DE', 'DK-1', 'DK-2', 'FR', 'BE', 'RO'], l_orderkey % 7 + 1) AS zone,
    strftime(l_shipdate, '%Y-%m-%d') AS from_timestamp, strftime(l_shipdate + INTERVAL 1 DAY, '%Y-%m-%d') AS to_timestamp,
    l_quantity AS carbon_intensity_gco2_kwh, l_returnflag AS carbon_index FROM lineitem""")
def carbon_json_rows(spark, sf):
    item = F.struct(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("from"),
        F.date_format(F.date_add("l_shipdate", 1), "yyyy-MM-dd").alias("to"),
        F.struct(F.col("l_quantity").alias("actual"), F.col("l_returnflag").alias("index")).alias("intensity"),
    )
    docs = _items_by_order(spark, sf).groupBy("l_orderkey", "zone").agg(F.collect_list(item).alias("data"))
    path = _land_json(spark, docs.select("zone", "data"))
    return payloads.carbon_rows(payloads.read_payloads(spark, path, payloads.CARBON_SCHEMA, multi_line=False))


@query(oracle(f"""SELECT 'EUR' AS base_currency, 'USD' AS quote_currency, {r('1 + l_quantity / 100', 6, 'fx_rate')},
    CASE WHEN i < n OR n = 1 THEN l_orderkey || '/' || (i - 1) ELSE CAST(i - 1 AS VARCHAR) END AS timestamp
    FROM weather_items"""))
def fx_json_rows(spark, sf):
    items = F.sort_array(F.collect_list(F.struct("l_linenumber", "l_quantity", "l_extendedprice", "l_discount")))
    docs = _items_by_order(spark, sf).groupBy("l_orderkey").agg(items.alias("i"))
    observations = F.map_from_entries(
        F.transform("i", lambda x, k: F.struct(k.cast("string"), F.array(1 + x["l_quantity"] / 100)))
    )
    dates = F.transform(
        "i", lambda x, k: F.struct(F.concat(F.col("l_orderkey").cast("string"), F.lit("/"), k.cast("string")).alias("id"))
    )
    short = F.slice(dates, F.lit(1), F.greatest(F.size("i") - 1, F.lit(1)))
    docs = docs.select(
        F.array(F.struct(F.create_map(F.lit(payloads.FX_SERIES), F.struct(observations.alias("observations")))
                         .alias("series"))).alias("dataSets"),
        F.struct(F.struct(F.array(F.struct(short.alias("values"))).alias("observation")).alias("dimensions"))
        .alias("structure"),
    )
    path = _land_json(spark, docs)
    rows = payloads.fx_rows(
        payloads.read_payloads(spark, path, payloads.FX_SCHEMA, multi_line=False), "EUR", "USD"
    )
    return rounded(rows, "fx_rate")


# ---------------------------------------------------------------------------
# Series shaping
# ---------------------------------------------------------------------------


@query(oracle("""SELECT zone, timestamp_utc, psr_type, sum(generation_mw) AS generation_mw,
    psr_type IN ('Solar', 'Wind Onshore', 'Biomass') AS is_renewable FROM generation
    WHERE generation_mw IS NOT NULL GROUP BY ALL"""))
def generation_wide_to_long(spark, sf):
    types = ["Solar", "Wind Onshore", "Biomass", "Fossil Gas", "Nuclear", "Fossil Hard coal"]
    wide = views.generation(spark, sf).groupBy("zone", "timestamp_utc").pivot("psr_type", types).agg(
        F.sum("generation_mw")
    )
    header = {"Solar": "Solar|Actual Aggregated"}
    return series.generation_long(wide.withColumnsRenamed(header))


CTES["resolution"] = """SELECT zone, CAST(CASE WHEN count(*) > 1
    THEN (epoch(max(timestamp_utc)) - epoch(min(timestamp_utc))) / 60 ELSE 60 END AS INTEGER) AS resolution_minutes FROM (
    SELECT zone, timestamp_utc, row_number() OVER (PARTITION BY zone ORDER BY timestamp_utc) AS rn
    FROM (SELECT DISTINCT zone, timestamp_utc FROM prices)) WHERE rn <= 2 GROUP BY zone"""


@query(oracle("SELECT * FROM resolution"))
def resolution_inference(spark, sf):
    return series.resolution_minutes(views.prices(spark, sf))


@query(oracle("""SELECT zone, price_eur_mwh, _ingest_ts, timestamp_utc - INTERVAL 1 HOUR AS timestamp_utc,
    resolution_minutes FROM latest_prices JOIN (SELECT zone, CAST((epoch(max(timestamp_utc)) - epoch(min(timestamp_utc)))
    / 60 AS INTEGER) AS resolution_minutes FROM (SELECT zone, timestamp_utc, row_number() OVER (PARTITION BY zone
    ORDER BY timestamp_utc) AS rn FROM latest_prices) WHERE rn <= 2 GROUP BY zone) USING (zone)"""))
def price_series_rows(spark, sf):
    local = latest_prices(spark, sf).withColumnRenamed("timestamp_utc", "timestamp_local")
    return series.price_series(local)


@query(oracle(f"""SELECT zone, timestamp_utc, {r('actual_load_mw')}, {r('forecast_load_mw')},
    round(actual_load_mw - forecast_load_mw, 2) AS forecast_error_mw FROM
    (SELECT zone, timestamp_utc, actual_load_mw FROM s_load WHERE actual_load_mw IS NOT NULL) FULL JOIN
    (SELECT zone, timestamp_utc, forecast_load_mw FROM s_load WHERE forecast_load_mw IS NOT NULL)
    USING (zone, timestamp_utc)"""))
def load_outer_join(spark, sf):
    from voltmart.plans.core import latest_load

    rows = latest_load(spark, sf)
    actual = rows.filter("actual_load_mw IS NOT NULL").select("zone", "timestamp_utc", "actual_load_mw")
    forecast = rows.filter("forecast_load_mw IS NOT NULL").select("zone", "timestamp_utc", "forecast_load_mw")
    return rounded(series.load_series(actual, forecast), "actual_load_mw", "forecast_load_mw")


@query(oracle("""SELECT zone_from, zone_to, timestamp_utc, flow_mw, _ingest_ts, zone_from || '_TO_' || zone_to AS direction
              FROM s_flows"""))
def flow_series_rows(spark, sf):
    return series.flow_series(views.flows(spark, sf))


_EIC_SQL = "CASE zone " + " ".join(f"WHEN '{z}' THEN '{e}'" for z, e in tables.ZONE_EIC.items()) + " END"


@query(oracle(f"SELECT _ingest_ts, {_EIC_SQL} AS eic FROM prices"))
def zone_eic_lookup(spark, sf):
    return views.prices(spark, sf).select("_ingest_ts", series.zone_eic().alias("eic"))


@query(oracle("""SELECT zone, timestamp_utc, _ingest_ts, price_eur_mwh FROM prices
    WHERE timestamp_utc >= TIMESTAMP '2024-01-09 23:00:00' AND timestamp_utc < TIMESTAMP '2024-01-12 23:00:00'"""))
def request_window(spark, sf):
    return series.in_request_window(views.prices(spark, sf), "2024-01-10", "2024-01-12")


# ---------------------------------------------------------------------------
# Incremental Bronze
# ---------------------------------------------------------------------------
CTES["marks"] = """SELECT 'prices' AS dataset, zone AS entity, strftime(min(timestamp_utc) +
    to_days(CAST(min(_ingest_ts) % 7 AS INTEGER)), '%Y-%m-%d') AS watermark FROM prices WHERE zone <> 'BE' GROUP BY zone
    UNION ALL SELECT 'flows', zone_from || '>' || zone_to, '2024-01-20' FROM flows GROUP BY zone_from, zone_to"""


def watermarks(spark: SparkSession, sf: str) -> DataFrame:
    first = F.to_date(F.min("timestamp_utc"))
    by_zone = views.prices(spark, sf).filter("zone <> 'BE'").groupBy("zone").agg(
        F.date_add(first, (F.min("_ingest_ts") % 7).cast("int")).cast("string").alias("watermark")
    )
    by_pair = views.flows(spark, sf).select(F.concat_ws(">", "zone_from", "zone_to").alias("entity")).distinct()
    return by_zone.select(F.lit("prices").alias("dataset"), F.col("zone").alias("entity"), "watermark").unionByName(
        by_pair.select(F.lit("flows").alias("dataset"), "entity", F.lit("2024-01-20").alias("watermark"))
    )


@query(oracle("""SELECT p.zone, timestamp_utc, price_eur_mwh, _ingest_ts AS event_id, 'b-1' AS _batch_id, 'landing' AS _source
    FROM prices p LEFT JOIN marks m ON dataset = 'prices' AND entity = zone
    WHERE timestamp_utc < DATE '2024-01-26' AND timestamp_utc >= coalesce(CAST(watermark AS DATE), DATE '2024-01-04')
    + INTERVAL 1 DAY"""))
def bronze_prices_batch(spark, sf):
    landed = views.prices(spark, sf).withColumnRenamed("_ingest_ts", "event_id")
    return tables.bronze_batch(
        landed, watermarks(spark, sf), "prices", "b-1", "landing", "2024-01-25", "2024-01-04"
    ).drop("_ingest_ts")


@query(oracle("""SELECT f.zone_from, f.zone_to, timestamp_utc, flow_mw, _ingest_ts AS row_id, 'b-2' AS _batch_id,
    'landing' AS _source FROM flows f JOIN marks m ON dataset = 'flows' AND entity = zone_from || '>' || zone_to
    WHERE zone_from || '>' || zone_to IN ('NL>DE','DE>NL','DE>DK-1','DK-1>DE','DK-1>DK-2','DK-2>DK-1','NL>FR','FR>NL',
    'BE>NL','NL>BE','BE>DE','DE>BE','FR>BE','BE>FR') AND timestamp_utc < DATE '2024-01-26'
    AND timestamp_utc >= DATE '2024-01-21'"""))
def bronze_flows_batch(spark, sf):
    landed = views.flows(spark, sf).withColumnRenamed("_ingest_ts", "row_id")
    return tables.bronze_batch(
        landed, watermarks(spark, sf), "flows", "b-2", "landing", "2024-01-25", "2024-01-04"
    ).drop("_ingest_ts")


@query(oracle("""SELECT zone, timestamp_utc, psr_type, generation_mw, is_renewable, _ingest_ts AS row_id, 'b-3' AS _batch_id,
    'landing' AS _source FROM generation WHERE timestamp_utc >= DATE '2024-01-05' AND timestamp_utc < DATE '2024-01-26'"""))
def bronze_generation_batch(spark, sf):
    landed = views.generation(spark, sf).withColumnRenamed("_ingest_ts", "row_id")
    return tables.bronze_batch(
        landed, watermarks(spark, sf), "generation", "b-3", "landing", "2024-01-25", "2024-01-04"
    ).drop("_ingest_ts")


@query(oracle(f"""SELECT zone, timestamp_utc, {r('actual_load_mw')}, {r('forecast_load_mw')}, _ingest_ts AS row_id,
    'b-4' AS _batch_id, 'landing' AS _source FROM load
    WHERE timestamp_utc >= DATE '2024-01-05' AND timestamp_utc < DATE '2024-01-26'"""))
def bronze_load_batch(spark, sf):
    landed = views.load(spark, sf).withColumnRenamed("_ingest_ts", "row_id")
    batch = tables.bronze_batch(
        landed, watermarks(spark, sf), "load", "b-4", "landing", "2024-01-25", "2024-01-04"
    )
    return rounded(batch, "actual_load_mw", "forecast_load_mw").drop("_ingest_ts")


# ---------------------------------------------------------------------------
# Loaded ranges: holes and corrections instead of one watermark
# ---------------------------------------------------------------------------
CTES["price_days"] = """SELECT zone, CAST(timestamp_utc AS DATE) AS day, count(*) AS n, min(_ingest_ts) AS first_id
    FROM prices GROUP BY ALL"""
CTES["load_records"] = """SELECT zone AS entity, day AS start_date, day + CAST(n % 3 AS INTEGER) AS end_date, false AS stale,
    TIMESTAMP '2024-02-01 00:00:00' AS seen FROM price_days WHERE n % 4 <> 0
    UNION ALL SELECT zone, day, day, true, TIMESTAMP '2024-02-02 00:00:00' FROM price_days WHERE first_id % 5 = 0"""
CTES["loaded_days"] = """SELECT entity, day FROM (SELECT entity, stale, seen,
    CAST(unnest(generate_series(start_date, end_date, INTERVAL 1 DAY)) AS DATE) AS day FROM load_records)
    GROUP BY entity, day HAVING NOT arg_max(stale, seen)"""


def _load_records(spark: SparkSession, sf: str) -> DataFrame:
    """Loads that reach up to two days further and leave holes; later, some days are corrected at the source."""
    days = views.prices(spark, sf).groupBy(F.lit("prices").alias("dataset"), "zone", F.to_date("timestamp_utc").alias("day")).agg(
        F.count("*").alias("n"), F.min("_ingest_ts").alias("first_id")
    ).withColumnRenamed("zone", "entity")
    loads = days.filter("n % 4 <> 0").select(
        *ranges.KEYS, F.col("day").alias("start_date"), F.date_add("day", (F.col("n") % 3).cast("int")).alias("end_date"),
        F.lit(ranges.LOADED).alias("status"), F.lit("2024-02-01 00:00:00").cast("timestamp").alias("recorded_at"),
    )
    changes = days.filter("first_id % 5 = 0").select(
        *ranges.KEYS, "day", F.lit("2024-02-02 00:00:00").cast("timestamp").alias("changed_at")
    )
    path = scratch_path(spark, "ranges")
    ranges.record(loads, path)
    ranges.record(ranges.corrections(changes, ranges.read_ranges(spark, path)), path)
    return ranges.read_ranges(spark, path)


_RUNS = """SELECT 'prices' AS dataset, entity, min(day) AS start_date, max(day) AS end_date, count(*) AS days FROM (
    SELECT entity, day, day - CAST(row_number() OVER (PARTITION BY entity ORDER BY day) AS INTEGER) AS run FROM ({})
    ) GROUP BY entity, run"""


@query(oracle(_RUNS.format("SELECT entity, day FROM loaded_days")))
def loaded_ranges(spark, sf):
    return ranges.loaded_ranges(_load_records(spark, sf)).withColumn("days", F.datediff("end_date", "start_date") + 1)


@query(oracle(_RUNS.format("""SELECT zone AS entity, CAST(unnest(generate_series(DATE '2023-12-28', DATE '2024-02-03',
    INTERVAL 1 DAY)) AS DATE) AS day FROM (SELECT DISTINCT zone FROM prices) EXCEPT SELECT entity, day FROM loaded_days""")))
def load_holes(spark, sf):
    entities = views.prices(spark, sf).select(F.lit("prices").alias("dataset"), F.col("zone").alias("entity"))
    return ranges.holes(_load_records(spark, sf), entities, "2023-12-28", "2024-02-03")


@query(oracle("""SELECT zone, timestamp_utc, price_eur_mwh, _ingest_ts AS event_id, 'b-5' AS _batch_id, 'landing' AS _source
    FROM prices ANTI JOIN (SELECT entity AS zone, day FROM loaded_days) l
    ON l.zone = prices.zone AND l.day = CAST(prices.timestamp_utc AS DATE)
    WHERE timestamp_utc >= DATE '2024-01-04' AND timestamp_utc < DATE '2024-01-26'"""))
def bronze_holes_batch(spark, sf):
    landed = views.prices(spark, sf).withColumnRenamed("_ingest_ts", "event_id")
    return ranges.bronze_holes(
        landed, _load_records(spark, sf), "prices", "b-5", "landing", "2024-01-04", "2024-01-25"
    ).drop("_ingest_ts")


@query("SELECT event_id, user_id, event_type FROM events")
def table_scan(spark, sf):
    return tables.scan(spark, f"{sf}/events.parquet").select("event_id", "user_id", "event_type")


@query(oracle("SELECT zone, timestamp_utc, price_eur_mwh, _ingest_ts FROM prices"))
def json_record_scan(spark, sf):
    path = scratch_path(spark, "records")
    rows = views.prices(spark, sf)
    sinks.write_json(rows, path)
    missing = tables.read_records(spark, scratch_path(spark, "absent"), rows.schema)
    return tables.read_records(spark, path, rows.schema).unionByName(missing)


def _land_text(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "landing")
    payload = views.prices(spark, sf).select(
        F.lit("prices").alias("dataset"), F.col("zone").alias("country"),
        F.date_format("timestamp_utc", "yyyy-MM-dd").alias("ingestion_date"),
        F.concat_ws(";", F.col("_ingest_ts").cast("string"), F.col("price_eur_mwh").cast("string")).alias("payload"),
    )
    sinks.write_landing(payload, path)
    return path


@query(oracle("""SELECT strftime(max(timestamp_utc), '%Y-%m-%d') AS ingestion_date, true AS is_zone_of_day,
    true AS is_text_file FROM prices"""))
def newest_landed_file(spark, sf):
    """The file itself has a name of chance; its folder is one that the newest day's rows landed in."""
    files = tables.landed_files(spark, _land_text(spark, sf), "*.txt")
    day, zone = F.to_date("ingestion_date"), F.regexp_extract("path", "/dataset=prices/country=([^/]+)/ingestion_date=", 1)
    prices = views.prices(spark, sf).select(F.col("zone").alias("_zone"), F.to_date("timestamp_utc").alias("_day")).distinct()
    newest = tables.newest_file(files).select("ingestion_date", "path", day.alias("_of"), zone.alias("_in"))
    return newest.join(prices, (F.col("_of") == F.col("_day")) & (F.col("_in") == F.col("_zone")), "left").select(
        "ingestion_date", F.col("_zone").isNotNull().alias("is_zone_of_day"), F.col("path").endswith(".txt").alias("is_text_file")
    )


@query(oracle("""SELECT 'prices' AS dataset, zone AS country, strftime(timestamp_utc, '%Y-%m-%d') AS ingestion_date,
    count(*) AS row_count FROM prices GROUP BY ALL"""))
def raw_landing_layout(spark, sf):
    landed = spark.read.schema("value string, dataset string, country string, ingestion_date string").text(
        _land_text(spark, sf)
    )
    return landed.groupBy("dataset", "country", "ingestion_date").agg(F.count("*").alias("row_count"))


_EIC_VALUES = ", ".join(f"('{z}', '{e}')" for z, e in tables.ZONE_EIC.items())


@query(oracle(f"""SELECT z.zone, eic, count(_ingest_ts) AS price_rows FROM (VALUES {_EIC_VALUES}) z(zone, eic)
    LEFT JOIN prices p ON p.zone = z.zone GROUP BY ALL"""))
def geography_dimension(spark, sf):
    counts = views.prices(spark, sf).groupBy("zone").agg(F.count("*").alias("price_rows"))
    return tables.geography(spark).join(counts, "zone", "left").fillna(0, ["price_rows"])


@query(oracle("""SELECT zone_from, zone_to, count(*) AS row_count, sum(flow_mw) AS flow_mw FROM s_flows
    WHERE zone_from || '>' || zone_to IN ('NL>DE','DE>NL','DE>DK-1','DK-1>DE','DK-1>DK-2','DK-2>DK-1','NL>FR','FR>NL',
    'BE>NL','NL>BE','BE>DE','DE>BE','FR>BE','BE>FR','RO>HU','HU>RO') GROUP BY ALL"""))
def reference_corridors(spark, sf):
    keys = ["zone_from", "zone_to"]
    return silver_flows(spark, sf).groupBy(*keys).agg(
        F.count("*").alias("row_count"), F.sum("flow_mw").alias("flow_mw")
    ).join(tables.corridors(spark), keys, "left_semi")


@query(oracle("SELECT CAST(max(timestamp_utc) AS DATE) + 1 AS start_date FROM prices"))
def start_from_target(spark, sf):
    return tables.start_from_target(views.prices(spark, sf), "timestamp_utc", "2020-01-01")


@query(oracle("""SELECT 'prices' AS dataset, zone AS entity, watermark, coalesce(CAST(watermark AS DATE),
    DATE '2020-01-01') + 1 AS start_date FROM (SELECT DISTINCT zone FROM prices)
    LEFT JOIN marks ON dataset = 'prices' AND entity = zone"""))
def start_from_watermarks(spark, sf):
    entities = views.prices(spark, sf).select(F.lit("prices").alias("dataset"), F.col("zone").alias("entity")).distinct()
    return tables.start_from_watermarks(entities, watermarks(spark, sf), "2020-01-01")


# ---------------------------------------------------------------------------
# Sinks
# ---------------------------------------------------------------------------


@query(oracle("SELECT zone, timestamp_utc, price_eur_mwh, _ingest_ts AS event_id, 'b-9' AS _batch_id FROM prices"))
def bronze_append(spark, sf):
    path = scratch_path(spark, "bronze")
    rows = views.prices(spark, sf).withColumnRenamed("_ingest_ts", "event_id")
    for part in (rows.filter("event_id % 2 = 0"), rows.filter("event_id % 2 = 1")):
        sinks.append_bronze(sinks.with_bronze_metadata(part, "b-9", "landing"), path)
    return spark.read.parquet(path).drop("_ingest_ts", "_source")


@query(oracle("""SELECT zone, timestamp_utc, event_date, price_eur_mwh, _ingest_ts FROM (
    SELECT *, CAST(timestamp_utc AS DATE) AS event_date FROM prices
    QUALIFY row_number() OVER (PARTITION BY zone, timestamp_utc ORDER BY _ingest_ts DESC) = 1)"""))
def keyed_upsert(spark, sf):
    path = scratch_path(spark, "upsert")
    rows = views.prices(spark, sf).withColumn("event_date", F.to_date("timestamp_utc"))
    keys = ["zone", "timestamp_utc"]
    late, early = rows.filter("_ingest_ts % 3 = 0"), rows.filter("_ingest_ts % 3 <> 0")
    for batch in (early, late, early):  # the repeated batch must change nothing
        sinks.upsert(batch, path, keys, "_ingest_ts", ["event_date"])
    return sinks.read_like(spark, path, rows)


@query(oracle(f"""SELECT zone, event_date, total_generation_mwh, CASE WHEN event_date >= DATE '2024-01-24'
    THEN 'second' ELSE 'first' END AS load_run FROM stability
    WHERE NOT (event_date = DATE '2024-01-28')"""))
def windowed_replace(spark, sf):
    path = scratch_path(spark, "window")
    mart = stability(spark, sf).select("zone", "event_date", "total_generation_mwh")
    sinks.append(mart.withColumn("load_run", F.lit("first")), path, ["event_date"])
    second = mart.withColumn("load_run", F.lit("second")).filter("event_date <> DATE'2024-01-28'")
    sinks.replace_window(second, path, "event_date", "2024-01-24")
    return sinks.read_like(spark, path, second)


@query(oracle("""SELECT _ingest_ts, zone, 'null_price_eur_mwh' AS _rejection_reason FROM prices
              WHERE price_eur_mwh IS NULL"""))
def quarantine_append(spark, sf):
    path = scratch_path(spark, "quarantine")
    bad = views.prices(spark, sf).filter("price_eur_mwh IS NULL")
    sinks.append_quarantine(bad, path, "null_price_eur_mwh")
    sinks.append_quarantine(bad.filter("zone = 'none'"), path, "nothing")
    return spark.read.parquet(path).select("_ingest_ts", "zone", "_rejection_reason")


@query(oracle("SELECT zone, timestamp_utc, price_eur_mwh, _ingest_ts FROM latest_prices"))
def parquet_overwrite(spark, sf):
    path = scratch_path(spark, "dataset")
    rows = latest_prices(spark, sf)
    sinks.write_parquet(rows.limit(1), path)
    sinks.write_parquet(rows, path)
    return spark.read.parquet(path)


@query(oracle("SELECT zone, timestamp_utc, price_eur_mwh, _ingest_ts FROM latest_prices"))
def json_record_sink(spark, sf):
    path = scratch_path(spark, "json-sink")
    rows = latest_prices(spark, sf)
    sinks.write_json(rows, path)
    return tables.read_records(spark, path, rows.schema)


@query(oracle(f"SELECT zone, timestamp_utc, price_eur_mwh, {r('price_z_score')}, is_negative_price FROM s_prices"))
def clustered_write(spark, sf):
    path = scratch_path(spark, "clustered")
    sinks.write_clustered(silver_prices(spark, sf), path, ["zone", "timestamp_utc"])
    return rounded(spark.read.parquet(path), "price_z_score").drop("_ingest_ts")


_KEY_SQL = " | ".join(f"(((d >> {i}) & 1) << {2 * i}) | (((h >> {i}) & 1) << {2 * i + 1})" for i in range(5))


@query(oracle(f"""SELECT _ingest_ts, {_KEY_SQL} AS cluster_key FROM (SELECT _ingest_ts,
    CAST(day(timestamp_utc) AS BIGINT) AS d, CAST(hour(timestamp_utc) AS BIGINT) AS h FROM prices)"""))
def interleaved_key(spark, sf):
    """The key of a layout clustered by day and hour at once."""
    key = sinks.interleaved([F.dayofmonth("timestamp_utc"), F.hour("timestamp_utc")], 5)
    return views.prices(spark, sf).select("_ingest_ts", key.alias("cluster_key"))


@query(ORACLES["clustered_write"])
def interleaved_write(spark, sf):
    path = scratch_path(spark, "interleaved")
    sinks.write_interleaved(silver_prices(spark, sf), path, ["timestamp_utc", "price_eur_mwh", "zone"])
    return rounded(spark.read.parquet(path), "price_z_score").drop("_ingest_ts")


@query(oracle(f"SELECT zone, event_date, {r('renewable_share_pct')} FROM stability"))
def view_definition(spark, sf):
    from voltmart.plans import core

    name = sinks.create_view(core.stability(spark, sf), "vw_renewable_stability")
    rows = spark.sql(f"SELECT zone, event_date, renewable_share_pct FROM {name}")
    return rounded(rows, "renewable_share_pct")
