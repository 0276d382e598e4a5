"""Market series derived from the star-schema test tables, in Spark and as SQL text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Zone by number modulo 7, production type by the first word of the part type.
ZONE_BY_NUMBER = ["NL", "DE", "DK-1", "DK-2", "FR", "BE", "RO"]
PSR_BY_WORD = {
    "ECONOMY": "Solar", "LARGE": "Wind Onshore", "SMALL": "Biomass", "MEDIUM": "Fossil Gas", "PROMO": "Nuclear",
}
OTHER_PSR = "Fossil Hard coal"
RENEWABLE_WORDS = ["ECONOMY", "LARGE", "SMALL"]


# Declared, so that opening a table starts no schema job.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
              "o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def zone_of(number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(z) for z in ZONE_BY_NUMBER]), (number % 7 + 1).cast("int"))


def shifted(day: str, key: str) -> Column:
    """A date's day within a 30-day month of January 2024 plus a quarter hour chosen by the key."""
    days = F.datediff(F.to_date(day), F.lit("1995-01-01").cast("date")) % 30
    return F.timestamp_seconds(F.lit(1704067200) + days * 86400 + F.col(key) % 96 * 900)


def psr_of(part_type: Column) -> Column:
    out = F.lit(OTHER_PSR)
    for word, psr in reversed(PSR_BY_WORD.items()):
        out = F.when(F.split_part(part_type, F.lit(" "), F.lit(1)) == word, F.lit(psr)).otherwise(out)
    return out


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    slot = F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / 900) * 900
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("_ingest_ts"),
        zone_of(F.col("user_id")).alias("zone"),
        F.timestamp_seconds(slot).alias("timestamp_utc"),
        F.when(F.col("event_id") % 101 != 0, F.round(F.col("value") * 2 - 20, 2)).alias("price_eur_mwh"),
    )


def _zoned(spark: SparkSession, sf_dir: str, name: str, key: str, number: str, out: str = "zone") -> DataFrame:
    """Key and zone of a dimension table, computed before it is joined."""
    return table(spark, sf_dir, name).select(key, zone_of(F.col(number)).alias(out))


def generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    suppliers = _zoned(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    word = F.split_part(F.col("p_type"), F.lit(" "), F.lit(1))
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", psr_of(F.col("p_type")).alias("psr_type"), word.isin(*RENEWABLE_WORDS).alias("is_renewable")
    )
    return (
        items.join(suppliers, items.l_suppkey == suppliers.s_suppkey)
        .join(parts, items.l_partkey == parts.p_partkey)
        .select(
            "zone",
            shifted("l_shipdate", "l_orderkey").alias("timestamp_utc"),
            "psr_type",
            F.when(F.col("l_orderkey") % 89 != 0, F.col("l_quantity")).alias("generation_mw"),
            "is_renewable",
            # order and line number, then quantity: line numbers repeat within an order
            ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 64 + F.col("l_quantity").cast("long"))
            .alias("_ingest_ts"),
        )
    )


def load(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customers = _zoned(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    key, total = F.col("o_orderkey"), F.col("o_totalprice") / 100
    return orders.join(customers, orders.o_custkey == customers.c_custkey).select(
        key.alias("_ingest_ts"),
        "zone",
        shifted("o_orderdate", "o_orderkey").alias("timestamp_utc"),
        F.when(~(key % 97).isin(0, 1), total).alias("actual_load_mw"),
        F.when(~(key % 97).isin(0, 2), total * (F.lit(0.9) + (key % 21) / 100)).alias("forecast_load_mw"),
    )


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    suppliers = _zoned(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey", "zone_from")
    customers = _zoned(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "zone_to")
    return (
        items.join(suppliers, items.l_suppkey == suppliers.s_suppkey)
        .join(orders.join(customers, orders.o_custkey == customers.c_custkey), items.l_orderkey == orders.o_orderkey)
        .filter(F.col("zone_from") != F.col("zone_to"))
        .select(
            "zone_from", "zone_to",
            shifted("l_shipdate", "l_orderkey").alias("timestamp_utc"),
            F.when(F.col("l_orderkey") % 83 != 0, F.col("l_quantity")).alias("flow_mw"),
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("_ingest_ts"),
        )
    )


def _sql_zone(expr: str) -> str:
    whens = " ".join(f"WHEN {i} THEN '{z}'" for i, z in enumerate(ZONE_BY_NUMBER))
    return f"(CASE {expr} % 7 {whens} END)"


def _sql_shift(day: str, key: str) -> str:
    return (
        f"(TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(date_diff('day', DATE '1995-01-01', CAST({day} AS DATE)) "
        f"% 30 AS INTEGER)) + to_minutes(CAST({key} % 96 * 15 AS INTEGER)))"
    )


_WORD = "split_part(p_type, ' ', 1)"
_PSR = f"(CASE {_WORD} " + " ".join(f"WHEN '{w}' THEN '{p}'" for w, p in PSR_BY_WORD.items()) + f" ELSE '{OTHER_PSR}' END)"

SQL_VIEWS = {
    "prices": f"""SELECT event_id AS _ingest_ts, {_sql_zone('user_id')} AS zone,
        time_bucket(INTERVAL '15 minutes', ts) AS timestamp_utc,
        CASE WHEN event_id % 101 <> 0 THEN round(value * 2 - 20, 2) END AS price_eur_mwh FROM events""",
    "generation": f"""SELECT {_sql_zone('s_nationkey')} AS zone, {_sql_shift('l_shipdate', 'l_orderkey')} AS timestamp_utc,
        {_PSR} AS psr_type, CASE WHEN l_orderkey % 89 <> 0 THEN l_quantity END AS generation_mw,
        {_WORD} IN ('ECONOMY', 'LARGE', 'SMALL') AS is_renewable,
        (l_orderkey * 10 + l_linenumber) * 64 + CAST(l_quantity AS BIGINT) AS _ingest_ts
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey""",
    "load": f"""SELECT o_orderkey AS _ingest_ts, {_sql_zone('c_nationkey')} AS zone,
        {_sql_shift('o_orderdate', 'o_orderkey')} AS timestamp_utc,
        CASE WHEN o_orderkey % 97 NOT IN (0, 1) THEN o_totalprice / 100 END AS actual_load_mw,
        CASE WHEN o_orderkey % 97 NOT IN (0, 2)
             THEN o_totalprice / 100 * (CAST(0.9 AS DOUBLE) + CAST(o_orderkey % 21 AS DOUBLE) / 100) END AS forecast_load_mw
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "flows": f"""SELECT * FROM (SELECT {_sql_zone('s_nationkey')} AS zone_from, {_sql_zone('c_nationkey')} AS zone_to,
        {_sql_shift('l_shipdate', 'l_orderkey')} AS timestamp_utc,
        CASE WHEN l_orderkey % 83 <> 0 THEN l_quantity END AS flow_mw, l_orderkey * 10 + l_linenumber AS _ingest_ts
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey) WHERE zone_from <> zone_to""",
}
