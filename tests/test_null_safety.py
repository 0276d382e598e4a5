"""NULL partitions, NULL orders and crashes in the writers and in the operations built on them."""

import pytest

from voltmart.functions.keys import first_per_key, latest_per_key
from voltmart.functions.rolling import rolling_stats, with_row_index
from voltmart.operators import operations as ops
from voltmart.schemas import ERASURE_SCHEMA
from voltmart.sinks import tables as sinks


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns or df.columns) for r in df.collect()), key=repr)


def test_erasure_keeps_other_rows_of_a_null_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    data = [("NL", None), ("DE", None), ("DE", "d1"), ("NL", "d1"), ("NL", "d2")]
    sinks.append(spark.createDataFrame(data, "zone string, event_date string"), path, ["event_date"])
    sinks.rewrite_without(spark, path, ["zone"], spark.createDataFrame([("NL",)], "entity_id string"), ["event_date"])
    assert rows(spark.read.parquet(path), "zone", "event_date") == [("DE", "d1"), ("DE", None)]


@pytest.mark.parametrize("partition_by", [["a"], ["a", "b"]])
def test_upsert_keeps_stored_rows_of_null_partitions(spark, tmp_path, partition_by):
    path, schema = str(tmp_path / "t"), "k int, v string, o int, a string, b string"
    first = [(1, "x", 1, None, "p"), (2, "x", 1, None, None), (3, "x", 1, "q", None), (4, "x", 1, "q", "p")]
    sinks.upsert(spark.createDataFrame(first, schema), path, ["k"], "o", partition_by)
    second = [(1, "y", 2, None, "p"), (5, "y", 1, "q", None), (6, "y", 1, None, None)]
    for _ in range(2):
        sinks.upsert(spark.createDataFrame(second, schema), path, ["k"], "o", partition_by)
        got = rows(spark.read.parquet(path), "k", "v")
        assert got == [(1, "y"), (2, "x"), (3, "x"), (4, "x"), (5, "y"), (6, "y")]


def test_upsert_of_a_narrower_source_keeps_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    full = [(1, 1, "a", "d"), (2, 1, "b", "d"), (None, 1, "n", "d"), (3, 1, "c", None)]
    sinks.upsert(spark.createDataFrame(full, "k int, o int, extra string, p string"), path, ["k"], "o", ["p"])
    narrow = spark.createDataFrame([(1, 2, "d"), (9, 1, "d"), (None, 3, "d")], "k int, o int, p string")
    sinks.upsert(narrow, path, ["k"], "o", ["p"])
    want = [(1, 2, "a"), (2, 1, "b"), (3, 1, "c"), (9, 1, None), (None, 3, "n")]
    assert rows(spark.read.parquet(path), "k", "o", "extra") == want


def test_upsert_into_an_emptied_table(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([("NL", "d1")], "zone string, p string")
    sinks.append(one, path, ["p"])
    sinks.rewrite_without(spark, path, ["zone"], spark.createDataFrame([("NL",)], "entity_id string"), ["p"])
    sinks.upsert(one, path, ["zone"], "p", ["p"])
    assert rows(spark.read.parquet(path), "zone", "p") == [("NL", "d1")]


@pytest.mark.parametrize("extra", ["v double", "v double, s string"])
def test_null_orders_lose_but_never_blank_a_row(spark, extra):
    width = extra.count(",") + 1
    data = [("a", None, 1.0), ("b", None, 2.0), ("b", 5, 3.0), ("b", 4, 4.0), ("c", -(2**31), 5.0)]
    df = spark.createDataFrame([r + ("s",) * (width - 1) for r in data], f"k string, o int, {extra}")
    assert rows(latest_per_key(df, ["k"], "o"), "k", "o", "v") == [("a", None, 1.0), ("b", 5, 3.0), ("c", -(2**31), 5.0)]
    assert rows(first_per_key(df, ["k"], "o"), "k", "o", "v") == [("a", None, 1.0), ("b", 4, 4.0), ("c", -(2**31), 5.0)]


def test_null_keys_form_a_series(spark):
    data = [(None, f"2024-01-{d:02d} 00:00:00", float(d)) for d in range(1, 21)]
    df = spark.createDataFrame(data, "zone string, t string, v double").selectExpr("zone", "CAST(t AS timestamp) AS ts", "v")
    assert sorted(r._idx for r in with_row_index(df, ["zone"], "ts").collect()) == list(range(20))
    found = rolling_stats(df, ["zone"], "unix_seconds(ts)", "v", 10 * 86400, 86400, "w").collect()
    assert sorted(r.w_n for r in found) == [*range(1, 12), *[11] * 9]


class Crash(RuntimeError):
    pass


@pytest.mark.parametrize("step", ["rewrite_without", "upsert", "swap_files"])
def test_erasure_audit_survives_a_crash_after_each_step(spark, tmp_path, monkeypatch, step):
    paths = {n: str(tmp_path / n) for n in ("prices", "requests", "audit")}
    sinks.append(spark.createDataFrame([("NL", 1), ("NL", 2), ("DE", 3)], "zone string, v int"), paths["prices"], ["zone"])
    spark.createDataFrame(
        [("r1", "NL", None, "PENDING"), ("r2", "FR", None, "COMPLETED")],
        "erasure_id string, entity_id string, completed_at timestamp, status string",
    ).selectExpr("*", "timestamp'2024-02-01' AS requested_at").write.parquet(paths["requests"])

    def process():
        ops.process_erasures(
            spark, {"prices": ("bronze", paths["prices"], ["zone"], ["zone"])}, paths["requests"], paths["audit"], "op"
        )

    whole = getattr(ops, step)

    def then_crash(*args, **kwargs):
        whole(*args, **kwargs)
        raise Crash

    monkeypatch.setattr(ops, step, then_crash)
    with pytest.raises(Crash):
        process()
    monkeypatch.undo()
    for _ in range(2):
        process()
        audit = spark.read.schema(ERASURE_SCHEMA).parquet(paths["audit"])
        assert rows(audit, "erasure_id", "status", "bronze_rows_deleted") == [("r1", "COMPLETED", 2)]
        assert rows(spark.read.parquet(paths["prices"]), "zone", "v") == [("DE", 3)]
        assert {r.status for r in spark.read.parquet(paths["requests"]).collect()} == {"COMPLETED"}
