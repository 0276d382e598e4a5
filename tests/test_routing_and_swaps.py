"""One-pass routing, crash-safe tables without partitions, clustering on several columns."""

import datetime as dt
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from voltmart.operators import operations as ops, quality
from voltmart.schemas import Contract, Rule
from voltmart.sinks import tables as sinks

RULES = [
    Rule("has_value", "v IS NOT NULL", "CRITICAL"), Rule("positive", "v > 0", "WARNING"), Rule("small", "v < 90", "CRITICAL")
]


@pytest.fixture()
def batch(spark):
    rows = [(i, None if i % 10 == 0 else float(i - 3)) for i in range(100)]
    return spark.createDataFrame(rows, "id long, v double").repartition(4)


def test_route_equals_evaluate_and_enforce(spark, batch, tmp_path):
    scanned = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def once(i):
        scanned.add(1)
        return i

    source = batch.withColumn("id", once.asNondeterministic()("id"))
    routed = quality.route(source, RULES, str(tmp_path / "t"))
    assert scanned.value == 100  # each source row was computed once
    valid, failed, counts = quality.enforce(batch, RULES)
    assert sorted(r.id for r in routed.valid.collect()) == sorted(r.id for r in valid.collect())
    assert routed.valid.columns == batch.columns
    assert sorted((r.id, r._failed_rule) for r in routed.quarantined.collect()) == sorted(
        (r.id, r._failed_rule) for r in failed.select("id", "_failed_rule").collect()
    )
    assert sorted(map(tuple, routed.counts.collect())) == sorted(map(tuple, counts.collect()))


def test_route_checks_contract_and_gate(spark, batch, tmp_path):
    keyed = Contract("numbers", ("id",), batch.schema)
    assert quality.route(batch, RULES, str(tmp_path / "a"), keyed).null_keys == {"id": 0}
    none = batch.withColumn("id", F.when(F.col("id") != 5, F.col("id")))
    with pytest.raises(quality.ContractError, match="NULL keys"):
        quality.route(none, RULES, str(tmp_path / "b"), keyed)
    with pytest.raises(quality.ContractError, match="missing"):
        quality.route(batch.drop("id"), RULES, str(tmp_path / "c"), keyed)
    assert not (tmp_path / "c").exists()
    with pytest.raises(quality.QualityGateError):
        quality.route(batch, RULES, str(tmp_path / "d"), critical=0.95)
    empty = quality.route(batch.limit(0), RULES, str(tmp_path / "e"), keyed, critical=0.95)
    assert empty.valid.count() == 0 and {r.pass_rate for r in empty.counts.collect()} == {1.0}


@pytest.mark.parametrize("step,call_no", [("delete", 1), ("delete", 2), ("rename", 1)])
def test_a_crash_while_files_are_swapped_loses_nothing(spark, tmp_path, monkeypatch, step, call_no):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(i, 1, f"old {i}") for i in range(20)], "k long, at long, v string").repartition(3)
    sinks.upsert(first, path, ["k"], "at")
    change = spark.createDataFrame([(5, 2, "new 5"), (99, 2, "new 99")], first.schema)

    real, done = sinks._folder, []

    class Failing:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            def call(*args):
                if name == step and ".draft" not in str(args[0]):
                    done.append(name)
                    if len(done) == call_no:
                        raise RuntimeError("the driver is gone")
                return getattr(self.fs, name)(*args)

            return call

    monkeypatch.setattr(sinks, "_folder", lambda s, p: (lambda place, fs: (place, Failing(fs)))(*real(s, p)))
    with pytest.raises(RuntimeError):
        sinks.upsert(change.repartition(2), path, ["k"], "at")
    monkeypatch.setattr(sinks, "_folder", real)
    sinks.finish_swaps(spark, path)
    found = {r.k: r.v for r in spark.read.parquet(path).collect()}
    assert len(found) == spark.read.parquet(path).count() == 21 and found[5] == "new 5" and found[99] == "new 99"
    sinks.upsert(change, path, ["k"], "at")
    assert spark.read.parquet(path).count() == 21 and not glob.glob(f"{path}/_swap*")


def test_a_request_that_arrives_during_erasure_stays_pending(spark, tmp_path, monkeypatch):
    schema = "erasure_id string, entity_id string, requested_at timestamp, completed_at timestamp, status string"
    paths = {n: str(tmp_path / n) for n in ("rows", "requests", "audit")}
    spark.createDataFrame([("NL", 1), ("DE", 2)], "zone string, v int").write.partitionBy("zone").parquet(paths["rows"])
    spark.createDataFrame([("r1", "NL", dt.datetime(2024, 1, 1), None, "PENDING")], schema).write.parquet(paths["requests"])
    late = spark.createDataFrame([("r2", "DE", dt.datetime(2024, 1, 2), None, "PENDING")], schema)
    real = ops.rewrite_without

    def rewrite(*args):
        late.write.mode("append").parquet(paths["requests"])
        real(*args)

    tables = {"rows": ("bronze", paths["rows"], ["zone"], ["zone"])}
    monkeypatch.setattr(ops, "rewrite_without", rewrite)
    ops.process_erasures(spark, tables, paths["requests"], paths["audit"], "me")
    status = {r.erasure_id: r.status for r in spark.read.parquet(paths["requests"]).collect()}
    assert status == {"r1": "COMPLETED", "r2": "PENDING"}
    monkeypatch.setattr(ops, "rewrite_without", real)
    ops.process_erasures(spark, tables, paths["requests"], paths["audit"], "me")
    status = {r.erasure_id: r.status for r in spark.read.parquet(paths["requests"]).collect()}
    assert status == {"r1": "COMPLETED", "r2": "COMPLETED"} and spark.read.parquet(paths["audit"]).count() == 2


def skipped(path, column, value):
    """Files whose statistics rule a value out, and all files."""
    ruled_out, files = 0, glob.glob(f"{path}/*.parquet")
    for file in files:
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.names.index(column)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        ruled_out += all(s.max < value or s.min > value for s in stats)
    return ruled_out, len(files)


def test_interleaved_layout_skips_files_by_each_column(spark, tmp_path):
    df = spark.range(20000).selectExpr("id % 137 AS a", "CAST(hash(id) % 1000 AS BIGINT) AS b", "CAST(id AS STRING) AS c")
    sinks.write_clustered(df, str(tmp_path / "sorted"), ["a", "b"], 16)
    sinks.write_interleaved(df, str(tmp_path / "mixed"), ["a", "b"], 16)
    assert spark.read.parquet(str(tmp_path / "mixed")).exceptAll(df).count() == 0
    assert spark.read.parquet(str(tmp_path / "mixed")).count() == 20000
    assert skipped(tmp_path / "sorted", "b", 10)[0] == 0
    # Bounds of the files are sampled and differ from run to run, so the share is taken over values all along the column.
    for column, values in (("a", range(4, 137, 8)), ("b", range(10, 1000, 60))):
        found = [skipped(tmp_path / "mixed", column, value) for value in values]
        assert sum(out for out, _ in found) >= sum(files for _, files in found) / 2, (column, found)


def test_interleaving_orders_bits_and_takes_nulls_and_texts(spark, tmp_path):
    df = spark.createDataFrame([(0, 0), (1, 0), (0, 1), (3, 3), (2, 1)], "x long, y long")
    keys = [r[0] for r in df.select(sinks.interleaved([F.col("x"), F.col("y")], 2)).collect()]
    assert keys == [0, 1, 2, 15, 6]
    with pytest.raises(ValueError):
        sinks.interleaved([F.col("x")] * 8, 8)
    odd = spark.createDataFrame([(None, "a"), (1, None), (1, None), (2, "é")], "x long, s string")
    sinks.write_interleaved(odd, str(tmp_path / "odd"), ["x", "s"])
    assert sorted(map(repr, spark.read.parquet(str(tmp_path / "odd")).collect())) == sorted(map(repr, odd.collect()))
    sinks.write_interleaved(odd.limit(0), str(tmp_path / "none"), ["x", "s"])
