"""The index of files that name an entity, and erasure through it."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from voltmart.operators import operations as ops
from voltmart.sinks import file_index, tables as sinks

ROWS = [("a b", 1), ("a b", 2), ("c:d", 3), ("x", 4), (None, 5), ("é", 6), ("x", 7)]


def table(spark, path, partition_by=()):
    for entity, value in ROWS:  # one file each
        row = spark.createDataFrame([(entity, f"o{value % 2}", value, "p q" if value < 4 else "r")], "e string, o string, v int, part string")
        sinks.append(row, path, partition_by)


def ids(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "entity_id string")


def values(spark, path):
    return sorted(r.v for r in spark.read.parquet(path).select("v").collect())


def test_candidates_are_the_files_that_hold_an_id(spark, tmp_path):
    path, index = str(tmp_path / "ro ws"), str(tmp_path / "index")
    assert file_index.refresh(spark, path, ["e"], index) == 0
    table(spark, path, ["part"])
    assert len(file_index.candidates(spark, path, index, ids(spark, "x"))) == 7  # nothing indexed: all files
    assert file_index.refresh(spark, path, ["e", "o"], index) == 7 and file_index.refresh(spark, path, ["e", "o"], index) == 0

    def found(*names):
        files = file_index.candidates(spark, path, index, ids(spark, *names))
        return sorted(r.v for r in sinks.read_files(spark, path, files).select("v").collect())

    assert found("a b") == [1, 2] and found("x", "é", "x") == [4, 6, 7] and found("o1") == [1, 3, 5, 7]
    assert found("nobody") == found(None) == found() == []
    table(spark, path, ["part"])
    assert len(found("nobody")) == 7 and file_index.refresh(spark, path, ["e", "o"], index) == 7 and found("c:d") == [3, 3]


@pytest.mark.parametrize("partition_by", [[], ["part"]])
def test_indexed_erasure_equals_full_search_and_reads_few_files(spark, tmp_path, monkeypatch, partition_by):
    read = []
    real = ops.read_files
    monkeypatch.setattr(ops, "read_files", lambda s, p, files: read.append(len(files)) or real(s, p, files))
    schema = "erasure_id string, entity_id string, requested_at timestamp, completed_at timestamp, status string"
    left, audits = [], []
    for name, indexed in (("full", False), ("indexed", True)):
        path, requests, audit = (str(tmp_path / f"{name} é%" / n) for n in ("rows", "requests", "audit"))
        table(spark, path, partition_by)
        now = dt.datetime(2024, 1, 1)
        spark.createDataFrame(
            [("r1", "x", now, None, "PENDING"), ("r2", "nobody", now, None, "PENDING"), ("r3", "é", now, now, "COMPLETED")], schema
        ).write.parquet(requests)
        indexes = {"rows": str(tmp_path / name / "index")} if indexed else None
        ops.process_erasures(spark, {"rows": ("gold", path, ["e"], partition_by)}, requests, audit, "me", indexes)
        left.append(values(spark, path))
        done = spark.read.parquet(audit).orderBy("erasure_id").collect()
        audits.append([(r.erasure_id, r.status, r.gold_rows_deleted) for r in done])
        if indexed:
            ops.process_erasures(spark, {"rows": ("gold", path, ["e"], partition_by)}, requests, audit, "me", indexes)
    assert left[0] == left[1] == [1, 2, 3, 5, 6]
    assert audits[0] == audits[1] == [("r1", "COMPLETED", 2), ("r2", "COMPLETED", 0)]
    assert read == [2, 0]


def test_a_crash_before_the_files_are_marked_leaves_them_unknown(spark, tmp_path, monkeypatch):
    path, index = str(tmp_path / "rows"), str(tmp_path / "index")
    table(spark, path)
    real = file_index.append

    def broken(df, *args):
        if df.filter(F.col("slot") == file_index.INDEXED).count():
            raise RuntimeError("lost")
        real(df, *args)

    monkeypatch.setattr(file_index, "append", broken)
    with pytest.raises(RuntimeError):
        file_index.refresh(spark, path, ["e"], index)
    monkeypatch.setattr(file_index, "append", real)
    files = spark.read.parquet(path).inputFiles()
    assert sorted(file_index.candidates(spark, path, index, ids(spark, "x"))) == sorted(files)  # each once
    assert file_index.refresh(spark, path, ["e"], index) == len(files)
    assert len(file_index.candidates(spark, path, index, ids(spark, "x"))) == 2
