"""Bucketed rolling statistics against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from voltmart.functions.keys import first_per_key, latest_per_key
from voltmart.functions import quantile
from voltmart.functions.quantile import exact_median, exact_quantile
from voltmart.functions.rolling import (
    chunk_window, drop_halo, rolling_stats, with_row_chunks, with_row_index, with_running_counts,
)


def series(seed, n=400, span=2000, hot=0.6):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < hot else rng.choice("ab")
        value = None if rng.random() < 0.1 else round(rng.uniform(-50, 300), 2)
        rows.append((key, rng.randrange(-200, span), value, i))
    return rows


def brute(rows, width):
    out = {}
    for key, t, _, i in rows:
        frame = [v for k, s, v, _ in rows if k == key and v is not None and t - width <= s <= t]
        out[i] = (
            len(frame),
            np.mean(frame) if frame else None,
            np.std(frame, ddof=1) if len(frame) > 1 else None,
            np.std(frame) if frame else None,
        )
    return out


@pytest.mark.parametrize("width,bucket", [(100, 100), (120, 10), (300, 50), (7, 7), (6, 1)])
def test_rolling_stats_equals_brute_force(spark, width, bucket):
    rows = series(width)
    df = spark.createDataFrame(rows, "zone string, t long, v double, i long")
    got = {r["i"]: r for r in rolling_stats(df, ["zone"], "t", "v", width, bucket, "w").collect()}
    assert len(got) == len(rows)
    for i, (n, avg, std, pstd) in brute(rows, width).items():
        row = got[i]
        assert row["w_n"] == n
        for name, want in (("w_avg", avg), ("w_std", std), ("w_pstd", pstd)):
            assert (row[name] is None) == (want is None), (i, name)
            if want is not None:
                assert row[name] == pytest.approx(want, rel=1e-9, abs=1e-9)


def test_constant_frame_has_zero_stddev(spark):
    rows = [("z", 900 * i, 0.1) for i in range(500)]
    df = spark.createDataFrame(rows, "zone string, t long, v double")
    for bucket in (900 * 96, 900 * 8):
        top = rolling_stats(df, ["zone"], "t", "v", 900 * 96, bucket, "w").agg(F.max("w_std"), F.max("w_pstd")).first()
        assert tuple(top) == (0.0, 0.0)


def test_large_offset_keeps_precision(spark):
    rows = [("z", i, 1e9 + (i % 7)) for i in range(300)]
    df = spark.createDataFrame(rows, "zone string, t long, v double")
    got = rolling_stats(df, ["zone"], "t", "v", 60, 6, "w").orderBy("t").collect()
    for i, row in enumerate(got[5:], start=5):
        frame = [v for _, t, v in rows if i - 60 <= t <= i]
        assert row["w_std"] == pytest.approx(np.std(frame, ddof=1), rel=1e-6)


@pytest.mark.parametrize("chunk", [8, 50])
def test_chunks_equal_plain_window(spark, chunk):
    rows = [(z, 60 * i, float((i * 37) % 101)) for z, n in (("hot", 300), ("a", 20), ("b", 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "zone string, t long, v double")
    plain = Window.partitionBy("zone").orderBy("t")
    want = df.withColumns({"m": F.avg("v").over(plain.rowsBetween(-8, 0)), "l": F.lag("v", 5).over(plain)})
    order = chunk_window(["zone"])
    got = drop_halo(
        with_row_chunks(df, ["zone"], "t", 8, chunk).withColumns(
            {"m": F.avg("v").over(order.rowsBetween(-8, 0)), "l": F.lag("v", 5).over(order)}
        )
    )
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_row_index_and_running_counts(spark):
    rows = [("z", 40000 * i, i % 3 == 0) for i in range(50)]
    df = spark.createDataFrame(rows, "zone string, t long, c boolean")
    got = with_running_counts(with_row_index(df, ["zone"], "t"), ["zone"], "t", {"n": "c"}).orderBy("t").collect()
    assert [r["_idx"] for r in got] == list(range(50))
    assert [r["n"] for r in got] == [sum(1 for j in range(i) if j % 3 == 0) for i in range(50)]


def test_dedup_picks_whole_rows_and_survives_a_hot_key(spark):
    rows = [("hot", i, float(i), f"s{i}") for i in range(1000)] + [("a", 5, 1.0, "x"), ("a", 4, 2.0, "y")]
    df = spark.createDataFrame(rows, "k string, o long, v double, s string")
    assert sorted(map(tuple, latest_per_key(df, ["k"], "o").collect())) == [("a", 5, 1.0, "x"), ("hot", 999, 999.0, "s999")]
    narrow = df.drop("s")
    assert sorted(map(tuple, first_per_key(narrow, ["k"], "o").collect())) == [("a", 4, 2.0), ("hot", 0, 0.0)]
    plan = latest_per_key(narrow, ["k"], "o")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "partial_" in plan


@pytest.mark.parametrize("q", [0.0, 0.1, 0.5, 0.95, 1.0])
def test_exact_quantile_equals_numpy(spark, q):
    rng = random.Random(7)
    groups = {"hot": [round(rng.gauss(50, 30), 1) for _ in range(5000)], "dup": [3.0] * 900 + [1.0, 9.0], "one": [4.5]}
    rows = [(k, v) for k, values in groups.items() for v in values] + [("one", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    # a coarse sketch makes the bracket narrow, so ranks are really searched inside it
    got = {r["k"]: r["quantile"] for r in exact_quantile(df, ["k"], "v", q, accuracy=50).collect()}
    for key, values in groups.items():
        assert got[key] == pytest.approx(np.quantile(values, q), abs=1e-9)


def test_exact_median_even_count(spark):
    df = spark.createDataFrame([("k", 1.0), ("k", 2.0), ("k", 10.0), ("k", 20.0)], "k string, v double")
    assert exact_median(df, ["k"], "v").first()["median"] == 6.0


def test_rows_without_key_are_kept(spark):
    rows = [(None, 10, 1.0), (None, 20, 2.0), ("z", 10, 3.0)]
    df = spark.createDataFrame(rows, "zone string, t long, v double")
    assert rolling_stats(df, ["zone"], "t", "v", 100, 10, "w").count() == 3
    assert drop_halo(with_row_chunks(df, ["zone"], "t", 2, 4)).count() == 3


@pytest.mark.parametrize("q", [0.0, 0.37, 0.5, 0.95, 1.0])
def test_exact_quantile_without_keys_ranks_by_range(spark, q):
    """All rows are one group: its bracket is spread over several tasks, ties and missing values included."""
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.normal(size=3000), np.repeat(0.25, 700), rng.integers(0, 9, 300).astype(float)])
    rows = [(float(v),) for v in rng.permutation(values)] + [(None,)] * 50
    df = spark.createDataFrame(rows, "v double").repartition(6)
    for accuracy in (40, 100000):  # a narrow bracket, and one that holds every value
        row = exact_quantile(df, [], "v", q, accuracy, also=[F.stddev_pop("_v").alias("s")]).first()
        assert row["quantile"] == pytest.approx(np.quantile(values, q), abs=1e-12) and row["n"] == 4000
        assert row["s"] == pytest.approx(values.std())
    assert exact_quantile(df.limit(0), [], "v", q).first() is None


def test_no_task_holds_the_bracket_of_one_group(spark, monkeypatch):
    """With many values in the bracket the ranking window sees one range at a time."""
    stored = []
    real = quantile.materialize
    monkeypatch.setattr(quantile, "materialize", lambda df: stored.append(real(df)) or stored[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(20000).select((F.hash("id") / 1000.0).alias("v"))
        row = exact_quantile(df, [], "v", 0.9, 100000).first()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert row["quantile"] == pytest.approx(np.quantile([r.v for r in df.collect()], 0.9))
    sizes = [r["count"] for r in stored[-1].groupBy("_part").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 20000 / 4
