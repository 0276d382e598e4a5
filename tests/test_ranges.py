"""Loaded ranges, their holes and corrections, against day sets."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from voltmart.operators import ranges as rg

D0 = dt.date(2024, 1, 1)


def day(n):
    return D0 + dt.timedelta(days=n)


def at(n):
    return dt.datetime(2024, 6, 1) + dt.timedelta(hours=n)


def frame(spark, rows):
    schema = "dataset string, entity string, start_date date, end_date date, status string, recorded_at timestamp"
    return spark.createDataFrame([("p", e, day(a), day(b), s, at(t)) for e, a, b, s, t in rows], schema)


def covered(rows, entity):
    """Brute force: the newest record of each day."""
    newest = {}
    for e, a, b, s, t in rows:
        for d in range(a, b + 1):
            if e == entity:
                newest[d] = max(newest.get(d, (-1, False)), (t, s != "LOADED"))
    return {d for d, (_, stale) in newest.items() if not stale}


def runs(days):
    out = []
    for d in sorted(days):
        if out and out[-1][1] == d - 1:
            out[-1][1] = d
        else:
            out.append([d, d])
    return [tuple(r) for r in out]


def got(df, entity):
    rows = df.filter(F.col("entity") == entity).orderBy("start_date").collect()
    return [((r.start_date - D0).days, (r.end_date - D0).days) for r in rows]


@pytest.mark.parametrize("seed", range(3))
def test_ranges_and_holes_equal_day_sets(spark, tmp_path, seed):
    rnd = random.Random(seed)
    rows = []
    for _ in range(60):
        a = rnd.randrange(-20, 80)
        rows.append((rnd.choice("AB"), a, a + rnd.randrange(0, 9), rnd.choice(["LOADED"] * 3 + ["STALE"]), rnd.randrange(9)))
    df = frame(spark, rows)
    names = spark.createDataFrame([("p", "A"), ("p", "B"), ("p", "B"), ("p", "C"), (None, "A")], "dataset string, entity string")
    found = rg.holes(df, names, str(day(0)), str(day(60)))
    path = str(tmp_path / "records")
    rg.record(df.limit(0), path)
    rg.record(df, path)
    rg.record(df, path)
    rg.compact(spark, path)
    packed = rg.read_ranges(spark, path)
    assert packed.count() <= 2 * df.count()
    for entity in "ABC":
        days = covered(rows, entity)
        assert got(rg.loaded_ranges(df), entity) == got(rg.loaded_ranges(packed), entity) == runs(days)
        assert got(found, entity) == runs(set(range(0, 61)) - days)
    assert all(r.days == (r.end_date - r.start_date).days + 1 for r in found.collect())
    # An older record that arrives after the compaction still loses.
    late = frame(spark, [("A", -20, 90, "STALE", -1)])
    rg.record(late, path)
    assert got(rg.loaded_ranges(rg.read_ranges(spark, path)), "A") == runs(covered(rows, "A"))


def test_empty_and_odd_records(spark):
    names = spark.createDataFrame([("p", "A")], "dataset string, entity string")
    none = frame(spark, [("A", 5, 4, "LOADED", 0)])
    assert got(rg.holes(none, names, str(day(0)), str(day(3))), "A") == [(0, 3)]
    assert rg.holes(none, names, str(day(9)), str(day(3))).count() == 0
    assert rg.holes(none, names.limit(0), str(day(0)), str(day(3))).count() == 0
    odd = frame(spark, [("A", 0, 1, None, 0), (None, 2, 3, "LOADED", 0), ("A", -9, 99, "LOADED", -5)])
    assert got(rg.holes(odd, names, str(day(0)), str(day(3))), "A") == [(0, 1)]
    assert rg.loaded_ranges(odd.limit(0)).count() == 0


def test_corrections_reopen_loaded_days(spark):
    loaded = frame(spark, [("A", 0, 9, "LOADED", 5), ("A", 20, 22, "LOADED", 5)])
    changes = spark.createDataFrame(
        [("p", "A", day(2), at(6)), ("p", "A", day(3), at(6)), ("p", "A", day(3), at(1)), ("p", "A", day(5), at(5)),
         ("p", "A", day(8), at(7)), ("p", "A", day(15), at(9)), ("p", "Z", day(2), at(9))],
        "dataset string, entity string, day date, changed_at timestamp",
    )
    stale = rg.corrections(changes, loaded)
    assert got(stale, "A") == [(2, 3), (8, 8)]
    assert got(rg.loaded_ranges(loaded.unionByName(stale)), "A") == [(0, 1), (4, 7), (9, 9), (20, 22)]
    again = frame(spark, [("A", 2, 8, "LOADED", 8)])
    assert got(rg.loaded_ranges(loaded.unionByName(stale).unionByName(again)), "A") == [(0, 9), (20, 22)]


def test_bronze_takes_the_rows_of_holes(spark):
    rows = spark.createDataFrame(
        [("NL", dt.datetime(2024, 1, d, 23, 45), float(d)) for d in range(1, 8)], "zone string, timestamp_utc timestamp, v double"
    )
    records = spark.createDataFrame(
        [("prices", "NL", day(0), day(1), "LOADED", at(0)), ("prices", "NL", day(4), day(4), "LOADED", at(0)),
         ("load", "NL", day(0), day(9), "LOADED", at(0))], rg.RANGE_SCHEMA,
    )
    batch = rg.bronze_holes(rows, records, "prices", "b", "s", "2024-01-01", "2024-01-06")
    assert sorted(r.v for r in batch.collect()) == [3.0, 4.0, 6.0]
