"""Forests per zone, stored models, regime columns."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltmart.operators import ensembles, gold, intelligence, models, scoring

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "zone string, timestamp_utc timestamp, price_eur_mwh double, generation_mw double, flat double"
COLUMNS = ["price_eur_mwh", "generation_mw", "flat"]


def at(i):
    return T0 + dt.timedelta(minutes=15 * i)


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(5)
    rows = []
    for zone, n, scale in (("NL", 900, 5.0), ("DE", 300, 50.0), (None, 40, 1.0)):
        for i, (a, b) in enumerate(rng.normal(60, scale, (n, 2))):
            rows.append((zone, at(i), float(a), 0.0 if zone == "DE" else float(b), 0.0))
    rows += [("NL", at(900), 900.0, 60.0, 0.0), ("DE", at(300), -4000.0, 0.0, 0.0), ("NL", at(901), None, float("nan"), None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(6)


def scores(rows):
    return {(r.zone, r.timestamp_utc): r.isolation_score for r in rows.collect()}


@pytest.mark.parametrize("seed", range(40))
def test_neighbouring_floats_and_constants_grow(seed):
    near = np.array([[1.0, 7.0], [np.nextafter(1.0, 2), 7.0], [1.0, 7.0], [np.nan, 7.0]])
    nodes = scoring._grow(near, seed)
    sizes = [n for n in nodes if n[0] >= 0]
    assert all(n[0] == 0 for n in sizes) and len(nodes) == 2 * len(sizes) + 1
    assert scoring._grow(np.array([[1.0], [np.nextafter(1.0, 2)]]), seed)[0][:2] == (0, np.nextafter(1.0, 2))
    assert scoring._grow(np.full((5, 2), 3.0), seed)[0][0] == -1


def test_features_per_zone(series):
    used = {r.zone: r.feature_cols for r in ensembles.feature_stats(series, "zone", COLUMNS).collect()}
    assert used == {"NL": COLUMNS[:2], "DE": COLUMNS[:1], None: COLUMNS[:2]}


def test_a_zone_scores_as_if_it_were_alone(series):
    together = scores(ensembles.score(series, ensembles.fit(series, COLUMNS, trees=30)))
    assert len(together) == series.count()
    for zone in ("NL", "DE", None):
        one = series.filter(F.col("zone").eqNullSafe(zone)).repartition(2)
        alone = scores(ensembles.score(one, ensembles.fit(one, COLUMNS, trees=30)))
        assert alone == {k: v for k, v in together.items() if k[0] == zone}


def test_scores_equal_one_forest_in_numpy(series):
    model = ensembles.fit(series, COLUMNS, trees=30)
    trees = [r.asDict() for r in model.filter("zone = 'NL'").collect()]
    rows = series.filter("zone = 'NL'").collect()
    points = np.nan_to_num([[r.price_eur_mwh or 0.0, r.generation_mw or 0.0] for r in rows])
    want = scoring._forest_scores(ensembles._forest_of(trees), (points - trees[0]["center"]) / trees[0]["scale"])
    got = scores(ensembles.score(series, model))
    assert [got["NL", r.timestamp_utc] for r in rows] == list(want)


def test_lanes_do_not_change_scores(series, monkeypatch):
    model = ensembles.fit(series, COLUMNS, trees=20)
    whole = scores(ensembles.score(series, model))
    monkeypatch.setattr(ensembles, "LANE_ROWS", 50)
    assert scores(ensembles.score(series, model)) == whole


def test_outliers_lead_in_each_zone(series):
    found = ensembles.anomalies(series, ensembles.fit(series, COLUMNS, trees=60))
    top = {r.zone: r for r in found.filter("anomaly_score = 1").collect()}
    assert top["DE"].price_eur_mwh == -4000.0 and set(top) == {"NL", "DE", None}
    assert top["NL"].price_eur_mwh in (900.0, None)
    low = found.groupBy("zone").agg(F.min("anomaly_score").alias("m")).collect()
    assert all(r.m == 0 for r in low)


def test_unknown_zone_empty_table_and_equal_rows(spark, series):
    model = ensembles.fit(series.filter("zone = 'NL'"), COLUMNS, trees=5)
    assert all((v is None) == (k[0] != "NL") for k, v in scores(ensembles.score(series, model)).items())
    none = series.limit(0)
    assert ensembles.fit(none, COLUMNS).count() == 0 and ensembles.score(none, model).count() == 0
    same = spark.createDataFrame([("NL", at(i), 5.0, 0.0, 0.0) for i in range(9)], SCHEMA)
    found = ensembles.anomalies(same, ensembles.fit(same, COLUMNS, trees=5))
    assert {r.anomaly_score for r in found.collect()} == {1.0}


def test_a_stored_model_scores_to_the_same_bits(spark, series, tmp_path):
    store = str(tmp_path / "models")
    model = ensembles.fit(series, COLUMNS, trees=20)
    record = models.save(model, store, "forest", "9", "run-a", 1243)
    models.save(ensembles.fit(series, COLUMNS, trees=3), store, "forest", "10", "run-b", 1243)
    stored, found = models.load(spark, store, "forest", "9")
    assert found == record and scores(ensembles.score(series, stored)) == scores(ensembles.score(series, model))
    assert models.load(spark, store, "forest")[1]["version"] == "10"  # by number
    with pytest.raises(ValueError):
        models.save(model, store, "forest", "9", "run-c", 1)
    with pytest.raises(LookupError):
        models.load(spark, store, "other")
    row = models.with_lineage(series, record).first()
    assert (row.model_name, row.model_version, row.model_run_id) == ("forest", "9", "run-a") and row.scored_at


def test_a_version_is_fitted_once_and_unseen_until_its_record_is_there(spark, series, tmp_path):
    store, calls = str(tmp_path / "models"), []

    def fit():
        calls.append(1)
        return ensembles.fit(series, COLUMNS, trees=3), 7

    ensembles.fit(series, COLUMNS, trees=3).write.parquet(f"{store}/forest-left-by-a-crash")
    for _ in range(3):
        model, record = models.load_or_fit(spark, store, "forest", "1", fit)
        assert model.count() == 9 and record["training_rows"] == 7
    assert len(calls) == 1 and models.records(spark, store).count() == 1


def test_price_lags_are_exact_hours(spark):
    rows = [("NL", T0 + dt.timedelta(hours=h), float(h)) for h in (0, 1, 3, 24, 25)] + [(None, T0, 5.0), ("DE", T0, None)]
    df = spark.createDataFrame(rows, "zone string, timestamp_utc timestamp, price_eur_mwh double")
    found = {
        (r.zone, r.timestamp_utc): (r.feature_lag_1h, r.feature_lag_24h) for r in gold.with_price_lags(df).collect()
    }
    assert [found["NL", T0 + dt.timedelta(hours=h)] for h in (0, 1, 3, 24, 25)] == [
        (None, None), (0.0, None), (None, None), (None, 0.0), (24.0, 1.0)
    ]
    assert found[None, T0] == found["DE", T0] == (None, None) and len(found) == 7


def test_the_local_job_offers_both_models(spark):
    prices = spark.createDataFrame([("NL", at(i), 50.0 + i % 12) for i in range(120)], "zone string, timestamp_utc timestamp, price_eur_mwh double")
    gen = spark.createDataFrame([("NL", at(i), 100.0 + i % 8) for i in range(120)], "zone string, timestamp_utc timestamp, generation_mw double")
    load = spark.createDataFrame([("NL", at(i), 1000.0 + i, 990.0 + i) for i in range(120)],
                                 "zone string, timestamp_utc timestamp, actual_load_mw double, forecast_load_mw double")
    result = intelligence.run(prices, gen, load, horizon=4, model_type="isolation_forest")
    row = result.anomalies.agg(F.min("anomaly_score"), F.max("anomaly_score"), F.min("model_type"), F.count("*")).first()
    assert tuple(row) == (0.0, 1.0, "isolation_forest", 120)
    with pytest.raises(ValueError):
        intelligence.score_zones(result.features, "oracle")
