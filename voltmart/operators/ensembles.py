"""Isolation forests per key: one small forest for each zone, with the zone's own features, fitted in one job.

A model is a table with a row per key and tree, so it can be stored and loaded like any other (``models.py``). Rows are
scored where they meet their key's trees: a key's rows are dealt to lanes and the trees are copied to each lane, so neither
the number of keys nor a hot key ends up in one task or one broadcast.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from voltmart.functions.keys import join_null_safe
from voltmart.functions.quantile import join_small
from voltmart.operators.features import FEATURE_CANDIDATES
from voltmart.operators.scoring import KEYS, Forest, _forest_scores, _grow, zero_if_missing
from voltmart.session import materialize

#: Rows of a key that one task scores at a time.
LANE_ROWS = 100_000
_TREE = "tree_id int, feature array<int>, threshold array<double>, left array<int>, depth array<double>"


def feature_stats(df: DataFrame, key: str = "zone", columns: Sequence[str] = FEATURE_CANDIDATES) -> DataFrame:
    """(key, n, feature_cols, center, scale): per key the features with any non-zero value, their mean and population stddev.

    A key without such a feature has the first one. A constant feature has scale 1.
    """
    values = {c: zero_if_missing(c) for c in columns}
    found = df.groupBy(key).agg(
        F.count("*").alias("n"),
        F.array(*[
            F.struct(
                F.lit(c).alias("name"), F.avg(v).alias("center"), F.stddev_pop(v).alias("spread"),
                F.max(F.abs(v)).alias("peak"),
            )
            for c, v in values.items()
        ]).alias("_all"),
    )
    some = F.filter("_all", lambda f: f["peak"] > 0)
    used = F.when(F.size(some) > 0, some).otherwise(F.slice("_all", 1, 1))
    return found.select(
        key, "n", F.transform(used, lambda f: f["name"]).alias("feature_cols"),
        F.transform(used, lambda f: f["center"]).alias("center"),
        F.transform(used, lambda f: F.when(f["spread"] > 0, f["spread"]).otherwise(F.lit(1.0))).alias("scale"),
    )


def _samples(df: DataFrame, stats: DataFrame, key: str, columns: Sequence[str], row_key, trees, sample, seed) -> DataFrame:
    """(key, tree_id, columns): up to ``sample`` hash-chosen rows per key and tree; most rows are dropped in the scan."""
    rate = F.lit(1.5 * trees * sample) / F.col("n")
    unit = F.pmod(F.xxhash64(F.lit(seed), *row_key), F.lit(1_000_000_007)) / 1_000_000_007
    rows = join_null_safe(df, stats.select(key, "n"), [key], "inner")
    drawn = rows.select(
        key, *[zero_if_missing(c).alias(c) for c in columns], F.xxhash64(F.lit(seed + 1), *row_key).alias("_row"),
        F.floor(rate + unit).cast("int").alias("_draws"),
    ).filter("_draws > 0")
    drawn = drawn.select("*", F.explode(F.sequence(F.lit(1), F.col("_draws"))).alias("_draw")).withColumn(
        "tree_id", F.pmod(F.xxhash64("_row", "_draw"), F.lit(trees)).cast("int")
    ).withColumn("_h", F.xxhash64("tree_id", "_row")).dropDuplicates([key, "tree_id", "_h"])
    order = Window.partitionBy(key, "tree_id").orderBy("_h")
    return drawn.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= sample).select(
        key, "tree_id", *columns
    )


def fit(
    df: DataFrame, columns: Sequence[str] = FEATURE_CANDIDATES, key: str = "zone", row_key: Sequence[str] = KEYS,
    trees: int = 100, sample: int = 256, seed: int = 42,
) -> DataFrame:
    """A forest per key as rows: key, n, feature_cols, center, scale, sample and one tree's arrays.

    Features are standardised per key. Trees depend on the key's own rows, the seed and nothing else: neither other keys
    nor the partitioning change them. NULL and not-a-number count as 0; NULL is a key like any other. No rows, no model.
    """
    columns = list(columns)
    stats = materialize(feature_stats(df, key, columns))
    drawn = join_null_safe(
        _samples(df, stats, key, columns, row_key, trees, sample, seed), stats.drop("n"), [key], "inner"
    )
    kind = df.schema[key].dataType.simpleString()

    def grow(rows: pd.DataFrame) -> pd.DataFrame:
        one = rows.iloc[0]
        points = (rows[list(one["feature_cols"])].to_numpy(dtype=float) - one["center"]) / one["scale"]
        points = points[np.lexsort(points.T)]  # independent of the order rows arrive in
        named = zlib.crc32(repr(one[key]).encode()) if one[key] is not None else 0
        nodes = pd.DataFrame(
            _grow(points, [seed, int(one["tree_id"]), named]), columns=["feature", "threshold", "left", "depth"]
        )
        return pd.DataFrame(
            {key: [one[key]], "tree_id": [one["tree_id"]]} | {c: [nodes[c].to_numpy()] for c in nodes.columns}
        )

    grown = drawn.groupBy(key, "tree_id").applyInPandas(grow, f"`{key}` {kind}, {_TREE}")
    return join_null_safe(grown, stats, [key], "inner").withColumn("sample", F.least(F.lit(sample), F.col("n")).cast("int"))


def _forest_of(trees: list[dict]) -> Forest:
    trees = sorted(trees, key=lambda t: t["tree_id"])
    shape = (len(trees), max(len(t["feature"]) for t in trees))
    arrays = {
        "feature": np.full(shape, -1, dtype=np.int32), "threshold": np.zeros(shape), "left": np.zeros(shape, np.int32),
        "depth": np.zeros(shape),
    }
    for i, tree in enumerate(trees):
        for name, array in arrays.items():
            array[i, : len(tree[name])] = tree[name]
    return Forest(tuple(trees[0]["feature_cols"]), trees[0]["sample"], **arrays)


def score(df: DataFrame, model: DataFrame, key: str = "zone", out: str = "isolation_score") -> DataFrame:
    """``df`` with the isolation score of its key's forest, higher is more isolated; NULL where the key has no forest.

    Rows of a key are dealt by hash to lanes of about ``LANE_ROWS``; a lane gets a copy of the key's trees.
    """
    import pyarrow as pa

    lanes = materialize(df.groupBy(key).agg(F.ceil(F.count("*") / LANE_ROWS).cast("int").alias("_lanes")))
    rows = join_null_safe(df, lanes, [key], "inner").withColumn(
        "_lane", F.pmod(F.xxhash64(*df.columns), F.col("_lanes")).cast("int")
    ).drop("_lanes")
    copies = join_null_safe(model, lanes, [key], "inner").withColumn(
        "_lane", F.explode(F.sequence(F.lit(0), F.col("_lanes") - 1))
    ).drop("_lanes")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        trees = right.to_pylist()
        scores = [None] * left.num_rows
        if trees and left.num_rows:
            one = trees[0]
            points = np.column_stack([
                np.nan_to_num(left.column(c).cast(pa.float64()).to_numpy().astype(float)) for c in one["feature_cols"]
            ])
            scores = _forest_scores(_forest_of(trees), (points - one["center"]) / one["scale"])
        return left.drop_columns(["_lane"]).append_column(out, pa.array(scores, type=pa.float64()))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return rows.select(*df.columns, "_lane").groupBy(key, "_lane").cogroup(copies.groupBy(key, "_lane")).applyInArrow(
        run, f"{fields}, `{out}` double"
    )


def normalised(scored: DataFrame, key: str = "zone", column: str = "isolation_score") -> DataFrame:
    """``anomaly_score``: the key's scores from 0 to 1, 1 = most anomalous, 6 places; 1 throughout if all are equal."""
    bounds = scored.groupBy(key).agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    bounds = materialize(bounds.withColumnRenamed(key, "_of"))
    width = F.col("_hi") - F.col("_lo")
    value = F.when(width > 0, (F.col(column) - F.col("_lo")) / width).when(F.col(column).isNotNull(), F.lit(1.0))
    joined = scored.join(bounds, scored[key].eqNullSafe(bounds["_of"]))
    return joined.withColumn("anomaly_score", F.round(value, 6)).drop("_lo", "_hi", "_of")


def anomalies(df: DataFrame, model: DataFrame, key: str = "zone") -> DataFrame:
    """``df`` with ``isolation_score`` and ``anomaly_score`` of its key's forest; scored once, then stored."""
    return normalised(materialize(score(df, model, key)), key)
