"""Anomaly scores: robust z-score, isolation forest, regime labels, model lineage."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from voltmart.functions.quantile import exact_median, exact_quantile, join_small
from voltmart.operators.features import FEATURE_CANDIDATES, active_features
from voltmart.operators.gold import regime_label
from voltmart.session import materialize

KEYS = ["zone", "timestamp_utc"]
# Regime features.
REGIME_FEATURES = ["price_eur_mwh", "price_z_score", "renewable_share_pct", "abs_forecast_error_mw"]


def training_set(
    prices: DataFrame, generation: DataFrame, load: DataFrame, start: str, end: str, renewable_only: bool = False
) -> DataFrame:
    """Prices in [start, end] with mean renewable share and load error, missing numbers 0.0.

    ``renewable_only`` averages the share over renewable rows and drops rows without a price.
    """
    def between(df: DataFrame) -> DataFrame:
        return df.filter(F.col("timestamp_utc").between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))

    gen = between(generation)
    if renewable_only:
        gen = gen.filter("is_renewable")
        prices = prices.filter(F.col("price_eur_mwh").isNotNull())
    share = gen.groupBy(*KEYS).agg(F.avg("renewable_share_pct").alias("renewable_share_pct"))
    error = between(load).select(*KEYS, "abs_forecast_error_mw")
    return between(prices).join(share, KEYS, "left").join(error, KEYS, "left").fillna(0.0)


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population stddev per column in one aggregation; 2 numbers per column reach the driver."""
    row = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]
    ).first()
    return {c: (row[f"m_{c}"] or 0.0, row[f"s_{c}"] or 1.0) for c in columns}


def scale(df: DataFrame, scaler: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in scaler.items()})


# ---------------------------------------------------------------------------
# Robust z-score
# ---------------------------------------------------------------------------


def robust_stats(features: DataFrame, columns: Sequence[str] = FEATURE_CANDIDATES) -> DataFrame:
    """Per (zone, feature): median, mad, stddev (population). Makes four passes: give it a stored table."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns])
    long = features.select("zone", F.inline(pairs))
    keys = ["zone", "feature"]
    median = materialize(exact_median(long, keys, "value", also=[F.stddev_pop("_v").alias("stddev")]).drop("n"))
    distance = long.join(median, keys).select(*keys, F.abs(F.col("value") - F.col("median")).alias("distance"))
    mad = exact_median(distance, keys, "distance").select(*keys, F.col("median").alias("mad"))
    return median.join(mad, keys)


def robust_scores(features: DataFrame, columns: Sequence[str] = FEATURE_CANDIDATES) -> DataFrame:
    """``anomaly_score``: mean over the zone's active features of min(|x - median| / scale / 3, 1), 6 places."""
    spread = F.greatest(F.col("stddev"), 1.4826 * F.col("mad"), F.lit(1e-9))
    wide = robust_stats(features, columns).groupBy("zone").pivot("feature", list(columns)).agg(
        F.first(F.struct("median", spread.alias("scale")))
    )
    model = wide.withColumnsRenamed({c: f"_s_{c}" for c in columns}).join(active_features(features, columns), "zone")
    scored = join_small(features, model, ["zone"])

    def part(c: str) -> Column:
        z = F.abs(F.col(c) - F.col(f"_s_{c}.median")) / F.col(f"_s_{c}.scale") / 3.0
        return F.when(F.array_contains("feature_cols", c), F.least(z, F.lit(1.0))).otherwise(F.lit(0.0))

    total = sum((part(c) for c in columns), F.lit(0.0))
    return scored.withColumn("anomaly_score", F.round(total / F.size("feature_cols"), 6)).drop(
        "feature_cols", *[f"_s_{c}" for c in columns]
    )


def label_anomalies(scored: DataFrame, model_type: str, threshold: float = 0.6) -> DataFrame:
    return scored.withColumns(
        {
            "is_anomaly": F.col("anomaly_score") >= threshold,
            "regime_label": regime_label(F.coalesce("price_eur_mwh", F.lit(0.0)), F.col("anomaly_score")),
            "model_type": F.lit(model_type),
        }
    )


# ---------------------------------------------------------------------------
# Isolation forest (Liu, Ting and Zhou 2008)
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Forest:
    """Trees as flat arrays, one row of each array per tree; at most ``2 * sample`` nodes a tree."""

    columns: tuple[str, ...]
    sample: int
    feature: np.ndarray  # split feature, -1 in a leaf
    threshold: np.ndarray
    left: np.ndarray  # the right child follows the left one
    depth: np.ndarray  # path length credited in a leaf


def path_norm(n: float) -> float:
    """Average path length of an unsuccessful search in a binary tree of ``n`` points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (np.log(n - 1.0) + 0.5772156649015329) - 2.0 * (n - 1.0) / n


def _grow(points: np.ndarray, seed: int | Sequence[int]) -> list[tuple[int, float, int, float]]:
    """One isolation tree over a sample, as (feature, threshold, left child, credited depth) rows; not-a-numbers are 0."""
    rng = np.random.default_rng(seed)
    points = np.nan_to_num(points, posinf=np.finfo(float).max / 4, neginf=np.finfo(float).min / 4)
    limit = int(np.ceil(np.log2(max(len(points), 2))))
    nodes: list[tuple[int, float, int, float]] = [(-1, 0.0, 0, 0.0)]
    todo = [(0, points, 0)]
    while todo:
        at, rows, depth = todo.pop()
        usable = np.zeros(0, dtype=int)
        if depth < limit and len(rows) > 1:
            low, high = rows.min(axis=0), rows.max(axis=0)
            usable = np.flatnonzero(high > low)
        if len(usable) == 0:
            nodes[at] = (-1, 0.0, 0, depth + path_norm(len(rows)))
            continue
        feature = int(rng.choice(usable))
        # In (low, high], so that both children have rows, also if no number lies between the two.
        cut = high[feature] - rng.random() * (high[feature] - low[feature])
        cut = float(max(cut, np.nextafter(low[feature], np.inf)))
        below = rows[:, feature] < cut
        child = len(nodes)
        nodes[at] = (feature, cut, child, 0.0)
        nodes += [(-1, 0.0, 0, 0.0)] * 2
        todo += [(child, rows[below], depth + 1), (child + 1, rows[~below], depth + 1)]
    return nodes


def tree_samples(
    df: DataFrame, n: int, columns: Sequence[str], key: Sequence[str], trees: int, sample: int, seed: int
) -> DataFrame:
    """(tree_id, features): up to ``sample`` hash-chosen rows of the ``n`` per tree.

    Each row is drawn ``rate`` times on average, each draw for a tree that a further hash names; a tree that is drawn twice
    counts once. On a large table nearly all rows are dropped in the scan.
    """
    rate = 1.5 * trees * sample / max(n, 1)
    unit = F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(1_000_000_007)) / 1_000_000_007
    drawn = df.select(
        *[F.col(c).cast("double").alias(c) for c in columns], F.xxhash64(F.lit(seed + 1), *key).alias("_row"),
        F.floor(F.lit(rate) + unit).cast("int").alias("_draws"),
    ).filter("_draws > 0")
    drawn = drawn.select("*", F.explode(F.sequence(F.lit(1), F.col("_draws"))).alias("_draw")).withColumn(
        "tree_id", F.pmod(F.xxhash64("_row", "_draw"), F.lit(trees))
    ).withColumn("_h", F.xxhash64("tree_id", "_row")).dropDuplicates(["tree_id", "_h"])
    order = Window.partitionBy("tree_id").orderBy("_h")
    return drawn.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= sample).select(
        "tree_id", *columns
    )


def fit_forest(
    df: DataFrame, columns: Sequence[str], key: Sequence[str] = KEYS, trees: int = 300, sample: int = 256,
    seed: int = 42,
) -> Forest:
    """Grow the trees in parallel, one group of at most ``sample`` rows per tree; only the trees reach the driver."""
    columns = tuple(columns)
    n = df.count()

    def grow(rows: pd.DataFrame) -> pd.DataFrame:
        tree = int(rows["tree_id"].iloc[0])
        points = rows[list(columns)].to_numpy(dtype=float)
        points = points[np.lexsort(points.T)]  # independent of the order rows arrive in
        nodes = _grow(points, seed * 100_003 + tree)
        out = pd.DataFrame(nodes, columns=["feature", "threshold", "left", "depth"])
        out.insert(0, "node", range(len(nodes)))
        out.insert(0, "tree_id", tree)
        return out

    nodes = (
        tree_samples(df, n, columns, key, trees, sample, seed)
        .groupBy("tree_id")
        .applyInPandas(grow, "tree_id long, node int, feature int, threshold double, left int, depth double")
        .toPandas()
    )
    if nodes.empty:
        raise ValueError("cannot fit a forest on no rows")
    ids = {tree: i for i, tree in enumerate(sorted(nodes["tree_id"].unique()))}
    shape = (len(ids), int(nodes["node"].max()) + 1)
    arrays = {
        "feature": np.full(shape, -1, dtype=np.int32), "threshold": np.zeros(shape), "left": np.zeros(shape, np.int32),
        "depth": np.zeros(shape),
    }
    at = (nodes["tree_id"].map(ids).to_numpy(), nodes["node"].to_numpy())
    for name, array in arrays.items():
        array[at] = nodes[name].to_numpy()
    return Forest(columns, min(sample, n), **arrays)


def _forest_scores(forest: Forest, points: np.ndarray) -> np.ndarray:
    total = np.zeros(len(points))
    rows = np.arange(len(points))
    for feature, threshold, left, depth in zip(forest.feature, forest.threshold, forest.left, forest.depth):
        at = np.zeros(len(points), dtype=np.int32)
        while True:
            split = feature[at]
            inner = split >= 0
            if not inner.any():
                break
            right = points[rows, np.maximum(split, 0)] >= threshold[at]
            at = np.where(inner, left[at] + right, at)
        total += depth[at]
    return np.power(2.0, -total / len(forest.feature) / path_norm(forest.sample))


def zero_if_missing(column: str) -> Column:
    """A number; NULL and not-a-number are 0."""
    return F.coalesce(F.nanvl(F.col(column).cast("double"), F.lit(0.0)), F.lit(0.0))


def isolation_scores(df: DataFrame, forest: Forest, out: str = "isolation_score") -> DataFrame:
    """Score rows in place in Arrow batches with the broadcast trees; higher means more isolated."""
    shared = df.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        trees = shared.value
        for columns in batches:
            points = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            yield pd.Series(_forest_scores(trees, points))

    return df.withColumn(out, score(*[zero_if_missing(c) for c in forest.columns]))


def forest_anomalies(scored: DataFrame, column: str = "isolation_score") -> DataFrame:
    """``anomaly_score`` = min-max normalised isolation score, 1 = most anomalous; range from one aggregation."""
    row = scored.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).first()
    if row["lo"] is None:
        return scored.withColumn("anomaly_score", F.lit(None).cast("double"))
    width = row["hi"] - row["lo"] + 1e-9
    return scored.withColumn("anomaly_score", (F.col(column) - F.lit(row["lo"])) / F.lit(width))


def flag_contamination(scored: DataFrame, contamination: float = 0.1, column: str = "isolation_score") -> DataFrame:
    """``anomaly_score`` above the cut that leaves ``contamination`` of the rows, and ``is_anomaly``."""
    cut = exact_quantile(scored, [], column, 1.0 - contamination).first()
    offset = cut["quantile"] if cut else 0.0
    margin = F.col(column) - F.lit(offset)
    return scored.withColumns({"anomaly_score": F.round(margin, 6), "is_anomaly": margin > 0})


def model_record(df: DataFrame, name: str, version: str, run_id: str) -> DataFrame:
    """One registry row: name, version, run id, number of training rows, time."""
    return df.agg(F.count("*").alias("training_rows")).select(
        F.lit(name).alias("model_name"), F.lit(version).alias("version"), F.lit(run_id).alias("run_id"),
        "training_rows", F.current_timestamp().alias("registered_at"),
    )
