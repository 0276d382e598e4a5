"""Exact group quantiles without collecting a group, and joins to small per-group tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from voltmart.session import materialize

def join_small(df: DataFrame, small: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join to a per-group table whose size nobody knows beforehand.

    The table is written first. Its size on disk then decides: below ``spark.sql.autoBroadcastJoinThreshold`` Spark
    broadcasts it and ``df`` is not shuffled onto a few group keys; above it is a sort-merge join with adaptive skew
    handling.
    """
    return df.join(materialize(small), keys, how)


def _with_bounds(present: DataFrame, bounds: DataFrame, keys: list[str]) -> DataFrame:
    """Every row with the bounds of its key; without keys the single row of bounds becomes literals."""
    if keys:
        return join_small(present, bounds, keys)
    row = bounds.first()
    return present.withColumns({c: F.lit(row[c]).cast(bounds.schema[c].dataType) for c in bounds.columns})


def exact_quantile(
    df: DataFrame, keys: list[str], value: str, q: float = 0.5, accuracy: int = 20000, also: Sequence[Column] = ()
) -> DataFrame:
    """One row per key: ``keys``, ``n``, ``also``, ``quantile`` with linear interpolation between the neighbouring ranks.

    ``keys`` may be empty: then all rows are one group, and a table without values gives no row. Pass 1 brackets the ranks
    with a quantile sketch, whose rank error is at most ``n / accuracy``. Pass 2 counts the rows below the bracket and the
    distinct values in it, about ``4 / accuracy`` of a key's rows, pre-aggregated by value. These are ranked by range: tasks
    hold ranges of (key, value), the ranges' counts are summed in order, and only the range that holds a rank is numbered.
    So no task holds a key, however large its bracket. The ranks are exact; a bracket that missed them raises an error.
    ``also``: further aggregates of the key's values, named ``_v``, taken in pass 1.
    """
    present = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    margin = 2.0 / accuracy
    bounds = present.groupBy(*keys).agg(
        F.count("_v").alias("n"),
        F.min("_v").alias("_min"),
        F.max("_v").alias("_max"),
        F.percentile_approx(
            "_v", F.array(F.lit(max(0.0, q - margin)), F.lit(min(1.0, q + margin))), F.lit(accuracy)
        ).alias("_q"),
        *also,
    )
    kept = [c for c in bounds.columns if c not in (*keys, "_min", "_max", "_q")]
    small = F.col("n") <= 10 * accuracy
    low_open, high_open = F.lit(q - margin <= 0), F.lit(q + margin >= 1)
    bounds = bounds.select(
        *keys, *kept,
        F.when(small | low_open, F.col("_min")).otherwise(F.col("_q")[0]).alias("_lo"),
        F.when(small | high_open, F.col("_max")).otherwise(F.col("_q")[1]).alias("_hi"),
    )
    near = _with_bounds(present, bounds, keys).filter(F.col("_v") <= F.col("_hi"))
    # The NULL value stands for all rows below the bracket; it sorts first.
    counted = near.groupBy(
        *keys, *kept, F.when(F.col("_v") >= F.col("_lo"), F.col("_v")).alias("_v")
    ).agg(F.count("*").alias("_c"))
    ranged = materialize(
        counted.repartitionByRange(*keys, F.col("_v").asc_nulls_first()).withColumn("_part", F.spark_partition_id())
    )
    place = (F.col("n") - 1) * F.lit(q)
    first_rank, last_rank = F.floor(place) + 1, F.ceil(place) + 1
    # One row per key and range, in the order of the ranges.
    sums = ranged.groupBy(*keys, "n", "_part").agg(F.sum("_c").alias("_held"))
    upto = F.sum("_held").over(Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, 0))
    final = F.max("_part").over(Window.partitionBy(*keys))
    sums = sums.withColumns({"_before": upto - F.col("_held"), "_final": final})
    # A key's last range is kept, so that ranks beyond the bracket are seen.
    holding = sums.filter(
        ((F.col("_before") < last_rank) & (F.col("_before") + F.col("_held") >= first_rank))
        | (F.col("_part") == F.col("_final"))
    ).select(*keys, "_part", "_before")
    inside = F.col("_v").isNotNull()
    rank = F.col("_before") + F.sum("_c").over(
        Window.partitionBy(*keys, "_part").orderBy(F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    )
    found = (
        ranged.join(holding, [*keys, "_part"])
        .withColumn("_upto", rank)
        .groupBy(*keys, *kept)
        .agg(
            F.min(F.when(inside & (F.col("_upto") >= first_rank), F.col("_v"))).alias("_a"),
            F.min(F.when(inside & (F.col("_upto") >= last_rank), F.col("_v"))).alias("_b"),
            F.max(F.when(~inside, F.col("_upto"))).alias("_below"),
        )
    )
    hit = (F.coalesce(F.col("_below"), F.lit(0)) < first_rank) & F.col("_b").isNotNull()
    return found.select(
        *keys, *kept,
        F.when(hit, F.col("_a") + (F.col("_b") - F.col("_a")) * (place - F.floor(place)))
        .otherwise(F.raise_error(F.lit("the bracket missed the rank")).cast("double"))
        .alias("quantile"),
    )


def exact_median(
    df: DataFrame, keys: list[str], value: str, accuracy: int = 20000, also: Sequence[Column] = ()
) -> DataFrame:
    return exact_quantile(df, keys, value, 0.5, accuracy, also).withColumnRenamed("quantile", "median")
