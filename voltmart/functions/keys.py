"""One row per key, chosen by an order, with partial aggregation before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

_FIXED_WIDTH = (
    T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
    T.DateType, T.TimestampType, T.TimestampNTZType,
)


#: What a NULL order counts as: below every other value when the greatest is kept, above it when the least is.
_LEAST = {
    T.ByteType: "-128Y", T.ShortType: "-32768S", T.IntegerType: "-2147483647 - 1", T.LongType: "-9223372036854775807L - 1L",
    T.FloatType: "float('-Infinity')", T.DoubleType: "double('-Infinity')", T.DateType: "date_from_unix_date(-719162)",
    T.TimestampType: "timestamp_micros(-9223372036854775807L)",
}
_GREATEST = {
    T.ByteType: "127Y", T.ShortType: "32767S", T.IntegerType: "2147483647", T.LongType: "9223372036854775807L",
    T.FloatType: "float('NaN')", T.DoubleType: "double('NaN')", T.DateType: "date_from_unix_date(2932896)",
    T.TimestampType: "timestamp_micros(9223372036854775807L)",
}


def _pick(df: DataFrame, keys: list[str], order: list[str], latest: bool) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    bounds = _LEAST if latest else _GREATEST
    fixed = all(isinstance(df.schema[c].dataType, _FIXED_WIDTH) for c in rest)
    if fixed and len(order) == 1 and type(df.schema[order[0]].dataType) in bounds:
        # Fixed-width buffers keep the hash aggregate: no sort on the map side.
        pick = F.max_by if latest else F.min_by
        others = [c for c in rest if c != order[0]]
        place = F.coalesce(F.col(order[0]), F.expr(bounds[type(df.schema[order[0]].dataType)]))
        bound = F.max(order[0]) if latest else F.min(order[0])
        return df.groupBy(*keys).agg(
            *[pick(F.col(c), place).alias(c) for c in others], bound.alias(order[0])
        ).select(*df.columns)
    tail = [c for c in rest if c not in order]
    known = [(F.col(c).isNotNull() if latest else F.col(c).isNull()).alias(f"_known_{i}") for i, c in enumerate(order)]
    ranked = [x for k, c in zip(known, order) for x in (k, F.col(c))]
    row = F.struct(*ranked, *[F.col(c) for c in tail])
    best = F.max(row) if latest else F.min(row)
    return df.groupBy(*keys).agg(best.alias("_row")).select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns]
    )


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on ``keys`` with NULL equal to NULL; keys once, then the other columns of ``left`` and of ``right``."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(renamed, same, how).drop(*[f"_right_{k}" for k in keys])


def latest_per_key(df: DataFrame, keys: list[str], order: list[str] | str) -> DataFrame:
    """Keep the row with the greatest ``order`` per key. Copies of one hot key collapse before the shuffle.

    Nothing is collected: the aggregate buffer is one row per key on every task. ``order`` should be unique per key;
    rows with a NULL order lose against any other.
    """
    return _pick(df, keys, [order] if isinstance(order, str) else order, True)


def first_per_key(df: DataFrame, keys: list[str], order: list[str] | str) -> DataFrame:
    """Keep the row with the smallest ``order`` per key (input-order dedup when ``order`` is the arrival number).

    Rows with a NULL order lose against any other.
    """
    return _pick(df, keys, [order] if isinstance(order, str) else order, False)


def false_if_null(predicate: Column) -> Column:
    return F.coalesce(predicate, F.lit(False))


def split(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """(rows where the predicate holds, all other rows); a NULL predicate fails, so the two sides add up."""
    ok = false_if_null(predicate)
    return df.filter(ok), df.filter(~ok)
