"""Rolling statistics that split a long series over many tasks.

A plain ``Window.partitionBy(zone)`` gives one task per zone and re-aggregates the whole frame for every row. Here the
series is cut into buckets first:

* ``rolling_stats`` (frames by distance): each row enters its own bucket and, without its payload, the bucket one
  frame later. A frame is then "rows of my bucket up to me" + "rows leaving the frame's first bucket" + whole buckets
  in between. The first two are running aggregates, so the work per row does not grow with the frame.
* ``with_row_index`` / ``with_row_chunks`` (frames by row count): rows get their position in the series, the series
  is cut every ``chunk`` rows, and the rows just before a cut are copied into the next chunk.

Moments are merged with the pairwise update of Chan, Golub and LeVeque (1979), so no large squares cancel.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window, functions as F

from voltmart.functions.keys import join_null_safe

DAY = 86400


def seconds(ts: str) -> str:
    """SQL for the whole seconds of a timestamp (a number stays as it is)."""
    return f"cast({ts} AS bigint)"


def merge_moments(a: str, b: str) -> str:
    """SQL for the moments (n, mean, m2) of the union of two disjoint sets."""
    n, delta = f"({a}.n + {b}.n)", f"({b}.mean - {a}.mean)"
    return (
        f"CASE WHEN {b}.n = 0 THEN {a} WHEN {a}.n = 0 THEN {b} ELSE named_struct('n', {n}, "
        f"'mean', {a}.mean + {delta} * {b}.n / {n}, "
        f"'m2', {a}.m2 + {b}.m2 + {delta} * {delta} * {a}.n * {b}.n / {n}) END"
    )


def _moments(n: str, mean: str, m2: str) -> str:
    return (
        f"named_struct('n', coalesce({n}, 0L), 'mean', coalesce({mean}, 0D), 'm2', coalesce({m2}, 0D))"
    )


def _stddev(m: str, ddof: int) -> str:
    """Standard deviation, NULL below ``ddof + 1`` rows; rounding residue of a constant frame counts as 0."""
    variance = f"({m}.m2 / ({m}.n - {ddof}))"
    floor = f"power(1e-10 * (abs({m}.mean) + 1e-10), 2)"
    return f"CASE WHEN {m}.n > {ddof} THEN CASE WHEN {variance} <= {floor} THEN 0D ELSE sqrt({variance}) END END"


def rolling_stats(
    df: DataFrame,
    keys: list[str],
    position: str,
    value: str,
    width: int,
    bucket: int,
    out: str,
    data_position: str | None = None,
) -> DataFrame:
    """Add ``{out}_n``, ``{out}_avg``, ``{out}_std`` (sample), ``{out}_pstd`` over rows of the key in
    ``[position - width, position]``, both ends included, NULL values ignored.

    ``position`` and ``data_position`` are SQL over ``df`` giving whole numbers. Rows take part in frames at
    ``data_position`` (default: ``position``), NULL meaning not at all. ``bucket`` must divide ``width``. A group
    holds two buckets of one key, whatever the width is.
    """
    if width % bucket:
        raise ValueError("bucket must divide width")
    lag = width // bucket
    payload = [c for c in df.columns if c not in keys]
    same = data_position is None
    base = df.selectExpr(
        *keys,
        f"struct({', '.join(payload)}) AS _row",
        f"cast({position} AS bigint) AS _pos",
        f"cast({position if same else data_position} AS bigint) AS _dpos",
        f"cast({value} AS double) AS _v",
    )
    entering = "(_dpos IS NOT NULL AND _v IS NOT NULL)"

    def record(kind: int, at: str, buckets: int = 0, shift: int = 0) -> str:
        row = "_row" if kind in (0, 3) else "if(false, _row, NULL)"
        x = "cast(NULL AS double)" if kind == 3 else f"if({entering}, _v, NULL)"
        return (
            f"named_struct('_kind', {kind}, '_b', floor({at} / {bucket}) + {buckets}, '_at', {at} + {shift}, "
            f"'_r', {row}, '_x', {x})"
        )

    # kind 0: row that asks and enters, 1: row entering, 2: row about to leave, 3: row that only asks
    records = [record(0, "_pos")] if same else [
        record(3, "_pos"), f"if({entering}, {record(1, '_dpos')}, NULL)"
    ]
    records.append(f"if({entering}, {record(2, '_dpos', lag, width)}, NULL)")
    spread = base.selectExpr(
        *keys, f"explode(filter(array({', '.join(records)}), e -> e IS NOT NULL)) AS _e"
    ).select(*keys, "_e.*")

    if lag > 1:
        between = _between(base.filter(entering), base, keys, bucket, lag, same)
        spread = join_null_safe(spread, between, [*keys, "_b"], "left")

    group = f"PARTITION BY {', '.join(keys)}, _b"
    rows = "RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"

    def running(kinds: str, order: str) -> str:
        x, over = f"if(_kind IN ({kinds}), _x, NULL)", f"OVER ({group} ORDER BY {order} {rows})"
        n = f"count({x}) {over}"
        return _moments(n, f"avg({x}) {over}", f"var_pop({x}) {over} * {n}")

    stats = spread.selectExpr(
        "*", f"{running('0, 1', '_at')} AS _head", f"{running('2', '_at DESC')} AS _tail"
    ).filter("_kind IN (0, 3)").selectExpr("*", f"{merge_moments('_head', '_tail')} AS _m")
    if lag > 1:
        stats = stats.selectExpr(
            *keys, "_r", f"CASE WHEN _mid IS NULL THEN _m ELSE {merge_moments('_m', '_mid')} END AS _m"
        )
    return stats.selectExpr(
        *keys,
        *[f"_r.{c} AS {c}" for c in payload],
        f"_m.n AS {out}_n",
        f"if(_m.n > 0, _m.mean, NULL) AS {out}_avg",
        f"{_stddev('_m', 1)} AS {out}_std",
        f"{_stddev('_m', 0)} AS {out}_pstd",
    )


def _between(entering: DataFrame, asking: DataFrame, keys: list[str], bucket: int, lag: int, same: bool) -> DataFrame:
    """Per bucket the moments of the ``lag - 1`` whole buckets before it: one row per key and bucket."""
    place = "_pos" if same else "_dpos"
    # Buckets that only ask need a row too: with one position column they are among the grouped rows already.
    totals = (asking if same else entering).groupBy(*keys, F.expr(f"floor({place} / {bucket})").alias("_b")).agg(
        F.expr(_moments("count(_v)", "avg(_v)", "var_pop(_v) * count(_v)")).alias("_t")
    )
    if not same:
        empty = F.expr(_moments("0L", "0D", "0D")).alias("_t")
        asked = asking.select(*keys, F.expr(f"floor(_pos / {bucket})").alias("_b"), empty).distinct()
        totals = totals.unionByName(asked).groupBy(*keys, "_b").agg(F.max("_t").alias("_t"))
    over = f"OVER (PARTITION BY {', '.join(keys)} ORDER BY _b RANGE BETWEEN {lag - 1} PRECEDING AND 1 PRECEDING)"
    return totals.selectExpr(*keys, "_b", f"collect_list(_t) {over} AS _l").selectExpr(
        *keys, "_b", f"aggregate(_l, {_moments('0L', '0D', '0D')}, (a, b) -> {merge_moments('a', 'b')}) AS _mid"
    )


def with_running_counts(
    df: DataFrame, keys: list[str], ts: str, counted: Mapping[str, str], bucket: int = DAY
) -> DataFrame:
    """For each ``out: condition`` (SQL) add ``out``: how many earlier rows of the key (by ``ts``) meet it.

    Runs as one task per key and bucket; the totals of earlier buckets come from a table with one row per key and
    bucket. ``ts`` must be unique per key for a defined result.
    """
    marked = df.selectExpr(
        "*", f"floor({seconds(ts)} / {bucket}) AS _b",
        *[f"cast({condition} AS bigint) AS _c_{out}" for out, condition in counted.items()],
    )
    key_list = ", ".join(keys)
    before = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    starts = (
        marked.groupBy(*keys, "_b").agg(*[F.sum(f"_c_{out}").alias(f"_n_{out}") for out in counted])
        .selectExpr(
            *keys, "_b",
            *[f"coalesce(sum(_n_{out}) OVER (PARTITION BY {key_list} ORDER BY _b {before}), 0L) AS _s_{out}"
              for out in counted],
        )
    )
    return join_null_safe(marked, starts, [*keys, "_b"], "left").selectExpr(
        *df.columns,
        *[f"_s_{out} + coalesce(sum(_c_{out}) OVER (PARTITION BY {key_list}, _b ORDER BY {ts} {before}), 0L) AS {out}"
          for out in counted],
    )


def with_row_index(df: DataFrame, keys: list[str], ts: str, out: str = "_idx", bucket: int = DAY) -> DataFrame:
    """Add the 0-based position of each row in its key's series."""
    return with_running_counts(df, keys, ts, {out: "true"}, bucket)


def with_row_chunks(df: DataFrame, keys: list[str], ts: str, halo: int, chunk: int = 4096) -> DataFrame:
    """Cut each series into chunks of ``chunk`` rows, every chunk led by the ``halo`` rows before it.

    Adds ``_idx``, ``_chunk`` and ``_halo``. Windows over ``(keys, _chunk)`` ordered by ``_idx`` that look back at
    most ``halo`` rows give the whole-series result on rows where ``_halo`` is false.
    """
    if halo > chunk:
        raise ValueError("halo must not exceed chunk")
    own = f"floor(_idx / {chunk})"
    copies = f"if(_idx % {chunk} >= {chunk - halo}, array({own}, {own} + 1), array({own}))"
    return (
        with_row_index(df, keys, ts)
        .selectExpr("*", f"explode({copies}) AS _chunk")
        .selectExpr("*", f"_chunk > {own} AS _halo")
    )


def chunk_window(keys: list[str]):
    return Window.partitionBy(*keys, "_chunk").orderBy("_idx")


def drop_halo(df: DataFrame) -> DataFrame:
    return df.filter("NOT coalesce(_halo, false)").drop("_idx", "_chunk", "_halo")
