"""Writers over plain Parquet: append, keyed upsert, windowed replace, quarantine, clustered layout.

No writer overwrites a path it is reading. Replaced partitions are staged in the shared folder first, then swapped in
with dynamic partition overwrite, so a lost executor or a retried job leaves either the old or the new partition. A table
without partitions has its new files staged in a hidden folder of its own and a journal that names the files they replace;
then old files go and new ones move in. A crash at any step loses nothing: the next writer finishes what a journal names.
Files that others append meanwhile are in no journal and stay. Readers may see part of the rows while files are moved.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from voltmart.functions.keys import join_null_safe, latest_per_key
from voltmart.session import materialize, scratch_path


def with_bronze_metadata(df: DataFrame, batch_id: str, source: str) -> DataFrame:
    return df.withColumns(
        {"_ingest_ts": F.current_timestamp(), "_batch_id": F.lit(batch_id), "_source": F.lit(source)}
    )


def _even(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Gather rows by table partition; adaptive execution splits a partition that is too large for one task."""
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df


def write_landing(payloads: DataFrame, path: str) -> None:
    """Raw text under ``dataset=/country=/ingestion_date=``; needs those columns and ``payload``."""
    layout = ["dataset", "country", "ingestion_date"]
    _even(payloads.select(*layout, "payload"), layout).write.mode("append").partitionBy(*layout).text(path)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    _even(df, partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)


def append_bronze(df: DataFrame, path: str) -> None:
    """Append partitioned by zone (flows: by origin)."""
    append(df, path, ["zone_from" if "zone_from" in df.columns else "zone"])


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path).schema
        return True
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def table_files(spark: SparkSession, path: str) -> DataFrame:
    """``file``: the files of a table as Spark lists them, named as by ``input_file_name``; contents are not read."""
    return spark.createDataFrame([(f,) for f in spark.read.parquet(path).inputFiles()], "file string")


def read_files(spark: SparkSession, path: str, files: Sequence[str]) -> DataFrame:
    """Some files of a table, with the table's columns and partition values; no files are no rows."""
    schema = spark.read.parquet(path).schema
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*[_listed(spark, f).toString() for f in files])


def _listed(spark: SparkSession, file: str):
    """Path of a file by its listed name, in which spaces and other characters are escaped."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(file))


def read_like(spark: SparkSession, path: str, df: DataFrame) -> DataFrame:
    """Read a table with the schema of ``df``, so partition values keep their types."""
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def _read_stored(spark: SparkSession, path: str, df: DataFrame) -> DataFrame:
    """Read a table with all its own columns; those that ``df`` has too take their type from it."""
    typed = {f.name: f for f in df.schema}
    own = spark.read.option("mergeSchema", "true").parquet(path).schema
    fields = [typed.pop(f.name, f) for f in own] + list(typed.values())
    return spark.read.schema(T.StructType(fields)).parquet(path).select(*[f.name for f in fields])


def _stage(df: DataFrame, partition_by: Sequence[str]) -> tuple[DataFrame, str]:
    """Write ``df`` to the shared folder; returns the copy read back and its path."""
    spark = df.sparkSession
    staged = scratch_path(spark, "stage")
    _even(df, partition_by).write.partitionBy(*partition_by).parquet(staged)
    return read_like(spark, staged, df), staged


def _overwrite(copy: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Overwrite the whole table, or with ``partition_by`` only the partitions ``copy`` has rows for."""
    writer = _even(copy, partition_by).write.mode("overwrite").partitionBy(*partition_by)
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; nothing happens when it is absent."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def swap_files(df: DataFrame, path: str, old: Sequence[str]) -> None:
    """Replace the files ``old`` of a table without partitions by the rows of ``df``, see the top of this module."""
    spark, name = df.sparkSession, f"_swap-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{name}")
    place, fs = _folder(spark, path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    draft = hadoop.Path(place, f"{name}.draft")
    out = fs.create(draft)
    out.write(bytearray("\n".join(old).encode()))
    out.close()
    fs.rename(draft, hadoop.Path(place, f"{name}.journal"))
    finish_swaps(spark, path)


def finish_swaps(spark: SparkSession, path: str) -> None:
    """Complete the replacements that journals of a table name; each step may be repeated."""
    place, fs = _folder(spark, path)
    if not fs.exists(place):
        return
    hadoop = spark._jvm.org.apache.hadoop.fs
    for journal in [s.getPath() for s in fs.listStatus(place)]:
        if not journal.getName().endswith(".journal"):
            continue
        stream = fs.open(journal)
        lines = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        for old in lines.split("\n") if lines else []:
            fs.delete(_listed(spark, old), False)
        staged = hadoop.Path(place, journal.getName().removesuffix(".journal"))
        for file in [s.getPath() for s in fs.listStatus(staged)] if fs.exists(staged) else []:
            if file.getName().startswith("part-"):
                fs.rename(file, hadoop.Path(place, file.getName()))
        fs.delete(staged, True)
        fs.delete(journal, False)


def _emptied(stored: DataFrame, kept: DataFrame, partition_by: Sequence[str]) -> list[str]:
    """Folders of the partitions of ``stored`` that have no row in ``kept``: one short text per table partition."""
    folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "")
    folders = stored.select(*partition_by, folder.alias("_folder")).distinct()
    gone = join_null_safe(folders, kept.select(*partition_by).distinct(), partition_by, "left_anti")
    return [row["_folder"] for row in gone.select("_folder").toLocalIterator()]


def _in_partitions(df: DataFrame, parts: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of ``df`` in the partitions listed in ``parts`` (a stored table); NULL is a partition like any other.

    Partitions without NULL meet in a plain semi join, which prunes the scan at run time; those with a NULL are few, and the
    filter prunes them when the scan is planned.
    """
    whole = " AND ".join(f"`{c}` IS NOT NULL" for c in partition_by)
    named = df.filter(whole).join(parts.filter(whole), list(partition_by), "left_semi")
    return named.unionByName(
        join_null_safe(df.filter(f"NOT ({whole})"), parts.filter(f"NOT ({whole})"), partition_by, "left_semi")
    ).select(*df.columns)


def upsert(
    source: DataFrame, path: str, keys: Sequence[str], order: str | Sequence[str], partition_by: Sequence[str] = ()
) -> None:
    """Insert new keys, replace present ones; of several rows per key the one with the greatest ``order`` stays.

    Only partitions that receive source rows are read and rewritten. A key must not move between partitions. Columns of
    the table that the source lacks keep the stored row's values, and are NULL for new keys. Repeating the same source
    changes nothing.
    """
    spark = source.sparkSession
    keys = list(keys)
    order = [order] if isinstance(order, str) else list(order)
    if not partition_by:
        finish_swaps(spark, path)
    if not exists(spark, path):
        rows = _even(latest_per_key(source, keys, order), partition_by)
        rows.write.mode("append").partitionBy(*partition_by).parquet(path)
        return
    target = _read_stored(spark, path, source)
    if partition_by:
        target = _in_partitions(target, materialize(source.select(*partition_by).distinct()), partition_by)
    absent = [c for c in target.columns if c not in source.columns]
    if absent:
        stored = latest_per_key(target, keys, order).select(*keys, *absent)
        source = join_null_safe(source, stored, keys, "left")
    rows = latest_per_key(target.unionByName(source), keys, order)
    if not partition_by:
        swap_files(rows, path, target.inputFiles())
        return
    copy, staged = _stage(rows, partition_by)
    _overwrite(copy, path, partition_by)
    delete_path(spark, staged)


def replace_window(df: DataFrame, path: str, date_column: str, cutoff: str | Column) -> None:
    """Replace the table's dates from ``cutoff`` on by those rows of ``df``; older dates stay untouched.

    The table is partitioned by the date column. A date in the window that ``df`` no longer has is emptied.
    """
    spark = df.sparkSession
    limit = (F.lit(cutoff) if isinstance(cutoff, str) else cutoff).cast("date")
    copy, staged = _stage(df.filter(F.col(date_column) >= limit), [date_column])
    gone: list[str] = []
    if exists(spark, path):
        stored = spark.read.schema(df.schema).parquet(path).filter(F.col(date_column) >= limit)
        gone = _emptied(stored, copy, [date_column])
    _overwrite(copy, path, [date_column])
    for folder in gone + [staged]:
        delete_path(spark, folder)


def rewrite_without(
    spark: SparkSession, path: str, columns: Sequence[str], ids: DataFrame, partition_by: Sequence[str] = (),
    files: Sequence[str] | None = None,
) -> None:
    """Delete the rows that name one of ``ids`` (column ``entity_id``) in any of ``columns``.

    With ``partition_by`` only partitions holding such rows are read in full and rewritten; emptied ones are removed.
    ``files``, from an index, are all that can hold such rows: only they are searched, and without partitions only they are
    replaced.
    """
    if files is not None and not files:
        return
    ids = materialize(ids.select("entity_id").distinct())
    if not partition_by:
        finish_swaps(spark, path)
        table = spark.read.parquet(path) if files is None else read_files(spark, path, files)
        swap_files(without(table, columns, ids), path, table.inputFiles())
        return
    table = spark.read.parquet(path)
    searched = table if files is None else read_files(spark, path, files)
    touched = None
    for column in columns:
        named = searched.join(ids, searched[column] == ids["entity_id"], "left_semi").select(*partition_by)
        touched = named if touched is None else touched.unionByName(named)
    touched = materialize(touched.distinct())
    affected = _in_partitions(table, touched, partition_by).select(*table.columns)
    copy, staged = _stage(without(affected, columns, ids), partition_by)
    located = table.select(*partition_by, "_metadata")
    gone = _emptied(_in_partitions(located, touched, partition_by), copy, partition_by)
    _overwrite(copy, path, partition_by)
    for folder in gone + [staged]:
        delete_path(spark, folder)


def without(df: DataFrame, columns: Sequence[str], ids: DataFrame) -> DataFrame:
    """Rows that name none of ``ids`` in ``columns``; NULL names nobody."""
    for column in columns:
        df = df.join(ids, df[column] == ids["entity_id"], "left_anti")
    return df


def append_quarantine(df: DataFrame, path: str, reason: str | Column) -> bool:
    """Append rejected rows with reason and time; nothing is written when there are none. The plan of ``df`` runs once."""
    tagged = materialize(df.withColumns(
        {
            "_rejection_reason": F.lit(reason) if isinstance(reason, str) else reason,
            "_quarantined_at": F.current_timestamp(),
        }
    ))
    if tagged.isEmpty():
        return False
    append(tagged, path)
    return True


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], files: int | None = None) -> None:
    """Range-partition and sort by ``columns`` so that file and row-group statistics can skip data."""
    ranged = df.repartitionByRange(files, *columns) if files else df.repartitionByRange(*columns)
    ranged.sortWithinPartitions(*columns).write.mode("overwrite").parquet(path)


def interleaved(ranks: Sequence[Column], bits: int) -> Column:
    """One number from whole-number ranks below ``2 ** bits``: bit 0 of each rank, first column lowest, then bit 1, ..."""
    if bits * len(ranks) > 63:
        raise ValueError("bits times columns must be 63 at most")
    key = F.lit(0).cast("long")
    for bit in range(bits):
        for place, rank in enumerate(ranks):
            one = F.shiftright(rank.cast("long"), bit).bitwiseAND(F.lit(1).cast("long"))
            key = key.bitwiseOR(F.shiftleft(one, bit * len(ranks) + place))
    return key


def range_ranks(df: DataFrame, columns: Sequence[str], bits: int, sample: int = 10_000) -> list[Column]:
    """Per column the number of bounds below the value, from 0 to ``2 ** bits - 1``; NULL is 0.

    Bounds are the quantiles of at most ``sample`` rows chosen by hash, so they only shape the layout. That many values per
    column reach the driver.
    """
    chosen = df.select(*columns).orderBy(F.xxhash64(F.lit(7), *columns), *columns).limit(sample).collect()
    ranks = []
    for column in columns:
        values = sorted(row[column] for row in chosen if row[column] is not None)
        steps = 1 << bits
        bounds = sorted({values[len(values) * i // steps] for i in range(1, steps)}) if values else []
        kind = df.schema[column].dataType
        value, below = F.col(column), F.lit(0)
        if bounds:
            below = F.size(F.filter(F.array(*[F.lit(b).cast(kind) for b in bounds]), lambda bound: bound < value))
        ranks.append(F.when(value.isNull(), F.lit(0)).otherwise(below))
    return ranks


def write_interleaved(
    df: DataFrame, path: str, columns: Sequence[str], files: int | None = None, bits: int = 6
) -> None:
    """Cluster on all ``columns`` at once: rows are range-partitioned and sorted by the interleaved bits of their ranks.

    A file then covers a small range of every column, so a filter on any of them skips files, not only one on the first.
    """
    bits = min(bits, 63 // len(columns))
    keyed = df.withColumn("_z", interleaved(range_ranks(df, columns, bits), bits))
    ranged = keyed.repartitionByRange(files, "_z", *columns) if files else keyed.repartitionByRange("_z", *columns)
    ranged.sortWithinPartitions("_z", *columns).drop("_z").write.mode("overwrite").parquet(path)


def create_view(df: DataFrame, name: str) -> str:
    """Session view over a query."""
    df.createOrReplaceTempView(name)
    return name
