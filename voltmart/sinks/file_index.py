"""Which files of a table name an entity: an inverted index from entity hashes to files, kept beside the table.

The index has one row per (file, entity), the entity as its 64-bit hash, in ``SLOTS`` folders by hash. A search reads the
folders of the ids it looks for and joins on the hash, so only files that hold an id come out (and, by a collision, another
file; never one too few). Files never change under one name, so a row is right as long as its file exists. A file counts as
indexed by a row of its own in the folder ``INDEXED``, written after all its rows are stored; files without it are always
among the candidates. Ids and entities are compared as text. Only file paths reach the driver, which lists them anyway.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from voltmart.session import materialize
from voltmart.sinks.tables import append, exists, read_files, table_files

SLOTS = 64
INDEXED = -1
INDEX_SCHEMA = "entity_hash long, file string, slot int"


def _hash(entity: Column) -> Column:
    return F.xxhash64(entity.cast("string"))


def _slot(entity_hash: Column) -> Column:
    return F.pmod(entity_hash, F.lit(SLOTS)).cast("int")


def read_index(spark: SparkSession, index_path: str) -> DataFrame:
    return spark.read.schema(INDEX_SCHEMA).parquet(index_path)


def _unknown(spark: SparkSession, files: DataFrame, index_path: str) -> DataFrame:
    if not exists(spark, index_path):
        return files
    known = read_index(spark, index_path).filter(F.col("slot") == INDEXED)
    return files.join(known.select("file").distinct(), "file", "left_anti")


def refresh(spark: SparkSession, path: str, columns: Sequence[str], index_path: str) -> int:
    """Index the files of a table that the index does not know; returns their number.

    A crash in between leaves files unknown, which the next refresh indexes again. Rows twice in the index change no answer.
    NULL entities are not indexed. An empty or absent table adds nothing.
    """
    if not exists(spark, path):
        return 0
    new = [row["file"] for row in _unknown(spark, table_files(spark, path), index_path).toLocalIterator()]
    if not new:
        return 0
    entities = F.array_distinct(F.array(*[F.col(c).cast("string") for c in columns]))
    pairs = read_files(spark, path, new).select(
        F.input_file_name().alias("file"), F.explode(F.filter(entities, lambda e: e.isNotNull())).alias("e")
    ).select(_hash(F.col("e")).alias("entity_hash"), "file").distinct()
    append(pairs.withColumn("slot", _slot(F.col("entity_hash"))), index_path, ["slot"])
    done = spark.createDataFrame([(None, f, INDEXED) for f in new], INDEX_SCHEMA)
    append(done, index_path, ["slot"])
    return len(new)


def candidates(spark: SparkSession, path: str, index_path: str, ids: DataFrame) -> list[str]:
    """Files of the table that hold one of ``ids`` (column ``entity_id``), and those that the index does not know."""
    files = table_files(spark, path)
    unknown = _unknown(spark, files, index_path)
    if exists(spark, index_path):
        named_ids = ids.filter("entity_id IS NOT NULL")
        wanted = materialize(named_ids.select(_hash(F.col("entity_id")).alias("entity_hash")).distinct())
        slots = [row["slot"] for row in wanted.select(_slot(F.col("entity_hash")).alias("slot")).distinct().collect()]
        index = read_index(spark, index_path).filter(F.col("slot").isin(slots))
        named = index.join(wanted, "entity_hash", "left_semi").select("file").distinct()
        unknown = unknown.unionByName(named.join(files, "file", "left_semi"))
    return [row["file"] for row in unknown.distinct().toLocalIterator()]
