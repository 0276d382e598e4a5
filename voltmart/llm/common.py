"""Column selection, worker caches and small array helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

#: The end id appended to every document.
END_ID = 1

#: A-Z to a-z, for texts as UTF-8 bytes.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

#: A-Z to a-z; every ASCII byte that is no digit or letter to a space. Bytes of other characters stay.
WORD_BYTES = bytes(
    b | 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` alone, so that further columns, whatever their names, cannot clash."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))


def held_out(doc_id):
    """True for the quarter of all documents that no model learns from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def encoded(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def map_batches(rows: DataFrame, one: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str) -> DataFrame:
    """``mapInArrow`` for a function from record batches to dicts of columns."""
    target = _arrow_schema(rows.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in one(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name], type=f.type) for f in target], schema=target
            )

    return rows.mapInArrow(run, schema)


def _arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], schema).schema)


def worker_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker, across tasks; callers bound its size."""
    module = sys.modules.setdefault("_worker_cache", types.ModuleType("_worker_cache"))
    return module.__dict__.setdefault(name, {})


def pieces(batches: Iterator[pa.RecordBatch], max_bytes: int = 16_000_000) -> Iterator[pa.RecordBatch]:
    """Record batches cut so that each holds about ``max_bytes`` of text, or one row."""
    for batch in batches:
        size, start = 0, 0
        lengths = np.diff(np.asarray(_offsets(batch.column("text"))))
        for i, n in enumerate(lengths):
            if size and size + n > max_bytes:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += int(n)
        if batch.num_rows > start:
            yield batch.slice(start)


def _offsets(column) -> np.ndarray:
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    return np.frombuffer(column.buffers()[1], dtype=wide)[column.offset : column.offset + len(column) + 1]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions ``starts[i] .. starts[i] + lengths[i] - 1`` for every i, concatenated."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    first = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return first + np.arange(total, dtype=np.int64)
