"""Power-of-two packing: documents are cut into pieces of binary lengths, and each piece is a full sequence."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from voltmart.functions.quantile import join_small
from voltmart.llm.common import END_ID, id_text, map_batches, pieces
from voltmart.llm.encode import CACHE_WORDS, send_tokenizer, tokenizer_path, worker_encoder
from voltmart.session import materialize


def binary_lengths(n: int, limit: int) -> np.ndarray:
    """Lengths of the pieces of ``n`` tokens: as many of ``limit`` (a power of two) as fit, then the bits of the rest."""
    rest = n % limit
    bits = [1 << b for b in range(limit.bit_length() - 1, -1, -1) if rest >> b & 1]
    return np.array([limit] * (n // limit) + bits, dtype=np.int64)


def pack(
    docs: DataFrame, tokenizer: str | None = None, limit: int = 2048, with_ids: bool = False,
    id_col: str = "doc_id", text_col: str = "text", cache_words: int = CACHE_WORDS,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for, ids.

    A document's ids and the end id are cut into pieces whose lengths are powers of two up to ``limit``. Pieces of equal
    length form one bucket; a batch drawn from a bucket needs no padding, and no sequence crosses documents, so each
    piece is a sequence of its own with offset 0. Sequences are numbered without gaps by bucket, longest first. A null or empty text is the end id alone; repeated rows are packed each; an empty table gives no sequence.
    ``limit`` must be a power of two. A worker's cache holds about ``cache_words`` words, some 200 bytes each; the result does
    not depend on it.
    """
    if limit < 1 or limit & (limit - 1):
        raise ValueError("limit must be a power of two")
    source = send_tokenizer(docs.sparkSession, tokenizer or tokenizer_path("byte_bpe_50k.json"))

    def run(batches) -> Iterator[dict]:
        from pyspark import TaskContext

        encoder, part, numbers = worker_encoder(source.value, cache_words), TaskContext.get().partitionId(), defaultdict(count)
        for batch in pieces(batches, 2_000_000):
            doc_ids = batch.column("doc_id").to_pylist()
            out = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "within", "ids")}
            for doc_id, raw in zip(doc_ids, encoder.encode(batch.column("text").to_pylist()), strict=True):
                raw += END_ID.to_bytes(4, "little")
                n = len(raw) // 4
                lengths = binary_lengths(n, limit)
                starts = np.cumsum(lengths) - lengths
                parts = [raw[4 * s : 4 * (s + k)] for s, k in zip(starts.tolist(), lengths.tolist())]
                out["doc_id"] += [doc_id] * len(parts)
                out["start"] += starts.tolist()
                out["length"] += lengths.tolist()
                out["ids_crc32"] += map(zlib.crc32, parts)
                out["doc_tokens"] += [n] * len(parts)
                out["part"] += [part] * len(parts)
                out["within"] += [next(numbers[k]) for k in lengths.tolist()]
                out["ids"] += parts if with_ids else []
            yield out if with_ids else {k: v for k, v in out.items() if k != "ids"}

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, within long"
    rows = materialize(map_batches(id_text(docs, id_col, text_col), run, schema + ", ids binary" * with_ids))
    return _numbered(rows)


def _numbered(rows: DataFrame) -> DataFrame:
    """Sequence ids from the number of pieces per bucket and task: a table with a row for each, and no order of pieces."""
    counts = rows.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    buckets = rows.groupBy("length").agg(F.count("*").alias("n"))  # one row per power of two
    longer = Window.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.withColumn("in_bucket", F.coalesce(F.sum("n").over(before), F.lit(0))).join(
        buckets.select("length", F.coalesce(F.sum("n").over(longer), F.lit(0)).alias("base")), "length"
    ).select("length", "part", (F.col("base") + F.col("in_bucket")).alias("base"))
    numbered = join_small(rows, bases, ["length", "part"])
    columns = [c for c in rows.columns if c not in ("part", "within")]
    return numbered.select(
        *columns, (F.col("base") + F.col("within")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
