"""Near duplicates by SimHash; links are found through deletion variants of fingerprint segments."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from voltmart.llm.common import LOWER, encoded, id_text, map_batches
from voltmart.llm.components import components
from voltmart.session import materialize

#: Buckets with more different fingerprints than this are linked by cliques instead of pairs.
PAIR_BUCKET = 256


def fingerprint(text: str | None, width: int = 3, block: int = 50_000) -> int:
    """Majority of the XXH64 bits (seed 42) of all word shingles, as an unsigned integer; 0 without words."""
    import xxhash

    words = encoded(text).translate(LOWER).split()
    if not words:
        return 0
    n, ones = max(1, len(words) - width + 1), np.zeros(64, dtype=np.int64)
    for start in range(0, n, block):
        part = words[start : min(start + block, n) + width - 1]
        columns = [part[k:] for k in range(width)] if len(words) >= width else None
        shingles = map(b" ".join, zip(*columns)) if columns else [b" ".join(words)]
        count = min(block, n - start)
        h = np.fromiter(map(xxhash.xxh64_intdigest, shingles, [42] * count), dtype=np.uint64, count=count)
        ones += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, tag, fp long) per row; ``fp`` holds the 64 bits as a signed number, ``tag`` is a hash of the text."""

    def run(batches) -> Iterator[dict]:
        for batch in batches:
            values = [fingerprint(t) for t in batch.column("text").to_pylist()]
            fp = np.array(values, dtype=np.uint64).view(np.int64)
            yield {"doc_id": batch.column("doc_id"), "tag": batch.column("tag"), "fp": fp}

    rows = id_text(docs, id_col, text_col).withColumn("tag", F.xxhash64("text"))
    return map_batches(rows, run, "doc_id long, tag long, fp long")


def _variants(fps: DataFrame) -> DataFrame:
    """64 keys per fingerprint: the segment (2 x 32 bits) and the one bit of it that is left out."""
    keyed = fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("slot"))
    return keyed.selectExpr(
        "fp",
        "(CASE WHEN slot < 32 THEN fp & 4294967295L ELSE shiftrightunsigned(fp, 32) END"
        " & ~shiftleft(1L, slot & 31)) | shiftleft(CAST(slot AS BIGINT), 32) AS key",
    )


def links(fps: DataFrame, pair_bucket: int = PAIR_BUCKET) -> DataFrame:
    """(u, v) edges whose components are those of all pairs of different fingerprints with at most two differing bits.

    Of two segments one differs by at most one bit, so such a pair shares a variant that leaves this bit out. Fingerprints
    of one bucket are joined on it and verified; a pair is kept in one bucket only. A bucket of more than ``pair_bucket``
    fingerprints would pair too many: its members are instead keyed by all 2,016 choices of two left-out bits of the
    whole fingerprint. Members of such a key differ in at most these two bits, so linking each to the smallest is exact
    and linear.
    """
    keys = _variants(fps)
    shared = materialize(keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"))
    members = materialize(keys.join(shared, "key").select("key", "fp", (F.col("n") > pair_bucket).alias("hot")))
    cold = members.filter("NOT hot").select("key", "fp")
    pairs = cold.alias("a").join(
        cold.alias("b"),
        F.expr(
            """a.key = b.key AND a.fp < b.fp AND bit_count(a.fp ^ b.fp) <= 2 AND shiftrightunsigned(a.key, 32) =
            CASE WHEN (a.fp ^ b.fp) & 4294967295L = 0 THEN 0
                 WHEN bit_count((a.fp ^ b.fp) & 4294967295L) = 1 THEN bit_count(((a.fp ^ b.fp) & 4294967295L) - 1)
                 ELSE 32 END"""
        ),
    ).selectExpr("a.fp AS u", "b.fp AS v")
    hot = members.filter("hot").select("fp").distinct()
    cliques = materialize(
        hot.select("fp", F.explode(F.sequence(F.lit(0), F.lit(62))).alias("i"))
        .select("fp", "i", F.explode(F.sequence(F.col("i") + 1, F.lit(63))).alias("j"))
        .selectExpr("fp", "i * 64 + j AS bits", "fp & ~shiftleft(1L, i) & ~shiftleft(1L, j) AS rest")
    )
    hubs = cliques.groupBy("bits", "rest").agg(F.min("fp").alias("v"), F.count("*").alias("n")).filter("n > 1")
    stars = cliques.join(materialize(hubs), ["bits", "rest"]).filter("fp <> v").select(F.col("fp").alias("u"), "v")
    return pairs.union(stars).distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pair_bucket: int = PAIR_BUCKET
) -> DataFrame:
    """(doc_id, fp, component_id): one row per document; component_id is the smallest doc_id of its group.

    Documents are linked if their fingerprints differ in at most two bits. Equal fingerprints are one class, so copies
    are never expanded into pairs. Null and empty texts have fingerprint zero and are linked like any other. Repeated
    rows stay repeated; a null id never is a component id unless all ids of the group are null. An empty table gives an
    empty result.
    """
    rows = materialize(fingerprints(docs, id_col, text_col))
    rooted, least = _groups(rows, F.min("doc_id"), pair_bucket)
    named = materialize(rooted.join(least, "root").select("fp", F.col("least").alias("component_id")))
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def _groups(rows: DataFrame, first: Column, pair_bucket: int = PAIR_BUCKET) -> tuple[DataFrame, DataFrame]:
    """(fp, first, root) of each fingerprint and (root, least) of each component, with ``first``, a minimum, over their rows."""
    classes = materialize(rows.groupBy("fp").agg(first.alias("first")))
    roots = components(links(classes.select("fp"), pair_bucket)).withColumnRenamed("u", "fp")
    rooted = classes.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    return rooted, rooted.groupBy("root").agg(F.min("first").alias("least"))


def deduplicate(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_unnamed: bool = True
) -> DataFrame:
    """``docs`` with one row per group, that of the smallest id, of several texts with this id that of the least hash; columns as given.

    Of rows equal in id and text one stays. Rows without an id cannot be named as a group's first document: they stay,
    exact repeats once. Without ``keep_unnamed`` they are judged like the others and come last in their group, so that
    each group keeps one row.
    """
    rows = materialize(fingerprints(docs, id_col, text_col))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "tag"))
    least = _groups(rows, first)[1].select(F.col("least.doc_id").alias("_kept_id"), F.col("least.tag").alias("_kept_tag"))
    kept = materialize(least.filter("_kept_id IS NOT NULL") if keep_unnamed else least)
    same = docs[id_col].cast("long").eqNullSafe(kept["_kept_id"]) & (F.xxhash64(docs[text_col].cast("string")) == kept["_kept_tag"])
    found = docs.join(kept, same).dropDuplicates(["_kept_id", "_kept_tag"]).select(*[docs[c] for c in docs.columns])
    if not keep_unnamed:
        return found
    return found.union(docs.filter(docs[id_col].cast("long").isNull()).dropDuplicates([text_col]))
