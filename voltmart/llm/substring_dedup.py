"""Substring deduplication by words: difference-cover anchors pick candidates, which then extend to whole windows.

Only short windows at the cover positions of each text (modulo a period) are compared at first. Whatever two places a
repeated window has, some shift below the period brings both to cover positions, so the two share an aligned anchor. The
windows around shared anchors are then compared word by word, by two independent 64-bit names.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from voltmart.functions.keys import join_null_safe
from voltmart.llm.common import map_batches, pieces, ragged
from voltmart.session import materialize, scratch_path

LENGTH, PERIOD = 35, 21

#: Odd multipliers of the two families of window names.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_BUCKET_BYTES = 1 << 28
_RUN = "k1 long, k2 long, first int, last int"


@lru_cache
def difference_cover(period: int) -> tuple[int, ...]:
    """Residues whose differences are all residues of ``period``: a smallest set up to 31, else twice the root in number."""
    if period > 31:
        step = math.isqrt(period - 1) + 1
        return tuple(sorted({*range(step), *range(0, period, step)} | {period - 1}))

    def extend(chosen: list[int], seen: frozenset, size: int):
        if len(chosen) == size:
            return tuple(chosen) if len(seen) == period else None
        left = size - len(chosen)
        if len(seen) + left * (left - 1 + 2 * len(chosen)) < period:
            return None
        for r in range(chosen[-1] + 1, period):
            new = seen | {(r - c) % period for c in chosen} | {(c - r) % period for c in chosen}
            found = extend([*chosen, r], new, size)
            if found:
                return found
        return None

    size = max(1, math.ceil((1 + math.sqrt(4 * period - 3)) / 2))
    while True:
        found = extend([0], frozenset([0]), size)
        if found:
            return found
        size += 1


def word_hashes(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets of each text's words, and both halves of the words' 128-bit hashes; each different word is hashed once."""
    import pyarrow.compute as pc
    import xxhash

    words = pc.ascii_split_whitespace(texts)
    flat = words.flatten()
    sizes = pc.binary_length(flat)
    if pc.any(pc.equal(sizes, 0)).as_py():  # an empty string stands at either end of a text that white space begins or ends
        kept = np.flatnonzero(sizes.to_numpy(zero_copy_only=False) > 0)
        ends = np.searchsorted(kept, words.offsets.to_numpy() - words.offsets[0].as_py())
        flat = flat.take(kept)
    else:
        ends = words.offsets.to_numpy().astype(np.int64) - words.offsets[0].as_py()
    coded = flat.dictionary_encode()
    known = np.frombuffer(
        b"".join([xxhash.xxh3_128_digest(w) for w in coded.dictionary.to_pylist()]), dtype=">u8"
    ).astype(np.uint64).reshape(-1, 2)
    at = coded.indices.to_numpy(zero_copy_only=False)
    return ends.astype(np.int64), known[at, 0], known[at, 1]


def window_names(hashes: np.ndarray, starts: np.ndarray, length: int, family: int) -> np.ndarray:
    """The 64-bit name of the ``length`` words from each start: a polynomial of word hashes, from its prefix sums."""
    base = _BASES[family]
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(len(hashes), base, dtype=np.uint64), dtype=np.uint64)
        sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(hashes * powers, dtype=np.uint64)))
        del powers
        back = np.cumprod(np.full(len(hashes), pow(base, -1, 1 << 64), dtype=np.uint64), dtype=np.uint64)
        name = (sums[starts + length] - sums[starts]) * back[starts]
        name ^= name >> np.uint64(32)
        return (name * np.uint64(0xD6E8FEB86659FD93)).view(np.int64)


def merged(first: np.ndarray, last: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs [first, last] of each text united where they touch; ordered by text and place."""
    if not len(first):
        return first, last, text
    order = np.lexsort((first, text))
    first, last, text = first[order], last[order], text[order]
    shift = text * (int(last.max()) + 3)  # texts far apart on one line
    reach = np.maximum.accumulate(last + shift)
    new = np.concatenate(([True], first[1:] + shift[1:] > reach[:-1] + 1))
    begin = np.flatnonzero(new)
    return first[begin], (reach - shift)[np.concatenate((begin[1:], [len(first)])) - 1], text[begin]


def _split_known(names: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Of equal names in a batch: one representative each, and all that are not alone."""
    order = np.lexsort(names)
    same = np.ones(max(0, len(order) - 1), dtype=bool)
    for name in names:
        same &= name[order][1:] == name[order][:-1]
    follows = np.concatenate(([False], same))
    return order[~follows], order[follows | np.concatenate((same, [False]))]


def _named(texts: DataFrame, columns: int, one: Callable) -> DataFrame:
    """Rows (name0.., known, k1, k2, first, last) that ``one`` makes from a batch's offsets, hashes and runs.

    ``one`` gives the text, place, names and run of each window. What occurs twice in a batch is known to repeat and is
    sent as united runs; each name is sent once per batch, so a string that stands everywhere costs a row per batch.
    """

    def run(batches) -> Iterator[dict]:
        for batch in pieces(batches):
            ends, h1, h2 = word_hashes(batch.column("text"))
            text, first, last, names = one(batch, ends, h1, h2)
            if not len(text):
                continue
            alone, twice = _split_known(names)
            f, e, t = merged(first[twice], last[twice], text[twice])
            k1, k2 = (batch.column(c).to_numpy() for c in ("k1", "k2"))
            rng = np.random.default_rng(int(k1[0]) & 0xFFFFFFFF)
            spread = rng.integers(-(2**63), 2**63, len(f))
            to = np.concatenate((text[alone], t))
            out = {f"name{i}": np.concatenate((n[alone], spread)) for i, n in enumerate(names)}
            yield out | {
                "known": np.arange(len(to)) >= len(alone), "k1": k1[to], "k2": k2[to],
                "first": np.concatenate((first[alone], f)).astype(np.int32),
                "last": np.concatenate((last[alone], e)).astype(np.int32),
            }

    schema = "".join(f"name{i} long, " for i in range(columns)) + "known boolean, " + _RUN
    return map_batches(texts, run, schema)


def _repeated(rows: DataFrame, columns: int) -> DataFrame:
    """(of1, of2, runs): per text the runs of rows whose name another row has, or that are known to repeat.

    Rows that are known to repeat are spread by a made-up name, and a name has a row per batch at most.
    """
    same = Window.partitionBy(*[f"name{i}" for i in range(columns)], "known")
    found = rows.withColumn("n", F.count("*").over(same)).filter("n > 1 OR known")
    return found.groupBy(F.col("k1").alias("of1"), F.col("k2").alias("of2")).agg(
        F.collect_list(F.struct("first", "last")).alias("runs")
    )


def _anchors(length: int, period: int) -> Callable:
    cover, size = np.array(difference_cover(period)), length - period + 1
    in_cover = np.isin(np.arange(period), cover)

    def one(batch, ends, h1, h2):
        n = np.diff(ends)
        usable = np.maximum(n - size + 1, 0) * (n >= length)  # windows of a text long enough
        text = np.repeat(np.arange(len(n)), usable)
        at = ragged(np.zeros(len(n), dtype=np.int64), usable)
        keep = in_cover[at % period]
        text, at = text[keep], at[keep]
        name = window_names(h1, ends[text] + at, size, 0)
        return text, np.maximum(at - period + 1, 0), np.minimum(at, n[text] - length), [name]

    return one


def _runs_of(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First, last and row of the runs in a list column, united."""
    offsets = column.offsets.to_numpy()
    inner = column.flatten()
    text = np.repeat(np.arange(len(column)), np.where(column.is_valid().to_numpy(zero_copy_only=False), np.diff(offsets), 0))
    first, last = (inner.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
    return merged(first, last, text)


def _windows(length: int) -> Callable:
    def one(batch, ends, h1, h2):
        first, last, text = _runs_of(batch.column("runs"))
        text = np.repeat(text, last - first + 1)
        at = ragged(first, last - first + 1)
        starts = ends[text] + at
        return text, at, at, [window_names(h, starts, length, i) for i, h in enumerate((h1, h2))]

    return one


def _keyed(docs: DataFrame, text_col: str) -> tuple:
    """A text's two 64-bit hashes; null is empty."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    return text.alias("text"), F.xxhash64(F.lit(1), text).alias("k1"), F.xxhash64(F.lit(2), text).alias("k2")


class _Texts:
    """Every different text once, with its number of rows, in buckets of its key; the table goes after use."""

    def __init__(self, docs: DataFrame, text_col: str):
        self.spark, self.name = docs.sparkSession, f"words_{uuid.uuid4().hex}"
        text, k1, k2 = _keyed(docs, text_col)
        grouped = docs.select(text, k1, k2).groupBy("k1", "k2").agg(F.count("*").alias("n"), F.first("text").alias("text"))
        total = docs.agg(F.sum(F.octet_length(docs[text_col].cast("string")))).first()[0] or 0
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        count = max(1, parts, math.ceil(total / _BUCKET_BYTES))
        if count > parts:
            grouped = grouped.repartition(count, "k1", "k2")
        grouped.write.format("parquet").option("compression", "zstd").bucketBy(count, "k1", "k2").option(
            "path", scratch_path(self.spark, "words")
        ).saveAsTable(self.name)

    def __enter__(self) -> DataFrame:
        return self.spark.table(self.name)

    def __exit__(self, *_) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def _with_runs(texts: DataFrame, runs: DataFrame, how: str) -> DataFrame:
    return texts.join(runs, (texts["k1"] == runs["of1"]) & (texts["k2"] == runs["of2"]), how)


def _repeated_starts(texts: DataFrame, length: int, period: int) -> DataFrame:
    """(of1, of2, runs): per text the runs of starts of windows that occur in another text or elsewhere in this one."""
    anchors = _named(texts.select("k1", "k2", "text"), 1, _anchors(length, period))
    found = materialize(_repeated(anchors, 1))
    joined = _with_runs(texts, found, "inner").select("k1", "k2", "text", "runs")
    return materialize(_repeated(_named(joined, 2, _windows(length)), 2))


def _checked(length: int, period: int | None) -> int:
    period = period or max(1, round(0.6 * length))
    if length < 1 or not 1 <= period <= length:
        raise ValueError("length must be 1 or more, and the period between 1 and the length")
    return period


def _kept_words(batch, length: int) -> Iterator[tuple[list[str], np.ndarray, int]]:
    """Per text: its words, which of them stay, and how many go."""
    import pyarrow.compute as pc

    first, last, text = _runs_of(batch.column("runs"))
    bounds = np.searchsorted(text, np.arange(batch.num_rows + 1))
    several = batch.column("n").to_numpy() > 1
    for i, words in enumerate(pc.ascii_split_whitespace(batch.column("text")).to_pylist()):
        if words and not words[0]:
            words = words[1:]
        if words and not words[-1]:
            words = words[:-1]
        cut = np.zeros(len(words) + 1, dtype=np.int64)
        if several[i] and len(words) >= length:
            cut[0] = 1
        a, b = first[bounds[i] : bounds[i + 1]], last[bounds[i] : bounds[i + 1]]
        np.add.at(cut, a, 1)
        np.add.at(cut, b + length, -1)
        stay = np.cumsum(cut[:-1]) == 0
        yield words, stay, len(words) - int(stay.sum())


def _results(docs: DataFrame, length: int, period: int, text_col: str, schema: str, one: Callable) -> DataFrame:
    """A row of ``schema`` per different text, keyed by (k1, k2), written."""
    with _Texts(docs, text_col) as texts:
        joined = _with_runs(texts, _repeated_starts(texts, length, period), "left").select("k1", "k2", "n", "text", "runs")

        def run(batches) -> Iterator[dict]:
            for batch in pieces(batches):
                found = [one(*x) for x in _kept_words(batch, length)]
                yield {"k1": batch.column("k1"), "k2": batch.column("k2")} | {
                    name: list(values) for name, values in zip(names, zip(*found), strict=True)
                }

        names = [c.split()[0] for c in schema.split(", ")]
        return materialize(map_batches(joined, run, "k1 long, k2 long, " + schema))


def measure(
    docs: DataFrame, length: int = LENGTH, period: int | None = PERIOD, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256), one row per row of ``docs``.

    A word, a run of characters other than space and the controls 9 to 13, goes if one of the ``length``-word windows over
    it has a word sequence that also starts elsewhere, in another row or in the same one. All windows are judged on the
    input, so each occurrence of a passage goes, the first too. Rows with equal texts, whatever their ids, are documents
    each, so all their windows repeat. A null text is empty and has no words; a null id is kept as it is; texts of fewer
    words than a window stay whole; an empty table gives an empty result. A text is held by one task, of any length.
    """

    def one(words, stay, removed):
        kept = " ".join([w for w, s in zip(words, stay) if s] if removed else words)
        return len(words), removed, hashlib.sha256(kept.encode("utf-8", "surrogatepass")).hexdigest()

    found = _results(docs, length, _checked(length, period), text_col, "n_words long, n_removed long, kept_sha256 string", one)
    keys = docs.select(docs[id_col].cast("long").alias("doc_id"), *_keyed(docs, text_col)[1:])
    return join_null_safe(keys, found, ["k1", "k2"], "inner").drop("k1", "k2")


def remove(
    docs: DataFrame, length: int = LENGTH, period: int | None = PERIOD, text_col: str = "text"
) -> DataFrame:
    """``docs`` without the repeated words, see ``measure``; rows and columns as given.

    Where words go, the kept ones are joined by one space; other texts, nulls too, stay as they are.
    """

    def one(words, stay, removed):
        return removed, " ".join([w for w, s in zip(words, stay) if s]) if removed else None

    found = _results(docs, length, _checked(length, period), text_col, "removed long, kept string", one)
    found = found.filter("removed > 0").select(F.col("k1").alias("_of1"), F.col("k2").alias("_of2"), F.col("kept").alias("_kept"))
    _, k1, k2 = _keyed(docs, text_col)
    joined = docs.join(found, (k1 == found["_of1"]) & (k2 == found["_of2"]), "left")
    return joined.select(*[
        F.when(found["_of1"].isNotNull(), found["_kept"]).otherwise(docs[c]).alias(c) if c == text_col else docs[c]
        for c in docs.columns
    ])
