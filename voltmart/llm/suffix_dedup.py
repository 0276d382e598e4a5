"""Removal of repeated byte strings by prefix doubling over sampled suffixes.

Names (64-bit ranks) of the prefixes of 1, 2, 4, ... bytes at every position are built by doubling: the name of 2m bytes
is made from the pair of names of m bytes at offsets 0 and m. Spark sorts (name, position) pairs at growing lengths and
drops what is unique, until the threshold is passed:

1. *Anchors.* Every ``length``-byte string is represented by the smallest name of a short prefix inside it (leftmost of
   equals), so equal strings have equal anchors at equal offsets, and one sorted row stands for the run of consecutive
   strings with that anchor. Anchors whose name is unique are dropped: none of their strings repeats.
2. *Contexts.* Rows with the same anchor name are sorted by the name of the whole run of bytes their strings cover. All
   but the earliest row of a context repeat it string by string.
3. *Cores.* Only the earliest rows of anchors with several contexts are left. Their runs are cut, at equal distances from
   the anchor, into blocks of a few strings; a block is named by the bytes that all its strings share, a little less than
   ``length``. Unique cores are dropped, and equal contexts of a core decided, as before.
4. *Full length.* Only the earliest rows of cores with several contexts are left. Each of their strings gets its own
   (name, position) row, and all but the earliest position of a name is a repeat.

Names of two independent families are compared together wherever a repeat is decided.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

from voltmart.llm.common import encoded, id_text, map_batches, pieces, ragged
from voltmart.session import materialize, scratch_path

LENGTH = 100

#: Bits of a packed position: 31 of the start, 11 of the anchor's distance from it, 11 of the number of further starts.
_RUN_BITS, _FAR_BITS, _START_BITS = 11, 11, 31
_RUN, _FAR = (1 << _RUN_BITS) - 1, (1 << _FAR_BITS) - 1
_LOW_BITS = _RUN_BITS + _FAR_BITS
#: Strings per block.
_CORE = 8
#: Bytes of text whose names are built at once, to stay in the processor's cache.
_BLOCK = 200_000


def _doubled(raw: np.ndarray, sizes: list[int], family: int) -> list[np.ndarray]:
    """Names of the prefixes of each of ``sizes`` (powers of two, ascending) at each position of ``raw``."""
    table = np.random.default_rng(family).integers(1, 2**63, 256, dtype=np.uint64)
    multiply = np.uint64(0x9E3779B97F4A7C15 if family == 1 else 0xC2B2AE3D27D4EB4F)
    names, m, found = table[raw], 1, []
    while True:
        if m in sizes:
            found.append(names)
        if m >= sizes[-1]:
            return found
        if len(names) <= m:
            return found + [names[:0]] * (len(sizes) - len(found))
        pair = names[:-m] * multiply
        pair ^= pair >> np.uint64(29)
        pair += names[m:]
        pair *= np.uint64(0xBF58476D1CE4E5B9)
        pair ^= pair >> np.uint64(32)
        names, m = pair, 2 * m


def _mixed(parts: list[np.ndarray]) -> np.ndarray:
    total = np.zeros(len(parts[0]), dtype=np.uint64)
    for part in parts:
        total ^= part.astype(np.uint64)
        total *= np.uint64(0xFF51AFD7ED558CCD)
        total ^= total >> np.uint64(33)
    return total


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost smallest of each ``width`` consecutive values."""
    least, at, m = values, np.arange(len(values), dtype=np.int32), 1
    while m < width:
        step = min(m, width - m)
        right = least[step:] < least[: len(least) - step]
        at = np.where(right, at[step:], at[: len(at) - step])
        least = np.minimum(least[step:], least[: len(least) - step])
        m += step
    return at


def _docs_in_blocks(raws: list[bytes], length: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(row, start, bytes) blocks of each text of at least ``length`` bytes, overlapping by ``length`` - 1."""
    for row, raw in enumerate(raws):
        if len(raw) >= length:
            whole = np.frombuffer(raw, dtype=np.uint8)
            for start in range(0, len(raw) - length + 1, _BLOCK):
                yield row, start, whole[start : start + _BLOCK + length - 1]


def _joined_blocks(raws: list[bytes], length: int):
    """Blocks of several short texts: bytes of all, and for each position its row and start, -1 where none begins."""
    rows, starts, parts, total = [], [], [], 0
    for row, start, part in _docs_in_blocks(raws, length):
        if total and total + len(part) > _BLOCK:
            yield np.concatenate(parts), np.array(rows), np.array(starts), np.array([len(p) for p in parts])
            rows, starts, parts, total = [], [], [], 0
        rows.append(row)
        starts.append(start)
        parts.append(part)
        total += len(part)
    if parts:
        yield np.concatenate(parts), np.array(rows), np.array(starts), np.array([len(p) for p in parts])


def anchor_rows(raws: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """Row, anchor name, context name, first start, run and anchor's distance of all texts, by row and start."""
    found = []
    for raw, rows, starts, sizes in _joined_blocks(raws, length):
        names, contexts, first, run, far = _anchors(raw, sizes, length)
        part = np.searchsorted(np.cumsum(sizes), first, side="right")
        begin = np.cumsum(sizes) - sizes
        found.append((rows[part], names, contexts, starts[part] + first - begin[part], run, far))
    if not found:
        none = np.zeros(0, dtype=np.int64)
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none, none
    return tuple(np.concatenate(c) for c in zip(*found))


def _anchors(raw: np.ndarray, sizes: np.ndarray, length: int):
    """Anchor name, context name, first start, number of starts and anchor's distance of each run of strings with one anchor.

    ``raw`` joins parts of the given sizes; strings that cross parts are left out.
    """
    gram = 1 << max(0, (2 * length // 5).bit_length() - 1)
    half = 1 << (length.bit_length() - 1)
    (short,), (long,) = _doubled(raw, [gram], 1), _doubled(raw, [half], 2)
    at = _least(short, length - gram + 1)[: len(raw) - length + 1]
    ends = np.cumsum(sizes)
    valid = ragged(ends - sizes, sizes - length + 1)
    at = at[valid]
    new = np.flatnonzero((np.diff(at) != 0) | (np.diff(valid) != 1)) + 1
    index = np.concatenate(([0], new))
    first, run = valid[index], np.diff(np.concatenate((index, [len(valid)])))
    size = run + length - 1
    offsets = [first + np.minimum(j * half, size - half) for j in range(4)]
    context = _mixed([*(long[o] for o in offsets), size, at[index] - first])
    return short[at[index]], context, first, run, at[index] - first


def names_at(raw: bytes, starts: np.ndarray, sizes: np.ndarray, family: int) -> np.ndarray:
    """Names of the strings of ``sizes`` bytes at ``starts`` of one text; the largest size is below twice the least."""
    out = np.zeros(len(starts), dtype=np.uint64)
    if not len(starts):
        return out
    half, most = 1 << (int(sizes.min()).bit_length() - 1), int(sizes.max())
    whole, order = np.frombuffer(raw, dtype=np.uint8), np.argsort(starts, kind="stable")
    bounds = np.searchsorted(starts[order], np.arange(0, len(raw) + _BLOCK, _BLOCK))
    for k, (low, high) in enumerate(zip(bounds[:-1], bounds[1:])):
        if high > low:
            begin, rows = k * _BLOCK, order[low:high]
            (names,) = _doubled(whole[begin : begin + _BLOCK + most - 1], [half], family)
            here, size = starts[rows] - begin, sizes[rows]
            out[rows] = _mixed([*(names[here + np.minimum(j * half, size - half)] for j in range(4)), size])
    return out


def _pack(starts: np.ndarray, far, runs) -> np.ndarray:
    return (starts.astype(np.int64) << _FAR_BITS | far) << _RUN_BITS | runs


def _tagged(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id``, ``text`` and ``tag``, the text's hash: id and tag name a document, as ids may be null or repeated."""
    return id_text(docs, id_col, text_col).withColumn("tag", F.xxhash64("text"))


def _firsts(one: np.ndarray, two: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of rows in order of position: indexes of the first row of each (one, two), and of the later rows.

    Later rows of the same document and position (``same``: a number of both) are in neither.
    """
    order = np.lexsort((two, one))
    a, b, s = one[order], two[order], same[order]
    new = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))[: len(order)]
    leader = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    later = ~new & (s != s[leader])
    return np.sort(order[new]), np.sort(order[later])


def _in_order(batch) -> tuple[list, np.ndarray, np.ndarray, list[bytes], np.ndarray]:
    """Columns of a batch ordered by id (nulls first) and tag, and a number for each different (id, tag)."""
    ids, tags = batch.column("doc_id").to_pylist(), batch.column("tag").to_pylist()
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, tags[i]))
    texts = batch.column("text")
    keys = [(ids[i], tags[i]) for i in order]
    number = np.cumsum([0] + [a != b for a, b in zip(keys[1:], keys)]) if keys else np.zeros(0, dtype=np.int64)
    return [k[0] for k in keys], np.array([k[1] for k in keys], dtype=np.int64), order, [
        encoded(texts[i].as_py()) for i in order
    ], number


def _sampled(rows: DataFrame, length: int) -> DataFrame:
    """Anchor rows (gram, context, doc_id, tag, position); repeats inside a batch come as runs of starts with a null gram."""

    def run(batches) -> Iterator[dict]:
        for batch in pieces(batches):
            ids, tags, _, raws, number = _in_order(batch)
            row, gram, context, first, size, far = anchor_rows(raws, length)
            same = (number[row] << _START_BITS) | first if len(row) else row
            lead, later = _firsts(gram, context, same)
            spans = _runs(number[row[later]], row[later], first[later], size[later])
            packed = _pack(first[lead], far[lead], size[lead] - 1)
            none = [None] * len(spans[0])
            yield {
                "gram": [*gram[lead].view(np.int64).tolist(), *none],
                "context": np.concatenate((context[lead].view(np.int64), spans[2])),
                "doc_id": [ids[r] for r in (*row[lead], *spans[0])],
                "tag": tags[np.concatenate((row[lead], spans[0]))],
                "position": np.concatenate((packed, _pack(spans[1], 0, 0))),
            }

    return map_batches(rows, run, "gram long, context long, doc_id long, tag long, position long")


def _runs(number, row, first, size):
    """Rows, first and last starts of the maximal runs of neighbouring starts of one document."""
    if not len(row):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    order = np.lexsort((first, number))
    number, row, first, last = number[order], row[order], first[order], (first + size - 1)[order]
    new = np.flatnonzero((np.diff(number) != 0) | (first[1:] != last[:-1] + 1)) + 1
    begin, end = np.concatenate(([0], new)), np.concatenate((new, [len(row)])) - 1
    return row[begin], first[begin], last[end]


def _column(batch, name: str, missing: int = -(2**63)) -> np.ndarray:
    return batch.column(name).fill_null(missing).to_numpy(zero_copy_only=False)


def _resolved(sorted_rows: DataFrame) -> DataFrame:
    """Streams rows sorted by gram, context, document and position; holds one row per open group.

    kind 0: a repeated run of starts (first in position, last in ``last``). kind 1: the earliest row of a context whose
    anchor has other contexts as well.
    """
    lowest = -(2**63)

    def run(batches) -> Iterator[dict]:
        leader, reported = None, False  # the earliest row of the open context, and whether it went out as kind 1
        for batch in batches:
            gram, context = _column(batch, "gram"), _column(batch, "context")
            doc, tag, at = (_column(batch, c) for c in ("doc_id", "tag", "position"))
            known = batch.column("gram").is_valid().to_numpy(zero_copy_only=False)
            out = [(doc[~known], tag[~known], at[~known], context[~known], 0)]
            rows = np.stack((gram, context, doc, tag, at), axis=1)[known]
            carried = leader is not None
            if carried:
                rows = np.concatenate((leader[None, :], rows))
            if len(rows):
                g, c = rows[:, 0], rows[:, 1]
                new = np.concatenate(([True], (g[1:] != g[:-1]) | (c[1:] != c[:-1])))
                lead = np.maximum.accumulate(np.where(new, np.arange(len(rows)), 0))
                runs = rows[~new & (rows[:, 2:] != rows[lead, 2:]).any(axis=1)]
                out.append((*runs[:, 2:].T, _start(runs[:, 4]) + (runs[:, 4] & _RUN), 0))
                heads = np.flatnonzero(new)
                same = g[heads[1:]] == g[heads[:-1]]
                several = np.concatenate((same, [False])) | np.concatenate(([False], same))
                before, reported = reported and carried, several[-1] or (reported and carried and len(heads) == 1)
                leader = rows[heads[-1]].copy()
                several[0] &= not before
                found = rows[heads[several]]
                out.append((*found[:, 2:].T, np.zeros(len(found), dtype=np.int64), 1))
            docs = np.concatenate([o[0] for o in out])
            yield {
                "doc_id": [None if d == lowest else d for d in docs.tolist()],
                "tag": np.concatenate([o[1] for o in out]),
                "position": np.concatenate([o[2] for o in out]),
                "last": np.concatenate([o[3] for o in out]),
                "kind": np.concatenate([np.full(len(o[0]), o[4], dtype=np.int32) for o in out]),
            }

    return map_batches(sorted_rows, run, "doc_id long, tag long, position long, last long, kind int")


def _start(position):
    return position >> _LOW_BITS


def _sorted_by_name(rows: DataFrame) -> DataFrame:
    """Equal names meet in one partition, in order of position; finished runs (no name) are spread."""
    where = F.coalesce("gram", F.xxhash64("doc_id", "tag", "position"))
    return rows.repartition(where).sortWithinPartitions("gram", "context", "doc_id", "tag", "position")


def _by_key(rows: DataFrame) -> DataFrame:
    """(key, doc_id, tag, z) of all documents as a table in buckets of ``key``, a hash of id and tag.

    Each pass joins its few rows with this table where it lies; z holds the text compressed. The table's files are in the
    shared folder.
    """

    def run(batches) -> Iterator[dict]:
        import zstandard

        tool = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            yield {
                "key": batch.column("key"), "doc_id": batch.column("doc_id"), "tag": batch.column("tag"),
                "z": [tool.compress(encoded(t.as_py())) for t in batch.column("text")],
            }

    spark = rows.sparkSession
    count = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keyed = map_batches(
        rows.select(_key("doc_id", "tag").alias("key"), "doc_id", "tag", "text"), run, "key long, doc_id long, tag long, z binary"
    )
    name = f"texts_{uuid.uuid4().hex}"
    keyed.repartition(count, "key").write.format("parquet").bucketBy(count, "key").option(
        "path", scratch_path(spark, "texts")
    ).saveAsTable(name)
    return spark.table(name)


def _key(doc_id: str, tag: str):
    return F.xxhash64(F.coalesce(doc_id, F.lit(0)), F.col(doc_id).isNull(), tag)


def _raw(batch) -> list[bytes]:
    import zstandard

    tool = zstandard.ZstdDecompressor()
    return [tool.decompress(z.as_py()) for z in batch.column("z")]


def _with_text(texts: DataFrame, wanted: DataFrame, how: str = "inner") -> DataFrame:
    """``texts`` with the rows of ``wanted`` (of_id, of_tag, ...) for the same document."""
    wanted = wanted.withColumn("of_key", _key("of_id", "of_tag"))
    same = F.expr("((doc_id IS NULL AND of_id IS NULL) OR doc_id = of_id) AND (tag ^ of_tag) = 0")
    return texts.join(wanted, (texts["key"] == wanted["of_key"]) & same, how)


def _finer(texts: DataFrame, open_runs: DataFrame, one) -> DataFrame:
    """Rows as of ``_sampled`` that ``one`` makes from a text and the packed positions of its open runs."""
    wanted = open_runs.groupBy(F.col("doc_id").alias("of_id"), F.col("tag").alias("of_tag")).agg(
        F.collect_list("position").alias("positions")
    )
    joined = _with_text(texts, wanted).select("doc_id", "tag", "z", "positions")

    def run(batches) -> Iterator[dict]:
        for batch in batches:
            ids, tags = batch.column("doc_id").to_pylist(), batch.column("tag").to_pylist()
            for i, raw in enumerate(_raw(batch)):
                gram, context, starts, runs = one(raw, batch.column("positions")[i].values.to_numpy())
                yield {
                    "gram": gram.view(np.int64), "context": context.view(np.int64), "doc_id": [ids[i]] * len(starts),
                    "tag": np.full(len(starts), tags[i], dtype=np.int64), "position": _pack(starts, 0, runs - 1),
                }

    return map_batches(joined, run, "gram long, context long, doc_id long, tag long, position long")


def _cores(length: int):
    """Blocks of the open runs: core name, context name, first start and number of starts."""
    step = max(1, min(_CORE, length // 4))

    def one(raw: bytes, at: np.ndarray):
        first, size, far = _start(at), (at & _RUN) + 1, at >> _RUN_BITS & _FAR
        low, high = far - size + 1, far  # distances of the run's last and first start from the anchor
        count = high // step - low // step + 1
        row = np.repeat(np.arange(len(at)), count)
        block = ragged(low // step, count)
        near, away = np.maximum(block * step, low[row]), np.minimum(block * step + step - 1, high[row])
        anchor = first[row] + far[row]
        starts, runs, core = anchor - away, away - near + 1, anchor - block * step
        keep = np.unique(np.stack((starts, runs, block), axis=1), axis=0, return_index=True)[1]
        starts, runs, core, block = starts[keep], runs[keep], core[keep], block[keep]
        gram = _mixed([names_at(raw, core, np.full(len(core), length - step + 1), 1), block])
        return gram, _mixed([names_at(raw, starts, runs + length - 1, 2), core - starts]), starts, runs

    return one


def _singles(length: int):
    """Each string of the open runs by its names in both families."""

    def one(raw: bytes, at: np.ndarray):
        starts = np.unique(ragged(_start(at), (at & _RUN) + 1))
        sizes = np.full(len(starts), length)
        return names_at(raw, starts, sizes, 1), names_at(raw, starts, sizes, 2), starts, np.ones(len(starts), dtype=np.int64)

    return one


def repeats(rows: DataFrame, texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """(of_id, of_tag, spans): byte spans [start, end) to remove per document that has any; see ``measure`` for the rule."""
    if not 2 <= length <= 1000:
        raise ValueError("length must be between 2 and 1000")
    found = materialize(_resolved(_sorted_by_name(_sampled(rows, length))))
    cores = materialize(_resolved(_sorted_by_name(_finer(texts, found.filter("kind = 1"), _cores(length)))))
    singles = _resolved(_sorted_by_name(_finer(texts, cores.filter("kind = 1"), _singles(length))))
    low = F.shiftright("position", _LOW_BITS)
    spans = found.union(cores).union(singles).filter("kind = 0").select(
        F.col("doc_id").alias("of_id"), F.col("tag").alias("of_tag"),
        F.struct(low.alias("first"), (F.col("last") + length).alias("end")).alias("span"),
    )
    return materialize(spans.groupBy("of_id", "of_tag").agg(F.collect_list("span").alias("spans")))


def merged(spans: np.ndarray) -> np.ndarray:
    """Maximal runs of the union of [start, end) rows; touching spans form one run."""
    if not len(spans):
        return np.zeros((0, 2), dtype=np.int64)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate(([True], spans[1:, 0] > reach[:-1]))
    begin = np.flatnonzero(new)
    return np.stack((spans[begin, 0], reach[np.concatenate((begin[1:], [len(spans)])) - 1]), axis=1)


def _kept(raw: bytes, runs: np.ndarray) -> bytes:
    at, parts = 0, []
    for a, b in runs.tolist():
        parts.append(raw[at:a])
        at = b
    return b"".join([*parts, raw[at:]])


def _spans_of(value) -> np.ndarray:
    if not value.is_valid:
        return merged(np.zeros((0, 2), dtype=np.int64))
    inner = value.values
    return merged(np.stack([inner.field(k).to_numpy() for k in (0, 1)], axis=1))


def measure(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), one row per document.

    A byte goes if a ``length``-byte string that covers it also starts earlier: in a document of smaller id, or earlier
    in the same one. All strings are judged on the input; matches never cross documents. Null is empty; a null id comes
    before all others. Rows that share an id but not the text are documents ordered by a hash of the text; rows equal in
    both are one document, and each gets its result. An empty table gives an empty result.
    """
    rows = _tagged(docs, id_col, text_col)
    texts = _by_key(rows)
    joined = _with_text(texts, repeats(rows, texts, length), "left").select("doc_id", "z", "spans")

    def run(batches) -> Iterator[dict]:
        for batch in batches:
            raws = _raw(batch)
            runs = [_spans_of(v) for v in batch.column("spans")]
            yield {
                "doc_id": batch.column("doc_id"), "n_bytes": [len(r) for r in raws],
                "n_removed": [int((x[:, 1] - x[:, 0]).sum()) for x in runs], "n_spans": [len(x) for x in runs],
                "kept_sha256": [hashlib.sha256(_kept(r, x)).hexdigest() for r, x in zip(raws, runs)],
            }

    return map_batches(joined, run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def whole_characters(raw: bytes, runs: np.ndarray) -> np.ndarray:
    """``runs`` shrunk so that they begin and end between characters."""
    inside = (np.frombuffer(raw + b" ", dtype=np.uint8) & 0xC0) == 0x80
    out = []
    for a, b in runs.tolist():
        while a < b and inside[a]:
            a += 1
        while b > a and inside[b]:
            b -= 1
        if a < b:
            out.append((a, b))
    return np.array(out, dtype=np.int64).reshape(-1, 2)


def remove(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated bytes cut from the texts, whole characters only; rows and columns as given.

    A null text stays null; a text that is repeated throughout becomes empty.
    """
    rows = _tagged(docs, id_col, text_col)
    spans = repeats(rows, _by_key(rows), length)
    tag = F.xxhash64(docs[text_col].cast("string"))
    joined = docs.join(
        spans, docs[id_col].cast("long").eqNullSafe(spans["of_id"]) & (tag == spans["of_tag"]), "left"
    )

    @F.pandas_udf("string")
    def cut(texts, found):
        import pandas as pd

        out = []
        for text, value in zip(texts, found):
            raw = encoded(text)
            runs = merged(np.array([(x["first"], x["end"]) for x in value], dtype=np.int64).reshape(-1, 2))
            out.append(_kept(raw, whole_characters(raw, runs)).decode("utf-8", "surrogatepass"))
        return pd.Series(out, dtype=object)

    found = spans["spans"]
    return joined.select(*[
        F.when(found.isNull(), docs[c]).otherwise(cut(docs[c], F.coalesce(found, F.array()))).alias(c)
        if c == text_col else docs[c] for c in docs.columns
    ])
