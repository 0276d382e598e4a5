"""Token files: ids of whole texts, coded by an adaptive context-mixing range coder in independent, checksummed blocks.

Container layout, all little-endian: ``TOKD``, u32 documents, u32 blocks; per document i64 id, u8 "has an id", u32 tokens; per
block u32 tokens, u32 bytes, u32 crc32 of its ids and coded bytes; then the blocks' coded bytes. Documents are cut into blocks without regard to
their bounds. Each block starts from fresh models, so it can be decoded, and found to be damaged, on its own. Inside a block up
to 4,096 runs of ids, its lanes, are coded side by side with numpy; they share the models, which learn from all lanes.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from voltmart.llm.common import END_ID, id_text, map_batches, pieces
from voltmart.llm.encode import CACHE_WORDS, send_tokenizer, tokenizer_path, worker_encoder
from voltmart.session import materialize, scratch_path

BLOCK_TOKENS = 1 << 20
#: Blocks handed to the coder at a time; each has models of its own, so this changes no byte.
GROUP_BLOCKS = 16
#: Runs of consecutive ids of one block that are coded side by side, and the least length of a run.
LANES, LANE_TOKENS = 4096, 256
#: Ids per container, about; a longer document makes a longer one.
CONTAINER_TOKENS = 2_000_000
MAGIC = b"TOKD"

_ONE, _TWO = 1 << 16, 1 << 18  # slots of the tables of order-1 and order-2 predictions
_MIX_BITS, _ID_BITS = 11, 17  # scales of the weights of the orders, and of the order-0 frequencies
_BITS = _MIX_BITS + _ID_BITS
_SCALE = 1 << _ID_BITS
_ALL, _NEW = 1 << 16, (1 << 16) + 1  # entries behind those of the ids: all of order 0, and an id not yet counted
_KEYS = 128  # confidences of both orders, and whether they agree
_U = np.uint64
_TOP, _WORD = _U(1 << 32), _U(32)

#: What an id's confidence (0 to 7, plus 8 if it was right) becomes, less what it was; and whether another id takes its place.
_MOVE = np.array([0] + [-1] * 7 + [1] * 7 + [0], np.int64)
_SWAP = np.array([1] + [0] * 15, np.int64)
_MOVES, _SWAPS = (_MOVE, np.repeat(_MOVE << 3, 8)), (_SWAP, np.repeat(_SWAP, 8))  # of order 1, and of order 2 three bits higher


def _take(table: np.ndarray, at: np.ndarray) -> np.ndarray:
    return table.take(at, mode="wrap")  # no index is out of range; this mode alone is not checked


class _Models:
    """Predictions and counts of one block, learned from all its lanes. Both directions update it alike.

    Order 2 and order 1 predict the id that last followed the same two or one ids (by hash), each with a confidence. An id's
    probability mixes the three orders: that of order 2 for its id, that of order 1 for its own, and the rest shared out by
    order-0 frequencies of whole ids. The weights are learned for each pair of confidences. An id not yet counted has the
    share of new ids among the last ones, and its 16 bits follow. Weights and order-0 frequencies are counted anew after 1,
    2, 4, .. steps and then every 16 and 64 steps. The tables of both orders hold 64 times the id, plus the confidence in three bits.
    """

    def __init__(self, steps: int, lanes: int):
        self.one, self.two = np.zeros(_ONE, np.int64), np.zeros(_TWO, np.int64)
        self.ids = np.zeros((steps + 2, lanes), np.int64)  # two rows of zeros come first
        self.keys = np.zeros((steps, lanes), np.int16)
        self.marks = np.repeat(np.array([1, 1, 2], np.int64), _KEYS).reshape(3, _KEYS)
        self.counts, self.step, self.mixed, self.counted = np.zeros(1 << 16, np.int64), 0, 0, 0
        self.size, self.start = np.full(_NEW + 1, _SCALE, np.int64), np.zeros(_NEW + 1, np.int64)
        self.symbol, self.escape = np.full(_SCALE, _NEW, np.int32), 0
        self._mix()

    def _mix(self) -> None:
        """Weights of the three orders and their starts, for each key."""
        if self.step:
            self.marks += np.bincount(self.keys[self.mixed : self.step].ravel(), minlength=3 * _KEYS).reshape(3, _KEYS)
            self.mixed = self.step
        weights = 1 + self.marks * ((1 << _MIX_BITS) - 3) // self.marks.sum(axis=0)
        weights[2] = (1 << _MIX_BITS) - weights[0] - weights[1]
        self.weight, self.first = weights.ravel(), ((np.cumsum(weights, axis=0) - weights) << _ID_BITS).ravel()
        if self.step % 64 == 0:  # the newest symbols weigh most
            self.marks = self.marks + 1 >> 1

    def _count(self) -> None:
        """Order-0 frequencies of the ids so far."""
        new = np.bincount(self.ids[self.counted + 2 : self.step + 2].ravel(), minlength=1 << 16)
        fresh, n = int(np.count_nonzero(new[self.counts == 0])), int(new.sum())
        self.counted = self.step
        self.counts += new
        ids = np.flatnonzero(self.counts)
        counts = self.counts[ids]
        share = min(_SCALE // 4, max(1, _SCALE * fresh // (2 * n)))  # at most a quarter, so every id has a place
        size = 1 + counts * (_SCALE - len(ids) - share) // counts.sum()
        ends = np.cumsum(size)
        self.escape = int(ends[-1])
        self.size[:] = _SCALE - self.escape
        self.start[:] = self.escape
        self.size[ids], self.start[ids] = size, ends - size
        self.size[_ALL], self.start[_ALL] = _SCALE, 0
        self.symbol[: self.escape] = np.repeat(ids.astype(np.int32), size)
        self.symbol[self.escape :] = _NEW

    def predict(self, n: int) -> np.ndarray:
        """Key of the first ``n`` lanes."""
        self.last = self.ids[self.step + 1, :n]
        self.slot = self.last * 40503
        self.slot += self.ids[self.step, :n]
        self.slot &= _TWO - 1
        self.by_one, self.by_two = _take(self.one, self.last), _take(self.two, self.slot)
        key = self.by_one | self.by_two
        key &= 63
        agree = (self.by_one ^ self.by_two) < 64
        key += agree.astype(np.int64) << 6
        return key

    def hits(self, now: np.ndarray) -> None:
        self.cells = now << 6
        self.hit_one, self.hit_two = (self.by_one ^ self.cells) < 64, (self.by_two ^ self.cells) < 64

    def update(self, key: np.ndarray) -> None:
        for table, at, old, hit, place, move, swap in (
            (self.one, self.last, self.by_one, self.hit_one, 0, _MOVES[0], _SWAPS[0]),
            (self.two, self.slot, self.by_two, self.hit_two, 3, _MOVES[1], _SWAPS[1]),
        ):
            state = hit.astype(np.int64)
            state <<= place + 3
            state |= old & (7 << place)
            other = self.cells - old
            other *= _take(swap, state)
            other += _take(move, state)
            other += old
            table[at] = other  # of equal slots the last lane's stays
        self.keys[self.step, : len(key)] = key
        if len(key) < self.keys.shape[1]:  # the last lane is shorter
            self.keys[self.step, len(key) :] = key[0]
        self.step += 1
        if self.step & (self.step - 1) == 0 or self.step % 16 == 0:
            self._mix()
            if self.step & (self.step - 1) == 0 or self.step % 64 == 0:
                self._count()


class _Writer:
    """Range coders of a block's lanes: 64-bit low and range, 32-bit words; carries are settled at the end.

    A reader takes each lane's first two words, and one more whenever a lane's range is small; as it does so where the writer
    shifts, words follow in that order, without lengths.
    """

    def __init__(self, lanes: int, steps: int):
        self.low, self.range = np.zeros(lanes, _U), np.full(lanes, (1 << 64) - 1, _U)
        self.words = 2 * steps + 4  # an id takes two words at most, its bits if it is not yet counted included
        self.out, self.used = np.zeros(lanes * self.words, _U), np.arange(lanes) * self.words
        self.begin, self.taken = self.used.copy(), []

    def code(self, rows: slice | np.ndarray, start: np.ndarray, size: np.ndarray, bits: int) -> None:
        """Narrows the coders of ``rows`` to the part from ``start`` of length ``size`` of ``2 ** bits``."""
        low, left, used = self.low[rows], self.range[rows], self.used[rows]
        left = left >> _U(bits)
        moved = start.view(_U) * left
        moved += low
        over = np.flatnonzero(moved < low)
        if len(over):
            self.out[used[over] - 1] += _U(1)
        left *= size.view(_U)
        small = np.flatnonzero(left < _TOP)
        if len(small):
            at, cut = used[small], moved[small]
            self.out[at] = cut >> _WORD
            self.taken.append(at)
            used[small] = at + 1
            moved[small] = cut << _WORD
            left[small] <<= _WORD
        self.low[rows], self.range[rows], self.used[rows] = moved, left, used

    def finish(self) -> bytes:
        end = self.low + (_TOP - _U(1))
        over = np.flatnonzero(end < self.low)
        self.out[self.used[over] - 1] += _U(1)
        self.out[self.used] = end >> _WORD
        words = self.out.reshape(-1, self.words)
        for k in range(int((self.used - self.begin).max()), 0, -1):
            words[:, k - 1] += words[:, k] >> _WORD
        at = np.concatenate([self.begin, self.begin + 1, *[at + 2 for at in self.taken]])
        return self.out[at].astype("<u4").tobytes()


class _Reader:
    def __init__(self, coded: bytes, lanes: int):
        self.words, self.used = np.frombuffer(coded, "<u4").astype(_U), 2 * lanes
        if len(self.words) < self.used:
            raise ValueError("the coded bytes are damaged")
        self.code = self.words[:lanes] << _WORD | self.words[lanes : self.used]
        self.range = np.full(lanes, (1 << 64) - 1, _U)

    def unit(self, rows: slice | np.ndarray, bits: int) -> np.ndarray:
        return self.range[rows] >> _U(bits)

    def take(self, rows: slice | np.ndarray, code: np.ndarray, left: np.ndarray) -> None:
        small = np.flatnonzero(left < _TOP)
        if len(small):
            words = self.words[self.used : self.used + len(small)]
            if len(words) < len(small):
                raise ValueError("the coded bytes are damaged")
            self.used += len(small)
            code[small] = code[small] << _WORD | words
            left[small] <<= _WORD
        self.code[rows], self.range[rows] = code, left


def _lanes(tokens: int) -> tuple[int, np.ndarray]:
    """Steps of a block, and the lanes that are open at each; only the last one may be shorter."""
    lanes = max(1, min(LANES, tokens // LANE_TOKENS))
    steps = -(-tokens // lanes)
    lanes = -(-tokens // steps)
    return lanes, np.where(np.arange(steps) < tokens - (lanes - 1) * steps, lanes, lanes - 1)


def encode_block(ids: np.ndarray) -> bytes:
    """Coded bytes of a block of ids below 65,536."""
    lanes, opened = _lanes(len(ids))
    steps = len(opened)
    models, out = _Models(steps, lanes), _Writer(lanes, steps)
    whole = np.zeros(steps * lanes, np.int64)
    whole[: len(ids)] = ids
    models.ids[2:] = whole.reshape(lanes, steps).T
    for step, n in enumerate(opened.tolist()):
        now, key = models.ids[step + 2, :n], models.predict(n)
        models.hits(now)
        symbol = (1 - models.hit_two.view(np.int8)) * (2 - models.hit_one.view(np.int8))  # order 2, order 1 or neither
        key += symbol.astype(np.int64) << 7
        entry = now - _ALL
        entry *= symbol >> 1
        entry += _ALL
        weight, within = _take(models.weight, key), _take(models.start, entry)
        start = within * weight
        start += _take(models.first, key)
        weight *= _take(models.size, entry)
        out.code(slice(0, n), start, weight, _BITS)
        new = np.flatnonzero(within == models.escape)
        new = new[entry[new] < _ALL]
        if len(new):
            out.code(new, now[new], np.ones(len(new), np.int64), 16)
        models.update(key)
    return out.finish()


def decode_block(coded: bytes, tokens: int) -> np.ndarray:
    """Ids of a block from its coded bytes; bytes that cannot be such raise ValueError."""
    lanes, opened = _lanes(tokens)
    steps = len(opened)
    models, source = _Models(steps, lanes), _Reader(coded, lanes)
    guesses, line = np.zeros((3, lanes), np.int64), np.arange(lanes)
    for step, n in enumerate(opened.tolist()):
        key, rows = models.predict(n), slice(0, n)
        unit, code = source.unit(rows, _BITS), source.code[rows]
        symbol = (code >= unit * _take(models.first, key + _KEYS).view(_U)).view(np.int8)
        symbol = symbol + (code >= unit * _take(models.first, key + 2 * _KEYS).view(_U)).view(np.int8)
        wide = symbol.astype(np.int64)
        key += wide << 7
        code = code - unit * _take(models.first, key).view(_U)
        unit *= _take(models.weight, key).view(_U)
        place = np.minimum(code // unit, _U(_SCALE - 1)).view(np.int64)
        found = _take(models.symbol, place)
        entry = found.astype(np.int64)
        entry -= _ALL
        entry *= symbol >> 1
        entry += _ALL
        code -= unit * _take(models.start, entry).view(_U)
        unit *= _take(models.size, entry).view(_U)
        source.take(rows, code, unit)
        np.right_shift(models.by_two, 6, out=guesses[0, :n])
        np.right_shift(models.by_one, 6, out=guesses[1, :n])
        guesses[2, :n] = found
        wide *= lanes
        wide += line[:n]
        now = models.ids[step + 2, :n]
        now[:] = _take(guesses.ravel(), wide)
        new = np.flatnonzero(entry == _NEW)
        if len(new):
            unit = source.unit(new, 16)
            value = np.minimum(source.code[new] // unit, _U(0xFFFF))
            source.take(new, source.code[new] - unit * value, unit)
            now[new] = value
        models.hits(now)
        models.update(key)
    return models.ids[2:].T.ravel()[:tokens].astype(np.uint32)


def write_container(doc_ids: list[int | None], raws: list[bytes], block_tokens: int = BLOCK_TOKENS) -> bytes:
    """One container of the documents' ids (u32 bytes each, end ids included)."""
    ids = np.frombuffer(b"".join(raws), "<u4")
    if len(ids) and ids.max() > 0xFFFF:
        raise ValueError("the coder takes ids below 65,536")
    blocks = [ids[i : i + block_tokens] for i in range(0, len(ids), block_tokens)]
    coded: list[bytes] = []
    for i in range(0, len(blocks), GROUP_BLOCKS):
        coded += [encode_block(block) for block in blocks[i : i + GROUP_BLOCKS]]
    head = [MAGIC, struct.pack("<II", len(raws), len(blocks))]
    head += [struct.pack("<qBI", d or 0, d is not None, len(r) // 4) for d, r in zip(doc_ids, raws)]
    head += [struct.pack("<III", len(b), len(c), zlib.crc32(c, zlib.crc32(b.tobytes()))) for b, c in zip(blocks, coded)]
    return b"".join(head + coded)


def read_container(data: bytes) -> tuple[list[int | None], list[bytes]]:
    """Document ids and u32 bytes of a container; a damaged block raises ValueError."""
    if data[:4] != MAGIC:
        raise ValueError("not a token container")
    n_docs, n_blocks = struct.unpack_from("<II", data, 4)
    docs = [struct.unpack_from("<qBI", data, 12 + 13 * i) for i in range(n_docs)]
    at = 12 + 13 * n_docs
    heads = np.frombuffer(data, "<u4", 3 * n_blocks, at).reshape(-1, 3).astype(np.int64)
    ends = at + 12 * n_blocks + np.cumsum(heads[:, 1])
    parts: list[bytes] = []
    for i, (tokens, size, crc) in enumerate(heads.tolist()):
        block = data[ends[i] - size : ends[i]]
        try:
            parts.append(decode_block(block, tokens).astype("<u4").tobytes())
        except ValueError as error:
            raise ValueError(f"block {i} is damaged") from error
        if zlib.crc32(block, zlib.crc32(parts[-1])) != crc:
            raise ValueError(f"block {i} is damaged")
    raw, raws, at = b"".join(parts), [], 0
    for _, _, n in docs:
        raws.append(raw[at : at + 4 * n])
        at += 4 * n
    return [d if known else None for d, known, _ in docs], raws


def write(
    docs: DataFrame, path: str, tokenizer: str | None = None, container_tokens: int = CONTAINER_TOKENS,
    id_col: str = "doc_id", text_col: str = "text", cache_words: int = CACHE_WORDS,
) -> None:
    """Token containers in ascending order of ids as rows (part, number, n_tokens, data) of Parquet files at ``path``.

    Null ids come first; a null or empty text is the end id alone. Rows that share an id (or have none) may be dealt to
    several tasks by their text's hash, in whose order they follow; repeated rows are stored each. A document lies whole in
    one container, so a very long text makes a longer one: it takes memory for its ids and coded bytes, not for more
    models. An empty table gives no container.
    """
    source = send_tokenizer(docs.sparkSession, tokenizer or tokenizer_path("word_bpe_49k.json"))
    ordered = id_text(docs, id_col, text_col).repartitionByRange("doc_id", F.xxhash64("text"))
    ordered = ordered.sortWithinPartitions("doc_id", F.xxhash64("text"))

    def run(batches) -> Iterator[dict]:
        from pyspark import TaskContext

        encoder, part = worker_encoder(source.value, cache_words), TaskContext.get().partitionId()
        ids, raws, size, number = [], [], 0, 0

        def row():
            return {"part": [part], "number": [number], "n_tokens": [size], "data": [write_container(ids, raws)]}

        for batch in pieces(batches, 8_000_000):
            found = encoder.encode_array(batch.column("text"))
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), found, strict=True):
                ids.append(doc_id)
                raws.append(raw + END_ID.to_bytes(4, "little"))
                size += len(raws[-1]) // 4
                if size >= container_tokens:
                    yield row()
                    ids, raws, size, number = [], [], 0, number + 1
        if ids:
            yield row()

    map_batches(ordered, run, "part int, number int, n_tokens long, data binary").write.parquet(path)


def read(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of all documents at ``path``; ids are u32 bytes, start counts all ids before."""
    return _read(spark, path, True)


def digest(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of all documents, decoded from the files at ``path``."""
    return _read(spark, path, False)


def _read(spark, path: str, with_ids: bool) -> DataFrame:
    files = spark.read.parquet(path)

    def run(batches) -> Iterator[dict]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, raws = read_container(batch.column("data")[i].as_py())
                sizes = np.array([len(r) // 4 for r in raws], dtype=np.int64)
                yield {
                    "part": [batch.column("part")[i]] * len(ids), "number": [batch.column("number")[i]] * len(ids),
                    "doc_id": ids, "within": np.cumsum(sizes) - sizes, "n_tokens": sizes,
                    **({"ids": raws} if with_ids else {"ids_crc32": [zlib.crc32(r) for r in raws]}),
                }

    kind = "ids binary" if with_ids else "ids_crc32 long"
    documents = map_batches(files, run, f"part int, number int, doc_id long, within long, n_tokens long, {kind}")
    sizes = files.select("part", "number", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # one row per written partition
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    bases = materialize(
        sizes.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(
            parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")), "part"
        ).select("part", "number", (F.col("base") + F.col("inside")).alias("base"))
    )
    return documents.join(bases, ["part", "number"]).select(
        "doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", kind.split()[0]
    )


def round_trip(docs: DataFrame, tokenizer: str | None = None, cache_words: int = CACHE_WORDS) -> DataFrame:
    """``digest`` of ``docs`` after writing them to a new folder of the shared directory."""
    path = scratch_path(docs.sparkSession, "tokens")
    write(docs, path, tokenizer, cache_words=cache_words)
    return digest(docs.sparkSession, path)
