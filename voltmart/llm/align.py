"""Alignment of two tokenizers over the same text: groups of tokens between common cuts, linked id pairs and their counts.

The tokenizers' own spans give coarse cuts: character offsets of the one, proto spans of the other. Where a token ends
within a character, or is one byte of a character that the vocabulary lacks, its decoded bytes give the exact place.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from itertools import chain, pairwise

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from voltmart.llm.common import id_text, map_batches, pieces, ragged, worker_cache
from voltmart.llm.encode import _RUNS, _SPACE_RUN, _WIDE, byte_alphabet, send_tokenizer, tokenizer_path
from voltmart.session import materialize

#: A worker's cache of aligned words is emptied when it holds this many.
CACHE_WORDS = 400_000
#: Tables of id pairs up to this size (16 bytes a pair) are sent to the tasks, larger ones are joined.
BROADCAST_PAIRS = 4_000_000

#: Before a single space that a non-space follows, and before a line break between non-spaces; neither vocabulary has a
#: token that goes on behind such a place.
_LINE = re.compile(r"(?<=[^\s᠎\x1c-\x1f])(?=\n[^\s᠎\x1c-\x1f])")
_CUT = re.compile(rf"(?<=[^ ])(?= [^\s᠎\x1c-\x1f])|{_LINE.pattern}")
#: What such cuts make, but for heads and tails of white space: any number of them joined is cut at the same places.
_WORD = re.compile(r"[ \n][^\s▁᠎\x1c-\x1f](?:[^▁]*[^\s▁᠎\x1c-\x1f])?")


class Aligner:
    """Tokens of both tokenizers with their byte ends, word by word where both vocabularies allow it."""

    def __init__(self, source: str, model: bytes):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2
        from tokenizers import Tokenizer

        shape = json.loads(source)
        self.a, self.b = Tokenizer.from_str(source), SentencePieceProcessor(model_proto=model)
        self.a.encode_special_tokens = True
        alphabet, added = byte_alphabet(), {t["content"] for t in shape["added_tokens"]}
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = token.encode() if token in added else bytes(alphabet[c] for c in token)
        self.b_byte = np.array([self.b.is_byte(i) for i in range(self.b.vocab_size())])
        names = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [
            bytes([int(n[1:-1], 16)]) if byte else n.replace("▁", " ").encode() for n, byte in zip(names, self.b_byte)
        ]
        self.a_sizes = np.array([len(x) for x in self.a_bytes])
        self.b_sizes = np.array([len(x) for x in self.b_bytes])
        spec = sentencepiece_model_pb2.ModelProto.FromString(model).normalizer_spec
        plain = shape["pre_tokenizer"]["type"] == "ByteLevel" and shape["normalizer"] is None
        self.by_word = (
            plain and not shape["pre_tokenizer"]["add_prefix_space"] and spec.name == "identity"
            and spec.add_dummy_prefix and not spec.remove_extra_whitespaces
            and not any("▁" in n.lstrip("▁") or "\n" in n for n in names)
        )
        self.marks: dict[str, tuple] = {}
        for mark in ".," if self.by_word else "":
            if not any(re.search(rf"[A-Za-z]\{mark}", n) for n in names):
                self._encode([" a", f" a{mark}"], [], found := {}, 1)
                first, both = found[" a"], found[f" a{mark}"]
                if both[0].startswith(first[0] + ";") and both[5].startswith(first[5]):
                    self.marks[mark] = (
                        both[0][len(first[0]) + 1 :], *[n - m for n, m in zip(both[1:5], first[1:5])], both[5][len(first[5]) :]
                    )

    def tokens(self, text: str) -> tuple | None:
        """(A ids, byte ends, B ids, byte ends) of a space and ``text``; None if either one's bytes are not those."""
        whole = " " + text
        raw = whole.encode("utf-8", "surrogatepass")
        found = self.a.encode(whole, add_special_tokens=False)
        a = np.array(found.ids, dtype=np.int64)
        spans = _rows([(p.id, p.begin, p.end) for p in self.b.encode(text, return_type="proto").pieces], 3)
        b = spans[:, 0]
        if b"".join([self.a_bytes[i] for i in found.ids]) != raw or b"".join([self.b_bytes[i] for i in b.tolist()]) != raw:
            return None
        span = _rows(found.offsets, 2)
        if len(raw) == len(whole):
            ends = span[:, 1]
        else:
            points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), dtype="<u4")
            width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
            ends = np.concatenate(([0], np.cumsum(width)))[span[:, 1]]
        inside = np.concatenate((span[1:, 0] < span[:-1, 1], [False]))  # the next token begins within the same character
        a_ends = _refined(ends, inside, self.a_sizes[a])
        return a, a_ends, b, _refined(1 + spans[:, 2], self.b_byte[b] & (spans[:, 1] == spans[:, 2]), self.b_sizes[b])

    def words(self, text: str) -> list[str]:
        """A space and the text, cut where both tokenizers cut."""
        whole = " " + text
        if not self.by_word:
            return [whole]
        runs = text[0] == " " or text[-1] == " " or any(run in text for run in _RUNS)
        if runs or not text.isascii() and _WIDE.search(text) and _SPACE_RUN.search(text):
            return _CUT.split(whole)
        words = [" " + w for w in text.split(" ")]
        if "\n" in text:
            words = [x for w in words for x in (_LINE.split(w) if "\n" in w else (w,))]
        return words

    def learn(self, words: Iterable[str], cache: dict, step: int = 1000) -> None:
        """Adds the alignment of each word to ``cache``; plain words are encoded together.

        A final stop or comma behind a letter is a token of its own in both vocabularies, so it is put to the word's record.
        """
        together, odd, marked = [], [], []
        for w in words:
            if w[-1] in self.marks and w[1:-1].isalpha() and w.isascii():
                marked.append(w)
                w = w[:-1]
                if w in cache:
                    continue
                cache[w] = None
            (together if self.by_word and _WORD.fullmatch(w) else odd).append(w)
        self._encode(list(dict.fromkeys(together)), odd, cache, step)
        for w in marked:
            stem, mark = cache[w[:-1]], self.marks[w[-1]]
            cache[w] = stem and (
                f"{stem[0]};{mark[0]}", *[n + m for n, m in zip(stem[1:5], mark[1:5])], stem[5] + mark[5]
            )

    def _encode(self, together: list[str], odd: list[str], cache: dict, step: int) -> None:
        lead = " a"  # so that a word may begin with a line break
        for i in range(0, len(together), step):
            part = [lead, *together[i : i + step]]
            found = self.tokens("".join(part)[1:])
            ends = np.cumsum([len(w.encode()) for w in part])
            if found is None or not (np.isin(ends, found[1]).all() and np.isin(ends, found[3]).all()):
                odd += part[1:]
                continue
            _, *records = _records(*found, ends)
            cache.update(zip(part[1:], records, strict=True))
        for w in odd:
            before = lead if w[0] == "\n" else ""
            found = self.tokens((before + w)[1:])
            ends = [2] * bool(before) + [0 if found is None else found[1][-1]]
            cache[w] = None if found is None else list(_records(*found, np.array(ends)))[-1]


def _rows(tuples: list[tuple], width: int) -> np.ndarray:
    return np.fromiter(chain.from_iterable(tuples), dtype=np.int64, count=width * len(tuples)).reshape(-1, width)


def _refined(coarse: np.ndarray, inside: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Byte ends: ``coarse`` but ``inside`` a character, where the decoded sizes since the last coarse cut count."""
    if not inside.any():
        return coarse
    total = np.cumsum(sizes)
    last = np.maximum.accumulate(np.where(inside, -1, np.arange(len(coarse))))
    known = last >= 0
    return np.where(known, coarse[last] + total - total[last], total)


def _records(a, a_ends, b, b_ends, ends) -> Iterator[tuple]:
    """Per word up to each of ``ends``: groups as text, numbers of A tokens, B tokens, groups and links, and the id pairs
    as bytes: A id, B id and links in 64 bits each."""
    common = np.intersect1d(a_ends, b_ends)
    a_cut, b_cut = np.searchsorted(a_ends, common, "right"), np.searchsorted(b_ends, common, "right")
    a_names, b_names = list(map(str, a.tolist())), list(map(str, b.tolist()))
    groups, i, k = [], 0, 0
    for j, m in zip(a_cut.tolist(), b_cut.tolist()):
        if j - i == 1 == m - k:
            groups.append(f"{a_names[i]}|{b_names[k]}")
        else:
            groups.append(",".join(a_names[i:j]) + "|" + ",".join(b_names[k:m]))
        i, k = j, m
    n_a, n_b = np.diff(a_cut, prepend=0), np.diff(b_cut, prepend=0)
    last = np.searchsorted(common, ends, "right")
    word = np.searchsorted(last, np.arange(len(common)), "right")
    totals = [np.diff(np.cumsum(n)[last - 1], prepend=0).tolist() for n in (n_a, n_b, np.ones_like(n_a), n_a * n_b)]
    at, left, right, times = _linked(a, n_a, b, n_b, word)
    pairs = np.stack((left, right, times), axis=1).astype("<i8").tobytes()
    cuts = (24 * np.searchsorted(at, np.arange(len(ends) + 1))).tolist()
    for (g, h), *counts, (x, y) in zip(pairwise([0, *last.tolist()]), *totals, pairwise(cuts), strict=True):
        yield ";".join(groups[g:h]), *counts, pairs[x:y]


def _linked(a, n_a, b, n_b, word) -> tuple:
    """(word, A id, B id, links) for the different id pairs of each group, ordered by word.

    Equal ids of a group are counted first, so a long group costs its different ids, not its links.
    """
    def counted(ids, sizes):
        group = np.repeat(np.arange(len(sizes)), sizes)
        width = int(ids.max(initial=0)) + 1
        keys, times = np.unique(group * width + ids, return_counts=True)
        return keys // width, keys % width, times

    ga, ia, ta = counted(a, n_a)
    gb, ib, tb = counted(b, n_b)
    first, size = np.searchsorted(gb, ga), np.searchsorted(gb, ga, "right") - np.searchsorted(gb, ga)
    with_b = ragged(first, size)
    with_a = np.repeat(np.arange(len(ga)), size)
    return word[ga[with_a]], ia[with_a], ib[with_b], ta[with_a] * tb[with_b]


_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


def align(
    docs: DataFrame, tokenizer: str | None = None, model: str | None = None, with_groups: bool = False,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, and the different linked id pairs
    as arrays a, b and links (how often). With ``with_groups``, also ``groups``: ``a1,a2|b1;a3|b2,b3``.

    Both tokenizers take a space and the whole text, A as it is and B by its own prefix; strings of special tokens are
    plain text. A text that is null, empty or not given back by the bytes of either tokenizer has no tokens: zeros, empty
    arrays and an empty string. Repeated rows and null ids are rows like any other; an empty table gives an empty result.
    A text's different id pairs are held by one task.
    """
    spark = docs.sparkSession
    source = send_tokenizer(spark, tokenizer or tokenizer_path("byte_bpe_50k.json"))
    with open(model or tokenizer_path("piece_bpe_32k.model"), "rb") as file:
        vocabulary = spark.sparkContext.broadcast(file.read())

    def run(batches) -> Iterator[dict]:
        kept = worker_cache(f"align-{hash((source.value, vocabulary.value))}")
        aligner = kept.setdefault("aligner", None) or Aligner(source.value, vocabulary.value)
        cache = kept.setdefault("words", {})
        kept["aligner"] = aligner
        for batch in pieces(batches, 4_000_000):
            texts = [aligner.words(t) if t else [] for t in batch.column("text").to_pylist()]
            if len(cache) > CACHE_WORDS:
                cache.clear()
            numbers: dict[str, int] = {}
            at = [[numbers.setdefault(w, len(numbers)) for w in words] for words in texts]
            aligner.learn([w for w in numbers if w not in cache], cache)
            yield {"doc_id": batch.column("doc_id")} | _digests([cache[w] for w in numbers], at, with_groups)

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in _COUNTS) + ", groups_sha256 string"
    schema += ", a array<int>, b array<int>, links array<long>" + ", groups string" * with_groups
    return map_batches(id_text(docs, id_col, text_col), run, schema)


def _digests(records: list[tuple | None], texts: list[list[int]], with_groups: bool) -> dict:
    """Columns of ``align`` for texts given as numbers of their words' records."""
    import pyarrow as pa

    bad = np.array([r is None for r in records] + [False])
    texts = [[] if bad[t].any() else t for t in texts]
    blank = ("", 0, 0, 0, 0, b"")
    records = [r or blank for r in records] or [blank]
    sizes = np.array([len(t) for t in texts])
    at = np.fromiter((i for t in texts for i in t), dtype=np.int64, count=int(sizes.sum()))
    text = np.repeat(np.arange(len(texts)), sizes)
    out = {}
    for k, name in enumerate(_COUNTS, 1):
        of = np.array([r[k] for r in records], dtype=np.int64)
        out[name] = _sums(of[at], sizes)
    groups = [";".join([records[i][0] for i in t]) for t in texts]
    out["groups_sha256"] = [hashlib.sha256(g.encode()).hexdigest() if t else "" for g, t in zip(groups, texts)]
    left, right, times = np.frombuffer(b"".join([r[5] for r in records]), dtype="<i8").reshape(-1, 3).T
    count = np.array([len(r[5]) // 24 for r in records])
    place = ragged((np.cumsum(count) - count)[at], count[at])
    width = int(right.max(initial=0)) + 1
    known, number = np.unique(left * width + right, return_inverse=True)
    key = np.repeat(text, count[at]) * max(1, len(known)) + number[place]
    order = np.argsort(key, kind="stable")
    key, begun = key[order], np.zeros(0, dtype=np.int64)
    if len(key):
        begun = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    total = np.add.reduceat(times[place][order], begun) if len(key) else np.zeros(0, dtype=np.int64)
    of_text, pair = key[begun] // max(1, len(known)), known[key[begun] % max(1, len(known))] if len(key) else begun
    offsets = pa.array(np.searchsorted(of_text, np.arange(len(texts) + 1)), type=pa.int32())
    for name, values, kind in (("a", pair // width, pa.int32()), ("b", pair % width, pa.int32()), ("links", total, pa.int64())):
        out[name] = pa.ListArray.from_arrays(offsets, pa.array(values, type=kind))
    return out | ({"groups": groups} if with_groups else {})


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Exact sums of consecutive stretches of ``values``."""
    total = np.concatenate(([0], np.cumsum(values)))
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(a, b, docs, best): in how many rows each id pair is linked, and whether no pair of the same A id is in more."""
    counts = aligned.select(F.inline(F.arrays_zip("a", "b"))).groupBy("a", "b").agg(F.count("*").alias("docs"))
    most = F.max("docs").over(Window.partitionBy("a"))  # at most one row per id of the other vocabulary
    return counts.withColumn("best", F.col("docs") == most)


def with_counts(aligned: DataFrame, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """``aligned`` (written) with n_best, the links whose pair is its A id's commonest, and count_sum over all links.

    Up to ``broadcast_pairs`` different pairs are sent to the tasks as sorted arrays; a larger table is joined with the
    rows' pairs. Both ways give the same result.
    """
    counts = materialize(pair_counts(aligned))
    plain = [c for c in aligned.columns if c not in ("a", "b", "links")]
    if counts.count() > broadcast_pairs:
        return _joined(aligned, counts, plain)
    table = counts.toArrow()
    a, b = (table.column(c).to_numpy().astype(np.int64) for c in ("a", "b"))
    order = np.argsort(a << 32 | b)
    shared = aligned.sparkSession.sparkContext.broadcast((
        (a << 32 | b)[order], table.column("docs").to_numpy()[order].astype(np.int64),
        np.asarray(table.column("best").to_numpy())[order].astype(bool),
    ))

    def run(batches) -> Iterator[dict]:
        keys, docs, best = shared.value
        for batch in batches:
            lists = {c: batch.column(c) for c in ("a", "b", "links")}
            flat = {c: x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c, x in lists.items()}
            sizes = np.diff(lists["a"].offsets.to_numpy())
            at = np.searchsorted(keys, flat["a"] << 32 | flat["b"])
            yield {c: batch.column(c) for c in plain} | {
                "n_best": _sums(flat["links"] * best[at], sizes), "count_sum": _sums(flat["links"] * docs[at], sizes),
            }

    kept = ", ".join(f"{c} {aligned.schema[c].dataType.simpleString()}" for c in plain)
    return map_batches(aligned, run, kept + ", n_best long, count_sum long")


def _joined(aligned: DataFrame, counts: DataFrame, plain: list[str]) -> DataFrame:
    """``with_counts`` by a join on the id pair; rows are told apart by a number, as ids may repeat."""
    rows = materialize(aligned.withColumn("_row", F.monotonically_increasing_id()))
    pairs = rows.select("_row", F.inline(F.arrays_zip("a", "b", "links")))
    sums = pairs.join(counts, ["a", "b"]).groupBy(F.col("_row").alias("_of")).agg(
        F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"),
        F.sum(F.col("links") * F.col("docs")).alias("count_sum"),
    )
    joined = rows.join(sums, F.col("_row") == F.col("_of"), "left")
    return joined.select(*plain, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")])


def alignment(docs: DataFrame, tokenizer: str | None = None, model: str | None = None) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) per row; see ``align`` and ``with_counts``."""
    found = with_counts(materialize(align(docs, tokenizer, model)))
    return found.select("doc_id", *_COUNTS, "n_best", "count_sum", "groups_sha256")
