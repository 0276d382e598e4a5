"""Token ids of whole texts by the tokenizers library, with a cache of the words seen by a worker."""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import SparkSession

from voltmart.llm.common import ragged, worker_cache

#: A cache that holds this many words keeps those of the newest batch only, so common ones stay.
CACHE_WORDS = 200_000

#: A space and another white space after it, in ASCII texts; white space beyond ASCII.
_RUNS = tuple(" " + c for c in " \n\t\r\x0b\x0c\x1c\x1d\x1e\x1f")
_WIDE = re.compile("[\x85\xa0\u1680\u180e\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_SPACE_RUN = re.compile(r"(?: [\s᠎\x1c-\x1f])|^ | $")
_WORD_START = re.compile(r"(?= [^\s᠎\x1c-\x1f])")

#: What makes ``_cut`` take ``_WORD_START``, for Arrow.
_RUN_IN_ARROW = (
    r" [\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|^ | $"
)

#: Letters that NFC leaves alone and lower-casing maps one to one. A run of them is one word to both kinds of pattern, and a
#: run of marks or a line break behind it another.
_LETTER = "[A-Za-zÀ-ÖØ-öø-ÿ]"
_LETTERS = re.compile(f"{_LETTER}+")
_MARK = "[.,!?:;#$%&*]"
_LINES = re.compile(rf"{_LETTER}+{_MARK}*(?:\n{_LETTER}+{_MARK}*)*")
_PARTS = re.compile(rf"{_LETTER}+|{_MARK}+|\n")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def send_tokenizer(spark: SparkSession, path: str) -> Broadcast:
    """The tokenizer's JSON file for the workers; its size is that of one vocabulary, whatever the data."""
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 as itself, others from U+0100."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


#: The character of a byte-level vocabulary for each byte, bytes as Latin-1.
BYTE_CHARS = {b: c for c, b in byte_alphabet().items()}


def worker_encoder(source: str, cache_words: int = CACHE_WORDS) -> Encoder:
    """The worker's encoder for a tokenizer, which is loaded once however many tasks the worker runs."""
    kept = worker_cache(f"encoder-{hash(source)}")
    if "encoder" not in kept:
        kept["encoder"] = Encoder(source)
    kept["encoder"].cache_words = cache_words
    return kept["encoder"]


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes, equal to encoding each text in one call.

    Both kinds of vocabulary supported split a text before a space that a non-space follows, whatever stands around it:
    byte-level BPE as its pattern takes such a space as the head of the next word, and BPE with word ends as it drops
    white space. So a text is cut there, and each different piece is encoded once and then looked up. Words of Latin letters
    are further cut before and behind marks and line breaks; as such a word is not cut any more, it goes to the
    tokenizer's model without its normalizer and pattern. Any other tokenizer encodes whole texts, and so are texts that hold
    the string of a special token: the library's plain call makes it that token's id, and spaces beside it may go with it.
    """

    def __init__(self, source: str, cache_words: int = CACHE_WORDS):
        from tokenizers import Tokenizer

        shape = json.loads(source)
        shape = {k: shape[k] for k in ("added_tokens", "normalizer", "pre_tokenizer")}
        self.plain = Tokenizer.from_str(source)
        self.specials = [t["content"] for t in shape["added_tokens"]]
        self.model = self.plain.model
        self.cut_word, self.cut_id = shape["added_tokens"][-1]["content"], shape["added_tokens"][-1]["id"]
        kind = shape["pre_tokenizer"]["type"]
        byte_level = kind == "ByteLevel" and shape["normalizer"] is None and not shape["pre_tokenizer"]["add_prefix_space"]
        parts = [p["type"] for p in shape["pre_tokenizer"].get("pretokenizers", [])]
        word_ends = kind == "Sequence" and parts == ["Split", "ByteLevel"]
        self.whole, self.keep_space, self.cache_words = not (byte_level or word_ends), byte_level, cache_words
        kept = worker_cache(f"ids-{hash(source)}")
        # what follows a space, without it; and what begins a text, the same where a space is dropped
        self.words = kept.setdefault("words", {})
        self.heads = kept.setdefault("heads", {}) if byte_level else self.words
        # words of ``encode_array``: their array, numbers of ids, and ids
        self.known = kept.setdefault("known", [pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, "<u4")])

    def _cut(self, text: str) -> tuple[str, list[str]]:
        """What begins the text, and the pieces that follow a space."""
        runs = text[0] == " " or text[-1] == " " or any(run in text for run in _RUNS)
        if runs or not text.isascii() and _WIDE.search(text) and _SPACE_RUN.search(text):
            head, *rest = _WORD_START.split(text)
            return head, [w[1:] for w in rest]
        head, *rest = text.split(" ")
        return head, rest

    def _learn(self, words: Iterable[str], heads: Iterable[str]) -> None:
        stems, starts, lines = [], set(heads), []
        for word in words:
            if not word.isalpha() and _LINES.fullmatch(word):
                lines.append(word)
                if not word[:-1].isalpha():
                    first, *rest = _PARTS.findall(word)
                    stems.append(first)
                    starts.update(rest)
                else:
                    stems.append(word[:-1])
                    starts.add(word[-1])
            else:
                stems.append(word)
        self._ask(set(stems).difference(self.words), self.words, " " if self.keep_space else "")
        self._ask(starts.difference(self.heads), self.heads, "")
        for word in lines:
            if word[:-1].isalpha():
                self.words[word] = self.words[word[:-1]] + self.heads[word[-1]]
            else:
                first, *rest = _PARTS.findall(word)
                self.words[word] = self.words[first] + b"".join([self.heads[r] for r in rest])

    def _ask(self, words: Iterable[str], cache: dict[str, bytes], lead: str, step: int = 500) -> None:
        begin, tokenize = BYTE_CHARS[ord(lead)] if lead else "", self.model.tokenize
        odd, others = [], []
        for word in words:
            ascii = word.isalpha() and word.isascii()
            if not (ascii or _LETTERS.fullmatch(word)):
                (odd if "<" in word else others).append(word)
                continue
            plain = word if self.keep_space else word.lower()
            raw = cache.get(plain)
            if raw is None:
                spelled = plain if ascii else plain.encode().decode("latin-1").translate(BYTE_CHARS)
                found = tokenize(begin + spelled)
                cache[plain] = raw = struct.pack(f"<{len(found)}I", *[token.id for token in found])
            cache[word] = raw
        for word, found in zip(odd, self.plain.encode_batch_fast([lead + w for w in odd], add_special_tokens=False)):
            cache[word] = np.array(found.ids, dtype="<u4").tobytes()
        for i in range(0, len(others), step):
            part = others[i : i + step]
            joined = lead + (self.cut_word + lead).join(part)
            found = self.plain.encode_batch_fast([joined], add_special_tokens=False)[0]
            ids = np.array(found.ids, dtype="<u4")
            cuts = np.flatnonzero(ids == self.cut_id) * 4
            raw = ids.tobytes()
            for word, a, b in zip(part, [0, *(cuts + 4).tolist()], [*cuts.tolist(), len(raw)], strict=True):
                cache[word] = raw[a:b]

    def _trim(self, seen: Iterable[str]) -> None:
        """Keeps the words of a full cache that are among the seen ones."""
        if len(self.words) + (len(self.heads) if self.keep_space else 0) > self.cache_words:
            kept = {w: self.words[w] for w in seen if w in self.words}
            self.words.clear()
            self.heads.clear()
            self.words.update(kept)

    def encode_array(self, texts: pa.Array) -> list[bytes]:
        """``encode`` of an Arrow array of strings: Arrow cuts it and tells its words apart, so each is looked up once.

        It pays for arrays that hold a word many times, as those of some megabytes do. Texts with runs of white space or the
        string of a special token are passed to ``encode``.
        """
        if self.whole:
            return self.encode(texts.to_pylist())
        texts = pc.fill_null(texts.cast(pa.string()), "")
        odd = pc.match_substring_regex(texts, "|".join([_RUN_IN_ARROW, *map(re.escape, self.specials)]))
        out: list[bytes] = [b""] * len(texts)
        others = np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist()
        for i, found in zip(others, self.encode(texts.filter(odd).to_pylist()) if others else []):
            out[i] = found
        plain = np.flatnonzero(pc.invert(odd).to_numpy(zero_copy_only=False)).tolist()
        if not plain:
            return out
        cut = pc.split_pattern(texts.filter(pc.invert(odd)), " ")
        sizes = pc.list_value_length(cut).to_numpy().astype(np.int64)
        first, values = np.cumsum(sizes) - sizes, cut.flatten()
        heads, found = values.take(pa.array(first)).to_pylist(), values.dictionary_encode()
        places = self._places(found.dictionary, heads)
        known, lengths, ids = self.known
        begins, entries = np.cumsum(lengths) - lengths, [self.heads[h] for h in heads]
        more = np.fromiter(map(len, entries), np.int64, len(entries)) >> 2
        at = places[found.indices.to_numpy()]
        at[first] = len(known) + np.arange(len(heads))
        counts = np.concatenate([lengths, more])[at]
        begins = np.concatenate([begins, len(ids) + np.cumsum(more) - more])[at]
        ids = np.concatenate([ids, np.frombuffer(b"".join(entries), "<u4")])[ragged(begins, counts)]
        raw, ends = ids.tobytes(), (4 * np.add.reduceat(counts, first).cumsum()).tolist()
        for i, a, b in zip(plain, [0, *ends], ends):
            out[i] = raw[a:b]
        return out

    def _places(self, words: pa.Array, heads: list[str]) -> np.ndarray:
        """Places in ``known`` of different words, after learning them and the heads."""
        known, lengths, ids = self.known
        found = pc.index_in(words, known)
        if len(known) > self.cache_words:
            kept = pc.drop_null(found).to_numpy()
            ids = ids[ragged((np.cumsum(lengths) - lengths)[kept], lengths[kept])]
            known, lengths = known.take(pa.array(kept)), lengths[kept]
            found = pc.index_in(words, known)
        if len(self.words) > self.cache_words:
            self.words.clear()
            self.heads.clear()
        fresh = words.filter(pc.is_null(found))
        new = fresh.to_numpy(zero_copy_only=False).tolist()
        self._learn([w for w in new if w not in self.words], set(heads))
        entries = [self.words[w] for w in new]
        sizes = np.fromiter(map(len, entries), np.int64, len(entries)) >> 2
        needed = set(heads)
        for w in new:  # the dict keeps what other words are made of
            if not w.isalpha() and w not in needed:
                del self.words[w]
        self.known[:] = (
            pa.concat_arrays([known, fresh]), np.concatenate([lengths, sizes]),
            np.concatenate([ids, np.frombuffer(b"".join(entries), "<u4")]),
        )
        places = pc.fill_null(found, 0).to_numpy().astype(np.int64)
        places[pc.is_null(found).to_numpy(zero_copy_only=False)] = len(known) + np.arange(len(new))
        return places

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if self.whole:
            found = self.plain.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)
            return [np.array(f.ids, dtype="<u4").tobytes() for f in found]
        special = [i for i, t in enumerate(texts) if t and any(s in t for s in self.specials)]
        whole, held = self.plain.encode_batch_fast([texts[i] for i in special], add_special_tokens=False), set(special)
        texts = ["" if i in held else t for i, t in enumerate(texts)] if special else texts
        cut = [self._cut(t) if t else ("", []) for t in texts]
        seen = set().union(*[words for _, words in cut])
        self._trim(seen)
        self._learn(seen.difference(self.words), {head for head, _ in cut})
        heads, words_of = self.heads, self.words.__getitem__
        out = [heads[head] + b"".join(map(words_of, words)) for head, words in cut]
        for i, found in zip(special, whole):
            out[i] = np.array(found.ids, dtype="<u4").tobytes()
        return out
