"""Language identification by rank-order profiles of letter n-grams and their out-of-place distance."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from voltmart.llm.common import held_out, id_text, map_batches, pieces, worker_cache

#: n-grams per profile, of documents and languages alike.
PROFILE = 400
LONGEST = 3
UNKNOWN = "und"

_PLAIN, _CODES = 0x250, 1024  # characters below keep a code of their own, others share the rest


def _letters() -> np.ndarray:
    """Code of each character: 0 for all but letters. Kept while the worker lives."""
    kept = worker_cache("letters")
    if "table" in kept:
        return kept["table"]
    table = kept["table"] = np.zeros(0x110000, dtype=np.uint16)
    for code in range(len(table)):
        if chr(code).isalpha():
            table[code] = code if code < _PLAIN else _PLAIN + code % (_CODES - _PLAIN)
    return table


def letter_codes(text: str | None, table: np.ndarray) -> np.ndarray:
    """Codes of the lower-cased letters; anything between words, and both ends, is one 0. Empty without a letter."""
    if not text:
        return np.zeros(0, dtype=np.int64)
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = np.concatenate(([0], table[points], [0])).astype(np.int64)
    codes = codes[np.concatenate(([True], (codes[1:] != 0) | (codes[:-1] != 0)))]
    return codes if len(codes) > 1 else codes[:0]


def ngrams(codes: np.ndarray, starts: int | None = None) -> np.ndarray:
    """Codes of all n-grams of 1 to 3 letters and word ends, but a single word end; of the first ``starts`` positions."""
    shift, starts = _CODES.bit_length() - 1, len(codes) if starts is None else starts
    found = [codes[:starts][codes[:starts] != 0]]
    for n in range(2, LONGEST + 1):
        size = min(starts, len(codes) - n + 1)
        if size > 0:
            gram = codes[:size]
            for k in range(1, n):
                gram = gram << shift | codes[k : size + k]
            found.append(gram | n << 40)
    return np.concatenate(found)


def counted(codes: np.ndarray, block: int = 1_000_000) -> tuple[np.ndarray, np.ndarray]:
    """Different n-grams and their counts, block by block for long texts."""
    grams, counts = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    for start in range(0, len(codes), block):
        new, n = np.unique(ngrams(codes[start : start + block + LONGEST - 1], block), return_counts=True)
        merged, at = np.unique(np.concatenate((grams, new)), return_inverse=True)
        counts = np.bincount(at, np.concatenate((counts, n)), len(merged)).astype(np.int64)
        grams = merged
    return grams, counts


def profile(codes: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams, most frequent first; ties by code."""
    grams, counts = counted(codes) if len(codes) > 500_000 else np.unique(ngrams(codes), return_counts=True)
    if len(grams) > 2 * size:  # all that can be among the first, in code order
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        grams, counts = grams[counts >= least], counts[counts >= least]
    return grams[np.lexsort((grams, -counts))[:size]]


def learn(docs: DataFrame, size: int = PROFILE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"):
    """{language: profile} from all rows that are not held out and have text and language, counted in Spark."""
    rows = docs.select(
        docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"),
        docs[lang_col].cast("string").alias("lang"),
    ).filter("text IS NOT NULL AND lang IS NOT NULL").filter(~held_out(F.col("doc_id"))).select("text", "lang")

    def run(batches) -> Iterator[dict]:
        table = _letters()
        for batch in pieces(batches):
            by_lang: dict[str, list] = {}
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                codes = letter_codes(text, table)
                if len(codes):
                    by_lang.setdefault(lang, []).append(codes[:-1])
            for lang, codes in by_lang.items():
                grams, n = counted(np.concatenate([*codes, [0]]))
                yield {"lang": [lang] * len(grams), "gram": grams, "n": n}

    counts = map_batches(rows, run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= size)
    found: dict[str, list] = {}
    for row in top.orderBy("lang", "place").toLocalIterator():
        found.setdefault(row["lang"], []).append(row["gram"])
    return {lang: np.array(grams, dtype=np.int64) for lang, grams in sorted(found.items())}


class Ranks:
    """Place of every n-gram in each language's profile; absent ones are as far out as the profile is long."""

    def __init__(self, profiles: dict[str, np.ndarray], size: int):
        self.langs, self.size = list(profiles), size
        self.grams = np.unique(np.concatenate(list(profiles.values()) or [np.zeros(0, dtype=np.int64)]))
        self.places = np.full((len(self.langs), len(self.grams) + 1), -1, dtype=np.int64)
        for row, grams in zip(self.places, profiles.values()):
            row[np.searchsorted(self.grams, grams)] = np.arange(len(grams))

    def predict(self, text: str | None, table: np.ndarray) -> tuple[str, float]:
        codes = letter_codes(text, table)
        if not len(codes) or not self.langs:
            return UNKNOWN, 0.0
        own = profile(codes, self.size)
        at = np.searchsorted(self.grams, own)
        at[(at < len(self.grams)) & (self.grams[np.minimum(at, len(self.grams) - 1)] != own)] = len(self.grams)
        places = self.places[:, at]
        out = np.where(places < 0, self.size, np.abs(places - np.arange(len(own)))).sum(axis=1)
        best = int(out.argmin())
        rest = np.delete(out, best)
        return self.langs[best], float(1 - out[best] / max(1, rest.min() if len(rest) else self.size * len(own)))


def identify(
    docs: DataFrame, size: int = PROFILE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), one row per document; a prediction reads the text alone.

    The language is the one whose profile is at the least out-of-place distance; of equals the first by name. The score is
    how much nearer it is than the second, as a share of that one's distance. Null, empty and letterless texts are ``und``
    with score 0, as is everything if nothing could be learned. Repeated rows are predicted each.
    """
    profiles = learn(docs, size, id_col, text_col, lang_col)
    sent = docs.sparkSession.sparkContext.broadcast(Ranks(profiles, size))

    def run(batches) -> Iterator[dict]:
        table, ranks = _letters(), sent.value
        for batch in pieces(batches):
            found = [ranks.predict(t, table) for t in batch.column("text").to_pylist()]
            yield {"doc_id": batch.column("doc_id"), "lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}

    found = map_batches(id_text(docs, id_col, text_col), run, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
