"""Toxicity by class-conditional Kneser-Ney models: toxic against ordinary log-likelihood per word."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from voltmart.functions.quantile import join_small
from voltmart.llm.common import WORD_BYTES, encoded, held_out, id_text, map_batches, pieces
from voltmart.session import materialize

#: The class models are fitted on about this many characters of labelled training texts per class, whole documents chosen by
#: hash (fewer where there are fewer), so the model that is sent to the tasks has a bound.
SAMPLE_CHARS = 3_000_000
#: The sampled documents are calibrated in this many parts, each by a model of the others.
FOLDS = 5
DISCOUNT = 0.75
#: One word in this many, two at least, makes up the third feature of a document.
TOP_SHARE = 80
#: A document is toxic from this score on.
THRESHOLD = 0.3


def word_ids(text: str | None) -> np.ndarray:
    """32-bit hashes of the lower-cased words of a text."""
    words = encoded(text).translate(WORD_BYTES).split()
    return np.fromiter(map(zlib.crc32, words), dtype=np.uint64, count=len(words))


def _before(ids: np.ndarray) -> np.ndarray:
    """The word before each; 0 at the start."""
    return np.concatenate((np.zeros(1, dtype=np.uint64), ids[:-1]))


def _pairs(ids: np.ndarray) -> np.ndarray:
    """Each word with the one before it; the first follows 0."""
    return _before(ids) << np.uint64(32) | ids


def _place(ids: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each id in the sorted ``keys``; their number where it is none of them."""
    if not len(keys):
        return np.zeros(len(ids), dtype=np.int64)
    at = np.minimum(np.searchsorted(keys, ids), len(keys) - 1)
    return np.where(keys[at] == ids, at, len(keys))


def shared_counts(docs: DataFrame, words: np.ndarray) -> np.ndarray:
    """In how many contexts (a document and the word before) each of the sorted ``words`` occurs in all texts; last, all others."""
    sent = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches) -> Iterator[dict]:
        total = np.zeros(len(sent.value) + 1, dtype=np.int64)
        for batch in pieces(batches):
            found = [np.unique(_pairs(word_ids(t))) for t in batch.column("text").to_pylist()]
            at = _place(np.concatenate(found) & np.uint64(0xFFFFFFFF), sent.value)
            total += np.bincount(at, minlength=len(total))
        used = np.flatnonzero(total)
        yield {"place": used, "n": total[used]}

    counts = map_batches(docs, run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    places, n = _fetched(counts, "place", ["n"], np.int64)
    sent.destroy()
    out = np.zeros(len(words) + 1)
    out[places] = n[0]
    return out


def _fetched(counts: DataFrame, key: str, names: list[str], kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Keys and columns of a table of bounded size, packed, in parts small enough to travel with the tasks' results."""
    most = np.iinfo(kind).max

    def run(batches) -> Iterator[dict]:
        for batch in batches:
            columns = [np.minimum(batch.column(c).to_numpy(), most).astype(kind) for c in names]
            yield {"keys": [batch.column(key).to_numpy().tobytes()], "columns": [np.stack(columns).tobytes()]}

    parts = map_batches(counts, run, "keys binary, columns binary").repartition(64).toPandas()
    if not len(parts):
        return np.zeros(0, dtype=np.int64), np.zeros((len(names), 0), dtype=kind)
    return np.concatenate([np.frombuffer(k, dtype=np.int64) for k in parts["keys"]]), np.concatenate(
        [np.frombuffer(c, dtype=kind).reshape(len(names), -1) for c in parts["columns"]], axis=1
    )


@dataclass
class Model:
    """Both classes' Kneser-Ney counts over hashed words, as sorted arrays."""

    words: np.ndarray  # sorted word hashes
    continuation: np.ndarray  # (2, words + 1): different words before, per class; 0 for a word that is not in the model
    followers: np.ndarray  # (2, words + 1): different words after
    uses: np.ndarray  # (2, words + 1): counts as a word before
    pairs: np.ndarray  # sorted (word before, word)
    pair_counts: np.ndarray  # (2, pairs): different words before the pair
    shared: np.ndarray  # (words + 1): backoff probabilities; the last one cancels, as its word is in neither class

    def ratio(self, ids: np.ndarray, before: int = 0) -> np.ndarray:
        """log P(word | before, toxic) - log P(word | before, ordinary) for each word, and the same without the word before.

        ``before`` precedes the first word.
        """
        previous = np.concatenate((np.array([before], dtype=np.uint64), ids[:-1]))
        at, after = _place(ids, self.words), _place(previous, self.words)
        pair_at = _place(previous << np.uint64(32) | ids, self.pairs)
        pair_known, pair_at = pair_at < len(self.pairs), np.minimum(pair_at, max(0, len(self.pairs) - 1))
        logs = np.empty((2, 2, len(ids)))
        for c in (0, 1):
            seen = self.continuation[c]
            types = max(1.0, seen.sum())
            unseen = max(DISCOUNT * np.count_nonzero(seen) / types, 1e-3)
            low = np.maximum(seen[at] - DISCOUNT, 0) / types + unseen * self.shared[at]
            used = self.uses[c][after]
            back = np.where(used > 0, DISCOUNT * self.followers[c][after] / np.maximum(used, 1), 1.0)
            count = np.where(pair_known, self.pair_counts[c][pair_at], 0.0)
            logs[c] = np.log(np.maximum(count - DISCOUNT, 0) / np.maximum(used, 1) + back * low), np.log(low)
        return logs[1] - logs[0]

    def features(self, text: str | None, block: int = 200_000) -> tuple[float, float, float] | None:
        """Length-normalised log-likelihood ratios: with and without the word before, and without it over the words that favour
        toxicity most (a pair seen once tells little of its two words); None without words."""
        ids = word_ids(text)
        if not len(ids):
            return None
        full, low = np.concatenate(
            [self.ratio(ids[i : i + block], ids[i - 1] if i else 0) for i in range(0, len(ids), block)], axis=1
        )
        top = min(len(low), max(2, len(low) // TOP_SHARE))
        return float(full.mean()), float(low.mean()), float(np.partition(low, len(low) - top)[-top:].mean())

    def score(self, text: str | None, weights: tuple[float, ...] | None) -> float:
        """Calibrated score; 0 for a text without words, and for all without weights, as nothing tells the classes apart."""
        found = self.features(text) if weights else None
        if found is None:
            return 0.0
        z = weights[0] + np.dot(weights[1:], found)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def model_of(words: np.ndarray, pairs: np.ndarray, n: np.ndarray, shared: np.ndarray) -> Model:
    """The model of the pair counts ``n`` (2, pairs); ``words`` are all words of the pairs."""
    before, word = _place(pairs >> np.uint64(32), words), _place(pairs & np.uint64(0xFFFFFFFF), words)
    tally = lambda at, w: np.stack([np.bincount(at, w[c], len(words) + 1) for c in (0, 1)]).astype(np.float32)
    return Model(words, tally(word, n > 0), tally(before, n > 0), tally(before, n), pairs, n, shared)


def _counted(train: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted (word before, word) pairs and (FOLDS + 1, 2, pairs): in how many different contexts, the words before the pair,
    each occurs per class; first in all of ``train``, then without each part. As many as the bounded sample holds.

    Contexts are types, so the copies of one document weigh no more than the document.
    """

    def run(batches) -> Iterator[dict]:
        for batch in pieces(batches):
            toxic, part = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("toxic", "part"))
            texts = batch.column("text").to_pylist()
            for c, k in sorted(set(zip(toxic.tolist(), part.tolist()))):
                found = [word_ids(texts[i]) for i in np.flatnonzero((toxic == c) & (part == k))]
                keys = np.concatenate([_pairs(ids) for ids in found])
                contexts = np.concatenate([_before(_before(ids)) if len(ids) else ids for ids in found])
                order = np.lexsort((contexts, keys))
                keys, contexts = keys[order], contexts[order]
                new = np.ones(len(keys), dtype=bool)
                new[1:] = (keys[1:] != keys[:-1]) | (contexts[1:] != contexts[:-1])
                yield {"key": keys[new].view(np.int64), "context": contexts[new].view(np.int64),
                       "toxic": np.full(int(new.sum()), c, dtype=np.int32), "parts": np.full(int(new.sum()), 1 << k, dtype=np.int32)}

    types = map_batches(train, run, "key long, context long, toxic int, parts int").groupBy("key", "context", "toxic").agg(
        F.bit_or("parts").alias("parts")
    )
    names = [(k, c) for k in range(FOLDS + 1) for c in (0, 1)]
    counts = types.groupBy("key").agg(*[  # a part's own types are those in no other part
        F.sum(((F.col("toxic") == c) & (F.lit(k == 0) | (F.col("parts") != 1 << max(0, k - 1)))).cast("int")).alias(f"n{k}_{c}")
        for k, c in names
    ])
    keys, n = _fetched(counts, "key", [f"n{k}_{c}" for k, c in names], np.uint16)
    keys = keys.view(np.uint64)
    order = np.argsort(keys)
    return keys[order], n[:, order].reshape(FOLDS + 1, 2, -1)


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 3.0) -> tuple[float, ...]:
    """Intercept and weights of a logistic regression by Newton's method.

    The ridge is on the weights of the standardised columns, so with few rows the scores go to the share of ``y``.
    """
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    x = np.concatenate((np.ones((len(x), 1)), (x - mean) / spread), axis=1)
    w, penalty = np.zeros(x.shape[1]), np.array([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    slopes = w[1:] / spread
    return float(w[0] - slopes @ mean), *slopes.tolist()


def fit(
    docs: DataFrame, labels: DataFrame, sample_chars: int = SAMPLE_CHARS, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic",
) -> tuple[Broadcast, tuple[float, ...] | None]:
    """The model (for the tasks) and the calibration of its features, from the labelled rows that are not held out.

    Null labels, ids and texts are left out. Backoff counts are over the texts of all rows. The pair counts of both classes
    come from whole documents of the bounded sample. The calibration reads every sampled document through a model of the
    parts it is not in; equal texts are in one part. Where a class has no words, or only in one part, there is no
    calibration (None).
    """
    rows, spark = id_text(docs, id_col, text_col), docs.sparkSession
    marks = labels.select(
        labels[id_col].cast("long").alias("doc_id"), labels[label_col].cast("int").alias("toxic")
    ).filter("doc_id IS NOT NULL AND toxic IN (0, 1)").distinct().filter(~held_out(F.col("doc_id")))
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(5)), F.lit(1_000_000)) / 1_000_000
    lengths = rows.filter("text IS NOT NULL").select("doc_id", F.length("text").alias("n"))
    sizes = dict(lengths.join(marks, "doc_id").groupBy("toxic").agg(F.sum("n")).collect())
    rate = {c: min(1.0, sample_chars / max(1, sizes.get(c) or 1)) for c in (0, 1)}
    drawn = marks.filter(draw < F.when(F.col("toxic") == 1, rate[1]).otherwise(rate[0]))
    sample = materialize(  # few ids: written first, they are sent to the texts instead of texts to them
        join_small(rows.filter("text IS NOT NULL"), drawn, ["doc_id"]).withColumn(
            "part", F.pmod(F.xxhash64("text", F.lit(6)), F.lit(FOLDS)).cast("int")
        )
    )
    pairs, n = _counted(sample)
    words = np.unique(np.concatenate((pairs & np.uint64(0xFFFFFFFF), pairs >> np.uint64(32))))
    usable = (n > 0).any(axis=2).all(axis=1)
    if not usable[1:].any():
        none = np.zeros(0, dtype=np.uint64)
        return spark.sparkContext.broadcast(model_of(none, none, np.zeros((2, 0)), np.ones(1))), None
    counts = shared_counts(rows, words)
    shared = ((counts + 0.5) / (counts.sum() + 0.5 * len(counts))).astype(np.float32)
    without = spark.sparkContext.broadcast([model_of(words, pairs, m, shared) if u else None for m, u in zip(n[1:], usable[1:])])

    def run(batches) -> Iterator[dict]:
        for batch in pieces(batches):
            rows = zip(*(batch.column(c).to_pylist() for c in ("text", "part", "toxic")))
            found = [(without.value[k] and without.value[k].features(t), c) for t, k, c in rows]
            found = np.array([(*x, c) for x, c in found if x]).reshape(-1, 4)
            yield {"full": found[:, 0], "low": found[:, 1], "top": found[:, 2], "toxic": found[:, 3].astype(np.int32)}

    seen = map_batches(sample, run, "full double, low double, top double, toxic int").toPandas()
    without.destroy()
    sent = spark.sparkContext.broadcast(model_of(words, pairs, n[0], shared))
    if seen["toxic"].nunique() < 2:
        return sent, None
    x, y = seen[["full", "low", "top"]].to_numpy(), seen["toxic"].to_numpy(dtype=float)
    # a class may be sampled at a lower rate; the intercept goes back to the classes' shares in all labelled rows
    bias, *slopes = _logistic(x, y)
    return sent, (bias + float(np.log(rate[0] / rate[1])), *slopes)


def scores(
    docs: DataFrame, labels: DataFrame, sample_chars: int = SAMPLE_CHARS, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic",
) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per document; the score reads the text alone.

    Texts without words, empty and null ones among them, have the score 0. Repeated rows get equal scores. Without labelled
    training documents of both classes, two texts of each at least, every score is 0: nothing is predicted toxic.
    """
    sent, weights = fit(docs, labels, sample_chars, id_col, text_col, label_col)

    def run(batches) -> Iterator[dict]:
        for batch in pieces(batches):
            yield {"doc_id": batch.column("doc_id"), "score": [sent.value.score(t, weights) for t in batch.column("text").to_pylist()]}

    found = map_batches(id_text(docs, id_col, text_col), run, "doc_id long, score double")
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_ordinary(docs: DataFrame, labels: DataFrame, sample_chars: int = SAMPLE_CHARS, id_col: str = "doc_id",
                  text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """``docs`` without the documents predicted toxic, all of them where the labels lack a class; columns as given."""
    sent, weights = fit(docs, labels, sample_chars, id_col, text_col, label_col)

    @F.pandas_udf("double")
    def score(texts):
        return texts.map(lambda t: sent.value.score(t, weights))

    return docs.filter(score(docs[text_col].cast("string")) < THRESHOLD)
