"""Benchmark decontamination with a generalised suffix automaton over the words of the benchmark items."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

from voltmart.llm.common import WORD_BYTES, encoded, id_text, map_batches, pieces
from voltmart.session import materialize

#: Item words per automaton; a larger benchmark is cut into blocks, each streamed over on its own.
BLOCK_WORDS = 200_000
WINDOW = 13


def normalized(text: str | None) -> list[bytes]:
    """Words of a text: A-Z lower-cased, split at every ASCII character that is no letter or digit."""
    return encoded(text).translate(WORD_BYTES).split()


class Automaton:
    """Suffix automaton of several word sequences (items) with the items of every window."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window, self.vocabulary = window, {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.windows: dict[int, set[str]] = {}  # state of a whole window -> items
        self.short: dict[int, list[tuple[int, str]]] = {}  # state of an item below a window -> (words, item)
        coded = [(i, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]) for i, words in items if words]
        for _, codes in coded:
            last = 0
            for c in codes:
                last = self._extend(last, c)
        for item, codes in coded:
            for end, (state, size) in enumerate(self.follow(codes), 1):
                if size >= window:
                    self.windows.setdefault(self._state_of(state, window), set()).add(item)
                elif end == len(codes):
                    self.short.setdefault(self._state_of(state, end), []).append((end, item))
        self.shortest = min([window, *(len(c) for _, c in coded)])
        self.above_short = self._nearest_short()

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            q = self.next[last][c]
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, q, c)
        new = len(self.next)
        self.next.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, c)
        return new

    def _clone(self, p: int, q: int, c: int) -> int:
        copy = len(self.next)
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def _state_of(self, state: int, size: int) -> int:
        """The state of the last ``size`` words of what ``state`` stands for."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def _nearest_short(self) -> list[int]:
        """For each state the nearest one up its links, itself included, that ends a short item; -1 for none."""
        found = [-1] * len(self.next)
        if self.short:
            for state in sorted(range(len(self.next)), key=self.length.__getitem__):
                above = found[self.link[state]] if state else -1
                found[state] = state if state in self.short else above
        return found

    def follow(self, codes) -> Iterator[tuple[int, int]]:
        """State and length of the longest match that ends at each word."""
        state, size = 0, 0
        for c in codes:
            while state and c not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if c in self.next[state]:
                state = self.next[state][c]
                size += 1
            yield state, size

    def scan(self, words: list[bytes]) -> tuple[list[list[int]], set[str], int]:
        """Merged spans [start, end) of hit words, items with an occurring window, and the longest match in words.

        A word that no item holds ends every match, so only runs of known words are followed.
        """
        codes = np.fromiter(map(self.vocabulary.get, words, [-1] * len(words)), dtype=np.int64, count=len(words))
        edges = np.flatnonzero(np.diff(np.concatenate(([0], codes >= 0, [0])).astype(np.int8)))
        spans, items, longest = [], set(), 0
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if end - start < self.shortest:
                continue
            for at, (state, size) in enumerate(self.follow(codes[start:end].tolist()), start + 1):
                longest = max(longest, size)
                hit = 0
                if size >= self.window:
                    items |= self.windows[self._state_of(state, self.window)]
                    hit = self.window
                up = self.above_short[state]
                while up >= 0:
                    for n, item in self.short[up]:
                        if n <= size:
                            items.add(item)
                            hit = max(hit, n)
                    up = self.above_short[self.link[up]] if up else -1
                if hit:
                    if spans and spans[-1][1] >= at - hit:
                        while len(spans) > 1 and spans[-2][1] >= at - hit:
                            spans.pop()
                        spans[-1] = [min(spans[-1][0], at - hit), at]
                    else:
                        spans.append([at - hit, at])
        return spans, items, longest


def automata(benchmark: DataFrame, window: int, block_words: int, id_col: str, text_col: str) -> list:
    """Broadcast automata of the items' blocks, at most about ``block_words`` words each.

    Items reach the driver one block at a time. A block is chosen by the item's hash, so the pieces of one item that has
    several rows stay together.
    """
    spark = benchmark.sparkSession
    items = benchmark.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).cast("string").alias("text")
    ).filter("text IS NOT NULL")
    words = F.expr(r"size(regexp_extract_all(text, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+', 0))")
    size = items.agg(F.sum(words)).first()[0] or 0
    blocks = max(1, -(-size // block_words))
    sent = []
    for block in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).toLocalIterator()
        sent.append(spark.sparkContext.broadcast(Automaton([(r.item, normalized(r.text)) for r in rows], window)))
    return sent


def scan(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS,
    id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, text_hash, n_words, n_hit, spans, items, longest), one row per document.

    A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is one window. ``spans``
    are the merged [start, end) word positions inside any occurrence of a window, ``items`` the sorted ids of items with
    an occurring window, ``longest`` the longest common run of words with any item. Null and empty texts have no words
    and no hits; an empty benchmark hits nothing; a null item id counts as ''. Repeated rows give repeated results.
    """
    rows = id_text(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    schema = "doc_id long, text_hash long, n_words long, spans array<array<int>>, items array<string>, longest int"
    found = None
    for block, sent in enumerate(automata(benchmark, window, block_words, item_id_col, item_text_col)):

        def run(batches, sent=sent, block=block) -> Iterator[dict]:
            automaton = sent.value
            for batch in pieces(batches):
                words = [normalized(t) for t in batch.column("text").to_pylist()]
                hits = [automaton.scan(w) for w in words]
                yield {
                    "doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash"),
                    "n_words": [None if block else len(w) for w in words], "spans": [h[0] for h in hits],
                    "items": [sorted(h[1]) for h in hits], "longest": [h[2] for h in hits],
                }

        part = map_batches(rows, run, schema)
        found = part if found is None else found.union(part)
    if part is found:  # one block: each document's row is whole
        spans, items = F.array_sort(F.array_distinct("spans")), F.array_sort(F.array_distinct("items"))
        one = found.withColumns({"spans": spans, "items": items, "times": F.lit(1)})
    else:
        one = found.groupBy("doc_id", "text_hash").agg(
            F.count("n_words").alias("times"), F.max("n_words").alias("n_words"), F.max("longest").alias("longest"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        )
    start = "struct(CAST(0 AS BIGINT) AS n, 0 AS end)"
    n_hit = F.expr(
        f"""aggregate(spans, {start}, (a, s) -> struct(a.n + greatest(0, s[1] - greatest(s[0], a.end)) AS n,
        greatest(a.end, s[1]) AS end), a -> a.n)"""
    )
    return one.select(
        "doc_id", "text_hash", "n_words", n_hit.alias("n_hit"), "spans", "items", "longest",
        F.explode(F.expr("sequence(1, CAST(times AS INT))")).alias("time"),
    ).drop("time")


def verdicts(found: DataFrame, one_in: int = 20, max_run: int | None = None) -> DataFrame:
    """``contaminated``: some word is hit, and at least one in ``one_in`` words is, or a run exceeds ``max_run`` words."""
    over = F.col("n_hit") * one_in >= F.col("n_words")
    if max_run is not None:
        over |= F.col("longest") > max_run
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & over)


def without_spans(text: str | None, spans) -> str | None:
    """``text`` without the words at the given positions; what stood between removed words goes with them."""
    if not spans:
        return text
    raw = encoded(text)
    is_word = np.frombuffer(raw.translate(WORD_BYTES), dtype=np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate(([0], is_word, [0])).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    keep = np.ones(len(raw), dtype=bool)
    for a, b in spans:
        keep[starts[a] : ends[b - 1]] = False
    return np.frombuffer(raw, dtype=np.uint8)[keep].tobytes().decode("utf-8", "surrogatepass")


def decontaminate(docs: DataFrame, benchmark: DataFrame, one_in: int = 20, **options) -> DataFrame:
    """``docs`` without contaminated documents; hit passages are cut from the texts of the others; columns as given."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    found = materialize(
        verdicts(scan(docs, benchmark, **options), one_in).filter("n_hit > 0")
        .select(F.col("doc_id").alias("_hit_id"), F.col("text_hash").alias("_hit_hash"), F.col("spans").alias("_hit_spans"),
                F.col("contaminated").alias("_hit_bad")).distinct()
    )
    joined = docs.join(
        found,
        docs[id_col].cast("long").eqNullSafe(found["_hit_id"])
        & F.xxhash64(docs[text_col].cast("string")).eqNullSafe(found["_hit_hash"]),
        "left",
    ).filter("_hit_bad IS NOT TRUE")
    cut = F.pandas_udf(lambda texts, spans: _cut(texts, spans), "string")
    columns = [
        F.when(F.col("_hit_spans").isNull(), docs[c]).otherwise(cut(docs[c], F.col("_hit_spans"))).alias(c)
        if c == text_col else docs[c] for c in docs.columns
    ]
    return joined.select(*columns)


def _cut(texts, spans):
    import pandas as pd

    return pd.Series([t if s is None else without_spans(t, [tuple(x) for x in s]) for t, s in zip(texts, spans)], dtype=object)
