import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from voltmart.llm import substring_dedup

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_force(rows, length):
    words = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + length]) for w in words for i in range(len(w) - length + 1))
    for (doc_id, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i : i + length])] > 1:
                gone.update(range(i, i + length))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        yield doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept


def check(docs, length=35, period=None):
    found = substring_dedup.measure(docs, length, period)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = sorted((x[:4] for x in brute_force(rows, length)), key=repr)
    assert sorted((tuple(r) for r in found.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=repr) == want
    return want


@pytest.mark.parametrize("period", [*range(1, 32), 32, 57, 100])
def test_cover_has_all_differences(period):
    cover = substring_dedup.difference_cover(period)
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_names_are_equal_for_equal_words_only():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 2**64, 40, dtype=np.uint64)[rng.integers(0, 4, 3000)]
    starts = np.arange(len(hashes) - 4)
    for family in (0, 1):
        names = substring_dedup.window_names(hashes, starts, 5, family)
        by_name = {}
        for s, n in zip(starts, names):
            assert by_name.setdefault(n, hashes[s : s + 5].tobytes()) == hashes[s : s + 5].tobytes()
        assert len(by_name) == len({hashes[s : s + 5].tobytes() for s in starts})


@pytest.mark.parametrize("length,period", [(1, 1), (5, 1), (5, 3), (8, 7), (12, 12), (35, 21)])
def test_passages_at_every_shift(spark, length, period):
    """Passages of length - 1, length and more words, put at all places modulo the period, within and across texts."""
    rng = random.Random(length)
    fresh = iter(range(10**6))
    word = lambda: f"w{next(fresh)}"
    shared = [[word() for _ in range(length + extra)] for extra in (-1, 0, 1, 17) if length + extra > 0]
    rows = []
    for i in range(90):
        words = [word() for _ in range(i % 29)]
        for passage in rng.sample(shared, rng.randint(0, len(shared))):
            words += passage + [word() for _ in range(rng.randint(0, 3))]
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(words)))
    rows.append((90, " ".join(["again"] * (2 * length + 3))))
    want = check(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), length, period)
    assert any(r[2] for r in want) and not all(r[2] for r in want)


def test_whole_table(sample):
    check(sample, 35, 21)


def test_nulls_copies_empty_table_and_clashing_columns(odd_docs, no_docs):
    odd = odd_docs.withColumnsRenamed({"fp": "k1", "tag": "k2", "key": "n", "spans": "runs"})
    check(odd)
    assert substring_dedup.measure(no_docs).count() == 0
    with pytest.raises(ValueError):
        substring_dedup.measure(odd, 5, 6)


def test_removal_keeps_rows_and_columns(spark, odd_docs):
    odd = odd_docs.withColumnRenamed("fp", "_kept")
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    found = substring_dedup.remove(odd)
    assert found.columns == odd.columns
    want = [(d, t if not removed else kept) for (d, t), (_, _, removed, _, kept) in zip(rows, brute_force(rows, 35))]
    assert sorted(((r.doc_id, r.text) for r in found.collect()), key=repr) == sorted(want, key=repr)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("words_")]
