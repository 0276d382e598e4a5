import hashlib

import numpy as np
import pytest

from tests.llm.conftest import rows_of, texts_of
from voltmart.llm import simhash, suffix_dedup
from voltmart.llm.components import components


def brute_fingerprint(text):
    import xxhash

    words = (text or "").encode().lower().split() if (text or "").isascii() else [
        w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in (text or "")).encode().split()
    ]
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    """(id, fingerprint) -> smallest id reachable over at most two differing bits."""
    fps = sorted({f for _, f in rows})
    label = {f: f for f in fps}
    changed = True
    while changed:
        changed = False
        for a in fps:
            for b in fps:
                if bin(a ^ b).count("1") <= 2 and label[b] < label[a]:
                    label[a], changed = label[b], True
    least = {}
    for i, f in rows:
        if i is not None:
            least[label[f]] = min(i, least.get(label[f], i))
    return sorted(((i, f, least.get(label[f])) for i, f in rows), key=repr)


@pytest.mark.parametrize("bucket", [simhash.PAIR_BUCKET, 1])
def test_near_duplicates_equal_brute_force(odd_docs, sample, bucket):
    for docs in (odd_docs, sample):
        found = simhash.near_duplicates(docs, pair_bucket=bucket).collect()
        got = sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in found), key=repr)
        assert got == brute_components([(i, brute_fingerprint(t)) for i, t in texts_of(docs)])


@pytest.mark.parametrize("bucket", [2, 10_000])
def test_links_of_a_dense_ball(spark, bucket):
    """All fingerprints within two bits of a centre, and some at three: pairs and cliques give the same components."""
    ball = [0] + [1 << i for i in range(0, 64, 5)] + [1 << i | 1 << j for i in range(0, 64, 7) for j in range(i)]
    ball += [0b111 << 40, 0xFFFF << 10]
    signed = [int(np.array(b, dtype=np.uint64).view(np.int64)) for b in sorted(set(ball))]
    links = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), bucket)
    roots = dict(map(tuple, components(links).collect()))
    got = sorted((f, f % 2**64, None) for f in signed)
    want = {f: root for f, _, root in brute_components([(f, f % 2**64) for f in signed])}
    assert [roots.get(f, f) for f, *_ in got] == [want[f] for f, *_ in got]


def test_deduplicate_keeps_one_row_per_group(odd_docs, no_docs):
    kept = simhash.deduplicate(odd_docs)
    assert kept.columns == odd_docs.columns
    components_of = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(odd_docs).collect()}
    want = sorted(i for i, c in components_of if i is not None and i == c)
    assert sorted(r.doc_id for r in kept.filter("doc_id IS NOT NULL").collect()) == want
    assert kept.filter("doc_id IS NULL").count() == 2  # one with text, one without
    assert simhash.deduplicate(no_docs).count() == 0 and simhash.near_duplicates(no_docs).count() == 0


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1001), (1001, 1000), (5, 5)]
    got = {r.u: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 301)}, 1001: 1000}


def brute_removed(rows, length):
    """Per row of (id, text), ids before nulls last in order: digest of what stays, as the contract says."""
    order = sorted({(i is not None, i or 0, t or "") for i, t in rows})
    seen, out = set(), {}
    for known, i, t in order:
        raw = t.encode()
        gone = np.zeros(len(raw), dtype=bool)
        for k in range(len(raw) - length + 1):
            s = raw[k : k + length]
            if s in seen:
                gone[k : k + length] = True
            seen.add(s)
        runs = int((np.diff(np.concatenate(([0], gone))) == 1).sum()) if len(raw) else 0
        kept = bytes(np.frombuffer(raw, dtype=np.uint8)[~gone])
        out[(known, i, t)] = (len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return sorted(((i, *out[(i is not None, i or 0, t or "")]) for i, t in rows), key=repr)


@pytest.mark.parametrize("length", [100, 7, 2])
def test_repeats_equal_brute_force(odd_docs, length):
    docs = odd_docs.filter("doc_id IS NOT NULL")  # several texts under the null id are ordered by hash, see below
    got = rows_of(suffix_dedup.measure(docs, length), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == brute_removed(texts_of(docs), length)


def test_repeats_on_the_given_documents(sample):
    got = rows_of(suffix_dedup.measure(sample), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == brute_removed(texts_of(sample), 100)


def test_null_ids_come_first(odd_docs):
    rows = {(r.doc_id, r.n_bytes): r.n_removed for r in suffix_dedup.measure(odd_docs).collect()}
    passage = max(len((t or "").encode()) for i, t in texts_of(odd_docs) if i is None)
    assert rows[(None, passage)] == 0 and rows[(4, passage)] == passage and rows[(6, passage)] == passage


def test_remove_cuts_whole_characters(spark, odd_docs, no_docs):
    cut = suffix_dedup.remove(odd_docs)
    assert cut.columns == odd_docs.columns and cut.count() == odd_docs.count()
    assert {r.text for r in cut.filter("doc_id = 6").collect()} == {""}
    assert cut.filter("doc_id = 1").first().text is None
    docs = spark.createDataFrame([(1, "ab" + "é" * 200), (2, "c" + "é" * 199 + "x")], "doc_id long, text string")
    texts = dict(texts_of(suffix_dedup.remove(docs)))
    assert all("�" not in t for t in texts.values()) and texts[2].replace("é", "") == "cx"
    assert suffix_dedup.remove(no_docs).count() == 0


def test_blocks_of_a_text_beyond_the_cache_size(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_BLOCK", 300)
    rng = np.random.default_rng(1)
    long = "".join(map(chr, rng.integers(97, 101, 5000)))
    rows = [(1, long), (2, "x" + long[137:2500] + "yy" + long[3000:])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = rows_of(suffix_dedup.measure(docs, 50), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == brute_removed(rows, 50)


def test_each_text_under_a_null_or_repeated_id_is_a_document(spark):
    """3,000 texts under the null id and 100 under one id: more than any short hash tells apart."""
    rng = np.random.default_rng(2)
    letters = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    passages = [letters(110) for _ in range(40)]
    rows = [(None, passages[i % 40] + letters(20) if i % 3 == 0 else letters(130)) for i in range(3000)]
    rows += [(7, letters(30) + passages[i % 40] if i % 2 else letters(140)) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    order = {r.text: r.h for r in docs.selectExpr("text", "xxhash64(text) AS h").collect()}
    seen, want, left = set(), [], []
    for i, t in sorted(rows, key=lambda x: (x[0] is not None, order[x[1]])):
        strings = [t[k : k + 100] for k in range(len(t) - 99)]
        gone = np.zeros(len(t), dtype=bool)
        for k, x in enumerate(strings):
            if x in seen:
                gone[k : k + 100] = True
        seen.update(strings)
        want.append((i, len(t), int(gone.sum())))
        left.append((i, "".join(c for c, g in zip(t, gone) if not g)))
    assert rows_of(suffix_dedup.measure(docs), "doc_id", "n_bytes", "n_removed") == sorted(want, key=repr)
    assert sorted(texts_of(suffix_dedup.remove(docs)), key=repr) == sorted(left, key=repr)


def test_deduplicate_judges_rows_not_ids(spark):
    rng = np.random.default_rng(3)
    text = lambda: " ".join("".join(map(chr, rng.integers(97, 123, 5))) for _ in range(60))
    a, b, c, d = (text() for _ in range(4))
    rows = [(1, a), (5, a), (5, b), (5, b), (9, c), (None, b), (None, d), (None, d + " "), (None, " " + d), (None, c)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = texts_of(simhash.deduplicate(docs, keep_unnamed=False))
    assert sorted(((i, t.strip()) for i, t in kept), key=repr) == sorted([(1, a), (5, b), (9, c), (None, d)], key=repr)
    named = [x for x in texts_of(simhash.deduplicate(docs)) if x[0] is not None]
    assert sorted(named) == [(1, a), (5, b), (9, c)]
