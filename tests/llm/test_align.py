import hashlib
from collections import Counter, defaultdict

import pytest

from voltmart.llm import align
from voltmart.llm.encode import tokenizer_path

TEXTS = [
    None, "", " ", "a ", " a", "a  b", "a   b\n\n c", "<|endoftext|> <s> </s> <0x0A> <unk>", "don't 'll it's. ok,\nA. b", "\n \n",
    "漢字😀x 漢 é ́a", "Σ ΑΣ ΑΣ. ς", "a  b 　c", "has ▁ inside", "▁", "\x00 nul\x00", "aaaa" * 300, "1234567 89.5% x=1;",
    "the cat sat on the mat", "the cat sat on the mat", "the cat sat on the rug", "  x\u0085 y", "ﬁ ½ Å", "\U0001f469‍\U0001f680",
]


def tokens(text):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    if not hasattr(tokens, "of"):
        a = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
        a.encode_special_tokens = True
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        table = {chr(b): b for b in shown}
        for b in range(256):
            if b not in shown:
                table[chr(256 + len(table) - len(shown))] = b
        tokens.of = a, SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model")), table
    a, b, table = tokens.of
    one = [(i, bytes(table[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    two = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        two.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    return one, two


def groups_of(text):
    """Groups of ids by walking both token lists byte by byte."""
    if not text:
        return []
    one, two = tokens(text)
    raw = (" " + text).encode()
    if b"".join(x for _, x in one) != raw or b"".join(x for _, x in two) != raw:
        return []
    found, at, left, right = [], [0, 0], [], []
    one, two = iter(one), iter(two)
    while at[0] < len(raw) or at[1] < len(raw):
        side = 0 if at[0] <= at[1] else 1
        i, x = next((one, two)[side])
        (left, right)[side].append(i)
        at[side] += len(x)
        if at[0] == at[1]:
            found.append((left, right))
            left, right = [], []
    return found


def brute_force(texts):
    groups = [groups_of(t) for t in texts]
    pairs = [Counter((x, y) for g in doc for x in g[0] for y in g[1]) for doc in groups]
    docs = Counter(p for doc in pairs for p in doc)
    most = defaultdict(int)
    for (a, _), n in docs.items():
        most[a] = max(most[a], n)
    for g, p in zip(groups, pairs):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        yield (
            sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(p.values()),
            sum(n for k, n in p.items() if docs[k] == most[k[0]]), sum(n * docs[k] for k, n in p.items()),
            hashlib.sha256(text.encode()).hexdigest() if g else "",
        )


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def result(frame):
    return {r.doc_id: tuple(r[c] for c in COLUMNS) for r in frame.collect()}


@pytest.mark.parametrize("limit", [0, 10**6])
def test_odd_texts_equal_brute_force(spark, limit):
    from voltmart.session import materialize

    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string").repartition(3)
    found = result(align.with_counts(materialize(align.align(docs)), limit))
    want = dict(enumerate(brute_force(TEXTS)))
    for i, t in enumerate(TEXTS):
        assert found[i] == want[i], (t, found[i], want[i])
    assert sum(w[0] == 0 for w in want.values()) >= 4  # nulls, empty texts and those that a tokenizer does not give back


def test_whole_table_equals_brute_force(sample):
    rows = sample.select("doc_id", "text").collect()
    want = dict(zip([r.doc_id for r in rows], brute_force([r.text for r in rows])))
    assert result(align.alignment(sample)) == want


def test_nulls_copies_empty_table_and_clashing_columns(spark, odd_docs, no_docs):
    found = align.alignment(odd_docs.withColumnsRenamed({"fp": "a", "tag": "b", "key": "links", "spans": "n_a"}))
    texts = [r.text for r in odd_docs.collect()]
    assert sorted(tuple(r[c] for c in COLUMNS) for r in found.collect()) == sorted(brute_force(texts))
    assert found.filter("doc_id IS NULL").count() == 2
    assert align.alignment(no_docs).count() == 0


def test_words_are_cut_only_where_both_tokenizers_cut(spark, sample, monkeypatch):
    from voltmart.llm.encode import send_tokenizer

    source = send_tokenizer(spark, tokenizer_path("byte_bpe_50k.json")).value
    with open(tokenizer_path("piece_bpe_32k.model"), "rb") as file:
        aligner = align.Aligner(source, file.read())
    assert aligner.by_word
    for text in [t for t in TEXTS if t] + [r.text for r in sample.limit(30).collect() if r.text]:
        words = aligner.words(text)
        assert "".join(words) == " " + text
        cache = {}
        aligner.learn(words, cache)
        parts = [cache[w] for w in words]
        whole = aligner.tokens(text)
        if whole is None:
            assert any(p is None for p in parts)
            continue
        record = next(align._records(*whole, whole[1][-1:]))
        assert ";".join(p[0] for p in parts) == record[0]
        assert [sum(p[i] for p in parts) for i in range(1, 5)] == [int(x) for x in record[1:5]]
