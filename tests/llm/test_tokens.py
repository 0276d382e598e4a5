import zlib

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import texts_of
from voltmart.llm import encode, packing, token_files
from voltmart.llm.encode import Encoder, tokenizer_path

TEXTS = [
    "", " ", "a ", " a", "a  b", "a   b\n\n c", "x y", "x y", "<|endoftext|> hi<|startoftext|>", "don't 'll it's. ok,\nA. b",
    "a<|endoftext|>b", "x <|startoftext|>", "<|endoftext|>", "<|ENDOFTEXT|> <|endoftext |>", "\n \n", "\t x", "é é ́a", "Σ ΑΣ ΑΣ. ς", "a  b  c", "\x1c a \x1cb ᠎ c ​ d", None, "3 4,5. 66 end.\nNext, .. ,",
]


def ids_of(name, text):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path(name))  # left as loaded
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids, dtype="<u4")


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_cached_encoding_equals_whole_texts(name):
    with open(tokenizer_path(name)) as file:
        encoder = Encoder(file.read(), cache_words=3)
    for _ in range(2):  # the second round finds an over-full cache
        assert encoder.encode(TEXTS) == [ids_of(name, t).tobytes() for t in TEXTS]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_latin_words_and_marks_equal_the_plain_call(name):
    with open(tokenizer_path(name)) as file:
        encoder = Encoder(file.read())
    parts = ["École é.", "À,\nÇa.\n ñ", "naïve,coeur", "µm ªº ß ẞ İx Straße", "n.\r\nB", "÷×À", "ſ Ǆ ŉ", "Ab.\nCD,\nef", "a.\n", "'S É's"]
    texts = [f"{a} {b}" for a in parts for b in parts]
    assert encoder.encode(texts) == [ids_of(name, t).tobytes() for t in texts]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("cache_words", [3, 1000])
def test_encoding_of_arrays_equals_whole_texts(name, cache_words):
    from tokenizers import Tokenizer

    with open(tokenizer_path(name)) as file:
        encoder = Encoder(file.read(), cache_words=cache_words)
    wide = [f"a {c}b" for c in "\t\n\x0b\x1c\x1f\x85\xa0\u1680\u180e\u2005\u2028\u202f\u205f\u3000"]
    marks = ["une.\nÉvié&&& le,%%%", "x### y.&&&\nZ*** .,", "a$ b.. c,\n\nd e'% it's.& 3% x%3", "é#́ a&b %a", "THE.!! The the!? a:b; Él éL ÉL"]
    texts = [*TEXTS, *wide, *marks, "one two one", "two one " * 50 + "six"]
    plain = Tokenizer.from_file(tokenizer_path(name))  # left as loaded
    want = {t: np.array(plain.encode(t or "", add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts + [" "]}
    for part in (texts, texts[::-1], ["", None], [" "], texts[-1:], []):  # later rounds find an over-full cache
        found = encoder.encode_array(pa.array(part, pa.string()))
        assert found == [want[t] for t in part] == encoder.encode(part)
    assert encoder.encode_array(pa.array(texts)[3:9]) == [want[t] for t in texts[3:9]]


def test_common_words_outlive_a_full_cache_and_the_tokenizer_is_loaded_once(monkeypatch):
    with open(tokenizer_path("byte_bpe_50k.json")) as file:
        source = file.read()
    encoder, asked = Encoder(source, cache_words=3), []
    encoder.encode(["x one two three", "x four five"])
    ask = encoder._ask
    monkeypatch.setattr(encoder, "_ask", lambda words, *rest: (asked.extend(words := list(words)), ask(words, *rest)))
    encoder.encode(["x one two six"])
    assert [w for w in asked if w in ("one", "two", "three", "six")] == ["six"]
    assert "four" not in encoder.words and "one" in encoder.words
    assert encode.worker_encoder(source) is encode.worker_encoder(source)
    assert encode.worker_encoder(source, 7).cache_words == 7
    assert encode.worker_encoder(source).cache_words == encode.CACHE_WORDS


def test_binary_lengths():
    assert packing.binary_lengths(2048 * 2 + 13, 2048).tolist() == [2048, 2048, 8, 4, 1]
    assert packing.binary_lengths(1, 2048).tolist() == [1]


def test_packing_covers_every_id_once(odd_docs, no_docs):
    pieces = packing.pack(odd_docs, limit=64, with_ids=True).toPandas()
    assert sorted(pieces.sequence_id) == list(range(len(pieces)))
    assert (pieces.offset == 0).all() and (pieces.length & (pieces.length - 1) == 0).all() and pieces.length.max() == 64
    assert [zlib.crc32(i) for i in pieces.ids] == pieces.ids_crc32.tolist()
    by_bucket = pieces.sort_values("sequence_id")
    assert by_bucket.length.is_monotonic_decreasing
    want = sorted(np.append(ids_of("byte_bpe_50k.json", t), 1).astype("<u4").tobytes() for _, t in texts_of(odd_docs))
    got = []
    pieces["key"] = pieces.doc_id.fillna(-1)
    for (key, total), part in pieces.groupby(["key", "doc_tokens"]):
        copies = int(part.length.sum() // total)
        assert sorted(part.start) == sorted(part.start.unique().tolist() * copies)
        one = part.sort_values("start").drop_duplicates("start")
        got += [b"".join(one.ids)] * copies
    assert sorted(got) == want
    assert packing.pack(no_docs).count() == 0
    with pytest.raises(ValueError):
        packing.pack(odd_docs, limit=100)


def test_coder_round_trip():
    rng = np.random.default_rng(0)
    skewed = np.minimum(rng.zipf(1.3, 5000), 65535).astype("<u4")
    for raws in ([], [b"\x01\0\0\0"], [skewed.tobytes(), b"", np.full(4000, 65535, "<u4").tobytes()], [skewed[:3].tobytes()]):
        data = token_files.write_container([None, 5, 6, 7][: len(raws)], raws, block_tokens=700)
        assert token_files.read_container(data) == ([None, 5, 6, 7][: len(raws)], raws)
    data = bytearray(token_files.write_container([1], [skewed.tobytes()]))
    assert len(data) < 2 * len(skewed)
    data[-40] ^= 255
    with pytest.raises(ValueError, match="damaged"):
        token_files.read_container(bytes(data))


def test_groups_of_blocks_stand_alone(monkeypatch):
    ids = np.minimum(np.random.default_rng(1).zipf(1.2, 3000), 65535).astype("<u4")
    whole = token_files.write_container([7], [ids.tobytes()], block_tokens=100)
    monkeypatch.setattr(token_files, "GROUP_BLOCKS", 4)
    assert token_files.write_container([7], [ids.tobytes()], block_tokens=100) == whole
    assert token_files.read_container(whole) == ([7], [ids.tobytes()])


def test_rare_and_flat_ids_round_trip():
    rng = np.random.default_rng(2)
    for ids in (rng.permutation(65536)[:9000], rng.integers(0, 65536, 9000), np.tile([0, 65535, 1], 3000)):
        raw = ids.astype("<u4").tobytes()
        assert token_files.read_container(token_files.write_container([None], [raw])) == ([None], [raw])


def test_coded_bytes_are_fewer_than_deflated(sample):
    with open(tokenizer_path("word_bpe_49k.json")) as file:
        raws = Encoder(file.read()).encode([t for _, t in texts_of(sample)])
    ids = np.frombuffer(b"".join(raws), "<u4")
    step = token_files.BLOCK_TOKENS
    deflated = sum(len(zlib.compress(ids[i : i + step].astype("<u2").tobytes(), 9)) for i in range(0, len(ids), step))
    assert len(token_files.write_container([1], [ids.tobytes()])) < 0.9 * deflated


def test_lanes_of_a_block_are_coded_side_by_side_and_share_what_is_learned(sample, monkeypatch):
    with open(tokenizer_path("word_bpe_49k.json")) as file:
        raws = Encoder(file.read()).encode([t for _, t in texts_of(sample)])
    steps, predict = [], token_files._Models.predict
    monkeypatch.setattr(token_files._Models, "predict", lambda self, n: (steps.append(n), predict(self, n))[1])
    data = token_files.write_container([None] * len(raws), raws)
    tokens = sum(map(len, raws)) // 4
    assert sum(steps) == tokens and len(steps) < 2 * token_files.LANE_TOKENS  # 4,096 steps before
    assert len(data) - 13 * len(raws) < 1.03 * tokens
    assert token_files.read_container(data)[1] == raws and len(steps) < 4 * token_files.LANE_TOKENS


@pytest.mark.parametrize("tokens", [1, 2, 255, 256, 511, 512, 513, 256 * 4096 + 1, 1 << 20])
def test_lanes_cover_a_block(tokens):
    lanes, opened = token_files._lanes(tokens)
    assert opened.sum() == tokens and opened.max() == lanes <= token_files.LANES and (opened >= lanes - 1).all()
    ids = np.random.default_rng(tokens).geometric(0.01, tokens).astype("<u4") % 65536
    assert (token_files.decode_block(token_files.encode_block(ids), tokens) == ids).all()


def test_every_damaged_byte_is_found():
    ids = np.random.default_rng(4).geometric(0.02, 700).astype("<u4")
    data = token_files.write_container([1], [ids.tobytes()])
    for at in range(12 + 13 + 12, len(data)):
        bad = bytearray(data)
        bad[at] ^= 1 << at % 8
        if at % 7 == 0 or at > len(data) - 20:
            with pytest.raises(ValueError, match="damaged"):
                token_files.read_container(bytes(bad))
    with pytest.raises(ValueError, match="damaged"):
        token_files.read_container(data[:-4])


def test_a_shared_id_is_dealt_to_many_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as with partitions of full size
    docs = spark.range(4000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "concat('word ', id) AS text")
    try:
        token_files.write(docs, str(tmp_path / "t"), container_tokens=500)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = token_files.read(spark, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).select("part").distinct().count() > 1
    assert rows.count() == 4000 and rows.select("start").distinct().count() == 4000
    assert rows.selectExpr("max(start + n_tokens) = sum(n_tokens)").first()[0]


def test_files_hold_all_documents_in_order(spark, odd_docs, no_docs, tmp_path):
    token_files.write(odd_docs, str(tmp_path / "t"), container_tokens=500)
    rows = token_files.read(spark, str(tmp_path / "t")).orderBy("start").collect()
    assert [r.start for r in rows] == np.cumsum([0] + [r.n_tokens for r in rows])[:-1].tolist()
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    want = sorted(np.append(ids_of("word_bpe_49k.json", t), 1).astype("<u4").tobytes() for _, t in texts_of(odd_docs))
    assert sorted(bytes(r.ids) for r in rows) == want
    assert token_files.round_trip(no_docs).count() == 0
