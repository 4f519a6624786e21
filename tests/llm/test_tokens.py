import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from riskspark.llm import tokencount
from riskspark.llm.idcoder import decode_block, encode_block
from riskspark.llm.idfiles import read_ids, write_ids
from riskspark.llm.tokens import SETTLED, SPACES, Encoder, public_path
from riskspark.session import work_path

BYTES, WORDS = public_path("byte_bpe_50k.json"), public_path("word_bpe_49k.json")
TEXT = st.text(alphabet=st.sampled_from(list("ab éß'sS.,!?1½ \t\n\r\x0b\x1c\x85  　你😀<|>")) , max_size=40)


@pytest.fixture(scope="module")
def library():
    return {p: Tokenizer.from_file(p) for p in (BYTES, WORDS)}


ENCODER, COUNTER = Encoder(BYTES), tokencount.Counter(WORDS)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, max_size=6))
def test_encoder_equals_the_library(texts):
    want = [e.ids for e in ENCODER.library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u2").tolist() for x in ENCODER.encode(texts)] == want


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, max_size=6))
def test_counter_equals_the_library(texts):
    want = [len(e.ids) for e in COUNTER.library.encode_batch(texts, add_special_tokens=False)]
    assert COUNTER.count(texts) == want


def test_special_strings_and_long_words(library):
    texts = ["a<|endoftext|>b <|startoftext|><|endoftext|>", "q" * 4000 + " " + "ab" * 3000, "<|endoftext|"]
    for own, path in ((lambda t: [len(x) // 2 for x in ENCODER.encode(t)], BYTES), (COUNTER.count, WORDS)):
        want = [len(e.ids) for e in library[path].encode_batch(texts, add_special_tokens=False)]
        assert own(texts) == want


def test_memory_starts_anew(monkeypatch, documents):
    import riskspark.llm.tokens as tokens

    monkeypatch.setattr(tokens, "MEMORY_WORDS", 50)
    monkeypatch.setattr(tokencount, "MEMORY_WORDS", 50)
    texts = [r.text for r in documents.limit(30).collect()]
    encoder, counter = Encoder(BYTES), tokencount.Counter(WORDS)
    whole = [e.ids for e in encoder.library.encode_batch(texts, add_special_tokens=False)]
    for at in range(0, 30, 3):
        assert [np.frombuffer(x, "<u2").tolist() for x in encoder.encode(texts[at:at + 3])] == whole[at:at + 3]
        assert counter.count(texts[at:at + 3]) == [
            len(e.ids) for e in counter.library.encode_batch(texts[at:at + 3], add_special_tokens=False)]


def test_words_of_settled_characters_do_not_go_to_the_library(monkeypatch):
    texts = ["Où l'été naïf où où", "Ça dépend de où.\nÉté", "Привет мир 你好 ñandú", "x <|endoftext|>é 😀é où"]
    want = [e.ids for e in ENCODER.library.encode_batch(texts, add_special_tokens=False)]
    asked, whole = [], ENCODER._whole
    monkeypatch.setattr(ENCODER, "_whole", lambda items: asked.extend(items) or whole(items))
    assert [np.frombuffer(x, "<u2").tolist() for x in ENCODER.encode(texts)] == want
    # The first words, and what holds a special string or another character.
    assert sorted(asked) == sorted(["Où", "Ça", "Привет", "x", " <|endoftext|>é 😀é"])
    # Without a special string to look for, tiktoken stops at every character.
    assert ENCODER.ranked.special_tokens_set == {"<|endoftext|>"}


def test_settled_characters_are_cut_as_the_library_does():
    every = pa.array([chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000])
    settled = every.filter(pc.match_substring_regex(every, f"^[{SETTLED}]$")).to_pylist()
    assert {"\x00", "a", "ÿ", "ж", "你", "한"} <= set(settled) and "😀" not in settled and "\u2028" not in settled
    texts = [" a{0}b1{0}2!{0}?{0}{0}'s".format(c) for c in settled if c not in SPACES]
    want = [e.ids for e in ENCODER.library.encode_batch_fast(texts, add_special_tokens=False)]
    assert [ENCODER.ranked.encode_ordinary(t) for t in texts] == want


def test_counts_of_documents(documents, library):
    rows = documents.collect()
    want = {r.doc_id: len(e.ids) for r, e in zip(rows, library[WORDS].encode_batch(
        [r.text for r in rows], add_special_tokens=False), strict=True)}
    got = tokencount.count_tokens(documents, WORDS).collect()
    assert {r.doc_id: r.n_tokens for r in got} == want
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got)


def test_counts_of_odd_rows(make_docs, odd, library):
    got = tokencount.count_tokens(make_docs(odd, n_tokens="x"), WORDS).collect()
    want = [len(library[WORDS].encode(t or "", add_special_tokens=False).ids) for _, t in odd]
    assert sorted(r.n_tokens for r in got) == sorted(want)
    assert sorted(r.n_bytes for r in got) == sorted(len((t or "").encode()) for _, t in odd)
    assert tokencount.count_tokens(make_docs([]), WORDS).collect() == []


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 700, 3000])
@pytest.mark.parametrize("high", [1, 7, 50_257])
def test_block_round_trip(n, high):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(0.01, n) - 1, high - 1)
    assert (decode_block(encode_block(ids, high)) == ids).all()


def test_repeats_cost_little_and_damage_is_found():
    ids = np.tile(np.arange(200), 100)
    block = encode_block(ids, 50_257)
    assert len(block) < len(ids) // 2
    for at in (0, 10, 30, len(block) - 1):
        bad = bytearray(block)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            decode_block(bytes(bad))
    with pytest.raises(ValueError):
        encode_block(np.array([5]), 5)


N = np.arange(200_001)


@pytest.mark.parametrize("ids, high, size, crc", [
    (N * N // 7 % 997 * (N % 3 + 1), 50_257, 60851, 1201414400),
    (N % 200, 50_257, 18711, 835367678),
    (N[:700] ** 2 % 251, 1 << 18, 607, 28949692),
    (N[:0], 1, 25, 558161692)])
def test_blocks_are_byte_for_byte_what_they_were(ids, high, size, crc):
    block = encode_block(ids, high)
    assert (len(block), zlib.crc32(block)) == (size, crc)
    assert (decode_block(block) == ids).all()


def expected(pairs, library):
    out = []
    for doc_id, text in pairs:
        ids = library[BYTES].encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    return out


def test_store_round_trip(spark, documents, library):
    path = work_path(spark, "ids-test")
    write_ids(documents, BYTES, path, block_ids=5000)
    assert spark.read.parquet(path).count() > 4
    got = sorted(read_ids(spark, path).collect())
    want = sorted(expected([(r.doc_id, r.text) for r in documents.collect()], library))
    assert [(r.doc_id, r.n_tokens, r.ids_crc32) for r in got] == want
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1]]


def test_store_of_odd_rows(spark, make_docs, odd, library):
    path = work_path(spark, "ids-odd")
    write_ids(make_docs(odd, block=3), BYTES, path)
    got = read_ids(spark, path, with_ids=True).collect()
    assert sorted(((r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in got)) == sorted(
        (i or 0, n, c) for i, n, c in expected(odd, library))
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in got)
    starts = sorted((r.start, r.n_tokens) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:], strict=False))
    path = work_path(spark, "ids-empty")
    write_ids(make_docs([]), BYTES, path)
    assert read_ids(spark, path).collect() == []
