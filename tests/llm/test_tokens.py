import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from larder.llm.bpe import Vocabulary, WordStore, bpe_decode, bpe_encode, bpe_round_trip
from larder.llm.queries import END_ID, TOKENIZERS
from larder.llm.token_files import BLOCK, TokenFile, library_words, pack, to_file, token_file_digests, unpack

PATH = f"{TOKENIZERS}/word_bpe_49k.json"
TEXTS = [
    None,
    "",
    " \n\t",
    "Hello  wörld's 123 ½ naïve\n<|endoftext|> 日本語 <|STARTOFTEXT|> <|endoftext|>x İ ÁΣΑΣ",
    "a\x1cb\x85c\xa0d aaaaaaaaaaaaaaaaaa !!!!!!!!!! é 'sam I'll 'LL <|startoftext|><|endoftext|>abc",
    "ǅ ŉ ẞ ß 1a2b ٣٤ ② ᾳ ﻿ 😀👍🏽 \x00 \x07 ՘x Ᲊ Ɤ",
    "lorem ipsum " * 30_000,
    "lorem ipsum " * 30_000,
    "x" * 5_000,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def documents(spark, texts):
    return spark.createDataFrame([(k, t, 1, "s") for k, t in enumerate(texts)], "doc_id long, text string, ids int, n_tokens string")


def test_encoding_equals_the_library(spark, library):
    docs = documents(spark, TEXTS)
    expected = {k: library.encode(t or "", add_special_tokens=False).ids for k, t in enumerate(TEXTS)}
    encoded = bpe_encode(docs, PATH)
    assert {r.doc_id: list(r.ids) for r in encoded.collect()} == expected
    texts = {r.doc_id: r.text for r in bpe_decode(encoded, PATH).collect()}
    assert texts == {k: library.decode(i, skip_special_tokens=False) for k, i in expected.items()}
    for r in bpe_round_trip(docs, PATH).collect():
        assert r.n_tokens == len(expected[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, expected[r.doc_id])).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_every_letter(library):
    texts = [f"{chr(c)}x{chr(c)} {chr(c)}." for c in [*range(1, 0x3400), *range(0xA000, 0xAC00), *range(0x1F000, 0x1FB00)]]
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for words in (Vocabulary(PATH).encode_words, library_words(PATH)):
        ids, counts = WordStore(words).encode(texts)
        ends = np.cumsum(counts)
        assert [ids[e - n : e].tolist() for e, n in zip(ends, counts)] == expected


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=20))
def test_any_text(texts):
    library = Tokenizer.from_file(PATH)
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    expected = [library.encode(t, add_special_tokens=False).ids for t in texts]
    for words in (Vocabulary(PATH).encode_words, library_words(PATH)):
        ids, counts = WordStore(words).encode(texts)
        ends = np.cumsum(counts)
        assert [ids[e - n : e].tolist() for e, n in zip(ends, counts)] == expected


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 1), st.integers(0, 1 << 16), st.integers(0, (1 << 64) - 1)), max_size=300))
def test_packing_round_trip(values):
    words, _ = pack(np.array(values, np.uint64), 64)
    assert unpack(words, len(values)).tolist() == values


def test_blocks_decode_alone():
    values = np.random.default_rng(1).integers(0, 50_000, 3 * BLOCK + 7)
    values[5000] = 1 << 62
    file = TokenFile(to_file([None, 7], np.array([10, len(values) - 10]), values))
    assert file.doc_ids == [None, 7]
    assert (file.ids() == values).all()
    for a, b in ((0, 1), (BLOCK - 1, BLOCK + 1), (2 * BLOCK, 3 * BLOCK + 7), (5, 5)):
        assert (file.ids(a, b) == values[a:b]).all()
    assert len(to_file([1], np.array([len(values)]), values)) < 4 * len(values)


def test_token_files(spark, library):
    rows = [(None, "no id"), *((k * 7 % 31, t) for k, t in enumerate(TEXTS))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    start = 0
    expected = []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, END_ID]
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    found = sorted(map(tuple, token_file_digests(docs, PATH, END_ID).collect()), key=lambda r: r[1])
    assert found == expected


def test_empty_table(spark):
    docs = documents(spark, [])
    assert token_file_digests(docs, PATH, END_ID).count() == 0
    assert bpe_round_trip(docs, PATH).count() == 0
