"""Best-fit packing: ids of the library, gapless sequences, few of them, odd rows."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import public_tokenizers
from duebook.llm import catalog, packing

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, uid string, size string, bin int"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "x", "big", 4) for i, t in rows], SCHEMA)


def cuts(rows, tokenizer, capacity):
    """(doc_id, piece, start, length, crc) of every piece."""
    out = []
    for i, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        first = len(ids) if len(ids) <= capacity else (len(ids) % capacity or capacity)
        at = [0, *range(first, len(ids) + 1, capacity)]
        out += [(i, n, a, b - a, zlib.crc32(ids[a:b].tobytes())) for n, (a, b) in enumerate(zip(at, at[1:]))]
    return sorted(out, key=str)


def check(rows, capacity):
    """Sequences are gapless and not too long; returns how many there are, and the least there can be."""
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for members in sequences.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), -(-sum(r.length for r in rows) // capacity)


def test_registered_query(spark, tokenizer):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    rows = catalog.queries()["op12_best_fit"](spark, FOLDER).collect()
    got = sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=str)
    assert got == cuts([(d.doc_id, d.text) for d in docs], tokenizer, packing.CAPACITY)
    used, least = check(rows, packing.CAPACITY)
    assert used <= 1.02 * least + 1


def test_odd_rows(spark, tokenizer):
    rows = [
        (1, None), (2, ""), (None, "no id"), (3, "same text"), (3, "same text"), (4, " \n\t  "), (5, "wort " * 40_000),
        (6, "a" * 10_000), (7, "日本語のテキスト" * 200), (8, "a\x1cb \x85 !\x1c c᠎ d"), (9, "x <|endoftext|> y<|endoftext|>"),
        (10, "It's  we'll\n\n  don't\tx   y　z 12 ''s 's  "),
    ]
    frame = documents(spark, rows)
    for capacity in (64, 2048):
        got = packing.pack(frame, capacity=capacity).collect()
        assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == cuts(rows, tokenizer, capacity)
        used, least = check(got, capacity)
        assert used <= least + 2
    assert packing.pack(documents(spark, [])).count() == 0


def test_random_texts_are_encoded_as_by_the_library(tokenizer):
    rng = np.random.default_rng(1)
    signs = list("ab'1 \n\t\r\x0b\x1c\x1f\x85 ᠎​ 　﻿é日🙂!<|>")
    texts = ["".join(rng.choice(signs, int(rng.integers(0, 40)))) for _ in range(3000)]
    encoder = packing.Encoder(public_tokenizers.path(packing.VOCABULARY))
    for at in range(0, 3000, 50):
        for text, raw in zip(texts[at: at + 50], encoder.ids(texts[at: at + 50])):
            want = tokenizer.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(raw, dtype="<u4").tolist() == want, repr(text)


def test_words_are_encoded_as_by_the_library(tokenizer):
    rng = np.random.default_rng(2)
    words = [" Straße", "\nÉtait", " naïve's", " don't", " ½x", " abcДЕ", " x1y2", " ×a", " Ǆo", " e\u0301a", "\n\nZ", "  q", " A<|endoftext|>b",
             " ǀǁ", " ꞌa", "'ll", " I'LL", " ", "\n", "--", " 3.14", " end."]
    encoder = packing.Encoder(public_tokenizers.path(packing.VOCABULARY))
    for _ in range(300):
        texts = ["".join(rng.choice(words, int(rng.integers(0, 12)))) for _ in range(8)]
        for text, raw in zip(texts, encoder.ids(texts)):
            want = tokenizer.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(raw, dtype="<u4").tolist() == want, repr(text)


def test_every_plain_character_is_encoded_as_by_the_library(tokenizer):
    encoder = packing.Encoder(public_tokenizers.path(packing.VOCABULARY))
    plain = [chr(c) for c in range(0x250) if packing._PLAIN.fullmatch(chr(c))]
    texts = [f"{a}{c}{b}" for c in plain for a in ("", " ", "a", "1", "!", "'", "\n", "é") for b in ("", " x", "s", "2", "?", "\n\n")]
    want = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    assert all(packing._PLAIN.fullmatch(t) for t in texts)
    assert [np.frombuffer(raw, dtype="<u4").tolist() for raw in encoder.ids(texts)] == want


def pack_sizes(spark, sizes, capacity):
    items = spark.createDataFrame(list(enumerate(sizes)), "id long, size long")
    rows = packing.best_fit(items, capacity).collect()
    assert sorted((r.id, r["size"]) for r in rows) == list(enumerate(sizes))
    load = {}
    for r in rows:
        load[r.bin] = load.get(r.bin, 0) + r["size"]
    assert max(load.values(), default=0) <= capacity
    return len(load)


@pytest.mark.parametrize("name, sizes, most", [
    ("all equal, three fit", [300] * 400, 134),
    ("all of one id", [1] * 3000, 3),
    ("halves", [500] * 101, 51),
    ("just over a half", [501] * 60, 60),
    ("one item", [1000], 1),
    ("pairs that fill", [600] * 50 + [400] * 50, 50),
    ("nothing", [], 0),
])
def test_number_of_bins(spark, name, sizes, most):
    assert pack_sizes(spark, sizes, 1000) <= most


def test_few_bins_on_mixed_sizes(spark):
    rng = np.random.default_rng(6)
    sizes = np.minimum(1000, rng.lognormal(5, 1, 2000).astype(int) + 1).tolist()
    assert pack_sizes(spark, sizes, 1000) <= 1.02 * (sum(sizes) / 1000) + 1


def test_rounds_match_ranges_by_rank():
    # Range 0 leaves 3 gaps, range 1 two pieces and one gap, range 2 three pieces.
    assert packing._across([(0, 0, 3), (1, 2, 1), (2, 3, 0)]) == [(0, 2, 1, 0, 2), (1, 0, 2, 0, 1), (0, 0, 2, 1, 1)]
