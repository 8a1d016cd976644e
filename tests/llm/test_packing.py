"""Packing against the tokenizer itself."""

from __future__ import annotations

import struct
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from adperf.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(packing.tokenizer_path())


def expected(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def check(spark, tokenizer, docs, window=packing.SEQUENCE_TOKENS):
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    pieces = packing.pack(frame, window=window).collect()
    want = {}
    for d, t in docs:
        want.setdefault(d, []).append(expected(tokenizer, t))
    total = sum(len(x) for xs in want.values() for x in xs)
    by_place = sorted(pieces, key=lambda p: (p.sequence_id, p.offset))
    at = 0
    for p in by_place:  # no gap, no overlap, full windows
        assert p.sequence_id * window + p.offset == at and p.offset + p.length <= window
        at += p.length
    assert at == total
    rebuilt, ids = {}, []
    for p in by_place:
        assert len(p.ids) == 4 * p.length
        ids = [] if p.start == 0 else ids
        assert len(ids) == p.start
        ids = [*ids, *struct.unpack(f"<{p.length}I", p.ids)]
        if len(ids) == p.doc_tokens:
            rebuilt.setdefault(p.doc_id, []).append(ids)
    assert {k: sorted(v) for k, v in rebuilt.items()} == {k: sorted(v) for k, v in want.items()}
    return frame, pieces


def test_pieces_rebuild_the_documents(spark, tokenizer, tables):
    docs = [(d["doc_id"], d["text"]) for d in tables("documents")]
    check(spark, tokenizer, docs)


def test_nulls_empties_repeats_and_long_texts(spark, tokenizer):
    docs = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "x"), (5, "word " * 9000), (6, "<|endoftext|> é İ 漢字 ́")]
    check(spark, tokenizer, docs, window=64)


def test_empty_table_and_clashing_names(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    frame = spark.createDataFrame([(1, "a", 9, "z")], "doc_id long, text string, part int, ids string")
    assert [(p.doc_id, p.length) for p in packing.pack(frame).collect()] == [(1, 2)]


def test_checksums(spark):
    frame = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    piece = packing.pack(frame).first()
    assert packing.piece_digests(packing.pack(frame)).first().ids_crc32 == zlib.crc32(piece.ids)


def test_sequences_hold_their_pieces_and_are_padded(spark, tokenizer):
    frame = spark.createDataFrame([(1, "a b c d e f g"), (2, "h i")], "doc_id long, text string").coalesce(1)
    rows = packing.sequences(packing.pack(frame, window=8), window=8, pad_id=7).orderBy("sequence_id").collect()
    ids = expected(tokenizer, "a b c d e f g") + expected(tokenizer, "h i")
    assert [r.n_tokens for r in rows] == [8, 3]
    assert [r.padded_tokens for r in rows] == [8, 8]
    assert b"".join(r.ids for r in rows) == struct.pack("<16I", *ids, *[7] * 5)
    two = packing.sequences(packing.pack(frame.filter("doc_id = 2").select("doc_id", "text"), window=8), window=8)
    three = two.first()
    assert (three.n_tokens, three.padded_tokens) == (3, 8)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(
    st.sampled_from("abz AZ'stre mlvd09²½ÀÿŁİßſǅ.,!<|>\n\t\x0b\x1c\xa0#$%"), st.characters(codec="utf-8")), max_size=60))
def test_encoder_gives_the_tokenizers_ids(text):
    encode, whole = _both()
    got = encode(text)
    assert list(struct.unpack(f"<{len(got) // 4}I", got)) == whole.encode(text, add_special_tokens=False).ids


def _both(cache={}):  # noqa: B006
    if not cache:
        cache["x"] = packing.encoder(packing.tokenizer_path()), Tokenizer.from_file(packing.tokenizer_path())
    return cache["x"]
