"""Piece ids and decoded texts against the library that the model belongs to."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import EXPECTED_COUNTS, LONG, count_by, no_documents, odd_documents, results

from cartwheel.llm import pieces
from cartwheel.llm.workload import piece_vocabulary


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=piece_vocabulary())


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel(piece_vocabulary())


def check(library, model, texts):
    ids = [i.tolist() for i in pieces.encode(model, texts)]
    expected = library.encode(texts, num_threads=1)
    assert ids == expected
    assert [pieces.decode(model, np.array(i, dtype=np.int64)) for i in ids] == [library.decode(i) for i in expected]


TRICKY = [
    "", " ", "  a ", "a  b", "▁", " ▁ a▁b", "\ta\n\n b", "\x00a", "<s>x</s><unk><0x41>", "é\U0001F600日本語",
    "⁇ ⁇", "�", "don't we'll  they're", "1234567890 3.14", "x" * 200 + " " * 40 + "the" * 90, "a" * 20_000, LONG,
]


def test_ids_equal_the_library(library, model):
    check(library, model, TRICKY)
    check(library, model, [" " * n for n in range(80)] + ["a" + " " * n + "b" for n in range(40)])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.lists(st.sampled_from(
    ["▁", " ", "   ", "\n", "a", "b", "the", "ing", "é", "日", "\x00", "<s>", "0", "ab", "�"]),
    max_size=60).map("".join)), max_size=4))
def test_ids_of_any_text(library, model, texts):
    check(library, model, texts)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 31_999), st.integers(0, 262), st.sampled_from([28705, 0, 1, 2])), max_size=9))
def test_decoding_any_ids(library, model, ids):
    assert pieces.decode(model, np.array(ids, dtype=np.int64)) == library.decode(ids)


def test_table_starts_afresh(library, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 2)
    monkeypatch.setattr(pieces, "AT_ONCE", 9)
    monkeypatch.setattr(pieces, "LONG_WORD", 3)
    check(library, pieces.PieceModel(piece_vocabulary()), ["the men went home before dark, " * 5, "x", "", "the men"])


def test_each_distinct_word_is_segmented_once(model, monkeypatch):
    asked = []
    monkeypatch.setattr(pieces, "segment", lambda m, words, f=pieces.segment: asked.extend(words) or f(m, words))
    fresh = pieces.PieceModel(piece_vocabulary())
    pieces.encode(fresh, ["one two one", "two one two three", "one two"])
    assert sorted(asked) == ["▁one", "▁three", "▁two"]


def test_pieces_of_odd_rows(spark, library):
    found = pieces.encode_and_decode(odd_documents(spark), piece_vocabulary())
    assert count_by(found) == EXPECTED_COUNTS
    rows = results(found)
    assert rows[2]["ids"] == [] and rows[2]["decoded"] == ""
    for text, doc_id in ((LONG, 5), (" \t\n ", 4), ("", 3)):
        assert rows[doc_id]["ids"] == library.encode(text)
        assert rows[doc_id]["decoded"] == text
    digests = results(pieces.digests(found))
    ids = library.encode(LONG)
    assert digests[5]["n_tokens"] == len(ids)
    assert digests[5]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert digests[2]["ids_sha256"] == hashlib.sha256(b"").hexdigest() == digests[2]["decoded_sha256"]
    assert pieces.encode_and_decode(no_documents(spark), piece_vocabulary()).count() == 0
