"""Piece encoding and decoding against the sentencepiece library, text by text."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_texts import SF

from pathlattice.llm import piece_codec, queries


@pytest.fixture(scope="module")
def model():
    path = queries.piece_model()
    return piece_codec.Pieces(path), sentencepiece.SentencePieceProcessor(model_file=path)


def agree(model, texts, block=piece_codec.BLOCK_CHARS):
    pieces, library = model
    seen = 0
    for i, ids, off in piece_codec.encode_texts(pieces, texts, block):
        raw, ends = pieces.decode(ids, off)
        for k in range(len(off) - 1):
            want = library.encode(texts[i + k], add_bos=True, add_eos=True)
            assert ids[off[k]:off[k + 1]].tolist() == want, texts[i + k][:100]
            assert raw[ends[k]:ends[k + 1]].tobytes().decode() == library.decode(want)
            seen += 1
    assert seen == len(texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=40), min_size=1, max_size=5))
def test_any_text(model, texts):
    agree(model, texts)


@pytest.mark.parametrize("letters", ["thein", "the inand ", "aeths\n", "abcdehinorst   \n\t.,\u2581\u00e9\u65e50123\U0001F600ThIn<>/"])
def test_mixed_letters_and_small_blocks(model, letters):
    """Few letters make many equal pairs in a word and pieces that go on at once; small blocks cut texts between words."""
    rng = random.Random(len(letters))
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 300))) for _ in range(400)]
    agree(model, texts)
    agree(model, texts[:60], block=50)


def test_runs_of_spaces_and_repeats(model):
    agree(model, [" " * n + "a" * (n % 3) + " " * (n // 2) for n in range(150)] + ["a" * n for n in range(200)])
    agree(model, [" " * 6000 + "x" + " " * 777, "", "<s> </s> <0x41> <unk>"], block=100)


def test_no_cut_in_a_long_word(model):
    agree(model, ["the" * 3000, "\u65e5" * 500, "x y" * 2000], block=128)


def test_bytes_that_make_no_character(model):
    pieces, library = model
    for ids in ([1, 3 + 0xC3, 2], [1, 3 + 0xE2, 3 + 0x82, 287, 2], [1, 287, 2]):
        raw, ends = pieces.decode(np.array(ids), np.array([0, len(ids)]))
        assert piece_codec._text_column(raw, ends).to_pylist()[0] == library.decode(ids)


def test_query_on_real_and_odd_rows(llm_spark, model, odd, none, odd_rows):
    pieces, library = model
    got = piece_codec.codec(llm_spark, odd, queries.piece_model()).collect()
    want = sorted(((r[0] if r[0] is not None else -1, library.encode(r[1] or "", add_bos=True, add_eos=True)) for r in odd_rows))
    assert sorted((r.doc_id if r.doc_id is not None else -1, np.frombuffer(r.ids, "<u4").tolist()) for r in got) == want
    assert all(r.n_tokens == len(r.ids) // 4 for r in got)
    assert piece_codec.codec(llm_spark, none, queries.piece_model()).count() == 0
    rows = {r.doc_id: r for r in queries.QUERIES["op12_sentencepiece"](llm_spark, SF).collect()}
    texts = {r.doc_id: r.text or "" for r in llm_spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert rows.keys() == texts.keys()
    for i, t in texts.items():
        ids = library.encode(t, add_bos=True, add_eos=True)
        assert rows[i].n_tokens == len(ids)
        assert rows[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
