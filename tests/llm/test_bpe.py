from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_support import SF_SMALL, make, odd_docs  # noqa: F401
from tokenizers import Tokenizer

from sleeper.llm import bpe as B
from sleeper.llm import queries
from sleeper.llm.lexicon import Lexicon
from sleeper.llm.pieces import Pieces

VOCAB = queries.vocabulary()


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(VOCAB)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def own():
    bpe = B.Bpe(VOCAB)
    words = [b"the", b" the", b"he", b" then", b"then", b" and", b"ing", b"."]
    return B.Encoder(bpe, Lexicon.compile({w: bpe.merge(w) for w in words}))


def ids(encoder, text):
    return np.frombuffer(encoder.texts([text])[0], "<u4").tolist()


def test_every_sign_between_letters_and_spaces(library, own):
    signs = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF and (c < 0x3100 or c % 37 == 0)]
    texts = []
    for i in range(0, len(signs), 50):
        texts += ["".join(f"a{c}b {c} {c}{c}d  {c} \n{c} 1{c}" for c in signs[i:i + 50])]
    for text, e in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert ids(own, text) == e.ids


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab'stdmrevl 1\n\t.,<|>endoftext é漢  \x1c\x85\U0001f600"), max_size=60))
def test_random_texts(library, own, text):
    text = text.replace("<>", "<|endoftext|>")
    e = library.encode(text, add_special_tokens=False)
    assert ids(own, text) == e.ids
    assert own.bpe.decode(e.ids) == library.decode(e.ids, skip_special_tokens=False)


def test_long_words_and_broken_ids(library, own):
    rng = random.Random(3)
    for text in ("x" * 5000, "".join(rng.choice("abcdefgh") for _ in range(3000)), "é" * 900, "=" * 4000, " " * 999):
        assert ids(own, text) == library.encode(text, add_special_tokens=False).ids
    for _ in range(200):
        some = [rng.randrange(50257) for _ in range(8)]
        assert own.bpe.decode(some) == library.decode(some, skip_special_tokens=False)


def test_pieces_forget_and_stay_right(library):
    p = Pieces(lambda pieces: [np.array(library.encode(x).ids, "<u4").tobytes() for x in pieces], kept=10)
    for text in ("one two three four five six", "seven eight nine ten eleven", "one two twelve thirteen") * 3:
        assert np.frombuffer(p.texts([text])[0], "<u4").tolist() == library.encode(text).ids
        assert len(p.ids) <= 16


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.binary(max_size=6), st.lists(st.integers(0, 9), max_size=4), max_size=40), st.lists(st.binary(max_size=6)))
def test_lexicon_is_a_map(tmp_path_factory, words, others):
    path = tmp_path_factory.mktemp("lexicon") / "l"
    path.write_bytes(Lexicon.compile(words).to_bytes())
    got = Lexicon.open(str(path))
    asked = [*words, *others]
    for w, n in zip(asked, got.find(asked).tolist()):
        assert (n >= 0) == (w in words)
        if n >= 0:
            assert np.frombuffer(got.ids_of(n), "<u4").tolist() == words[w]


def test_lexicon_shares_suffixes():
    words = {f"{a}{b}ation".encode(): [1] for a in "abcdefgh" for b in "abcdefgh"}
    assert len(Lexicon.compile(words).final) == 8  # a start, one state for all first letters, and the ending


def test_query_matches_library(spark, library):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = queries.op9_bpe_lexicon(spark, SF_SMALL).collect()
    assert len(got) == len(docs)
    for r in got:
        e = library.encode(docs[r["doc_id"]], add_special_tokens=False).ids
        back = library.decode(e, skip_special_tokens=False)
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(e), hashlib.sha256(np.array(e, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())


def test_word_counts(spark, make):
    df = make([(1, "the cat the"), (2, None), (3, "the <|endoftext|>the")], "doc_id long, text string")
    got = {bytes(r["word"]): r["n"] for r in B.word_counts(df.select("text"), VOCAB).collect()}
    assert got == {b"the": 3, b" cat": 1, b" the": 1, b" ": 1}


def test_odd_rows(spark, make, library):
    docs = odd_docs(make)
    got = {(r["doc_id"], r["text"]) for r in B.round_trip(docs, VOCAB, words=50).collect()}
    assert got == {(r["doc_id"], r["text"] or "") for r in docs.collect()}
    rows = docs.selectExpr("0L _file", "0L _row", "doc_id", "text")
    name = B.train_lexicon(spark, rows.select("text"), VOCAB)
    back = B.decode(B.encode(rows, VOCAB, name), VOCAB)
    assert {(r["doc_id"], r["text"]) for r in back.collect()} == got
    assert B.round_trip(make([], "doc_id long, text string"), VOCAB).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("abcdehilnorstz éß漢.,'"), max_size=30).map(str.encode), max_size=20))
def test_many_words_merge_like_one(words):
    bpe = B._bpe(VOCAB)
    assert [np.frombuffer(x, "<u4").tolist() for x in bpe.merge_many(words)] == [bpe.merge(w) for w in words]
