from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_support import SF_SMALL, make, odd_docs  # noqa: F401
from tokenizers import Tokenizer

from sleeper.llm import pieces, queries
from sleeper.llm import token_files as T

VOCAB = queries.vocabulary()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2 ** 32 - 1)), max_size=20), max_size=8))
def test_pack_and_unpack(texts):
    flat, sizes = np.array([v for t in texts for v in t], np.uint32), np.array([len(t) for t in texts], np.int64)
    packed = T.pack(flat, sizes)
    for (control, data), t in zip(packed, texts, strict=True):
        assert len(control) == -(-len(t) // 4)
        assert len(data) == sum(max(1, -(-v.bit_length() // 8)) for v in t)
    assert T.unpack([c for c, _ in packed], [d for _, d in packed], sizes).tolist() == flat.tolist()


@settings(max_examples=60, deadline=None)
@given(st.text(st.sampled_from("abstdz 1\n\t.,'<|>é漢ßªʰ\u01c5\u0661\u2167 \x1c\x85\U0001f600"), max_size=50))
def test_library_by_pieces(text):
    library = T._library(VOCAB, "I")
    assert np.frombuffer(library.texts([text])[0], "<u4").tolist() == \
        Tokenizer.from_file(VOCAB).encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("abstdz 1\n\n.,$'<|>é漢ªʰ²\u2167\x1c\x85\U0001f600"), max_size=50)), max_size=6))
def test_library_by_column(texts):
    got = T._library(VOCAB, "I").column(pa.array(texts, pa.string()), np.array([2], "<u4").tobytes())
    library = Tokenizer.from_file(VOCAB)
    assert [np.frombuffer(x, "<u4").tolist() for x in got.to_pylist()] == \
        [library.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]


def test_a_column_costs_one_look_up_for_each_distinct_piece(monkeypatch):
    """Words that signs and a new line join are encoded as words, once; a column longer than a run gives the same."""
    library, given = Tokenizer.from_file(VOCAB), []

    def encode(words):
        given.extend(words)
        return [np.array(e.ids, "<u4").tobytes() for e in library.encode_batch(words, add_special_tokens=False)]

    texts = ["One stone.\nTwo stone,\nTwo stone$$$", None, "two  spaces stone.\nTwo end ", "", "stone\nTwo don't stone²"] * 3
    want = [np.array(library.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() + b"end." for t in texts]
    assert pieces.Pieces(encode).column(pa.array(texts), b"end.").to_pylist() == want
    assert len(given) == len(set(given))
    assert {" stone", "Two", ".", ",", "$$$", "\n"} <= set(given) and not {" stone.\nTwo", " stone$$$"} & set(given)
    monkeypatch.setattr(pieces, "RUN_BYTES", 20)
    assert pieces.Pieces(encode, kept=4).column(pa.array(texts), b"end.").to_pylist() == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("aZ 1\n\n\t.,$'[<|>é漢ßªʰǅ٠²Ⅷ—€\u0301\u3000\xa0\x00\x1c\x85\U00010400\U0001f600  "), min_size=1, max_size=30), max_size=5))
def test_texts_are_cut_where_the_library_cuts(texts):
    """The ids of what is between the starts are the texts' ids, whatever stands there."""
    library, raw = Tokenizer.from_file(VOCAB), [t.encode() for t in texts]
    begins = np.cumsum([0, *map(len, raw)])
    starts = pieces.word_starts(np.frombuffer(b"".join(raw), np.uint8), begins[:-1])
    assert set(begins[:-1].tolist()) <= set(starts.tolist())
    for t, x, y in zip(raw, begins, begins[1:]):
        at = [*(starts[(starts >= x) & (starts < y)] - x).tolist(), len(t)]
        words = [t[a:b].decode() for a, b in zip(at, at[1:])]
        assert [i for w in words for i in library.encode(w, add_special_tokens=False).ids] == \
            library.encode(t.decode(), add_special_tokens=False).ids


def test_plain_text_is_cut_into_words():
    text = "(One stone.\nÉté&&& a—b don't  7up, end.".encode()
    starts = pieces.word_starts(np.frombuffer(text, np.uint8), np.zeros(1, np.int64)).tolist()
    assert [text[a:b].decode() for a, b in zip(starts, [*starts[1:], len(text)])] == \
        ["(", "One", " stone", ".", "\n", "Été", "&&&", " a—b", " don't ", " 7up,", " end", "."]


def test_words_stay_known_whatever_signs_they_stand_before():
    """What is remembered are words: their pairs with signs and with each other take no room."""
    given, letters = [], "abcdefgh"
    words, tails = [x + y for x in letters for y in letters], [x * n for x in ".,!?&$#%" for n in (1, 2, 3)]

    def encode(new):
        given.extend(new)
        return [w.encode() + b"|" for w in new]

    memory = pieces.Pieces(encode, kept=2 * len(words) + len(tails) + 1)
    for tail in tails:
        text = "".join(f" {w}{tail}\n{w}" for w in words)
        assert memory.column(pa.array([text]), b"").to_pylist()[0].decode().replace("|", "") == text
    assert len(given) == len(set(given)) == 2 * len(words) + len(tails) + 1


def test_slices_nulls_and_empty_columns():
    memory = pieces.Pieces(lambda new: [w.encode() for w in new])
    texts = pa.array(["skip", None, "", "a b.", None, "c", "skip"])
    assert memory.column(texts.slice(1, 5), b"$").to_pylist() == [b"$", b"$", b"a b.$", b"$", b"c$"]
    assert memory.column(texts.slice(1, 2), b"$").to_pylist() == [b"$", b"$"]
    assert memory.column(texts.slice(0, 0), b"$").to_pylist() == []
    assert memory.column(texts.cast(pa.large_string()).slice(3, 1), b"$").type == pa.binary()


def test_query_matches_library(spark):
    library = Tokenizer.from_file(VOCAB)
    docs = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect())
    got = {r["doc_id"]: r for r in queries.op7_token_files(spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    start = 0
    for i, t in docs:
        e = np.array(library.encode(t, add_special_tokens=False).ids + [2], "<u4")
        assert got[i].asDict() == {"doc_id": i, "start": start, "n_tokens": len(e), "ids_crc32": zlib.crc32(e.tobytes())}
        start += len(e)


def test_files_are_in_order_and_frequent_ids_short(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    path = T.write_tokens(docs, VOCAB)
    files = spark.read.parquet(f"{path}/ids").orderBy("shard", "start").collect()
    assert [r["doc_id"] for r in files] == sorted(r["doc_id"] for r in files)
    assert sum(len(r["data"]) for r in files) < 1.7 * sum(r["n_tokens"] for r in files)


def test_odd_rows(spark, make):
    library = Tokenizer.from_file(VOCAB)
    docs = odd_docs(make)
    got = T.read_tokens(spark, T.write_tokens(docs, VOCAB)).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == sorted((r["doc_id"] for r in docs.collect()), key=lambda x: (x is not None, x))
    texts = {}
    for r in docs.collect():
        texts.setdefault(r["doc_id"], []).append(r["text"] or "")
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
        e = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(e) == r["n_tokens"] and e[-1] == 2
        assert library.decode(e[:-1], skip_special_tokens=False) in texts[r["doc_id"]]
    empty = T.read_tokens(spark, T.write_tokens(make([], "doc_id long, text string"), VOCAB))
    assert empty.collect() == []
