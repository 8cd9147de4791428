"""BPE encoding and decoding with a lexicon of frequent words.

The words of all documents are counted, the most frequent are merged once and
compiled into a transducer (:mod:`sleeper.llm.lexicon`) that every worker maps into
memory; words it doesn't hold are merged exactly. The ids equal those of the
tokenizers library for a byte-level BPE file without normalizer, truncation and
padding.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sleeper.llm.common import map_batches, texts_of, with_row_id
from sleeper.llm.lexicon import Lexicon
from sleeper.llm.pieces import STOPS, Pieces, cut
from sleeper.session import scratch_path

#: Words compiled into the lexicon at most; what it costs the driver is bounded by this.
LEXICON_WORDS = 1 << 16
#: Distinct pieces a counting task holds before it passes them on.
COUNTED = 200_000
_NONE = 1 << 30
# White space as the Unicode property has it, without the separators \x1c-\x1f.
_S = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WORDS = rf"'(?:s|t|re|ve|m|ll|d)| ?\p{{L}}+| ?\p{{N}}+| ?[^{_S}\p{{L}}\p{{N}}]+|[{_S}]+(?![^{_S}])|[{_S}]+"


def byte_signs() -> dict[str, int]:
    """The sign that stands for each byte in the vocabulary's strings."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    """The vocabulary and merges of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        signs = byte_signs()
        vocab = spec["model"]["vocab"]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.single = [0] * 256
        size = 1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])])
        self.bytes_of: list[bytes] = [b""] * size
        for text, i in vocab.items():
            self.bytes_of[i] = bytes(signs[c] for c in text)
            if len(text) == 1:
                self.single[signs[text]] = i
        pairs_of = np.array(list(self.merges), np.int64).reshape(-1, 2)
        order = np.argsort(pairs_of[:, 0] << 32 | pairs_of[:, 1], kind="stable")
        self._keys = (pairs_of[:, 0] << 32 | pairs_of[:, 1])[order]
        self._ranks = np.append(order, _NONE).astype(np.int32)  # ranks are the places in the file
        self._made = np.array([new for _, new in self.merges.values()], np.int32)
        self._first = np.array(self.single, np.int32)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for text, i in self.special.items():
            self.bytes_of[i] = text.encode()
        self.words = regex.compile(_WORDS).findall
        self._parts = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")").split \
            if self.special else lambda text: [text]
        self._split = bool(self.special)

    def parts(self, piece: str) -> list[bytes | int]:
        """The words of a piece, and the ids of special tokens between them."""
        word = piece[1:] if piece[:1] == " " else piece
        if word.isalpha():
            return [piece.encode()]
        if word[-1:] in STOPS and word[:-1].isalpha():
            return [piece[:-1].encode(), word[-1:].encode()]
        if not self._split or not any(s in piece for s in self.special):
            return [w.encode() for w in self.words(piece)]
        out: list[bytes | int] = []
        for i, x in enumerate(self._parts(piece)):
            out += [self.special[x]] if i % 2 else [w.encode() for w in self.words(x)]
        return out

    def merge(self, word: bytes) -> list[int]:
        """The word's ids: again and again the pair of the lowest rank, the leftmost first."""
        ids = [self.single[b] for b in word]
        if len(ids) > 48:
            return self._merge_long(ids)
        merges = self.merges
        while len(ids) > 1:
            best, at = None, -1
            for i, pair in enumerate(zip(ids, ids[1:])):
                m = merges.get(pair)
                if m is not None and (best is None or m < best):
                    best, at = m, i
            if best is None:
                break
            ids[at:at + 2] = [best[1]]
        return ids

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair, _NONE if it doesn't merge (or one of it is no id)."""
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where((self._keys[at] == key) & (b >= 0), self._ranks[at], _NONE)

    def merge_many(self, words: list[bytes]) -> list[bytes]:
        """:meth:`merge` of many words at once, as little-endian unsigned 32-bit ids.

        Words of about the same length lie in the rows of a table. In each step every
        row merges its best pair and gets one column shorter; rows without a pair are
        done.
        """
        out: list[bytes] = [b""] * len(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        for low, high in ((0, 4), (4, 8), (8, 12), (12, 16), (16, 24), (24, 48)):
            rows = np.flatnonzero((lengths > low) & (lengths <= high))
            if len(rows):
                self._merge_table([words[i] for i in rows.tolist()], rows, high, out)
        for i in np.flatnonzero(lengths > 48).tolist():
            out[i] = np.array(self.merge(words[i]), "<u4").tobytes()
        return out

    def _merge_table(self, words: list[bytes], rows: np.ndarray, width: int, out: list[bytes]) -> None:
        n = np.fromiter(map(len, words), np.int64, len(words))
        table = np.full((len(words), width), -1, np.int32)
        table[np.arange(width) < n[:, None]] = self._first[np.frombuffer(b"".join(words), np.uint8)]
        rank = self._rank(table[:, :-1], table[:, 1:])
        while len(rows):
            at = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(rows), np.int64)
            best = rank[np.arange(len(rows)), at] if rank.shape[1] else np.full(len(rows), _NONE)
            done = best == _NONE
            if done.any():
                ended = table[done]
                sizes = (ended >= 0).sum(axis=1)
                raw, ends = ended[ended >= 0].astype("<u4").tobytes(), (np.cumsum(sizes) * 4).tolist()
                for i, a, b in zip(rows[done].tolist(), [0, *ends], ends):
                    out[i] = raw[a:b]
                go = ~done
                rows, table, rank, at, best = rows[go], table[go], rank[go], at[go], best[go]
            if not len(rows):
                return
            line, columns = np.arange(len(rows)), np.arange(table.shape[1] - 1)
            table[line, at] = self._made[best]
            table = np.take_along_axis(table, columns + (columns > at[:, None]), axis=1)
            columns = columns[:-1]
            rank = np.take_along_axis(rank, columns + (columns >= at[:, None]), axis=1)
            for first in (at - 1, at):  # the pairs that the new id is in
                ok = (first >= 0) & (first < rank.shape[1])
                r, c = line[ok], first[ok]
                rank[r, c] = self._rank(table[r, c], table[r, c + 1])

    def _merge_long(self, ids: list[int]) -> list[int]:
        """As :meth:`merge`, by a heap of pairs over a linked list."""
        n, merges = len(ids), self.merges
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(*merges[p], i, p) for i, p in enumerate(zip(ids, ids[1:])) if p in merges]
        heap = [(rank, i, new, p) for rank, new, i, p in heap]
        heapq.heapify(heap)
        while heap:
            _, i, new, pair = heapq.heappop(heap)
            j = right[i]
            if ids[i] != pair[0] or j < 0 or ids[j] != pair[1]:
                continue
            ids[i], ids[j] = new, -1
            right[i] = right[j]
            if right[i] >= 0:
                left[right[i]] = i
            for a, b in ((left[i], i), (i, right[i])):
                if a >= 0 and b >= 0 and (m := merges.get((ids[a], ids[b]))):
                    heapq.heappush(heap, (m[0], a, m[1], (ids[a], ids[b])))
        return [x for x in ids if x >= 0]

    def decode(self, ids: list[int]) -> str:
        """The text of the ids, special tokens included; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


class Encoder:
    """Ids as little-endian unsigned 32-bit integers: words by the lexicon, others merged."""

    def __init__(self, bpe: Bpe, lexicon: Lexicon):
        self.bpe, self.lexicon = bpe, lexicon
        self.pieces = Pieces(self._encode)
        self.texts = self.pieces.texts

    def _encode(self, pieces: list[str]) -> list[bytes]:
        parts = [self.bpe.parts(p) for p in pieces]
        words = list({w for ws in parts for w in ws})
        ids: dict[bytes | int, bytes] = {w: np.array([w], "<u4").tobytes() for w in words if isinstance(w, int)}
        words = [w for w in words if not isinstance(w, int)]
        numbers = self.lexicon.find(words)
        for w, number in zip(words, numbers.tolist()):
            if number >= 0:
                ids[w] = self.lexicon.ids_of(number)
        unseen = [words[i] for i in np.flatnonzero(numbers < 0).tolist()]
        ids.update(zip(unseen, self.bpe.merge_many(unseen)))
        return [b"".join([ids[w] for w in ws]) for ws in parts]


def word_counts(texts: DataFrame, vocab: str) -> DataFrame:
    """(word, n): how often each word, as UTF-8, occurs in all texts (column ``text``)."""

    def count(batches):
        bpe, seen = _bpe(vocab), Counter()

        def flush():
            words = Counter()
            for p, n in seen.items():
                for w in bpe.parts(p[1:] if p[:1] == "\n" else " " + p):
                    if not isinstance(w, int):
                        words[w] += n
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(words), pa.binary()),
                                               pa.array(list(words.values()), pa.int64())], ["word", "n"])

        for b in batches:
            for t in texts_of(b["text"]):
                pieces = cut(t)
                pieces[0] = "\n" + pieces[0]
                seen.update(pieces)
            if len(seen) >= COUNTED:
                yield flush()
        yield flush()

    return map_batches(texts, count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


_BPE: dict[str, Bpe] = {}
_ENCODERS: dict[tuple[str, str], Encoder] = {}


def _bpe(vocab: str) -> Bpe:
    if vocab not in _BPE:
        _BPE[vocab] = Bpe(vocab)
    return _BPE[vocab]


def _encoder(vocab: str, lexicon: str) -> Encoder:
    """This worker's encoder; it stays for the worker's next tasks."""
    if (vocab, lexicon) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[vocab, lexicon] = Encoder(_bpe(vocab), Lexicon.open(SparkFiles.get(lexicon)))
    return _ENCODERS[vocab, lexicon]


def train_lexicon(spark: SparkSession, texts: DataFrame, vocab: str, words: int = LEXICON_WORDS) -> str:
    """Compile the most frequent words of ``texts`` (column ``text``) and give the file to
    all executors, present and future; returns its name there."""
    bpe = _bpe(vocab)
    top = word_counts(texts, vocab).orderBy(F.desc("n"), "word").limit(words).select("word").toArrow()
    names = top["word"].to_pylist()
    merged = (np.frombuffer(x, "<u4").tolist() for x in bpe.merge_many(names))
    data = Lexicon.compile(dict(zip(names, merged))).to_bytes()
    name = f"lexicon-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{scratch_path(spark, 'lexicon')}/{name}")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(data))
    out.close()
    spark.sparkContext.addFile(path.toString())
    return name


_ROW = "_file long, _row long, doc_id long"


def _batch(b: pa.RecordBatch, **more: pa.Array) -> pa.RecordBatch:
    names = ["_file", "_row", "doc_id"]
    return pa.RecordBatch.from_arrays([*(b[n] for n in names), *more.values()], [*names, *more])


def encode(rows: DataFrame, vocab: str, lexicon: str) -> DataFrame:
    """(_file, _row, doc_id, ids): each row's ids, little-endian unsigned 32-bit, as binary."""

    def run(batches):
        for b in batches:
            yield _batch(b, ids=pa.array(_encoder(vocab, lexicon).texts(texts_of(b["text"])), pa.binary()))

    return map_batches(rows, run, f"{_ROW}, ids binary", rows=128)


def _texts(raw: list[bytes], vocab: str) -> pa.Array:
    bpe = _bpe(vocab)
    return pa.array([bpe.decode(np.frombuffer(x, "<u4").tolist()) for x in raw], pa.string())


def decode(encoded: DataFrame, vocab: str) -> DataFrame:
    """(_file, _row, doc_id, text) from the ids that :func:`encode` gave."""

    def run(batches):
        for b in batches:
            yield _batch(b, text=_texts(b["ids"].to_pylist(), vocab))

    return map_batches(encoded, run, f"{_ROW}, text string", rows=128)


def encode_decode(rows: DataFrame, vocab: str, lexicon: str) -> DataFrame:
    """Both in one pass: (_file, _row, doc_id, n_tokens, ids_sha256, text)."""

    def run(batches):
        for b in batches:
            raw = _encoder(vocab, lexicon).texts(texts_of(b["text"]))
            yield _batch(b, n_tokens=pa.array([len(x) // 4 for x in raw], pa.int64()),
                         ids_sha256=pa.array([hashlib.sha256(x).hexdigest() for x in raw]), text=_texts(raw, vocab))

    return map_batches(rows, run, f"{_ROW}, n_tokens long, ids_sha256 string, text string", rows=128)


def round_trip(docs: DataFrame, vocab: str, words: int = LEXICON_WORDS, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Encode every text and decode its ids: ``_file``, ``_row``, ``doc_id``, ``n_tokens``, ``ids_sha256``, ``text``.

    Null and empty texts have no ids and decode to the empty text. Very long texts are
    encoded whole, each in one task. Ties between words of equal frequency decide which of them the
    lexicon holds, never ids. Equal rows give equal rows; no rows give none. Other columns of ``docs`` are not read.
    """
    rows = with_row_id(docs, F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    lexicon = train_lexicon(docs.sparkSession, rows.select("text"), vocab, words)
    return encode_decode(rows, vocab, lexicon)
