"""Token files: ids in byte-aligned variable length, control bytes apart from the data.

Ids are replaced by their rank in the corpus, the most frequent being 0, so that
most take one byte. Four values share a control byte, two bits each for the number
of bytes less one; the values' bytes follow each other in a second string. A
reader finds all lengths by one table lookup per control byte.

A token folder holds ``ids/shard=N/`` (Parquet: doc_id, start, n_tokens, control,
data), in ascending order of doc_id over shards and inside them, and ``ranks/``
(rank, id). ``start`` counts the ids of all documents before.
"""

from __future__ import annotations

import os
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sleeper.llm.common import drop_kept, keep, map_batches
from sleeper.llm.bpe import byte_signs
from sleeper.llm.pieces import Pieces
from sleeper.session import scratch_path

#: For each control byte, the bytes that its four values take.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1).astype(np.uint8)

#: Words that are spelt at once for the library's model.
WORDS = 8192


def _used(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, used): each text begins a control byte of its own; where each begins and the last ends, and
    which places hold values."""
    whole = -(-sizes // 4) * 4
    places = np.concatenate([[0], np.cumsum(whole)])
    used = np.ones(places[-1], bool)
    for k in range(3):
        used[(places[:-1] + sizes + k)[sizes + k < whole]] = False
    return places, used


def pack(values: np.ndarray, sizes: np.ndarray) -> list[tuple[bytes, bytes]]:
    """(control, data) of each text: ``values`` holds the unsigned 32-bit values of all texts, ``sizes``
    how many each has."""
    places, used = _used(sizes)
    extra, more = np.zeros(len(values), np.uint8), []
    for k in range(1, 4):
        more.append(np.flatnonzero(values >= 1 << 8 * k))
        if not len(more[-1]):
            break
        extra[more[-1]] = k
    spread = np.zeros(len(used), np.uint8)
    spread[used] = extra
    control = (spread[::4] | spread[1::4] << 2 | spread[2::4] << 4 | spread[3::4] << 6).tobytes()
    at = np.concatenate([[0], np.cumsum(extra, dtype=np.int64)]) + np.arange(len(values) + 1)
    raw = np.empty(at[-1], np.uint8)
    raw[at[:-1]] = values.astype(np.uint8)
    for k, where in enumerate(more, 1):
        raw[at[where] + k] = (values[where] >> 8 * k).astype(np.uint8)
    data, ends, places = raw.tobytes(), at[np.concatenate([[0], np.cumsum(sizes)])].tolist(), (places // 4).tolist()
    return [(control[c:d], data[x:y]) for c, d, x, y in zip(places, places[1:], ends, ends[1:])]


def unpack(control: list[bytes], data: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """The values of all texts that :func:`pack` was given, by looking up each control byte's lengths."""
    raw = np.frombuffer(b"".join(data), np.uint8)
    lengths = LENGTHS[np.frombuffer(b"".join(control), np.uint8)].ravel()[_used(sizes)[1]]
    at = np.cumsum(lengths, dtype=np.int64) - lengths
    values = raw[at].astype(np.uint32)
    for k in range(1, 4):
        more = np.flatnonzero(lengths > k)
        if not len(more):
            break
        values[more] |= raw[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return values


_LIBRARY: dict[tuple[str, str], Pieces] = {}


def _library(vocab: str, code: str) -> Pieces:
    """The tokenizers library behind a memory of pieces, giving ids as arrays of type ``code``; it stays
    for the worker's next tasks."""
    if (vocab, code) not in _LIBRARY:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task is one thread
        t = Tokenizer.from_file(vocab)
        t.no_truncation()
        t.no_padding()

        sign_of = {byte: sign for sign, byte in byte_signs().items()}
        alphabet, line = np.array([ord(sign_of[i]) for i in range(256)], "<u4"), sign_of[0x0a]
        tokenize, size = t.model.tokenize, array(code).itemsize

        def words(some: list[str]) -> list[bytes]:
            spelt = alphabet[np.frombuffer("\n".join(some).encode(), np.uint8)].tobytes().decode("utf-32-le").split(line)
            got, ends = [], []
            for x in spelt:
                got += [token.id for token in tokenize(x)]
                ends.append(len(got) * size)
            raw = array(code, got).tobytes()
            return [raw[x:y] for x, y in zip([0, *ends], ends)]

        def encode(pieces: list[str]) -> list[bytes]:
            # letters, and a space before them, are one word: it goes to the library's model, in its alphabet for bytes
            plain = [p.removeprefix(" ").isalpha() for p in pieces]
            some = [p for p, x in zip(pieces, plain) if x]
            got = iter([x for i in range(0, len(some), WORDS) for x in words(some[i:i + WORDS])])
            rest = iter(t.encode_batch_fast([p for p, x in zip(pieces, plain) if not x], add_special_tokens=False))
            return [next(got) if x else array(code, next(rest).ids).tobytes() for x in plain]

        _LIBRARY[vocab, code] = Pieces(encode)
    return _LIBRARY[vocab, code]


def _ids(docs: DataFrame, vocab: str, end: int) -> DataFrame:
    """(shard, local, doc_id, n_tokens, ids) in order of doc_id: ``shard`` is the range of
    ids, ``local`` the tokens before the document in its shard."""
    width = "<u2" if max(end, Tokenizer.from_file(vocab).get_vocab_size()) < 1 << 16 else "<u4"
    ordered = docs.repartitionByRange(F.col("doc_id"), F.col("tie")).sortWithinPartitions("doc_id", "tie")

    def run(batches):
        library, shard, local = _library(vocab, "H" if width == "<u2" else "I"), TaskContext.get().partitionId(), 0
        last = np.array([end], width).tobytes()
        for b in batches:
            ids = library.column(b["text"], last)
            n = pc.binary_length(ids).to_numpy().astype(np.int64) // np.dtype(width).itemsize
            before = local + np.cumsum(n) - n
            local += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), shard, np.int32)), pa.array(before), b["doc_id"], pa.array(n), ids],
                ["shard", "local", "doc_id", "n_tokens", "ids"])

    got = map_batches(ordered, run, "shard int, local long, doc_id long, n_tokens long, ids binary", rows=2048)
    return keep(got, "token_ids"), width


def write_tokens(docs: DataFrame, vocab: str, path: str | None = None, end: int = 2, id_col: str = "doc_id",
                 text_col: str = "text") -> str:
    """Encode all texts, append ``end`` to each, and write a token folder; returns its path.

    Null and empty texts are the end id alone; a null doc_id comes first; rows with
    the same doc_id are all written, in the order of their texts' hashes. An empty
    table gives an empty folder. Other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ids, width = _ids(rows.withColumn("tie", F.xxhash64("text")), vocab, end)

    size = max(end + 1, 1 + max(Tokenizer.from_file(vocab).get_vocab().values()))

    def count(batches):
        n = np.zeros(size, np.int64)
        for b in batches:
            n += np.bincount(np.frombuffer(b"".join(b["ids"].to_pylist()), width), minlength=size)
        has = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(has), pa.array(n[has])], ["id", "n"])

    # one row for each id of the vocabulary at most
    counts = map_batches(ids.select("ids"), count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    by_rank = np.array([r["id"] for r in counts.orderBy(F.desc("n"), "id").collect()], np.int64)
    rank_of = np.zeros(int(by_rank.max(initial=0)) + 1, np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    spark.createDataFrame([(i, int(x)) for i, x in enumerate(by_rank)], "rank long, id long") \
        .coalesce(1).write.parquet(f"{path}/ranks")

    totals = ids.groupBy("shard").agg(F.max(F.col("local") + F.col("n_tokens")).alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row for each task that wrote
    starts = keep(totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "token_starts")
    placed = ids.join(F.broadcast(starts), "shard").select(
        "shard", "doc_id", (F.col("base") + F.col("local")).cast("long").alias("start"), "n_tokens", "ids")

    def code(batches):
        for b in batches:
            values = rank_of[np.frombuffer(b"".join(b["ids"].to_pylist()), width)]
            packed = pack(values, b["n_tokens"].to_numpy())
            yield pa.RecordBatch.from_arrays(
                [b["shard"], b["doc_id"], b["start"], b["n_tokens"], pa.array([c for c, _ in packed], pa.binary()),
                 pa.array([d for _, d in packed], pa.binary())],
                ["shard", "doc_id", "start", "n_tokens", "control", "data"])

    map_batches(placed, code, "shard int, doc_id long, start long, n_tokens long, control binary, data binary",
                rows=128).sortWithinPartitions("shard", "start") \
        .write.option("compression", "zstd").partitionBy("shard").parquet(f"{path}/ids")
    drop_kept(ids)
    return path


def read_tokens(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of a token folder; ids little-endian unsigned 32-bit, or with
    ``digest`` their number and unsigned crc32 instead (n_tokens, ids_crc32)."""
    by_rank = np.array([r["id"] for r in spark.read.schema("rank long, id long").parquet(f"{path}/ranks")
                       .orderBy("rank").collect()], "<u4")  # the vocabulary at most
    last = "ids_crc32 long" if digest else "ids binary"

    def run(batches):
        for b in batches:
            sizes = b["n_tokens"].to_numpy()
            raw = by_rank[unpack(b["control"].to_pylist(), b["data"].to_pylist(), sizes)].tobytes()
            ends = (np.cumsum(sizes) * 4).tolist()
            ids = [raw[x:y] for x, y in zip([0, *ends], ends)]
            out = pa.array([zlib.crc32(x) for x in ids], pa.int64()) if digest else pa.array(ids, pa.binary())
            n = pa.array([len(x) // 4 for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["start"], n, out],
                                             ["doc_id", "start", "n_tokens", last.split()[0]])

    files = spark.read.schema("doc_id long, start long, n_tokens long, control binary, data binary, shard int") \
        .parquet(f"{path}/ids")
    return map_batches(files.drop("shard"), run, f"doc_id long, start long, n_tokens long, {last}", rows=128)
