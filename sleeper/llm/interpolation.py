"""Language-model scores by deleted interpolation.

The probability of a token after another is a mixture of three estimates: of the
pair, of the token alone, and a uniform one. The mixture's weights depend on how
often the context occurs (a bucket for each power of two) and are learned by
expectation-maximisation on deleted training documents: those whose counts are
taken away from the estimates while the weights are learned, and come back for
scoring.

Documents are packed into blocks. A block asks each counting shard once for every
distinct n-gram it holds, bringing along its own counts, and the answer is that
n-gram's total. So a word that is in every document costs one entry for each
block, wherever it occurs, and no shard holds more than its share of n-grams.
N-grams are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sleeper.llm.common import drop_kept, keep, map_batches, texts_of, with_row_id

#: Text of one block in characters, and tokens for each counting shard.
BLOCK_CHARS, SHARD_TOKENS = 4 << 20, 2 << 20
#: Of the training documents, one in so many is deleted while the weights are learned.
DELETED = 8
#: Powers of two of a context's count that have weights of their own.
BUCKETS = 48
ROUNDS, STILL = 200, 1e-4
TRAIN, DEV, HELD = 0, 1, 2
_END, _BEGIN = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def parts(doc_id: F.Column, held: int = 2, of: int = 7) -> F.Column:
    """HELD if crc32 of the id as text leaves the remainder ``held``, else DEV or TRAIN; no id trains."""
    crc = F.coalesce(F.crc32(doc_id.cast("string").cast("binary")), F.lit(0))
    return F.when(crc % of == held, HELD).when(F.floor(crc / of) % DELETED == 0, DEV).otherwise(TRAIN).cast("int")


# ---------------------------------------------------------------- blocks

BLOCK = ("block long, files array<long>, rows array<long>, ids array<long>, parts binary, lengths binary, "
         "words binary, codes binary")


def _pack(block: int, files, rows, ids, kinds, texts) -> pa.RecordBatch:
    seen: dict[bytes, int] = {b"": 0}  # the end
    codes, lengths = [], []
    for t in texts:
        w = t.encode("utf-8", "surrogatepass").lower().split()
        w.append(b"")
        codes.append(np.fromiter([seen.setdefault(x, len(seen)) for x in w], np.int32, len(w)))
        lengths.append(len(w))
    hashes = [_END] + [xxhash.xxh3_64_intdigest(x) for x in list(seen)[1:]]
    lists, binary = pa.list_(pa.int64()), pa.binary()
    return pa.RecordBatch.from_arrays(
        [pa.array([block]), pa.array([files], lists), pa.array([rows], lists), pa.array([ids], lists),
         pa.array([np.array(kinds, np.uint8).tobytes()], binary), pa.array([np.array(lengths, "<i4").tobytes()], binary),
         pa.array([np.array(hashes, "<u8").tobytes()], binary), pa.array([np.concatenate(codes).tobytes()], binary)],
        ["block", "files", "rows", "ids", "parts", "lengths", "words", "codes"])


def pack(rows: DataFrame) -> DataFrame:
    """The written blocks of rows (_file, _row, doc_id, part, text)."""

    def run(batches):
        held, size, made = ([], [], [], [], []), 0, TaskContext.get().partitionId() << 32
        for b in batches:
            for row in zip(*(b[n].to_pylist() for n in ("_file", "_row", "doc_id", "part")), texts_of(b["text"])):
                for x, v in zip(held, row):
                    x.append(v)
                size += len(row[-1])
                if size >= BLOCK_CHARS:
                    yield _pack(made, *held)
                    held, size, made = ([], [], [], [], []), 0, made + 1
        if held[0]:
            yield _pack(made, *held)

    return keep(map_batches(rows, run, BLOCK), "lm_blocks")


class Block:
    """A block's tokens and its distinct n-grams: first the words, then the pairs."""

    def __init__(self, row: dict):
        self.row = row
        self.parts = np.frombuffer(row["parts"], np.uint8)
        self.lengths = np.frombuffer(row["lengths"], "<i4").astype(np.int64)
        hashes = np.frombuffer(row["words"], "<u8")
        self.codes = np.frombuffer(row["codes"], "<i4").astype(np.int64)
        self.n_words = n = len(hashes)
        self.starts = np.cumsum(self.lengths) - self.lengths
        before = np.empty_like(self.codes)
        before[1:] = self.codes[:-1]
        before[self.starts] = n  # the beginning
        pairs, self.pair = np.unique(before * n + self.codes, return_inverse=True)
        self.pair_context, self.pair_word = pairs // n, pairs % n
        with_begin = np.append(hashes, np.uint64(_BEGIN))
        self.keys = np.concatenate([hashes, _mix(with_begin[self.pair_context], hashes[self.pair_word])])

    def counts(self, part: Iterable[int]) -> np.ndarray:
        """Of each n-gram, in the documents of these parts."""
        mask = np.repeat(np.isin(self.parts, list(part)), self.lengths)
        return np.concatenate([np.bincount(self.codes[mask], minlength=self.n_words),
                               np.bincount(self.pair[mask], minlength=len(self.pair_word))])

    def dealt(self, shards: int) -> Iterator[tuple[int, np.ndarray]]:
        """The n-grams of each shard, in an order that a second call repeats."""
        shard = ((self.keys >> np.uint64(33)) % np.uint64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        edges = np.searchsorted(shard[order], np.arange(shards + 1))
        for s in range(shards):
            if edges[s] < edges[s + 1]:
                yield s, order[edges[s]:edges[s + 1]]


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.uint64(0x9E3779B185EBCA87) + (b ^ (a >> np.uint64(29)))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# ---------------------------------------------------------------- counts

def _small(counts: np.ndarray) -> bytes:
    """Counts as single bytes, those from 255 on as 8 bytes at the end."""
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + counts[counts >= 255].astype("<i8").tobytes()


def _counts(raw: bytes, n: int) -> np.ndarray:
    out = np.frombuffer(raw, np.uint8, n).astype(np.int64)
    out[out == 255] = np.frombuffer(raw, "<i8", offset=n)
    return out


ASKED = "block long, shard int, words long, keys binary, train binary, dev binary"
ANSWER = "block long, shard int, train binary, dev binary, n_train long, n_dev long, v_train long, v_dev long"


def count(blocks: DataFrame, shards: int) -> DataFrame:
    """For each block and shard the totals of the n-grams asked for: over all training documents
    and over the deleted ones. The rows of block -1 hold a shard's tokens and distinct words
    (``v_dev``: those left when the deleted documents are taken away)."""

    def ask(batches):
        for b in batches:
            for row in b.to_pylist():
                block = Block(row)
                train, dev = block.counts((TRAIN, DEV)), block.counts((DEV,))
                got = [(s, at) for s, at in block.dealt(shards)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["block"]] * len(got), pa.int64()), pa.array([s for s, _ in got], pa.int32()),
                     pa.array([int((at < block.n_words).sum()) for _, at in got], pa.int64()),
                     pa.array([block.keys[at].astype("<u8").tobytes() for _, at in got], pa.binary()),
                     *(pa.array([_small(x[at]) for _, at in got], pa.binary()) for x in (train, dev))],
                    ["block", "shard", "words", "keys", "train", "dev"])

    def answer(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        keys = [np.frombuffer(r["keys"], "<u8") for r in rows]
        sizes = np.cumsum([0, *map(len, keys)])
        is_word = np.concatenate([np.arange(len(k)) < r["words"] for k, r in zip(keys, rows)])
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        word = np.zeros(len(distinct), bool)
        word[at[is_word]] = True
        total = []
        for name in ("train", "dev"):
            own = np.concatenate([_counts(r[name], len(k)) for r, k in zip(rows, keys)])
            total.append(np.bincount(at, own, len(distinct)).astype(np.int64))
        left = total[0] - total[1]
        sums = [int(total[0][word].sum()), int(total[1][word].sum()), int((total[0][word] > 0).sum()),
                int((left[word] > 0).sum())]
        out = [[r["block"], r["shard"], *(_small(x[at[a:b]]) for x in total), 0, 0, 0, 0]
               for r, a, b in zip(rows, sizes, sizes[1:])]
        out.append([-1, rows[0]["shard"], b"", b"", *sums])
        names = [x.split()[0] for x in ANSWER.split(", ")]
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * 4]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    asked = map_batches(blocks, ask, ASKED, rows=1)
    return keep(asked.groupBy("shard").applyInArrow(answer, ANSWER), "lm_answers", batch=4)


class Counted:
    """A block with the totals of its n-grams."""

    def __init__(self, row: dict, shards: int):
        self.block = Block(row)
        self.train = np.zeros(len(self.block.keys), np.int64)
        self.dev = np.zeros(len(self.block.keys), np.int64)
        answers = {a["shard"]: a for a in row["answers"]}
        for s, at in self.block.dealt(shards):
            self.train[at] = _counts(answers[s]["train"], len(at))
            self.dev[at] = _counts(answers[s]["dev"], len(at))

    def estimates(self, counts: np.ndarray, n: int, docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each distinct pair: its bucket, its own estimate, and its second word's."""
        b = self.block
        words, pairs = counts[:b.n_words], counts[b.n_words:]
        context = np.append(words, docs)[b.pair_context]
        bucket = np.minimum(np.log2(context + 1).astype(np.int64), BUCKETS - 1)
        return bucket, pairs / np.maximum(context, 1), words[b.pair_word] / max(n, 1)


# ---------------------------------------------------------------- weights

def learn(estimates: DataFrame, uniform: float) -> np.ndarray:
    """The weights (bucket x pair, word, uniform) that fit the deleted documents, by
    expectation-maximisation; each round is one pass whose result is BUCKETS rows.

    ``estimates`` has binary columns bucket (uint8), n, pair, word (float32). To each
    expected count one is added, so no weight is zero.
    """
    weights = np.full((BUCKETS, 3), 1 / 3)
    for _ in range(ROUNDS):
        now = weights

        def expect(batches):
            sums = np.zeros((BUCKETS, 3))
            for b in batches:
                for row in b.to_pylist():
                    bucket = np.frombuffer(row["bucket"], np.uint8)
                    n = np.frombuffer(row["n"], "<f4")
                    p = np.stack([np.frombuffer(row["pair"], "<f4"), np.frombuffer(row["word"], "<f4"),
                                  np.full(len(n), uniform, np.float32)], axis=1) * now[bucket]
                    p *= (n / p.sum(axis=1))[:, None]
                    for k in range(3):
                        sums[:, k] += np.bincount(bucket, p[:, k], BUCKETS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(BUCKETS)), *(pa.array(sums[:, k]) for k in range(3))], ["bucket", "a", "b", "c"])

        sums = np.zeros((BUCKETS, 3))
        for r in map_batches(estimates, expect, "bucket long, a double, b double, c double", rows=16) \
                .groupBy("bucket").agg(*(F.sum(k).alias(k) for k in "abc")).collect():
            sums[r["bucket"]] = r["a"], r["b"], r["c"]
        weights = (sums + 1) / (sums + 1).sum(axis=1, keepdims=True)
        if np.abs(weights - now).max() < STILL:
            break
    return weights


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held: int = 2, of: int = 7) -> DataFrame:
    """Learn from the training documents and score all whole texts.

    Returns one row per row of ``docs``: ``_file``, ``_row``, ``doc_id``,
    ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (add-one
    over single tokens) and ``score`` (the mixture), both log10 probabilities of the
    text. Very long texts are counted and scored whole, each in one block. No order
    decides anything, so there are no ties. Null and empty texts are the end alone. Without training documents every
    token is unknown and the weights are even. Equal rows get equal scores; a null
    id is a training document; an empty table gives no rows. Other columns are not
    read.
    """
    rows = with_row_id(docs, F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       parts(F.col(id_col).cast("long"), held, of).alias("part"))
    blocks = pack(rows)

    def sizes(batches):
        for b in batches:
            for row in b.select(["parts", "lengths"]).to_pylist():
                kind = np.frombuffer(row["parts"], np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(x)]) for x in (len(row["lengths"]) // 4, (kind < HELD).sum(), (kind == DEV).sum(),
                                                  np.frombuffer(row["lengths"], "<i4").sum())],
                    ["docs", "train", "dev", "tokens"])

    s = map_batches(blocks.select("parts", "lengths"), sizes, "docs long, train long, dev long, tokens long") \
        .agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("docs", "train", "dev", "tokens"))).first()
    shards = max(1, -(-s["tokens"] // SHARD_TOKENS))
    answers = count(blocks, shards)
    t = answers.where("block = -1").agg(
        *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_train", "n_dev", "v_train", "v_dev"))).first()
    n, v = t["n_train"], t["v_train"]
    by_block = answers.where("block >= 0").groupBy("block").agg(
        F.collect_list(F.struct("shard", "train", "dev")).alias("answers"))
    whole = blocks.join(by_block, "block")  # made for each of the two passes: a written copy would hold the blocks twice

    def deleted(batches):
        for b in batches:
            for row in b.to_pylist():
                c = Counted(row, shards)
                m = c.block.counts((DEV,))[c.block.n_words:]
                bucket, pair, word = c.estimates(c.train - c.dev, n - t["n_dev"], s["train"] - s["dev"])
                at = np.flatnonzero(m)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[at].astype(k).tobytes()], pa.binary())
                     for x, k in ((bucket, np.uint8), (m, "<f4"), (pair, "<f4"), (word, "<f4"))],
                    ["bucket", "n", "pair", "word"])

    estimates = keep(map_batches(whole, deleted, "bucket binary, n binary, pair binary, word binary", rows=1),
                     "lm_deleted", batch=2)
    weights = learn(estimates, 1 / (t["v_dev"] + 1))
    drop_kept(estimates)

    def scores(batches):
        for b in batches:
            for row in b.to_pylist():
                c = Counted(row, shards)
                k = c.block
                bucket, pair, word = c.estimates(c.train, n, s["train"])
                w = weights[bucket]
                mixed = np.log10(w[:, 0] * pair + w[:, 1] * word + w[:, 2] / (v + 1))[k.pair]
                known = c.train[:k.n_words]
                base = np.log10((known + 1) / (n + v + 1))[k.codes]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["files"], pa.int64()), pa.array(row["rows"], pa.int64()),
                     pa.array(row["ids"], pa.int64()), pa.array(k.parts == HELD), pa.array(k.lengths),
                     pa.array(np.add.reduceat((known > 0)[k.codes].astype(np.int64), k.starts)),
                     pa.array(np.full(len(k.lengths), n, np.int64)), pa.array(np.add.reduceat(base, k.starts)),
                     pa.array(np.add.reduceat(mixed, k.starts))],
                    [x.split()[0] for x in SCORES.split(", ")])

    out = keep(map_batches(whole, scores, SCORES, rows=1), "lm_scores", batch=2)
    drop_kept(blocks, answers)
    return out


SCORES = ("_file long, _row long, doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
          "base_score double, score double")
