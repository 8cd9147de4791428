"""Benchmark decontamination by a distributed positional inverted index.

The index is sharded by document: each shard holds, for some hundreds of whole
documents, every term (by hash) with the ascending positions at which it occurs,
on one axis where documents lie apart. It is written once. Queries (sequences of
terms) are cut from the benchmark in tasks, written in blocks of bounded size, and go to all
shards round by round; a shard drops a query as soon as
one of its terms has no posting, and otherwise intersects the terms' postings,
moved by the term's place in the query, from the rarest on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sleeper.llm.common import keep, map_batches, texts_of, with_row_id

WINDOW = 10
#: Text bytes of documents in one shard, and of benchmark items in one block.
SHARD_BYTES = 4 << 20
BLOCK_BYTES = 4 << 20
#: Positions that lie between two documents; queries and proximity are shorter.
GAP = 1 << 16

_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
              for b in range(256))


def words(text: str) -> list[bytes]:
    """Runs of digits, letters (A-Z lower-cased) and characters beyond ASCII."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


def term(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


# ---------------------------------------------------------------- index

def _shard(files, rows, ids, texts) -> pa.RecordBatch:
    seen: dict[bytes, int] = {}
    codes, counts = [], []
    for t in texts:
        w = words(t)
        counts.append(len(w))
        codes.append(np.fromiter([seen.setdefault(x, len(seen)) for x in w], np.int64, len(w)))
    n = np.array(counts, np.int64)
    starts = np.cumsum(n + GAP) - (n + GAP)
    code = np.concatenate(codes) if codes else np.zeros(0, np.int64)
    at = np.concatenate([s + np.arange(k) for s, k in zip(starts, counts)]) if codes else code
    hashes = np.fromiter(map(term, seen), np.uint64, len(seen))
    order = np.argsort(hashes)
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    by_term = place[code]
    sorted_ = np.argsort(by_term, kind="stable")
    offsets = np.concatenate([[0], np.cumsum(np.bincount(by_term, minlength=len(seen)))])

    def one(x, kind):
        return pa.array([np.ascontiguousarray(x, kind).tobytes()], pa.binary())

    return pa.RecordBatch.from_arrays(
        [pa.array([files], pa.list_(pa.int64())), pa.array([rows], pa.list_(pa.int64())),
         pa.array([ids], pa.list_(pa.int64())), one(n, "<i8"), one(hashes[order], "<u8"), one(offsets, "<i8"),
         one(at[sorted_], "<i8" if len(at) and at.max() > 0x7FFFFFFF else "<i4")],
        ["files", "rows", "ids", "n_words", "terms", "offsets", "positions"])


INDEX = "files array<long>, rows array<long>, ids array<long>, n_words binary, terms binary, offsets binary, positions binary"


def build_index(rows: DataFrame) -> DataFrame:
    """The written index of rows (_file, _row, doc_id, text), one row per shard."""

    def run(batches):
        held, size = ([], [], [], []), 0
        for b in batches:
            for f, r, i, t in zip(b["_file"].to_pylist(), b["_row"].to_pylist(), b["doc_id"].to_pylist(),
                                  texts_of(b["text"])):
                for x, v in zip(held, (f, r, i, t)):
                    x.append(v)
                size += len(t)
                if size >= SHARD_BYTES:
                    yield _shard(*held)
                    held, size = ([], [], [], []), 0
        if held[0]:
            yield _shard(*held)

    return keep(map_batches(rows, run, INDEX), "positional_index")


class Shard:
    """One shard as read from the index."""

    def __init__(self, row: dict):
        self.files, self.rows, self.ids = row["files"], row["rows"], row["ids"]
        self.n_words = np.frombuffer(row["n_words"], "<i8")
        self.starts = np.cumsum(self.n_words + GAP) - (self.n_words + GAP)
        self.terms = np.frombuffer(row["terms"], "<u8")
        self.offsets = np.frombuffer(row["offsets"], "<i8")
        total = int(self.offsets[-1])
        self.positions = np.frombuffer(row["positions"], "<i4" if len(row["positions"]) == 4 * total else "<i8")

    def find(self, terms: np.ndarray) -> np.ndarray:
        """The place of each term in this shard, -1 where it has none."""
        if not len(self.terms):
            return np.full(len(terms), -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def postings(self, place: int) -> np.ndarray:
        return self.positions[self.offsets[place]:self.offsets[place + 1]].astype(np.int64)

    def phrase(self, places: np.ndarray) -> np.ndarray:
        """Where the terms follow each other: postings moved back by each term's offset, rarest first."""
        sizes = self.offsets[places + 1] - self.offsets[places]
        found = None
        for k in np.argsort(sizes, kind="stable").tolist():
            here = self.postings(places[k])
            if found is None:
                found = here - k
            else:
                at = np.minimum(np.searchsorted(here, found + k), len(here) - 1)
                found = found[here[at] == found + k]
            if not len(found):
                break
        return found

    def near(self, places: np.ndarray, within: int) -> np.ndarray:
        """First positions of spans of at most ``within`` words that hold each term once or more."""
        sizes = self.offsets[places + 1] - self.offsets[places]
        order = np.argsort(sizes, kind="stable")
        found = self.postings(places[order[0]])
        for k in order[1:].tolist():  # the rarest term's postings that have each other term near by
            here = self.postings(places[k])
            at = np.searchsorted(here, found - (within - 1))
            ok = (at < len(here)) & (here[np.minimum(at, len(here) - 1)] <= found + (within - 1))
            found = found[ok]
        every = [self.postings(p) for p in places.tolist()]
        firsts = set()
        for x in found.tolist():  # a span that holds x begins with one of the terms, up to within - 1 before
            for here in every:
                lo, hi = np.searchsorted(here, [x - within + 1, x + 1])
                for s in here[lo:hi].tolist():
                    if all((a := np.searchsorted(h, s)) < len(h) and h[a] < s + within for h in every):
                        firsts.add(s)
        return np.array(sorted(firsts), np.int64)


# ---------------------------------------------------------------- queries

BLOCK = ("block long, size long, names array<string>, terms binary, codes binary, starts binary, sizes binary, "
         "owner_starts binary, owners binary")


class Queries:
    """Windows of benchmark items as stretches of the items' terms; equal windows are one, with all their items."""

    def __init__(self, row: dict):
        self.names = row["names"]
        self.terms = np.frombuffer(row["terms"], "<u8")
        self.codes, self.starts, self.sizes, self.owner_starts, self.owners = (
            np.frombuffer(row[n], "<i4") for n in ("codes", "starts", "sizes", "owner_starts", "owners"))

    def possible(self, places: np.ndarray) -> np.ndarray:
        """The windows all of whose terms a shard has (``places`` of the distinct terms)."""
        missing = np.concatenate([[0], np.cumsum(places[self.codes] < 0)])
        return np.flatnonzero(missing[self.starts + self.sizes] == missing[self.starts])

    def window(self, w: int) -> np.ndarray:
        return self.codes[self.starts[w]:self.starts[w] + self.sizes[w]]

    def items(self, w: int) -> np.ndarray:
        return self.owners[self.owner_starts[w]:self.owner_starts[w + 1]]


def _block(number: int, size: int, items: list[tuple[str, list[bytes]]], window: int) -> pa.RecordBatch:
    seen: dict[bytes, int] = {}
    codes = np.array([seen.setdefault(w, len(seen)) for _, text in items for w in text], "<i4")
    raw, first, owners, end = codes.tobytes(), {}, {}, 0
    for item, (_, text) in enumerate(items):
        begin, end = end, end + len(text)
        n = min(window, len(text))
        for at in range(begin, end - n + 1 if n else begin):
            key = raw[4 * at:4 * (at + n)]
            first.setdefault(key, at)
            own = owners.setdefault(key, [])
            if not own or own[-1] != item:
                own.append(item)
    owned = np.cumsum([0, *map(len, owners.values())])
    arrays = {"terms": np.fromiter(map(term, seen), "<u8", len(seen)), "codes": codes, "starts": [*first.values()],
              "sizes": [len(k) // 4 for k in first], "owner_starts": owned,
              "owners": [x for own in owners.values() for x in own]}
    return pa.RecordBatch.from_arrays(
        [pa.array([number]), pa.array([size]), pa.array([[n for n, _ in items]], pa.list_(pa.string())),
         *(pa.array([np.asarray(x, "<u8" if n == "terms" else "<i4").tobytes()], pa.binary()) for n, x in arrays.items())],
        ["block", "size", "names", *arrays])


def build_blocks(benchmark: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text",
                 size: int = BLOCK_BYTES) -> DataFrame:
    """The written windows of the items (ids as text) in blocks of about ``size`` bytes of text.

    Items are cut into windows where they lie; an item is whole in one block.
    """
    items = benchmark.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("string").alias("name"),
                                                              F.col(text_col).cast("string").alias("text"))

    def run(batches):
        held, used, number = [], 0, TaskContext.get().partitionId() << 32
        for b in batches:
            for name, text in zip(b["name"].to_pylist(), texts_of(b["text"])):
                if not (w := words(text)):
                    continue
                held.append((name, w))
                used += len(text)
                if used >= size:
                    yield _block(number, used, held, window)
                    held, used, number = [], 0, number + 1
        if held:
            yield _block(number, used, held, window)

    return keep(map_batches(items, run, BLOCK), "benchmark_blocks")


def rounds(blocks: DataFrame, size: int = BLOCK_BYTES) -> Iterator[list[Queries]]:
    """The blocks in rounds of ``size`` bytes of text (or one block); only one round is read at a time."""
    ids, used = [], 0

    def read():
        return [Queries(r) for r in blocks.where(F.col("block").isin(ids)).toArrow().to_pylist()] if ids else []

    for number, more in sorted(tuple(r) for r in blocks.select("block", "size").collect()):  # two numbers a block
        if ids and used + more > size:
            yield read()
            ids, used = [], 0
        ids.append(number)
        used += more
    yield read()


HITS = "_file long, _row long, doc_id long, n_words long, hits array<struct<from:long,to:long>>, items array<string>"


def _hits(shard: Shard, queries: list[Queries]) -> pa.RecordBatch:
    """For each document of the shard the merged hit word ranges and the items that occur in it."""
    spans: dict[int, list[tuple[int, int]]] = {}
    items: dict[int, set[str]] = {}
    for q in queries:
        places = shard.find(q.terms)
        for w in q.possible(places).tolist():
            size = int(q.sizes[w])
            at = shard.phrase(places[q.window(w)])
            docs = np.searchsorted(shard.starts, at, "right") - 1
            for d, x in zip(docs.tolist(), (at - shard.starts[docs]).tolist()):
                spans.setdefault(d, []).append((x, x + size))
                items.setdefault(d, set()).update(q.names[i] for i in q.items(w).tolist())
    merged = [merge_spans(spans.get(d, [])) for d in range(len(shard.ids))]
    return pa.RecordBatch.from_arrays(
        [pa.array(shard.files, pa.int64()), pa.array(shard.rows, pa.int64()), pa.array(shard.ids, pa.int64()),
         pa.array(shard.n_words), pa.array([[{"from": a, "to": b} for a, b in m] for m in merged],
                                           pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))),
         pa.array([sorted(items.get(d, ())) for d in range(len(shard.ids))], pa.list_(pa.string()))],
        ["_file", "_row", "doc_id", "n_words", "hits", "items"])


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def search(index: DataFrame, queries: Broadcast) -> DataFrame:
    """One round of queries against all shards, a row for each document (HITS)."""

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                yield _hits(Shard(row), queries.value)

    return map_batches(index, run, HITS, rows=1)


def search_near(index: DataFrame, phrase: str, within: int) -> DataFrame:
    """(doc_id, position): spans of at most ``within`` words that hold all words of ``phrase``."""
    terms = np.array(sorted({term(w) for w in words(phrase)}), np.uint64)
    assert within < GAP

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                shard = Shard(row)
                places = shard.find(terms)
                at = shard.near(places, within) if len(places) and places.min() >= 0 else np.zeros(0, np.int64)
                d = np.searchsorted(shard.starts, at, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard.ids[i] for i in d.tolist()], pa.int64()), pa.array(at - shard.starts[d])],
                    ["doc_id", "position"])

    return map_batches(index, run, "doc_id long, position long", rows=1)


def _written(found: DataFrame | None, hits: DataFrame) -> DataFrame:
    """The first round's rows, and of further rounds those of the documents they hit."""
    return keep(hits, "hits") if found is None else found.unionByName(keep(hits.where(F.size("hits") > 0), "hits"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                  text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """:func:`contamination_rows` over any frame with an id and a text column."""
    rows = with_row_id(docs, F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return contamination_rows(rows, benchmark, window, block_bytes)


def contamination_rows(rows: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                       block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Which words of rows (_file, _row, doc_id, text) lie in a window of a benchmark item.

    Returns one row per row (HITS): ``n_words``, ``hits`` (merged ranges of word
    numbers, end exclusive) and ``items`` (ids as text, sorted) of which a window
    occurs. A window is ``window`` consecutive words of an item, or the whole item
    if it has fewer; an item without words, with null text or null id has none.
    Items that share an id count as one id. Null and empty texts have no words;
    equal rows get equal results; an empty table gives no rows, an empty benchmark
    no hits. An item that occurs by several windows counts once. Very long texts are
    indexed whole: a document lies in one shard, an item in one block, whatever their length.
    Terms are compared by 64-bit hashes. Other columns are not read.
    """
    assert window < GAP
    index = build_index(rows)
    blocks = build_blocks(benchmark, window, size=block_bytes)
    spread, found = None, None
    for queries in rounds(blocks, block_bytes):
        if spread is not None:  # another round comes: the last one's results are written, its queries dropped
            found = _written(found, search(index, spread))
            spread.destroy()
        spread = index.sparkSession.sparkContext.broadcast(queries)  # a round: bounded
    if found is None:
        return search(index, spread)
    found = _written(found, search(index, spread))
    spread.destroy()
    ranges = F.array_sort(F.flatten(F.collect_list("hits")))
    return found.groupBy("_file", "_row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), ranges.alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))


def n_hit() -> F.Column:
    """Words in ``hits``, counted once where ranges of several blocks overlap."""
    return F.aggregate("hits", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
                       lambda acc, x: F.struct(
                           (acc["n"] + F.greatest(F.lit(0), x["to"] - F.greatest(x["from"], acc["end"]))).alias("n"),
                           F.greatest(acc["end"], x["to"]).alias("end")), lambda acc: acc["n"])
