"""SimHash near-dedup with a pigeonring filter.

Fingerprints of 64 bits lie on a ring of ``2 * max_bits + 1`` segments. If two
fingerprints differ in at most ``max_bits`` bits, then from some segment on every
chain of consecutive segments stays within its proportional share of the
differences (``floor(length * max_bits / segments)``). The shortest chains may not
differ at all, so they are the join key; the longer ones prune what the key lets
through, and the full Hamming distance decides.

Keys that many fingerprints share are not paired: there each fingerprint names all
centres within half the distance, and whoever shares a centre is linked to one
member, so that a group costs as much as it has rows. Copies of one fingerprint
are one node of the graph.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sleeper.llm.common import drop_kept, join_sites, keep, map_batches, texts_of, with_row_id

#: Fingerprints under one key that are paired with each other; beyond it the centres link them.
PAIRED = 32
_CHUNK = 1 << 18


def fingerprint(text: str, shingle: int) -> int:
    """The bits set in over half of the shingles' hashes; no words give 0."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    whole = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends[shingle - 1:].tolist()
    n, counts, digest = len(ends), np.zeros(64, np.int64), xxhash.xxh64_digest
    for i in range(0, n, _CHUNK):
        part = b"".join([digest(whole[a:b], 42) for a, b in zip(starts[i:i + _CHUNK], ends[i:i + _CHUNK])])
        bits = np.unpackbits(np.frombuffer(part, np.uint8)).reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(rows: DataFrame, shingle: int) -> DataFrame:
    """(_file, _row, doc_id, fp): ``fp`` holds the 64 bits as a signed long."""

    def run(batches):
        for b in batches:
            fp = [fingerprint(t, shingle) for t in texts_of(b["text"])]
            yield pa.RecordBatch.from_arrays(
                [b["_file"], b["_row"], b["doc_id"], pa.array(np.array(fp, np.uint64).view(np.int64))],
                ["_file", "_row", "doc_id", "fp"])

    return map_batches(rows, run, "_file long, _row long, doc_id long, fp long")


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, bits) of each segment of the ring, from the lowest bit on."""
    m = 2 * max_bits + 1
    edges = [round(i * 64 / m) for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def chain(max_bits: int, start: int, length: int) -> int:
    """The bits of ``length`` consecutive segments from ``start`` on, as a signed mask."""
    ring = segments(max_bits)
    mask = 0
    for k in range(length):
        first, n = ring[(start + k) % len(ring)]
        mask |= ((1 << n) - 1) << first
    return mask - (1 << 64) if mask >> 63 else mask


def within_ring(diff: F.Column, max_bits: int, start: int) -> F.Column:
    """Does every chain from segment ``start`` on keep its share of the differences ``diff``?"""
    m = 2 * max_bits + 1
    ok = F.lit(True)
    for length in range(1, m + 1):
        share = length * max_bits // m
        ok = ok & (F.bit_count(diff.bitwiseAND(F.lit(chain(max_bits, start, length)))) <= share)
    return ok


def links(fps: DataFrame, max_bits: int) -> DataFrame:
    """(a, b): links within ``max_bits`` bits that connect whatever is connected.

    ``fps`` has each fingerprint once. Within keys of at most PAIRED fingerprints
    these are all linked pairs; elsewhere stars over the same components.
    """
    m = 2 * max_bits + 1
    free = max(1, (m - 1) // max_bits) if max_bits else m  # chains up to this length may not differ
    keys = F.array(*[F.struct(F.lit(i).alias("start"),
                              F.col("fp").bitwiseAND(F.lit(chain(max_bits, i, free))).alias("key"))
                     for i in range(m)])
    keyed = keep(fps.select("fp", F.explode(keys).alias("k")).select("fp", "k.start", "k.key"), "simhash_keys")
    counts = keyed.groupBy("start", "key").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    counts = keep(counts, "simhash_counts")
    few = keyed.join(counts.where(F.col("n") <= PAIRED), ["start", "key"])
    other = few.select("start", "key", F.col("fp").alias("b"))
    diff = F.col("fp").bitwiseXOR(F.col("b"))
    ring = F.expr("false")
    for i in range(m):
        ring = ring | ((F.col("start") == i) & within_ring(diff, max_bits, i))
    pairs = few.join(other, ["start", "key"]).where(
        (F.col("fp") < F.col("b")) & ring & (F.bit_count(diff) <= max_bits)).select(F.col("fp").alias("a"), "b")

    many = join_sites(keyed, counts.where(F.col("n") > PAIRED), ["start", "key"], "n").select("fp").distinct()
    near, far = max_bits // 2, max_bits - max_bits // 2
    flips = [sum(1 << b for b in c) for r in range(far + 1) for c in combinations(range(64), r)]
    inner = sum(1 for r in range(near + 1) for _ in combinations(range(64), r))
    flips = np.array(flips, np.uint64).view(np.int64)

    def centres(batches):
        for b in batches:
            fp = b["fp"].to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(fp, len(flips))), pa.array((fp[:, None] ^ flips[None, :]).ravel()),
                 pa.array(np.tile(np.arange(len(flips)) < inner, len(fp)))], ["fp", "centre", "near"])

    spread = map_batches(many, centres, "fp long, centre long, near boolean", rows=64)
    heads = spread.groupBy("centre").agg(F.min(F.when(F.col("near"), F.col("fp"))).alias("a"),
                                         F.count("*").alias("n"), F.max("fp").alias("last"))
    heads = heads.where((F.col("n") > 1) & F.col("a").isNotNull()).select("centre", "a")
    stars = spread.join(heads, "centre").where(F.col("a") != F.col("fp")).select("a", F.col("fp").alias("b"))
    return pairs.unionByName(stars).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node connected with each node that has an edge.

    Alternating large and small stars: each round hangs a node's larger neighbours,
    then the node and its smaller ones, under the smallest; a hot node's star is
    dealt with as edges and never gathered. Ends when a round changes nothing.
    """
    def hung(e: DataFrame, large: bool) -> DataFrame:
        both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else \
            e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = both.groupBy("a").agg(F.min("b").alias("low"), F.count("*").alias("n"))
        low = keep(low.select("a", F.least("a", "low").alias("low"), "n"), "star_heads")
        joined = join_sites(keep(both, "star_edges"), low, ["a"], "n")
        if large:
            out = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        else:
            out = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
                joined.select("a", F.col("low").alias("b")))
        return out.where(F.col("a") != F.col("b")).distinct()

    def state(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = keep(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while (now := state(edges)) != before:
        before = now
        edges = keep(hung(keep(hung(edges, True), "large"), False), "small")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """:func:`near_duplicate_rows` over any frame with an id and a text column."""
    return near_duplicate_rows(
        with_row_id(docs, F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), shingle, max_bits)


def near_duplicate_rows(rows: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """Components of rows (_file, _row, doc_id, text) whose fingerprints differ in few bits.

    Returns one row per row: ``_file``, ``_row``, ``doc_id``, ``fp`` (long),
    ``component_id`` (smallest id reachable, itself included), ``kept`` (one row of
    each component: the smallest id, then the first place). Null and empty texts
    and texts of white space have the fingerprint 0 and are one group. Null ids
    are never the smallest, unless a component has no other. Equal rows share
    their component, and one of them is kept. Very long texts are fingerprinted
    whole, their shingles a chunk at a time. No rows give no rows.

    Scale: with two bits the chains that may not differ make a key of some 26 bits, so beyond some
    two billion distinct fingerprints nearly every key is crowded and its members go through
    shared centres, 65 rows a fingerprint. The result is the same.
    """
    docs = keep(fingerprints(rows, shingle), "fingerprints")
    least = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_file", "_row")
    nodes = keep(docs.groupBy("fp").agg(F.min(least).alias("least"), F.count("*").alias("n")), "simhash_nodes")
    comp = keep(components(links(nodes.select("fp"), max_bits)).distinct(), "simhash_components")
    nodes = nodes.join(comp.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    nodes = keep(nodes, "simhash_rooted")
    roots = keep(nodes.groupBy("root").agg(F.min("least").alias("head"), F.count("*").alias("m")), "simhash_roots")
    whole = keep(join_sites(nodes.select("fp", "n", "root"), roots, ["root"], "m"), "simhash_whole")
    return join_sites(docs, whole.select("fp", "n", "head"), ["fp"], "n").select(
        "_file", "_row", "doc_id", "fp", F.col("head.doc_id").alias("component_id"),
        ((F.col("_file") == F.col("head._file")) & (F.col("_row") == F.col("head._row"))).alias("kept"))
