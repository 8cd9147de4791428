"""Near-duplicate embeddings by sorted projection passes.

In each pass every vector gets a key of 64 sign bits of random projections. The
vectors of a label are put in the keys' lexicographic order, and each is compared
with its ``window`` neighbours; pairs whose cosine reaches the threshold are links.
Close vectors share a long beginning of their keys with some chance in every pass,
so the links of enough passes together hold nearly all pairs; how many passes are
enough follows from the largest label and the recall asked for.

Equal vectors are one node, so copies cost nothing after the first grouping. A
window is too narrow for a crowd of unlike vectors that are all close: there the
members within half the threshold's angle of the crowd's middle are linked with
each other by the triangle inequality, and counted without listing their pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sleeper.llm.common import drop_kept, join_sites, keep, map_batches
from sleeper.llm.simhash import components
from sleeper.llm.vectors import finite_vectors

#: Passes whose keys are shuffled in one job: each takes the vectors' size in shuffle files.
AT_ONCE = 4
_BLOCK = 256
_ORDER = ["turn", "label", "dim", "key", "node"]


def passes_needed(largest: int, threshold: float, window: int, recall: float) -> int:
    """Passes after which two vectors at the threshold have been neighbours with chance ``recall``.

    Among ``largest`` vectors the neighbours share about ``log2(largest / window)``
    bits, and each bit is equal with chance ``1 - angle / pi``.
    """
    if largest <= window + 1:
        return 1
    bits = max(1.0, math.log2(largest / window))
    hit = (1 - math.acos(min(1.0, max(-1.0, threshold))) / math.pi) ** bits
    return 1 if hit >= recall else math.ceil(math.log(1 - recall) / math.log(1 - hit))


def unit(matrix: np.ndarray) -> np.ndarray:
    """Rows of length 1; rows of zeros stay."""
    top = np.abs(matrix).max(axis=1, keepdims=True, initial=0)
    m = matrix / np.where(top > 0, top, 1)
    size = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return m / np.where(size > 0, size, 1)


def _digests(df: DataFrame) -> DataFrame:
    """Rows (vec_id, label, v) with ``digest``, equal for equal labels and vectors; null where a row links with nothing."""

    def run(batches):
        for b in batches:
            digest = [None] * b.num_rows
            labels = b["label"].to_pylist()
            for at, m in finite_vectors(b["v"]):
                used = (m != 0).any(axis=1)
                for i, row in zip(at[used], m[used] + 0.0):  # no negative zeros
                    if labels[i] is not None:
                        key = labels[i].encode() + b"\0" + row.tobytes()
                        digest[i] = hashlib.blake2b(key, digest_size=16).digest()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(digest, pa.binary())], [*b.schema.names, "digest"])

    kind = df.schema["v"].dataType.simpleString()
    return map_batches(df, run, f"vec_id long, label string, v {kind}, digest binary", 2048)


def _keyed(nodes: DataFrame, turns: list[int], seed: int) -> DataFrame:
    """Each node once a pass, with the pass's key as a long in the bits' lexicographic order."""

    def run(batches):
        planes: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            for at, m in finite_vectors(b["v"]):
                dim, rows, u = m.shape[1], b.take(pa.array(at)), unit(m)
                for turn in turns:
                    if (turn, dim) not in planes:
                        planes[turn, dim] = np.random.default_rng([seed, turn, dim]).standard_normal((dim, 64))
                    bits = np.packbits(u @ planes[turn, dim] > 0, axis=1)
                    key = (bits.view(">u8").ravel().astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), turn, np.int32)), rows["label"],
                         pa.array(np.full(len(at), dim, np.int32)), pa.array(key), rows["node"], rows["v"]],
                        [*_ORDER, "v"])

    kind = nodes.schema["v"].dataType.simpleString()
    return map_batches(nodes.select("node", "label", "v"), run,
                       f"turn int, label string, dim int, key long, node long, v {kind}", 2048)


def _runs(b) -> Iterator[tuple[int, int]]:
    """(from, to) of the stretches of one pass, label and length."""
    n = b.num_rows
    new = np.zeros(max(n - 1, 0), bool)
    for c in ("turn", "label", "dim"):
        column = b[c]
        new |= pc.not_equal(column.slice(1), column.slice(0, max(n - 1, 0))).to_numpy(zero_copy_only=False)
    edges = [0, *(np.flatnonzero(new) + 1).tolist(), n]
    return zip(edges, edges[1:])


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return unit(flat.reshape(len(column), -1))


def _neighbours(u: np.ndarray, place: np.ndarray, window: int, threshold: float, first: int = 0):
    """(i, j, cosine) with j before i, their places at most ``window`` apart, for i from ``first`` on.
    ``place`` ascends, so that neighbours are within ``window`` rows."""
    for s in range(first, len(u), _BLOCK):
        low = max(0, s - window)
        cos = u[s:s + _BLOCK] @ u[low:s + _BLOCK].T
        i, j = np.nonzero(cos >= threshold)
        c = cos[i, j]
        i, j = i + s, j + low
        near = (j < i) & (place[i] - place[j] <= window)
        yield i[near], j[near], c[near]


_FOUND = ["a", "b", "tight", "turn", "label", "dim", "pid", "idx", "v"]


def _found(kind: str) -> str:
    return f"a long, b long, tight boolean, turn int, label string, dim int, pid int, idx long, v {kind}"


def _compare(ordered: DataFrame, window: int, threshold: float, half: float) -> DataFrame:
    """Rows of two kinds from sorted partitions: links (a, b, tight) between neighbours of one partition, and,
    for neighbours across partitions, the first and last ``window`` rows of each (``a`` the node, ``pid`` and
    ``idx`` its place); one row without a node gives the partition's size in ``idx``."""
    kind = ordered.schema["v"].dataType.simpleString()

    def links(a, b, cos, like):
        n = len(a)
        nothing = [pa.nulls(n, like.schema.field(c).type) for c in ("turn", "label", "dim")]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(cos >= half), *nothing,
             pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, like.schema.field("v").type)], _FOUND)

    def border(rows, idx, pid):
        n = rows.num_rows
        return pa.RecordBatch.from_arrays(
            [rows["node"], pa.nulls(n, pa.int64()), pa.nulls(n, pa.bool_()), rows["turn"], rows["label"], rows["dim"],
             pa.array(np.full(n, pid, np.int32)), pa.array(idx), rows["v"]], _FOUND)

    def run(batches):
        pid, seen, last, kept, carry = TaskContext.get().partitionId(), 0, None, 0, None
        for b in batches:
            nodes = b["node"].to_numpy()
            for s, e in _runs(b):
                key = tuple(b[c][s].as_py() for c in ("turn", "label", "dim"))
                u, own = _matrix(b["v"].slice(s, e - s)), nodes[s:e]
                before = 0
                if carry is not None and carry[0] == key:
                    before = len(carry[1])
                    u, own = np.concatenate([carry[1], u]), np.concatenate([carry[2], own])
                for i, j, c in _neighbours(u, np.arange(len(u)), window, threshold, before):
                    if len(i):
                        yield links(own[i], own[j], c, b)
                carry = (key, u[-window:], own[-window:])
            if kept < window:  # the head of the partition
                head = b.slice(0, window - kept)
                yield border(head, np.arange(seen, seen + head.num_rows), pid)
                kept += head.num_rows
                rest = b.slice(head.num_rows)
            else:
                rest = b
            seen += b.num_rows
            if rest.num_rows:
                rest = rest.slice(max(0, rest.num_rows - window))
                last = rest if last is None else pa.Table.from_batches([last, rest]).combine_chunks().to_batches()[0]
                last = last.slice(max(0, last.num_rows - window))
        if last is not None:
            yield border(last, np.arange(seen - last.num_rows, seen), pid)
        if seen:
            like = b.schema
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.bool_()), pa.nulls(1, pa.int32()),
                 pa.nulls(1, like.field("label").type), pa.nulls(1, pa.int32()), pa.array([pid], pa.int32()),
                 pa.array([seen], pa.int64()), pa.nulls(1, like.field("v").type)], _FOUND)

    return map_batches(ordered, run, _found(kind), 2048)


def _across(found: DataFrame, window: int, threshold: float, half: float) -> DataFrame:
    """Links (a, b, tight) between rows of different partitions: their places in the whole order come from the
    partitions' sizes; blocks of places overlap by a window, so that no group outgrows five windows."""
    sizes = found.where(F.col("a").isNull()).select("pid", F.col("idx").alias("n"))
    before = sizes.select("pid", (F.sum("n").over(Window.orderBy("pid")) - F.col("n")).alias("before"))  # a row a partition
    wide = 4 * window
    place = F.col("before") + F.col("idx")
    block = F.floor(place / wide)
    rows = found.where(F.col("a").isNotNull() & F.col("b").isNull()).join(before, "pid").select(
        "turn", "label", "dim", F.col("a").alias("node"), "pid", place.alias("place"), "v",
        F.explode(F.when(place % wide < window, F.array(block, block - 1)).otherwise(F.array(block))).alias("block"))

    def run(table: pa.Table) -> pa.Table:
        t = table.sort_by([("place", "ascending")])
        b = t.combine_chunks().to_batches()[0]
        out = []
        for s, e in _runs(b):
            part = b.slice(s, e - s)
            nodes, pid, place = (part[c].to_numpy() for c in ("node", "pid", "place"))
            for i, j, c in _neighbours(_matrix(part["v"]), place, window, threshold):
                far = pid[i] != pid[j]
                a, z = nodes[i[far]], nodes[j[far]]
                out.append(pa.table({"a": np.minimum(a, z), "b": np.maximum(a, z), "tight": c[far] >= half}))
        return pa.concat_tables(out) if out else pa.table(
            {"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "tight": pa.array([], pa.bool_())})

    return rows.groupBy("block").applyInArrow(run, "a long, b long, tight boolean")


def find_links(nodes: DataFrame, threshold: float, window: int, passes: int, seed: int = 0) -> DataFrame:
    """(a, b, tight): pairs of ``nodes`` (node, label, v) of one label whose cosine is ``threshold`` or more and that
    were neighbours in some pass; ``tight`` where their angle is at most half the threshold's."""
    spark = nodes.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    half = math.cos(math.acos(threshold) / 2)
    found = None
    for start in range(0, passes, AT_ONCE):
        keyed = _keyed(nodes, list(range(start, min(passes, start + AT_ONCE))), seed)
        ordered = keyed.repartitionByRange(parts, *_ORDER).sortWithinPartitions(*_ORDER)
        step = keep(_compare(ordered, window, threshold, half), "projection_pass")
        pairs = step.where(F.col("b").isNotNull()).select("a", "b", "tight").unionByName(
            _across(step, window, threshold, half))
        pairs = keep(pairs.distinct(), "projection_links")
        drop_kept(step)
        found = pairs if found is None else found.unionByName(pairs)
    return keep(found.distinct(), "links")


def _crowds(nodes: DataFrame, groups: DataFrame, window: int, threshold: float) -> DataFrame:
    """(node, ball): members of a group (node, root) of more than ``window`` nodes that lie within half the
    threshold's angle of its middle: any two of them are linked."""
    sizes = groups.groupBy("root").agg(F.count("*").alias("m")).where(F.col("m") > window)
    mine = keep(join_sites(groups, keep(sizes, "crowd_sizes"), ["root"], "m").select("node", "root"), "crowds")
    rows = keep(nodes.select("node", "v").join(mine, "node"), "crowd_rows")

    def sums(batches):
        for b in batches:
            roots = b["root"].to_numpy()
            for at, m in finite_vectors(b["v"]):
                which, group = np.unique(roots[at], return_inverse=True)
                total = np.zeros((len(which), m.shape[1]))
                np.add.at(total, group, unit(m))
                yield pa.RecordBatch.from_arrays([pa.array(which), pa.array(list(total), pa.list_(pa.float64()))],
                                                 ["root", "s"])

    parts = map_batches(rows, sums, "root long, s array<double>", 4096)
    entries = parts.select("root", F.posexplode("s").alias("i", "x")).groupBy("root", "i").agg(F.sum("x").alias("x"))
    middle = entries.groupBy("root").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("s")).select(
        "root", F.col("s.x").alias("middle"))  # as long as a vector
    middle = keep(middle.join(sizes, "root"), "crowd_middles")
    inside = math.cos(math.acos(threshold) / 2 - 1e-6)

    def dot(x: str, y: str) -> F.Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda p, q: p + q)

    near = dot("v", "middle") / F.sqrt(dot("v", "v")) / F.sqrt(dot("middle", "middle"))
    return join_sites(rows, middle, ["root"], "m").where(near >= inside).select("node", F.col("root").alias("ball"))


def near_duplicates(df: DataFrame, threshold: float = 0.93, window: int = 32, recall: float = 0.999, seed: int = 0,
                    id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of ``df``.

    ``n_links`` is the number of other rows of the same label whose cosine with it
    was found to be ``threshold`` or more; ``component_id`` the smallest id that
    links lead to, itself included; ``kept`` whether that is its own. ``recall`` is
    the chance of finding a pair at the threshold itself; closer pairs are found
    more surely, equal vectors and those around the middle of a crowd always.

    Rows without a label, null and empty vectors, zero vectors and vectors with
    null or non-finite entries link with nothing, nor do vectors of different length.
    Equal vectors of a label, repeated rows included, link with each other, at any
    number of copies. Rows of one id share ``kept``. A null id counts as a row but is the smallest of a
    component only if all its ids are null. Ties of keys are in no particular order
    and may fall out of each other's window; other passes have other ties. No rows give no
    rows; other columns are not read. A vector may be as long as a task holds ``2048``
    of them.
    """
    if not 0 < threshold < 1:
        raise ValueError("threshold must lie between 0 and 1")
    rows = keep(_digests(df.select(F.col(id_col).cast("long").alias("vec_id"),
                                   F.col(label_col).cast("string").alias("label"), F.col(vec_col).alias("v"))),
                "vectors")
    usable = rows.where(F.col("digest").isNotNull())
    nodes = usable.groupBy("digest").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"),
                                         F.first("label").alias("label"), F.first("v").alias("v"))
    nodes = keep(nodes.withColumn("node", F.monotonically_increasing_id()), "vector_nodes")
    largest = nodes.groupBy("label", F.size("v")).agg(F.count("*").alias("m")).agg(F.max("m")).first()[0] or 0
    links = find_links(nodes, threshold, window, passes_needed(largest, threshold, window, recall), seed)

    tight = keep(components(links.where("tight").select("a", "b")).distinct(), "tight_groups").select("node", "root")
    balls = keep(_crowds(nodes, tight, window, threshold), "crowd_members")
    info = keep(nodes.select("node", "n", "least", "digest").join(balls, "node", "left").join(tight, "node", "left")
                .withColumn("root", F.coalesce("root", "node")), "node_info")
    weight = info.where(F.col("ball").isNotNull()).groupBy("ball").agg(
        F.sum("n").alias("weight"), F.count("*").alias("members"))

    def end(c: str) -> DataFrame:
        return info.select(F.col("node").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in ("n", "ball", "root")])

    ends = keep(links.join(end("a"), "a").join(end("b"), "b"), "link_ends")
    own = ends.where(~F.coalesce(F.col("ball_a") == F.col("ball_b"), F.lit(False)))
    degree = own.select(F.col("a").alias("node"), F.col("n_b").alias("w")).unionByName(
        own.select(F.col("b").alias("node"), F.col("n_a").alias("w"))).groupBy("node").agg(F.sum("w").alias("degree"))

    loose = ends.where(F.col("root_a") != F.col("root_b")).select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
    joined = keep(components(loose.distinct()).distinct(), "loose_groups").select(
        F.col("node").alias("root"), F.col("root").alias("top"))
    # groups of nodes can be large: what holds for a group comes back by joins that stand hot keys
    per_root = info.groupBy("root").agg(F.min("least").alias("least"), F.count("*").alias("m"))
    per_root = keep(per_root.join(joined, "root", "left").withColumn("top", F.coalesce("top", "root")), "group_tops")
    per_top = keep(per_root.groupBy("top").agg(F.min("least").alias("component_id"), F.count("*").alias("k")), "tops")
    per_root = keep(join_sites(per_root.select("root", "m", "top"), per_top, ["top"], "k"), "group_ids")
    whole = join_sites(info.select("node", "n", "digest", "ball", "root"), per_root.select("root", "m", "component_id"),
                       ["root"], "m")
    in_ball = keep(join_sites(info.where(F.col("ball").isNotNull()).select("node", "ball"), keep(weight, "ball_weights"),
                              ["ball"], "members"), "ball_nodes").select("node", "weight")
    whole = whole.join(in_ball, "node", "left").join(degree, "node", "left")
    n_links = F.coalesce("weight", "n") - 1 + F.coalesce("degree", F.lit(0))
    sites = keep(whole.select("digest", "n", n_links.alias("n_links"), "component_id"), "vector_sites")
    linked = join_sites(usable.select("vec_id", "digest"), sites, ["digest"], "n").select("vec_id", "n_links", "component_id")
    alone = rows.where(F.col("digest").isNull()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
