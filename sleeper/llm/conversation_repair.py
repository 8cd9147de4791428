"""Repair of conversations to turns in order, at the least cost.

A conversation has to read ``(s?(ua)+)?`` by the initials of its roles. Its rows are
kept (free), given the role user or assistant (2) or deleted (3; blank rows and
duplicates must be), and empty rows of user or assistant may be inserted anywhere
(2); a truncated row that stays costs 1. Of the cheapest edits those come out whose
initials (D, I, K, R) are the ASCII-least.

The rows are dealt by range of (conversation, turn), so that a conversation of any
length spreads over tasks; the rows of one conversation in one task are a segment. In
a segment the costs of the four states run backward and are stored at every square
root of its length only; walking forward each block's costs are made again from its
checkpoint, and the least letter whose edit is tight is taken. Segments of one
conversation are tied together by their 4 x 4 least-cost matrices: from the
last to the first these give each segment's closing costs, and then, from the first to
the last, the state it is entered in.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sleeper.llm.common import join_sites, keep, map_batches

#: States: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = (USER, USER, ASSISTANT, USER)  # what an inserted or renamed row leads to
_ROLES = {"s": 0, "u": 1, "a": 2}
_KEEPS = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (ASSISTANT, 1): USER, (USER, 2): ASSISTANT}
DELETE, INSERT, RENAME, TRUNCATED = 3, 2, 2, 1
INF = 1 << 50
#: A row's byte: its role's initial, must it go, is it truncated.
OTHER, MUST, CUT = 3, 4, 8
#: Costs at the end of a conversation: empty, or an assistant last.
END = (0, 2 * INSERT, INSERT, 0)
_SPACE = " \t\n\x0b\x0c\r"


def _add(a: int, b: int) -> int:
    return min(INF, a + b)


def _edits(code: int, after: tuple, state: int):
    """(cost, letter, next state) of what can be done with a row of ``code``, given the costs after it."""
    cut = TRUNCATED if code & CUT else 0
    yield _add(DELETE, after[state]), "D", state
    if not code & MUST:
        kept = _KEEPS.get((state, code & 3))
        if kept is not None:
            yield _add(cut, after[kept]), "K", kept
        yield _add(RENAME + cut, after[_NEXT[state]]), "R", _NEXT[state]


def _before(code: int, after: tuple) -> tuple:
    """Costs of the states before a row, inserts included (two in a row at most are ever needed)."""
    base = [min(c for c, _, _ in _edits(code, after, s)) for s in range(4)]
    once = [min(base[s], _add(INSERT, base[_NEXT[s]])) for s in range(4)]
    return tuple(min(once[s], _add(INSERT, once[_NEXT[s]])) for s in range(4))


@lru_cache(maxsize=1 << 14)
def _back(code: int, after: tuple) -> tuple[tuple, int]:
    """(costs before a row less their least, that least). Only differences of costs recur, and few do."""
    before = _before(code, after)
    least = min(before)
    return tuple(c if c >= INF else c - least for c in before), least


@lru_cache(maxsize=1 << 14)
def _choices(code: int, after: tuple) -> tuple:
    """Per state the edits from there to behind the row: (letters, roles given, next state)."""
    before = _before(code, after)
    out = []
    for s in range(4):
        letters, given, state = "", [], s
        while before[s] < INF:
            tight = [(e, t) for c, e, t in _edits(code, after, state) if c == before[state]]
            if _add(INSERT, before[_NEXT[state]]) == before[state]:
                tight.append(("I", _NEXT[state]))
            letter, state = min(tight)
            letters += letter
            given.append(state if letter in "IR" else 0)
            if letter != "I":
                break
        out.append((letters, bytes(given), state))
    return tuple(out)


def _down(codes: bytes, after: tuple) -> tuple[tuple, int]:
    total = 0
    for c in reversed(codes):
        after, least = _back(c, after)
        total += least
    return after, total


def _normal(costs) -> tuple[tuple, int]:
    least = min(costs)
    return tuple(INF if c >= INF else c - least for c in costs), least


def costs_before(codes: bytes, after) -> list[int]:
    """The four states' costs before the rows of ``codes``, given those after them."""
    diff, least = _normal(after)
    diff, total = _down(codes, diff)
    return [INF if c >= INF else c + least + total for c in diff]


def matrix(codes: bytes) -> list[int]:
    """Least cost from each state before the rows to each state after them, by rows of 4."""
    columns = [costs_before(codes, [0 if s == t else INF for s in range(4)]) for t in range(4)]
    return [columns[t][s] for s in range(4) for t in range(4)]


def walk(codes: bytes, after, last: bool, entries=(START,)) -> list[tuple[str, bytes, int]]:
    """(letters, roles given, exit state) of the least tight edits from each of ``entries``.

    Backward, the costs are stored at every ``isqrt(n)``-th row only; forward, each block's are
    made again from the checkpoint behind it.
    """
    size = max(1, math.isqrt(len(codes)))
    blocks = range(0, len(codes), size)
    cost = _normal(after)[0]
    checkpoints = []
    for at in reversed(blocks):
        checkpoints.append(cost)
        cost = _down(codes[at:at + size], cost)[0]
    paths = [([], [], s) for s in entries]
    for at in blocks:
        block, behind = codes[at:at + size], checkpoints.pop()
        costs = [behind]  # behind each row of the block, the last first
        for c in reversed(block[1:]):
            costs.append(_back(c, costs[-1])[0])
        for c, cost in zip(block, reversed(costs)):
            choices = _choices(c, cost)
            for k, (letters, given, state) in enumerate(paths):
                e, g, state = choices[state]
                letters.append(e)
                given.append(g)
                paths[k] = (letters, given, state)
    out = []
    for letters, given, state in paths:
        while last and state not in (START, ASSISTANT):
            state = _NEXT[state]
            letters.append("I")
            given.append(bytes([state]))
        out.append(("".join(letters), b"".join(given), state))
    return out


def illegal(initials: np.ndarray) -> int:
    """Adjacent initials that are none of su, ua, au."""
    a, b = initials[:-1], initials[1:]
    return int((~(((a != 1) & (a != 3) & (b == 1)) | ((a == 1) & (b == 2)))).sum())


@dataclass
class Repair:
    """``summary``: (conv, gaps, blank, duplicate, truncated, illegal, cost, audit), a row a conversation.
    ``rows``: what the conversations read repaired, (conv, part, place, edit, role, text), in the order of
    (part, place) within each."""

    summary: DataFrame
    rows: DataFrame


def _flagged(rows: DataFrame) -> DataFrame:
    """Rows without texts, with their faults (``blank``, ``duplicate``, ``truncated``; the first one counts)."""
    trimmed = F.rtrim(F.col("text"), F.lit(_SPACE))
    narrow = rows.select(
        "k", "conv", "turn", "role", "id", F.unhex(F.sha2("text", 256)).alias("digest"),
        (trimmed == "").alias("blank"), (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("open"))
    narrow = keep(narrow, "turns")
    said = narrow.where(~F.col("blank")).groupBy("k", "role", "digest").agg(
        F.min(F.struct("turn", "id")).alias("first"), F.count("*").alias("n")).where(F.col("n") > 1)
    whole = join_sites(narrow, keep(said, "said_again"), ["k", "role", "digest"], "n", how="left")
    again = ~F.col("blank") & F.coalesce(F.struct("turn", "id") != F.col("first"), F.lit(False))
    return whole.select("k", "conv", "turn", "role", "digest", "id", "blank", again.alias("duplicate"),
                        (~F.col("blank") & ~again & F.col("open")).alias("truncated"))


def _segments(flagged: DataFrame) -> DataFrame:
    """(k, part, edge, n, codes, ids, first, last, illegal): each conversation's rows of one task, packed;
    ``edge`` where the conversation may go on in the task before or behind."""
    parts = int(flagged.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["k", "turn", "role", "digest", "id"]
    initial = F.substring("role", 1, 1)
    code = F.lit(OTHER)
    for letter, number in _ROLES.items():
        code = F.when(initial == letter, number).otherwise(code)
    code = code + F.when(F.col("blank") | F.col("duplicate"), MUST).otherwise(0) + F.when(F.col("truncated"), CUT).otherwise(0)
    ordered = flagged.select(*order, code.cast("int").alias("code")).repartitionByRange(parts, *order) \
        .sortWithinPartitions(*order).select("k", "id", "code")
    names = ["k", "part", "edge", "n", "codes", "ids", "first", "last", "illegal"]
    types = [pa.string(), pa.int32(), pa.bool_(), pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int64()]

    def run(batches):
        part, first = TaskContext.get().partitionId(), True
        key, codes, ids = None, [], []

        def packed(edge):
            c, i = np.concatenate(codes), np.concatenate(ids)
            role = c & 3
            return (key, part, edge, len(c), c.tobytes(), i.tobytes(), int(role[0]), int(role[-1]), illegal(role))

        for b in batches:
            ks, cs, js = b["k"].to_pylist(), b["code"].to_numpy().astype(np.uint8), b["id"].to_numpy()
            edges = [0, *(i for i in range(1, len(ks)) if ks[i] != ks[i - 1]), len(ks)]
            done = []
            for s, e in zip(edges, edges[1:]):
                if key is not None and ks[s] != key:
                    done.append(packed(first))
                    first, codes, ids = False, [], []
                key = ks[s]
                codes.append(cs[s:e])
                ids.append(js[s:e])
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names)
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(packed(True), types)], names)

    return map_batches(ordered, run, "k string, part int, edge boolean, n long, codes binary, ids binary, first int, "
                                     "last int, illegal long", 4096)


_SOLVED = "k string, part int, letters string, given binary, ids binary, cost long, illegal long"


def _solved_alone(segments: DataFrame) -> DataFrame:
    """Segments that are whole conversations."""

    def run(batches):
        for b in batches:
            codes = b["codes"].to_pylist()
            paths = [walk(c, END, True)[0] for c in codes]
            yield pa.RecordBatch.from_arrays(
                [b["k"], b["part"], pa.array([p[0] for p in paths], pa.string()), pa.array([p[1] for p in paths], pa.binary()),
                 b["ids"], pa.array([costs_before(c, END)[START] for c in codes], pa.int64()), b["illegal"]],
                ["k", "part", "letters", "given", "ids", "cost", "illegal"])

    return map_batches(segments, run, _SOLVED, 1024)


def _solved_together(segments: DataFrame) -> DataFrame:
    """Segments of conversations that may lie in several tasks. What a conversation's segments have to tell
    each other is a row of numbers each, at most one a task."""

    def matrices(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b["k"], b["part"], b["first"], b["last"],
                 pa.array([matrix(c) for c in b["codes"].to_pylist()], pa.list_(pa.int64()))],
                ["k", "part", "first", "last", "m"])

    def closing(t: pa.Table) -> pa.Table:
        rows = t.sort_by("part").to_pylist()
        after, out = list(END), []
        for i in range(len(rows) - 1, -1, -1):
            r = rows[i]
            before = [min(_add(r["m"][4 * s + x], after[x]) for x in range(4)) for s in range(4)]
            out.append({"k": r["k"], "part": r["part"], "after": after, "final": i == len(rows) - 1, "cost": before[START],
                        "seam": illegal(np.array([rows[i - 1]["last"], r["first"]])) if i else 0})
            after = before
        return pa.Table.from_pylist(out, pa.schema([
            ("k", pa.string()), ("part", pa.int32()), ("after", pa.list_(pa.int64())), ("final", pa.bool_()),
            ("cost", pa.int64()), ("seam", pa.int64())]))

    small = map_batches(segments, matrices, "k string, part int, first int, last int, m array<long>", 64)
    ends = small.groupBy("k").applyInArrow(
        closing, "k string, part int, after array<long>, final boolean, cost long, seam long")

    def walks(batches):
        for b in batches:
            found = [walk(c, after, final, range(4)) for c, after, final in
                     zip(*(b[x].to_pylist() for x in ("codes", "after", "final")))]
            yield pa.RecordBatch.from_arrays(
                [b["k"], b["part"], b["cost"], b["illegal"], b["ids"],
                 pa.array([[p[0] for p in f] for f in found], pa.list_(pa.string())),
                 pa.array([[p[1] for p in f] for f in found], pa.list_(pa.binary())),
                 pa.array([[p[2] for p in f] for f in found], pa.list_(pa.int32()))],
                ["k", "part", "cost", "illegal", "ids", "letters", "given", "exits"])

    joined = segments.select("k", "part", "codes", "ids", "illegal").join(ends, ["k", "part"]).select(
        "k", "part", "codes", "after", "final", "ids", "cost", (F.col("illegal") + F.col("seam")).alias("illegal"))
    walked = keep(map_batches(joined, walks, "k string, part int, cost long, illegal long, ids binary, "
                                             "letters array<string>, given array<binary>, exits array<int>", 8), "walks")

    def entered(t: pa.Table) -> pa.Table:
        state, out = START, []
        for i, r in enumerate(t.sort_by("part").to_pylist()):
            out.append({"k": r["k"], "part": r["part"], "entry": state, "head": i == 0})
            state = r["exits"][state]
        return pa.Table.from_pylist(out, pa.schema([
            ("k", pa.string()), ("part", pa.int32()), ("entry", pa.int32()), ("head", pa.bool_())]))

    entries = walked.select("k", "part", "exits").groupBy("k").applyInArrow(
        entered, "k string, part int, entry int, head boolean")
    return walked.join(entries, ["k", "part"]).select(
        "k", "part", F.get("letters", "entry").alias("letters"), F.get("given", "entry").alias("given"), "ids",
        F.when(F.col("head"), F.col("cost")).otherwise(0).alias("cost"), "illegal")


def _edit_rows(solved: DataFrame) -> DataFrame:
    """(k, part, place, edit, id, given): one row an edit; ``id`` of the row it is done to, null for inserts."""

    def run(batches):
        for b in batches:
            for k, part, letters, given, ids in zip(*(b[c].to_pylist() for c in ("k", "part", "letters", "given", "ids"))):
                n = len(letters)
                edit = np.frombuffer(letters.encode(), np.uint8)
                old = edit != ord("I")
                at = np.zeros(n, np.int64)
                at[old] = np.frombuffer(ids, np.int64)
                for s in range(0, n, 65536):
                    e = slice(s, s + 65536)
                    m = len(edit[e])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k] * m, pa.string()), pa.array(np.full(m, part, np.int32)),
                         pa.array(np.arange(s, s + m)), pa.array(list(letters[e]), pa.string()),
                         pa.array(at[e], mask=~old[e]), pa.array(np.frombuffer(given, np.uint8)[e].astype(np.int32))],
                        ["k", "part", "place", "edit", "id", "given"])

    return map_batches(solved, run, "k string, part int, place long, edit string, id long, given int", 256)


def repair(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> Repair:
    """The cheapest repair of every conversation of ``df``; see the module and :class:`Repair`.

    Null role and text are one space. Rows go by turn, null turns first; rows of one
    turn by role and the SHA-256 of their text, so ties do not depend on the files' order. A
    row's first fault counts: blank (no character but white space), duplicate (role and
    text occurred before in the conversation; a repeated row is one), truncated (last such character
    none of ``.!?``). ``gaps`` are the turns between the least and the largest that no row has, null
    turns aside. A null conversation is one like any other. Rows of an empty table: none. Texts of any length are
    read whole, but only their digest, faults and role are shuffled before the repaired rows are put
    together. A conversation's ``audit`` is one string of a letter a row, so a conversation of more
    than two billion rows has no summary; ``rows`` has no such bound. Other columns are not read.
    """
    def text(c: str) -> F.Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    conv = F.col(conv_col)
    rows = keep(df.select(
        F.when(conv.isNull(), "").otherwise(F.concat(F.lit("="), conv.cast("string"))).alias("k"), conv.alias("conv"),
        F.col(turn_col).cast("long").alias("turn"), text(role_col).alias("role"), text(text_col).alias("text"),
        F.monotonically_increasing_id().alias("id")), "conversation_rows")
    flagged = keep(_flagged(rows), "faults")
    segments = keep(_segments(flagged), "segments")
    solved = keep(_solved_alone(segments.where(~F.col("edge"))).unionByName(
        _solved_together(segments.where("edge"))), "repairs")

    counts = flagged.groupBy("k").agg(
        F.first("conv").alias("conv"), F.min("turn").alias("low"), F.max("turn").alias("high"),
        F.count_distinct("turn").alias("turns"), *(F.count_if(c).alias(c) for c in ("blank", "duplicate", "truncated")))
    told = solved.groupBy("k").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"),
                                   F.sort_array(F.collect_list(F.struct("part", "letters"))).alias("parts"))
    summary = counts.join(told, "k").select(
        "conv", F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).alias("gaps"), "blank", "duplicate",
        "truncated", "illegal", "cost", F.array_join("parts.letters", "").alias("audit"))

    edits = keep(_edit_rows(solved.drop("cost", "illegal")).where(F.col("edit") != "D"), "edits")
    role = F.when(F.col("given") == USER, "user").when(F.col("given") == ASSISTANT, "assistant")
    old = edits.where(F.col("id").isNotNull()).join(rows.select("id", "conv", "role", "text"), "id").select(
        "k", "conv", "part", "place", "edit", F.coalesce(role, "role").alias("role"), "text")
    new = edits.where(F.col("id").isNull()).join(counts.select("k", "conv"), "k").select(
        "k", "conv", "part", "place", "edit", role.alias("role"), F.lit("").alias("text"))
    return Repair(summary, old.unionByName(new))


def digests(rows: DataFrame) -> DataFrame:
    """(conv, sha256): hex digest of each conversation's ``role:text`` lines, newline-joined. The rows stream
    through a task in order; a digest of a whole conversation can't be made in parts."""
    kind = rows.schema["conv"].dataType.simpleString()
    ordered = rows.repartition("k").sortWithinPartitions("k", "part", "place").select("k", "conv", "role", "text")

    def run(batches):
        key, sha, conv = None, None, None
        for b in batches:
            out = []
            for k, role, text, c in zip(b["k"].to_pylist(), b["role"].to_pylist(), b["text"].to_pylist(), b["conv"]):
                if k != key:
                    if sha:
                        out.append((conv, sha.hexdigest()))
                    key, sha, conv = k, hashlib.sha256(), c
                else:
                    sha.update(b"\n")
                sha.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c.as_py() for c, _ in out], conv.type), pa.array([s for _, s in out])], ["conv", "sha256"])
        if sha:
            yield pa.RecordBatch.from_arrays([pa.array([conv.as_py()], conv.type), pa.array([sha.hexdigest()])],
                                             ["conv", "sha256"])

    return map_batches(ordered, run, f"conv {kind}, sha256 string", 1024)
