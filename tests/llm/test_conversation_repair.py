from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from llm_support import CLASH, SF_SMALL, make  # noqa: F401

from sleeper.llm import conversation_repair as R
from sleeper.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
NAME = {"u": "user", "a": "assistant"}


def brute(rows):
    """Cheapest and then ASCII-least edits by comparing (cost, letters) of every way through the rows.
    ``rows`` are (turn, role, text) in order."""
    faults, seen = [], set()
    for _, role, text in rows:
        bare = text.strip(SPACE)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else
                      "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    done = {"": (0, "", ())}  # state -> (cost, letters, repaired), the least

    def better(table, state, value):
        if state not in table or value[:2] < table[state][:2]:
            table[state] = value

    def inserted(table):
        for _ in range(3):
            for state, (cost, letters, out) in list(table.items()):
                to = NEXT[state]
                better(table, to, (cost + 2, letters + "I", (*out, f"{NAME[to]}:")))
        return table

    for (_, role, text), fault in zip(rows, faults):
        new = {}
        for state, (cost, letters, out) in inserted(done).items():
            better(new, state, (cost + 3, letters + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            more = fault == "truncated"
            first = role[:1]
            if first == NEXT[state] or (first == "s" and not state):
                better(new, first, (cost + more, letters + "K", (*out, f"{role}:{text}")))
            to = NEXT[state]
            better(new, to, (cost + 2 + more, letters + "R", (*out, f"{NAME[to]}:{text}")))
        done = new
    inserted(done)
    cost, letters, out = min((done[s] for s in ("", "a") if s in done), key=lambda x: x[:2])
    initials = [r[:1] for _, r, _ in rows]
    turns = [t for t, _, _ in rows if t is not None]
    assert re.fullmatch("(s?(ua)+)?", "".join(o[:1] for o in out))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, letters, "\n".join(out))


def ordered(rows):
    def key(r):
        return (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest())

    return sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=key)


def damage(rows):
    """The contract's damage to (conv, turn, role, text)."""
    out = []
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if k:
            text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            out += [(c, t, "user" if k == 4 else role, text)] * (1 + (k == 3))
    return out


def by_conversation(rows):
    found = {}
    for c, *r in rows:
        found.setdefault(c, []).append(tuple(r))
    return found


def got_of(result):
    shas = {r["conv"]: r["sha256"] for r in R.digests(result.rows).collect()}
    return {r["conv"]: (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"],
                        shas.get(r["conv"], hashlib.sha256(b"").hexdigest())) for r in result.summary.collect()}


def want_of(rows):
    out = {}
    for c, mine in by_conversation(rows).items():
        *numbers, text = brute(ordered(mine))
        out[c] = (*numbers, hashlib.sha256(text.encode()).hexdigest())
    return out


def random_rows(rng, convs, most):
    texts = ["a.", "b?", "open", " ", "", "c! \n", "d,", "é.", "x" * 50 + "."]
    return [(c, rng.choice([None, *range(12)]), rng.choice(["user", "assistant", "system", "tool", None, "u", "a"]), rng.choice(texts))
            for c in range(convs) for _ in range(rng.randint(1, most))]


def test_query_matches_brute_force(spark):
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text"))
            for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()]
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    want = {c: empty for c, *_ in rows} | want_of(damage(rows))
    got = {r["conv_id"]: tuple(r)[1:] for r in queries.op13_checkpointed_repair(spark, SF_SMALL).collect()}
    assert got == want


def test_random_conversations(spark, make):
    rows = random_rows(random.Random(1), 120, 14)
    assert got_of(R.repair(make(rows, SCHEMA))) == want_of(rows)


def test_one_conversation_over_all_tasks(spark, make):
    """Two long conversations, each in several tasks, between short ones."""
    rng = random.Random(2)
    rows = random_rows(rng, 6, 4)
    for c in (2, 4):
        rows += [(c, 100 + i, rng.choice(["user", "assistant", "user", "tool"]), f"{rng.choice('abc')}{i // rng.choice([1, 2])}.")
                 for i in range(700)]
    result = R.repair(make(rows, SCHEMA))
    assert got_of(result) == want_of(rows)
    assert result.rows.where("conv = 2").select("part").distinct().count() > 1


@pytest.mark.parametrize("seed", range(4))
def test_walk_in_pieces(seed):
    """Any cutting of a conversation gives the edits of the whole."""
    rng = random.Random(seed)
    codes = bytes(rng.choice([0, 1, 2, 3, 1, 2, 1 | R.CUT, 2 | R.CUT, 1 | R.MUST, 2 | R.MUST, 3 | R.CUT]) for _ in range(60))
    whole = R.walk(codes, R.END, True)[0]
    cuts = sorted(rng.sample(range(61), 4))
    pieces = [codes[a:b] for a, b in zip([0, *cuts], [*cuts, 60])]
    after, ends = list(R.END), []
    for p in reversed(pieces):
        ends.insert(0, after)
        m = R.matrix(p)
        after = [min(m[4 * s + t] + after[t] for t in range(4)) for s in range(4)]
    state, letters = R.START, ""
    for i, (p, end) in enumerate(zip(pieces, ends)):
        piece = R.walk(p, end, i == len(pieces) - 1, range(4))[state]
        letters, state = letters + piece[0], piece[2]
    assert letters == whole[0] and after[R.START] == R.costs_before(codes, R.END)[R.START]


def test_odd_rows(spark, make):
    rows = [(None, 1, "user", "a."), (None, None, "assistant", "b."), (1, None, None, None), (2, 5, "user", "é" * 200_000),
            (2, 5, "user", "é" * 200_000), (3, 1, "", "x."), (4, 2, "assistant", "Yes!"), (4, 9, "system", "s.")]
    df = make([(*r, *["z"] * 13) for r in rows], f"{SCHEMA}, {CLASH}")
    assert got_of(R.repair(df)) == want_of(rows)
    result = R.repair(make([], SCHEMA))
    assert result.summary.collect() == [] and result.rows.collect() == []
