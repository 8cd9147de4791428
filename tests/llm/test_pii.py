from __future__ import annotations

import hashlib
import random
import re
import time

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_support import SF_SMALL, make, odd_docs  # noqa: F401

from sleeper.llm import pii as P
from sleeper.llm import queries


def brute(text):
    """The base by the patterns as they are written in the contract."""
    out = [("email", m.start(), m.end()) for m in
           re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        odd = d[-1::-2]
        even = [sum(divmod(2 * x, 10)) for x in d[-2::-2]]
        if 16 <= len(d) <= 19 and (sum(odd) + sum(even)) % 10 == 0:
            out.append(("card", m.start(), m.end()))
    return out + [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
                  if 8 <= sum(c.isdigit() for c in m[0]) <= 15]


@settings(max_examples=500, deadline=None)
@given(st.text(st.sampled_from("a@.+-( )0129é\n"), max_size=40))
def test_base_is_the_patterns(text):
    assert P.base_spans(text) == brute(text)


def test_base_of_planted_spans():
    text = "é me.x+1@mail-3.example.com, 240.56.125.154; 4795 5229-3596 1213 x +1 (621) 555-4974. 1.2.3.4.5.6.7.8 999.1.1.1"
    assert P.base_spans(text) == brute(text) and len(P.base_spans(text)) >= 5
    for long in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "+1" + "(" * 200_000, "@" * 100_000):
        P.candidates(long)  # in a moment, not in hours


def test_many_spans_in_one_text():
    """Ten megabytes of numbers in seconds, and no proposed span overlaps another or the base."""
    began = time.process_time()
    found = P.candidates("555-123-4567 " * 800_000)
    assert len(found) >= 400_000 and time.process_time() - began < 60
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice(["+1", ".1", " 2", "300", "555-123-4567", "(at)", "a.b", "@", "4795 5229 3596 1213", ":f", " "])
                       for _ in range(30))
        spans = P.candidates(text)
        for k, a, b, base in spans:
            assert base or not any(x < b and a < y for o, x, y, _ in spans if (o, x, y) != (k, a, b)), (text, spans)
    assert ("ip", 17, 26, False) not in P.candidates("+1.1.1.1 2.2.2.2 300.1.1.1")
    name = "n" * 300
    assert ("email", 1, 1 + 300 + 6 + 11, False) in P.candidates(f" {name} (at) example.com")


def test_query_matches_brute_force(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = queries.op5_weak_supervision(spark, SF_SMALL).collect()
    assert len(got) == len(docs)
    for r in got:
        base = [f"{k}:{a}:{b}" for k, a, b in brute(docs[r["doc_id"]])]
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in P.KINDS] == [sum(s.startswith(k) for s in base) for k in P.KINDS]
        assert set(base) <= set(r["spans"].split(",")) | {""}


def test_labelers_learn_and_decide(spark, make):
    rows = []
    for i in range(300):
        rows.append((i, f"write me: anna.b{i}@mail.example.com or call +1 (621) 555-{1000 + i} now"))
        rows.append((1000 + i, f"call me, phone (621) 555-{1000 + i} ok"))
        rows.append((2000 + i, f"version 3.{i % 9}.{300 + i}.{i} and serial 555-123-{1000 + i}x"))
        rows.append((3000 + i, f"contact: joe{i} [at] site{i} [dot] org please"))
    got = {r["doc_id"]: r for r in P.find(make(rows, "doc_id long, text string")).collect()}
    added = {i: [s["kind"] for s in got[i]["spans"]] for i in got}
    assert all(added[i] == ["email", "phone"] for i in range(300))
    assert sum(added[1000 + i] == ["phone"] for i in range(300)) > 250
    assert sum(added[3000 + i] == ["email"] for i in range(300)) > 250
    assert sum(added[2000 + i] == [] for i in range(300)) > 250


def test_reliabilities_recover_planted_labelers():
    rng = np.random.default_rng(0)
    real = rng.random(20_000) < 0.3
    right = [0.95, 0.9, 0.8, 0.7, 0.85, 0.6]
    votes = np.stack([np.where(rng.random(len(real)) < p, real, ~real) * 2 - 1 for p in right], axis=1)
    patterns, at, n = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    likely, table, share = P.reliabilities(patterns, n.astype(float))
    assert abs(share - 0.3) < 0.03
    assert all(abs(table[1, k, 2] - p) < 0.05 for k, p in enumerate(right))
    assert ((likely[at] > 0.5) == real).mean() > 0.97


def test_odd_rows(spark, make):
    got = P.find(odd_docs(make)).collect()
    assert len(got) == 12 and all(r["base"] == [] or r["doc_id"] == 10 for r in got)
    assert P.find(make([], "doc_id long, text string")).collect() == []


def test_spans_do_not_overlap():
    text = "a@b.cc (at) d.ee 1.2.3.4 4111 1111 1111 1111 621-555-4974 10[.]0[.]0[.]1 +1 621 555 4974"
    spans = sorted((a, b) for _, a, b, base in P.candidates(text) if not base)
    assert all(b <= c for (_, b), (c, _) in zip(spans, spans[1:]))
    assert P.mask("x a@b.cc y", [("email", 2, 8)]) == "x <email> y"
