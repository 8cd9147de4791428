"""Personal data by weak supervision.

Wide patterns propose spans of each kind; labelers (the strict pattern and its
checks, lists of what such data looks like, cue words and signs around it) vote on
each. Expectation-maximisation over the votes of all documents estimates how
reliable each labeler is for each kind, and so how likely each span is real. A
final classifier over the span's form and surroundings is fitted to these
likelihoods and decides. Spans of the strict patterns (the base) always stay.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sleeper.llm.common import keep, map_batches, texts_of, with_row_id

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("strict", "check", "gazetteer", "cue", "edges", "shape")
#: Rounds of expectation-maximisation and of the classifier's fit.
ROUNDS, STEPS = 50, 300
THRESHOLD = 0.5

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    double = [0, 2, 4, 6, 8, 1, 3, 5, 7, 9]
    return sum(double[int(d)] if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of the strict pattern, each sign at a time, so that long runs stay linear."""
    end = 0
    while (at := text.find("@", end)) >= 0:
        start = end + len(text[end:at].rstrip(_LOCAL))
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
        end = m.end() if m else at + 1


def dotted(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """Leftmost groups of four numbers with dots between, from runs of any length."""
    for m in _DOTTED.finditer(text):
        if m[0].count(".") < 3:
            continue
        at, numbers = m.start(), m[0].split(".")
        for i in range(0, len(numbers) - 3, 4):
            four = numbers[i:i + 4]
            size = sum(map(len, four)) + 3
            yield at, at + size, four
            at += size + 1


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the strict patterns, by kind and place."""
    out = []
    if "@" in text:
        out += [("email", a, b) for a, b in emails(text)]
    if _DIGITS.search(text):
        out += [("ip", a, b) for a, b, four in dotted(text)
                if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in four)]
        out += [("card", m.start(), m.end()) for m in _CARD.finditer(text)
                if 16 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
        if "+" in text:
            out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


# ---------------------------------------------------------------- candidates

_AT = re.compile(r"(?i)\s?[(\[{]\s?at\s?[)\]}]\s?")
_SPOKEN = re.compile(r"(?i)[a-z0-9-]{1,63}(?:\s?(?:\.|[(\[{]\s?dot\s?[)\]}])\s?[a-z0-9-]{1,63}){1,6}")
_DEFANGED = re.compile(r"(?<![0-9.])[0-9]{1,3}(?:(?:\[\.\]|\(\.\))[0-9]{1,3}){3}(?![0-9])")
_SIX = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
_LONG = re.compile(r"(?<![0-9])[0-9](?:[\x20. -]?[0-9]){12,18}(?![0-9])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+(])(?:00[1-9][0-9]{0,2}[\x20.-])?(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])"
                          r"[0-9]{3}[\x20.-][0-9]{4}(?![0-9])")


def candidates(text: str) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, base): the base and what the wide patterns propose beside it."""
    base = base_spans(text)
    wide: list[tuple[str, int, int]] = []
    if "at" in text or "At" in text or "AT" in text:
        end = 0
        for m in _AT.finditer(text):
            before = text[end:m.start()]
            end = m.end()
            n = len(before) - len(before.rstrip(_LOCAL))
            if n and (d := _SPOKEN.match(text, end)):
                wide.append(("email", m.start() - n, d.end()))
    if _DIGITS.search(text):
        wide += [("ip", a, b) for a, b, _ in dotted(text)]
        for kind, pattern in (("ip", _DEFANGED), ("ip", _SIX), ("card", _LONG), ("phone", _LOCAL_PHONE)):
            wide += [(kind, m.start(), m.end()) for m in pattern.finditer(text)]
    out = [(*s, True) for s in base]
    if not wide:
        return out
    starts = sorted(a for _, a, _ in base)
    ends = list(accumulate((b for _, b in sorted((a, b) for _, a, b in base)), max))  # the largest end up to each start
    reach = 0  # of the wide spans so far, which come by their start
    for kind, a, b in sorted(set(wide) - set(base), key=lambda s: (s[1], -s[2], s[0])):
        i = bisect_left(starts, b)
        if reach <= a and not (i and ends[i - 1] > a):
            out.append((kind, a, b, False))
            reach = b
    return out


# ---------------------------------------------------------------- labelers

# Words that announce data of a kind, and words that announce something else.
CUES = {"email": ("mail", "e-mail", "email", "contact", "write", "from", "to", "cc", "reply"),
        "ip": ("ip", "ipv4", "ipv6", "address", "host", "server", "client", "addr", "peer"),
        "card": ("card", "visa", "mastercard", "amex", "credit", "debit", "cc", "pan", "payment"),
        "phone": ("phone", "tel", "telephone", "call", "mobile", "cell", "fax", "dial", "whatsapp")}
AGAINST = ("version", "ver", "v", "release", "build", "isbn", "issn", "doi", "id", "serial", "order", "invoice", "sku",
           "token", "key", "hash", "sha", "commit", "section", "page", "figure", "chapter")
# Top-level names common in mail, and the first digits of card issuers.
TLDS = frozenset("com org net edu gov mil int info biz io co us uk de fr es it nl eu ch at be se no dk pl ru jp cn in br "
                 "ca au mx pt ie fi cz gr hu ro tr kr tw za nz me tv dev app ai".split())
ISSUERS = ("4", "51", "52", "53", "54", "55", "22", "23", "24", "25", "26", "27", "34", "37", "36", "38", "30", "6011",
           "65", "64", "35", "62")
_CUE_WORD = re.compile(r"[A-Za-z0-9-]+")


def votes(text: str, kind: str, a: int, b: int, base: bool) -> tuple[int, ...]:
    """Of each labeler: 1 for, -1 against, 0 no opinion."""
    span, digits = text[a:b], _digits(text[a:b])
    left, right = text[a - 1:a], text[b:b + 1]
    before = [w.lower() for w in _CUE_WORD.findall(text[max(0, a - 24):a])][-3:]
    if kind == "email":
        name = re.split(r"[.\s)\]}]+", span)[-1].lower()
        check = 1 if name.isalpha() and 2 <= len(name) <= 24 else -1
        known = 1 if name in TLDS else 0
        shape = 1 if ".." not in span and not span.startswith(".") else -1
    elif kind == "ip":
        numbers = re.findall(r"[0-9A-Fa-f]+", span)
        four = len(numbers) == 4
        check = 1 if not four or all(x.isdigit() and int(x[-9:]) <= 255 and len(x) <= 9 for x in numbers) else -1
        known = -1 if four and numbers[0] in ("0", "00", "000") else 1 if four and len(digits) >= 8 else 0
        shape = -1 if four and any(len(x) > 1 and x[0] == "0" for x in numbers) else 1
    elif kind == "card":
        check = 1 if luhn(digits) else -1
        known = 1 if digits.startswith(ISSUERS) else -1
        groups = [len(x) for x in re.findall(r"[0-9]+", span)]
        shape = 1 if len(groups) == 1 or groups[0] == 4 and max(groups) <= 6 else -1
    else:
        check = 1 if 8 <= len(digits) <= 15 else -1
        known = 1 if span.startswith(("+", "00")) else 0
        shape = 1 if span.count("(") == span.count(")") and len(set(digits)) > 2 else -1
    cue = -1 if any(w in AGAINST for w in before) else 1 if any(w in CUES[kind] for w in before) else 0
    inside = left.isalnum() or right.isalnum() or left in ("_", "/", "=", "#") and left or right in ("_", "=") and right
    more = right == "." and text[b + 1:b + 2].isdigit() or left == "." and text[a - 2:a - 1].isdigit()
    return (1 if base else -1, check, known, cue, -1 if inside or more else 1, shape)


FEATURES = 8


def features(text: str, kind: str, a: int, b: int, base: bool) -> tuple[int, ...]:
    """What the final classifier sees: small whole numbers only, so that their combinations are few."""
    span = text[a:b]
    digits = sum("0" <= c <= "9" for c in span)
    return (int(base), min(digits // 4, 4), min((b - a) // 8, 4), min(sum(not c.isalnum() for c in span), 6),
            int(text[a - 1:a].isspace() or a == 0), int(text[b:b + 1].isspace() or b == len(text)),
            int(text[a - 1:a].isalnum()), int(text[b:b + 1].isalnum()))


SPANS = "_file long, _row long, doc_id long, spans array<struct<kind:int,from:int,to:int,base:boolean,form:string>>"


def propose(rows: DataFrame) -> DataFrame:
    """Each row's candidates with votes and features (``form``), in the order of kind and place."""
    span = pa.struct([("kind", pa.int32()), ("from", pa.int32()), ("to", pa.int32()), ("base", pa.bool_()),
                      ("form", pa.string())])

    def run(batches):
        for b in batches:
            out = []
            for t in texts_of(b["text"]):
                found = sorted((KINDS.index(k), x, y, base) for k, x, y, base in candidates(t))
                out.append([{"kind": k, "from": x, "to": y, "base": base, "form": " ".join(
                    map(str, (*votes(t, KINDS[k], x, y, base), *features(t, KINDS[k], x, y, base))))}
                    for k, x, y, base in found])
            yield pa.RecordBatch.from_arrays([b["_file"], b["_row"], b["doc_id"], pa.array(out, pa.list_(span))],
                                             ["_file", "_row", "doc_id", "spans"])

    return map_batches(rows, run, SPANS)


# ---------------------------------------------------------------- models

def reliabilities(votes_: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Expectation-maximisation over patterns of votes (-1, 0, 1) that occur ``n`` times.

    Returns how likely each pattern is real, each labeler's chance of each vote for
    real and for other spans (2 x labelers x 3), and the share of real spans. The
    start trusts every labeler somewhat, and the pseudo-counts keep it from
    turning round: to each vote belong 10 spans on which labelers are right 8 times
    in 10.
    """
    prior = np.empty((2, votes_.shape[1], 3))
    prior[1] = (1.0, 1.0, 8.0)
    prior[0] = (8.0, 1.0, 1.0)
    table, share = prior / 10, 0.5
    hot = votes_[:, :, None] == np.array([-1, 0, 1])
    real = np.zeros(len(n))
    for _ in range(ROUNDS):
        like = [np.log(table[c][None].repeat(len(n), 0)[hot].reshape(len(n), -1)).sum(axis=1) for c in (0, 1)]
        odds = like[1] + np.log(share) - like[0] - np.log(1 - share)
        real = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
        share = (float((real * n).sum()) + 1) / (float(n.sum()) + 2)
        for c, weight in ((0, n * (1 - real)), (1, n * real)):
            sums = (weight[:, None, None] * hot).sum(axis=0) + prior[c]
            table[c] = sums / sums.sum(axis=1, keepdims=True)
    return real, table, share


def _design(forms: np.ndarray) -> np.ndarray:
    """Votes and features of a kind's spans as columns, with a constant."""
    x = forms.astype(float)
    return np.concatenate([np.ones((len(x), 1)), x[:, :len(LABELERS)], x[:, len(LABELERS):] / 4], axis=1)


def fit(forms: np.ndarray, n: np.ndarray, real: np.ndarray) -> np.ndarray:
    """Logistic regression of the likelihoods on the forms, by Newton steps with a small penalty."""
    x, weights = _design(forms), np.zeros(_design(forms[:1]).shape[1])
    n = n / max(n.sum(), 1) * 1000
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (n * (p - real)) + weights
        step = np.linalg.solve((x * (n * p * (1 - p) + 1e-9)[:, None]).T @ x + np.eye(len(weights)), slope)
        weights = weights - step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def train(spans: DataFrame) -> dict[int, np.ndarray]:
    """A classifier for each kind from the forms of all spans (column ``spans``).

    What reaches the driver are distinct forms with their counts: votes and features
    are small whole numbers, so they are few however many spans there are.
    """
    forms = spans.select(F.explode("spans").alias("s")).groupBy("s.kind", "s.form").agg(F.count("*").alias("n"))
    got = forms.orderBy("kind", "form").collect()
    models = {}
    for kind in sorted({r["kind"] for r in got}):
        own = [r for r in got if r["kind"] == kind]
        table, n = np.array([list(map(int, r["form"].split())) for r in own]), np.array([r["n"] for r in own], float)
        real, _, _ = reliabilities(table[:, :len(LABELERS)], n)
        models[kind] = fit(table, n, real)
    return models


def likely(models: dict[int, np.ndarray], kind: int, form: str) -> float:
    x = _design(np.array([list(map(int, form.split()))]))[0]
    return float(1 / (1 + np.exp(-np.clip(x @ models[kind], -30, 30))))


FOUND = "_file long, _row long, doc_id long, base array<struct<kind:string,from:int,to:int>>, " \
        "spans array<struct<kind:string,from:int,to:int>>"


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Personal data in every whole text.

    Returns one row per row of ``docs``: ``_file``, ``_row``, ``doc_id``, ``base``
    (spans of the strict patterns) and ``spans`` (these and what the classifier
    finds likely), by kind and start, in code points, end exclusive. Spans of the
    wide patterns never overlap others; of two that would, the one that starts
    first stays, then the longer, then the kind's name. Very long texts are read whole,
    and their spans swept in one pass, however many there are. Null and empty texts have
    none; equal rows get equal spans; an empty table gives no rows. Other columns
    are not read.
    """
    rows = with_row_id(docs, F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    proposed = keep(propose(rows), "pii_spans")
    models = train(proposed)
    span = pa.list_(pa.struct([("kind", pa.string()), ("from", pa.int32()), ("to", pa.int32())]))

    def run(batches):
        known: dict[tuple[int, str], bool] = {}
        for b in batches:
            base, every = [], []
            for spans in b["spans"].to_pylist():
                for s in spans:
                    form = s["kind"], s["form"]
                    if form not in known:
                        known[form] = likely(models, *form) >= THRESHOLD
                own = [{"kind": KINDS[s["kind"]], "from": s["from"], "to": s["to"]} for s in spans]
                base.append([o for o, s in zip(own, spans) if s["base"]])
                every.append([o for o, s in zip(own, spans) if s["base"] or known[s["kind"], s["form"]]])
            yield pa.RecordBatch.from_arrays([b["_file"], b["_row"], b["doc_id"], pa.array(base, span),
                                              pa.array(every, span)], ["_file", "_row", "doc_id", "base", "spans"])

    return map_batches(proposed, run, FOUND)


def mask(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by its kind in angle brackets."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], s[2])):
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])
