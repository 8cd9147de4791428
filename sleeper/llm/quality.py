"""Quality classifier with hierarchical empirical Bayes.

A document classifier gives the odds that a text is of low quality, and that it is
toxic: words that mark either class significantly, and measures of the text's
form, in a logistic regression. Documents of a host, and of a path on it, share
much of their quality: the share of bad documents of each host is estimated from
its documents' odds and shrunk towards the global share, that of each path towards
its host's, the more the fewer documents there are. The strength of shrinking is
estimated from the spread between sites. The site's odds against the global ones
are the prior that the document's evidence is combined with.
"""

from __future__ import annotations

from collections import Counter
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sleeper.llm.common import join_sites, keep, map_batches, texts_of, with_row_id

#: Labelled documents that marks and regression are fitted on at most (the first by a hash of the id).
FITTED = 20_000
#: Words and beginnings of words kept for each class: those that mark it best, from a signed root of
#: the G statistic of Z on.
MARKERS, Z = 2_000, 4.0
#: Beginnings of words of these lengths are marks like whole words.
STEMS = (4, 5, 7)
#: A site's prior may move a document's log odds by so much at most.
SWAY = 2.0
THRESHOLD = 0.5
#: Distinct marks a counting task holds before it passes them on.
HELD = 200_000
HEADS = ("low", "toxic")
FORMS, MEASURES = 13, 4
_STRIP = ".,;:!?()[]\"'*#%&$|"


def marks_of(word: str) -> list[str]:
    """A word, and with ``^`` before them its beginnings."""
    return [word, *("^" + word[:n] for n in STEMS if len(word) > n)]


def words_of(text: str) -> set[str]:
    """A text's words in lower case, without punctuation."""
    return {w.strip(_STRIP) for w in set(text.lower().split())} - {""}


def marks(text: str) -> set[str]:
    return {m for w in words_of(text) for m in marks_of(w)}


_SPACE, _UPPER, _DIGIT = b" \t\n\r\x0b\x0c", bytes(range(65, 91)), b"0123456789"
_SIGNS = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def _count(raw: bytes, of: bytes) -> int:
    return len(raw) - len(raw.translate(None, of))


def form(text: str) -> list[float]:
    """Measures of a text's form, each about between 0 and 1. Signs are counted as bytes."""
    raw, words = text.encode("utf-8", "surrogatepass"), text.lower().split()
    n, size = max(len(words), 1), max(len(raw), 1)
    solid = max(size - _count(raw, _SPACE), 1)
    digits, signs = _count(raw, _DIGIT), _count(raw, _SIGNS)
    letters = max(solid - digits - signs, 1)
    lines = [x for x in text.split("\n") if x.strip()]
    return [np.log1p(n) / 10, min(solid / n / 10, 3), _count(raw, _UPPER) / letters, 1 - letters / solid, digits / size,
            raw.count(b"|") / n, _count(raw, b"*#%&$") / n, raw.count(b"!!") / n, sum(map(eq, words, words[1:])) / n,
            1 - len(set(words)) / n, 1 - len(set(lines)) / max(len(lines), 1), _count(raw, b".!?") / n, float(not words)]


# ---------------------------------------------------------------- document classifier

def markers(labelled: DataFrame) -> dict[str, dict[str, float]]:
    """For each head, marks and their log odds in favour of the bad class.

    Counts documents over the labelled texts (text, low, toxic), equal texts once;
    only the MARKERS best significant marks of each head reach the driver.
    """
    labelled = keep(labelled.groupBy(F.xxhash64("text").alias("_same")).agg(
        F.min("text").alias("text"), *(F.max(h).alias(h) for h in HEADS)).drop("_same"), "distinct_labelled")

    def run(batches):
        seen = [Counter() for _ in range(1 + len(HEADS))]  # documents, and the bad ones of each head

        def flush():
            names = list(seen[0])
            out = pa.RecordBatch.from_arrays([pa.array(names, pa.string()),
                                              *(pa.array([c[m] for m in names], pa.int64()) for c in seen)],
                                             ["word", "n", *HEADS])
            for c in seen:
                c.clear()
            return out

        for b in batches:
            for t, *bad in zip(texts_of(b["text"]), *(b[h].to_pylist() for h in HEADS)):
                own = marks(t)
                for c, counts in zip(seen, (True, *bad)):
                    if counts:
                        c.update(own)
                if len(seen[0]) >= HELD:
                    yield flush()
        yield flush()

    totals = labelled.agg(F.count("*").alias("n"), *(F.coalesce(F.sum(h), F.lit(0)).alias(h) for h in HEADS)).first()
    counts = map_batches(labelled, run, "word string, n long, low long, toxic long") \
        .groupBy("word").agg(*(F.sum(c).alias(c) for c in ("n", *HEADS)))
    counts = keep(counts.where("n > 1"), "label_words")
    out = {}
    def part(x: F.Column, expected: F.Column) -> F.Column:
        return F.when(x > 0, x * F.log(x / expected)).otherwise(F.lit(0.0))

    for h in HEADS:
        n, bad = float(totals["n"] or 1), float(totals[h] or 0)
        with_bad, with_ = F.col(h), F.col("n")
        share = with_ / n
        odds = F.log((with_bad + 0.5) / (bad + 1)) - F.log((with_ - with_bad + 0.5) / (n - bad + 1))
        g = 2 * (part(with_bad, share * bad) + part(with_ - with_bad, share * (n - bad))
                 + part(bad - with_bad, (1 - share) * bad) + part(n - bad - with_ + with_bad, (1 - share) * (n - bad)))
        root = F.sqrt(F.greatest(g, F.lit(0.0)))
        top = counts.select("word", odds.alias("odds"), root.alias("root")).where(F.col("root") >= Z) \
            .orderBy(F.desc("root"), "word").limit(MARKERS)
        out[h] = {r["word"]: float(r["odds"]) for r in top.collect()}
    return out


class Classifier:
    """Scores texts: log odds of each head."""

    def __init__(self, marks: dict[str, dict[str, float]]):
        self.marks, self.weights, self.mean, self.scale = marks, {}, None, None
        # every mark of a word begins as the word does: most words end at this set
        self.begin = {m.removeprefix("^")[:STEMS[0]] for found in marks.values() for m in found}

    def features(self, text: str) -> list[float]:
        own, out, begin, first = words_of(text), form(text), self.begin, STEMS[0]
        marked = [marks_of(w) for w in own if w[:first] in begin]
        for h in HEADS:
            found = self.marks[h]
            best = sorted((max(hits) for ms in marked if (hits := [found[m] for m in ms if m in found])), reverse=True)
            strong = [x for x in best if x > 2]
            out += [max([0.0, *best[:1]]) / 5, max([0.0, *best[1:2]]) / 5, np.log1p(len(strong)),
                    np.log1p(len(strong)) - np.log1p(len(own)) / 2]
        return out

    def fit(self, x: np.ndarray, labels: dict[str, np.ndarray]) -> None:
        width = FORMS + MEASURES * len(HEADS)
        x = x.reshape(-1, width)
        self.mean = x.mean(axis=0) if len(x) else np.zeros(width)
        self.scale = x.std(axis=0) + 1e-3 if len(x) else np.ones(width)
        for h in HEADS:
            self.weights[h] = logistic(self._design(x), np.asarray(labels[h], float))

    def _design(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.concatenate([np.ones((len(x), 1)), z], axis=1)

    def odds(self, texts: list[str]) -> dict[str, np.ndarray]:
        x = self._design(np.array([self.features(t) for t in texts]).reshape(len(texts), -1)) if texts else None
        return {h: x @ self.weights[h] if texts else np.zeros(0) for h in HEADS}


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.3) -> np.ndarray:
    """Newton steps with a penalty on all weights but the constant; one pseudo-document of each class."""
    rate = (y.sum() + 1) / (len(y) + 2)
    w = np.zeros(x.shape[1])
    w[0] = np.log(rate / (1 - rate))
    if len(y) == 0 or y.min() == y.max():
        return w
    ridge = np.full(len(w), penalty)
    ridge[0] = 1e-3
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge * w
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge), slope)
        w = w - step * min(1, 5 / np.abs(step).max())
        if np.abs(step).max() < 1e-6:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          fitted: int = FITTED) -> Classifier:
    """Fit on the documents that ``labels`` (doc_id, quality, toxic) covers, at most ``fitted`` of them: the
    first by the hash of their id, and then of their text. Rows with the same id and text count once, so that no
    id, however many rows it has, is more than ``fitted`` rows or outweighs the others by its copies.
    The labels go to the documents, whose texts stay where they are but for those chosen. Labels with a null
    id are dropped, null classes count as good, and of several labels of one id the worst counts."""
    by_id = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        (1 - F.min(F.coalesce("quality", F.lit(1)))).cast("int").alias("low"),
        F.max(F.coalesce("toxic", F.lit(0))).cast("int").alias("toxic"))
    chosen = by_id.orderBy(F.xxhash64("id"), "id").limit(fitted)
    rows = with_row_id(docs, F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    found = rows.join(F.broadcast(chosen), "id").select(
        "id", *HEADS, F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"), F.struct("_file", "_row").alias("at"))
    picked = found.groupBy("id", *HEADS, "hash").agg(F.min("at").alias("at")).orderBy(F.xxhash64("id"), "id", "hash").limit(fitted)
    picked = keep(picked.select("at.*", *HEADS), "labelled_rows")
    labelled = keep(rows.join(F.broadcast(picked), ["_file", "_row"]).select("text", *HEADS), "labelled")
    model = Classifier(markers(labelled.select("text", *HEADS)))

    def run(batches):
        for b in batches:
            x = [model.features(t) for t in texts_of(b["text"])]
            yield pa.RecordBatch.from_arrays([b["low"], b["toxic"], pa.array(x, pa.list_(pa.float64()))],
                                             ["low", "toxic", "x"])

    sample = map_batches(labelled, run, "low int, toxic int, x array<double>").toArrow()
    model.fit(np.array(sample["x"].to_pylist(), float), {h: sample[h].to_numpy() for h in HEADS})
    return model


# ---------------------------------------------------------------- sites

def shrunk(sites: DataFrame, head: str, toward: F.Column) -> F.Column:
    """The posterior share of a site with ``n`` documents and the expected bad ones in ``head``:
    as if ``strength`` more documents had the share ``toward``."""
    return (F.col(head) + F.col(f"{head}_strength") * toward) / (F.col("n") + F.col(f"{head}_strength"))


def strengths(sites: DataFrame) -> dict[str, float]:
    """For each head how many documents the prior weighs, by the method of moments: from the spread
    of the sites' shares beyond what their sizes explain. One row of sums."""
    got = sites.agg(F.sum("n").alias("n"), F.count("*").alias("k"), F.sum(F.col("n") * F.col("n")).alias("nn"),
                    *(F.sum(h).alias(h) for h in HEADS),
                    *(F.sum(F.col(h) * F.col(h) / F.col("n")).alias(f"{h}_sq") for h in HEADS)).first()
    out = {}
    for h in HEADS:
        if not got["n"] or got["k"] < 2:
            out[h] = 10.0
            continue
        mean = got[h] / got["n"]
        within = mean * (1 - mean)
        spread = got[f"{h}_sq"] - got["n"] * mean * mean  # sum of n (share - mean)^2
        between = max((spread - (got["k"] - 1) * within) / max(got["n"] - got["nn"] / got["n"], 1e-9), 1e-9)
        out[h] = float(np.clip(within / between - 1, 2.0, 1e4))
    return out


def _logit(p: F.Column) -> F.Column:
    p = F.greatest(F.lit(1e-4), F.least(F.lit(1 - 1e-4), p))
    return F.log(p / (1 - p))


def judge(docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text",
          host_col: str = "source", path_col: str = "lang") -> DataFrame:
    """:func:`judge_rows` over any frame with an id, a text, a host and a path column."""
    return judge_rows(with_row_id(
        docs, F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
        F.col(host_col).cast("string").alias("host"), F.col(path_col).cast("string").alias("path")), model)


def judge_rows(rows: DataFrame, model: Classifier) -> DataFrame:
    """Combine the classifier's evidence on rows (_file, _row, doc_id, text, host, path) with their sites'.

    Returns one row per row: ``_file``, ``_row``, ``doc_id``, for each head the
    document's own probability (``p_low``, ``p_toxic``), its host's and path's
    posterior shares (``host_low``, ``path_low``, ...) and the combined probability
    (``low``, ``toxic``), and ``kept`` (neither reaches THRESHOLD, a tie with it is one that does).
    Null and empty texts have the form of an empty text, texts of any length are read whole; a null
    host or path is a site named by the empty string. Equal rows get equal results; an empty
    table gives no rows.
    """
    def run(batches):
        for b in batches:
            odds = model.odds(texts_of(b["text"]))
            yield pa.RecordBatch.from_arrays([*(b[c] for c in ("_file", "_row", "doc_id", "host", "path")),
                                              *(pa.array(odds[h]) for h in HEADS)],
                                             ["_file", "_row", "doc_id", "host", "path", *HEADS])

    rows = rows.select("_file", "_row", "doc_id", "text", F.coalesce("host", F.lit("")).alias("host"),
                       F.coalesce("path", F.lit("")).alias("path"))
    scored = keep(map_batches(rows, run, "_file long, _row long, doc_id long, host string, path string, "
                                         "low double, toxic double"), "evidence")
    share = {h: (1 / (1 + F.exp(-F.col(h)))).alias(h) for h in HEADS}
    paths = keep(scored.select("host", "path", *share.values()).groupBy("host", "path")
                 .agg(F.count("*").alias("n"), *(F.sum(h).alias(h) for h in HEADS)), "paths")
    hosts = keep(paths.groupBy("host").agg(F.sum("n").alias("n"), F.count("*").alias("paths"),
                                           *(F.sum(h).alias(h) for h in HEADS)), "hosts")
    top = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
                    *(F.coalesce(F.sum(h), F.lit(0.0)).alias(h) for h in HEADS)).first()
    overall = {h: min(max(top[h] / max(top["n"], 1), 1e-4), 1 - 1e-4) for h in HEADS}

    def posterior(sites: DataFrame, toward: dict[str, F.Column], name: str) -> DataFrame:
        force = strengths(sites)
        for h in HEADS:
            sites = sites.withColumn(f"{h}_strength", F.lit(force[h]))
        return sites.select("*", *(shrunk(sites, h, toward[h]).alias(f"{name}_{h}") for h in HEADS))

    hosts = posterior(hosts, {h: F.lit(overall[h]) for h in HEADS}, "host").select(
        "host", "paths", *(f"host_{h}" for h in HEADS))
    with_host = join_sites(paths, keep(hosts, "host_posteriors"), ["host"], "paths")
    sites = keep(posterior(keep(with_host, "path_hosts"), {h: F.col(f"host_{h}") for h in HEADS}, "path").select(
        "host", "path", "n", *(f"{s}_{h}" for s in ("host", "path") for h in HEADS)), "path_posteriors")
    out = join_sites(scored, sites, ["host", "path"], "n")
    for h in HEADS:
        sway = _logit(F.col(f"path_{h}")) - float(np.log(overall[h] / (1 - overall[h])))
        both = F.col(h) + F.greatest(F.lit(-SWAY), F.least(F.lit(SWAY), sway))
        out = out.withColumn(f"p_{h}", 1 / (1 + F.exp(-F.col(h)))).withColumn(h, 1 / (1 + F.exp(-both)))
    return out.select("_file", "_row", "doc_id", *(f"{x}_{h}" for h in HEADS for x in ("p", "host", "path")), *HEADS,
                      ((F.col("low") < THRESHOLD) & (F.col("toxic") < THRESHOLD)).alias("kept"))
