"""Declarative data-quality rules, row routing and rule outcomes.

Rules are plain Python objects (no rule-language parser). Each row rule
yields a failure expression; ``evaluate`` attaches the names of the failed
rules to every row, ``split`` routes rows, ``outcomes`` aggregates per-rule
counts in a single pass, and ``observe`` collects the same counts during
another action (typically the Silver write) without a second scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sleeper.functions.scores import round_half_even


@dataclass(frozen=True)
class Rule:
    """One row rule.

    kind: ``complete`` (not NULL), ``between`` (lo..hi), ``at_least`` (>= lo) or
    ``expr`` (a SQL predicate that must hold). For range and expression rules a
    NULL value passes unless ``nulls="fail"``; completeness is its own rule.
    """

    name: str
    kind: str
    column: str | None = None
    lo: float | None = None
    hi: float | None = None
    inclusive: bool = True
    nulls: str = "pass"
    predicate: str | None = None

    def passes(self) -> Column:
        c = F.col(self.column) if self.column else None
        if self.kind == "complete":
            return c.isNotNull()
        if self.kind == "between":
            ok = c.between(self.lo, self.hi) if self.inclusive else (c > self.lo) & (c < self.hi)
        elif self.kind == "at_least":
            ok = c >= self.lo
        elif self.kind == "expr":
            ok = F.expr(self.predicate)
        else:
            raise ValueError(f"unknown rule kind {self.kind!r}")
        return F.coalesce(ok, F.lit(self.nulls != "fail"))

    def failure(self) -> Column:
        return ~self.passes()


def is_complete(column: str) -> Rule:
    return Rule(f'IsComplete "{column}"', "complete", column)


def column_between(column: str, lo: float, hi: float, inclusive: bool = True,
                   nulls: str = "pass") -> Rule:
    return Rule(f'ColumnValues "{column}" between {lo:g} and {hi:g}', "between", column, lo, hi,
                inclusive, nulls)


def column_at_least(column: str, lo: float, nulls: str = "pass") -> Rule:
    return Rule(f'ColumnValues "{column}" >= {lo:g}', "at_least", column, lo, nulls=nulls)


def row_rule(name: str, predicate: str, nulls: str = "pass") -> Rule:
    return Rule(name, "expr", predicate=predicate, nulls=nulls)


# The Silver rule set (7 completeness rules, 6 range rules).
RULES_SILVER: tuple[Rule, ...] = (
    is_complete("nombre"),
    is_complete("appid"),
    is_complete("precio"),
    is_complete("total_resenas"),
    is_complete("resenas_positivas"),
    is_complete("resenas_negativas"),
    is_complete("puntuacion"),
    column_between("metacritic_score", 0, 100),
    column_between("puntuacion", 0, 100),
    column_at_least("jugadores_actuales_api", 0),
    column_at_least("resenas_positivas", 0),
    column_at_least("resenas_negativas", 0),
    column_at_least("total_resenas", 10),
)

# The row rules the documentation names beyond the rule set.
RULES_README: tuple[Rule, ...] = (
    row_rule("positive <= total", "resenas_positivas <= total_resenas"),
    row_rule("price >= 0", "precio >= 0"),
    row_rule("positive pct between 0 and 100",
             "100.0 * resenas_positivas / nullif(total_resenas, 0) BETWEEN 0 AND 100"),
    row_rule("total > 0", "total_resenas > 0", nulls="fail"),
)


def column_count_gt(df: DataFrame, n: int = 0) -> bool:
    """Table rule ``ColumnCount > n``: schema only, no job."""
    return len(df.columns) > n


class TableRuleFailed(ValueError):
    """A rule on the table as a whole does not hold."""


@dataclass(frozen=True)
class TableRule:
    """One rule on a table: ``column_count`` (more than ``bound`` columns), ``row_count`` (``bound`` rows at
    least that passed) or ``pass_share`` (``bound`` of the rows at least passed; no rows pass).

    The first needs the schema only; the others read counters that the write has collected anyhow.
    """

    name: str
    kind: str
    bound: float

    @property
    def needs_counts(self) -> bool:
        return self.kind != "column_count"

    def measure(self, columns: int, evaluated: int | None = None, passed: int | None = None) -> float | None:
        if self.kind == "column_count":
            return float(columns)
        if self.kind == "row_count":
            return float(passed)
        if self.kind == "pass_share":
            return passed / evaluated if evaluated else None
        raise ValueError(f"unknown table rule kind {self.kind!r}")

    def holds(self, value: float | None) -> bool:
        return value is None or (value > self.bound if self.kind == "column_count" else value >= self.bound)


def column_count_above(n: int) -> TableRule:
    return TableRule(f"ColumnCount > {n}", "column_count", n)


def row_count_at_least(n: int) -> TableRule:
    return TableRule(f"RowCount >= {n}", "row_count", n)


def pass_share_at_least(share: float) -> TableRule:
    return TableRule(f"PassShare >= {share:g}", "pass_share", share)


# Fixed value: the table rule that a run is checked with when none are given.
RULES_TABLE: tuple[TableRule, ...] = (column_count_above(0),)


def table_outcomes(rules, columns: int, evaluated: int | None = None, passed: int | None = None,
                   best_effort: bool = False) -> list[dict]:
    """``{rule, value, outcome}`` of each table rule that can be told yet (without counts: the rules on the schema).

    Rules that do not hold end the run (:class:`TableRuleFailed`); with ``best_effort`` they are only reported.
    """
    out = []
    for r in rules:
        if r.needs_counts and evaluated is None:
            continue
        value = r.measure(columns, evaluated, passed)
        out.append({"rule": r.name, "value": value, "outcome": "Passed" if r.holds(value) else "Failed"})
    failed = [o["rule"] for o in out if o["outcome"] == "Failed"]
    if failed and not best_effort:
        raise TableRuleFailed(", ".join(failed))
    return out


def failed_rules(rules: tuple[Rule, ...] | list[Rule]) -> Column:
    """array<string> of the names of the rules a row fails, in rule order."""
    return F.filter(F.array(*[F.when(r.failure(), F.lit(r.name)) for r in rules]),
                    lambda x: x.isNotNull())


def evaluate(df: DataFrame, rules, col: str = "failed_rules") -> DataFrame:
    return df.withColumn(col, failed_rules(rules))


def split(df: DataFrame, rules, col: str = "failed_rules") -> tuple[DataFrame, DataFrame]:
    """(passed, rejected). ``passed`` keeps the input columns only.

    The failed rules come out of an array of one, so that neither the filter is pushed
    below them (and every rule evaluated once more there) nor the input's own
    expressions are repeated in each rule.
    """
    ev = df.select("*", F.explode(F.array(failed_rules(rules))).alias(col))
    return ev.where(F.size(col) == 0).drop(col), ev.where(F.size(col) > 0)


def audit(df: DataFrame, rules, col: str = "failed_rules") -> DataFrame:
    """All rows with the rules they fail and ``outcome`` (Passed or Failed), none routed away."""
    return evaluate(df, rules, col).withColumn(
        "outcome", F.when(F.size(col) == 0, F.lit("Passed")).otherwise(F.lit("Failed")))


def _count_columns(rules) -> list[Column]:
    return [F.count(F.lit(1)).alias("evaluated")] + [
        F.count_if(r.failure()).alias(f"f{i}") for i, r in enumerate(rules)]


def outcomes(df: DataFrame, rules, digits: int = 4) -> DataFrame:
    """Per rule: evaluated, failed, pass ratio and Passed/Failed, from one aggregate."""
    agg = df.agg(*_count_columns(rules))
    longf = agg.select("evaluated", F.explode(F.array(*[
        F.struct(F.lit(i).alias("rule_idx"), F.lit(r.name).alias("rule"), F.col(f"f{i}").alias("failed"))
        for i, r in enumerate(rules)])).alias("r"))
    return longf.select(
        "r.rule_idx", "r.rule", "evaluated", "r.failed",
        round_half_even((F.col("evaluated") - F.col("r.failed")) / F.nullif(F.col("evaluated"), F.lit(0)),
                        digits).alias("pass_ratio"),
        F.when(F.col("r.failed") == 0, F.lit("Passed")).otherwise(F.lit("Failed")).alias("outcome"),
    )


def observe(df: DataFrame, rules, name: str = "dq", col: str = "failed_rules") -> tuple[DataFrame, Observation]:
    """Attach rule counters to ``df``; they fill in when the next action runs. If the rows carry their
    failed rules in ``col``, the counters are taken from these, else from the rules."""
    obs = Observation(name)
    counts = routed_counts(rules, col) if col in df.columns else _count_columns(rules)
    return df.observe(obs, *counts), obs


def routed_counts(rules, col: str = "failed_rules", malformed: str = "Malformed record") -> list[Column]:
    """Counters taken from the column that routes the rows, so that counts and routing agree."""
    return [F.count(F.lit(1)).alias("evaluated"),
            F.count_if(F.array_contains(col, malformed)).alias("malformed"),
            F.count_if(F.size(col) == 0).alias("passed")] + [
        F.count_if(F.array_contains(col, r.name)).alias(f"f{i}") for i, r in enumerate(rules)]


def routed_outcomes(seen: list[dict], rules) -> dict[str, int]:
    """The sums of several :func:`routed_counts`, by name."""
    names = {"evaluated": "evaluated", "malformed": "malformed"} | {f"f{i}": r.name for i, r in enumerate(rules)}
    return {name: sum(int(m[k]) for m in seen) for k, name in names.items()}


def observed_outcomes(obs: Observation, rules) -> list[dict]:
    m = obs.get
    n = int(m["evaluated"])
    out = []
    for i, r in enumerate(rules):
        f = int(m[f"f{i}"])
        out.append({"rule": r.name, "evaluated": n, "failed": f,
                    "pass_ratio": (n - f) / n if n else None,
                    "outcome": "Passed" if f == 0 else "Failed"})
    return out
