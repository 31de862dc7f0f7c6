"""Quality rules: a learned decision list (sequential covering, RIPPER style).

Each rule is a conjunction of thresholds on document statistics that rejects a
document. A rule grows on two thirds of the labelled rows by FOIL gain, is
pruned on the rest, and is taken only if it is precise enough there; the rows
it covers leave and the next rule is learned. The list becomes one ordered
Spark CASE expression, evaluated in the JVM beside the statistics.

Defined results: a null text counts as empty (all statistics 0) and meets the
same rules as any text, as does a very long one. Without usable labels, or with
one class, the list is empty and every document is kept. Repeated rows and ties
get equal decisions. An empty table gives no rows. Extra columns pass through
unchanged in the stage, clashing names too, and are left out by the query.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import Shield, pick
from .stats import STATISTICS, labelled_sample, statistics

#: At most so many labelled documents are used to learn the list.
MAX_LABELLED = 20_000


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    cut: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        col = x[:, STATISTICS.index(self.statistic)]
        return col > self.cut if self.above else col <= self.cut

    def column(self) -> Column:
        col = F.col(self.statistic)
        return col > F.lit(self.cut) if self.above else col <= F.lit(self.cut)

    def __str__(self) -> str:
        return f"{self.statistic} {'>' if self.above else '<='} {self.cut:.6g}"


Rule = tuple[Condition, ...]


def covers(rule: Rule, x: np.ndarray) -> np.ndarray:
    hit = np.ones(len(x), dtype=bool)
    for condition in rule:
        hit &= condition.holds(x)
    return hit


def _grow(x: np.ndarray, bad: np.ndarray, max_conditions: int, grid: int) -> Rule:
    rule: list[Condition] = []
    live = np.ones(len(x), dtype=bool)
    while len(rule) < max_conditions:
        p0, n0 = int((live & bad).sum()), int((live & ~bad).sum())
        if not p0 or not n0:
            break
        now, best = math.log2(p0 / (p0 + n0)), (1e-9, None)
        for j, name in enumerate(STATISTICS):
            values = x[live, j]
            order = np.argsort(values, kind="stable")
            ranked, hits = values[order], np.cumsum(bad[live][order])
            cuts = np.unique(np.quantile(ranked, np.linspace(0, 1, grid + 1)[:-1], method="lower"))
            at = np.searchsorted(ranked, cuts, side="right")
            low_p = hits[at - 1]
            for above, p, n in ((False, low_p, at - low_p), (True, p0 - low_p, (len(ranked) - at) - (p0 - low_p))):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(p > 0, p * (np.log2(p / np.maximum(p + n, 1)) - now), 0.0)
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (float(gain[k]), Condition(name, above, float(cuts[k])))
        if best[1] is None:
            break
        rule.append(best[1])
        live &= best[1].holds(x)
    return tuple(rule)


def _prune(rule: Rule, x: np.ndarray, bad: np.ndarray) -> tuple[Rule, float, int]:
    """The prefix with the best (p - n) / (p + n) on the pruning rows, shorter first."""
    best = (-2.0, rule, 0.0, 0)
    for k in range(1, len(rule) + 1):
        hit = covers(rule[:k], x)
        p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
        worth = (p - n) / (p + n) if p + n else -1.0
        if worth > best[0]:
            best = (worth, rule[:k], p / (p + n) if p + n else 0.0, p)
    return best[1], best[2], best[3]


def learn_list(
    x: np.ndarray,
    bad: np.ndarray,
    max_rules: int = 12,
    max_conditions: int = 4,
    min_precision: float = 0.95,
    min_support: int = 2,
    grid: int = 64,
    seed: int = 11,
) -> list[Rule]:
    """Ordered rules for ``bad``; empty if nothing precise can be learned."""
    bad = np.asarray(bad, dtype=bool)
    rules: list[Rule] = []
    if not len(x) or bad.all() or not bad.any():
        return rules
    order = np.random.default_rng(seed).permutation(len(x))
    prune_rows = np.zeros(len(x), dtype=bool)
    prune_rows[order[::3]] = True
    live = np.ones(len(x), dtype=bool)
    while len(rules) < max_rules:
        grow, prune = live & ~prune_rows, live & prune_rows
        if not (bad & grow).any():
            break
        rule = _grow(x[grow], bad[grow], max_conditions, grid)
        if not rule:
            break
        rule, precision, support = _prune(rule, x[prune], bad[prune])
        if precision < min_precision or support < min_support:
            break
        rules.append(rule)
        live &= ~covers(rule, x)
    return rules


def rule_expression(rules: list[Rule]) -> Column:
    """1-based number of the first rule that holds, 0 for none."""
    out = None
    for k, rule in enumerate(rules, 1):
        test = rule[0].column()
        for condition in rule[1:]:
            test = test & condition.column()
        out = F.when(test, F.lit(k)) if out is None else out.when(test, F.lit(k))
    return F.lit(0) if out is None else out.otherwise(F.lit(0))


def accepted(judged: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rows of a frame with STATISTICS that no rule rejects.

    Adding a partition id's top bit, which is 0, makes the rule's number
    nondeterministic to the optimizer. It would else move the filter below the
    projections and build the word arrays anew for each condition.
    """
    number = rule_expression(rules) + F.shiftright(F.spark_partition_id(), 31)
    return judged.withColumn("rule_number", number).where("rule_number = 0").drop("rule_number")


def learn_from_tables(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> list[Rule]:
    frame = labelled_sample(docs, labels, "quality", max_labelled)
    return learn_list(frame[list(STATISTICS)].to_numpy(), frame["y"].to_numpy() == 0)


def apply_rules(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """The documents that no rule rejects, all columns unchanged."""
    shield = Shield(docs, "text")
    judged = statistics(shield.df, shield["text"], *[F.col(a) for a in shield.aliases])
    return shield.restore(accepted(judged, rules))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: learn the list from ``labels`` and drop what it rejects."""
    return apply_rules(docs, learn_from_tables(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, statistics) of every document that the learned list keeps."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rules = learn_from_tables(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    judged = statistics(pick(docs, "doc_id", "text"), F.col("text"), F.col("doc_id"))
    return accepted(judged, rules)
