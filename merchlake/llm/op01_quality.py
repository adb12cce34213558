"""Quality classifier: a sparse rule ensemble over text statistics.

Shallow trees are boosted on a bounded sample of labelled rows; every path from a root to a node is a
rule, a conjunction of bounds on statistics. A logistic regression with an L1 penalty picks few rules
and weighs them. Statistics and rules are Spark column expressions, so scoring runs in the engine.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlake.llm.common import Scratch, has_remainder, table

#: About so many labelled rows are sent to the driver at most, picked by hash.
SAMPLE = 40_000
TREES = 40
DEPTH = 3
STEP = 0.3
#: Least rows on each side of a split, as a share of the sample.
LEAST = 0.002
BINS = 32
PENALTY = 1e-3
ROUNDS = 400
THRESHOLD = 0.3

_WORD = "[^\\x20\\x09-\\x0D]+"


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and one column per statistic, for docs (doc_id, text)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    parts = docs.select(
        "doc_id",
        F.length(text).alias("chars"),
        F.regexp_extract_all(text, F.lit(f"({_WORD})"), 1).alias("words"),
        F.filter(F.split(text, "\n", -1), lambda x: F.length(F.trim(x)) > 0).alias("lines"),
        *(
            F.regexp_count(text, F.lit(pattern)).alias(name)
            for name, pattern in (
                ("uppers", "\\p{Lu}"),
                ("digits", "[0-9]"),
                ("symbols", "[#*$%&|<>{}\\[\\]@~^=_+]"),
                ("stops", "[.,;:]"),
                ("calls", "[!?]"),
            )
        ),
    )
    counted = parts.select(
        "doc_id", "chars", "uppers", "digits", "symbols", "stops", "calls",
        F.size("words").alias("n_words"),
        F.size(F.array_distinct("words")).alias("n_distinct"),
        F.size("lines").alias("n_lines"),
        F.size(F.array_distinct("lines")).alias("n_distinct_lines"),
        F.coalesce(F.aggregate("words", F.lit(0), lambda n, w: n + F.length(w)), F.lit(0)).alias("word_chars"),
        F.coalesce(F.array_max(F.transform("words", F.length)), F.lit(0)).alias("longest_word"),
    )

    def share(a: str, b: str) -> Column:
        return F.col(a) / F.greatest(F.col(b), F.lit(1))

    columns = {
        "log_words": F.log1p(F.col("n_words").cast("double")),
        "mean_word": share("word_chars", "n_words"),
        "longest_word": F.col("longest_word").cast("double"),
        "upper_share": share("uppers", "word_chars"),
        "digit_share": share("digits", "word_chars"),
        "symbol_share": share("symbols", "n_words"),
        "stop_share": share("stops", "n_words"),
        "call_share": share("calls", "n_words"),
        "distinct_share": share("n_distinct", "n_words"),
        "variety": F.col("n_distinct") / F.greatest(F.sqrt("n_words"), F.lit(1.0)),
        "line_share": share("n_distinct_lines", "n_lines"),
        "line_words": share("n_words", "n_lines"),
    }
    return counted.select("doc_id", *(column.cast("double").alias(name) for name, column in columns.items()))


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    bound: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        x = values[self.statistic]
        return x > self.bound if self.above else x <= self.bound

    def column(self) -> Column:
        c = F.col(self.statistic)
        return c > self.bound if self.above else c <= self.bound


Rule = frozenset[Condition]


@dataclass
class RuleModel:
    """Weighted rules; the score is the logistic function of the sum of the weights of rules that hold."""

    base: float
    rules: list[tuple[Rule, float]]

    def score(self) -> Column:
        total = F.lit(self.base)
        for rule, weight in self.rules:
            total = total + F.when(_all(c.column() for c in sorted(rule, key=repr)), weight).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-total))


def _all(conditions) -> Column:
    result = None
    for c in conditions:
        result = c if result is None else result & c
    return result


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


class _Boosting:
    """Boosted shallow trees on binned statistics, kept for their paths only."""

    def __init__(self, values: dict[str, np.ndarray], labels: np.ndarray):
        self.names, self.values, self.labels = sorted(values), values, labels
        self.edges, self.bins = {}, {}
        for name in self.names:
            edges = np.unique(np.quantile(values[name], np.linspace(0, 1, BINS + 1)[1:-1]))
            self.edges[name] = edges
            self.bins[name] = np.searchsorted(edges, values[name], side="left")
        self.least = max(5, int(LEAST * len(labels)))
        self.rules: dict[Rule, None] = {}

    def run(self) -> list[Rule]:
        share = np.clip(self.labels.mean(), 1e-6, 1 - 1e-6)
        margin = np.full(len(self.labels), np.log(share / (1 - share)))
        for _ in range(TREES):
            p = _logistic(margin)
            self._grow(np.arange(len(margin)), frozenset(), self.labels - p, p * (1 - p), margin, DEPTH)
        return list(self.rules)

    def _grow(self, rows, path: Rule, residual, weight, margin, depth: int) -> None:
        best = self._split(rows, residual, weight) if depth else None
        if best is None:
            margin[rows] += STEP * residual[rows].sum() / (weight[rows].sum() + 1.0)
            return
        name, k = best
        below = self.bins[name][rows] <= k
        for above, part in ((False, rows[below]), (True, rows[~below])):
            longer = path | {Condition(name, above, float(self.edges[name][k]))}
            self.rules[longer] = None
            self._grow(part, longer, residual, weight, margin, depth - 1)

    def _split(self, rows, residual, weight) -> tuple[str, int] | None:
        best, choice = 1e-3, None
        r, w = residual[rows], weight[rows]
        whole = r.sum() ** 2 / (w.sum() + 1.0)
        for name in self.names:
            n = len(self.edges[name])
            if not n:
                continue
            b = self.bins[name][rows]
            sums, weights, counts = (np.cumsum(np.bincount(b, x, n + 1))[:-1] for x in (r, w, None))
            right, right_weight = r.sum() - sums, w.sum() - weights
            gain = sums**2 / (weights + 1.0) + right**2 / (right_weight + 1.0) - whole
            gain[(counts < self.least) | (len(rows) - counts < self.least)] = -np.inf
            k = int(gain.argmax())
            if gain[k] > best:
                best, choice = gain[k], (name, k)
        return choice


def fit(values: dict[str, np.ndarray], labels: np.ndarray) -> RuleModel:
    """Rules from boosted trees, weighed by L1-penalised logistic regression (accelerated proximal
    gradient). Labels of one kind only give a constant score."""
    share = (labels.sum() + 0.5) / (len(labels) + 1.0)
    base = float(np.log(share / (1 - share)))
    if len(np.unique(labels)) < 2:
        return RuleModel(base, [])
    rules = _Boosting(values, labels).run()
    if not rules:
        return RuleModel(base, [])
    held = np.column_stack([np.logical_and.reduce([c.holds(values) for c in rule]) for rule in rules]).astype(np.float64)
    support = held.mean(axis=0)
    scale = np.sqrt(np.maximum(support * (1 - support), 1e-4))
    x = (held - support) / scale
    weights, intercept = np.zeros(x.shape[1]), base
    ahead, ahead_intercept, momentum = weights.copy(), intercept, 1.0
    # The largest curvature by a few power steps bounds the step length.
    v = np.ones(x.shape[1])
    for _ in range(20):
        v = x.T @ (x @ v)
        v /= np.linalg.norm(v) + 1e-12
    rate = 1.0 / (0.25 * (np.linalg.norm(x @ v) ** 2 / len(x) + 1.0))
    for _ in range(ROUNDS):
        error = _logistic(x @ ahead + ahead_intercept) - labels
        moved = ahead - rate * (x.T @ error) / len(x)
        fresh = np.sign(moved) * np.maximum(np.abs(moved) - rate * PENALTY, 0.0)
        fresh_intercept = ahead_intercept - rate * error.mean()
        grown = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = fresh + (momentum - 1) / grown * (fresh - weights)
        ahead_intercept = fresh_intercept + (momentum - 1) / grown * (fresh_intercept - intercept)
        weights, intercept, momentum = fresh, fresh_intercept, grown
    kept = np.flatnonzero(weights)
    raw = weights[kept] / scale[kept]
    return RuleModel(float(intercept - raw @ support[kept]), [(rules[k], float(w)) for k, w in zip(kept, raw, strict=True)])


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    sample: int = SAMPLE,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs``.

    The model learns from the labels of documents whose crc32(id as text) leaves a remainder other
    than 0 on division by 5; held_out marks the others. predicted is 1 from ``threshold`` on.

    Edge cases: a null text counts as empty; empty texts have a score like all others. Rows without
    id are scored, not held out, and not learned from. Rows that repeat an id are scored one by one.
    Null labels are left out. Without labels the score is 0.5 throughout; with labels of one kind, or
    too few for a rule, it is their smoothed share. Other columns are ignored, whatever their names. An empty table gives
    an empty result.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    measured = scratch.keep(statistics(rows), "statistics")
    marked = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_column).cast("double").alias("label"))
        .filter("doc_id IS NOT NULL AND label IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .filter(~has_remainder("doc_id", 5, 0))
    )
    marked = scratch.keep(marked, "labels")
    share = sample / max(1, marked.count())
    picked = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit(int(min(1.0, share) * (1 << 30)))
    learned = measured.join(marked.filter(picked), "doc_id").orderBy("doc_id").toPandas()
    values = {c: learned[c].to_numpy() for c in learned.columns if c not in ("doc_id", "label")}
    model = fit(values, (learned["label"].to_numpy() > 0).astype(np.float64))
    scored = measured.select("doc_id", has_remainder("doc_id", 5, 0).alias("held_out"), model.score().alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op1_quality": op1_quality}
SQL: dict[str, str] = {}
