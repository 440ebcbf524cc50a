"""Quality classifier: a sparse ensemble of rules over text statistics.

Small boosted trees propose rules: each path from a root is a conjunction of comparisons. A lasso logistic fit gives most of
them no weight. The remaining ones are compiled into one Spark column expression, so that scoring is a projection.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.llm.common import labelled, written
from siltbed.llm.statistics import SHARES, text_statistics

#: A comparison: index of the statistic, split value, whether the row lies at or above it.
Rule = tuple[tuple[int, float, bool], ...]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _best_split(rows: np.ndarray, gradient: np.ndarray, cuts: list[np.ndarray], least: int) -> tuple[float, int, float] | None:
    best = None
    whole = gradient.sum() ** 2 / len(gradient)
    for f, values in enumerate(cuts):
        if not len(values):
            continue
        place = np.searchsorted(values, rows[:, f], side="right")  # rows at or above values[i] have a place over i
        n = np.bincount(place, minlength=len(values) + 1)[::-1].cumsum()[::-1][1:]
        g = np.bincount(place, gradient, minlength=len(values) + 1)[::-1].cumsum()[::-1][1:]
        m = len(gradient) - n
        ok = (n >= least) & (m >= least)
        if ok.any():
            gain = np.where(ok, g**2 / np.maximum(n, 1) + (gradient.sum() - g) ** 2 / np.maximum(m, 1) - whole, -1)
            i = int(gain.argmax())
            if best is None or gain[i] > best[0]:
                best = float(gain[i]), f, float(values[i])
    return best if best and best[0] > 1e-9 else None


def propose(rows: np.ndarray, marks: np.ndarray, trees: int, depth: int, seed: int) -> list[Rule]:
    """Rules from trees fitted one after another to what the trees before them got wrong, each on half of the rows."""
    draw, margin, rules = np.random.default_rng(seed), np.zeros(len(rows)), {}
    cuts = [np.unique(np.quantile(rows[:, f], np.linspace(0.02, 0.98, 49))) for f in range(rows.shape[1])]
    least = max(3, len(rows) // 400)
    for _ in range(trees):
        chosen = draw.random(len(rows)) < 0.5
        gradient = marks - _sigmoid(margin)

        def grow(own: np.ndarray, path: Rule, residual: np.ndarray, half: np.ndarray) -> None:
            if path:
                rules.setdefault(path)
            fit = own & half
            split = _best_split(rows[fit], residual[fit], cuts, least) if len(path) < depth and fit.sum() > 2 * least else None
            if split is None:
                if fit.any():
                    weight = residual[fit].mean() / max(0.05, np.abs(residual[fit]).mean() * (1 - np.abs(residual[fit]).mean()))
                    margin[own] += 0.2 * np.clip(weight, -4, 4)
                return
            _, f, value = split
            above = rows[:, f] >= value
            grow(own & above, (*path, (f, value, True)), residual, half)
            grow(own & ~above, (*path, (f, value, False)), residual, half)

        grow(np.ones(len(rows), bool), (), gradient, chosen)
    return list(rules)


def holds(rules: list[Rule], rows: np.ndarray) -> np.ndarray:
    out = np.ones((len(rows), len(rules)))
    for i, rule in enumerate(rules):
        for f, value, above in rule:
            out[:, i] *= (rows[:, f] >= value) == above
    return out


def lasso(x: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[np.ndarray, float]:
    """Logistic weights with an absolute-value penalty, by accelerated proximal gradient; the intercept is free."""
    n, width = x.shape
    step = 4 * n / max(np.linalg.norm(x, 2) ** 2 + n, 1e-9)
    weights, bias = np.zeros(width), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    ahead, ahead_bias, pace = weights, bias, 1.0
    for _ in range(steps):
        wrong = _sigmoid(x @ ahead + ahead_bias) - y
        moved = ahead - step * (x.T @ wrong) / n
        after = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0)
        after_bias = ahead_bias - step * wrong.mean()
        next_pace = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead = after + (pace - 1) / next_pace * (after - weights)
        ahead_bias = after_bias + (pace - 1) / next_pace * (after_bias - bias)
        weights, bias, pace = after, after_bias, next_pace
    return weights, bias


def _loss(p: np.ndarray, y: np.ndarray) -> float:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())


class RuleEnsemble:
    """Rules with weights, as a score of rows and as a Spark column."""

    def __init__(self, rules: list[Rule], weights: np.ndarray, bias: float, names: list[str]):
        used = np.flatnonzero(np.abs(weights) > 1e-8)
        self.rules, self.weights, self.bias, self.names = [rules[i] for i in used], weights[used], float(bias), names

    def score(self, rows: np.ndarray) -> np.ndarray:
        return _sigmoid(holds(self.rules, rows) @ self.weights + self.bias)

    def column(self) -> Column:
        def one(rule: Rule, weight: float) -> Column:
            tests = [F.col(self.names[f]) >= value if above else F.col(self.names[f]) < value for f, value, above in rule]
            return F.when(reduce(lambda a, b: a & b, tests), float(weight)).otherwise(0.0)

        total = reduce(lambda a, b: a + b, map(one, self.rules, self.weights), F.lit(self.bias))
        return 1 / (1 + F.exp(-total))


def fit_rules(
    rows: np.ndarray,
    marks: np.ndarray,
    names: list[str],
    trees: int = 40,
    depth: int = 3,
    penalties: tuple[float, ...] = (0.01, 0.003, 0.001),
    seed: int = 11,
) -> RuleEnsemble:
    """The penalty is the one with the least loss on every fourth row, which the fit for that comparison does not see."""
    if len(rows) < 8 or marks.min() == marks.max():
        share = float(np.clip((marks.sum() + 1) / (len(marks) + 2), 1e-3, 1 - 1e-3))
        return RuleEnsemble([], np.zeros(0), float(np.log(share / (1 - share))), names)
    rules = propose(rows, marks, trees, depth, seed)
    x = holds(rules, rows)
    _, first = np.unique(x, axis=1, return_index=True)
    rules, x = [rules[i] for i in sorted(first)], x[:, sorted(first)]
    aside = np.arange(len(rows)) % 4 == 3
    losses = []
    for penalty in penalties:
        weights, bias = lasso(x[~aside], marks[~aside], penalty)
        losses.append(_loss(_sigmoid(x[aside] @ weights + bias), marks[aside]))
    return RuleEnsemble(rules, *lasso(x, marks, penalties[int(np.argmin(losses))]), names)


def quality_scores(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    sample: int = 12_000,
    cutoff: float = 0.3,
    folds: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per document: ``held_out``, the ``score`` for label 1, and ``predicted``.

    Labels are learnt from rows whose crc32(id as text) modulo ``folds`` is not 0, at most ``sample`` of them. Null and empty
    texts are scored by their statistics (all 0). Without labels the score is one half. A row without an id counts as not held out.
    """
    measured = written(spark, text_statistics(docs, id_col, text_col).select("doc_id", *SHARES), "statistics")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == 0, F.lit(False))
    marks = labels.select("doc_id", "quality").where(F.col("quality").isNotNull() & ~held_out)
    seen = labelled(measured, marks, "doc_id", sample).toPandas().sort_values(["doc_id", *SHARES])
    model = fit_rules(seen[SHARES].to_numpy(float), seen.quality.to_numpy(float), SHARES)
    return measured.select("doc_id", held_out.alias("held_out"), model.column().alias("score")).withColumn(
        "predicted", (F.col("score") >= cutoff).cast("int")
    )
