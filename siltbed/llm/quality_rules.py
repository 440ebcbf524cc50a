"""Quality rules: fixed base rules, and an isolation forest over the rules' statistics.

Each tree splits a small sample at random values of random statistics; documents that few splits set apart are
anomalous. Every tree draws its rows from all labelled ones, the threshold is that of all held-out ones, and every document is judged on its whole text.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltbed.llm.common import WorkTables, all_labelled, map_batches, nth_smallest, raw, slices
from siltbed.llm.statistics import COUNTS, LEAST_WORDS, MOST_REPEATED_PERCENT, SHARES, of_text, text_statistics


#: The rules' statistics that the forest splits on. Sizes are left out: a long or short text is no anomaly.
RULES = ["word_length", "symbol_share", "repeat_share", "upper_share"]


def mean_path(n: float) -> float:
    """Expected path length of an unsuccessful search in a tree over ``n`` rows."""
    return 0.0 if n < 2 else 1.0 if n < 3 else 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


class IsolationForest:
    """Trees as flat arrays: statistic, split value, children; a leaf holds its path length. Each tree is grown from rows of its own."""

    def __init__(self, rows: list[np.ndarray], seed: int):
        draw = np.random.default_rng(seed)
        self.per_tree = max(map(len, rows))
        self.depth = max(1, math.ceil(math.log2(max(2, self.per_tree))))
        self.trees = [self._grow(own, draw) for own in rows]

    def _grow(self, rows: np.ndarray, draw: np.random.Generator) -> tuple[np.ndarray, ...]:
        nodes: list[list[float]] = []

        def grow(own: np.ndarray, depth: int) -> int:
            at = len(nodes)
            nodes.append([-1, 0.0, at, at, depth + mean_path(len(own))])
            low, high = own.min(0), own.max(0)
            usable = np.flatnonzero(high > low)
            if depth < self.depth and len(own) > 1 and len(usable):
                f = int(draw.choice(usable))
                value = draw.uniform(low[f], high[f])
                left = own[:, f] < value
                nodes[at][:4] = f, value, grow(own[left], depth + 1), grow(own[~left], depth + 1)
            return at

        grow(rows, 0)
        f, value, left, right, length = zip(*nodes, strict=True)
        return np.array(f, int), np.array(value), np.array(left, int), np.array(right, int), np.array(length)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Between 0 and 1, higher for rows that are set apart sooner."""
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for f, value, left, right, length in self.trees:
            at = np.zeros(len(rows), int)
            for _ in range(self.depth):
                at = np.where(rows[every, f[at]] < value[at], left[at], right[at])
            total += length[at]
        return np.exp2(-total / len(self.trees) / max(mean_path(self.per_tree), 1e-9))


#: What is needed of a labelled row.
_SEEN = ["doc_id", "n_words", "n_repeat_words", *RULES]


def _drawn(rows: DataFrame, count: int, trees: int, per_tree: int, seed: int) -> list[np.ndarray]:
    """For each tree, ``per_tree`` of all ``count`` rows, those of the smallest hash of id and tree: a draw without replacement.

    Only rows below a bound that leaves several times as many as are needed go through the window.
    """
    spread = 1 << 40
    bound = min(spread, spread * (4 * per_tree + 400) // count)
    draw = lambda tree: F.pmod(F.xxhash64(F.col("doc_id"), tree, F.lit(seed)), F.lit(spread))
    tree = F.explode(F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: draw(t) < bound)).alias("tree")
    near = rows.select("doc_id", "quality", *RULES, tree)
    order = Window.partitionBy("tree").orderBy(draw(F.col("tree")), "doc_id", "quality")
    chosen = near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= per_tree).toPandas()
    return [own[RULES].to_numpy(float) for _, own in chosen.sort_values(["tree", "place"]).groupby("tree")]


def _scores(forest: IsolationForest, batch: pa.RecordBatch) -> np.ndarray:
    return forest.score(np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in RULES]))


def fit_forest(
    work: WorkTables, measured: DataFrame, labels: DataFrame, trees: int = 100, per_tree: int = 256, keep_share: float = 0.99, seed: int = 7
) -> tuple[IsolationForest, float] | None:
    """Forest and threshold from all labelled rows of ``measured``; None where a half of them lacks what it is for.

    A hash of the id halves the labelled rows that pass the base rules. Trees are grown from the one half, good or not, each from a draw of
    ``per_tree`` rows. The threshold is the score that ``keep_share`` of all good ones of the other half stay at or below. What reaches the
    driver is the draws and counts.
    """
    marks = labels.select("doc_id", "quality").where(F.col("quality").isNotNull())
    passed = (F.col("n_words") >= LEAST_WORDS) & (100 * F.col("n_repeat_words") <= MOST_REPEATED_PERCENT * F.col("n_words"))
    seen = all_labelled(measured.select(*_SEEN), marks, "doc_id").where(passed)
    seen = work.write(seen.select("doc_id", "quality", *RULES, F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(2)).alias("half")), "labelled")
    grows, judges = F.col("half") == 0, (F.col("half") == 1) & (F.col("quality") == 1)
    n_grow, n_judge = seen.agg(F.count_if(grows), F.count_if(judges)).first()
    if not n_grow or not n_judge:
        work.drop(seen)
        return None
    forest = IsolationForest(_drawn(seen.where(grows), n_grow, trees, per_tree, seed), seed)
    scores = map_batches(seen.where(judges).select(*RULES), lambda batch: {"score": _scores(forest, batch)}, "score double", None)
    scores = work.write(scores, "scores")
    threshold = nth_smallest(scores, "score", math.ceil(keep_share * (n_judge - 1)))
    work.drop(scores, seen)
    return forest, threshold


def quality_rules(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    keep_share: float = 0.99,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per document: the base statistics, ``base_failed``, the forest's ``anomaly`` score and ``kept``.

    The forest and its threshold are those of all labelled rows. Null or empty texts have no
    word and fail the base rules. Repeated rows are judged each; rows without an id are judged but never labelled.
    Without labels the base rules decide alone and ``anomaly`` is null.
    """
    with WorkTables(spark) as work:
        measured = work.write(text_statistics(docs, id_col, text_col), "statistics")
        fitted = fit_forest(work, measured, labels, keep_share=keep_share)
        work.keep(measured)
    base_failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    if fitted is None:
        scored = measured.withColumn("anomaly", F.lit(None).cast("double"))
        threshold = 1.0
    else:
        forest, threshold = fitted

        def judge(batch):
            return {c: batch.column(c) for c in ["doc_id", *COUNTS]} | {"anomaly": _scores(forest, batch)}

        scored = map_batches(measured, judge, ", ".join(["doc_id long", *(f"{c} long" for c in COUNTS), "anomaly double"]), None)
    return scored.select(
        "doc_id",
        *COUNTS,
        "anomaly",
        base_failed.alias("base_failed"),
        (~base_failed & (F.coalesce("anomaly", F.lit(0.0)) <= threshold)).alias("kept"),
    )


def drop_anomalous(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    keep_share: float = 0.99,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that ``quality_rules`` keeps, with all their columns and without moving any.

    Texts are measured once for the fit, where a label may belong to any of them, and once beside the rows.
    """
    with WorkTables(spark) as work:
        measured = work.write(text_statistics(docs, id_col, text_col).select(*_SEEN), "statistics")
        fitted = fit_forest(work, measured, labels, keep_share=keep_share)

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_col):
                found = [of_text(x or b"") for x in raw(part, text_col)]
                counts = np.array([f[0] for f in found], "int64").reshape(-1, len(COUNTS))
                words, repeated = counts[:, COUNTS.index("n_words")], counts[:, COUNTS.index("n_repeat_words")]
                kept = (words >= LEAST_WORDS) & (100 * repeated <= MOST_REPEATED_PERCENT * words)
                if fitted is not None:
                    shares = np.array([f[1] for f in found], float).reshape(-1, len(SHARES))
                    kept &= fitted[0].score(shares[:, [SHARES.index(c) for c in RULES]]) <= fitted[1]
                yield part.filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)
