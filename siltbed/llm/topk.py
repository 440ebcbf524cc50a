"""Exact top-k inner products by a three-phase uniform threshold.

The dimensions are split into m lists: a score is the sum of m partial scores, and a list ranks all vectors by one of them.
Phase 1 gathers the heads of the local lists and resolves those; the k-th best score of a query is a safe cutoff T, as k vectors
reach it. Phase 2 sends the cutoffs out: a score of T or more has a partial score of T / m or more in some list, so a list hands
over its entries above that only. Of those, an entry goes on if the norms of its other dimensions let it still reach T. Phase 3
resolves the remaining partial scores of what is left, pair by pair, and keeps the best.

Vectors are worked on in blocks of rows and queries in blocks of queries, so a task holds one block of each and the partial scores
of one list at a time. A list whose norms in a block keep all of it below T / m is not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.llm.common import map_batches, written

#: Vectors and queries in a block.
BLOCK, QUERY_BLOCK = 4096, 1024
_BLOCKS = "part long, seq long, width int, ids array<long>, matrix binary"


def _blocks(vectors: DataFrame, size: int, scale: int) -> DataFrame:
    """Rows of up to ``size`` vectors of one width: ids, and the components as a matrix of whole numbers in doubles.

    Vectors that are null, or hold null or non-finite components, or have no id, are left out here.
    """

    def run(batches):
        part, seq, held = TaskContext.get().partitionId(), 0, {}

        def block(width: int, rows: list) -> pa.RecordBatch:
            nonlocal seq
            seq += 1
            ids, data = zip(*rows, strict=True)
            values = [[part], [seq], [width], [list(ids)], [np.array(data, "<f8").tobytes()]]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names=["part", "seq", "width", "ids", "matrix"])

        for batch in batches:
            for vec_id, x in zip(batch.column("vec_id").to_pylist(), batch.column("x").to_pylist(), strict=True):
                if vec_id is None or x is None or None in x:
                    continue
                x = np.floor(scale * np.array(x, float))
                if not np.isfinite(x).all():
                    continue
                rows = held.setdefault(len(x), [])
                rows.append((vec_id, x))
                if len(rows) == size:
                    yield block(len(x), held.pop(len(x)))
        for width, rows in held.items():
            yield block(width, rows)

    return vectors.mapInArrow(run, _BLOCKS)


#: Numbers of a gathered part that are resolved at a time.
_RESOLVED = 1 << 21
#: Below every score of finite doubles.
_LEAST = -(1 << 2200)


def _bound(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)


def _whole(a: np.ndarray) -> np.ndarray:
    return np.array([[int(x) for x in r] for r in a], object).reshape(a.shape)


class Lists:
    """A block of queries against a block of vectors, their dimensions cut into lists.

    Scores are whole numbers: in doubles where every partial sum is exact, else in Python's integers.
    """

    def __init__(self, q: np.ndarray, v: np.ndarray, q_ids: np.ndarray, ids: np.ndarray, lists: int):
        self.exact = _bound(q, v) < 2**53
        self.q, self.v = (q, v) if self.exact else (_whole(q), _whole(v))
        self.q_ids, self.ids, self.resolved = q_ids, ids, 0
        at = np.linspace(0, q.shape[1], lists + 1).astype(int)
        self.cuts = [slice(a, b) for a, b in zip(at[:-1], at[1:], strict=True)]

    def partial(self, cut: slice) -> np.ndarray:
        return self.q[:, cut] @ self.v[:, cut].T

    def resolve(self, i: np.ndarray, j: np.ndarray) -> list[np.ndarray]:
        """The partial scores of some pairs in every list."""
        self.resolved += len(i)
        step = max(1, _RESOLVED // max(1, self.q.shape[1]))
        out = [[] for _ in self.cuts]
        for start in range(0, len(i), step):
            a, b = self.q[i[start : start + step]], self.v[j[start : start + step]]
            for parts, cut in zip(out, self.cuts, strict=True):
                parts.append((a[:, cut] * b[:, cut]).sum(axis=1))
        return [np.concatenate(parts) if parts else np.empty(0, self.q.dtype) for parts in out]

    def heads(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phase 1: each query's best k of each list, once, with their whole scores."""
        pairs = []
        for cut in self.cuts:
            scores = self.partial(cut)
            for i, query in enumerate(self.q_ids):
                best = _best(scores[i], self.ids, k, self.ids != query)
                pairs.append(i * len(self.ids) + best)
        i, j = np.divmod(np.unique(np.concatenate(pairs)), len(self.ids)) if pairs else (np.empty(0, int), np.empty(0, int))
        return i, j, sum(self.resolve(i, j))

    def _may_reach(self, i: np.ndarray, j: np.ndarray, partial: np.ndarray, floors: np.ndarray, norms: tuple) -> np.ndarray:
        """Whether the other dimensions, by their norms, can bring a partial score up to the cutoff; rounding speaks for the pair."""
        return partial + norms[0][i] * norms[1][j] * (1 + 1e-9) + 1 >= floors[i]

    def above(self, k: int, cutoffs: list[int | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phases 2 and 3: each query's best k of the pairs that reach its cutoff."""
        m, found = len(self.cuts), []
        if self.exact:
            floors = np.array([-np.inf if c is None else _not_above(c) for c in cutoffs])
            squares = [((self.q[:, c] ** 2).sum(axis=1), (self.v[:, c] ** 2).sum(axis=1)) for c in self.cuts]
            everything = [sum(s[side] for s in squares) for side in (0, 1)]
        else:
            floors = np.array([_LEAST if c is None else c for c in cutoffs], object)
        for n, cut in enumerate(self.cuts):
            asked = np.arange(len(self.q_ids))
            if self.exact:
                reach = np.sqrt(squares[n][0]) * np.sqrt(squares[n][1].max(initial=0)) * (1 + 1e-9) + 1
                asked = np.flatnonzero(reach * m >= floors)
                if not len(asked):
                    continue
            scores = self.q[asked, cut] @ self.v[:, cut].T
            i, j = np.nonzero((scores * m >= floors[asked, None]) & (self.q_ids[asked, None] != self.ids))
            partial, i = scores[i, j], asked[i]
            del scores
            if self.exact:
                rest = tuple(np.sqrt(np.maximum(e - s, 0)) for e, s in zip(everything, squares[n], strict=True))
                may = self._may_reach(i, j, partial, floors, rest)
                i, j = i[may], j[may]
            parts = self.resolve(i, j)
            total = sum(parts)
            new = total >= floors[i]
            for earlier in parts[:n]:  # an entry that several lists hand over counts once
                new &= earlier * m < floors[i]
            found.append((i[new], j[new], total[new]))
        i, j, total = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.empty(0, int), np.empty(0, int), np.empty(0))
        order = np.lexsort([self.ids[j], -total, i])
        i, j, total = i[order], j[order], total[order]
        first = np.searchsorted(i, i)  # place of the query's best
        best = np.arange(len(i)) - first < k
        return i[best], j[best], total[best]


def _not_above(n: int) -> float:
    """``n`` as a double, rounded down."""
    x = float(n)
    return x if int(x) <= n else float(np.nextafter(x, -np.inf))


def _best(scores: np.ndarray, ids: np.ndarray, k: int, allowed: np.ndarray) -> np.ndarray:
    """Places of the k best allowed scores, ties to smaller ids."""
    at = np.flatnonzero(allowed)
    if len(at) > 4 * k and scores.dtype != object:
        least = np.partition(scores[at], len(at) - k)[len(at) - k]
        at = at[scores[at] >= least]
    return at[np.lexsort([ids[at], -scores[at]])][:k]


def top_k(
    spark: SparkSession,
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    lists: int = 2,
    scale: int = 1024,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: for each query its ``k`` best vectors other than itself, all if fewer.

    Components x count as floor(``scale`` * x). Only vectors of a query's width compete; ties go to the smaller id. Vectors that
    are null or hold null or non-finite components take no part, nor do rows without an id. Rows that share an id with the query are
    the query's own; repeated rows of another id compete once each. A query id given twice is asked once, for one of its rows.
    """

    def clean(df: DataFrame) -> DataFrame:
        return df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"))

    asked = clean(queries).groupBy("vec_id").agg(F.min("x").alias("x")) if queries is not None else clean(vectors)
    blocks = written(spark, _blocks(clean(vectors), BLOCK, scale), "blocks")
    # queries are few against all vectors: few, full blocks
    asked = _blocks(asked.coalesce(max(1, spark.sparkContext.defaultParallelism // 2)), QUERY_BLOCK, scale)
    asked = written(spark, asked.select("width", F.struct("part", "seq").alias("block"), F.col("ids").alias("q_ids"), F.col("matrix").alias("q")), "asked")

    # every block of queries meets every block of vectors of its width; salts deal them out evenly
    salts = max(1, spark.sparkContext.defaultParallelism * 4)
    dealt = blocks.withColumn("salt", F.pmod(F.xxhash64("part", "seq"), F.lit(salts)))

    def meet(asked: DataFrame) -> DataFrame:
        return dealt.join(asked.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))), ["width", "salt"])

    def entries(phase):
        def work(batch):
            out = []
            for row in batch.to_pylist():
                ids, q_ids = np.array(row["ids"], np.int64), np.array(row["q_ids"], np.int64)
                v, q = (np.frombuffer(row[c], "<f8").reshape(len(n), row["width"]) for c, n in (("matrix", ids), ("q", q_ids)))
                i, j, scores = phase(Lists(q, v, q_ids, ids, lists), row.get("floors"))
                out.append((q_ids[i], ids[j], scores.astype(np.int64)))
            columns = [np.concatenate(x) for x in zip(*out, strict=True)] or [np.empty(0, np.int64)] * 3
            return {n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), columns, strict=True)}

        return work

    schema = "query_id long, vec_id long, score long"
    ranked = "row_number() over (partition by query_id order by score desc, vec_id)"
    gathered = map_batches(meet(asked).select("ids", "matrix", "q_ids", "q", "width"), entries(lambda both, _: both.heads(k)), schema, None)
    floors = gathered.selectExpr("query_id", "score", f"{ranked} as place").where(F.col("place") == k).select("query_id", "score")

    # cutoffs go back into the blocks of queries, in their order
    placed = asked.select("width", "block", F.posexplode("q_ids").alias("i", "query_id")).join(floors, "query_id", "left")
    placed = placed.groupBy("width", "block").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "score"))), lambda s: s["score"]).alias("floors"))
    asked = asked.join(placed, ["width", "block"])
    collected = map_batches(meet(asked).select("ids", "matrix", "q_ids", "q", "width", "floors"), entries(lambda both, cutoffs: both.above(k, cutoffs)), schema, None)
    return collected.selectExpr("query_id", f"{ranked} as rank", "vec_id", "score").where(F.col("rank") <= k)
