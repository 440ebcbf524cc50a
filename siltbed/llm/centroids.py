"""Clustering of vectors around centroids, with a vantage-point tree for the nearest one.

Each round builds a tree over the centroids and sends it to all tasks. A node has one centroid as its vantage point and two halves:
those nearer to it and those farther, each with the least and greatest distance to the vantage point. By the triangle inequality a vector
at distance d from the vantage point is no nearer to a half than d is outside of that range. Every vector takes the open node with
the smallest such bound first and stops when the smallest bound exceeds its best distance. A bound equal to it is still followed, so ties
are seen. Bounds are rounded down by more than doubles can be off; the distances that decide are whole numbers.

The vectors of a batch search side by side, each with open nodes and a best centroid of its own.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.llm.common import WorkTables, map_batches, written
from siltbed.llm.vectors import matrices, vector_table

#: Centroids in a leaf of the tree, and vectors that search at a time.
LEAF, CHUNK = 4, 2048


@dataclass
class Tree:
    """Nodes by number, 0 the root. A leaf has ``members`` only."""

    points: np.ndarray
    members: list[list[int]] = field(default_factory=list)
    vantage: list[int] = field(default_factory=list)
    halves: list[list[tuple[int, float, float]]] = field(default_factory=list)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances between rows of whole numbers that broadcast against each other."""
    d = a - b
    return (d * d).sum(axis=-1)


def build_tree(points: np.ndarray) -> Tree:
    """A tree over centroids of whole numbers. The vantage point of a node is the centroid farthest from the first."""
    tree = Tree(points)

    def add(members: list[int]) -> int:
        number = len(tree.members)
        tree.members.append(members if len(members) <= LEAF else [])
        tree.vantage.append(-1)
        tree.halves.append([])
        if len(members) > LEAF:
            at = members[int(squared(points[members], points[members[0]]).argmax())]
            others = [m for m in members if m != at]
            away = np.sqrt(squared(points[others], points[at]).astype(float))
            order = np.argsort(away, kind="stable")
            tree.vantage[number] = at
            for half in np.array_split(order, 2):
                low, high = float(away[half[0]]), float(away[half[-1]])
                tree.halves[number].append((add([others[i] for i in half]), low, high))
        return number

    add(list(range(len(points))))
    return tree


def nearest(tree: Tree, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centroid, exact squared distance to it, nodes visited); ties go to the smaller number."""
    cluster = np.full(len(vectors), len(tree.points), np.int64)
    best = np.full(len(vectors), np.iinfo(np.int64).max)
    visits = 0

    def offer(rows: np.ndarray, number: int, distance: np.ndarray) -> None:
        better = (distance < best[rows]) | ((distance == best[rows]) & (number < cluster[rows]))
        best[rows[better]], cluster[rows[better]] = distance[better], number

    # open nodes of all vectors, as (vector, node, bound)
    who, node, bound = np.arange(len(vectors)), np.zeros(len(vectors), np.int64), np.zeros(len(vectors))
    while len(who):
        open_ = bound <= np.sqrt(best[who].astype(float))
        who, node, bound = who[open_], node[open_], bound[open_]
        order = np.lexsort([node, bound, who])
        who, node, bound = who[order], node[order], bound[order]
        first = np.ones(len(who), bool)
        first[1:] = who[1:] != who[:-1]
        found = [(who[~first], node[~first], bound[~first])]
        for number in np.unique(node[first]).tolist():
            rows = who[first & (node == number)]
            visits += len(rows)
            for member in tree.members[number]:
                offer(rows, member, squared(vectors[rows], tree.points[member]))
            if (at := tree.vantage[number]) >= 0:
                distance = squared(vectors[rows], tree.points[at])
                offer(rows, at, distance)
                away = np.sqrt(distance.astype(float))
                for child, low, high in tree.halves[number]:
                    least = np.maximum(np.maximum(low - away, away - high), 0.0)
                    least = np.maximum(least - 1e-12 * (away + high), 0.0)  # doubles are off by far less
                    found.append((rows, np.full(len(rows), child), least))
        who, node, bound = (np.concatenate(f) for f in zip(*found, strict=True))
    return cluster, best, visits


def _wholes(vectors: DataFrame, width: int, scale: int) -> DataFrame:
    """Rows that take part: id, and the components as whole numbers."""
    largest = 2 ** ((60 - width.bit_length()) // 2)  # squared distances stay below 2**62

    def work(batch):
        ids, out = [], []
        for rows, matrix in matrices(batch.column("x")):
            if matrix.shape[1] == width:
                with np.errstate(over="ignore"):
                    matrix = np.floor(scale * matrix)
                fits = (np.abs(matrix) <= largest).all(axis=1)
                ids += batch.column("vec_id").take(pa.array(rows[fits])).to_pylist()
                out += list(matrix[fits].astype(np.int64))
        return {"vec_id": ids, "x": out}

    return map_batches(vectors, work, "vec_id long, x array<long>", None)


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(-1, width)


def _assigned(vectors: DataFrame, tree: Broadcast, width: int) -> DataFrame:
    def work(batch):
        x = _matrix(batch, width)
        found = [nearest(tree.value, x[i : i + CHUNK])[:2] for i in range(0, len(x), CHUNK)]
        cluster, distance = (np.concatenate([f[i] for f in found] or [np.empty(0, np.int64)]) for i in (0, 1))
        return {"vec_id": batch.column("vec_id"), "cluster": cluster.astype(np.int32), "distance": distance}

    return map_batches(vectors, work, "vec_id long, cluster int, distance long", None)


def _moved(vectors: DataFrame, tree: Broadcast, width: int) -> np.ndarray:
    """The centroids of the next round. A task sends one sum for each cluster and dimension; they are added up in Spark."""

    def run(batches):
        count: dict[int, int] = {}
        sums: dict[int, list[int]] = {}
        for batch in batches:
            x = _matrix(batch, width)
            for at in range(0, len(x), CHUNK):
                part = x[at : at + CHUNK]  # CHUNK of them cannot overflow: components are below 2**30
                cluster = nearest(tree.value, part)[0]
                for c in np.unique(cluster).tolist():
                    own = part[cluster == c]
                    count[c] = count.get(c, 0) + len(own)
                    sums[c] = [a + b for a, b in zip(sums.get(c, [0] * width), own.sum(axis=0).tolist(), strict=True)]
        kind = pa.decimal128(38, 0)
        rows = [(c, i, count[c], s) for c, own in sums.items() for i, s in enumerate(own)]
        columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int32(), pa.int32(), kind, kind))]
        yield pa.RecordBatch.from_arrays(columns, names=["cluster", "i", "n", "s"])

    told = vectors.select("x").mapInArrow(run, "cluster int, i int, n decimal(38,0), s decimal(38,0)")
    new = tree.value.points.copy()
    for r in told.groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect():
        new[r.cluster, r.i] = int(r.s) // int(r.n)
    return new


def cluster_vectors(
    spark: SparkSession,
    vectors: DataFrame,
    clusters: int = 8,
    rounds: int = 10,
    width: int = 64,
    scale: int = 1024,
    seed: str = "3",
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Per vector: ``cluster``, ``distance`` (squared), and of the last assignment ``cluster_inertia``, ``inertia`` and ``centroid_sha256``.

    Vectors of ``width`` components take part, as whole numbers floor(``scale`` * x). The centroids start as the vectors with the smallest
    sha256 of ``<seed>:<id>``. Each round assigns every vector to the nearest centroid (ties to the smaller number) and moves each centroid to the
    floor of its vectors' mean; one without vectors stays where it is. What reaches the driver is one sum per cluster and dimension, and what is
    broadcast are the centroids in their tree: both have the size of ``clusters`` times ``width``.
    ``centroid_sha256`` is that of the final centroid's components in decimal, joined by commas.

    Rows whose vector is null, has another width, or holds null or non-finite components, or ones too large for squared distances in a long
    (2**26 for 64 components), take no part. Rows without an id are assigned but start no centroid; a table of such rows alone has no centroid and gives no rows. Repeated rows count once each, also as
    starting points: of equal hashes the smaller vector comes first. With fewer vectors than ``clusters`` there are as many centroids as vectors. An empty table gives no rows.
    """
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    with WorkTables(spark) as work:
        whole = work.write(_wholes(vector_table(vectors, id_col, vector_col), width, scale), "whole_vectors")
        starts = whole.where("vec_id is not null").orderBy(order, "x").limit(clusters).select("x").collect()
        if not starts:
            return spark.createDataFrame([], schema)
        points = np.array([r.x for r in starts], np.int64)
        for _ in range(rounds):
            tree = spark.sparkContext.broadcast(build_tree(points))
            points = _moved(whole, tree, width)
            tree.unpersist()
        tree = spark.sparkContext.broadcast(build_tree(points))
        last = written(spark, _assigned(whole, tree, width), "assigned")
        tree.unpersist()

    found = {r.cluster: r.inertia for r in last.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    digests = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points.tolist()]
    facts = [(c, i, digests[c]) for c, i in found.items()]
    by_cluster = F.create_map(*[x for c, i, _ in facts for x in (F.lit(c), F.lit(i).cast("long"))])
    by_digest = F.create_map(*[F.lit(x) for c, _, d in facts for x in (c, d)])
    return last.select(
        "vec_id",
        "cluster",
        "distance",
        by_cluster[F.col("cluster")].alias("cluster_inertia"),
        F.lit(sum(found.values())).cast("long").alias("inertia"),
        by_digest[F.col("cluster")].alias("centroid_sha256"),
    )
