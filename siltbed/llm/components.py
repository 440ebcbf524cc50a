"""Connected components of a graph given as a table of edges, by alternating star operations."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.llm.common import WorkTables, written

#: Edges that a task holds at a time.
EDGES_HELD = 1_000_000


def smallest_reached(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest number that each of ``n`` numbers reaches over the links (i, j)."""
    low = np.arange(n)
    while True:
        m = np.minimum(low[i], low[j])
        new = low.copy()
        for ends in (i, j, low[i], low[j]):
            np.minimum.at(new, ends, m)
        new = new[new]
        if (new == low).all():
            return low
        low = new


def _starred(edges: DataFrame) -> DataFrame:
    """The same components with fewer edges: those a task reads become edges to the smallest node they reach there."""

    def star(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
        low = smallest_reached(len(nodes), at[: len(u)], at[len(u) :])
        own = low != np.arange(len(nodes))
        return nodes[own], nodes[low[own]]

    def run(batches):
        u, v = np.empty(0, np.int64), np.empty(0, np.int64)
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) + len(u) > EDGES_HELD:
                u, v = star(*(np.concatenate([x, *(b.column(c).to_numpy() for b in held)]) for x, c in ((u, "u"), (v, "v"))))
                held = []
                if len(u) > EDGES_HELD // 2:  # it does not get smaller here: let it go
                    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])
                    u, v = u[:0], v[:0]
        u, v = star(*(np.concatenate([x, *(b.column(c).to_numpy() for b in held)]) for x, c in ((u, "u"), (v, "v"))))
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    return edges.mapInArrow(run, "u long, v long")


def _with_smallest(edges: DataFrame) -> DataFrame:
    """Each edge (u, v) with the smallest of u and u's neighbours.

    The hash beside the key groups nothing further, but the join then deals out both its inputs anew, which is the shape in which
    adaptive execution splits the many edges of one node.
    """
    smallest = edges.groupBy("u", F.xxhash64("u").alias("hash")).agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(smallest, "u")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first())


def components(spark: SparkSession, edges: DataFrame, owner: WorkTables | None = None) -> DataFrame:
    """``node``, ``component`` (the smallest node reachable) for every node of ``edges`` (u, v) that has another neighbour than itself.

    Each round links every node to the smallest neighbour it knows, first among the edges of a task, then through
    its larger neighbours, then through its smaller ones, until no edge changes. A node with many neighbours only meets aggregated rows or
    joins that Spark can split. Each round is a table in the shared folder, of which only the result stays, as one of ``owner`` if given.
    """
    with WorkTables(spark) as work:
        now = work.write(_starred(edges.where("u <> v").select(F.col("u").cast("long"), F.col("v").cast("long"))), "edges")
        state = _state(now)
        while state[0]:
            both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
            large = _with_smallest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            found = _with_smallest(large)
            small = found.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            small = small.union(found.select("u", F.col("m").alias("v"))).distinct()
            last, now = now, work.write(_starred(small), "edges")
            work.drop(last)
            before, state = state, _state(now)
            if state == before:
                break
        named = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
        named = named.union(roots)
        return owner.write(named, "components") if owner else written(spark, named, "components")
