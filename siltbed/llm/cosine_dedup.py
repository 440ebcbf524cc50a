"""Near-duplicate vectors by the signs of random projections.

Each of several tables gives a vector the signs of its inner products with random hyperplanes as its bucket. Two vectors at an angle
share a sign with the chance 1 - angle / pi, and a bucket with that to the power of the bits. Bits follow the size of the largest label, so
that a bucket holds a sixteenth of an unrelated vector on average; tables follow from the bits, so that a pair at the threshold is
missed with the chance ``miss`` at most, and closer ones far less often. Vectors of a bucket are compared exactly.

Equal vectors are one node, however many rows have them. A bucket is cut into blocks, and each two of its blocks meet in a task that
multiplies them as matrices: what leaves it is a row for each linked node, never a pair.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.llm.common import WorkTables, map_batches, written
from siltbed.llm.components import components, smallest_reached
from siltbed.llm.vectors import matrices, vector_table

#: Nodes of a bucket in a block, and rows that a task holds at a time.
BLOCK, ROWS_HELD = 1024, 8192
SEED = 20_240_611


def plan_tables(rows: int, threshold: float, miss: float) -> tuple[int, int]:
    """Bits of a bucket and number of tables for the largest label's ``rows``."""
    bits = min(62, max(1, math.ceil(math.log2(max(rows, 1))) + 4))
    shared = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, 1 if shared >= 1 else max(1, math.ceil(math.log(miss) / math.log1p(-shared)))


def _units(matrix: np.ndarray) -> np.ndarray:
    """Rows at length one, without squares that overflow or vanish on the way."""
    matrix = matrix / np.abs(matrix).max(axis=1)[:, None]
    return matrix / np.sqrt((matrix * matrix).sum(axis=1))[:, None]


def _packed(x: np.ndarray) -> bytes:
    """A vector's bytes, in single precision where that holds it exactly."""
    with np.errstate(over="ignore"):
        single = x.astype("<f4")
    return single.tobytes() if (single == x).all() else x.astype("<f8").tobytes()


def _unpacked(vectors: list[bytes], width: int) -> np.ndarray:
    if {len(v) for v in vectors} == {4 * width}:
        return np.frombuffer(b"".join(vectors), "<f4").reshape(-1, width).astype(float)
    return np.array([np.frombuffer(v, "<f4" if len(v) == 4 * width else "<f8") for v in vectors], float)


def _measured(vectors: DataFrame) -> DataFrame:
    """Per row: id, label, and, of a vector that can be linked, width, digest and bytes."""

    def work(batch):
        n = len(batch)
        width, high, low, packed = [None] * n, [None] * n, [None] * n, [None] * n
        for rows, matrix in matrices(batch.column("x")):
            matrix = matrix + 0.0  # one zero
            some = np.abs(matrix).max(axis=1) > 0
            for at, x in zip(rows[some].tolist(), matrix[some], strict=True):
                packed[at] = _packed(x)
                digest = hashlib.blake2b(packed[at], digest_size=16).digest()
                high[at] = int.from_bytes(digest[:8], "little", signed=True)
                low[at] = int.from_bytes(digest[8:], "little", signed=True)
                width[at] = len(x)
        return {"vec_id": batch.column("vec_id"), "label": batch.column("label"), "width": width, "hi": high, "lo": low, "vector": packed}

    return map_batches(vectors, work, "vec_id long, label string, width int, hi long, lo long, vector binary", None)


_CLASS = "node long, label string, width int, hi long, lo long, first_id long, size long"


def _signed(classes: DataFrame, bits: int, tables: int) -> DataFrame:
    """Each node with its bucket in every table."""
    weights = 1 << np.arange(bits, dtype=np.int64)

    def work(batch):
        width = batch.column("width").to_numpy()
        keys: list = [None] * len(batch)
        vectors = batch.column("vector").to_pylist()
        for w in np.unique(width).tolist():
            rows = np.flatnonzero(width == w)
            planes = np.random.default_rng([SEED, w]).standard_normal((w, bits * tables))
            signs = _units(_unpacked([vectors[i] for i in rows], w)) @ planes >= 0
            for at, k in zip(rows.tolist(), signs.reshape(len(rows), tables, bits) @ weights, strict=True):
                keys[at] = k
        return {c: batch.column(c) for c in batch.schema.names} | {"buckets": keys}

    return map_batches(classes, work, f"{_CLASS}, vector binary, buckets array<{'int' if bits < 32 else 'long'}>", None)


def _compared(threshold: float):
    """For tasks whose rows come by unit (two blocks of a bucket): the links of its nodes that no earlier table finds."""

    def unit_links(x, table, p, q, own, label, buckets, size):
        left, right = np.flatnonzero(own == p), np.flatnonzero(own == q)
        i, j = np.nonzero(x[left] @ x[right].T >= threshold)
        i, j = left[i], right[j]
        once = i < j if p == q else np.ones(len(i), bool)
        once &= (label[i] == label[j]) & (buckets[i, table] == buckets[j, table])
        i, j = i[once], j[once]
        for earlier in range(table):
            new = buckets[i, earlier] != buckets[j, earlier]
            i, j = i[new], j[new]
        links = np.bincount(i, size[j], len(x)) + np.bincount(j, size[i], len(x))
        return links.astype(np.int64), smallest_reached(len(x), i, j)

    def flush(rows: pa.Table) -> pa.RecordBatch:
        marks = [rows.column(c).to_numpy() for c in ("unit_id", "width", "table", "p", "q")]
        own, node, size = (rows.column(c).to_numpy() for c in ("own", "node", "size"))
        label = rows.column("label").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        buckets = rows.column("buckets").combine_chunks().flatten().to_numpy().reshape(len(rows), -1)
        vectors, width = rows.column("vector").to_pylist(), marks[1]
        new = np.ones(len(rows), bool)
        new[1:] = np.any([m[1:] != m[:-1] for m in marks], axis=0)
        starts = np.flatnonzero(new).tolist()
        out: tuple[list, list, list] = ([], [], [])
        for a, b in zip(starts, [*starts[1:], len(rows)], strict=True):
            if b - a == 1:
                continue
            x = _units(_unpacked(vectors[a:b], int(width[a])))
            links, low = unit_links(x, marks[2][a], marks[3][a], marks[4][a], own[a:b], label[a:b], buckets[a:b], size[a:b])
            at = np.flatnonzero(links)
            for held, found in zip(out, (node[a:b][at], links[at], node[a:b][low[at]]), strict=True):
                held.append(found)
        columns = [pa.array(np.concatenate(h) if h else [], pa.int64()) for h in out]
        return pa.RecordBatch.from_arrays(columns, names=["node", "links", "root"])

    def run(batches):
        held, count = [], 0
        for batch in batches:
            held.append(batch)
            count += len(batch)
            if count > ROWS_HELD:
                rows = pa.Table.from_batches(held)
                ids = rows.column("unit_id").to_numpy()
                cut = int(np.searchsorted(ids, ids[-1]))  # all but the last unit are whole
                if cut:
                    yield flush(rows.slice(0, cut))
                    held, count = rows.slice(cut).to_batches(), len(rows) - cut
        if count:
            yield flush(pa.Table.from_batches(held))

    return run


def near_vectors(
    spark: SparkSession,
    vectors: DataFrame,
    threshold: float = 0.98,
    miss: float = 1e-5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """Per row: ``n_links`` (other rows linked directly), ``component_id`` (the smallest id reachable over links) and ``kept``.

    Rows of one label are linked where the cosine of their vectors, in doubles, is ``threshold`` or more; a pair is missed with the chance
    ``miss`` at most. Vectors of different widths are not linked. Rows with a null label, or with a vector that is null, zero, empty or
    holds null or non-finite components, are linked with nothing: their component is their own id.

    Every row counts: copies are linked with each other, also where they share an id. Rows without an id
    take part; their component is the smallest id there, null if there is none, and they are kept only then. An empty table gives no rows.
    """
    x = vector_table(vectors, id_col, vector_col, F.col(label_col).cast("string").alias("label"))
    key, place = ["label", "width", "hi", "lo"], ["label", "width", "table", "bucket"]
    most = x.where("label is not null").groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, tables = plan_tables(most, threshold, miss)
    with WorkTables(spark) as work:
        classes = _measured(x).where("label is not null and width is not null").groupBy(*key)
        classes = classes.agg(F.min("vec_id").alias("first_id"), F.count("*").alias("size"), F.first("vector").alias("vector"))
        classes = classes.select(F.monotonically_increasing_id().alias("node"), *key, "first_id", "size", "vector")
        signed = work.write(_signed(classes, bits, tables), "signed")

        # buckets with one node have no pair; they go before any vector is moved
        postings = signed.select("node", "label", "width", F.posexplode("buckets").alias("table", "bucket"))
        shared = postings.groupBy(*place).agg(F.count("*").alias("nodes")).where("nodes > 1")
        shared = work.write(shared.select(*place, F.ceil(F.col("nodes") / BLOCK).alias("blocks")), "buckets")
        placed = postings.join(shared, place).withColumn("own", F.pmod(F.xxhash64("node"), "blocks"))
        placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        placed = placed.withColumns({"p": F.least("own", "other"), "q": F.greatest("own", "other")})
        placed = placed.select("node", "table", "own", "p", "q", F.xxhash64(*place, "p", "q").alias("unit_id"))
        vectors_of = signed.select("node", "label", "width", "size", "vector", "buckets")
        met = placed.join(vectors_of, "node").repartition("unit_id").sortWithinPartitions("unit_id", "width", "table", "p", "q")
        found = work.write(met.mapInArrow(_compared(threshold), "node long, links long, root long"), "vector_links")
        work.drop(shared)

        counts = found.groupBy("node").agg(F.sum("links").alias("links"))
        reached = components(spark, found.select(F.col("node").alias("u"), F.col("root").alias("v")), work)
        names = reached.join(signed.select("node", "first_id"), "node").groupBy("component").agg(F.min("first_id").alias("name"))
        named = reached.join(work.write(names, "names"), "component").select("node", "name")
        judged = signed.select("node", *key, "first_id", "size").join(counts, "node", "left").join(named, "node", "left")
        links = F.col("size") - 1 + F.coalesce("links", F.lit(0))
        judged = written(spark, judged.select(*key, links.alias("links"), F.coalesce("name", "first_id").alias("name")), "judged")

    out = _measured(x).select("vec_id", *key).join(judged, key, "left")
    component = F.when(F.col("links").isNotNull(), F.col("name")).otherwise(F.col("vec_id"))
    return out.select(
        "vec_id",
        F.coalesce("links", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, component.isNull()).alias("kept"),
    )
