"""Whitening of vectors by the leading components of their covariance.

Components count as whole numbers, so counts, sums and products of centred vectors are exact whatever the order in which tasks deliver them,
and a task that runs again changes nothing. Vectors are centred on the whole part of the mean before they are multiplied; the remainder of the
mean, below one, is taken off in whole numbers too. What reaches the driver has the size of the covariance matrix, which grows with
the dimensions alone. Its leading eigenpairs are found there (``eigen``) and go back to all vectors as one small matrix.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.llm.common import map_batches
from siltbed.llm.eigen import EPS, leading_pairs
from siltbed.llm.vectors import matrices, vector_table

#: Components up to here in absolute value are whole numbers that doubles hold exactly, with room for centring.
LARGEST = 2**51
#: Vectors multiplied at a time.
CHUNK = 4096


def _whole(batch: pa.RecordBatch, scale: int, offset: int, width: int | None = None):
    """(rows, matrix of whole numbers) of a batch, for each width or one."""
    for rows, matrix in matrices(batch.column("x")):
        if width in (None, matrix.shape[1]):
            with np.errstate(over="ignore"):
                matrix = np.floor(scale * matrix)
            fits = (np.abs(matrix) < LARGEST).all(axis=1)
            if fits.any():
                yield rows[fits], matrix[fits].astype(np.int64) + offset


def _in_wholes(values: np.ndarray, terms: int) -> np.ndarray:
    """Whole numbers in a form in which ``terms`` of them add up exactly: as they are, or as Python's integers."""
    return values if int(np.abs(values).max(initial=0)) * max(terms, 1) < 2**62 else values.astype(object)


def _sums(vectors: DataFrame, scale: int, offset: int) -> dict[int, tuple[int, list[int]]]:
    """For each width the number of vectors and their exact sums."""

    def run(batches):
        held: dict[int, tuple[int, list[int]]] = {}
        for batch in batches:
            for rows, x in _whole(batch, scale, offset):
                n, sums = held.get(x.shape[1], (0, [0] * x.shape[1]))
                added = _in_wholes(x, len(x)).sum(axis=0).tolist()
                held[x.shape[1]] = n + len(rows), [a + b for a, b in zip(sums, added, strict=True)]
        flat = [(w, i, n, s) for w, (n, sums) in held.items() for i, s in enumerate(sums)]
        yield _decimals(flat, "width", "i", "n", "s")

    told = vectors.mapInArrow(run, "width decimal(38,0), i decimal(38,0), n decimal(38,0), s decimal(38,0)")
    out: dict[int, tuple[int, list[int]]] = {}
    for r in told.groupBy("width", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("width", "i").collect():
        out.setdefault(int(r.width), (int(r.n), []))[1].append(int(r.s))
    return out


def _decimals(rows: list[tuple], *names: str) -> pa.RecordBatch:
    kind = pa.decimal128(38, 0)
    columns = [pa.array([r[i] for r in rows], kind) for i in range(len(names))]
    return pa.RecordBatch.from_arrays(columns, names=list(names))


def _products(vectors: DataFrame, scale: int, offset: int, centre: list[int]) -> dict[tuple[int, int], int]:
    """The exact sums of products of vectors less ``centre``, by pair of dimensions (i <= j)."""
    width, middle = len(centre), np.array(centre, np.int64)
    upper = np.triu_indices(width)

    def run(batches):
        total: np.ndarray | None = None
        for batch in batches:
            for _, x in _whole(batch, scale, offset, width):
                for at in range(0, len(x), CHUNK):
                    y = x[at : at + CHUNK] - middle
                    if int(np.abs(y).max()) ** 2 * len(y) < 2**53:  # every partial sum is a whole number that a double holds
                        product = (y.T.astype(float) @ y.astype(float)).astype(np.int64)[upper].astype(object)
                    else:
                        product = (y.T.astype(object) @ y.astype(object))[upper]
                    total = product if total is None else total + product
        if total is not None:
            yield _decimals(list(zip(upper[0].tolist(), upper[1].tolist(), total.tolist(), strict=True)), "i", "j", "s")

    told = vectors.mapInArrow(run, "i decimal(38,0), j decimal(38,0), s decimal(38,0)")
    return {(int(r.i), int(r.j)): int(r.s) for r in told.groupBy("i", "j").agg(F.sum("s").alias("s")).collect()}


def whiten(
    spark: SparkSession,
    vectors: DataFrame,
    components: int = 32,
    scale: int = 64,
    offset: int = 1_000_000,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Per row and component: ``whitened``, and of the fit ``n``, ``explained`` and ``identity_error``; ``deviation`` of the row.

    A component c of a vector becomes the whole number floor(``scale`` * c) + ``offset``. All rows that take part are the fit; the
    covariance has the divisor n. Its unit eigenvectors, numbered from 1 by falling eigenvalue, are the components; ``whitened`` is the centred vector
    projected on one, over the root of its eigenvalue. A component has no row where its eigenvalue is zero but for rounding (fewer different vectors than
    components, dimensions that depend on each other), as nothing can be divided by it; so a single vector, or equal ones, give no rows.
    ``deviation`` is the exact sum over dimensions of (n * x - S)^2, S being the sums; one beyond a long stops the query.
    ``identity_error`` is the largest absolute entry of the covariance of ``whitened`` less the identity.

    Rows whose vector is null, empty, or holds null or non-finite components, or one that ``scale`` takes beyond 2**51, take no part.
    Vectors of one fit have one width: that of most rows, the smaller of equally frequent ones; others take no part. Repeated rows and
    rows without an id count like any other. An empty table gives no rows.
    """
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    x = vector_table(vectors, id_col, vector_col)
    sums = _sums(x.select("x"), scale, offset)
    if not sums:
        return spark.createDataFrame([], schema)
    width = min(sums, key=lambda w: (-sums[w][0], w))
    n, total = sums[width]
    centre = [s // n for s in total]
    rest = [s - n * c for s, c in zip(total, centre, strict=True)]  # n times the part of the mean below one
    products = _products(x.select("x"), scale, offset, centre)
    covariance = np.zeros((width, width))
    for (i, j), s in products.items():
        covariance[i, j] = covariance[j, i] = float(Fraction(n * s - rest[i] * rest[j], n * n))

    trace = float(np.trace(covariance))
    values, axes = leading_pairs(covariance, min(components, width))
    held = int((values > width * EPS * max(trace, 0.0)).sum())
    if not held:
        return spark.createDataFrame([], schema)
    onto = axes[:, :held] / np.sqrt(values[:held])
    # projecting is linear, so this is the covariance of what is returned
    identity_error = float(np.abs(onto.T @ covariance @ onto - np.eye(held)).max())
    explained = (values[:held] / trace).tolist()
    middle, below_one, rests = np.array(centre, np.int64), np.array([r / n for r in rest]), np.array(rest, object)

    def project(batch):
        ids: list = []
        deviation: list = []
        projected: list = []
        for rows, whole in _whole(batch, scale, offset, width):
            y = whole - middle
            wide = int(np.abs(y).max()) * n + n  # at most this: n * x - S = n * y - rest
            exact = (n * y - rests.astype(np.int64)) if wide**2 * width < 2**62 else n * y.astype(object) - rests
            ids += batch.column("vec_id").take(pa.array(rows)).to_pylist()
            deviation += (exact * exact).sum(axis=1).tolist()
            projected += list((y - below_one) @ onto)
        return {"vec_id": ids, "deviation": deviation, "projected": projected}

    rows = map_batches(x, project, "vec_id long, deviation long, projected array<double>", None)
    shares = F.array(*map(F.lit, explained))
    return rows.select("vec_id", "deviation", F.posexplode("projected").alias("place", "whitened")).select(
        "vec_id",
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(shares, F.col("place") + 1).alias("explained"),
        F.lit(identity_error).alias("identity_error"),
    )
