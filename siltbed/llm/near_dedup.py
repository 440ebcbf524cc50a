"""Near-duplicate documents by bottom-k sketches.

One hash function orders all shingles; a document keeps its k smallest values. Inverted lists hold the documents that
retain the same values, the union of two sketches estimates the similarity of a candidate pair, and the full sets decide.

A list belongs to a short run of values that follow one another in a sketch, not to one value: a frequent shingle alone
would put a third of all documents in one list. No link is lost by that. Let two sets differ in D values: the C
values they share lie in at most D + 1 runs, so one run has C / (D + 1) values or more, and C >= D * t / (1 - t) at similarity t. At 0.8
that is three values (two where the sets have at most five). For sets larger than k the same holds but for chance, below 1e-11 a pair at k = 64.
"""

from __future__ import annotations

import functools
import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.llm.bpe import Kept
from siltbed.llm.common import WorkTables, documents, free_names, map_batches, raw, written
from siltbed.llm.components import components

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
#: Shingles in a block of a group.
BLOCK_VALUES = 400_000
#: How far below the threshold a sketch's estimate may lie: over six standard deviations of 64 values at 0.8.
ESTIMATE_SLACK = 0.35


@functools.lru_cache(maxsize=1)
def _words() -> Kept:
    return Kept(lambda word: int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little"))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _B
    h = (h ^ (h >> np.uint64(27))) * _C
    return h ^ (h >> np.uint64(31))


def shingle_set(data: bytes, width: int) -> np.ndarray:
    """The sorted hash values of the distinct shingles of a text's words, A-Z lower-cased."""
    words = data.lower().split()
    if not words:
        return np.empty(0, np.int64)
    h = np.fromiter(map(_words().__getitem__, words), np.uint64, len(words))
    n = min(width, len(h))
    out = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        out = _mixed(out * _A + h[i : len(h) - n + 1 + i])
    return np.unique(out.view(np.int64))


def _digest(values: np.ndarray) -> tuple[int, int]:
    d = hashlib.blake2b(values.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def run_lengths(threshold: float) -> tuple[int, int, int]:
    """Short and long run length, and the set size up to which only short runs are sure to be shared."""
    ratio = threshold / (1 - threshold)
    short = max(1, math.ceil(ratio - 1e-9) // 2)
    risky = [short * (d + 1) + d for d in range(1, 200) if math.ceil(ratio * d - 1e-9) <= short * (d + 1)]
    return (short, short + 1, max(risky, default=0)) if len(risky) < 150 else (short, short, 0)


def sketches(docs: DataFrame, width: int, k: int) -> DataFrame:
    """Per row: id, set size, digest of the set, and its ``k`` smallest values."""

    def work(batch):
        sets = [shingle_set(x or b"", width) for x in raw(batch)]
        digests = [_digest(s) for s in sets]
        return {
            "doc_id": batch.column("doc_id"),
            "n_shingles": [len(s) for s in sets],
            "hi": [d[0] for d in digests],
            "lo": [d[1] for d in digests],
            "sketch": [s[:k] for s in sets],
        }

    return map_batches(docs, work, "doc_id long, n_shingles long, hi long, lo long, sketch array<long>")


def postings(nodes: DataFrame, threshold: float) -> DataFrame:
    """``key``, ``node``: the inverted lists, a key being a run of retained values."""
    short, long, risky = run_lengths(threshold)

    def runs(length: int) -> str:
        values = ", ".join(f"sketch[i + {j}]" for j in range(length))
        return f"transform(sequence(0, size(sketch) - {length}), i -> xxhash64({length}, {values}))"

    keys = F.expr(
        f"concat(if(size(sketch) >= {long}, {runs(long)}, array()), "
        f"if(n_shingles <= {risky} and size(sketch) >= {short}, {runs(short)}, array()))"
    )
    return nodes.select(F.explode(F.array_distinct(keys)).alias("key"), "node")


def _full_sets(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """``node``, ``values``: the full sets of ``nodes``, whose digests tell which text is meant."""
    texts = docs.join(nodes, docs.doc_id == nodes.node).select("node", "hi", "lo", "text")

    def work(batch):
        sets = [shingle_set(x or b"", width) for x in raw(batch)]
        digests = zip(batch.column("hi").to_pylist(), batch.column("lo").to_pylist(), strict=True)
        own = [_digest(s) == d for s, d in zip(sets, digests, strict=True)]
        return {"node": batch.column("node"), "values": [s.tobytes() if ok else None for s, ok in zip(sets, own, strict=True)]}

    return map_batches(texts, work, "node long, values binary").where("values is not null")


def _similar(nodes: DataFrame, sets: DataFrame, pairs: DataFrame, k: int, threshold: float) -> DataFrame:
    """The pairs (a, b) that are links: estimated from the union of two sketches, confirmed on full sets."""
    part, whole = _fraction(threshold)

    def side(name: str) -> DataFrame:
        return nodes.select(F.col("node").alias(name), F.col("n_shingles").alias(f"n_{name}"), F.col("sketch").alias(f"s_{name}"))

    fit = whole * F.least("n_a", "n_b") >= part * F.greatest("n_a", "n_b")
    union = F.slice(F.array_sort(F.array_union("s_a", "s_b")), 1, k)
    common = F.size(F.array_intersect(F.array_intersect("s_a", "s_b"), "union"))
    near = pairs.join(side("b"), "b").join(side("a"), "a").where(fit).withColumn("union", union)
    near = near.where(common >= (threshold - ESTIMATE_SLACK) * F.size("union")).select("a", "b")
    both = near.join(sets.select(F.col("node").alias("b"), F.col("values").alias("v_b")), "b")
    both = both.join(sets.select(F.col("node").alias("a"), F.col("values").alias("v_a")), "a")

    def confirm(batch):
        kept = []
        for x, y in zip(batch.column("v_a").to_pylist(), batch.column("v_b").to_pylist(), strict=True):
            x, y = np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)
            shared = len(np.intersect1d(x, y, assume_unique=True))
            kept.append(whole * shared >= part * (len(x) + len(y) - shared))
        return {"a": batch.column("a"), "b": batch.column("b"), "linked": kept}

    return map_batches(both, confirm, "a long, b long, linked boolean", "v_b").where("linked").select("a", "b")


def _links_in_groups(members: DataFrame, sets: DataFrame, k: int, threshold: float) -> DataFrame:
    """Links (a, b) between the components of nodes of one ``group``: a and b are components.

    A group is cut by set size and into blocks of about as many shingles, and each two of its blocks meet in one task. Nodes whose sketches
    estimate the similarity too low are left out there first; of the others the task counts the common values from a local
    inverted index. Only links between components leave the task, each once.
    """
    part, whole = _fraction(threshold)
    # sizes of linked sets differ by the threshold at most: a document meets those of its size class and the two beside it
    size = F.floor(F.log("n_shingles") / math.log(1 / threshold)).cast("long")
    classed = members.select("node", "component", "n_shingles", "group", F.explode(F.array(size, size - 1)).alias("size"))
    blocks = classed.groupBy("group", "size", F.xxhash64("group", "size").alias("hash")).agg(
        F.ceil(F.sum("n_shingles") / BLOCK_VALUES).alias("blocks"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    blocks = blocks.where("low < high").select("group", "size", "blocks")
    placed = classed.join(blocks, ["group", "size"]).withColumn("own", F.pmod(F.xxhash64("node"), "blocks"))
    placed = placed.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    placed = placed.select("group", "size", "node", "component", "own", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"))

    def meet(table: pa.Table) -> pa.Table:
        component, own, p, q = (table.column(c).to_numpy() for c in ("component", "own", "p", "q"))
        values = [np.frombuffer(v, np.int64) for v in table.column("values").to_pylist()]
        left, right = np.flatnonzero(own == p), np.flatnonzero(own == q)
        found: set[tuple[int, int]] = set()
        if len(left) and len(right):  # documents go to blocks by hash, so a block can be without any
            size = np.array([len(v) for v in values])
            flat, owner = np.concatenate([values[i] for i in right]), np.repeat(np.arange(len(right)), size[right])
            order = np.argsort(flat, kind="stable")
            flat, owner = flat[order], owner[order]
            for i in left:
                apart = component[right] != component[i]
                if not apart.any():
                    continue
                # what the other set has of the retained values estimates at least the similarity
                few = values[i][:k]
                close = apart & (whole * np.minimum(size[i], size[right]) >= part * np.maximum(size[i], size[right]))
                shared = _shared(few, flat, owner, len(right))
                close &= shared >= (threshold - ESTIMATE_SLACK) * len(few)
                if not close.any():
                    continue
                shared = _shared(values[i], flat, owner, len(right))
                linked = close & (whole * shared >= part * (size[i] + size[right] - shared))
                found |= {(min(component[i], c), max(component[i], c)) for c in component[right[linked]].tolist()}
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return placed.join(sets, "node").groupBy("group", "size", "p", "q").applyInArrow(meet, "a long, b long").distinct()


def _shared(values: np.ndarray, flat: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """How many of ``values`` each of ``n`` owners has in the sorted ``flat``."""
    first, last = np.searchsorted(flat, values, "left"), np.searchsorted(flat, values, "right")
    count = last - first
    at = np.repeat(last - np.cumsum(count), count) + np.arange(count.sum())
    return np.bincount(owner[at], minlength=n)


def _fraction(threshold: float) -> tuple[int, int]:
    """The threshold as a fraction of whole numbers, so that the comparison is exact."""
    from fractions import Fraction

    f = Fraction(threshold).limit_denominator(10_000)
    return f.numerator, f.denominator


def near_duplicates(
    spark: SparkSession,
    docs: DataFrame,
    threshold: float = 0.8,
    width: int = 5,
    k: int = 64,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: ``n_shingles``, ``component_id`` (the smallest id linked to it, over any number of links) and ``kept``.

    Documents are linked where the Jaccard similarity of their sets of ``width``-word shingles is at least ``threshold``.
    Equal sets count as one node, so copies cost nothing beyond their own row. The members of a list are first compared with its smallest one.
    The lists that then still hold several components are compared in blocks, those with one smallest member as one group, out
    of which only links between components come: no link is lost, and large groups do not multiply.

    Null, empty and wordless texts have no shingles and are linked with nothing. Rows with one id count as one document,
    linked by any of its texts. Rows without an id take part through their text: their component is the smallest id there, null if there is none,
    and they are kept only then. An empty table gives no rows.
    """
    docs = documents(docs, id_col, text_col)
    with WorkTables(spark) as work:
        rows = work.write(sketches(docs, width, k), "sketches")
        sets = rows.where("n_shingles > 0 and doc_id is not null").groupBy("hi", "lo")
        classes = sets.agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"))
        classes = work.write(classes, "classes")

        # the hash beside the key groups nothing further; it lets the join split a long list, as it deals out both inputs anew
        lists = postings(classes, threshold)
        heads = lists.groupBy("key", F.xxhash64("key").alias("hash")).agg(F.min("node").alias("head"), F.max("node").alias("last"))
        lists = work.write(lists.join(heads.where("head < last").select("key", "head"), "key"), "lists")
        chosen = lists.select("node").distinct().join(classes.select("node", "hi", "lo"), "node")
        sets = work.write(_full_sets(docs, chosen, width), "sets")

        pairs = lists.where("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
        links = work.write(_similar(classes, sets, pairs, k, threshold), "links")
        first = components(spark, links.toDF("u", "v"), work)

        placed = lists.join(first, "node", "left").select("key", "head", "node", F.coalesce("component", "node").alias("component"))
        mixed = placed.groupBy("key", F.xxhash64("key").alias("hash")).agg(F.min("component").alias("x"), F.max("component").alias("y"))
        members = placed.join(mixed.where("x < y").select("key"), "key")
        members = members.select(F.col("head").alias("group"), "node", "component").distinct().join(classes.select("node", "n_shingles"), "node")
        links = work.write(_links_in_groups(members, sets, k, threshold), "links")
        second = components(spark, links.toDF("u", "v"), work).toDF("component", "joined")

        named = classes.select("hi", "lo", "node").join(first, "node", "left")
        named = named.select("hi", "lo", F.coalesce("component", "node").alias("component")).join(second, "component", "left")
        named = named.select("hi", "lo", F.coalesce("joined", "component").alias("component"))
        own = F.when(F.col("n_shingles") > 0, F.col("component"))
        out = rows.select("doc_id", "n_shingles", "hi", "lo").join(named, ["hi", "lo"], "left")
        component = F.coalesce(own, "doc_id")
        out = out.select(
            "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept")
        )
        return written(spark, out, "near_duplicates")


def drop_near_duplicates(
    spark: SparkSession, docs: DataFrame, threshold: float = 0.8, width: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with all its columns, one row of each group of near duplicates: of the smallest id.

    Rows without an id take part under a key made of their text, beyond other ids, so one of them stays only where no row of the group
    has an id. Of rows that share an id each different text is judged with the others of the id, and of equal ones one row stays.
    Null, empty and wordless texts are linked with nothing; of those that share an id, and of those without one, one of each text stays.
    """
    key, text_hash, row = free_names(docs, "row_key", "text_hash", "row")
    own = F.coalesce(F.col(id_col).cast("long"), F.lit(1 << 62) + F.xxhash64(text_col).bitwiseAND(F.lit((1 << 61) - 1)))
    keyed = docs.withColumns({key: own, text_hash: F.xxhash64(text_col)})
    found = near_duplicates(spark, keyed, threshold, width, id_col=key, text_col=text_col)
    # tables of their own size, so that Spark's threshold decides whether documents are moved for them
    gone = written(spark, found.where("not kept").select(F.col("doc_id").alias(key)).distinct(), "near_duplicates_gone")
    again = keyed.groupBy(key, text_hash).count().where("count > 1").select(key, text_hash)
    again = written(spark, again.join(gone, key, "left_anti"), "repeated_rows")
    left = keyed.join(gone, key, "left_anti")
    alone = left.join(again, [key, text_hash], "left_anti").select(*docs.columns)
    first = F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias(row)
    return alone.union(left.join(again, [key, text_hash], "left_semi").groupBy(key, text_hash).agg(first).select(f"{row}.*"))
