"""Mixing documents to target weights of domains, with soft memberships.

A classifier learnt from a labelled table gives each document a probability of each domain, hence expected tokens by domain. Document
rates (how often a document is taken) then follow by projected-gradient least squares: each round sums what the rates give,
compares with the targets, and moves every rate along its document's memberships, never below a floor.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.llm.bpe import count_batch
from siltbed.llm.common import TOKEN_BATCH_BYTES, WorkTables, documents, free_names, labelled, map_batches

#: Counts of hashed words that the classifier looks at, and texts it looks at together.
WIDTH, CHUNK = 1024, 512


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each word of the texts, in order, and where those of each text start. A word is lower-cased and hashed once for all texts."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    words, ends = parts.flatten(), parts.offsets.to_numpy().astype(np.int64)
    held = pc.binary_length(words).to_numpy() > 0  # white space at an end of a text leaves an empty one there
    coded = words.dictionary_encode()
    hashed = (zlib.crc32(word) % WIDTH for word in coded.dictionary.cast(pa.binary()).to_pylist())
    buckets = np.fromiter(hashed, np.int64, len(coded.dictionary))[coded.indices.to_numpy()]
    return buckets[held], np.append(0, np.cumsum(held))[ends - ends[0]]


def _features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Shares of hashed words of each whole text, and its words, for as many texts at a time as are looked at together."""
    buckets, starts = _words(texts)
    for at in range(0, len(texts), CHUNK):
        of = starts[at : at + CHUNK + 1]
        n = np.diff(of)
        place = np.repeat(np.arange(len(n)) * WIDTH, n) + buckets[of[0] : of[-1]]
        shares = np.bincount(place, minlength=len(n) * WIDTH).reshape(-1, WIDTH) / np.maximum(n, 1)[:, None]
        yield np.sqrt(shares.astype(np.float32)), n


def fit_domains(rows: np.ndarray, domain: np.ndarray, n_domains: int, steps: int = 300, decay: float = 1e-4) -> np.ndarray:
    """Weights of a multinomial logistic classifier, by accelerated gradient from zero; the last row is the intercept."""
    x = np.hstack([rows.astype(float), np.ones((len(rows), 1))])
    y = np.eye(n_domains)[domain]
    step = 2 * len(x) / max(np.linalg.norm(x, 2) ** 2, 1e-9)
    weights = ahead = np.zeros((x.shape[1], n_domains))
    for i in range(steps):
        after = ahead - step * (x.T @ (_softmax(x @ ahead) - y) / len(x) + decay * ahead)
        ahead, weights = after + i / (i + 3) * (after - weights), after
    return weights


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


@dataclass(frozen=True)
class Domains:
    """A classifier of domains: the weights learnt, and the shares that wordless texts get."""

    names: list[str]
    share: np.ndarray
    weights: np.ndarray | None

    def classify(self, texts: pa.Array) -> np.ndarray:
        p = np.tile(self.share, (len(texts), 1))
        if self.weights is not None:
            for i, (rows, n) in enumerate(_features(texts)):
                p[i * CHUNK : (i + 1) * CHUNK][n > 0] = _softmax(rows[n > 0] @ self.weights[:-1] + self.weights[-1])
        return p


def learnt_domains(docs: DataFrame, labels: DataFrame, domains: list[str], sample: int = 3000) -> Domains:
    """The classifier learnt from ``labels`` (``doc_id`` and ``domain``), of which at most ``sample`` rows, those of the smallest id hash.

    Domains without a label get no share; without labels, and for wordless texts, all are as likely as among the labels.
    """
    marks = labels.where(F.col("domain").isin(domains) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("domain").alias("domain"))
    schema = "doc_id long, domain string, x array<float>"

    def look(batch):
        return {"doc_id": batch.column("doc_id"), "domain": batch.column("domain"), "x": [x for rows, _ in _features(batch.column("text")) for x in rows]}

    seen = map_batches(labelled(docs, marks, "doc_id", sample), look, schema).toArrow().sort_by([("doc_id", "ascending")])
    x = np.array(seen.column("x").to_pylist(), np.float32).reshape(-1, WIDTH)
    y = np.array([domains.index(d) for d in seen.column("domain").to_pylist()], int)
    share = (np.bincount(y, minlength=len(domains)) + 0.0) / max(len(y), 1) if len(y) else np.full(len(domains), 1 / len(domains))
    return Domains(domains, share, fit_domains(x, y, len(domains)) if len(y) else None)


def memberships(docs: DataFrame, known: Domains, tokenizer: str) -> DataFrame:
    """Per document row: ``doc_id``, ``n_tokens`` (exact, of the whole text) and ``p``, the probability of each domain."""

    def work(batch):
        p = pa.array(list(known.classify(batch.column("text"))), pa.list_(pa.float64()))
        return {"doc_id": batch.column("doc_id"), "n_tokens": count_batch(tokenizer, batch.column("text")), "p": p}

    return map_batches(docs, work, "doc_id long, n_tokens long, p array<double>", size=TOKEN_BATCH_BYTES)


@dataclass(frozen=True)
class Rates:
    """What gives a document its rate: the moves so far, along its memberships, and the floor below which none goes.

    ``target_error`` is the largest distance between a domain's share of all tokens taken and its target.
    """

    moves: list[np.ndarray]
    floor: float
    target_error: float = 0.0

    @property
    def start(self) -> float:
        return float(max(1.0, self.floor))

    def of(self, p: np.ndarray) -> np.ndarray:
        rate = np.full(len(p), self.start)
        for move in self.moves:
            along = np.zeros(len(p))
            for i in range(p.shape[1]):
                along = along + p[:, i] * move[i]
            rate = np.maximum(self.floor, rate - along)
        return rate

    def column(self) -> Column:
        if not self.moves:
            return F.lit(self.start)
        told = F.array(*(F.array(*(F.lit(float(c)) for c in move)) for move in self.moves))

        def step(rate: Column, move: Column) -> Column:
            along = sum((F.col("p")[i] * move[i] for i in range(len(self.moves[0]))), F.lit(0.0))
            return F.greatest(F.lit(float(self.floor)), rate - along)

        return F.aggregate(told, F.lit(self.start), step)


def fit_rates(rows: DataFrame, targets: list[float], total: float, floor: float, rounds: int, tolerance: float) -> Rates:
    """Projected-gradient least squares over ``rows`` (``n_tokens``, ``p``): each round sums over all documents what the rates give.

    The step is that of least squares over the documents that are not at the floor, as only they can give less.
    """
    d, n = len(targets), F.col("n_tokens")
    p = [F.col("p")[i] for i in range(d)]
    want = np.array(targets, float) / sum(targets)
    square = [(i, j) for i in range(d) for j in range(d)]

    def sums(columns: list[Column], of: DataFrame) -> np.ndarray:
        found = of.agg(*(F.sum(c).alias(f"s{i}") for i, c in enumerate(columns))).first()
        return np.array([x or 0.0 for x in found], float)

    tokens, *natural = sums([n, *(n * x for x in p)], rows)
    natural = np.array(natural)
    if not tokens:
        return Rates([], floor)
    reachable = natural > 1e-9 * tokens
    want = np.where(reachable, want, 0) / max(want[reachable].sum(), 1e-12)
    goal = total
    if floor > 0:  # the domain the floor overfills most sets the total
        goal = max(total, floor * float((natural[reachable] / (tokens * np.maximum(want[reachable], 1e-12))).max()))
    rates, best, before = Rates([], floor), None, np.inf
    for turn in range(rounds + 1):
        rated = rows.withColumn("rate", rates.column())
        # a document at the floor still counts where the next step raises it; a small share of all keeps the step bounded
        free = F.when(F.col("rate") > floor, n).otherwise(n * 1e-3)
        told = sums([*(n * x * F.col("rate") for x in p), *(free * p[i] * p[j] for i, j in square)], rated)
        given, metric = told[:d], told[d:].reshape(d, d)
        off = float(np.abs(given / max(given.sum(), 1e-12) - want).max())
        if best is None or off < best.target_error:
            best = Rates(rates.moves, floor, off)
        error = given / tokens - goal * want
        size = float(np.abs(error).max())
        if turn == rounds or size <= tolerance * goal:
            break
        if floor > 0 and size > 0.7 * before:  # documents of other domains bring the overfilled one more of its own: more has to be taken of all
            goal *= 1.05
            error = given / tokens - goal * want
        before = size
        inverse = np.linalg.pinv(metric / tokens + 1e-9 * np.eye(d))
        rates = Rates([*rates.moves, inverse @ error], floor)
    return best


def _chance(id_: Column) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(id_, F.lit(0).cast("long")), F.lit("mix")), F.lit(1 << 30)) / float(1 << 30)


def _fitted(docs, labels, targets, total, floor, rounds, tolerance, sample, tokenizer, work: WorkTables) -> tuple[Domains, DataFrame, Rates]:
    names = sorted(targets)
    known = learnt_domains(docs, labels, names, sample)
    rows = work.write(memberships(docs, known, tokenizer), "memberships")
    return known, rows, fit_rates(rows, [targets[n] for n in names], total, floor, rounds, tolerance)


def mix(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    targets: dict[str, float],
    tokenizer: str,
    total: float = 1.0,
    floor: float = 0.0,
    rounds: int = 60,
    tolerance: float = 1e-4,
    sample: int = 3000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: ``n_tokens``, ``p_<domain>``, ``rate`` and ``copies``, how often the document is taken, and of all ``target_error``.

    The expected tokens of domain d under the rates come to ``targets[d]`` (made to sum to 1) of ``total`` times all tokens. With ``floor``
    above 0 no document is left out, and ``total`` grows to what the floor makes necessary. Where ``rounds`` end before the shares are within
    ``tolerance``, or no rates can reach the targets, the best rates found are given; ``target_error`` always says how far the
    shares reached are from the targets. ``copies`` rounds the rate by a hash of the id, so that a copy is as likely as the rate says.

    Empty texts weigh nothing; their rate follows their memberships. Rows without an id are rated alike but rounded as id 0. Repeated rows count
    each. A domain that no text belongs to cannot reach its target; the others still do, in proportion. An empty table gives no rows.
    """
    docs = documents(docs, id_col, text_col)
    with WorkTables(spark) as work:
        known, rows, rates = _fitted(docs, labels, targets, total, floor, rounds, tolerance, sample, tokenizer, work)
        work.keep(rows)
    whole = F.floor("rate")
    copies = (whole + (_chance(F.col("doc_id")) < F.col("rate") - whole).cast("long")).cast("long")
    by_name = [F.col("p")[i].alias(f"p_{name}") for i, name in enumerate(known.names)]
    rated = rows.select("doc_id", "n_tokens", *by_name, rates.column().alias("rate"))
    return rated.withColumns({"copies": copies, "target_error": F.lit(rates.target_error)})


def mixed_documents(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    targets: dict[str, float],
    tokenizer: str,
    total: float = 1.0,
    floor: float = 0.0,
    rounds: int = 60,
    tolerance: float = 1e-4,
    sample: int = 3000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with all its columns, each row as often as ``mix`` takes it.

    A rate depends on a text alone, so it is worked out again beside the text, and no document is moved for it.
    """
    with WorkTables(spark) as work:
        known, _, rates = _fitted(documents(docs, id_col, text_col), labels, targets, total, floor, rounds, tolerance, sample, tokenizer, work)
    (chance,) = free_names(docs, "chance")
    columns = docs.columns

    def take(batch):
        rate = rates.of(known.classify(batch.column(text_col)))
        whole = np.floor(rate)
        copies = whole.astype(np.int64) + (batch.column(chance).to_numpy() < rate - whole)
        taken = batch.take(pa.array(np.repeat(np.arange(len(batch)), copies)))
        return {c: taken.column(c) for c in columns}

    return map_batches(docs.withColumn(chance, _chance(F.col(id_col).cast("long"))), take, docs.schema, text_col, TOKEN_BATCH_BYTES)
