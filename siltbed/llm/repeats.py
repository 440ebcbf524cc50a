"""Repeated passages across documents, by distributed suffix sorting.

Suffixes are dealt to tasks by content, so that equal strings of ``length`` bytes meet: of the ``anchor``-byte strings in
a string of that length, the one with the smallest hash is its anchor, wherever the string occurs. Anchors that occur in one document
only are left out, and with them all suffixes that cannot repeat. The bytes around the others go to the anchor's task,
which sorts the suffixes by two-stage sorting and reads repeats off the common prefixes of neighbours.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.llm.common import WorkTables, documents, free_names, map_batches, raw, written
from siltbed.llm.suffixes import sort_suffixes

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
#: Windows a task sorts at a time. The strings of an anchor with more windows than that are grouped one by one instead.
WINDOWS_A_SORT = 20_000
#: Windows dealt to a task, on average.
WINDOWS_A_TASK = 40_000


def _gram_hashes(data: bytes, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes from each place on."""
    n = len(data) - size + 1
    eight = np.ndarray((len(data),), "<u8", data + b"\0" * 8, strides=(1,))
    h = np.zeros(n, np.uint64)
    for at in [*range(0, size - 7, 8), *([size - 8] if size % 8 else [])]:
        h = (h ^ eight[at : at + n]) * _A
        h ^= h >> np.uint64(29)
    h *= _B
    return h ^ (h >> np.uint64(32))


def _rolling(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over each window of ``width`` values."""
    span = 1
    while span * 2 <= width:
        values = pick(values[:-span], values[span:])
        span *= 2
    return pick(values[: -(width - span)], values[width - span :]) if span < width else values


def anchors(data: bytes, length: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of all strings of ``length`` bytes of a text, and the smallest hash of each string.

    Equal smallest hashes are all anchors.
    """
    if len(data) < length:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    h, width = _gram_hashes(data, size), length - size + 1
    smallest = _rolling(h, width, np.minimum)
    none = np.zeros(width - 1, np.uint64)
    places = np.flatnonzero(_rolling(np.concatenate([none, smallest, none]), width, np.maximum) == h)
    return places, h[places].view(np.int64), smallest.view(np.int64)


def owned_starts(data: bytes, length: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors by the strings they are first in: place, hash, and the first and last start of their strings.

    Each string of ``length`` bytes belongs to the leftmost of its anchors, so all its occurrences have it in the same place.
    """
    places, hashes, smallest = anchors(data, length, size)
    if not len(places):
        return places, hashes, places, places
    first = np.flatnonzero(np.concatenate([[True], smallest[1:] != smallest[:-1]]))
    last = np.concatenate([first[1:], [len(smallest)]]) - 1
    found = []
    while len(first):
        at = np.searchsorted(places, first)
        while (other := hashes[at] != smallest[first]).any():
            at[other] += 1
        found.append((at, first, np.minimum(last, places[at])))
        on = places[at] < last  # the same hash occurs again behind: the rest belongs to its next place
        first, last = places[at][on] + 1, last[on]
    at, first, last = (np.concatenate(x) for x in zip(*found, strict=True))
    return places[at], hashes[at], first, last


def _anchor_rows(docs: DataFrame, length: int, size: int) -> DataFrame:
    """``h``, ``salt``, ``doc_id``, ``known``: the distinct anchors of each document.

    Within a batch only the first document with an anchor stands for it (salt 0). Others already know that the anchor is
    shared and go their own ways, so that an anchor has one row a batch in its group, however many documents have it.
    """

    def work(batch):
        ids, hashes = [], []
        for doc_id, data in zip(batch.column("doc_id").to_pylist(), raw(batch), strict=True):
            h = np.unique(anchors(data or b"", length, size)[1])
            hashes.append(h)
            ids.append(np.full(len(h), doc_id, np.int64))
        h, ids = np.concatenate(hashes or [np.empty(0, np.int64)]), np.concatenate(ids or [np.empty(0, np.int64)])
        order = np.lexsort([ids, h])
        h, ids = h[order], ids[order]
        head = np.ones(len(h), bool)
        head[1:] = h[1:] != h[:-1]
        firsts = np.flatnonzero(head)
        low, high = ids[firsts], np.maximum.reduceat(ids, firsts) if len(firsts) else firsts
        shared = (low < high)[np.cumsum(head) - 1] if len(firsts) else head
        salt = np.where(head, 0, ids | np.int64(1))
        return {"h": h, "salt": salt, "doc_id": ids, "known": shared}

    return map_batches(docs, work, "h long, salt long, doc_id long, known boolean")


def _alike(near: list[bytes], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, dict[bytes, int]]:
    """The number of each window's bytes, the smallest document of each number, and the numbers."""
    index: dict[bytes, int] = {}
    which = np.fromiter((index.setdefault(x, len(index)) for x in near), np.int64, len(near))
    smallest = np.full(len(index), np.iinfo(np.int64).max)
    np.minimum.at(smallest, which, ids)
    return which, smallest, index


def _windows(texts: DataFrame, length: int, size: int) -> DataFrame:
    """``h``, ``doc_id``, ``first``, ``ahead``, ``near``, ``last``: the bytes of all strings of each shared anchor.

    ``near`` starts at ``first``, ``ahead`` bytes before the anchor; equal bytes have it in the same place, as it is the leftmost anchor of
    their first string. Documents of a batch that have the same window: the smallest id keeps
    it; for the others every string in it is known to occur in a smaller document, and only its starts, ``first`` to ``last``, go on.
    """

    def work(batch):
        near, found = [], []
        rows = zip(batch.column("doc_id").to_pylist(), raw(batch), batch.column("shared").to_pylist(), strict=True)
        for doc_id, data, shared in rows:
            place, h, first, last = owned_starts(data or b"", length, size)
            own = np.isin(h, np.array(shared, np.int64))
            place, h, first, last = place[own], h[own], first[own], last[own]
            near += [data[i:j] for i, j in zip(first.tolist(), (last + length).tolist(), strict=True)]
            found.append((h, np.full(len(h), doc_id, np.int64), first, place - first, last))
        h, ids, first, ahead, last = (np.concatenate(x) for x in zip(*found, strict=True))
        which, smallest, _ = _alike(near, ids)
        known = smallest[which] < ids
        return {
            "h": pa.array(h, pa.int64(), mask=known),
            "doc_id": pa.array(ids, pa.int64()),
            "first": pa.array(first, pa.int64()),
            "ahead": pa.array(ahead.astype(np.int32), pa.int32(), mask=known),
            "near": [None if k else x for x, k in zip(near, known.tolist(), strict=True)],
            "last": pa.array(last, pa.int64(), mask=~known),
        }

    return map_batches(texts, work, "h long, doc_id long, first long, ahead int, near binary, last long")


def _sorted_repeats(length: int, size: int):
    """For tasks that hold whole anchors: runs of starting places of strings that also start in a smaller document."""
    before, width = length - size, 2 * length - size

    def sort(ids, firsts, ahead, near) -> pa.RecordBatch:
        # equal windows are sorted once and stand for their smallest document
        which, smallest, index = _alike(near, ids)
        sizes = np.fromiter(map(len, index), np.int64, len(index))
        shift = np.empty(len(index), np.int64)
        shift[which] = before - ahead
        table = np.zeros((len(index), width), np.uint8)
        place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes - shift, sizes)
        table[np.repeat(np.arange(len(index)), sizes), place] = np.frombuffer(b"".join(index), np.uint8)
        start = np.arange(before + 1)
        valid = (start >= shift[:, None]) & (start <= (shift + sizes - length)[:, None])
        row, at, common = sort_suffixes(table, valid, length)
        # a class goes on while neighbours share ``length`` bytes
        group = np.cumsum(common < length) - 1 if len(row) else np.empty(0, np.int64)
        lowest = np.full(int(group[-1]) + 1 if len(group) else 0, np.iinfo(np.int64).max)
        np.minimum.at(lowest, group, smallest[row])
        first = np.full((len(index), before + 1), np.iinfo(np.int64).max)
        first[row, at] = lowest[group]
        i, j = np.nonzero(first[which] < ids[:, None])
        return _runs(ids[i], firsts[i] + ahead[i] - before + j)

    def flush(table: pa.Table) -> pa.RecordBatch:
        ids, firsts, ahead = (table.column(c).to_numpy() for c in ("doc_id", "first", "ahead"))
        return sort(ids, firsts, ahead.astype(np.int64), table.column("near").to_pylist())

    def run(batches):
        held, count = [], 0
        for batch in batches:
            held.append(batch)
            count += len(batch)
            if count > WINDOWS_A_SORT:
                table = pa.Table.from_batches(held)
                h = table.column("h").to_numpy()
                cut = int(np.searchsorted(h, h[-1]))  # rows are sorted by anchor: all but the last anchor are whole
                if cut:
                    yield flush(table.slice(0, cut))
                    held, count = table.slice(cut).to_batches(), len(table) - cut
        if count:
            yield flush(pa.Table.from_batches(held))

    return run


def _runs(ids: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
    """Starting places as runs: ``doc_id``, ``first``, ``last``."""
    order = np.lexsort([starts, ids])
    ids, starts = ids[order], starts[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (starts[1:] > starts[:-1] + 1)
    at = np.flatnonzero(new)
    last = starts[np.concatenate([at[1:], [len(ids)]]) - 1] if len(at) else starts[:0]
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (ids[at], starts[at], last)], names=["doc_id", "first", "last"])


def _merged(first: np.ndarray, last: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Spans of bytes that the strings starting in these runs cover."""
    out: list[list[int]] = []
    for a, b in sorted(zip(first, last, strict=True)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b + length)
        else:
            out.append([a, b + length])
    return [(a, b) for a, b in out]


def repeat_spans(spark: SparkSession, docs: DataFrame, length: int = 50, size: int = 20) -> DataFrame:
    """``cut_id``, ``digest``, ``spans``: of each document that loses bytes its id, the sha256 of the text that is judged, and the runs of bytes.

    Of the texts of an id the one with the smallest digest is judged. What a copy of a smaller document loses is known without looking into it.
    """

    def measure(batch):
        data = [x or b"" for x in raw(batch)]
        return {"doc_id": batch.column("doc_id"), "n_bytes": list(map(len, data)), "digest": [hashlib.sha256(x).digest() for x in data]}

    with WorkTables(spark) as work:
        narrow = map_batches(docs.where("doc_id is not null"), measure, "doc_id long, n_bytes long, digest binary")
        named = work.write(narrow.groupBy("doc_id").agg(F.min(F.struct("digest", "n_bytes")).alias("own")).select("doc_id", "own.*"), "named")
        twins = named.groupBy("digest", F.xxhash64("digest").alias("hash")).agg(F.min("doc_id").alias("twin")).drop("hash")
        named = work.write(named.join(twins, "digest"), "twins")

        rows = _anchor_rows(docs.where("doc_id is not null"), length, size)
        lows = "min(doc_id) over (partition by h, salt) < max(doc_id) over (partition by h, salt)"
        shared = rows.selectExpr("h", "doc_id", f"known or ({lows}) as shared").where("shared").select("h", "doc_id")
        # as many as the document has anchors
        by_doc = work.write(shared.groupBy("doc_id").agg(F.collect_list("h").alias("shared")), "shared")
        alone = by_doc.join(named.where("doc_id = twin").select("doc_id", "digest"), "doc_id")
        texts = docs.join(alone, "doc_id").where(F.unhex(F.sha2(F.col("text").cast("binary"), 256)) == F.col("digest"))
        windows = work.write(_windows(texts.select("doc_id", "text", "shared"), length, size), "windows")
        work.drop(by_doc)

        total = windows.where("h is not null").count()
        frequent = windows.where("h is not null").groupBy("h").count().where(F.col("count") > WINDOWS_A_SORT).select("h")
        frequent = work.write(frequent, "frequent")
        parts = max(spark.sparkContext.defaultParallelism, total // WINDOWS_A_TASK + 1)
        dealt = windows.where("h is not null").join(frequent, "h", "left_anti").repartition(parts, "h").sortWithinPartitions("h")
        schema = "doc_id long, first long, last long"
        found = dealt.select("h", "doc_id", "first", "ahead", "near").mapInArrow(_sorted_repeats(length, size), schema)

        # strings around a frequent anchor, one row for each: equal ones are aggregated before they meet
        many = windows.join(frequent, "h", "left_semi").selectExpr("doc_id", "first", "near", f"explode(sequence(0, length(near) - {length})) as i")
        many = many.selectExpr("doc_id", "first + i as first", f"substring(near, i + 1, {length}) as string")
        lowest = many.groupBy("string", F.xxhash64("string").alias("hash")).agg(F.min("doc_id").alias("lowest")).drop("hash")
        single = many.join(lowest, "string").where("lowest < doc_id").selectExpr("doc_id", "first", "first as last")
        known = windows.where("h is null").select("doc_id", "first", "last")
        runs = work.write(found.union(known).union(single), "runs")
        work.drop(windows)

        def merge(batch):
            own = [[(s["start"], s["end"]) for s in r] for r in batch.column("runs").to_pylist()]
            spans = [[{"start": a, "end": b} for a, b in _merged(*zip(*r, strict=True), length)] for r in own]
            return {"cut_id": batch.column("doc_id"), "spans": spans}

        kind = "array<struct<start: bigint, end: bigint>>"
        runs = runs.groupBy("doc_id").agg(F.collect_list(F.struct(F.col("first").alias("start"), F.col("last").alias("end"))).alias("runs"))
        spans = map_batches(runs, merge, f"cut_id long, spans {kind}", None)
        spans = spans.join(named.select(F.col("doc_id").alias("cut_id"), "digest"), "cut_id").select("cut_id", "digest", "spans")
        copies = named.where(f"twin < doc_id and n_bytes >= {length}").selectExpr(
            "doc_id as cut_id", "digest", f"cast(array(named_struct('start', 0L, 'end', n_bytes)) as {kind}) as spans"
        )
        return written(spark, spans.unionByName(copies), "spans")


def _cut(data: bytes, digest: bytes | None, spans: list[dict] | None) -> tuple[bytes, list[dict], bytes | None]:
    """(sha256, spans, rest) of a text; the rest is null where nothing goes."""
    own = hashlib.sha256(data).digest()
    if digest != own:
        return own, [], None
    ends = [0, *(x for s in spans for x in (s["start"], s["end"])), len(data)]
    return own, spans, b"".join(data[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True))


def remove_repeats(
    spark: SparkSession, docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: ``n_bytes``, ``digest`` (sha256 of the text), ``spans`` (start and end of each removed run of bytes), ``kept`` (the bytes that stay), its sha256.

    A byte goes if a string of ``length`` bytes that covers it also starts in a document with a smaller id; texts are
    compared as UTF-8 and never across documents. ``kept`` is null where nothing goes, and may hold broken characters, which ``kept_text``
    leaves out.
    A null text counts as empty. Rows without an id neither lose bytes nor make others lose any. Of rows that share an id, those with the
    text of the smallest sha256 are judged, each alike; the others keep all. An empty table gives no rows.
    """
    docs = documents(docs, id_col, text_col)
    spans = repeat_spans(spark, docs, length)

    def work(batch):
        told = zip(raw(batch), batch.column("digest").to_pylist(), batch.column("spans").to_pylist(), strict=True)
        cut = [(x or b"", *_cut(x or b"", digest, own)) for x, digest, own in told]
        return {
            "doc_id": batch.column("doc_id"),
            "n_bytes": [len(x) for x, _, _, _ in cut],
            "digest": [d for _, d, _, _ in cut],
            "spans": [s for _, _, s, _ in cut],
            "kept": [r for _, _, _, r in cut],
            "kept_text": [None if r is None else r.decode(errors="ignore") for _, _, _, r in cut],
            "kept_sha256": [(d if r is None else hashlib.sha256(r).digest()).hex() for _, d, _, r in cut],
        }

    schema = "doc_id long, n_bytes long, digest binary, spans array<struct<start: long, end: long>>, kept binary, kept_text string, kept_sha256 string"
    return map_batches(docs.join(spans, F.col("doc_id") == F.col("cut_id"), "left"), work, schema)


def without_repeats(
    spark: SparkSession, docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = None
) -> DataFrame:
    """``docs`` with all its columns, the texts as ``remove_repeats`` leaves them and ``chars_col`` counting their code points anew.

    Texts that lose nothing and their counts stay as they are, null ones too.
    """
    spans = repeat_spans(spark, documents(docs, id_col, text_col), length)
    cut_id, digest, own = free_names(docs, "cut_id", "digest", "spans")
    spans = spans.toDF(cut_id, digest, own)
    joined = docs.join(spans, F.col(id_col).cast("long") == F.col(cut_id), "left")

    def work(batch):
        out = {c: batch.column(c) for c in docs_columns}
        texts, counts = out[text_col].to_pylist(), out[chars_col].to_pylist() if chars_col else []
        told = zip(batch.column(digest).to_pylist(), batch.column(own).to_pylist(), strict=True)
        for i, (d, s) in enumerate(told):
            if d is not None and (rest := _cut((texts[i] or "").encode(), d, s)[2]) is not None:
                texts[i] = rest.decode(errors="ignore")
                if chars_col:
                    counts[i] = len(texts[i])
        return out | {text_col: texts} | ({chars_col: counts} if chars_col else {})

    docs_columns = docs.columns
    return map_batches(joined, work, docs.schema, text_col)
