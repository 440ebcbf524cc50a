"""Harmonic packing of tokenised documents into sequences of fixed capacity.

Lengths fall into reciprocal classes of the capacity: class j holds lengths above capacity / (j + 1), up to capacity / j, and a sequence
of class j takes j of them whole. A document of a capacity or more gives whole sequences first; its rest goes by its length.
The room left in a sequence with its j documents is filled from what comes later: by a document that fits it whole, the
tightest room first, else by cutting one. Documents that are cut anyway, the rests of long ones, are cut for that first; others
only when many sequences wait. Workers fill their sequences independently; no row is shuffled.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from siltbed.llm import bpe
from siltbed.llm.common import TOKEN_BATCH_BYTES, documents, slices

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_NAMES = [x.split()[0] for x in SCHEMA.split(", ")]
#: Sequence ids of one worker's part lie together: its number, then a count of up to 2^40 sequences.
_PART_BITS = 40
#: Sequences with room that a worker keeps before it cuts documents that would fit whole elsewhere.
WAITING = 256
_WIDTH = 4


class Piece:
    """Consecutive ids of a document, four bytes each."""

    __slots__ = ("doc_id", "start", "ids", "doc_tokens")

    def __init__(self, doc_id: int | None, start: int, ids: bytes, doc_tokens: int):
        self.doc_id, self.start, self.ids, self.doc_tokens = doc_id, start, ids, doc_tokens

    def __len__(self) -> int:
        return len(self.ids) // _WIDTH

    def cut(self, n: int) -> tuple[Piece, Piece]:
        at = n * _WIDTH
        return Piece(self.doc_id, self.start, self.ids[:at], self.doc_tokens), Piece(self.doc_id, self.start + n, self.ids[at:], self.doc_tokens)


def powers(n: int) -> Iterator[int]:
    """The powers of two that make up ``n``, largest first."""
    while n:
        size = 1 << (n.bit_length() - 1)
        yield size
        n -= size


class Bins:
    """One worker's open sequences: those of a class that lack documents, and those with all theirs that have room."""

    def __init__(self, part: int, capacity: int, waiting: int = WAITING):
        self.next_id, self.capacity, self.waiting = part << _PART_BITS, capacity, waiting
        self.classes: dict[int, list[Piece]] = {}
        #: (room, order of arrival, pieces), by room
        self.rooms: list[tuple[int, int, list[Piece]]] = []
        self.arrived, self.full = 0, []

    def _close(self, pieces: list[Piece]) -> None:
        offset = 0
        for p in pieces:
            self.full.append((p.doc_id, p.start, len(p), zlib.crc32(p.ids), p.doc_tokens, self.next_id, offset))
            offset += len(p)
        self.next_id += 1

    def _wait(self, pieces: list[Piece], room: int) -> None:
        if room:
            self.arrived += 1
            insort(self.rooms, (room, self.arrived, pieces))
        else:
            self._close(pieces)

    def _fits(self, piece: Piece) -> bool:
        """Puts a piece whole into the tightest room that holds it, if there is one."""
        at = bisect_left(self.rooms, (len(piece),))
        if at == len(self.rooms):
            return False
        room, _, pieces = self.rooms.pop(at)
        self._wait([*pieces, piece], room - len(piece))
        return True

    def _fill(self, piece: Piece) -> Piece | None:
        """Cuts a piece over the largest rooms until the last of it fits one whole; what is left if there are too few."""
        while self.rooms:
            if self._fits(piece):
                return None
            room, _, pieces = self.rooms.pop()
            own, piece = piece.cut(room)
            self._close([*pieces, own])
        return piece

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        """Places a document; what is held of it is a copy, so that its batch can go."""
        n = len(ids)
        whole = n - n % self.capacity
        for start in range(0, whole, self.capacity):
            self._close([Piece(doc_id, start, ids[start : start + self.capacity].tobytes(), n)])
        piece = Piece(doc_id, whole, ids[whole:].tobytes(), n)
        if whole == n or self._fits(piece):
            return
        if whole or len(self.rooms) > self.waiting:
            piece = self._fill(piece)
        if piece:
            count = self.capacity // len(piece)
            held = self.classes.setdefault(count, [])
            held.append(piece)
            if len(held) == count:
                self._wait(self.classes.pop(count), self.capacity - sum(map(len, held)))

    def end(self) -> None:
        """Empties the emptiest open sequences into the fullest; the rest goes to sequences of a power of two, which need no padding."""
        for held in self.classes.values():
            self._wait(held, self.capacity - sum(map(len, held)))
        self.classes = {}
        rest = None
        while self.rooms:
            for piece in self.rooms.pop()[2]:
                # a rest is there only when no room is: what follows it joins it
                while piece:
                    if not rest and self.rooms:
                        piece = self._fill(piece)
                        continue
                    rest = [*(rest or []), piece]
                    piece = None
        pieces = rest or []
        for size in powers(sum(map(len, pieces))):
            own = []
            while size:
                piece = pieces.pop(0)
                if len(piece) > size:
                    piece, after = piece.cut(size)
                    pieces.insert(0, after)
                own.append(piece)
                size -= len(piece)
            self._close(own)

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.full, strict=True)) or [()] * len(_NAMES)
        self.full = []
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=_NAMES)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence.

    A null or empty text is the end id alone. Repeated rows and rows without an id are packed like any other document; an
    empty table gives no rows. ``capacity`` is a power of two. No sequence is padded: each is full or, at most a few at the end of a
    worker's part, of a power of two.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError(f"capacity {capacity} is not a power of two")
    end = end_id.to_bytes(_WIDTH, "little")

    def run(batches):
        bins = Bins(TaskContext.get().partitionId(), capacity)
        for batch in batches:
            for part in slices(batch, size=TOKEN_BATCH_BYTES):
                texts = bpe.encode_batch(tokenizer, part.column("text"), end)
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), texts, strict=True):
                    bins.add(doc_id, ids)
                yield bins.take()
                del part, texts
            del batch
            pa.default_memory_pool().release_unused()
        bins.end()
        yield bins.take()
        bpe.forget_unused()

    return documents(docs, id_col, text_col).mapInArrow(run, SCHEMA)
