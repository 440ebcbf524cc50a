"""Byte-level BPE over whole texts, with the work done once per distinct segment.

A segment starts at a space that a non-space follows, or at a single line break between non-spaces. No token of the
pre-tokenizer's pattern crosses such a place, and none looks beyond it, so the tokens of a text are those of its segments in order.
Workers keep segments they have met.
"""

from __future__ import annotations

import functools
import json
import re
import struct
import weakref

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Fixed value: the pre-tokenizer's pattern of byte-level BPE vocabularies of this kind.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Segments a worker keeps; those met first are the frequent ones. After as many times more that were not kept, it starts
#: anew, as the texts may have changed. Longer segments are not kept.
KEPT_SEGMENTS, KEPT_LENGTH, KEPT_TIMES = 150_000, 64, 8

BOUNDARY = re.compile(r" (?=\S)")
_PLAIN = re.compile("[\\n -~À-ÖØ-öø-ÿ]*")


def _byte_of_symbol() -> dict[str, int]:
    """The printable symbol that stands for each byte: itself where printable, else the next free one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """One tokenizer file: its ranks by bytes, its special strings, and an encoder without special handling."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        before = told.get("pre_tokenizer") or {}
        if told["model"]["type"] != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or told.get("normalizer"):
            raise ValueError(f"{path} is not byte-level BPE without normalizer and prefix space")
        self.special = {x["content"]: x["id"] for x in told["added_tokens"]}
        symbols = _byte_of_symbol()
        self.ranks = {bytes(symbols[c] for c in t): i for t, i in told["model"]["vocab"].items() if t not in self.special}
        self.longest = max(map(len, self.ranks))
        self.library = Tokenizer.from_file(path)
        self.merges = tiktoken.Encoding("merges", pat_str=PATTERN, mergeable_ranks=self.ranks, special_tokens={})
        self._piece = self.merges._core_bpe.encode_single_piece
        self._split = re.compile("|".join(map(re.escape, self.special))) if self.special else None

    def ids(self, text: str) -> list[int]:
        """Ids of a text without special strings. Beyond plain Latin text the library itself decides what a letter is."""
        if text.isascii() and text[1:].isalpha() and (text[0] == " " or text[0].isalpha()):
            return self._piece(text.encode())
        if _PLAIN.fullmatch(text):
            return self.merges.encode_ordinary(text)
        return self.library.encode(text, add_special_tokens=False).ids

    def parts(self, text: str) -> list[tuple[str, int | None]]:
        """The text between special strings, each part with the id of the special string after it."""
        if not self._split or not self._split.search(text):
            return [(text, None)]
        found, at = [], 0
        for m in self._split.finditer(text):
            found.append((text[at : m.start()], self.special[m.group()]))
            at = m.end()
        return [*found, (text[at:], None)]


@functools.lru_cache(maxsize=4)
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


#: What the task that runs has used of what a worker keeps.
_used: set[int | str] = set()


def vocabulary(path: str) -> Vocabulary:
    _used.add("vocabulary")
    return _vocabulary(path)


def forget_unused() -> None:
    """At the end of a task: drops what it had no use for, as another operator's tasks may have left it in the worker."""
    if "vocabulary" not in _used:
        for kept in (_vocabulary, _kept_ids, _kept_counts):
            kept.cache_clear()
    for kept in Kept.all:
        if id(kept) not in _used:
            kept.clear()
    _used.clear()


def led(segment: str) -> str:
    """A segment other than the first as it stands in the text."""
    return segment if segment[:1] == "\n" else " " + segment


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class Kept(dict):
    """Values by segment, made when first asked for, in bounded number.

    A segment that ends in a letter and one of ``marks`` is not kept: its value is that of the rest plus that of the mark.
    """

    all: weakref.WeakSet = weakref.WeakSet()

    def __init__(self, make, marks: dict | None = None):
        super().__init__()
        self.make, self.left_out, self.marks = make, 0, marks or {}
        Kept.all.add(self)

    __hash__ = object.__hash__

    def __missing__(self, segment):
        _used.add(id(self))
        if segment[-1:] in self.marks and segment[-2:-1].isalpha():
            return self[segment[:-1]] + self.marks[segment[-1:]]
        value = self.make(segment)
        if len(self) < KEPT_SEGMENTS:
            if len(segment) <= KEPT_LENGTH:
                self[segment] = value
        else:
            self.left_out += 1
            if self.left_out > KEPT_TIMES * KEPT_SEGMENTS:
                self.clear()
                self.left_out = 0
        return value


class Split:
    """A batch of texts as segments: ``names`` are the distinct ones, ``codes`` the place of each segment of each text there.

    Text i has the codes from ``starts[i]`` to ``starts[i + 1]``. The first segment of a text, which no space leads,
    is not in ``codes``: it is ``firsts[i]``. ``aside`` are texts that have to be worked on alone: those with special strings, and
    those with white space in runs, where a space may be the end of what stands before it.
    """

    def __init__(self, words: Vocabulary, texts: pa.Array):
        texts = texts.fill_null("")
        parts = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        ends = parts.offsets.to_numpy().astype(np.int64)
        ends, values = ends - ends[0], parts.flatten()
        self.firsts = values.take(pa.array(ends[:-1])).to_pylist()
        later = np.ones(len(values), bool)
        later[ends[:-1]] = False
        coded = values.filter(pa.array(later)).dictionary_encode()
        self.codes, self.names = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        self.starts = ends - np.arange(len(ends))
        odd = np.fromiter((not n[n[:1] == "\n" :][:1].strip() for n in self.names), bool, len(self.names))
        aside = self.by_text(odd[self.codes]) > 0
        for mark in words.special:
            aside |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
        self.aside = np.flatnonzero(aside)

    def by_text(self, values: np.ndarray) -> np.ndarray:
        """Sums of one value per code over each text."""
        return np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[self.starts])


@functools.lru_cache(maxsize=4)
def _kept_ids(path: str) -> Kept:
    words = vocabulary(path)
    return Kept(lambda segment: packed(words.ids(led(segment))), {m: packed(words.ids(m)) for m in ",."})


def encoded(path: str, text: str) -> bytes:
    """One text's ids, as the library that owns the file gives them."""
    words, out = vocabulary(path), []
    for part, special in words.parts(text):
        out.append(packed(words.ids(part)))
        if special is not None:
            out.append(packed([special]))
    return b"".join(out)


@functools.lru_cache(maxsize=4)
def _kept_counts(path: str) -> Kept:
    words = vocabulary(path)
    return Kept(lambda segment: len(words.ids(led(segment))), {m: len(words.ids(m)) for m in ",."})


def count_batch(path: str, texts: pa.Array) -> np.ndarray:
    """The number of ids of each whole text, equal to the library's."""
    words, kept = vocabulary(path), _kept_counts(path)
    split = Split(words, texts)
    by_name = np.fromiter(map(kept.__getitem__, split.names), np.int64, len(split.names))
    counts = split.by_text(by_name[split.codes]) + np.array([len(words.ids(x)) if x else 0 for x in split.firsts], np.int64)
    for i in split.aside:
        counts[i] = len(encoded(path, texts[i].as_py() or "")) // 4
    return counts


def encode_batch(path: str, texts: pa.Array, end: bytes = b"") -> list[np.ndarray]:
    """The ids of each text, equal to those of the library that owns the file, and ``end`` (packed ids) behind each."""
    words, kept = vocabulary(path), _kept_ids(path)
    split = Split(words, texts)
    first_ids = [packed(words.ids(x)) if x else b"" for x in split.firsts]
    stored = [*map(kept.__getitem__, split.names), *(end + x for x in first_ids), end]
    sizes = np.fromiter(map(len, stored), np.int64, len(stored)) // 4
    ids, places = np.frombuffer(b"".join(stored), "<u4"), np.cumsum(sizes) - sizes
    # the end of a text and the first segment of the next one are stored together
    order = np.insert(split.codes.astype(np.int64), split.starts[:-1], len(split.names) + np.arange(len(split.firsts)))
    order = np.append(order, len(stored) - 1)
    took = sizes[order]
    until = np.cumsum(took)
    flat = ids[np.repeat(places[order] - (until - took), took) + np.arange(until[-1])]
    skip = len(end) // 4
    heads = until[split.starts + np.arange(len(split.starts))] - took[split.starts + np.arange(len(split.starts))]
    out = [flat[a + skip : b + skip] for a, b in zip(heads[:-1], heads[1:], strict=True)]
    for i in split.aside:
        out[i] = np.frombuffer(encoded(path, texts[i].as_py() or "") + end, "<u4")
    return out
