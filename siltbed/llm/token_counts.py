"""Token counts at every prefix of a text, by dynamic programming over prefixes.

The last token of a prefix is the one that ends there and may stand after the last token of what is before it; the
count is one more than the count there. So one pass over a piece of text gives the exact count of each of its prefixes, and
questions on truncation and budgets are look-ups. Pieces repeat, so their counts are kept.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from siltbed.llm import bpe
from siltbed.llm.common import documents, map_batches

_PIECES = regex.compile(bpe.PATTERN)
#: White space at the start, by what the pattern takes for it: Python's own notion has four controls more.
_SPACE = regex.compile(r"\s*")
_KEPT_PAIRS = 500_000


class PrefixCounts:
    """Counts by prefix for one tokenizer file."""

    def __init__(self, path: str):
        self.words = bpe.vocabulary(path)
        self._pairs: dict[tuple[bytes, bytes], bool] = {}
        self.totals = bpe.Kept(lambda segment: self.total(bpe.led(segment)), {m: 1 for m in ",."})
        self._pieces = bpe.Kept(lambda piece: self.piece(piece.encode())[-1])
        self._ends: dict = {}
        for token in self.words.ranks:
            node = self._ends
            for byte in reversed(token):
                node = node.setdefault(byte, {})
            node[-1] = token

    def _stand_together(self, a: bytes, b: bytes) -> bool:
        """Whether the merges leave ``a`` and ``b`` side by side as they are."""
        known = self._pairs.get((a, b))
        if known is None:
            known = self.words._piece(a + b) == [self.words.ranks[a], self.words.ranks[b]]
            if len(self._pairs) >= _KEPT_PAIRS:
                self._pairs.clear()
            self._pairs[a, b] = known
        return known

    def piece(self, piece: bytes) -> list[int]:
        """The count of each byte prefix of one piece, the empty one first."""
        counts, last = [0], [b""]
        for end in range(1, len(piece) + 1):
            node, ending = self._ends, []
            for start in range(end - 1, -1, -1):  # the tokens that end here, by their bytes from the last on
                node = node.get(piece[start])
                if node is None:
                    break
                if -1 in node:
                    ending.append((start, node[-1]))
            for start, token in reversed(ending):
                if not start or self._stand_together(last[start], token):
                    counts.append(counts[start] + 1)
                    last.append(token)
                    break
        return counts

    def total(self, text: str) -> int:
        """The count of a text without special strings."""
        return sum(map(self._pieces.__getitem__, self._cut(text)))

    def _cut(self, text: str) -> list[str]:
        """The pieces of a text. Beyond plain Latin text the library itself decides what a letter is."""
        if bpe._PLAIN.fullmatch(text):
            return _PIECES.findall(text)
        return [text[a:b] for _, (a, b) in self.words.library.pre_tokenizer.pre_tokenize_str(text)]

    def table(self, text: str) -> list[int]:
        """The count of each code point prefix of a text, the empty one first.

        Prefixes that the pattern cuts otherwise than the whole text are counted as the prefix alone would be: runs of
        white space, of which the last character may join what follows, and the letters of a contraction.
        """
        out = [0]
        for part, special in self.words.parts(text):
            base = out[-1]
            if special is None:
                self._part_table(part, out)
            else:  # what ends inside a special string is ordinary text
                mark = next(k for k, v in self.words.special.items() if v == special)
                self._part_table(part + mark[:-1], out)
                out.append(base + self.total(part) + 1)
        return out

    def _part_table(self, part: str, out: list[int]) -> None:
        base, run, run_base = out[-1], "", out[-1]
        for p in self._cut(part):
            data = p.encode()
            counts = [c for i, c in enumerate(self.piece(data)) if i == len(data) or data[i] & 0xC0 != 0x80]
            if p in ("'re", "'ve", "'ll"):
                counts[2] = 2
            if ahead := len(_SPACE.match(p).group()):
                if not run:
                    run_base = base
                for i in range(1, ahead + 1):
                    if run or ahead > 1:
                        counts[i] = run_base - base + len(self.words._piece((run + p[:i]).encode()))
                whole = base + self.total(p)
                run = run + p if ahead == len(p) else ""
                out += [base + c for c in counts[1:]]
                base = whole
                continue
            run = ""
            out += [base + c for c in counts[1:]]
            base += counts[-1]

    def fit(self, text: str, limit: int) -> int:
        """Code points of the longest prefix with at most ``limit`` tokens."""
        counts = self.table(text)
        return int(np.flatnonzero(np.array(counts) <= limit)[-1])

    def _fit(self, pieces: list[str], running: np.ndarray, at: int, limit: int) -> int:
        """``fit`` of a text whose segment ``at`` ends beyond the limit, from the segments up to the one after it and the running counts."""
        first = max(0, at - 1)
        near = "".join(pieces[first : at + 1]) + " " * (at + 1 < len(pieces) and pieces[at + 1][0] == " ")
        known = int(running[first - 1]) if first else 0
        return sum(map(len, pieces[:first])) + self.fit(near, limit - known)

    def measure(self, texts: pa.Array, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """Each text's count and ``fit``. Only the segments around the place where the limit falls are looked into."""
        split = bpe.Split(self.words, texts)
        by_name = np.fromiter(map(self.totals.__getitem__, split.names), np.int64, len(split.names))
        firsts = np.array([self.total(x) for x in split.firsts], np.int64)
        counts = firsts + split.by_text(by_name[split.codes])
        fits = pc.utf8_length(texts.fill_null("")).to_numpy(zero_copy_only=False).astype(np.int64)
        aside = set(split.aside.tolist())
        for i in np.flatnonzero(counts > limit):
            if int(i) not in aside:
                codes = split.codes[split.starts[i] : split.starts[i + 1]]
                running = firsts[i] + np.concatenate([[0], np.cumsum(by_name[codes])])
                at = int(np.searchsorted(running, limit, side="right"))  # the first segment that ends beyond the limit
                fits[i] = self._fit([split.firsts[i], *(bpe.led(split.names[c]) for c in codes[: at + 1])], running, at, limit)
        for i in split.aside:
            text = texts[i].as_py() or ""
            if len(self.words.parts(text)) > 1:
                table = np.array(self.table(text))
                counts[i], fits[i] = table[-1], np.flatnonzero(table <= limit)[-1]
                continue
            names = bpe.BOUNDARY.split(text)  # white space in runs: the text is cut where no token crosses, its segments are kept
            running = np.cumsum([self.total(names[0]), *map(self.totals.__getitem__, names[1:])])
            counts[i] = running[-1]
            if counts[i] > limit:
                at = int(np.searchsorted(running, limit, side="right"))
                fits[i] = self._fit([names[0], *map(bpe.led, names[1 : at + 2])], running, at, limit)
        return counts, fits


@functools.lru_cache(maxsize=4)
def prefix_counts(path: str) -> PrefixCounts:
    return PrefixCounts(path)


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: bytes, tokens, whether there are more than ``limit``, and the longest prefix within it.

    A null text counts as empty; repeated rows and null ids are counted like any other; an empty table gives no rows.
    ``fit_chars`` is in code points and exact for the prefix alone, encoded anew.
    """

    def work(batch):
        texts = batch.column("text")
        n, fit = prefix_counts(tokenizer).measure(texts, limit)
        n_bytes = pc.fill_null(pc.binary_length(texts), 0)
        return {"doc_id": batch.column("doc_id"), "n_bytes": n_bytes.cast("int64"), "n_tokens": n, "over_limit": n > limit, "fit_chars": fit}

    return map_batches(
        documents(docs, id_col, text_col), work, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long"
    )


def prefix_table(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``counts``, the exact token count of each code point prefix, the empty prefix first."""

    def work(batch):
        counts = prefix_counts(tokenizer)
        return {"doc_id": batch.column("doc_id"), "counts": [counts.table(t or "") for t in batch.column("text").to_pylist()]}

    return map_batches(documents(docs, id_col, text_col), work, "doc_id long, counts array<int>")
