"""Statistics of whole texts that the quality rules and the rule ensemble look at. Words are runs of bytes other than ASCII white space."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.llm.common import map_batches, raw

#: The symbols that count as noise, and the base rules' limits.
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SHARES = [
    "log_words",
    "word_length",
    "distinct_share",
    "symbol_share",
    "dup_line_share",
    "repeat_share",
    "upper_share",
    "mark_share",
    "top_word_share",
    "line_share",
    "digit_share",
]
SCHEMA = ", ".join(["doc_id long", *(f"{c} long" for c in COUNTS), *(f"{c} double" for c in SHARES)])

_UPPER, _MARKS, _DIGITS = bytes(range(65, 91)), b".,;:!?", b"0123456789"


def _repeated(codes: np.ndarray, distinct: int) -> int:
    """Words that lie in a three-word window found twice or more."""
    if len(codes) < 4:
        return 0
    pairs = codes[:-1] * distinct + codes[1:]
    if distinct > 2_000_000:  # three codes would not fit one number
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, where, times = np.unique(pairs[:-1] * distinct + codes[2:], return_inverse=True, return_counts=True)
    again = times[where] > 1
    covered = np.zeros(len(codes), bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


def of_text(data: bytes) -> tuple[list[int], list[float]]:
    words = data.split()
    joined = b"".join(words)
    n, chars = len(words), len(joined.decode())
    code: dict[bytes, int] = {}
    codes = np.array([code.setdefault(w, len(code)) for w in words], np.int64)
    lines = [x for x in data.split(b"\n") if x.strip()]
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    dup_lines = len(lines) - len(set(lines))
    repeated = _repeated(codes, len(code))
    per_word, per_char = max(n, 1), max(chars, 1)

    def share(of: bytes) -> float:
        return (len(joined) - len(joined.translate(None, of))) / per_char

    top = int(np.bincount(codes).max()) if n else 0
    shares = [
        float(np.log1p(n)),
        chars / per_word,
        len(code) / per_word,
        symbols / per_char,
        dup_lines / max(len(lines), 1),
        repeated / per_word,
        share(_UPPER),
        share(_MARKS),
        top / per_word,
        len(lines) / per_word,
        share(_DIGITS),
    ]
    return [n, chars, symbols, dup_lines, repeated], shares


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", extra: list[str] | None = None) -> DataFrame:
    """Per document, counts and shares over its whole text. A null text has no words; all shares are then 0.

    ``extra`` names further columns (with types) that go along.
    """
    kept = [x.split()[0] for x in extra or []]

    def work(batch):
        found = [of_text(x or b"") for x in raw(batch)]
        counts = np.array([f[0] for f in found], "int64").reshape(-1, len(COUNTS))
        shares = np.array([f[1] for f in found], "float64").reshape(-1, len(SHARES))
        out = {"doc_id": batch.column("doc_id")} | {c: batch.column(c) for c in kept}
        return out | dict(zip(COUNTS, counts.T, strict=True)) | dict(zip(SHARES, shares.T, strict=True))

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *kept)
    return map_batches(rows, work, ", ".join([SCHEMA, *(extra or [])]))
