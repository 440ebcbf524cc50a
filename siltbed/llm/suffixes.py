"""Two-stage suffix sorting of many short strings, and the common prefixes of neighbours.

A suffix smaller than its successor (the suffix one byte on) is sorted directly. The others follow by induction: within
the bucket of one first byte they come before the direct ones, in the order of their successors.
"""

from __future__ import annotations

import numpy as np

_ONE, _EIGHT = np.uint64(1), 8


def _words_at(flat: np.ndarray) -> np.ndarray:
    """At each byte, the eight bytes from there on as one big-endian number."""
    padded = np.concatenate([flat, np.zeros(_EIGHT, np.uint8)])
    return np.ndarray((len(flat),), ">u8", padded, strides=(1,)).astype(np.uint64)


def sort_suffixes(strings: np.ndarray, wanted: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the ``wanted`` suffixes (by row, and place among a row's first bytes) of ``strings`` (uint8, zero at the ends).

    Returns, in sorted order, row and place of each suffix, and the length of its common prefix with the one before,
    counted up to ``depth``. Suffixes that agree in ``depth`` bytes stand together in any order.
    """
    rows, width = strings.shape
    pitch = width + 1  # a zero ends each string
    text = np.zeros((rows, pitch), np.uint8)
    text[:, :width] = strings
    # direct[i]: suffix i is smaller than suffix i + 1; equal bytes take what comes after them
    by_place = np.ascontiguousarray(text.T)
    smaller = np.ones((pitch, rows), bool)
    for i in range(width - 1, -1, -1):
        smaller[i] = np.where(by_place[i] == by_place[i + 1], smaller[i + 1], by_place[i] < by_place[i + 1])
    direct = np.ascontiguousarray(smaller.T)
    # induction needs each induced suffix's successors up to the next direct one
    asked = np.zeros((rows, pitch), bool)
    asked[:, : wanted.shape[1]] = wanted
    needed = asked.T.copy()
    for i in range(1, pitch):
        needed[i] |= needed[i - 1] & ~smaller[i - 1]
    needed = needed.T
    flat, is_direct = text.ravel(), direct.ravel()
    places = np.flatnonzero(needed.ravel())
    own_direct = is_direct[places]

    first_stage = places[own_direct]
    left = pitch - first_stage % pitch
    keys = []
    words = _words_at(flat)
    for k in range(0, depth, _EIGHT):
        at = np.minimum(first_stage + k, len(flat) - 1)
        inside = np.clip(np.minimum(left - k, depth - k), 0, _EIGHT).astype(np.uint64)
        # bytes behind the string's end or the depth count as zero
        shift = (np.uint64(_EIGHT) - inside) * np.uint64(8)
        keys.append(np.where(inside > 0, (words[at] >> np.minimum(shift, np.uint64(63))) << np.minimum(shift, np.uint64(63)), 0))
    first_stage = first_stage[np.lexsort(keys[::-1])]

    rank = np.full(len(flat) + 1, -1, np.int64)
    induced = places[~own_direct]
    head_direct, head_induced = flat[first_stage], flat[induced]
    n_direct, n_induced = np.bincount(head_direct, minlength=256), np.bincount(head_induced, minlength=256)
    ends_direct = np.concatenate([[0], np.cumsum(n_direct)])
    by_head = induced[np.argsort(head_induced, kind="stable")]
    ends_induced = np.concatenate([[0], np.cumsum(n_induced)])
    ordered, done = [], 0
    for byte in np.flatnonzero(n_direct + n_induced):
        bucket = by_head[ends_induced[byte] : ends_induced[byte + 1]]
        # successors with a smaller first byte are ranked; runs of this byte are one step longer each time
        wave = bucket[flat[bucket + 1] < byte]
        waiting = bucket[flat[bucket + 1] == byte]
        while len(wave):
            wave = wave[np.argsort(rank[wave + 1], kind="stable")]
            rank[wave] = done + np.arange(len(wave))
            ordered.append(wave)
            done += len(wave)
            ready = rank[waiting + 1] >= 0
            wave, waiting = waiting[ready], waiting[~ready]
        own = first_stage[ends_direct[byte] : ends_direct[byte + 1]]
        rank[own] = done + np.arange(len(own))
        ordered.append(own)
        done += len(own)
    order = np.concatenate(ordered) if ordered else np.empty(0, np.int64)
    order = order[asked.ravel()[order]]
    return order // pitch, order % pitch, _common(words, order, pitch, depth)


def _common(words: np.ndarray, order: np.ndarray, pitch: int, depth: int) -> np.ndarray:
    """Common prefix of each suffix with the one before it, up to ``depth`` and the ends of both; 0 for the first."""
    out = np.zeros(len(order), np.int64)
    if len(order) < 2:
        return out
    a, b = order[:-1], order[1:]
    most = np.minimum(depth, pitch - np.maximum(a % pitch, b % pitch))
    common, open_ = np.full(len(a), depth), np.arange(len(a))
    for k in range(0, depth, _EIGHT):
        apart = words[np.minimum(a[open_] + k, len(words) - 1)] ^ words[np.minimum(b[open_] + k, len(words) - 1)]
        differ = apart != 0
        first = apart[differ]
        equal = np.zeros(len(first), np.int64)
        for byte in range(_EIGHT):
            equal += (first >> np.uint64(56 - 8 * byte)) == 0
        common[open_[differ]] = k + equal
        open_ = open_[~differ]
    out[1:] = np.minimum(common, most)
    return out
