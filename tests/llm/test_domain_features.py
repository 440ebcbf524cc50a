import zlib

import numpy as np
import pyarrow as pa

from siltbed.llm import mixing


def test_features_are_those_of_words_taken_one_by_one():
    texts = ["A b\tb\x0bC", None, "", " \n ", "  Ünï É x y  z\r\n", "b " * 1500 + "İ"] + [f"w{i} w{i % 7} W{i}" for i in range(mixing.CHUNK)]
    found = list(mixing._features(pa.array(["cut off", *texts], pa.string()).slice(1)))
    rows, n = np.concatenate([r for r, _ in found]), np.concatenate([n for _, n in found])
    assert len(found) == 2 and len(rows) == len(texts)
    for text, row, count in zip(texts, rows, n, strict=True):
        words = (text or "").encode().lower().split()
        want = np.bincount([zlib.crc32(w) % mixing.WIDTH for w in words], minlength=mixing.WIDTH) / max(len(words), 1)
        assert count == len(words) and np.array_equal(row, np.sqrt(want.astype(np.float32)))


def test_a_word_is_hashed_once_for_all_texts(monkeypatch):
    asked = []
    monkeypatch.setattr(mixing.zlib, "crc32", lambda word: asked.append(word) or 1)
    texts = pa.array(["a b a", "B c", "a"] * mixing.CHUNK)
    assert mixing.Domains(["x"], np.ones(1), np.zeros((mixing.WIDTH + 1, 1))).classify(texts).tolist() == [[1.0]] * len(texts)
    assert sorted(asked) == [b"a", b"b", b"c"]
