"""The operators on vectors against brute force: nulls, ties, repeated rows, odd widths, clashing columns, empty tables."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltbed.llm import cosine_dedup
from siltbed.llm.centroids import build_tree, cluster_vectors, nearest, squared
from siltbed.llm.components import smallest_reached
from siltbed.llm.cosine_dedup import near_vectors, plan_tables
from siltbed.llm.eigen import leading_pairs
from siltbed.llm.whitening import whiten

NAN, INF = float("nan"), float("inf")
#: Names the operators use inside, as further columns of the input.
CLASHING = "vec_id long, embedding array<double>, label int, node long, size long, unit string, x int, n long, cluster int, links long"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 1, "u", 1, 1, 1, 1) for r in rows], CLASHING)


def groups(seed=5, width=16):
    """Groups of near copies about the threshold, copies, far vectors and rows that take no part."""
    rng = np.random.default_rng(seed)
    rows, vec_id = [], 100
    for label, members in ((0, 60), (0, 3), (1, 25), (None, 5), (1, 1), (2, 2)):
        base = rng.standard_normal(width)
        for _ in range(members):
            rows.append((vec_id, (base + rng.standard_normal(width) * rng.uniform(0.02, 0.2)).tolist(), label))
            vec_id += 1
    rows += [(vec_id + i, rng.standard_normal(width).tolist(), i % 3) for i in range(60)]
    rows += [(i, rows[i % 3][1], 0) for i in range(10, 16)]  # copies under smaller ids
    rows += [(16, (np.array(rows[0][1]) * 1e-200).tolist(), 0), (17, (np.array(rows[0][1]) * 1e200).tolist(), 0)]
    rows += [(18, rows[0][1], 1), (19, rows[0][1][:8], 0), (20, rows[0][1][:8], 0)]
    rows += [(21, None, 0), (22, [], 0), (23, [0.0] * width, 0), (24, [0.0] * width, 0), (25, [None, *rows[0][1][1:]], 0)]
    rows += [(26, [NAN, *rows[0][1][1:]], 0), (27, [INF, *rows[0][1][1:]], 0), (28, [1.0, *[-0.0] * 15], 2), (29, [1.0, *[0.0] * 15], 2)]
    return rows


def links_by_hand(rows, threshold=0.98):
    def usable(x):
        return x is not None and len(x) and all(v is not None and np.isfinite(v) for v in x) and any(x)

    unit = {}
    for i, (_, x, label) in enumerate(rows):
        if usable(x) and label is not None:
            x = np.array(x) / np.abs(x).max()
            unit[i] = x / np.linalg.norm(x)
    linked = defaultdict(set)
    for i in unit:
        for j in unit:
            if i != j and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                linked[i].add(j)
    out = []
    for i, (vec_id, _, _) in enumerate(rows):
        reached, todo = {i}, [i]
        while todo:
            new = linked[todo.pop()] - reached
            reached |= new
            todo += new
        ids = [rows[j][0] for j in reached if rows[j][0] is not None]
        smallest = min(ids, default=None)
        out.append((vec_id, len(linked[i]), smallest, vec_id == smallest))
    return Counter(out)


@pytest.mark.parametrize("block", [1024, 7])
def test_near_vectors_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(cosine_dedup, "BLOCK", block)
    rows = groups()
    rows += [(None, rows[0][1], 0), (None, [9.0, *[0.5] * 15], 7), (11, rows[1][1], 0), (11, rows[90][1], 1)]
    assert Counter(map(tuple, near_vectors(spark, table(spark, rows)).collect())) == links_by_hand(rows)


def test_near_vectors_of_an_empty_table(spark):
    out = near_vectors(spark, table(spark, []))
    assert (out.columns, out.collect()) == (["vec_id", "n_links", "component_id", "kept"], [])


def test_no_pair_at_the_threshold_is_missed(spark):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(1500):
        a, b = (v / np.linalg.norm(v) for v in rng.standard_normal((2, 64)))
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        angle = np.arccos(0.98) - 1e-9
        rows += [(2 * i, a.tolist(), 0), (2 * i + 1, (np.cos(angle) * a + np.sin(angle) * b).tolist(), 0)]
    found = near_vectors(spark, table(spark, rows)).collect()
    assert sum(r.n_links == 1 and r.component_id == r.vec_id // 2 * 2 for r in found) == len(rows)


def test_tables_follow_the_miss_chance():
    for nodes in (0, 1, 50, 10**4, 10**9):
        bits, tables = plan_tables(nodes, 0.98, 1e-5)
        shared = (1 - np.arccos(0.98) / np.pi) ** bits
        assert (1 - shared) ** tables <= 1e-5 and (nodes < 2 or 2**bits >= nodes)


@given(st.integers(1, 30), st.lists(st.tuples(st.integers(0, 29), st.integers(0, 29)), max_size=40))
@settings(deadline=None, max_examples=100)
def test_smallest_reached(n, links):
    links = [(i % n, j % n) for i, j in links]
    want = list(range(n))
    for _ in range(n):
        for i, j in links:
            want[i] = want[j] = min(want[i], want[j])
    i, j = (np.array([x[k] for x in links], int) for k in (0, 1))
    assert smallest_reached(n, i, j).tolist() == want


def whole_numbers(rows, scale=64, offset=1_000_000, width=16):
    usable = [(i, x) for i, x, _ in rows if x is not None and len(x) == width and all(v is not None and np.isfinite(v) and abs(v) < 1e9 for v in x)]
    return [i for i, _ in usable], np.array([[int(np.floor(scale * v)) + offset for v in x] for _, x in usable], object).reshape(-1, width)


def test_whitening_equals_brute_force(spark):
    rows = [r for r in groups() if r[1] is None or not any(v is not None and abs(v) > 1e9 for v in r[1])] + [(None, [3.0] * 16, None), (11, [2.5] * 16, 1)]
    ids, x = whole_numbers(rows)
    n, total = len(x), x.sum(axis=0)
    out = whiten(spark, table(spark, rows), components=12).orderBy("vec_id", "deviation", "component").collect()
    assert len(out) == 12 * n and {r.n for r in out} == {n}
    assert Counter((r.vec_id, r.deviation) for r in out) == Counter({k: 12 * c for k, c in Counter(zip(ids, ((n * x - total) ** 2).sum(axis=1).tolist(), strict=True)).items()})

    centred = (n * x - total).astype(float) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    assert np.allclose([r.explained for r in out[:12]], values[:12] / values.sum(), rtol=1e-10)
    z = np.array([r.whitened for r in out]).reshape(n, 12)
    order = sorted(range(n), key=lambda i: (ids[i] is not None, ids[i] or 0, int(((n * x[i] - total) ** 2).sum())))
    want = (centred @ axes[:, :12] / np.sqrt(values[:12]))[order]
    assert np.allclose(np.abs(z), np.abs(want), atol=1e-8)
    measured = np.abs(np.cov(z.T, bias=True) - np.eye(12)).max()
    assert measured < 1e-10 and out[0].identity_error < 1e-10


def test_whitening_of_few_equal_and_no_vectors(spark):
    assert whiten(spark, table(spark, [])).collect() == []
    assert whiten(spark, table(spark, [(1, [1.0, 2.0], 0)] * 3)).collect() == []
    assert whiten(spark, table(spark, [(1, None, 0), (2, [NAN], 0)])).collect() == []
    two = whiten(spark, table(spark, [(1, [0.0, 0.0], 0), (2, [1.0, 1.0], 0), (3, [9.0], 0)])).collect()  # one direction only, one odd width
    assert {(r.vec_id, r.component, round(abs(r.whitened), 12), r.n, r.deviation) for r in two} == {(1, 1, 1.0, 2, 8192), (2, 1, 1.0, 2, 8192)}


def test_whitening_of_large_components(spark):
    def vectors(step):
        return [(i, [float(i * step), float(-i), 0.25 * i * i], 0) for i in range(5)] + [(9, [1e300, 0.0, 0.0], 0)]

    out = whiten(spark, table(spark, vectors(10**6)), components=1).collect()
    x = np.array([[int(np.floor(64 * v)) + 10**6 for v in r[1]] for r in vectors(10**6)[:5]], object)
    assert {r.vec_id: (r.n, r.deviation) for r in out} == {i: (5, d) for i, d in enumerate(((5 * x - x.sum(axis=0)) ** 2).sum(axis=1).tolist())}
    with pytest.raises(Exception, match="too large"):  # no long holds these deviations
        whiten(spark, table(spark, vectors(10**9)), components=1).collect()


@pytest.mark.parametrize(
    "spectrum", [np.geomspace(1, 1e-12, 24), np.repeat([3.0, 1.0, 0.0], 8), np.ones(24), np.r_[np.full(3, 5), 5 + 1e-13, np.linspace(1, 2, 20)]]
)
def test_leading_pairs(spectrum):
    q = np.linalg.qr(np.random.default_rng(1).standard_normal((24, 24)))[0]
    a = q @ np.diag(spectrum) @ q.T
    a = (a + a.T) / 2
    values, vectors = leading_pairs(a, 12)
    assert np.allclose(values, np.sort(spectrum)[::-1][:12], atol=1e-13 * max(spectrum))
    assert np.abs(vectors.T @ vectors - np.eye(12)).max() < 1e-13
    assert np.abs(a @ vectors - vectors * values).max() < 1e-13 * max(spectrum)


def clusters_by_hand(rows, k, rounds, width, scale=1024, seed="3"):
    usable = [(i, x) for i, x, _ in rows if x is not None and len(x) == width and all(v is not None and np.isfinite(v) and abs(v) < 2**15 for v in x)]
    whole = [(i, [int(np.floor(scale * v)) for v in x]) for i, x in usable]
    starts = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), x) for i, x in whole if i is not None)
    points = [x for _, x in starts[:k]]

    def assign(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, p, strict=True)), c) for c, p in enumerate(points))

    for _ in range(rounds):
        own = defaultdict(list)
        for _, x in whole:
            own[assign(x)[1]].append(x)
        points = [[sum(v) // len(own[c]) for v in zip(*own[c], strict=True)] if c in own else p for c, p in enumerate(points)]
    last = [(i, *assign(x)) for i, x in whole]
    by = Counter()
    for _, d, c in last:
        by[c] += d
    digests = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points]
    return Counter((i, c, d, by[c], sum(by.values()), digests[c]) for i, d, c in last)


@pytest.mark.parametrize("k", [1, 3, 8, 40, 500])
def test_clusters_equal_brute_force(spark, k):
    rows = groups() + [(None, [3.0] * 16, None), (11, [2.5] * 16, 1), (11, [2.5] * 16, 1)]
    out = cluster_vectors(spark, table(spark, rows), clusters=k, rounds=3, width=16)
    assert Counter(map(tuple, out.collect())) == clusters_by_hand(rows, k, 3, 16)


def test_clusters_of_copies_and_of_no_vectors(spark):
    assert cluster_vectors(spark, table(spark, [])).collect() == []
    assert cluster_vectors(spark, table(spark, [(None, [1.0], 0), (1, [1.0, 2.0], 0)]), width=1).collect() == []
    rows = [(i, [1.0, -2.5], 0) for i in range(20)]  # all centroids are equal: every vector ties, and the others stay empty
    out = cluster_vectors(spark, table(spark, rows), width=2).collect()
    assert Counter(map(tuple, out)) == clusters_by_hand(rows, 8, 10, 2) and {r.cluster for r in out} == {0}


@given(st.integers(1, 60), st.integers(1, 6), st.integers(0, 2**31))
@settings(deadline=None, max_examples=60)
def test_tree_finds_the_nearest_with_ties(k, spread, seed):
    rng = np.random.default_rng(seed)
    points, x = rng.integers(-spread, spread + 1, (k, 3)), rng.integers(-spread, spread + 1, (50, 3))
    cluster, distance, _ = nearest(build_tree(points), x)
    every = squared(x[:, None], points[None])
    assert (cluster == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()


def test_tree_leaves_nodes_out():
    rng = np.random.default_rng(2)
    centres = rng.integers(-(10**6), 10**6, (40, 8))
    points = np.repeat(centres, 10, axis=0) + rng.integers(-50, 50, (400, 8))
    tree = build_tree(points)
    _, _, visits = nearest(tree, points + 1)
    assert visits < len(points) * len(tree.members) / 4
