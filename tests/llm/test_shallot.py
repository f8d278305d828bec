import hashlib
import math

import numpy as np

from tidemark.llm import shallot

DDL = "vec_id long, embedding array<float>, a int, v string"


def plain(rows, k, rounds, dims):
    kept = []
    for i, e, *_ in rows:
        if e is None or len(e) != dims or any(x is None or not math.isfinite(x) for x in e):
            continue
        kept.append((i, [math.floor(1024 * float(np.float32(x))) for x in e]))

    def rank(r):
        return (r[0] is None, "" if r[0] is None else hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1])

    cents = [list(v) for _, v in sorted(kept, key=rank)[:k]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c)), n) for n, c in enumerate(cents))

    for r in range(rounds + 1):
        near = [nearest(v) for _, v in kept]
        if r < rounds:
            for c in range(len(cents)):
                mine = [v for (_, v), (_, n) in zip(kept, near) if n == c]
                if mine:
                    cents[c] = [sum(x) // len(mine) for x in zip(*mine)]
    total = sum(d for d, _ in near)
    out = []
    for (i, _), (d, c) in zip(kept, near):
        mark = hashlib.sha256(",".join(map(str, cents[c])).encode()).hexdigest()
        out.append((i, c, d, sum(x for x, n in near if n == c), total, mark))
    return sorted(out, key=repr)


def _rows(rng, n, dims):
    return [(i, rng.normal(size=dims).round(2).tolist(), 1, "clash") for i in range(n)]


def test_equals_plain_rounds(frame):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(5, 6))
    rows = [(i, (centres[i % 5] + rng.normal(size=6) * 0.2).tolist(), 0, "") for i in range(150)] + _rows(rng, 50, 6)
    rows = [(i, *r[1:]) for i, r in enumerate(rows)]
    odd = [(900, None), (901, []), (902, [0.0] * 5), (903, [float("nan")] + [0.0] * 5), (904, [float("inf")] + [0.0] * 5)]
    rows += [(*o, 0, "") for o in odd] + [(905, [None, 1.0, 0.0, 0.0, 0.0, 0.0], 0, "")]
    rows += [rows[3], rows[3], (None, rows[4][1], 0, "")]
    got = shallot.cluster(frame(rows, DDL), k=4, rounds=5, dims=6)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(rows, 4, 5, 6)


def test_ties_go_to_the_smaller_number(frame):
    # A grid, so that many vectors are as far from several centroids.
    rows = [(i, [float(i % 4), float(i // 4 % 4)], 0, "") for i in range(64)]
    got = shallot.cluster(frame(rows, DDL), k=8, rounds=3, dims=2)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(rows, 8, 3, 2)


def test_few_vectors_and_none(frame):
    rows = [(1, [0.5, 0.25], 0, ""), (2, [0.5, 0.25], 0, "")]
    for some in (rows, rows[:1]):
        got = shallot.cluster(frame(some, DDL), dims=2)
        assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(some, 8, 10, 2)
    assert shallot.cluster(frame([], DDL)).count() == 0


def test_bounds_save_distances():
    """After the first round a settled vector takes no distance but its own."""
    rng = np.random.default_rng(4)
    c = rng.integers(-1000, 1000, (8, 16)) * 10
    v = c[rng.integers(0, 8, 4000)] + rng.integers(-20, 20, (4000, 16))
    a, b = np.zeros(4000, np.int32), np.ones(4000, np.int32)
    upper, lower = np.full(4000, np.inf), np.zeros(4000)
    shallot.assign(v, a, b, upper, lower, shallot.Round(c, np.zeros(8)))
    d = ((v[:, None] - c[None]) ** 2).sum(axis=2)
    assert (a == d.argmin(axis=1)).all() and (b != a).all()
    assert (lower <= np.sqrt(np.sort(d, axis=1)[:, 1]) * (1 + 1e-9)).all()
    assert (upper < lower).all()
