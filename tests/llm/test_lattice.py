import itertools

import numpy as np
import pytest

from tidemark.llm import lattice

DDL = "vec_id long, embedding array<float>, gid int, cell string, label int"


def plain(rows, least=0.95):
    vectors = []
    for i, e, *_ in rows:
        v = np.array([np.nan if x is None else np.float32(x) for x in e or []], float)
        vectors.append(v if len(v) and np.isfinite(v).all() and (v != 0).any() else None)
    n = len(rows)
    links, root = [0] * n, list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(n), 2):
        x, y = vectors[a], vectors[b]
        if x is None or y is None or len(x) != len(y):
            continue
        if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= least:
            links[a] += 1
            links[b] += 1
            root[find(a)] = find(b)
    out = []
    for i in range(n):
        same = [rows[j][0] for j in range(n) if find(j) == find(i) and rows[j][0] is not None]
        c = min(same) if same else None
        out.append((rows[i][0], links[i], c, rows[i][0] == c))
    return sorted(out, key=repr)


def _near(rng, v, cosine):
    v = v / np.linalg.norm(v)
    g = rng.normal(size=len(v))
    g -= (g @ v) * v
    return cosine * v + np.sqrt(1 - cosine**2) * g / np.linalg.norm(g)


def _mixed(rng):
    base = rng.normal(size=(120, 64))
    vectors = [*base, *[_near(rng, b, 0.985) for b in base[:30]], *[_near(rng, base[0], 0.99) for _ in range(40)]]
    vectors += [base[5]] * 20 + [base[6] * 3.5, base[7] * 1e-30, -base[8]]
    vectors += [v[:16] for v in base[:4]] + [np.r_[v[:16], 0.0] for v in base[:2]]
    rows = [(i, [float(x) for x in v], 0, "clash", None) for i, v in enumerate(vectors)]
    odd = [None, [], [0.0] * 64, [None] + [1.0] * 63, [float("nan")] * 64, [float("inf")] * 64, [-0.0] * 64]
    rows += [(500 + i, e, 0, "", 1) for i, e in enumerate(odd)]
    return rows + [(None, rows[5][1], 0, "", 1), rows[9], rows[9], (None, None, 0, "", 1)]


@pytest.mark.parametrize("block", [lattice.BLOCK, 7])
def test_equals_all_pairs(frame, block):
    rows = _mixed(np.random.default_rng(8))
    got = lattice.near_duplicates(frame(rows, DDL).repartition(3), block=block)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(rows)


def test_recall_at_the_threshold(frame):
    """Pairs as far apart as a link allows: at least nine of ten are found, none below it."""
    rng = np.random.default_rng(9)
    base = rng.normal(size=(600, 64))
    pairs = [(b / np.linalg.norm(b), _near(rng, b, 0.9501 if i < 400 else 0.9499)) for i, b in enumerate(base)]
    rows = [(i, [float(x) for x in v], 0, "", 0) for i, v in enumerate(itertools.chain(*pairs))]
    links = {r["vec_id"]: r["n_links"] for r in lattice.near_duplicates(frame(rows, DDL)).collect()}
    assert sum(links[i] for i in range(800)) >= 0.92 * 800
    assert not any(links[i] for i in range(800, 1200))


def test_empty_table(frame):
    assert lattice.near_duplicates(frame([], DDL)).count() == 0


def test_nearest_point_is_nearest():
    rng = np.random.default_rng(1)
    y = rng.normal(size=(500, 8)) * 2
    p = lattice.nearest_point(y)
    assert (np.rint(p.sum(axis=1)) % 2 == 0).all()
    assert ((2 * p) % 2 == (2 * p[:, :1]) % 2).all()
    own = ((y - p) ** 2).sum(axis=1)
    around = ((y[:, None] - p[:, None] - lattice.MINIMAL[None]) ** 2).sum(axis=2).min(axis=1)
    assert (own <= around + 1e-9).all() and (own <= 1 + 1e-9).all()
