import itertools

import numpy as np
import xxhash

from tidemark.llm import simhash
from tidemark.llm.components import components

DDL = "doc_id long, text string, fp string, row int"


def brute_print(text, n=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints, bits=4):
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(prints, 2):
        if bin(a ^ b).count("1") <= bits:
            root[find(a)] = find(b)
    return {p: find(p) for p in prints}


def test_clusters_equal_all_pairs(spark, frame):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(50)]
    base = [" ".join(rng.choice(words, 120)) for _ in range(12)]
    near = [t + " Tail  X" for t in base] + [t.upper() for t in base[:4]] + base[:5]
    texts = base + near + ["", None, "one two", "ONE\ttwo\n", "É é", " \x0b "]
    rows = [(100 - i, t, "clash", 1) for i, t in enumerate(texts)] + [(None, base[0], "", 0), (7, base[0], "", 0), (7, base[0], "", 0)]
    got = simhash.clusters(frame(rows, DDL)).collect()
    assert len(got) == len(rows)
    prints = {i: brute_print(t) for i, (_, t, *_) in enumerate(rows)}
    classes = brute_classes(set(prints.values()))
    least = {}
    for i, (doc_id, *_) in enumerate(rows):
        if doc_id is not None:
            c = classes[prints[i]]
            least[c] = min(least.get(c, doc_id), doc_id)
    want = sorted(repr((d, prints[i], least[classes[prints[i]]])) for i, (d, *_) in enumerate(rows))
    assert sorted(repr((r["doc_id"], r["fp"] % (1 << 64), r["component_id"])) for r in got) == want
    df = frame(rows, DDL)
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns and kept.count() == len(set(classes.values()))


def test_dense_keys_link_the_same_over_midpoints(frame):
    rng = np.random.default_rng(5)
    centre = int(rng.integers(1 << 62))
    values = {centre}
    for _ in range(300):
        flips = rng.choice(64, int(rng.integers(1, 7)), replace=False)
        values.add(centre ^ sum(1 << int(b) for b in flips))
    values = sorted(values | {int(x) for x in rng.integers(1 << 62, size=50)})
    signed = [(v - (1 << 64) if v >= 1 << 63 else v,) for v in values]
    for direct in (1, 4096):
        edges = simhash.links(frame(signed, "fp long"), direct=direct).collect()
        assert all(bin((r["a"] ^ r["b"]) % (1 << 64)).count("1") <= 4 for r in edges)
        root = {v[0]: v[0] for v in signed}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for r in edges:
            root[find(r["a"])] = find(r["b"])
        want = brute_classes(values)
        groups = {}
        for v, s in zip(values, signed):
            groups.setdefault(want[v], set()).add(find(s[0]))
        assert all(len(g) == 1 for g in groups.values())
        assert len({find(s[0]) for s in signed}) == len(groups)


def test_components_of_chains_and_hubs(frame):
    chain = [(i, i + 1) for i in range(40)]
    hub = [(1000, 1000 + i) for i in range(1, 60)]
    got = {r["node"]: r["root"] for r in components(frame(chain + hub + [(5, 5), (7, 6)], "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {1000 + i: 1000 for i in range(60)}
    assert components(frame([], "a long, b long")).count() == 0


def test_empty_table(frame):
    assert simhash.clusters(frame([], DDL)).count() == 0


def test_any_four_bytes_hold_a_listed_set():
    sets = simhash._covering_sets(4)
    assert len(sets) == 20
    for four in itertools.combinations(range(8), 4):
        assert any(set(s) <= set(four) for s in sets)
