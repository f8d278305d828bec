import itertools
import re

import pytest

from tidemark.llm import interactions

DDL = "doc_id long, text string, lang string, rid long, part string, digest int"


def plain(rows, labels):
    docs = [(i, t or "", lang or "") for i, t, lang, *_ in rows]
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t] = min(least.get(t, i), i)
    judged = []
    for i, t, part in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = set()
        if len(words) < 100:
            fails.add("A")
        if 100 * len(set(words)) < 80 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 10 * len(t):
            fails.add("C")
        if re.search("[#$%&*|]", t):
            fails.add("D")
        if i is not None and least[t] < i:
            fails.add("E")
        good = any(d == i and q == 1 for d, q, _ in labels)
        toxic = any(d == i and x == 1 for d, _, x in labels)
        judged.append((part, fails, good, toxic))
    out, removed_by = [], {}
    for part in {j[0] for j in judged}:
        mine = [j for j in judged if j[0] == part]
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order):
                gone = [j for j in left if f in j[1]]
                left = [j for j in left if f not in j[1]]
                fails = sum(f in j[1] for j in mine)
                removed_by[part, f] = removed_by.get((part, f), 0) + len(gone)
                out.append(
                    (part, "".join(order), step + 1, len(left), len(gone), fails - len(gone), sum(j[1] == {f} for j in mine), sum(j[2] for j in gone), sum(j[3] for j in gone))
                )
    return sorted((*r, removed_by[r[0], r[1][r[2] - 1]]) for r in out)


def test_audit_equals_all_orders_applied(frame):
    long = " ".join(f"word{i}" for i in range(120))
    texts = [long, long, None, "", "SHORT TEXT", "a " * 150, long + " #", long.upper(), long, "x\x0by\x0cz", "É" * 30, "a b " * 90 + "$"]
    rows = [(i, t, [None, "en", "", "de"][i % 4], 7, "clash", 1) for i, t in enumerate(texts)]
    rows += [(None, long, "en", 0, "", 0), (3, long, "de", 0, "", 0), (3, long, "de", 0, "", 0)]
    labels = [(0, 1, 0), (1, 0, 1), (1, 1, 0), (4, None, 1), (5, 1, None), (None, 1, 1), (99, 1, 1)]
    found = interactions.filter_audit(frame(rows, DDL), frame(labels, "doc_id long, quality int, toxic int"))
    assert found.columns[:3] == ["part", "filter_order", "step"]
    assert sorted(tuple(r) for r in found.collect()) == plain(rows, labels)


def test_empty_table_has_no_parts(frame):
    docs, labels = frame([], DDL), frame([], "doc_id long, quality int, toxic int")
    assert interactions.filter_audit(docs, labels).count() == 0


@pytest.mark.parametrize("copies", [1, 3000])
def test_copies_of_a_hot_text_fail_but_the_first(spark, frame, copies):
    rows = [(i, "same", "en", 0, "", 0) for i in range(copies)] + [(-1, "other", "en", 0, "", 0)]
    everything, tables = interactions.failing_ids(frame(rows, DDL), frame([], "doc_id long, quality int, toxic int"))
    assert tables["E"].count() == copies - 1
    assert everything.count() == copies + 1
