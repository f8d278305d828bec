import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle

DDL = "doc_id long, text string, slice int, mark string"


def brute(rows):
    """(n_chars, sha256 of the edited text, next text) per row, in the documented order."""
    low = -(1 << 63)
    key = [low if d is None else d for d, *_ in rows]
    order = sorted(set(key), reverse=True)
    first = {k: min((r[1] or "") for r, x in zip(rows, key) if x == k) for k in order}
    out = []
    for (d, t, *_), k in zip(rows, key):
        after = first[order[(order.index(k) + 1) % len(order)]]
        t = t or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bits", [3, 10])
def test_next_document_and_edited_text(frame, monkeypatch, bits):
    monkeypatch.setattr(merkle, "SLICE_BITS", bits)
    ids = [5, 4, 3, 0, -7, 1 << 60, (1 << 60) + 3, -(1 << 61), 900, 901, 77]
    rows = [(d, f"text {d}. And é\U0001f600 more.\nline {d * 3}\n\nsection", 1, "clash") for d in ids]
    rows += [(5, "repeated id", 1, ""), (5, "repeated id", 1, ""), (None, None, 1, ""), (12, "", 1, ""), (13, "x" * 50_000, 1, "")]
    got = merkle.edited_pairs(frame(rows, DDL)).collect()
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=repr) == brute(rows)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)


def test_one_document_follows_itself_and_empty_table(frame):
    row = merkle.edited_pairs(frame([(1, "abcdef", 0, "")], DDL)).first()
    assert row["edited_sha256"] == hashlib.sha256(b"abcabc").hexdigest() and row["near_next"] == 1
    assert merkle.edited_pairs(frame([], DDL)).count() == 0


def test_roots_test_equality_and_branches_locate_edits(frame):
    one = "head\n\nfirst par. two.\nsecond par.\n\nlast"
    texts = [one, one, one.replace("second", "other"), one.replace("\n\n", "\n"), None, ""]
    df = frame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    marks = {r["i"]: r["m"] for r in df.select("i", merkle.fingerprint(merkle.tree(F.col("text"))).alias("m")).collect()}
    assert marks[0] == marks[1] and marks[4] == marks[5]
    assert len({marks[i][:64] for i in (0, 2, 3, 4)}) == 4
    pair = frame([(texts[0], texts[2], texts[1])], "a string, b string, c string")
    row = pair.select(
        merkle.edits(merkle.tree(F.col("a")), merkle.tree(F.col("b"))).alias("b"),
        merkle.edits(merkle.tree(F.col("a")), merkle.tree(F.col("c"))).alias("c"),
    ).first()
    assert [tuple(x) for x in row["b"]] == [(1, 1)] and row["c"] == []


def test_native_plan(frame):
    plan = merkle.edited_pairs(frame([(1, "a", 0, ""), (2, "b", 0, "")], DDL))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
