from tests.conftest import rows_of
from tidemark.llm import exact

DDL = "doc_id long, text string, rid int, rest string"


def brute(rows):
    best, size = {}, {}
    for doc_id, text, *_ in rows:
        text = text or ""
        size[text] = size.get(text, 0) + 1
        best[text] = max(best.get(text, float("-inf")), float("-inf") if doc_id is None else doc_id)
    return {t: (None if b == float("-inf") else b, size[t]) for t, b in best.items()}


def test_groups_equal_a_plain_grouping(frame):
    long = "x" * 70_000
    texts = ["", None, "a", "a\0", "a" * 64, "a" * 65, "a" * 64 + "b", long, long + "é", long, "é" * 40, "é" * 40]
    rows = [(i, t, 1, "clash") for i, t in enumerate(texts)] + [(None, "a", 1, ""), (99, "a", 1, ""), (99, "a", 1, "")]
    rows += [(1000 + i, "third of all", 1, "") for i in range(20)]
    got = exact.duplicate_groups(frame(rows, DDL)).collect()
    assert len(got) == len(rows)
    want = brute(rows)
    by_id = {}
    for doc_id, text, *_ in rows:
        by_id[doc_id] = want[text or ""]
    for r in got:
        assert (r["keep_id"], r["group_size"]) == by_id[r["doc_id"]]
        assert len(r["text_sha256"]) == 64
    assert sum(r["kept"] for r in got) == len(want)


def test_kept_rows_keep_all_columns(frame):
    rows = [(1, "x", 7, "clash"), (2, "x", 8, "other"), (3, None, None, None)]
    df = frame(rows, DDL)
    kept = exact.drop_duplicates(df)
    assert kept.columns == df.columns
    assert rows_of(kept) == sorted([rows[1], rows[2]], key=repr)


def test_empty_table(frame):
    assert exact.duplicate_groups(frame([], DDL)).count() == 0
