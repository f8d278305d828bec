import zlib

import numpy as np

from tidemark.llm import language


def test_forward_backward_equals_a_plain_recursion(monkeypatch):
    monkeypatch.setattr(language, "BLOCK", 4)
    rng = np.random.default_rng(0)
    scores, moves = rng.normal(size=(30, 3)) * 3, rng.normal(size=(3, 3))
    doc = np.array([0] * 10 + [1] + [2] * 19)
    want = []
    for d in range(3):
        e = np.exp(scores[doc == d])
        a, b = [e[0]], [np.ones(3)]
        for row in e[1:]:
            a.append((a[-1] @ np.exp(moves)) * row)
        for row in e[:0:-1]:
            b.insert(0, np.exp(moves) @ (row * b[0]))
        m = np.array(a) * np.array(b)
        want.append(m / m.sum(axis=1, keepdims=True))
    assert np.allclose(language.forward_backward(scores, doc, moves), np.concatenate(want))


def test_held_out_accuracy_and_edge_cases(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    odd = [(10**6, None, None), (10**6 + 1, "", "en"), (10**6 + 2, "1234 !!", "en"), (None, "the and of", None), (10**6 + 3, "the of and " * 30_000, None)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    rows = language.identify(docs.selectExpr("*", "1 AS score", "2 AS place")).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert 0 <= r["score"] <= 1
        assert r["doc_id"] is None or r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    by_id = {r["doc_id"]: r for r in rows}
    assert all(by_id[10**6 + i]["lang_pred"] == "und" and by_id[10**6 + i]["score"] == 0 for i in range(3))
    assert by_id[10**6 + 3]["lang_pred"] == "en" and by_id[None]["lang_pred"] == "en"
    held = [r for r in rows if r["held_out"] and r["lang"] and r["lang_pred"] != "und"]
    assert len(held) > 20 and np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.97


def test_runs_of_a_text_that_switches(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = language.train(docs, "doc_id", "text", "lang")
    text = "the and that with for this are from der die und nicht ein das mit sich"
    df = spark.createDataFrame([(text,), (None,), ("",)], "text string")
    runs = [r[0] for r in df.select(language.label_words(df, model)).collect()]
    assert runs[1] == runs[2] == []
    assert [r["lang"] for r in runs[0]] == ["en", "de"]
    assert text[runs[0][1]["start"] : runs[0][1]["end"]].startswith("der die")


def test_nothing_to_learn_from(spark, frame):
    ddl = "doc_id long, text string, lang string"
    assert language.identify(frame([], ddl)).count() == 0
    rows = language.identify(frame([(1, "some words", None)], ddl)).collect()
    assert rows[0]["lang_pred"] == "und" and rows[0]["score"] == 0
