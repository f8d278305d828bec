import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import quality

def rating():
    return F.col("quality") + 1 - F.col("toxic")



def test_held_out_grades(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").selectExpr("doc_id", "text", "1 AS p_top", "2 AS grade")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    graded = quality.grade(docs, labels.filter("doc_id % 3 <> 0"), rating())
    rows = graded.join(labels.filter("doc_id % 3 = 0"), "doc_id").select("expected_grade", "p_top", rating().alias("g")).toPandas()
    means = rows.groupby("g").expected_grade.mean()
    assert means[2] > means[1]
    assert ((rows.p_top >= 0.5) == (rows.g == 2)).mean() > (rows.g == 2).mean()
    assert rows.expected_grade.between(0, 2).all() and rows.p_top.between(0, 1).all()


def test_thresholds_are_ordered_and_marks_are_learnt():
    rng = np.random.default_rng(0)
    words = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(10) for j in range(10)]
    texts, grades = [], []
    for i in range(600):
        grade = i % 4
        texts.append(" ".join([*rng.choice(words, 40), *["awful"] * (3 - grade)]))
        grades.append(grade)
    model = quality.fit(texts, grades)
    assert (np.diff(model.thresholds) > 0).all() and model.grades == [0, 1, 2, 3]
    scores = quality._scores(model, ["awful awful awful " + " ".join(words[:40]), " ".join(words[:40]), None, ""])
    assert scores.expected_grade[0] < scores.expected_grade[1]
    assert scores.expected_grade[2] == scores.expected_grade[3]


def test_edge_cases(frame):
    docs = frame([(1, "a text", 1), (1, "a text", 1), (2, None, 2), (None, "", 3), (3, "w " * 50_000, 1)], "doc_id long, text string, selected int")
    labels = frame([(1, 1, 0), (1, 0, 1), (2, None, 0), (9, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    rows = quality.grade(docs, labels, rating()).collect()
    assert len(rows) == 5 and all(0 <= r["p_top"] <= 1 for r in rows)
    none = quality.grade(docs, labels.limit(0), rating()).collect()
    assert all(r["expected_grade"] == 0 and r["selected"] for r in none)
    assert quality.grade(docs.limit(0), labels, rating()).count() == 0


def test_marks_of_few_documents_are_learnt():
    rng = np.random.default_rng(1)
    words = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(10) for j in range(10)]
    insults = ["awful", "vile", "rotten"]
    texts = [" ".join(rng.choice(words, 40)) for _ in range(3000)]
    grades = [2] * 3000
    for i in range(0, 3000, 100):  # 1 % of the documents, 10 for each insult
        texts[i], grades[i] = f"{texts[i]} {insults[i // 100 % 3]}", 1
    model = quality.fit(texts, grades)
    clean = " ".join(rng.choice(words, 40))
    scores = quality._scores(model, [clean, *[f"{clean} {w}" for w in insults]])
    assert scores.p_top[0] >= 0.6 and (scores.p_top[1:] < 0.6).all()
