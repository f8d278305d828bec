import re
from collections import defaultdict

import corpus_pipeline
import pytest
from tests.llm.test_pii import plain_spans
from tests.llm.test_simhash import brute_classes, brute_print

from tidemark.llm import queries
from tidemark.llm.frames import settle


@pytest.fixture(scope="module")
def packed(spark, folder):
    return corpus_pipeline.run(spark, folder).collect()


def test_documents_that_come_through(spark, folder, packed):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    by_text = defaultdict(list)
    for r in rows:
        if re.search(r"[^\W\d_]", r["text"] or ""):
            by_text[r["text"]].append(r["doc_id"])
    kept = {max(ids): text for text, ids in by_text.items()}
    prints = {i: brute_print(t) for i, t in kept.items()}
    classes = brute_classes(set(prints.values()))
    least = defaultdict(lambda: float("inf"))
    for i, p in prints.items():
        least[classes[p]] = min(least[classes[p]], i)
    assert {r["doc_id"] for r in packed} == set(least.values())


def test_sequences(packed):
    sequences = defaultdict(list)
    for r in packed:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_stages_keep_the_columns_of_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(60)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = settle(stage(spark, docs, folder))  # written and read again, as the contract says
        assert docs.columns == columns, name
    plain = [r["text"] for r in docs.collect()]
    assert not any(plain_spans(t) for t in plain)


def test_every_operator_has_its_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5
