"""A training corpus from raw documents, stage by stage on the operators of tidemark.llm."""

from __future__ import annotations

from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import exact, language, packing, pii, simhash
from tidemark.llm.frames import documents, settle, tokenizer_file
from tidemark.sources.tables import forget_settled, settled_apart

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A document is rejected when no language has this share of its words' probability.
LEAST_SHARE = 0.4


def language_id(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Without documents that have no letter or no prevailing language; ``lang`` is set where
    it was null."""
    guess = docs.withColumn("__guess", language.predict(docs, _model(docs)))
    kept = guess.filter((F.col("__guess.lang_pred") != language.UNKNOWN) & (F.col("__guess.score") >= LEAST_SHARE))
    return kept.withColumn("lang", F.coalesce("lang", "__guess.lang_pred")).drop("__guess")


def _model(docs: DataFrame) -> language.Model:
    return language.train(docs.filter(~language.held_out()), "doc_id", "text", "lang")


def exact_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return exact.drop_duplicates(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs, shingle=4, max_bits=4)


def private_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return pii.sanitise(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"), capacity=2048)


#: Folders that the last stage of this pipeline settled frames in.
_settled: ContextVar[tuple[str, ...]] = ContextVar("settled", default=())


def _stage(work: Stage) -> Stage:
    """A stage with its intermediate tables in a folder of its own. The stage before it has
    been written when this one begins, so what that one settled goes first: the pipeline needs
    room for the tables of one stage, not of all."""

    def stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
        for done in _settled.get():
            forget_settled(spark, done)
        with settled_apart(spark) as own:
            _settled.set((own,))
            return work(spark, docs, folder)

    return stage


STAGES = [
    ("language_id", _stage(language_id)),
    ("exact_dedup", _stage(exact_dedup)),
    ("simhash_near_dedup", _stage(simhash_near_dedup)),
    ("pii", _stage(private_data)),
    ("best_fit_packing", _stage(best_fit_packing)),
]

#: Models, tokenizers and components have no SQL; the tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages on the documents of a folder; each stage's result is written and read again,
    and goes when the next one's is written."""
    docs, before = documents(spark, folder), None
    for _, stage in STAGES[:-1]:
        result = stage(spark, docs, folder)
        with settled_apart(spark) as written:
            docs = settle(result)
        if before is not None:
            forget_settled(spark, before)
        before = written
    return STAGES[-1][1](spark, docs, folder)
