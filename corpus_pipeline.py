"""Corpus pipeline over ``documents``: five stages, each written and read again before the next.

Toxic documents go, then those whose language cannot be told, then all but one of each group
of near copies, then those with a benchmark passage; what is left is encoded, decoded and compared. All
stages but the last return their input's columns. A stage keeps null texts unless its own rule
rejects them: language identification does, as it rejects every text without a letter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierlake.llm import decontaminate, language, near_copies, tokens, toxicity
from tierlake.llm.common import masked, prepare, read_table
from tierlake.llm.unigram import load
from tierlake.sources.staging import Staging

#: Texts whose best language is less likely than this are rejected.
LANGUAGE_FROM = 0.4


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not predict as toxic."""
    prepare(spark)
    docs, restore = masked(docs, ("doc_id", "text"))
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"), Staging(spark))
    return restore(toxicity.score(docs, model).filter("predicted = 0"))


def drop_unidentified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with enough certainty."""
    prepare(spark)
    docs, restore = masked(docs, ("doc_id", "text", "lang"))
    net = language.fit(docs, Staging(spark))
    sure = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LANGUAGE_FROM)
    return restore(language.identify(docs, net).filter(sure))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a five-word similarity of at least 0.8: fingerprints give
    candidates, shared shingles those that fingerprints miss, and all are compared exactly."""
    prepare(spark)
    docs, restore = masked(docs, ("doc_id", "text"))
    return restore(near_copies.keep_one(docs, Staging(spark)))


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    prepare(spark)
    docs, restore = masked(docs, ("doc_id", "text"))
    return restore(decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"), staging=Staging(spark)))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether they decode to it."""
    prepare(spark)
    back = tokens.encode(docs.select("doc_id", "text"), load(), Staging(spark), decoded=True)
    return back.select(
        "doc_id",
        F.coalesce(F.size("ids"), F.lit(0)).alias("n_tokens"),
        "ids",
        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_unidentified),
    ("near_copies", drop_near_copies),
    ("benchmark", drop_leaked),
    ("tokens", tokenize),
]

# Learned, iterative and tokenizing stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each stage's result is written to the shared folder."""
    staging = Staging(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staging.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
