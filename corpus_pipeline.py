"""From raw documents to a training mixture, a stage at a time.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept; each
result is written to the shared scratch folder as Parquet and read again, so a lost executor
costs one stage at most.  All stages but the last return the columns of `documents`.

1. language: a document in none of the labelled languages goes (no letters, null text, letter
   noise, languages never learnt); texts of a few letters get the benefit of the doubt;
2. near copies: of each group of texts that share 80 % of their word 5-grams the row with the
   smallest id stays;
3. decontamination: a document that holds a benchmark item, exact or edited, goes;
4. secrets: every finding is replaced by a mark, and n_chars follows; no document goes;
5. mixing: documents are repeated or left out until the sources have their target weights; the
   columns mix_* say in which epoch, block and place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import decontam, jaccard, langid, mixing, secrets
from tradewind.llm.common import fresh, stored, table
from tradewind.session import scratch_path

# At 0 a one-versus-rest classifier denies a text, at 1 it claims it.  Short clean texts may lie
# near 0.5; below this value even the nearest language is denied.  Noise lies near 0.5 as well and
# is left to the familiarity of its grams.
LANGUAGE_SCORE = 0.25


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.fit(docs, "text", "lang", "doc_id", familiar=True)
    pred, score, foreign = fresh("pred"), fresh("score"), fresh("foreign")
    found = langid.predict(docs, "text", model, pred, score, foreign)
    claimed = (F.col(pred) != langid.UNKNOWN) & (F.col(score) >= LANGUAGE_SCORE) & ~F.col(foreign)
    return found.where(claimed).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs, "text", "doc_id", jaccard.Rule(shingle=5, share=80))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.without_leaks(docs, "text", table(spark, sf_dir, "benchmark"))


def remove_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    spans = fresh("spans")
    found = secrets.attach_spans(docs, "text", scratch_path(spark, "ledger"), into=spans)
    found = found.withColumn("text", secrets.redact(F.col("text"), F.col(spans)))
    n_chars = F.when(F.size(spans) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType)).select(
        *docs.columns
    )


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_copies", near_copies),
    ("decontamination", decontaminate),
    ("secrets", remove_secrets),
    ("mixing", mix_sources),
]

# Trained scores and alignments have no SQL; tests/llm/test_pipeline.py has a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
