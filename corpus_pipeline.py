"""Corpus pipeline over ``documents``: language ID, near duplicates, repeated passages, mixing, packing.

Every stage takes (spark, docs, sf_dir); its result is written as Parquet and
read again as the next one's ``docs``. All but the last return the columns of
``docs``. A stage bounds the session's Arrow batches by their bytes, and leaves
it so: the frame that it returns runs later.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroperf.llm import jaccard, language, mixing, packing, passages
from aeroperf.llm.columns import fresh
from aeroperf.llm.id_filter import without_listed
from aeroperf.llm.queries import TOKENIZER
from aeroperf.llm.storage import stored
from aeroperf.llm.workers import bounded_batches

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _bounded(stage: Stage) -> Stage:
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bounded_batches(spark)
        return stage(spark, docs, sf_dir)

    return run


@_bounded
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter; only those without one (``und``) go. The model is fitted on the stage's own labelled documents; where none is labelled, texts with a letter stay all the same."""
    model = language.train_language_model(docs)
    if not model.langs:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    names = fresh(docs, "lang_pred", "score")
    return language.identify(docs, model, names=tuple(names)).where(F.col(names[0]) != "und").select(docs.columns)


@_bounded
def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more over 5-word shingles, that with the smallest id. Documents without an id stay."""
    groups = jaccard.jaccard_components(docs, k=5, num=8, den=10)
    copies = stored(groups.where("component_id <> doc_id").select("doc_id"), "copies")
    return without_listed(docs, "doc_id", copies)


@_bounded
def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that other documents keep are cut out; a document of nothing else goes. n_chars follows the text."""
    spans = stored(passages.repeated_passages(docs), "spans")
    cut = passages.cut_passages(docs, spans)
    emptied = (F.col("text") == "") & (F.col("n_chars") > 0)
    out = cut.where(~F.coalesce(emptied, F.lit(False)))
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(docs.columns)


@_bounded
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them: at least once each, at most 1.25 times by source, shares in the tokens that are packed."""
    return mixing.mix(docs, TOKENIZER, max_epochs=1.25, names=tuple(fresh(docs, "epoch", "mix_weight", "mix_order"))).select(docs.columns)


@_bounded
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("language_id", known_language),
    ("near_duplicates", one_of_each),
    ("repeated_passages", without_repeats),
    ("mixing", mixed),
    ("packing", packed),
]

#: The stages cannot be expressed in SQL; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
