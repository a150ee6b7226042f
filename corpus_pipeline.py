"""The corpus pipeline: quality classifier, near-duplicates, mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from churnlake.llm import bestfit, kn_quality, mixing, simhash
from churnlake.llm.common import materialise, table
from churnlake.llm.queries import vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the n-gram model, trained on the labelled good documents
    among ``docs``, finds no less fluent than their language's threshold. Documents
    without text, or of a language without trusted text, stay; null languages count
    as one. No documents or no labels: all stay."""
    return kn_quality.keep_clean(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (SimHash over three-word
    shingles, two bits): the one of the smallest doc_id. Null and empty texts are
    copies of each other; rows without an id come after those with one. No documents:
    none."""
    return simhash.keep_one(docs, k=3, radius=2)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their mixing weights: every document once at least, documents
    of small sources up to twice (a row for each time). A null source is a source,
    and a null text one token long. No documents: none."""
    return mixing.mixed(docs, repeat_limit=2.0)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of 4096 tokens. Null and empty
    texts are one piece of one token; very long texts are cut into pieces; every row
    is a document. No documents: no rows."""
    return bestfit.pack(docs, vocabulary("word_bpe_49k.json"), "word", end_id=1, capacity=4096)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("mix", mix), ("pack", pack)]

#: Trained models, hash sketches and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
