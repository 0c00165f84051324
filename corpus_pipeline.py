"""From documents to batches: language, near duplicates, benchmark leaks, personal data, packing.

STAGES lists the stages; each takes (spark, docs, sf_dir) and returns a DataFrame, all but the last with the columns
of documents. run() writes each stage's result as Parquet and gives it to the next one.

ORACLE_SQL is None: learned filters, alignment and the tagger aren't SQL; the stages are tested against brute force."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.llm import jaccard, language, leaks, packing, pii, tokens
from trawl.llm.common import staged, table

ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no language that was learned go."""
    return language.accept(docs, language.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word shingles stays."""
    return jaccard.one_of_each(docs, words=5, part=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return leaks.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; n_chars follows."""
    out = pii.mask(docs, pii.fit(docs))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document is packed: bucket, batch and slot. Lengths are tokens, with the end id."""
    lengths = tokens.lengths(docs, public_tokenizers.path("word_bpe_49k.json"), lean=True)
    return packing.pack(lengths, buckets=16, budget=65_536, length=lengths["n_tokens"])


STAGES = [("language", language_id), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("personal_data", personal_data), ("packing", batches)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = staged(docs, name)
    return docs
