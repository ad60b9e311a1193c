"""A corpus from raw documents to token ids: five stages, each written and read again.

Run ``run(spark, sf_dir)``; or apply ``STAGES`` in turn, each to what the one before kept.
Every stage works on whole tables and texts of any length, and none collects documents.
In each, null and empty texts are documents without words, repeated rows are treated
alike, an empty table stays empty, and columns of any name pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kinfold.llm import bpe, decontam, quality, simhash, substring
from kinfold.llm.common import discard, materialize, scratch, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality classifier rejects.

    Texts without words get the score of no words; without labels every score is a half
    and all documents stay.
    """
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each group of near duplicates.

    Texts without words are one group. Of rows with one id and text the least by their
    columns stays; a null id stays only where its group has no other.
    """
    return simhash.keep_first(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 50 words or more that a document with a lesser id has.

    Rows with one id cut nothing from each other; a null id comes last. No row is dropped:
    a text may become empty.
    """
    return substring.strip_repeats(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which benchmark passages make up a twentieth or more.

    Texts without words are never contaminated; test items without words have no passages.
    """
    return decontam.clean(docs, decontam.windows(table(spark, sf_dir, "benchmark")))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, with digests of the ids and of their decoding; a row per row.

    Null and empty texts have no ids.
    """
    return bpe.digests(docs, bpe.default_vocabulary(), with_ids=True)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("substrings", substring_stage),
    ("decontamination", decontamination_stage),
    ("encoding", encoding_stage),
]

#: A fitted classifier decides what the first stage keeps; SQL cannot express it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for all ``documents``. Only they stay in the shared folder."""
    docs = first = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scratch(spark):
            done = materialize(stage(spark, docs, sf_dir), f"stage-{name}", keep=True)
        if docs is not first:
            discard(docs)
        docs = done
    return docs
