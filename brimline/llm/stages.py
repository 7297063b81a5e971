"""The pipeline's stages: ``(spark, docs, sf_dir) -> DataFrame``, each on all rows it gets.

All but packing return the columns of ``docs``. Which rows or texts change:
``drop_poor_documents`` drops rejected documents and takes lines above their host's limit out
of the others; ``drop_near_copies`` leaves one document of each group; ``hide_secrets`` masks
spans and drops nothing; ``mix_sources`` samples by source, language and topic.

Nulls, empty and long texts, ties, repeated rows and columns of any other name are as in the
operator a stage calls: a NULL text is empty, so it is rejected for its few words; NULL ids are
kept; repeated rows count each in the rules, are one document to the near copies, and share their
draw in the mix. An empty table stays empty through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from brimline.llm import line_rules, mixing, packing, secret_scan, simhash
from brimline.llm.common import prepared
from brimline.llm.tokens import VOCABULARY


def drop_poor_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without their host's frequent lines."""
    return line_rules.cleaned(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    prepared(spark)
    return simhash.one_of_each(docs)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked by models learned from these documents."""
    models = secret_scan.train(secret_scan.labelled_tokens(docs))
    return secret_scan.masked(docs, models)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn with the probabilities that bring the margins to their targets."""
    return mixing.kept_documents(docs)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    prepared(spark)
    return packing.pack(docs, VOCABULARY)
