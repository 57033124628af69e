"""From raw documents to packed training sequences, in five stages.

Each stage takes what its predecessor kept and calls one operator of ``ledgerloom.llm``:
documents of no language go, one document of each group of near copies stays, secrets are
masked, sources are mixed to their target weights (documents come as often as they are
taken), and the texts are packed into sequences of tokens. All stages but the last return
the columns of documents. ``run`` writes each stage's result and reads it back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers
from ledgerloom.llm.common import stored, table
from ledgerloom.llm.jaccard_join import one_of_each_group
from ledgerloom.llm.language_id import identify_languages, train_languages
from ledgerloom.llm.packing import pack_documents
from ledgerloom.llm.secret_automaton import mask_secrets
from ledgerloom.llm.source_mixing import mixed_documents


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; trained on the labelled rows of ``docs``."""
    named = identify_languages(docs, train_languages(docs))
    return named.where("not rejected").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links connect: the one with the smallest id."""
    return one_of_each_group(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked by their kind."""
    return mask_secrets(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences of 4096 tokens."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixing", mixing),
    ("packing", packing),
]

#: SQL can't express compression, automata or packing; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
