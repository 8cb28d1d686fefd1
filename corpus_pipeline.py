"""Corpus preparation: five stages, each one operator of ``glyphledger.llm`` over all its predecessor kept.

Language identification, SimHash near-duplicates, repeated passages, personal
data, packing. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphledger.llm.op02_packing import pack_documents
from glyphledger.llm.op03_substrings import remove_repeats
from glyphledger.llm.op05_personal import candidates, mask, train
from glyphledger.llm.op07_simhash import near_duplicates
from glyphledger.llm.op09_language import Profiles, accept, learn_profiles, training_rows
from glyphledger.llm.queries import tokenizer_path
from glyphledger.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _counted(docs: DataFrame) -> DataFrame:
    """The columns of ``documents`` with ``n_chars`` counted anew; null texts stay null."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, and those unlike every learned language, go."""
    profiles = Profiles.collect(learn_profiles(training_rows(docs)))
    return accept(docs.select(*COLUMNS), profiles)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, that with the least id."""
    return near_duplicates(docs.select(*COLUMNS))


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words under repeated windows are cut out; every document stays, if only with an empty text."""
    return _counted(remove_repeats(docs.select(*COLUMNS)))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets."""
    model = train(candidates(docs))
    return _counted(mask(docs.select(*COLUMNS), model))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their places in packed sequences."""
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("passages", passage_stage),
    ("personal_data", personal_data_stage),
    ("packing", packing_stage),
]

# Neither the fingerprints nor the tokenizer can be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
