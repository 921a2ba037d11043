"""A training corpus from documents: each stage works on all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.llm.jaccard_join import link_components
from tickerloom.llm.packing import pack_documents
from tickerloom.llm.pseudonyms import pseudonymise
from tickerloom.llm.quality_net import score, train
from tickerloom.llm.suffix_dedup import remove_repeats
from tickerloom.llm.texts import documents
from tickerloom.sources.workspace import workspace

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Near duplicates share 80 % of their runs of five words.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def _columns(docs: DataFrame) -> DataFrame:
    """The columns of documents, with the length of the text as it is now."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops rows whose text the quality network, fitted to the labelled ones, rejects.

    Null texts are scored as empty ones.
    """
    network = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), lambda doc_id: F.lit(True))
    return score(docs, network, (*COLUMNS,)).filter("predicted = 1").select(*COLUMNS)


def keep_one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps, of each group of near duplicates, the document with the smallest doc_id.

    Texts without words are in no group and stay; so do rows without a doc_id.  Rows of one
    doc_id are one document and stay or go together.
    """
    groups = link_components(docs, NEAR_WORDS, NEAR_PERCENT)
    dropped = groups.filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes strings of 200 bytes that occur more than once; all rows stay.

    A cut may fall inside a character; what is left of it goes too.  Null texts stay null.
    """
    others = tuple(c for c in COLUMNS if c != "text")
    cut = remove_repeats(docs.withColumn("_null", F.col("text").isNull()), (*others, "_null"), as_text=True)
    return _columns(cut.withColumn("text", F.when(~F.col("_null"), F.col("kept"))))


def hide_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by pseudonyms; all rows stay."""
    return _columns(pseudonymise(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", keep_quality),
    ("ngram_jaccard_join", keep_one_of_near),
    ("suffix_array_dedup", cut_repeats),
    ("pii", hide_private),
    ("packing", pack),
]

#: A network's scores and tokenisation are beyond SQL; tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written and read again."""
    folder = workspace(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
