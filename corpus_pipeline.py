"""Documents to training sequences, in five stages.

Defined results of every stage: a NULL text is an empty text, NULL identifiers are kept
and come first in an order, rows may repeat, an empty table gives no rows, and other
columns pass unchanged whatever they are named (the last stage returns its own).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, packing, simhash, substrings, toxicity
from tidemark.llm.common import prepare, stored
from tidemark.llm.queries import WORD_BPE


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that the string kernel scores as toxic. Texts without words
    stay as far as the fit calls them clean; without labels of both kinds all stay."""
    labels = prepare(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, labels)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z as a-z) the row with the largest identifier stays; of equal
    identifiers the one that stands last in the files, NULL only if there is no other."""
    prepare(spark)
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar texts the smallest identifier stays (then the smaller
    hash of the text). Texts without words are similar to none and stay; rows equal in
    identifier and text stay or go together."""
    prepare(spark)
    return simhash.without_near_duplicates(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without passages of 20 words or more that stand in an earlier document, or
    earlier in the same one. Earlier is by identifier, NULL first, then by a hash of the
    text; documents that lose all words stay, with an empty text."""
    prepare(spark)
    cut = substrings.without_repeats(docs)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of 4096 ids. An empty
    text is one piece, the end id."""
    prepare(spark)
    placed = packing.pack_documents(docs, WORD_BPE)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("packing", pack),
]

#: None of the stages but the second can be said in SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
