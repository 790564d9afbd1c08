"""Corpus pipeline: five stages over ``documents``, each written and read again.

Every stage gets all rows its predecessor kept; all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from climark.llm.common import stored, table
from climark.llm.decontaminate import clean
from climark.llm.language_id import calibrate, keep_identified, learn
from climark.llm.ngram_jaccard import first_of_groups
from climark.llm.pack_sequences import pack_documents
from climark.llm.secret_scan import scan_secrets


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the profiles recognise; the profiles and the least
    cosines learn from the rows at hand, the held-out fold excepted."""
    return keep_identified(docs, calibrate(learn(docs), docs))


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the first by doc_id."""
    return first_of_groups(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return clean(docs, table(spark, sf_dir, "benchmark"), "documents")


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every secret span replaced; n_chars follows the new text."""
    scanned = scan_secrets(docs)
    text = F.when(F.col("text").isNotNull(), F.col("redacted_text"))
    changed = F.col("spans") != ""
    return scanned.select(*[
        text.alias("text") if c == "text" else
        F.when(changed, F.length("redacted_text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars")
        if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining texts in sequences of at most 2048 tokens."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", identified),
    ("near_duplicates", deduplicated),
    ("decontamination", decontaminated),
    ("secrets", without_secrets),
    ("packing", packed),
]

#: The stages learn, hash and pack in ways that SQL does not express; tests
#: compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each result stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
