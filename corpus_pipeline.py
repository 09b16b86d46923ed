"""From raw documents to packed training sequences, in stages written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm import decontaminate, near_dedup, packing, quality_rules, secret_scan
from reviewloom.llm.queries import VOCABULARY
from reviewloom.llm.text import stored, table
from reviewloom.session import ship_package


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.good_documents(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near-duplicates: five-word shingles,
    similarity 0.8 or more."""
    ship_package(spark)
    return near_dedup.without_copies(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that don't hold a benchmark passage."""
    ship_package(spark)
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; secrets in their texts give way to a mark, and ``n_chars`` follows."""
    out = secret_scan.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    ship_package(spark)
    pieces = packing.token_pieces(docs, VOCABULARY)
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


STAGES = [
    ("quality_rules", good_quality),
    ("near_dedup", one_of_each),
    ("decontamination", uncontaminated),
    ("secret_scan", without_secrets),
    ("packing", packed),
]

# Packing counts tokens of a byte-pair vocabulary, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written before the next reads them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
