"""Training-data pipeline: documents to token ids, in five stages.

Every stage is one operator of ``reviewlake.llm`` and works on all rows that
the stage before it kept, written as Parquet and read again in between:

1. language_id      documents that no learned language claims go
2. line_dedup       repeated three-line windows go; so does a document of
                    which no word is left
3. near_duplicates  five-word shingles, Jaccard 0.8: one document per group stays
4. mixing           each source is read towards its target weight: rows repeat
                    or go
5. encoding         byte-level BPE ids of what is left, with the digest of the
                    bytes that they decode to

All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.llm import bpe, langid, line_dedup, mixing, ngram_join
from reviewlake.llm.common import written
from reviewlake.session import table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.known_language(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.deduped_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.first_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = docs.select("doc_id", "source", bpe.round_trip(F.col("text"), *bpe.public_vocabulary()).alias("coded"))
    return coded.select("doc_id", "source", F.floor(F.octet_length("coded.ids") / 4).cast("long").alias("n_tokens"),
                        F.col("coded.ids").alias("ids"), F.sha2("coded.ids", 256).alias("ids_sha256"),
                        F.sha2("coded.decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", dedup_lines),
    ("near_duplicates", near_duplicates),
    ("mixing", mix),
    ("encoding", encoding),
]

#: Language ID and encoding can't be written in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
