"""Corpus pipeline: documents in, a mixed training corpus out.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before
kept, and returns a DataFrame that is written as Parquet and read back for the
next one. All but the last return the columns of documents:

1. language_id: documents whose language can't be told go;
2. line_dedup: lines that copy an earlier line leave their documents;
3. simhash_near_dedup: one document of each near-duplicate group stays;
4. decontamination: documents that hold a benchmark window go;
5. mixing: the documents as often as the source targets ask, with shard and copy.

An empty documents table runs through every stage and gives an empty result.
Extra columns of documents are carried along to the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadrisk.llm import decontam, langid, linededup, mixing, simhash
from roadrisk.llm.common import stored, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.accepted_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("decontamination", decontamination),
    ("mixing", mix),
]

#: Compression sizes, hash components and the splitting tree have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
