"""The corpus pipeline: five stages, each over all that the one before it kept.

Every stage takes (spark, docs, sf_dir); what it returns is written as Parquet and read again as the ``docs`` of the
next. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm.chosen_path import without_near_duplicates
from riskloom.llm.common import table, written
from riskloom.llm.decontaminate import uncontaminated
from riskloom.llm.mixing import mixed
from riskloom.llm.quality import accepted
from riskloom.llm.token_orc import default_tokenizer, token_orc


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return accepted(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8) the document with the smallest id stays."""
    return without_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document comes as often as the mix of the sources takes it."""
    return mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The corpus as token ids in ORC files; a row for each document in them."""
    return token_orc(docs, default_tokenizer())


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: the fitted classifier, minwise joins, BM25 retrieval and the tokenizer are not SQL
ORACLE_SQL = None
