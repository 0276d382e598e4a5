"""A corpus pipeline over the text operators: each stage's rows are written and read again before the next.

Toxic documents go, one document of each near-duplicate group stays, repeated passages and benchmark passages are cut (documents
that are benchmark text for a twentieth or more go), and what is left is packed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voltmart.llm import decontaminate, packing, simhash, suffix_dedup, toxicity
from voltmart.llm.common import documents
from voltmart.session import materialize

#: The models, hashes and tokenizer have no SQL form; the stages are tested against brute force instead.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic; texts without words, null ones too, stay. Equal texts share a verdict;
    without labels of both classes, and of an empty table, all rows stay.
    """
    return toxicity.keep_ordinary(docs, documents(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group: that of the smallest id, null ids last, of equal ids the least text hash;
    repeated rows once.
    """
    return simhash.deduplicate(docs, keep_unnamed=False)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, texts without bytes that repeat earlier ones. A null text stays null; a text repeated
    throughout becomes empty.
    """
    return suffix_dedup.remove(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not benchmark text, hit passages cut. Null and empty texts have no words and stay;
    repeated rows all stay or all go.
    """
    return decontaminate.decontaminate(docs, documents(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece with its ids. A null or empty text is the end id alone; repeated rows are packed each."""
    return packing.pack(docs, with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", cut_repeats),
    ("decontamination", drop_benchmark),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage. Further columns of ``documents`` are carried along until packing; an empty table
    gives no rows.
    """
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
