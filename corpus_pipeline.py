"""Corpus pipeline: quality rules, language, near duplicates, packing.

Every stage but the last takes documents and returns those it keeps, with all their columns. The
stages are run one after the other on written tables, so each works on what the one before kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctrisk.llm import jaccard, language, packing, rules
from acctrisk.llm.common import materialise, table

# A language counts as known from this score on. Texts that switch languages score about 0.3 and
# more, so only texts in none of the learnt languages fall below.
MIN_LANGUAGE = 0.2
# The number of a row among those that near duplicates are sought in.
ROW = "_row_of_stage"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the isolation forest keep.

    The forest's threshold is calibrated on the labelled rows among these documents.
    """
    measured = materialise(rules.measure(docs))
    return rules.keep(docs, rules.fit(measured, table(spark, sf_dir, "labels")))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learnt from `lang`; texts without a letter go."""
    return language.keep(docs, language.fit(docs), MIN_LANGUAGE)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of near duplicates: the smallest doc_id, null ids last.

    Rows are told apart by numbers of their own, so null and repeated ids lose no text. Rows
    without a word are near duplicates of nothing; of those that have equal ids and texts one
    stays.
    """
    rows = materialise(docs.withColumn(ROW, F.monotonically_increasing_id()))
    blank = F.when(F.col("text").rlike(r"^[\x20\x09-\x0D]*\z"), F.sha2("text", 256))
    ids = rows.select(ROW, "doc_id", blank.alias("blank"))
    joined = jaccard.join(rows.select(F.col(ROW).alias("doc_id"), "text")).documents
    joined = joined.select(F.col("doc_id").alias(ROW), "component_id", "n_shingles").join(ids, ROW)
    repeated = (F.col("n_shingles") == 0) & F.col("doc_id").isNotNull()
    kept = (
        joined.groupBy(F.when(~repeated, F.col("component_id")).alias("component"),
                       F.when(repeated, F.col("doc_id")).alias("id"),
                       F.when(repeated, F.col("blank")).alias("blank"))
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", ROW)).alias("first"))
        .select(F.col("first")[ROW].alias(ROW))
    )
    return rows.join(kept, ROW, "left_semi").select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Kept documents as pieces of sequences of at most 1024 tokens."""
    return packing.pack(docs, added=True)


STAGES = [
    ("quality rules", quality_rules), ("language", known_language),
    ("near duplicates", one_of_each_group), ("packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
