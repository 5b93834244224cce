"""Corpus pipeline: the training-data operators in a row over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it
kept, and is written as Parquet and read again before the next; the tables
that it wrote on the way and what it read of the stage before go then. All but
the last return the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import decontaminate, jaccard_join, line_dedup, quality
from lodestar.llm.common import delete_tables, materialise, read_table, written_tables
from lodestar.llm.queries import pack_documents


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.drop_rejected(docs, read_table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go; n_chars follows the text. The other
    columns stay as they are, whatever their names."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    out = line_dedup.drop_recurring_lines(
        docs.toDF(*names), id_col=names[docs.columns.index("doc_id")],
        text_col=names[docs.columns.index("text")])
    kept = out.select(*names).toDF(*docs.columns)
    return kept.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns \
        else kept


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles,
    Jaccard similarity 0.8 or more) stays: the one with the smallest id."""
    return jaccard_join.keep_one_per_component(docs, n=5, percent=80)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten words in a row of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences, with their ids."""
    return pack_documents(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup_stage),
    ("jaccard_join", jaccard_stage),
    ("decontaminate", decontaminate_stage),
    ("packing", packing_stage),
]

#: The first stage is a fitted model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = read_table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with written_tables() as tables:
            docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
        delete_tables(spark, before + tables[:-1])
        before = tables[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)
