"""From raw documents to token ids: the stages of the training-data pipeline.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of `documents`.  `run` writes each stage's result and reads it again for the next.
Null and empty texts, repeated rows, empty tables and extra columns are handled as the
operators say; extra columns are carried up to the mix.
"""

import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from duebook.llm import bpe, language, lines, mixing, near_dup  # noqa: E402
from duebook.storage import materialize  # noqa: E402


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is close enough to a centroid of some language."""
    model = language.fit(language.training(docs))
    return language.predict(docs, model).where(~F.col("rejected")).select("_row.*")


def remove_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts without the lines that many sites share."""
    row = F.col("_row").withField("text", F.col("text"))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.length("text").cast("long"))
    return lines.line_dedup(docs).select(row.alias("_row")).select("_row.*")


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, 0.8)."""
    return near_dup.dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit) and digests of ids and decoded bytes."""
    return bpe.digests(docs, ids=True)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", remove_boilerplate),
    ("near_dedup", remove_near_duplicates),
    ("mix_sources", mix_sources),
    ("bpe", tokenize),
]

#: Clustered centroids cannot be expressed in SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents` of the folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
