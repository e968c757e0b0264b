"""Helpers that several of the operators share."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Words of a text in order; a null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES + "+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """`_id` and `_fp`: never null, the same for equal rows only (id, and a fingerprint of the text).

    Rows that repeat id and text share a key on purpose: whatever is found for one of them
    holds for the other.
    """
    i, t = F.col(doc_id), F.col(text)
    return [
        F.coalesce(i, F.lit(0)).cast("long").alias("_id"),
        F.xxhash64(t, i.isNull(), t.isNull()).alias("_fp"),
    ]


def packed(df: DataFrame) -> Column:
    """All columns of `df` in one, so that no helper column can clash with theirs."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")


def read(spark, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def small_batches(batches, rows: int = 256):
    """Arrow batches cut to `rows` rows, which bounds what a task holds besides its input."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
