"""MERGE-style table updates as joins."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _one_row_per_key(source: DataFrame, keys, values) -> DataFrame:
    """Keys and `_new`, a struct of `values`; the job fails where a key has several rows."""
    found = source.groupBy(*keys).agg(F.count("*").alias("_n"), F.any_value(F.struct(*values)).alias("_v"))
    several = F.raise_error(F.lit("The source of a merge has several rows with one key."))
    return found.select(*keys, F.when(F.col("_n") > 1, several.cast(found.schema["_v"].dataType)).otherwise(F.col("_v")).alias("_new"))


def upsert(target: DataFrame, source: DataFrame, keys) -> DataFrame:
    """Rows of `target` replaced by matching rows of `source`, plus unmatched `source` rows.

    A key with several rows in `source` is an error.  Columns that `source` lacks keep their value
    (NULL in inserted rows).
    """
    incoming = _one_row_per_key(source, keys, source.columns)
    merged = target.select(*keys, F.struct(*target.columns).alias("_old")).join(
        incoming, list(keys), "full_outer"
    )
    from_source = F.col("_new").isNotNull()

    def pick(c):
        if c in keys:
            return F.col(c)
        if c not in source.columns:
            return F.col(f"_old.{c}").alias(c)
        return F.when(from_source, F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c)

    return merged.select(*[pick(c) for c in target.columns])


def update_from(target: DataFrame, source: DataFrame, keys) -> DataFrame:
    """Update matched rows of `target` with the columns of `source`; others stay unchanged.

    A key with several rows in `source` is an error.
    """
    values = [c for c in source.columns if c not in keys]
    incoming = _one_row_per_key(source, keys, values)
    return target.join(incoming, list(keys), "left").select(
        *[
            (
                F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}"))
                .otherwise(F.col(c))
                .cast(target.schema[c].dataType)
                .alias(c)
            )
            if c in values
            else F.col(c)
            for c in target.columns
        ]
    )
