"""Tables bucketed alike on one key, so that joins and groupings on it need no shuffle.

A key with a large share of all rows would fill its bucket.  Such keys (at most 1 / share of
them) are kept apart in plain files, where partial sums and skew joins spread them.
"""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook.storage import materialize, new_path

SHARE = 0.001


class Colocated:
    """`frames` stored by `key`: `cold[name]` in buckets, `hot[name]` in plain files."""

    def __init__(self, spark: SparkSession, frames: dict[str, DataFrame], key: str, buckets: int, share: float = SHARE):
        self.key, self.cold, self.hot, self._names = key, {}, {}, []
        self.hot_keys = materialize(_hot_keys(frames, key, share), "hot-keys")
        for name, df in frames.items():
            hot = F.broadcast(self.hot_keys)  # at most 1 / share rows per table
            self.hot[name] = materialize(df.join(hot, key, "left_semi"), f"hot-{name}")
            self.cold[name] = self._bucketed(spark, df.join(hot, key, "left_anti"), name, buckets)

    def _bucketed(self, spark, df, name, buckets):
        # Hashed as the buckets are, so every bucket is one file, written by one task.
        table = f"{name}_{uuid.uuid4().hex[:12]}"
        (
            df.repartition(buckets, self.key).write.bucketBy(buckets, self.key).sortBy(self.key)
            .option("path", new_path(spark, f"bucketed-{name}")).format("parquet").saveAsTable(table)
        )
        self._names.append((spark, table))
        return spark.table(table)

    def apply(self, operator: Callable[..., DataFrame]) -> DataFrame:
        """The rows of an operator that works on each key alone, given the frames by name."""
        return operator(**self.cold).unionByName(operator(**self.hot))

    def drop(self) -> None:
        """Forget the table names; the files go with the application's other tables."""
        for spark, table in self._names:
            spark.sql(f"DROP TABLE IF EXISTS {table}")


def _hot_keys(frames: dict[str, DataFrame], key: str, share: float) -> DataFrame:
    """Keys that have more than `share` of the rows of some table, and more than 1 / share rows of it."""
    found = None
    for df in frames.values():
        sizes = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
        rows = df.agg(F.count("*")).scalar()
        hot = sizes.where((F.col("_n") > rows * share) & (F.col("_n") > 1 / share)).select(key)
        found = hot if found is None else found.union(hot)
    return found.distinct()
