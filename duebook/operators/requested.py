"""Reading only what is asked for: ids of small requests reach the scan as a filter."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.storage import SPLIT

FEW = 1000  # ids that become a filter; more are joined


def requested(table: DataFrame, ids: DataFrame, key: str, few: int = FEW) -> DataFrame:
    """Rows of `table` whose `key` is in `ids`, each once.

    The ids are looked at when this is called.  Up to `few` of them become an `IN` filter that
    the Parquet reader evaluates on row groups by their least and largest values and Bloom
    filters (for more than `spark.sql.parquet.pushdown.inFilterThreshold` ids by their range
    only); beyond that the rows are met by a join.
    """
    wanted = ids.select(key).where(F.col(key).isNotNull())
    first = [r[0] for r in wanted.limit(few + 1).collect()]
    if len(first) > few:
        return table.join(wanted, key, "left_semi")
    return table.where(F.col(key).isin(sorted(set(first)))) if first else table.where(F.lit(False))


def lookup_options(columns, row_group: int | None = None) -> dict[str, str]:
    """Parquet options for a table that is looked up by `columns`; filters are as large as needed."""
    out = {"parquet.bloom.filter.adaptive.enabled": "true"}
    out |= {f"parquet.bloom.filter.enabled#{c}": "true" for c in columns}
    return out | ({"parquet.block.size": str(row_group)} if row_group else {})


def store_for_lookups(df: DataFrame, path: str, order: str, columns, row_group: int | None = SPLIT) -> DataFrame:
    """Write `df` so that lookups skip row groups: sorted by `order` in each file, Bloom filters on `columns`."""
    df.sortWithinPartitions(order).write.options(**lookup_options(columns, row_group)).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
