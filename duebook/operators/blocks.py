"""Order-dependent columns that never put one key, or all rows, into one task.

`ordered_blocks` range-partitions the rows on a unique order and writes them once, so the
block a row fell into is fixed.  A block is a slice of the global order: one busy key simply
spans several blocks.  Running values are computed inside blocks and corrected with one
carry row per block (as many rows as there are blocks, which is why they may be broadcast).
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duebook.storage import materialize

_COPIES_PER_PIECE = 1_000_000
_POSITION_BITS = 33  # monotonically_increasing_id keeps the row's place in its low 33 bits


def ordered_blocks(df: DataFrame, order, blocks: int | None = None, name="ordered", keep=None) -> DataFrame:
    """Rows of `df` with `_block` and 1-based `_pos`; blocks follow each other in `order`.

    Without `blocks` their number follows the data: adaptive execution unites small ones.
    With `keep` only these columns are written; the others serve the order alone.
    """
    sliced = (
        df.repartitionByRange(*([blocks] if blocks else []), *order)
        .sortWithinPartitions(*order)
        .withColumn("_block", F.spark_partition_id())
        .withColumn(
            "_pos",
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)) + 1,
        )
    )
    return materialize(sliced if keep is None else sliced.select(*keep, "_block", "_pos"), name)


def dense_key(df: DataFrame, name: str, order, start: Column | int = 0, blocks=None, keep=None) -> DataFrame:
    """`df` (or its columns `keep`) plus `name` = start + 1, start + 2, ... in `order`, which must be unique."""
    keep = df.columns if keep is None else keep
    cut = ordered_blocks(df, order, blocks, name=f"keys-{name}", keep=keep)
    sizes = cut.groupBy("_block").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_block", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    start = F.lit(start) if isinstance(start, int) else start
    return cut.join(F.broadcast(offsets), "_block").select(
        (start + F.col("_offset") + F.col("_pos")).cast("bigint").alias(name),
        *[c for c in keep if c != name],
    )


def dense_key_with_copies(df: DataFrame, name: str, blocks=None) -> DataFrame:
    """`dense_key` in the order of all columns, for rows that may have any number of copies.

    Copies are counted first and then numbered, which makes the order unique, so one row's copies
    may span several blocks.  A row with many copies is numbered in pieces that different tasks take.
    """
    order = df.columns
    counted = df.groupBy(*order).agg(F.count("*").alias("_copies"))
    last_piece = F.expr(f"(_copies - 1) div {_COPIES_PER_PIECE}")
    pieces = counted.where(F.col("_copies") > _COPIES_PER_PIECE).select(
        *order, "_copies", F.explode(F.sequence(F.lit(0), last_piece)).alias("_piece")
    ).repartition(*order, "_piece")
    few = counted.where(F.col("_copies") <= _COPIES_PER_PIECE).select(*order, "_copies", F.lit(0).cast("bigint").alias("_piece"))
    low = F.col("_piece") * _COPIES_PER_PIECE
    high = F.least(low + _COPIES_PER_PIECE, F.col("_copies"))
    numbered = few.unionByName(pieces).select(*order, F.explode(F.sequence(low + 1, high)).alias("_copy"))
    return dense_key(numbered, name, [*order, "_copy"], blocks=blocks, keep=order).select(name, *order)


def running(cut: DataFrame, keys, sums=None, lasts=None) -> DataFrame:
    """Running values per key over ordered blocks, current row included.

    `sums` maps new names to the column to add up, `lasts` to the column whose latest
    non-NULL value is wanted.  The order of `cut` must start with `keys`.
    """
    sums, lasts = sums or {}, lasts or {}
    here = (
        Window.partitionBy("_block", *keys)
        .orderBy("_pos")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    key = F.struct(*keys)
    local = cut.select(
        "*",
        *[F.sum(c).over(here).alias(n) for n, c in sums.items()],
        *[F.last(c, ignorenulls=True).over(here).alias(n) for n, c in lasts.items()],
    )
    names = [*sums, *lasts]
    ends = local.groupBy("_block").agg(
        F.min_by(key, "_pos").alias("_first"),
        F.max_by(F.struct(key.alias("_key"), *names), "_pos").alias("_end"),
    )
    chain = (
        Window.partitionBy("_end._key")
        .orderBy("_block")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    upto = ends.select(
        "_block",
        "_first",
        F.struct(
            F.col("_end._key").alias("_key"),
            *[F.sum(f"_end.{n}").over(chain).alias(n) for n in sums],
            *[F.last(f"_end.{n}", ignorenulls=True).over(chain).alias(n) for n in lasts],
        ).alias("_upto"),
    )
    previous = F.lag("_upto").over(Window.orderBy("_block"))
    carry = upto.select("_block", "_first", previous.alias("_in")).where(
        F.col("_in._key").eqNullSafe(F.col("_first"))
    )
    joined = local.join(F.broadcast(carry), "_block", "left")
    continues = F.col("_first").isNotNull() & key.eqNullSafe(F.col("_first"))
    added = {
        n: F.when(continues, F.coalesce(F.col(f"_in.{n}"), F.lit(0)) + F.col(n)).otherwise(F.col(n))
        for n in sums
    }
    kept = {
        n: F.when(continues, F.coalesce(F.col(n), F.col(f"_in.{n}"))).otherwise(F.col(n))
        for n in lasts
    }
    fixed = {**added, **kept}
    return joined.select(*cut.columns, *[fixed[n].alias(n) for n in names])


def neighbour(cut: DataFrame, keys, columns, step: int) -> DataFrame:
    """Columns of the previous (step -1) or next (step 1) row with the same key.

    `columns` maps new names to existing columns; they are NULL at the ends of a key.
    """
    values = F.struct(
        F.struct(*keys).alias("_key"), *[F.col(c).alias(n) for n, c in columns.items()]
    )
    inside, across = Window.partitionBy("_block").orderBy("_pos"), Window.orderBy("_block")
    shift = F.lag if step < 0 else F.lead
    edge = F.max_by if step < 0 else F.min_by
    edges = (
        cut.groupBy("_block")
        .agg(edge(values, "_pos").alias("_edge"))
        .select("_block", shift("_edge").over(across).alias("_edge"))
    )
    paired = cut.withColumn("_near", shift(values).over(inside)).join(
        F.broadcast(edges), "_block", "left"
    )
    near = F.coalesce(F.col("_near"), F.col("_edge"))
    same = near["_key"].eqNullSafe(F.struct(*keys))
    return paired.select(
        *cut.columns, *[F.when(same, near[n]).alias(n) for n in columns]
    )


class Ordered:
    """Rows in a given order within each key, ready for running values and neighbours.

    The rows are cut into ordered blocks, so a key of any size spans as many tasks as it needs.
    """

    def __init__(self, df: DataFrame, keys, order, blocks=None, name="ordered"):
        self.keys = list(keys)
        self.columns = df.columns
        self.rows = ordered_blocks(df, [*keys, *order], blocks, name)

    def running(self, sums=None, lasts=None) -> "Ordered":
        """Adds running sums and latest non-NULL values per key, current row included."""
        sums, lasts = sums or {}, lasts or {}
        return self._with(running(self.rows, self.keys, sums, lasts), [*sums, *lasts])

    def neighbour(self, columns: dict[str, str], step: int) -> "Ordered":
        """Adds columns of the previous (-1) or next (1) row of the same key."""
        return self._with(neighbour(self.rows, self.keys, columns, step), columns)

    def result(self) -> DataFrame:
        return self.rows.select(*self.columns)

    def _with(self, rows: DataFrame, names) -> "Ordered":
        self.rows, self.columns = rows, [*self.columns, *names]
        return self


def rank_within(df: DataFrame, name: str, keys, order, blocks=None) -> DataFrame:
    """`df` plus `name` = 1, 2, ... per key in `order`; safe when one key holds most rows."""
    ranked = Ordered(df, keys, order, blocks, name=f"rank-{name}")
    return ranked.running(sums={name: F.lit(1).cast("bigint")}).result()
