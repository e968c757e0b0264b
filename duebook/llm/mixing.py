"""Mixing sources to target weights by capped water-filling.

Targets: sources share all words by weight; a source whose share exceeds `max_epochs` times
its size is clamped there and its excess goes to the others in proportion to their weights,
until no share is above its cap.  A loop over the table of sources does this; each round
sends two sums to the driver.

Sample: a document is taken floor(target / size of the source) times, and once more where it
is inside the fractional part: documents of a source are ordered by a seeded hash, and the
first ones whose words fill the rest are taken.  The running sum is taken over hash buckets
first (a bounded number per source) and over documents in the one bucket where the rest
ends, so a source with a third of all rows is never sorted as a whole.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duebook.llm.common import packed, read, word_count
from duebook.operators.blocks import dense_key
from duebook.storage import materialize

WEIGHTS = (5, 2, 1)
BUCKET_DIGITS = 3  # hexadecimal digits: 4,096 hash buckets per source


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = 3) -> DataFrame:
    """`source`, `source_size` -> plus `target`; one row per source, sizes not null.

    Weights repeat over the sources in code point order, null last.
    """
    order = [F.col("source").asc_nulls_last()]
    table = materialize(
        dense_key(sizes, "_rank", order).select(
            "source", "source_size",
            F.element_at(F.array(*[F.lit(w) for w in weights]),
                         (((F.col("_rank") - 1) % len(weights)) + 1).cast("int")).cast("long").alias("weight"),
            (F.col("source_size") * max_epochs).alias("cap"),
        ),
        "sources",
    )
    # Sources with more words per weight than the level stay free, so the level only rises.
    total = table.agg(F.sum("source_size")).first()[0] or 0
    rest, free, clamped = total, table.agg(F.sum("weight")).first()[0] or 0, None
    while free:
        # cap < weight * rest / free, in whole numbers
        over = F.col("cap").cast("decimal(38,0)") * free < F.col("weight").cast("decimal(38,0)") * rest
        got = table.agg(
            F.count(F.when(over, 1)), F.sum(F.when(over, F.col("cap"))), F.sum(F.when(~over, F.col("weight")))
        ).first()
        if got[0] == (clamped or 0):
            break
        clamped, rest, free = got[0], total - (got[1] or 0), got[2] or 0
    cap = F.col("cap").cast("double")
    if not free:
        share = cap
    else:
        fair = (F.col("weight").cast("double") * F.lit(float(rest))) / F.lit(float(free))
        over = F.col("cap").cast("decimal(38,0)") * free < F.col("weight").cast("decimal(38,0)") * rest
        share = F.when(over, cap).otherwise(fair)
    return table.select("source", "source_size", share.alias("target"))


def copies(docs: DataFrame, weights=WEIGHTS, max_epochs: int = 3, seed: str = "mix") -> DataFrame:
    """`_row` (all columns of `docs`), size, source_size, target and `copies` of every row.

    Null and blank texts have size 0; a source without words has target 0 and is taken zero
    times.  Rows that repeat id and text are separate documents that tie in the order, so
    one may be taken once more than the other.  An empty table gives no rows.
    """
    text_key = F.xxhash64("text")
    h = F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string")))
    sized = docs.select(
        packed(docs), F.col("doc_id").alias("_id"), text_key.alias("_fp"), F.col("source").alias("_source"),
        word_count(F.col("text")).alias("size"), h.alias("_h"),
    ).withColumn("_bucket", F.substring("_h", 1, BUCKET_DIGITS))
    slim = sized.select("_id", "_fp", "_source", "size", "_h", "_bucket")
    narrow = materialize(slim, "mix-sizes")
    buckets = materialize(
        narrow.groupBy("_source", "_bucket").agg(F.sum("size").alias("_words")), "mix-buckets"
    )
    sizes = buckets.groupBy(F.col("_source").alias("source")).agg(F.sum("_words").alias("source_size"))
    targets = source_targets(sizes, weights, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("_whole", whole.cast("long")).withColumn(
        "_rest", F.col("target") - F.col("_whole") * F.col("source_size")
    )
    before = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    plan = (
        buckets.withColumn("_before", F.coalesce(F.sum("_words").over(before), F.lit(0)))
        .join(targets, F.col("_source").eqNullSafe(F.col("source")))
        .select(
            F.col("_source").alias("_s"), F.col("_bucket").alias("_b"), "source_size", "target", "_whole",
            "_rest", "_before", (F.col("_before") + F.col("_words")).alias("_after"),
        )
    )
    plan = materialize(plan, "mix-plan")
    on_bucket = (F.col("_source").eqNullSafe(F.col("_s"))) & (F.col("_bucket") == F.col("_b"))
    # The bucket in which a source's rest ends: its documents are ordered one by one.
    split = plan.where((F.col("_before") < F.col("_rest")) & (F.col("_after") > F.col("_rest")))
    inside = Window.partitionBy("_source", "_bucket").orderBy("_h", "_id", "_fp").rowsBetween(
        Window.unboundedPreceding, -1
    )
    cut = narrow.join(split, on_bucket).withColumn(
        "_start", F.col("_before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    )
    # A document is taken when at least half of it lies before the end.
    ends = materialize(
        cut.where(F.col("_start") + F.col("size") / 2 <= F.col("_rest"))
        .groupBy("_source", "_bucket")
        .agg(F.max(F.struct("_h", "_id", "_fp")).alias("_last"), F.count("*").alias("_n"))
        .select(F.col("_source").alias("_es"), F.col("_bucket").alias("_eb"), "_last"),
        "mix-ends",
    )
    plan = plan.join(
        ends, F.col("_s").eqNullSafe(F.col("_es")) & (F.col("_b") == F.col("_eb")), "left"
    ).drop("_es", "_eb")
    whole_bucket = F.col("_after") <= F.col("_rest")
    place = F.struct(F.col("_h"), F.col("_id"), F.col("_fp"))
    extra = F.when(whole_bucket, 1).when(F.col("_last").isNotNull() & (place <= F.col("_last")), 1).otherwise(0)
    n = F.when(F.col("source_size") > 0, F.col("_whole") + extra).otherwise(0)
    # At most 4,096 rows per source; Catalyst broadcasts the plan only below its own limit.
    return sized.join(plan, on_bucket).select(
        "_row", "size", "source_size", "target", F.least(n, F.lit(max_epochs)).cast("long").alias("copies")
    )


def mix(docs: DataFrame, weights=WEIGHTS, max_epochs: int = 3, seed: str = "mix") -> DataFrame:
    """The mix itself: rows of `docs`, each as often as it is taken."""
    taken = copies(docs, weights, max_epochs, seed).where("copies > 0")
    return taken.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("_row.*")


def op5_mix_sources(spark, folder: str) -> DataFrame:
    return copies(read(spark, folder, "documents")).select(
        "_row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


OP5_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    md5('mix:' || doc_id) AS h, text
  FROM documents
), s AS (
  SELECT *, list_value(5, 2, 1)[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source)
), fill(step, rest, free) AS (
  SELECT 0, sum(source_size)::BIGINT, sum(weight)::BIGINT FROM s
  UNION ALL
  SELECT step + 1,
    (SELECT sum(source_size) FROM s)::BIGINT - (SELECT coalesce(sum(3 * source_size), 0) FROM s WHERE 3 * source_size * free < weight * rest)::BIGINT,
    (SELECT coalesce(sum(weight), 0) FROM s WHERE 3 * source_size * free >= weight * rest)::BIGINT
  FROM fill WHERE free > 0 AND step < 100
), level AS (SELECT rest, free FROM fill ORDER BY step DESC LIMIT 1
), t AS (
  SELECT s.source, source_size,
    CASE WHEN free = 0 OR 3 * source_size * free < weight * rest THEN (3 * source_size)::DOUBLE
      ELSE weight::DOUBLE * rest::DOUBLE / free::DOUBLE END AS target
  FROM s, level
), u AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t
), r AS (
  SELECT d.doc_id, d.size, u.source_size, u.target, u.whole, u.target - u.whole * u.source_size AS rest,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY h, doc_id ROWS UNBOUNDED PRECEDING) - d.size AS start
  FROM d JOIN u ON d.source IS NOT DISTINCT FROM u.source
)
SELECT doc_id, size, source_size, target,
  (size * least(3, whole + CASE WHEN start + size / 2 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r
"""
