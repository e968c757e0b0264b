"""Line dedup: lines that appear on many sites are boilerplate.

The spread of a line is its number of distinct sites.  Lines are reduced to 64-bit hashes;
those of one site only go first (min and max site of a hash, summed before the shuffle).
For the others a HyperLogLog sketch of sites per line hash is built by aggregation, which
merges partial sketches.  Lines whose estimate is clear are decided by it; lines near the
threshold get an exact distinct count.  A boilerplate line stays in its first document (the
smallest id) and goes everywhere else, so no content is lost altogether.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.llm.common import packed, read, row_key
from duebook.storage import materialize

NEAR = 0.25  # estimates within this share of the threshold are counted exactly


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_sites(docs: DataFrame) -> DataFrame:
    """`_line` (hash), `_site` (hash, null sites are one site), `_id`: each line with a word, once per row."""
    d = docs.select(
        F.coalesce("doc_id", F.lit(2**63 - 1)).alias("_id"),
        F.xxhash64("source", F.col("source").isNull()).alias("_site"),
        F.explode(F.array_distinct(F.filter(_lines(F.col("text")), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")))).alias("_text"),
    )
    return d.select(F.xxhash64("_text").alias("_line"), "_site", "_id")


def boilerplate(docs: DataFrame, min_sites: int = 5, lg_k: int = 12) -> DataFrame:
    """`_line`, `_first` (smallest document id): lines of at least `min_sites` distinct sites."""
    # One row per line and site: a frequent line is summed up before the shuffle.
    pairs = materialize(
        line_sites(docs).groupBy("_line", "_site").agg(F.min("_id").alias("_id")), "line-pairs"
    )
    spread = pairs.groupBy("_line").agg(
        F.min("_site").alias("_a"), F.max("_site").alias("_b"), F.min("_id").alias("_first")
    )
    several = materialize(spread.where("_a <> _b").select("_line", "_first"), "line-several")
    pairs = pairs.join(several.select("_line"), "_line", "left_semi")
    sketched = pairs.groupBy("_line").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("_site", lg_k)).alias("_sites")
    )
    sketched = materialize(sketched, "line-sketches")
    low, high = min_sites * (1 - NEAR), min_sites * (1 + NEAR)
    near = sketched.where((F.col("_sites") >= low) & (F.col("_sites") <= high)).select("_line")
    exact = (
        pairs.join(near, "_line", "left_semi").groupBy("_line").agg(F.count("*").alias("_sites"))
        .where(F.col("_sites") >= min_sites).select("_line")
    )
    clear = sketched.where(F.col("_sites") > high).select("_line")
    return materialize(clear.unionByName(exact).join(several, "_line"), "line-boilerplate")


def line_dedup(docs: DataFrame, min_sites: int = 5, lg_k: int = 12) -> DataFrame:
    """`_row` (all columns of `docs`), `text` without boilerplate lines, `n_lines`, `n_removed`.

    Lines are the parts between newlines; lines without a word are kept as they are.  A
    repeated line of the first document stays there each time.  Null text stays null with 0
    lines, an empty text has one empty line.  Rows that repeat an id count as that document;
    a null id counts as the largest one.
    """
    drop = boilerplate(docs, min_sites, lg_k)
    keyed = docs.select(packed(docs), *row_key(), F.col("doc_id").alias("_d"), F.col("text").alias("_text"))
    hits = (
        docs.select(
            *row_key(), F.coalesce("doc_id", F.lit(2**63 - 1)).alias("_own"),
            F.explode(F.array_distinct(F.transform(_lines(F.col("text")), lambda x: F.xxhash64(x)))).alias("_line"),
        )
        .join(drop, "_line")
        .where("_own <> _first")
        # A document has as many lines as it has, and the list is no longer than that.
        .groupBy("_id", "_fp").agg(F.collect_set("_line").alias("_gone"))
    )
    lines, gone = _lines(F.col("_text")), F.col("_gone")
    kept = F.filter(lines, lambda x: ~F.array_contains(gone, F.xxhash64(x)))
    n = F.when(F.col("_text").isNull(), 0).otherwise(F.size(lines)).cast("long")
    joined = keyed.join(hits, ["_id", "_fp"], "left").withColumn(
        "_kept", F.when(gone.isNull() | F.col("_text").isNull(), F.lit(None)).otherwise(kept)
    )
    return joined.select(
        "_row",
        F.when(F.col("_kept").isNull(), F.col("_text")).otherwise(F.array_join("_kept", "\n")).alias("text"),
        n.alias("n_lines"),
        F.when(F.col("_kept").isNull(), 0).otherwise(n - F.size("_kept")).cast("long").alias("n_removed"),
    )


def op8_line_dedup(spark, folder: str) -> DataFrame:
    return line_dedup(read(spark, folder, "documents")).select(
        "_row.doc_id", "n_lines", "n_removed", F.sha2(F.encode("text", "utf-8"), 256).alias("kept_sha256")
    )


OP8_SQL = r"""
WITH l AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents
), b AS (
  SELECT line, min(doc_id) AS first FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
  GROUP BY line HAVING count(DISTINCT coalesce(source, chr(0))) >= 5
), k AS (
  SELECT doc_id, i, l.line, b.line IS NOT NULL AND b.first <> doc_id AS gone FROM l LEFT JOIN b ON l.line = b.line
)
SELECT doc_id, count(*) AS n_lines, count_if(gone)::BIGINT AS n_removed,
  sha256(coalesce(string_agg(CASE WHEN NOT gone THEN line END, chr(10) ORDER BY i), '')) AS kept_sha256
FROM k GROUP BY doc_id
"""
