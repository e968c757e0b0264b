"""Connected components of a table of links, by alternating large and small stars.

Every round is a grouping and a join; links, components and labels stay in tables.  Nodes
with many links are summed up before the shuffle and split by the skew join.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.storage import materialize


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """`a`, `b` with b < a: each node's neighbours hung on the smallest of them and itself."""
    if large:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        hung = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = links.groupBy("a").agg(F.min("b").alias("m"))
        hung = (
            links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b")))
        )
    return hung.where("a <> b")


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """`node`, `label`: nodes that have a link, and the smallest node they reach."""
    table = materialize(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(),
        "links",
    )
    state = None
    while True:
        # Labels only fall, so equal counts and sums of labels mean that nothing changed.
        now = table.agg(F.count("*"), F.sum(F.col("b").cast("decimal(38,0)")), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == state or not now[0]:
            break
        state = tuple(now)
        table = materialize(_stars(materialize(_stars(table, True), "links"), False).distinct(), "links")
    return table.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        table.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    )
