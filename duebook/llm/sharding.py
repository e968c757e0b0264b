"""Sharding by vector bin packing: bytes, tokens and rows are balanced together.

Documents of equal text form a group.  Groups travel in units whose number is bounded by
the parameters, not by the data: a group that weighs more than a unit in any dimension is a
unit of its own (or several, when it is larger still), the others share units by the hash of
their text.  Units are placed largest first, each in the shard where the dot product of its
vector with the residual capacity is highest.  Only unit sums reach the driver.
"""

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duebook.llm.common import read, word_count
from duebook.storage import materialize

DIMENSIONS = ("size", "tokens", "rows")


def place(vectors: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unit.  A unit goes where vector . residual capacity is highest.

    Vectors are shares of the capacity of one shard, so all dimensions weigh the same.
    """
    totals = vectors.sum(axis=0)
    scaled = vectors / np.where(totals == 0, 1, totals / shards)
    room = np.ones((shards, vectors.shape[1])) * (totals > 0)
    out = np.zeros(len(vectors), dtype=np.int64)
    for i in np.argsort(-scaled.max(axis=1), kind="stable"):
        s = int(np.argmax(room @ scaled[i]))
        out[i] = s
        room[s] -= scaled[i]
    return out


def shard_documents(docs: DataFrame, shards: int = 24, units_per_shard: int = 128) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard; one row per row of `docs`.

    size is the UTF-8 bytes of the text (null: none) plus 8, tokens are its words.  A null
    text is the group of null texts and has the checksum of no bytes.  Equal rows stay rows
    of their own with slots of their own.  The law is `bytes`: sizes of shards differ by
    less than the size of a unit or of the largest document.  An empty table gives no rows.

    Groups larger than a unit are cut into pieces of neighbouring documents by hash of their
    ids, so one text with a third of all rows is spread as evenly as everything else.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    facts = materialize(
        docs.select(
            "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text).cast("long").alias("text_crc32"), word_count(F.col("text")).alias("tokens"),
            F.xxhash64("text", F.col("text").isNull()).alias("_g"),
        ),
        "shard-facts",
    )
    sums = [F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]
    groups = materialize(facts.groupBy("_g").agg(*sums), "shard-groups")
    total = groups.agg(*[F.sum(d).alias(d) for d in DIMENSIONS]).first()
    n_units = shards * units_per_shard
    most = {d: max(1.0, (total[d] or 0) / n_units) for d in DIMENSIONS}
    weight = F.greatest(*[F.col(d) / F.lit(most[d]) for d in DIMENSIONS])
    # Fewer than n_units groups per dimension can weigh more than a unit.
    large = materialize(
        groups.withColumn("_w", weight).where("_w > 1")
        .select(F.col("_g").alias("_lg"), F.ceil("_w").cast("int").alias("_pieces")),
        "shard-large",
    )
    piece = F.pmod(F.xxhash64("doc_id", F.lit("piece")), F.col("_pieces")).cast("int")
    unit = F.when(F.col("_pieces").isNull(), F.concat_ws(":", F.lit("u"), F.pmod(F.col("_g"), F.lit(n_units)).cast("string")))
    unit = unit.otherwise(F.concat_ws(":", F.lit("g"), F.col("_lg").cast("string"), piece.cast("string")))
    marked = materialize(
        facts.join(F.broadcast(large), F.col("_g") == F.col("_lg"), "left").withColumn("_unit", unit).drop("_lg", "_pieces"),
        "shard-marked",
    )
    units = marked.groupBy("_unit").agg(*sums).orderBy("_unit").collect()  # at most 7 * n_units rows
    shard_of = place(np.array([[r[d] for d in DIMENSIONS] for r in units], dtype=float).reshape(-1, 3), shards)
    offset, table = [0] * shards, []
    for r, s in zip(units, shard_of.tolist()):
        table.append((r["_unit"], s, offset[s]))
        offset[s] += r["rows"]
    placed = spark.createDataFrame(table, "_unit string, shard int, _offset long")
    inside = Window.partitionBy("_unit").orderBy("_g", "doc_id", "size", "text_crc32")
    return (
        marked.withColumn("_pos", F.row_number().over(inside) - 1)
        .join(F.broadcast(placed), "_unit")
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
            (F.col("_offset") + F.col("_pos")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )


def op9_shards(spark, folder: str) -> DataFrame:
    return shard_documents(read(spark, folder, "documents"))
