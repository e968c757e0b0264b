"""Best-fit packing in bulk-synchronous rounds.

Documents become token ids and an end id; longer ones than a sequence are cut, full pieces
stand alone, and one shorter piece of a document is left to be packed.  A round puts the pieces
still unplaced and the gaps of open sequences into one order by length, longest first and gaps
before pieces of the same length.  In that order the tightest gap of a piece is the nearest
free one before it, so gaps and pieces match like brackets.  Every range sweeps its own rows
with a stack; what is left of a range is a run of pieces and a run of gaps, told apart by rank,
and one row per range (its two counts) settles which ranks of which ranges belong together.
Gaps are then updated and the next round begins.

A gap takes one piece a round.  So that small pieces do not need a round each, a gap of t times
the longest unplaced piece enters as t gaps; what is left of them is one gap again afterwards.
Sequences are opened where a round leaves pieces without a gap: as many as their tokens need at
least, and one for each piece of more than half a sequence.
"""

import functools
import os
import re
import zlib

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import public_tokenizers
from duebook.llm.common import read, small_batches
from duebook.storage import discard, materialize

VOCABULARY = "byte_bpe_50k.json"
CAPACITY = 2048
END = 0

# Characters whose class (letter, digit, white space, other) all versions of Unicode agree on.
_PLAIN = re.compile("[\t\n\r -~¡-¬®-ɏ]*")


def _byte_values() -> dict[str, int]:
    """Byte of each letter that byte-level vocabularies write: itself, or the next free one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


class Encoder:
    """Ids of texts by a byte-level vocabulary of `tokenizers`, as little-endian unsigned 32-bit integers.

    Texts of plain characters and without the string of a special token take a faster way to the
    same ids: the vocabulary numbers its merges in order, so its ids are ranks, by which
    `tiktoken` merges.  All other texts are encoded by `tokenizers`.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer, values = Tokenizer.from_file(path), _byte_values()
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        ranks = {bytes(map(values.get, t)): i for t, i in self.tokenizer.get_vocab().items() if t not in special}
        self.plain = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.special = tuple(special)

    def ids(self, texts: list[str]) -> list[bytes]:
        out = [None] * len(texts)
        for i, text in enumerate(texts):
            if _PLAIN.fullmatch(text) and not any(t in text for t in self.special):
                out[i] = self.plain.encode_ordinary(text)
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, e in zip(rest, self.tokenizer.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False)):
            out[i] = e.ids
        return [np.array(ids, dtype="<u4").tobytes() for ids in out]


@functools.cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, doc_id="doc_id", text="text") -> DataFrame:
    """uid, doc_id, piece, start, length, ids_crc32 of every piece of every document.

    A null text is empty, so it is the end id alone.  Only documents of more than `capacity`
    ids are cut: their first piece takes the remainder, the others are full.
    """
    def run(batches):
        enc, number = encoder(path), TaskContext.get().partitionId() << 40
        for b in small_batches(batches, 64):
            rows = []
            for place, raw in enumerate(enc.ids([t or "" for t in b.column(1).to_pylist()])):
                raw += int(end).to_bytes(4, "little")
                n = len(raw) // 4
                first = n if n <= capacity else (n % capacity or capacity)
                cuts = [0, *range(first, n + 1, capacity)]
                for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
                    rows.append((place, i, lo, hi - lo, zlib.crc32(raw[4 * lo: 4 * hi])))
            place, piece, start, length, crc = zip(*rows)
            uid = pa.array(range(number, number + len(rows)), pa.int64())
            number += len(rows)
            yield pa.RecordBatch.from_arrays(
                [uid, b.column(0).take(pa.array(place)), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["uid", "doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return materialize(
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("t"))
        .mapInArrow(run, "uid long, doc_id long, piece int, start long, length long, ids_crc32 long"),
        "pieces",
    )


def _sweep(batches):
    """Matches the sorted rows of one range like brackets.

    Comes back with the pieces (`bin` null where unmatched) and gaps (`size` is what is left
    of them); `rank` numbers the unmatched ones of either kind in order, from 0.
    """
    stack, waiting, out = [], 0, []  # the stack holds unmatched gaps of this range

    def flush():
        rows, out[:] = list(out), []
        columns = list(zip(*rows)) if rows else [[]] * 6
        types = (pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], ["block", "gap", "id", "size", "bin", "rank"]
        )

    block = None
    for b in batches:
        gap, ids, size = (b.column(c).to_pylist() for c in ("gap", "id", "size"))
        block = b.column("block")[0].as_py() if b.num_rows else block
        for is_gap, i, s in zip(gap, ids, size):
            if is_gap:
                stack.append((i, s))
            elif stack:
                bin_, room = stack.pop()
                out.append((block, False, i, s, bin_, None))
                out.append((block, True, bin_, room - s, None, None))
            else:
                out.append((block, False, i, s, None, waiting))
                waiting += 1
        yield flush()
    out += [(block, True, i, s, None, rank) for rank, (i, s) in enumerate(stack)]
    yield flush()


def _across(counts) -> list[tuple]:
    """Which ranks of ranges match: (gap range, gap rank of the first, piece range, its first rank, how many).

    `counts` has (range, unmatched pieces, unmatched gaps) in order.  Ranks of pieces rise
    where those of gaps fall, since the nearest gap is the last one of its range.
    """
    stack, out = [], []
    for block, waiting, free in counts:
        done = 0
        while done < waiting and stack:
            other, left = stack.pop()
            n = min(left, waiting - done)
            out.append((other, left - 1, block, done, n))
            done += n
            if left > n:
                stack.append((other, left - n))
        if free:
            stack.append((block, free))
    return out


def _round(spark: SparkSession, gaps: DataFrame, waiting: DataFrame, longest: int, blocks: int) -> DataFrame:
    """Pieces with their bin (null: none yet) and gaps with what is left of them."""
    copies = F.greatest(F.lit(1), F.expr(f"size div {longest}")).cast("int")
    split = gaps.select(F.col("id"), "size", F.posexplode(F.array_repeat(F.lit(longest).cast("long"), copies)).alias("nth", "part")).select(
        "id", F.lit(True).alias("gap"),
        F.when(F.col("nth") > 0, F.col("part")).otherwise(F.col("size") - (copies - 1) * F.col("part")).alias("size"), "nth",
    )
    rows = split.unionByName(waiting.select("id", F.lit(False).alias("gap"), "size", F.lit(0).alias("nth")))
    order = [F.desc("size"), F.desc("gap"), F.col("id"), F.col("nth")]
    swept = materialize(
        rows.repartitionByRange(blocks, *order).sortWithinPartitions(*order)
        .select(F.spark_partition_id().alias("block"), "gap", "id", "size")
        .mapInArrow(_sweep, "block int, gap boolean, id long, size long, bin long, rank long"),
        "swept",
    )
    left = swept.where("rank IS NOT NULL")
    counts = (
        left.groupBy("block").agg(F.count(F.when(~F.col("gap"), 1)).alias("p"), F.count(F.when(F.col("gap"), 1)).alias("g"))
        .orderBy("block").collect()  # one row a range
    )
    matched = spark.createDataFrame(
        _across([tuple(r) for r in counts]), "g_block int, g_rank long, block int, p_rank long, n long"
    )  # at most two rows a range
    # Both sides get the name of their match: the range of the gap and its rank there.
    place = (left["block"] == matched["block"]) & (F.col("rank") >= F.col("p_rank")) & (F.col("rank") < F.col("p_rank") + F.col("n"))
    piece = left.where("NOT gap").join(F.broadcast(matched), place, "left").select(
        "id", "size", F.col("g_block").alias("block"), (F.col("g_rank") - (F.col("rank") - F.col("p_rank"))).alias("rank")
    )
    free = left.where("gap").select("block", "rank", F.col("id").alias("g_id"), F.col("size").alias("g_size"))
    # Pieces without a match have no name and take no part in the join.
    met = free.join(piece.where("block IS NOT NULL"), ["block", "rank"], "left")
    none = F.lit(None).cast("long")
    lone = piece.where("block IS NULL").select(F.lit(False).alias("gap"), "id", "size", none.alias("bin"))
    crossed = met.select(F.explode(F.array(
        F.struct(F.lit(False).alias("gap"), "id", "size", F.col("g_id").alias("bin")),
        F.struct(F.lit(True).alias("gap"), F.col("g_id").alias("id"),
                 (F.col("g_size") - F.coalesce("size", F.lit(0))).alias("size"), none.alias("bin")),
    )).alias("r")).select("r.*").where("id IS NOT NULL").unionByName(lone)
    done = materialize(swept.where("rank IS NULL").select("gap", "id", "size", "bin").unionByName(crossed), "round")
    discard(swept)
    return done


def best_fit(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`id`, `size`, `bin` of items (`id` unique, 1 <= `size` <= `capacity`), in few bins."""
    spark = items.sparkSession
    blocks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    waiting, gaps = items.select("id", "size"), None
    placed, bins, before = [], 0, None
    while True:
        big = F.count(F.when(F.col("size") > capacity // 2, 1))
        total, longest, least, halves, n = waiting.agg(F.sum("size"), F.max("size"), F.min("size"), big, F.count("*")).first()
        if not n:
            break
        if n == before or gaps is None:  # the last round placed nothing, or this is the first
            more = max(halves, -(-total // capacity))
            fresh = spark.range(bins, bins + more).select("id", F.lit(capacity).cast("long").alias("size"))
            gaps, bins = fresh if gaps is None else gaps.unionByName(fresh), bins + more
        before = n
        # Gaps shorter than every piece take no part any more.
        done = _round(spark, gaps.where(f"size >= {least}"), waiting, longest, blocks)
        placed.append(done.where("NOT gap AND bin IS NOT NULL").select("id", "size", "bin"))
        waiting = done.where("NOT gap AND bin IS NULL").select("id", "size")
        gaps = done.where("gap").groupBy("id").agg(F.sum("size").alias("size"))
    if not placed:
        return spark.createDataFrame([], "id long, size long, bin long")
    return functools.reduce(DataFrame.unionByName, placed)


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END, doc_id="doc_id", text="text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of `docs`.

    Null and empty texts are the end id alone; texts of any length are encoded whole; rows that
    repeat are documents of their own; a null doc_id stays null.  Other columns are ignored, so
    their names cannot clash.  An empty table has no pieces.  `path` is the vocabulary file,
    which must exist on every executor.
    """
    cut = pieces(docs, path or public_tokenizers.path(VOCABULARY), capacity, end, doc_id, text)
    # Only the first piece of a document can be shorter than a sequence.
    short, full = cut.where(f"length < {capacity}"), cut.where(f"length = {capacity}")
    placed = best_fit(short.select(F.col("uid").alias("id"), F.col("length").alias("size")), capacity)
    before = Window.partitionBy("bin").orderBy(F.desc("size"), "id").rowsBetween(Window.unboundedPreceding, -1)
    at = placed.select(
        F.col("id").alias("uid"), (F.col("bin") * 2).alias("sequence_id"),
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"),
    )
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    alone = full.withColumn("sequence_id", F.col("uid") * 2 + 1).withColumn("offset", F.lit(0).cast("long"))
    return short.join(at, "uid").select(*columns).unionByName(alone.select(*columns))


def op12_best_fit(spark, folder: str) -> DataFrame:
    return pack(read(spark, folder, "documents"))
