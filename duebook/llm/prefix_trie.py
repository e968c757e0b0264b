"""Prefix trie of conversations in a hash-addressed node table.

Conversations are rebuilt (first turns of a base conversation, then their own), and every
prefix gets a 128-bit digest: the sum of one mixed value per (depth, turn), so that digests of
a conversation of any length come from running sums over ordered blocks, and the parent's
digest from taking off the last value.  Distinct digests are the nodes.  All members of a node
must agree on depth, last turn (SHA-256) and parent digest; if one does not, digests are drawn
anew with another seed, so a node never holds two sequences.

Sums over subtrees are taken per shard.  A minimal perfect hash gives every digest of a shard
its slot, checked against the digest kept there; counts are scattered into flat arrays and
added to parent slots, deepest nodes first.  A shard holds whole subtrees of at most `limit`
turns.  Nodes above them are cut into segments of at most `limit` depths of one path: shards of
segments are first summed as wholes, the tree of segments (about 2 N / limit rows, for
N turns and limit >= sqrt(N)) is summed in one shard, and its sums enter the segments again.
So neither a first turn that all share, nor one endless conversation, fills a task.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duebook.llm.common import read
from duebook.operators.blocks import ordered_blocks
from duebook.storage import discard, materialize

HEAD = 8  # most turns that a conversation takes from its base
FAMILY = 5
TIE = 64  # characters of a text that order rows of one turn and role; then its digest does
LIMIT = 1024
SHARD = 16384  # nodes that a shard aims at
IDS = 65536  # conversation ids joined in one piece of a list
_LOW = (1 << 32) - 1
_KEY = ["k1", "k2"]


class SlotTable:
    """A minimal perfect hash over distinct 128-bit keys: key -> slot 0 .. n - 1.

    In every level the keys left are thrown into twice as many places; those alone in theirs
    stay, the others go on.  A slot is the number of taken places before it.  Slots keep their
    key, so a key that is not in the table is told apart.
    """

    def __init__(self, keys: np.ndarray):
        self.levels, left, taken = [], np.arange(len(keys)), 0
        while len(left):
            if len(self.levels) > 200:
                raise ValueError("a key stands twice in the table")
            size = 2 * len(left)
            at = self._place(keys[left], len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            self.levels.append((alone, np.cumsum(alone) - 1 + taken))
            taken += int(alone.sum())
            left = left[~alone[at]]
        self.keys = np.empty_like(keys)
        self.keys[self._raw(keys)] = keys

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        x = keys[:, 0].astype(np.uint64) ^ (keys[:, 1].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        x += np.uint64(level * 0xD1B54A32D192ED03 % 2**64)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xFF51AFD7ED558CCD)
        return ((x ^ (x >> np.uint64(32))) % np.uint64(size)).astype(np.int64)

    def _raw(self, keys: np.ndarray) -> np.ndarray:
        slot, left = np.full(len(keys), -1), np.arange(len(keys))
        for level, (alone, ranks) in enumerate(self.levels):
            at = self._place(keys[left], level, len(alone))
            slot[left[alone[at]]] = ranks[at[alone[at]]]
            left = left[~alone[at]]
        return slot

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of every key; -1 where the table does not hold it."""
        slot = self._raw(keys)
        held = slot >= 0
        held[held] = (self.keys[slot[held]] == keys[held]).all(axis=1)
        return np.where(held, slot, -1)


def subtree_sums(keys, parents, depth, counts, linked=None) -> np.ndarray:
    """`counts` (one row per kind) of every key plus those of all keys below it.

    Keys that are not `linked` (by default: of depth 0) add nothing to their parent.
    """
    linked = depth > 0 if linked is None else linked
    table = SlotTable(keys)
    slot, n = table.slots(keys), len(keys)
    parent_slot, depths = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    parent_slot[slot], depths[slot] = np.where(linked, table.slots(parents), -1), depth
    flat = np.zeros((len(counts), n), dtype=np.int64)
    flat[:, slot] = counts
    order = np.argsort(-depths, kind="stable")
    ends = np.flatnonzero(np.diff(depths[order], append=-1))
    for a, b in zip([0, *(ends[:-1] + 1)], ends + 1):
        level = order[a:b]
        level = level[parent_slot[level] >= 0]
        for row in flat:
            np.add.at(row, parent_slot[level], row[level])
    return flat[:, slot]


def _in_shards(nodes: DataFrame, shard: Column, key, parent, depth: str, linked: Column | None = None) -> DataFrame:
    """`nodes` with `leaves` and `saved` summed over what lies below in the same shard.

    Rows that are not `linked` (by default: of depth 0) add nothing to their parent.
    """
    columns = nodes.columns

    def run(table: pa.Table) -> pa.Table:
        def matrix(names):
            return np.stack([table.column(c).fill_null(0).to_numpy() for c in names], axis=1)

        sums = subtree_sums(
            matrix(key), matrix(parent), table.column(depth).to_numpy(), matrix(["leaves", "saved"]).T,
            table.column("_linked").to_numpy(zero_copy_only=False),
        )
        table = table.select(columns)
        for name, values in zip(("leaves", "saved"), sums):
            table = table.set_column(columns.index(name), name, pa.array(values, pa.int64()))
        return table

    linked = F.col(depth) > 0 if linked is None else linked
    return nodes.withColumns({"_shard": shard, "_linked": linked}).groupBy("_shard").applyInArrow(run, nodes.schema)


def _values(depth: Column, turn: Column, seed: int) -> list[Column]:
    """Four 32-bit values of a turn at a depth; as many as 2^31 of them add up in a long."""
    a, b = F.xxhash64(F.lit(seed), depth, turn), F.xxhash64(turn, depth, F.lit(-1 - seed))
    return [F.shiftrightunsigned(a, 32), a.bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(b, 32), b.bitwiseAND(F.lit(_LOW))]


def _digest(sums: list[Column]) -> list[Column]:
    low = [s.bitwiseAND(F.lit(_LOW)) for s in sums]
    return [F.shiftleft(low[0], 32).bitwiseOR(low[1]), F.shiftleft(low[2], 32).bitwiseOR(low[3])]


def _turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns as digests in ordered blocks, and one row per conversation and block."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("c"), F.col("turn").alias("_turn"), role.alias("_role"),
        F.substring(text, 1, TIE).alias("_head"), F.unhex(F.sha2(whole, 256)).alias("turn"),
        F.octet_length(text).cast("long").alias("size"),
    )
    cut = ordered_blocks(rows, ["c", F.col("_turn").asc_nulls_first(), "_role", "_head", "turn"], name="turns")
    by_block = Window.partitionBy("c").orderBy("_block")
    pairs = (
        cut.groupBy("_block", "c").agg(F.min("_pos").alias("start"), F.count("*").alias("here"))
        .withColumn("before", F.coalesce(F.sum("here").over(by_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("own", F.sum("here").over(Window.partitionBy("c")))
    )
    return cut, materialize(pairs, "conversation-blocks")


def _prefixes(cut: DataFrame, pairs: DataFrame, seed: int) -> DataFrame:
    """Every prefix of every rebuilt conversation: c, depth, length, turn, size, digest, parent digest."""
    place = (F.col("before") + F.col("_pos") - F.col("start") + 1).alias("pos")
    sums = ["s1", "s2", "s3", "s4"]
    values = ["v1", "v2", "v3", "v4"]
    heads = (
        cut.where(F.col("c") % FAMILY == 0).join(pairs.where(f"before < {HEAD}"), ["_block", "c"])
        .select("c", place, "turn", "size").where(f"pos <= {HEAD}")
        .withColumns(dict(zip(values, _values(F.col("pos"), F.col("turn"), seed))))
        .groupBy(F.col("c").alias("base"))
        .agg(F.sort_array(F.collect_list(F.struct("pos", "turn", "size", *values))).alias("heads"))  # at most 8
    )
    take = (F.crc32(F.col("c").cast("string").cast("binary")) % (HEAD + 1)).cast("int")
    facts = (
        pairs.where("before = 0").select("c", "own", (F.col("c") - F.col("c") % FAMILY).alias("base"), take.alias("h"))
        .join(heads, "base", "left")
        .withColumn("heads", F.expr("CASE WHEN heads IS NULL OR h = 0 THEN slice(array(), 1, 0) ELSE slice(heads, 1, h) END"))
        .withColumn("taken", F.size("heads").cast("long"))
        .withColumn("length", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
        .withColumns({s: F.coalesce(F.aggregate(F.col("heads")[v], F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0))
                      for s, v in zip(sums, values)})
    )
    facts = materialize(facts, "rebuilt")
    # A conversation has one row of facts per block, so a block's rows meet it in one place each.
    placed = pairs.drop("own").join(facts.select("c", "h", "taken", "length", *sums), "c")
    own = (
        cut.select("_block", "c", "_pos", "turn", "size").join(placed, ["_block", "c"])
        .select("*", place).where("pos > h")
        .withColumn("depth", F.col("pos") - F.col("h") + F.col("taken"))
        .withColumns(dict(zip(values, _values(F.col("depth"), F.col("turn"), seed))))
    )
    upto = Window.partitionBy("_block", "c").orderBy("_pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = materialize(
        own.select("_block", "c", "depth", "length", "turn", "size", *values,
                   *[(F.col(s) + F.sum(v).over(upto)).alias(s) for s, v in zip(sums, values)],
                   ((F.col("before") > 0) | (F.col("before") + F.col("here") < F.col("length") + F.col("h") - F.col("taken"))).alias("wide")),
        "own-turns",
    )
    # At most one conversation goes on from block to block, so there is at most one carry a block.
    earlier = Window.partitionBy("c").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        own.where("wide").groupBy("c", "_block").agg(*[F.sum(v).alias(v) for v in values])
        .select("c", "_block", *[F.sum(v).over(earlier).alias(f"c_{s}") for s, v in zip(sums, values)]).where("c_s1 IS NOT NULL")
    )
    own = own.join(F.broadcast(carry), ["_block", "c"], "left").select(
        "c", "depth", "length", "turn", "size", *values,
        *[(F.col(s) + F.coalesce(f"c_{s}", F.lit(0))).alias(s) for s in sums],
    )
    borrowed = facts.select("c", "length", "heads", F.posexplode("heads").alias("_at", "one")).select(
        "c", F.col("one.pos").alias("depth"), "length", "one.turn", "one.size", *[f"one.{v}" for v in values],
        *[F.aggregate(F.slice(F.col("heads")[v], 1, F.col("_at") + 1), F.lit(0).cast("long"), lambda a, x: a + x).alias(s)
          for s, v in zip(sums, values)],
    )
    k = _digest([F.col(s) for s in sums])
    p = _digest([F.col(s) - F.col(v) for s, v in zip(sums, values)])
    inner = own.unionByName(borrowed).select(
        "c", "depth", "length", "turn", "size", k[0].alias("k1"), k[1].alias("k2"), p[0].alias("p1"), p[1].alias("p2")
    )
    zero = F.lit(0).cast("long")
    root = facts.select(
        "c", zero.alias("depth"), "length", F.lit(None).cast("binary").alias("turn"), zero.alias("size"),
        zero.alias("k1"), zero.alias("k2"), F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"),
    )
    return materialize(inner.unionByName(root), "prefixes")


def _nodes(prefixes: DataFrame) -> DataFrame | None:
    """One row per digest, or None if one digest stands for two sequences."""
    facts = F.struct("depth", "turn", "p1", "p2")
    nodes = materialize(
        prefixes.groupBy(*_KEY).agg(
            F.min("c").alias("conv_id"), F.count("*").alias("n_convs"),
            F.sum(F.col("length") - F.col("depth") + 1).alias("weight"), F.max("size").alias("size"),
            F.min(facts).alias("one"), F.max(facts).alias("other"),
        ).select(*_KEY, "conv_id", "n_convs", "weight", "size", "one.depth", "one.p1", "one.p2",
                 (~F.col("one").eqNullSafe(F.col("other"))).alias("mixed")),
        "nodes",
    )
    return None if nodes.where("mixed").limit(1).count() else nodes.drop("mixed")


def _with_parents(nodes: DataFrame, limit: int) -> DataFrame:
    """Adds n_children, and conv_id and weight of the parent."""
    kids = nodes.where("depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children"))
    nodes = materialize(
        nodes.join(kids, _KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "nodes"
    )
    parents = nodes.select(
        F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"),
        F.col("weight").alias("parent_weight"), F.col("n_children").alias("siblings"),
    )
    # Parents of `limit` or more children: at most N / limit <= sqrt(N) of them.
    many, few = F.broadcast(parents.where(f"siblings >= {limit}").drop("siblings")), parents.where(f"siblings < {limit}").drop("siblings")
    below = nodes.where("depth > 0")
    nothing = F.lit(None).cast("long")
    return materialize(
        below.join(many, ["p1", "p2"])
        .unionByName(below.join(many, ["p1", "p2"], "left_anti").join(few, ["p1", "p2"]))
        .unionByName(nodes.where("depth = 0").withColumns({"parent_conv_id": nothing, "parent_weight": nothing}))
        .withColumn("leaves", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long"))
        .withColumn("saved", (F.col("n_convs") - 1) * F.col("size")),
        "linked-nodes",
    )


def _labels(nodes: DataFrame, limit: int) -> DataFrame:
    """`conv_id`, `label`: the small subtree in which the path of a conversation ends, by pointer doubling."""
    tops = nodes.where("depth = 0 OR parent_conv_id <> conv_id")
    alone = (F.col("depth") == 0) | (F.col("weight") > limit) | (F.col("parent_weight") > limit)
    table = materialize(tops.select(
        "conv_id", F.when(alone, F.col("conv_id")).otherwise(F.col("parent_conv_id")).alias("label"), alone.alias("found")
    ), "labels")
    while table.where("NOT found").limit(1).count():  # chains of at most `limit`: log2(limit) rounds
        step = table.select(F.col("conv_id").alias("label"), F.col("label").alias("next"), F.col("found").alias("found_next"))
        moved = table.where("NOT found").join(step, "label").select(
            "conv_id", F.col("next").alias("label"), F.col("found_next").alias("found")
        )
        table = materialize(table.where("found").unionByName(moved), "labels")
    return table.select("conv_id", "label")


def _ends(prefixes: DataFrame) -> DataFrame:
    """Digest of the ascending ids of the conversations that end at a node, by node.

    Sorted ids are joined in pieces, so only text pieces of a busy node meet in one task,
    which reads them one after the other.
    """
    ends = prefixes.where("depth = length").select(*_KEY, "c")
    blocks = int(prefixes.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def groups(table):
        k = np.stack([table.column(c).to_numpy() for c in range(2)], axis=1)
        cuts = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
        return zip(k[[0, *cuts]].tolist() if len(k) else [], [0, *cuts], [*cuts, len(k)])

    def join(batches):
        for b in batches:
            for at in range(0, b.num_rows, IDS):
                part = b.slice(at, IDS)
                ids = part.column(2).to_pylist()
                rows = [(k1, k2, ids[lo], ",".join(map(str, ids[lo:hi]))) for (k1, k2), lo, hi in groups(part)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.string()))],
                    ["k1", "k2", "first", "ids"],
                )

    def digest(batches):
        key, state = None, None
        for b in batches:
            out = []
            for (k, lo, hi) in groups(b):
                if k != key:
                    if key is not None:
                        out.append((*key, state.hexdigest()))
                    key, state, glue = k, hashlib.sha256(), ""
                for at in range(lo, hi):
                    state.update((glue + b.column(3)[at].as_py()).encode())
                    glue = ","
            yield batch(out)
        yield batch([] if key is None else [(*key, state.hexdigest())])

    def batch(rows):
        columns = list(zip(*rows)) or [[], [], []]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))], ["k1", "k2", "ends_sha256"]
        )

    pieces = (
        ends.repartitionByRange(blocks, *_KEY, "c").sortWithinPartitions(*_KEY, "c")
        .mapInArrow(join, "k1 long, k2 long, first long, ids string")
    )
    return (
        pieces.repartition(*_KEY).sortWithinPartitions(*_KEY, "first")
        .mapInArrow(digest, "k1 long, k2 long, ends_sha256 string")
    )


def prefix_trie(conversations: DataFrame, limit: int | None = None, shard: int = SHARD) -> DataFrame:
    """Nodes of the trie of rebuilt conversations, with sums over subtrees.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.  Rows without conv_id are left out; null roles and texts are
    empty; null turns come first; rows of one turn go by role, first 64 characters of the text
    and SHA-256 of role and text, so repeated rows are turns of their own.  Texts of any length
    are digested whole.  Other columns are ignored.  An empty table has no nodes, not even a
    root.  A conversation may have 2^31 turns.
    """
    cut, pairs = _turns(conversations)
    total = pairs.agg(F.coalesce(F.sum("here"), F.lit(0))).first()[0] + 1
    limit = limit or max(LIMIT, int(total**0.5))
    nodes, seed = None, 0
    while nodes is None:
        prefixes = _prefixes(cut, pairs, seed)
        nodes, seed = _nodes(prefixes), seed + 1
    nodes = _with_parents(nodes, limit)
    discard(cut)
    small = nodes.where(f"weight <= {limit}").join(_labels(nodes, limit), "conv_id")
    shards = max(1, -(-total // shard))
    small = materialize(
        _in_shards(small, F.pmod(F.xxhash64("label"), F.lit(shards)), _KEY, ["p1", "p2"], "depth").drop("label"), "subtrees"
    )
    hung = small.where(f"parent_weight > {limit}").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")
    )
    added = {c: F.col(c) + F.coalesce(f"more_{c}", F.lit(0)) for c in ("leaves", "saved")}
    large = materialize(
        nodes.where(f"weight > {limit}").join(hung, _KEY, "left").withColumns(added).drop("more_leaves", "more_saved")
        .withColumn("band", F.expr(f"depth div {limit}")),
        "upper-nodes",
    )
    segments = large.groupBy("conv_id", "band").agg(
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.min("depth").alias("top"),
        F.min_by("parent_conv_id", "depth").alias("up_conv"),
    ).withColumn("up_band", F.expr(f"(top - 1) div {limit}"))
    below = (
        _in_shards(segments, F.lit(0), ["conv_id", "band"], ["up_conv", "up_band"], "top").where("top > 0")
        .groupBy(F.col("up_conv").alias("conv_id"), (F.col("top") - 1).alias("depth"))
        .agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    )
    # What comes from other segments has been added to the nodes where it hangs: only links inside are left.
    inside = F.expr(f"coalesce(parent_conv_id = conv_id AND (depth - 1) div {limit} = band, false)")
    large = _in_shards(
        large.join(below, ["conv_id", "depth"], "left").withColumns(added).drop("more_leaves", "more_saved"),
        F.pmod(F.xxhash64("conv_id", "band"), F.lit(shards)), _KEY, ["p1", "p2"], "depth", inside,
    ).drop("band")
    return small.unionByName(large).join(_ends(prefixes), _KEY, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def op11_prefix_trie(spark, folder: str) -> DataFrame:
    return prefix_trie(read(spark, folder, "conversations"))


OP11_SQL = """
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), left(coalesce(text, ''), 64),
           sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT c, n, xor(list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
           lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
             lambda y, z: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384::BIGINT) ELSE y >> 1 END)
         ), 4294967295::BIGINT) % 9 AS h
  FROM (SELECT c, count(*) AS n FROM t GROUP BY c)
), built AS (
  SELECT o.c, t.pos AS d, t.r, t.x FROM own o JOIN t ON t.c = o.c - o.c % 5 AND t.pos <= o.h
  UNION ALL
  SELECT t.c, t.pos - o.h + least(o.h, coalesce(b.n, 0)), t.r, t.x
  FROM t JOIN own o ON o.c = t.c LEFT JOIN own b ON b.c = o.c - o.c % 5 WHERE t.pos > o.h
), pref AS (
  SELECT c, d, strlen(x) AS size,
         sha256(string_agg(strlen(r) || ':' || strlen(x) || ':' || r || x, '') OVER (PARTITION BY c ORDER BY d)) AS k
  FROM built
  UNION ALL SELECT c, 0, 0, 'root' FROM own
), node AS (
  SELECT k, d, min(c) AS c, count(*) AS n, max(size) AS size FROM pref GROUP BY k, d
), up AS (
  SELECT n.k, p.k AS pk FROM node n JOIN pref p ON p.c = n.c AND p.d = n.d - 1
), kids AS (SELECT pk AS k, count(*) AS n FROM up GROUP BY pk),
below AS (
  SELECT p.k, count(*) FILTER (WHERE kids.n IS NULL) AS leaves, sum((n.n - 1) * n.size) AS saved
  FROM node n JOIN pref p ON p.c = n.c AND p.d <= n.d LEFT JOIN kids ON kids.k = n.k GROUP BY p.k
), ends AS (
  SELECT p.k, sha256(string_agg(p.c::VARCHAR, ',' ORDER BY p.c)) AS sha
  FROM pref p JOIN (SELECT c, max(d) AS d FROM pref GROUP BY c) e ON e.c = p.c AND e.d = p.d GROUP BY p.k
)
SELECT n.c AS conv_id, n.d::BIGINT AS depth, pn.c AS parent_conv_id, n.n AS n_convs, coalesce(kids.n, 0)::BIGINT AS n_children,
       below.leaves::BIGINT AS n_leaves, below.saved::BIGINT AS saved_tokens, coalesce(ends.sha, sha256('')) AS ends_sha256
FROM node n LEFT JOIN up ON up.k = n.k LEFT JOIN node pn ON pn.k = up.pk LEFT JOIN kids ON kids.k = n.k
JOIN below ON below.k = n.k LEFT JOIN ends ON ends.k = n.k
"""
