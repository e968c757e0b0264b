"""Near-duplicate documents by bottom-k sketches of one hash function.

1. A document's shingles are hashed once.  Equal sets (copies) become one class, which is
   known by a 64-bit fingerprint; its sketch keeps the `K` smallest hashes of the set.
2. Inverted lists: a key is made of `RUN` neighbouring values of a sketch.  Two sets that
   agree in 80% share such a run: always, when the sketch holds the whole set (among the
   runs that at most 20% of foreign values leave in the union, one has 3 values if the union
   has 6; sets of up to 5 use runs of 2 as well), and else with a probability of all but 0.697^64 < 1e-10.
3. Each list hangs its classes on its smallest one, its centre.  All classes of a centre
   form a canopy; classes that share any list are together in a canopy, and a class is in a
   canopy once, however many lists it shares.  No pair is ever written.
4. A canopy is cut into cells of bounded size.  Inside a cell the union of two sketches
   estimates the Jaccard index of every pair and drops hopeless ones (a pair at the threshold,
   of sets above the sketch, with a probability of 2e-8); full sets verify the rest.  A cell returns its components, each as a star.  The centre goes to every cell.
5. For canopies of several cells, classes that are already connected to the largest part of
   the canopy need no more comparing among themselves; the others meet everything that they
   have not met, again in cells.
6. Components of the links give every class its smallest document.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.llm.common import packed, read, row_key, small_batches
from duebook.llm.components import components
from duebook.llm.hashing import slices
from duebook.storage import materialize

K = 64
RUN = 3
CELL = 256
# Estimates below threshold - SLACK are dropped: over five standard deviations of a K of 64.
SLACK = 0.3
_BLOCK_WORDS = 1 << 16


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a whole text, A-Z lower-cased."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    found = []
    for at in range(0, max(1, len(words) - size + 1), _BLOCK_WORDS):
        part = words[at: at + _BLOCK_WORDS + size - 1]
        lengths = np.fromiter(map(len, part), dtype=np.int64, count=len(part))
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        n = max(1, len(part) - size + 1)
        found.append(slices(b" ".join(part), starts[:n], ends[min(size, len(part)) - 1:]))
    h = np.sort(np.concatenate(found))
    return h[np.concatenate(([True], h[1:] != h[:-1]))]


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """_id, _fp, doc_id, cid (fingerprint of the set, null when empty), n, sketch."""

    def run(batches):
        for b in small_batches(batches):
            cids, ns, sketches = [], [], []
            for t in b.column("_text"):
                s = shingle_set(t.as_py(), size)
                ns.append(len(s))
                cids.append(int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True) if len(s) else None)
                sketches.append((s[:K] >> np.uint64(32)).astype(np.uint32).view(np.int32).tolist())
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), b.column("_fp"), b.column("doc_id"), pa.array(cids, pa.int64()),
                 pa.array(ns, pa.int64()), pa.array(sketches, pa.list_(pa.int32()))],
                ["_id", "_fp", "doc_id", "cid", "n", "sketch"],
            )

    rows = docs.select(*row_key(), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("_text"))
    return rows.mapInArrow(run, "_id long, _fp long, doc_id long, cid long, n long, sketch array<int>")


def _keys(sketch: Column, n: Column) -> Column:
    """Keys of a sketch; sets of up to five shingles have keys of two values as well."""

    def runs(length):
        last = F.size(sketch) - length
        return F.when(
            last >= 0,
            F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                        lambda i: F.xxhash64(*[F.get(sketch, i + j) for j in range(length)], F.lit(length))),
        ).otherwise(F.array().cast("array<bigint>"))

    return F.when(n <= 5, F.concat(runs(2), runs(RUN))).otherwise(runs(RUN))


def links_of(cids: np.ndarray, sets: list, threshold: int) -> list[tuple[int, int]]:
    """Components of the pairs with 100 * |A & B| >= threshold * |A | B|, as a star each.

    `cids` are in ascending order.
    """
    m = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)

    def overlaps(parts):
        flat = np.concatenate(parts)
        owner = np.repeat(np.arange(m), [len(p) for p in parts])
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        new = np.concatenate(([True], flat[1:] != flat[:-1]))
        value = np.cumsum(new) - 1
        shared = np.bincount(value)[value] > 1
        value, owner = value[shared], owner[shared]
        _, column = np.unique(value, return_inverse=True)
        out = np.zeros((m, m), dtype=np.int64)
        for at in range(0, int(column.max(initial=-1)) + 1, 8192):
            lo, hi = np.searchsorted(column, (at, at + 8192))
            x = np.zeros((m, min(8192, int(column[hi - 1]) - at + 1)), dtype=np.float32)
            x[owner[lo:hi], column[lo:hi] - at] = 1
            out += (x @ x.T).astype(np.int64)
        return out

    # Both sketches cut at the smaller of their largest values: a sketch of the union.
    heads = [s[:K] for s in sets]
    ends = np.array([h[-1] if len(s) > K else np.iinfo(np.uint64).max for h, s in zip(heads, sets)], dtype=np.uint64)
    below = np.array([np.searchsorted(h, ends, side="right") for h in heads])
    common = overlaps(heads)
    near = sizes[:, None] * 100 >= threshold * sizes[None, :]
    maybe = near & near.T & (common > 0)
    maybe &= common >= (threshold / 100 - SLACK) * (below + below.T - common)
    np.fill_diagonal(maybe, False)
    some = np.flatnonzero(maybe.any(axis=1))
    if not len(some):
        return []
    sets, sizes, cids, m = [sets[i] for i in some], sizes[some], cids[some], len(some)
    full = overlaps(sets)
    linked = maybe[np.ix_(some, some)] & (100 * full >= threshold * (sizes[:, None] + sizes[None, :] - full))
    out, left = [], np.ones(m, dtype=bool)
    for start in range(m):
        if not left[start]:
            continue
        left[start], todo = False, [start]
        while todo:
            i = todo.pop()
            found = np.flatnonzero(linked[i] & left)
            left[found] = False
            # Ids come in order, so `start` has the smallest of its component.
            out += [(int(cids[start]), int(cids[j])) for j in found]
            todo += found.tolist()
    return out


def _cells(rows: DataFrame, keys: list[str], threshold: int) -> DataFrame:
    """Links (a, b) of the classes (cid, set) that meet in a cell of `keys`."""

    def cell(table: pa.Table) -> pa.Table:
        first = {}
        for c, s in zip(table.column("cid").to_pylist(), table.column("set").to_pylist()):
            first.setdefault(c, s)
        cids = np.array(sorted(first), dtype=np.int64)
        sets = [np.frombuffer(first[c], dtype=np.uint64) for c in cids.tolist()]
        found = links_of(cids, sets, threshold) if len(sets) > 1 else []
        return pa.table({
            "a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())
        })

    return rows.groupBy(*keys).applyInArrow(cell, "a long, b long")


def _block(c: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(c, F.lit("cell")), blocks)


def _upto(n: Column) -> Column:
    return F.sequence(F.lit(0).cast("long"), n.cast("long") - 1)


def _rest(members: DataFrame, sets: DataFrame, labels: DataFrame, threshold: int) -> DataFrame:
    """Links of canopies of several cells that their first cells could not see.

    `labels` has the components (node, label) so far.
    """
    wide = members.where("cells > 1")
    placed = materialize(
        wide.join(labels, wide["cid"] == labels["node"], "left")
        .select("centre", "cid", F.coalesce("label", "cid").alias("label")),
        "near-placed",
    )
    parts = placed.groupBy("centre", "label").agg(F.count("*").alias("n"))
    main = parts.groupBy("centre").agg(
        F.max_by("label", F.struct("n", "label")).alias("main"), F.max("n").alias("n_in"), F.sum("n").alias("n_all")
    )
    blocks = main.where("n_all > n_in").select(
        "centre", "main", F.ceil((F.col("n_all") - F.col("n_in")) / CELL).cast("long").alias("outs"),
        F.ceil(F.col("n_in") / CELL).cast("long").alias("ins"),
    )
    at = placed.join(blocks, "centre")
    outside, inside = at.where("label <> main"), at.where("label = main")
    own = _block(F.col("cid"), F.col("outs"))
    among = outside.select(
        "centre", "cid", F.lit(0).alias("kind"), own.alias("_o"), F.explode(_upto(F.col("outs"))).alias("_x")
    ).select("centre", "cid", "kind", F.least("_o", "_x").alias("i"), F.greatest("_o", "_x").alias("j"))
    against = outside.select(
        "centre", "cid", F.lit(1).alias("kind"), own.alias("i"), F.explode(_upto(F.col("ins"))).alias("j")
    ).unionByName(
        inside.select("centre", "cid", F.lit(1).alias("kind"), F.explode(_upto(F.col("outs"))).alias("i"),
                      _block(F.col("cid"), F.col("ins")).alias("j"))
    )
    rows = among.unionByName(against).join(sets, "cid")
    return _cells(rows, ["centre", "kind", "i", "j"], threshold)


def near_duplicates(docs: DataFrame, size: int = 4, threshold: int = 80) -> DataFrame:
    """_id, _fp, doc_id, n_shingles, component_id, rep_id, rep_fp: one row per row of `docs`.

    Documents are linked when the Jaccard index of their sets of `size`-word shingles is at
    least `threshold` percent; a shorter text is one shingle.  Texts without words (null,
    empty, blank) are linked with nothing and are their own component.  `component_id` is the
    smallest doc_id reachable (null when the component has none); `rep_id`, `rep_fp` is the
    row key of the one document of the component to keep.  Shingles and sets are compared by
    64-bit hashes.  Columns other than doc_id and text are ignored; an empty table gives none.
    """
    facts = materialize(_sets(docs, size), "near-sets")
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("_id"), F.col("_fp"))
    classes = materialize(
        facts.where("cid is not null").groupBy("cid").agg(
            F.min(key).alias("rep"), F.min("doc_id").alias("least"),
            F.any_value("n").alias("n"), F.any_value("sketch").alias("sketch"),
        ),
        "near-classes",
    )
    postings = classes.select("cid", F.explode(F.array_distinct(_keys(F.col("sketch"), F.col("n")))).alias("key"))
    lists = postings.groupBy("key").agg(F.min("cid").alias("centre"), F.count("*").alias("_n")).where("_n > 1")
    member = materialize(
        postings.join(lists.select("key", "centre"), "key").groupBy("centre", "cid").agg(F.lit(1).alias("_one")).drop("_one"),
        "near-members",
    )
    cells = member.groupBy("centre").agg(F.ceil(F.count("*") / CELL).cast("long").alias("cells"))
    members = materialize(member.join(cells, "centre"), "near-canopies")

    def full(batches):
        for b in small_batches(batches):
            sets = [shingle_set(t.as_py(), size).tobytes() for t in b.column("_text")]
            yield pa.RecordBatch.from_arrays([b.column("cid"), pa.array(sets, pa.binary())], ["cid", "set"])

    wanted = classes.join(members.select("cid").distinct(), "cid").select(
        "cid", F.col("rep._id").alias("_id"), F.col("rep._fp").alias("_fp")
    )
    sets = materialize(
        docs.select(*row_key(), F.col("text").alias("_text")).join(wanted, ["_id", "_fp"])
        .select("cid", "_text").mapInArrow(full, "cid long, set binary"),
        "near-full",
    )
    spread = members.select("centre", "cid", _block(F.col("cid"), F.col("cells")).alias("cell")).unionByName(
        members.where("cid = centre and cells > 1").select("centre", "cid", F.explode(_upto(F.col("cells"))).alias("cell"))
    )
    links = materialize(_cells(spread.join(sets, "cid"), ["centre", "cell"], threshold), "near-links")
    labels = materialize(components(links, "a", "b"), "near-labels")
    if not members.where("cells > 1").isEmpty():
        more = materialize(_rest(members, sets, labels, threshold), "near-links")
        known = labels.select(F.col("node").alias("a"), F.col("label").alias("b"))
        labels = materialize(components(known.unionByName(more), "a", "b"), "near-labels")
    owned = classes.join(labels, classes["cid"] == labels["node"], "left").select(
        "cid", "rep", "least", F.coalesce("label", "cid").alias("label")
    )
    groups = owned.groupBy("label").agg(F.min("rep").alias("rep"), F.min("least").alias("component_id"))
    named = materialize(owned.select("cid", "label").join(groups, "label").drop("label"), "near-groups")
    return facts.drop("sketch").join(named, "cid", "left").select(
        "_id", "_fp", "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("cid").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("rep._id", "_id").alias("rep_id"), F.coalesce("rep._fp", "_fp").alias("rep_fp"),
    )


def dedup(docs: DataFrame, size: int = 5, threshold: int = 80) -> DataFrame:
    """Rows of `docs` with one document of every group; rows that repeat it go as well."""
    found = near_duplicates(docs, size, threshold)
    stay = found.where("_id = rep_id and _fp = rep_fp").select("_id", "_fp").distinct()
    rows = docs.select(packed(docs), *row_key()).join(stay, ["_id", "_fp"])
    return rows.groupBy("_id", "_fp").agg(F.any_value("_row").alias("_row")).select("_row.*")


def op3_minhash_dedup(spark, folder: str) -> DataFrame:
    found = near_duplicates(read(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_shingles", "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"),
    )


OP3_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' ')) END) AS s FROM w
), c AS (
  SELECT min(doc_id) AS c, len(s) AS n, s FROM (SELECT doc_id, list_sort(s) AS s FROM s WHERE len(s) > 0) GROUP BY s
), e AS (
  SELECT c, n, unnest(s) AS g FROM c
), f AS (
  SELECT g FROM e GROUP BY g HAVING count(*) > 1
), p AS (
  SELECT a.c AS a, b.c AS b FROM e a JOIN f ON a.g = f.g JOIN e b ON b.g = f.g
  WHERE a.c < b.c AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), l AS (
  SELECT a, b FROM p UNION SELECT b, a FROM p
), reach(x, y) AS (
  SELECT c, c FROM c UNION SELECT reach.x, l.b FROM reach JOIN l ON reach.y = l.a
), m AS (
  SELECT x, min(y) AS y FROM reach GROUP BY x
)
SELECT s.doc_id, len(s.s) AS n_shingles, coalesce(m.y, s.doc_id) AS component_id, s.doc_id = coalesce(m.y, s.doc_id) AS kept
FROM s LEFT JOIN c ON list_sort(s.s) = c.s AND len(s.s) > 0 LEFT JOIN m ON m.x = c.c
"""
