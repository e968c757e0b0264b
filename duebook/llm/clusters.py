"""Centroid clustering with a vantage-point tree over the centroids.

Vectors become whole numbers, floor(scale * x).  Every round builds a vantage-point tree over
the k centroids, which is broadcast (k and the dimension are parameters, so its size is
bounded), and assigns every vector by best-first branch-and-bound: each vector opens its node
of least lower bound, until no bound is within the pruning radius.  The radius is inclusive:
a node whose bound equals the best distance is opened as well, since it may hold an equally
near centroid of a smaller number.  Bounds are floating point, reduced by more than their
rounding; distances of leaves are exact in 64 bits.  Tasks return one row of sums per
centroid, which are added up exactly; means are rounded down in whole numbers.

Vectors are never shuffled and never gathered: a task holds one Arrow batch and the tree.
"""

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.llm.common import read, small_batches
from duebook.storage import discard, materialize

LIMIT = 1 << 27  # whole components beyond it count as it, so that squared distances fit 64 bits
_LONG = 2**63 - 1
ROWS = 4096  # vectors that a task compares at a time


@dataclass
class Tree:
    """Nodes of a vantage-point tree as arrays; leaves hold centroid numbers."""

    points: np.ndarray  # k x dim whole numbers
    vantage: np.ndarray  # centroid whose distances split a node; -1 for a leaf
    near: np.ndarray  # children of a node
    far: np.ndarray
    low: np.ndarray  # least and largest distance of a node's centroids from its parent's vantage point
    high: np.ndarray
    leaves: dict  # node -> centroid numbers, ascending


def squared(x: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of `x` from one point."""
    gap = x - point
    return np.einsum("ij,ij->i", gap, gap)


def build(points: np.ndarray, leaf: int = 4) -> Tree:
    """Tree over the rows of `points`; equal points end in one leaf, however many they are."""
    vantage, near, far, low, high, leaves = [], [], [], [], [], {}

    def node(members: np.ndarray, lo: float, hi: float) -> int:
        at = len(vantage)
        for column, value in zip((vantage, near, far, low, high), (-1, -1, -1, lo, hi)):
            column.append(value)
        if len(members) <= leaf:
            leaves[at] = np.sort(members)
            return at
        # The member farthest from the first one spreads the others the most.
        pivot = members[np.argmax(squared(points[members], points[members[0]]))]
        away = squared(points[members], points[pivot])
        order = np.argsort(away, kind="stable")
        half = int(np.searchsorted(away[order], away[order][len(order) // 2], side="right"))
        if half == len(order):  # the upper half lies at one distance: cut below it
            half = int(np.searchsorted(away[order], away[order][-1], side="left"))
        if half == 0:
            leaves[at] = np.sort(members)
            return at
        vantage[at] = int(pivot)
        dist = np.sqrt(away[order].astype(float))
        near[at] = node(members[order[:half]], dist[0], dist[half - 1])
        far[at] = node(members[order[half:]], dist[half], dist[-1])
        return at

    if len(points):
        node(np.arange(len(points)), 0.0, np.inf)
    return Tree(points, *(np.array(c) for c in (vantage, near, far, low, high)), leaves)


def assign(tree: Tree, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of every row (ties: the smaller number), its squared distance, and how
    many exact distances were taken.

    All rows step together: in a step each opens the node that is best for itself.
    """
    n = len(x)
    number, best = np.full(n, len(tree.points)), np.full(n, _LONG)
    taken = 0
    bounds = np.full((n, len(tree.vantage)), np.inf)
    bounds[:, 0] = 0.0
    rows = np.arange(n)

    def offer(who, centroid, dist):
        better = (dist < best[who]) | ((dist == best[who]) & (centroid < number[who]))
        best[who[better]], number[who[better]] = dist[better], centroid

    while len(rows):
        choice = np.argmin(bounds[rows], axis=1)
        bound = bounds[rows, choice]
        radius = np.sqrt(best[rows].astype(float))
        open_ = bound <= radius * (1 + 1e-9) + 1e-6  # inclusive, and safe against rounding
        open_ &= np.isfinite(bound)
        rows, choice, bound = rows[open_], choice[open_], bound[open_]
        for at in np.unique(choice):
            picked = choice == at
            who = rows[picked]
            parent_bound = bound[picked]
            bounds[who, at] = np.inf
            if tree.vantage[at] < 0:
                for c in tree.leaves[at]:
                    offer(who, c, squared(x[who], tree.points[c]))
                    taken += len(who)
                continue
            dist = squared(x[who], tree.points[tree.vantage[at]])
            taken += len(who)
            offer(who, tree.vantage[at], dist)
            length = np.sqrt(dist.astype(float))
            for child in (tree.near[at], tree.far[at]):
                apart = np.maximum(tree.low[child] - length, length - tree.high[child])
                bounds[who, child] = np.maximum(parent_bound, apart)
    return number, best, taken


def whole_vectors(vectors: DataFrame, dim: int, scale: int, id_col: str, vec_col: str) -> DataFrame:
    """`vec_id` and `v` (whole numbers) of vectors with `dim` components, none null or non-finite."""
    x = F.col(vec_col).cast("array<double>")
    fine = F.col(vec_col).isNotNull() & (F.size(vec_col) == dim) & ~F.exists(
        x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    )
    to_whole = F.transform(x, lambda c: F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.floor(c * scale))).cast("int"))
    return vectors.where(fine).select(F.col(id_col).cast("long").alias("vec_id"), to_whole.alias("v"))


def first_centroids(kept: DataFrame, k: int, seed: Column) -> np.ndarray:
    """The k vectors of smallest seed; rows without an id start no cluster."""
    rows = (
        kept.where("vec_id IS NOT NULL").orderBy(seed, "v").limit(k).select("v").collect()  # k rows, a parameter
    )
    return np.array([r.v for r in rows], dtype=np.int64)


def _blocks(batches):
    for b in small_batches(batches, ROWS):
        v = b.column("v")
        yield b, v.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(b.num_rows, -1)


def _sums(kept: DataFrame, tree: Tree) -> list:
    """(centroid, component, exact sum, count): k x dim rows."""
    shared = kept.sparkSession.sparkContext.broadcast(tree)

    def run(batches):
        k, dim = shared.value.points.shape
        total, count = np.zeros((k, dim), dtype=object), np.zeros(k, dtype=np.int64)
        for _, x in _blocks(batches):
            number, _, _ = assign(shared.value, x)
            part = np.zeros((k, dim), dtype=np.int64)  # 4,096 rows of at most 2^27 each
            np.add.at(part, number, x)
            total += part
            count += np.bincount(number, minlength=k)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array([[str(c) for c in total[c]] for c in some], pa.list_(pa.string())),
             pa.array(count[some], pa.int64())],
            ["cluster", "sums", "n"],
        )

    parts = kept.select("v").mapInArrow(run, "cluster int, sums array<string>, n long")
    rows = (
        parts.select("cluster", "n", F.posexplode("sums").alias("at", "s"))
        .groupBy("cluster", "at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n"))
        .collect()
    )
    shared.unpersist()
    return rows


def cluster(
    vectors: DataFrame, k: int = 16, rounds: int = 3, dim: int = 64, scale: int = 64, leaf: int = 4,
    id_col="vec_id", vec_col="embedding", seed: Column | None = None,
) -> tuple[DataFrame, np.ndarray]:
    """(`vec_id`, `cluster`, `distance`) of every kept row, and the centroids.

    Kept are rows whose vector has exactly `dim` components, none null or non-finite; other
    rows are left out.  Start centroids are the `k` kept rows of smallest `seed` (fewer rows:
    fewer centroids); equal seeds go by the vector.  A row without an id is assigned and
    counted but starts no cluster; if no row has an id there are no clusters and no rows come
    back.  Repeated rows count as often as they stand there, repeated start vectors make equal
    centroids, of which the smaller number gets all ties and the other stays where it is.
    Components beyond 2^27 after scaling count as 2^27.  Other columns are ignored, so their
    names cannot clash.  An empty table gives no rows.
    """
    spark = vectors.sparkSession
    kept = materialize(whole_vectors(vectors, dim, scale, id_col, vec_col), "vectors")
    seed = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256) if seed is None else seed
    points = first_centroids(kept, k, seed)
    if not len(points):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), points.reshape(0, dim)
    for _ in range(rounds):
        moved = points.copy()
        for r in _sums(kept, build(points, leaf)):
            moved[r.cluster, r.at] = int(r.s) // int(r.n)
        points = moved
    shared = spark.sparkContext.broadcast(build(points, leaf))

    def run(batches):
        for b, x in _blocks(batches):
            number, dist, _ = assign(shared.value, x)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), pa.array(number, pa.int32()), pa.array(dist, pa.int64())],
                ["vec_id", "cluster", "distance"],
            )

    found = materialize(kept.mapInArrow(run, "vec_id long, cluster int, distance long"), "assigned")
    discard(kept)
    return found, points


def with_inertia(found: DataFrame, points: np.ndarray) -> DataFrame:
    """Adds the inertia of the cluster and of all, and the digest of the centroid."""
    per = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("own")).collect()  # at most k rows
    own = {r.cluster: int(r.own) for r in per}
    facts = found.sparkSession.createDataFrame(
        [(c, min(own[c], _LONG), min(sum(own.values()), _LONG),
          hashlib.sha256(",".join(map(str, points[c].tolist())).encode()).hexdigest()) for c in sorted(own)],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return found.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def op13_centroid_clusters(spark, folder: str) -> DataFrame:
    return with_inertia(*cluster(read(spark, folder, "embeddings")))


def _round(i: int) -> str:
    """SQL of one assignment `a<i>` and of the centroids `c<i + 1>` after it."""
    return f""", a{i} AS (
  SELECT id, vec_id, v, cluster, distance FROM (
    SELECT k.id, k.vec_id, k.v, c.cluster, d.distance,
           row_number() OVER (PARTITION BY k.id ORDER BY d.distance, c.cluster) AS place
    FROM kept k, c{i} c, LATERAL (SELECT list_sum(list_transform(list_zip(k.v, c.p), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS distance) d
  ) WHERE place = 1
), s{i} AS (
  SELECT cluster, place, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n
  FROM (SELECT cluster, unnest(v) AS x, unnest(range(1, 65)) AS place FROM a{i}) GROUP BY ALL
), c{i + 1} AS (
  SELECT cluster, p FROM c{i} WHERE cluster NOT IN (SELECT cluster FROM s{i})
  UNION ALL
  SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY place) FROM s{i} GROUP BY cluster
)"""


OP13_SQL = f"""
WITH kept AS (
  SELECT row_number() OVER () AS id, vec_id,
         list_transform(embedding, lambda x: greatest(-{LIMIT}, least({LIMIT}, floor(64 * x::DOUBLE)))::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS (
  SELECT (row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1)::INTEGER AS cluster, v AS p
  FROM kept WHERE vec_id IS NOT NULL QUALIFY cluster < 16
){"".join(_round(i) for i in range(4))}
SELECT a.vec_id, a.cluster, a.distance, sum(a.distance) OVER (PARTITION BY a.cluster)::BIGINT AS cluster_inertia,
       sum(a.distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.p, ',')) AS centroid_sha256
FROM a3 a JOIN c3 c USING (cluster)
"""
