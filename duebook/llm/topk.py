"""Exact top-k search by inner product with multi-resolution segment statistics.

Vectors are cut into segments, at several resolutions.  A segment is kept as its mean and its
deviation (the length of what is left of it after the mean).  From them the distance of two
vectors has the lower bound  sum len * (mean - mean')^2 + (dev - dev')^2,  and with the
lengths of both an upper bound of their inner product.  Bounds are taken coarse to fine; at
every resolution the pairs of highest bounds are scored exactly, which raises the k-th score
that others must reach, and pairs that cannot reach it drop out.  Survivors are scored exactly
in whole numbers: pair by pair where few are left, else all rows of the columns that are left.

Queries meet candidates in blocks of fixed size, so neither side is held whole by a task and
nothing is broadcast; a block returns k rows per query.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duebook.llm.common import read
from duebook.storage import materialize

_EXACT = 2.0**53
_LONG = 2**63 - 1
QUERIES = 128  # queries of a block that are compared at a time


def segment_stats(x: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, means and deviations of `parts` segments of the rows of `x`."""
    cuts = np.linspace(0, x.shape[1], min(parts, max(1, x.shape[1])) + 1).astype(int)
    length = np.diff(cuts).astype(float)
    means = np.stack([x[:, a:b].mean(axis=1) for a, b in zip(cuts, cuts[1:])], axis=1)
    rest = [x[:, a:b] - means[:, i: i + 1] for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    return length, means, np.stack([np.sqrt((r * r).sum(axis=1)) for r in rest], axis=1)


def _level(x: np.ndarray, parts: int) -> np.ndarray:
    """Rows whose squared distances are the lower bounds of this resolution."""
    length, means, devs = segment_stats(x, parts)
    return np.hstack([means * np.sqrt(length), devs])


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of rows of whole numbers; beyond 64 bits they stop at the largest long."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, x.shape[1])
    if top < _EXACT:
        return np.rint(q @ x.T).astype(np.int64)
    qs, xs = [[int(c) for c in r] for r in q.tolist()], [[int(c) for c in r] for r in x.tolist()]
    whole = [[max(-_LONG, min(_LONG, sum(map(int.__mul__, a, c)))) for c in xs] for a in qs]
    return np.array(whole, dtype=np.int64).reshape(len(qs), len(xs))


def pair_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of row i of `q` with the rows of x[i], as `exact_scores` gives them."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, x.shape[2])
    if top < _EXACT:
        return np.rint(np.einsum("rd,rkd->rk", q, x)).astype(np.int64)
    return np.array([exact_scores(q[i: i + 1], x[i])[0] for i in range(len(q))], dtype=np.int64).reshape(x.shape[:2])


FEW = 0.1  # share of pairs below which survivors are scored one by one


def search_block(qids, quids, q, xids, xuids, x, k: int, levels=(1, 4, 16, 32), tally: list | None = None):
    """Best k rows of the block for each query: (query number, candidate number, score).

    `tally` gets (pairs scored exactly, pairs) of every group of queries.
    """
    if not len(q) or not len(x):
        return []
    q2, x2 = (q * q).sum(axis=1), (x * x).sum(axis=1)
    # Half of |q|^2 + |x|^2 - distance^2, with the squares of both sides taken out once.
    stats = []
    for lq, lx in ((_level(q, p), _level(x, p)) for p in levels if x.shape[1]):
        stats.append((lq, lx, (q2 - (lq * lq).sum(axis=1)) / 2, (x2 - (lx * lx).sum(axis=1)) / 2))
    own = {int(u): i for i, u in enumerate(xuids)}
    out = []
    for at in range(0, len(q), QUERIES):
        part = slice(at, at + QUERIES)
        alive = np.ones((len(q[part]), len(x)), dtype=bool)
        for i, u in enumerate(quids[part]):
            if int(u) in own:
                alive[i, own[int(u)]] = False
        cols, floor, scored = np.arange(len(x)), np.full(len(alive), -np.inf), 0
        for lq, lx, cq, cx in stats:
            if len(cols) <= k:
                break
            upper = lq[part] @ lx[cols].T + cq[part][:, None] + cx[cols][None, :]
            # Rounding of the bounds must never drop a true result.
            upper += 1e-9 * (q2[part][:, None] + x2[cols][None, :]) + 1.0
            here = alive[:, cols]
            probe = np.argpartition(np.where(here, -upper, np.inf), k - 1, axis=1)[:, :k]
            known = pair_scores(q[part], x[cols[probe]])
            full = np.take_along_axis(here, probe, axis=1).all(axis=1)
            floor = np.maximum(floor, np.where(full, known.min(axis=1), -np.inf))
            scored += probe.size
            here &= ~(upper < floor[:, None])
            alive[:, cols] = here
            cols = cols[here.any(axis=0)]
        here = alive[:, cols]
        if here.sum() < FEW * here.size:
            scores = np.zeros(here.shape, dtype=np.int64)
            for i, row in enumerate(here):
                left = np.flatnonzero(row)
                scores[i, left] = exact_scores(q[part][i: i + 1], x[cols[left]])[0]
            scored += int(here.sum())
        else:
            scores = exact_scores(q[part], x[cols])
            scored += here.size
        if tally is not None:
            tally.append((scored, alive.size))
        for i in range(len(here)):
            left = np.flatnonzero(here[i])
            if len(left) > k:
                least = np.partition(scores[i, left], -k)[-k]
                left = left[scores[i, left] >= least]
            best = left[np.lexsort((xids[cols[left]], -scores[i, left]))[:k]]
            out += [(at + i, int(cols[j]), int(scores[i, j])) for j in best]
    return out


def top_k(
    vectors: DataFrame, is_query, k: int = 5, query_block: int = 4096, row_block: int = 8192,
    id_col="vec_id", vec_col="embedding", scale: int = 256,
) -> DataFrame:
    """query_id, rank, vec_id, score: the `k` highest inner products of every query row.

    Components become floor(scale * x).  Vectors that are null or hold a null or non-finite
    component take no part, nor do rows with a null id; vectors of different lengths are not
    compared.  Ties go to the smaller id.  A row is never its own candidate, but another row
    with the same id is one, and a repeated query row gets its rows again.
    """
    v = F.transform(F.col(vec_col).cast("array<double>"), lambda x: F.floor(x * scale).cast("double"))
    fine = F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & ~F.exists(
        F.col(vec_col).cast("array<double>"),
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")),
    )
    rows = materialize(
        vectors.where(fine).select(F.col(id_col).cast("long").alias("id"), is_query.alias("is_q"), v.alias("v"))
        .withColumn("uid", F.monotonically_increasing_id()).withColumn("dim", F.size("v")),
        "vectors",
    )
    n = rows.agg(F.count("*"), F.count(F.when(F.col("is_q"), 1))).first()
    x_blocks, q_blocks = max(1, -(-n[0] // row_block)), max(1, -(-n[1] // query_block))
    # Blocks by hash of the row number: equal vectors and a busy id are spread like all others.
    x_of, q_of = F.pmod(F.hash("uid"), F.lit(x_blocks)), F.pmod(F.hash("uid"), F.lit(q_blocks))
    candidates = rows.select(
        "dim", x_of.alias("xb"), F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("qb"), "id", "uid", "v",
        F.lit(False).alias("q"),
    )
    queries = rows.where("is_q").select(
        "dim", F.explode(F.sequence(F.lit(0), F.lit(x_blocks - 1))).alias("xb"), q_of.alias("qb"), "id", "uid", "v",
        F.lit(True).alias("q"),
    )

    def cell(table: pa.Table) -> pa.Table:
        flag = np.array(table.column("q").to_pylist(), dtype=bool)
        ids, uids = table.column("id").to_numpy(), table.column("uid").to_numpy()
        dim = table.column("dim")[0].as_py()
        v = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), dim)
        got = search_block(ids[flag], uids[flag], v[flag], ids[~flag], uids[~flag], v[~flag], k)
        qi, qu, xi = ids[flag], uids[flag], ids[~flag]
        return pa.table({
            "query_id": pa.array([int(qi[i]) for i, _, _ in got], pa.int64()),
            "quid": pa.array([int(qu[i]) for i, _, _ in got], pa.int64()),
            "vec_id": pa.array([int(xi[j]) for _, j, _ in got], pa.int64()),
            "score": pa.array([s for _, _, s in got], pa.int64()),
        })

    found = candidates.unionByName(queries).groupBy("dim", "xb", "qb").applyInArrow(
        cell, "query_id long, quid long, vec_id long, score long"
    )
    best = Window.partitionBy("quid").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op10_top_k(spark, folder: str) -> DataFrame:
    return top_k(read(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


OP10_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""
