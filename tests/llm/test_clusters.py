"""Centroid clustering: the tree against brute force, odd rows, ties."""

import hashlib

import numpy as np
import pytest

from duebook.llm import clusters

SCHEMA = "vec_id long, embedding array<float>, label int, v int, cluster string, distance string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "x", "y") for i, v in rows], SCHEMA)


@pytest.mark.parametrize("k", [1, 2, 5, 17, 200])
@pytest.mark.parametrize("spread", [2, 1000])
def test_tree_finds_the_nearest(k, spread):
    """A small spread makes many equal distances and equal centroids."""
    rng = np.random.default_rng(k)
    points = rng.integers(-spread, spread, (k, 6))
    x = np.vstack([rng.integers(-spread, spread, (300, 6)), points])
    number, dist, taken = clusters.assign(clusters.build(points), x)
    plain = ((x[:, None, :] - points[None]) ** 2).sum(axis=2)
    assert (dist == plain.min(axis=1)).all() and (number == plain.argmin(axis=1)).all()
    assert taken <= 2 * plain.size


def test_tree_leaves_far_centroids_out():
    rng = np.random.default_rng(1)
    points = rng.integers(-(2**20), 2**20, (256, 3))
    x = points[rng.integers(0, 256, 2000)] + rng.integers(-9, 9, (2000, 3))
    number, dist, taken = clusters.assign(clusters.build(points), x)
    plain = ((x[:, None, :] - points[None]) ** 2).sum(axis=2)
    assert (number == plain.argmin(axis=1)).all() and taken < 0.3 * plain.size


def test_largest_components_stay_exact():
    points = np.array([[clusters.LIMIT] * 64, [-clusters.LIMIT] * 64])
    _, dist, _ = clusters.assign(clusters.build(points[:1]), points)
    assert dist.tolist() == [0, 64 * (2 * clusters.LIMIT) ** 2]


def lloyd(rows, k, rounds, scale, dim):
    """{place in rows: (cluster, distance)} and centroids."""
    kept = [(n, i, [min(clusters.LIMIT, max(-clusters.LIMIT, int(np.floor(scale * c)))) for c in v])
            for n, (i, v) in enumerate(rows)
            if v is not None and len(v) == dim and all(c is not None and np.isfinite(c) for c in v)]
    start = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for _, i, v in kept if i is not None)[:k]
    points = [v for _, v in start]

    def nearest():
        return {n: min((sum((a - b) ** 2 for a, b in zip(v, p)), c) for c, p in enumerate(points))[::-1] for n, _, v in kept}

    for _ in range(rounds if points else 0):
        at = nearest()
        for c in range(len(points)):
            mine = [v for n, _, v in kept if at[n][0] == c]
            if mine:
                points[c] = [sum(x) // len(mine) for x in zip(*mine)]
    return (nearest() if points else {}), points


def test_odd_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=4)]) for i in range(60)]
    rows += [(100, None), (101, []), (102, [1.0, 2.0, 3.0]), (103, [1.0, None, 2.0, 3.0]), (104, [float("nan")] * 4),
             (105, [float("inf"), 0.0, 0.0, 0.0]), (None, [0.5] * 4), (5, rows[5][1]), (5, rows[5][1]), (5, [9.0] * 4),
             (106, [3.0e38, -3.0e38, 0.0, 0.0]), (-7, [0.25] * 4)]
    found, points = clusters.cluster(frame(spark, rows), k=7, dim=4)
    want, centres = lloyd(rows, 7, 3, 64, 4)
    key = lambda x: (x[0] is None, x)
    got = sorted(((r.vec_id, r.cluster, r.distance) for r in found.collect()), key=key)
    assert got == sorted(((rows[n][0], c, d) for n, (c, d) in want.items()), key=key)
    assert points.tolist() == centres
    full = clusters.with_inertia(found, points)
    assert full.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    sums = {}
    for _, c, d in got:
        sums[c] = sums.get(c, 0) + d
    for r in full.collect():
        assert r.cluster_inertia == sums[r.cluster] and r.inertia == sum(sums.values())
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centres[r.cluster])).encode()).hexdigest()


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, [1.0] * 4)], [(1, [1.0] * 4)], [(1, [1.0] * 4)] * 3])
def test_few_rows(spark, rows):
    found, points = clusters.cluster(frame(spark, rows), k=4, dim=4)
    got = clusters.with_inertia(found, points).collect()
    want, _ = lloyd(rows, 4, 3, 64, 4)
    assert sorted((r.cluster, r.distance) for r in got) == sorted(want.values())
