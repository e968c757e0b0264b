"""Prefix trie: slots, sums over subtrees, and the trie against brute force at every cut."""

import hashlib
import zlib

import numpy as np
import pytest

from duebook.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, c string, _block int, k1 string, depth string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 3, "y", "z") for r in rows], SCHEMA)


def trie(rows):
    """Rows of the contract."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    for c, turns in own.items():
        turns.sort()
        own[c] = [(r, t) for _, _, r, t in turns]

    def base(c):
        return c - int(np.fmod(c, 5))

    members = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        path = tuple(own.get(base(c), [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append((c, d == len(path)))
    out = []
    for path, who in members.items():
        below = [p for p in members if p[: len(path)] == path]
        inner = {p[:-1] for p in members if p}
        ends = ",".join(str(c) for c, end in sorted(who) if end)
        out.append((
            min(who)[0], len(path), min(members[path[:-1]])[0] if path else None, len(who),
            sum(1 for p in members if p and p[:-1] == path), sum(1 for p in below if p not in inner),
            sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def conversations(seed, n=60, long=0):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(-6, n):
        if rng.random() < 0.1:
            continue
        for t in range(int(rng.integers(1, 12))):
            rows.append((c, t, ["user", "assistant"][t % 2], f"t{t} {rng.integers(0, 2)}"))
    rows += [(1000, t, "user", f"long {t} é") for t in range(long)]
    return [rows[i] for i in rng.permutation(len(rows))]


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_slots_are_minimal_perfect_and_verified(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(-(2**63), 2**63 - 1, (n, 2))
    table = prefix_trie.SlotTable(keys)
    assert sorted(table.slots(keys).tolist()) == list(range(n))
    strange = rng.integers(-(2**63), 2**63 - 1, (500, 2))
    assert (table.slots(strange) == -1).all()
    twins = np.stack([np.full(50, 7), np.arange(50)], axis=1)
    assert sorted(prefix_trie.SlotTable(twins).slots(twins).tolist()) == list(range(50))


def test_repeated_key_is_an_error():
    with pytest.raises(ValueError):
        prefix_trie.SlotTable(np.zeros((2, 2), dtype=np.int64))


def test_subtree_sums():
    rng = np.random.default_rng(3)
    keys = np.stack([np.arange(400), np.arange(400) * 3], axis=1)
    up = np.array([0] + [int(rng.integers(0, i)) for i in range(1, 400)])
    depth = np.zeros(400, dtype=np.int64)
    for i in range(1, 400):
        depth[i] = depth[up[i]] + 1
    counts = rng.integers(0, 9, (2, 400))
    want = counts.copy()
    for i in range(399, 0, -1):
        want[:, up[i]] += want[:, i]
    parents = keys[up]
    parents[0] = (-1, -1)
    order = rng.permutation(400)
    got = prefix_trie.subtree_sums(keys[order], parents[order], depth[order], counts[:, order])
    assert (got == want[:, order]).all()


@pytest.mark.parametrize("limit, shard", [(1, 1), (3, 5), (10, 40), (None, 16384)])
def test_trie_at_every_cut(spark, limit, shard):
    """Small limits put most nodes above the shards and cut paths into segments."""
    rows = conversations(1, long=40)
    got = prefix_trie.prefix_trie(frame(spark, rows).repartition(5), limit, shard)
    assert sorted((tuple(r) for r in got.collect()), key=str) == trie(rows)


def test_conversation_over_many_blocks(spark):
    rows = conversations(2, n=10, long=700) + [(1003, t, "user", f"long {t} é") for t in range(300)]
    got = prefix_trie.prefix_trie(frame(spark, rows).repartition(3), 50, 100)
    assert sorted((tuple(r) for r in got.collect()), key=str) == trie(rows)


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "lost"), (1, None, None, None), (1, 0, "", ""), (1, 0, "", ""), (1, 5, "user", "x" * 300_000),
        (2, 0, "a", "b"), (2, 0, "a", "a"), (2, 0, None, "z"), (7, 3, "ab", "c"), (8, 3, "a", "bc"), (5, -1, "user", "é"),
        (-3, 0, "user", "neg"), (10, 0, "user", "copy"), (15, 0, "user", "copy"), (20, 0, "user", "copy"),
    ]
    got = prefix_trie.prefix_trie(frame(spark, rows))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == trie(rows)


@pytest.mark.parametrize("rows", [[], [(None, 0, "user", "a")]])
def test_nothing(spark, rows):
    assert prefix_trie.prefix_trie(frame(spark, rows)).count() == 0


def test_copies_beyond_a_piece_of_ids(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS", 7)
    rows = [(5 * c, 0, "user", "same") for c in range(100)] + [(5 * c, 1, "user", str(c % 3)) for c in range(0, 100, 2)]
    got = prefix_trie.prefix_trie(frame(spark, rows))
    assert sorted((tuple(r) for r in got.collect()), key=str) == trie(rows)


def test_equal_digests_are_drawn_again(spark, monkeypatch):
    """With values that forget the turn, every two turns of one depth collide: seed 0 is refused."""
    real, seeds = prefix_trie._values, []

    def values(depth, turn, seed):
        seeds.append(seed)
        return real(depth, turn if seed else depth.cast("string").cast("binary"), seed)

    monkeypatch.setattr(prefix_trie, "_values", values)
    rows = conversations(4, n=12)
    got = prefix_trie.prefix_trie(frame(spark, rows))
    assert sorted((tuple(r) for r in got.collect()), key=str) == trie(rows) and set(seeds) == {0, 1}
