"""Exact removal of repeated byte strings by bucket-pointer refinement.

A position is removed when a string of `LENGTH` bytes that covers it starts anywhere else.
The suffixes are put into buckets by a first q-gram and buckets are refined by the bucket
identifiers at later offsets, as in bucket-pointer refinement; the refined identifiers are
used again in the next round.  An identifier is a 64-bit name of the bytes it stands for, so
it means the same in every task: the name of 2L bytes at p is made of the names of L bytes at
p and at p + L.

* First buckets.  Of the q-grams inside a string of LENGTH bytes the one with the smallest
  name, the leftmost of equals, is its anchor.  Equal strings have equal anchors at equal
  places, so only anchors need buckets, about one position in 120.
* Refinement.  An anchor stands for the strings that have it, a run of up to SPAN starts.  A
  node is a range of these starts.  Its core, the bytes that all strings of its cell of a
  fixed grid share, names its bucket; its whole, the bytes that any of its strings covers, is
  the bucket it is refined to.  Nodes whose core occurs once hold no repeat.  Nodes whose
  whole occurs again are repeats as a whole: all are marked, and one of them goes on as a
  witness for others.  The rest is cut along a finer grid and refined again, down to single
  strings.
* Texts stay in their rows: each round joins its open nodes to the texts and takes names of
  their parts; only names travel.

The same refinement works on words: a text is then a string of word names, and a passage counts
where its bucket holds strings of several texts (`shared_passages`).
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duebook.llm.common import packed, read, row_key, small_batches
from duebook.llm.hashing import byte_values, mix, slices
from duebook.storage import discard, materialize

LENGTH = 400
CHUNK = 1 << 18  # bytes or words whose names are taken together


@dataclass(frozen=True)
class Unit:
    """What strings are made of, how long a repeat is, and the grids of the rounds."""

    length: int
    span: int  # starts of strings that share an anchor: cells of the first round
    steps: tuple  # cells of the grid in each later round
    words: bool = False  # words instead of bytes
    across: bool = False  # only what stands in several texts is a repeat

    @property
    def q(self) -> int:
        return self.length - self.span + 1


BYTES = Unit(LENGTH, 240, (64, 8, 1))
PASSAGES = Unit(51, 26, (5, 1), words=True, across=True)  # more than fifty words
_HIGH, _LOW = np.uint64(0xFFFFFFFF00000000), np.uint64(0xFFFFFFFF)
_A, _B = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xCA5A826395121157)


def _pair(first: np.ndarray, later: np.ndarray) -> np.ndarray:
    """Name of a string from those of its parts."""
    x = first * _A + later
    x ^= x >> np.uint64(32)
    return x * _B


class Names:
    """Names of the strings of a text: of every 2^i bytes, and from those of any length."""

    def __init__(self, data: np.ndarray, most: int = 256):
        self.n, self.levels = len(data), [byte_values(data) if data.dtype == np.uint8 else data]
        while 2 ** len(self.levels) <= min(most, self.n):
            last, half = self.levels[-1], 2 ** (len(self.levels) - 1)
            self.levels.append(_pair(last[:-half], last[half:]))

    def all(self, length: int) -> np.ndarray:
        """Names of the strings of `length` bytes at every position."""
        i = length.bit_length() - 1
        level = self.levels[i]
        m = self.n - length + 1
        return level[:m] if 2**i == length else _pair(level[:m], level[length - 2**i: length - 2**i + m])

    def at(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Names of the strings from starts to ends (of any lengths)."""
        out = np.zeros(len(starts), dtype=np.uint64)
        lengths = ends - starts
        top = np.minimum(np.frexp(lengths.astype(float))[1] - 1, len(self.levels) - 1)
        for i in np.unique(top):
            rows, size = np.flatnonzero(top == i), 2 ** int(i)
            s, e, level = starts[rows], ends[rows], self.levels[int(i)]
            name = _pair(level[s], level[e - size])
            more = e - s > 2 * size  # strings of more than two pieces: the pieces between
            at = s + size
            while more.any():
                name[more] = _pair(name[more], level[np.minimum(at, e - size)[more]])
                at = at + size
                more &= e - at > size
            out[rows] = _pair(name, (e - s).astype(np.uint64))
        return mix(out)


def _slide(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every `width` neighbours."""
    step = 1
    while step * 2 <= width:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    return x if step == width else np.minimum(x[: len(x) - (width - step)], x[width - step:])


def _utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a text column as they lie in memory; null is empty."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=kind)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    return at, np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _word_names(column) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and names of the words of a text column; null is empty."""
    offsets, data = _utf8(column)
    ends, names, count = [0], [], 0
    for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        while start < end:
            # Long texts go in pieces that end at white space.
            stop = min(end, start + CHUNK)
            while stop < end and not _SPACE[data[stop]]:
                stop += 1
            here = data[start:stop]
            inside = np.concatenate(([False], ~_SPACE[here], [False]))
            first, last = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
            if len(first):
                names.append(slices(here.tobytes(), first, last))
                count += len(first)
            start = stop
        ends.append(count)
    return np.array(ends, dtype=np.int64), np.concatenate(names) if names else np.zeros(0, dtype=np.uint64)


def _units(column, unit: Unit) -> tuple[np.ndarray, np.ndarray]:
    return _word_names(column) if unit.words else _utf8(column)


def _pieces(offsets: np.ndarray, length: int):
    """Groups of (row, first byte, end) of about CHUNK neighbouring bytes; long texts in pieces
    that overlap by length - 1 bytes, so that every string is in exactly one."""
    group, size = [], 0
    for row, (start, end) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        if end - start > 2 * CHUNK:
            if group:
                yield group
            for at in range(start, end - length + 1, CHUNK):
                yield [(row, at, min(end, at + CHUNK + length - 1))]
            group, size = [], 0
            continue
        group.append((row, start, end))
        size += end - start
        if size >= CHUNK:
            yield group
            group, size = [], 0
    if group:
        yield group


def first_nodes(offsets: np.ndarray, data: np.ndarray, unit: Unit = BYTES):
    """(row, pos, low, high, core, whole) arrays of the anchors of each group of texts.

    A node stands for the strings that start `high` to `low` bytes before its anchor.
    """
    for group in _pieces(offsets, unit.length):
        rows, starts, ends = (np.array(c, dtype=np.int64) for c in zip(*group))
        base = starts[0]
        here = data[base: ends[-1]]
        if len(here) < unit.length:
            continue
        names = Names(here)
        grams = mix(names.all(unit.q))
        order = (grams & _HIGH) | np.arange(len(grams), dtype=np.uint64)
        anchor = (_slide(order, unit.span) & _LOW).astype(np.int64)  # of the string at each start
        text = np.repeat(np.arange(len(rows)), ends - starts)[: len(anchor)]
        inside = np.arange(len(anchor)) + unit.length <= (ends - base)[text]
        new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1])))
        first = np.flatnonzero(new)
        last = np.concatenate((first[1:], [len(anchor)])) - 1
        first, last = first[inside[first]], last[inside[first]]
        p, t = anchor[first], text[first]
        yield (rows[t], p - (offsets[rows[t]] - base), p - last, p - first, grams[p], names.at(first, last + unit.length))


def _first_nodes(docs: DataFrame, unit: Unit) -> DataFrame:
    def run(batches):
        for b in batches:
            ids, fps = b.column("_id").to_numpy(), b.column("_fp").to_numpy()
            for row, pos, low, high, core, whole in first_nodes(*_units(b.column("_text"), unit), unit):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (ids[row], fps[row], pos.astype(np.int32), low.astype(np.int32),
                                           high.astype(np.int32), core.view(np.int64), whole.view(np.int64))],
                    ["_id", "_fp", "pos", "low", "high", "core", "whole"],
                )

    rows = docs.select(*row_key(), F.col("text").alias("_text"))
    return rows.mapInArrow(run, "_id long, _fp long, pos int, low int, high int, core long, whole long")


def cut_nodes(pos, low, high, start, data, size, length=LENGTH):
    """(node, low, high, core, whole): the nodes along a grid of `size`; `start` is the first
    byte of each node's text.  The core is that of the whole cell of the grid, so a string
    that two nodes share is under the same core in both."""
    a, e = start + pos - high, start + pos - low + length
    base = np.concatenate(([0], np.cumsum(e - a)))[:-1]
    names = Names(np.concatenate([data[x:y] for x, y in zip(a.tolist(), e.tolist())]))
    count = high // size - low // size + 1
    node = np.repeat(np.arange(len(pos)), count)
    step = np.arange(len(node)) - np.repeat(np.cumsum(count) - count, count)
    cell = (low[node] // size + step) * size
    lo, hi, at = np.maximum(cell, low[node]), np.minimum(cell + size - 1, high[node]), (base + high)[node]
    core = mix(_pair(names.at(at - cell, at - (cell + size - 1) + length), cell.astype(np.uint64)))
    return node, lo, hi, core, names.at(at - hi, at - lo + length)


def _cut(docs: DataFrame, nodes: DataFrame, size: int, unit: Unit) -> DataFrame:
    """The open nodes cut along a grid of `size` starts, with core and whole."""
    asked = nodes.groupBy("_id", "_fp").agg(F.collect_list(F.struct("pos", "low", "high", "alone")).alias("_ask"))
    # Rows that repeat a document are one here: their nodes are already counted.
    rows = (
        docs.select(*row_key(), F.col("text").alias("_text")).join(asked, ["_id", "_fp"])
        .groupBy("_id", "_fp").agg(F.any_value("_text").alias("_text"), F.any_value("_ask").alias("_ask"))
    )
    names = ["_id", "_fp", "pos", "low", "high", "alone", "core", "whole"]

    def run(batches):
        for b in batches:
            ids, fps, ask = b.column("_id").to_numpy(), b.column("_fp").to_numpy(), b.column("_ask")
            offsets, data = _units(b.column("_text"), unit)
            row = np.repeat(np.arange(len(ids)), ask.value_lengths().to_numpy(zero_copy_only=False))
            flat = ask.flatten()
            pos, low, high = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("pos", "low", "high"))
            alone = flat.field("alone").to_numpy(zero_copy_only=False)
            for at in range(0, len(pos), 512):
                part = slice(at, at + 512)
                r, p = row[part], pos[part]
                node, lo, hi, core, whole = cut_nodes(p, low[part], high[part], offsets[r], data, size, unit.length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (ids[r][node], fps[r][node], p[node].astype(np.int32), lo.astype(np.int32),
                                           hi.astype(np.int32), alone[part][node], core.view(np.int64), whole.view(np.int64))],
                    names,
                )

    return rows.mapInArrow(
        run, "_id long, _fp long, pos int, low int, high int, alone boolean, core long, whole long"
    )


def _refine(nodes: DataFrame, name: str, across: bool) -> tuple[DataFrame, DataFrame]:
    """Ranges of starts that repeat (_id, _fp, pos, low, high), and the nodes to cut further.

    With `across` a bucket repeats where its nodes are of several texts; of nodes that one text
    has in a bucket of its own, one goes on for all.

    Nodes with equal core, whole and limits are one bucket, and a bucket of several is a
    repeat.  Where a bucket of one node still wants an answer (`alone`) and its core belongs
    to other buckets, all buckets of the core go on, each through one node.
    """
    bucket = ["core", "whole", "low", "high"]
    nodes = materialize(nodes, f"repeats-nodes-{name}")
    cores = nodes.groupBy("core").agg(F.count("*").alias("n"), F.max("alone").alias("alone")).where("n > 1 and alone")
    met = materialize(nodes.join(cores.select("core"), "core", "left_semi"), f"repeats-met-{name}")
    discard(nodes)
    sizes = met.groupBy(*bucket).agg(
        F.count("*").alias("n"), F.max("alone").alias("alone"), F.min(F.struct("_id", "_fp", "pos")).alias("rep")
    )
    single = F.col("n") == 1
    if across:
        text = F.struct("_id", "_fp")
        texts = met.groupBy(*bucket).agg(F.min(text).alias("_a"), F.max(text).alias("_b"))
        sizes = sizes.join(texts, bucket).withColumn("n", F.when(F.col("_a") == F.col("_b"), 1).otherwise(F.col("n"))).drop("_a", "_b")
    sizes = materialize(sizes.withColumn("alone", F.col("alone") & single), f"repeats-buckets-{name}")
    parts = sizes.groupBy("core").agg(F.count("*").alias("parts"), F.max("alone").alias("open"))
    again = sizes.join(parts.where("parts > 1 and open").select("core"), "core", "left_semi").select(
        "rep._id", "rep._fp", "rep.pos", "low", "high", "alone"
    )
    marked = met.where("alone").join(sizes.where("n > 1").select(*bucket), bucket, "left_semi")
    out = (
        materialize(marked.select("_id", "_fp", "pos", "low", "high"), f"repeats-marked-{name}"),
        materialize(again, f"repeats-open-{name}"),
    )
    discard(met, sizes)
    return out


def repeated_spans(docs: DataFrame, unit: Unit = BYTES) -> DataFrame:
    """_id, _fp, `spans` (array of start and end, as found, overlapping) of texts with repeats."""
    marked, again = _refine(_first_nodes(docs, unit).withColumn("alone", F.lit(True)), "first", unit.across)
    every = marked
    for size in unit.steps:
        marked, left = _refine(_cut(docs, again, size, unit), f"by-{size}", unit.across)
        discard(again)
        every, again = every.unionByName(marked), left
    span = F.struct(
        (F.col("pos") - F.col("high")).alias("start"), (F.col("pos") - F.col("low") + unit.length).alias("end")
    )
    return every.groupBy("_id", "_fp").agg(F.collect_list(span).alias("spans"))


def union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of bytes that the spans cover."""
    out = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def shared_passages(docs: DataFrame, unit: Unit = PASSAGES) -> DataFrame:
    """_id, _fp, n_shared_words: words of a text in passages of `unit.length` words that another text has too.

    Words are runs of bytes other than ASCII white space.  A passage that stands in one text
    several times, and in another one, may be counted there once.  Texts without such a passage
    have no row.
    """
    found = repeated_spans(docs, unit).select("_id", "_fp", F.array_sort("spans").alias("spans"))
    # Covered words: every span adds what lies behind the end of those before it.
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate("spans", start, lambda a, x: F.struct(
        (a["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(a["end"], x["start"]))).alias("n"),
        F.greatest(a["end"], x["end"]).alias("end"),
    ))
    return found.select("_id", "_fp", covered["n"].alias("n_shared_words"))


def remove_repeats(docs: DataFrame, keep=None) -> DataFrame:
    """`_row` (columns `keep` of `docs`, all by default), n_bytes, spans, kept; a row per row.

    A byte goes when a string of 400 bytes that covers it starts anywhere else, in the same
    text or another one; strings are judged on the input.  `spans` are the maximal removed
    runs, `kept` the other bytes.  Null texts are empty, texts of fewer than 400 bytes have
    no repeats, a repeated row loses all of a text that is long enough.  Strings are compared
    by 64-bit names of their first q-gram together with those of the strings themselves.  An
    empty table gives no rows; columns other than doc_id and text are only carried.
    """
    found = repeated_spans(docs)
    rows = docs.select(packed(docs.select(*keep) if keep else docs), *row_key(), F.col("text").alias("_text")).join(
        found, ["_id", "_fp"], "left"
    ).select("_row", "_text", "spans")

    def run(batches):
        for b in small_batches(batches):
            sizes, spans, kept = [], [], []
            for t, s in zip(b.column("_text"), b.column("spans").to_pylist()):
                raw = (t.as_py() or "").encode("utf-8", "surrogatepass")
                runs = union([(x["start"], x["end"]) for x in s or []])
                sizes.append(len(raw))
                spans.append([{"start": x, "end": y} for x, y in runs])
                edges = [0, *[e for r in runs for e in r], len(raw)]
                kept.append(b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2])))
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [b.column("_row"), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())],
                ["_row", "n_bytes", "spans", "kept"],
            )

    pair = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    schema = T.StructType([
        rows.schema["_row"], T.StructField("n_bytes", T.LongType()),
        T.StructField("spans", T.ArrayType(pair)), T.StructField("kept", T.BinaryType()),
    ])
    return rows.mapInArrow(run, schema)


def op1_suffix_dedup(spark, folder: str) -> DataFrame:
    """The removal, and how many words a document shares with others in passages of over fifty words."""
    docs = read(spark, folder, "documents")
    rows = remove_repeats(docs.select("doc_id", "text", *row_key()), keep=["doc_id", "_id", "_fp"]).select(
        "_row.*", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
    return rows.join(shared_passages(docs), ["_id", "_fp"], "left").drop("_id", "_fp").withColumns({
        "n_shared_words": F.coalesce("n_shared_words", F.lit(0)).cast("long"),
        "shares_passage": F.coalesce(F.col("n_shared_words") > 0, F.lit(False)),
    })
