"""Byte-level BPE as a monoid: a text is a tree of halves whose token lists are joined.

`encode` halves a text until a piece is a leaf, encodes leaves, and joins neighbours.  A cut
may fall inside a match of the splitting pattern, so a join re-encodes a window around the
cut.  The window grows until each side ends at a place that no match can cross: a character
that is not white space followed by a blank or a newline.  What lies before such a place does
not depend on what follows, and the other way round, so tokens outside the window are final.
If a side has no such place the window reaches that side's end.  Decoding concatenates the
bytes of halves up the same kind of tree.
"""

import base64
import functools

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

import public_tokenizers
from duebook.llm.common import packed, read, small_batches

RANKS = "byte_bpe_multi_50k.tiktoken"
LEAF = 512  # characters of a leaf, and ids of a leaf in decoding


@functools.cache
def codec(path: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoder of a rank file, and the number of bytes of each id; once per worker."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}
    sizes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    for token, rank in ranks.items():
        sizes[rank] = len(token)
    enc = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return enc, sizes


def _final(text: str, p: int) -> bool:
    return text[p] in " \n" and not text[p - 1].isspace()


def _left_end(text: str, lo: int, cut: int) -> int:
    """Last place in (lo, cut] that no match can cross; else lo."""
    return next((p for p in range(min(cut, len(text) - 1), lo, -1) if _final(text, p)), lo)


def _right_end(text: str, cut: int, hi: int) -> int:
    """First such place in [cut, hi); else hi."""
    return next((p for p in range(cut, hi) if _final(text, p)), hi)


def join(text: str, lo: int, cut: int, hi: int, left: list, right: list, enc, sizes) -> list:
    """Token list of text[lo:hi] from those of text[lo:cut] and text[cut:hi]."""
    a, b = _left_end(text, lo, cut), _right_end(text, cut, hi)
    if a == cut == b:
        return left + right
    drop, n = len(left), len(text[a:cut].encode("utf-8"))
    while n > 0:
        drop -= 1
        n -= sizes[left[drop]]
    skip, n = 0, len(text[cut:b].encode("utf-8"))
    while n > 0:
        n -= sizes[right[skip]]
        skip += 1
    return left[:drop] + enc.encode_ordinary(text[a:b]) + right[skip:]


def encode(text: str | None, enc, sizes, leaf: int = LEAF) -> np.ndarray:
    """Ids of a whole text; null and empty texts have none."""
    def tree(lo, hi):
        if hi - lo <= leaf:
            return enc.encode_ordinary(text[lo:hi])
        cut = (lo + hi) // 2
        return join(text, lo, cut, hi, tree(lo, cut), tree(cut, hi), enc, sizes)

    return np.array(tree(0, len(text)) if text else [], dtype="<u4")


def decode(ids: np.ndarray, enc, leaf: int = LEAF) -> bytes:
    """Bytes of the ids, concatenated up a tree of halves."""
    def tree(lo, hi):
        if hi - lo <= leaf:
            return enc.decode_bytes(ids[lo:hi].tolist())
        cut = (lo + hi) // 2
        return tree(lo, cut) + tree(cut, hi)

    return tree(0, len(ids))


def round_trip(docs: DataFrame, path: str | None = None, text: str = "text", keep=None) -> DataFrame:
    """`_row` (columns `keep` of `docs`, all by default), `ids` and `decoded`.

    `ids` holds the ids as little-endian unsigned 32-bit integers, `decoded` the bytes that
    they decode to.  Null and empty texts give empty values; texts of any length are encoded
    whole; equal texts give equal ids; an empty table gives no rows.  `path` is the rank file,
    which must exist on every executor.
    """
    path = path or public_tokenizers.path(RANKS)

    def run(batches):
        enc, sizes = codec(path)
        for b in small_batches(batches):
            ids = [encode(t.as_py(), enc, sizes) for t in b.column("_text")]
            yield pa.RecordBatch.from_arrays(
                [b.column("_row"), pa.array([x.tobytes() for x in ids], pa.binary()),
                 pa.array([decode(x, enc) for x in ids], pa.binary())],
                ["_row", "ids", "decoded"],
            )

    rows = docs.select(packed(docs.select(*keep) if keep else docs), F.col(text).alias("_text"))
    schema = T.StructType([
        rows.schema["_row"], T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())
    ])
    return rows.mapInArrow(run, schema)


def digests(docs: DataFrame, path: str | None = None, ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row, and `ids` if asked for."""
    return round_trip(docs, path, keep=["doc_id"]).select(
        "_row.doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
        *(["ids"] if ids else []),
    )


def op4_bpe_round_trip(spark, folder: str) -> DataFrame:
    return digests(read(spark, folder, "documents"))
