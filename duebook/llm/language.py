"""Language identification by nearest centroid.

Texts become TF-IDF vectors of character n-grams (1 to 3 characters of the lower-cased words,
hashed into a fixed number of dimensions), scaled to length 1.  Each language has several
centroids, found by spherical k-means over a bounded sample of its labelled texts.  A text
takes the language of the centroid with the highest cosine; it is rejected where that cosine
is below the limit of the centroid for texts of so many letters.  The limits are low quantiles
of the cosines of the sample, whose texts are also cut to each length, as short texts score
lower.
"""

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duebook.llm.common import packed, read, small_batches
from duebook.storage import materialize

DIMENSIONS = 4096
UNKNOWN = "und"
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35], dtype=np.uint32)


@functools.cache
def _is_letter() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)], dtype=bool)


# Limits are found for texts of 1, 2, 4 ... letters and taken in between by the logarithm.
STEPS = 13


def codes(text: str | None) -> np.ndarray | None:
    """Lower-cased letters of a whole text, blanks for all else; None where it has no letter."""
    if text is None:
        return None
    lower = text.lower()
    raw = np.frombuffer(lower.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    # Letters keep their code, everything else is a blank: digits and signs name no language.
    letters = np.where(_is_letter()[raw], raw, np.uint32(32))
    return letters if (letters != 32).any() else None


def counts(letters: np.ndarray) -> np.ndarray:
    """Hashed n-gram counts of `codes`."""
    chars = np.concatenate(([np.uint32(32)], letters, [np.uint32(32)]))
    out = np.zeros(DIMENSIONS, dtype=np.float64)
    h = np.zeros(len(chars), dtype=np.uint32)
    for n in range(3):
        # h at p covers n + 1 characters from p on; grams of blanks alone are skipped below.
        h = (h[: len(chars) - n] if n else h) ^ (chars[n:] * _MULTIPLIERS[n])
        h = h * np.uint32(0x01000193)
        h ^= h >> np.uint32(15)
        word = chars[: len(chars) - n] != 32
        if n:
            word |= chars[n:] != 32
        out += np.bincount((h[word] >> np.uint32(7)) & np.uint32(DIMENSIONS - 1), minlength=DIMENSIONS)
    return out


def unit(tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Logarithmic term weights times IDF, scaled to length 1 (rows)."""
    v = np.log1p(tf) * idf
    size = np.linalg.norm(v, axis=-1, keepdims=True)
    return v / np.where(size == 0, 1, size)


def spherical_means(vectors: np.ndarray, k: int, rounds: int = 12, least: float = 0.03) -> np.ndarray:
    """Up to `k` unit centroids of clusters that hold at least the share `least` of the vectors.

    Starts are drawn one after the other with a probability that grows with the distance to
    those before (seeded, so reruns agree).  Clusters that end smaller go, the smallest first,
    and their vectors join the others: an odd text makes no centroid of its own.
    """
    rng = np.random.default_rng(len(vectors))
    starts = [int(rng.integers(len(vectors)))]
    while len(starts) < min(k, len(vectors)):
        far = np.maximum(0, 1 - (vectors @ vectors[starts].T).max(axis=1)) ** 2
        if far.sum() <= 1e-9:
            break
        starts.append(int(rng.choice(len(vectors), p=far / far.sum())))
    c = vectors[starts]
    while True:
        for _ in range(rounds):
            near = np.argmax(vectors @ c.T, axis=1)
            sums = np.array([vectors[near == i].sum(axis=0) if (near == i).any() else c[i] for i in range(len(c))])
            c = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
        size = np.bincount(np.argmax(vectors @ c.T, axis=1), minlength=len(c))
        if len(c) == 1 or size.min() >= least * len(vectors):
            return c
        c = np.delete(c, size.argmin(), axis=0)


def least_cosines(vectors, centroids, heads, idf, quantile: float, margin: float, enough: int) -> np.ndarray:
    """The lowest cosine that a centroid (row) accepts from texts of 1, 2, 4 ... letters (column).

    Every text of the sample is cut to each length and measured against centroids without
    itself.  A limit is the quantile of the cosines nearest to the centroid where these are at
    least `enough`, else of all of the language.  A length that fewer than four fifths of the
    sample have takes the limit of the length before: a low quantile of few texts is chance.
    """
    own = np.argmax(vectors @ centroids.T, axis=1)
    sums = np.array([vectors[own == i].sum(axis=0) for i in range(len(centroids))])
    rest = sums[own] - vectors
    size = np.linalg.norm(rest, axis=1, keepdims=True)
    # A cluster of one text would not be there without it: the text is measured against others.
    alone = (size[:, 0] <= 1e-9) & (len(centroids) > 1)
    rest = np.where(size > 1e-9, rest / np.maximum(size, 1e-9), centroids[own])
    places = [np.flatnonzero(h != 32) for h in heads]

    def limits_of(v, at):
        cos = v @ centroids.T
        cos[np.arange(len(at)), own[at]] = np.where(alone[at], -1, (v * rest[at]).sum(axis=1))
        near, best = np.argmax(cos, axis=1), cos.max(axis=1)
        by = [best[near == i] for i in range(len(centroids))]
        return [np.quantile(x if len(x) >= enough else best, quantile, method="lower") - margin for x in by]

    out = np.empty((len(centroids), STEPS))
    for step in range(STEPS):
        long = np.array([i for i, p in enumerate(places) if len(p) >= 1 << step], dtype=np.int64)
        if step and len(long) < 0.8 * len(heads):
            out[:, step] = out[:, step - 1]
            continue
        v = unit(np.array([counts(heads[i][: places[i][(1 << step) - 1] + 1]) for i in long]), idf)
        out[:, step] = limits_of(v, long)
    return out


class Model:
    """IDF weights, centroids, the language of each and the lowest cosines it accepts (by length)."""

    def __init__(self, idf, centroids, langs, limits):
        self.idf, self.centroids, self.langs, self.limits = idf, centroids, langs, limits


def fit(
    labelled: DataFrame, per_language: int = 400, clusters: int = 4, quantile: float = 0.02,
    max_languages: int = 1000, margin: float = 0.01, enough: int = 100,
) -> Model:
    """Model from `text`, `lang` of labelled rows.

    Centroids are found on at most `per_language` different texts of each language (those with
    the smallest hashes, so reruns agree); document frequencies are counted over all labelled
    rows.  More than `max_languages` languages are an error; both numbers bound what the tasks
    and the driver hold.  Rows with null lang or without a letter teach nothing.
    A centroid accepts texts whose cosine is at least the `quantile` of those of its sample
    at that length, less `margin`; see `least_cosines`.
    """
    spark = labelled.sparkSession
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        "lang", "text", F.xxhash64("text").alias("h")
    )
    # Hashes are chosen before texts travel; copies of a text count once.
    salted = Window.partitionBy("lang", "_salt").orderBy("h")
    order = Window.partitionBy("lang").orderBy("h")
    # First the smallest of each of 64 parts of a language, then the smallest of these.
    chosen = (
        rows.groupBy("lang", "h").agg(F.lit(1).alias("one")).withColumn("_salt", F.pmod("h", F.lit(64)))
        .withColumn("_n", F.row_number().over(salted)).where(F.col("_n") <= per_language)
        .withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= per_language)
        .groupBy(F.col("lang").alias("_lang")).agg(F.max("h").alias("_last"))
    )
    limits = materialize(chosen, "language-limits")  # one row per language
    languages = limits.count()
    if languages > max_languages:
        raise ValueError(f"{languages} languages are more than max_languages={max_languages}.")
    sample = (
        rows.join(limits, (F.col("lang") == F.col("_lang")) & (F.col("h") <= F.col("_last")))
        .groupBy("lang", "h").agg(F.any_value("text").alias("text"))
    )

    def vectors(batches):
        for b in small_batches(batches):
            langs, tfs, heads = [], [], []
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                letters = codes(text)
                if letters is not None:
                    langs.append(lang)
                    tfs.append(counts(letters).astype(np.float32).tobytes())
                    # What the longest length that limits are found for needs of the text.
                    last = np.flatnonzero(letters != 32)[: 1 << (STEPS - 1)][-1]
                    heads.append(letters[: last + 1].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(tfs, pa.binary()), pa.array(heads, pa.binary())], ["lang", "tf", "head"]
            )

    tf = materialize(sample.mapInArrow(vectors, "lang string, tf binary, head binary"), "language-sample")

    def seen(batches):
        n, df = 0, np.zeros(DIMENSIONS, dtype=np.int64)
        for b in batches:
            for text in b.column("text"):
                letters = codes(text.as_py())
                if letters is not None:
                    df += counts(letters) > 0
                    n += 1
        yield pa.RecordBatch.from_arrays([pa.array([[n, *df.tolist()]], pa.list_(pa.int64()))], ["df"])

    # One row per partition, added up by Spark: the number of texts, then one sum per dimension.
    sums = (
        rows.select("text").mapInArrow(seen, "df array<long>").select(F.posexplode("df").alias("at", "n"))
        .groupBy("at").agg(F.sum("n").alias("n")).collect()
    )
    found = np.zeros(DIMENSIONS + 1)
    for r in sums:
        found[r["at"]] = r["n"]
    idf = np.log((1 + found[0]) / (1 + found[1:])) + 1

    def centroids(key, table):
        v = unit(np.array([np.frombuffer(x, dtype=np.float32) for x in table.column("tf").to_pylist()], dtype=np.float64), idf)
        c = spherical_means(v, clusters)
        c = c[np.unique(np.argmax(v @ c.T, axis=1))]
        heads = [np.frombuffer(x, dtype=np.uint32) for x in table.column("head").to_pylist()]
        least = least_cosines(v, c, heads, idf, quantile, margin, enough)
        rows = [(i, c[i].astype(np.float32).tobytes(), least[i].tolist()) for i in range(len(c))]
        return pa.table({
            "lang": pa.array([key[0].as_py()] * len(rows), pa.string()),
            "cluster": pa.array([r[0] for r in rows], pa.int32()),
            "centroid": pa.array([r[1] for r in rows], pa.binary()),
            "least": pa.array([r[2] for r in rows], pa.list_(pa.float64())),
        })

    found = (
        tf.groupBy("lang").applyInArrow(centroids, "lang string, cluster int, centroid binary, least array<double>")
        .orderBy("lang", "cluster").collect()
    )
    c = np.array([np.frombuffer(r.centroid, dtype=np.float32) for r in found]).reshape(len(found), DIMENSIONS)
    return Model(idf, c.astype(np.float32), [r.lang for r in found], np.array([r.least for r in found]).reshape(len(found), STEPS))


def predict(docs: DataFrame, model: Model, keep=None) -> DataFrame:
    """`_row` (columns `keep` of `docs`, all by default), lang_pred, score (0 to 1), rejected.

    Null texts and texts without a letter are `und` with score 0, and rejected; so is
    everything when the model has no language.  Ties go to the first language by name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by `fit`

    def label(batches):
        m = shared.value
        for b in small_batches(batches):
            chunk = [codes(t.as_py()) for t in b.column("_text")]
            some = [i for i, letters in enumerate(chunk) if letters is not None]
            lang, score, bad = [UNKNOWN] * len(chunk), [0.0] * len(chunk), [True] * len(chunk)
            if some and m.langs:
                cos = unit(np.array([counts(chunk[i]) for i in some]), m.idf).astype(np.float32) @ m.centroids.T
                best = np.argmax(cos, axis=1)
                for i, k, row in zip(some, best.tolist(), cos):
                    lang[i], score[i] = m.langs[k], float(min(1.0, max(0.0, row[k])))
                    long = np.log2((chunk[i] != 32).sum())
                    bad[i] = bool(row[k] < np.interp(long, np.arange(STEPS), m.limits[k]))
            yield pa.RecordBatch.from_arrays(
                [b.column("_row"), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(bad, pa.bool_())],
                ["_row", "lang_pred", "score", "rejected"],
            )

    rows = docs.select(packed(docs.select(*keep) if keep else docs), F.col("text").alias("_text"))
    schema = T.StructType([
        rows.schema["_row"], T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType()),
    ])
    return rows.mapInArrow(label, schema)


def training(docs: DataFrame) -> DataFrame:
    """Rows that may teach: labelled, and not held out."""
    return docs.where(F.col("lang").isNotNull() & ~F.coalesce(held_out(F.col("doc_id")), F.lit(False)))


def held_out(doc_id):
    return F.crc32(doc_id.cast("string")) % 3 == 1


def op7_language_id(spark, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    model = fit(training(docs))
    return predict(docs, model, keep=["doc_id"]).select(
        "_row.doc_id", F.coalesce(held_out(F.col("_row.doc_id")), F.lit(False)).alias("held_out"),
        "lang_pred", "score", "rejected",
    )
