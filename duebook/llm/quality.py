"""Quality rules whose limits come from the data: quantile sketches per language and source.

Every text is measured once.  KLL sketches of the measures are built per (lang, source) with
partial aggregation, so a source with a third of all rows is summed up before the shuffle,
and merged into sketches per language and over all rows.  A limit is a quantile of the group
plus a multiple of its distance from another one, at least by a small floor, and is joined
back to the measures.  Shares that are 0 in most texts take high quantiles, which move as soon
as a tenth of a group's texts have symbols, or a hundredth repeated lines.

Main path: built-in functions only.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.llm.common import read, words
from duebook.storage import materialize

SYMBOLS = "#*$%&|<>"
WINDOW = 5
# Limit -> measure, quantile, the quantile that it is compared with, how many times their
# distance is added, and the floor: the least distance from the quantile.  The floor of a text
# of n words is sqrt(100 / n) times as wide where n is below 100, as the mean of few words
# varies more.
LIMITS = {
    "word_length_low": ("word_length", 0.25, 0.75, 3.0, 0.75),
    "word_length_high": ("word_length", 0.75, 0.25, 3.0, 0.75),
    "symbol_share_high": ("symbol_share", 0.9, 0.5, 3.0, 0.1),
    "line_share_high": ("line_share", 0.99, 0.5, 1.0, 0.25),
}
MEASURES = ("word_length", "symbol_share", "line_share")


def measured(docs: DataFrame, text: str = "text", keep=("doc_id", "lang", "source")) -> DataFrame:
    """`keep` and the base measures of every whole text.

    Null, empty and blank texts have 0 everywhere.  `n_repeat_words` counts words inside
    windows of five words that occur at least twice in the text; windows are told apart by
    64-bit hashes, positions are sorted only where a hash repeats.
    """
    t = F.coalesce(F.col("_text"), F.lit(""))
    df = docs.select(*keep, F.col(text).alias("_text"))
    df = df.select(
        *keep,
        words(F.col("_text")).alias("_w"),
        F.length(F.translate(t, " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
    )
    w, n = F.col("_w"), F.size("_w")
    none = F.array().cast("array<bigint>")
    df = df.select(
        *keep, "word_chars", "n_symbols",
        n.cast("long").alias("n_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(
            n >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), n - WINDOW),
                lambda i: F.xxhash64(*[w[i + k] for k in range(WINDOW)]),
            ),
        ).otherwise(none).alias("_h"),
    )
    pairs = F.array().cast("array<struct<h:bigint,i:int>>")
    df = df.withColumn(
        "_sorted",
        F.when(
            F.size(F.array_distinct("_h")) < F.size("_h"),
            F.sort_array(F.transform("_h", lambda x, i: F.struct(x.alias("h"), i.alias("i")))),
        ).otherwise(pairs),
    ).drop("_h")
    s = F.col("_sorted")
    df = df.withColumn(
        "_at",
        F.sort_array(
            F.transform(
                F.filter(
                    s,
                    lambda p, j: F.get(s, j - 1)["h"].eqNullSafe(p["h"])
                    | F.get(s, j + 1)["h"].eqNullSafe(p["h"]),
                ),
                lambda p: p["i"],
            )
        ),
    ).drop("_sorted")
    at = F.col("_at")
    covered = F.aggregate(
        F.transform(at, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - x, F.lit(WINDOW)))),
        F.lit(0).cast("long"),
        lambda acc, x: acc + x,
    )
    return df.withColumn("n_repeat_words", covered).drop("_at")


def with_shares(measures: DataFrame) -> DataFrame:
    """The measures that limits are set on, as doubles; null where a text has no word."""
    n = F.when(F.col("n_words") > 0, F.col("n_words"))
    lines = F.when(F.col("n_lines") > 0, F.col("n_lines"))
    return measures.select(
        "*",
        (F.col("word_chars") / n).alias("word_length"),
        (F.col("n_symbols") / n).alias("symbol_share"),
        (F.col("n_dup_lines") / lines).alias("line_share"),
    )


def _fences(sketches: dict[str, Column]) -> list[Column]:
    out = []
    for name, (measure, at, other, times, _) in LIMITS.items():
        q = F.kll_sketch_get_quantile_double(sketches[measure], F.lit(at))
        r = F.kll_sketch_get_quantile_double(sketches[measure], F.lit(other))
        out.append((q + times * (q - r)).alias(name))
    return out


def limits(shares: DataFrame, k: int = 2048, min_rows: int = 50) -> DataFrame:
    """One row per (lang, source) with the limits of its texts.

    A group of fewer than `min_rows` measured texts takes the limits of its language, a
    language of fewer those of all texts; both come from merging the same sketches.
    """
    has = F.col("n_words") > 0
    groups = shares.where(has).groupBy("lang", "source").agg(
        F.count("*").alias("_n"),
        *[F.kll_sketch_agg_double(m, F.lit(k)).alias(m) for m in MEASURES],
    )
    groups = materialize(groups, "quality-sketches")

    def merged(*keys):
        return groups.groupBy(*keys).agg(
            F.sum("_n").alias("_n"),
            *[F.kll_merge_agg_double(m, F.lit(k)).alias(m) for m in MEASURES],
        )

    sketch = {m: F.col(m) for m in MEASURES}
    fences = _fences(sketch)
    own = groups.select("lang", "source", "_n", F.struct(*fences).alias("own"))
    language = merged("lang").select(
        F.col("lang").alias("_lang"), F.col("_n").alias("_ln"), F.struct(*fences).alias("language")
    )
    # One row over all groups, read as a scalar of every row of the small table.
    total = merged(F.lit(1).alias("_all")).select(F.struct(*fences).alias("everything"), "_all")
    table = (
        own.join(language, own["lang"].eqNullSafe(F.col("_lang")))
        .withColumn("_all", F.lit(1))
        .join(F.broadcast(total), "_all")
    )
    chosen = F.when(F.col("_n") >= min_rows, F.col("own")).when(
        F.col("_ln") >= min_rows, F.col("language")
    ).otherwise(F.col("everything"))
    return table.select("lang", "source", chosen.alias("_limits")).select(
        "lang", "source", *[F.col("_limits")[n].alias(n) for n in LIMITS]
    )


def quality_rules(
    docs: DataFrame, k: int = 2048, min_rows: int = 50,
    min_words: int = 10, max_repeat_percent: int = 20,
) -> DataFrame:
    """doc_id, lang, source, base measures, `base_failed` and `kept`, one row per document.

    `k` is the accuracy parameter of the sketches: a group of up to about `k` texts is exact.
    A text without words fails the base rule.  Null languages and sources form groups of
    their own.  Equal rows are measured and judged alike; an empty table gives no rows.
    Columns of `docs` other than doc_id, text, lang and source are ignored.
    """
    shares = materialize(with_shares(measured(docs)), "quality-measures")
    table = limits(shares, k, min_rows).select(
        F.col("lang").alias("_lang"), F.col("source").alias("_source"), *LIMITS
    )
    n = F.col("n_words")
    base = (n < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * n)
    inside, wide = F.lit(True), F.greatest(F.lit(1.0), F.sqrt(F.lit(100.0) / F.when(n > 0, n)))
    for name, (measure, at, other, _, floor) in LIMITS.items():
        if at < other:
            inside = inside & (F.col(measure) >= F.col(name) - floor * wide)
        else:
            inside = inside & (F.col(measure) <= F.col(name) + floor * wide)
    joined = shares.join(
        table,
        shares["lang"].eqNullSafe(F.col("_lang")) & shares["source"].eqNullSafe(F.col("_source")),
        "left",
    )
    return joined.select(
        "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", base.alias("base_failed"),
        (~base & F.coalesce(inside, F.lit(False))).alias("kept"),
    )


def op2_quality_rules(spark, folder: str) -> DataFrame:
    return quality_rules(read(spark, folder, "documents")).drop("lang", "source")


OP2_SQL = r"""
WITH base AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, i, md5(concat_ws(chr(0), w[i], w[i+1], w[i+2], w[i+3], w[i+4])) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM base WHERE len(w) >= 5)
), starts AS (
  SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt
  FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows) WHERE n > 1
), repeats AS (
  SELECT doc_id, sum(least(5, coalesce(nxt - i, 5))) AS n_repeat_words FROM starts GROUP BY doc_id
), m AS (
  SELECT b.doc_id, lang, source, len(w) AS n_words,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(r.n_repeat_words, 0) AS n_repeat_words
  FROM base b LEFT JOIN repeats r USING (doc_id)
), s AS (
  SELECT *, word_chars / n_words AS wl, n_symbols / n_words AS ss, n_dup_lines / n_lines AS ls,
    greatest(1.0::DOUBLE, sqrt(100.0::DOUBLE / n_words)) AS wide
  FROM m
), q AS (
  SELECT lang, source, grouping(lang) + grouping(source) AS lvl, count(*) AS n,
    quantile_disc(wl, 0.25) AS wl1, quantile_disc(wl, 0.75) AS wl3,
    quantile_disc(ss, 0.5) AS ss2, quantile_disc(ss, 0.9) AS ss3,
    quantile_disc(ls, 0.5) AS ls2, quantile_disc(ls, 0.99) AS ls3
  FROM s WHERE n_words > 0 GROUP BY GROUPING SETS ((lang, source), (lang), ())
), f AS (
  SELECT lang, source, lvl, n, wl1 - 3 * (wl3 - wl1) AS wl_low, wl3 + 3 * (wl3 - wl1) AS wl_high,
    ss3 + 3 * (ss3 - ss2) AS ss_high, ls3 + (ls3 - ls2) AS ls_high
  FROM q
), judged AS (
  SELECT s.*, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    CASE WHEN o.n >= 50 THEN o WHEN l.n >= 50 THEN l ELSE e END AS lim
  FROM s
  LEFT JOIN f o ON o.lvl = 0 AND o.lang IS NOT DISTINCT FROM s.lang AND o.source IS NOT DISTINCT FROM s.source
  LEFT JOIN f l ON l.lvl = 1 AND l.lang IS NOT DISTINCT FROM s.lang
  LEFT JOIN f e ON e.lvl = 2
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND coalesce(wl >= lim.wl_low - 0.75::DOUBLE * wide AND wl <= lim.wl_high + 0.75::DOUBLE * wide
    AND ss <= lim.ss_high + 0.1::DOUBLE * wide AND ls <= lim.ls_high + 0.25::DOUBLE * wide, false) AS kept
FROM judged
"""
