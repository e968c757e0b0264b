"""URL filters: fixed rules first, mined association rules for the rest.

A whole url becomes a set of tokens.  Spark's FP-growth mines token combinations of labelled
pages together with the label; rules `tokens -> block` that reach the minimum support and
confidence are kept.  Tokens in too few bad pages to be part of any rule are left out before,
and tokens that occur in the same labelled pages are mined as one.  An inverted index lists
each rule under its rarest part, so a url meets only rules of which it has that part, and the
rest of the rule is checked there.

Main path: built-in functions and Spark ML only.
"""

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.llm.common import read
from duebook.storage import materialize

RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
BLOCK = "=block"
MIN_PAGES = 10  # bad labelled pages that a rule needs
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column, Column, Column, Column]:
    """Scheme, host, path, query and fragment; empty where the url is null or has no `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    scheme = F.coalesce(F.when(at > 0, F.translate(url.substr(F.lit(1), at - 1), _UPPER, _LOWER)), F.lit(""))
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    fragment = F.regexp_extract(rest, "(?s)^[^#]*#(.*)", 1)
    return scheme, host, path, query, fragment


def tokens(scheme: Column, host: Column, path: Column, query: Column, fragment: Column) -> Column:
    """Scheme, all host labels, path parts, parameter names and values, and fragment parts."""

    def named(kind: str, values: Column) -> Column:
        return F.transform(F.filter(values, lambda x: x != ""), lambda x: F.concat(F.lit(kind), x))

    pairs = F.split(query, "[&;]")
    return F.array_distinct(
        F.concat(
            named("s:", F.array(scheme)),
            named("h:", F.split(host, r"\.")),
            named("p:", F.split(path, "/")),
            named("q:", F.transform(pairs, lambda x: F.regexp_extract(x, "^[^=]*", 0))),
            named("v:", F.transform(pairs, lambda x: F.regexp_extract(x, "(?s)^[^=]*=(.*)", 1))),
            named("f:", F.split(fragment, "[/?&=]")),
        )
    )


def mine(labelled: DataFrame, min_pages: int = MIN_PAGES, min_confidence: float = 0.8) -> DataFrame:
    """`_need` and `_rarest` of rules that block, from `tokens`, `bad`.

    A rule holds for at least `min_pages` bad urls, a number that does not grow with the
    corpus, and blocks rightly in at least `min_confidence` of those that have its tokens.  No
    labelled rows give no rules.
    `_need` has the parts of a rule, each a list of tokens that occur in the same labelled
    urls; any one of them will do.  `_rarest` is the part that the fewest labelled urls have.
    """
    spark = labelled.sparkSession
    # Written with its row numbers, which are the same in both readings below.
    rows = materialize(
        labelled.where(F.size("tokens") > 0).select("tokens", "bad", F.monotonically_increasing_id().alias("_n")),
        "url-labelled",
    )
    empty = spark.createDataFrame([], "_need array<array<string>>, _rarest array<string>")
    n = rows.count()
    if n == 0:
        return empty
    # A token in fewer bad urls than a rule must hold for is in no rule.
    each = rows.select("bad", "_n", F.explode("tokens").alias("_t")).groupBy("_t").agg(
        F.sum(F.col("bad").cast("long")).alias("_bad"), F.count("*").alias("_f"),
        F.bit_xor(F.xxhash64("_n")).alias("_x"), F.bit_xor(F.xxhash64("_n", F.lit(1))).alias("_y"),
    ).where(F.col("_bad") >= min_pages)
    # Two hashes of the urls that have a token tell the tokens of other urls apart.
    parts = materialize(
        each.groupBy("_f", "_x", "_y").agg(F.sort_array(F.collect_list("_t")).alias("_part")), "url-parts"
    ).withColumn("_name", F.col("_part")[0])
    firsts = parts.select(F.col("_name").alias("_t"))
    found = (
        rows.select("_n", F.explode("tokens").alias("_t")).join(firsts, "_t")
        .groupBy("_n").agg(F.collect_list("_t").alias("_items"))
    )
    items = F.coalesce("_items", F.array().cast("array<string>"))
    baskets = materialize(
        rows.select("_n", "bad").join(found, "_n", "left").select(
            F.when(F.col("bad"), F.concat(items, F.array(F.lit(BLOCK)))).otherwise(items).alias("items")
        ),
        "url-baskets",
    )
    # Half a page less than the number, as the share is multiplied by n again and rounded up.
    share = min(1.0, (min_pages - 0.5) / n)
    model = FPGrowth(itemsCol="items", minSupport=share, minConfidence=min_confidence).fit(baskets)
    rules = materialize(
        model.associationRules.where(F.col("consequent")[0] == BLOCK).select(F.array_sort("antecedent").alias("_rule")),
        "url-rules",
    )
    return (
        rules.select("_rule", F.explode("_rule").alias("_name")).join(parts, "_name")
        .groupBy("_rule").agg(
            F.collect_list("_part").alias("_need"), F.min_by("_part", F.struct("_f", "_name")).alias("_rarest")
        )
        .select("_need", "_rarest")
    )


def blocked_urls(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """`_url` of the urls (`_url`, `tokens`) that a rule blocks, each once."""
    index = rules.select("_need", F.explode("_rarest").alias("_t"))
    hits = urls.select("_url", "tokens", F.explode("tokens").alias("_t")).join(index, "_t")
    return hits.where(F.forall("_need", lambda part: F.arrays_overlap(part, F.col("tokens")))).select("_url").distinct()


def listed(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, h + p).otherwise(name)
        verdict = F.when(fits, v).otherwise(verdict)
    return name, verdict


def judge(
    pages: DataFrame, labels: DataFrame, rules=RULES, min_pages: int = MIN_PAGES, min_confidence: float = 0.8
) -> DataFrame:
    """page_id, host, path, rule, verdict; one row per row of `pages`.

    Labels belong to pages by `doc_id = page_id`; a page is bad when a label of its says
    quality 0 or toxic 1.  Null urls and urls without `://` have an empty host and path, no
    rule, and are allowed.  Repeated urls get the same verdict, repeated rows stay.
    """
    cut = dict(zip(("scheme", "host", "path", "query", "fragment"), parts(F.col("url"))))
    seen = pages.select("page_id", "url", *[c.alias(n) for n, c in cut.items()])
    seen = materialize(seen.select("page_id", "url", "host", "path", tokens(*map(F.col, cut)).alias("tokens")), "urls")
    known = (
        labels.groupBy("doc_id")
        .agg(F.max((F.col("quality").eqNullSafe(0) | F.col("toxic").eqNullSafe(1)).cast("int")).alias("_bad"),
             F.max(F.col("quality").isNotNull() | F.col("toxic").isNotNull()).alias("_known"))
        .where("_known")
    )
    labelled = seen.join(known, F.col("page_id") == F.col("doc_id")).select("tokens", (F.col("_bad") == 1).alias("bad"))
    urls = seen.where(F.size("tokens") > 0).groupBy(F.col("url").alias("_url")).agg(F.first("tokens").alias("tokens"))
    blocked = materialize(blocked_urls(urls, mine(labelled, min_pages, min_confidence)), "urls-blocked")
    name, verdict = listed(F.col("host"), F.col("path"), rules)
    mined = F.when(F.col("_url").isNotNull(), "block").otherwise("allow")
    return seen.join(blocked, F.col("url") == F.col("_url"), "left").select(
        "page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, mined).alias("verdict")
    )


def op6_url_filter(spark, folder: str) -> DataFrame:
    return judge(read(spark, folder, "pages"), read(spark, folder, "labels"))


OP6_SQL = r"""
WITH u AS (
  SELECT page_id, url, coalesce(CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END, '') AS rest,
    coalesce(CASE WHEN strpos(url, '://') > 0 THEN translate(substr(url, 1, strpos(url, '://') - 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END, '') AS scheme
  FROM pages
), p AS (
  SELECT page_id, url, scheme,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
    string_split_regex(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '[&;]') AS pairs,
    string_split_regex(regexp_extract(rest, '(?s)^[^#]*#(.*)', 1), '[/?&=]') AS fragments
  FROM u
), t AS (
  SELECT page_id, url, host, path, list_sort(list_distinct(list_filter(list_concat(
    ['s:' || scheme],
    list_transform(string_split(host, '.'), lambda x: 'h:' || x),
    list_transform(string_split(path, '/'), lambda x: 'p:' || x),
    list_transform(pairs, lambda x: 'q:' || regexp_extract(x, '^[^=]*')),
    list_transform(pairs, lambda x: 'v:' || regexp_extract(x, '(?s)^[^=]*=(.*)', 1)),
    list_transform(fragments, lambda x: 'f:' || x)), lambda x: len(x) > 2))) AS tok
  FROM p
), known AS (
  SELECT row_number() OVER () AS n, * FROM (
    SELECT t.tok, bool_or(coalesce(quality = 0, false) OR coalesce(toxic = 1, false)) AS bad
    FROM (SELECT *, row_number() OVER () AS at FROM t) t JOIN labels ON page_id = doc_id
    WHERE (quality IS NOT NULL OR toxic IS NOT NULL) AND len(tok) > 0 GROUP BY t.at, t.tok)
), often AS (
  -- A rule needs ten bad pages, so do all its tokens.
  SELECT token FROM (SELECT bad, unnest(tok) AS token FROM known) GROUP BY token HAVING count_if(bad) >= 10
), short AS (
  SELECT n, any_value(bad) AS bad, list_sort(list(token)) AS tok
  FROM (SELECT n, bad, unnest(tok) AS token FROM known) JOIN often USING (token) GROUP BY n
), sets AS (
  SELECT bad, list_filter(tok, lambda x, i: (m >> (i - 1)) % 2 = 1) AS need
  FROM (SELECT bad, tok, unnest(range(1, (1 << len(tok)))) AS m FROM short)
), mined AS (
  SELECT need FROM sets GROUP BY need HAVING count_if(bad) >= 10 AND count_if(bad) / count(*) >= 0.8::DOUBLE
), hit AS (
  SELECT DISTINCT url FROM t JOIN mined ON list_has_all(tok, need)
), r(h, p, v) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), best AS (
  SELECT host, path, max_by(h || p, length(h || p)) AS rule, max_by(v, length(h || p)) AS v
  FROM (SELECT DISTINCT host, path FROM t) JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY host, path
)
SELECT t.page_id, t.host, t.path, best.rule, coalesce(best.v, CASE WHEN hit.url IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM t LEFT JOIN best ON best.host = t.host AND best.path = t.path LEFT JOIN hit ON hit.url = t.url
"""
