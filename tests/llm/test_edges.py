"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import base64
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from duebook.llm import bpe, language, lines, mixing, near_dup, quality, repeats, sharding, topk, urls
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id string, _row int, size string, kept int"
LONG = " ".join(f"wort{i * i % 7919} und" for i in range(40_000))
NEAR = " ".join(f"n{i}" for i in range(60))


def documents(spark, rows):
    full = [(i, t, lang, s, len(t) if t is not None else None, "x", 1, "big", 7) for i, t, lang, s in rows]
    return spark.createDataFrame(full, SCHEMA)


ROWS = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, None), (4, LONG, "de", "b"),
    (5, LONG, "de", "c"), (5, LONG, "de", "c"), (6, NEAR + " end", "en", None), (7, NEAR + " fin", "en", "a"),
    (8, NEAR, None, "b"), (None, "one two three", "en", "a"), (9, "one two three", "en", "b"), (10, "ONE Two three", "en", "c"),
    (11, "éa ß 日本 🙂 ?", "fr", "d"), (12, "word", "en", "d"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark, ROWS)


@pytest.fixture(scope="module")
def nothing(spark):
    return documents(spark, [])


def test_repeats(docs, nothing):
    rows = repeats.remove_repeats(docs).collect()
    assert len(rows) == len(ROWS) and rows[0]._row.kept == 7
    got = {(r._row.doc_id, r._row.text): r for r in rows}
    assert got[(4, LONG)].kept == b"" and [tuple(x) for x in got[(5, LONG)].spans] == [(0, len(LONG))]
    assert got[(1, None)].n_bytes == 0 and got[(8, NEAR)].spans == [] and got[(8, NEAR)].kept == NEAR.encode()
    assert repeats.remove_repeats(nothing).count() == 0


def test_repeats_at_every_limit(spark):
    """Repeats of 399, 400 and 401 bytes, at text ends, overlapping themselves, three-fold."""
    rng = np.random.default_rng(3)

    def noise(n):
        return "".join(chr(97 + c) for c in rng.integers(0, 26, n))

    p399, p400, p401, p900 = noise(399), noise(400), noise(401), noise(900)
    texts = [
        p399 + noise(50), noise(70) + p399, p400, noise(10) + p400 + noise(10), p401 + noise(500), noise(333) + p401,
        noise(100) + p900 + noise(100), p900[:450] + noise(3) + p900[450:], p900[200:700], "ab" * 1000, "ab" * 250 + "c",
        noise(600) + "é" * 300, "é" * 300 + noise(20), noise(5000), p900[:600] + p900[300:],
    ]
    rows = list(enumerate(texts))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {
        r._row.doc_id: (r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), brute.sha(bytes(r.kept)))
        for r in repeats.remove_repeats(frame).collect()
    }
    assert got == brute.repeats(rows)


def test_repeats_across_the_pieces_of_a_long_text(spark):
    rng = np.random.default_rng(4)
    chars = rng.integers(97, 123, 3 * repeats.CHUNK).astype(np.uint8).tobytes().decode()
    at = [(repeats.CHUNK - 900, 1800), (2 * repeats.CHUNK - 399, 400), (2 * repeats.CHUNK + 5000, 399)]
    other = "#".join(chars[a: a + n] for a, n in at)
    rows = [(1, chars), (2, other), (3, chars[: repeats.LENGTH - 1])]
    got = {r._row.doc_id: [tuple(x) for x in r.spans]
           for r in repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: [(a, a + n) for a, n in at[:2]], 2: [(0, 1800), (1801, 2201)], 3: []}


def test_shared_passages_at_every_limit(spark):
    """Passages of 50, 51 and 60 words, at ends, over white space of all kinds, inside one text, in long texts."""
    rng = np.random.default_rng(9)

    def noise(n):
        return [f"w{x}" for x in rng.integers(0, 10**9, n)]

    p50, p51, p60, own = noise(50), noise(51), noise(60), noise(55)
    long = noise(3 * 4000)
    texts = [
        noise(20) + p50, p50 + noise(5), p51, noise(9) + p51 + noise(9), p60 + noise(30), noise(70) + p60, noise(7) + p60[3:57] + noise(2),
        own + noise(3) + own, long, noise(60) + long[9000:9051] + noise(60), [], noise(51), ["é", "日本"] * 30, ["é", "日本"] * 26,
    ]
    gaps = [" ", "\n", "\t ", "\x0b"]
    rows = [(i, "".join(w + gaps[int(rng.integers(0, 4))] for w in t)) for i, t in enumerate(texts)] + [(99, None)]
    for chunk in (repeats.CHUNK, 3000):
        repeats.CHUNK, before = chunk, repeats.CHUNK
        words, offsets = [], None
        import pyarrow as pa

        offsets, names = repeats._word_names(pa.array([t for _, t in rows], pa.string()))
        repeats.CHUNK = before
        words.append(names)
        assert np.diff(offsets).tolist() == [len(brute.WORD.findall(t or "")) for _, t in rows]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r._id: r.n_shared_words for r in repeats.shared_passages(frame).collect()}
    assert got == {i: n for i, n in brute.shared_words(rows).items() if n}
    assert repeats.shared_passages(frame.limit(0)).count() == 0


def test_quality(spark, docs, nothing):
    rows = {(r.doc_id, r.n_words): r for r in quality.quality_rules(docs).collect()}
    assert quality.quality_rules(docs).count() == len(ROWS)
    assert rows[(1, 0)].base_failed and not rows[(1, 0)].kept and rows[(3, 0)].word_chars == 0
    assert rows[(11, 5)].word_chars == 7
    assert quality.quality_rules(nothing).count() == 0
    text = "a b c d e f a b c d e g\n#*$\n#*$\n\n"
    r = quality.quality_rules(documents(spark, [(1, text, None, None)])).first()
    assert (r.n_words, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (14, 6, 1, 10, True)


def test_quality_limits_follow_the_group(spark):
    """Symbols that are usual in one source make a text of another source an outlier."""
    plain = [(i, f"word{i} " + " ".join(f"w{j}x{i}" for j in range(30)), "en", "plain") for i in range(60)]
    code = [(100 + i, " ".join(f"v{j}x{i} | #" for j in range(30)), "en", "code") for i in range(60)]
    odd = [(500, " ".join(f"z{j} | #" for j in range(30)), "en", "plain")]
    got = {r.doc_id: r.kept for r in quality.quality_rules(documents(spark, plain + code + odd)).collect()}
    assert not got.pop(500) and all(got.values())


def test_quality_limits_move_with_few_texts_of_a_group(spark):
    """Symbols in a seventh of a source's texts, repeated lines in a fiftieth: no outliers there, but elsewhere."""
    def text(i, symbols=0, lines=0):
        body = " ".join(f"w{j}x{i}" + "#" * (j < symbols) for j in range(60))
        return body + "".join("\nsame line here" for _ in range(lines))

    rows = [(i, text(i, 20 if i % 7 == 0 else 0, 9 if i % 50 == 1 else 0), "en", "forum") for i in range(300)]
    rows += [(1000 + i, text(1000 + i, 20 if i == 0 else 0, 9 if i == 1 else 0), "en", "news") for i in range(300)]
    got = {r.doc_id: r.kept for r in quality.quality_rules(documents(spark, rows), max_repeat_percent=100).collect()}
    assert {i for i, kept in got.items() if not kept} == {1000, 1001}


def test_near_duplicates(spark, docs, nothing):
    rows = near_dup.near_duplicates(docs).collect()
    assert len(rows) == len(ROWS)
    got = {(r.doc_id, r.n_shingles): r.component_id for r in rows}
    assert got[(1, 0)] == 1 and got[(2, 0)] == 2 and got[(3, 0)] == 3
    assert got[(7, 58)] == 6 and got[(8, 57)] == 6 and got[(10, 1)] == 9 and got[(None, 1)] == 9
    assert {c for (i, n), c in got.items() if n > 1000} == {4}
    kept = near_dup.dedup(docs, size=4)
    assert kept.columns == docs.columns
    # 4 of the long ones, 6 of the near ones, 9 of the short ones, and all that stand alone.
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 6, 9, 11, 12]
    assert near_dup.near_duplicates(nothing).count() == 0 and near_dup.dedup(nothing).count() == 0


def test_near_duplicates_against_brute_force(spark):
    """Small sets of every size, chains, and a group of more members than a cell."""
    rng = np.random.default_rng(5)
    rows = []
    for size in (4, 5, 6, 7, 8, 9, 12, 15, 20, 40, 90):
        for _ in range(6):
            base = [f"b{rng.integers(1e9)}" for _ in range(size + 3)]
            for _ in range(4):
                words = list(base)
                for at in rng.integers(0, len(words), rng.integers(0, 2)):
                    words[at] = f"x{rng.integers(1e9)}"
                cut = rng.integers(0, 3)
                rows.append(" ".join(words[cut:]))
    base = [f"m{rng.integers(1e9)}" for _ in range(120)]
    for _ in range(2 * near_dup.CELL):
        words = list(base)
        for at in rng.integers(0, len(words), rng.integers(1, 7)):
            words[at] = f"y{rng.integers(1e9)}"
        rows.append(" ".join(words))
    rows = [(int(i), t) for i, t in zip(rng.permutation(len(rows)), rows)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(frame).collect()}
    assert got == brute.components(rows, 4, 80)


def test_bpe(docs, nothing):
    enc, sizes = bpe.codec(bpe.public_tokenizers.path(bpe.RANKS))
    rows = bpe.round_trip(docs).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        text = r._row.text or ""
        assert np.frombuffer(r.ids, dtype="<u4").tolist() == enc.encode_ordinary(text) and r.decoded == text.encode()
    assert bpe.round_trip(nothing).count() == 0


def test_bpe_joins_at_every_cut():
    enc, sizes = bpe.codec(bpe.public_tokenizers.path(bpe.RANKS))
    texts = [
        "It's  we'll\n\n  don't\tx   y　z 123abc 日本語のテキスト ''s 's  ", "a" * 300, " " * 200, "\n \n" * 60,
        "été  \x1c x\x85y " * 20, "🙂🙂 𝒳y" * 30,
    ]
    for text in texts:
        for leaf in (1, 2, 3, 7, 50):
            ids = bpe.encode(text, enc, sizes, leaf=leaf)
            assert ids.tolist() == enc.encode_ordinary(text)
            assert bpe.decode(ids, enc, leaf=leaf) == text.encode()


def test_mixing(spark, docs, nothing):
    rows = mixing.copies(docs).collect()
    assert len(rows) == len(ROWS) and all(r.copies <= 3 for r in rows)
    assert {r._row.source: r.target for r in rows if r.size == 0}.keys() == {"a", None}
    assert mixing.mix(docs).columns == docs.columns
    assert mixing.mix(nothing).count() == 0 and mixing.copies(nothing).count() == 0


def test_water_filling(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 90), (None, 900)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    # Weights 5, 2, 1, 5: a is clamped at 30; b and c would get 492 and 246; c gives up 270 only above its cap.
    assert got["a"] == 30 and abs(sum(got.values()) - 2000) < 1e-6
    assert got["c"] == pytest.approx(246.25) and got["b"] == pytest.approx(492.5) and got[None] == pytest.approx(1231.25)
    assert {r.target for r in mixing.source_targets(sizes.where("source = 'a'")).collect()} == {10.0}


def test_mix_comes_near_its_targets(spark):
    rng = np.random.default_rng(1)
    rows = [(i, "w " * int(rng.integers(1, 40)), "en", f"s{rng.integers(5)}") for i in range(3000)]
    frame = documents(spark, rows)
    first = mixing.copies(frame).select("_row.doc_id", "_row.source", "size", "target", "copies")
    taken = first.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.max("target").alias("t"))
    assert all(abs(r.taken - r.t) <= 40 for r in taken.collect())
    again = mixing.copies(frame.repartition(5)).select("_row.doc_id", "_row.source", "size", "target", "copies")
    assert first.exceptAll(again).count() == 0


def test_languages(docs, nothing):
    model = language.fit(docs)
    rows = language.predict(docs, model).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        blank = r._row.text is None or not any(c.isalpha() for c in r._row.text)
        assert (r.lang_pred == "und") == blank and (not blank or (r.rejected and r.score == 0))
    untaught = language.predict(docs, language.fit(nothing)).collect()
    assert {r.lang_pred for r in untaught} == {"und"} and language.predict(nothing, model).count() == 0


def test_foreign_texts_are_rejected(spark):
    rows = [(i, f"the cat and the dog went over the hill number {i} to see their friends", "en", "a") for i in range(50)]
    model = language.fit(documents(spark, rows))
    got = language.predict(documents(spark, [(1, "всё смешалось в доме", None, None), *rows[:3]]), model).collect()
    assert [r.rejected for r in got] == [True, False, False, False]


FOREIGN = {
    "Finnish": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja "
               "omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.",
    "Dutch": "Alle mensen worden vrij en gelijk in waardigheid en rechten geboren. Zij zijn begiftigd met verstand en "
             "geweten, en behoren zich jegens elkander in een geest van broederschap te gedragen.",
    "Italian": "Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti. Essi sono dotati di ragione e di "
               "coscienza e devono agire gli uni verso gli altri in spirito di fratellanza.",
}


def test_noise_and_unlearned_languages_are_rejected_and_held_out_texts_stay(spark):
    rng = np.random.default_rng(7)

    def noise(alphabet, n):
        return " ".join("".join(rng.choice(list(alphabet), size=rng.integers(2, 10))) for _ in range(n))

    every = "abcdefghijklmnopqrstuvwxyz"
    odd = [noise(every, n) for n in (40, 100, 400) for _ in range(5)]
    odd += [noise("bcdfghjklmnpqrstvwxz", n) for n in (40, 100, 400) for _ in range(5)]
    odd += [base64.b64encode(rng.bytes(n)).decode() for n in (200, 1000, 4000) for _ in range(5)]
    odd += FOREIGN.values()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(language.training(docs))
    frame = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    kept = [r for r in language.predict(frame, model).collect() if not r.rejected]
    assert kept == []
    held = language.predict(docs.where(language.held_out(F.col("doc_id"))), model).collect()
    assert len(held) > 250 and sum(not r.rejected for r in held) >= 0.96 * len(held)


def test_bounds_leave_out_most_pairs_of_clustered_vectors():
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 64)) * 4
    x = np.floor(256 * (centres[rng.integers(0, 40, 3000)] + rng.normal(size=(3000, 64)) * 0.1))
    ids, tally = np.arange(3000), []
    got = topk.search_block(ids[::30], ids[::30], x[::30], ids, ids, x, 5, tally=tally)
    scores = (x[::30] @ x.T).astype(np.int64)
    want = set()
    for i, row in enumerate(scores):
        others = sorted((-s, j) for j, s in enumerate(row) if j != 30 * i)
        want |= {(i, j, -s) for s, j in others[:5]}
    assert set(got) == want and sum(s for s, _ in tally) < 0.05 * sum(n for _, n in tally)


def test_lines(spark, docs, nothing):
    rows = lines.line_dedup(docs).collect()
    assert len(rows) == len(ROWS)
    got = {(r._row.doc_id, r._row.text): r for r in rows}
    assert got[(1, None)].text is None and got[(1, None)].n_lines == 0 and got[(2, "")].n_lines == 1
    assert lines.line_dedup(nothing).count() == 0
    many = [(i, f"own {i}\nheader\n\nheader\nnear", None, None if i == 9 else f"s{i}") for i in range(3, 10)]
    many += [(20 + i, "rare\nsame site", None, f"s{i % 4}") for i in range(12)]
    got = {r._row.doc_id: (r.text, r.n_removed) for r in lines.line_dedup(documents(spark, many)).collect()}
    assert got[3] == ("own 3\nheader\n\nheader\nnear", 0) and got[9] == ("own 9\n", 3) and got[25] == ("rare\nsame site", 0)


def test_line_spread_near_the_threshold_is_exact(spark):
    rows = [(i, "five", None, f"a{i}") for i in range(5)] + [(10 + i, "four", None, f"a{i % 4}") for i in range(40)]
    got = {r._row.doc_id: r.text for r in lines.line_dedup(documents(spark, rows), min_sites=5).collect()}
    assert [got[i] for i in range(5)] == ["five", "", "", "", ""] and got[30] == "four"


def test_shards(docs, nothing):
    rows = sharding.shard_documents(docs, shards=3).collect()
    assert len(rows) == len(ROWS)
    for s in range(3):
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))
    assert {r["size"] for r in rows if r.doc_id in (1, 2)} == {8} and sharding.shard_documents(nothing).count() == 0


def test_one_text_with_a_third_of_all_rows_is_spread(spark):
    rows = [(i, "same text here" if i % 3 == 0 else f"text number {i}", None, None) for i in range(6000)]
    got = sharding.shard_documents(documents(spark, rows), shards=8).groupBy("shard").agg(F.sum("size").alias("s")).collect()
    loads = [r.s for r in got]
    assert len(loads) == 8 and max(loads) - min(loads) < 0.02 * max(loads)


def test_placing_takes_the_highest_dot_product():
    out = sharding.place(np.array([[4.0, 0], [0, 4], [4, 0], [0, 4]]), 2)
    assert out[0] != out[2] and out[1] != out[3]


PAGES = [
    (1, "http://WWW.Example.com/en/1?x#y"), (2, "https://a.example.com/en/"), (3, "http://example.com/de/en/"),
    (4, "http://x.net/es/1"), (5, "http://net/fr/"), (6, "http://x.net/de/"), (7, None), (8, "no scheme"), (9, ""),
    (10, "http://notexample.com/en/"), (11, "http://a.com"), (12, "http://a.com?q=/en/"), (12, "http://a.com?q=/en/"),
    (None, "http://x.NET/fr/z"), (13, "HTTP://h.org/é"),
]


def test_urls(spark):
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, rule string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = urls.judge(pages, labels).collect()
    assert len(rows) == len(PAGES)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows}
    assert got[1] == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert got[2] == ("a.example.com", "/en/", "example.com/en/", "block") and got[3][2:] == ("com/", "allow")
    assert got[4][2:] == ("net/es/", "block") and got[5][2:] == ("net/fr/", "block") and got[6][2:] == (None, "allow")
    assert got[7] == ("", "", None, "allow") and got[8] == got[7] and got[10][2:] == ("com/", "allow")
    assert got[11] == ("a.com", "", None, "allow") and got[None][2:] == ("net/fr/", "block")
    assert urls.judge(pages.limit(0), labels).count() == 0


def test_mined_rules_block(spark):
    pages = [(i, f"http://{'spam' if i % 4 == 0 else 'fine'}.site.org/{'buy' if i % 2 else 'read'}/{i}") for i in range(200)]
    pages += [(1000, "http://spam.site.org/other"), (1001, "http://spam.other.org/read/x"), (1002, "http://fine.site.org/read")]
    frame = spark.createDataFrame(pages, "page_id long, url string")
    labels = spark.createDataFrame(
        [(i, 0 if i % 4 == 0 else 1, 0) for i in range(0, 200)] + [(3, None, None)], "doc_id long, quality int, toxic int"
    )
    got = {r.page_id: r.verdict for r in urls.judge(frame, labels).collect()}
    assert got[0] == got[1000] == got[1001] == "block" and got[1] == got[2] == got[1002] == "allow"


@pytest.mark.parametrize("bad, other, fresh", [
    ("/a/b/casino/{}", "/a/b/news/{}", "/c/d/casino/x"),
    ("/a/b/c/d/e/casino/{}", "/a/b/c/d/e/news/{}", "/casino"),
    ("/{}?page=2&ref=x", "/{}?page=2&ref=y", "/n?ref=x"),
    ("/{}?casino=1", "/{}?news=1", "/n?page=1&casino=7"),
    ("/{}#/casino/{}", "/{}#/news/{}", "/n?ref=z#casino"),
])
def test_rules_come_from_the_whole_url(spark, bad, other, fresh):
    pages = [(i, "http://www.site.org" + (bad if i % 4 == 0 else other).format(i, i)) for i in range(200)]
    pages += [(1000, "http://m.site.org" + fresh), (1001, "http://m.site.org/read")]
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(200)], "doc_id long, quality int, toxic int")
    got = {r.page_id: r.verdict for r in urls.judge(spark.createDataFrame(pages, "page_id long, url string"), labels).collect()}
    assert got[0] == got[196] == got[1000] == "block" and got[1] == got[1001] == "allow"


def test_rules_come_from_all_host_labels(spark):
    pages = [(i, f"http://{'casino' if i % 4 == 0 else 'news'}.a.b.c.d.org/{i}") for i in range(200)]
    pages += [(1000, "http://casino.x.y.z.net/new"), (1001, "http://x.a.b.c.d.org/new")]
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(200)], "doc_id long, quality int, toxic int")
    got = {r.page_id: r.verdict for r in urls.judge(spark.createDataFrame(pages, "page_id long, url string"), labels).collect()}
    assert got[0] == got[1000] == "block" and got[1] == got[1001] == "allow"


def test_tokens_of_one_long_url_are_mined_as_one(spark):
    """60 tokens that only one labelled page has would make 2^60 combinations."""
    long = "http://site.org/" + "/".join(f"x{i}" for i in range(60))
    pages = [(1, long), (2, "http://site.org/y"), (3, "http://site.org/a/x59"), (4, "http://site.org/b")]
    labels = spark.createDataFrame([(1, 0, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    frame = spark.createDataFrame(pages, "page_id long, url string")
    got = {r.page_id: r.verdict for r in urls.judge(frame, labels, min_pages=1).collect()}
    assert got == {1: "block", 2: "allow", 3: "block", 4: "allow"}


@pytest.mark.parametrize("size", [400, 2400])
def test_urls_against_brute_force(spark, size):
    """The same bad pages among few and among many: rules need ten of them, not a share."""
    rng = np.random.default_rng(size)
    hosts, parts, names = ["a.com", "www.b.net", "x.y.org", "spam.org"], ["en", "es", "buy", "Read", ""], ["ref", "id", "page"]
    pages = []
    for i in range(size):
        url = f"HTTP{'s' * int(rng.integers(0, 2))}://{rng.choice(hosts)}/" + "/".join(rng.choice(parts, int(rng.integers(0, 4))))
        if rng.random() < 0.5:
            url += "?" + "&".join(f"{rng.choice(names)}={rng.integers(0, 3)}" for _ in range(int(rng.integers(1, 3))))
        if rng.random() < 0.2:
            url += f"#top/{rng.integers(0, 2)}"
        pages.append((i, url))
    bad = {i for i, u in pages if "spam" in u and "/buy" in u and "ref=1" in u}
    bad = set(sorted(bad)[:14]) | {i for i in range(size) if rng.random() < 0.02}
    labels = [(i, 0 if i in bad else 1, 0) for i in range(0, size) if rng.random() < 0.9 or i in bad]
    frame = spark.createDataFrame(pages, "page_id long, url string")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    for min_pages in (3, urls.MIN_PAGES):
        got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(frame, known, min_pages=min_pages).collect()}
        assert got == brute.url_verdicts(pages, labels, urls.RULES, min_pages)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string")


def test_top_k(spark):
    rng = np.random.default_rng(2)
    data = rng.normal(size=(300, 24)).astype(np.float32)
    data[10:20] = data[0]
    rows = [(i, v.tolist(), "x") for i, v in enumerate(data)]
    rows += [(900, None, "x"), (950, [1.0, None] + [0.0] * 22, "x"), (1000, [float("nan")] * 24, "x"), (None, data[1].tolist(), "x")]
    rows += [(150, data[7].tolist(), "x")]
    frame = vectors(spark, rows)
    got = topk.top_k(frame, F.col("vec_id") % 50 == 0, query_block=4, row_block=64)
    ints = [(i, np.floor(256 * np.array(v, dtype=np.float64)).astype(np.int64)) for i, v, _ in rows[:300] + rows[-1:]]
    want = []
    for at, (i, q) in enumerate(ints):
        if i % 50 == 0:
            best = sorted((-int(q @ v), j) for n, (j, v) in enumerate(ints) if n != at)[:5]
            want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_top_k_of_few_and_odd_vectors(spark):
    frame = vectors(spark, [(0, [1.0, 2.0], "a"), (1, [0.5, 0.5], "a"), (2, [3.0], "a"), (50, [3e38, 3e38], "a"), (100, [], "a")])
    got = [tuple(r) for r in topk.top_k(frame, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()]
    assert [r[:3] for r in got] == [(0, 1, 50), (0, 2, 1), (50, 1, 0), (50, 2, 1)]
    assert topk.top_k(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages(spark, docs, nothing, name, stage):
    got = stage(spark, docs, "")
    assert name == "bpe" or got.columns == docs.columns
    assert got.count() > 0 and stage(spark, nothing, "").count() == 0
