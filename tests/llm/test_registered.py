"""Registered queries against their SQL, and those without SQL against brute force."""

import zlib

import numpy as np
import pytest

from duebook.llm import bpe, catalog
from tests.compare import differences, duck
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").collect()


@pytest.mark.parametrize("name", list(SQL))
def test_same_rows_as_sql(spark, con, name):
    assert differences(spark, con, FOLDER, name, QUERIES[name], SQL[name]) is None


def test_repeats(spark, docs):
    rows = QUERIES["op1_suffix_dedup"](spark, FOLDER).collect()
    assert {r[0]: tuple(r)[1:5] for r in rows} == brute.repeats([(r.doc_id, r.text) for r in docs])
    shared = brute.shared_words([(r.doc_id, r.text) for r in docs])
    assert {r.doc_id for r in rows if r.shares_passage} == {i for i, n in shared.items() if n}
    assert all(0 <= r.n_shared_words <= shared[r.doc_id] for r in rows) and any(shared.values())


def test_bpe_is_that_of_the_library(spark, docs):
    enc, _ = bpe.codec(bpe.public_tokenizers.path(bpe.RANKS))
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op4_bpe_round_trip"](spark, FOLDER).collect()}
    for r in docs:
        ids = np.array(enc.encode_ordinary(r.text or ""), dtype="<u4").tobytes()
        assert got[r.doc_id] == (len(ids) // 4, brute.sha(ids), brute.sha((r.text or "").encode()))


def test_held_out_languages(spark, docs):
    lang = {r.doc_id: r.lang for r in docs}
    rows = QUERIES["op7_language_id"](spark, FOLDER).collect()
    assert {r.doc_id for r in rows} == set(lang) and len(rows) == len(docs)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in lang if zlib.crc32(str(i).encode()) % 3 == 1}
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_shards(spark, docs):
    rows = QUERIES["op9_shards"](spark, FOLDER).collect()
    size = {r.doc_id: len((r.text or "").encode()) + 8 for r in docs}
    crc = {r.doc_id: zlib.crc32((r.text or "").encode()) for r in docs}
    assert {r.doc_id: r["size"] for r in rows} == size and {r.doc_id: r.text_crc32 for r in rows} == crc
    per = {}
    for r in rows:
        assert r.law == "bytes" and r.grown_shard is None
        per.setdefault(r.shard, []).append(r)
    assert all(sorted(r.slot for r in x) == list(range(len(x))) for x in per.values())
    loads = [sum(r["size"] for r in x) for x in per.values()]
    assert len(loads) == 24 and max(loads) - min(loads) <= 2 * max(size.values())
    want = brute.shards([(r.doc_id, r.text) for r in docs], 24, 128)
    assert {r.doc_id: (r["size"], r.shard, r.slot) for r in rows} == want


def test_pipeline_stages(spark, docs, tmp_path):
    import corpus_pipeline

    frame = spark.read.parquet(f"{FOLDER}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, FOLDER)
        frame.write.parquet(str(tmp_path / name))
        frame = spark.read.parquet(str(tmp_path / name))
        seen.append({"rows": frame.collect(), "columns": frame.columns})
    first, lined, deduped, mixed, tokens = seen
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(set(s["columns"]) == set(columns) for s in seen[:4])
    assert 0.97 * len(docs) <= len(first["rows"]) <= len(docs)
    assert brute.lines([(r.doc_id, r.source, r.text) for r in first["rows"]], 5) == {
        r.doc_id: r.text for r in lined["rows"]}
    groups = brute.components([(r.doc_id, r.text) for r in lined["rows"]], 5, 80)
    assert sorted(r.doc_id for r in deduped["rows"]) == sorted(i for i, g in groups.items() if i == g)
    assert {r.doc_id for r in mixed["rows"]} <= {r.doc_id for r in deduped["rows"]}
    enc, _ = bpe.codec(bpe.public_tokenizers.path(bpe.RANKS))
    want = sorted((r.doc_id, brute.sha(np.array(enc.encode_ordinary(r.text), dtype="<u4").tobytes())) for r in mixed["rows"])
    assert sorted((r.doc_id, r.ids_sha256) for r in tokens["rows"]) == want


def test_pipeline_runs(spark):
    import corpus_pipeline

    assert corpus_pipeline.run(spark, FOLDER).count() > 0
