"""The number of tasks follows the size of the input, so that the rows of one stay within its memory."""

import contextlib

import pytest
from pyspark.sql import functions as F

from duebook import storage
from duebook.operators.blocks import ordered_blocks
from duebook.plans.core import core
from duebook.tables import Tables

FOLDER = "/root/testdata/sf0.001"


@contextlib.contextmanager
def confs(spark, **values):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def large(spark):
    """The session as an input of 50 shares leaves it, with small tasks."""
    with confs(spark, **{"spark.sql.adaptive.advisoryPartitionSizeInBytes": "65536",
                         "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16384"}):
        assert storage.size_tasks(spark, 50 * storage.SHARE) == 50
        yield
    storage.size_tasks(spark, 0)


def numbers(spark, n=200_000):
    return spark.range(n).select("id", F.xxhash64("id").alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("text"))


def test_partitions_grow_with_the_input(spark):
    core(spark, FOLDER)
    few = int(spark.conf.get(storage.INITIAL))
    assert few == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert storage.size_tasks(spark, 1000 * storage.SHARE) == 1000
    assert storage.size_tasks(spark, 2000 * storage.SHARE) == 2000
    core(spark, FOLDER)
    assert int(spark.conf.get(storage.INITIAL)) == few


def test_settings_of_the_session_stay(spark):
    with confs(spark, **{storage.INITIAL: "77", "spark.sql.files.maxPartitionBytes": "1m"}):
        assert storage.size_tasks(spark, 1000 * storage.SHARE) == 77
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "1m"
    storage.size_tasks(spark, 0)


def test_blocks_grow_with_the_rows(spark, large):
    cut = ordered_blocks(numbers(spark), ["v", "id"])
    sizes = [r["count"] for r in cut.groupBy("_block").count().collect()]
    assert len(sizes) > 20 and max(sizes) < 200_000 / 10


def test_a_large_bucket_goes_to_several_tasks(spark, large, tmp_path):
    tables = Tables(spark, str(tmp_path / "t"), {"rows": "id"}, 2)
    run = tables.run()
    run.create("rows", numbers(spark))
    run.publish()
    files = tables.read("rows").inputFiles()
    assert len({f.partition("_bucket=")[2].partition("/")[0] for f in files}) == 2 and len(files) > 8
    assert tables.read("rows").agg(F.count("*"), F.sum("id")).first() == numbers(spark).agg(F.count("*"), F.sum("id")).first()


def test_a_large_file_is_read_by_several_tasks(spark):
    with confs(spark, **{"spark.sql.files.maxPartitionBytes": "4m", "spark.sql.files.openCostInBytes": "0"}):
        rows = spark.range(0, 400_000, 1, 1).select("id", F.sha2(F.col("id").cast("string"), 512).alias("text"))
        back = storage.materialize(rows, "one-file")
        assert len(back.inputFiles()) == 1
        per_task = back.groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) > 2
