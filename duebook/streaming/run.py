"""Running a streaming query over what is there, and reading its result back."""

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from duebook.storage import new_path

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for the queries started inside the block."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def stream_files(spark: SparkSession, path: str, schema, pattern=None, files_per_batch=None) -> DataFrame:
    """Parquet files under `path` as a stream with an explicit schema."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def append_available(stream: DataFrame, name: str, path: str | None = None, **confs) -> str:
    """Append everything available to Parquet files; a second call with the same `path` goes on
    where the first one stopped."""
    path = path or new_path(stream.sparkSession, name)
    with settings(stream.sparkSession, {STATE_STORE: ROCKSDB, **confs}):
        query = (
            stream.writeStream.outputMode("append")
            .format("parquet")
            .option("path", f"{path}/rows")
            .option("checkpointLocation", f"{path}/state")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    return path


def update_available(stream: DataFrame, name: str, path: str | None = None, **confs) -> str:
    """Write the rows changed by each batch under that batch's number, so that a repeated batch
    replaces itself."""
    path = path or new_path(stream.sparkSession, name)

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/rows/batch_number={number}")

    with settings(stream.sparkSession, {STATE_STORE: ROCKSDB, **confs}):
        query = (
            stream.writeStream.outputMode("update")
            .foreachBatch(keep)
            .option("checkpointLocation", f"{path}/state")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    return path


def appended(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{path}/rows")


def latest(spark: SparkSession, path: str, schema, keys) -> DataFrame:
    """The last written row per key."""
    numbered = StructType([*schema.fields, StructField("batch_number", LongType())])
    rows = spark.read.schema(numbered).parquet(f"{path}/rows")
    values = [name for name in schema.names if name not in keys]
    newest = F.max_by(F.struct(*values), "batch_number").alias("_row")
    return rows.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"_row.{v}") for v in values])
