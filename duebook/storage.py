"""Tables written between jobs.

Results that several jobs need are written once as Parquet into the folder that
``spark.checkpoint.dir`` names, so they survive the loss of any executor and are read
back with column pruning and filter pushdown.  Where that is unset a session on one machine
writes below its warehouse; on a cluster it is an error, since executors would not see each
other's files.  An application's tables are removed when its Python process ends.
"""

import atexit
import math
import uuid

from pyspark.sql import DataFrame, SparkSession

_FOLDERS = {}

SPLIT = 16 << 20  # bytes of files, or of shuffled rows, that one task takes
SHARE = 4 << 20  # bytes of input for each shuffle partition; rows grow to several times that on their way
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
CODEC = "zstd"  # of stored Parquet files: a quarter to a third smaller than with the default
SIZES = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": SPLIT, "spark.sql.files.maxPartitionBytes": SPLIT}
_SET = {}  # application -> the number of shuffle partitions that `size_tasks` set last


def _delete(spark: SparkSession, path: str) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(conf).delete(place, True)


def shared_folder(spark: SparkSession) -> str:
    """Folder for this application below ``spark.checkpoint.dir``."""
    app = spark.sparkContext.applicationId
    if app not in _FOLDERS:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            master = spark.sparkContext.master
            if not master.startswith("local") or master.startswith("local-cluster"):
                raise ValueError("Set spark.checkpoint.dir to a folder that the driver and all executors share.")
            base = spark.conf.get("spark.sql.warehouse.dir")
        _FOLDERS[app] = f"{base.rstrip('/')}/duebook-{app}-{uuid.uuid4().hex[:8]}"
        atexit.register(_remove, spark, app)
    return _FOLDERS[app]


def _remove(spark: SparkSession, app: str) -> None:
    try:
        if spark.sparkContext._jsc and spark.sparkContext.applicationId == app:
            _delete(spark, _FOLDERS[app])
    except Exception:  # the session has ended before: its files stay for whoever owns the folder
        pass


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def input_bytes(spark: SparkSession, paths) -> int:
    """Size of the files or folders that exist among `paths`."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    places = [jvm.org.apache.hadoop.fs.Path(p) for p in paths]
    stores = [p.getFileSystem(conf) for p in places]
    return sum(fs.getContentSummary(p).getLength() for p, fs in zip(places, stores, strict=True) if fs.exists(p))


def size_tasks(spark: SparkSession, size: int) -> int:
    """Let the number of tasks follow an input of `size` bytes, so that none has to spill.

    Shuffles begin with a partition per `SHARE` of the input, at least as many as
    ``spark.sql.shuffle.partitions``; adaptive execution unites what is smaller than `SPLIT`.
    Settings that the session already has stay as they are.
    """
    conf, app = spark.conf, spark.sparkContext.applicationId
    given = conf.getAll
    for key, value in SIZES.items():
        if key not in given:
            conf.set(key, str(value))
    if given.get(INITIAL, _SET.get(app)) == _SET.get(app):
        _SET[app] = str(max(int(conf.get("spark.sql.shuffle.partitions")), math.ceil(size / SHARE)))
        conf.set(INITIAL, _SET[app])
    return int(conf.get(INITIAL))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to a fresh shared path and return a DataFrame over the written files.

    A file can be read by several tasks, one for each of its row groups.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.options(**{"parquet.block.size": SPLIT, "compression": CODEC}).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Remove materialized tables that no later job reads."""
    for table in tables:
        for path in {f.rpartition("/")[0] for f in table.inputFiles()}:
            _delete(table.sparkSession, path)
