"""Stored tables that change by bucket, and sets of them that become visible together.

A table lies below ``<root>/<table>/_run=<run>/_bucket=<n>`` as plain Parquet; a row's bucket is
the hash of its key.  One small file, the pointer, says which runs hold the rows of each bucket.
A run writes its files into folders of its own and is published by renaming a new pointer into
place, after all its tables are there.  So a request reads and writes the buckets of its keys
and no others, readers see either all tables of a run or none, and a run that stops half-way
leaves nothing but folders that no pointer names.  Runs that end after another one was
published since they began are turned down.
"""

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from duebook.storage import CODEC

BUCKET, RUN = "_bucket", "_run"


class Conflict(RuntimeError):
    """Another run was published since this one began."""


class Tables:
    """Tables below `root`.  `keys` names the key column of each; a table not listed has none.

    `buckets` holds for tables that are created from now on; a table keeps its own number.
    """

    def __init__(self, spark: SparkSession, root: str, keys: dict[str, str], buckets: int = 64):
        self.spark, self.root, self.keys, self.buckets = spark, root.rstrip("/"), dict(keys), buckets

    # ---- the pointer ---------------------------------------------------------------
    def _files(self):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path
        return path, path(self.root).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str, prefix: str) -> list[str]:
        path, fs = self._files()
        place = path(folder)
        if not fs.exists(place):
            return []
        found = [f.getPath().getName() for f in fs.listStatus(place)]
        return sorted(n for n in found if n.startswith(prefix))

    def pointer(self) -> dict:
        """What is published: {"number", "tables": {name: {"schema", "key", "buckets", "parts", "highest"}}, "notes"}."""
        names = self._names(self.root, "pointer-")
        if not names:
            return {"number": 0, "tables": {}, "notes": {}}
        return json.loads(self.spark.read.text(f"{self.root}/{names[-1]}", wholetext=True).first()[0])

    def _publish(self, pointer: dict) -> None:
        path, fs = self._files()
        draft, final = path(f"{self.root}/draft-{uuid.uuid4().hex}"), path(f"{self.root}/pointer-{pointer['number']:012d}")
        out = fs.create(draft)
        out.write(bytearray(json.dumps(pointer).encode()))
        out.close()
        # A rename onto an existing file fails, so of two runs with one number the first wins.
        if fs.exists(final) or not fs.rename(draft, final):
            fs.delete(draft, False)
            raise Conflict(f"Run {pointer['number']} is already published.")
        for old in self._names(self.root, "pointer-")[:-2]:
            fs.delete(path(f"{self.root}/{old}"), False)

    # ---- reading --------------------------------------------------------------------
    def _frame(self, name: str, entry: dict, parts: dict[str, list[str]]) -> DataFrame:
        schema = StructType.fromJson(entry["schema"])
        folders = [f"{self.root}/{name}/{RUN}={run}/{BUCKET}={b}" for b, runs in parts.items() for run in runs]
        if not folders:
            return self.spark.createDataFrame([], schema)
        placed = StructType([*schema.fields, StructField(RUN, StringType()), StructField(BUCKET, IntegerType())])
        rows = self.spark.read.schema(placed).option("basePath", f"{self.root}/{name}").parquet(*folders)
        return rows.where(F.col(BUCKET).isin([int(b) for b in parts])).select(*schema.names)

    def read(self, name: str, keys: DataFrame | None = None) -> DataFrame:
        """The published rows of a table; with `keys` those of the buckets that these fall into.

        `keys` is a frame whose first column holds key values; null ones fall nowhere.
        """
        entry = self.pointer()["tables"][name]
        parts = entry["parts"]
        if keys is not None:
            parts = {b: runs for b, runs in parts.items() if int(b) in self._touched(entry, keys)}
        return self._frame(name, entry, parts)

    def highest(self, name: str) -> int:
        """Largest key ever published, 0 for none."""
        return self.pointer()["tables"].get(name, {}).get("highest") or 0

    def _touched(self, entry: dict, keys: DataFrame) -> set[int]:
        """Buckets of the keys: at most as many numbers as there are buckets."""
        column = keys.columns[0]
        kind = StructType.fromJson(entry["schema"])[entry["key"]].dataType
        bucket = bucket_of([F.col(column).cast(kind)], entry["buckets"])
        return {r[0] for r in keys.where(F.col(column).isNotNull()).select(bucket).distinct().collect()}

    # ---- writing --------------------------------------------------------------------
    def run(self) -> "Run":
        return Run(self)

    def vacuum(self) -> None:
        """Remove folders of runs that the pointer no longer names; no reader or run may be at work."""
        path, fs = self._files()
        for name, entry in self.pointer()["tables"].items():
            used = {run for runs in entry["parts"].values() for run in runs}
            for folder in self._names(f"{self.root}/{name}", f"{RUN}="):
                if folder.partition("=")[2] not in used:
                    fs.delete(path(f"{self.root}/{name}/{folder}"), True)


def bucket_of(key: list[Column], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int").alias(BUCKET)


def _by_bucket(rows: DataFrame) -> DataFrame:
    """Rows dealt out by bucket; a large bucket goes to several tasks, each of which writes a file of it."""
    if rows.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        return rows.hint("rebalance", F.col(BUCKET))
    return rows.repartition(BUCKET)


class Run:
    """Tables written together.  Nothing is visible to readers before `publish`."""

    def __init__(self, tables: Tables):
        self.tables, self.before = tables, tables.pointer()
        self.next = json.loads(json.dumps(self.before))
        self.next["number"] += 1
        self.id = f"{self.next['number']:012d}-{uuid.uuid4().hex[:8]}"
        self.metrics: dict[str, dict] = {}

    def read(self, name: str, keys: DataFrame | None = None) -> DataFrame:
        """Rows as they were when the run began."""
        entry = self.before["tables"][name]
        parts = entry["parts"]
        if keys is not None:
            touched = self.tables._touched(entry, keys)
            parts = {b: runs for b, runs in parts.items() if int(b) in touched}
        return self.tables._frame(name, entry, parts)

    def highest(self, name: str) -> int:
        return self.before["tables"].get(name, {}).get("highest") or 0

    def create(self, name: str, df: DataFrame, sums=(), options=None) -> DataFrame:
        """Replace a whole table.  The result reads the files of this run."""
        return self._write(name, df, "create", None, sums, options)

    def replace(self, name: str, df: DataFrame, keys: DataFrame, sums=(), options=None) -> DataFrame:
        """Replace the buckets of `keys` by `df`, which must be all of their rows."""
        return self._write(name, df, "replace", keys, sums, options)

    def append(self, name: str, df: DataFrame, sums=(), options=None) -> DataFrame:
        """Add rows; no bucket is rewritten."""
        return self._write(name, df, "append", None, sums, options)

    def _write(self, name, df, mode, keys, sums, options):
        tables, entry = self.tables, self.next["tables"].get(name)
        if name in self.metrics:
            raise ValueError(f"{name} is written twice in one run.")
        if mode == "create" or entry is None:
            key = tables.keys.get(name)
            entry = {"schema": json.loads(df.schema.json()), "key": key, "buckets": tables.buckets, "parts": {}, "highest": 0}
        schema = StructType.fromJson(entry["schema"])
        df = df.select(*schema.names)
        key = entry["key"]
        bucket = bucket_of([F.col(key)] if key else [F.col(c) for c in schema.names], entry["buckets"])
        # Counted while it is written: nothing reads the table again for its totals.
        seen = Observation(f"{name}-{self.id}-{uuid.uuid4().hex[:6]}")
        whole = key is not None and schema[key].dataType.typeName() == "long"
        counted = [F.count("*").alias("rows"), *[F.sum(c).alias(f"sum_{c}") for c in sums]]
        counted += [F.max(key).alias("highest")] if whole else []
        folder = f"{tables.root}/{name}/{RUN}={self.id}"
        writer = _by_bucket(df.observe(seen, *counted).withColumn(BUCKET, bucket)).write
        given = {"compression": CODEC} | (options or {})
        writer.mode("append").options(**given).partitionBy(BUCKET).parquet(folder)
        written = {n.partition("=")[2] for n in tables._names(folder, f"{BUCKET}=")}
        # Where the optimizer knows that there are no rows it leaves the counting out as well.
        self.metrics[name] = dict(seen.get) if written else {"rows": 0, "highest": None}
        if mode == "replace":
            for b in tables._touched(entry, keys):
                entry["parts"].pop(str(b), None)
            outside = written & set(entry["parts"])
            if outside:
                raise ValueError(f"Rows of {name} lie outside the buckets that are replaced.")
        for b in written:
            entry["parts"].setdefault(b, []).append(self.id)
        if whole:
            entry["highest"] = max(entry["highest"], self.metrics[name]["highest"] or 0)
        self.next["tables"][name] = entry
        return tables._frame(name, entry, {b: [self.id] for b in sorted(written)})

    def note(self, name: str, value) -> None:
        """A value that becomes visible with the tables."""
        self.next["notes"][name] = value

    def publish(self) -> None:
        """Make all tables of this run visible at once."""
        if self.tables.pointer()["number"] != self.before["number"]:
            raise Conflict(f"Run {self.next['number']} is already published.")
        self.tables._publish(self.next)


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
