"""Written tables in the folder that all executors share.

Iterative operators cut their lineage by writing a step as Parquet and reading it back, so a lost
executor costs a re-read and not a recomputation. The folder is the one the session names in
``spark.checkpoint.dir``; where none is named (tests, a laptop) a temporary one is made, which is
refused on a real cluster because its executors could not see it.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from frond.session import ship

_LEFTOVER: dict[str, SparkSession] = {}
_LOCAL: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get().rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if not _LOCAL:
        _LOCAL.append("file://" + tempfile.mkdtemp(prefix="frond-"))
    return _LOCAL[0]


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder; one atomic step on HDFS and local disks."""
    jvm = spark.sparkContext._jvm
    a, b = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    fs = a.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(b.getParent())
    if not fs.rename(a, b):
        raise OSError(f"cannot move {source} to {target}")


def exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def file_sizes(spark: SparkSession, path: str) -> list[int]:
    """Bytes of each Parquet file directly in a folder."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getLen() for s in fs.listStatus(at) if s.getPath().getName().endswith(".parquet")]


class Scratch:
    """Tables written by one operator call.

    ``write`` materialises a DataFrame and returns it as a scan; ``drop`` deletes a table no later
    step reads. What a returned DataFrame still reads stays until the interpreter ends.
    """

    def __init__(self, spark: SparkSession):
        ship(spark)
        self.spark = spark
        self.root = f"{shared_dir(spark)}/frond-{uuid.uuid4().hex}"
        self._paths: dict[int, str] = {}
        self._n = 0
        _LEFTOVER[self.root] = spark

    def path(self, tag: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{tag}"

    def write(self, df: DataFrame, tag: str) -> DataFrame:
        at = self.path(tag)
        df.write.option("compression", "zstd").parquet(at)
        back = self.spark.read.schema(df.schema).parquet(at)
        self._paths[id(back)] = at
        return back

    def drop(self, df: DataFrame) -> None:
        if at := self._paths.pop(id(df), None):
            _delete(self.spark, at)

    def close(self) -> None:
        """Delete all tables of this call; what was returned and still reads them can no longer run."""
        _delete(self.spark, self.root)
        _LEFTOVER.pop(self.root, None)


def release(spark: SparkSession) -> int:
    """Delete the tables of all calls so far, for a driver that lives long; returns how many calls.

    To be called once the DataFrames that operators returned have been consumed.
    """
    roots = [r for r, s in _LEFTOVER.items() if s is spark]
    for root in roots:
        _delete(spark, root)
        _LEFTOVER.pop(root, None)
    return len(roots)


@atexit.register
def _sweep() -> None:
    for root, spark in list(_LEFTOVER.items()):
        try:
            _delete(spark, root)
        except Exception:  # the JVM may be gone already
            pass
