"""Consolidating a mass of tiny files into a few well-sized ones."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frond import storage
from frond.functions.keys import file_key
from frond.storage import Scratch

#: Parquet with zstd holds label and note text in about a third of the bytes the shuffle sees.
SHUFFLE_TO_FILE = 3


@dataclass(frozen=True)
class Checksum:
    """Order-free digest of a multiset of rows: their number and two sums of row hashes."""

    rows: int
    low: int
    high: int


def row_hashes(df: DataFrame) -> list:
    """Two hashes of a row over all columns; nulls count by position, so (null, x) and (x, null) differ."""
    cells = [x for c in df.columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())] or [F.lit(0)]
    return [F.xxhash64(F.lit(seed), *cells) for seed in (17, 40503)]


def _summed(low, high) -> list:
    big = lambda h: F.sum(h.cast("decimal(38,0)"))
    return [F.count(F.lit(1)), big(low), big(high)]


def multiset_checksum(df: DataFrame) -> Checksum:
    """Checksum over all columns.

    Sums, unlike exclusive or, do not cancel repeated rows. An empty table gives zeros.
    """
    r = df.agg(*_summed(*row_hashes(df))).first()
    return Checksum(r[0], int(r[1] or 0), int(r[2] or 0))


def _own_settings(df: DataFrame, settings: dict[str, str]) -> DataFrame:
    """The same rows in a session of their own, so that no other user of this session sees ``settings``."""
    spark = df.sparkSession
    own = spark._jsparkSession.cloneSession()
    for k, v in settings.items():
        own.conf().set(k, v)
    dataset = getattr(spark._jvm, "org.apache.spark.sql.classic.Dataset")
    return DataFrame(dataset.ofRows(own, df._jdf.logicalPlan()), spark)


def compact(df: DataFrame, target: str, file_bytes: int = 128 << 20, hashes: DataFrame | None = None) -> dict:
    """Write ``df`` to ``target`` as Parquet files near ``file_bytes``, each record exactly once.

    The rows pass a REBALANCE exchange: runtime statistics merge small output partitions and split
    large ones, so neither many tiny inputs nor one hot input yields odd files. The folder appears
    under its name only after the multiset checksum of what was written equals that of the input;
    otherwise nothing is committed and RuntimeError is raised. Returns the manifest, which is also
    stored beside the files. ``df`` has to be repeatable, as it is read for the checksum too; where
    its rows are costly to find, ``hashes`` gives the ``row_hashes`` (low, high) of the same rows by
    a way that does not move their content. An existing ``target`` is refused. An empty table
    commits an empty folder with a schema.
    """
    spark = df.sparkSession
    if storage.exists(spark, target):
        raise FileExistsError(target)
    staging = f"{target}.staging"
    if hashes is None:
        before = multiset_checksum(df)
    else:
        r = hashes.agg(*_summed(F.col("low"), F.col("high"))).first()
        before = Checksum(r[0], int(r[1] or 0), int(r[2] or 0))
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(file_bytes * SHUFFLE_TO_FILE), "spark.sql.adaptive.enabled": "true"}
    _own_settings(df.hint("rebalance"), settings).write.mode("overwrite").option("compression", "zstd").parquet(staging)
    after = multiset_checksum(spark.read.schema(df.schema).parquet(staging))
    if before != after:
        storage._delete(spark, staging)
        raise RuntimeError(f"not committed: {before} was read and {after} was written")
    sizes = storage.file_sizes(spark, staging)
    manifest = {"rows": after.rows, "files": len(sizes), "bytes": sum(sizes), "largest": max(sizes, default=0), "checksum": [str(after.low), str(after.high)]}
    spark.range(1).select(F.lit(json.dumps(manifest)).alias("value")).coalesce(1).write.mode("overwrite").text(f"{staging}/_manifest")
    storage.rename(spark, staging, target)
    return manifest


def current_ids(files: DataFrame) -> DataFrame:
    """(_keep): file_id of the row that holds the latest state of each file, written once.

    Rows whose label_path names no file (null, blank) are kept as they are: nothing shows that they
    repeat another. A null modified_at is older than any other. On a tie the smallest file_id stays.
    The latest row is found by an aggregate, which combines before its shuffle.
    """
    keyed = files.where(F.col("file_id").isNotNull()).select("file_id", "modified_at", file_key(F.col("label_path")).alias("_file"))
    # a row without a file is a group of its own; the complement of an id orders it downwards
    group = F.when(F.col("_file").isNull(), F.col("file_id"))
    best = keyed.groupBy("_file", group.alias("_alone")).agg(F.max(F.struct("modified_at", F.bitwise_not("file_id").alias("m"))).alias("b"))
    return Scratch(files.sparkSession).write(best.select(F.bitwise_not("b.m").alias("_keep")), "current")


def current_label_files(files: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Rows of label_files that hold the latest state of their file; rows without file_id are kept.

    They are fetched by their unique file_id, so a file listed a million times makes no large task.
    """
    ids = current_ids(files) if ids is None else ids
    named = files.join(ids, files["file_id"] == ids["_keep"], "left_semi")
    return named.unionByName(files.where(F.col("file_id").isNull()))


def compact_label_files(spark: SparkSession, files: DataFrame, target: str, file_bytes: int = 128 << 20) -> dict:
    """Current label records, empty ones included, as a few Parquet files.

    The input's checksum joins row hashes with the current ids, so content is shuffled for the write
    only.
    """
    ids = current_ids(files)
    low, high = row_hashes(files)
    thin = files.select("file_id", low.alias("low"), high.alias("high"))
    hashes = thin.join(ids, F.col("file_id") == F.col("_keep"), "left_semi").unionByName(thin.where(F.col("file_id").isNull()))
    return compact(current_label_files(files, ids), target, file_bytes, hashes)


def read_compacted(spark: SparkSession, target: str, schema) -> DataFrame:
    """The committed records."""
    return spark.read.schema(schema).parquet(target)
