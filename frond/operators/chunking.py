"""Per-key results when a handful of keys own most rows: exact offset chunking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from frond.storage import Scratch

CHUNK_ROWS = 250_000


def _number(batches):
    """Add each row's 1-based place among the rows of its key in this partition."""
    import numpy as np
    import pyarrow as pa

    seen: dict = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        codes = batch.column("_key").dictionary_encode()
        idx = codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        order = np.argsort(idx, kind="stable")
        srt = idx[order]
        starts = np.flatnonzero(np.r_[True, srt[1:] != srt[:-1]])
        lengths = np.diff(np.r_[starts, len(srt)])
        base = np.empty(len(starts), np.int64)
        for j, s in enumerate(starts):
            name = codes.dictionary[int(srt[s])].as_py()
            base[j] = seen.get(name, 0)
            seen[name] = int(base[j] + lengths[j])
        place = np.empty(len(srt), np.int64)
        place[order] = np.arange(len(srt)) - np.repeat(starts, lengths) + np.repeat(base, lengths) + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], names=[*batch.schema.names, "_place"])


def number_rows(df: DataFrame, key: Column, order: list[str], keep: list[Column], chunk_rows: int = CHUNK_ROWS, scratch: Scratch | None = None) -> DataFrame:
    """Rows with a key, as (_key, _row, _chunk, kept columns): _row is the exact place by ``order``.

    1. Range-partition by ``order`` and sort within partitions: partitions are even however the keys
       fall. 2. Number each key's rows inside its partition, with one counter a key. The result is
       written, so later passes see the same partitions even after a lost executor. 3. Count rows
       of each key and partition and take prefix sums over partitions. 4. Add them up.
    No row moves by its key alone, so no task meets more than a partition or a chunk. Rows with a
    null key are left out. ``order`` should identify a row, else ties are numbered in any order.
    """
    scratch = scratch or Scratch(df.sparkSession)
    rows = df.select(key.alias("_key"), *order, *keep).where(F.col("_key").isNotNull())
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.select(*rows.columns, F.spark_partition_id().alias("_part"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", _place bigint"
    placed = scratch.write(rows.mapInArrow(_number, schema), "numbered")
    counts = placed.groupBy("_key", "_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = W.partitionBy("_key").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("_key", "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    row = F.col("_offset") + F.col("_place")
    out = placed.join(offsets, ["_key", "_part"]).withColumn("_row", row)
    return out.withColumn("_chunk", F.floor((F.col("_row") - 1) / chunk_rows).cast("bigint")).drop("_part", "_place", "_offset")


def _fold(states: DataFrame, keys: list[str]) -> DataFrame:
    """The ordered states of each of ``keys`` as one state."""
    got = states.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_chunk", "n", "first", "last", "best", "head", "tail"))).alias("s"))
    zero = F.lit(0).cast("bigint")
    start = F.struct(zero.alias("n"), zero.alias("best"), zero.alias("head"), zero.alias("tail"))
    both = F.aggregate(
        "s",
        start,
        lambda a, x: F.struct(
            (a["n"] + x["n"]).alias("n"),
            F.greatest(a["best"], x["best"], a["tail"] + x["head"]).alias("best"),
            F.when(a["head"] == a["n"], a["n"] + x["head"]).otherwise(a["head"]).alias("head"),
            F.when(x["tail"] == x["n"], a["tail"] + x["n"]).otherwise(x["tail"]).alias("tail"),
        ),
    )
    got = got.withColumn("_f", both)
    return got.select(*keys, *[F.col(f"_f.{c}").alias(c) for c in ("n", "best", "head", "tail")], F.col("s")[0]["first"].alias("first"), F.element_at("s", -1)["last"].alias("last"))


def merge_runs(chunks: DataFrame, fan: int = 1024) -> DataFrame:
    """Fold the ordered chunk states of each key.

    A state has n rows, its first and last value, and for runs of flagged rows the longest (best),
    the one at its start (head) and the one at its end (tail). A run crossing a border is the tail
    carried so far plus the head. States of ``fan`` neighbouring chunks are folded first, then those
    of the key, so a key of n rows brings n / (chunk_rows * fan) states together at the end.
    """
    groups = _fold(chunks.withColumn("_group", F.floor(F.col("_chunk") / fan)), ["_key", "_group"]).withColumnRenamed("_group", "_chunk")
    return _fold(groups, ["_key"]).select(F.col("_key").alias("key"), F.col("n").alias("n_rows"), F.col("first").alias("first_value"), F.col("last").alias("last_value"), F.col("best").alias("longest_run"))


def per_key_summary(df: DataFrame, key: Column, order: list[str], value: Column, flag: Column, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """For each key: rows, value of its first and last row by ``order``, longest run of flagged rows.

    Null values count as values; a null flag is no flag. Empty input gives no rows. The rows are
    written once and go through the numbering without their value: states hold the order of a first
    and last row, by which the values are fetched at the end, two rows for each key. Of rows that
    ``order`` does not tell apart the least value counts, null before others.
    """
    scratch = Scratch(df.sparkSession)
    names = [f"_o{i}" for i in range(len(order))]
    given = [F.col(o).alias(n) for o, n in zip(order, names)]
    base = scratch.write(df.select(key.alias("_k"), *given, value.alias("_value"), F.coalesce(flag, F.lit(False)).alias("_flag")), "rows")
    rows = number_rows(base, F.col("_k"), names, [F.col("_flag")], chunk_rows, scratch)
    inside = W.partitionBy("_key", "_chunk").orderBy("_row")
    off = F.when(~F.col("_flag"), F.col("_row"))
    start = F.col("_chunk") * chunk_rows
    run = F.col("_row") - F.coalesce(F.max(off).over(inside.rowsBetween(W.unboundedPreceding, 0)), start)
    states = rows.withColumn("_run", run).groupBy("_key", "_chunk").agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by(F.struct(*names), "_row").alias("first"),
        F.max_by(F.struct(*names), "_row").alias("last"),
        F.max("_run").alias("best"),
        F.min(off).alias("_off_first"),
        F.max(off).alias("_off_last"),
    )
    end = start + F.col("n")
    states = states.withColumn("head", F.coalesce(F.col("_off_first") - 1 - start, F.col("n")))
    states = states.withColumn("tail", F.coalesce(end - F.col("_off_last"), F.col("n")))
    merged = scratch.write(merge_runs(states), "merged")
    ends = merged.select("key", F.explode(F.array(F.struct(F.lit(0).alias("end"), F.col("first_value").alias("o")), F.struct(F.lit(1).alias("end"), F.col("last_value").alias("o")))).alias("e"))
    ends = ends.select("key", F.col("e.end").alias("_end"), *[F.col(f"e.o.{n}").alias(f"_e{n}") for n in names])
    same = F.col("_k") == F.col("key")
    for n in names:
        same = same & F.col(n).eqNullSafe(F.col(f"_e{n}"))
    found = base.join(ends, same).groupBy("key").agg(*[F.min(F.when(F.col("_end") == e, F.struct("_value"))).alias(n) for e, n in ((0, "_first"), (1, "_last"))])
    return merged.drop("first_value", "last_value").join(found, "key").select("key", "n_rows", F.col("_first._value").alias("first_value"), F.col("_last._value").alias("last_value"), "longest_run")


def key_counts(df: DataFrame, key: Column, order: list[str], chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(key, n_rows) from merged chunk states."""
    rows = number_rows(df, key, order, [], chunk_rows)
    states = rows.groupBy("_key", "_chunk").agg(F.count(F.lit(1)).alias("n"))
    return states.groupBy(F.col("_key").alias("key")).agg(F.sum("n").alias("n_rows"))


def one_per_id(df: DataFrame, id_col: str, columns: dict[str, Column], newest: str) -> DataFrame:
    """One row for each non-null id: the columns of its newest delivery (nulls oldest).

    The aggregate combines before its shuffle, so an id delivered very often makes no large task.
    Deliveries of the same time are told apart by the columns themselves, the greatest staying.
    """
    pick = F.struct(*[c.alias(n) for n, c in columns.items()])
    got = df.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max(F.struct(F.col(newest).alias("t"), pick.alias("p"))).alias("b"))
    return got.select(id_col, *[F.col(f"b.p.{n}").alias(n) for n in columns])
