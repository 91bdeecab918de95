"""Joins and ranks which stay balanced when a few keys own most rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

HOT_ROWS = 200_000
MAX_HOT_KEYS = 1024
#: Largest written table that the planner may broadcast by its size in files.
MAX_SENT = 100_000


def hot_keys(counts: DataFrame, key: str, n: str, hot_rows: int = HOT_ROWS, total: int | None = None) -> list:
    """Keys whose count exceeds both ``hot_rows`` and a 1/1024 of the total.

    ``counts`` has one row for each key. Since counts add up to the total, fewer than 1024 keys can
    qualify, whatever the data; this is the proof of size for the broadcast in ``lookup``. ``total``
    is given where ``counts`` leaves out keys that cannot qualify.
    """
    if total is None:
        total = counts.agg(F.sum(n)).first()[0] or 0
    least = max(hot_rows, total / MAX_HOT_KEYS)
    return [r[0] for r in counts.where(F.col(n) > least).select(key).limit(MAX_HOT_KEYS).collect()]


def hot_of(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> list:
    """The hot keys of a column; a table of at most ``hot_rows`` rows can have none and is not searched."""
    if df.limit(hot_rows + 1).count() <= hot_rows:
        return []
    return hot_keys(df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")), key, "n", hot_rows)


def lookup(big: DataFrame, small: DataFrame, key: str, hot: list, how: str = "inner") -> DataFrame:
    """Equi-join of ``big`` with a table of unique keys, the hot keys' rows staying where they are.

    Rows of hot keys meet a broadcast of at most 1024 rows; the rest is an ordinary shuffle join.
    Null keys match nothing; a left join keeps them without sending them all to one task.
    """
    known = big.where(F.col(key).isNotNull())
    if hot:
        is_hot = F.col(key).isin(hot)
        few = F.broadcast(small.where(is_hot))
        out = known.where(~is_hot).join(small.where(~is_hot), key, how).unionByName(known.where(is_hot).join(few, key, how))
    else:
        out = known.join(small, key, how)
    if how != "left":
        return out
    new = [F.lit(None).cast(f.dataType).alias(f.name) for f in small.schema if f.name != key]
    return out.unionByName(big.where(F.col(key).isNull()).select("*", *new))


def merged_if_large(small: DataFrame) -> DataFrame:
    """A written table with a merge hint where it has more than ``MAX_SENT`` rows.

    Parquet packs repeated and sequential values so well that a table of millions of rows may look
    small enough to broadcast, which takes many times its size in files of the driver's memory.
    """
    return small.hint("merge") if small.count() > MAX_SENT else small


def bucketed_rank(df: DataFrame, keys: list[str], order: Column, tie: Column, out: str, buckets: int = 256, size: str | None = None) -> DataFrame:
    """Exact 1-based rank inside ``keys`` by (order, tie), with no group in a single task.

    ``order`` is a uniform double in [0, 1). Each group is cut into ``buckets`` ranges of it; a rank
    is the rows in earlier ranges, from counts that combine before their shuffle, plus the place in
    its own range. A group of n rows thus meets tasks of about n / buckets rows. Null keys form a
    group like any other. ``tie`` should be unique for the rank to be repeatable. ``size`` names a
    column for the rows of the group.
    """
    b, before, at = "_bucket", "_before", "_order"
    cut = df.withColumn(at, order).withColumn(b, F.floor(F.col(at) * buckets).cast("int"))
    sizes = cut.groupBy(*keys, b).agg(F.count(F.lit(1)).alias("_n"))
    earlier = W.partitionBy(*keys).orderBy(b).rowsBetween(W.unboundedPreceding, -1)
    total = [F.sum("_n").over(W.partitionBy(*keys)).alias(size)] if size else []
    sizes = sizes.select(*keys, b, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias(before), *total)
    names = {k: f"_k{i}" for i, k in enumerate(keys)}
    right = sizes.select(*[F.col(k).alias(v) for k, v in names.items()], F.col(b).alias("_kb"), before, *([size] if size else []))
    same = F.col(b) == F.col("_kb")
    for k, v in names.items():
        same = same & F.col(k).eqNullSafe(F.col(v))
    place = W.partitionBy(*keys, b).orderBy(at, tie)
    ranked = cut.join(right, same).withColumn(out, F.row_number().over(place) + F.col(before))
    return ranked.drop(b, before, at, "_kb", *names.values())


def pair_join(left: DataFrame, right: DataFrame, key: str, spread: Column, hot: list, parts: int = 64) -> DataFrame:
    """Equi-join in which a key may own many rows on both sides.

    Rows of hot keys are dealt over ``parts`` tasks on the left, by ``spread`` (a column of the left
    rows), and repeated for each of them on the right, so that no task meets more than a share of a
    hot key's pairs. Other keys are joined as usual; null keys match nothing.
    """
    if not hot:
        return left.join(right, key)
    is_hot = F.col(key).isin(hot)
    part = F.pmod(F.xxhash64(spread), F.lit(parts)).cast("int")
    all_parts = F.sequence(F.lit(0), F.lit(parts - 1))
    a = left.withColumn("_part", F.when(is_hot, part).otherwise(0))
    b = right.withColumn("_part", F.explode(F.when(is_hot, all_parts).otherwise(F.array(F.lit(0)))))
    return a.join(b, [key, "_part"]).drop("_part")
