"""Pairing audits and the join shapes of the dataset checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frond.operators.skew import HOT_ROWS, hot_of, lookup


def pair_status(images: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """JN-01: (key, status): paired, missing_label or orphan_label, from a full outer join of keys.

    Keys are made unique on both sides first, by aggregates that combine before the shuffle. Null
    keys pair with nothing and are left out.
    """
    i = images.where(F.col(key).isNotNull()).groupBy(key).agg(F.lit(True).alias("i"))
    x = labels.where(F.col(key).isNotNull()).groupBy(key).agg(F.lit(True).alias("x"))
    status = F.when(F.col("i").isNull(), "orphan_label").when(F.col("x").isNull(), "missing_label").otherwise("paired")
    return i.join(x, key, "full_outer").select(key, status.alias("status"))


def mask_status(images: DataFrame, masks: DataFrame, key: str) -> DataFrame:
    """JN-02: (key, status) with sizes checked; both sides have key, w, h, the right one coverage.

    First match of: missing_mask, orphan_mask, size_mismatch, empty_mask (a warning), ok. A mask
    turned by 90 degrees is "rotated", as it can be repaired. Keys are taken to be unique.
    """
    j = images.select(key, F.col("w").alias("iw"), F.col("h").alias("ih"), F.lit(True).alias("i")).join(
        masks.select(key, F.col("w").alias("mw"), F.col("h").alias("mh"), "coverage", F.lit(True).alias("m")), key, "full_outer"
    )
    same = (F.col("iw") == F.col("mw")) & (F.col("ih") == F.col("mh"))
    turned = (F.col("iw") == F.col("mh")) & (F.col("ih") == F.col("mw"))
    status = (
        F.when(F.col("m").isNull(), "missing_mask").when(F.col("i").isNull(), "orphan_mask")
        .when(F.coalesce(turned & ~same, F.lit(False)), "rotated").when(~F.coalesce(same, F.lit(False)), "size_mismatch")
        .when(F.coalesce(F.col("coverage") <= 0, F.lit(False)), "empty_mask").otherwise("ok")
    )
    return j.select(key, status.alias("status"))


def first_match(left: DataFrame, right: DataFrame, key: str, order: Column, keep: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """JN-05: inner join in which each key of the right counts once, by its first row in ``order``.

    Keys of very many left rows are looked up by broadcast.
    """
    one = right.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(F.struct(*keep), order).alias("r"))
    got = lookup(left, one, key, hot_of(left, key, hot_rows))
    return got.select(*left.columns, *[F.col(f"r.{k}").alias(k) for k in keep])


def with_default(left: DataFrame, dim: DataFrame, key: str, value: str, default: Column) -> DataFrame:
    """JN-08: left lookup; what the dimension lacks becomes ``default``."""
    return left.join(dim.select(key, value), key, "left").withColumn(value, F.coalesce(F.col(value), default))


def align_classes(base: DataFrame, new: DataFrame) -> DataFrame:
    """JN-12: (class_name, base_id, new_id, merged_id) of two class lists (class_id, class_name).

    Baseline ids stay; classes only the new list has follow in the order of its ids. Class lists are
    the size of a label set, so the ordering by a single window is bounded by it.
    """
    from pyspark.sql import Window as W

    b = base.select("class_name", F.col("class_id").alias("base_id"))
    n = new.select("class_name", F.col("class_id").alias("new_id"))
    top = b.agg(F.coalesce(F.max("base_id"), F.lit(-1)).alias("top"))
    j = b.join(n, "class_name", "full_outer")
    fresh = F.row_number().over(W.partitionBy(F.col("base_id").isNull()).orderBy("new_id"))
    return j.crossJoin(F.broadcast(top)).select("class_name", "base_id", "new_id", F.coalesce("base_id", F.col("top") + fresh).cast("int").alias("merged_id"))


def compatible(old: DataFrame, new: DataFrame) -> DataFrame:
    """JN-16: one row (classes, compatible): every class of the old list has the same name in the new."""
    j = old.select("class_id", F.col("class_name").alias("a")).join(new.select("class_id", F.col("class_name").alias("b")), "class_id", "left")
    return j.agg(F.count(F.lit(1)).alias("classes"), F.coalesce(F.bool_and(F.col("a").eqNullSafe(F.col("b"))), F.lit(True)).alias("compatible"))


def merge_versions(base: DataFrame, new: DataFrame, digest: str, id_col: str, order: Column) -> DataFrame:
    """JN-13, SET-03: baseline rows whole, and new rows whose digest is not yet present.

    Copies inside the baseline stay; of new copies the first by ``order`` does. New rows without a
    digest cannot be compared and stay.
    """
    from frond.operators.dedup import first_wins

    named = new.where(F.col(digest).isNotNull()).join(base.select(digest).where(F.col(digest).isNotNull()).distinct(), digest, "left_anti")
    once = first_wins(named, digest, id_col, [order]).where(F.col("first_id") == F.col(id_col)).select(*new.columns)
    fresh = once.unionByName(new.where(F.col(digest).isNull()))
    return base.withColumn("dataset_source", F.lit("baseline")).unionByName(fresh.withColumn("dataset_source", F.lit("new")), allowMissingColumns=True)


def name_collisions(df: DataFrame, name: str, id_col: str) -> DataFrame:
    """Q16: (name, n) of output names used more than once; a merge reports them and overwrites nothing."""
    return df.where(F.col(name).isNotNull()).groupBy(name).agg(F.count(id_col).alias("n")).where("n > 1")
