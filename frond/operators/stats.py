"""Distributions, balance and scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SPLITS = ("train", "val", "test")
#: Weights of the quality score's parts.
WEIGHTS = {"structure": 0.15, "image": 0.20, "label": 0.25, "polygon": 0.20, "split": 0.10, "balance": 0.10}


def count_by_class(df: DataFrame, cls: str, split: str, classes: DataFrame, splits: tuple[str, ...] = SPLITS) -> DataFrame:
    """AGG-01: (class, split, n) for every class of ``classes`` and split, 0 where there is no row."""
    s = F.explode(F.array(*[F.lit(x) for x in splits])).alias(split)
    grid = classes.select(cls, s)
    n = df.groupBy(cls, split).agg(F.count(F.lit(1)).alias("n"))
    return grid.join(n, [cls, split], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))


def class_by_split(df: DataFrame, cls: str, split: str, splits: tuple[str, ...] = SPLITS) -> DataFrame:
    """AGG-02: (class, train, val, test, total); total counts the given splits."""
    ok = df.where(F.col(split).isin(*splits))
    p = ok.groupBy(cls).pivot(split, list(splits)).agg(F.count(F.lit(1)))
    cols = [F.coalesce(F.col(s), F.lit(0).cast("bigint")).alias(s) for s in splits]
    return p.select(cls, *cols, reduce(lambda a, b: a + b, [F.coalesce(F.col(s), F.lit(0).cast("bigint")) for s in splits]).alias("total"))


def middles(df: DataFrame, group: list[str], value: Column) -> DataFrame:
    """(group, middle): exact median of the non-null values of each group, by the ranks of its middle rows.

    Rows combine to counts of each value first; these are range-partitioned by value, and a value's
    ranks are the counts before its partition plus those before it there. So neither a large group
    nor a frequent value is one task, and no task holds a group's values.
    """
    from frond.storage import Scratch

    counts = df.where(value.isNotNull()).groupBy(*group, value.cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.repartitionByRange("_v").sortWithinPartitions("_v").withColumn("_part", F.spark_partition_id())
    counts = Scratch(df.sparkSession).write(counts, "counts")
    per = counts.groupBy(*group, "_part").agg(F.sum("_n").alias("_m"))
    before = F.coalesce(F.sum("_m").over(W.partitionBy(*group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    per = per.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_part").alias("_p"), before.alias("_before"), F.sum("_m").over(W.partitionBy(*group)).alias("_total"))
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group)], F.col("_part") == F.col("_p"))
    upto = F.col("_before") + F.sum("_n").over(W.partitionBy(*group, "_part").orderBy("_v").rowsBetween(W.unboundedPreceding, 0))
    at = counts.join(per, same).withColumn("_upto", upto)
    low, high = F.floor((F.col("_total") + 1) / 2), F.floor(F.col("_total") / 2) + 1
    holds = lambda p: F.when((p <= F.col("_upto")) & (p > F.col("_upto") - F.col("_n")), F.col("_v"))
    return at.groupBy(*group).agg(((F.max(holds(low)) + F.max(holds(high))) / 2).alias("middle"))


def profile(df: DataFrame, group: list[str], value: Column) -> DataFrame:
    """AGG-03: (group, n, low, high, mean, middle, deviation) of non-null values; zeros for an empty group.

    deviation is the population one, middle the median.
    """
    v = value
    z = lambda c: F.coalesce(c, F.lit(0.0))
    out = df.groupBy(*group).agg(
        F.count(v).alias("n"), z(F.min(v).cast("double")).alias("low"), z(F.max(v).cast("double")).alias("high"), z(F.avg(v)).alias("mean"), z(F.stddev_pop(v)).alias("deviation"),
    )
    m = middles(df, group, value).select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], "middle")
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group)])
    return out.join(m, same, "left").select(*group, "n", "low", "high", "mean", z(F.col("middle")).alias("middle"), "deviation")


def conditional_counts(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """AGG-04: one row with the number of rows of each condition; null is no match."""
    return df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in conditions.items()])


def distinct_lists(df: DataFrame, group: str, value: str) -> DataFrame:
    """AGG-05: (group, values): different values as sorted text; duplicates go before they are collected."""
    d = df.where(F.col(value).isNotNull()).select(group, value).distinct()
    return d.groupBy(group).agg(F.array_join(F.array_sort(F.collect_list(value)), ",").alias("values"))


def balance(counts: DataFrame, cls: str, n: str = "n") -> DataFrame:
    """AGG-10, WN-04: (class, n, ratio, share, below_quarter, below_tenth).

    Classes without rows are left out first; ratio is the largest over the smallest; the flags
    compare with the mean. Totals come from one aggregate row.
    """
    ok = counts.where(F.col(n) > 0)
    t = ok.agg(F.max(n).alias("hi"), F.min(n).alias("lo"), F.avg(n).alias("mean"), F.sum(n).alias("total"))
    j = ok.crossJoin(F.broadcast(t))  # one row
    return j.select(
        cls, n, F.round(F.col("hi") / F.col("lo"), 2).alias("ratio"), F.round(100.0 * F.col(n) / F.col("total"), 4).alias("share"),
        (F.col(n) < 0.25 * F.col("mean")).alias("below_quarter"), (F.col(n) < 0.1 * F.col("mean")).alias("below_tenth"),
    )


def class_health(n: Column) -> Column:
    """PRJ-07: GOOD from 100, WARNING from 30, else CRITICAL."""
    return F.when(n >= 100, "GOOD").when(n >= 30, "WARNING").otherwise("CRITICAL")


def class_rating(n: Column) -> Column:
    """PRJ-07: Excellent from 80, Good from 50, Fair from 20, else Poor."""
    return F.when(n >= 80, "Excellent").when(n >= 50, "Good").when(n >= 20, "Fair").otherwise("Poor")


def readiness(score: Column) -> Column:
    """PRJ-07: READY from 80, PARTIAL from 60, else NOT_READY."""
    return F.when(score >= 80, "READY").when(score >= 60, "PARTIAL").otherwise("NOT_READY")


def coverage_bucket(c: Column, empty_counts: bool = False) -> Column:
    """PRJ-06, V4: <1, 1-5, 5-20, 20-50, >50 percent; null and NaN have none.

    Whether an empty mask falls into <1 differs between users of the rule, so it is a parameter;
    where it does not, it is "empty".
    """
    out = F.when(c.isNull() | F.isnan(c), F.lit(None).cast("string"))
    if not empty_counts:
        out = out.when(c <= 0, "empty")
    return out.when(c < 1, "<1").when(c < 5, "1-5").when(c < 20, "5-20").when(c <= 50, "20-50").otherwise(">50")


def mask_flags(c: Column) -> dict[str, Column]:
    """PRJ-05: tiny below 0.2 %, huge above 98.5 %, abnormal above 90 or below 1."""
    return {"is_tiny": c < 0.2, "is_huge": c > 98.5, "is_abnormal": (c > 90) | (c < 1)}


def missing_in_train(df: DataFrame, cls: str, split: str, low: int = 10) -> DataFrame:
    """AGG-18: (class, train, held_out, problem): in val or test but absent from or rare in train."""
    g = df.where(F.col(cls).isNotNull()).groupBy(cls).agg(F.count_if(F.col(split) == "train").alias("train"), F.count_if(F.col(split).isin("val", "test")).alias("held_out"))
    bad = F.when(F.col("train") == 0, "absent").when(F.col("train") < low, "rare")
    return g.where("held_out > 0").withColumn("problem", bad).where("problem is not null")


def objects_per_image(polys: DataFrame, image: str, cls: str) -> DataFrame:
    """AGG-20: (class, images, single, multiple, crowded, simple): images by their number of objects."""
    per = polys.groupBy(cls, image).agg(F.count(F.lit(1)).alias("k"))
    return per.groupBy(cls).agg(
        F.count(F.lit(1)).alias("images"), F.count_if(F.col("k") == 1).alias("single"), F.count_if(F.col("k") > 1).alias("multiple"),
        F.count_if(F.col("k") > 5).alias("crowded"), F.count_if(F.col("k") <= 5).alias("simple"),
    )


def label_contents(polys: DataFrame, image: str, cls: str) -> DataFrame:
    """AGG-22: (image, boxes, classes): lines and different classes of each label file."""
    per = polys.groupBy(image, cls).agg(F.count(F.lit(1)).alias("k"))
    return per.groupBy(image).agg(F.sum("k").alias("boxes"), F.count(F.lit(1)).alias("classes"))


def repeated_in_group(df: DataFrame, group: str, value: str) -> DataFrame:
    """AGG-17: (group, repeated): rows beyond the first of each value inside a group."""
    per = df.groupBy(group, value).agg(F.count(F.lit(1)).alias("k"))
    return per.groupBy(group).agg(F.sum(F.col("k") - 1).alias("repeated")).where("repeated > 0")


def imbalance(polys: DataFrame, cls: str) -> DataFrame:
    """One row (ratio): valid polygons of the largest class over those of the smallest, two places; 1 without any.

    Classes without a valid polygon are left out.
    """
    n = polys.where("reason = 'OK'").groupBy(cls).agg(F.count(F.lit(1)).alias("n"))
    return n.agg(F.coalesce(F.round(F.max("n") / F.min("n"), 2), F.lit(1.0)).alias("ratio"))


def quality_score(images: DataFrame, polys: DataFrame, leaks: DataFrame, ratio: DataFrame) -> DataFrame:
    """AGG-11: six capped penalties and the weighted score, in one row.

    images: is_corrupted, label_exists, is_healthy, polygon_count. polys: reason. leaks: rows (n),
    added up, as ``pairwise_shared`` gives them. ratio: one row (ratio), see ``imbalance``. The
    structure part has no penalty. An empty set of images scores 0 in all.
    """
    i = images.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.coalesce("is_corrupted", F.lit(False))).alias("corrupt"), F.count_if(~F.coalesce("label_exists", F.lit(False))).alias("missing"),
        F.count_if(F.coalesce(F.col("is_healthy") & (F.col("polygon_count") > 0), F.lit(False))).alias("violations"),
    )
    p = polys.agg(F.count_if(F.col("reason") != "OK").alias("invalid"))
    one = i.crossJoin(p).crossJoin(leaks.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("leaks"))).crossJoin(ratio.select("ratio"))  # single rows
    cut = lambda most, x: F.lit(100.0) - F.least(F.lit(float(most)), x)
    one = (
        one.withColumn("structure", F.lit(100.0))
        .withColumn("image", cut(50, F.col("corrupt") * 10.0))
        .withColumn("label", F.lit(100.0) - F.least(F.lit(30.0), F.col("missing") * 5.0) - F.least(F.lit(50.0), F.col("violations") * 15.0))
        .withColumn("polygon", cut(40, F.col("invalid") * 3.0))
        .withColumn("split", cut(60, F.col("leaks") * 15.0))
        .withColumn("balance", F.when(F.col("ratio") > 5, cut(25, (F.col("ratio") - 5.0) * 2.0)).otherwise(100.0))
    )
    some = F.col("total") > 0
    parts = [F.when(some, F.col(k)).otherwise(0.0).alias(k) for k in WEIGHTS]
    score = F.round(reduce(lambda a, b: a + b, [F.col(k) * w for k, w in WEIGHTS.items()]), 1)
    blocked = (F.col("corrupt") > 0) | (F.col("leaks") > 0) | (F.col("invalid") > 0) | (F.col("violations") > 0)
    return one.select("total", *parts, F.when(some, score).otherwise(0.0).alias("overall"), (some & ~blocked & (score >= 80)).alias("ready"))


def nearest_to_median(df: DataFrame, group: str, id_col: str, value: str) -> DataFrame:
    """WN-05: (group, id): the row whose value is nearest to the group's median, the smallest id on a tie.

    The median is an aggregate joined back; the choice is one too. Null and NaN values take no part.
    """
    ok = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    m = middles(ok, [group], F.col(value)).withColumnRenamed("middle", "_m")
    gap = F.abs(F.col(value) - F.col("_m"))
    return ok.join(m, group).groupBy(group).agg(F.min(F.struct(gap.alias("g"), F.col(id_col).alias("id"))).alias("b")).select(group, F.col("b.id").alias(id_col))


def reconcile(checks: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """AGG-19: (name, left_n, right_n, holds): whether two tables have as many rows."""
    out = None
    for name, (a, b) in checks.items():
        one = a.agg(F.count(F.lit(1)).alias("left_n")).crossJoin(b.agg(F.count(F.lit(1)).alias("right_n")))
        one = one.select(F.lit(name).alias("name"), "left_n", "right_n", (F.col("left_n") == F.col("right_n")).alias("holds"))
        out = one if out is None else out.unionByName(one)
    return out


def contiguous(df: DataFrame, col: str) -> DataFrame:
    """SET-05, AGG-19: one row (n, least, most, contiguous) on whether ids run without a gap from 0."""
    d = df.where(F.col(col).isNotNull()).select(col).distinct()
    a = d.agg(F.count(F.lit(1)).alias("n"), F.min(col).alias("least"), F.max(col).alias("most"))
    return a.withColumn("contiguous", F.coalesce((F.col("least") == 0) & (F.col("most") == F.col("n") - 1), F.lit(False)))


def extremes(df: DataFrame, healthy: Column, value: str, id_col: str, k: int) -> DataFrame:
    """TOP-03: (side, id, value): the k largest of the healthy rows and the k smallest of the others.

    The smaller id on a tie; rows of unknown health are on neither side. Each side is one top-k, to
    which a partition sends k rows.
    """
    big = df.where(healthy).orderBy(F.desc(value), id_col).limit(k).select(F.lit("largest_healthy").alias("side"), id_col, value)
    return big.unionByName(df.where(~healthy).orderBy(value, id_col).limit(k).select(F.lit("smallest_disease").alias("side"), id_col, value))
