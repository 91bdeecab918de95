"""Ranked recommendations, votes over views and ordered fallback lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from frond.functions import text as T


def top_items(scores: DataFrame, group: str, item: str, prob: Column, ordinal: Column, k: int = 3, where: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """TOP-01, PRJ-03: (group, item, kept columns, confidence, place): the k best of each group.

    The optional filter comes first; confidence is the probability times 100, rounded to two places
    before ranking; ties follow ``ordinal``; what is kept is not renormalised. Spark turns the bound
    on the row number into a group limit before the shuffle, so a group sends k rows a partition.
    """
    s = scores if where is None else scores.where(where)
    s = s.select(group, F.col(item).alias("_item"), *keep, F.round(prob * 100, 2).alias("confidence"), ordinal.alias("_ord")).where("confidence is not null and not isnan(confidence)")
    w = W.partitionBy(group).orderBy(F.desc("confidence"), "_ord", "_item")
    return s.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k).select(group, F.col("_item").alias(item), *keep, "confidence", "place")


#: What a request may hold, and the other name of three of its fields.
RANGES = {"nitrogen": (0.0, 500.0), "phosphorus": (0.0, 300.0), "potassium": (0.0, 500.0), "temperature": (5.0, 50.0), "humidity": (0.0, 100.0), "ph": (3.5, 9.5)}
ALIASES = {"nitrogen": "N", "phosphorus": "P", "potassium": "K"}
CATEGORIES = ("vegetable", "fruit", "flower", "herb")


def checked_requests(df: DataFrame) -> DataFrame:
    """PRJ-04: df with ``reason``: the first thing wrong with a request, null if nothing is.

    A field may be given under either of its names (any that the table has); the long one counts
    first. In order of RANGES: "<field> missing" if both are null, "<field> out of range" beyond the
    inclusive limits or NaN; then "category unknown" for one outside CATEGORIES. A null category
    asks for none.
    """
    have = set(df.columns)
    reason = F.lit(None).cast("string")
    checks = []
    for name, (low, high) in RANGES.items():
        given = [F.col(c).cast("double") for c in (name, ALIASES.get(name)) if c in have]
        v = F.coalesce(*given) if given else F.lit(None).cast("double")
        checks += [(v.isNull(), f"{name} missing"), (F.isnan(v) | ~v.between(low, high), f"{name} out of range")]
    if "category" in have:
        checks.append((F.coalesce(~F.col("category").isin(*CATEGORIES), F.lit(False)), "category unknown"))
    for wrong, text in reversed(checks):
        reason = F.when(wrong, text).otherwise(reason)
    return df.withColumn("reason", reason)


def answer(class_name: Column, confidence: Column, issues: Column, unknown_below: float) -> Column:
    """SNK-13: STRUCT<status, diagnosis, warning> of a prediction.

    unknown if the confidence is below the least or nothing was predicted; healthy by the name, with
    a warning if ``issues`` names diseases; else diseased, the diagnosis being "Crop - Disease".
    """
    d = T.crop_and_disease(class_name)
    unknown = class_name.isNull() | F.coalesce(confidence < unknown_below, F.lit(True))
    healthy = F.coalesce(d["healthy"], F.lit(False))
    named = T.issue_list([d["crop"], d["disease"]], " - ")
    return F.struct(
        F.when(unknown, "unknown").when(healthy, "healthy").otherwise("diseased").alias("status"),
        F.when(unknown, "Unknown").when(healthy, "Healthy").otherwise(named).alias("diagnosis"),
        F.when(~unknown & healthy & (issues != ""), F.concat(F.lit("possible disease in part of the input: "), issues)).alias("warning"),
    )


def sharpest_in_time(frames: DataFrame, group: str, frame: str, sharpness: Column, n: int) -> DataFrame:
    """TOP-04: (group, frame, place): the n sharpest frames of each group, numbered in the order of time.

    A group of at most n frames is whole. Of equal sharpness the earlier frame counts; null is least.
    """
    w = W.partitionBy(group).orderBy(sharpness.desc_nulls_last(), frame)
    best = frames.select(group, frame, F.row_number().over(w).alias("_r")).where(F.col("_r") <= n)
    return best.select(group, frame, F.row_number().over(W.partitionBy(group).orderBy(frame)).alias("place"))


def frame_views(frames: DataFrame, group: str, frame: str, w: Column, h: Column, mode: str = "three") -> DataFrame:
    """JN-17, IMG-09: (group, frame, view, x, y, side_w, side_h): the views of each frame, by arithmetic.

    The whole picture if square or in mode "squash"; else the centre square, or in mode "three" the
    first, middle and last square along the longer side.
    """
    s = F.least(w, h)
    cut = lambda f: F.struct(F.floor(F.when(w > h, (w - s) * f).otherwise(0)).cast("int").alias("x"), F.floor(F.when(w > h, 0).otherwise((h - s) * f)).cast("int").alias("y"), s.alias("side_w"), s.alias("side_h"))
    whole = F.array(F.struct(F.lit(0).alias("x"), F.lit(0).alias("y"), w.alias("side_w"), h.alias("side_h")))
    parts = F.array(*[cut(f) for f in ((0.5,) if mode == "center" else (0.0, 0.5, 1.0))])
    boxes = whole if mode == "squash" else F.when(w == h, whole).otherwise(parts)
    return frames.select(group, frame, F.posexplode(boxes).alias("view", "b")).select(group, frame, "view", "b.*")


def best_views(views: DataFrame, group: list[str], view: str, p: str) -> DataFrame:
    """WN-06, JN-17: (group, view, top, conf): of each frame the view of greatest confidence, the lower one on a tie."""
    v = views.where(F.size(p) > 0).withColumn("conf", F.array_max(p)).withColumn("top", argmax(F.col(p)))
    return best_per_group(v, group, [-F.col("conf"), F.col(view)], [view, "top", "conf"])


def argmax(p: Column) -> Column:
    """MTH-07: place from 0 of the first greatest element."""
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")


def softmax(x: Column) -> Column:
    """MTH-07: exponentials over their sum, shifted by the maximum so that none overflows.

    Maximum and sum are computed once for each array, as fields of a struct.
    """
    top = F.transform(F.array(F.struct(x.alias("x"), F.array_max(x).alias("m"))), lambda s: F.transform(s["x"], lambda v: F.exp(v - s["m"])))
    summed = F.transform(top, lambda e: F.struct(e.alias("e"), F.aggregate(e, F.lit(0.0), lambda a, b: a + b).alias("t")))
    return F.get(F.transform(summed, lambda s: F.transform(s["e"], lambda v: v / s["t"])), F.lit(0))


def keep_views(views: DataFrame, group: str, view: str, p: str, least_conf: float = 0.5) -> DataFrame:
    """TOP-12: views with the greatest probability at ``least_conf`` or above; if fewer than
    min(V, max(3, ceil(V / 4))) pass, exactly that many of the most confident (the lower view on a tie)."""
    v = views.where(F.size(p) > 0).withColumn("conf", F.array_max(p)).withColumn("top", argmax(F.col(p)))
    whole = W.partitionBy(group)
    n = F.count(F.lit(1)).over(whole)
    good = F.count_if(F.col("conf") >= least_conf).over(whole)
    place = F.row_number().over(whole.orderBy(F.desc("conf"), view))
    least = F.least(n, F.greatest(F.lit(3), F.ceil(n * 0.25)))
    return v.select("*", n.alias("_n"), good.alias("_g"), place.alias("_p"), least.alias("_l")).where(
        F.when(F.col("_g") < F.col("_l"), F.col("_p") <= F.col("_l")).otherwise(F.col("conf") >= least_conf)
    ).drop("_n", "_g", "_p", "_l")


def weighted_vote(kept: DataFrame, group: str, p: str) -> DataFrame:
    """AGG-13: (group, class_id, weight): mean of probability vectors, weighted by their confidence."""
    x = kept.select(group, "conf", F.posexplode(p).alias("class_id", "prob"))
    return x.groupBy(group, "class_id").agg((F.sum(F.col("prob") * F.col("conf")) / F.sum("conf")).alias("weight"))


def decide(kept: DataFrame, group: str, p: str) -> DataFrame:
    """AGG-14: (group, final_class, used, agreement): best weighted class, the lower one on a tie."""
    w = weighted_vote(kept, group, p)
    best = w.groupBy(group).agg(F.min(F.struct((-F.col("weight")).alias("w"), "class_id")).alias("b")).select(group, F.col("b.class_id").alias("final_class"))
    j = kept.join(best, group)
    return j.groupBy(group, "final_class").agg(F.count(F.lit(1)).alias("used"), F.avg((F.col("top") == F.col("final_class")).cast("double")).alias("agreement"))


def vote_shares(kept: DataFrame, group: str, p: str, least_ratio: float = 0.25, healthy: list[int] | None = None) -> DataFrame:
    """AGG-14, AGG-15: (group, class_id, votes, ratio, mean_confidence, issue).

    An issue is a class that is not healthy and has at least ``least_ratio`` of the kept views.
    """
    per = kept.groupBy(group, F.col("top").alias("class_id")).agg(F.count(F.lit(1)).alias("votes"), F.avg(F.get(p, F.col("top"))).alias("mean_confidence"))
    ratio = F.col("votes") / F.sum("votes").over(W.partitionBy(group))
    sick = ~F.col("class_id").isin(healthy) if healthy else F.lit(True)
    return per.withColumn("ratio", ratio).select(group, "class_id", "votes", "ratio", "mean_confidence", ((F.col("ratio") >= least_ratio) & sick).alias("issue"))


def best_per_group(df: DataFrame, group: list[str], order: list[Column], keep: list[str]) -> DataFrame:
    """WN-01, WN-06: the first row of each group by ``order``, as a combining aggregate."""
    return df.groupBy(*group).agg(F.min(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], F.struct(*keep).alias("r"))).alias("b")).select(*group, *[F.col(f"b.r.{k}").alias(k) for k in keep])


#: Species under which a crop's entries are filed.
CROP_SPECIES = {
    "bellpepper": "capsicum", "bell_pepper": "capsicum", "dragonfruit": "dragon_fruit", "eggplant": "brinjal",
    "blueberryfruit": "blueberry", "blueberryleaf": "blueberry", "squash": "zucchini", "chili": "chilli",
}


def lookup_key(c: Column) -> Column:
    """STR-01: lower case, trimmed, runs of blanks, hyphens and underscores become one underscore."""
    return F.regexp_replace(F.lower(F.trim(c)), r"[\s\-_]+", "_")


def fallback_lookup(names: DataFrame, entries: DataFrame, name: str = "class_name") -> DataFrame:
    """JN-09: (class_name, matched, step) of the entry (species, disease, ordinal) for each class name.

    Steps, the first that matches wins: 1 exact; 2 with _fruit, _leaf and _rot taken out; 3 with the
    pattern below taken out, whose $ binds to its last part only; 4 containment either way, the
    first entry in order. Of entries with one key the last in order counts. Healthy names and names
    without a crop part match nothing. Each name has a row.
    """
    n = names.select(name).distinct()
    triple = F.col(name).contains("___")
    at = F.when(triple, F.instr(name, "___")).otherwise(F.instr(name, "_"))
    gap = F.when(triple, 3).otherwise(1)
    crop = lookup_key(F.substring(name, F.lit(1), at - 1))
    dis = lookup_key(F.substring(name, at + gap, F.length(name)))
    species = crop
    for k, v in CROP_SPECIES.items():
        species = F.when(crop == k, v).otherwise(species)
    ok = (at > 0) & ~F.lower(name).contains("healthy")
    q = n.where(ok).select(name, species.alias("species"), dis.alias("d1"))
    q = q.withColumn("d2", F.replace(F.replace(F.replace("d1", F.lit("_fruit"), F.lit("")), F.lit("_leaf"), F.lit("")), F.lit("_rot"), F.lit("")))
    q = q.withColumn("d3", F.regexp_replace("d1", r"_fruit_rot|_leaf_spot|_leaf|_fruit|_rot|_blight$", ""))
    e = entries.select(lookup_key(F.col("species")).alias("species"), lookup_key(F.col("disease")).alias("disease"), "ordinal")
    e = e.groupBy("species", "disease").agg(F.min("ordinal").alias("first"), F.max("ordinal").alias("ordinal"))
    j = q.join(e, "species")
    x = F.col("disease")
    step = F.when(x == F.col("d1"), 1).when(x == F.col("d2"), 2).when(x == F.col("d3"), 3).when(F.col("d1").contains(x) | x.contains(F.col("d1")), 4)
    best = j.withColumn("step", step).where("step is not null").groupBy(name).agg(F.min(F.struct("step", "first", "ordinal", "disease")).alias("b"))
    return n.join(best, name, "left").select(name, F.col("b.disease").alias("matched"), F.col("b.step").alias("step"))
