"""Exact and near duplicates, leakage between splits, and their resolution.

"First of a group" is never a window over the group: the smallest order key is an aggregate, which
combines before its shuffle, and is looked up by rows, with a broadcast for keys that own very many
of them. A hash that a third of all images share is thus no task of its own.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frond.operators.skew import HOT_ROWS, MAX_HOT_KEYS, hot_keys, lookup, merged_if_large, pair_join
from frond.storage import Scratch

PRIORITY = {"train": 0, "val": 1, "test": 2}


def split_rank(split: Column) -> Column:
    """WN-01: train before val before test, anything else last."""
    out = F.lit(len(PRIORITY))
    for name, r in PRIORITY.items():
        out = F.when(split == name, F.lit(r)).otherwise(out)
    return out


def duplicate_groups(df: DataFrame, key: str) -> DataFrame:
    """AGG-06: (key, n, extra) of keys with two rows or more; null keys are no group."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").withColumn("extra", F.col("n") - 1)


def duplicate_totals(df: DataFrame, key: str) -> DataFrame:
    """V7: the three ways of counting duplicates, (groups, extra_rows, member_rows), in one row."""
    g = duplicate_groups(df, key)
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint"))
    return g.agg(F.count(F.lit(1)).alias("groups"), zero(F.sum("extra")).alias("extra_rows"), zero(F.sum("n")).alias("member_rows"))


def leaking_keys(df: DataFrame, key: str, split: str = "split") -> DataFrame:
    """AGG-07: (key, splits, n) of keys found in more than one split; null keys and splits are left out.

    Splits are few, so a set of them for each key is small.
    """
    ok = df.where(F.col(key).isNotNull() & F.col(split).isNotNull())
    per = ok.groupBy(key, split).agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(split)), ",").alias("splits"), F.sum("n").alias("n")).where(F.col("splits").contains(","))


def near_by_equal_fingerprint(df: DataFrame, fp: str, digest: str) -> DataFrame:
    """AGG-08: (fp, n, digests): rows of one fingerprint with at least two different digests."""
    ok = df.where(F.col(fp).isNotNull() & F.col(digest).isNotNull())
    per = ok.groupBy(fp, digest).agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy(fp).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("digests")).where("digests > 1")


def first_wins(df: DataFrame, key: str, id_col: str, order: list[Column], hot_rows: int = HOT_ROWS) -> DataFrame:
    """AGG-09, WN-07: df with ``first_id``: the id of the first row of the same key by (order, id).

    Rows with a null key are their own first. The order key is a parameter, since users of the rule
    differ on it.
    """
    first = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], F.col(id_col).alias("first_id"))).alias("f"), F.count(F.lit(1)).alias("_n"))
    first = Scratch(df.sparkSession).write(first.select(key, F.col("f.first_id").alias("first_id"), "_n").where("_n > 1"), "firsts")
    got = lookup(df, merged_if_large(first.drop("_n")), key, hot_keys(first, key, "_n", hot_rows), "left")
    return got.withColumn("first_id", F.coalesce("first_id", id_col))


def duplicate_of(df: DataFrame, key: str, id_col: str, order: list[Column], hot_rows: int = HOT_ROWS) -> DataFrame:
    """(id, duplicate_of) of every row that is not the first of its key."""
    got = first_wins(df, key, id_col, order, hot_rows)
    return got.where(F.col("first_id") != F.col(id_col)).select(id_col, F.col("first_id").alias("duplicate_of"))


def resolve_leakage(df: DataFrame, key: str, id_col: str, split: str = "split", hot_rows: int = HOT_ROWS) -> DataFrame:
    """AGG-07 with WN-01: (id, split, key, kept): members of leaking keys; the first by split stays.

    Once a key crosses splits its same-split copies go too. Nothing is deleted: losers are a column.
    """
    members = df.where(F.col(key).isNotNull() & F.col(split).isNotNull())
    first = F.min(F.struct(split_rank(F.col(split)).alias("o"), F.col(id_col).alias("first_id")))
    per = members.groupBy(key).agg(first.alias("f"), F.count(F.lit(1)).alias("_n"), (F.min(split) != F.max(split)).alias("leaks"))
    leaks = Scratch(df.sparkSession).write(per.where("leaks").select(key, F.col("f.first_id").alias("first_id"), "_n"), "leaks")
    got = lookup(members, merged_if_large(leaks.drop("_n")), key, hot_keys(leaks, key, "_n", hot_rows))
    return got.select(id_col, split, key, (F.col("first_id") == F.col(id_col)).alias("kept"))


def pairwise_shared(df: DataFrame, key: str, split: str = "split", splits: tuple[str, ...] = ("train", "val", "test")) -> DataFrame:
    """SET-01, SET-02: (split_a, split_b, n): different keys that both splits hold, pairs without any too.

    A key in all three splits counts in three pairs. One aggregate over keys, no join.
    """
    ok = df.where(F.col(key).isNotNull() & F.col(split).isin(*splits))
    has = ok.groupBy(key).agg(*[F.max((F.col(split) == s).cast("int")).alias(s) for s in splits])
    pairs = list(combinations(splits, 2))
    one = has.agg(*[F.coalesce(F.sum(F.col(a) * F.col(b)), F.lit(0)).cast("bigint").alias(f"{a}_{b}") for a, b in pairs])
    rows = F.array(*[F.struct(F.lit(a).alias("split_a"), F.lit(b).alias("split_b"), F.col(f"{a}_{b}").alias("n")) for a, b in pairs])
    return one.select(F.inline(rows))


def within_split(df: DataFrame, key: str, id_col: str, split: str = "split", hot_rows: int = HOT_ROWS) -> DataFrame:
    """In-split cleanup: (id, duplicate_of) inside each split; the smallest id stays."""
    both = df.where(F.col(key).isNotNull() & F.col(split).isNotNull()).withColumn("_k", F.concat_ws("|", F.col(split), F.col(key).cast("string")))
    return duplicate_of(both, "_k", id_col, [], hot_rows)


def hamming_pairs(fps: DataFrame, max_bits: int, hot_rows: int = HOT_ROWS) -> DataFrame:
    """JN-10: pairs (a, b), a < b as numbers, of distinct fingerprints within ``max_bits`` bits.

    By the pigeonhole principle: of max_bits + 2 blocks at least two are equal, so equality of some
    two blocks is a complete candidate test, of about 2 * 64 / (max_bits + 2) bits. A pair that
    several block pairs find is kept by the first. ``fps`` holds one column ``fp`` of distinct values.
    Parts that very many fingerprints share, as those of near-blank pictures, are dealt over tasks.
    A side has a row for every band and fingerprint, which the planner's size of an exploded table
    leaves out; the merge hint keeps it from being sent to the driver for a broadcast. Both sides of
    the plain join are the same rows, so that they are shuffled once.
    """
    blocks = min(64, max_bits + 2)
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    masks = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:])]
    known = fps.where("fp is not null")
    lits = F.array(*[_bits(x | y) for x, y in combinations(masks, 2)])
    cut = lambda n, mask: known.select(F.col("fp").alias(n), F.explode(lits).alias(mask))
    in_both = lambda n, mask: F.col(n).bitwiseAND(F.col(mask))
    hot = _hot_parts(known, masks, hot_rows)
    if hot:
        part = lambda n: cut(n, "mask").withColumn("part", F.xxhash64("mask", in_both(n, "mask")))
        near = pair_join(part("a"), part("b").drop("mask").hint("merge"), "part", F.col("a"), hot)
    else:
        near = cut("a", "mask").join(cut("b", "mask_b").hint("merge"), (in_both("a", "mask") == in_both("b", "mask_b")) & (F.col("mask") == F.col("mask_b")))
    x = F.col("a").bitwiseXOR(F.col("b"))
    near = near.where(F.col("a") < F.col("b")).where(F.bit_count(x) <= max_bits)
    first = F.get(F.filter(lits, lambda m: x.bitwiseAND(m) == 0), F.lit(0))
    return near.where(first == F.col("mask")).select("a", "b", F.bit_count(x).alias("distance"))


def _bits(mask: int) -> Column:
    return F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("bigint")


def _hot_parts(known: DataFrame, masks: list[int], hot_rows: int) -> list:
    """Hashes of the parts (two blocks) that very many fingerprints share; ``known`` has no nulls.

    Each block of such a part is shared by as many, so blocks are counted first: these have few
    values. Parts are counted only of fingerprints with two such blocks.
    """
    n = known.count()
    pairs = list(combinations(range(len(masks)), 2))
    least = max(hot_rows, n * len(pairs) / MAX_HOT_KEYS)
    if n <= least:
        return []
    one = known.select("fp", F.posexplode(F.array(*[_bits(m) for m in masks])).alias("block", "mask"))
    rows = one.groupBy("block", F.col("fp").bitwiseAND(F.col("mask")).alias("v")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > least)
    many: dict = {}
    for r in rows.select("block", "v").collect():  # fewer than blocks x n / least
        many.setdefault(r.block, []).append(r.v)
    has = lambda i: F.col("fp").bitwiseAND(_bits(masks[i])).isin(many[i])
    both = [F.when(has(i) & has(j), _bits(masks[i] | masks[j])) for i, j in pairs if i in many and j in many]
    if not both:
        return []
    parts = known.select("fp", F.explode(F.array(*both)).alias("mask")).where("mask is not null")
    counts = parts.groupBy(F.xxhash64("mask", F.col("fp").bitwiseAND(F.col("mask"))).alias("part")).agg(F.count(F.lit(1)).alias("n"))
    return hot_keys(counts, "part", "n", hot_rows, n * len(pairs))


def min_label(edges: DataFrame, scratch: Scratch, hot_rows: int = HOT_ROWS) -> DataFrame:
    """GRF-01: (node, root): smallest node of its component, for nodes of the edges (a, b).

    Every round takes the least label among neighbours and then the label of that label, which
    halves distances, so rounds grow with the logarithm of the longest path. Rounds are written.
    Minima are aggregates that combine before their shuffle; a hub's label, and a label that very
    many nodes have, are looked up by broadcast.
    """
    both = scratch.write(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "both")
    big = both.limit(hot_rows + 1).count() > hot_rows
    hot = lambda df, c: hot_keys(df.groupBy(c).agg(F.count(F.lit(1)).alias("n")), c, "n", hot_rows) if big else []
    hubs = hot(both, "b")
    labels = scratch.write(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "labels")
    while True:
        near = lookup(both, labels.select(F.col("node").alias("b"), "root"), "b", hubs).groupBy(F.col("a").alias("node")).agg(F.min("root").alias("seen"))
        step = scratch.write(labels.join(near, "node").select("node", F.least("root", "seen").alias("root"), F.col("root").alias("old")), "step")
        jump = step.select(F.col("node").alias("root"), F.col("root").alias("up"))
        after = scratch.write(lookup(step, jump, "root", hot(step, "root"), "left").select("node", F.coalesce("up", "root").alias("root"), "old"), "labels")
        done = after.where("root <> old").isEmpty()
        scratch.drop(labels)
        scratch.drop(step)
        labels = after
        if done:
            return labels.select("node", "root")


def near_components(df: DataFrame, id_col: str, fp: str, max_bits: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """GRF-01: (id, component, links) for every row with a fingerprint, with the columns ``keep``.

    component is the smallest id among rows joined, directly or through others, by fingerprints
    within ``max_bits`` (equal ones included); links is the number of different fingerprints within
    reach of the row's own. Copies are one node, so no pair of copies is formed. The written classes, a
    row for each fingerprint, are merged: as Parquet they may look small enough to broadcast.
    """
    scratch = Scratch(df.sparkSession)
    rows = df.where(F.col(fp).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col), F.col(fp).alias("fp"), *keep)
    reps = scratch.write(rows.groupBy("fp").agg(F.min(id_col).alias("rep"), F.count(F.lit(1)).alias("_n")), "reps")
    pairs = scratch.write(hamming_pairs(reps.select("fp"), max_bits).select("a", "b"), "pairs")
    roots = min_label(pairs, scratch).select(F.col("node").alias("fp"), "root")
    degree = pairs.select(F.col("a").alias("fp")).unionByName(pairs.select(F.col("b").alias("fp"))).groupBy("fp").agg(F.count(F.lit(1)).alias("links"))
    named = reps.join(roots, "fp", "left").join(degree, "fp", "left").select("fp", "rep", "_n", F.coalesce("root", "fp").alias("root"), F.coalesce("links", F.lit(0).cast("bigint")).alias("links"))
    least = named.groupBy("root").agg(F.min("rep").alias("component"))
    classes = scratch.write(named.join(least, "root").select("fp", "component", "links", "_n"), "classes")
    return lookup(rows, classes.drop("_n").hint("merge"), "fp", hot_keys(classes, "fp", "_n")).select(id_col, "component", "links", *keep)


def leakage_report(df: DataFrame, id_col: str, digest: str, fp: str, split: str, max_bits: int) -> DataFrame:
    """GRF-02: (id, split, kind, kept) of images in groups that cross splits: exact groups first.

    A near group counts only for images that no exact leak has named already. The first by split
    and id stays. Images without split take no part.
    """
    scratch = Scratch(df.sparkSession)
    ok = scratch.write(df.where(F.col(split).isNotNull()).select(id_col, digest, fp, split), "split")
    exact = scratch.write(resolve_leakage(ok, digest, id_col, split).select(id_col, split, "kept"), "exact")
    rest = scratch.write(ok.join(exact.select(id_col), id_col, "left_anti").select(id_col, fp, split), "rest")
    members = scratch.write(near_components(rest, id_col, fp, max_bits, (split,)).select(id_col, split, "component"), "members")
    near = resolve_leakage(members, "component", id_col, split)
    return exact.select(id_col, split, F.lit("exact").alias("kind"), "kept").unionByName(near.select(id_col, split, F.lit("near").alias("kind"), "kept"))
