"""Splits that keep related records together: components by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frond.functions.keys import unit_hash
from frond.operators.skew import HOT_ROWS, hot_keys, lookup
from frond.storage import Scratch


def entity_stars(records: DataFrame, id_col: str, entities: list[Column], hot_rows: int, scratch: Scratch) -> DataFrame:
    """Edges (a, b), a > b: each record to the smallest record of each entity it shares.

    Entities are compared by the first 128 bits of their SHA-256, told apart by their position in
    the list. An entity of one record gives no edge. Entities are summed up by an aggregate that
    combines before its shuffle; one owning a third of all rows is joined back by broadcast.
    """
    marks = F.array(*[F.when(e.isNotNull(), F.substring(F.unhex(F.sha2(F.concat(F.lit(f"{i}:"), e), 256)), 1, 16)) for i, e in enumerate(entities)])
    links = records.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("a"), F.explode(marks).alias("e"))
    links = links.where(F.col("e").isNotNull())
    stats = links.groupBy("e").agg(F.min("a").alias("b"), F.max("a").alias("_top"), F.count(F.lit(1)).alias("n")).where("b < _top").drop("_top")
    stats = scratch.write(stats, "entities")
    hot = hot_keys(stats, "e", "n", hot_rows)
    edges = lookup(links, stats.select("e", "b"), "e", hot).where("a > b").select("a", "b")
    edges = scratch.write(edges.distinct(), "stars")
    scratch.drop(stats)
    return edges


def _hot(edges: DataFrame, side: str, hot_rows: int) -> list:
    return hot_keys(edges.groupBy(side).agg(F.count(F.lit(1)).alias("n")), side, "n", hot_rows)


def star_components(edges: DataFrame, hot_rows: int = HOT_ROWS, scratch: Scratch | None = None) -> DataFrame:
    """(node, root) for each non-root node of the graph of ``edges`` (a, b), a > b.

    Large-star: every larger neighbour of a node b moves to the smallest neighbour of b. Small-star:
    the smaller neighbours of a node a, and a, move to the smallest of them. They alternate until
    all that is left are stars. Minima are aggregates; hubs are looked up by broadcast, of fewer
    than 1024 keys. Each round is written, so no lineage grows. Rounds grow with the logarithm of
    the longest path.
    """
    scratch = scratch or Scratch(edges.sparkSession)
    while True:
        big = edges.limit(hot_rows + 1).count() > hot_rows
        hot_b, hot_a = (_hot(edges, "b", hot_rows), _hot(edges, "a", hot_rows)) if big else ([], [])
        least = edges.groupBy(F.col("a").alias("b")).agg(F.min("b").alias("m"))
        large = lookup(edges, least, "b", hot_b, "left").select("a", F.coalesce("m", "b").alias("b"))
        # the smallest neighbour of a after the large step
        small_m = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = lookup(large, small_m, "a", hot_a).where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        kept = small_m.select("a", F.col("m").alias("b"))
        after = scratch.write(kept.unionByName(moved).distinct(), "round")
        scratch.drop(edges)
        edges = after
        ends = edges.select("a", F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("b").alias("a"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        ends = ends.groupBy("a").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if ends.where("up > 1 or (up = 1 and down = 1)").isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def related_groups(records: DataFrame, id_col: str, entities: list[Column], hot_rows: int = HOT_ROWS) -> DataFrame:
    """(group_id, <id>) for each id related to at least one other by shared entities, transitively.

    group_id is the smallest id of the group and has a row too. Null ids and null entities relate
    nothing; repeated rows of an id change nothing. Empty input gives no rows.
    """
    scratch = Scratch(records.sparkSession)
    found = star_components(entity_stars(records, id_col, entities, hot_rows, scratch), hot_rows, scratch)
    roots = found.groupBy("root").agg(F.lit(1).alias("_")).select(F.col("root").alias("group_id"), F.col("root").alias(id_col))
    return found.select(F.col("root").alias("group_id"), F.col("node").alias(id_col)).unionByName(roots)


def grouped_splits(records: DataFrame, id_col: str, entities: list[Column], shares: dict[str, float], seed: int = 7, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(<id>, group_id, split) for every distinct non-null id.

    The group's hash, a uniform number, falls into one of the split's ranges, which are as wide as
    the shares (normalised to sum 1); so related records share a split and the answer for a group
    does not depend on other groups. An id related to none is its own group. Shares are met in
    expectation; one very large group cannot be divided.
    """
    groups = related_groups(records, id_col, entities, hot_rows)
    ids = records.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("bigint").alias(id_col)).agg(F.lit(1).alias("_")).drop("_")
    whole = ids.join(groups, id_col, "left").select(id_col, F.coalesce("group_id", id_col).alias("group_id"))
    total, upto, names = float(sum(shares.values())), 0.0, list(shares)
    u = unit_hash(seed, F.col("group_id"))
    pick = F.lit(names[-1])
    for name in reversed(names[:-1]):
        upto = sum(shares[n] for n in names[: names.index(name) + 1]) / total
        pick = F.when(u < upto, name).otherwise(pick)
    return whole.withColumn("split", pick)
