"""Deterministic splits, numbering, samples and fingerprints of datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frond.functions.keys import unit_hash
from frond.operators.skew import bucketed_rank


def stratified_split(df: DataFrame, cls: str, id_col: str, seed: int = 42, train: float = 0.8, val: float = 0.1) -> DataFrame:
    """WN-03: df with ``split``: per class in hash order int(n * train), then int(n * val), the rest test.

    Sizes equal those of a shuffle-and-cut; membership follows SHA-256, so any engine can repeat it.
    Ranks are exact and no class is one task. Shares that exceed 1 are refused (MTH-05).
    """
    if not (0 <= train and 0 <= val and train + val <= 1 + 1e-5):
        raise ValueError("shares must be at least 0 and add to 1 at most")
    j = bucketed_rank(df, [cls], unit_hash(seed, F.col(id_col)), F.col(id_col), "_rank", buckets=64, size="_size")
    a, b = F.floor(F.col("_size") * train), F.floor(F.col("_size") * val)
    split = F.when(F.col("_rank") <= a, "train").when(F.col("_rank") <= a + b, "val").otherwise("test")
    return j.withColumn("split", split).drop("_size", "_rank")


def seeded_sample(df: DataFrame, cls: str, id_col: str, k: int, seed: int = 42) -> DataFrame:
    """TOP-08: k rows of each class by hash order, with ``place``; smaller classes whole."""
    ranked = bucketed_rank(df, [cls], unit_hash(seed, F.col(id_col)), F.col(id_col), "place", buckets=64)
    return ranked.where(F.col("place") <= k)


def renumber(df: DataFrame, order: list[str], out: str, start: int = 1) -> DataFrame:
    """WN-02: consecutive numbers in ``order``, without pulling all rows into one task.

    Rows are range-partitioned and sorted; a partition's first number is what came before it.
    """
    from frond.operators.chunking import number_rows

    got = number_rows(df, F.lit("all"), order, [F.col(c) for c in df.columns if c not in order])
    return got.withColumn(out, F.col("_row") - 1 + start).drop("_key", "_row", "_chunk")


def _numbered_name(name: Column, k: Column) -> Column:
    text = k.cast("string")
    padded = F.when(F.length(text) < 3, F.lpad(text, 3, "0")).otherwise(text)
    return F.concat(F.regexp_replace(name, r"\.[^.]*$", ""), F.lit("_"), padded, F.regexp_extract(name, r"(\.[^.]*)$", 1))


def collision_names(df: DataFrame, name: str, order: list[str]) -> DataFrame:
    """PRJ-08: ``new_name``: the first user of a name keeps it, others get _NNN before the suffix.

    Numbers go up from 1 in ``order``, padded to at least three digits, and step over those that
    would give a name already in use, so no two rows have one new name. Rows without a name are left
    out. Numbers are found without a key gathering in one task: the rows and the names in use offer
    one number each, the taken ones go, and what is left is numbered again.
    """
    from frond.operators.chunking import number_rows
    from frond.storage import Scratch

    scratch = Scratch(df.sparkSession)
    got = scratch.write(number_rows(df, F.col(name), order, [F.col(c) for c in df.columns if c not in order], scratch=scratch).drop("_chunk"), "users")
    more = got.where("_row > 1")
    # names such as stem_NNN.suffix, by the name they would be given out for
    number = F.regexp_extract("_key", r"^(.*)_([0-9]{3}|[1-9][0-9]{3,17})(\.[^.]*)?$", 2).try_cast("bigint")
    used = got.where("_row = 1").select(number.alias("_k"), F.regexp_replace("_key", r"_[0-9]+(\.[^.]*)?$", "$1").alias("_name"))
    counts = more.groupBy(F.col("_key").alias("_name")).agg(F.count(F.lit(1)).alias("_n"))
    used = scratch.write(used.where("_k > 0").join(counts, "_name"), "used")
    later = number_rows(used, F.col("_name"), ["_k"], [F.col("_n")], scratch=scratch).select(F.col("_key").alias("_name"), (F.col("_n") + F.col("_row")).alias("_k"))
    some = used.select("_name").distinct()
    offered = more.select(F.col("_key").alias("_name"), (F.col("_row") - 1).alias("_k")).join(some, "_name", "left_semi").unionByName(later)
    free = offered.join(used.select("_name", "_k"), ["_name", "_k"], "left_anti")
    free = number_rows(free, F.col("_name"), ["_k"], [], scratch=scratch).select(F.col("_key").alias("_name"), (F.col("_row") + 1).alias("_at"), "_k")
    out = got.join(free, (F.col("_key") == F.col("_name")) & (F.col("_row") == F.col("_at")), "left")
    new = F.when(F.col("_row") == 1, F.col("_key")).otherwise(_numbered_name(F.col("_key"), F.coalesce("_k", F.col("_row") - 1)))
    return out.withColumn("new_name", new).select(*df.columns, "new_name")


def fingerprint_ordered(df: DataFrame, cols: list[str], chunk_rows: int = 100_000) -> DataFrame:
    """AGG-12: one row (sha256) over all rows in the order of ``cols``, in two levels.

    Rows are numbered, each chunk of ``chunk_rows`` is hashed by itself, and the chunk hashes in
    order are hashed once more. So the order matters, and no task holds more than a chunk. Up to
    one chunk the result is the SHA-256 of that chunk's SHA-256. An empty table hashes "".
    """
    from frond.operators.chunking import number_rows

    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
    rows = number_rows(df.select(*cols), F.lit("all"), cols, [], chunk_rows)
    line = F.struct("_row", text.alias("t"))
    parts = rows.groupBy("_chunk").agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(line)), lambda x: x["t"]), "\n"), 256).alias("h"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_chunk", "h"))), lambda x: x["h"]), "\n")
    return parts.agg(F.sha2(whole, 256).alias("sha256"))


def fingerprint_multiset(df: DataFrame, cols: list[str]) -> DataFrame:
    """An order-free fingerprint in one combining aggregate: rows, and sums of two hash halves."""
    h = F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in cols]), 256)
    part = lambda i: F.sum(F.conv(F.substring(h, i, 8), 16, 10).cast("bigint"))
    return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(part(1), F.lit(0)).alias("low"), F.coalesce(part(9), F.lit(0)).alias("high"))


def evenly_spaced(total: Column, n: Column) -> Column:
    """WN-08: n places from 0 to total - 1, truncated, each once; none if either is not positive."""
    step = F.when(n > 1, (total - 1) / (n - 1)).otherwise(F.lit(0.0))
    last = F.greatest(n.cast("int") - 1, F.lit(0))
    places = F.transform(F.sequence(F.lit(0), last), lambda i: F.floor(F.when(i == last, F.when(n > 1, total - 1).otherwise(0)).otherwise(i * step)).cast("int"))
    return F.when((total > 0) & (n > 0), F.array_distinct(places)).otherwise(F.array().cast("array<int>"))


def backfill(chosen: DataFrame, pool: DataFrame, id_col: str, k: int, order: list[Column]) -> DataFrame:
    """TOP-11: ``chosen``, filled up to k rows with the best of the pool it does not have yet."""
    have = chosen.agg(F.count(F.lit(1))).first()[0]
    spare = pool.join(chosen.select(id_col), id_col, "left_anti").orderBy(*order).limit(max(0, k - have))
    return chosen.unionByName(spare.select(*chosen.columns))
