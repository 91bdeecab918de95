"""Queries and SQL of the general operators for training data: compaction and hot keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from frond.functions import keys as K
from frond.operators import chunking, compaction
from frond.plans.tables import table
from frond.storage import Scratch

HOT_SHARE = 0.04


def p2_found(spark, d):
    """Label records that an up-to-date compacted label tree leaves out."""
    files = table(spark, d, "label_files")
    at = Scratch(spark).path("label_tree")
    compaction.compact_label_files(spark, files, at)
    kept = compaction.read_compacted(spark, at, files.schema)
    named = files.select("file_id").where(F.col("file_id").isNotNull())
    return named.join(kept.select("file_id"), "file_id", "left_anti")


def p2_compacted(spark, d):
    """Content of the compacted tree: each file once, empty ones included."""
    files = table(spark, d, "label_files")
    at = Scratch(spark).path("label_tree")
    compaction.compact_label_files(spark, files, at)
    kept = compaction.read_compacted(spark, at, files.schema)
    return kept.select("file_id", K.file_key(F.col("label_path")).alias("file"), F.coalesce(F.length("content"), F.lit(0)).cast("bigint").alias("chars"))


def _pairs(spark, d):
    cols = {"key": K.name_key(F.col("disease_name")), "digest": K.digest(F.col("sha256_hash")), "corrupted": F.col("is_corrupted")}
    return chunking.one_per_id(table(spark, d, "raw_pairs"), "pair_id", cols, "loaded_at")


def p3_found(spark, d):
    """Keys of disease_name that hold at least 4 % of the pair_ids with a key."""
    pairs = chunking.one_per_id(table(spark, d, "raw_pairs"), "pair_id", {"key": K.name_key(F.col("disease_name"))}, "loaded_at")
    counts = chunking.key_counts(pairs, F.col("key"), ["pair_id"])
    total = counts.agg(F.sum("n_rows").alias("total"))
    return counts.crossJoin(F.broadcast(total)).where(F.col("n_rows") >= HOT_SHARE * F.col("total")).select(F.col("key").alias("disease_key"))


def p3_summary(spark, d):
    """For each disease: pair_ids, first and last hash, longest run of corrupted files, by pair_id."""
    out = chunking.per_key_summary(_pairs(spark, d), F.col("key"), ["pair_id"], F.col("digest"), F.col("corrupted"))
    return out.select(F.col("key").alias("disease_key"), "n_rows", F.col("first_value").alias("first_hash"), F.col("last_value").alias("last_hash"), "longest_run")


QUERIES = {"p2_found": p2_found, "p2_compacted": p2_compacted, "p3_found": p3_found, "p3_summary": p3_summary}

KEY = "nullif(trim(regexp_replace(lower({c}), '[^a-z0-9]+', ' ', 'g')), '')"
DIGEST = "nullif(lower(trim(sha256_hash)), '')"

_FILE = r"""
segs as (
  select *, list_filter(string_split(regexp_replace(replace(replace(regexp_replace(regexp_replace(label_path, '^\s+|\s+$', '', 'g'),
    '^file://', ''), '%20', ' '), '\', '/'), '^/mnt/store/', ''), '/'), lambda s: s <> '' and s <> '.') as s from label_files
),
fold as (
  select *, list_reduce(list_prepend([]::varchar[], list_transform(s, lambda x: [x])),
    lambda a, x: case when x[1] = '..' then a[1:len(a) - 1] else list_concat(a, x) end) as f from segs
),
named as (select *, nullif(array_to_string(f, '/'), '') as file from fold),
ranked as (
  select *, row_number() over (partition by file order by modified_at desc nulls last, file_id) as r from named
)
"""

ORACLES = {
    "p2_found": f"with {_FILE} select file_id from ranked where file is not null and r > 1",
    "p2_compacted": f"with {_FILE} select file_id, file, coalesce(length(content), 0) as chars from ranked where file is null or r = 1",
    "p3_found": f"""
      with k as (select distinct pair_id, {KEY.format(c='disease_name')} as key from raw_pairs where pair_id is not null)
      select key as disease_key from k where key is not null group by key
      having count(*) >= 0.04 * (select count(*) from k where key is not null)""",
    "p3_summary": f"""
      with k as (
        select pair_id, {KEY.format(c='disease_name')} as key, {DIGEST} as h, coalesce(is_corrupted, false) as c,
               row_number() over (partition by pair_id order by loaded_at desc nulls last) as r
        from raw_pairs where pair_id is not null
      ),
      o as (select *, row_number() over (partition by key order by pair_id) as n from k where r = 1 and key is not null),
      g as (select key, c, n - row_number() over (partition by key, c order by n) as island from o),
      runs as (select key, max(m) as longest from (select key, island, count(*) as m from g where c group by key, island) group by key)
      select o.key as disease_key, count(*) as n_rows, arg_min_null(h, n) as first_hash, arg_max_null(h, n) as last_hash,
             coalesce(max(longest), 0) as longest_run
      from o left join runs using (key) group by o.key""",
}
