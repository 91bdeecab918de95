"""Compaction and exact offset chunking."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from frond import storage
from frond.functions import keys as K
from frond.operators import chunking as C
from frond.operators import compaction as P
from frond.operators import skew


def test_file_key(spark):
    want = {
        "file:///mnt/store/a/b%20c.txt": "a/b c.txt", " /mnt/store/./tmp/../d//e\\f\\x.txt ": "d/e/f/x.txt", "../../a/./b": "a/b", "a/../..": None, "": None, "  ": None, "./.": None,
        "A/b": "A/b", "/mnt/store/": None, "mnt/store/x": "mnt/store/x", "a/b/../../c": "c",
    }
    df = spark.createDataFrame([(k,) for k in want] + [(None,)], "p string")
    got = {r.p: r.k for r in df.select("p", K.file_key(F.col("p")).alias("k")).collect()}
    assert got == want | {None: None}


def test_keys(spark):
    row = lambda c: spark.range(1).select(c).first()[0]
    assert row(K.name_key(F.lit(" Leek___Ash--Mildew! "))) == "leek ash mildew" and row(K.name_key(F.lit("??"))) is None
    assert row(K.fingerprint(F.lit(" 0XFFFFFFFFFFFFFFFF "))) == -1 and row(K.fingerprint(F.lit("0000000000000000001f"))) == 31
    assert row(K.fingerprint(F.lit("xyz"))) is None and row(K.fingerprint(F.lit(""))) is None and row(K.fingerprint(F.lit("1" * 17))) is None
    assert row(K.plant_key(F.lit("Leek"), F.lit("pt-1 "))) == "leek|PT1" and row(K.plant_key(F.lit("Leek"), F.lit("n/a"))) is None
    assert row(K.split_name(F.lit(" Validation"))) == "val" and row(K.split_name(F.lit("x"))) is None


FILES = "file_id bigint, label_path string, content string, size_bytes bigint, modified_at timestamp_ntz, _file string, _keep bigint, b int"


def files(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], FILES)


def t(day):
    return datetime(2025, 1, day)


def test_current_files_and_compaction(spark):
    rows = [
        (1, "a.txt", "x", 1, t(1)), (2, "./a.txt", "y", 1, t(2)), (3, "/mnt/store/a.txt", "z", 1, t(2)), (4, "b.txt", "", 0, None), (5, "b.txt", None, 0, None),
        (6, None, "n", 1, t(1)), (7, None, "n", 1, t(1)), (8, " ", "m", 1, t(1)), (9, "A.txt", "q", 1, t(1)), (None, "a.txt", "?", 1, t(9)),
    ]
    df = files(spark, rows)
    assert sorted((r.file_id or 0) for r in P.current_label_files(df).collect()) == [0, 2, 4, 6, 7, 8, 9]
    at = storage.Scratch(spark).path("tree")
    m = P.compact_label_files(spark, df, at)
    assert m["rows"] == 7 and m["files"] == 1
    assert P.read_compacted(spark, at, df.schema).count() == 7
    with pytest.raises(FileExistsError):
        P.compact_label_files(spark, df, at)


def test_one_hot_file_and_file_sizes(spark):
    df = spark.range(60_000).select("id", F.sha2(F.col("id").cast("string"), 512).alias("v")).repartition(40)
    at = storage.Scratch(spark).path("big")
    m = P.compact(df, at, file_bytes=1 << 20)
    assert m["rows"] == 60_000 and 1 < m["files"] < 40
    assert P.multiset_checksum(spark.read.parquet(at)) == P.multiset_checksum(df)


def test_checksum_sees_position_and_repeats(spark):
    f = lambda rows: P.multiset_checksum(spark.createDataFrame(rows, "a string, b string"))
    assert f([(None, "x")]) != f([("x", None)]) and f([("a", "b")] * 2) != f([("a", "b")]) and f([("a", "b"), ("c", "d")]) == f([("c", "d"), ("a", "b")])
    assert f([]).rows == 0


def test_compaction_refuses_a_changed_input(spark, monkeypatch):
    at = storage.Scratch(spark).path("bad")
    real, calls = P.multiset_checksum, []

    def wrong(df):
        calls.append(1)
        c = real(df)
        return c if len(calls) > 1 else P.Checksum(c.rows + 1, c.low, c.high)

    monkeypatch.setattr(P, "multiset_checksum", wrong)
    with pytest.raises(RuntimeError):
        P.compact(spark.range(5).toDF("x"), at)
    assert not storage.exists(spark, at) and not storage.exists(spark, at + ".staging")


def test_empty_compaction(spark):
    at = storage.Scratch(spark).path("none")
    assert P.compact_label_files(spark, files(spark, []), at)["rows"] == 0


@pytest.mark.parametrize("chunk", [1, 7, 1000])
def test_numbering_and_runs(spark, chunk):
    rng = random.Random(chunk)
    rows = [(i, rng.choice(["hot"] * 6 + ["a", "b", None]), rng.choice([None, "v1", "v2"]), rng.choice([True, True, False, None])) for i in range(400)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, "x") for r in rows], "id bigint, k string, v string, f boolean, _n string").repartition(7)
    got = {r.key: tuple(r)[1:] for r in C.per_key_summary(df, F.col("k"), ["id"], F.col("v"), F.col("f"), chunk).collect()}
    want = {}
    for key in ("hot", "a", "b"):
        mine = sorted(r for r in rows if r[1] == key)
        best = run = 0
        for r in mine:
            run = run + 1 if r[3] else 0
            best = max(best, run)
        if mine:
            want[key] = (len(mine), mine[0][2], mine[-1][2], best)
    assert got == want
    numbered = C.number_rows(df, F.col("k"), ["id"], [], chunk).collect()
    by = {}
    for r in numbered:
        by.setdefault(r._key, []).append((r.id, r._row, r._chunk))
    assert all([(i, n, (n - 1) // chunk) for n, (i, _, _) in enumerate(sorted(x), 1)] == sorted(x) for x in by.values())
    assert {r.key: r.n_rows for r in C.key_counts(df, F.col("k"), ["id"], chunk).collect()} == {k: v[0] for k, v in want.items()}


def test_numbering_empty_and_one_per_id(spark):
    e = spark.createDataFrame([], "id bigint, k string, at int")
    assert C.key_counts(e, F.col("k"), ["id"]).count() == 0 and C.per_key_summary(e, F.col("k"), ["id"], F.col("k"), F.lit(True)).count() == 0
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, None, None), (None, "z", 1), (3, "c", 1), (3, "d", 1)], "id bigint, k string, at int")
    assert {tuple(r) for r in C.one_per_id(df, "id", {"k": F.col("k")}, "at").collect()} == {(1, "b"), (2, None), (3, "d")}


def test_bucketed_rank_and_hot_lookup(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["x", "x", "x", "y", None]), rng.random()) for i in range(300)]
    df = spark.createDataFrame([(*r, 5) for r in rows], "id bigint, k string, u double, n int")
    got = {r.id: r.rank for r in skew.bucketed_rank(df, ["k"], F.col("u"), F.col("id"), "rank", buckets=8).collect()}
    for key in ("x", "y", None):
        mine = sorted((u, i) for i, k, u in rows if k == key)
        assert [got[i] for _, i in mine] == list(range(1, len(mine) + 1))
    counts = df.where("k is not null").groupBy("k").agg(F.count("*").alias("c"))
    assert skew.hot_keys(counts, "k", "c", 100) == ["x"]
    small = counts.select("k", "c")
    for how, n in (("inner", sum(k is not None for _, k, _ in rows)), ("left", 300)):
        assert skew.lookup(df, small, "k", ["x"], how).count() == n == df.join(small, "k", how).count()
