"""Duplicates, pairing, statistics, splits, votes, lookup and selection on small hand-computed tables."""

import random

import pytest
from pyspark.sql import functions as F

from frond.operators import dedup as D
from frond.operators import pairing as P
from frond.operators import predictions as R
from frond.operators import select as S
from frond.operators import splits as Q
from frond.operators import stats as T
from frond.storage import Scratch


@pytest.fixture(scope="module")
def leaks(spark):
    rows = [("train", "A", "h1"), ("val", "B", "h1"), ("test", "C", "h1"), ("train", "D", "h2"), ("train", "E", "h2"), ("test", "F", "h3"), ("train", "G", None), (None, "H", "h3")]
    return spark.createDataFrame([(*r, "x") for r in rows], "split string, filename string, sha string, _n string")


def test_leakage(spark, leaks):
    assert [tuple(r) for r in D.leaking_keys(leaks, "sha").collect()] == [("h1", "test,train,val", 3)]
    assert sorted(r.n for r in D.pairwise_shared(leaks, "sha").collect()) == [1, 1, 1]
    got = {r.filename: r.kept for r in D.resolve_leakage(leaks, "sha", "filename").collect()}
    assert got == {"A": True, "B": False, "C": False}
    assert {tuple(r) for r in D.within_split(leaks, "sha", "filename").collect()} == {("E", "D")}
    by_text = D.duplicate_of(leaks.where("split is not null"), "sha", "filename", [F.col("split")])
    assert {tuple(r) for r in by_text.collect()} == {("A", "C"), ("B", "C"), ("E", "D")}
    assert tuple(D.duplicate_totals(leaks.where("split is not null"), "sha").first()) == (2, 3, 5)
    hot = D.duplicate_of(leaks.where("split is not null"), "sha", "filename", [F.col("split")], hot_rows=1)
    assert {tuple(r) for r in hot.collect()} == {("A", "C"), ("B", "C"), ("E", "D")}
    e = leaks.limit(0)
    assert D.leaking_keys(e, "sha").count() == 0 and D.resolve_leakage(e, "sha", "filename").count() == 0 and [r.n for r in D.pairwise_shared(e, "sha").collect()] == [0, 0, 0]


def test_near_components(spark):
    df = spark.createDataFrame([(1, 0), (2, 0x1F), (3, 0x3FF), (4, -(1 << 63)), (5, None), (6, 0)], "id bigint, h bigint")
    five = {r.id: (r.component, r.links) for r in D.near_components(df, "id", "h", 5).collect()}
    assert five == {1: (1, 2), 2: (1, 2), 3: (1, 1), 4: (1, 1), 6: (1, 2)}
    three = {r.id: r.component for r in D.near_components(df.where("id < 4"), "id", "h", 3).collect()}
    assert three == {1: 1, 2: 2, 3: 3}
    assert D.near_components(df.limit(0), "id", "h", 5).count() == 0


def test_components_of_a_long_chain(spark):
    n = 90
    e = spark.createDataFrame([(i, i + 1) for i in range(n)], "a bigint, b bigint")
    assert {r.root for r in D.min_label(e, Scratch(spark)).collect()} == {0}


@pytest.mark.parametrize("k", [0, 2, 5])
def test_hamming_pairs(spark, k):
    rng = random.Random(k)
    base = [rng.getrandbits(64) for _ in range(5)]
    vals = {b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(7))) & ((1 << 64) - 1) for b in base for _ in range(25)}
    sg = [v - (1 << 64) if v >> 63 else v for v in vals]
    got = {(r.a, r.b): r.distance for r in D.hamming_pairs(spark.createDataFrame([(v,) for v in sg], "fp bigint"), k).collect()}
    bits = lambda a, b: ((a ^ b) & ((1 << 64) - 1)).bit_count()
    assert got == {(a, b): bits(a, b) for a in sg for b in sg if a < b and bits(a, b) <= k}


@pytest.mark.parametrize("hot_rows", [5, 10**6])
def test_hamming_pairs_broadcast_no_exploded_side(spark, hot_rows):
    few = Scratch(spark).write(spark.range(50).select(F.col("id").alias("fp")), "few")
    near = D.hamming_pairs(few, 1, hot_rows)
    assert near.count() == sum((a ^ b).bit_count() == 1 for a in range(50) for b in range(a))
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_hamming_pairs_shuffle_their_rows_once(spark):
    near = D.hamming_pairs(Scratch(spark).write(spark.range(50).select(F.col("id").alias("fp")), "few"), 1)
    near.collect()
    assert "ReusedExchange" in near._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("hot_rows", [20, 60, 1000])
def test_hot_parts(spark, hot_rows):
    # 100 values share blocks 0 and 1, 50 of them block 2 as well; the other values share none
    masks = [0xFFFF << s for s in (0, 16, 32, 48)]
    vals = [0x10001 | (1 << 32 if i < 50 else i << 33) | i << 48 for i in range(100)] + [i * 0x0001_0001_0001_0001 for i in range(200, 300)]
    known = spark.createDataFrame([(v,) for v in vals], "fp bigint")
    want = [(m, sum(v & m == 0x1_0001_0001 & m for v in vals)) for m in (masks[0] | masks[1], masks[0] | masks[2], masks[1] | masks[2])]
    parts = [spark.range(1).select(F.xxhash64(F.lit(m).cast("bigint"), F.lit(0x1_0001_0001 & m).cast("bigint"))).first()[0] for m, n in want if n > hot_rows]
    assert sorted(D._hot_parts(known, masks, hot_rows)) == sorted(parts) and len(parts) == {20: 3, 60: 1, 1000: 0}[hot_rows]


def test_near_components_broadcast_no_class_for_each_fingerprint(spark):
    rows = Scratch(spark).write(spark.range(50).select("id", (F.col("id") * 1000003).alias("h")), "rows")
    got = D.near_components(rows, "id", "h", 1)
    assert got.count() == 50 and "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()


def test_leakage_report(spark):
    df = spark.createDataFrame([(1, "train", "a", 0), (2, "test", "a", 99), (3, "val", "b", 1), (4, "train", "c", 3), (5, "val", "d", 1 << 40), (6, None, "a", 0)], "id bigint, split string, d string, fp bigint")
    got = {r.id: (r.kind, r.kept) for r in D.leakage_report(df, "id", "d", "fp", "split", 5).collect()}
    assert got == {1: ("exact", True), 2: ("exact", False), 3: ("near", False), 4: ("near", True), 5: ("near", False)} or got == {1: ("exact", True), 2: ("exact", False), 3: ("near", False), 4: ("near", True), 5: ("near", False)}


def test_leakage_report_broadcasts_no_exploded_side(spark, monkeypatch):
    df = Scratch(spark).write(spark.range(60).select("id", F.when(F.col("id") % 2 == 0, "train").otherwise("test").alias("split"), F.col("id").cast("string").alias("d"), F.col("id").alias("fp")), "images")
    plans, write = {}, Scratch.write
    monkeypatch.setattr(Scratch, "write", lambda self, df, tag: plans.update({tag: df._jdf.queryExecution().executedPlan().toString()}) or write(self, df, tag))
    assert D.leakage_report(df, "id", "d", "fp", "split", 1).where("kind = 'near'").count() == 60
    assert "SortMergeJoin" in plans["pairs"] and "Broadcast" not in plans["pairs"]


def test_leakage_report_reads_its_images_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        seen.add(1)
        return x

    df = spark.range(60).select("id", F.when(F.col("id") % 2 == 0, "train").otherwise("test").alias("split"), counted((F.col("id") % 50).cast("string")).alias("d"), F.col("id").alias("fp"))
    assert D.leakage_report(df, "id", "d", "fp", "split", 1).count() > 0
    assert seen.value == 60


def test_large_firsts_are_not_broadcast(spark, monkeypatch):
    df = Scratch(spark).write(spark.range(60).select("id", (F.col("id") % 20).alias("k"), F.when(F.col("id") < 30, "train").otherwise("test").alias("split")), "rows")
    for f, n in ((lambda: D.first_wins(df, "k", "id", []), 60), (lambda: D.resolve_leakage(df, "k", "id"), 60)):
        for most, sent in ((100, True), (10, False)):
            monkeypatch.setattr("frond.operators.skew.MAX_SENT", most)
            assert f().count() == n and ("BroadcastHashJoin" in f()._jdf.queryExecution().executedPlan().toString()) == sent


def test_pairing(spark):
    i = spark.createDataFrame([("a",), ("b",), ("c",), ("a",), (None,)], "k string")
    x = spark.createDataFrame([("a",), ("b",), ("d",), (None,)], "k string")
    assert {tuple(r) for r in P.pair_status(i, x, "k").collect()} == {("a", "paired"), ("b", "paired"), ("c", "missing_label"), ("d", "orphan_label")}
    im = spark.createDataFrame([("a", 2, 3), ("b", 2, 3), ("c", 2, 3), ("d", 2, 3), ("e", None, 3)], "k string, w int, h int")
    mk = spark.createDataFrame([("a", 2, 3, 1.0), ("b", 3, 2, 1.0), ("c", 5, 5, 1.0), ("f", 1, 1, 1.0), ("e", 2, 3, 0.0)], "k string, w int, h int, coverage double")
    assert {tuple(r) for r in P.mask_status(im, mk, "k").collect()} == {("a", "ok"), ("b", "rotated"), ("c", "size_mismatch"), ("d", "missing_mask"), ("e", "size_mismatch"), ("f", "orphan_mask")}
    base = spark.createDataFrame([(0, "a"), (1, "b")], "class_id int, class_name string")
    new = spark.createDataFrame([(0, "b"), (1, "c"), (2, "a")], "class_id int, class_name string")
    assert {r.class_name: r.merged_id for r in P.align_classes(base, new).collect()} == {"a": 0, "b": 1, "c": 2}
    assert tuple(P.compatible(base, new).first()) == (2, False) and tuple(P.compatible(base, base).first()) == (2, True)
    b = spark.createDataFrame([(1, "x"), (2, "x"), (3, None)], "id bigint, d string")
    n = spark.createDataFrame([(4, "x"), (5, "y"), (6, "y"), (7, None), (8, None)], "id bigint, d string")
    assert {(r.id, r.dataset_source) for r in P.merge_versions(b, n, "d", "id", F.col("id")).collect()} == {(1, "baseline"), (2, "baseline"), (3, "baseline"), (5, "new"), (7, "new"), (8, "new")}


def test_quality(spark):
    img = spark.createDataFrame([(i < 2, i not in (2, 3), False, 1) for i in range(10)], "is_corrupted boolean, label_exists boolean, is_healthy boolean, polygon_count int")
    poly = spark.createDataFrame([("OK",)] * 5 + [("no_area",)] * 3, "reason string")
    q = T.quality_score(img, poly, spark.createDataFrame([(1,)], "n bigint"), spark.createDataFrame([(8.0,)], "ratio double")).first()
    assert (q.image, q.label, q.polygon, q.split, q.balance, q.structure, q.overall, q.ready) == (80, 90, 91, 85, 94, 100, 89.6, False)
    e = T.quality_score(img.limit(0), poly.limit(0), spark.createDataFrame([(0,)], "n bigint"), spark.createDataFrame([(1.0,)], "ratio double")).first()
    assert e.overall == 0 and e.image == 0 and not e.ready


def test_distributions(spark):
    df = spark.createDataFrame([("a", "train"), ("a", "val"), ("b", "test"), ("b", "test"), ("c", None)], "c string, split string")
    cls = spark.createDataFrame([("a",), ("b",), ("z",)], "c string")
    got = {(r.c, r.split): r.n for r in T.count_by_class(df, "c", "split", cls).collect()}
    assert len(got) == 9 and got["a", "train"] == 1 and got["b", "test"] == 2 and got["z", "val"] == 0
    assert {tuple(r) for r in T.class_by_split(df, "c", "split").collect()} == {("a", 1, 1, 0, 2), ("b", 0, 0, 2, 2)}
    n = spark.createDataFrame([("a", 8), ("b", 1), ("c", 0)], "c string, n bigint")
    assert {(r.c, r.ratio, r.below_quarter) for r in T.balance(n, "c").collect()} == {("a", 8.0, False), ("b", 8.0, True)}
    assert {r.c: r.problem for r in T.missing_in_train(df, "c", "split", 2).collect()} == {"a": "rare", "b": "absent"}
    cov = spark.createDataFrame([(x,) for x in (None, float("nan"), 0.0, 0.5, 1.0, 5.0, 50.0, 50.1)], "x double")
    assert [r[0] for r in cov.select(T.coverage_bucket(F.col("x"))).collect()] == [None, None, "empty", "<1", "1-5", "5-20", "20-50", ">50"]
    assert cov.where("x = 0").select(T.coverage_bucket(F.col("x"), True)).first()[0] == "<1"
    v = spark.createDataFrame([("g", 1, 1.0), ("g", 2, 5.0), ("g", 3, 9.0), ("g", 4, None), ("h", 9, 2.0)], "g string, id bigint, v double")
    assert {tuple(r) for r in T.nearest_to_median(v, "g", "id", "v").collect()} == {("g", 2), ("h", 9)}
    p = T.profile(v, ["g"], F.col("v")).where("g = 'g'").first()
    assert (p.n, p.low, p.high, p.mean, p.middle) == (3, 1, 9, 5, 5) and abs(p.deviation - (32 / 3) ** 0.5) < 1e-12
    assert tuple(T.contiguous(spark.range(4).toDF("x"), "x").first()) == (4, 0, 3, True) and not T.contiguous(spark.range(0).toDF("x"), "x").first().contiguous
    assert {r.c: r["values"] for r in T.distinct_lists(df, "c", "split").collect()} == {"a": "train,val", "b": "test"}


@pytest.mark.parametrize("n,want", [(17, (13, 1, 3)), (10, (8, 1, 1)), (3, (2, 0, 1)), (1, (0, 0, 1))])
def test_split_sizes(spark, n, want):
    got = Q.stratified_split(spark.range(n).select("id", F.lit("k").alias("c")), "c", "id").groupBy("split").count().collect()
    c = {r.split: r["count"] for r in got}
    assert tuple(c.get(s, 0) for s in ("train", "val", "test")) == want


def test_splits_samples_and_numbers(spark):
    df = spark.createDataFrame([(i, [None, "a", "b"][i % 3]) for i in range(30)], "id bigint, c string")
    assert Q.stratified_split(df, "c", "id").count() == 30 and Q.seeded_sample(df, "c", "id", 4).count() == 12
    with pytest.raises(ValueError):
        Q.stratified_split(df, "c", "id", train=0.9, val=0.2)
    assert [(r.id, r.no) for r in Q.renumber(df, ["id"], "no").orderBy("id").collect()] == [(i, i + 1) for i in range(30)]
    names = spark.createDataFrame([(1, "a.jpg"), (2, "a.jpg"), (3, "a.jpg"), (4, "b"), (5, "b")], "id bigint, name string")
    assert {r.id: r.new_name for r in Q.collision_names(names, "name", ["id"]).collect()} == {1: "a.jpg", 2: "a_001.jpg", 3: "a_002.jpg", 4: "b", 5: "b_001"}
    one = Q.fingerprint_ordered(df, ["id", "c"]).first()[0]
    assert one == Q.fingerprint_ordered(df.repartition(5), ["id", "c"]).first()[0] != Q.fingerprint_ordered(df.where("id > 0"), ["id", "c"]).first()[0]
    assert Q.fingerprint_ordered(df, ["id", "c"], 7).first()[0] != one
    assert Q.fingerprint_multiset(df, ["id"]).first() != Q.fingerprint_multiset(df.unionByName(df), ["id"]).first()
    sp = lambda t, n: spark.range(1).select(Q.evenly_spaced(F.lit(t), F.lit(n))).first()[0]
    assert sp(10, 4) == [0, 3, 6, 9] and sp(3, 5) == [0, 1, 2] and sp(0, 3) == [] and sp(5, 1) == [0]
    got = Q.backfill(df.where("id < 2"), df, "id", 5, [F.desc("id")])
    assert {r.id for r in got.collect()} == {0, 1, 29, 28, 27}


def test_votes(spark):
    df = spark.createDataFrame([("v", 0, [0.9, 0.1]), ("v", 1, [0.6, 0.4]), ("v", 2, [0.2, 0.8]), ("v", 3, [0.55, 0.45])], "g string, view int, p array<double>")
    kept = R.keep_views(df, "g", "view", "p")
    assert kept.count() == 4
    w = {r.class_id: r.weight for r in R.weighted_vote(kept, "g", "p").collect()}
    assert abs(w[0] - 0.57281) < 1e-5 and abs(w[1] - 0.42719) < 1e-5
    d = R.decide(kept, "g", "p").first()
    assert (d.final_class, d.used, d.agreement) == (0, 4, 0.75)
    s = {r.class_id: (r.votes, r.ratio, r.issue) for r in R.vote_shares(kept, "g", "p", healthy=[0]).collect()}
    assert s == {0: (3, 0.75, False), 1: (1, 0.25, True)}
    low = df.withColumn("p", F.array(F.lit(0.3), F.lit(0.3)))
    assert {r.view for r in R.keep_views(low, "g", "view", "p").collect()} == {0, 1, 2}
    x = spark.range(1).select(R.softmax(F.array(F.lit(1000.0), F.lit(1000.0))).alias("p")).first().p
    assert x == [0.5, 0.5]


def test_top_items(spark):
    df = spark.createDataFrame([("r", "tomato", .50, "vegetable", 0), ("r", "mint", .30, "herb", 1), ("r", "okra", .1234, "vegetable", 2), ("r", "unlisted", .0766, None, 3)], "g string, crop string, p double, cat string, o int")
    got = [(r.crop, r.confidence) for r in R.top_items(df, "g", "crop", F.col("p"), F.col("o")).orderBy("place").collect()]
    assert got == [("tomato", 50.0), ("mint", 30.0), ("okra", 12.34)]
    veg = R.top_items(df, "g", "crop", F.col("p"), F.col("o"), where=F.col("cat") == "vegetable").orderBy("place").collect()
    assert [(r.crop, r.confidence) for r in veg] == [("tomato", 50.0), ("okra", 12.34)]


def test_lookup(spark):
    e = spark.createDataFrame([("zucchini", "Powdery Mildew", 0), ("capsicum", "Bacterial Spot", 1), ("strawberry", "Anthracnose", 2), ("Dragon Fruit", "Anthracnose", 3)], "species string, disease string, ordinal int")
    n = spark.createDataFrame([(x,) for x in ["Squash___Powdery_Mildew", "BellPepper___Bacterial_Spot", "Strawberry___Anthracnose_Fruit_Rot", "DragonfruitLeaf___Anthracnose", "Tomato___Healthy", "x", None]], "class_name string")
    got = {r.class_name: (r.matched, r.step) for r in R.fallback_lookup(n, e).collect()}
    assert got["Squash___Powdery_Mildew"] == ("powdery_mildew", 1) and got["BellPepper___Bacterial_Spot"] == ("bacterial_spot", 1)
    assert got["Strawberry___Anthracnose_Fruit_Rot"] == ("anthracnose", 2) and got["DragonfruitLeaf___Anthracnose"] == (None, None) == got["Tomato___Healthy"] == got["x"] == got[None]


def test_selections(spark):
    rng = random.Random(6)
    rows = [(rng.choice("ab"), i, rng.getrandbits(20) if i % 9 else None, rng.random()) for i in range(120)]
    df = spark.createDataFrame(rows, "g string, id bigint, fp bigint, q double")
    fp = {i: f for _, i, f, _ in rows}
    got = S.greedy_distinct(df, "g", "id", "fp", "q", 10, 9).collect()
    for g in "ab":
        mine = [r.id for r in got if r.g == g and not r.filled]
        assert len([r for r in got if r.g == g]) == 10
        assert all(fp[x] is None or fp[y] is None or (fp[x] ^ fp[y]).bit_count() >= 9 for x in mine for y in mine if x != y)
    far = S.farthest_point(df, "g", "id", "fp", "q", 8).collect()
    assert len(far) == 16 and all(max((r for r in rows if r[0] == g), key=lambda r: (r[3], -r[1]))[1] == next(r.id for r in far if r.g == g and r.place == 1) for g in "ab")
    assert S.greedy_distinct(df.limit(0), "g", "id", "fp", "q", 3).count() == 0



def test_kmeans_in_each_group(spark):
    rng = random.Random(7)
    rows = [("a", i, rng.random(), rng.random()) for i in range(60)] + [("b", 100 + i, rng.random(), None) for i in range(4)] + [("c", 200 + i, 1.0, float(i)) for i in range(30)] + [(None, 300 + i, float(i % 9), 0.5) for i in range(20)]
    df = spark.createDataFrame(rows, "g string, id bigint, x double, q double")
    got = S.kmeans_by_group(df, "g", "id", ["x", "q"], "q", 5).collect()
    by = {g: sorted(r.id for r in got if r.g == g) for g in ("a", "b", "c", None)}
    assert {g: len(set(v)) for g, v in by.items()} == {"a": 5, "b": 4, "c": 5, None: 5} and len(got) == 19
    assert all((r[0], r[1]) in {(x[0], x[1]) for x in rows} for r in got)
    # all rows coincide: one cluster, the rest filled by quality
    same = S.kmeans_by_group(df.where("g = 'c'"), "g", "id", ["x"], "q", 5).collect()
    assert len(same) == 5 and {229, 228, 227, 226} <= {r.id for r in same} and sum(r.cluster is None for r in same) == 4
    assert S.kmeans_by_group(df, "g", "id", ["x"], "q", 1).count() == 4 and S.kmeans_by_group(df, "g", "id", ["x"], "q", 0).count() == 0


@pytest.mark.parametrize("k", [3, 12, 500])
def test_large_groups_are_selected_in_steps_with_the_same_result(spark, k):
    rng = random.Random(k)
    base = [rng.getrandbits(64) for _ in range(25)]
    rows = []
    for i in range(400):
        fp = rng.choice(base)
        for _ in range(rng.randrange(0, 9)):
            fp ^= 1 << rng.randrange(64)
        hist = [rng.random() for _ in range(6)]
        rows.append((rng.choice(["a", "a", "b", None]), i, None if rng.random() < 0.05 else fp - (1 << 64) if fp >> 63 else fp, rng.choice([None, 0.1, 0.5, rng.random()]), hist if rng.random() < 0.9 else None))
    df = spark.createDataFrame(rows, "g string, id int, fp bigint, q double, h array<double>")
    for h in (None, "h"):
        want = sorted(map(str, S.greedy_distinct(df, "g", "id", "fp", "q", k, histogram=h).collect()))
        assert sorted(map(str, S.greedy_distinct(df, "g", "id", "fp", "q", k, histogram=h, max_group=150, block=20).collect())) == want
    if k < 100:
        want = sorted(map(str, S.farthest_point(df, "g", "id", "fp", "q", k).collect()))
        assert sorted(map(str, S.farthest_point(df, "g", "id", "fp", "q", k, max_group=150).collect())) == want


def test_histograms_that_correlate_resemble_each_other(spark):
    df = spark.createDataFrame([("a", 1, 0, 0.9, [1.0, 2.0, 3.0]), ("a", 2, -1, 0.8, [2.0, 4.0, 6.5]), ("a", 3, 255 << 20, 0.7, [3.0, 1.0, 0.0]), ("a", 4, None, 0.1, None)], "g string, id int, fp bigint, q double, h array<double>")
    got = {r.id: (r.place, r.filled) for r in S.greedy_distinct(df, "g", "id", "fp", "q", 3, min_bits=5, histogram="h").collect()}
    assert got == {1: (1, False), 3: (2, False), 4: (3, False)}


def test_names_in_use_are_stepped_over(spark):
    rows = [(i, "x.jpg") for i in range(1005)] + [(2000, "a.jpg"), (2001, "a.jpg"), (2002, "a_001.jpg"), (2003, "a.jpg"), (2004, "a_001.jpg"), (2005, None), (2006, "n"), (2007, "n"), (2008, "x_0500.jpg"), (2009, "x_1000.jpg")]
    got = {r.id: r.new_name for r in Q.collision_names(spark.createDataFrame([(*r, "z") for r in rows], "id int, name string, k string"), "name", ["id"]).collect()}
    assert len(got) == len(set(got.values())) == len(rows) - 1
    assert got[1] == "x_001.jpg" and got[999] == "x_999.jpg" and got[1000] == "x_1001.jpg" and got[1004] == "x_1005.jpg"
    assert [got[i] for i in range(2000, 2005)] == ["a.jpg", "a_002.jpg", "a_001.jpg", "a_003.jpg", "a_001_001.jpg"] and got[2007] == "n_001"


def test_middles(spark):
    from pyspark.sql import functions as F

    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1, 1, 1, 2, 5, rng.randrange(50), None])) for _ in range(300)] + [("c", None), ("d", 4)]
    df = spark.createDataFrame(rows, "g string, v int")
    want = {r.g: r.m for r in df.where("v is not null").groupBy("g").agg(F.median("v").alias("m")).collect()}
    assert {r.g: r.middle for r in T.middles(df, ["g"], F.col("v")).collect()} == want
    assert T.middles(df.limit(0), ["g"], F.col("v")).count() == 0


def test_quality_counts_every_pair_of_splits_and_valid_polygons(spark, leaks):
    images = spark.createDataFrame([(False, True, False, 1)] * 4, "is_corrupted boolean, label_exists boolean, is_healthy boolean, polygon_count int")
    polys = spark.createDataFrame([(0, "OK")] * 8 + [(1, "OK")] + [(1, "no_area")] * 5 + [(2, "malformed")], "class_id int, reason string")
    got = T.quality_score(images, polys, D.pairwise_shared(leaks, "sha"), T.imbalance(polys, "class_id")).first()
    assert got.split == 100 - 45 and got.balance == 100 - (8 - 5) * 2 and got.polygon == 100 - 18 and not got.ready


def test_hubs_and_crowded_bands(spark):
    edges = spark.createDataFrame([(0, i) for i in range(1, 40)] + [(39, 40), (50, 51)], "a bigint, b bigint")
    got = {r.node: r.root for r in D.min_label(edges, Scratch(spark), hot_rows=5).collect()}
    assert got == {i: 0 for i in range(41)} | {50: 50, 51: 50}
    vals = sorted({sum(1 << b for b in random.Random(i).sample(range(64), i % 4)) for i in range(90)})
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in vals], "fp bigint")
    pairs = lambda h: {(r.a, r.b, r.distance) for r in D.hamming_pairs(df, 3, h).collect()}
    assert pairs(5) == pairs(10**6) and pairs(5)
