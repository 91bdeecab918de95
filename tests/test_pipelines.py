"""Pipelines and request checks on small hand-computed tables, empty ones included."""

from pyspark.sql import functions as F

from frond.functions import labels as L
from frond.functions import text as X
from frond.operators import pairing, stats
from frond.operators import predictions as R
from frond.plans import pipelines as P
from frond.sources import readers, sinks
from frond.storage import Scratch

IMAGES = "image_id bigint, split string, crop string, digest string, fp bigint, file string, filename string, w int, h int, quality double, corrupted boolean, extra string"


def images(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], IMAGES)


ROWS = [
    (1, "train", "fig", "h1", 0, "a", "a.jpg", 10, 20, 0.9, False), (2, "val", "fig", "h1", 0, "b", "b.jpg", 10, 20, 0.8, False), (3, "test", "fig", "h3", 1, "c", "a.jpg", 10, 20, 0.1, False),
    (4, "train", "fig", None, 3, "d", "d.jpg", 10, 20, None, None), (5, "train", "plum", "h5", None, "e", None, 10, 20, 0.7, True), (6, None, "fig", "h6", (1 << 50) - 1, None, "f.jpg", 10, 20, 0.6, False),
]


def test_subset_merge_cleanup_curation(spark):
    i = images(spark, ROWS)
    masks = spark.createDataFrame([("a",), ("b",), ("d",), (None,)], "file string")
    got = {r.image_id: r.outcome for r in P.subset(i, masks, ["fig"]).collect()}
    assert got == {1: "kept", 2: "exact_leak", 3: "near_leak", 4: "kept"}
    merged = {r.image_id: (r.dataset_source, r.new_name) for r in P.merged(i.where("image_id <= 2"), i.where("image_id > 2")).collect()}
    assert merged[1] == ("baseline", "a.jpg") and merged[3] == ("new", "a_001.jpg") and merged[5] == ("new", None) and len(merged) == 6
    m = spark.createDataFrame([("a", 20, 10, 5.0), ("b", 10, 20, 5.0), ("d", 30, 30, 5.0)], "file string, w int, h int, coverage double")
    assert {r.image_id: r.action for r in P.cleanup(i, m).collect()} == {1: "rotate_mask", 2: "remove_leak", 3: "none", 4: "resize_mask", 5: "none", 6: "none"}
    c = {r.image_id: r.outcome for r in P.curated(i, 0.5).collect()}
    assert c == {1: "kept", 2: "exact_duplicate", 3: "near_duplicate", 4: "near_duplicate", 5: "corrupted", 6: "kept"}
    assert {(r.crop, r.image_id) for r in P.curated_selection(i, 0.5, 5).collect()} == {("fig", 1), ("fig", 6)}


def test_audit_score_of_the_worked_example(spark):
    a = spark.createDataFrame([(j < 2, j > 1, False, 0) for j in range(6)], "is_corrupted boolean, label_exists boolean, is_healthy boolean, polygon_count int")
    polys = spark.createDataFrame([(0, "OK")] * 8 + [(1, "OK")] + [(1, "no_area")] * 3, "class_id int, reason string")
    leak = spark.createDataFrame([("train", "val", 1), ("train", "test", 0), ("val", "test", 0)], "split_a string, split_b string, n bigint")
    got = stats.quality_score(a, polys, leak, stats.imbalance(polys, "class_id")).first()
    assert (got.image, got.label, got.polygon, got.split, got.balance, got.structure, got.overall, got.ready) == (80, 90, 91, 85, 94, 100, 89.6, False)
    files = spark.createDataFrame([(1, "0 .1 .1 .5 .1 .5 .5\n0 .1 .1 .5 .1 .5 .5"), (2, ""), (3, None)], "file_id bigint, content string")
    one = P.audit_gate(images(spark, ROWS), a, files).first()
    assert one.blocking == "corrupted,leaks,polygons" and not one.ready
    e = P.audit_gate(images(spark, []), a.limit(0), files.limit(0)).first()
    assert e.total == 0 and e.overall == 0 and e.blocking == "" and not e.ready


def test_classes_and_labels(spark):
    b = spark.createDataFrame([(0, "a"), (1, "b")], "class_id int, class_name string")
    n = spark.createDataFrame([(0, "b"), (1, "c"), (2, "a")], "class_id int, class_name string")
    j = pairing.align_classes(b, n)
    assert {r.class_name: r.merged_id for r in j.collect()} == {"a": 0, "b": 1, "c": 2}
    remap = j.where("new_id is not null").select(F.col("new_id").alias("class_id"), F.col("merged_id").alias("new_id"))
    lines = spark.createDataFrame([(0,), (1,), (2,), (9,)], "class_id int")
    assert {(r.class_id, r.new_id) for r in P.merged_labels(lines, remap).collect()} == {(0, 1), (1, 2), (2, 0), (9, None)}
    classes = P.healthy_classes(spark.createDataFrame([(0, "Leek Healthy"), (1, "spot"), (14, None), (2, None)], "class_id int, class_name string"), 14)
    assert {r.class_id: r.healthy for r in classes.collect()} == {0: True, 1: False, 14: True, 2: False}
    files = spark.createDataFrame([(1, "0 .1 .2\n2 .3 .4\n1 .5 .6"), (2, "0 .1 .1"), (3, ""), (4, None)], "file_id bigint, content string")
    got = {r.file_id: (r.kind, r.lines, r.content) for r in P.healthy_to_background(files, classes).collect()}
    assert got == {1: ("disease", 2, "1 .3 .4\n0 .5 .6"), 2: ("healthy", 0, ""), 3: ("unknown", 0, ""), 4: ("unknown", 0, "")}
    re = {(r["item"], r.id): r.n for r in P.rebuilt_classes(files, images(spark, ROWS), spark.createDataFrame([(0, 5)], "class_id int, new_id int")).collect()}
    assert re == {("class", 5): 2, ("dropped", 2): 1, ("dropped", 1): 1, ("leak", None): 1}
    # one image id in two documents; too few numbers, nothing, and a corner outside
    coco = spark.createDataFrame([
        ("train", [(1, "a.jpg", 10, 10), (2, "b.jpg", 10, 10)], [(7, 1, 3, 1.0, [[-5.0, 0.0, 5.0, 5.0, 0.0, 5.0], [1.0, 1.0, 2.0, 2.0]]), (8, 2, 3, 1.0, [])]),
        ("test", [(1, "c.jpg", 10, 20)], [(9, 1, 4, 1.0, [[1.0, 2.0, 3.0, 4.0, 5.0, 6.0]])]),
    ], "split string, images array<struct<id: bigint, file_name: string, width: int, height: int>>, annotations array<struct<id: bigint, image_id: bigint, category_id: int, area: double, segmentation: array<array<double>>>>")
    ids = spark.createDataFrame([(3, 0)], "category_id int, class_id int")
    text = {(r.split, r.file_name): r.content for r in P.coco_to_labels(coco, ids).collect()}
    assert text == {("train", "a.jpg"): "0 0.000000 0.000000 0.500000 0.500000 0.000000 0.500000", ("train", "b.jpg"): "", ("test", "c.jpg"): ""}


def test_requests_and_recommendations(spark):
    rows = [(1, 20.0, None, 30.0, 40.0, 20.0, 50.0, 6.5, "Vegetable".lower()), (2, None, 500.0, 30.0, 40.0, 20.0, 50.0, 6.5, None), (3, None, None, 30.0, 40.0, 20.0, 50.0, 6.5, None), (4, 20.0, None, 300.1, 40.0, 20.0, 50.0, 6.5, None), (5, 20.0, None, 30.0, 40.0, 20.0, 50.0, float("nan"), None), (6, 20.0, None, 30.0, 40.0, 20.0, 50.0, 6.5, "tree")]
    df = spark.createDataFrame(rows, "request_id int, nitrogen double, N double, phosphorus double, potassium double, temperature double, humidity double, ph double, category string")
    assert {r.request_id: r.reason for r in R.checked_requests(df).collect()} == {1: None, 2: None, 3: "nitrogen missing", 4: "phosphorus out of range", 5: "ph out of range", 6: "category unknown"}
    scores = spark.createDataFrame([(q, c, p, o) for q in (1, 2, 6) for o, (c, p) in enumerate([("tomato", 0.5), ("mint", 0.3), ("okra", 0.1234), ("unlisted", 0.0766)])], "request_id int, crop string, prob double, ordinal int")
    crops = spark.createDataFrame([("tomato", "vegetable"), ("mint", "herb"), ("okra", "vegetable")], "crop string, category string")
    got = {}
    for r in P.recommendations(df, scores, crops).collect():
        got.setdefault(r.request_id, []).append((r.reason, r.crop, r.category, r.confidence, r.place))
    assert sorted(got[1], key=lambda x: x[4]) == [(None, "tomato", "vegetable", 50.0, 1), (None, "okra", "vegetable", 12.34, 2)]
    assert [x[1] for x in sorted(got[2], key=lambda x: x[4])] == ["tomato", "mint", "okra"] and got[6] == [("category unknown", None, None, None, None)] and len(got) == 6
    assert P.recommendations(df.limit(0), scores, crops).count() == 0


def test_diagnosis_of_views(spark):
    v = spark.createDataFrame([("m", 0, [0.9, 0.1]), ("m", 1, [0.6, 0.4]), ("m", 2, [0.2, 0.8]), ("m", 3, [0.55, 0.45]), ("h", 0, [0.1, 0.9]), ("e", 0, [])], "g string, view int, p array<double>")
    names = spark.createDataFrame([(0, "Squash___Powdery_Mildew"), (1, "Fig___Healthy")], "class_id int, class_name string")
    entries = spark.createDataFrame([("zucchini", "Powdery Mildew", 1)], "species string, disease string, ordinal int")
    got = {r.g: r for r in P.diagnoses(v, "g", names, entries).collect()}
    m, h = got["m"], got["h"]
    assert set(got) == {"m", "h"} and (m.final_class, m.confidence, m.agreement, m.status, m.diagnosis, m.matched) == (0, 0.5728, 0.75, "diseased", "Squash - Powdery Mildew", "powdery_mildew")
    assert (h.status, h.diagnosis, h.warning) == ("healthy", "Healthy", None)
    assert P.diagnoses(v, "g", names, entries, unknown_below=0.6).where("g = 'm'").first().status == "unknown"
    warned = v.limit(0).sparkSession.createDataFrame([("w", j, [0.0, 1.0] if j else [0.8, 0.2]) for j in range(4)], "g string, view int, p array<double>")
    assert P.diagnoses(warned, "g", names, entries).first().warning.endswith("Squash___Powdery_Mildew")
    assert P.diagnoses(v.limit(0), "g", names, entries).count() == 0


def test_frames_and_prefixes(spark):
    f = spark.createDataFrame([("a", 1, 0.1), ("a", 2, 0.9), ("a", 3, None), ("a", 4, 0.5), ("b", 1, None)], "g string, frame int, s double")
    assert {(r.g, r.frame, r.place) for r in R.sharpest_in_time(f, "g", "frame", F.col("s"), 2).collect()} == {("a", 2, 1), ("a", 4, 2), ("b", 1, 1)}
    s = spark.createDataFrame([("a", 1, 30, 10), ("a", 2, 10, 30), ("a", 3, 9, 9)], "g string, frame int, w int, h int")
    views = lambda mode: sorted((r.frame, r.view, r.x, r.y, r.side_w, r.side_h) for r in R.frame_views(s, "g", "frame", F.col("w"), F.col("h"), mode).collect())
    assert views("three") == [(1, 0, 0, 0, 10, 10), (1, 1, 10, 0, 10, 10), (1, 2, 20, 0, 10, 10), (2, 0, 0, 0, 10, 10), (2, 1, 0, 10, 10, 10), (2, 2, 0, 20, 10, 10), (3, 0, 0, 0, 9, 9)]
    assert views("center")[0] == (1, 0, 10, 0, 10, 10) and views("squash")[0] == (1, 0, 0, 0, 30, 10)
    v = spark.createDataFrame([("a", 1, 0, [0.4, 0.6]), ("a", 1, 1, [0.6, 0.4]), ("a", 2, 2, [1.0])], "g string, frame int, view int, p array<double>")
    assert {(r.frame, r.view, r.top) for r in R.best_views(v, ["g", "frame"], "view", "p").collect()} == {(1, 0, 1), (2, 2, 0)}
    n = spark.createDataFrame([("Leek_1.jpg",), ("oak_2.jpg",), ("plain",), (None,)], "n string")
    assert [r[0] for r in n.select(X.allowed_prefix(F.col("n"), ["leek"])).collect()] == [None, "oak", "plain", None]


def test_runs_take_up_what_is_left(spark):
    i = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3"), ("a", "1"), (None, "4")], "rel_path string, sha256 string")
    m = spark.createDataFrame([("a", 50.0), ("b", 0.1)], "rel_path string, coverage double")
    state = sinks.ResumeState(spark, Scratch(spark).path("state"))
    run = lambda b: {r.rel_path: r.status for r in P.segmentation_queue(i, m, state, b).collect()}
    assert run("1") == {"a": "COMPLETED", "b": "REVIEW", "c": "FAILED"} and run("2") == {"b": "REVIEW", "c": "FAILED"}


def test_reports_and_empty_tables(spark):
    e = images(spark, [])
    files = spark.createDataFrame([], "file_id bigint, file string, content string")
    assert P.subset(e, files, ["fig"]).count() == 0 and P.curated(e, 0.5).count() == 0 and P.cleanup(e, files.select("file", F.lit(1).alias("w"), F.lit(1).alias("h"), F.lit(1.0).alias("coverage"))).count() == 0
    assert P.statistics_report(e, "crop").count() == 0 and P.validation(e.withColumn("stem", F.lit("")), files).count() == 0 and P.merged(e, e).count() == 0
    pairs = spark.createDataFrame([("a", False, 10), ("a", True, None), (None, False, 5)], "k string, is_corrupted boolean, file_size bigint")
    assert [tuple(r) for r in P.scorecards(pairs, "k").collect()] == [("a", 2, 1, 1, 10.0, "CRITICAL", "Poor", "NOT_READY")]
    got = {(r.check, r.problem): r.n for r in P.validation(images(spark, ROWS).withColumn("stem", F.col("filename")), spark.createDataFrame([(1, "a", "0 .1 .1 .1 .1 .5 .5"), (2, "zz", "0 1"), (3, None, "")], "file_id bigint, file string, content string")).collect()}
    assert got[("pairing", "missing_label")] == 4 and got[("pairing", "orphan_label")] == 1 and got[("strict_odd7", "token_count")] == 1 and got[("even_coords7", "empty")] == 1 and got[("points", "repeated_point")] == 1 and got[("stems", "train-test")] == 1
    assert readers.missing_paths(spark.createDataFrame([("data/train/images/a.jpg",)], "path string"), ["train/images", "images/a.jpg", "rain", "b"], spark).count() == 2
    page = sinks.html_report("A & B", {"t": spark.createDataFrame([("<x>", None)], "a string, b string")})
    assert "<h1>A &amp; B</h1>" in page and "<td>&lt;x&gt;</td><td></td>" in page
    many = spark.createDataFrame([(1, "\n".join(["0 .1 .1 .5 .1 .5 .5"] * 3 + ["", "  0 .1 .1 .5 .1 .5 .5 "]))], "file_id bigint, content string")
    assert sorted((r.line_no, r.reason) for r in L.audit_polygons(many).collect()) == [(0, "OK"), (1, "duplicate_line"), (2, "duplicate_line"), (4, "duplicate_line")]


def plans_of_pairs(monkeypatch):
    """The plans of the band joins that are written from here on."""
    plans, write = [], Scratch.write
    monkeypatch.setattr(Scratch, "write", lambda self, df, tag: (tag == "pairs" and plans.append(df._jdf.queryExecution().executedPlan().toString())) or write(self, df, tag))
    return plans


def written_images(spark):
    return Scratch(spark).write(spark.range(1, 61).select(F.col("id").alias("image_id"), F.lit("fig").alias("crop"), F.col("id").cast("string").alias("digest"), F.col("id").alias("fp"), F.lit(0.9).alias("quality"), F.lit(False).alias("corrupted")), "images")


def test_curation_broadcasts_no_exploded_side(spark, monkeypatch):
    i, plans = written_images(spark), plans_of_pairs(monkeypatch)
    assert {(r.image_id, r.outcome) for r in P.curated(i, 0.5).collect()} == {(1, "kept")} | {(n, "near_duplicate") for n in range(2, 61)}
    assert len(plans) == 1 and "SortMergeJoin" in plans[0] and "Broadcast" not in plans[0]


def test_selection_broadcasts_no_exploded_side(spark, monkeypatch):
    i, plans = written_images(spark), plans_of_pairs(monkeypatch)
    assert [tuple(r) for r in P.curated_selection(i, 0.5, 5).collect()] == [("fig", 1, 1)]
    assert len(plans) == 1 and "SortMergeJoin" in plans[0] and "Broadcast" not in plans[0]


def test_curation_seeks_near_groups_once(spark):
    rows = [(1, "fig", "a", 7, 0.9, False), (2, None, "b", 7, 0.8, False), (3, None, "c", 6, 0.7, False), (4, "fig", "d", None, 0.9, False), (5, "fig", "e", 7, 0.1, False), (6, "fig", "e", 7, 0.05, None), (7, "fig", "f", None, None, False), (8, "fig", "g", 7, 0.9, True)]
    got = P.curated(spark.createDataFrame(rows, "image_id bigint, crop string, digest string, fp bigint, quality double, corrupted boolean"), 0.5)
    assert {r.image_id: r.outcome for r in got.collect()} == {1: "kept", 2: "kept", 3: "near_duplicate", 4: "kept", 5: "near_duplicate", 6: "exact_duplicate", 7: "low_quality", 8: "corrupted"}
    assert "component" not in got._jdf.queryExecution().analyzed().toString()


def test_selection_broadcasts_no_kept_ids(spark, monkeypatch):
    plans, write = {}, Scratch.write
    i = written_images(spark).withColumn("fp", F.xxhash64("image_id"))
    monkeypatch.setattr(Scratch, "write", lambda self, df, tag: plans.update({tag: df._jdf.queryExecution().executedPlan().toString()}) or write(self, df, tag))
    monkeypatch.setattr("frond.operators.skew.MAX_SENT", 10)
    assert P.curated_selection(i, 0.5, 100).count() == 60
    assert "SortMergeJoin" in plans["kept"] and "Broadcast" not in plans["kept"]
