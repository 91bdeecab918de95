"""Label rules, polygons and scalar functions on hand-computed cases."""

import pytest
from pyspark.sql import functions as F

from frond.functions import geometry as G
from frond.functions import labels as L
from frond.functions import text as X


def one(spark, c):
    return spark.range(1).select(c.alias("v")).first()[0]


LINES = ["0 .1 .1 .5 .1 .5 .5", "0 .1 .1 .5 .1 .5 .5 .9", "0 .1 .1 .5 .1", "0 .1", "1.0 .1 .1 .5 .1 .5 .5"]


@pytest.mark.parametrize("rule,good", [("strict_odd7", [1, 0, 0, 0, 0]), ("loose7", [1, 1, 0, 0, 0]), ("even_coords7", [1, 0, 0, 0, 0]), ("min3", [1, 1, 1, 0, 0]), ("box5", [0, 0, 1, 0, 0])])
def test_rule_presets(spark, rule, good):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(LINES)], "i int, x string")
    got = {r.i: r.w is None for r in df.select("i", L.line_reason(L.tokens(F.col("x")), rule).alias("w")).collect()}
    assert [int(got[i]) for i in range(5)] == good


def test_strict_numbers(spark):
    df = spark.createDataFrame([(x,) for x in ["1", "+3", "1.0", "1_000", "nan", "inf", "1e-3", ".5", "5.", "", "-", None]], "x string")
    got = {r.x: (r.i, r.f) for r in df.select("x", L.strict_int(F.col("x")).alias("i"), L.strict_float(F.col("x")).alias("f")).collect()}
    assert got["1"] == (1, 1.0) and got["+3"] == (3, 3.0) and got["1.0"] == (None, 1.0) and got["1_000"] == (None, None) and got["nan"] == (None, None) == got["inf"]
    assert got["1e-3"] == (None, 0.001) and got[".5"] == (None, 0.5) and got["5."] == (None, 5.0) and got[""] == (None, None) and got[None] == (None, None)


def test_audit_cascade(spark):
    text = "\n".join([
        "0 .1 .1 .5 .1 .5 .5 .1 .5", "1 0 0 1 0 0 1", "0 0 0 1 1 1 0 0 1", "0 .2 .2 .2 .2 .2 .2", "9 0 0 1.2 0 0 1", "0 0 0 1.2 0 0 1", "0 .1 .1 .5 .1 .5 .5 .1 .5", "", "  ", "0 1 2", "x .1 .1 .5 .1 .5 .5",
    ])
    df = spark.createDataFrame([(1, text), (2, ""), (3, None), (4, "\r\n0 .1 .1 .5 .1 .5 .5\r\n")], "file_id bigint, content string")
    got = {(r.file_id, r.line_no): r for r in L.audit_polygons(df, [0, 1]).collect()}
    why = [got[1, i].reason for i in (0, 1, 2, 3, 4, 5, 6, 9, 10)]
    assert why == ["OK", "OK", "self_intersecting", "no_area", "unknown_class", "out_of_bounds", "duplicate_line", "token_count", "class_id"]
    assert abs(got[1, 0].area - 0.16) < 1e-12 and abs(got[1, 1].area - 0.5) < 1e-12 and got[1, 3].has_duplicate_points and got[1, 6].class_id == -1
    assert got[4, 1].reason == "OK" and {k[0] for k in got} == {1, 4}
    st = {r.file_id: (r.lines, r.reason) for r in L.label_status(df, "loose7").collect()}
    assert st[2] == (0, "empty") == st[3] and st[1] == (9, "out_of_bounds") and L.label_status(df, "strict_odd7").where("file_id = 2").first().reason is None


def test_geometry(spark):
    pts = lambda xy: F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in xy])
    sq = pts([(0, 0), (2, 0), (2, 1), (0, 1)])
    assert one(spark, G.signed_area(sq)) == 2.0 and one(spark, G.area(G.clockwise(sq))) == 2.0
    assert tuple(one(spark, G.bbox(sq))) == (0, 0, 2, 1) and one(spark, G.perimeter(sq)) == 6.0 and one(spark, G.compactness(G.perimeter(sq), G.area(sq))) == 18.0
    dup = pts([(0, 0), (0, 0), (1, 0), (1, 1), (0, 0)])
    assert [tuple(p) for p in one(spark, G.drop_consecutive(dup))] == [(0, 0), (1, 0), (1, 1)] and one(spark, G.has_repeated_point(dup)) and one(spark, G.unique_points(dup)) == 3
    assert [tuple(p) for p in one(spark, G.normalize(pts([(-5, 3), (20, 5)]), F.lit(10), F.lit(10)))] == [(0.0, 0.3), (1.0, 0.5)] and one(spark, G.normalize(sq, F.lit(0), F.lit(1))) is None
    assert [tuple(p) for p in one(spark, G.denormalize(pts([(0.5, 0.99)]), F.lit(10), F.lit(10)))] == [(5, 9)]
    assert one(spark, G.corners(F.lit(0.9), F.lit(0.5), F.lit(0.4), F.lit(0.2)))["outside"]
    assert len(one(spark, G.to_points(F.array(F.lit(1.0), F.lit(2.0), F.lit(3.0))))) == 1 and one(spark, G.to_points(F.array().cast("array<double>"))) == []


def test_intersection_both_ways_and_simplify(spark):
    import random

    rng = random.Random(1)
    rows = []
    for i in range(80):
        n = rng.randrange(2, 9)
        rows.append((i, [rng.randrange(5) * 1.0 for _ in range(n)], [rng.randrange(5) * 1.0 for _ in range(n)]))
    df = spark.createDataFrame(rows, "i int, xs array<double>, ys array<double>")
    p = F.transform(F.arrays_zip("xs", "ys"), lambda q: F.struct(q["xs"].alias("x"), q["ys"].alias("y")))
    got = df.select("i", G.self_intersects(p).alias("a"), G.polygon_crosses()("xs", "ys").alias("b")).collect()
    assert all(r.a == r.b for r in got) and any(r.a for r in got) and not all(r.a for r in got)
    line = spark.createDataFrame([([0.0, 1.0, 2.0, 3.0, 4.0], [0.0, 0.01, 0.0, 2.0, 0.0]), ([1.0], [1.0])], "xs array<double>, ys array<double>")
    assert [r[0] for r in line.select(G.simplify(0.1)("xs", "ys")).collect()] == [[0.0, 0.0, 2.0, 0.0, 3.0, 2.0, 4.0, 0.0], [1.0, 1.0]]


def test_text(spark):
    assert one(spark, X.title(F.lit("bean_healthy leaves x2y"))) == "Bean_Healthy Leaves X2Y"
    c = one(spark, X.crop_and_disease(F.lit("Bell_Pepper___Bacterial_Spot")))
    assert tuple(c) == ("Bell Pepper", "Bacterial Spot", False) and one(spark, X.crop_and_disease(F.lit("Tomato___Healthy")))["healthy"]
    for name, want in [("tomato_early_blight_google_0001.jpg", "tomato early blight"), ("fig_12.png", "fig"), ("grape_x_3d_y.jpg", "grape x"), ("google_leaf.jpg", "google leaf")]:
        assert one(spark, X.infer_disease(F.lit(name))) == want
    assert one(spark, X.longest_listed(F.lit("Leek_ash_mildew_3"), ["leek ash", "leek ash mildew"])) == "leek ash" and one(spark, X.longest_listed(F.lit("z"), ["a"])) == ""
    assert tuple(one(spark, X.parse_size(F.lit("640X480")))) == (640, 480) and one(spark, X.parse_size(F.lit("bad"))) is None
    assert one(spark, X.stem(F.lit("a/b.c.txt"))) == "b.c" and one(spark, X.stem(F.lit("a/.hidden"))) == ".hidden" and one(spark, X.suffix(F.lit("x/A.JPG"))) == ".jpg" and one(spark, X.is_image(F.lit("q.JpEg")))
    assert one(spark, X.split_of_path(F.lit("/d/Train/images/x"))) == "train" and one(spark, X.split_of_path(F.lit("/d/x"))) is None
    assert one(spark, X.strip_suffixes(F.lit("anthracnose_fruit_rot"))) == "anthracnose" and one(spark, X.strip_suffixes(F.lit("a_rot_b"))) == "a_b"
    assert one(spark, X.disease_slug(F.lit(" Banana - Panama "))) == "banana_panama_disease" and one(spark, X.is_snake(F.lit("a_b2"))) and not one(spark, X.is_snake(F.lit("a__b")))
    assert one(spark, X.issue_list([F.lit(" - a"), F.lit(None).cast("string"), F.lit("b - ")])) == "a, b" and one(spark, X.contains_either(F.lit("ab"), F.lit("b")))
    assert one(spark, X.short_name(F.lit("x" * 30), 5)).startswith("xxxxx_") and one(spark, X.short_name(F.lit("x"), 5)) == "x"


def test_numbers(spark):
    assert one(spark, X.hamming(F.lit(0), F.lit(31))) == 5 and one(spark, X.hamming(F.lit(None).cast("bigint"), F.lit(1).cast("bigint"))) == 999
    assert one(spark, X.image_quality(F.lit(1920), F.lit(1080), F.lit(500.0), F.lit(140.0), F.lit(50.0))) == 1.0
    assert abs(one(spark, X.image_quality(F.lit(0), F.lit(0), F.lit(0.0), F.lit(30.0), F.lit(0.0))) - 0.04) < 1e-9
    assert one(spark, X.clamp(F.lit(9.0), 0, 1)) == 1.0 and one(spark, X.is_close(F.lit(1.0), F.lit(1.000001))) and not one(spark, X.is_close(F.lit(1.0), F.lit(1.1)))
    px = F.array(*[F.lit(float(i)) for i in range(64)])
    assert one(spark, X.mean_hash(px)) == (1 << 32) - 1 and one(spark, X.mean_hash(F.slice(px, 1, 10))) is None
    flat = F.array_repeat(F.lit(1.0), 64)
    assert one(spark, X.mean_hash(flat)) == 0 and one(spark, X.mean_hash(flat, inclusive=True)) == -1
    fall = F.array(*[F.lit(float(-i)) for i in range(72)])
    assert one(spark, X.difference_hash(fall)) == -1
    assert one(spark, X.frame_seconds(F.lit(45), F.lit(30))) == 1.5 and one(spark, X.frame_seconds(F.lit(1), F.lit(0))) is None
