"""Sources, sinks, incremental processing and pixel kernels."""

import json
import os
import struct
import zlib
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from frond.functions import pixels as X
from frond.sources import readers as R
from frond.sources import sinks as K


def png(img):
    h, w, n = img.shape
    raw = b"".join(b"\0" + img[y].tobytes() for y in range(h))
    part = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, {1: 0, 3: 2, 4: 6}[n], 0, 0, 0)) + part(b"IDAT", zlib.compress(raw)) + part(b"IEND", b"")


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("data")
    files = {"train/images/a.jpg": b"\xff\xd8x", "train/labels/a.txt": b"0 .1 .1 .5 .1 .5 .5\n", "train/labels/b.txt": b"", "train/images/b.PNG": png(np.zeros((4, 6, 3), np.uint8)), "val/images/c.jpeg": b"", "val/images/d.gif": b"GIF", "top.txt": b"x", "extra/deep/er/e.txt": "ñ".encode()}
    for name, data in files.items():
        p = root / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(data)
    return str(root)


def test_listing_and_scans(spark, tree):
    ls = R.list_files(spark, tree)
    assert ls.count() == 8 and ls.where("size_bytes = 0").count() == 2
    assert {(r.split, r.stem) for r in R.scan_images(ls).collect()} == {("train", "a"), ("train", "b"), ("val", "c")}
    kinds = {os.path.basename(r.path): r.kind for r in R.classify_paths(ls).collect()}
    assert kinds["c.jpeg"] == "zero_byte" == kinds["b.txt"] and kinds["b.PNG"] == "image" and kinds["d.gif"] == "unrecognized"
    lt = {os.path.basename(r.path): r.content for r in R.read_label_tree(spark, tree).collect()}
    assert lt == {"a.txt": "0 .1 .1 .5 .1 .5 .5\n", "b.txt": "", "top.txt": "x", "e.txt": "ñ"}
    assert {r.required for r in R.missing_paths(ls, ["train/images", "test/images", "top.txt"], spark).collect()} == {"test/images"}
    assert {r.class_name for r in R.folder_classes(ls.where("path like '%/images/%'")).collect()} == {"images"}
    with pytest.raises(FileNotFoundError):
        R.list_files(spark, tree + "/nothing")


def test_headers(spark, tree):
    good = png(np.zeros((4, 6, 3), np.uint8))
    jpg = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x0b\x08\x00\x09\x00\x07\x03xx" + b"\xff\xd9"
    bmp = b"BM" + struct.pack("<I", 54) + b"\0" * 12 + struct.pack("<iiHH", 5, -3, 1, 24) + b"\0" * 24
    assert R.parse_header(good) == (6, 4, 3, "RGB", None) and R.parse_header(good[:-12])[4] == "truncated" and R.parse_header(b"")[4] == "empty" == R.parse_header(None)[4]
    assert R.parse_header(jpg) == (7, 9, 3, "RGB", None) and R.parse_header(jpg[:-2])[4] == "truncated" and R.parse_header(b"zz")[4] == "unknown format" and R.parse_header(bmp) == (5, 3, 3, "RGB", None)
    df = spark.createDataFrame([("g", good), ("t", good[:20]), ("n", None)], "path string, content binary")
    got = {r.path: (r.width, r.is_corrupted) for r in R.image_headers(df).collect()}
    assert got == {"g": (6, False), "t": (None, True), "n": (None, True)}


def test_csv_coco_yaml(spark, tmp_path):
    p = tmp_path / "m.csv"
    p.write_bytes("﻿Name,Label file,Plant,Disease,Split,Index,Resolution,Mask ratio,URL,License\na.jpg,a.png,Tomato,x,Training,3,10x20,,,\nb.jpg,b.png,Fig,y,Test,bad,bad,,,\n".encode())
    got = R.read_metadata(spark, str(p)).collect()
    assert [(r.Name, r.Index) for r in got] == [("a.jpg", 3), ("b.jpg", None)]
    doc = lambda f: {"images": [{"id": 1, "file_name": f, "width": 10, "height": 10}], "annotations": [{"id": 5, "image_id": 1, "category_id": 2, "area": 1.0, "segmentation": [[0, 0, 1, 0, 1, 1], [1, 2, 3, 4]]}, {"id": 6, "image_id": 1, "category_id": 2, "area": 1.0, "segmentation": []}]}
    for s, f in (("train", "t.jpg"), ("test", "u.jpg")):
        (tmp_path / f"{s}.json").write_text(json.dumps(doc(f), indent=1))
    polys = R.coco_polygons(R.read_coco(spark, {s: str(tmp_path / f"{s}.json") for s in ("train", "test")})).collect()
    assert {(r.split, r.file_name, r.part) for r in polys} == {("train", "t.jpg", 0), ("test", "u.jpg", 0)}
    want = {0: "a", 1: "b c"}
    for text in ("nc: 2\nnames: [a, 'b c']\n", "names:\n- a\n- \"b c\"\nnc: 2", "names:\n  0: a\n  1: b c\n# x\n", "names: {0: a, 1: b c}", "names: [a,\n  b c]"):
        assert R.parse_class_names(text) == want
    assert R.parse_class_names("nc: 1") == {} and R.class_map(spark, want).count() == 2
    (tmp_path / "k.json").write_text('{"fig": {"category": "fruit", "days": 3}, "mint": {"category": "herb"}}')
    assert {tuple(r) for r in R.keyed_dimension(spark, str(tmp_path / "k.json"), "crop", "category string, days int").collect()} == {("fig", "fruit", 3), ("mint", "herb", None)}


def test_soil(spark):
    df = R.soil_samples(spark, [("okra", (80, 40, 40, 25, 99, 6.5), (10, 5, 5, 2, 5, 0.3)), ("leek", (10, 10, 10, 10, 50, 13.9), (20, 1, 1, 1, 1, 1))], 500)
    s = df.groupBy("label").agg(F.count("*").alias("n"), F.min("N").alias("n0"), F.max("humidity").alias("h"), F.max("ph").alias("ph"), F.avg("K").alias("k")).collect()
    assert {r.label: r.n for r in s} == {"okra": 500, "leek": 500} and all(r.n0 >= 0 and r.h <= 100 and r.ph <= 14 for r in s) and abs(next(r.k for r in s if r.label == "okra") - 40) < 1.5


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "train", "a|b"), (2, "val", None)], "id bigint, split string, t string")
    body = K.save_json_report(df, str(tmp_path / "r" / "x.json"))
    assert R.read_json_report(str(tmp_path / "r" / "x.json"))["rows"] == body["rows"] and "timestamp_utc" in body
    K.save_csv(df, ["split", "id"], str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).columns == ["split", "id"]
    assert "| 1 | train | a\\|b |" in K.markdown_report("T", {"s": df}, str(tmp_path / "m.md"))
    K.write_manifest(df, str(tmp_path / "man"))
    assert {x for x in os.listdir(tmp_path / "man") if "=" in x} == {"split=train", "split=val"}
    out = str(tmp_path / "t")
    assert K.plan_write(df, out, dry_run=True)["written"] is False and not os.path.exists(out)
    K.plan_write(df, out)
    with pytest.raises(FileExistsError):
        K.plan_write(df, out)
    assert K.verify_written(df, out) and not K.verify_written(df.where("id = 1"), out) and K.differences(df, out).count() == 0 and K.differences(df.limit(1), out).count() == 1
    assert K.without(df, df.where("id = 1"), "id").count() == 1
    K.write_class_files({1: "b: c", 0: "a"}, str(tmp_path / "y"))
    assert R.parse_class_names((tmp_path / "y" / "data.yaml").read_text()) == {0: "a", 1: "b: c"}
    w = K.write_label_tree(spark.createDataFrame([("x/a.txt", "1"), ("x/b.txt", None)], "path string, content string"), str(tmp_path / "lab")).collect()
    assert {r.path: r.bytes for r in w} == {"x/a.txt": 1, "x/b.txt": 0} and (tmp_path / "lab/x/b.txt").read_text() == ""
    cp = spark.createDataFrame([(str(tmp_path / "lab/x/a.txt"), str(tmp_path / "cp/a.txt")), (str(tmp_path / "no"), str(tmp_path / "cp/b"))], "source string, target string")
    assert {r.status for r in K.copy_files(cp).collect()} == {"copied", "missing"} and {r.status for r in K.copy_files(cp).collect()} == {"present", "missing"}


def test_resume_and_stream(spark, tmp_path):
    from frond.streaming.incremental import class_counts_stream, process_new_files

    src, schema = str(tmp_path / "in"), "rel_path string, sha256 string, ts timestamp_ntz"
    put = lambda rows: spark.createDataFrame([(*r, datetime(2025, 1, 1)) for r in rows], schema).coalesce(1).write.mode("append").parquet(src)
    work = lambda df: df.select("rel_path", "sha256", F.when(F.col("rel_path") == "bad", "FAILED").otherwise("COMPLETED").alias("status"))
    go = lambda: process_new_files(spark, src, schema, str(tmp_path / "state"), str(tmp_path / "out"), work, str(tmp_path / "ck"))
    put([("a", "1"), ("b", "1"), ("a", "1"), ("bad", "1")])
    go()
    put([("a", "1"), ("a", "2"), ("c", "1"), ("bad", "1")])
    go()
    go()
    out = spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "out")).collect()
    assert sorted((r.rel_path, r.sha256) for r in out) == [("a", "1"), ("a", "2"), ("b", "1"), ("bad", "1"), ("bad", "1"), ("c", "1")]
    st = K.ResumeState(spark, str(tmp_path / "state"))
    assert {r.rel_path for r in st.pending(spark.read.parquet(src)).collect()} == {"bad"}
    s = class_counts_stream(spark.readStream.schema(schema).parquet(src).withColumn("ts", F.col("ts").cast("timestamp")), "ts", "sha256")
    q = s.writeStream.outputMode("complete").format("memory").queryName("cc").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {(r.sha256, r.n) for r in spark.table("cc").collect()} == {("1", 7), ("2", 1)}


def test_kernels():
    rng = np.random.default_rng(1)
    g = rng.integers(0, 255, (20, 30)).astype(float)
    lap = np.zeros_like(g)
    at = lambda y, x: g[abs(y) if y < 20 else 2 * 19 - y, abs(x) if x < 30 else 2 * 29 - x]
    for y in range(20):
        for x in range(30):
            lap[y, x] = at(y - 1, x) + at(y + 1, x) + at(y, x - 1) + at(y, x + 1) - 4 * g[y, x]
    assert abs(X.laplacian_variance(g) - lap.var()) < 1e-6
    assert np.allclose(X.box_resize(np.arange(16.0).reshape(4, 4), 2, 2), [[2.5, 4.5], [10.5, 12.5]]) and abs(X.box_resize(g, 7, 9).mean() - g.mean()) < 1e-9
    assert X.average_hash(np.full((8, 8), 3.0)) == 0 and X.average_hash(np.full((8, 8), 3.0), True) == -1
    green = np.zeros((40, 40, 3), np.uint8)
    green[:, :, 1] = 200
    assert X.leaf_ratios(green) == (1.0, 0.0) and X.leaf_verdict(1.0, 0.0) == "ok" and X.leaf_verdict(0, 0) == "low_vegetation" and X.leaf_verdict(0.5, 0.3) == "spots" and X.non_green(green) == 0.0
    h, s, v = X.hsv(np.array([[[0, 0, 255], [255, 0, 0], [7, 7, 7]]], np.uint8))
    assert h.tolist() == [[0, 120, 0]] and s.tolist() == [[255, 255, 0]] and v.tolist() == [[255, 255, 7]]
    assert X.framed(np.full((60, 60), 250.0)) and not X.framed(g) and 0 <= X.edge_fraction(g) <= 1
    assert abs(sum(X.color_histogram(green)) - 1) < 1e-9 and len(X.feature_vector(green)) == 27 and X.histogram_correlation([1, 2], [2, 4]) == pytest.approx(1)
    assert X.square_views(10, 30) == [(0, 0, 10, 10), (10, 0, 10, 10), (20, 0, 10, 10)] and X.square_views(9, 9) == [(0, 0, 9, 9)] and X.square_views(10, 30, "center") == [(10, 0, 10, 10)]
    m = np.zeros((6, 8), bool)
    m[1:3, 1:3] = True
    assert X.repair((6, 8), m)[1] == "ok" and X.repair((8, 6), m)[1] == "rotated" and X.repair((3, 4), m)[1] == "quarantine" and X.repair((3, 4), m, True)[0].shape == (3, 4)
    assert X.morph(m, True).sum() == 16 and X.morph(m, False).sum() == 0
    two = np.r_[np.zeros(50), np.full(50, 200)].reshape(10, 10)
    assert 0 <= X.otsu(two) < 200 and X.leaf_mask(green).shape == (40, 40)


def test_components_by_flood():
    rng = np.random.default_rng(3)
    for p in (0.2, 0.45, 0.7):
        m = rng.random((25, 31)) < p
        seen, sizes = np.zeros_like(m), []
        for y, x in zip(*np.nonzero(m)):
            if not seen[y, x]:
                stack, n = [(y, x)], 0
                seen[y, x] = True
                while stack:
                    a, b = stack.pop()
                    n += 1
                    for c in range(max(0, a - 1), min(25, a + 2)):
                        for d in range(max(0, b - 1), min(31, b + 2)):
                            if m[c, d] and not seen[c, d]:
                                seen[c, d] = True
                                stack.append((c, d))
                sizes.append(n)
        assert X.components(m) == sorted(sizes, reverse=True)


def test_image_source(spark, tmp_path):
    rng = np.random.default_rng(5)
    img = rng.integers(0, 255, (60, 70, 3)).astype(np.uint8)  # red, green, blue
    (tmp_path / "a.png").write_bytes(png(img))
    (tmp_path / "bad.png").write_bytes(b"nope")
    mask = np.zeros((60, 70, 1), np.uint8)
    mask[20:40, 20:50] = 255
    (tmp_path / "m.png").write_bytes(png(mask))
    df = spark.read.format("image").option("dropInvalid", False).load(str(tmp_path)).withColumn("name", F.regexp_extract("image.origin", "([^/]*)$", 1))
    got = {r.name: r for r in X.measure_images(df, ["name"]).collect()}
    want = X.image_metrics(img[:, :, ::-1])
    assert got["bad.png"].width is None and got["a.png"].ahash == want[13] and abs(got["a.png"].blur - want[3]) < 1e-6 and len(got["a.png"].histogram) == 512
    mm = {r.name: r for r in X.measure_masks(df, ["name"]).collect()}["m.png"]
    assert (mm.mask_pixels, mm.components, mm.largest, mm.x, mm.y, mm.w, mm.h, mm.verdict) == (600, 1, 600, 20, 20, 30, 20, "valid")
    assert X.mask_metrics(np.zeros((5, 5), bool))[-1] == "low coverage" and X.mask_metrics(np.ones((50, 50), bool))[-1] == "high coverage"
