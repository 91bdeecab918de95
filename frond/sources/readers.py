"""Sources: file listings, metadata, annotation documents, label trees, class lists, image headers."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frond.functions import text as X
from frond.session import ship
from frond.storage import Scratch

METADATA = T.StructType([
    T.StructField("Name", T.StringType()), T.StructField("Label file", T.StringType()), T.StructField("Plant", T.StringType()), T.StructField("Disease", T.StringType()), T.StructField("Split", T.StringType()),
    T.StructField("Index", T.IntegerType()), T.StructField("Resolution", T.StringType()), T.StructField("Mask ratio", T.StringType()), T.StructField("URL", T.StringType()), T.StructField("License", T.StringType()),
])

COCO = (
    "images array<struct<id: bigint, file_name: string, width: int, height: int>>, "
    "annotations array<struct<id: bigint, image_id: bigint, category_id: int, area: double, segmentation: array<array<double>>>>, "
    "categories array<struct<id: int, name: string>>"
)

LISTING = "path string, size_bytes bigint, modified_at timestamp_ntz"


def list_files(spark: SparkSession, root: str, batch: int = 100_000) -> DataFrame:
    """(path, size_bytes, modified_at) of all files below ``root``, empty ones included.

    Spark's own file scans pass over empty files, so the listing comes from the file system. A local
    or mounted tree is walked by tasks, one for each folder of the first two levels. Other systems
    are listed by an iterator in batches that are written at once, so the driver never holds the
    whole list.
    """
    ship(spark)
    if re.match(r"^(?!file:)[a-z][a-z0-9+.-]*:", root):
        return _list_remote(spark, root, batch)
    import os

    base = re.sub("^file:/*", "/", root)
    if not os.path.isdir(base):
        raise FileNotFoundError(root)

    def walk(batches):
        import os
        from datetime import datetime, timezone

        for pdf in batches:
            for top, deep in zip(pdf["dir"], pdf["deep"]):
                rows = []
                for at, _, names in os.walk(top) if deep else [(top, [], [e.name for e in os.scandir(top) if e.is_file()])]:
                    for name in names:
                        s = os.stat(p := os.path.join(at, name))
                        rows.append((p, s.st_size, datetime.fromtimestamp(s.st_mtime, timezone.utc).replace(tzinfo=None)))
                yield pd.DataFrame(rows, columns=["path", "size_bytes", "modified_at"])

    first = sorted(e.path for e in os.scandir(base) if e.is_dir())
    dirs = [(d, False) for d in [base, *first]] + [(e.path, True) for d in first for e in os.scandir(d) if e.is_dir()]
    return spark.createDataFrame(dirs, "dir string, deep boolean").repartition(max(1, min(len(dirs), 2000))).mapInPandas(walk, LISTING)


def _list_remote(spark: SparkSession, root: str, batch: int) -> DataFrame:
    from datetime import datetime, timezone

    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    it = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(at, True)
    scratch, parts, rows = Scratch(spark), [], []

    def flush():
        if rows or not parts:
            parts.append(scratch.write(spark.createDataFrame(rows, LISTING), "listing"))
            rows.clear()

    while it.hasNext():
        s = it.next()
        rows.append((s.getPath().toString(), s.getLen(), datetime.fromtimestamp(s.getModificationTime() / 1000, timezone.utc).replace(tzinfo=None)))
        if len(rows) >= batch:
            flush()
    flush()
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def scan_images(listing: DataFrame) -> DataFrame:
    """SRC-01: (path, split, filename, stem, size_bytes) of jpg, jpeg and png files in a split folder."""
    p = F.col("path")
    got = listing.where(X.is_image(p)).select(p, X.split_of_path(p).alias("split"), X.basename(p).alias("filename"), X.stem(p).alias("stem"), "size_bytes")
    return got.where("split is not null")


def classify_paths(listing: DataFrame) -> DataFrame:
    """SRC-02: ``kind``: zero_byte, image, mask or unrecognized, from folders and suffix."""
    parts = F.split(F.lower("path"), "/")
    in_mask = F.exists(parts, lambda s: s.isin("masks", "annotations", "labels"))
    kind = F.when(F.col("size_bytes") == 0, "zero_byte").when(~X.is_image(F.col("path")), "unrecognized").when(in_mask, "mask").otherwise("image")
    return listing.withColumn("kind", kind)


def folder_classes(listing: DataFrame) -> DataFrame:
    """SRC-03: (class_name, class_id): parent folders, numbered by name. Class lists are small."""
    from pyspark.sql import Window as W

    name = F.element_at(F.split("path", "/"), -2)
    return listing.select(name.alias("class_name")).distinct().withColumn("class_id", (F.row_number().over(W.partitionBy(F.lit(1)).orderBy("class_name")) - 1).cast("int"))


def read_metadata(spark: SparkSession, path: str, schema: T.StructType = METADATA) -> DataFrame:
    """SRC-04: CSV with a header and an explicit schema; a byte-order mark is dropped, bad numbers are null."""
    return spark.read.option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", False).schema(schema).csv(path)


def read_coco(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """SRC-05: annotation documents, one for each split, with their split."""
    out = None
    for split, path in paths.items():
        one = spark.read.option("multiLine", True).schema(COCO).json(path).withColumn("split", F.lit(split))
        out = one if out is None else out.unionByName(one)
    return out


def coco_polygons(coco: DataFrame) -> DataFrame:
    """JN-07: (split, image_id, file_name, width, height, annotation_id, category_id, part, flat).

    Images and annotations are joined by split and id, since ids may repeat between splits. Polygons
    of fewer than six numbers and empty segmentations give no row.
    """
    i = coco.select("split", F.explode("images").alias("i")).select("split", F.col("i.id").alias("image_id"), "i.file_name", "i.width", "i.height")
    a = coco.select("split", F.explode("annotations").alias("a")).select("split", F.col("a.image_id").alias("image_id"), F.col("a.id").alias("annotation_id"), "a.category_id", F.posexplode("a.segmentation").alias("part", "flat"))
    return i.join(a.where(F.size("flat") >= 6), ["split", "image_id"])


def coco_subset(coco_images: DataFrame, coco_annotations: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """JN-06: images by wanted (split, file_name), and the annotations of the images that stay."""
    i = coco_images.join(wanted.select("split", "file_name").distinct(), ["split", "file_name"], "left_semi")
    return i, coco_annotations.join(i.select("split", "image_id").distinct(), ["split", "image_id"], "left_semi")


def read_label_tree(spark: SparkSession, root: str, suffix: str = ".txt") -> DataFrame:
    """SRC-06: (path, content, size_bytes, modified_at) of a label tree, empty files with content ''.

    The suffix may be written in any letter case.
    """
    listed = list_files(spark, root).where(F.lower("path").endswith(suffix.lower()))
    either = "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in suffix)
    scan = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{either}").load(root)
    text = scan.select(F.regexp_replace("path", "^file:/*", "/").alias("path"), F.decode("content", "UTF-8").alias("content"))
    return listed.join(text, "path", "left").select("path", F.coalesce("content", F.lit("")).alias("content"), "size_bytes", "modified_at")


def parse_class_names(text: str) -> dict[int, str]:
    """SRC-07, MAP-03: names of a data.yaml: a flow list or map, a dashed list, or an indented map."""
    unquote = lambda s: s.strip().strip("'\"")
    lines = [re.sub(r"\s+#.*$", "", x).rstrip() for x in text.splitlines()]
    for at, line in enumerate(lines):
        m = re.match(r"^names\s*:\s*(.*)$", line)
        if not m:
            continue
        body = m[1].strip()
        follow = []
        for x in lines[at + 1 :]:
            if x.strip() and not x[0].isspace() and not x.startswith("-"):
                break
            follow.append(x.strip())
        if body.startswith(("[", "{")):
            flow = " ".join([body, *follow])
            inner = flow[1 : flow.index("]" if flow[0] == "[" else "}")]
            items = [x for x in (p.strip() for p in inner.split(",")) if x]
            return {int(unquote(k)): unquote(v) for k, v in (x.split(":", 1) for x in items)} if flow[0] == "{" else {i: unquote(x) for i, x in enumerate(items)}
        rows = [x for x in follow if x]
        if all(x.startswith("-") for x in rows):
            return {i: unquote(x[1:]) for i, x in enumerate(rows)}
        return {int(unquote(k)): unquote(v) for k, v in (x.split(":", 1) for x in rows)}
    return {}


def class_map(spark: SparkSession, names: dict[int, str]) -> DataFrame:
    """(class_id, class_name) of parsed names."""
    return spark.createDataFrame(sorted(names.items()), "class_id int, class_name string")


def read_dimension(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """SRC-08, SRC-14: a small JSON document of records, or an earlier report."""
    return spark.read.option("multiLine", True).schema(schema).json(path)


def keyed_dimension(spark: SparkSession, path: str, key: str, value_schema: str) -> DataFrame:
    """SRC-08: a JSON object of objects as rows (key, fields...)."""
    raw = spark.read.text(path, wholetext=True)
    m = F.from_json("value", T.MapType(T.StringType(), T._parse_datatype_string(value_schema)))
    return raw.select(F.explode(m).alias(key, "v")).select(key, "v.*")


def missing_paths(listing: DataFrame, required: list[str], spark: SparkSession) -> DataFrame:
    """SRC-15: required relative paths that no listed path ends with or lies below.

    A listed path gives its stretches of as many folders as some required path has, which are joined
    by equality.
    """
    want = spark.createDataFrame([(r.strip("/"),) for r in required], "required string").distinct()
    parts = F.filter(F.split("path", "/"), lambda s: s != "")

    def of(n: int) -> Column:
        last = F.size("p") - n
        return F.when(last >= 0, F.transform(F.sequence(F.lit(1), last + 1), lambda i: F.array_join(F.slice("p", i, n), "/"))).otherwise(F.array().cast("array<string>"))

    stretches = [of(n) for n in sorted({r.strip("/").count("/") + 1 for r in required})]
    have = listing.select(parts.alias("p")).select(F.explode(F.array_distinct(F.concat(*stretches))).alias("required")) if stretches else None
    return want if have is None else want.join(have, "required", "left_anti")


# ---- image headers ----------------------------------------------------------------------------

HEADER = "width int, height int, channels int, color_mode string, corruption_reason string"


def parse_header(b: bytes | None) -> tuple:
    """SRC-09: size, bands and mode from the bytes of a PNG, JPEG or BMP, or why it is unusable."""
    bad = lambda why: (None, None, None, None, why)
    if not b:
        return bad("empty")
    if b[:8] == b"\x89PNG\r\n\x1a\n":
        if len(b) < 33 or b[12:16] != b"IHDR":
            return bad("truncated")
        w, h, kind = int.from_bytes(b[16:20]), int.from_bytes(b[20:24]), b[25]
        if b"IEND" not in b[-16:]:
            return bad("truncated")
        n, mode = {0: (1, "L"), 2: (3, "RGB"), 3: (1, "P"), 4: (2, "LA"), 6: (4, "RGBA")}.get(kind, (0, None))
        return (w, h, n, mode, None) if n and w and h else bad("broken")
    if b[:2] == b"\xff\xd8":
        i = 2
        while i + 9 < len(b):
            if b[i] != 0xFF:
                return bad("broken")
            k = b[i + 1]
            if k == 0xFF or k == 0x01 or 0xD0 <= k <= 0xD7:
                i += 1 if k == 0xFF else 2
                continue
            if 0xC0 <= k <= 0xCF and k not in (0xC4, 0xC8, 0xCC):
                h, w, n = int.from_bytes(b[i + 5 : i + 7]), int.from_bytes(b[i + 7 : i + 9]), b[i + 9]
                if b"\xff\xd9" not in b[-64:]:
                    return bad("truncated")
                return (w, h, n, {1: "L", 3: "RGB", 4: "CMYK"}.get(n), None) if w and h else bad("broken")
            i += 2 + int.from_bytes(b[i + 2 : i + 4])
        return bad("truncated")
    if b[:2] == b"BM":
        if len(b) < 30 or len(b) < int.from_bytes(b[2:6], "little"):
            return bad("truncated")
        n = int.from_bytes(b[28:30], "little") // 8
        return int.from_bytes(b[18:22], "little"), abs(int.from_bytes(b[22:26], "little", signed=True)), max(1, n), {3: "RGB", 4: "RGBA"}.get(n, "P"), None
    return bad("unknown format")


def image_headers(files: DataFrame, content: str = "content", keep: list[str] | None = None) -> DataFrame:
    """SRC-09, MTH-09: kept columns, size, bands, mode, reason, and the SHA-256 of the bytes."""
    keep = keep or ["path"]

    @F.pandas_udf(HEADER)
    def header(b: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame([parse_header(x) for x in b], columns=["width", "height", "channels", "color_mode", "corruption_reason"])
        return out.astype({"width": "Int32", "height": "Int32", "channels": "Int32"})

    got = files.select(*keep, F.sha2(content, 256).alias("sha256"), header(F.col(content)).alias("h"))
    return got.select(*keep, "sha256", "h.*", F.col("h.corruption_reason").isNotNull().alias("is_corrupted"))


# ---- synthetic soil samples -------------------------------------------------------------------


def soil_samples(spark: SparkSession, profiles: list[tuple], per_crop: int = 1000, seed: int = 42, noise: float = 0.05) -> DataFrame:
    """SRC-13, MTH-08: per_crop rows for each profile (label, six means, six deviations).

    Draws are normal around the means; a further factor within ±noise of one is applied; values are
    clamped to at least 0, humidity to 100 and acidity to 14, counts rounded to whole numbers and the
    rest to two places. The draws of Spark's generators, so only the distribution is fixed.
    """
    names = ["N", "P", "K", "temperature", "humidity", "ph"]
    fields = ", ".join(f"m_{n} double" for n in names) + ", " + ", ".join(f"s_{n} double" for n in names)
    p = spark.createDataFrame([(t[0], *map(float, t[1]), *map(float, t[2])) for t in profiles], "label string, " + fields)
    rows = p.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(per_crop))))

    def draw(i: int, n: str) -> Column:
        v = (F.col(f"m_{n}") + F.randn(seed + i) * F.col(f"s_{n}")) * (1 + (F.rand(seed + 100 + i) * 2 - 1) * noise)
        v = F.greatest(v, F.lit(0.0))
        if n in ("humidity", "ph"):
            v = F.least(v, F.lit(100.0 if n == "humidity" else 14.0))
        return F.round(v).cast("int").alias(n) if n in ("N", "P", "K") else F.round(v, 2).alias(n)

    return rows.select(*[draw(i, n) for i, n in enumerate(names)], "label")


def read_json_report(path: str) -> dict:
    """SRC-14: an earlier report of one document."""
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def inverted(pairs: DataFrame, key: str, value: str) -> DataFrame:
    """MAP-04: (value, key) with one key for each value, the greatest, as the last of a sorted list wins."""
    return pairs.where(F.col(value).isNotNull()).groupBy(value).agg(F.max(key).alias(key))
