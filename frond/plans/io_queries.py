"""Queries of sources and sinks: the tables are written out in their outer form, read back and compared with SQL.

What is written as single files goes to the session's shared folder, which has to be a mounted path.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import functions as F

from frond.functions import keys as K
from frond.operators import compaction
from frond.plans import curation_queries as C
from frond.plans import pipeline_queries as Q
from frond.plans.tables import table
from frond.sources import readers, sinks
from frond.storage import Scratch

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _folder(spark, tag: str) -> str:
    """A new path in the shared folder for single files."""
    at = Scratch(spark).path(tag)
    if re.match(r"^(?!file:)[a-z][a-z0-9+.-]*:", at):
        raise RuntimeError("single files need a shared folder that is mounted on all machines")
    at = re.sub("^file:/*", "/", at)
    os.makedirs(os.path.dirname(at), exist_ok=True)
    return at


def _done(df) -> None:
    df.write.format("noop").mode("overwrite").save()


_CUR = f"""cur as (select * from (select *, row_number() over (partition by file order by modified_at desc nulls last, file_id) as r from (select *, nullif({C._FILE}, '') as file from label_files)) where r = 1 and file is not null)"""


def _label_tree(spark, d) -> str:
    root = _folder(spark, "labels")
    now = compaction.current_label_files(table(spark, d, "label_files")).select(K.file_key(F.col("label_path")).alias("path"), "content").where("path is not null")
    _done(sinks.write_label_tree(now, root))
    return root


@query(f"with {_CUR} select file as path, coalesce(content, '') as content, octet_length(encode(coalesce(content, '')))::bigint as size_bytes from cur")
def src06_label_tree(spark, d):
    """A tree of label files written and read back, empty files included."""
    root = _label_tree(spark, d)
    got = readers.read_label_tree(spark, root)
    return got.select(F.substring("path", len(root) + 2, 1 << 20).alias("path"), "content", "size_bytes")


_IMGS = f"""im as (select distinct {C._FILE.replace('label_path', 'image_path')} as path from dataset_images where image_path is not null), ok as (select path, regexp_extract(path, '([^/]*)$', 1) as filename from im where path <> '')"""


def _image_tree(spark, d):
    """A tree with a file for each image path, holding its name; (listing, root)."""
    root = _folder(spark, "images")
    i = table(spark, d, "dataset_images").select(K.file_key(F.col("image_path")).alias("path")).where("path is not null").distinct()
    _done(sinks.write_label_tree(i.withColumn("content", F.when(F.length("path") % 9 != 0, F.col("path"))), root))
    return readers.list_files(spark, root), root


@query(rf"with {_IMGS} select path, list_filter(string_split(lower(path), '/'), lambda p: p in ('train', 'val', 'test'))[1] as split, filename, regexp_replace(filename, '(.)\.[^.]*$', '\1') as stem from ok where regexp_matches(lower(filename), '.\.(jpg|jpeg|png)$') and list_has_any(string_split(lower(path), '/'), ['train', 'val', 'test'])")
def src01_scan(spark, d):
    listing, root = _image_tree(spark, d)
    return readers.scan_images(listing.withColumn("path", F.substring("path", len(root) + 2, 1 << 20))).select("path", "split", "filename", "stem")


@query(rf"with {_IMGS} select case when length(path) % 9 = 0 then 'zero_byte' when not regexp_matches(lower(filename), '.\.(jpg|jpeg|png)$') then 'unrecognized' when list_has_any(string_split(lower(path), '/'), ['masks', 'annotations', 'labels']) then 'mask' else 'image' end as kind, count(*) as n from ok group by 1")
def src02_kinds(spark, d):
    """Files by kind; those with a path of a length divisible by nine were written empty."""
    listing, root = _image_tree(spark, d)
    got = readers.classify_paths(listing.withColumn("path", F.substring("path", len(root) + 2, 1 << 20)))
    return got.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query(f"with {_IMGS}, c as (select distinct list_extract(string_split('/' || path, '/'), -2) as class_name from ok) select class_name, (row_number() over (order by class_name) - 1)::integer as class_id from c")
def src03_folder_classes(spark, d):
    listing, root = _image_tree(spark, d)
    return readers.folder_classes(listing.withColumn("path", F.concat(F.lit("/"), F.substring("path", len(root) + 2, 1 << 20))))


@query(f"with {_IMGS}, r(required) as (values ('datasets/baseline/train/images'), ('datasets/new/labels'), ('train/images'), ('images'), ('data.yaml'), ('datasets')) select required from r where not exists (select 1 from ok where contains('/' || path || '/', '/' || required || '/'))")
def src15_missing(spark, d):
    listing, root = _image_tree(spark, d)
    return readers.missing_paths(listing.withColumn("path", F.substring("path", len(root) + 2, 1 << 20)), ["datasets/baseline/train/images", "datasets/new/labels", "/train/images/", "images", "data.yaml", "datasets"], spark)


_META = ["Name", "Label file", "Plant", "Disease", "Split", "Index", "Resolution", "Mask ratio", "URL", "License"]


@query(f"""with {C._IMG} select filename as "Name", file as "Label file", crop as "Plant", nullif(split, '') as "Split", try_cast(image_id as integer) as "Index", width || 'x' || height as "Resolution" from img""")
def src04_metadata(spark, d):
    """A metadata file written with its columns and read back."""
    i = C.images(spark, d)
    size = F.concat_ws("x", *[F.when(F.col("width").isNotNull() & F.col("height").isNotNull(), F.col(c)) for c in ("width", "height")])
    none = F.lit(None).cast("string")
    cols = [F.col("filename"), F.col("file"), F.col("crop"), none, F.col("split"), F.col("image_id"), F.when(size != "", size), none, none, none]
    at = Scratch(spark).path("metadata")
    sinks.save_csv(i.select(*[c.alias(n) for c, n in zip(cols, _META)]), _META, at)
    return readers.read_metadata(spark, at).select("Name", "Label file", "Plant", "Split", "Index", "Resolution")


@query(f"with {C._IMG}, w as (select distinct split, filename from img where split is not null and crop in ('leek', 'fig')), {Q._PICKED}, p as (select p.*, i.filename from pick p join img i using (image_id, split)) select split, filename as file_name, count(*) as images from p semi join w using (split, filename) group by all")
def jn06_coco_subset(spark, d):
    coco = Q._coco(spark, d)
    i = coco.select("split", F.explode("images").alias("i")).select("split", F.col("i.id").alias("image_id"), "i.file_name")
    a = coco.select("split", F.explode("annotations").alias("a")).select("split", F.col("a.image_id").alias("image_id"), F.col("a.id").alias("annotation_id"))
    w = C.images(spark, d).where("split is not null and crop in ('leek', 'fig')").select("split", F.col("filename").alias("file_name"))
    return readers.coco_subset(i, a, w)[0].groupBy("split", "file_name").agg(F.count(F.lit(1)).alias("images"))


@query(f"with {C._CLS} select class_id, class_name from cb")
def src07_class_files(spark, d):
    """data.yaml and classes.txt of the class list, written and parsed."""
    names = {r.class_id: r.class_name for r in C._class_lists(spark, d)[0].collect()}  # a label set
    at = _folder(spark, "classes")
    sinks.write_class_files(names, at)
    with open(os.path.join(at, "data.yaml"), encoding="utf-8") as f:
        got = readers.parse_class_names(f.read())
    with open(os.path.join(at, "classes.txt"), encoding="utf-8") as f:
        assert f.read().split("\n")[:-1] == [names[k] for k in sorted(names)]
    return readers.class_map(spark, got)


@query(f"select crop, min({C._KEY.format(c='category')}) as category, count(*) as n from crop_recommendations where crop is not null group by crop")
def src08_dimension(spark, d):
    """A document of crops with their fields, written as one object and read as rows."""
    import json

    per = table(spark, d, "crop_recommendations").where("crop is not null").groupBy("crop").agg(F.min(K.name_key(F.col("category"))).alias("category"), F.count(F.lit(1)).alias("n"))
    rows = sinks._rows(per)
    at = _folder(spark, "crops.json")
    with open(at, "w", encoding="utf-8") as f:
        json.dump({r.crop: {"category": r.category, "n": r.n} for r in rows}, f)
    return readers.keyed_dimension(spark, at, "crop", "category string, n bigint")


@query("""with i as (select image_id, width, height, image_id % 5 as k from dataset_images where width > 0 and height > 0)
 select image_id, case when k < 3 then width end as width, case when k < 3 then height end as height, case when k < 3 then [3, 1, 4][k + 1] end::integer as channels, case when k < 3 then ['RGB', 'L', 'RGBA'][k + 1] end as color_mode, case k when 3 then 'truncated' when 4 then 'empty' end as corruption_reason, k > 2 as is_corrupted from i""")
def src09_headers(spark, d):
    """Headers of pictures made from the recorded sizes, some cut off or empty."""
    k = F.col("image_id") % 5
    h = lambda c: F.lpad(F.hex(c), 8, "0")
    kind = F.when(k == 0, "02").when(k == 1, "00").otherwise("06")
    png = F.concat(F.lit("89504E470D0A1A0A0000000D49484452"), h("width"), h("height"), F.lit("08"), kind, F.lit("00000000000000"), F.when(k == 3, "").otherwise("0000000049454E44AE426082"))
    i = table(spark, d, "dataset_images").where("width > 0 and height > 0").select("image_id", F.when(k == 4, F.unhex(F.lit(""))).otherwise(F.unhex(png)).alias("content"))
    return readers.image_headers(i, keep=["image_id"]).drop("sha256")


_SOIL = [("leek", [80, 45, 40, 22, 70, 6.5], [8, 5, 4, 2, 6, 0.3]), ("fig", [20, 60, 70, 28, 50, 7.2], [5, 6, 7, 3, 5, 0.4])]


@query("select * from (values ('leek', 500::bigint, true), ('fig', 500::bigint, true)) t(label, n, plausible)")
def src13_soil(spark, d):
    """Generated samples: their number, and means within a tenth of the profiles'."""
    s = readers.soil_samples(spark, _SOIL, per_crop=500)
    near = None
    for i, n in enumerate(["N", "P", "K", "temperature", "humidity", "ph"]):
        want = F.when(F.col("label") == "leek", float(_SOIL[0][1][i])).otherwise(float(_SOIL[1][1][i]))
        ok = F.abs(F.avg(n) - F.max(want)) <= 0.1 * F.max(want)
        near = ok if near is None else near & ok
    return s.groupBy("label").agg(F.count(F.lit(1)).alias("n"), near.alias("plausible"))


@query(f"with {C._IMG} select coalesce(split, 'none') as split, count(*) as n from img group by 1")
def src14_report(spark, d):
    """A report written as one document with its time, and read again as rows."""
    per = C.images(spark, d).groupBy(F.coalesce("split", F.lit("none")).alias("split")).agg(F.count(F.lit(1)).alias("n"))
    at = _folder(spark, "report.json")
    body = sinks.save_json_report(per, at)
    again = readers.read_json_report(at)
    assert again == body and again["timestamp_utc"]
    rows = readers.read_dimension(spark, at, "rows array<struct<split: string, n: bigint>>, timestamp_utc string")
    return rows.select(F.inline("rows"))


_LINE = "'| ' || split || ' | ' || n || ' |'"


@query(f"""with {C._IMG}, g as (select coalesce(split, 'none') as split, count(*) as n from img group by 1), r as (select *, row_number() over (order by split) as i from g)
 select 'markdown' as form, line::integer as line, text from (select 0 as line, '# Splits' as text union all select 2, '## counts' union all select 4, '| split | n |' union all select 5, '|---|---|' union all select 5 + i, {_LINE} from r)
 union all select 'html', (5 + i)::integer, '<tr><td>' || split || '</td><td>' || n || '</td></tr>' from r""")
def snk03_reports(spark, d):
    """The lines of a report as Markdown, and the rows of its table as HTML."""
    per = C.images(spark, d).groupBy(F.coalesce("split", F.lit("none")).alias("split")).agg(F.count(F.lit(1)).alias("n")).orderBy("split")
    text = sinks.markdown_report("Splits", {"counts": per}).split("\n")
    page = sinks.html_report("Splits", {"counts": per}).split("\n")
    rows = [("markdown", i, x) for i, x in enumerate(text) if x] + [("html", i, x) for i, x in enumerate(page) if x.startswith("<tr><td>")]
    return spark.createDataFrame(rows, "form string, line int, text string")


@query(f"with {_CUR}, n as (select count(*) as n from cur) select * from (select 1 as run, 'copied' as status, n from n union all select 2, 'present', n from n union all select 2, 'missing', 1 from n)")
def snk04_copies(spark, d):
    """Label files copied by a manifest, then once more with one that is missing."""
    root = _label_tree(spark, d)
    to = _folder(spark, "copies")
    m = readers.list_files(spark, root).select(F.col("path").alias("source"), F.concat(F.lit(to), F.substring("path", len(root) + 1, 1 << 20)).alias("target"))
    out = None
    for run, manifest in ((1, m), (2, m.unionByName(spark.createDataFrame([(f"{root}/none", f"{to}/none")], "source string, target string")))):
        one = Scratch(spark).write(sinks.copy_files(manifest), "copied").groupBy(F.lit(run).alias("run"), "status").agg(F.count(F.lit(1)).alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


@query(f"with {C._AUD} select coalesce(case when is_corrupted then 'quarantine' when mask_coverage_pct > 90 or mask_coverage_pct < 1 then 'review' end, 'ok') as status, count(*) as n from aud group by 1")
def snk07_quarantine(spark, d):
    """Audits written by status and read back from their folders."""
    a = C.audits(spark, d)
    c = F.col("mask_coverage_pct")
    status = F.coalesce(F.when(F.col("is_corrupted"), "quarantine").when((c > 90) | (c < 1), "review"), F.lit("ok"))
    at = Scratch(spark).path("by_status")
    sinks.write_manifest(a.select("audit_id", status.alias("status")), at, by="status")
    return spark.read.parquet(at).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query(f"with {C._IMG} select image_id, 'missing' as side from img where image_id % 1000 = 7 union all select -1, 'extra' union all select null, 'verified' where true union all select null, 'refused' where exists (select 1 from img)")
def snk09_verified(spark, d):
    """A write verified by its checksum, and the differences of one that was changed."""
    i = C.images(spark, d).select("image_id", "digest")
    at = Scratch(spark).path("good")
    i.write.parquet(at)
    other = Scratch(spark).path("bad")
    i.where("image_id % 1000 <> 7").unionByName(spark.createDataFrame([(-1, "x")], "image_id bigint, digest string")).write.parquet(other)
    signs = [s for s, ok in (("verified", sinks.verify_written(i, at)), ("refused", not sinks.verify_written(i, other))) if ok]
    return sinks.differences(i, other).select("image_id", "side").unionByName(spark.createDataFrame([(None, s) for s in signs], "image_id bigint, side string"))


@query(f"""with {C._IMG}, ok as (select * from img where digest is not null and split is not null), r as (select image_id, row_number() over (partition by split, digest order by image_id) as r from ok)
 select image_id from img where image_id not in (select image_id from r where r > 1)""")
def snk11_survivors(spark, d):
    from frond.operators import dedup

    i = C.images(spark, d).select("image_id", "split", "digest")
    return sinks.without(i, dedup.within_split(i, "digest", "image_id"), "image_id").select("image_id")


@query("select * from (values (1, false, false, 0::bigint), (2, false, true, 30::bigint), (3, true, false, 30::bigint), (4, true, true, 3::bigint)) t(step, there, written, n)")
def snk12_refusals(spark, d):
    """Dry run, write, refusal, and overwrite of one folder."""
    at = Scratch(spark).path("once")
    df = spark.range(30)
    count = lambda: spark.read.parquet(at).count()
    rows = []
    plan = sinks.plan_write(df, at, dry_run=True)
    rows.append((1, plan["exists"], plan["written"], 0))
    plan = sinks.plan_write(df, at)
    rows.append((2, plan["exists"], plan["written"], count()))
    try:
        sinks.plan_write(df, at)
        raise AssertionError("not refused")
    except FileExistsError:
        rows.append((3, True, False, count()))
    plan = sinks.plan_write(spark.range(3), at, overwrite=True)
    rows.append((4, plan["exists"], plan["written"], count()))
    return spark.createDataFrame(rows, "step int, there boolean, written boolean, n bigint")
