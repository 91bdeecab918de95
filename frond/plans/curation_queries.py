"""Queries of the dataset operators over the project's tables, with SQL for each that SQL can express."""

from __future__ import annotations

from pyspark.sql import functions as F

from frond.functions import geometry as G
from frond.functions import keys as K
from frond.functions import labels as L
from frond.functions import text as T
from frond.operators import dedup, pairing, predictions, splits, stats
from frond.operators import select as sel
from frond.operators.skew import hot_of, lookup
from frond.plans.tables import table
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


# ---- shared inputs ----------------------------------------------------------------------------


def images(spark, d):
    """dataset_images with canonical split, source, digest, fingerprint, crop and label file."""
    return table(spark, d, "dataset_images").select(
        "image_id", K.split_name(F.col("split")).alias("split"), F.lower(F.trim("dataset_source")).alias("source"), "filename", "image_path",
        K.digest(F.col("sha256_hash")).alias("digest"), K.fingerprint(F.col("phash")).alias("fp"), F.lower(F.regexp_extract("filename", "^([A-Za-z]+)", 1)).alias("crop"),
        K.file_key(F.col("label_path")).alias("file"), "width", "height", "file_size", F.coalesce("is_corrupted", F.lit(False)).alias("corrupted"),
    )


def audits(spark, d):
    """The latest audit of each audit_id, by aggregate."""
    cols = ["split", "image_path", "filename", "width", "height", "color_mode", "file_size", "is_healthy", "label_exists", "polygon_count", "mask_coverage_pct", "is_corrupted"]
    a = table(spark, d, "audit_images").where("audit_id is not null").groupBy("audit_id").agg(F.max_by(F.struct(*cols, "label_path"), "audited_at").alias("r"))
    return a.select("audit_id", *[f"r.{c}" for c in cols if c != "split"], K.split_name(F.col("r.split")).alias("split"), K.file_key(F.col("r.label_path")).alias("file"))


def diseases(spark, d):
    """Distinct pair_ids with a key of disease_name."""
    return table(spark, d, "raw_pairs").select("pair_id", K.name_key(F.col("disease_name")).alias("disease"), F.coalesce("is_corrupted", F.lit(False)).alias("corrupted")).where("pair_id is not null and disease is not null").distinct()


def views(spark, d):
    """Probability vectors of views: softmax of an embedding's numbers, by label."""
    e = table(spark, d, "embeddings").where("vec_id is not null and size(embedding) > 0")
    return e.select("label", F.col("vec_id").alias("view"), predictions.softmax(F.transform("embedding", lambda v: v.cast("double") * 30)).alias("p"))


_FILE = r"""array_to_string(list_reduce(list_prepend([]::varchar[], list_transform(list_filter(string_split(regexp_replace(replace(replace(regexp_replace(
  regexp_replace(label_path, '^\s+|\s+$', '', 'g'), '^file://', ''), '%20', ' '), '\', '/'), '^/mnt/store/', ''), '/'), lambda s: s <> '' and s <> '.'), lambda x: [x])),
  lambda a, x: case when x[1] = '..' then a[1:len(a) - 1] else list_concat(a, x) end), '/')"""
_KEY = "nullif(trim(regexp_replace(lower({c}), '[^a-z0-9]+', ' ', 'g')), '')"
_SPLIT = "case when lower(trim(split)) in ('train', 'training') then 'train' when lower(trim(split)) in ('val', 'validation') then 'val' when lower(trim(split)) in ('test', 'testing') then 'test' end"
_FP = "regexp_replace(lower(trim(phash)), '^0x', '')"
_IMG = f"""img as (
  select image_id, {_SPLIT} as split, lower(trim(dataset_source)) as source, filename, image_path, nullif(lower(trim(sha256_hash)), '') as digest,
    case when regexp_full_match({_FP}, '0*[0-9a-f]{{1,16}}') then ('0x' || lpad(right({_FP}, 16), 16, '0'))::ubigint end as fp,
    lower(regexp_extract(filename, '^([A-Za-z]+)', 1)) as crop, nullif({_FILE}, '') as file, width, height, file_size, coalesce(is_corrupted, false) as corrupted
  from dataset_images)"""
_AUD = f"""aud as (
  select * exclude (split, r, label_path), {_SPLIT} as split, nullif({_FILE}, '') as file from
  (select *, row_number() over (partition by audit_id order by audited_at desc) as r from audit_images where audit_id is not null) where r = 1)"""
_DIS = f"""dis as (
  select distinct pair_id, {_KEY.format(c='disease_name')} as disease, coalesce(is_corrupted, false) as corrupted from raw_pairs
  where pair_id is not null and {_KEY.format(c='disease_name')} is not null)"""
_RANK = "case split when 'train' then 0 when 'val' then 1 when 'test' then 2 else 3 end"
_LINES = r"""ln as (
  select file_id, i - 1 as line_no, regexp_replace(raw, '^\s+|\s+$', '', 'g') as line from (
    select file_id, unnest(string_split(replace(content, chr(13), ''), chr(10))) as raw, generate_subscripts(string_split(replace(content, chr(13), ''), chr(10)), 1) as i from label_files)
  where regexp_replace(raw, '^\s+|\s+$', '', 'g') <> ''),
tk as (select *, string_split_regex(line, '\s+') as t from ln)"""
_POLY = f"""{_LINES},
poly as (select file_id, line_no, t[1]::integer as class_id, list_transform(t[2:], lambda x: x::double) as v, row_number() over (partition by file_id, line order by line_no) as again from tk)"""
_UNIT = "cast(('0x' || substr(sha256('{s}:' || {c}), 1, 13))::bigint as double) / 4503599627370496.0"
_VIEWS = """vw as (
  select label, vec_id as view, list_transform(embedding, lambda v: v::double * 30) as x from embeddings where vec_id is not null and len(embedding) > 0),
pr as (select label, view, list_transform(list_transform(x, lambda v: exp(v - list_max(x))), lambda v: v / list_sum(list_transform(x, lambda u: exp(u - list_max(x))))) as p from vw),
cf as (select *, list_max(p) as conf, list_position(p, list_max(p)) - 1 as top, count(*) over (partition by label) as n from pr),
pl as (select *, count(*) filter (where conf >= 0.5) over (partition by label) as good, row_number() over (partition by label order by conf desc, view) as place,
  least(n, greatest(3, ceil(n * 0.25))) as least_n from cf),
kept as (select * from pl where case when good < least_n then place <= least_n else conf >= 0.5 end)"""

# ---- duplicates and leakage -------------------------------------------------------------------


@query(f"with {_IMG} select digest, count(*) as n, count(*) - 1 as extra from img where digest is not null group by digest having count(*) > 1")
def agg06_duplicate_groups(spark, d):
    return dedup.duplicate_groups(images(spark, d).select("digest"), "digest")


@query(f"with {_IMG}, g as (select count(*) as n from img where digest is not null group by digest having count(*) > 1) select count(*) as groups, coalesce(sum(n - 1), 0)::bigint as extra_rows, coalesce(sum(n), 0)::bigint as member_rows from g")
def agg06_duplicate_totals(spark, d):
    return dedup.duplicate_totals(images(spark, d).select("digest"), "digest")


@query(f"""with {_IMG}, ok as (select image_id, split, digest from img where digest is not null and split is not null),
 r as (select *, row_number() over (partition by digest order by {_RANK}, image_id) as r from ok)
 select image_id, split, digest, r = 1 as kept from r where digest in (select digest from ok group by digest having count(distinct split) > 1)""")
def agg07_leakage(spark, d):
    return dedup.resolve_leakage(images(spark, d).select("image_id", "split", "digest"), "digest", "image_id")


@query(f"with {_IMG} select printf('%016x', fp) as phash, count(*) as n, count(distinct digest) as digests from img where fp is not null and digest is not null group by fp having count(distinct digest) > 1")
def agg08_equal_fingerprint(spark, d):
    got = dedup.near_by_equal_fingerprint(images(spark, d).select("fp", "digest"), "fp", "digest")
    return got.select(F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("phash"), "n", "digests")


@query(f"""with {_IMG}, r as (select image_id, digest, first_value(image_id) over (partition by digest order by coalesce(split, ''), coalesce(filename, ''), image_id) as f from img where digest is not null)
 select image_id, f as duplicate_of from r where f <> image_id""")
def agg09_duplicate_of(spark, d):
    return dedup.duplicate_of(images(spark, d).select("image_id", "digest", "split", "filename"), "digest", "image_id", [F.coalesce("split", F.lit("")), F.coalesce("filename", F.lit(""))])


_PAIRS = """p(split_a, split_b) as (values ('train', 'val'), ('train', 'test'), ('val', 'test'))"""


@query(f"""with {_IMG}, {_PAIRS}, k as (select distinct digest as k, split from img where digest is not null and split is not null)
 select split_a, split_b, (select count(*) from k a join k b on a.k = b.k where a.split = p.split_a and b.split = p.split_b) as n from p""")
def set01_pairwise_leaks(spark, d):
    return dedup.pairwise_shared(images(spark, d).select("digest", "split"), "digest")


@query(rf"""with {_IMG}, {_PAIRS}, k as (select distinct regexp_replace(filename, '(.)\.[^.]*$', '\1') as k, split from img where filename is not null and split is not null)
 select split_a, split_b, (select count(*) from k a join k b on a.k = b.k where a.split = p.split_a and b.split = p.split_b) as n from p""")
def set02_stem_overlap(spark, d):
    return dedup.pairwise_shared(images(spark, d).select(T.stem(F.col("filename")).alias("stem"), "split"), "stem")


@query(f"""with {_IMG}, r as (select image_id, split, digest, min(image_id) over (partition by split, digest) as f from img where digest is not null and split is not null)
 select image_id, f as duplicate_of from r where f <> image_id""")
def pip11_within_split(spark, d):
    return dedup.within_split(images(spark, d).select("image_id", "split", "digest"), "digest", "image_id")


_COMP = f"""{_IMG}, f as (select distinct fp from img where fp is not null),
 e as (select a.fp as a, b.fp as b from f a join f b on a.fp <> b.fp and bit_count(xor(a.fp, b.fp)) <= 5),
 reach(a, b) as (select fp, fp from f union select r.a, e.b from reach r join e on r.b = e.a),
 least_id as (select fp, min(image_id) as i from img where fp is not null group by fp),
 comp as (select r.a as fp, min(i) as component from reach r join least_id l on l.fp = r.b group by r.a),
 deg as (select a as fp, count(*) as links from e group by a)"""


@query(f"with recursive {_COMP} select image_id, component, coalesce(links, 0) as links from img join comp using (fp) left join deg using (fp)")
def grf01_components(spark, d):
    return dedup.near_components(images(spark, d).select("image_id", "fp"), "image_id", "fp", 5)


@query(f"""with recursive {_IMG}, ok as (select image_id, split, digest, fp from img where split is not null),
 lk as (select digest from ok where digest is not null group by digest having count(distinct split) > 1),
 ex as (select image_id, split, 'exact' as kind, row_number() over (partition by digest order by {_RANK}, image_id) = 1 as kept from ok where digest in (select digest from lk)),
 rest as (select * from ok where image_id not in (select image_id from ex)), f as (select distinct fp from rest where fp is not null),
 e as (select a.fp as a, b.fp as b from f a join f b on a.fp <> b.fp and bit_count(xor(a.fp, b.fp)) <= 5),
 reach(a, b) as (select fp, fp from f union select r.a, e.b from reach r join e on r.b = e.a),
 least_id as (select fp, min(image_id) as i from rest where fp is not null group by fp), comp as (select r.a as fp, min(i) as component from reach r join least_id l on l.fp = r.b group by r.a),
 m as (select image_id, split, component from rest join comp using (fp)), ml as (select component from m group by component having count(distinct split) > 1)
 select image_id, split, kind, kept from ex union all
 select image_id, split, 'near', row_number() over (partition by component order by {_RANK}, image_id) = 1 from m where component in (select component from ml)""")
def grf02_leakage_report(spark, d):
    return dedup.leakage_report(images(spark, d).select("image_id", "digest", "fp", "split"), "image_id", "digest", "fp", "split", 5)


@query(f"""with {_IMG}, {_IMG.replace('img as', 'img2 as')},
 a as (select image_id from (select image_id, digest, row_number() over (partition by digest order by {_RANK}, image_id) as r from img where digest is not null and split is not null) where r > 1
   and digest in (select digest from img where digest is not null and split is not null group by digest having count(distinct split) > 1)),
 b as (select image_id from (select image_id, row_number() over (partition by split, digest order by image_id) as r from img where digest is not null and split is not null) where r > 1)
 select image_id from a union select image_id from b""")
def set06_removals(spark, d):
    i = images(spark, d).select("image_id", "split", "digest")
    a = dedup.resolve_leakage(i, "digest", "image_id").where(~F.col("kept")).select("image_id")
    return a.unionByName(dedup.within_split(i, "digest", "image_id").select("image_id")).distinct()


@query("""with e as (select vec_id, embedding as v, list_reduce(list_prepend(0.0::double, list_transform(embedding, lambda x: x::double)), lambda a, x: a + x) / 64 as m from embeddings where len(embedding) = 64)
 select vec_id, list_aggregate(list_transform(v, lambda x: case when x::double > m then '1' else '0' end), 'string_agg', '') as bits from e""")
def mth10_mean_hash(spark, d):
    e = table(spark, d, "embeddings").where("size(embedding) = 64")
    return e.select("vec_id", F.lpad(F.bin(T.mean_hash(F.transform("embedding", lambda v: v.cast("double")))), 64, "0").alias("bits"))


# ---- pairing ----------------------------------------------------------------------------------


@query(f"""with {_IMG}, x as (select distinct nullif({_FILE}, '') as file from label_files), i as (select distinct file from img where file is not null)
 select coalesce(i.file, x.file) as file, case when i.file is null then 'orphan_label' when x.file is null then 'missing_label' else 'paired' end as status
 from i full outer join (select * from x where file is not null) x on i.file = x.file""")
def jn01_pair_audit(spark, d):
    return pairing.pair_status(images(spark, d).select("file"), table(spark, d, "label_files").select(K.file_key(F.col("label_path")).alias("file")), "file")


@query(f"""with {_IMG}, {_AUD}, i as (select file, min(width) as iw, min(height) as ih from img where file is not null group by file),
 m as (select file, min(width) as mw, min(height) as mh, max(mask_coverage_pct) as c from aud where file is not null group by file)
 select coalesce(i.file, m.file) as file, case when m.file is null then 'missing_mask' when i.file is null then 'orphan_mask'
   when coalesce(iw = mh and ih = mw and not (iw = mw and ih = mh), false) then 'rotated' when not coalesce(iw = mw and ih = mh, false) then 'size_mismatch'
   when coalesce(c <= 0, false) then 'empty_mask' else 'ok' end as status from i full outer join m on i.file = m.file""")
def jn02_mask_audit(spark, d):
    one = lambda df, *x: df.where("file is not null").groupBy("file").agg(F.min("width").alias("w"), F.min("height").alias("h"), *x)
    return pairing.mask_status(one(images(spark, d)), one(audits(spark, d), F.max("mask_coverage_pct").alias("coverage")), "file")


@query(f"with {_IMG}, {_AUD}, a as (select distinct file from aud where file is not null) select image_id, a.file is not null as audited from img left join a using (file)")
def jn03_audited(spark, d):
    a = audits(spark, d).where("file is not null").groupBy("file").agg(F.lit(True).alias("a"))
    return images(spark, d).select("image_id", "file").join(a, "file", "left").select("image_id", F.coalesce("a", F.lit(False)).alias("audited"))


@query(f"with {_IMG} select file_id from label_files where nullif({_FILE}, '') is null or nullif({_FILE}, '') not in (select file from img where file is not null)")
def jn04_unreferenced(spark, d):
    x = table(spark, d, "label_files").select("file_id", K.file_key(F.col("label_path")).alias("file"))
    return x.join(images(spark, d).select("file").where("file is not null").distinct(), "file", "left_anti").select("file_id")


@query(f"with {_IMG}, {_AUD}, f as (select image_path, min(image_id) as image_id from img where image_path is not null group by image_path) select audit_id, f.image_id from aud join f using (image_path)")
def jn05_first_match(spark, d):
    got = pairing.first_match(audits(spark, d).select("audit_id", "image_path"), images(spark, d).select("image_path", "image_id"), "image_path", F.col("image_id"), ["image_id"])
    return got.select("audit_id", "image_id")


@query(f"with {_AUD} select audit_id from aud where file in (select nullif({_FILE}, '') from label_files)")
def jn06_with_label(spark, d):
    x = table(spark, d, "label_files").select(K.file_key(F.col("label_path")).alias("file")).distinct()
    return audits(spark, d).select("audit_id", "file").join(x, "file", "left_semi").select("audit_id")


@query(f"""with {_IMG}, {_POLY}, i as (select distinct file, split from img where file is not null and split is not null),
 x as (select file_id, nullif({_FILE}, '') as file from label_files)
 select split, class_id, count(*) as n from i join x using (file) join poly using (file_id) group by split, class_id""")
def jn07_objects_by_split(spark, d):
    lf = table(spark, d, "label_files")
    i = images(spark, d).select("file", "split").where("file is not null and split is not null").distinct()
    x = lf.select("file_id", K.file_key(F.col("label_path")).alias("file"))
    ln = L.lines(lf).select("file_id", F.get(L.tokens(F.col("line")), F.lit(0)).try_cast("int").alias("class_id"))
    return i.join(x, "file").join(ln, "file_id").groupBy("split", "class_id").agg(F.count(F.lit(1)).alias("n"))


@query(f"""with r as (select distinct rec_id, {_KEY.format(c='category')} as k from crop_recommendations),
 t as (select {_KEY.format(c='key_value')} as k, min(target_id) as target from sample_targets where field_name = 'category' group by 1)
 select coalesce(k, 'unknown') as category, coalesce(target, -1) as target, count(*) as n from r left join t using (k) group by all""")
def jn08_lookup_default(spark, d):
    r = table(spark, d, "crop_recommendations").select("rec_id", K.name_key(F.col("category")).alias("k")).distinct()
    t = table(spark, d, "sample_targets").where("field_name = 'category'").groupBy(K.name_key(F.col("key_value")).alias("k")).agg(F.min("target_id").alias("target"))
    got = pairing.with_default(r, t, "k", "target", F.lit(-1).cast("bigint"))
    return got.groupBy(F.coalesce("k", F.lit("unknown")).alias("category"), "target").agg(F.count(F.lit(1)).alias("n"))


def _classes(names):
    """SRC-03: ids from sorted names; the names of a label set are few."""
    from pyspark.sql import Window as W

    return names.select("class_name").where("class_name is not null and class_name <> ''").distinct().withColumn("class_id", (F.row_number().over(W.partitionBy(F.lit(1)).orderBy("class_name")) - 1).cast("int"))


_CLS = f"""{_IMG}, cb as (select class_name, (row_number() over (order by class_name) - 1)::integer as class_id from (select distinct crop as class_name from img where source = 'baseline' and crop <> '')),
 cn as (select class_name, (row_number() over (order by class_name) - 1)::integer as class_id from (select distinct crop as class_name from img where source = 'new' and crop <> ''))"""


def _class_lists(spark, d):
    i = images(spark, d)
    return [_classes(i.where(F.col("source") == s).select(F.col("crop").alias("class_name"))) for s in ("baseline", "new")]


@query(f"with {_CLS} select class_name, class_id from cb")
def src03_class_ids(spark, d):
    return _class_lists(spark, d)[0].select("class_name", "class_id")


@query(f"""with {_CLS}, j as (select coalesce(b.class_name, n.class_name) as class_name, b.class_id as base_id, n.class_id as new_id from cb b full outer join cn n on b.class_name = n.class_name)
 select class_name, base_id, new_id, coalesce(base_id, (select coalesce(max(class_id), -1) from cb) + row_number() over (partition by base_id is null order by new_id))::integer as merged_id from j""")
def jn12_class_alignment(spark, d):
    return pairing.align_classes(*_class_lists(spark, d))


@query(f"with {_CLS} select count(*) as classes, coalesce(bool_and(b.class_name is not distinct from n.class_name), true) as compatible from cb b left join cn n using (class_id)")
def jn16_compatible(spark, d):
    return pairing.compatible(*_class_lists(spark, d))


@query(f"""with {_IMG}, b as (select * from img where source = 'baseline'), n as (select * from img where source = 'new'),
 f as (select *, row_number() over (partition by digest order by filename, image_id) as r from n where digest is not null and digest not in (select digest from b where digest is not null))
 select image_id, digest, 'baseline' as dataset_source from b union all select image_id, digest, 'new' from f where r = 1 union all select image_id, digest, 'new' from n where digest is null""")
def jn13_merge(spark, d):
    i = images(spark, d).select("image_id", "digest", "filename", "source")
    got = pairing.merge_versions(i.where("source = 'baseline'"), i.where("source = 'new'"), "digest", "image_id", F.col("filename"))
    return got.select("image_id", "digest", "dataset_source")


@query(f"with {_IMG} select filename, count(image_id) as n from img where filename is not null group by filename having count(image_id) > 1")
def q16_name_collisions(spark, d):
    return pairing.name_collisions(images(spark, d), "filename", "image_id")


@query(f"""with {_IMG}, m as (select nullif(lower(trim(sha256_hash)), '') as digest, min({_KEY.format(c='disease_name')}) as disease from raw_pairs group by 1)
 select image_id, coalesce(disease, crop) as disease from img left join m using (digest)""")
def jn15_disease_or_crop(spark, d):
    m = table(spark, d, "raw_pairs").select(K.digest(F.col("sha256_hash")).alias("digest"), K.name_key(F.col("disease_name")).alias("disease")).where("digest is not null")
    m = m.groupBy("digest").agg(F.min("disease").alias("disease"))
    i = images(spark, d).select("image_id", "digest", "crop")
    return lookup(i, m, "digest", hot_of(i, "digest"), "left").select("image_id", F.coalesce("disease", "crop").alias("disease"))


# ---- distributions and scores -----------------------------------------------------------------


@query(f"""with {_IMG}, c as (select distinct crop from img where crop <> ''), s(split) as (values ('train'), ('val'), ('test'))
 select crop, split, (select count(*) from img i where i.crop = c.crop and i.split = s.split) as n from c, s""")
def agg01_class_counts(spark, d):
    i = images(spark, d).select("crop", "split")
    return stats.count_by_class(i, "crop", "split", i.where("crop <> ''").select("crop").distinct())


@query(f"with {_IMG} select crop, count(*) filter (split = 'train') as train, count(*) filter (split = 'val') as val, count(*) filter (split = 'test') as test, count(*) as total from img where split is not null group by crop")
def agg02_class_by_split(spark, d):
    return stats.class_by_split(images(spark, d).select("crop", "split"), "crop", "split")


@query(f"""with {_AUD} select coalesce(split, 'none') as split, count(width) as n, coalesce(min(width)::double, 0) as low, coalesce(max(width)::double, 0) as high, round(coalesce(avg(width), 0), 6) as mean,
 coalesce(median(width), 0) as middle, round(coalesce(stddev_pop(width), 0), 3) as deviation from aud group by all""")
def agg03_width_profile(spark, d):
    got = stats.profile(audits(spark, d).select(F.coalesce("split", F.lit("none")).alias("split"), "width"), ["split"], F.col("width"))
    return got.withColumn("mean", F.round("mean", 6)).withColumn("deviation", F.round("deviation", 3))


@query(f"""with {_AUD} select count(*) filter (where is_corrupted) as corrupted, count(*) filter (where not label_exists) as unlabelled, count(*) filter (where is_healthy and polygon_count > 0) as healthy_violations,
 count(*) filter (where color_mode <> 'RGB') as not_rgb, count(*) filter (where width < height) as upright from aud""")
def agg04_conditions(spark, d):
    c = F.col
    return stats.conditional_counts(audits(spark, d), {"corrupted": c("is_corrupted"), "unlabelled": ~c("label_exists"), "healthy_violations": c("is_healthy") & (c("polygon_count") > 0), "not_rgb": c("color_mode") != "RGB", "upright": c("width") < c("height")})


@query(f"with {_IMG} select crop, string_agg(distinct split, ',' order by split) as values from img where split is not null group by crop")
def agg05_splits_of_crop(spark, d):
    return stats.distinct_lists(images(spark, d), "crop", "split")


@query(f"""with {_DIS}, n as (select disease, count(*) as n from dis group by disease), t as (select max(n) as hi, min(n) as lo, avg(n) as mean, sum(n) as total from n)
 select disease, n, round(hi / lo, 2) as ratio, round(100.0 * n / total, 4) as share, n < 0.25 * mean as below_quarter, n < 0.1 * mean as below_tenth from n, t""")
def agg10_balance(spark, d):
    return stats.balance(diseases(spark, d).groupBy("disease").agg(F.count(F.lit(1)).alias("n")), "disease")


@query(f"""with {_DIS} select disease, count(*) as n, case when count(*) >= 100 then 'GOOD' when count(*) >= 30 then 'WARNING' else 'CRITICAL' end as health,
 case when count(*) >= 80 then 'Excellent' when count(*) >= 50 then 'Good' when count(*) >= 20 then 'Fair' else 'Poor' end as rating from dis group by disease""")
def prj07_class_health(spark, d):
    n = diseases(spark, d).groupBy("disease").agg(F.count(F.lit(1)).alias("n"))
    return n.select("disease", "n", stats.class_health(F.col("n")).alias("health"), stats.class_rating(F.col("n")).alias("rating"))


_BUCKET = "case when mask_coverage_pct is null or isnan(mask_coverage_pct) then null when mask_coverage_pct <= 0 then 'empty' when mask_coverage_pct < 1 then '<1' when mask_coverage_pct < 5 then '1-5' when mask_coverage_pct < 20 then '5-20' when mask_coverage_pct <= 50 then '20-50' else '>50' end"


@query(f"with {_AUD} select {_BUCKET} as bucket, count(*) as n from aud group by 1")
def prj06_coverage(spark, d):
    return audits(spark, d).groupBy(stats.coverage_bucket(F.col("mask_coverage_pct")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query(f"with {_AUD} select count(*) filter (where mask_coverage_pct < 0.2) as is_tiny, count(*) filter (where mask_coverage_pct > 98.5) as is_huge, count(*) filter (where mask_coverage_pct > 90 or mask_coverage_pct < 1) as is_abnormal from aud where not isnan(mask_coverage_pct)")
def prj05_mask_flags(spark, d):
    a = audits(spark, d).where(~F.isnan("mask_coverage_pct"))
    return stats.conditional_counts(a, stats.mask_flags(F.col("mask_coverage_pct")))


@query(f"""with {_IMG}, g as (select crop, count(*) filter (split = 'train') as train, count(*) filter (split in ('val', 'test')) as held_out from img group by crop)
 select crop, train, held_out, case when train = 0 then 'absent' else 'rare' end as problem from g where held_out > 0 and train < 40""")
def agg18_missing_in_train(spark, d):
    return stats.missing_in_train(images(spark, d).select("crop", "split"), "crop", "split", low=40)


@query(f"""with {_POLY}, k as (select class_id, file_id, count(*) as k from poly group by all)
 select class_id, count(*) as images, count(*) filter (k = 1) as single, count(*) filter (k > 1) as multiple, count(*) filter (k > 5) as crowded, count(*) filter (k <= 5) as simple from k group by class_id""")
def agg20_objects(spark, d):
    return stats.objects_per_image(_objects(spark, d), "file_id", "class_id")


def _objects(spark, d):
    ln = L.lines(table(spark, d, "label_files"))
    return ln.select("file_id", "line", F.get(L.tokens(F.col("line")), F.lit(0)).try_cast("int").alias("class_id"))


@query(f"with {_POLY} select file_id, count(*) as boxes, count(distinct class_id) as classes from poly group by file_id")
def agg22_label_contents(spark, d):
    return stats.label_contents(_objects(spark, d), "file_id", "class_id")


@query(f"with {_LINES}, k as (select file_id, count(*) as k from ln group by file_id, line) select file_id, sum(k - 1)::bigint as repeated from k group by file_id having sum(k - 1) > 0")
def agg17_repeated_lines(spark, d):
    return stats.repeated_in_group(_objects(spark, d), "file_id", "line")


@query("""select 'audits' as name, (select count(distinct audit_id) from audit_images) as left_n, (select count(*) from dataset_images) as right_n,
 (select count(distinct audit_id) from audit_images) = (select count(*) from dataset_images) as holds
 union all select 'labels', (select count(*) from label_files), (select count(*) from dataset_images), (select count(*) from label_files) = (select count(*) from dataset_images)""")
def agg19_reconcile(spark, d):
    i = table(spark, d, "dataset_images")
    return stats.reconcile({"audits": (table(spark, d, "audit_images").select("audit_id").where("audit_id is not null").distinct(), i), "labels": (table(spark, d, "label_files"), i)})


@query(f"with {_POLY}, c as (select distinct class_id as c from poly) select count(*) as n, min(c) as least, max(c) as most, coalesce(min(c) = 0 and max(c) = count(*) - 1, false) as contiguous from c")
def set05_contiguous_ids(spark, d):
    return stats.contiguous(_objects(spark, d), "class_id")


_AREA = "abs(list_sum(list_transform(range(1, len(v) // 2 + 1), lambda i: v[2 * i - 1] * v[2 * (i % (len(v) // 2)) + 2] - v[2 * (i % (len(v) // 2)) + 1] * v[2 * i]))) / 2"
_X = lambda i: f"v[2 * ({i}) + 1]"
_Y = lambda i: f"v[2 * ({i}) + 2]"


def _ccw(a, b, c):
    return f"(({_Y(c)} - {_Y(a)}) * ({_X(b)} - {_X(a)}) > ({_Y(b)} - {_Y(a)}) * ({_X(c)} - {_X(a)}))"


_I1, _J1 = "(e.i + 1) % e.n", "(f.i + 1) % e.n"
_CROSS = f"""eg as (select file_id, line_no, v, (len(v) // 2)::bigint as n, unnest(range(0, len(v) // 2)) as i from poly),
 crossing as (select distinct e.file_id, e.line_no from eg e join eg f on e.file_id = f.file_id and e.line_no = f.line_no and f.i >= e.i + 2 and not (e.i = 0 and f.i = e.n - 1) and e.n >= 4
   where {_ccw('e.i', 'f.i', _J1)} <> {_ccw(_I1, 'f.i', _J1)} and {_ccw('e.i', _I1, 'f.i')} <> {_ccw('e.i', _I1, _J1)})""".replace(" v[", " e.v[").replace("(v[", "(e.v[").replace("((v[", "((e.v[")


@query(f"""with {_POLY}, {_CROSS}, a as (select *, {_AREA} as area from poly)
 select a.file_id, a.line_no::integer as line_no, case when again > 1 then 'duplicate_line' when len(v) % 2 = 1 or len(v) < 6 then 'malformed' when len(list_filter(v, lambda x: x < 0 or x > 1)) > 0 then 'out_of_bounds'
   when c.file_id is not null then 'self_intersecting' when area <= 0.00001 then 'no_area' else 'OK' end as reason
 from a left join crossing c on a.file_id = c.file_id and a.line_no = c.line_no""")
def prj09_polygon_audit(spark, d):
    return L.audit_polygons(table(spark, d, "label_files").select("file_id", "content")).select("file_id", "line_no", "reason")


@query(f"with {_POLY} select file_id, line_no::integer as line_no, (len(v) // 2)::integer as points, round({_AREA}, 6) as area from poly")
def arr02_areas(spark, d):
    p = _polygons(spark, d)
    return p.select("file_id", "line_no", F.size("p").alias("points"), F.round(G.area(F.col("p")), 6).alias("area"))


def _polygons(spark, d):
    ln = L.lines(table(spark, d, "label_files"))
    return ln.select("file_id", "line_no", G.to_points(F.transform(F.slice(L.tokens(F.col("line")), 2, 1 << 30), lambda t: t.try_cast("double"))).alias("p"))


_XS = "list_transform(range(0, len(v) // 2), lambda i: v[2 * i + 1])"
_YS = "list_transform(range(0, len(v) // 2), lambda i: v[2 * i + 2])"


@query(f"with {_POLY} select file_id, line_no::integer as line_no, list_min({_XS}) as x, list_min({_YS}) as y, round(list_max({_XS}) - list_min({_XS}), 6) as w, round(list_max({_YS}) - list_min({_YS}), 6) as h from poly")
def arr04_boxes(spark, d):
    b = _polygons(spark, d).withColumn("b", G.bbox(F.col("p")))
    return b.select("file_id", "line_no", F.col("b.x").alias("x"), F.col("b.y").alias("y"), F.round("b.w", 6).alias("w"), F.round("b.h", 6).alias("h"))


def _signed(v="v"):
    return _AREA.replace("abs(", "(", 1)


@query(f"with {_POLY} select file_id, line_no::integer as line_no, {_signed()} < 0 as turned from poly")
def arr09_orientation(spark, d):
    return _polygons(spark, d).select("file_id", "line_no", (G.signed_area(F.col("p")) < 0).alias("turned"))


def _status_sql():
    rules = {"strict_odd7": ("len(t) < 7", "len(t) % 2 = 0", "null"), "loose7": ("len(t) < 7", "false", "'empty'"), "min3": ("len(t) < 3", "false", "null"), "box5": ("len(t) <> 5", "false", "null")}
    parts = []
    for name, (count, odd, empty) in rules.items():
        why = f"case when {count} then 'token_count' when {odd} then 'odd_coordinates' when len(list_filter(t[2:], lambda x: x::double < 0 or x::double > 1)) > 0 then 'out_of_bounds' end"
        parts.append(f"select '{name}' as rule, coalesce(w, case when n is null then {empty} end, 'valid') as reason, count(*) as files from label_files l left join (select file_id, count(*) as n, arg_min({why}, line_no) filter (where {why} is not null) as w from tk group by file_id) s using (file_id) group by all")
    return f"with {_LINES} " + " union all ".join(parts)


@query(_status_sql())
def prj14_label_rules(spark, d):
    files = table(spark, d, "label_files").select("file_id", "content")
    out = None
    for rule in ("strict_odd7", "loose7", "min3", "box5"):
        one = L.label_status(files, rule).groupBy(F.lit(rule).alias("rule"), F.coalesce("reason", F.lit("valid")).alias("reason")).agg(F.count(F.lit(1)).alias("files"))
        out = one if out is None else out.unionByName(one)
    return out


@query(f"""with {_POLY}, k as (select file_id, max((class_id not in (0, 1, 2))::integer) as d, max((class_id in (0, 1, 2))::integer) as h from poly group by file_id)
 select file_id, case when d = 1 then 'disease' when h = 1 then 'healthy' else 'unknown' end as kind from label_files left join k using (file_id)""")
def prj13_image_kind(spark, d):
    return L.image_kind(_objects(spark, d), table(spark, d, "label_files"), [0, 1, 2])


def _class_map(spark):
    return spark.range(60).where("id % 5 <> 0").select(F.col("id").cast("int").alias("class_id"), (F.col("id") - F.floor(F.col("id") / 5) - 1).cast("int").alias("new_id"))


@query(f"with {_POLY} select class_id, case when class_id % 5 <> 0 then class_id - class_id // 5 - 1 end as new_id, count(*) as n from poly group by all")
def prj10_remap_flagged(spark, d):
    return L.remap_lines(_objects(spark, d), _class_map(spark), "flag").groupBy("class_id", "new_id").agg(F.count(F.lit(1)).alias("n"))


@query(f"with {_POLY} select case when class_id % 5 <> 0 then class_id - class_id // 5 - 1 end as new_id, count(*) as n from poly where class_id % 5 <> 0 group by all")
def prj10_remap_dropped(spark, d):
    return L.remap_lines(_objects(spark, d), _class_map(spark), "drop").groupBy("new_id").agg(F.count(F.lit(1)).alias("n"))


@query(f"with {_POLY} select file_id, string_agg(class_id || ' ' || array_to_string(list_transform(v, lambda x: printf('%.6f', x)), ' '), chr(10) order by line_no) as content from poly group by file_id")
def snk05_label_text(spark, d):
    lf = table(spark, d, "label_files")
    p = _polygons(spark, d).join(L.lines(lf).select("file_id", "line_no", F.get(L.tokens(F.col("line")), F.lit(0)).try_cast("int").alias("class_id")), ["file_id", "line_no"])
    rows = p.select("file_id", F.struct("line_no", L.format_line(F.col("class_id"), F.col("p")).alias("t")).alias("x"))
    return rows.groupBy("file_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["t"]), "\n").alias("content"))


@query(f"""with {_IMG}, {_AUD}, {_POLY}, {_CROSS}, a as (select *, {_AREA} as area from poly),
 i as (select count(*) as total, count(*) filter (where is_corrupted) as corrupt, count(*) filter (where not label_exists) as missing, count(*) filter (where is_healthy and polygon_count > 0) as viol from aud),
 p as (select count(*) filter (where again > 1 or len(v) % 2 = 1 or len(v) < 6 or len(list_filter(v, lambda x: x < 0 or x > 1)) > 0 or c.file_id is not null or area <= 0.00001) as invalid from a left join crossing c on a.file_id = c.file_id and a.line_no = c.line_no),
 h as (select digest, bool_or(split = 'train') as a, bool_or(split = 'val') as b, bool_or(split = 'test') as c from img where digest is not null and split is not null group by digest),
 l as (select count(*) filter (where a and b) + count(*) filter (where a and c) + count(*) filter (where b and c) as leaks from h),
 n as (select count(*) as n from a left join crossing c on a.file_id = c.file_id and a.line_no = c.line_no
   where again = 1 and len(v) % 2 = 0 and len(v) >= 6 and len(list_filter(v, lambda x: x < 0 or x > 1)) = 0 and c.file_id is null and area > 0.00001 group by class_id),
 r as (select coalesce(round(max(n) / min(n), 2), 1.0) as ratio from n),
 s as (select total, 100.0 as structure, 100 - least(50.0, corrupt * 10.0) as image, 100 - least(30.0, missing * 5.0) - least(50.0, viol * 15.0) as label, 100 - least(40.0, invalid * 3.0) as polygon, 100 - least(60.0, leaks * 15.0) as split,
   case when ratio > 5 then 100 - least(25.0, (ratio - 5) * 2.0) else 100.0 end as balance, corrupt, leaks, invalid, viol from i, p, l, r)
 select total, structure::double as structure, image::double as image, label::double as label, polygon::double as polygon, split::double as split, balance::double as balance,
   round(structure * 0.15 + image * 0.2 + label * 0.25 + polygon * 0.2 + split * 0.1 + balance * 0.1, 1)::double as overall, corrupt = 0 and leaks = 0 and invalid = 0 and viol = 0 and round(structure * 0.15 + image * 0.2 + label * 0.25 + polygon * 0.2 + split * 0.1 + balance * 0.1, 1) >= 80 as ready from s""")
def agg11_quality(spark, d):
    polys = L.audit_polygons(table(spark, d, "label_files").select("file_id", "content"))
    polys = Scratch(spark).write(polys.select("class_id", "reason"), "polygons")
    return stats.quality_score(audits(spark, d), polys, dedup.pairwise_shared(images(spark, d), "digest"), stats.imbalance(polys, "class_id"))


# ---- order, splits and samples ----------------------------------------------------------------


@query(f"""with {_DIS}, u as (select distinct pair_id, disease from dis), r as (select *, row_number() over (partition by disease order by {_UNIT.format(s=42, c='pair_id')}, pair_id) as r, count(*) over (partition by disease) as n from u)
 select pair_id, disease, case when r <= floor(n * 0.8) then 'train' when r <= floor(n * 0.8) + floor(n * 0.1) then 'val' else 'test' end as split from r""")
def wn03_stratified_split(spark, d):
    return splits.stratified_split(diseases(spark, d).select("pair_id", "disease").distinct(), "disease", "pair_id")


@query(f"""with {_DIS}, u as (select distinct pair_id, disease from dis), r as (select *, row_number() over (partition by disease order by {_UNIT.format(s=42, c='pair_id')}, pair_id) as place from u) select pair_id, disease, place from r where place <= 5""")
def top08_class_samples(spark, d):
    got = splits.seeded_sample(diseases(spark, d).select("pair_id", "disease").distinct(), "disease", "pair_id", 5)
    return got.select("pair_id", "disease", F.col("place").cast("bigint").alias("place"))


@query("select rec_id, row_number() over (order by requested_at, rec_id) as number from (select distinct rec_id, requested_at from crop_recommendations)")
def wn02_renumber(spark, d):
    r = table(spark, d, "crop_recommendations").select("rec_id", "requested_at").distinct()
    return splits.renumber(r, ["requested_at", "rec_id"], "number").select("rec_id", "number")


@query(r"""with r as (select image_id, filename, row_number() over (partition by filename order by image_id) - 1 as m, count(*) over (partition by filename) as n from dataset_images where filename is not null),
 names as (select distinct filename as f from r), dots as (select f, regexp_replace(f, '\.[^.]*$', '') as stem, regexp_extract(f, '(\.[^.]*)$', 1) as suffix from names),
 taken as (select regexp_replace(stem, '_[0-9]+$', '') || suffix as owner, list(regexp_extract(stem, '_([0-9]+)$', 1)::bigint) as ks from dots where regexp_matches(stem, '_([0-9]{3}|[1-9][0-9]{3,17})$') group by 1),
 k as (select r.*, case when ks is null then m else list_filter(range(1, n + len(ks) + 1), lambda x: not list_contains(ks, x))[m] end as k from r left join taken t on t.owner = r.filename)
 select image_id, case when m = 0 then filename else regexp_replace(filename, '\.[^.]*$', '') || '_' || case when k < 1000 then lpad(k::varchar, 3, '0') else k::varchar end || regexp_extract(filename, '(\.[^.]*)$', 1) end as new_name from k""")
def prj08_collision_names(spark, d):
    i = table(spark, d, "dataset_images").select("image_id", "filename")
    return splits.collision_names(i, "filename", ["image_id"]).select("image_id", "new_name")


@query(f"""with {_IMG}, r as (select image_id || '|' || coalesce(digest, '') as t, row_number() over (order by image_id, digest) - 1 as n from img),
 c as (select n // 100000 as c, sha256(string_agg(t, chr(10) order by n)) as h from r group by 1) select sha256(string_agg(h, chr(10) order by c)) as sha256 from c""")
def agg12_fingerprint(spark, d):
    return splits.fingerprint_ordered(images(spark, d).select("image_id", "digest"), ["image_id", "digest"])


@query(f"""with {_IMG}, h as (select sha256(image_id || '|' || coalesce(digest, '~')) as h from img)
 select count(*) as rows, sum(('0x' || substr(h, 1, 8))::bigint)::bigint as low, sum(('0x' || substr(h, 9, 8))::bigint)::bigint as high from h""")
def agg12_multiset(spark, d):
    return splits.fingerprint_multiset(images(spark, d), ["image_id", "digest"])


@query(f"""with {_IMG}, ok as (select crop, image_id, file_size from img where file_size is not null and crop <> ''), m as (select crop, median(file_size) as m from ok group by crop),
 r as (select crop, image_id, row_number() over (partition by crop order by abs(file_size - m), image_id) as r from ok join m using (crop)) select crop, image_id from r where r = 1""")
def wn05_nearest_median(spark, d):
    return stats.nearest_to_median(images(spark, d).where("crop <> ''").select("crop", "image_id", "file_size"), "crop", "image_id", "file_size")


@query("""with g as (select label, count(*) as n from embeddings group by label) select label, array_to_string(list_distinct_sorted, ',') as places from (
 select label, list_sort(list_distinct(list_transform(range(0, 7), lambda i: floor(case when i = 6 then n - 1 else i * ((n - 1) / 6) end)::integer))) as list_distinct_sorted from g)""")
def wn08_evenly_spaced(spark, d):
    g = table(spark, d, "embeddings").groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return g.select("label", F.array_join(splits.evenly_spaced(F.col("n"), F.lit(7)), ",").alias("places"))


@query("""with r as (select distinct rec_id, request_id, crop, round(confidence / 100 * 100, 2) as confidence from crop_recommendations where confidence is not null and not isnan(confidence) and request_id is not null),
 p as (select *, row_number() over (partition by request_id order by confidence desc, rec_id, crop) as place from r) select request_id, crop, confidence, place::integer as place from p where place <= 3""")
def top01_top3(spark, d):
    return predictions.top_items(_scores(spark, d), "request_id", "crop", F.col("prob"), F.col("rec_id"))


def _scores(spark, d):
    r = table(spark, d, "crop_recommendations").where("request_id is not null")
    return r.select("rec_id", "request_id", "crop", K.name_key(F.col("category")).alias("k"), (F.col("confidence") / 100).alias("prob")).distinct()


@query(f"""with r as (select distinct rec_id, request_id, crop, {_KEY.format(c='category')} as k, round(confidence / 100 * 100, 2) as confidence from crop_recommendations where confidence between 0 and 100 and request_id is not null),
 p as (select *, row_number() over (partition by request_id order by confidence desc, rec_id, crop) as place from r where k = 'vegetable') select request_id, crop, confidence, place::integer as place from p where place <= 3""")
def prj03_filtered_top3(spark, d):
    return predictions.top_items(_scores(spark, d), "request_id", "crop", F.col("prob"), F.col("rec_id"), where=(F.col("k") == "vegetable") & F.col("prob").between(0, 1))


@query(f"with {_AUD} select audit_id, mask_coverage_pct from aud where mask_coverage_pct is not null and not isnan(mask_coverage_pct) order by mask_coverage_pct desc, audit_id limit 50")
def top03_largest_masks(spark, d):
    a = audits(spark, d).where("mask_coverage_pct is not null and not isnan(mask_coverage_pct)")
    return a.select("audit_id", "mask_coverage_pct").orderBy(F.desc("mask_coverage_pct"), "audit_id").limit(50)


@query(f"with {_IMG}, r as (select split, image_id, row_number() over (partition by split order by image_id) as r from img where split is not null) select split, string_agg(image_id::varchar, ',' order by image_id) as first_ids from r where r <= 10 group by split")
def top05_first_ten(spark, d):
    w = predictions.W.partitionBy("split").orderBy("image_id")
    r = images(spark, d).where("split is not null").select("split", "image_id").withColumn("r", F.row_number().over(w)).where("r <= 10")
    return r.groupBy("split").agg(F.array_join(F.transform(F.array_sort(F.collect_list("image_id")), lambda i: i.cast("string")), ",").alias("first_ids"))


@query(f"with {_DIS}, n as (select disease, count(*) as n from dis group by disease) (select 'top' as side, disease, n from n order by n desc, disease limit 5) union all select 'under', disease, n from n where n < 20")
def top06_extremes(spark, d):
    n = diseases(spark, d).groupBy("disease").agg(F.count(F.lit(1)).alias("n"))
    top = n.orderBy(F.desc("n"), "disease").limit(5).select(F.lit("top").alias("side"), "disease", "n")
    return top.unionByName(n.where("n < 20").select(F.lit("under").alias("side"), "disease", "n"))


# ---- votes and lookup -------------------------------------------------------------------------


@query(f"with {_VIEWS} select label, view from kept")
def top12_kept_views(spark, d):
    return predictions.keep_views(views(spark, d), "label", "view", "p").select("label", "view")


@query(f"""with {_VIEWS}, x as (select label, conf, unnest(p) as q, unnest(range(0, len(p)))::integer as c from kept), w as (select label, c, sum(q * conf) / sum(conf) as w from x group by all),
 b as (select label, c, w, row_number() over (partition by label order by w desc, c) as r from w)
 select k.label, c as final_class, round(w, 9) as weight, count(*) as used, round(avg((top = c)::int), 9) as agreement from kept k join b on k.label = b.label and r = 1 group by k.label, c, w""")
def agg13_weighted_vote(spark, d):
    kept = predictions.keep_views(views(spark, d), "label", "view", "p")
    w = predictions.weighted_vote(kept, "label", "p").withColumnRenamed("class_id", "final_class")
    got = predictions.decide(kept, "label", "p").join(w, ["label", "final_class"])
    return got.select("label", "final_class", F.round("weight", 9).alias("weight"), "used", F.round("agreement", 9).alias("agreement"))


@query(f"with {_VIEWS}, v as (select label, top::integer as class_id, count(*) as votes, avg(conf) as c from kept group by label, top) select label, class_id, votes, round(votes / sum(votes) over (partition by label), 9) as ratio, round(c, 9) as mean_confidence, votes / sum(votes) over (partition by label) >= 0.25 as issue from v")
def agg14_vote_shares(spark, d):
    got = predictions.vote_shares(predictions.keep_views(views(spark, d), "label", "view", "p"), "label", "p")
    return got.select("label", "class_id", "votes", F.round("ratio", 9).alias("ratio"), F.round("mean_confidence", 9).alias("mean_confidence"), "issue")


@query(f"""with {_VIEWS}, x as (select label, conf, unnest(p) as q, unnest(range(0, len(p)))::integer as c from kept), w as (select label, c, sum(q * conf) / sum(conf) as w from x group by all),
 b as (select label, c, row_number() over (partition by label order by w desc, c) as r from w) select label, c as class_id, r::integer as place from b where r <= 3""")
def top02_top_classes(spark, d):
    w = predictions.weighted_vote(predictions.keep_views(views(spark, d), "label", "view", "p"), "label", "p")
    place = F.row_number().over(predictions.W.partitionBy("label").orderBy(F.desc("weight"), "class_id"))
    return w.withColumn("place", place).where("place <= 3").select("label", "class_id", "place")


#: Entries of the lookup query: species, disease, ordinal.
ENTRIES = [("leek", "ash mildew", 1), ("leek", "ash", 2), ("fig", "glass spot", 3), ("quince", "silver", 4), ("taro", "corky vein", 5), ("taro", "corky", 6), ("fennel", "thread", 7), ("millet", "pale rust", 8), ("zucchini", "ring scorch", 9)]


@query(r"""with n as (select distinct disease_name as class_name from raw_pairs),
 e(species, disease, ordinal) as (values ('leek', 'ash_mildew', 1), ('leek', 'ash', 2), ('fig', 'glass_spot', 3), ('quince', 'silver', 4), ('taro', 'corky_vein', 5), ('taro', 'corky', 6), ('fennel', 'thread', 7), ('millet', 'pale_rust', 8), ('zucchini', 'ring_scorch', 9)),
 q as (select class_name, case when contains(class_name, '___') then strpos(class_name, '___') else strpos(class_name, '_') end as pos, case when contains(class_name, '___') then 3 else 1 end as gap from n where not contains(lower(class_name), 'healthy')),
 k as (select class_name, regexp_replace(lower(trim(substr(class_name, 1, pos - 1))), '[\s\-_]+', '_', 'g') as c, regexp_replace(lower(trim(substr(class_name, pos + gap))), '[\s\-_]+', '_', 'g') as d1 from q where pos > 0),
 v as (select class_name, case c when 'squash' then 'zucchini' else c end as species, d1, replace(replace(replace(d1, '_fruit', ''), '_leaf', ''), '_rot', '') as d2, regexp_replace(d1, '_fruit_rot|_leaf_spot|_leaf|_fruit|_rot|_blight$', '', 'g') as d3 from k),
 j as (select class_name, disease, ordinal, case when disease = d1 then 1 when disease = d2 then 2 when disease = d3 then 3 when contains(d1, disease) or contains(disease, d1) then 4 end as step from v join e using (species)),
 r as (select *, row_number() over (partition by class_name order by step, ordinal) as r from j where step is not null)
 select n.class_name, r.disease as matched, r.step from n left join r on n.class_name = r.class_name and r = 1""")
def jn09_fallback_lookup(spark, d):
    e = spark.createDataFrame(ENTRIES, "species string, disease string, ordinal int")
    return predictions.fallback_lookup(table(spark, d, "raw_pairs").select(F.col("disease_name").alias("class_name")), e)


@query(f"""with recursive {_IMG}, o as (select crop, image_id, fp, row_number() over (partition by crop order by file_size desc nulls last, image_id) as i, count(*) over (partition by crop) as n from img where crop <> ''),
 g(crop, i, ids, fps) as (select distinct crop, 0::bigint, []::bigint[], []::ubigint[] from o union all
  select crop, i + 1, case when ok then list_append(ids, image_id) else ids end, case when ok and fp is not null then list_append(fps, fp) else fps end from
   (select g.*, o.image_id, o.fp, len(ids) < 40 and (o.fp is null or len(list_filter(fps, lambda x: bit_count(xor(x, o.fp)) < 12)) = 0) as ok from g join o on o.crop = g.crop and o.i = g.i + 1)),
 fin as (select crop, arg_max(ids, i) as ids from g group by crop), k as (select crop, unnest(ids) as image_id, generate_subscripts(ids, 1) as place from fin),
 sp as (select o.crop, o.image_id, len(ids) + row_number() over (partition by o.crop order by i) as place from o join fin using (crop) where n > 40 and not list_contains(ids, o.image_id))
 select crop, image_id, i::integer as place, false as filled from o where n <= 40 union all select k.crop, k.image_id, place::integer, false from k join o on o.image_id = k.image_id where n > 40
 union all select crop, image_id, place::integer, true from sp where place <= 40""")
def jn11_greedy_distinct(spark, d):
    i = images(spark, d).where("crop <> ''").select("crop", "image_id", "fp", F.col("file_size").cast("double").alias("quality"))
    return sel.greedy_distinct(i, "crop", "image_id", "fp", "quality", 40)


@query(f"""with recursive {_IMG}, o as (select crop, image_id, coalesce(fp, 0::ubigint) as fp, coalesce(file_size / 1e7, 0.0) as q, row_number() over (partition by crop order by file_size desc nulls last, image_id) as i, count(*) over (partition by crop) as n from img where crop <> ''),
 g(crop, place, at_i, is_, fps) as (select crop, 1, i, [i], [fp] from o where i = 1 and n > 20 union all
  select crop, place + 1, nxt, list_append(is_, nxt), list_append(fps, (select fp from o where o.crop = z.crop and o.i = z.nxt)) from (
   select g.crop, g.place, any_value(is_) as is_, any_value(fps) as fps, arg_min(o.i, row(-(list_min(list_transform(fps, lambda x: bit_count(xor(x, o.fp)))) + 16.0 * o.q), o.i)) as nxt
   from g join o on o.crop = g.crop where g.place < 20 and not list_contains(is_, o.i) group by g.crop, g.place) z)
 select g.crop, image_id, place from g join o on o.crop = g.crop and o.i = at_i union all select crop, image_id, i::integer from o where n <= 20""")
def top09_farthest_point(spark, d):
    i = images(spark, d).where("crop <> ''").select("crop", "image_id", "fp", (F.col("file_size") / 1e7).alias("quality"))
    return sel.farthest_point(i, "crop", "image_id", "fp", "quality", 20)


@query()
def top10_kmeans(spark, d):
    a = audits(spark, d)
    return sel.kmeans_by_group(a, "split", "audit_id", ["width", "height", "mask_coverage_pct"], "file_size", 12)


# ---- projections and scalar functions ---------------------------------------------------------


@query("""select coalesce(case when lower(trim(split)) in ('train', 'training') then 'train' when lower(trim(split)) in ('val', 'validation') then 'val' when lower(trim(split)) in ('test', 'testing') then 'test' end, split) as split, count(*) as n from dataset_images group by 1""")
def prj02_split_names(spark, d):
    i = table(spark, d, "dataset_images")
    return i.groupBy(F.coalesce(K.split_name(F.col("split")), "split").alias("split")).agg(F.count(F.lit(1)).alias("n"))


@query("select image_id from dataset_images where lower(trim(dataset_source)) in ('baseline') and lower(trim(split)) = 'train'")
def prj01_filters(spark, d):
    i = table(spark, d, "dataset_images")
    return i.where(F.lower(F.trim("dataset_source")).isin("baseline") & (F.lower(F.trim("split")) == "train")).select("image_id")


@query("select case when confidence is null then 'missing' when isnan(confidence) then 'nan' when confidence < 0 then 'negative' when confidence > 100 then 'above_100' end as reason, count(*) as n from crop_recommendations group by 1")
def prj04_rejects(spark, d):
    r = table(spark, d, "crop_recommendations")
    return r.groupBy(T.checked_confidence(F.col("confidence")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query(r"""select distinct disease_name, regexp_replace(lower(trim(disease_name)), '[\s\-_]+', '_', 'g') as lookup_key, regexp_replace(regexp_replace(lower(trim(disease_name)), '[- ]', '_', 'g'), '_+', '_', 'g') as slug,
 regexp_matches(disease_name, '^[a-z0-9]+(_[a-z0-9]+)*$') as snake, case when length(disease_name) > 20 then substr(disease_name, 1, 20) || '_' || substr(md5(disease_name), 1, 8) else disease_name end as short_name from raw_pairs""")
def str01_names(spark, d):
    c = F.col("disease_name")
    return table(spark, d, "raw_pairs").select(c, predictions.lookup_key(c).alias("lookup_key"), T.disease_slug(c).alias("slug"), T.is_snake(c).alias("snake"), T.short_name(c).alias("short_name")).distinct()


@query(r"""select distinct disease_name, regexp_replace(lower(disease_name), '_fruit_rot|_leaf_spot|_leaf|_fruit|_rot|_blight$', '', 'g') as stripped, contains(lower(disease_name), 'healthy') as healthy,
 regexp_matches(lower(disease_name), 'quince|fig|taro') as listed from raw_pairs where disease_name is not null""")
def str12_suffixes(spark, d):
    c = F.lower("disease_name")
    return table(spark, d, "raw_pairs").where("disease_name is not null").select("disease_name", T.strip_suffixes(c).alias("stripped"), c.contains("healthy").alias("healthy"), c.rlike("quince|fig|taro").alias("listed")).distinct()


@query(r"""select image_id, regexp_extract(image_path, '([^/]*)$', 1) as base, regexp_replace(regexp_extract(image_path, '([^/]*)$', 1), '(.)\.[^.]*$', '\1') as stem, lower(regexp_extract(regexp_extract(image_path, '([^/]*)$', 1), '.(\.[^.]*)$', 1)) as suffix,
 list_filter(string_split(lower(image_path), '/'), lambda p: p in ('train', 'val', 'test'))[1] as split from dataset_images""")
def str07_paths(spark, d):
    c = F.col("image_path")
    return table(spark, d, "dataset_images").select("image_id", T.basename(c).alias("base"), T.stem(c).alias("stem"), T.suffix(c).alias("suffix"), T.split_of_path(c).alias("split"))


@query("select image_id, width || 'X' || height as resolution, width as w, height as h from dataset_images where width >= 0 and height >= 0")
def str10_sizes(spark, d):
    i = table(spark, d, "dataset_images").where("width >= 0 and height >= 0").select("image_id", F.concat(F.col("width").cast("string"), F.lit("X"), F.col("height").cast("string")).alias("resolution"))
    s = T.parse_size(F.col("resolution"))
    return i.select("image_id", "resolution", s["w"].alias("w"), s["h"].alias("h"))


@query("select audit_id, round(least(1.0, width::double * height / 2073600.0) * 0.2 + case when file_size > 0 then least(1.0, (file_size / 1000.0) / 500.0) else 0 end * 0.4 + case when mask_coverage_pct < 40 or mask_coverage_pct > 220 then 0.2 when mask_coverage_pct between 100 and 180 then 1 else greatest(0.2, 1 - abs(mask_coverage_pct - 140) / 100.0) end * 0.2 + least(1.0, channels * 10 / 50.0) * 0.2, 4)::double as quality from audit_images where width > 0 and height > 0 and mask_coverage_pct between 0 and 100 and not isnan(mask_coverage_pct)")
def mth02_quality(spark, d):
    a = table(spark, d, "audit_images").where("width > 0 and height > 0 and mask_coverage_pct between 0 and 100")
    q = T.image_quality(F.col("width"), F.col("height"), F.col("file_size") / 1000.0, F.col("mask_coverage_pct"), F.col("channels") * 10)
    return a.select("audit_id", q.alias("quality"))


@query("select event_id, event_type, (json_extract(props, '$.k'))::bigint as k from events")
def map02_nested_path(spark, d):
    return table(spark, d, "events").select("event_id", "event_type", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))


@query("select coalesce(corruption_reason, '') as corruption_reason, count(*) as n from audit_images group by 1 union all select 'missing:' || coalesce(split, ''), count(*) from dataset_images where width is null group by 1")
def set07_append(spark, d):
    a = table(spark, d, "audit_images").groupBy(F.coalesce("corruption_reason", F.lit("")).alias("corruption_reason")).agg(F.count(F.lit(1)).alias("n"))
    b = table(spark, d, "dataset_images").where("width is null").groupBy(F.concat(F.lit("missing:"), F.coalesce("split", F.lit(""))).alias("corruption_reason")).agg(F.count(F.lit(1)).alias("n"))
    return a.unionByName(b, allowMissingColumns=True).fillna("")


@query(f"with {_IMG} select distinct digest from img where digest is not null and source = 'baseline' except select distinct digest from img where source = 'new'")
def set04_except(spark, d):
    i = images(spark, d).where("digest is not null")
    return i.where("source = 'baseline'").select("digest").distinct().join(i.where("source = 'new'").select("digest").distinct(), "digest", "left_anti")
