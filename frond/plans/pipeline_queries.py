"""Queries of the pipelines over the project's tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from frond.functions import keys as K
from frond.functions import labels as L
from frond.functions import text as T
from frond.operators import predictions, stats
from frond.plans import curation_queries as C
from frond.plans import pipelines as P
from frond.plans.tables import table
from frond.sources import readers, sinks
from frond.storage import Scratch

QUERIES: dict = {}
ORACLES: dict = {}
CROPS = ["fennel", "fig", "leek", "millet", "plum", "quince", "taro"]


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _files(spark, d):
    return table(spark, d, "label_files").select("file_id", K.file_key(F.col("label_path")).alias("file"), "content")


_NEAR = f"""lk as (select digest from ok where digest is not null group by digest having count(distinct split) > 1),
 ex as (select image_id, row_number() over (partition by digest order by {C._RANK}, image_id) = 1 as kept from ok where digest in (select digest from lk)),
 rest as (select * from ok where image_id not in (select image_id from ex)), f as (select distinct fp from rest where fp is not null),
 e as (select a.fp as a, b.fp as b from f a join f b on a.fp <> b.fp and bit_count(xor(a.fp, b.fp)) <= 5),
 reach(a, b) as (select fp, fp from f union select r.a, e.b from reach r join e on r.b = e.a),
 least_id as (select fp, min(image_id) as i from rest where fp is not null group by fp), comp as (select r.a as fp, min(i) as component from reach r join least_id l on l.fp = r.b group by r.a),
 m as (select image_id, split, component from rest join comp using (fp)), ml as (select component from m group by component having count(distinct split) > 1),
 nr as (select image_id, row_number() over (partition by component order by {C._RANK}, image_id) = 1 as kept from m where component in (select component from ml))"""


@query(f"""with recursive {C._IMG}, ok as (select image_id, split, digest, fp, file from img where split is not null and crop in ({', '.join(repr(c) for c in CROPS)})), {_NEAR},
 x as (select distinct nullif({C._FILE}, '') as file from label_files)
 select image_id, split, case when image_id in (select image_id from ex where not kept) then 'exact_leak' when image_id in (select image_id from nr where not kept) then 'near_leak'
   when file is null or file not in (select file from x where file is not null) then 'no_mask' else 'kept' end as outcome from ok""")
def pip01_subset(spark, d):
    return P.subset(C.images(spark, d).select("image_id", "split", "crop", "digest", "fp", "file"), _files(spark, d), CROPS)


def _coco(spark, d):
    """Annotation documents, one file for each split, written from the label files and read again."""
    i = C.images(spark, d).where("split is not null and file is not null").select("image_id", "split", "file", "filename").dropDuplicates(["split", "file"])
    ln = L.lines(_files(spark, d), keep=("file_id", "file")).withColumn("t", L.tokens(F.col("line")))
    flat = F.transform(F.slice("t", 2, F.greatest(F.size("t") - 1, F.lit(0))), lambda v: v.cast("double") * 1000)
    a = ln.join(i, "file").select("split", F.struct((F.col("file_id") * 1000 + F.col("line_no")).alias("id"), "image_id", F.get("t", F.lit(0)).cast("int").alias("category_id"), F.array(flat).alias("segmentation")).alias("a"))
    images = i.groupBy("split").agg(F.collect_list(F.struct(F.col("image_id").alias("id"), F.col("filename").alias("file_name"), F.lit(1000).alias("width"), F.lit(1000).alias("height"))).alias("images"))
    docs = images.join(a.groupBy("split").agg(F.collect_list("a").alias("annotations")), "split", "left")
    scratch = Scratch(spark)
    at = scratch.path("coco")
    docs.select("split", F.to_json(F.struct("images", "annotations")).alias("value")).repartition("split").write.partitionBy("split").text(at)
    return readers.read_coco(spark, {s: f"{at}/split={s}" for s in ("train", "val", "test")})


_PICKED = "pick as (select min(image_id) as image_id, split, file from img where split is not null and file is not null group by split, file)"
_FMT = "class_id || ' ' || array_to_string(list_transform(v[1:len(v) // 2 * 2], lambda x: printf('%.6f', greatest(0.0, least(1.0, x)))), ' ')"


@query(f"""with {C._IMG}, {C._POLY}, pick as (select distinct split, file from img where split is not null and file is not null),
 x as (select file_id, nullif({C._FILE}, '') as file from label_files), j as (select p.split, p.file, x.file_id, poly.line_no, class_id, v from pick p left join x using (file) left join poly on poly.file_id = x.file_id and len(v) >= 6),
 c as (select split, file, coalesce(string_agg(class_id || ' ' || array_to_string(list_transform(v[1:len(v) // 2 * 2], lambda x: printf('%.6f', greatest(0.0, least(1.0, x)))), ' '), chr(10) order by file_id, line_no), '') as content from j group by all)
 select split, content, count(*) as files from c group by all""")
def pip02_coco_labels(spark, d):
    coco = _coco(spark, d)
    classes = spark.range(1000).select(F.col("id").cast("int").alias("category_id"), F.col("id").cast("int").alias("class_id"))
    return P.coco_to_labels(coco, classes).groupBy("split", "content").agg(F.count(F.lit(1)).alias("files"))


@query(f"""with {C._IMG}, b as (select * from img where source = 'baseline'), n as (select * from img where source = 'new'),
 f as (select *, row_number() over (partition by digest order by filename, image_id) as r from n where digest is not null and digest not in (select digest from b where digest is not null)),
 m as (select image_id, filename, 'baseline' as dataset_source from b union all select image_id, filename, 'new' from f where r = 1 union all select image_id, filename, 'new' from n where digest is null),
 r as (select *, row_number() over (partition by filename order by dataset_source, image_id) - 1 as k, count(*) over (partition by filename) as c from m where filename is not null),
 names as (select distinct filename as f from r), dots as (select regexp_replace(f, '\\.[^.]*$', '') as stem, regexp_extract(f, '(\\.[^.]*)$', 1) as suffix from names),
 taken as (select regexp_replace(stem, '_[0-9]+$', '') || suffix as owner, list(regexp_extract(stem, '_([0-9]+)$', 1)::bigint) as ks from dots where regexp_matches(stem, '_([0-9]{{3}}|[1-9][0-9]{{3,17}})$') group by 1),
 z as (select r.*, case when ks is null then k else list_filter(range(1, c + len(ks) + 1), lambda x: not list_contains(ks, x))[k] end as q from r left join taken t on t.owner = r.filename)
 select image_id, dataset_source, case when k = 0 then filename else regexp_replace(filename, '\\.[^.]*$', '') || '_' || case when q < 1000 then lpad(q::varchar, 3, '0') else q::varchar end || regexp_extract(filename, '(\\.[^.]*)$', 1) end as new_name from z
 union all select image_id, dataset_source, null from m where filename is null""")
def pip04_merge(spark, d):
    i = C.images(spark, d).select("image_id", "digest", "filename", "source")
    return P.merged(i.where("source = 'baseline'"), i.where("source = 'new'"))


@query(f"""with {C._CLS.replace('cb as', 'cb0 as').replace('cn as', 'cn0 as')}, cb as (select class_name, class_id from cb0), cn as (select class_name, class_id from cn0),
 j as (select coalesce(b.class_name, n.class_name) as class_name, b.class_id as base_id, n.class_id as new_id from cb b full outer join cn n on b.class_name = n.class_name),
 mg as (select new_id as class_id, coalesce(base_id, (select coalesce(max(class_id), -1) from cb) + row_number() over (partition by base_id is null order by new_id))::integer as new_id from j), {C._POLY}
 select p.class_id, m.new_id, count(*) as n from poly p left join (select * from mg where class_id is not null) m using (class_id) group by all""")
def pip04_merged_labels(spark, d):
    from frond.operators import pairing

    classes = pairing.align_classes(*C._class_lists(spark, d)).where("new_id is not null").select(F.col("new_id").alias("class_id"), F.col("merged_id").alias("new_id"))
    return P.merged_labels(C._objects(spark, d), classes).groupBy("class_id", "new_id").agg(F.count(F.lit(1)).alias("n"))


@query(C.ORACLES["agg11_quality"].replace("as ready from s", "as ready, concat_ws(',', case when corrupt > 0 then 'corrupted' end, case when leaks > 0 then 'leaks' end, case when invalid > 0 then 'polygons' end, case when viol > 0 then 'healthy' end) as blocking from s"))
def pip05_audit_gate(spark, d):
    return P.audit_gate(C.images(spark, d), C.audits(spark, d), table(spark, d, "label_files"))


@query(f"""with k as (select distinct pair_id, {C._KEY.format(c='disease_name')} as disease, coalesce(is_corrupted, false) as bad, file_size from raw_pairs where pair_id is not null),
 g as (select disease, count(*) as n, count(*) filter (where bad) as corrupted, round(avg(file_size), 3) as mean_size from k where disease is not null group by disease),
 u as (select *, n - corrupted as usable, 100.0 * (n - corrupted) / n * least(1.0, (n - corrupted) / 100.0) as score from g)
 select disease, n, corrupted, usable, mean_size, case when usable >= 100 then 'GOOD' when usable >= 30 then 'WARNING' else 'CRITICAL' end as health,
  case when usable >= 80 then 'Excellent' when usable >= 50 then 'Good' when usable >= 20 then 'Fair' else 'Poor' end as rating, case when score >= 80 then 'READY' when score >= 60 then 'PARTIAL' else 'NOT_READY' end as readiness from u""")
def pip06_scorecards(spark, d):
    p = table(spark, d, "raw_pairs").where("pair_id is not null")
    return P.scorecards(p.select("pair_id", K.name_key(F.col("disease_name")).alias("disease"), F.coalesce("is_corrupted", F.lit(False)).alias("is_corrupted"), "file_size").distinct(), "disease")


def _quality_images(spark, d):
    q = F.when(F.col("file_size") > 0, F.col("file_size").cast("double"))
    return C.images(spark, d).select("image_id", "crop", "digest", "fp", q.alias("quality"), "corrupted")


@query(f"""with recursive {C._IMG}, q as (select image_id, crop, digest, fp, case when file_size > 0 then file_size::double end as quality, corrupted from img),
 o as (select *, row_number() over (partition by coalesce(digest, 'i' || image_id) order by coalesce(-quality, 'infinity'::double), image_id) as r from q where not corrupted), l as (select * from o where r = 1),
 f as (select distinct fp from l where fp is not null), e as (select a.fp as a, b.fp as b from f a join f b on a.fp <> b.fp and bit_count(xor(a.fp, b.fp)) <= 5),
 reach(a, b) as (select fp, fp from f union select r.a, e.b from reach r join e on r.b = e.a), comp as (select a as fp, min(b) as component from reach group by a),
 g as (select l.*, row_number() over (partition by coalesce(component || '|' || crop, 'i' || image_id) order by coalesce(-quality, 'infinity'::double), image_id) as near from l left join comp using (fp))
 select image_id, case when near > 1 then 'near_duplicate' when quality is null or quality < 500000 then 'low_quality' else 'kept' end as outcome from g
 union all select image_id, 'exact_duplicate' from o where r > 1 union all select image_id, 'corrupted' from q where corrupted""")
def pip07_curation(spark, d):
    return P.curated(_quality_images(spark, d), 500_000.0)


@query()
def pip07_selection(spark, d):
    return P.curated_selection(_quality_images(spark, d).where("crop <> ''").withColumn("quality", F.col("quality") / 1e7), 0.05, 20)


_STEM = r"regexp_replace(filename, '(.)\.[^.]*$', '\1')"


@query(f"""with {C._IMG}, {C._POLY}, {C._CROSS}, {C._PAIRS}, a as (select *, {C._AREA} as area from poly), x as (select file_id, nullif({C._FILE}, '') as file from label_files), i as (select distinct file from img where file is not null),
 pr as (select case when i.file is null then 'orphan_label' when x.file is null then 'missing_label' end as problem from i full outer join (select distinct file from x where file is not null) x on i.file = x.file),
 st as (select 'strict_odd7' as rule union all select 'even_coords7'),
 bad as (select file_id, line_no, case when len(t) < 7 then 'token_count' when len(t) % 2 = 0 then 'odd_coordinates' when len(list_filter(t[2:], lambda x: x::double < 0 or x::double > 1)) > 0 then 'out_of_bounds' end as w from tk),
 ff as (select l.file_id, (select count(*) from tk where tk.file_id = l.file_id) as n, (select arg_min(w, line_no) from bad where bad.file_id = l.file_id and w is not null) as w from label_files l),
 rs as (select rule, coalesce(w, case when n = 0 and rule = 'even_coords7' then 'empty' end) as problem from ff, st),
 po as (select case when again > 1 then 'duplicate_line' when len(v) < 6 then 'token_count' when len(v) % 2 = 1 then 'odd_coordinates' when len(list_filter(v, lambda x: x < 0 or x > 1)) > 0 then 'out_of_bounds' when c.file_id is not null then 'self_intersecting' when area <= 0.00001 then 'no_area' end as problem,
   len(v) >= 6 and len(v) % 2 = 0 and again = 1 and len(list_distinct(list_transform(range(0, len(v) // 2), lambda i: struct_pack(x := v[2 * i + 1], y := v[2 * i + 2])))) < len(v) // 2 as rep
  from a left join crossing c on a.file_id = c.file_id and a.line_no = c.line_no),
 k as (select distinct {_STEM} as k, split from img where filename is not null and split is not null),
 ss as (select split_a || '-' || split_b as problem, (select count(*) from k a join k b on a.k = b.k where a.split = p.split_a and b.split = p.split_b) as n from p)
 select 'pairing' as "check", problem, count(*) as n from pr where problem is not null group by problem union all select rule, problem, count(*) from rs where problem is not null group by all
 union all select 'polygon', problem, count(*) from po where problem is not null group by problem union all select * from (select 'points', 'repeated_point', count(*) as n from po where rep) where n > 0 union all select 'stems', problem, n from ss where n > 0""")
def pip08_validation(spark, d):
    i = C.images(spark, d).select("file", "split", T.stem(F.col("filename")).alias("stem"))
    return P.validation(i, _files(spark, d))


def _named_classes(spark):
    return spark.range(40).select(F.col("id").cast("int").alias("class_id"), F.when(F.col("id") % 7 == 3, F.concat(F.lit("Crop healthy "), F.col("id"))).when(F.col("id") < 38, F.concat(F.lit("spot "), F.col("id"))).alias("class_name"))


_HC = "hc as (select i::integer as class_id, case when i % 7 = 3 then true when i < 38 then false else i >= 14 end as healthy from range(0, 40) t(i)), nw as (select class_id, (row_number() over (order by class_id) - 1)::integer as new_id from hc where not healthy)"


@query(f"with {_HC} select class_id, healthy from hc")
def prj11_healthy_classes(spark, d):
    """Classes without a name are told by their id."""
    return P.healthy_classes(_named_classes(spark), 14).select("class_id", "healthy")


@query(f"""with {_HC}, {C._LINES}, z as (select file_id, line_no, t, t[1]::integer as class_id from tk),
 k as (select file_id, bool_or(not coalesce(healthy, false)) as sick, count(*) as c from z left join hc using (class_id) group by file_id),
 r as (select file_id, count(*) as lines, string_agg(new_id || ' ' || array_to_string(t[2:], ' '), chr(10) order by line_no) as content from z join nw using (class_id) group by file_id)
 select file_id, case when k.c is null then 'unknown' when sick then 'disease' else 'healthy' end as kind, coalesce(lines, 0) as lines, coalesce(r.content, '') as content from label_files left join k using (file_id) left join r using (file_id)""")
def pip09_background(spark, d):
    return P.healthy_to_background(table(spark, d, "label_files").select("file_id", "content"), P.healthy_classes(_named_classes(spark), 14))


@query(f"""with {C._IMG}, g as (select crop, count(*) filter (split = 'train') as train, count(*) filter (split = 'val') as val, count(*) filter (split = 'test') as test, count(*) as total from img where split is not null and crop <> '' group by crop)
 select *, round(100.0 * total / sum(total) over (), 4) as share, round(max(total) over () / min(total) over (), 2) as ratio, case when total >= 100 then 'GOOD' when total >= 30 then 'WARNING' else 'CRITICAL' end as health from g""")
def pip10_statistics(spark, d):
    return P.statistics_report(C.images(spark, d).select("crop", "split"), "crop")


@query(f"""with {C._IMG}, {C._AUD}, i as (select file, min(width) as iw, min(height) as ih from img where file is not null group by file),
 m as (select file, min(width) as mw, min(height) as mh from aud where file is not null group by file),
 s as (select i.file, case when m.file is null then null when coalesce(iw = mh and ih = mw and not (iw = mw and ih = mh), false) then 'rotate_mask' when not coalesce(iw = mw and ih = mh, false) then 'resize_mask' end as fix from i left join m on i.file = m.file),
 ok as (select * from img where digest is not null and split is not null),
 lk as (select image_id from (select image_id, row_number() over (partition by digest order by {C._RANK}, image_id) as r from ok where digest in (select digest from ok group by digest having count(distinct split) > 1)) where r > 1),
 cp as (select image_id from (select image_id, row_number() over (partition by split, digest order by image_id) as r from ok) where r > 1)
 select image_id, case when image_id in (select image_id from lk) then 'remove_leak' when image_id in (select image_id from cp) then 'remove_copy' when fix is not null then fix else 'none' end as action from img left join s using (file)""")
def pip11_cleanup(spark, d):
    i = C.images(spark, d).select("image_id", "split", "digest", "file", F.col("width").alias("w"), F.col("height").alias("h"))
    return P.cleanup(i, C.audits(spark, d).select("file", F.col("width").alias("w"), F.col("height").alias("h"), F.col("mask_coverage_pct").alias("coverage")))


@query(f"""with {C._IMG}, {C._AUD}, c as (select image_path, max(mask_coverage_pct) as c from aud where image_path is not null group by image_path),
 t as (select distinct image_path, digest from img where image_path is not null and digest is not null)
 select t.image_path as rel_path, t.digest as sha256, case when c is null or isnan(c) then 'FAILED' when c < 0.2 or c > 98.5 then 'REVIEW' else 'COMPLETED' end as status,
  case when c is null or isnan(c) or c < 0.2 or c > 98.5 then 2 else 1 end as runs from t left join c using (image_path)""")
def pip12_segmentation(spark, d):
    """Two runs: the second takes up only what the first did not complete."""
    i = C.images(spark, d).select(F.col("image_path").alias("rel_path"), F.col("digest").alias("sha256"))
    m = C.audits(spark, d).select(F.col("image_path").alias("rel_path"), F.col("mask_coverage_pct").alias("coverage"))
    state = sinks.ResumeState(spark, Scratch(spark).path("state"))
    both = P.segmentation_queue(i, m, state, "1").unionByName(P.segmentation_queue(i, m, state, "2"))
    return both.groupBy("rel_path", "sha256", "status").agg(F.count(F.lit(1)).cast("int").alias("runs"))


_REQ = """rq as (select r as request_id, case when r % 11 = 0 then null when r % 7 = 0 then null else ((r * 37) % 520)::double end as nitrogen, case when r % 7 = 0 then ((r * 37) % 520)::double end as "N", ((r * 13) % 310)::double as phosphorus, ((r * 17) % 505)::double as potassium,
 4.5 + (r * 7) % 46 as temperature, ((r * 3) % 101)::double as humidity, 3.4 + ((r * 5) % 61) / 10.0 as ph, case r % 5 when 0 then 'vegetable' when 1 then 'fruit' when 2 then 'tree' end as category from
 (select distinct request_id as r from crop_recommendations where request_id is not null))"""
_WHY = """why as (select request_id, category as wanted, case when coalesce(nitrogen, "N") is null then 'nitrogen missing' when not coalesce(nitrogen, "N") between 0 and 500 then 'nitrogen out of range' when not phosphorus between 0 and 300 then 'phosphorus out of range'
 when not potassium between 0 and 500 then 'potassium out of range' when not temperature between 5 and 50 then 'temperature out of range' when not humidity between 0 and 100 then 'humidity out of range' when not ph between 3.5 and 9.5 then 'ph out of range'
 when category = 'tree' then 'category unknown' end as reason from rq)"""


def _requests(spark, d):
    """Requests with field values made from their ids, some out of range or missing."""
    r = table(spark, d, "crop_recommendations").where("request_id is not null").select(F.col("request_id").alias("r")).distinct()
    x = F.col("r")
    n = ((x * 37) % 520).cast("double")
    return r.select(
        x.alias("request_id"), F.when((x % 11 != 0) & (x % 7 != 0), n).alias("nitrogen"), F.when(x % 7 == 0, n).alias("N"), ((x * 13) % 310).cast("double").alias("phosphorus"), ((x * 17) % 505).cast("double").alias("potassium"),
        (4.5 + (x * 7) % 46).alias("temperature"), ((x * 3) % 101).cast("double").alias("humidity"), (3.4 + ((x * 5) % 61) / 10.0).alias("ph"), F.when(x % 5 == 0, "vegetable").when(x % 5 == 1, "fruit").when(x % 5 == 2, "tree").alias("category"),
    )


@query(f"with {_REQ}, {_WHY} select request_id, reason from why")
def prj04_requests(spark, d):
    return predictions.checked_requests(_requests(spark, d)).select("request_id", "reason")


_SCORES = f"""sc as (select request_id, crop, max(confidence) as c, min(rec_id) as o from crop_recommendations where request_id is not null and confidence is not null and not isnan(confidence) group by all),
 ct as (select crop, min({C._KEY.format(c='category')}) as category from crop_recommendations where hash_pick(crop) group by crop)""".replace("where hash_pick(crop) ", "where crop not in ('leek', 'fig') ")


@query(f"""with {_REQ}, {_WHY}, {_SCORES}, j as (select sc.request_id, sc.crop, coalesce(category, 'unknown') as category, round(c / 100 * 100, 2) as confidence, o, wanted from sc join why using (request_id) left join ct using (crop) where reason is null),
 p as (select *, row_number() over (partition by request_id order by confidence desc, o, crop) as place from j where wanted is null or category = wanted)
 select request_id, null as reason, crop, category, confidence, place::integer as place from p where place <= 3 union all select request_id, reason, null, null, null, null from why where reason is not null""")
def pip13_recommendations(spark, d):
    r = table(spark, d, "crop_recommendations")
    s = r.where("request_id is not null and confidence is not null and not isnan(confidence)").groupBy("request_id", "crop").agg((F.max("confidence") / 100).alias("prob"), F.min("rec_id").alias("ordinal"))
    crops = r.where("crop not in ('leek', 'fig')").groupBy("crop").agg(F.min(K.name_key(F.col("category"))).alias("category"))
    return P.recommendations(_requests(spark, d), s, crops)


#: Entries of the diagnosis: species, disease, ordinal; and names of classes by id modulo 8.
NAMES = ["Fennel___ash_mildew", "Fig___glass_spot", "Leek_healthy", "Taro___corky_vein", "Plum___Healthy", "Quince___silver_leaf", "Millet___pale_rust", None]
_NM = "nm(m, class_name) as (values " + ", ".join(f"({i}, {'null' if n is None else repr(n)})" for i, n in enumerate(NAMES)) + ")"
_FB = """fb(class_name, matched) as (values ('Fig___glass_spot', 'glass_spot'), ('Taro___corky_vein', 'corky_vein'), ('Quince___silver_leaf', 'silver'), ('Millet___pale_rust', 'pale_rust'))"""
_TITLE = """ti(class_name, shown) as (values ('Fennel___ash_mildew', 'Fennel - Ash Mildew'), ('Fig___glass_spot', 'Fig - Glass Spot'), ('Taro___corky_vein', 'Taro - Corky Vein'), ('Quince___silver_leaf', 'Quince - Silver Leaf'), ('Millet___pale_rust', 'Millet - Pale Rust'))"""


@query(f"""with {C._VIEWS}, {_NM}, {_FB}, {_TITLE}, x as (select label, conf, unnest(p) as q, unnest(range(0, len(p)))::integer as c from kept), w as (select label, c, sum(q * conf) / sum(conf) as w from x group by all),
 b as (select label, c, w, row_number() over (partition by label order by w desc, c) as r from w),
 fin as (select k.label, c as final_class, w, avg((top = c)::int) as agreement from kept k join b on k.label = b.label and r = 1 group by k.label, c, w),
 v as (select label, top, count(*) as votes, count(*) / sum(count(*)) over (partition by label) as ratio from kept group by label, top),
 iss as (select label, string_agg(class_name, ', ' order by votes desc, top) as issues from v join nm on m = top % 8 where ratio >= 0.25 and class_name is not null and not contains(lower(class_name), 'healthy') group by label),
 n as (select fin.*, class_name, coalesce(issues, '') as issues from fin left join nm on m = final_class % 8 left join iss using (label))
 select label, final_class, n.class_name, round(w, 4) as confidence, round(agreement, 3) as agreement, issues, matched, case when n.class_name is null or w < 0.02 then 'unknown' when contains(lower(n.class_name), 'healthy') then 'healthy' else 'diseased' end as status,
  case when n.class_name is null or w < 0.02 then 'Unknown' when contains(lower(n.class_name), 'healthy') then 'Healthy' else shown end as diagnosis,
  case when n.class_name is not null and w >= 0.02 and contains(lower(n.class_name), 'healthy') and issues <> '' then 'possible disease in part of the input: ' || issues end as warning
 from n left join fb using (class_name) left join ti using (class_name)""")
def pip14_diagnosis(spark, d):
    names = F.array(*[F.lit(n).cast("string") for n in NAMES])
    classes = spark.range(64).select(F.col("id").cast("int").alias("class_id"), F.get(names, (F.col("id") % 8).cast("int")).alias("class_name"))
    entries = spark.createDataFrame(C.ENTRIES, "species string, disease string, ordinal int")
    return P.diagnoses(C.views(spark, d), "label", classes, entries, unknown_below=0.02)


@query(f"""with {C._IMG}, {C._POLY}, k as (select case when class_id % 5 <> 0 then 'class' else 'dropped' end as item, case when class_id % 5 <> 0 then class_id - class_id // 5 - 1 else class_id end as id from poly)
 select item, id, count(*) as n from k group by all union all select 'leak', null, count(*) from (select digest from img where digest is not null and split is not null group by digest having count(distinct split) > 1)""")
def pip15_rebuild(spark, d):
    return P.rebuilt_classes(table(spark, d, "label_files").select("file_id", "content"), C.images(spark, d), C._class_map(spark))


# ---- shapes of the single operators -----------------------------------------------------------


@query("""with f as (select vec_id as frame, label, embedding[1]::double as s from embeddings where vec_id is not null), b as (select *, row_number() over (partition by label order by s desc nulls last, frame) as r from f)
 select label, frame, row_number() over (partition by label order by frame)::integer as place from b where r <= 7""")
def top04_sharpest_in_time(spark, d):
    e = table(spark, d, "embeddings").where("vec_id is not null").select("label", F.col("vec_id").alias("frame"), F.get("embedding", F.lit(0)).cast("double").alias("s"))
    return predictions.sharpest_in_time(e, "label", "frame", F.col("s"), 7)


@query("""with i as (select image_id, width as w, height as h, least(width, height) as s from dataset_images where width > 0 and height > 0), v as (select *, unnest(case when w = h then [0.0] else [0.0, 0.5, 1.0] end) as f, unnest(case when w = h then [0] else [0, 1, 2] end) as view from i)
 select image_id, view::integer as view, (case when w > h then floor((w - s) * f) else 0 end)::integer as x, (case when w > h then 0 else floor((h - s) * f) end)::integer as y, s as side_w, s as side_h from v""")
def jn17_frame_views(spark, d):
    i = table(spark, d, "dataset_images").where("width > 0 and height > 0").withColumn("g", F.lit(0))
    return predictions.frame_views(i, "g", "image_id", F.col("width"), F.col("height")).drop("g")


@query(f"""with {C._VIEWS}, a as (select label, view // 3 as frame, view, top::integer as top, conf from cf), r as (select *, row_number() over (partition by label, frame order by conf desc, view) as r from a)
 select label, frame, view, top, round(conf, 9) as conf from r where r = 1""")
def wn06_best_views(spark, d):
    v = C.views(spark, d).withColumn("frame", F.floor(F.col("view") / 3))
    return predictions.best_views(v, ["label", "frame"], "view", "p").select("label", "frame", "view", "top", F.round("conf", 9).alias("conf"))


@query(f"""with {C._AUD}, ok as (select audit_id, is_healthy, mask_coverage_pct as c from aud where mask_coverage_pct is not null and not isnan(mask_coverage_pct))
 (select 'largest_healthy' as side, audit_id, c from ok where is_healthy order by c desc, audit_id limit 50) union all (select 'smallest_disease', audit_id, c from ok where not is_healthy order by c, audit_id limit 50)""")
def top03_extreme_masks(spark, d):
    a = C.audits(spark, d).where("mask_coverage_pct is not null and not isnan(mask_coverage_pct)").select("audit_id", "is_healthy", F.col("mask_coverage_pct").alias("c"))
    return stats.extremes(a, F.col("is_healthy"), "c", "audit_id", 50)
