"""Queries of the scalar, array, map and image functions over the project's tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from frond.functions import geometry as G
from frond.functions import labels as L
from frond.functions import pixels as X
from frond.functions import text as T
from frond.operators import splits
from frond.plans import curation_queries as C
from frond.plans.tables import table

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _names(spark, d):
    return table(spark, d, "raw_pairs").where("disease_name is not null").select("disease_name").distinct()


_TITLED = "list_aggregate(list_transform(regexp_extract_all({c}, '[A-Za-z]+|[^A-Za-z]+'), lambda p: upper(p[1]) || lower(p[2:])), 'string_agg', '')"
_PRETTY = _TITLED.format(c="trim(replace({c}, '_', ' '))")


@query(f"""with n as (select distinct disease_name as n, replace(disease_name, ' ', '___') as k from raw_pairs where disease_name is not null)
 select n as disease_name, coalesce({_PRETTY.format(c="split_part(k, '___', 1)")}, '') as crop, case when contains(k, '___') then coalesce({_PRETTY.format(c="substr(k, strpos(k, '___') + 3)")}, '') end as disease, contains(lower(k), 'healthy') as healthy from n""")
def str03_crop_and_disease(spark, d):
    k = F.replace(F.col("disease_name"), F.lit(" "), F.lit("___"))
    x = T.crop_and_disease(k)
    return _names(spark, d).select("disease_name", x["crop"].alias("crop"), x["disease"].alias("disease"), x["healthy"].alias("healthy"))


@query(r"""with n as (select distinct filename as f from raw_pairs where filename is not null), p as (select f, string_split(lower(regexp_replace(regexp_extract(f, '([^/]*)$', 1), '(.)\.[^.]*$', '\1')), '_') as ps from n),
 s as (select f, ps, list_filter(range(2, len(ps) + 1), lambda i: regexp_matches(ps[i], '^[0-9]') or ps[i] in ('google', 'bing', 'baidu'))[1] as stop from p) select f as filename, array_to_string(ps[1:coalesce(stop - 1, len(ps))], ' ') as disease from s""")
def str04_infer_disease(spark, d):
    f = table(spark, d, "raw_pairs").where("filename is not null").select("filename").distinct()
    return f.select("filename", T.infer_disease(F.col("filename")).alias("disease"))


_LISTED = ["bell pepper", "leek ash", "leek", "fig", "taro corky", "taro", "plum", "quince"]


@query(f"""with n as (select distinct filename as f from dataset_images where filename is not null), l(i, name) as (values {', '.join(f"({i}, '{n}')" for i, n in enumerate(_LISTED))})
 select f as filename, coalesce((select arg_min(name, i) from l where starts_with(lower(f), replace(name, ' ', '_'))), '') as listed from n""")
def str05_listed_prefix(spark, d):
    f = table(spark, d, "dataset_images").where("filename is not null").select("filename").distinct()
    return f.select("filename", T.longest_listed(F.col("filename"), _LISTED).alias("listed"))


@query("select image_id, case when lower(split_part(filename, '_', 1)) not in ('leek', 'fig', 'taro') then lower(split_part(filename, '_', 1)) end as prefix from dataset_images")
def str14_prefixes(spark, d):
    return table(spark, d, "dataset_images").select("image_id", T.allowed_prefix(F.col("filename"), ["leek", "fig", "taro"]).alias("prefix"))


@query("with n as (select distinct disease_name as a from raw_pairs where disease_name is not null) select a as disease_name, contains(lower(a), 'leaf spot') or contains('leaf spot', lower(a)) as either, regexp_replace(concat_ws(' - ', a, nullif(regexp_replace(a, '[a-zA-Z]', '', 'g'), '')), '^[ \\-]+|[ \\-]+$', '', 'g') as joined from n")
def str17_joined(spark, d):
    a = F.col("disease_name")
    rest = F.regexp_replace(a, "[a-zA-Z]", "")
    return _names(spark, d).select(a, T.contains_either(F.lower(a), F.lit("leaf spot")).alias("either"), T.issue_list([a, F.when(rest != "", rest)], " - ").alias("joined"))


@query(f"with {C._IMG} select image_id, coalesce(bit_count(xor(fp, 81985529216486895::ubigint)), 999)::integer as distance from img")
def mth01_hamming(spark, d):
    return C.images(spark, d).select("image_id", T.hamming(F.col("fp"), F.lit(81985529216486895)).alias("distance"))


@query(f"""with {C._AUD} select audit_id, least(greatest(mask_coverage_pct, 0), 100) as clamped, abs(width - height) <= 0.01 * greatest(abs(width), abs(height)) as square, round(width / nullif(height, 0), 2) as seconds
 from aud where mask_coverage_pct is not null and not isnan(mask_coverage_pct) and width is not null and height is not null""")
def mth03_clamped(spark, d):
    a = C.audits(spark, d).where("mask_coverage_pct is not null and not isnan(mask_coverage_pct) and width is not null and height is not null")
    return a.select("audit_id", T.clamp(F.col("mask_coverage_pct"), 0.0, 100.0).alias("clamped"), T.is_close(F.col("width"), F.col("height"), 0.01).alias("square"), T.frame_seconds(F.col("width"), F.col("height")).alias("seconds"))


_PT = "list_transform(range(0, len(v) // 2), lambda i: struct_pack(x := v[2 * i + 1], y := v[2 * i + 2]))"


@query(f"""with {C._POLY}, p as (select file_id, line_no, {_PT} as p from poly), k as (select *, list_filter(p, lambda q, i: i = 1 or q <> p[i - 1]) as kept from p)
 select file_id, line_no::integer as line_no, len(list_distinct(p)) < len(p) as has_repeat, len(list_distinct(p))::integer as n_unique, (len(kept) - case when len(kept) > 1 and kept[1] = kept[len(kept)] then 1 else 0 end)::integer as kept from k""")
def arr05_points(spark, d):
    p = C._polygons(spark, d)
    return p.select("file_id", "line_no", G.has_repeated_point(F.col("p")).alias("has_repeat"), G.unique_points(F.col("p")).alias("n_unique"), F.size(G.drop_consecutive(F.col("p"))).alias("kept"))


@query(f"""with {C._POLY}, n as (select file_id, line_no, list_transform(v[1:len(v) // 2 * 2], lambda x: round(greatest(0.0, least(1.0, x)), 6)) as u from poly)
 select file_id, line_no::integer as line_no, array_to_string(list_transform(u, lambda x: printf('%.6f', x)), ' ') as unit, coalesce(array_to_string(list_transform(range(1, len(u) + 1), lambda i: trunc(u[i] * case when i % 2 = 1 then 640 else 480 end)::integer), ' '), '') as pixels from n""")
def arr07_normalized(spark, d):
    flat = lambda p: F.flatten(F.transform(p, lambda q: F.array(q["x"], q["y"])))
    p = C._polygons(spark, d).withColumn("big", F.transform("p", lambda q: F.struct((q["x"] * 4).alias("x"), (q["y"] * 8).alias("y"))))
    u = p.withColumn("u", G.normalize(F.col("big"), F.lit(4), F.lit(8)))
    return u.select("file_id", "line_no", F.array_join(F.transform(flat(F.col("u")), lambda x: F.format_string("%.6f", x)), " ").alias("unit"), F.array_join(F.transform(flat(G.denormalize(F.col("u"), F.lit(640), F.lit(480))), lambda x: x.cast("string")), " ").alias("pixels"))


@query(f"""with {C._POLY}, s as (select *, {C._signed()} as area from poly where len(v) >= 6), f as (select file_id, line_no, case when area > 0 then list_reverse({_PT}) else {_PT} end as p from s)
 select file_id, line_no::integer as line_no, p[1].x as x, p[1].y as y from f""")
def arr09_clockwise(spark, d):
    p = C._polygons(spark, d).where(F.size("p") >= 3).withColumn("c", G.clockwise(F.col("p")))
    return p.select("file_id", "line_no", F.get("c", F.lit(0))["x"].alias("x"), F.get("c", F.lit(0))["y"].alias("y"))


@query(f"""with {C._POLY} select file_id, line_no::integer as line_no, v[1] - v[3] / 2 as x1, v[2] - v[4] / 2 as y1, v[1] + v[3] / 2 as x2, v[2] + v[4] / 2 as y2, v[1] - v[3] / 2 < 0 or v[2] - v[4] / 2 < 0 or v[1] + v[3] / 2 > 1 or v[2] + v[4] / 2 > 1 as outside from poly where len(v) >= 4""")
def arr10_corners(spark, d):
    p = C._polygons(spark, d).where(F.size("p") >= 2)
    a, b = F.get("p", F.lit(0)), F.get("p", F.lit(1))
    return p.withColumn("b", G.corners(a["x"], a["y"], b["x"], b["y"])).select("file_id", "line_no", "b.*")


@query(f"with {C._POLY}, {C._CROSS} select p.file_id, p.line_no::integer as line_no, c.file_id is not null as crosses from poly p left join crossing c on p.file_id = c.file_id and p.line_no = c.line_no")
def arr03_numpy(spark, d):
    """Self-intersection by the Arrow-batched kernel."""
    xs = F.transform("p", lambda q: q["x"])
    ys = F.transform("p", lambda q: q["y"])
    return C._polygons(spark, d).select("file_id", "line_no", G.polygon_crosses()(xs, ys).alias("crosses"))


@query(f"""with {C._POLY}, e as (select *, {C._AREA} as area, list_sum(list_transform(range(0, len(v) // 2), lambda i: sqrt((v[2 * ((i + 1) % (len(v) // 2)) + 1] - v[2 * i + 1]) ** 2 + (v[2 * ((i + 1) % (len(v) // 2)) + 2] - v[2 * i + 2]) ** 2))) as around from poly where len(v) >= 6)
 select file_id, line_no::integer as line_no, round(around, 6) as perimeter, round(around * around / nullif(area, 0), 3) as compactness from e where area > 0.0001 or area = 0""")
def mth06_compactness(spark, d):
    p = C._polygons(spark, d).where(F.size("p") >= 3).select("file_id", "line_no", G.perimeter(F.col("p")).alias("a"), G.area(F.col("p")).alias("s"))
    return p.where("s > 0.0001 or s = 0").select("file_id", "line_no", F.round("a", 6).alias("perimeter"), F.round(G.compactness(F.col("a"), F.col("s")), 3).alias("compactness"))


@query("""with e as (select vec_id, list_transform(embedding, lambda x: x::double) as v from embeddings where len(embedding) = 64)
 select vec_id, list_aggregate(list_transform(range(0, 64), lambda k: case when v[(k // 8) * 8 + k % 8 + 1] > coalesce(v[(k // 8) * 8 + k % 8 + 2], v[1]) and k % 8 < 7 then '1' when k % 8 < 7 then '0' else '' end), 'string_agg', '') as bits from e""")
def mth10_difference_hash(spark, d):
    e = table(spark, d, "embeddings").where("size(embedding) = 64").select("vec_id", F.transform("embedding", lambda v: v.cast("double")).alias("v"))
    return e.select("vec_id", F.lpad(F.bin(T.difference_hash(F.col("v"), 8, 8)), 56, "0").alias("bits"))


@query(f"""with {C._CLS} select class_id, class_name from cb""")
def map04_inverted(spark, d):
    from frond.sources.readers import inverted

    return inverted(C._class_lists(spark, d)[0].select("class_name", "class_id"), "class_name", "class_id")


@query(f"""with {C._IMG}, ok as (select crop, image_id, file_size from img where file_size is not null and crop = 'leek'), c as (select image_id from ok where image_id % 3 = 0)
 select image_id, true as chosen from c union all select image_id, false from (select image_id from ok where image_id not in (select image_id from c) order by file_size desc, image_id limit greatest(0, 500 - (select count(*) from c)))""")
def top11_backfill(spark, d):
    i = C.images(spark, d).where("crop = 'leek' and file_size is not null").select("image_id", "file_size", F.lit(False).alias("chosen"))
    return splits.backfill(i.where("image_id % 3 = 0").withColumn("chosen", F.lit(True)), i, "image_id", 500, [F.desc("file_size"), F.col("image_id")]).select("image_id", "chosen")


@query(f"with {C._IMG} select image_id, row_number() over (order by split nulls first, filename nulls first, image_id) as place from img")
def top07_total_order(spark, d):
    return splits.renumber(C.images(spark, d).select("image_id", "split", "filename"), ["split", "filename", "image_id"], "place").select("image_id", "place")


@query(f"with {C._LINES} select file_id, line_no::integer as line_no, try_cast(case when regexp_full_match(t[1], '[+-]?[0-9]+') then t[1] end as bigint) as class_id, len(list_filter(t[2:], lambda x: try_cast(x as double) is null))::integer as bad, len(t) >= 7 and len(t) % 2 = 1 and len(list_filter(t[2:], lambda x: x::double < 0 or x::double > 1)) = 0 as valid from tk")
def arr08_line_check(spark, d):
    t = L.tokens(F.col("line"))
    ln = L.lines(table(spark, d, "label_files")).withColumn("t", t)
    bad = F.size(F.filter(F.slice("t", 2, F.greatest(F.size("t") - 1, F.lit(0))), lambda x: L.strict_float(x).isNull()))
    return ln.select("file_id", "line_no", L.strict_int(F.get("t", F.lit(0))).alias("class_id"), bad.alias("bad"), L.line_reason(F.col("t"), "strict_odd7").isNull().alias("valid"))


# ---- pictures: the 64 numbers of an embedding as 8 x 8 grey values, or 7 x 3 pixels of three bands --------


def _pictures(spark, d, w: int, h: int, n: int):
    e = table(spark, d, "embeddings").where("vec_id is not null and size(embedding) = 64")
    v = F.transform(F.slice("embedding", 1, w * h * n), lambda x: F.greatest(F.lit(0), F.least(F.lit(255), F.floor(x.cast("double") * 400 + 128).cast("int"))))
    data = F.unhex(F.array_join(F.transform(v, lambda x: F.lpad(F.hex(x), 2, "0")), ""))
    return e.select("vec_id", F.struct(F.lit("").alias("origin"), F.lit(h).alias("height"), F.lit(w).alias("width"), F.lit(n).alias("nChannels"), F.lit(0).alias("mode"), data.alias("data")).alias("image"))


_PX = "px as (select vec_id, list_transform(embedding, lambda x: greatest(0, least(255, floor(x::double * 400 + 128)::integer))) as g from embeddings where vec_id is not null and len(embedding) = 64)"


@query(f"""with {_PX}, m as (select *, list_sum(g) / 64.0 as mean from px), s as (select *, sqrt(list_sum(list_transform(g, lambda x: (x - mean) ** 2)) / 64.0) as sd from m)
 select vec_id, 8 as width, 8 as height, 1 as channels, round(mean, 6) as brightness, round(sd, 6) as contrast, list_aggregate(list_transform(g, lambda x: case when x > mean then '1' else '0' end), 'string_agg', '') as ahash,
  (list_max(g) >> 5)::integer as top_cell from s""")
def img02_grey_measures(spark, d):
    m = X.measure_images(_pictures(spark, d, 8, 8, 1), ["vec_id"])
    top = F.array_max(F.transform(F.filter(F.transform("histogram", lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda s: s["x"] > 0), lambda s: s["i"])) % 8
    return m.select("vec_id", "width", "height", "channels", F.round("brightness", 6).alias("brightness"), F.round("contrast", 6).alias("contrast"), F.lpad(F.bin("ahash"), 64, "0").alias("ahash"), top.cast("int").alias("top_cell"))


@query(f"""with {_PX}, b as (select vec_id, list_transform(g, lambda x: case when x > 150 then 1 else 0 end) as b from px),
 c as (select vec_id, b, list_sum(b) as n, list_filter(range(0, 64), lambda i: b[i + 1] = 1) as spots from b), x as (select *, list_transform(spots, lambda i: i % 8) as xs, list_transform(spots, lambda i: i // 8) as ys from c)
 select vec_id, n::bigint as mask_pixels, round(100.0 * n / 64, 6) as coverage, case when n > 0 then list_min(xs) else 0 end::integer as x, case when n > 0 then list_min(ys) else 0 end::integer as y, case when n > 0 then list_max(xs) - list_min(xs) + 1 else 0 end::integer as w,
  case when n > 0 then list_max(ys) - list_min(ys) + 1 else 0 end::integer as h, case when n > 0 then list_contains(ys, 0)::integer + list_contains(ys, 7)::integer + list_contains(xs, 0)::integer + list_contains(xs, 7)::integer else 0 end as borders, 100.0 * n / 64 < 0.2 as is_tiny, 100.0 * n / 64 > 98.5 as is_huge from x""")
def img05_mask_measures(spark, d):
    m = X.measure_masks(_pictures(spark, d, 8, 8, 1), ["vec_id"], level=150)
    return m.select("vec_id", "mask_pixels", F.round("coverage", 6).alias("coverage"), "x", "y", "w", "h", "borders", "is_tiny", "is_huge")


@query(f"""with recursive {_PX}, b as (select vec_id, i, i % 8 as x, i // 8 as y from (select vec_id, g, unnest(range(0, 64)) as i from px) where g[i + 1] > 150),
 reach(vec_id, a, z) as (select vec_id, i, i from b union select r.vec_id, r.a, n.i from reach r join b m on m.vec_id = r.vec_id and m.i = r.z join b n on n.vec_id = r.vec_id and abs(n.x - m.x) <= 1 and abs(n.y - m.y) <= 1),
 c as (select vec_id, a, min(z) as part from reach group by all), s as (select vec_id, part, count(*) as n from c group by all)
 select vec_id, count(s.n)::integer as components, coalesce(max(s.n), 0)::bigint as largest from px left join s using (vec_id) group by vec_id""")
def img06_components(spark, d):
    return X.measure_masks(_pictures(spark, d, 8, 8, 1), ["vec_id"], level=150).select("vec_id", "components", "largest")


@query(f"""with {_PX}, p as (select vec_id, unnest(list_transform(range(0, 21), lambda i: [g[3 * i + 1]::double, g[3 * i + 2]::double, g[3 * i + 3]::double])) as q from px),
 c as (select vec_id, q[1] as b, q[2] as g, q[3] as r, list_max(q) as v, list_min(q) as lo from p),
 h as (select *, case when v = lo then 0.0 when v = r then 60 * (g - b) / (v - lo) when v = g then 120 + 60 * (b - r) / (v - lo) else 240 + 60 * (r - g) / (v - lo) end as hh, case when v = 0 then 0 else 255 * (v - lo) / v end as s from c),
 k as (select *, case when hh < 0 then hh + 360 else hh end / 2 as hue from h)
 select vec_id, round(count(*) filter (where hue between 30 and 90 and s >= 20 and v >= 20) / 21.0, 6) as green_ratio, round(count(*) filter (where hue between 5 and 28 and s >= 30 and v >= 20) / 21.0, 6) as spot_ratio, round(avg(0.114 * b + 0.587 * g + 0.299 * r), 6) as brightness from k group by vec_id""")
def img03_colour_measures(spark, d):
    m = X.measure_images(_pictures(spark, d, 7, 3, 3), ["vec_id"])
    return m.select("vec_id", F.round("green_ratio", 6).alias("green_ratio"), F.round("spot_ratio", 6).alias("spot_ratio"), F.round("brightness", 6).alias("brightness"))


@query()
def pip03_mask_labels(spark, d):
    """Label lines from the outlines of all pictures read as masks."""
    from frond.plans.pipelines import masks_to_labels

    return masks_to_labels(_pictures(spark, d, 8, 8, 1).join(table(spark, d, "embeddings").select("vec_id", "label"), "vec_id"), "vec_id", "label", min_area=2.0)
