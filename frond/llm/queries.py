"""Queries and SQL of the operators in this package."""

from __future__ import annotations

from pyspark.sql import functions as F

from frond.functions import keys as K
from frond.llm import components, leakage, mixing, overlap, quota, spans, variety
from frond.plans.tables import table

SHARES = {"train": 0.8, "val": 0.1, "test": 0.1}
SUBSET = 1000


def _entities():
    return [K.digest(F.col("sha256_hash")), K.plant_key(F.col("disease_name"), F.col("plant_tag"))]


def p1_found(spark, d):
    return components.related_groups(table(spark, d, "raw_pairs"), "pair_id", _entities())


def p1_splits(spark, d):
    return components.grouped_splits(table(spark, d, "raw_pairs"), "pair_id", _entities(), SHARES)


def p4_found(spark, d):
    return overlap.image_pairs(table(spark, d, "dataset_images"))


def p4_report(spark, d):
    return overlap.overlap_report(table(spark, d, "dataset_images"))


def p5_found(spark, d):
    return variety.crowded_cells(table(spark, d, "audit_images"))


def p5_subset(spark, d):
    return variety.varied_subset(table(spark, d, "audit_images"), SUBSET)


def p5_varied(spark, d):
    """The subset over binned sizes, so that all of their range is in it."""
    return variety.spread_subset(table(spark, d, "audit_images"), SUBSET)


def p6_found(spark, d):
    return quota.unmet_targets(spark, table(spark, d, "raw_pairs"), table(spark, d, "crop_recommendations"), table(spark, d, "sample_targets"))


def p6_targets(spark, d):
    """Supply of every target and whether it can be met."""
    t = table(spark, d, "sample_targets")
    units = {"disease_name": quota.disease_units(table(spark, d, "raw_pairs")), "category": quota.category_units(table(spark, d, "crop_recommendations"))}
    plans = [quota.calibrate(u, quota.target_rows(t, f)) for f, u in units.items()]
    return plans[0].unionByName(plans[1]).select("target_id", "supply", "quota", F.round("probability", 9).alias("probability"), "met", F.round("gap", 6).alias("gap"))


def _samples(spark, d):
    """(field, plan, sample) of each field."""
    pairs, items, t = table(spark, d, "raw_pairs"), table(spark, d, "crop_recommendations"), table(spark, d, "sample_targets")
    for f in ("disease_name", "category"):
        units = quota.units_of(f, pairs, items)
        plan = quota.calibrate(units, quota.target_rows(t, f))
        yield f, plan, quota.pivotal_sample(units, plan)


def p6_sample(spark, d):
    """The samples by disease_name (unit_id is a pair_id) and by category (a rec_id)."""
    a, b = [s.select(F.lit(f).alias("field_name"), "unit_id", "key") for f, _, s in _samples(spark, d)]
    return a.unionByName(b)


def p7_found(spark, d):
    return leakage.leaked_pairs(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p7_kinds(spark, d):
    """Leaks by kind; the names of crops come from the corpus."""
    docs = table(spark, d, "documents")
    return leakage.leak_kinds(docs, table(spark, d, "eval_items"), names=leakage.NAMES | leakage.listed_names(docs, "crop"))


def p8_found(spark, d):
    return mixing.short_sources(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p8_mix(spark, d):
    return mixing.mixed(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p8_report(spark, d):
    return mixing.mix_report(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p9_found(spark, d):
    return spans.stretch_pairs(table(spark, d, "documents"))


def p9_shares(spark, d):
    return spans.stretch_shares(table(spark, d, "documents"))


def p9_stretches(spark, d):
    return spans.shared_stretches(table(spark, d, "documents"))


def p6_report(spark, d):
    """Wanted and drawn rows of every target of both fields, with the gap."""
    out = []
    for f, plan, sample in _samples(spark, d):
        drawn = sample.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        n = F.when(F.col("quota") > 0, F.coalesce("n", F.lit(0))).otherwise(0).cast("bigint")
        out.append(plan.join(drawn, "key", "left").select(F.lit(f).alias("field_name"), "target_id", "key", "share", "min_rows", "supply", "quota", n.alias("drawn"), "met", F.round("gap", 6).alias("gap")))
    return out[0].unionByName(out[1])


def p9_cleaned(spark, d):
    return spans.without_repeats(table(spark, d, "documents"))


QUERIES = {
    f.__name__: f
    for f in (p1_found, p1_splits, p4_found, p4_report, p5_found, p5_subset, p5_varied, p6_found, p6_targets, p6_sample, p6_report, p7_found, p7_kinds, p8_found, p8_mix, p8_report, p9_found, p9_shares, p9_stretches, p9_cleaned)
}

_KEY = "nullif(trim(regexp_replace(lower({c}), '[^a-z0-9]+', ' ', 'g')), '')"
_DIGEST = "nullif(lower(trim(sha256_hash)), '')"

_GROUPS = f"""
tags as (
  select pair_id, {_DIGEST} as h, {_KEY.format(c='disease_name')} as k, regexp_replace(upper(plant_tag), '[^A-Z0-9]', '', 'g') as t
  from raw_pairs where pair_id is not null
),
links as (
  select distinct pair_id as a, 'h' || h as e from tags where h is not null
  union select distinct pair_id, 'p' || k || '|' || t from tags where k is not null and t is not null and t not in ('', 'UNKNOWN', 'NA', 'NONE')
),
edges as (
  select distinct l.a, m.b from links l join (select e, min(a) as b, count(*) as n from links group by e) m using (e) where n > 1 and a <> b
),
both_ways as (select a, b from edges union select b, a from edges),
reach(a, b) as (select distinct a, a from both_ways union select r.a, w.b from reach r join both_ways w on r.b = w.a),
groups as (select a as pair_id, min(b) as group_id from reach group by a)
"""

_UNIT = "cast(('0x' || substr(sha256('7:' || {c}), 1, 13))::bigint as double) / 4503599627370496.0"

_IMAGES = f"""
base as (
  select image_id, lower(trim(split)) as s, coalesce(lower(trim(dataset_source)), '') as source, {_DIGEST} as h,
         regexp_replace(lower(trim(phash)), '^0x', '') as p
  from dataset_images where image_id is not null
),
images as (
  select image_id, source, h,
    case when s in ('train', 'training') then 'train' when s in ('val', 'validation') then 'val' when s in ('test', 'testing') then 'test' end as split,
    case when regexp_full_match(p, '0*[0-9a-f]{{1,16}}') then ('0x' || lpad(right(p, 16), 16, '0'))::ubigint end as fp
  from base
),
pairs as (
  select t.image_id as t, e.image_id as e, e.split, e.source, coalesce(t.h = e.h, false) as same, coalesce(bit_count(xor(t.fp, e.fp)) <= 5, false) as near
  from images t join images e on t.split = 'train' and e.split in ('val', 'test') and (t.h = e.h or bit_count(xor(t.fp, e.fp)) <= 5)
)
"""

_USABLE = """
latest as (
  select *, row_number() over (partition by audit_id order by audited_at desc nulls last, width desc nulls last) as r from audit_images where audit_id is not null
),
usable as (
  select audit_id, greatest(width, height) as long_side, least(width, height) as short_side, cast(floor(mask_coverage_pct / 5) as integer) as coverage_band
  from latest where r = 1 and not coalesce(is_corrupted, false) and width > 0 and height > 0 and mask_coverage_pct between 0 and 100 and not isnan(mask_coverage_pct)
)
"""

_SUPPLY = f"""
units as (
  select distinct 'disease_name' as f, pair_id as u, {_KEY.format(c='disease_name')} as k from raw_pairs where not coalesce(is_corrupted, false) and pair_id is not null
  union all
  select distinct 'category', rec_id, {_KEY.format(c='category')} from crop_recommendations where confidence between 0 and 100 and rec_id is not null
),
supply as (select f, k, count(*) as n from units where k is not null group by f, k),
targets as (
  select target_id, lower(trim(t.field_name)) as f, {_KEY.format(c='t.key_value')} as k, coalesce(target_share, 0) as share, coalesce(n, 0) as supply, coalesce(sample_size, 0) as size,
    coalesce(target_share, 0) * coalesce(sample_size, 0) as wish, coalesce(min_rows, 0) as least
  from sample_targets t left join supply s on s.f = lower(trim(t.field_name)) and s.k = {_KEY.format(c='t.key_value')}
)
"""

# the sum of the clamped wishes is straight between the factors at which a wish meets a bound
_QUOTAS = f"""{_SUPPLY},
named as (select *, k is null or row_number() over (partition by f, k order by target_id) > 1 as again from targets),
b as (select target_id, f, k, wish, least(least, supply)::double as low, supply::double as high, max(size) over (partition by f) as size from named where not again),
turns as (select distinct f, c from (select f, low / wish as c from b where wish > 0 union all select f, high / wish from b where wish > 0 union all select f, 0.0 from b)),
sums as (select a.f, a.c, sum(case when wish > 0 then least(high, greatest(low, a.c * wish)) else low end) as s, sum(case when wish > 0 and low <= a.c * wish and a.c * wish < high then wish else 0 end) as slope, any_value(size) as size from turns a join b on a.f = b.f group by a.f, a.c),
factor as (select f, coalesce(arg_max(c + case when slope > 0 then (size - s) / slope else 0 end, c) filter (where s <= size), 0) as factor from sums group by f),
parts as (select b.*, case when wish > 0 then least(high, greatest(low, factor * wish)) else low end as part from b join factor using (f)),
whole as (select *, least(high, floor(part + 1e-9)) as base, round(sum(part) over (partition by f)) as total from parts),
ranks as (select *, total - sum(base) over (partition by f) as short, row_number() over (partition by f, base < high and part > base + 1e-9 order by part - base desc, target_id) as place from whole),
quotas as (select target_id, greatest(low, base + case when base < high and part > base + 1e-9 and place <= short then 1 else 0 end)::bigint as quota from ranks),
planned as (select n.*, coalesce(q.quota, 0) as quota, not (supply < wish or supply < least) as met, round(greatest(0.0, greatest(wish, least) - coalesce(q.quota, 0)), 6) as gap from named n left join quotas q using (target_id))
"""

_WORDS = r"""
regexp_extract_all(lower(regexp_replace(regexp_replace(regexp_replace(text, '</?\p{L}[^<>]*>', '', 'g'), '[\x{00AD}\x{200B}]', '', 'g'), '-\r?\n', '', 'g')), '[\p{L}\p{N}]+')
"""

_LEAKS = f"""
iw as (select item_id, {_WORDS} as w from eval_items),
dw as (select doc_id, {_WORDS} as w from documents where text is not null),
ig as (
  select distinct item_id, least(12, len(w)) as n, unnest(list_transform(range(1, len(w) - least(12, len(w)) + 2), lambda i: array_to_string(w[i:i + least(12, len(w)) - 1], ' '))) as g
  from iw where len(w) > 0
),
dg as (
  select distinct doc_id, n, unnest(list_transform(range(1, greatest(1, len(w) - n + 2)), lambda i: array_to_string(w[i:i + n - 1], ' '))) as g
  from dw, (select distinct n from ig)
)
"""

# words, and words by form: capitals inside sentences mark names unless there are too many of them
_KINDS = rf"""
lex as (select w, min(k) as k from (select unnest([{', '.join(repr(u) for u in sorted(leakage.UNITS))}]) as w, 2 as k union all select unnest([{', '.join(repr(u) for u in sorted(leakage.NAMES))}]), 3
  union all select distinct lower(trim(crop)), 3 from documents where regexp_full_match(lower(trim(crop)), '\p{{L}}+')) group by w),
texts as (select 'i' as src, item_id as id, text from eval_items where item_id is not null union all select 'd', doc_id, text from documents where doc_id is not null),
plain as (select src, id, regexp_replace(regexp_replace(regexp_replace(text, '</?\p{{L}}[^<>]*>', '', 'g'), '[\x{{00AD}}\x{{200B}}]', '', 'g'), '-\r?\n', '', 'g') as t from texts where text is not null),
wt as (select src, id, unnest(ws) as w, generate_subscripts(ws, 1) as pos from (select src, id, regexp_extract_all(lower(t), '[\p{{L}}\p{{N}}]+') as ws from plain)),
ft as (select src, id, unnest(ws) as w, generate_subscripts(ws, 1) as pos from (select src, id, regexp_extract_all(t, '\p{{Nd}}+(?:[.,]\p{{Nd}}+)*|[\p{{L}}\p{{Nl}}\p{{No}}]+|[.!?:\n]') as ws from plain)),
fm as (select *, w in ('.', '!', '?', ':', chr(10)) as mark, coalesce(lag(w) over (partition by src, id order by pos) in ('.', '!', '?', ':', chr(10)), true) as head, w[1] = upper(w[1]) and w[1] <> lower(w[1]) as cap from ft),
fs as (select src, id, count(*) filter (where not mark and not head) as inside, count(*) filter (where not mark and not head and cap) as caps from fm group by all),
fn as (select distinct src, id, lower(w) as w from fm where not mark and not head and cap),
fw as (select m.src, m.id, m.pos, case when cap and (not head or n.w is not null) and not (inside >= 20 and caps > 0.15 * inside) then '^' else '' end || lower(m.w) as w
  from fm m join fs using (src, id) left join fn n on n.src = m.src and n.id = m.id and n.w = lower(m.w) where not mark),
tok as (select 'w' as cut, * from wt union all select 'f' as cut, src, id, w, pos from fw),
typed as (select tok.*, case when starts_with(tok.w, '^') then '<3>' when regexp_full_match(tok.w, '\p{{Nd}}+([.,]\p{{Nd}}+)*') then '<1>' when k = 2 then '<2>' when k = 3 then '<3>' else tok.w end as t from tok left join lex using (w)),
seqs as (select cut, src, id, list(w order by pos) as ws, list(t order by pos) as ts, count(*) as n from typed group by all),
iwin as (select distinct cut, item_id, k, array_to_string(ts[i:i + k - 1], ' ') as tpl, array_to_string(ws[i:i + k - 1], ' ') as iw from (select cut, id as item_id, least(12, n) as k, ts, ws, unnest(range(1, n - least(12, n) + 2)) as i from seqs where src = 'i')),
dwin as (select distinct cut, doc_id, k, tpl, array_to_string(ws[i:i + k - 1], ' ') as dw from (
  select *, array_to_string(ts[i:i + k - 1], ' ') as tpl from (select s.cut, id as doc_id, k, ts, ws, unnest(range(1, n - k + 2)) as i from seqs s join (select distinct cut, k from iwin) l on l.cut = s.cut where src = 'd' and n >= k))
  where (cut, k, tpl) in (select (cut, k, tpl) from iwin)),
met as (select cut, doc_id, item_id, iw, dw from dwin join iwin using (cut, k, tpl)),
slots as (select distinct cut, doc_id, item_id, ltrim(p.a, '^') as a, ltrim(p.b, '^') as b from (select cut, doc_id, item_id, unnest(list_transform(list_zip(string_split(iw, ' '), string_split(dw, ' ')), lambda z: struct_pack(a := z[1], b := z[2]))) as p from met)
  left join lex on lex.w = p.a where lex.w is not null or starts_with(p.a, '^') or regexp_full_match(p.a, '[0-9]+([.,][0-9]+)*')),
torn as (select cut, doc_id, item_id from slots group by all having count(*) <> count(distinct a) or count(*) <> count(distinct b)),
good as (select distinct doc_id, item_id, replace(iw, '^', '') as iw, replace(dw, '^', '') as dw from met left join (select *, true as t from torn) torn using (cut, doc_id, item_id)
  where case when cut = 'w' then iw = dw or t is null else iw <> dw and t is null end)
"""

# every window of 300 characters; those that another document has too, merged where they overlap
_STRETCHES = """
lt as (select distinct doc_id, text from documents where length(text) >= 300 and doc_id is not null),
win as (select doc_id, s, md5(substr(text, s + 1, 300)) as g from (select doc_id, text, unnest(range(0, length(text) - 299)) as s from lt)),
twice as (select g from win group by g having min(doc_id) < max(doc_id)),
hit as (select doc_id, s from win semi join twice using (g)),
marked as (select *, count(*) filter (where lead_s is null or s >= lead_s + 300) over (partition by doc_id order by s) as part
  from (select doc_id, s, lag(s) over (partition by doc_id order by s) as lead_s from hit))
"""

# sentences with their places; runs of two or more with 300 characters, the shortest from and to each sentence
_BLANK = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_RUNS = rf"""
cutting as (select doc_id, text, regexp_extract_all(text, '(?s).*?(?:[.!?]+["'')\]]*{_BLANK}+|{_BLANK}*\n{_BLANK}*)|.+') as ps from documents where doc_id is not null and text <> ''),
pcs as (select doc_id, unnest(ps) as piece, generate_subscripts(ps, 1) as i from cutting),
sen as (select *, sum(length(piece)) over (partition by doc_id order by i) - length(piece) as a,
  sum(length(piece)) over (partition by doc_id order by i) - length(piece) + length(regexp_replace(piece, '{_BLANK}+$', '')) as z from pcs),
runs as (
  select x.doc_id, x.i, x.a, min(y.z) as z from sen x join sen y on x.doc_id = y.doc_id and y.i > x.i and y.z - x.a >= 300 group by all
  union
  select y.doc_id, max(x.i), max(x.a), y.z from sen x join sen y on x.doc_id = y.doc_id and y.i > x.i and y.z - x.a >= 300 group by y.doc_id, y.i, y.z
),
named as (select r.*, md5(substr(d.text, r.a::int + 1, (r.z - r.a)::int)) as h from runs r join documents d using (doc_id)),
repeated as (select doc_id, a, z from (select *, count(*) over (partition by h) as n, row_number() over (partition by h order by doc_id, i) as place from named) where n > 1 and place > 1)
"""

ORACLES = {
    "p1_found": f"with recursive {_GROUPS} select group_id, pair_id from groups",
    "p1_splits": f"""
      with recursive {_GROUPS},
      whole as (select i.pair_id, coalesce(g.group_id, i.pair_id) as group_id from (select distinct pair_id from raw_pairs where pair_id is not null) i left join groups g using (pair_id))
      select pair_id, group_id, case when u < 0.8 then 'train' when u < 0.9 then 'val' else 'test' end as split
      from (select *, {_UNIT.format(c='group_id')} as u from whole)""",
    "p4_found": f"with {_IMAGES} select distinct least(t, e) as image_id_a, greatest(t, e) as image_id_b from pairs where t <> e",
    "p4_report": f"""
      with {_IMAGES},
      held as (select e, bool_or(same) as same, bool_or(near) as near from pairs group by e)
      select split, source, count(*) as images, count(*) filter (where same) as same_hash, count(*) filter (where near) as near, count(*) filter (where same or near) as leaked
      from images i left join held on e = image_id where split in ('val', 'test') group by split, source""",
    "p5_found": f"""
      with {_USABLE} select long_side, short_side, coverage_band from usable group by all having count(*) >= 0.02 * (select count(*) from usable)""",
    "p5_subset": f"""
      with {_USABLE},
      ranked as (select *, row_number() over (partition by long_side, short_side, coverage_band order by {_UNIT.format(c='audit_id')}, audit_id) as cell_rank from usable)
      select audit_id, long_side, short_side, coverage_band, cell_rank from ranked order by cell_rank, long_side, short_side, coverage_band limit {SUBSET}""",
    "p5_varied": f"""
      with {_USABLE},
      fine as (select *, floor(log2(long_side) * 8)::int as lf, floor(log2(short_side) * 8)::int as sf from usable),
      grids as (select j, count(*) as n from (select distinct j, lf // (1 << j) as l, sf // (1 << j) as s, coverage_band from fine, (select unnest(range(0, 9))::int as j)) group by j),
      binned as (select *, lf // (1 << j) as long_bin, sf // (1 << j) as short_bin from fine, (select coalesce(min(j) filter (where n < {SUBSET}), 8) as j from grids)),
      ranked as (select *, row_number() over (partition by long_bin, short_bin, coverage_band order by {_UNIT.format(c='audit_id')}, audit_id) as cell_rank from binned)
      select audit_id, long_side, short_side, coverage_band, long_bin::int as long_bin, short_bin::int as short_bin, cell_rank from ranked
      order by cell_rank, sha256('7:' || long_bin || ':' || short_bin || ':' || coverage_band), long_bin, short_bin, coverage_band limit {SUBSET}""",
    "p6_found": f"with {_SUPPLY} select target_id from targets where supply < wish or supply < least",
    "p6_targets": f"with {_QUOTAS} select target_id, supply, quota, round(case when quota > 0 then least(1.0, quota / supply) else 0.0 end, 9) as probability, met, gap from planned where f in ('disease_name', 'category')",
    # the pivotal method hits every quota exactly
    "p6_report": f"with {_QUOTAS} select f as field_name, target_id, k as key, share, least as min_rows, supply, quota, quota as drawn, met, gap from planned where f in ('disease_name', 'category')",
    "p7_found": f"with {_LEAKS} select distinct doc_id, item_id from ig join dg using (n, g)",
    "p7_kinds": f"with {_KINDS} select doc_id, item_id, count(*) filter (where iw = dw) as same_windows, count(*) filter (where iw <> dw) as changed_windows from good group by doc_id, item_id",
    # characters stand in for tokens: the comparison is far from equal for every source
    "p8_found": """
      with s as (select lower(trim(source)) as source, sum(length(coalesce(text, ''))) as n from documents group by 1)
      select lower(trim(m.source)) as source from mix_targets m left join s on s.source = lower(trim(m.source))
      where m.max_repeats * coalesce(n, 0) < target_share * (select sum(n) from s)""",
    "p9_found": """
      with t as (select distinct doc_id, text from documents where length(text) >= 300 and doc_id is not null),
      w as (select distinct doc_id, md5(substr(text, i, 300)) as g from (select doc_id, text, unnest(range(1, length(text) - 298)) as i from t)),
      r as (select g from w group by g having count(*) > 1),
      x as (select doc_id, g from w semi join r using (g))
      select distinct a.doc_id as doc_id_a, b.doc_id as doc_id_b from x a join x b on a.g = b.g and a.doc_id < b.doc_id""",
    "p9_stretches": f"with {_STRETCHES} select doc_id, min(s)::int as start, max(s + 300)::int as end from marked group by doc_id, part",
    "p9_shares": f"""
      with {_STRETCHES}, {_RUNS},
      sized as (select doc_id, max(length(coalesce(text, ''))) as n_chars from documents where doc_id is not null group by doc_id),
      shared as (select doc_id, sum(e - s) as n from (select doc_id, min(s) as s, max(s + 300) as e from marked group by doc_id, part) group by doc_id),
      spots as (select distinct doc_id, a, z from repeated),
      fresh as (select doc_id, greatest(0, z - greatest(a, coalesce(max(z) over (partition by doc_id order by a, z rows between unbounded preceding and 1 preceding), 0))) as n from spots),
      removable as (select doc_id, sum(n) as n from fresh group by doc_id)
      select doc_id, n_chars, coalesce(s.n, 0)::bigint as shared_chars, coalesce(r.n, 0)::bigint as removable_chars from sized left join shared s using (doc_id) left join removable r using (doc_id)""",
    "p9_cleaned": f"""
      with {_RUNS},
      kept as (select s.doc_id, string_agg(s.piece, '' order by s.i) as t from sen s where not exists (select 1 from repeated r where r.doc_id = s.doc_id and r.a <= s.a and s.a < r.z) group by s.doc_id)
      select d.doc_id, case when d.text is null then null else coalesce(k.t, '') end as text from documents d left join kept k using (doc_id) where d.doc_id is not null""",
}
