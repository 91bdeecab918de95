"""What a user runs from end to end, composed of the operators. All are functions of DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from frond.functions import geometry as G
from frond.functions import labels as L
from frond.operators import dedup, pairing, predictions, select, splits, stats
from frond.operators.skew import merged_if_large
from frond.sources import readers
from frond.storage import Scratch


def count_by(df: DataFrame, *cols: str) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def subset(images: DataFrame, masks: DataFrame, crops: list[str], max_bits: int = 5) -> DataFrame:
    """PIP-01: (image_id, split, outcome) of a subset by crops: images (image_id, split, crop, digest, fp, file).

    In turn: other crops and unknown splits are left out; members of exact leaks that are not the
    first by split are "exact_leak"; of the rest, those of near groups that cross splits "near_leak";
    of what is left, images without a mask (file) "no_mask"; the others are "kept".
    """
    ok = Scratch(images.sparkSession).write(images.where(F.col("crop").isin(crops) & F.col("split").isNotNull()), "wanted")
    report = dedup.leakage_report(ok, "image_id", "digest", "fp", "split", max_bits).where(~F.col("kept"))
    leak = report.select("image_id", F.concat("kind", F.lit("_leak")).alias("leak"))
    have = masks.where("file is not null").select("file").distinct().withColumn("mask", F.lit(True))
    j = ok.select("image_id", "split", "file").join(leak, "image_id", "left").join(have, "file", "left")
    return j.select("image_id", "split", F.coalesce("leak", F.when(F.col("mask").isNull(), "no_mask"), F.lit("kept")).alias("outcome"))


def coco_to_labels(coco: DataFrame, classes: DataFrame) -> DataFrame:
    """PIP-02: (split, image_id, file_name, content) of annotation documents; classes (category_id, class_id).

    Polygons of unmapped categories and of fewer than three points go; coordinates are divided by the
    image's size and clamped. Lines follow annotation and part. Images without a line have ''.
    """
    p = readers.coco_polygons(coco).join(classes, "category_id")
    unit = G.normalize(G.to_points(F.col("flat")), F.col("width"), F.col("height"))
    rows = p.select("split", "image_id", F.struct("annotation_id", "part", L.format_line(F.col("class_id"), unit).alias("t")).alias("x")).where("x.t is not null")
    text = rows.groupBy("split", "image_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["t"]), "\n").alias("content"))
    i = coco.select("split", F.explode("images").alias("i")).select("split", F.col("i.id").alias("image_id"), "i.file_name")
    return i.join(text, ["split", "image_id"], "left").withColumn("content", F.coalesce("content", F.lit("")))


def masks_to_labels(masks: DataFrame, id_col: str, cls: str, min_area: float = 10.0, epsilon_ratio: float = 0.005) -> DataFrame:
    """PIP-03: (id, split, content, reason) of rows with an ``image`` column: the mask's outlines as label lines.

    Split by WN-03 within the class. A mask without a valid outline has content '' and the reason of
    its first refused outline, or "empty".
    """
    from frond.functions.pixels import mask_labels

    placed = splits.stratified_split(masks.select(id_col, cls), cls, id_col).select(id_col, "split")
    return mask_labels(masks, [id_col, cls], cls, min_area, epsilon_ratio).join(placed, id_col).select(id_col, "split", "content", "reason")


def merged(base: DataFrame, new: DataFrame) -> DataFrame:
    """PIP-04: (image_id, dataset_source, new_name): versions merged by digest, output names made unique.

    Baseline rows come first and keep their names; images without a name have none.
    """
    m = Scratch(base.sparkSession).write(pairing.merge_versions(base, new, "digest", "image_id", F.col("filename")).select("image_id", "dataset_source", "filename"), "merged")
    named = splits.collision_names(m, "filename", ["dataset_source", "image_id"]).select("image_id", "dataset_source", "new_name")
    return named.unionByName(m.where("filename is null").select("image_id", "dataset_source", F.lit(None).cast("string").alias("new_name")))


def merged_labels(lines: DataFrame, classes: DataFrame) -> DataFrame:
    """PIP-04: label lines with the ids of the merged class list, as JN-12 gives it; unmapped ids are kept and flagged."""
    return L.remap_lines(lines, classes, "flag")


def audit_gate(images: DataFrame, audits: DataFrame, files: DataFrame) -> DataFrame:
    """PIP-05: one row: the quality score with its parts, and what blocks training (blocking, ready).

    images (digest, split), audits (is_corrupted, label_exists, is_healthy, polygon_count), files
    (file_id, content). Blocking, in order: corrupted, leaks, polygons, healthy.
    """
    scratch = Scratch(images.sparkSession)
    polys = scratch.write(L.audit_polygons(files.select("file_id", "content")).select("class_id", "reason"), "polygons")
    leaks = scratch.write(dedup.pairwise_shared(images, "digest"), "leaks")
    score = stats.quality_score(audits, polys, leaks, stats.imbalance(polys, "class_id"))
    a = audits.agg(F.count_if(F.coalesce("is_corrupted", F.lit(False))).alias("c"), F.count_if(F.coalesce(F.col("is_healthy") & (F.col("polygon_count") > 0), F.lit(False))).alias("h"))
    one = score.crossJoin(a).crossJoin(leaks.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("l"))).crossJoin(polys.agg(F.count_if(F.col("reason") != "OK").alias("p")))  # single rows
    blocking = F.concat_ws(",", *[F.when(F.col(c) > 0, n) for c, n in (("c", "corrupted"), ("l", "leaks"), ("p", "polygons"), ("h", "healthy"))])
    return one.select(*score.columns, blocking.alias("blocking"))


def scorecards(pairs: DataFrame, cls: str) -> DataFrame:
    """PIP-06: (class, n, corrupted, usable, mean_size, health, rating, readiness): pairs (id, class, is_corrupted, file_size).

    readiness rates the share of usable images in percent, times the share of 100 images there are.
    """
    g = pairs.where(F.col(cls).isNotNull()).groupBy(cls).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce("is_corrupted", F.lit(False))).alias("corrupted"), F.round(F.avg("file_size"), 3).alias("mean_size"))
    usable = F.col("n") - F.col("corrupted")
    score = 100.0 * usable / F.col("n") * F.least(F.lit(1.0), usable / 100.0)
    return g.select(cls, "n", "corrupted", usable.alias("usable"), "mean_size", stats.class_health(usable).alias("health"), stats.class_rating(usable).alias("rating"), stats.readiness(score).alias("readiness"))


def curated(images: DataFrame, min_quality: float, max_bits: int = 5) -> DataFrame:
    """PIP-07: (image_id, outcome): images (image_id, crop, digest, fp, quality, corrupted) of the healthy class.

    In turn: "corrupted"; not the best of its digest "exact_duplicate"; not the best of its near group
    inside the crop "near_duplicate"; quality below the least, or none, "low_quality"; else "kept".
    Best is the greatest quality, then the smallest id.
    """
    scratch = Scratch(images.sparkSession)
    i = scratch.write(images.select("image_id", "crop", "digest", "fp", "quality", F.coalesce("corrupted", F.lit(False)).alias("bad")), "images")
    best = [F.coalesce(-F.col("quality"), F.lit(float("inf")))]
    once = scratch.write(dedup.first_wins(i.where("not bad"), "digest", "image_id", best).withColumn("copy", F.col("first_id") != F.col("image_id")).drop("first_id"), "once")
    left = once.where("not copy")
    # near groups are sought over all crops and cut by crop
    comp = dedup.near_components(left, "image_id", "fp", max_bits, ("crop", "quality"))
    inside = comp.select("image_id", "quality", F.concat_ws("|", F.col("component").cast("string"), F.coalesce("crop", F.lit(""))).alias("_k"))
    alone = left.where("fp is null or image_id is null").select("image_id", "quality", F.lit(None).cast("string").alias("_k"))
    near = dedup.first_wins(scratch.write(inside.unionByName(alone), "grouped"), "_k", "image_id", best)
    low = F.col("quality").isNull() | (F.col("quality") < min_quality)
    out = near.select("image_id", F.when(F.col("first_id") != F.col("image_id"), "near_duplicate").when(low, "low_quality").otherwise("kept").alias("outcome"))
    return out.unionByName(once.where("copy").select("image_id", F.lit("exact_duplicate").alias("outcome"))).unionByName(i.where("bad").select("image_id", F.lit("corrupted").alias("outcome")))


def curated_selection(images: DataFrame, min_quality: float, k: int, max_bits: int = 5) -> DataFrame:
    """PIP-07: (crop, image_id, place): of the images that curation keeps, k of each crop that differ most."""
    scratch = Scratch(images.sparkSession)
    kept = scratch.write(curated(images, min_quality, max_bits).where("outcome = 'kept'").select("image_id"), "ids")
    rows = images.join(merged_if_large(kept), "image_id", "left_semi").select("crop", "image_id", "fp", "quality")
    return select.farthest_point(scratch.write(rows, "kept"), "crop", "image_id", "fp", "quality", k)


def validation(images: DataFrame, labels: DataFrame) -> DataFrame:
    """PIP-08: (check, problem, n) of a label tree: images (file, split, stem), labels (file_id, file, content).

    Pairing, label lines by the two rule sets for polygons, coordinates and points of each polygon,
    and stems that two splits share.
    """
    scratch = Scratch(images.sparkSession)
    pair = count_by(pairing.pair_status(images, labels, "file").where("status <> 'paired'"), "status").select(F.lit("pairing").alias("check"), F.col("status").alias("problem"), "n")
    out = pair
    for rule in ("strict_odd7", "even_coords7"):
        bad = L.label_status(labels, rule).where("reason is not null")
        out = out.unionByName(count_by(bad, "reason").select(F.lit(rule).alias("check"), F.col("reason").alias("problem"), "n"))
    audit = scratch.write(L.audit_polygons(labels.select("file_id", "content")).select("reason", "has_duplicate_points"), "audit")
    out = out.unionByName(count_by(audit.where("reason <> 'OK'"), "reason").select(F.lit("polygon").alias("check"), F.col("reason").alias("problem"), "n"))
    out = out.unionByName(audit.where("has_duplicate_points").agg(F.count(F.lit(1)).alias("n")).select(F.lit("points").alias("check"), F.lit("repeated_point").alias("problem"), "n").where("n > 0"))
    stems = dedup.pairwise_shared(images.select("stem", "split"), "stem").where("n > 0")
    return out.unionByName(stems.select(F.lit("stems").alias("check"), F.concat_ws("-", "split_a", "split_b").alias("problem"), "n"))


def healthy_classes(classes: DataFrame, fallback_id: int | None = None) -> DataFrame:
    """PRJ-11: (class_id, class_name, healthy): by the name, or from ``fallback_id`` on where a class has no name."""
    named = F.lower("class_name").contains("healthy")
    return classes.select("class_id", "class_name", F.coalesce(named, F.lit(False) if fallback_id is None else F.col("class_id") >= fallback_id).alias("healthy"))


def healthy_to_background(files: DataFrame, classes: DataFrame) -> DataFrame:
    """PIP-09: (file_id, kind, lines, content): healthy classes become background, disease ids close up.

    classes as ``healthy_classes`` gives them. Disease classes are numbered anew in the order of their
    ids. A file keeps its disease lines, so one with healthy lines only is an empty file, as is one
    without lines. kind: disease, healthy or unknown (no lines).
    """
    sick = classes.where("not healthy")
    new = sick.select("class_id", (F.row_number().over(W.partitionBy(F.lit(1)).orderBy("class_id")) - 1).cast("int").alias("new_id"))  # a label set is small
    ln = L.lines(files).select("file_id", "line_no", L.tokens(F.col("line")).alias("t")).withColumn("class_id", F.get("t", F.lit(0)).try_cast("int"))
    kind = L.image_kind(ln.select("file_id", F.coalesce("class_id", F.lit(-1)).alias("class_id")), files, [r[0] for r in classes.where("healthy").select("class_id").collect()])
    kept = L.remap_lines(ln, new, "drop")
    text = F.array_join(F.concat(F.array(F.col("new_id").cast("string")), F.slice("t", 2, F.size("t"))), " ")
    per = kept.groupBy("file_id").agg(F.count(F.lit(1)).alias("lines"), F.array_sort(F.collect_list(F.struct("line_no", text.alias("x")))).alias("s"))
    per = per.select("file_id", "lines", F.array_join(F.transform("s", lambda x: x["x"]), "\n").alias("content"))
    return kind.join(per, "file_id", "left").select("file_id", "kind", F.coalesce("lines", F.lit(0)).cast("bigint").alias("lines"), F.coalesce("content", F.lit("")).alias("content"))


def statistics_report(images: DataFrame, cls: str) -> DataFrame:
    """PIP-10: (class, train, val, test, total, share, ratio, health): images (class, split)."""
    per = stats.class_by_split(images.where(F.col(cls) != ""), cls, "split")
    b = stats.balance(per.select(cls, F.col("total").alias("n")), cls).select(cls, "share", "ratio")
    return per.join(b, cls).select(cls, "train", "val", "test", "total", "share", "ratio", stats.class_health(F.col("total")).alias("health"))


def cleanup(images: DataFrame, masks: DataFrame) -> DataFrame:
    """PIP-11: (image_id, action): images (image_id, split, digest, file, w, h), masks (file, w, h, coverage).

    The first of: remove_leak (a leak between splits, not its first), remove_copy (a copy inside its
    split), rotate_mask, resize_mask (sizes differ otherwise), none. Without split or digest an image
    is no copy.
    """
    scratch = Scratch(images.sparkSession)
    i = scratch.write(images, "images")
    leak = dedup.resolve_leakage(i.select("image_id", "split", "digest"), "digest", "image_id").where("not kept").select("image_id", F.lit(True).alias("leak"))
    copy = dedup.within_split(i.select("image_id", "split", "digest"), "digest", "image_id").select("image_id", F.lit(True).alias("copy"))
    one = lambda df, *x: df.where("file is not null").groupBy("file").agg(F.min("w").alias("w"), F.min("h").alias("h"), *x)
    status = pairing.mask_status(one(i), one(masks, F.max("coverage").alias("coverage")), "file")
    j = i.select("image_id", "file").join(leak, "image_id", "left").join(copy, "image_id", "left").join(status, "file", "left")
    action = F.when(F.col("leak"), "remove_leak").when(F.col("copy"), "remove_copy").when(F.col("status") == "rotated", "rotate_mask").when(F.col("status") == "size_mismatch", "resize_mask").otherwise("none")
    return j.select("image_id", action.alias("action"))


def segmentation_queue(images: DataFrame, masks: DataFrame, state, batch: str) -> DataFrame:
    """PIP-12: a resumable run over images (rel_path, sha256) with precomputed masks (rel_path, coverage).

    Images that ``state`` does not know as completed are judged by their mask, recorded as one batch,
    and returned as (rel_path, sha256, status): COMPLETED, REVIEW (tiny or huge mask) or FAILED (none).
    """
    m = masks.where("rel_path is not null").groupBy("rel_path").agg(F.max("coverage").alias("coverage"))
    todo = state.pending(images.where("rel_path is not null and sha256 is not null").select("rel_path", "sha256").distinct()).join(m, "rel_path", "left")
    flag = stats.mask_flags(F.col("coverage"))
    status = F.when(F.col("coverage").isNull() | F.isnan("coverage"), "FAILED").when(flag["is_tiny"] | flag["is_huge"], "REVIEW").otherwise("COMPLETED")
    done = Scratch(images.sparkSession).write(todo.select("rel_path", "sha256", status.alias("status")), "run")
    state.record(batch, done)
    return done


def recommendations(requests: DataFrame, scores: DataFrame, crops: DataFrame, k: int = 3) -> DataFrame:
    """PIP-13: (request_id, reason, crop, category, confidence, place): requests checked, then answered.

    requests as ``predictions.checked_requests`` takes them, with request_id and an optional wanted
    category; scores (request_id, crop, prob, ordinal); crops (crop, category), a crop without entry
    being "unknown". A refused request has one row with its reason; one without any score has none.
    """
    r = predictions.checked_requests(requests).select("request_id", F.lower("category").alias("wanted"), "reason")
    s = pairing.with_default(scores, crops, "crop", "category", F.lit("unknown"))
    j = s.join(r.where("reason is null").select("request_id", "wanted"), "request_id")
    top = predictions.top_items(j, "request_id", "crop", F.col("prob"), F.col("ordinal"), k, F.col("wanted").isNull() | (F.col("category") == F.col("wanted")), keep=("category",))
    bad = r.where("reason is not null").select("request_id", "reason", *[F.lit(None).cast(t).alias(n) for n, t in (("crop", "string"), ("category", "string"), ("confidence", "double"), ("place", "int"))])
    return top.select("request_id", F.lit(None).cast("string").alias("reason"), "crop", "category", "confidence", "place").unionByName(bad)


def diagnoses(views: DataFrame, group: str, classes: DataFrame, entries: DataFrame, least_conf: float = 0.5, unknown_below: float = 0.0) -> DataFrame:
    """PIP-14: (group, final_class, class_name, confidence, agreement, issues, matched, status, diagnosis, warning).

    views (group, view, p) of one image or video; classes (class_id, class_name); entries as in
    ``fallback_lookup``. Views are kept, voted and named, the entry is looked up and the answer shaped.
    """
    scratch = Scratch(views.sparkSession)
    kept = scratch.write(predictions.keep_views(views, group, "view", "p", least_conf), "kept")
    w = predictions.weighted_vote(kept, group, "p").withColumnRenamed("class_id", "final_class")
    final = predictions.decide(kept, group, "p").join(w, [group, "final_class"])
    names = classes.select(F.col("class_id").alias("final_class"), "class_name")
    shares = predictions.vote_shares(kept, group, "p").join(classes.select("class_id", "class_name"), "class_id", "left").where("issue and not coalesce(lower(class_name) like '%healthy%', false)")
    issues = shares.groupBy(group).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("votes")).alias("v"), "class_id", "class_name"))), lambda x: x["class_name"]), ", ").alias("issues"))
    j = final.join(names, "final_class", "left").join(issues, group, "left")
    j = j.join(predictions.fallback_lookup(classes.where("class_name is not null"), entries), "class_name", "left")
    a = predictions.answer(F.col("class_name"), F.col("weight"), F.coalesce("issues", F.lit("")), unknown_below)
    return j.select(group, "final_class", "class_name", F.round("weight", 4).alias("confidence"), F.round("agreement", 3).alias("agreement"), F.coalesce("issues", F.lit("")).alias("issues"), "matched", *[a[n].alias(n) for n in ("status", "diagnosis", "warning")])


def rebuilt_classes(files: DataFrame, images: DataFrame, mapping: DataFrame) -> DataFrame:
    """PIP-15: (item, id, n): lines of each new class after a rebuild, lines dropped, and leaks as a warning.

    mapping (class_id, new_id). item: "class" with the new id, "dropped" with the old one, "leak" with
    null and the number of digests that several splits hold.
    """
    ln = L.lines(files).select(F.get(L.tokens(F.col("line")), F.lit(0)).try_cast("int").alias("class_id"))
    mapped = L.remap_lines(ln, mapping, "flag")
    item = F.when(F.col("new_id").isNull(), "dropped").otherwise("class")
    per = mapped.groupBy(item.alias("item"), F.coalesce("new_id", "class_id").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    leaks = dedup.leaking_keys(images, "digest").agg(F.count(F.lit(1)).alias("n")).select(F.lit("leak").alias("item"), F.lit(None).cast("int").alias("id"), "n")
    return per.unionByName(leaks)
