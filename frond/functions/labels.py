"""Label lines: tokens, strict numbers, the rule presets, and first-match reasons."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frond.functions import geometry as G

INT = r"^[+-]?[0-9]+$"
FLOAT = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


@dataclass(frozen=True)
class Rule:
    """What a valid line is: fewest tokens, whether their number must be odd or exact, whether empty labels fail."""

    least: int
    odd: bool = False
    exact: int | None = None
    empty_ok: bool = True


#: The presets that the different checkers use.
RULES = {
    "strict_odd7": Rule(7, odd=True),
    "loose7": Rule(7, empty_ok=False),
    "even_coords7": Rule(7, odd=True, empty_ok=False),
    "min3": Rule(3),
    "box5": Rule(5, exact=5),
    "any": Rule(0),
}


def tokens(line: Column) -> Column:
    """STR-08: runs of other than blanks; an empty line has none."""
    return F.filter(F.split(line, r"\s+"), lambda t: t != "")


def strict_int(t: Column) -> Column:
    """STR-09: an integer written as one, else null ("1.0" and "1_000" are none)."""
    return F.when(t.rlike(INT), t.try_cast("bigint"))


def strict_float(t: Column) -> Column:
    """STR-09: a finite decimal number, else null (nan and inf are refused)."""
    return F.when(t.rlike(FLOAT), t.try_cast("double"))


def line_reason(t: Column, rule: str = "strict_odd7") -> Column:
    """PRJ-14: the first rule that a line's tokens break; null if none.

    Order: number of tokens, their parity, class id, coordinates, bounds.
    """
    r = RULES[rule]
    n = F.size(t)
    count = (n != r.exact) if r.exact is not None else (n < r.least)
    parity = (n % 2 == 0) if r.odd else F.lit(False)
    coords = F.slice(t, 2, F.greatest(n - 1, F.lit(0)))
    value = lambda c: strict_float(c)
    return (
        F.when(count, "token_count")
        .when(parity, "odd_coordinates")
        .when(F.coalesce(strict_int(F.get(t, F.lit(0))), F.lit(-1)) < 0, "class_id")
        .when(F.exists(coords, lambda c: value(c).isNull()), "not_a_number")
        .when(F.exists(coords, lambda c: (value(c) < 0) | (value(c) > 1)), "out_of_bounds")
    )


def lines(files: DataFrame, content: str = "content", keep: tuple[str, ...] = ("file_id",)) -> DataFrame:
    """SRC-06: (keep..., line_no, line): stripped lines that are not blank, with their ordinal."""
    split = F.posexplode(F.split(F.col(content), "\r\n|\n|\r")).alias("line_no", "raw")
    cut = files.select(*keep, split).withColumn("line", F.regexp_replace("raw", r"^\s+|\s+$", ""))
    return cut.where("line <> ''").select(*keep, "line_no", "line")


def label_status(files: DataFrame, rule: str = "strict_odd7", key: str = "file_id") -> DataFrame:
    """PRJ-14: (key, lines, reason): the reason of the first failing line by ordinal, null if all hold.

    A file without lines is healthy or "empty", as the preset has it. Each file has a row.
    """
    ln = lines(files, keep=(key,)).withColumn("why", line_reason(tokens(F.col("line")), rule))
    per = ln.groupBy(key).agg(F.count(F.lit(1)).alias("lines"), F.min_by("why", F.when(F.col("why").isNotNull(), F.col("line_no"))).alias("reason"))
    out = files.select(key).distinct().join(per, key, "left")
    n = F.coalesce("lines", F.lit(0).cast("bigint"))
    empty = F.lit(None).cast("string") if RULES[rule].empty_ok else F.when(n == 0, "empty")
    return out.select(key, n.alias("lines"), F.coalesce("reason", empty).alias("reason"))


def audit_polygons(files: DataFrame, class_ids: list[int] | None = None, key: str = "file_id") -> DataFrame:
    """PRJ-09: one row for each line, with geometry and the first reason of the audit cascade.

    Order: repeated line of the file, token count, class id written wrongly, number written wrongly,
    unknown class, bounds, fewer than three points, self-intersection, area at most 1e-5, OK. A line
    that fails before its geometry has class -1 and no points.
    """
    # a file's lines, sorted in its own array: equal ones are neighbours, the first in the file leading
    cut = F.transform(F.split("content", "\r\n|\n|\r"), lambda r, i: F.struct(F.regexp_replace(r, r"^\s+|\s+$", "").alias("line"), i.alias("line_no")))
    srt = files.select(key, F.array_sort(F.filter(cut, lambda x: x["line"] != "")).alias("s"))
    marked = F.transform("s", lambda x, i: F.struct(x["line_no"].alias("line_no"), x["line"].alias("line"), F.coalesce((i > 0) & (x["line"] == F.get("s", i - 1)["line"]), F.lit(False)).alias("again")))
    ln = srt.select(key, F.inline(marked)).withColumn("t", tokens(F.col("line")))
    malformed = line_reason(F.col("t"), "strict_odd7")
    malformed = F.when(F.col("again"), "duplicate_line").when(~malformed.isin("out_of_bounds"), malformed)
    ln = ln.withColumn("bad", malformed)
    cid = F.when(F.col("bad").isNull(), F.get("t", F.lit(0)).try_cast("int"))
    flat = F.when(F.col("bad").isNull(), F.transform(F.slice("t", 2, F.greatest(F.size("t") - 1, F.lit(0))), lambda c: c.try_cast("double")))
    ln = ln.select(key, "line_no", "bad", F.coalesce(cid, F.lit(-1)).alias("class_id"), flat.alias("flat"))
    ln = ln.withColumn("p", G.to_points(F.col("flat")))
    ln = ln.withColumn("area", G.area(F.col("p"))).withColumn("crosses", G.self_intersects(F.col("p")))
    known = F.col("class_id").isin(class_ids) if class_ids is not None else F.lit(True)
    reason = (
        F.when(F.col("bad").isNotNull(), F.col("bad"))
        .when(~known, "unknown_class")
        .when(F.exists("flat", lambda v: (v < 0) | (v > 1)), "out_of_bounds")
        .when(F.size("p") < 3, "too_few_points")
        .when(F.col("crosses"), "self_intersecting")
        .when(F.col("area") <= 0.00001, "no_area")
        .otherwise("OK")
    )
    return ln.select(
        key, "line_no", "class_id", F.coalesce(F.size("p"), F.lit(0)).alias("num_vertices"), F.coalesce("area", F.lit(0.0)).alias("area"), G.bbox(F.col("p")).alias("bbox"),
        F.coalesce(G.has_repeated_point(F.col("p")), F.lit(False)).alias("has_duplicate_points"), F.coalesce("crosses", F.lit(False)).alias("is_self_intersecting"), reason.alias("reason"),
    )


def format_line(class_id: Column, p: Column) -> Column:
    """SNK-05: "class x y ..." with six decimals."""
    return F.concat_ws(" ", class_id.cast("string"), F.array_join(F.transform(p, lambda q: F.format_string("%.6f %.6f", q["x"], q["y"])), " "))


def remap_lines(lines_df: DataFrame, mapping: DataFrame, unmapped: str = "drop") -> DataFrame:
    """PRJ-10: class ids of (…, class_id) through (class_id, new_id).

    ``unmapped``: "drop" leaves such lines out, "keep" keeps the old id, "flag" keeps them with new_id
    null. The mapping has one row for each class and is left to Catalyst to broadcast by its size.
    """
    if unmapped == "drop":
        return lines_df.join(mapping, "class_id")
    got = lines_df.join(mapping, "class_id", "left")
    return got.withColumn("new_id", F.coalesce("new_id", "class_id")) if unmapped == "keep" else got


def image_kind(polys: DataFrame, files: DataFrame, healthy_ids: list[int], key: str = "file_id") -> DataFrame:
    """PRJ-13: disease, healthy or unknown for each file; disease wins over healthy, no lines is unknown."""
    is_healthy = F.col("class_id").isin(healthy_ids)
    per = polys.where("class_id >= 0").groupBy(key).agg(F.max((~is_healthy).cast("int")).alias("d"), F.max(is_healthy.cast("int")).alias("h"))
    kind = F.when(F.col("d") == 1, "disease").when(F.col("h") == 1, "healthy").otherwise("unknown")
    return files.select(key).distinct().join(per, key, "left").select(key, kind.alias("kind"))
