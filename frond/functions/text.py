"""String and number functions of the dataset checks, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stem(c: Column) -> Column:
    """STR-07: file name without folders and without its last suffix."""
    return F.regexp_replace(basename(c), r"(?<=.)\.[^.]*$", "")


def basename(c: Column) -> Column:
    """STR-07: what follows the last slash."""
    return F.regexp_extract(c, r"([^/]*)$", 1)


def suffix(c: Column) -> Column:
    """STR-07: last suffix with its dot in lower case; empty if there is none."""
    return F.lower(F.regexp_extract(basename(c), r".(\.[^.]*)$", 1))


def is_image(c: Column) -> Column:
    """SRC-01: a jpg, jpeg or png by name, in any letter case."""
    return suffix(c).isin(".jpg", ".jpeg", ".png")


def split_of_path(c: Column) -> Column:
    """STR-06: the first path part that is train, val or test; null if none is."""
    return F.get(F.filter(F.split(F.lower(c), "/"), lambda p: p.isin("train", "val", "test")), F.lit(0))


def disease_slug(c: Column) -> Column:
    """STR-02: lower case, hyphens and blanks to underscores, runs collapsed, two aliases."""
    s = F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), "[- ]", "_"), "_+", "_")
    return F.when(s == "banana_panama", "banana_panama_disease").when(s == "grape_leafroll_disease", "grapevine_leafroll_disease").otherwise(s)


def title(c: Column) -> Column:
    """Each run of letters capitalised; digits and signs part runs, unlike initcap."""
    parts = F.regexp_extract_all(c, F.lit(r"([A-Za-z]+|[^A-Za-z]+)"), F.lit(1))
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substring(p, 2, 1 << 30)))), "")


def crop_and_disease(c: Column) -> Column:
    """STR-03: STRUCT<crop, disease, healthy> of "Crop___Disease": underscores to blanks, title case.

    A name without the triple underscore has no disease.
    """
    at = F.split(c, "___", 2)
    pretty = lambda s: title(F.trim(F.replace(s, F.lit("_"), F.lit(" "))))
    return F.struct(pretty(F.get(at, F.lit(0))).alias("crop"), pretty(F.get(at, F.lit(1))).alias("disease"), F.lower(c).contains("healthy").alias("healthy"))


def infer_disease(name: Column) -> Column:
    """STR-04: disease from a file name: parts up to the first that begins with a digit or names a search engine."""
    parts = F.split(F.lower(stem(name)), "_")
    stop = F.filter(F.transform(parts, lambda p, i: F.when((i > 0) & (p.rlike("^[0-9]") | p.isin("google", "bing", "baidu")), i)), lambda i: i.isNotNull())
    n = F.coalesce(F.get(stop, F.lit(0)), F.size(parts))
    return F.array_join(F.slice(parts, 1, n), " ")


def longest_listed(c: Column, names: list[str]) -> Column:
    """STR-05: the first of ``names``, in list order, that the text begins with (blanks as underscores); else ''."""
    out = F.lit("")
    for n in reversed(names):
        out = F.when(F.lower(c).startswith(n.replace(" ", "_")), n).otherwise(out)
    return out


def parse_size(c: Column) -> Column:
    """STR-10: STRUCT<w, h> of "WxH" in any letter case; null if it is not that."""
    pat = r"^\s*([0-9]{1,9})\s*[xX]\s*([0-9]{1,9})\s*$"
    return F.when(c.rlike(pat), F.struct(F.regexp_extract(c, pat, 1).try_cast("int").alias("w"), F.regexp_extract(c, pat, 2).try_cast("int").alias("h")))


def short_name(c: Column, most: int = 20) -> Column:
    """STR-16: a long name cut and given the first 8 digits of its MD5."""
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, most), F.lit("_"), F.substring(F.md5(c), 1, 8))).otherwise(c)


def is_snake(c: Column) -> Column:
    """STR-15: lower-case words and digits with single underscores."""
    return c.rlike("^[a-z0-9]+(_[a-z0-9]+)*$")


def strip_suffixes(c: Column) -> Column:
    """STR-12: fruit, leaf, rot and blight endings; the $ binds to the last alternative only."""
    return F.regexp_replace(c, r"_fruit_rot|_leaf_spot|_leaf|_fruit|_rot|_blight$", "")


def contains_either(a: Column, b: Column) -> Column:
    """STR-13: one holds the other."""
    return a.contains(b) | b.contains(a)


def issue_list(parts: list[Column], between: str = ", ") -> Column:
    """STR-17: non-null parts joined; blanks and hyphens at the ends go."""
    return F.regexp_replace(F.concat_ws(between, *parts), r"^[ \-]+|[ \-]+$", "")


def allowed_prefix(name: Column, allowed: list[str]) -> Column:
    """STR-14: what stands before the first underscore if it is not among ``allowed``; null if it is.

    Compared in lower case. A name without an underscore is its own prefix; a null name has none.
    """
    p = F.lower(F.substring_index(name, "_", 1))
    return F.when(~p.isin(allowed), p)


def hamming(a: Column, b: Column) -> Column:
    """MTH-01: differing bits of two fingerprints; 999 if either is missing."""
    return F.coalesce(F.bit_count(a.bitwiseXOR(b)), F.lit(999))


def clamp(c: Column, low: float, high: float) -> Column:
    """MTH-03: into [low, high]."""
    return F.least(F.greatest(c, F.lit(low)), F.lit(high))


def is_close(a: Column, b: Column, rel: float = 1e-5) -> Column:
    """MTH-05: equal within ``rel`` of the larger magnitude."""
    return F.abs(a - b) <= rel * F.greatest(F.abs(a), F.abs(b))


def image_quality(w: Column, h: Column, blur: Column, bright: Column, contrast: Column) -> Column:
    """MTH-02: 0.2 resolution + 0.4 sharpness + 0.2 brightness + 0.2 contrast, four places."""
    res = F.least(F.lit(1.0), w.cast("double") * h / F.lit(1920.0 * 1080.0))
    sharp = F.when(blur > 0, F.least(F.lit(1.0), blur / 500.0)).otherwise(0.0)
    light = F.when((bright < 40) | (bright > 220), 0.2).when(bright.between(100, 180), 1.0).otherwise(F.greatest(F.lit(0.2), 1.0 - F.abs(bright - 140) / 100.0))
    return F.round(res * 0.2 + sharp * 0.4 + light * 0.2 + F.least(F.lit(1.0), contrast / 50.0) * 0.2, 4)


def mean_hash(pixels: Column, inclusive: bool = False) -> Column:
    """MTH-10, V1: aHash of 64 values as BIGINT, first value in the top bit: bit set above the mean.

    ``inclusive`` also sets values equal to it. Null if there are not 64 values.
    """
    m = F.aggregate(pixels, F.lit(0.0), lambda s, v: s + v) / 64
    bit = lambda v: ((v >= m) if inclusive else (v > m)).cast("bigint")
    return F.when(F.size(pixels) == 64, F.aggregate(pixels, F.lit(0).cast("bigint"), lambda s, v: F.shiftleft(s, 1).bitwiseOR(bit(v))))


def difference_hash(pixels: Column, width: int = 9, height: int = 8) -> Column:
    """MTH-10, V1: dHash of height rows of width values: bit set where a value exceeds its right neighbour."""
    places = F.array(*[F.lit(r * width + c) for r in range(height) for c in range(width - 1)])
    bit = lambda i: (F.get(pixels, i) > F.get(pixels, i + 1)).cast("bigint")
    return F.when(F.size(pixels) == width * height, F.aggregate(places, F.lit(0).cast("bigint"), lambda s, i: F.shiftleft(s, 1).bitwiseOR(bit(i))))


def frame_seconds(frame: Column, fps: Column) -> Column:
    """DAT-02: frame number to seconds, two places; null for fps 0."""
    return F.round(F.try_divide(frame.cast("double"), fps.cast("double")), 2)


def checked_confidence(c: Column) -> Column:
    """PRJ-04: why a confidence is refused: missing, not a number, below 0 or above 100; null if it is fine."""
    return F.when(c.isNull(), "missing").when(F.isnan(c), "nan").when(c < 0, "negative").when(c > 100, "above_100")
