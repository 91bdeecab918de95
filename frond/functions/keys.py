"""Canonical forms of the loosely written columns, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def name_key(c: Column) -> Column:
    """Lower case, runs of other than a-z and 0-9 become one blank, trimmed; nothing left is null."""
    k = F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))
    return F.when(k != "", k)


def digest(c: Column) -> Column:
    """sha256_hash trimmed and lower-cased; empty is null."""
    k = F.lower(F.trim(c))
    return F.when(k != "", k)


def source_key(c: Column) -> Column:
    """source trimmed and lower-cased; null stays null."""
    return F.lower(F.trim(c))


def plant_key(disease: Column, tag: Column) -> Column:
    """Name key and cleaned tag of one photographed plant; null without a usable tag."""
    t = F.regexp_replace(F.upper(tag), "[^A-Z0-9]", "")
    k = name_key(disease)
    usable = k.isNotNull() & t.isNotNull() & ~t.isin("", "UNKNOWN", "NA", "NONE")
    return F.when(usable, F.concat(k, F.lit("|"), t))


def split_name(c: Column) -> Column:
    """train, val or test; null for anything else."""
    s = F.lower(F.trim(c))
    return (
        F.when(s.isin("train", "training"), "train")
        .when(s.isin("val", "validation"), "val")
        .when(s.isin("test", "testing"), "test")
    )


def file_key(path: Column) -> Column:
    """The file a label path names; null when no segment is left.

    ``..`` at the root cancels nothing.
    """
    p = F.regexp_replace(path, r"^\s+|\s+$", "")
    p = F.regexp_replace(p, "^file://", "")
    p = F.replace(F.replace(p, F.lit("%20"), F.lit(" ")), F.lit("\\"), F.lit("/"))
    p = F.regexp_replace(p, "^/mnt/store/", "")
    segments = F.filter(F.split(p, "/"), lambda s: ~s.isin("", "."))
    folded = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda done, s: F.when(s == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(
            F.concat(done, F.array(s))
        ),
    )
    out = F.array_join(F.when(F.array_contains(segments, ".."), folded).otherwise(segments), "/")
    return F.when(out != "", out)


def fingerprint(c: Column) -> Column:
    """A 64-bit hexadecimal fingerprint as BIGINT; null when it is not one to sixteen hex digits.

    The halves are converted apart: sixteen digits do not fit a signed conversion.
    """
    h = F.regexp_replace(F.lower(F.trim(c)), "^0x", "")
    h = F.when(h.rlike("^0*[0-9a-f]{1,16}$"), F.lpad(F.right(h, F.lit(16)), 16, "0"))
    high = F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint")
    low = F.conv(F.substring(h, 9, 8), 16, 10).cast("bigint")
    return F.shiftleft(high, 32).bitwiseOR(low)


def unit_hash(seed: int, c: Column) -> Column:
    """A uniform double in [0, 1): 52 bits of the SHA-256 of "seed:value", so any engine can repeat it."""
    h = F.sha2(F.concat(F.lit(f"{int(seed)}:"), c.cast("string")), 256)
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
