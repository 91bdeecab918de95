"""Polygons as ARRAY<STRUCT<x DOUBLE, y DOUBLE>>, by higher-order expressions that stay in the JVM.

Every function gives null for a null polygon. None uses a Python worker.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def to_points(flat: Column) -> Column:
    """ARR-01: [x1, y1, x2, y2, ...] as points; a last odd number is left out."""
    n = F.floor(F.size(flat) / 2).cast("int")
    places = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.struct(F.get(flat, i * 2).alias("x"), F.get(flat, i * 2 + 1).alias("y")))


def edges(p: Column) -> Column:
    """(a, b, i): each point with the next one, the last with the first."""
    after = F.concat(F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), F.slice(p, 1, 1))
    return F.transform(F.arrays_zip(p.alias("a"), after.alias("b")), lambda e, i: F.struct(e["a"].alias("a"), e["b"].alias("b"), i.alias("i")))


def signed_area(p: Column) -> Column:
    """Shoelace sum over two, the sign giving the direction; 0 below three points."""
    total = F.aggregate(edges(p), F.lit(0.0), lambda s, e: s + e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"])
    return F.when(F.size(p) < 3, F.lit(0.0)).otherwise(total / 2)


def area(p: Column) -> Column:
    """ARR-02: shoelace area."""
    return F.abs(signed_area(p))


def bbox(p: Column) -> Column:
    """ARR-04: STRUCT<x, y, w, h>; null without points."""
    xs, ys = F.transform(p, lambda q: q["x"]), F.transform(p, lambda q: q["y"])
    x0, y0 = F.array_min(xs), F.array_min(ys)
    box = F.struct(x0.alias("x"), y0.alias("y"), (F.array_max(xs) - x0).alias("w"), (F.array_max(ys) - y0).alias("h"))
    return F.when(F.size(p) > 0, box)


def has_repeated_point(p: Column) -> Column:
    """ARR-05: a point occurs twice anywhere."""
    return F.size(F.array_distinct(p)) < F.size(p)


def unique_points(p: Column) -> Column:
    """ARR-05: number of different points."""
    return F.size(F.array_distinct(p))


def drop_consecutive(p: Column) -> Column:
    """ARR-06: a point equal to the one before goes, then the last if it equals the first."""
    kept = F.filter(p, lambda q, i: (i == 0) | (q != F.get(p, i - 1)))
    closed = (F.size(kept) > 1) & (F.get(kept, F.lit(0)) == F.element_at(kept, -1))
    return F.when(closed, F.slice(kept, 1, F.size(kept) - 1)).otherwise(kept)


def normalize(p: Column, w: Column, h: Column) -> Column:
    """ARR-07: divide by the image's size, clamp to [0, 1], six decimals; null for sizes below 1."""
    unit = lambda v, n: F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), v / n)), 6)
    out = F.transform(p, lambda q: F.struct(unit(q["x"], w).alias("x"), unit(q["y"], h).alias("y")))
    return F.when((w > 0) & (h > 0), out)


def denormalize(p: Column, w: Column, h: Column) -> Column:
    """ARR-07: back to pixels, truncated."""
    return F.transform(p, lambda q: F.struct((q["x"] * w).cast("int").alias("x"), (q["y"] * h).cast("int").alias("y")))


def clockwise(p: Column) -> Column:
    """ARR-09: reversed if the sum of (x2 - x1)(y2 + y1) over its edges is negative, so if signed_area is positive."""
    return F.when(signed_area(p) > 0, F.reverse(p)).otherwise(p)


def corners(cx: Column, cy: Column, w: Column, h: Column) -> Column:
    """ARR-10: centre and size as STRUCT<x1, y1, x2, y2, outside>, outside if a corner leaves [0, 1]."""
    x1, y1, x2, y2 = cx - w / 2, cy - h / 2, cx + w / 2, cy + h / 2
    return F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"), ((x1 < 0) | (y1 < 0) | (x2 > 1) | (y2 > 1)).alias("outside"))


def _turn(a: Column, b: Column, c: Column) -> Column:
    return (c["y"] - a["y"]) * (b["x"] - a["x"]) > (b["y"] - a["y"]) * (c["x"] - a["x"])


def self_intersects(p: Column) -> Column:
    """ARR-03: two edges without a common point cross, by the strict turn test; never below four points.

    Quadratic in the points of one polygon; polygons of many points should pass polygon_crosses.
    """
    e, n = edges(p), F.size(p)

    def crosses(s: Column, t: Column) -> Column:
        apart = (t["i"] >= s["i"] + 2) & ~((s["i"] == 0) & (t["i"] == n - 1))
        a, b, c, d = s["a"], s["b"], t["a"], t["b"]
        return apart & (_turn(a, c, d) != _turn(b, c, d)) & (_turn(a, b, c) != _turn(a, b, d))

    return F.when(n < 4, F.lit(False)).otherwise(F.exists(e, lambda s: F.exists(e, lambda t: crosses(s, t))))


def crosses_itself(xs, ys) -> bool:
    """ARR-03 in numpy, edge against edge."""
    n = len(xs)
    if n < 4:
        return False
    x, y = np.asarray(xs, float), np.asarray(ys, float)
    u, v = np.roll(x, -1), np.roll(y, -1)
    turn = lambda ax, ay, bx, by, cx, cy: (cy - ay) * (bx - ax) > (by - ay) * (cx - ax)
    for i in range(n - 2):
        j = np.arange(i + 2, n - 1 if i == 0 else n)
        one = turn(x[i], y[i], x[j], y[j], u[j], v[j]) != turn(u[i], v[i], x[j], y[j], u[j], v[j])
        two = turn(x[i], y[i], u[i], v[i], x[j], y[j]) != turn(x[i], y[i], u[i], v[i], u[j], v[j])
        if (one & two).any():
            return True
    return False


def polygon_crosses():
    """ARR-03 as an Arrow-batched function of two arrays (xs, ys), for polygons of many points."""

    @F.pandas_udf("boolean")
    def run(xs: pd.Series, ys: pd.Series) -> pd.Series:
        return pd.Series([None if a is None else crosses_itself(a, b) for a, b in zip(xs, ys)], dtype="boolean")

    return run


def compactness(perimeter: Column, a: Column) -> Column:
    """MTH-06: perimeter squared over area; null for area 0."""
    return F.try_divide(perimeter * perimeter, a)


def perimeter(p: Column) -> Column:
    """Length of the closed outline."""
    return F.aggregate(edges(p), F.lit(0.0), lambda s, e: s + F.hypot(e["b"]["x"] - e["a"]["x"], e["b"]["y"] - e["a"]["y"]))


def straightened(points, tolerance: float) -> list:
    """ARR-11: Douglas-Peucker. Ends stay; a stretch is straight while no point is farther than ``tolerance`` from it.

    An explicit stack replaces recursion, so long outlines cannot exhaust it.
    """
    n = len(points)
    if n < 3:
        return list(points)
    x, y = np.asarray([q[0] for q in points], float), np.asarray([q[1] for q in points], float)
    keep = np.zeros(n, bool)
    keep[[0, n - 1]] = True
    stack = [(0, n - 1)]
    while stack:
        a, b = stack.pop()
        if b <= a + 1:
            continue
        dx, dy = x[b] - x[a], y[b] - y[a]
        px, py = x[a + 1 : b] - x[a], y[a + 1 : b] - y[a]
        length = np.hypot(dx, dy)
        d = np.hypot(px, py) if length == 0 else np.abs(dx * py - dy * px) / length
        k = int(d.argmax())
        if d[k] > tolerance:
            keep[m := a + 1 + k] = True
            stack += [(a, m), (m, b)]
    return [q for q, k in zip(points, keep) if k]


def simplify(tolerance: float):
    """ARR-11: ``straightened`` as an Arrow-batched function of two arrays; gives [x1, y1, ...]."""

    @F.pandas_udf("array<double>")
    def run(xs: pd.Series, ys: pd.Series) -> pd.Series:
        return pd.Series([None if a is None else [float(v) for q in straightened(list(zip(a, b)), tolerance) for v in q] for a, b in zip(xs, ys)])

    return run
