"""Pixel kernels in numpy, over the rows of Spark's ``image`` source, in Arrow batches.

Arrays are height x width x channels in the order blue, green, red, as the source delivers them.
Equality to the last bit with other image libraries is not promised; definitions are given here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

METRICS = (
    "width int, height int, channels int, blur double, sharpness double, brightness double, contrast double, framed boolean, green_ratio double, "
    "spot_ratio double, non_green double, edge_fraction double, is_flat boolean, ahash bigint, dhash bigint, histogram array<double>, features array<double>"
)
MASK_METRICS = (
    "width int, height int, mask_pixels bigint, coverage double, components int, largest bigint, second bigint, x int, y int, w int, h int, "
    "borders int, fullest_corner double, perimeter double, is_tiny boolean, is_huge boolean, verdict string"
)


def to_array(data: bytes, h: int, w: int, n: int):
    """Bytes of an image row as an array."""
    import numpy as np

    return np.frombuffer(data, np.uint8)[: h * w * n].reshape(h, w, n)


def gray(img):
    """Luma of a colour image, 0.299 red + 0.587 green + 0.114 blue; a single band as it is."""
    import numpy as np

    if img.shape[2] < 3:
        return img[:, :, 0].astype(np.float64)
    b, g, r = (img[:, :, i].astype(np.float64) for i in range(3))
    return 0.114 * b + 0.587 * g + 0.299 * r


def laplacian_variance(g) -> float:
    """IMG-01: variance of the 4-neighbour Laplacian, borders mirrored without repeating the edge."""
    import numpy as np

    if g.shape[0] < 2 or g.shape[1] < 2:
        return 0.0
    p = np.pad(g, 1, mode="reflect")
    return float((p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * g).var())


def box_resize(g, h: int, w: int):
    """Mean over the source area of each target pixel, areas split exactly."""
    import numpy as np

    def weights(n, m):
        edges = np.linspace(0, n, m + 1)
        lo, hi = edges[:-1, None], edges[1:, None]
        at = np.arange(n)[None, :]
        x = np.clip(np.minimum(hi, at + 1) - np.maximum(lo, at), 0, None)
        return x / x.sum(axis=1, keepdims=True)

    return weights(g.shape[0], h) @ g @ weights(g.shape[1], w).T


def pack_bits(bits) -> int:
    """64 booleans as a signed number, the first in the top bit."""
    v = int("".join("1" if b else "0" for b in bits.ravel()), 2)
    return v - (1 << 64) if v >> 63 else v


def average_hash(g, inclusive: bool = False, first: int | None = None) -> int:
    """MTH-10, V1: 8 x 8 means, a bit where above their mean (or equal, if inclusive).

    ``first`` is the side of an earlier reduction, 32 or 10 in two of the variants.
    """
    s = box_resize(box_resize(g, first, first) if first else g, 8, 8)
    return pack_bits(s >= s.mean() if inclusive else s > s.mean())


def difference_hash(g, rising: bool = False) -> int:
    """MTH-10, V1: 8 rows of 9 means, a bit where a value exceeds its right neighbour, or is exceeded by it (rising)."""
    s = box_resize(g, 8, 9)
    return pack_bits(s[:, 1:] > s[:, :-1] if rising else s[:, :-1] > s[:, 1:])


def hsv(img):
    """Hue 0 to 180, saturation and value 0 to 255, as arrays of float."""
    import numpy as np

    b, g, r = (img[:, :, i].astype(np.float64) for i in range(3))
    v, lo = np.maximum(np.maximum(r, g), b), np.minimum(np.minimum(r, g), b)
    d = v - lo
    safe = np.where(d == 0, 1, d)
    h = np.where(v == r, 60 * (g - b) / safe, np.where(v == g, 120 + 60 * (b - r) / safe, 240 + 60 * (r - g) / safe))
    h = np.where(d == 0, 0, h)
    return np.where(h < 0, h + 360, h) / 2, np.where(v == 0, 0, 255 * d / np.where(v == 0, 1, v)), v


def _between(h, s, v, hue: tuple, sat: float, low: float, high: float = 255.0):
    return (h >= hue[0]) & (h <= hue[1]) & (s >= sat) & (v >= low) & (v <= high)


def leaf_ratios(img) -> tuple[float, float]:
    """IMG-03: shares of green pixels (hue 30 to 90) and of yellow to brown ones (hue 5 to 28)."""
    if img.shape[2] < 3:
        return 0.0, 0.0
    h, s, v = hsv(img)
    return float(_between(h, s, v, (30, 90), 20, 20).mean()), float(_between(h, s, v, (5, 28), 30, 20).mean())


def leaf_verdict(green: float, spots: float) -> str:
    """IMG-03: low_vegetation if both shares are below 8 %, spots if they are over a quarter of both, else ok."""
    if green < 0.08 and spots < 0.08:
        return "low_vegetation"
    return "spots" if spots > 0 and green > 0 and spots / (green + spots) > 0.25 else "ok"


def non_green(img) -> float:
    """IMG-03: of the pixels that are neither dark, pale nor glaring, the share outside hue 20 to 95; 0 for under 100 of them."""
    if img.shape[2] < 3:
        return 0.0
    h, s, v = hsv(img)
    leaf = _between(h, s, v, (0, 180), 30, 30, 250)
    n = int(leaf.sum())
    return 0.0 if n < 100 else 1.0 - int((leaf & _between(h, s, v, (20, 95), 30, 30, 250)).sum()) / n


def framed(g) -> bool:
    """IMG-02: some border strip varies by less than 1.5 and the picture is very bright or very dark."""
    k = max(5, int(min(g.shape) * 0.02))
    flat = any(x.std() < 1.5 for x in (g[:k], g[-k:], g[:, :k], g[:, -k:]))
    return bool(flat and (g.mean() > 240 or g.mean() < 15))


def sharpness(g) -> float:
    """IMG-01: Laplacian variance of the centre square at 256 x 256."""
    h, w = g.shape
    s = min(h, w)
    y, x = (h - s) // 2, (w - s) // 2
    return laplacian_variance(box_resize(g[y : y + s, x : x + s], 256, 256))


def _sobel(g):
    """Horizontal and vertical derivatives of whole grey values, the border repeated."""
    import numpy as np

    p = np.pad(np.rint(g).astype(np.int64), 1, mode="edge")
    x = (p[:-2, 2:] + 2 * p[1:-1, 2:] + p[2:, 2:]) - (p[:-2, :-2] + 2 * p[1:-1, :-2] + p[2:, :-2])
    y = (p[2:, :-2] + 2 * p[2:, 1:-1] + p[2:, 2:]) - (p[:-2, :-2] + 2 * p[:-2, 1:-1] + p[:-2, 2:])
    return x, y


def canny(g, low: float = 30.0, high: float = 100.0):
    """IMG-04: edges by Canny's method: gradients |x| + |y|, thinned across their direction, by two thresholds.

    A pixel is a ridge if its gradient exceeds that before it and is not below that after it, along
    the nearest of four directions. Ridges above ``high``, and those above ``low`` joined to one, are
    edges.
    """
    import numpy as np

    x, y = _sobel(g)
    m = np.abs(x) + np.abs(y)
    p = np.pad(m, 1)
    at = lambda dy, dx: p[1 + dy : p.shape[0] - 1 + dy, 1 + dx : p.shape[1] - 1 + dx]
    ax, ay = np.abs(x), np.abs(y)
    t = np.tan(np.pi / 8)
    flat, steep = ay < t * ax, ay > (t + 2) * ax
    falls = (x < 0) != (y < 0)
    ridge = np.where(
        flat, (m > at(0, -1)) & (m >= at(0, 1)),
        np.where(steep, (m > at(-1, 0)) & (m >= at(1, 0)), np.where(falls, (m > at(-1, 1)) & (m > at(1, -1)), (m > at(-1, -1)) & (m > at(1, 1)))),
    )
    weak = ridge & (m > low)
    labels, sizes = label_parts(weak)
    strong = np.zeros(len(sizes) + 1, bool)
    strong[labels[weak & (m > high)]] = True
    strong[0] = False
    return strong[labels]


def edge_fraction(g) -> float:
    """IMG-04: share of pixels that are edges between the thresholds 30 and 100."""
    return float(canny(g).mean()) if min(g.shape) >= 2 else 0.0


def color_histogram(img):
    """ARR-12: shares of pixels in 8 x 8 x 8 cells of blue, green and red."""
    import numpy as np

    q = (img[:, :, :3] if img.shape[2] >= 3 else np.repeat(img[:, :, :1], 3, axis=2)).astype(np.int64) >> 5
    cells = (q[:, :, 0] << 6) | (q[:, :, 1] << 3) | q[:, :, 2]
    return (np.bincount(cells.ravel(), minlength=512) / cells.size).tolist()


def label_parts(mask):
    """IMG-06: (labels, sizes): the number of the 8-connected part of each pixel, from 1, and the parts' sizes.

    By union of row runs; parts are numbered by their first pixel, 0 is background.
    """
    import numpy as np

    up: list[int] = []

    def find(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    before: list[tuple[int, int, int]] = []
    spans = []
    for r, row in enumerate(mask):
        d = np.diff(np.r_[0, row.astype(np.int8), 0])
        runs = []
        j = 0
        for a, b in zip(np.flatnonzero(d == 1).tolist(), np.flatnonzero(d == -1).tolist()):
            me = len(up)
            up.append(me)
            while j < len(before) and before[j][1] < a:
                j += 1
            k = j
            while k < len(before) and before[k][0] <= b:
                x, y = find(before[k][2]), find(me)
                up[max(x, y)] = min(x, y)
                k += 1
            runs.append((a, b, me))
            spans.append((r, a, b, me))
        before = runs
    labels = np.zeros(mask.shape, np.int32)
    number: dict[int, int] = {}
    sizes: list[int] = []
    for r, a, b, me in spans:
        root = find(me)
        if root not in number:
            number[root] = len(sizes) + 1
            sizes.append(0)
        sizes[number[root] - 1] += b - a
        labels[r, a:b] = number[root]
    return labels, sizes


def components(mask) -> list[int]:
    """IMG-06: sizes of the 8-connected parts, largest first."""
    return sorted(label_parts(mask)[1], reverse=True)


def largest_part(mask):
    """IMG-06: the mask of the largest part, the first on a tie; empty if there is none."""
    labels, sizes = label_parts(mask)
    return labels == (sizes.index(max(sizes)) + 1 if sizes else -1)


#: Steps around a pixel, clockwise on the screen from the left: (row, column).
_AROUND = [(0, -1), (-1, -1), (-1, 0), (-1, 1), (0, 1), (1, 1), (1, 0), (1, -1)]


def outline(mask) -> list[tuple[int, int]]:
    """ARR-11: the outer border of a mask of one part as (x, y) of its pixels in turn, by Moore's tracing.

    Starts at the first pixel and ends when that is entered as at the beginning. Pixels on straight
    stretches are kept; ``corners_only`` drops them.
    """
    import numpy as np

    if not mask.any():
        return []
    p = np.pad(mask, 1)
    start = tuple(int(v) for v in np.argwhere(p)[0])
    at, back, out = start, 0, []
    first = None
    while True:
        out.append((at[1] - 1, at[0] - 1))
        for k in range(1, 9):
            d = (back + k) % 8
            to = (at[0] + _AROUND[d][0], at[1] + _AROUND[d][1])
            if p[to]:
                break
        else:
            return out  # a single pixel
        if at == start:
            if first is None:
                first = d
            elif d == first:
                return out[:-1]
        # the background pixel looked at before, as seen from the new one
        last = (back + k - 1) % 8
        seen = (at[0] + _AROUND[last][0] - to[0], at[1] + _AROUND[last][1] - to[1])
        at, back = to, _AROUND.index(seen)


def corners_only(points: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Points of a closed outline at which its direction changes."""
    n = len(points)
    if n < 3:
        return points
    step = [(points[(i + 1) % n][0] - points[i][0], points[(i + 1) % n][1] - points[i][1]) for i in range(n)]
    return [points[i] for i in range(n) if step[i] != step[i - 1]]


def shoelace(points) -> float:
    """Area of a closed outline."""
    n = len(points)
    return abs(sum(points[i][0] * points[(i + 1) % n][1] - points[(i + 1) % n][0] * points[i][1] for i in range(n))) / 2 if n >= 3 else 0.0


def arc_length(points) -> float:
    import math

    return sum(math.dist(points[i], points[(i + 1) % len(points)]) for i in range(len(points))) if len(points) > 1 else 0.0


def simplified(points, tolerance: float) -> list:
    """ARR-11: a closed outline by Douglas and Peucker, cut at two far points of it."""
    from frond.functions.geometry import straightened

    n = len(points)
    if n < 4:
        return list(points)
    far = max(range(n), key=lambda i: (points[i][0] - points[0][0]) ** 2 + (points[i][1] - points[0][1]) ** 2)
    one = straightened([*points[: far + 1]], tolerance)
    two = straightened([*points[far:], points[0]], tolerance)
    return one[:-1] + two[:-1]


def convex_hull(points) -> list:
    """ARR-11: corners of the convex hull in turn, by two monotone chains; points on its sides are left out."""
    ps = sorted(set(map(tuple, points)))
    if len(ps) < 3:
        return ps

    def chain(seq):
        out: list = []
        for q in seq:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (q[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (q[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(q)
        return out[:-1]

    return chain(ps) + chain(ps[::-1])


def mask_polygons(mask, epsilon_ratio: float = 0.005, min_area: float = 10.0) -> list:
    """ARR-11: simplified outer outlines (lists of (x, y)) of the parts whose outline has at least ``min_area``."""
    labels, sizes = label_parts(mask)
    out = []
    for k in range(1, len(sizes) + 1):
        line = corners_only(outline(labels == k))
        if shoelace(line) < min_area:
            continue
        pts = simplified(line, epsilon_ratio * arc_length(line))
        if len(pts) >= 3:
            out.append(pts)
    return out


def polygon_fault(points, w: int, h: int, min_area: float) -> str | None:
    """PIP-03: why an outline is refused: outside the image, too few points, too small, or crossing itself; null if fine."""
    from frond.functions.geometry import crosses_itself

    clean = [q for i, q in enumerate(points) if i == 0 or q != points[i - 1]]
    if len(clean) > 1 and clean[0] == clean[-1]:
        clean.pop()
    if any(x < 0 or y < 0 or x > w or y > h for x, y in clean):
        return "outside"
    if len(clean) < 3:
        return "too_few_points"
    if shoelace(clean) < min_area:
        return "too_small"
    return "self_intersecting" if crosses_itself([x for x, _ in clean], [y for _, y in clean]) else None


def shape_ratios(mask) -> tuple[float, float, float]:
    """MTH-06: (aspect, solidity, convexity) of the largest part: box sides, pixels over hull area, hull over outline length; 0 where undefined."""
    big = largest_part(mask)
    line = corners_only(outline(big))
    if not line:
        return 0.0, 0.0, 0.0
    xs, ys = [x for x, _ in line], [y for _, y in line]
    hull = convex_hull(line)
    area, around = shoelace(hull), arc_length(line)
    return (max(xs) - min(xs) + 1) / (max(ys) - min(ys) + 1), float(big.sum()) / area if area > 0 else 0.0, arc_length(hull) / around if around > 0 else 0.0


def prompt_points(mask) -> list[tuple[int, int]]:
    """IMG-07: (x, y) at the middle and at both thirds of the box's middle row that lie in the mask."""
    import numpy as np

    if not mask.any():
        return []
    ys, xs = np.flatnonzero(mask.any(axis=1)), np.flatnonzero(mask.any(axis=0))
    x0, x1, y = int(xs[0]), int(xs[-1]), int(ys[0] + ys[-1]) // 2
    return [(x, y) for x in ((x0 + x1) // 2, x0 + (x1 - x0) // 3, x0 + 2 * (x1 - x0) // 3) if mask[y, x]]


def filled(mask):
    """IMG-10: a mask without holes: background that the frame's outside does not reach, by sides, is filled."""
    import numpy as np

    p = np.pad(~mask, 1, constant_values=True)
    reached = np.zeros_like(p)
    reached[0] = reached[-1] = True
    reached[:, 0] = reached[:, -1] = True
    while True:
        grown = reached.copy()
        grown[1:] |= reached[:-1]
        grown[:-1] |= reached[1:]
        grown[:, 1:] |= reached[:, :-1]
        grown[:, :-1] |= reached[:, 1:]
        grown &= p
        if (grown == reached).all():
            return ~reached[1:-1, 1:-1]
        reached = grown


def refined(mask):
    """IMG-10: opened by a cross of three pixels, its largest part without holes, closed by the cross."""
    opened = cross(cross(mask, False), True)
    return cross(cross(filled(largest_part(opened)), True), False)


def cross(mask, grow: bool):
    """Dilation or erosion by a cross of three pixels."""
    import numpy as np

    p = np.pad(mask, 1, constant_values=not grow)
    parts = [p[1:-1, 1:-1], p[:-2, 1:-1], p[2:, 1:-1], p[1:-1, :-2], p[1:-1, 2:]]
    return np.logical_or.reduce(parts) if grow else np.logical_and.reduce(parts)


def downscaled(h: int, w: int, most: int) -> tuple[int, int]:
    """IMG-09: (height, width) with the longer side at most ``most``, truncated; never enlarged."""
    f = most / max(h, w)
    return (h, w) if f >= 1 else (int(h * f), int(w * f))


def otsu(g) -> float:
    """IMG-07: the threshold that parts the grey values with the greatest variance between classes."""
    import numpy as np

    p = np.bincount(np.clip(g, 0, 255).astype(np.int64).ravel(), minlength=256) / g.size
    w, m = np.cumsum(p), np.cumsum(p * np.arange(256))
    den = w * (1 - w)
    with np.errstate(divide="ignore", invalid="ignore"):
        between = np.where(den > 0, (m[-1] * w - m) ** 2 / den, 0)
    return float(between.argmax())


def morph(mask, grow: bool, radius: int = 1):
    """IMG-07: dilation or erosion by a square, outside counting as background for growth only."""
    import numpy as np

    p = np.pad(mask, radius, constant_values=not grow)
    out = mask.copy()
    for dy in range(2 * radius + 1):
        for dx in range(2 * radius + 1):
            part = p[dy : dy + mask.shape[0], dx : dx + mask.shape[1]]
            out = out | part if grow else out & part
    return out


def leaf_mask(img):
    """IMG-07: pixels at or below the Otsu threshold of grey, opened and closed by 7 x 7."""
    g = gray(img)
    m = g <= otsu(g)
    m = morph(morph(m, False, 3), True, 3)
    return morph(morph(m, True, 3), False, 3)


def repair(image_size: tuple[int, int], mask, resize: bool = False):
    """IMG-08, V9: (mask, action): ok, rotated by 90 degrees, resized by nearest pixel, or quarantine."""
    import numpy as np

    h, w = image_size
    if mask.shape[:2] == (h, w):
        return mask, "ok"
    if mask.shape[:2] == (w, h):
        return np.rot90(mask), "rotated"
    if not resize or 0 in mask.shape[:2]:
        return None, "quarantine"
    return mask[np.arange(h) * mask.shape[0] // h][:, np.arange(w) * mask.shape[1] // w], "resized"


def square_views(h: int, w: int, mode: str = "three") -> list[tuple[int, int, int, int]]:
    """IMG-09: boxes (x, y, width, height): the whole picture if square or "squash", else the centre
    square, or in mode "three" the first, middle and last square along the longer side."""
    if mode == "squash" or w == h:
        return [(0, 0, w, h)]
    s = min(h, w)
    return [(int((w - s) * f), int((h - s) * f), s, s) for f in ((0.5,) if mode == "center" else (0.0, 0.5, 1.0))]


def feature_vector(img) -> list[float]:
    """ARR-12: 8 bins each of hue, saturation and value, then sharpness, brightness and aspect, 27 numbers."""
    import numpy as np

    out: list[float] = []
    for c in hsv(img if img.shape[2] >= 3 else np.repeat(img[:, :, :1], 3, axis=2)):
        k = np.bincount(np.minimum(c, 255).astype(np.int64).ravel() >> 5, minlength=8)
        out += (k / (k.sum() + 1e-6)).tolist()
    g = gray(img)
    return [*out, laplacian_variance(g) / 5000.0, float(g.mean()) / 255.0, img.shape[1] / max(1, img.shape[0])]


def histogram_correlation(a, b) -> float:
    """ARR-12: correlation of two histograms; 1 if both are constant."""
    import numpy as np

    x, y = np.asarray(a) - np.mean(a), np.asarray(b) - np.mean(b)
    d = float(np.sqrt((x * x).sum() * (y * y).sum()))
    return float((x * y).sum() / d) if d else 1.0


def mask_metrics(mask, tiny: float = 0.2, huge: float = 98.5, raw=None) -> tuple:
    """IMG-05, IMG-06, IMG-10: coverage in percent, parts, box, borders, and the first reason to refuse.

    Order: coverage below 5 % or above 95 %; a second part above 5 % of the largest or 0.5 % of the
    image; all four borders touched; a corner more than 30 % full; of the largest outline its length
    squared over its area above 150, or no area. Parts are those of ``raw``, the mask before it was
    refined, where that is given.
    """
    import numpy as np

    h, w = mask.shape
    n = int(mask.sum())
    if n == 0:
        return (w, h, 0, 0.0, 0, 0, 0, 0, 0, 0, 0, 0, 0.0, 0.0, True, False, "low coverage")
    parts = components(mask if raw is None else raw) or [0]
    ys, xs = np.flatnonzero(mask.any(axis=1)), np.flatnonzero(mask.any(axis=0))
    c = 100.0 * n / mask.size
    borders = sum(bool(e.any()) for e in (mask[0], mask[-1], mask[:, 0], mask[:, -1]))
    k = min(15, min(h, w) // 20)
    corner = max(float(x.mean()) for x in (mask[:k, :k], mask[:k, w - k :], mask[h - k :, :k], mask[h - k :, w - k :])) if k else 0.0
    labels, sizes = label_parts(mask)
    lines = [corners_only(outline(labels == i)) for i in range(1, len(sizes) + 1)] if c >= 5 and c <= 95 else [corners_only(outline(largest_part(mask)))]
    line = max(lines, key=shoelace)
    around, area = arc_length(line), shoelace(line)
    second = parts[1] if len(parts) > 1 else 0
    verdict = (
        "low coverage" if c < 5 else "high coverage" if c > 95 else "several regions" if second > 0.05 * parts[0] or second > 0.005 * mask.size
        else "touches all borders" if borders == 4 else "background in corner" if corner > 0.3 else "no outline area" if area == 0 else "jagged" if around * around / area > 150 else "valid"
    )
    return (w, h, n, c, len(parts), parts[0], second, int(xs[0]), int(ys[0]), int(xs[-1] - xs[0] + 1), int(ys[-1] - ys[0] + 1), borders, corner, around, c < tiny, c > huge, verdict)


def image_metrics(img) -> tuple:
    """All measures of one picture, in the order of METRICS. Pictures below 50 pixels have blur 0."""
    g = gray(img)
    edges = edge_fraction(g)
    blur = laplacian_variance(g) if min(g.shape) >= 50 else 0.0
    return (
        img.shape[1], img.shape[0], img.shape[2], blur, sharpness(g), float(g.mean()), float(g.std()), framed(g), *leaf_ratios(img), non_green(img),
        edges, bool(g.std() < 8 or edges < 0.005), average_hash(g), difference_hash(g), color_histogram(img), feature_vector(img),
    )


def _measure(df: DataFrame, keep: list[str], schema: str, work) -> DataFrame:
    cols = [F.col("image.height").alias("_h"), F.col("image.width").alias("_w"), F.col("image.nChannels").alias("_n"), F.col("image.data").alias("_d")]
    kinds = dict(df.dtypes)
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        import pandas as pd

        for pdf in batches:
            rows = [work(to_array(d, h, w, n)) if d is not None and h > 0 and w > 0 and n > 0 else (None,) * len(names) for d, h, w, n in zip(pdf["_d"], pdf["_h"], pdf["_w"], pdf["_n"])]
            out = pd.DataFrame(rows, columns=names, dtype=object)
            yield pd.concat([pdf[keep].reset_index(drop=True), out], axis=1)

    return df.select(*keep, *cols).mapInPandas(run, ", ".join([*[f"`{k}` {kinds[k]}" for k in keep], schema]))


def measure_images(df: DataFrame, keep: list[str]) -> DataFrame:
    """Kept columns and METRICS of rows with an ``image`` column; nulls where it did not decode."""
    return _measure(df, keep, METRICS, image_metrics)


def measure_masks(df: DataFrame, keep: list[str], level: int = 0) -> DataFrame:
    """Kept columns and MASK_METRICS; a pixel counts where its first band exceeds ``level``."""
    return _measure(df, keep, MASK_METRICS, lambda img: mask_metrics(img[:, :, 0] > level))


def mask_labels(df: DataFrame, keep: list[str], cls: str, min_area: float = 10.0, epsilon_ratio: float = 0.005, level: int = 0) -> DataFrame:
    """PIP-03, ARR-11: kept columns, content and reason of rows with an ``image`` column and a class id.

    content has a label line for each outline that is not refused, coordinates over the image's size,
    clamped, six places. reason is that of the first refused outline, "empty" without outline or
    picture, else null.
    """

    def work(img, row):
        polys = mask_polygons(img[:, :, 0] > level, epsilon_ratio, min_area)
        h, w = img.shape[:2]
        faults = [polygon_fault(p, w, h, min_area) for p in polys]
        unit = lambda v, n: f"{min(1.0, max(0.0, v / n)):.6f}"
        lines = [f"{row[cls]} " + " ".join(f"{unit(x, w)} {unit(y, h)}" for x, y in p) for p, f in zip(polys, faults) if f is None]
        return "\n".join(lines), next((f for f in faults if f), None) if polys else "empty"

    kinds = dict(df.dtypes)
    cols = [F.col("image.height").alias("_h"), F.col("image.width").alias("_w"), F.col("image.nChannels").alias("_n"), F.col("image.data").alias("_d")]

    def run(batches):
        import pandas as pd

        for pdf in batches:
            rows = []
            for r in pdf.to_dict("records"):
                good = r["_d"] is not None and r["_h"] > 0 and r["_w"] > 0 and r["_n"] > 0
                rows.append(work(to_array(r["_d"], int(r["_h"]), int(r["_w"]), int(r["_n"])), r) if good else ("", "empty"))
            yield pd.concat([pdf[keep].reset_index(drop=True), pd.DataFrame(rows, columns=["content", "reason"], dtype=object)], axis=1)

    return df.select(*keep, *cols).mapInPandas(run, ", ".join([*[f"`{k}` {kinds[k]}" for k in keep], "content string, reason string"]))
