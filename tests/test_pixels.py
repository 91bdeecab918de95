import random

import numpy as np
import pytest

from frond.functions import pixels as X


def mask(rows):
    return np.array([[c == "#" for c in r] for r in rows])


def flood(m):
    """Parts by flood fill."""
    left, out = {tuple(p) for p in np.argwhere(m)}, []
    while left:
        stack, part = [left.pop()], set()
        while stack:
            y, x = stack.pop()
            part.add((y, x))
            for dy in (-1, 0, 1):
                for dx in (-1, 0, 1):
                    if (q := (y + dy, x + dx)) in left:
                        left.remove(q)
                        stack.append(q)
        out.append(part)
    return out


@pytest.mark.parametrize("seed", range(8))
def test_parts_and_outlines(seed):
    rng = random.Random(seed)
    m = np.array([[rng.random() < 0.45 for _ in range(17)] for _ in range(13)])
    labels, sizes = X.label_parts(m)
    parts = flood(m)
    assert sorted(sizes) == sorted(map(len, parts)) and {frozenset(map(tuple, np.argwhere(labels == k).tolist())) for k in range(1, len(sizes) + 1)} == set(map(frozenset, parts))
    assert int(X.largest_part(m).sum()) == max(sizes)
    for k in range(1, len(sizes) + 1):
        one = labels == k
        line = X.outline(one)
        # every point is of the part, neighbours touch, and all pixels next to the outside are met
        assert all(one[y, x] for x, y in line) and all(max(abs(a[0] - b[0]), abs(a[1] - b[1])) <= 1 for a, b in zip(line, line[1:] + line[:1]))
        whole = X.filled(one)
        p = np.pad(whole, 1)
        edge = {(x, y) for y, x in np.argwhere(whole & ~(p[:-2, 1:-1] & p[2:, 1:-1] & p[1:-1, :-2] & p[1:-1, 2:]))}
        assert edge <= set(line)
        assert set(X.corners_only(line)) <= set(line) and X.shoelace(X.corners_only(line)) == pytest.approx(X.shoelace(line)) and X.arc_length(X.corners_only(line)) == pytest.approx(X.arc_length(line))
        hull = X.convex_hull(line)
        assert X.shoelace(hull) >= X.shoelace(line) - 1e-9
        assert all((b[0] - a[0]) * (q[1] - a[1]) - (b[1] - a[1]) * (q[0] - a[0]) >= 0 for a, b in zip(hull, hull[1:] + hull[:1]) for q in line if len(hull) > 2)


def test_outlines_of_simple_shapes():
    assert X.outline(mask(["#"])) == [(0, 0)] and X.outline(mask(["."])) == []
    assert X.corners_only(X.outline(mask(["....", ".##.", ".##.", "...."]))) == [(1, 1), (2, 1), (2, 2), (1, 2)]
    assert X.outline(mask(["###"])) == [(0, 0), (1, 0), (2, 0), (1, 0)]
    big = np.zeros((40, 60), bool)
    big[5:25, 10:50] = True
    big[30:32, 3:5] = True
    assert X.mask_polygons(big) == [[(10, 5), (49, 5), (49, 24), (10, 24)]]
    assert X.shape_ratios(big) == pytest.approx((40 / 20, 800 / (39 * 19), 1.0))
    assert X.prompt_points(big) == [(26, 18), (18, 18), (33, 18)] and X.prompt_points(big[:0]) == []


def test_refining_keeps_one_part_without_holes():
    m = np.zeros((30, 30), bool)
    m[5:20, 5:20] = True
    m[10:12, 10:12] = False
    m[25, 25] = True
    r = X.refined(m)
    assert r[10, 10] and not r[25, 25] and len(X.components(r)) == 1
    assert not X.refined(np.zeros((5, 5), bool)).any() and X.filled(np.ones((2, 3), bool)).all()


def test_edges():
    step = np.zeros((20, 20))
    step[:, 10:] = 200
    e = X.canny(step)
    assert e.sum(axis=1).tolist() == [1] * 20 and X.edge_fraction(step) == pytest.approx(20 / 400)
    assert X.edge_fraction(np.full((9, 9), 7.0)) == 0 and X.edge_fraction(np.zeros((1, 5))) == 0
    faint = np.zeros((20, 20))
    faint[:, 10:] = 12  # gradients of 48: above the lower threshold only
    assert not X.canny(faint).any()
    faint[:3, 10:] = 100  # joined to a strong stretch
    assert X.canny(faint).sum() >= 18


def test_faults_and_variants():
    assert X.polygon_fault([(0, 0), (9, 0), (9, 9)], 9, 9, 10) is None and X.polygon_fault([(0, 0), (10, 0), (9, 9)], 9, 9, 10) == "outside"
    assert X.polygon_fault([(0, 0), (0, 0), (9, 9)], 9, 9, 1) == "too_few_points" and X.polygon_fault([(0, 0), (1, 0), (1, 1)], 9, 9, 10) == "too_small"
    assert X.polygon_fault([(0, 0), (8, 8), (8, 0), (0, 6)], 9, 9, 1) == "self_intersecting"
    g = np.arange(64.0).reshape(8, 8)
    assert X.average_hash(g) == X.average_hash(g, first=8) == (1 << 32) - 1 and X.difference_hash(g, rising=True) == -1 and X.difference_hash(g) == 0
    assert X.downscaled(100, 200, 50) == (25, 50) and X.downscaled(10, 20, 50) == (10, 20)


def test_masks_become_labels(spark):
    big = np.zeros((40, 60), np.uint8)
    big[5:25, 10:50] = 255
    rows = [(1, 7, big), (2, 7, np.zeros((40, 60), np.uint8)), (3, 8, None)]
    df = spark.createDataFrame([(i, c, (("", 40, 60, 1, 0, bytearray(m.tobytes())) if m is not None else None)) for i, c, m in rows], "id bigint, cls int, image struct<origin: string, height: int, width: int, nChannels: int, mode: int, data: binary>")
    got = {r.id: (r.content, r.reason) for r in X.mask_labels(df, ["id"] + ["cls"], "cls").collect()}
    assert got == {1: ("7 0.166667 0.125000 0.816667 0.125000 0.816667 0.600000 0.166667 0.600000", None), 2: ("", "empty"), 3: ("", "empty")}
    from frond.plans.pipelines import masks_to_labels

    placed = {r.id: (r.split, r.content) for r in masks_to_labels(df, "id", "cls").collect()}
    assert set(placed) == {1, 2, 3} and placed[1][1] == got[1][0] and masks_to_labels(df.limit(0), "id", "cls").count() == 0
