import math
import random
from collections import Counter

from frond.llm import variety as V

SCHEMA = "audit_id bigint, width int, height int, mask_coverage_pct double, is_corrupted boolean, audited_at timestamp_ntz, long_side string, u double, bucket int, r string, n int"


def table(spark, rows):
    from datetime import datetime

    return spark.createDataFrame([(*r, datetime(2025, 1, 1), "x", 0.5, 3, "r", 9) for r in rows], SCHEMA)


def cells(rows):
    out = {}
    for i, w, h, c, bad in rows:
        if i is not None and not bad and w and h and w > 0 and h > 0 and c is not None and not math.isnan(c) and 0 <= c <= 100:
            out[i] = (max(w, h), min(w, h), int(c // 5))
    return out


def data():
    rng = random.Random(4)
    rows = []
    for i in range(400):
        w, h = rng.choice([(100, 200), (200, 100), (100, 200), (50, 50), (0, 10), (-3, 4), (None, 5), (7, 9)])
        c = rng.choice([1.0, 1.0, 1.0, rng.random() * 100, 100.0, 0.0, None, float("nan"), -0.1, 100.1])
        rows.append((i if rng.random() > 0.02 else None, w, h, c, rng.choice([False, False, False, None, True])))
    return rows + rows[:50]


def test_crowded_cells(spark):
    rows = data()
    c = cells(rows)
    n = Counter(c.values())
    want = {k for k, v in n.items() if v >= 0.02 * len(c)}
    assert {tuple(r) for r in V.crowded_cells(table(spark, rows)).collect()} == want


def test_round_robin(spark):
    rows = data()
    c = cells(rows)
    df = table(spark, rows)
    for k in (1, 30, 90, 10_000):
        for buckets in (1, 16):
            got = V.varied_subset(df, k, buckets=buckets).collect()
            assert len(got) == min(k, len(c)) and len({r.audit_id for r in got}) == len(got)
            n, size = Counter((r.long_side, r.short_side, r.coverage_band) for r in got), Counter(c.values())
            most = max(r.cell_rank for r in got)
            # no cell stays behind by more than one round unless it is used up
            assert all(n[x] >= min(size[x], most - 1) for x in size)
            assert all(c[r.audit_id] == (r.long_side, r.short_side, r.coverage_band) for r in got)
    a = {r.audit_id for r in V.varied_subset(df, 30, buckets=1).collect()}
    assert a == {r.audit_id for r in V.varied_subset(df, 30, buckets=64).collect()}


def test_nothing_asked_or_there(spark):
    assert V.varied_subset(table(spark, data()), 0).count() == 0
    assert V.varied_subset(table(spark, []), 5).count() == 0 and V.crowded_cells(table(spark, [])).count() == 0


def test_whole_range_of_sizes(spark):
    rng = random.Random(5)
    rows = [(i, w := int(100 * 2 ** (rng.random() * 7)), rng.randrange(50, w + 1), rng.random() * 100, False) for i in range(3000)]
    df, k = table(spark, rows), 200
    got = V.spread_subset(df, k).collect()
    assert len(got) == k == len({r.audit_id for r in got})
    c, whole = cells(rows), V.spread_subset(df, 10_000, buckets=3).collect()
    assert {r.audit_id: (r.long_side, r.short_side, r.coverage_band) for r in whole} == c
    # fewer cells than k: each occupied cell gives its first before any gives its second
    bins = {r.audit_id: (r.long_bin, r.short_bin, r.coverage_band) for r in got}
    step = max(int(math.log2(r.long_side) * 8) for r in got) // max(r.long_bin for r in got)
    j = round(math.log2(step))
    size = Counter((int(math.log2(x) * 8) >> j, int(math.log2(y) * 8) >> j, b) for x, y, b in c.values())
    n, most = Counter(bins.values()), max(r.cell_rank for r in got)
    assert len(size) < k and all(n[x] >= min(size[x], most - 1) for x in size)
    # the largest sizes are in it, and a cut first round is spread too
    assert max(r.long_side for r in got) > 10_000
    assert sum(r.long_side > 3000 for r in V.spread_subset(df, 10).collect()) >= 1
    assert V.spread_subset(df, 0).count() == 0 and V.spread_subset(table(spark, []), 5).count() == 0
