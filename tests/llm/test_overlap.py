import random
from itertools import combinations

import pytest

from frond.llm import overlap as O

SCHEMA = "image_id bigint, dataset_source string, split string, sha256_hash string, phash string, list int, mask string, content string, fp string, fp_left string, t int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "m", "c", "f", "l", 2) for r in rows], SCHEMA)


def canon(p):
    p = (p or "").strip().lower().removeprefix("0x")
    return int(p, 16) if p else None


def brute(rows):
    names = {"train": "train", "training": "train", "val": "held", "validation": "held", "test": "held", "testing": "held"}
    out = set()
    for x, y in combinations([r for r in rows if r[0] is not None], 2):
        sx, sy = names.get((x[2] or "").strip().lower()), names.get((y[2] or "").strip().lower())
        if not sx or not sy or sx == sy or x[0] == y[0]:
            continue
        hx, hy = (x[3] or "").strip().lower(), (y[3] or "").strip().lower()
        px, py = canon(x[4]), canon(y[4])
        if (hx and hx == hy) or (px is not None and py is not None and (px ^ py).bit_count() <= 5):
            out.add((min(x[0], y[0]), max(x[0], y[0])))
    return out


def rows_of(seed, n=150):
    rng = random.Random(seed)
    bases = [rng.getrandbits(64) for _ in range(8)] + [0, (1 << 64) - 1, 1 << 63]
    out = []
    for i in range(n):
        v = rng.choice(bases)
        for _ in range(rng.randrange(0, 8)):
            v ^= 1 << rng.randrange(64)
        text = rng.choice([None, "", f"{v:x}", f"0x{v:016X}", f" 0X{v:x} ", f"{v:016x}"])
        out.append((i, rng.choice([None, "new", "New "]), rng.choice(["train", " TRAINING", "val", "Validation ", "test", "testing", "extra", None]), rng.choice([None, "", f" H{rng.randrange(40)} "]), text))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_pairs_match_brute_force(spark, seed):
    rows = rows_of(seed)
    got = [(r.image_id_a, r.image_id_b) for r in O.image_pairs(table(spark, rows)).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows)


def test_join_is_exact_for_other_bounds(spark):
    rng = random.Random(5)
    vals = list({rng.getrandbits(10) | (rng.getrandbits(6) << 58) for _ in range(150)})
    signed = [v - (1 << 64) if v >> 63 else v for v in vals]
    df = spark.createDataFrame([(v,) for v in [*signed, None]], "fp bigint")
    for k in (0, 1, 3):
        got = {(r[0], r[1]) for r in O.fingerprint_join(df, df, k).collect()}
        assert got == {(a, b) for a in signed for b in signed if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= k}
    assert all(abs(r.cosine - (1 - 2 * ((r.fp_left ^ r.fp_right) & ((1 << 64) - 1)).bit_count() / 64)) < 1e-12 for r in O.fingerprint_join(df, df, 1).collect())


def test_choice_of_lists_changes_nothing(spark):
    assert [O.choose_lists(n, n, 5)[0] for n in (10, 10**5, 10**6, 10**9)] == sorted(O.choose_lists(n, n, 5)[0] for n in (10, 10**5, 10**6, 10**9))
    rng = random.Random(7)
    vals = [rng.getrandbits(12) << 20 for _ in range(80)]
    df = spark.createDataFrame([(v,) for v in set(vals)], "fp bigint")
    sets = [{(r[0], r[1]) for r in O.fingerprint_join(df, df, 3, c, h).collect()} for c, h in (((4, 1), 5), ((5, 1), 10**6), ((6, 2), 5), ((9, 5), 5), ((9, 6), 10**6))]
    assert all(s == sets[0] for s in sets) and len(sets[0]) > len(df.collect())


def test_bad_parameters(spark):
    df = spark.createDataFrame([], "fp bigint")
    with pytest.raises(ValueError):
        O.fingerprint_join(df, df, 5, (5, 1))
    with pytest.raises(ValueError):
        O.cosine_join(df, df, 0.0)


def vectors(rng, n, terms):
    return {i: {t: rng.choice([0.2, 1.0, 3.0, -1.0]) for t in rng.sample(range(terms), rng.randrange(0, 8))} for i in range(n)}


def brute_cosine(x, y, t):
    import math

    norm = lambda v: math.sqrt(sum(w * w for w in v.values()))
    out = {}
    for i, a in x.items():
        for j, b in y.items():
            c = sum(w * b.get(k, 0.0) for k, w in a.items())
            if a and b and c / (norm(a) * norm(b)) >= t - 1e-9:
                out[i, j] = c / (norm(a) * norm(b))
    return out


@pytest.mark.parametrize("t", [0.1, 0.5, 0.8, 1.0])
def test_weighted_cosine_matches_brute_force(spark, t):
    rng = random.Random(int(t * 10))
    x, y = vectors(rng, 60, 25), vectors(rng, 50, 30)
    y[50] = dict(x[3])
    rows = lambda d: spark.createDataFrame([(i, f"t{k}", w, "extra") for i, v in d.items() for k, w in v.items()] + [(None, "t1", 1.0, ""), (1, None, 1.0, "")], "id bigint, term string, weight double, n string")
    want = brute_cosine(x, y, t)
    for hot in (3, 10**6):
        got = {(r.id_left, r.id_right): r.cosine for r in O.cosine_join(rows(x), rows(y), t, hot).collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    e = spark.createDataFrame([], "id bigint, term string, weight double")
    assert O.cosine_join(e, rows(y).select("id", "term", "weight"), t).count() == 0


def test_residual_is_not_listed(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([([(1, 0.6, 0.9), (2, 0.6, 0.9), (3, 0.4, 0.9), (4, 0.3, 0.1)],)], "v array<struct<term: int, weight: double, most: double>>")
    n = lambda least: df.select(O.listed(F.col("v"), F.lit(least), F.lit(1.0))).first()[0]
    # by weights times greatest weights the last holds 0.03 and the last two 0.39; by norm the last two hold 0.5
    assert [n(x) for x in (0.02, 0.1, 0.38, 0.45, 0.9)] == [4, 3, 3, 2, 1]


def test_one_fingerprint_of_many_and_report(spark):
    rows = [(i, "new", "train", None, "ff") for i in range(40)] + [(100 + i, "new", "val", "x", "fe") for i in range(3)] + [(200, None, "test", "y", None)]
    df = table(spark, rows)
    assert O.image_pairs(df).count() == 120 and O.image_pairs(df, hot_rows=2).distinct().count() == 120
    rep = {(r.split, r.source): (r.images, r.same_hash, r.near, r.leaked) for r in O.overlap_report(df).collect()}
    assert rep == {("val", "new"): (3, 0, 3, 3), ("test", ""): (1, 0, 0, 0)}


def test_empty(spark):
    assert O.image_pairs(table(spark, [])).count() == 0 and O.overlap_report(table(spark, [])).count() == 0
