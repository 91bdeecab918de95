import random

from pyspark.sql import functions as F

from frond.functions import keys as K
from frond.llm import components as C

SCHEMA = "pair_id bigint, disease_name string, plant_tag string, sha256_hash string, group_id string, a int, b int, e string, n int"


def ents():
    return [K.digest(F.col("sha256_hash")), K.plant_key(F.col("disease_name"), F.col("plant_tag"))]


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, "e", 3) for r in rows], SCHEMA)


def brute(rows):
    up = {}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    seen = {}
    for pid, dis, tag, h in rows:
        if pid is None:
            continue
        up.setdefault(pid, pid)
        marks = []
        if h and h.strip():
            marks.append(("h", h.strip().lower()))
        k = " ".join("".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789" else " " for c in (dis or "").lower()).split())
        t = "".join(c for c in (tag or "").upper() if c.isascii() and c.isalnum())
        if k and t and t not in ("UNKNOWN", "NA", "NONE"):
            marks.append(("p", k, t))
        for m in marks:
            if m in seen:
                x, y = find(pid), find(seen[m])
                up[max(x, y)] = min(x, y)
            seen[m] = pid
    groups = {}
    for p in up:
        groups.setdefault(find(p), set()).add(p)
    return {(g, p) for g, ps in groups.items() if len(ps) > 1 for p in ps}


def found(df, **kw):
    return {(r.group_id, r.pair_id) for r in C.related_groups(df, "pair_id", ents(), **kw).collect()}


def test_random_records_match_union_find(spark):
    rng = random.Random(3)
    tags = [None, "", "n/a", "unknown", "None", "PT-1", "pt 1", "pt-2", "PT2", "x9"]
    rows = [(rng.choice([None, *range(1, 120)]), rng.choice(["Leek___Rot", "leek rot", "fig", "", None]), rng.choice(tags) if rng.random() < 0.3 else None, rng.choice([None, "", "  ", *[f" H{i} " if i % 2 else f"h{i}" for i in range(90)]])) for _ in range(160)]
    df = table(spark, rows)
    assert found(df) == brute(rows)
    assert found(df, hot_rows=1) == brute(rows)  # hot keys by broadcast


def test_long_chain_is_one_group(spark):
    n = 150
    rows = []
    for i in range(n):  # i and i+1 share a hash or a plant, in turn
        rows.append((1000 - i, "d", f"t{i // 2}", f"h{(i + 1) // 2}"))
    assert found(table(spark, rows)) == {(1000 - n + 1, 1000 - i) for i in range(n)}


def test_one_entity_of_all_and_repeats(spark):
    rows = [(i, None, None, "SAME") for i in range(1, 60)] * 2
    assert found(table(spark, rows), hot_rows=5) == {(1, i) for i in range(1, 60)}


def test_empty_and_nulls(spark):
    assert found(table(spark, [])) == set()
    assert found(table(spark, [(None, None, None, None), (None, "a", "b", "c"), (1, "a", "b", "c")])) == set()


def test_splits_keep_groups_and_shares(spark):
    rows = [(i, None, None, f"h{i // 3}") for i in range(3000)]
    got = C.grouped_splits(table(spark, rows), "pair_id", ents(), {"train": 0.8, "val": 0.1, "test": 0.1}).collect()
    by = {}
    for r in got:
        by.setdefault(r.group_id, set()).add(r.split)
    assert len(got) == 3000 and all(len(s) == 1 for s in by.values())
    share = sum(r.split == "train" for r in got) / 3000
    assert 0.74 < share < 0.86
    assert C.grouped_splits(table(spark, []), "pair_id", ents(), {"train": 1.0}).count() == 0
