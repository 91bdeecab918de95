import random

import pytest

from frond.llm import anchors as A
from frond.llm import spans as S


def docs(spark, rows):
    return spark.createDataFrame([(*r, 1, "h", 2, "r") for r in rows], "doc_id bigint, text string, at int, h string, n int, rep string")


def brute(rows, span):
    grams = {}
    for d, t in rows:
        if d is not None and t:
            for i in range(len(t) - span + 1):
                grams.setdefault(t[i : i + span], set()).add(d)
    return {(a, b) for ds in grams.values() for a in ds for b in ds if a < b}


def corpus(seed, span):
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice("abcdefgh ñ\n.😀") for _ in range(n))
    rows = []
    shared = [word(span + k) for k in (-1, 0, 1, 5, 40, 200)]
    for i in range(60):
        t = word(rng.randrange(0, 200))
        for _ in range(rng.randrange(0, 3)):
            s = rng.choice(shared)
            a = rng.randrange(0, 4)
            t += (s if a else s[1:]) + word(rng.randrange(0, 60))
        rows.append((i, t))
    rows += [(100, rows[0][1] + shared[4]), (101, rows[0][1] + shared[4]), (102, None), (103, ""), (None, shared[3]), (104, "a" * 500), (105, "a" * 320), (106, "ab" * 200)]
    return rows + rows[:3]


@pytest.mark.parametrize("seed,paired,hot", [(1, 64, 1000), (2, 64, 3), (3, 1, 1000), (4, 1, 3)])
def test_pairs_match_brute_force(spark, seed, paired, hot):
    span = 60
    rows = corpus(seed, span)
    got = [tuple(r) for r in S.stretch_pairs(docs(spark, rows), span=span, gram=40, paired=paired, hot_rows=hot).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows, span)


def test_real_bounds_at_the_border(spark):
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abcdefghijkl ") for _ in range(n))
    rows = []
    for i, n in enumerate((299, 300, 301)):
        s = word(n)
        rows += [(2 * i, word(37) + s + "X" + word(50)), (2 * i + 1, "Y" + s + "Z" + word(400))]
    assert {tuple(r) for r in S.stretch_pairs(docs(spark, rows)).collect()} == {(2, 3), (4, 5)} == brute(rows, 300)


def test_anchors_of_pieces_and_groups(monkeypatch):
    rng = random.Random(1)
    texts = ["".join(rng.choice("abc") for _ in range(n)) for n in (0, 99, 100, 101, 1500, 4000)] + [None]
    whole = {tuple(map(int, x)) for x in zip(*A.anchors(texts, 100, 60))}
    monkeypatch.setattr(A, "PIECE", 700)
    assert {tuple(map(int, x)) for x in zip(*A.anchors(texts, 100, 60))} == whole
    # each window holds an anchor, and equal windows the same one
    by = {}
    for i, p, h in whole:
        by.setdefault(i, []).append((p, h))
    for i, t in enumerate(texts):
        for s in range(len(t or "") - 99):
            assert any(s <= p <= s + 40 for p, _ in by[i])


def test_empty(spark):
    assert S.stretch_pairs(docs(spark, [])).count() == 0 and S.shared_sentences(docs(spark, [])).count() == 0


def test_sentences():
    t = "One two. Three!  Four\nfive. Six"
    assert [t[a:b] for a, b in S.sentence_bounds(t)] == ["One two. ", "Three!  ", "Four\n", "five. ", "Six"]
    assert S.sentence_bounds("") == [] and S.sentence_bounds("x") == [(0, 1)]
    assert S.sentence_runs(t, 12, 2) == [(0, 2, 0, 15), (1, 2, 9, 21), (2, 3, 17, 31)]


def test_shared_sentence_shares(spark):
    a, b, c, d = "Alpha beta gamma. ", "Delta epsilon zeta. ", "Eta theta iota. ", "Kappa lambda mu. "
    rows = [(1, a + b + c), (2, d + a + b), (3, c + d), (4, None), (5, a + b + a + b)]
    got = {r.doc_id: (r.n_chars, r.shared_chars, r.removable_chars) for r in S.shared_sentences(docs(spark, rows), min_chars=30, least=2).collect()}
    ab = len(a + b) - 1
    assert got[1] == (len(a + b + c), ab, 0) and got[2] == (len(d + a + b), ab, ab) and got[4] == (0, 0, 0) and got[3][1] == 0
    assert got[5][1] == got[5][2] == 2 * ab
    clean = {r.doc_id: r.text for r in S.without_repeats(docs(spark, rows), min_chars=30, least=2).collect()}
    assert clean == {1: a + b + c, 2: d, 3: c + d, 4: None, 5: ""}
    hot = {r.doc_id: (r.n_chars, r.shared_chars, r.removable_chars) for r in S.shared_sentences(docs(spark, rows), min_chars=30, least=2, hot_rows=1).collect()}
    assert hot == got


@pytest.mark.parametrize("seed,paired,hot", [(1, 64, 1000), (3, 1, 3)])
def test_shared_characters_match_brute_force(spark, seed, paired, hot):
    span = 60
    rows = corpus(seed, span)
    holders = {}
    for d, t in rows:
        for i in range(len(t or "") - span + 1):
            if d is not None:
                holders.setdefault(t[i : i + span], set()).add(d)
    want = {}
    for d, t in rows:
        if d is not None:
            want[d] = {c for i in range(len(t or "") - span + 1) if len(holders[t[i : i + span]]) > 1 for c in range(i, i + span)}
    got = {}
    for r in S.shared_stretches(docs(spark, rows), span=span, gram=40, paired=paired, hot_rows=hot).collect():
        more = set(range(r.start, r.end))
        assert len(more) >= span and not more & got.get(r.doc_id, set())
        got.setdefault(r.doc_id, set()).update(more)
    assert got == {d: c for d, c in want.items() if c}
    shares = {r.doc_id: r.shared_chars for r in S.stretch_shares(docs(spark, rows), span=span, gram=40, paired=paired, hot_rows=hot).collect()}
    assert shares == {d: len(c) for d, c in want.items()}


def test_the_end_of_a_run_counts(spark):
    t = "Alpha beta gamma delta. Epsilon zeta eta theta. Iota."
    assert S.ending_runs(t, 30, 2) == [(0, 2, 0, 47), (0, 3, 0, 53)] and S.sentence_runs(t, 30, 2) == [(0, 2, 0, 47)]
    d = docs(spark, [(1, t), (2, t), (3, None)])
    got = {r.doc_id: r.removable_chars for r in S.shared_sentences(d, min_chars=30, least=2).collect()}
    assert got == {1: 0, 2: len(t), 3: 0}
    assert {r.doc_id: r.text for r in S.without_repeats(d, min_chars=30, least=2).collect()} == {1: t, 2: "", 3: None}
    for seed in range(30):
        rng = random.Random(seed)
        x = "".join("w" * rng.randrange(1, 20) + ". " for _ in range(12))
        b = S.sentence_bounds(x)
        trim = [s + len(x[s:e].rstrip()) for s, e in b]
        want = [max((i for i in range(j) if trim[j] - b[i][0] >= 30), default=None) for j in range(len(b))]
        assert {j: i for j, i in enumerate(want) if i is not None} == {i + n - 1: i for i, n, _, _ in S.ending_runs(x, 30, 2)}


def test_pairs_of_a_common_block_are_formed_once(spark):
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("abcdefghijkl ") for _ in range(n))
    block, short = word(1000), word(320)
    rows = [(i, word(60) + block + word(60)) for i in range(100)] + [(200 + i, word(9) + short + block[:400]) for i in range(70)]
    scratch = S.Scratch(spark)
    ctx, _ = S._met(docs(spark, rows), 300, 200, 64, scratch, 10**6)
    pairs = S._windowed(ctx.where("large"), 300, 200, scratch, 10**6).collect()
    sets = spark.read.parquet(next(p for p in scratch._paths.values() if p.endswith("-sets"))).collect()
    assert len(pairs) == 170 * 169 // 2
    assert sum(r.n * (r.n - 1) // 2 for r in sets) <= 3 * len(pairs)  # pairs formed, each window by itself would be 700 times as many
