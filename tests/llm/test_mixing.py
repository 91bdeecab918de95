import itertools
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from frond.llm import mixing as M

pytestmark = pytest.mark.skipif(not os.path.exists(M.TOKENIZER), reason="no tokenizer file")


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 30), st.integers(0, 4)), min_size=0, max_size=5, unique_by=lambda x: x[0]), st.integers(0, 150))
def test_knapsack_is_best(parts, budget):
    lengths, counts = [w for w, _ in parts], [c for _, c in parts]
    best = max([sum(w * k for w, k in zip(lengths, ks)) for ks in itertools.product(*[range(c + 1) for c in counts]) if sum(w * k for w, k in zip(lengths, ks)) <= budget], default=0)
    take = M.bounded_knapsack(lengths, counts, budget)
    assert all(0 <= t <= c for t, c in zip(take, counts)) and sum(w * t for w, t in zip(lengths, take)) == best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 400), st.integers(1, 300)), min_size=1, max_size=12, unique_by=lambda x: x[0]), st.floats(0, 5), st.integers(0, 4))
def test_fit_stays_within(hist, share, repeats):
    total = sum(w * c for w, c in hist)
    passes, take = M.fit_source(hist, total * share, repeats, 1, window=500)
    used = passes * total + sum(w * t for (w, _), t in zip(hist, take))
    assert used <= total * share + 1e-6 and all(0 <= t <= c for t, (_, c) in zip(take, hist))
    assert passes <= repeats and (passes < repeats or not any(take))
    if passes < repeats and total:  # what is missing is less than the longest document left
        left = [w for (w, c), t in zip(hist, take) if w > 0 and t < c]
        assert not left or int(total * share) - used < min(left) or int(total * share) - used < max(w for w, _ in hist)


def docs(spark, rows):
    return spark.createDataFrame([(*r, 1, "s") for r in rows], "doc_id bigint, source string, text string, n_tokens int, uses string")


def targets(spark, rows):
    return spark.createDataFrame([(*r, 5) for r in rows], "source string, target_share double, max_repeats int, docs int")


def test_lengths_are_those_of_the_tokenizer(spark):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    texts = ["The leek's 12.5 kg  crate\r\n\r\n", "Über Ñandú ​­ 漢字 \t x", "<|endoftext|> x", "", "a" * 50_000]
    got = {r.doc_id: r.n_tokens for r in M.token_lengths(docs(spark, [(i, " A ", x) for i, x in enumerate(texts)] + [(99, None, None)])).collect()}
    t.encode_special_tokens = True
    assert got == {i: len(t.encode(x, add_special_tokens=False).ids) for i, x in enumerate(texts)} | {99: 0}


def test_mix(spark):
    rows = [(i, "Big ", "leek fig taro plum " * (1 + i % 7)) for i in range(300)] + [(1000 + i, "small", "rot and rust") for i in range(5)] + [(2000, None, "no source"), (2001, "big", None), (2002, "other", "x y z")]
    t = [("big", 0.5, 1), (" SMALL", 0.5, 3), ("absent", 0.1, 2), (None, 0.2, 1)]
    d, m = docs(spark, rows), targets(spark, t)
    assert {r.source for r in M.short_sources(d, m).collect()} == {"small", "absent"}
    got = M.mixed(d, m).collect()
    assert len({r.doc_id for r in got}) == len(got) and all(r.uses <= 3 for r in got)
    assert all(r.uses == 3 for r in got if r.source == "small") and sum(r.source == "small" for r in got) == 5
    total = sum(r.n_tokens for r in M.token_lengths(d).collect())
    big = sum(r.uses * r.n_tokens for r in got if r.source == "big")
    assert 0 <= 0.5 * total - big < 8
    rep = {r.source: r for r in M.mix_report(d, m).collect()}
    assert rep["absent"].tokens == 0 and rep["big"].tokens == big and abs(sum(r.share for r in rep.values()) - 1) < 1e-9


def test_empty(spark):
    assert M.short_sources(docs(spark, []), targets(spark, [("a", 0.5, 1)])).count() == 0
    assert M.mixed(docs(spark, []), targets(spark, [("a", 0.5, 1)])).count() == 0
    assert M.mix_report(docs(spark, []), targets(spark, [("a", 0.5, 1)])).count() == 1
    assert M.mixed(docs(spark, [(1, "a", "x")]), targets(spark, [])).count() == 0


def test_long_documents_are_fitted():
    assert M.fit_source([(100_000, 3)], 110_000, 1, 7) == (0, [1])
    assert M.fit_source([(100_000, 3)], 110_000, 2, 7) == (0, [1])
    hist = [(60_000, 2), (100_000, 1)]
    for seed in range(8):  # whatever the order, the best sum
        assert M.fit_source(hist, 130_000, 1, seed) == (0, [2, 0])
    passes, take = M.fit_source([(3, 1), (900_000, 2)], 899_999, 1, 7)
    assert (passes, take) == (0, [1, 0])
