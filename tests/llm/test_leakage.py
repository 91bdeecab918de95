import random

from frond.llm import leakage as L
from frond.llm.words import forms, words

DOCS = "doc_id bigint, text string, item_id int, template string, length string, doc_words int"


def docs(spark, rows):
    return spark.createDataFrame([(*r, 1, "t", "l", 2) for r in rows], DOCS)


def items(spark, rows):
    return spark.createDataFrame([(*r, 1, "t") for r in rows], "item_id bigint, text string, doc_id int, template string")


def brute(ds, its):
    out = set()
    for d, t in ds:
        w = words(t)
        for i, u in its:
            v = words(u)
            k = min(12, len(v))
            if d is None or i is None or not k:
                continue
            grams = {tuple(v[j : j + k]) for j in range(len(v) - k + 1)}
            if any(tuple(w[j : j + k]) in grams for j in range(len(w) - k + 1)):
                out.add((d, i))
    return out


def test_words():
    assert words("A<b>c</b> x-\r\ny soft­ly ze​ro a_b 3.5 <3 > <1> Ärger") == ["ac", "xy", "softly", "zero", "a", "b", "3", "5", "3", "1", "ärger"]
    assert words(None) == [] and words("") == [] and words("-- \n") == []


def test_matches_brute_force(spark):
    rng = random.Random(9)
    vocab = ["leek", "fig", "row", "5", "7", "kg", "days", "the", "a", "rot", "leaf"]
    its = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([1, 2, 5, 11, 12, 13, 30])))) for i in range(30)] + [(90, None), (91, ""), (92, "!?"), (None, "leek fig"), (93, "leek")]
    ds = []
    for i in range(60):
        w = [rng.choice(vocab) for _ in range(rng.randrange(0, 60))]
        if rng.random() < 0.6:
            v = words(rng.choice(its)[1])
            cut = rng.randrange(0, 3)
            w[5:5] = [x.upper() if rng.random() < 0.2 else x for x in v[cut:]]
        ds.append((i, " ".join(w) if rng.random() > 0.1 else ", ".join(w)))
    ds += [(100, None), (101, ""), (None, its[0][1]), (102, " ".join(["the row"] * 30_000) + " " + its[-1][1])]
    ds += ds[:5]
    got = [tuple(r) for r in L.leaked_pairs(docs(spark, ds), items(spark, its)).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(ds, its)


def test_shuffle_path_gives_the_same(spark, monkeypatch):
    its = [(1, "one two three four five six seven eight nine ten eleven twelve thirteen"), (2, "two three")]
    ds = [(1, "zero one two three four five six seven eight nine ten eleven twelve"), (2, "three two"), (3, "x two three")]
    want = {tuple(r) for r in L.leaked_pairs(docs(spark, ds), items(spark, its)).collect()}
    monkeypatch.setattr(L, "MAX_BROADCAST", 0)
    assert {tuple(r) for r in L.leaked_pairs(docs(spark, ds), items(spark, its)).collect()} == want == {(1, 1), (1, 2), (3, 2)}


def test_many_items_go_by_filter(spark):
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(5000)]
    its = [(i, " ".join(rng.choices(vocab, k=10_100))) for i in range(26)]  # 262,314 windows
    hot = " ".join(words(its[3][1])[500:520])
    ds = [(i, " ".join(rng.choices(vocab, k=50)) + (" " + hot if i < 60 else "")) for i in range(80)]
    ds += [(100 + i, " ".join(words(its[i][1])[7 * i : 7 * i + (12 if i % 2 else 11)])) for i in range(26)]
    want = {(i, 3) for i in range(60)} | {(100 + i, i) for i in range(26) if i % 2}
    assert {tuple(r) for r in L.leaked_pairs(docs(spark, ds), items(spark, its)).collect()} == want
    m = L.template_matches(docs(spark, ds), items(spark, its), hot_rows=5).where("doc_words = item_words")
    assert {(r.doc_id, r.item_id) for r in m.select("doc_id", "item_id").distinct().collect()} == want


def test_changed_slots_must_be_consistent(spark):
    its = [(1, "mix 5 kg of leek and 5 kg of fig then wait 3 days for rain"), (2, "rows of 4 m and beds of 4 m were seen on the north side of that hill, rows of 4 m and beds of 6 m on the south side of it")]
    ds = [(1, "Mix 8 kg of leek and 8 kg of taro then wait 3 days for rain"), (2, "mix 8 kg of leek and 9 kg of fig then wait 3 days for rain"), (3, its[0][1]), (4, "mix 5 kg of leek and 5 kg of moss then wait 3 days for rain")]
    # one renaming inside each window, but 4 becomes 7 in some and 9 in others
    ds += [(5, its[1][1].replace("4", "7")), (6, "rows of 7 m and beds of 7 m were seen on the north side of that hill, rows of 9 m and beds of 6 m on the south side of it")]
    crops = L.NAMES | {"leek", "fig", "taro"}
    got = {(r.doc_id, r.item_id): (r.same_windows, r.changed_windows) for r in L.leak_kinds(docs(spark, ds), items(spark, its), names=crops).collect()}
    assert got[3, 1][0] == 5 and got[1, 1] == (0, 5)
    assert (2, 1) not in got and ((4, 1) not in got or got[4, 1][1] == 0)
    assert got[5, 2][1] > 0 and got[5, 2][1] > got.get((6, 2), (0, 0))[1] == 0


def test_names_of_a_table(spark):
    df = spark.createDataFrame([(" Leek",), ("leek",), ("bell pepper",), (None,), ("",), ("Ñora",), ("x1",)], "crop string")
    assert L.listed_names(df, "crop") == {"leek", "ñora"}


def test_empty(spark):
    assert L.leaked_pairs(docs(spark, []), items(spark, [(1, "a b")])).count() == 0
    assert L.leaked_pairs(docs(spark, [(1, "a b")]), items(spark, [])).count() == 0


def test_names_are_known_by_form(spark):
    its = [(1, "The first choice at Bramotes, ahead of an untreated rootstock and its 2.5 kg of feed in marzo")]
    ds = [(1, "the first choice at Nini, ahead of an untreated rootstock and its 2.5 kg of feed in marzo"), (2, "the first choice at nothing, ahead of an untreated rootstock and its 2.5 kg of feed in marzo")]
    ds += [(3, "the first choice at Bramotes, ahead of an untreated rootstock and its 12kg of feed in enero"), (4, its[0][1])]
    got = {r.doc_id: (r.same_windows, r.changed_windows) for r in L.leak_kinds(docs(spark, ds), items(spark, its)).collect()}
    assert got[1][1] >= 5 and got[2][1] == 0 and got[3][1] >= 4 and got[4][0] > got[1][0] and got[4][1] == 0
    assert forms("Leek at Nini. Nini: 12kg, 2.5 Leek") == ["^leek", "at", "^nini", "^nini", "12", "kg", "2.5", "^leek"]
    assert not any("^" in w for w in forms("Wir fanden die Probe mit der Blüte am Rand und die Rinde bei dem Baum nach drei Tagen im Beet bei Nini."))
