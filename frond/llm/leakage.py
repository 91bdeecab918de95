"""Evaluation texts inside training text: template windows.

Every word becomes itself or a typed placeholder (number, unit, name). Windows of equal template are
joined by hash. What the placeholders stand for, the slots, then decides: a window is the same
passage if all slots are equal, and a re-parameterised one if the slots of all windows of the
document and the item are a one-to-one renaming.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frond.llm.words import forms, words
from frond.operators.skew import HOT_ROWS, hot_keys, pair_join
from frond.storage import Scratch

WINDOW = 12
#: Item windows that may travel to every task, some 150 bytes each; more go by a shuffle join.
MAX_BROADCAST = 250_000

#: Units of measure and time in English, Spanish and German, and signs of the international system.
UNITS = frozenset(
    "mm cm dm m km in ft ha a acre acres hectare hectares hectarea hectareas hektar mg g gram grams gramo gramos gramm kg kilo kilos t tonne tonnes tonelada toneladas tonnen ml cl l "
    "litre litres liter liters litro litros percent prozent ciento ppm c f k w v s sec min h second seconds segundo segundos sekunde sekunden minute minutes minuto minutos minuten "
    "hour hours hora horas stunde stunden day days dia dias tag tage tagen week weeks semana semanas woche wochen month months mes meses monat monate year years jahr jahre px pixel pixels".split()
)
#: The months in English, Spanish and German. Other names come from a table, or by their form.
NAMES = frozenset(
    "january february march april may june july august september october november december enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre "
    "januar februar märz mai juni juli oktober dezember".split()
)
#: Names that a table may hold, as they travel to every task; more are refused.
MAX_NAMES = 100_000
#: Bits of the filter for more item windows than travel as they are: 32 MB.
FILTER_BITS = 1 << 28

#: Characters whose words are held at once.
GROUP_CHARS = 1 << 22

_NUM, _UNIT, _NAME = 1, 2, 3
_BASE = 0x9E3779B97F4A7C15


def _mix(x):
    """64-bit finaliser (the constants are those of splitmix64)."""
    import numpy as np

    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Lexicon:
    """Ids of words, memoised for a task: a hash of the word, or of its placeholder in a template."""

    def __init__(self, units: Iterable[str] = UNITS, names: Iterable[str] = NAMES, bound: int = 2_000_000):
        self.units, self.names, self.bound = frozenset(units), frozenset(names), bound
        self.known: dict[str, tuple[int, int]] = {}

    def __call__(self, w: str) -> tuple[int, int]:
        got = self.known.get(w)
        if got is None:
            import xxhash

            own = xxhash.xxh3_64_intdigest(w)
            kind = _NAME if w[0] == "^" else _NUM if w[0].isdigit() and w.replace(".", "").replace(",", "").isdigit() else _UNIT if w in self.units else _NAME if w in self.names else 0
            got = (xxhash.xxh3_64_intdigest(f"\0{kind}") if kind else own, own)
            if len(self.known) >= self.bound:  # forgetting costs time only
                self.known.clear()
            self.known[w] = got
        return got


def rolling(ids, width: int):
    """Hash of each run of ``width`` ids: a polynomial modulo 2^64 over mixed ids, mixed again."""
    import numpy as np

    n = len(ids) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    base = np.uint64(_BASE)
    for j in range(width):
        h *= base
        h += ids[j : j + n]
    return _mix(h)


def item_windows(items: list, width: int, lex: Lexicon, cut=words) -> list[tuple]:
    """(template, item_id, length, text of the window) of all windows of all items.

    Items of fewer words than ``width`` have one window of all their words; items without words or
    id have none.
    """
    import numpy as np

    out = []
    for item_id, text in items:
        ws = cut(text)
        if not ws or item_id is None:
            continue
        k = min(width, len(ws))
        ids = _mix(np.array([lex(w)[0] for w in ws], np.uint64))
        for at, h in enumerate(rolling(ids, k)):
            out.append((int(h.astype(np.int64)), item_id, k, " ".join(ws[at : at + k])))
    return out


def _item_table(items: DataFrame, width: int, units, names, cut) -> DataFrame:
    def run(batches):
        import pyarrow as pa

        lex = Lexicon(units, names)
        for b in batches:
            got = item_windows(list(zip(b.column(0).to_pylist(), b.column(1).to_pylist())), width, lex, cut)
            cols = list(zip(*got)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.string())], names=["template", "item_id", "length", "item_words"])

    return items.select(F.col("item_id").cast("bigint"), "text").mapInArrow(run, "template bigint, item_id bigint, length int, item_words string").distinct()


def _hits(group: list, lengths: list[int], seek, lex: Lexicon, cut=words) -> list[tuple]:
    """Wanted windows of some documents; a window's repeats inside a document count once."""
    import numpy as np

    flat: list[str] = []
    ends = []
    for _, t in group:
        flat.extend(cut(t))
        ends.append(len(flat))
    known = lex.known
    codes = _mix(np.array([(known.get(w) or lex(w))[0] for w in flat], np.uint64))
    last = np.array(ends)
    out: list = []
    seen: set = set()
    for k in lengths:
        h = rolling(codes, k).view(np.int64)
        if not len(h):
            continue
        hit = np.flatnonzero(seek(h))
        doc = np.searchsorted(last, hit, side="right")
        inside = hit + k <= last[doc]
        for p, d in zip(hit[inside].tolist(), doc[inside].tolist()):
            text = " ".join(flat[p : p + k])
            if (d, text) not in seen:
                seen.add((d, text))
                out.append((int(h[p]), group[d][0], k, text))
    return out


class Sorted:
    """Membership in a sorted array of hashes."""

    def __init__(self, hashes):
        self.hashes = hashes

    def __call__(self, h):
        import numpy as np

        if not len(self.hashes):
            return np.zeros(len(h), bool)
        at = np.searchsorted(self.hashes, h)
        at[at == len(self.hashes)] = 0
        return self.hashes[at] == h


class Filter:
    """A Bloom filter of two places for each hash: says yes to all members and to a few others."""

    def __init__(self, words, bits: int):
        self.words, self.bits = words, bits

    def __call__(self, h):
        import numpy as np

        u = h.view(np.uint64)
        ok = np.ones(len(u), bool)
        for shift in (0, 32):
            p = (u >> np.uint64(shift)) & np.uint64(self.bits - 1)
            ok &= (self.words[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1) == 1
        return ok


def bloom(hashes: DataFrame, n: int, most: int = FILTER_BITS) -> Filter:
    """The filter of column ``template``: bits are set by an aggregate, at most ``most`` of them.

    About 16 bits for each of ``n`` members, where one window in fifty passes for nothing.
    """
    import numpy as np

    bits = min(most, 1 << max(16, (16 * max(1, n) - 1).bit_length()))
    place = F.explode(F.array(*[F.shiftrightunsigned("template", s).bitwiseAND(F.lit(bits - 1)) for s in (0, 32)])).alias("p")
    set_bits = hashes.select(place).groupBy(F.shiftrightunsigned("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("b")).toArrow()
    words = np.zeros(bits >> 6, np.uint64)
    words[set_bits.column("w").to_numpy()] = set_bits.column("b").to_numpy().view(np.uint64)
    return Filter(words, bits)


def doc_windows(docs: DataFrame, lengths: list[int], wanted, units=UNITS, names=NAMES, cut=words) -> DataFrame:
    """(template, doc_id, length, doc_words) of the windows whose template is among ``wanted``.

    ``wanted`` is a broadcast of a test for hashes. Whole texts are read; the words of documents of together some GROUP_CHARS characters are hashed as one array.
    """

    def run(batches):
        import pyarrow as pa

        lex = Lexicon(units, names)
        seek = wanted.value
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.string())
        for b in batches:
            group: list = []
            chars = 0
            rows = zip(b.column(0).to_pylist(), b.column(1).to_pylist())
            for i, t in [*rows, (None, None)]:
                if i is not None and t:
                    group.append((i, t))
                    chars += len(t)
                if group and (chars >= GROUP_CHARS or (i is None and t is None)):
                    out = _hits(group, lengths, seek, lex, cut)
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["template", "doc_id", "length", "doc_words"])
                    group, chars = [], 0

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "template bigint, doc_id bigint, length int, doc_words string")


def template_matches(docs: DataFrame, items: DataFrame, width: int = WINDOW, units=UNITS, names=NAMES, cut=words, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(template, doc_id, item_id, length, doc_words, item_words): joined windows of equal template.

    If the items have at most MAX_BROADCAST windows, a number that is counted first, their hashes go
    to every task, windows of the corpus that match none never leave it, and the item windows are
    the broadcast side of the hash join, so a passage in a third of all documents makes no large
    task. Beyond that a filter of bounded size takes the place of the hashes, the windows that pass
    are written, and both sides are shuffled by template, hot templates being dealt over many tasks.
    """
    import numpy as np

    spark: SparkSession = docs.sparkSession
    scratch = Scratch(spark)
    mine = scratch.write(_item_table(items, width, units, names, cut), "items")
    lengths = sorted(r[0] for r in mine.select("length").distinct().collect())
    n = mine.count()
    if n <= MAX_BROADCAST:
        hashes = mine.select("template").distinct().toArrow().column(0).to_numpy()
        wanted = spark.sparkContext.broadcast(Sorted(np.sort(hashes)))
        return doc_windows(docs, lengths, wanted, units, names, cut).join(F.broadcast(mine), ["template", "length"])
    wanted = spark.sparkContext.broadcast(bloom(mine.select("template"), n))
    found = scratch.write(doc_windows(docs, lengths, wanted, units, names, cut), "windows")
    hot = hot_keys(found.groupBy("template").agg(F.count(F.lit(1)).alias("n")), "template", "n", hot_rows)
    theirs = mine.withColumnRenamed("length", "_length")
    return pair_join(found, theirs, "template", F.col("doc_id"), hot).where("length = _length").drop("_length")


def leaked_pairs(docs: DataFrame, items: DataFrame, width: int = WINDOW) -> DataFrame:
    """(doc_id, item_id): 12 consecutive words of the item stand consecutively in the document.

    Of matching templates only those with all slots equal count. Null texts and texts without words
    leak nothing. One row for each pair.
    """
    same = template_matches(docs, items, width).where(F.col("doc_words") == F.col("item_words"))
    return same.select("doc_id", "item_id").distinct()


def listed_names(df: DataFrame, column: str) -> frozenset:
    """The different names in a column, as a lexicon's names: lower-cased, one word each.

    For a dimension such as the crops of a corpus. More than MAX_NAMES are refused, since they go to
    every task; nulls and names of several words are left out.
    """
    one = F.lower(F.trim(F.col(column)))
    got = df.select(one.alias("n")).where(F.col("n").rlike(r"^\p{L}+$")).distinct().limit(MAX_NAMES + 1).collect()
    if len(got) > MAX_NAMES:
        raise ValueError(f"more than {MAX_NAMES} names")
    return frozenset(r.n for r in got)


def slots(text: F.Column, units=UNITS, names=NAMES) -> F.Column:
    """Values of the placeholders of a window, in order."""
    typed = lambda w: w.rlike("^[0-9]+([.,][0-9]+)*$") | w.startswith("^") | w.isin(*sorted(frozenset(units) | frozenset(names)))
    return F.transform(F.filter(F.split(text, " "), typed), lambda w: F.ltrim(w, F.lit("^")))


def leak_kinds(docs: DataFrame, items: DataFrame, width: int = WINDOW, units=UNITS, names=NAMES) -> DataFrame:
    """(doc_id, item_id, same_windows, changed_windows) of documents with an item's template.

    Same: all slots equal. Changed: slots differ, but over all windows of the document that have a
    template of the item each value of the item became one value, and no two became the same; a
    pair without such a one-to-one renaming has no changed windows. Pairs with neither are not
    reported. Changed windows are sought in words and in ``forms``, where names are known by their
    capital, each with a renaming of its own, and counted once; same windows are those of the words,
    as in ``leaked_pairs``. ``names`` are those besides the ones known by form, see ``listed_names``.
    """
    cols = ("item_words", "doc_words")
    scratch = Scratch(docs.sparkSession)

    def kinds(cut, tag: str) -> DataFrame:
        m = template_matches(docs, items, width, units, names, cut)
        z = F.array_distinct(F.arrays_zip(*[slots(F.col(c), units, names).alias(n) for c, n in zip(cols, "id")]))
        m = scratch.write(m.select("doc_id", "item_id", *cols, z.alias("z")), tag)
        became = m.select("doc_id", "item_id", F.explode("z").alias("s")).select("doc_id", "item_id", "s.i", "s.d").distinct()
        per = became.groupBy("doc_id", "item_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("i").alias("ni"), F.count_distinct("d").alias("nd"))
        torn = per.where("n <> ni or n <> nd").select("doc_id", "item_id", F.lit(True).alias("torn"))
        out = m.join(torn, ["doc_id", "item_id"], "left")
        return out.select("doc_id", "item_id", *[F.replace(F.col(c), F.lit("^"), F.lit("")).alias(c) for c in cols], F.col("torn").isNull().alias("one"))

    same = F.col("doc_words") == F.col("item_words")
    plain = kinds(words, "words").where(same | F.col("one"))
    both = plain.unionByName(kinds(forms, "forms").where(~same & F.col("one"))).select("doc_id", "item_id", *cols).distinct()
    return both.groupBy("doc_id", "item_id").agg(F.count_if(same).alias("same_windows"), F.count_if(~same).alias("changed_windows"))
