"""Same or near-same images across splits: a weighted cosine join over inverted lists.

Vectors are sets of weighted terms, and each term has one inverted list. With the terms of all
vectors in one order, rarest first, a pair whose dot product reaches the threshold has its first
common term among the first terms of both vectors: among those that have to be listed so that what
is left, the residual, cannot reach the threshold by itself. Two bounds say so: the residual's norm
(times the other vector's norm) and the sum of its weights times each term's greatest weight on the
other side. Only these first terms are joined; dot products of the pairs that meet are exact.

A 64-bit fingerprint becomes such a vector by cutting it into B blocks: every choice of m blocks
with their content is a term. Fingerprints that differ in at most k bits agree on B - k blocks, so
they share at least s = C(B - k, m) terms. A term weighs ln(1 + N / n), n being a bound on its list
length; the least dot product of s shared terms is the vector's own threshold. So the fullest lists,
such as those of near-blank pictures, are left out first. The dot product of the fingerprints
themselves, 64 signed terms of 1/8, decides: at most k bits is a cosine of at least 1 - 2k/64.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frond.functions.keys import digest, fingerprint, split_name
from frond.operators.skew import HOT_ROWS, hot_keys, lookup, pair_join
from frond.storage import Scratch

BITS = 64
#: Sums of weights may differ in the last places by their order.
SLACK = 1e-9


def listed(v: Column, least: Column, norm: Column, last: int | None = None) -> Column:
    """How many first terms of a vector are listed; the rest cannot reach ``least`` by itself.

    ``v`` is an array of structs with weight and most, the greatest weight of the term on the other
    side; ``norm`` is a bound on the other side's norms. ``last`` terms are looked at, where it is
    known that these together reach ``least``.
    """
    zero = F.struct(F.lit(0).alias("rest"), F.lit(0.0).alias("squares"), F.lit(0.0).alias("sums"))

    def add(acc: Column, x: Column) -> Column:
        squares, sums = acc["squares"] + x["weight"] * x["weight"], acc["sums"] + F.abs(x["weight"]) * x["most"]
        out = F.least(F.sqrt(squares) * norm, sums) < least - SLACK
        return F.struct((acc["rest"] + out.cast("int")).alias("rest"), squares.alias("squares"), sums.alias("sums"))

    return F.size(v) - F.aggregate(F.reverse(F.slice(v, -last, last) if last else v), zero, add)["rest"]


def _postings(vectors: DataFrame, name: str, least: Column, norm: Column, term: Column | None = None, last: int | None = None) -> DataFrame:
    first = F.slice("v", 1, F.greatest(listed(F.col("v"), least, norm, last), F.lit(0)))
    return vectors.select(F.col("id").alias(name), F.explode(first).alias("t")).select(name, (F.col("t.term") if term is None else term).alias("term"))


def _vectors(rows: DataFrame) -> DataFrame:
    """(id, term, weight) of vectors of norm 1; a repeated term of a vector is added up, weights of 0 go."""
    w = rows.where("id is not null and term is not null").groupBy("id", "term").agg(F.sum(F.coalesce("weight", F.lit(0.0))).alias("weight")).where("weight <> 0")
    norms = w.groupBy("id").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    return w.join(norms, "id").select("id", "term", (F.col("weight") / F.col("norm")).alias("weight"))


def cosine_join(left: DataFrame, right: DataFrame, threshold: float, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(id_left, id_right, cosine) of all pairs with a cosine of at least ``threshold`` > 0, exactly.

    Inputs are rows (id, term, weight) with a string or whole-number term; null ids, terms and
    weights count as absent, so a vector without terms matches nothing. Terms that only one side has
    are dropped. Terms of very many vectors are looked up and joined without gathering in one task.
    A vector's terms are gathered, which is its own size. Empty sides give no rows.
    """
    if not threshold > 0:
        raise ValueError("the threshold has to be above 0")
    scratch = Scratch(left.sparkSession)
    a, b = scratch.write(_vectors(left), "left"), scratch.write(_vectors(right), "right")
    side = lambda df, n: df.groupBy("term").agg(F.count(F.lit(1)).alias(f"n_{n}"), F.max(F.abs("weight")).alias(f"most_{n}"))
    lists = side(a, "left").join(side(b, "right"), "term").withColumn("n", F.col("n_left") + F.col("n_right"))
    lists = scratch.write(lists, "lists")
    hot = hot_keys(lists, "term", "n", hot_rows)

    def gathered(df: DataFrame, most: str) -> DataFrame:
        rows = lookup(df, lists.select("term", "n", F.col(most).alias("most")), "term", hot)
        return scratch.write(rows.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("n", "term", "weight", "most"))).alias("v")), "vectors")

    x, y = gathered(a, "most_right"), gathered(b, "most_left")
    least, norm = F.lit(float(threshold)), F.lit(1.0)
    met = pair_join(_postings(x, "id_left", least, norm), _postings(y, "id_right", least, norm), "term", F.col("id_left"), hot).select("id_left", "id_right").distinct()
    flat = lambda df, n: df.select(F.col("id").alias(f"id_{n}"), F.map_from_entries(F.transform("v", lambda t: F.struct(t["term"], t["weight"]))).alias(f"m_{n}"))
    both = met.join(flat(x, "left"), "id_left").join(flat(y, "right"), "id_right")
    dot = F.aggregate(F.map_entries("m_left"), F.lit(0.0), lambda s, e: s + e["value"] * F.coalesce(F.try_element_at("m_right", e["key"]), F.lit(0.0)))
    return both.select("id_left", "id_right", dot.alias("cosine")).where(F.col("cosine") >= threshold - SLACK)


# ---- fingerprints as vectors ------------------------------------------------------------------


def block_masks(blocks: int) -> list[int]:
    """Bit masks of ``blocks`` nearly even, adjoining blocks of the 64 places."""
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask


def choose_lists(n_left: int, n_right: int, max_bits: int) -> tuple[int, int]:
    """(blocks, blocks of a term) of least expected cost; every choice gives the same pairs.

    Few blocks mean few lists but short equal parts, hence more candidates by chance; their number
    is estimated for fingerprints spread evenly. A candidate costs about a fifth of a shuffled row.
    Choices whose vectors share one term only are left out, as no list could be spared then.
    """

    def cost(c: tuple[int, int]) -> float:
        blocks, m = c
        kept = comb(blocks, m) - comb(blocks - max_bits, m) + 1
        return kept * (n_left + n_right + 0.2 * n_left * n_right / 2 ** (BITS * m / blocks))

    fewest = max(6, max_bits + 2)  # a block's contents are counted, so it may not be wide
    most = min(BITS, max(fewest, max_bits + 5))
    return min(((b, m) for b in range(fewest, most + 1) for m in range(1, b - max_bits)), key=cost)


def block_counts(fps: DataFrame, blocks: int) -> list[int]:
    """How many fingerprints have each content of each block, by place in one array.

    The array's size follows from the number of blocks, at most blocks * 2^(64 / blocks + 1) numbers,
    whatever the data; these counts are all that the driver sees.
    """
    masks, width = block_masks(blocks), 1 << -(-BITS // blocks)
    slots = F.array(*[_slot(F.col("fp"), i, m, width) for i, m in enumerate(masks)])
    got = fps.select(F.explode(slots).alias("slot")).groupBy("slot").agg(F.count(F.lit(1)).alias("n")).collect()
    out = [0] * (blocks * width)
    for slot, n in got:
        out[slot] = n
    return out


def _slot(fp: Column, i: int, mask: int, width: int) -> Column:
    low = (mask & -mask).bit_length() - 1
    return (F.shiftrightunsigned(fp.bitwiseAND(F.lit(_signed(mask))), low) + F.lit(i * width)).cast("int")


def fingerprint_vectors(fps: DataFrame, blocks: int, m: int, counts: list[int]) -> DataFrame:
    """(id, v): terms of each fingerprint, rarest first; n bounds the list length by the rarest block."""
    spark, masks, width = fps.sparkSession, block_masks(blocks), 1 << -(-BITS // blocks)
    total = float(max(1, sum(counts) // blocks))
    table = spark.createDataFrame([(counts,)], "counts array<bigint>")  # one row of a size that blocks fixes
    x = fps.select("fp", F.array(*[_slot(F.col("fp"), i, k, width) for i, k in enumerate(masks)]).alias("slots")).crossJoin(F.broadcast(table))
    x = x.select("fp", F.transform("slots", lambda s: F.get("counts", s)).alias("loads"))
    terms = []
    for i, c in enumerate(combinations(range(blocks), m)):
        part = F.col("fp").bitwiseAND(F.lit(_signed(sum(masks[j] for j in c))))
        loads = [F.get("loads", F.lit(j)) for j in c]
        terms.append(F.struct((F.least(*loads) if m > 1 else loads[0]).alias("n"), F.lit(i).alias("list"), part.alias("content")))
    weighed = []
    for t in terms:
        w = F.log1p(F.lit(total) / F.greatest(t["n"], F.lit(1)))
        weighed.append(F.struct(t["n"].alias("n"), t["list"].alias("list"), t["content"].alias("content"), w.alias("weight"), w.alias("most")))
    return x.select(F.col("fp").alias("id"), F.array_sort(F.array(*weighed)).alias("v"))


def fingerprint_join(left: DataFrame, right: DataFrame, max_bits: int = 5, lists: tuple[int, int] | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Pairs (fp_left, fp_right, cosine) of distinct fingerprints with at most ``max_bits`` differing.

    Inputs have a column ``fp`` and should hold each fingerprint once; null fingerprints match
    nothing. ``lists`` (blocks, blocks of a term) is chosen by the inputs' sizes unless given. Every
    pair is found once. Lists longer than ``hot_rows`` are split, which their bound tells beforehand.
    """
    a, b = left.where("fp is not null").select("fp"), right.where("fp is not null").select("fp")
    n_left, n_right = a.count(), b.count()
    blocks, m = lists or choose_lists(n_left, n_right, max_bits)
    if max_bits < 0 or not max(4, max_bits + 1) <= blocks <= BITS or not 1 <= m <= blocks - max_bits:
        raise ValueError("needs max_bits < blocks, 4 to 64 blocks, and terms of 1 to blocks - max_bits blocks")
    counts = block_counts(a.unionByName(b), blocks)
    shared = comb(blocks - max_bits, m)
    least = F.aggregate(F.slice("v", -shared, shared), F.lit(0.0), lambda s, t: s + t["weight"] * t["weight"])
    every = F.lit(float("inf"))  # weights are not scaled to norm 1
    term = F.xxhash64("t.list", "t.content")
    # a table of eight bytes a row has few files, but its rows become many: all cores take part
    tasks = left.sparkSession.sparkContext.defaultParallelism
    wide = lambda df, n: df.repartition(max(tasks, n // 250_000), "fp")
    x = _postings(fingerprint_vectors(wide(a, n_left), blocks, m, counts), "fp_left", least, every, term, shared)
    y = _postings(fingerprint_vectors(wide(b, n_right), blocks, m, counts), "fp_right", least, every, term, shared)
    hot: list = []
    if max(counts) > hot_rows:  # else no list can be that long
        hot = hot_keys(x.groupBy("term").agg(F.count(F.lit(1)).alias("n")), "term", "n", hot_rows)
    dot = F.lit(1.0) - F.bit_count(F.col("fp_left").bitwiseXOR(F.col("fp_right"))) * (2.0 / BITS)
    met = pair_join(x, y, "term", F.col("fp_left"), hot).where(dot >= 1.0 - 2.0 * max_bits / BITS)
    return met.select("fp_left", "fp_right", dot.alias("cosine")).distinct()


def prepared(images: DataFrame) -> DataFrame:
    """(image_id, split, source, hash, fp) of images with an id and a known split."""
    return images.select(
        F.col("image_id"), split_name(F.col("split")).alias("split"), F.coalesce(F.lower(F.trim("dataset_source")), F.lit("")).alias("source"),
        digest(F.col("sha256_hash")).alias("hash"), fingerprint(F.col("phash")).alias("fp"),
    ).where(F.col("image_id").isNotNull() & F.col("split").isNotNull())


def class_overlaps(p: DataFrame, max_bits: int = 5) -> DataFrame:
    """(fp_left, fp_right, cosine): fingerprints of train that are near one of val or test.

    ``p`` is a prepared table. Copies count once: joins run over distinct fingerprints, so a fingerprint that a third of all
    images share is one row on each side.
    """
    scratch = Scratch(p.sparkSession)
    side = lambda c: scratch.write(p.where(F.col("fp").isNotNull() & c).groupBy("fp").agg(F.lit(1).alias("_")).select("fp"), "side")
    return fingerprint_join(side(F.col("split") == "train"), side(F.col("split") != "train"), max_bits)


def _hot_of(rows: int, hot_rows: int):
    """Finds the hot keys of a column; a table of at most ``hot_rows`` rows can have none."""

    def of(df: DataFrame, c: str) -> list:
        if rows <= hot_rows:
            return []
        return hot_keys(df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n")), c, "n", hot_rows)

    return of


def image_pairs(images: DataFrame, max_bits: int = 5, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(image_id_a, image_id_b), a < b: one in train, the other in val or test, same hash or near.

    Images without split or id take no part; a missing hash or fingerprint equals nothing. Each
    pair has one row. Copies are expanded here, since the result lists images; a hash or fingerprint
    of very many images is dealt over many tasks.
    """
    p = Scratch(images.sparkSession).write(prepared(images), "images")
    train, held = p.where(F.col("split") == "train"), p.where(F.col("split") != "train")
    t = train.select(F.col("image_id").alias("t"), F.col("hash").alias("th"), F.col("fp").alias("fp_left"))
    h = held.select(F.col("image_id").alias("h"), F.col("hash").alias("hh"), F.col("fp").alias("fp_right"))
    hot = _hot_of(p.count(), hot_rows)
    # a hash is a vector of one term: its list is the join
    same = pair_join(t.withColumnRenamed("th", "hash"), h.withColumnRenamed("hh", "hash"), "hash", F.col("t"), hot(t, "th")).select("t", "h")
    near = Scratch(images.sparkSession).write(class_overlaps(p, max_bits), "near")
    near = pair_join(t, near, "fp_left", F.col("t"), hot(t, "fp_left"))
    near = pair_join(near, h, "fp_right", F.col("t"), hot(h, "fp_right"))
    near = near.where(~F.coalesce(F.col("th") == F.col("hh"), F.lit(False))).select("t", "h")
    both = same.unionByName(near)
    return both.select(F.least("t", "h").alias("image_id_a"), F.greatest("t", "h").alias("image_id_b")).where("image_id_a < image_id_b").distinct()


def overlap_report(images: DataFrame, max_bits: int = 5, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(split, source, images, same_hash, near, leaked): held-out images by overlap with train.

    No pair of images is formed: a held-out image is marked by its hash and by its fingerprint, so
    the cost follows the distinct values.
    """
    p = Scratch(images.sparkSession).write(prepared(images), "images")
    hashes = p.where("split = 'train' and hash is not null").groupBy("hash").agg(F.lit(True).alias("same"))
    fps = class_overlaps(p, max_bits).groupBy(F.col("fp_right").alias("fp")).agg(F.lit(True).alias("close"))
    held = p.where("split <> 'train'")
    # counted by (split, source, hash, fp) first: copies shrink before the joins on hash and fp
    held = held.groupBy("split", "source", "hash", "fp").agg(F.count(F.lit(1)).alias("n"))
    held = Scratch(images.sparkSession).write(held, "held")
    hot = _hot_of(held.count(), hot_rows)
    held = lookup(lookup(held, hashes, "hash", hot(held, "hash"), "left"), fps, "fp", hot(held, "fp"), "left")
    n = lambda c: F.sum(F.when(c, F.col("n")).otherwise(F.lit(0)))
    s, c = F.coalesce("same", F.lit(False)), F.coalesce("close", F.lit(False))
    return held.groupBy("split", "source").agg(F.sum("n").alias("images"), n(s).alias("same_hash"), n(c).alias("near"), n(s | c).alias("leaked"))
