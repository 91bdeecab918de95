"""Long exact spans shared between documents.

Two operators. ``shared_sentences`` slides over sentences: the shortest long enough runs from and to
each are hashed, which cover all longer ones, runs are joined globally, and sentences covered by a
repeated run are measured or, unless the run is the first of its kind, removed. Sentence borders
cannot promise to find every stretch of 300 characters, since such a stretch may lie inside one
sentence or hold a single whole one; so ``stretch_pairs``, ``shared_stretches`` and
``stretch_shares`` slide over borders chosen by content (see anchors) and are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from frond.llm.anchors import anchors
from frond.operators.skew import HOT_ROWS, hot_keys, lookup, pair_join
from frond.storage import Scratch

SPAN = 300
GRAM = 200
#: Places of a gram that are compared pair by pair; larger groups go by their exact windows.
PAIRED_GROUP = 64


def _texts(docs: DataFrame, span: int) -> DataFrame:
    long_enough = F.col("doc_id").isNotNull() & (F.length("text") >= span)
    return docs.where(long_enough).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")


def copies(docs: DataFrame, scratch: Scratch, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(doc_id, rep): documents of equal texts, by SHA-256, with the smallest id among them.

    Only classes of two or more appear. An id that is listed twice with one text is one document.
    """
    d = docs.select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest")).distinct()
    reps = d.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n")).where("n > 1")
    reps = scratch.write(reps, "classes")
    return lookup(d, reps.select("digest", "rep"), "digest", hot_keys(reps, "digest", "n", hot_rows)).select("doc_id", "rep")


def _anchor_rows(docs: DataFrame, span: int, gram: int) -> DataFrame:
    """(h, doc_id, text_key, at): named grams of each text."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            who, at, h = anchors(b.column("text").to_pylist(), span, gram)
            if len(who):
                ids, keys = b.column("doc_id").take(pa.array(who)), b.column("text_key").take(pa.array(who))
                yield pa.RecordBatch.from_arrays([pa.array(h), ids, keys, pa.array(at.astype("int32"))], names=["h", "doc_id", "text_key", "at"])

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    return rows.mapInArrow(run, "h bigint, doc_id bigint, text_key bigint, at int")


def _contexts(docs: DataFrame, places: DataFrame, span: int, gram: int) -> DataFrame:
    """(h, large, doc_id, at, before, gram, after): the gram with up to span - gram characters on either side.

    ``before`` is reversed, so that common endings are common beginnings. A document's places are
    gathered first, at most as many as its grams, and meet its text once.
    """
    margin = span - gram
    per = places.groupBy("doc_id").agg(F.collect_list(F.struct("at", "h", "large")).alias("places"))

    def run(batches):
        import pyarrow as pa

        names = ["h", "large", "doc_id", "at", "before", "gram", "after"]
        for b in batches:
            out: list = []
            for d, t, ps in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), b.column("places").to_pylist()):
                for p in ps:
                    a = p["at"]
                    out.append((p["h"], p["large"], d, a, t[max(0, a - margin) : a][::-1], t[a : a + gram], t[a + gram : a + span]))
            if out:
                cols = list(zip(*out))
                cols[3] = pa.array(cols[3], pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=names)

    return docs.join(per, "doc_id").mapInArrow(run, "h bigint, large boolean, doc_id bigint, at int, before string, gram string, after string")


def _common(a: list, b: list) -> list:
    """Length of the common beginning of each two texts."""
    out = []
    for x, y in zip(a, b):
        n = min(len(x), len(y))
        if x[:n] == y[:n]:
            out.append(n)
            continue
        low, high = 0, n  # x[:low] == y[:low], x[:high] != y[:high]
        while high - low > 1:
            mid = (low + high) // 2
            if x[low:mid] == y[low:mid]:
                low = mid
            else:
                high = mid
        out.append(low)
    return out


def _paired(ctx: DataFrame, margin: int) -> DataFrame:
    """Pairs of one gram whose common context reaches the span."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            col = lambda n: b.column(n).to_pylist()  # noqa: E731, B023
            reach = np.array(_common(col("b1"), col("b2")), np.int64) + np.array(_common(col("a1"), col("a2")), np.int64)
            good = pa.array(reach >= margin)
            yield pa.RecordBatch.from_arrays([b.column("d1").filter(good), b.column("d2").filter(good)], names=["rep_a", "rep_b"])

    one = ctx.select("h", F.col("doc_id").alias("d1"), F.col("before").alias("b1"), F.col("gram").alias("g1"), F.col("after").alias("a1"))
    two = ctx.select("h", F.col("doc_id").alias("d2"), F.col("before").alias("b2"), F.col("gram").alias("g2"), F.col("after").alias("a2"))
    both = one.join(two, "h").where("d1 < d2 and g1 = g2").select("d1", "d2", "b1", "b2", "a1", "a2")
    return both.mapInArrow(run, "rep_a bigint, rep_b bigint").distinct()


def _windowed(ctx: DataFrame, span: int, gram: int, scratch: Scratch, hot_rows: int) -> DataFrame:
    """Pairs of large groups, by the exact windows that contain the gram.

    Documents that only share the gram part here, each window being a key of its own; the documents
    of a window are all pairs of the result, so no work is spent on pairs that fail. Neighbouring
    windows of a stretch mostly have the same documents: of windows with one set of documents, told
    by its size and two exclusive ors of hashes, one forms the pairs.
    """
    margin = span - gram

    def run(batches):
        import pyarrow as pa

        for b in batches:
            out: list = []
            for d, x, g, y in zip(*[b.column(n).to_pylist() for n in ("doc_id", "before", "gram", "after")]):
                whole, lead = x[::-1] + g + y, len(x)
                for s in range(max(0, lead - margin), min(lead, len(whole) - span) + 1):
                    out.append((d, whole[s : s + span]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["doc_id", "window"])

    cut = ctx.mapInArrow(run, "doc_id bigint, window string")
    cut = scratch.write(cut.select("doc_id", F.unhex(F.sha2("window", 256)).alias("window")).distinct(), "windows")
    sets = cut.groupBy("window").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("doc_id")).alias("x"), F.bit_xor(F.xxhash64("doc_id", F.lit(1))).alias("y")).where("n > 1")
    one_each = scratch.write(sets.groupBy("n", "x", "y").agg(F.min("window").alias("window")).select("window", "n"), "sets")
    hot = hot_keys(one_each, "window", "n", hot_rows)
    cut = lookup(cut, one_each.select("window"), "window", hot)
    one, two = cut.select("window", F.col("doc_id").alias("rep_a")), cut.select("window", F.col("doc_id").alias("rep_b"))
    return pair_join(one, two, "window", F.col("rep_a"), hot).where("rep_a < rep_b").select("rep_a", "rep_b").distinct()


def class_pairs(docs: DataFrame, span: int = SPAN, gram: int = GRAM, paired: int = PAIRED_GROUP, scratch: Scratch | None = None, hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """Pairs (rep_a, rep_b) of different texts with ``span`` common characters, and the copies table.

    Grams that only one text names are dropped after a combining aggregate. Copies take part by
    their representative, so a text that a third of the documents repeat is one text. Grams at up to
    ``paired`` places are compared in pairs; larger groups by exact windows, whole.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    ctx, same = _met(docs, span, gram, paired, scratch, hot_rows)
    small = _paired(ctx.where("not large"), span - gram)
    large = _windowed(ctx.where("large"), span, gram, scratch, hot_rows)
    return small.unionByName(large).distinct(), same


def _met(docs: DataFrame, span: int, gram: int, paired: int, scratch: Scratch, hot_rows: int) -> tuple[DataFrame, DataFrame]:
    """Contexts of the grams that several texts name, and the copies table."""
    long_docs = _texts(docs, span)
    same = scratch.write(copies(long_docs, scratch, hot_rows), "copies")
    rows = scratch.write(_anchor_rows(long_docs, span, gram), "anchors")
    shared = rows.groupBy("h").agg(F.min("text_key").alias("x"), F.max("text_key").alias("y"), F.count(F.lit(1)).alias("n")).where("x <> y")
    shared = scratch.write(shared.select("h", "n", (F.col("n") > paired).alias("large")), "shared")
    others = same.where("doc_id <> rep").select("doc_id")
    # a gram may stand at several places of a text: all count
    places = lookup(rows.select("h", "doc_id", "at"), shared.drop("n"), "h", hot_keys(shared, "h", "n", hot_rows))
    places = places.join(others, "doc_id", "left_anti").distinct()
    return scratch.write(_contexts(long_docs, scratch.write(places, "places"), span, gram), "contexts"), same


def stretch_pairs(docs: DataFrame, span: int = SPAN, gram: int = GRAM, paired: int = PAIRED_GROUP, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(doc_id_a, doc_id_b), a < b: documents whose texts have ``span`` consecutive characters in common.

    Null, empty and shorter texts share nothing; compared exactly, by code points. Copies are
    expanded to documents at the end.
    """
    scratch = Scratch(docs.sparkSession)
    reps, same = class_pairs(docs, span, gram, paired, scratch, hot_rows)
    hot = hot_keys(same.groupBy("rep").agg(F.count(F.lit(1)).alias("n")), "rep", "n", hot_rows)
    reps = scratch.write(reps, "reps")
    alone = reps.select(F.col("rep_a").alias("rep")).unionByName(reps.select(F.col("rep_b").alias("rep"))).distinct().join(same, "rep", "left_anti")
    members = scratch.write(same.select("rep", "doc_id").unionByName(alone.select("rep", F.col("rep").alias("doc_id"))), "members")
    member = lambda n: members.select(F.col("rep").alias(f"rep_{n}"), F.col("doc_id").alias(f"m_{n}"))
    wide = pair_join(reps, member("a"), "rep_a", F.col("rep_b"), hot)
    wide = pair_join(wide, member("b"), "rep_b", F.col("m_a"), hot)
    wide = wide.select(F.least("m_a", "m_b").alias("doc_id_a"), F.greatest("m_a", "m_b").alias("doc_id_b"))
    one, two = same.select("rep", F.col("doc_id").alias("doc_id_a")), same.select("rep", F.col("doc_id").alias("doc_id_b"))
    inner = pair_join(one, two, "rep", F.col("doc_id_a"), hot).where("doc_id_a < doc_id_b").select("doc_id_a", "doc_id_b")
    return wide.unionByName(inner)


def _paired_ranges(ctx: DataFrame, margin: int) -> DataFrame:
    """(doc_id, start, end): both sides of each two places of one gram whose common context reaches the span."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            col = lambda n: b.column(n).to_pylist()  # noqa: E731, B023
            before, after = np.array(_common(col("b1"), col("b2")), np.int32), np.array(_common(col("a1"), col("a2")), np.int32)
            good = before + after >= margin
            for d, at in (("d1", "at1"), ("d2", "at2")):
                p = b.column(at).to_numpy()[good]
                ends = p + b.column("size").to_numpy()[good] + after[good]
                yield pa.RecordBatch.from_arrays([b.column(d).filter(pa.array(good)), pa.array(p - before[good], pa.int32()), pa.array(ends, pa.int32())], names=["doc_id", "start", "end"])

    side = lambda n: ctx.select("h", *[F.col(c).alias(f"{a}{n}") for c, a in (("doc_id", "d"), ("at", "at"), ("before", "b"), ("gram", "g"), ("after", "a"))])
    both = side(1).join(side(2), "h").where("d1 < d2 and g1 = g2").select("d1", "d2", "at1", "at2", "b1", "b2", "a1", "a2", F.length("g1").cast("int").alias("size"))
    return both.mapInArrow(run, "doc_id bigint, start int, end int")


def _windowed_ranges(ctx: DataFrame, span: int, gram: int, scratch: Scratch, hot_rows: int) -> DataFrame:
    """(doc_id, start, end): windows of large groups that another document has, without forming pairs."""
    margin = span - gram

    def run(batches):
        import hashlib

        import pyarrow as pa

        for b in batches:
            out: list = []
            for d, at, x, g, y in zip(*[b.column(n).to_pylist() for n in ("doc_id", "at", "before", "gram", "after")]):
                whole, lead = x[::-1] + g + y, len(x)
                for s in range(max(0, lead - margin), min(lead, len(whole) - span) + 1):
                    out.append((hashlib.blake2b(whole[s : s + span].encode("utf-8", "surrogatepass"), digest_size=16).digest(), d, at - lead + s))
            if out:
                w, d, s = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(w, pa.binary()), pa.array(d, pa.int64()), pa.array(s, pa.int32())], names=["window", "doc_id", "start"])

    cut = scratch.write(ctx.mapInArrow(run, "window binary, doc_id bigint, start int"), "windows")
    again = cut.groupBy("window").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count(F.lit(1)).alias("n")).where("low < high")
    again = scratch.write(again.select("window", "n"), "again")
    got = lookup(cut, again.select("window"), "window", hot_keys(again, "window", "n", hot_rows))
    return got.select("doc_id", "start", (F.col("start") + F.lit(span)).cast("int").alias("end"))


def shared_stretches(docs: DataFrame, span: int = SPAN, gram: int = GRAM, paired: int = PAIRED_GROUP, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(doc_id, start, end): where a text has ``span`` or more consecutive characters in common with other documents.

    Positions count code points from 0. Exact: a character is inside if and only if it lies in a
    common stretch; stretches that overlap, with whichever documents, are one row. Copies are shared
    from end to end. No pairs of documents are formed beyond groups of ``paired`` places.
    """
    scratch = Scratch(docs.sparkSession)
    ctx, same = _met(docs, span, gram, paired, scratch, hot_rows)
    small = _paired_ranges(ctx.where("not large"), span - gram)
    parts = small.unionByName(_windowed_ranges(ctx.where("large"), span, gram, scratch, hot_rows))
    parts = parts.groupBy("doc_id", "start").agg(F.max("end").alias("end"))
    seen = W.partitionBy("doc_id").orderBy("start")
    parts = parts.withColumn("reach", F.max("end").over(seen.rowsBetween(W.unboundedPreceding, -1)))
    parts = parts.withColumn("part", F.count_if(F.col("reach").isNull() | (F.col("start") >= F.col("reach"))).over(seen.rowsBetween(W.unboundedPreceding, 0)))
    merged = parts.groupBy("doc_id", "part").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("part")
    ids = same.select("doc_id").distinct()
    whole = _texts(docs, span).join(ids, "doc_id").groupBy("doc_id").agg(F.max(F.length("text")).cast("int").alias("end"))
    return merged.join(ids, "doc_id", "left_anti").unionByName(whole.select("doc_id", F.lit(0).alias("start"), "end"))


# ---- sliding sentence spans -------------------------------------------------------------------


def sentence_bounds(text: str) -> list[tuple[int, int]]:
    """(start, end) of the sentences: they end after . ! ? and blanks, or at a line end."""
    import re

    out, start = [], 0
    for m in re.finditer(r"[.!?]+[\"')\]]*\s+|\s*\n\s*", text):
        if m.end() > start:
            out.append((start, m.end()))
            start = m.end()
    if start < len(text):
        out.append((start, len(text)))
    return out


def sentence_runs(text: str, min_chars: int, least: int) -> list[tuple[int, int, int, int]]:
    """(first sentence, number, start, end): from each sentence the shortest run of at least ``least``
    sentences and ``min_chars`` characters, trailing blanks not counted."""
    b = sentence_bounds(text)
    trim = [s + len(text[s:e].rstrip()) for s, e in b]
    out, j = [], 0
    for i in range(len(b)):
        j = max(j, i + least - 1)
        while j < len(b) and trim[j] - b[i][0] < min_chars:
            j += 1
        if j >= len(b):
            break
        out.append((i, j - i + 1, b[i][0], trim[j]))
    return out


def ending_runs(text: str, min_chars: int, least: int) -> list[tuple[int, int, int, int]]:
    """As ``sentence_runs``, to each sentence the shortest such run.

    Together they cover every longer run: a run's last sentences, which its shortest beginnings may
    not reach, are in the shortest run that ends with it.
    """
    b = sentence_bounds(text)
    trim = [s + len(text[s:e].rstrip()) for s, e in b]
    out, i = [], -1
    for j in range(least - 1, len(b)):
        while i + 1 <= j - least + 1 and trim[j] - b[i + 1][0] >= min_chars:
            i += 1
        while i >= 0 and trim[j] - b[i][0] < min_chars:
            i -= 1
        if i >= 0:
            out.append((i, j - i + 1, b[i][0], trim[j]))
    return out


def _runs(docs: DataFrame, min_chars: int, least: int) -> DataFrame:
    def run(batches):
        import hashlib

        import pyarrow as pa

        names = ["span", "doc_id", "first", "start", "end"]
        for b in batches:
            out: list = []
            for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                for i, _, s, e in sorted({*sentence_runs(t, min_chars, least), *ending_runs(t, min_chars, least)}):
                    out.append((hashlib.blake2b(t[s:e].encode("utf-8", "surrogatepass"), digest_size=16).digest(), d, i, s, e))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int32()))], names=names)

    return docs.mapInArrow(run, "span binary, doc_id bigint, first int, start int, end int")


def repeated_runs(docs: DataFrame, min_chars: int = SPAN, least: int = 2, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(doc_id, first, start, end, elsewhere, is_first): runs of sentences that occur more than once.

    ``elsewhere`` says whether another document has the run; ``is_first`` marks the occurrence of the
    smallest (doc_id, first). A run that a third of all documents hold is looked up by broadcast.
    """
    scratch = Scratch(docs.sparkSession)
    rows = scratch.write(_runs(_texts(docs, 1), min_chars, least), "runs")
    stats = rows.groupBy("span").agg(
        F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.min(F.struct("doc_id", "first")).alias("lead"),
    ).where("n > 1")
    stats = scratch.write(stats, "spans")
    hot = hot_keys(stats, "span", "n", hot_rows)
    got = lookup(rows, stats, "span", hot)
    return got.select("doc_id", "first", "start", "end", (F.col("low") < F.col("high")).alias("elsewhere"), (F.struct("doc_id", "first") == F.col("lead")).alias("is_first"))


def shared_sentences(docs: DataFrame, min_chars: int = SPAN, least: int = 2, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(doc_id, n_chars, shared_chars, removable_chars) for every document with an id.

    shared_chars: characters covered by runs that another document holds too; removable_chars: those
    covered by a repeated run that is not the first of its kind, which a deduplication takes out.
    Overlapping runs count once, by merging intervals inside the document. Null and empty texts have 0.
    """
    runs = repeated_runs(docs, min_chars, least, hot_rows)
    out = _lengths(docs).join(_covered(runs.where("elsewhere"), "shared_chars"), "doc_id", "left")
    out = out.join(_covered(runs.where("not is_first"), "removable_chars"), "doc_id", "left")
    return out.select("doc_id", "n_chars", F.coalesce("shared_chars", F.lit(0)).alias("shared_chars"), F.coalesce("removable_chars", F.lit(0)).alias("removable_chars"))


def stretch_shares(docs: DataFrame, span: int = SPAN, gram: int = GRAM, least: int = 2, paired: int = PAIRED_GROUP, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(doc_id, n_chars, shared_chars, removable_chars) for every document with an id.

    shared_chars: characters inside a stretch of ``span`` or more that another document holds too,
    exactly; removable_chars as in ``shared_sentences``, since only whole sentences are taken out.
    """
    found = shared_stretches(docs, span, gram, paired, hot_rows).groupBy("doc_id").agg(F.sum(F.col("end") - F.col("start")).alias("shared_chars"))
    out = _lengths(docs).join(found, "doc_id", "left")
    out = out.join(_covered(repeated_runs(docs, span, least, hot_rows).where("not is_first"), "removable_chars"), "doc_id", "left")
    return out.select("doc_id", "n_chars", F.coalesce("shared_chars", F.lit(0)).alias("shared_chars"), F.coalesce("removable_chars", F.lit(0)).alias("removable_chars"))


def _covered(runs: DataFrame, name: str) -> DataFrame:
    """(doc_id, name): characters that the runs of a document cover."""
    seen = W.partitionBy("doc_id").orderBy("start", "end").rowsBetween(W.unboundedPreceding, -1)
    fresh = F.greatest(F.col("end") - F.greatest(F.col("start"), F.coalesce(F.max("end").over(seen), F.lit(0))), F.lit(0))
    return runs.select("doc_id", fresh.alias("x")).groupBy("doc_id").agg(F.sum("x").alias(name))


def _lengths(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max(F.coalesce(F.length("text"), F.lit(0))).cast("bigint").alias("n_chars"))


def without_repeats(docs: DataFrame, min_chars: int = SPAN, least: int = 2, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(doc_id, text): every document without the sentences that a non-first repeated run covers.

    Whole sentences go, with the blanks after them. Documents without such a run, and null texts,
    come through unchanged. Runs of a document are gathered, at most as many as its sentences.
    """
    cut = repeated_runs(docs, min_chars, least, hot_rows).where("not is_first")
    per = cut.groupBy("doc_id").agg(F.collect_set(F.struct("start", "end")).alias("runs"))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            out: list = []
            for t, runs in zip(b.column("text").to_pylist(), b.column("runs").to_pylist()):
                if runs and t:
                    spans = sorted((r["start"], r["end"]) for r in runs)
                    keep, at = [], 0
                    gone = [False] * len(b0 := sentence_bounds(t))
                    j = 0
                    for i, (s, e) in enumerate(b0):
                        while at < len(spans) and spans[at][0] <= s:
                            j = max(j, spans[at][1])
                            at += 1
                        gone[i] = s < j
                    keep = [t[s:e] for (s, e), g in zip(b0, gone) if not g]
                    t = "".join(keep)
                out.append(t)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.string())], names=["doc_id", "text"])

    base = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return base.join(per, "doc_id", "left").select("doc_id", "text", "runs").mapInArrow(run, "doc_id bigint, text string")
