"""Mixing sources to target weights: subset-sum budget fitting over exact token lengths."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frond.functions.keys import source_key, unit_hash
from frond.operators.skew import bucketed_rank
from frond.storage import Scratch

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Tokens left to the dynamic programme, or the longest document that fits if that is more; the rest is filled before.
DP_WINDOW = 1 << 14

#: Fixed value: the cut of text into pieces that the byte-level vocabularies were made with.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_ENCODER: dict = {}


def _encoder(path: str):
    """The tokenizer of this worker process, read once."""
    if path not in _ENCODER:
        import base64

        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODER[path] = tiktoken.Encoding("frond", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
    return _ENCODER[path]


def token_lengths(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, source, n_tokens): exact numbers of tokens of the whole texts; null and empty have 0."""

    def run(batches):
        import pyarrow as pa

        enc = _encoder(tokenizer)
        for b in batches:
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64())], names=["doc_id", "source", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("bigint"), source_key(F.col("source")).alias("source"), "text")
    return rows.mapInArrow(run, "doc_id bigint, source string, n_tokens bigint")


def length_counts(lengths: DataFrame) -> DataFrame:
    """(source, n_tokens, docs): documents of each exact length, combined before the shuffle."""
    return lengths.groupBy("source", "n_tokens").agg(F.count(F.lit(1)).alias("docs"))


def targets_of(targets: DataFrame) -> DataFrame:
    """mix_targets with canonical source; a null share is 0 and a null cap 1."""
    return targets.where(F.col("source").isNotNull()).select(
        source_key(F.col("source")).alias("source"), F.coalesce("target_share", F.lit(0.0)).alias("target_share"), F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(0)).alias("max_repeats"),
    )


def capacities(counts: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, max_repeats, tokens, total, wanted, reachable) of each target.

    ``wanted`` is the share of the tokens of all documents, those without a source included;
    ``reachable`` says whether the source can give it within its repeats.
    """
    per = counts.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("docs")).alias("tokens"))
    total = per.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("total"))
    got = targets_of(targets).join(per, "source", "left").crossJoin(F.broadcast(total))  # one row
    got = got.withColumn("tokens", F.coalesce("tokens", F.lit(0)))
    wanted = F.col("target_share") * F.col("total")
    return got.withColumn("wanted", wanted).withColumn("reachable", ~(F.col("max_repeats") * F.col("tokens") < wanted))


def bounded_knapsack(lengths: list[int], counts: list[int], budget: int) -> list[int]:
    """How many of each length to take so that their sum is the largest one within ``budget``.

    Dynamic programme over sums: for each length in turn, the fewest of it that reach each sum not
    reached before. Cost is (number of lengths) x budget, of memory too, so callers bound the budget.
    """
    import numpy as np

    budget = int(budget)
    take = [0] * len(lengths)
    if budget <= 0:
        return take
    reached = np.full(budget + 1, -1, np.int32)  # index of the length that first reached a sum
    used = np.zeros(budget + 1, np.int64)  # how many of that length were used for it
    reached[0] = len(lengths)
    for i, (w, c) in enumerate(zip(lengths, counts)):
        if w <= 0 or c <= 0 or w > budget:
            continue
        if reached[budget] >= 0:
            break
        old = reached >= 0
        # step s is at most c copies of w above a sum reached without this length
        for s in range(1, min(c, budget // w) + 1):
            base = old[: budget + 1 - s * w]
            fresh = base & (reached[s * w :] < 0)
            if not fresh.any():
                continue
            at = np.flatnonzero(fresh) + s * w
            reached[at], used[at] = i, s
    best = int(np.flatnonzero(reached >= 0)[-1])
    while best > 0:
        i = int(reached[best])
        take[i] += int(used[best])
        best -= int(used[best]) * lengths[i]
    return take


def fit_source(hist: list[tuple[int, int]], wanted: float, max_repeats: int, seed: int, window: int = DP_WINDOW) -> tuple[int, list[int]]:
    """Full passes over all documents, and how many of each length to use once more.

    ``hist`` is (length, documents). After the full passes the remaining budget is below one pass.
    It is filled in proportion over all lengths down to ``window`` tokens, rounded down, which keeps
    the length profile of the source, and the rest exactly, by the dynamic programme over what is left.
    ``window`` grows to the longest document that fits, so what is left stays below twice the window.
    """
    total = sum(w * c for w, c in hist)
    if total == 0 or max_repeats <= 0 or wanted <= 0:
        return 0, [0] * len(hist)
    passes = min(max_repeats, int(wanted // total))
    if passes >= max_repeats:
        return max_repeats, [0] * len(hist)
    rest = int(wanted) - passes * total
    window = max(window, max((w for w, _ in hist if w <= rest), default=0))
    share = max(0, rest - window) / total
    take = [int(c * share) if w > 0 else 0 for w, c in hist]
    rest -= sum(w * t for (w, _), t in zip(hist, take))
    # singles that proportional rounding left out, in seeded order, until the window is reached
    import random

    order = [i for i, (w, _) in enumerate(hist) if w > 0]
    random.Random(seed).shuffle(order)
    for i in order:
        w, c = hist[i]
        more = min(c - take[i], max(0, rest - window) // w)
        if more > 0:
            take[i] += more
            rest -= more * w
    spare = [hist[i][1] - take[i] for i in order]
    fits = sum(hist[i][0] * n for i, n in zip(order, spare) if hist[i][0] <= rest)
    more = bounded_knapsack([hist[i][0] for i in order], spare, min(rest, fits))
    for i, m in zip(order, more):
        take[i] += m
    return passes, take


QUOTA = "source string, n_tokens bigint, passes int, once_more bigint"


def quotas(counts: DataFrame, targets: DataFrame, total_tokens: int | None, seed: int, window: int = DP_WINDOW) -> DataFrame:
    """(source, n_tokens, passes, once_more): how often each exact length of a source is used.

    One task fits one source from its length counts, which are as many as there are lengths.
    """
    cap = capacities(counts, targets)
    size = F.col("wanted") if total_tokens is None else F.col("target_share") * F.lit(float(total_tokens))
    rows = counts.join(cap.select("source", "max_repeats", size.alias("wanted")), "source")

    def run(pdf):
        import zlib

        pdf = pdf.sort_values("n_tokens")
        name = pdf["source"].iloc[0]
        hist = list(zip(pdf["n_tokens"].tolist(), pdf["docs"].tolist()))
        passes, take = fit_source(hist, float(pdf["wanted"].iloc[0]), int(pdf["max_repeats"].iloc[0]), seed + zlib.crc32(name.encode()), window)
        return pdf.assign(passes=passes, once_more=take)[["source", "n_tokens", "passes", "once_more"]]

    return rows.groupBy("source").applyInPandas(run, QUOTA)


def short_sources(docs: DataFrame, targets: DataFrame, tokenizer: str = TOKENIZER, seed: int = 7) -> DataFrame:
    """(source): targets that the budget fitting leaves open with every document used as often as allowed.

    A source without documents is short if it wants anything. What is left open is then checked
    exactly: the repeated tokens of the source are fewer than wanted.
    """
    counts = Scratch(docs.sparkSession).write(length_counts(token_lengths(docs, tokenizer)), "counts")
    fit = quotas(counts, targets, None, seed).groupBy("source").agg(F.max("passes").alias("passes"))
    got = capacities(counts, targets).join(fit, "source", "left")
    spent = F.coalesce(F.col("passes") >= F.col("max_repeats"), F.lit(True)) | (F.col("tokens") == 0)
    return got.where(spent & ~F.col("reachable")).select("source")


def _mixed(docs: DataFrame, targets: DataFrame, total_tokens: int | None, seed: int, tokenizer: str, window: int) -> tuple[DataFrame, DataFrame]:
    scratch = Scratch(docs.sparkSession)
    lengths = scratch.write(token_lengths(docs, tokenizer), "lengths")
    counts = scratch.write(length_counts(lengths), "counts")
    q = scratch.write(quotas(counts, targets, total_tokens, seed, window), "quotas")
    ranked = bucketed_rank(lengths.where(F.col("source").isNotNull()), ["source", "n_tokens"], unit_hash(seed, F.col("doc_id")), F.col("doc_id"), "_rank", buckets=64)
    uses = (F.col("passes") + F.when(F.col("_rank") <= F.col("once_more"), 1).otherwise(0)).cast("int")
    return ranked.join(q, ["source", "n_tokens"]).select("doc_id", "source", "n_tokens", uses.alias("uses")).where("uses > 0"), counts


def mixed(docs: DataFrame, targets: DataFrame, total_tokens: int | None = None, seed: int = 7, tokenizer: str = TOKENIZER, window: int = DP_WINDOW) -> DataFrame:
    """(doc_id, source, n_tokens, uses): documents of the mix and how often each is used, at least 1.

    ``total_tokens`` is the size of the mix, by default the tokens of all documents. Documents of a
    length are chosen by a seeded hash. Sources without a target, and null ones, give nothing.
    """
    return _mixed(docs, targets, total_tokens, seed, tokenizer, window)[0]


def mix_report(docs: DataFrame, targets: DataFrame, total_tokens: int | None = None, seed: int = 7, tokenizer: str = TOKENIZER) -> DataFrame:
    """(source, target_share, max_repeats, docs, uses, tokens, share, wanted, reachable) of the mix.

    share is the part of the mix's tokens that the source has; reachable says whether the source can
    give the ``wanted`` tokens within its repeats.
    """
    mix, counts = _mixed(docs, targets, total_tokens, seed, tokenizer, DP_WINDOW)
    per = mix.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum("uses").alias("uses"), F.sum(F.col("uses") * F.col("n_tokens")).alias("used"))
    total = per.agg(F.sum("used").alias("all"))
    got = capacities(counts, targets).join(per, "source", "left").crossJoin(F.broadcast(total))  # one row
    wanted = F.col("wanted") if total_tokens is None else F.col("target_share") * F.lit(float(total_tokens))
    zero = lambda c, n: F.coalesce(c, F.lit(0)).alias(n)
    share = F.coalesce(F.try_divide(F.col("used"), F.col("all")), F.lit(0.0))
    return got.select("source", "target_share", "max_repeats", zero("docs", "docs"), zero("uses", "uses"), zero("used", "tokens"), share.alias("share"), wanted.alias("wanted"), (~(F.col("max_repeats") * F.col("tokens") < wanted)).alias("reachable"))
