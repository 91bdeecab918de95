"""Selections that depend on what was chosen before, group by group in Arrow batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from frond.storage import Scratch

#: Largest group that one task selects from at once; larger ones are selected from in steps.
MAX_GROUP = 2_000_000
#: Best rows of a larger group that a step takes into one task.
BLOCK = 10_000


def _sizes(df: DataFrame, group: str, max_group: int) -> tuple[DataFrame, DataFrame | None]:
    """The rows of groups that fit a task, and those of larger groups, if there are any."""
    n = df.groupBy(F.col(group).alias("_g")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > max_group).select("_g")
    if n.isEmpty():
        return df, None
    # fewer groups than rows / max_group
    same = F.col(group).eqNullSafe(F.col("_g"))
    return df.join(F.broadcast(n), same, "left_anti"), df.join(F.broadcast(n), same, "left_semi")


def _codes(pdf, fp: str):
    """Fingerprints as unsigned numbers. Nulls were filled before, since pandas turns a column with nulls into floats."""
    import numpy as np

    return pdf[fp].astype("int64").to_numpy().view(np.uint64)


def _filled(df: DataFrame, fp: str) -> DataFrame:
    return df.withColumn("_known", F.col(fp).isNotNull()).withColumn(fp, F.coalesce(F.col(fp), F.lit(0)).cast("bigint"))


def _visit(pdf, fp: str, histogram: str | None, have: int, k: int, min_bits: int, least_corr: float) -> list[int]:
    """Places of the rows kept, in order; the first ``have`` rows are kept already."""
    import numpy as np

    codes, known = _codes(pdf, fp), pdf["_known"].to_numpy(bool)
    shapes = None
    if histogram:
        width = max([len(h) for h in pdf[histogram] if h is not None], default=1)
        shapes = np.zeros((len(pdf), width))
        for i, h in enumerate(pdf[histogram]):
            if h is not None and len(h) == width:
                x = np.asarray(h, float) - np.mean(h)
                shapes[i] = x / (np.sqrt((x * x).sum()) or 1.0)
    kept: list[int] = []
    seen = np.empty(k, np.uint64)
    m = 0
    for i in range(len(pdf)):
        if len(kept) >= k:
            break
        if i >= have:
            if known[i] and m and (np.bitwise_count(seen[:m] ^ codes[i]) < min_bits).any():
                continue
            if shapes is not None and kept and (shapes[kept] @ shapes[i] > least_corr).any():
                continue
        if known[i]:
            seen[m], m = codes[i], m + 1
        kept.append(i)
    return kept


def greedy_distinct(
    df: DataFrame, group: str, id_col: str, fp: str, quality: str, k: int, min_bits: int = 12, histogram: str | None = None, least_corr: float = 0.85, max_group: int = MAX_GROUP, block: int = BLOCK,
) -> DataFrame:
    """JN-11, TOP-11: (group, id, place, filled): best first, leaving out what resembles one kept.

    Rows are visited by falling quality, then id. Two resemble each other if their fingerprints
    differ in fewer than ``min_bits`` bits or, where a column of histograms is given, these
    correlate by more than ``least_corr``. If fewer than k differ enough, the best of those left out
    fill up (filled). A group of at most k rows is kept whole. A null fingerprint or histogram
    resembles none. The choice is sequential by definition, so a group is one task; of groups beyond
    ``max_group`` rows the best ``block`` that are still open are visited in each step, with the same
    result.
    """
    rows = _filled(df.select(group, id_col, fp, quality, *([histogram] if histogram else [])), fp)
    keep, kind = rows.columns, dict(rows.dtypes)
    schema = f"`{group}` {kind[group]}, `{id_col}` {kind[id_col]}, place int, filled boolean"
    small, large = _sizes(rows, group, max(max_group, k))

    def run(pdf):
        pdf = pdf.sort_values([quality, id_col], ascending=[False, True], na_position="last", kind="stable")
        n = len(pdf)
        if n <= k:
            return pdf.assign(place=range(1, n + 1), filled=False)[[group, id_col, "place", "filled"]]
        kept = _visit(pdf, fp, histogram, 0, k, min_bits, least_corr)
        chosen = set(kept)
        rest = [i for i in range(n) if i not in chosen][: k - len(kept)]
        out = pdf.iloc[kept + rest]
        return out.assign(place=range(1, len(out) + 1), filled=[False] * len(kept) + [True] * len(rest))[[group, id_col, "place", "filled"]]

    got = small.groupBy(group).applyInPandas(run, schema)
    if large is None:
        return got
    order = [F.col(quality).desc_nulls_last(), F.col(id_col)]
    scratch = Scratch(df.sparkSession)
    every = rest = scratch.write(large, "large")
    names = ", ".join(f"`{c}` {kind[c]}" for c in keep)
    kept = df.sparkSession.createDataFrame([], f"{names}, _place int")

    def step(pdf):
        pdf = pdf.sort_values(["_place", quality, id_col], ascending=[True, False, True], na_position="last", kind="stable")
        have = int(pdf["_place"].notna().sum())
        at = [i for i in _visit(pdf, fp, histogram, have, k, min_bits, least_corr) if i >= have]
        return pdf.iloc[at].assign(_place=range(have + 1, have + len(at) + 1))[[*keep, "_place"]]

    while True:
        place = F.row_number().over(W.partitionBy(group).orderBy(*order))
        top = scratch.write(rest.withColumn("_r", place).where(F.col("_r") <= block).drop("_r"), "top")
        if top.isEmpty():
            break
        both = kept.unionByName(top.withColumn("_place", F.lit(None).cast("int")))
        fresh = scratch.write(both.groupBy(group).applyInPandas(step, f"{names}, _place int"), "fresh")
        kept = scratch.write(kept.unionByName(fresh), "kept")
        # what follows the visited rows, in groups that are not full
        last = top.groupBy(F.col(group).alias("_g")).agg(F.max(F.struct(F.coalesce(-F.col(quality), F.lit(float("inf"))).alias("q"), F.col(id_col).alias("i"))).alias("_last"))
        full = kept.groupBy(F.col(group).alias("_g")).agg(F.count(F.lit(1)).alias("_k"), F.collect_list(F.when(F.col("_known"), F.col(fp))).alias("_fps"))
        state = last.join(full, last["_g"].eqNullSafe(full["_g"])).select(last["_g"], "_last", "_k", "_fps")  # k fingerprints a large group
        near = F.exists("_fps", lambda x: F.bit_count(x.bitwiseXOR(F.col(fp))) < min_bits)
        after = F.struct(F.coalesce(-F.col(quality), F.lit(float("inf"))).alias("q"), F.col(id_col).alias("i")) > F.col("_last")
        open_ = rest.join(F.broadcast(state), F.col(group).eqNullSafe(F.col("_g"))).where((F.col("_k") < k) & after & ~(F.col("_known") & near))
        rest = scratch.write(open_.select(*keep), "rest")
    count = kept.groupBy(F.col(group).alias("_g")).agg(F.count(F.lit(1)).alias("_k"))
    spare = every.join(kept.select(id_col), id_col, "left_anti").withColumn("_r", F.row_number().over(W.partitionBy(group).orderBy(*order))).where(F.col("_r") <= k)
    spare = spare.join(F.broadcast(count), F.col(group).eqNullSafe(F.col("_g"))).where(F.col("_k") + F.col("_r") <= k)
    out = kept.select(group, id_col, F.col("_place").alias("place"), F.lit(False).alias("filled"))
    return got.unionByName(out).unionByName(spare.select(group, id_col, (F.col("_k") + F.col("_r")).cast("int").alias("place"), F.lit(True).alias("filled")))


def farthest_point(df: DataFrame, group: str, id_col: str, fp: str, quality: str, k: int, max_group: int = MAX_GROUP) -> DataFrame:
    """TOP-09: (group, id, place): start with the best; then always the greatest min-distance + 16 x quality.

    Ties take the earlier row by falling quality, then id. Distances to the chosen are kept as an
    array, so a group of n rows costs n x k bit counts. In groups beyond ``max_group`` rows each of
    the k places is an aggregate over all rows, with the same result.
    """
    kind = dict(df.dtypes)
    small, large = _sizes(_filled(df.select(group, id_col, fp, quality), fp).drop("_known"), group, max(max_group, k))

    def run(pdf):
        import numpy as np

        pdf = pdf.sort_values([quality, id_col], ascending=[False, True], na_position="last", kind="stable")
        n, q = len(pdf), pdf[quality].fillna(0.0).to_numpy(float)
        if n <= k:
            return pdf.assign(place=range(1, n + 1))[[group, id_col, "place"]]
        codes = _codes(pdf, fp)
        order, free = [0], np.ones(n, bool)
        free[0] = False
        near = np.bitwise_count(codes ^ codes[0]).astype(float)
        while len(order) < k:
            j = int(np.where(free, near + 16.0 * q, -np.inf).argmax())
            order.append(j)
            free[j] = False
            np.minimum(near, np.bitwise_count(codes ^ codes[j]), out=near)
        return pdf.iloc[order].assign(place=range(1, k + 1))[[group, id_col, "place"]]

    got = small.groupBy(group).applyInPandas(run, f"`{group}` {kind[group]}, `{id_col}` {kind[id_col]}, place int")
    if large is None:
        return got
    scratch = Scratch(df.sparkSession)
    low = F.coalesce(-F.col(quality).cast("double"), F.lit(float("inf")))
    rest = scratch.write(large.select(group, id_col, F.col(fp).alias("_c"), low.alias("_q"), F.coalesce(F.col(quality).cast("double"), F.lit(0.0)).alias("_w"), F.lit(None).cast("double").alias("_near")), "open")
    out = None
    for place in range(1, k + 1):
        score = F.coalesce(F.col("_near") + 16.0 * F.col("_w"), F.lit(0.0))
        pick = rest.groupBy(F.col(group).alias("_g")).agg(F.min(F.struct((-score).alias("s"), F.col("_q").alias("q"), F.col(id_col).alias("i"), F.col("_c").alias("c"))).alias("p"))
        pick = scratch.write(pick.select("_g", F.col("p.i").alias("_i"), F.col("p.c").alias("_p")), "pick")
        one = pick.select(F.col("_g").alias(group), F.col("_i").alias(id_col), F.lit(place).alias("place"))
        out = one if out is None else out.unionByName(one)
        left = rest.join(F.broadcast(pick), F.col(group).eqNullSafe(F.col("_g"))).where(F.col(id_col) != F.col("_i"))  # one row a large group
        gap = F.bit_count(F.col("_c").bitwiseXOR(F.col("_p"))).cast("double")
        rest = left.select(group, id_col, "_c", "_q", "_w", F.least(F.coalesce("_near", gap), gap).alias("_near"))
        if place % 8 == 0:
            rest = scratch.write(rest, "open")
    return got.unionByName(out) if out is not None else got


def kmeans_by_group(df: DataFrame, group: str, id_col: str, features: list[str], quality: str, k: int, seed: int = 42) -> DataFrame:
    """TOP-10, TOP-11: (group, id, cluster): k rows of each group, by k-means inside it.

    A group of at most k rows is kept whole. In others features are scaled by the group's own range,
    each of k clusters gives the row nearest its median quality, and what empty clusters leave open
    is filled with the unused rows of best quality, then smallest id (cluster null for rows not
    chosen by a cluster). Each larger group is a distributed fit of its own; only the groups and
    their sizes reach the driver. A null group is a group.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import MinMaxScaler, VectorAssembler

    from frond.operators.splits import backfill
    from frond.operators.stats import nearest_to_median
    from frond.storage import Scratch

    k = max(0, k)
    scratch = Scratch(df.sparkSession)
    clean = [F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(f"_f{i}") for i, c in enumerate(features)]
    rows = scratch.write(df.select(group, id_col, F.col(quality).cast("double").alias("_q"), *clean), "rows")
    sizes = rows.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    none = F.lit(None).cast("int").alias("cluster")
    out = rows.limit(0).select(group, id_col, none)
    best = [F.nanvl(F.col("_q"), F.lit(None)).desc_nulls_last(), F.col(id_col)]
    for g, n in sizes.collect() if k else []:
        part = rows.where(F.col(group).eqNullSafe(F.lit(g)))
        if n <= k:
            out = out.unionByName(part.select(group, id_col, none))
            continue
        wide = VectorAssembler(inputCols=[f"_f{i}" for i in range(len(features))], outputCol="_v").transform(part)
        scaled = MinMaxScaler(inputCol="_v", outputCol="_s").fit(wide).transform(wide)
        if k > 1:  # one cluster is the whole group
            model = KMeans(featuresCol="_s", predictionCol="cluster", k=k, seed=seed).fit(scaled)
            chosen = nearest_to_median(model.transform(scaled).select(id_col, "_q", "cluster"), "cluster", id_col, "_q").select(id_col, "cluster")
        else:
            chosen = nearest_to_median(part.select(id_col, "_q", F.lit(0).alias("cluster")), "cluster", id_col, "_q").select(id_col, "cluster")
        chosen = scratch.write(chosen, "chosen")
        full = scratch.write(backfill(chosen, part.withColumn("cluster", none), id_col, k, best), "group")
        out = out.unionByName(full.select(F.lit(g).cast(rows.schema[group].dataType).alias(group), id_col, "cluster"))
    return out
