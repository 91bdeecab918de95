"""A sample that matches target category proportions: calibration, then pivotal sampling."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frond.functions.keys import name_key, unit_hash
from frond.storage import Scratch

#: Upper bound on the number of target rows that the driver holds.
MAX_TARGETS = 100_000


def target_rows(targets: DataFrame, field: str) -> DataFrame:
    """(target_id, key, share, min_rows, sample_size) of one field's targets that have a key."""
    return targets.where(F.lower(F.trim("field_name")) == field).select(
        "target_id", name_key(F.col("key_value")).alias("key"), F.coalesce("target_share", F.lit(0.0)).alias("share"),
        F.coalesce("min_rows", F.lit(0)).alias("min_rows"), F.coalesce("sample_size", F.lit(0)).cast("bigint").alias("sample_size"),
    )


def disease_units(pairs: DataFrame) -> DataFrame:
    """(unit_id, key): distinct pair_ids that are not corrupted, by key of disease_name.

    Deliveries of one pair_id combine before the shuffle; a unit counts if any delivery is sound.
    """
    k = name_key(F.col("disease_name"))
    ok = pairs.where(F.col("pair_id").isNotNull() & k.isNotNull() & ~F.coalesce("is_corrupted", F.lit(False)))
    return ok.select(F.col("pair_id").alias("unit_id"), k.alias("key")).distinct()


def category_units(items: DataFrame) -> DataFrame:
    """(unit_id, key): distinct rec_ids with a category and a confidence from 0 to 100."""
    k = name_key(F.col("category"))
    c = F.col("confidence")
    ok = items.where(F.col("rec_id").isNotNull() & k.isNotNull() & c.between(0, 100) & ~F.isnan(c))
    return ok.select(F.col("rec_id").alias("unit_id"), k.alias("key")).distinct()


def moments(units: DataFrame, wanted: DataFrame) -> DataFrame:
    """Targets with their supply: units of the target's key, counted by a combining aggregate."""
    supply = units.groupBy("key").agg(F.count(F.lit(1)).alias("supply"))
    return wanted.join(supply, "key", "left").withColumn("supply", F.coalesce("supply", F.lit(0).cast("bigint")))


def newton_total(cells: DataFrame, size: float, steps: int = 100, tol: float = 1e-10) -> float:
    """The multiplier nu of the sample size in the tilting dual, by Newton steps; -inf or inf if none is finite.

    ``cells`` has a row for each category with wish, low and high: its rows at nu = 0, its floor and
    its supply. Tilting by exp(nu) gives it min(high, max(low, wish * exp(nu))) rows, what is at a
    bound being fixed there. The dual's gradient is the sum of these moments less ``size``, its
    Hessian the sum over the categories that are not fixed. Both depend on nu and are aggregated
    anew in every step; a step that leaves the interval known to hold the root is replaced by its
    middle. If the floors exceed the size, or the supplies cannot reach it, the bound is the answer.
    """
    w, lo, hi = F.col("wish"), F.col("low"), F.col("high")
    some = cells.where("wish > 0")
    ends = some.agg(F.sum(lo), F.sum(hi), F.min(F.ln(F.greatest(lo, F.lit(0.5)) / w)), F.max(F.ln(hi / w))).first()
    fixed = cells.where("not wish > 0").agg(F.coalesce(F.sum(lo), F.lit(0.0))).first()[0]
    size = size - fixed
    if ends[0] is None or ends[0] >= size:
        return -math.inf
    if ends[1] <= size:
        return math.inf
    a, b = min(0.0, ends[2]) - 1.0, max(0.0, ends[3]) + 1.0
    while True:  # the lower end has to lie below the root
        if some.agg(F.sum(F.least(hi, F.greatest(lo, w * math.exp(a))))).first()[0] < size:
            break
        a = 2 * a - 1.0
    nu = 0.0
    for _ in range(steps):
        x = w * math.exp(nu)
        got, slope = some.agg(F.sum(F.least(hi, F.greatest(lo, x))), F.sum(F.when((x > lo) & (x < hi), x).otherwise(0.0))).first()
        if abs(got - size) <= tol * size:
            break
        a, b = (nu, b) if got < size else (a, nu)
        step = nu + (size - got) / slope if slope > 0 else math.nan
        nu = step if a < step < b else (a + b) / 2
    return nu


def round_to_total(parts: list[float], caps: list[int], total: int) -> list[int]:
    """Whole numbers near ``parts``, at most ``caps``, adding to ``total`` where caps permit."""
    out = [min(c, int(math.floor(p + 1e-9))) for p, c in zip(parts, caps)]
    short = total - sum(out)
    for i in sorted(range(len(parts)), key=lambda i: (-(parts[i] - out[i]), i)):
        if short <= 0:
            break
        if out[i] < caps[i] and parts[i] > out[i] + 1e-9:
            out[i], short = out[i] + 1, short - 1
    return out


def plan(rows: list, nu: float) -> list[dict]:
    """Quotas of one field's targets at the multiplier ``nu`` of the size.

    A wish is share * size. Wishes are scaled by exp(nu) so that quotas add to the size, each
    between its floor (min_rows, or the supply if smaller) and its supply. What a scarce category
    lacks thus goes to the others in proportion, which leaves their shares among each other as
    wanted. Floors that exceed the size by themselves are kept. Targets that are fixed at their
    supply before any scaling, short of the wish or of min_rows, are not met; the gap is what the
    quota lacks of the greater of both. With one category for each unit its own multiplier lam is
    ln(quota / supply), and exp(lam) the chance of its units.
    """
    out, want = [], []
    for r in rows:
        wish, low = r["share"] * r["sample_size"], min(r["min_rows"], r["supply"])
        at = math.exp(nu) * wish if wish > 0 and nu < 700 else math.inf if wish > 0 else 0.0
        want.append(float(min(r["supply"], max(low, at))))
    quota = round_to_total(want, [r["supply"] for r in rows], round(sum(want)))
    for r, q in zip(rows, quota):
        wish = r["share"] * r["sample_size"]
        q = max(q, min(r["min_rows"], r["supply"]))
        lam = math.log(q / r["supply"]) if q > 0 else None
        short = min(r["supply"], max(wish, r["min_rows"])) < max(wish, r["min_rows"])
        out.append(r.asDict() | {"quota": q, "lam": lam, "probability": 0.0 if lam is None else min(1.0, q / r["supply"]), "met": not short, "gap": max(0.0, float(max(wish, r["min_rows"])) - q)})
    return out


PLAN = "target_id bigint, key string, share double, min_rows int, sample_size bigint, supply bigint, quota bigint, lam double, probability double, met boolean, gap double"


def calibrate(units: DataFrame, wanted: DataFrame) -> DataFrame:
    """One row for each target: supply, quota, tilt, inclusion probability, met or not, and the gap.

    Only the targets with their supplies reach the driver, and they are a parameter of the sample;
    more than MAX_TARGETS of them are refused. The multiplier of the size is found by Newton steps on
    moments that are aggregated in every step. Of targets naming one key, the one of the smallest
    target_id is sampled and the others get quota 0, as they draw on the same supply.
    """
    cells = Scratch(units.sparkSession).write(moments(units, wanted), "moments")
    got = cells.orderBy("target_id").limit(MAX_TARGETS + 1).collect()
    if len(got) > MAX_TARGETS:
        raise ValueError(f"more than {MAX_TARGETS} targets")
    seen: set = set()
    first, again = [], []
    for r in got:
        (again if r["key"] is None or r["key"] in seen else first).append(r)
        seen.add(r["key"])
    sampled = cells.where(F.col("key").isNotNull()).groupBy("key").agg(F.min_by(F.struct("share", "min_rows", "sample_size", "supply"), "target_id").alias("t")).select("t.*")
    bounds = sampled.select((F.col("share") * F.col("sample_size")).alias("wish"), F.least("min_rows", "supply").cast("double").alias("low"), F.col("supply").cast("double").alias("high"))
    size = max([0, *(r["sample_size"] for r in first)])
    nu = newton_total(bounds, float(size)) if first else 0.0
    none = {"quota": 0, "lam": None, "probability": 0.0}
    rows = plan(first, nu) + [p | none | {"gap": max(0.0, p["share"] * p["sample_size"], float(p["min_rows"]))} for r in again for p in plan([r], 0.0)]
    names = [c.split()[0] for c in PLAN.split(", ")]
    return units.sparkSession.createDataFrame([tuple(r[n] for n in names) for r in rows], PLAN)


def _pivotal(last: bool):
    """Sequential pivotal sampling of each bucket's and key's units, in the order of rows.

    Two units duel: with probabilities p and q, one gives its probability to the other until it is 0
    or 1. At most one undecided unit of a bucket and key is left, with its current probability.
    Rows come bucket by bucket; in the last pass the bucket is the key's only one.
    """

    def run(batches):
        import pyarrow as pa

        state: dict = {}
        now = None

        def batch_of(rows):
            i, k, p, b = zip(*rows)
            return pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(k, pa.string()), pa.array(p, pa.float64()), pa.array(b, pa.int32())], names=["unit_id", "key", "p", "bucket"])

        def settled(b):
            rest = [(i, k, (1.0 if p > 0.5 else 0.0) if last else p, b) for k, (i, p) in state.items()]
            state.clear()
            return rest

        for batch in batches:
            out: list = []
            for i, k, q, b, u in zip(*[batch.column(n).to_pylist() for n in ("unit_id", "key", "p", "bucket", "draw")]):
                if b != now:
                    out += settled(now)
                    now = b
                if q >= 1.0 - 1e-9:
                    out.append((i, k, 1.0, b))
                    continue
                held = state.get(k)
                if held is None:
                    state[k] = (i, q)
                    continue
                j, p = held
                t = p + q
                if t < 1.0 - 1e-9:
                    state[k] = (j, t) if u * t < p else (i, t)
                    continue
                # the winner is taken, the other goes on with the rest
                keep_j = u * (2.0 - t) < 1.0 - q if t < 2.0 else True
                out.append((j if keep_j else i, k, 1.0, b))
                if t - 1.0 > 1e-9:
                    state[k] = (i if keep_j else j, t - 1.0)
                else:
                    state.pop(k)
            if out:
                yield batch_of(out)
        if rest := settled(now):
            yield batch_of(rest)

    return run


def pivotal_sample(units: DataFrame, chances: DataFrame, seed: int = 7, buckets: int = 4096) -> DataFrame:
    """(unit_id, key): a sample with the inclusion probabilities of ``chances`` (key, probability).

    A unit's hash puts it into one of ``buckets``; each decides its units in one pass by unit_id,
    whatever their keys, so a key of a third of all rows is spread over all tasks. What stays
    undecided, at most one unit for each key and bucket, meets again in a task of its key. A key's
    probabilities add to a whole number, its quota, which is then hit exactly. Buckets, orders and
    draws follow from the ids and the seed alone: however the input is partitioned, the sample is
    the same. An id listed twice under one key is one unit.
    """
    scratch = Scratch(units.sparkSession)
    p = chances.where(F.col("probability") > 0).groupBy("key").agg(F.max("probability").alias("p"))
    rows = units.where("unit_id is not null").select("unit_id", "key").distinct().join(F.broadcast(p), "key")
    bucket = F.floor(unit_hash(seed, F.col("unit_id")) * buckets).cast("int")
    rows = rows.select("unit_id", "key", "p", bucket.alias("bucket"), unit_hash(seed + 1, F.col("unit_id")).alias("draw"))
    schema = "unit_id bigint, key string, p double, bucket int"
    first = scratch.write(rows.repartition("bucket").sortWithinPartitions("bucket", "unit_id", "key").mapInArrow(_pivotal(False), schema), "duels")
    undecided = first.where("p < 1").repartition("key").sortWithinPartitions("key", "bucket", "unit_id")
    undecided = undecided.select("unit_id", "key", "p", F.lit(0).alias("bucket"), unit_hash(seed + 2, F.col("unit_id")).alias("draw"))
    final = undecided.mapInArrow(_pivotal(True), schema)
    return first.where("p >= 1").select("unit_id", "key").unionByName(final.where("p >= 1").select("unit_id", "key"))


def units_of(field: str, pairs: DataFrame | None, items: DataFrame | None) -> DataFrame:
    return disease_units(pairs) if field == "disease_name" else category_units(items)


def unmet_targets(spark: SparkSession, pairs: DataFrame, items: DataFrame, targets: DataFrame) -> DataFrame:
    """(target_id) of the targets that the calibration reports as not met, for both fields."""
    plans = [calibrate(units_of(f, pairs, items), target_rows(targets, f)) for f in ("disease_name", "category")]
    return plans[0].unionByName(plans[1]).where(~F.col("met")).select("target_id")
