"""A varied subset: multi-attribute grid round-robin, in SQL only.

Cells are the combinations of binned features. Rows are ranked inside their cell by a seeded hash,
ordered by rank and then cell, and the first k are kept; so every cell gives its first row before
any gives its second, and large groups of similar records weigh no more than small ones.

No cell is ranked in one task: its hash range is cut into BUCKETS ranges, counted by a combining
aggregate, and a row's rank is the rows in earlier ranges plus its place in its own. Ranges that
begin beyond the level the k-th row can reach are dropped before they are sorted. Rounds before the
last are taken whole and the last by prefix counts over cells, so the k rows never meet in one task.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from frond.storage import Scratch

#: Ranges of the hash that each cell is cut into. A cell of n rows means tasks of n / BUCKETS.
BUCKETS = 256

#: One row for each audit_id that can be binned: repeated audits count once, the latest one.
USABLE = """
select audit_id, greatest(r.width, r.height) as long_side, least(r.width, r.height) as short_side,
       cast(floor(r.mask_coverage_pct / 5) as int) as coverage_band
from (
  select audit_id, max_by(struct(width, height, mask_coverage_pct, is_corrupted),
                          struct(audited_at, width, height, mask_coverage_pct)) as r
  from {audits} where audit_id is not null group by audit_id
)
where not coalesce(r.is_corrupted, false) and r.width > 0 and r.height > 0
  and r.mask_coverage_pct between 0 and 100 and not isnan(r.mask_coverage_pct)
"""

CELLS = """
select long_side, short_side, coverage_band, count(*) as n from ({usable}) group by 1, 2, 3
"""

#: The smallest level at which cells cut down to it hold k rows (or all rows).
#: With cells ordered by size, those of fewer rows than the level count whole. The windows run over
#: the different sizes of cells, of which n rows can have no more than the square root of 2 n.
LEVEL = """
select coalesce(min(level), (select max(n) from ({cells}))) as level from (
  select n, ceil(({k} - (upto - rows_n)) / double(above)) as level, lag(n, 1, 0) over (partition by 1 order by n) as lower_n
  from (
    select n, rows_n, sum(rows_n) over (partition by 1 order by n) as upto,
           sum(cells_n) over (partition by 1 order by n rows between current row and unbounded following) as above
    from (select n, n * count(*) as rows_n, count(*) as cells_n from ({cells}) group by n)
  )
)
where level <= n and level > lower_n
"""

#: Rows with their rank in the cell. ``binned`` has audit_id and the columns of a cell, ``cell``;
#: ranges that begin at or after ``level`` ranks, or end before ``least``, are dropped unsorted.
RANKED = """
cut as (
  select *, cast(floor(u * {buckets}) as int) as bucket
  from (select *, cast(conv(substring(sha2(concat('{seed}:', audit_id), 256), 1, 13), 16, 10) as double) / 4503599627370496D as u from ({binned}))
),
sizes as (select {cell}, bucket, count(*) as n from cut group by {cell}, bucket),
offsets as (
  select {cell}, bucket, n,
         coalesce(sum(n) over (partition by {cell} order by bucket rows between unbounded preceding and 1 preceding), 0) as before
  from sizes
),
ranked as (
  select c.*, cast(o.before + row_number() over (partition by {qualified}, c.bucket order by c.u, c.audit_id) as bigint) as cell_rank
  from cut c join offsets o using ({cell}, bucket)
  where o.before < {level} and o.before + o.n >= {least}
)
"""

#: Rounds before the last are whole. Of the cells that still have a row for the last round, the first
#: in order give theirs: their places are counted by coarse parts of the order, of which there are few
#: beside the cells, so no task orders all cells or all chosen rows.
PICK = """
with {ranked},
full as (select {cell}, sum(n) as n from sizes group by {cell}),
last as (select {cell}, {coarse} as part, {fine} as fine from full where n >= {level}),
parts as (select part, count(*) as n from last group by part),
starts as (select part, coalesce(sum(n) over (partition by 1 order by part rows between unbounded preceding and 1 preceding), 0) as before from parts),
room as (select {k} - sum(least(n, {level} - 1)) as open from full),
giving as (
  select {cell} from (
    select l.*, s.before + row_number() over (partition by l.part order by l.fine, {listed}) as place from last l join starts s using (part)
  ) cross join room where place <= open
)
select {out}, cell_rank from ranked where cell_rank < {level}
union all
select {out}, cell_rank from ranked join giving using ({cell}) where cell_rank = {level}
"""

#: The cells that give a row in the round that holds the 2 % mark: those of so many rows or more.
FOUND = """
with {ranked} select {cell} from ranked where cell_rank = {level}
"""

RAW = ("long_side", "short_side", "coverage_band")
BINS = ("long_bin", "short_bin", "coverage_band")

#: Sides in steps of an eighth of an octave; coarser grids halve the number of steps again and again.
FINE = """
select *, cast(floor(log2(long_side) * 8) as int) as long_fine, cast(floor(log2(short_side) * 8) as int) as short_fine from ({usable})
"""

#: Occupied cells of each grid; at the coarsest all sizes are in one bin.
GRIDS = """
select j, count(*) as n from (
  select distinct j, shiftright(long_fine, j) as l, shiftright(short_fine, j) as s, coverage_band
  from (select distinct long_fine, short_fine, coverage_band from ({fine})) lateral view explode(sequence(0, 8)) as j
) group by j
"""

BINNED = """
select audit_id, long_side, short_side, coverage_band, shiftright(long_fine, {j}) as long_bin, shiftright(short_fine, {j}) as short_bin from ({fine})
"""

def _view(df: DataFrame) -> str:
    """A temporary view under a name of its own, so calls do not disturb each other."""
    name = f"frond_audits_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(name)
    return name


def _usable(audits: DataFrame) -> str:
    """The usable records, written once, as several statements read them."""
    spark = audits.sparkSession
    return f"select * from {_view(Scratch(spark).write(spark.sql(USABLE.format(audits=_view(audits))), 'usable'))}"


def cell_counts(audits: DataFrame) -> DataFrame:
    """(long_side, short_side, coverage_band, n) over distinct usable audit_ids."""
    v = _view(audits)
    return audits.sparkSession.sql(CELLS.format(usable=USABLE.format(audits=v)))


def _ranked(binned: str, cell: tuple, seed: int, buckets: int, level: int, least: int = 0) -> str:
    return RANKED.format(binned=binned, cell=", ".join(cell), qualified=", ".join(f"c.{c}" for c in cell), seed=int(seed), buckets=int(buckets), level=int(level), least=int(least))


def _picked(spark: SparkSession, binned: str, cell: tuple, out: tuple, k: int, seed: int, buckets: int, coarse: str, fine: str) -> DataFrame:
    cells = f"select count(*) as n from ({binned}) group by {', '.join(cell)}"
    level = int(spark.sql(LEVEL.format(cells=cells, k=k)).first()[0] or 0) if k else 0
    return spark.sql(PICK.format(ranked=_ranked(binned, cell, seed, buckets, level), cell=", ".join(cell), listed=", ".join(f"l.{c}" for c in cell), out=", ".join(out), coarse=coarse, fine=fine, level=level, k=k))


def crowded_cells(audits: DataFrame, share: float = 0.02, seed: int = 7, buckets: int = BUCKETS) -> DataFrame:
    """The cells that hold at least ``share`` of the usable audit_ids: where similar records pile up.

    They are those the round-robin still draws from in round ceil(share * n): a cell of fewer rows
    has run out by then. One range of each such cell is sorted. Empty input gives no rows.
    """
    from decimal import Decimal
    from math import ceil

    spark: SparkSession = audits.sparkSession
    usable = _usable(audits)
    n = spark.sql(f"select count(*) from ({usable})").first()[0]
    level = max(1, ceil(Decimal(str(share)) * n))
    return spark.sql(FOUND.format(ranked=_ranked(usable, RAW, seed, buckets, level + 1, level), cell=", ".join(RAW), level=level))


def varied_subset(audits: DataFrame, k: int, seed: int = 7, buckets: int = BUCKETS) -> DataFrame:
    """The first k of (cell_rank, cell): audit_id, its cell and its rank there.

    Records that are corrupted or have a null, NaN or out-of-range feature are outside the grid and
    never chosen. Fewer than k usable records are all returned; k <= 0 returns none. audit_id makes
    equal hashes repeatable. The level is a single number; no rows come to the driver.
    """
    return _picked(audits.sparkSession, _usable(audits), RAW, ("audit_id", *RAW), max(0, int(k)), seed, buckets, "long_side", "short_side")


def spread_subset(audits: DataFrame, k: int, seed: int = 7, buckets: int = BUCKETS) -> DataFrame:
    """k records over the whole range of sizes: audit_id, its sides and band, its bins and its rank in the cell.

    As ``varied_subset``, but sides are binned in steps of their logarithm, the finest of which the
    occupied cells are fewer than k, and a round that k cuts is spread over the grid by a seeded hash
    of the cell in place of the cells of the smallest sides. At most nine counts come to the driver.
    """
    spark: SparkSession = audits.sparkSession
    k = max(0, int(k))
    fine = FINE.format(usable=_usable(audits))
    j = min((r.j for r in spark.sql(GRIDS.format(fine=fine)).collect() if r.n < k), default=8)
    hashed = f"sha2(concat('{int(seed)}:', long_bin, ':', short_bin, ':', coverage_band), 256)"
    return _picked(spark, BINNED.format(fine=fine, j=j), BINS, ("audit_id", *RAW, *BINS[:2]), k, seed, buckets, f"substring({hashed}, 1, 3)", hashed)
