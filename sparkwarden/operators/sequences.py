"""Sequence operators: gaps, autocorrelation, runs, baselines by slot, presence over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkwarden.operators.enrich import bounded
from sparkwarden.operators.runs import longest_slot_run
from sparkwarden.storage import written

#: Gaps of one key that are listed in one row; keys with more have a row for each gap and stride.
ROW_GAPS = 100_000


#: Stretches of time into which the timelines of busy keys are cut.
STRETCHES = 4096


def gaps(df: DataFrame, keys: list[str], at: str, tie: str, least: int = 4) -> DataFrame:
    """Time between consecutive records of each key that has at least ``least`` of them.

    Timelines are cut into stretches of time, each ordered by itself; a stretch's first record takes the last time of
    the key's stretch before.  So one key is dealt out over as many tasks as its records are over time; only records of
    one key in one stretch (of ``STRETCHES``) meet.  Records without a time are left out.
    """
    rows = df.where(F.col(at).isNotNull()).select(*keys, at, tie)
    lo, hi = rows.agg(F.min(at), F.max(at)).first()
    width = max(1, -(-(hi - lo + 1) // STRETCHES)) if lo is not None else 1
    cut = rows.withColumn("__part", F.floor((F.col(at) - F.lit(lo or 0)) / width))
    inside = Window.partitionBy(*keys, "__part").orderBy(at, tie)
    ordered = cut.withColumn("__before", F.lag(at).over(inside)).withColumn("__k", F.row_number().over(inside))
    # At most STRETCHES rows a key.
    over = Window.partitionBy(*keys)
    ends = cut.groupBy(*keys, "__part").agg(F.count(F.lit(1)).alias("__n"), F.max(at).alias("__last"))
    ends = ends.select(
        *(F.col(c).alias(f"__{c}") for c in keys), F.col("__part").alias("__of"), F.sum("__n").over(over).alias("n"),
        (F.sum("__n").over(over.orderBy("__part")) - F.col("__n")).alias("__earlier"), F.lag("__last").over(over.orderBy("__part")).alias("__carried"),
    ).where(F.col("n") >= least)
    same = F.col("__part") == F.col("__of")
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    out = ordered.join(ends, same).withColumn("__prev", F.when(F.col("__k") > 1, F.col("__before")).otherwise(F.col("__carried")))
    return out.where("__prev is not null").select(*keys, at, tie, (F.col(at) - F.col("__prev")).alias("gap"), (F.col("__k") + F.col("__earlier")).cast("int").alias("k"))


def strided_autocorrelation(x: Column) -> Column:
    """The largest of ``sum(x[i*j] * x[(i-1)*j]) / sum(x*x)`` over strides j; null where all gaps are zero."""
    n = F.size(x)
    total = F.aggregate(x, F.lit(0.0), lambda s, v: s + v * v)

    def at_stride(j: Column) -> Column:
        last = F.ceil(n / j) - 1
        steps = F.when(last >= 1, F.sequence(F.lit(1), last.cast("int"))).otherwise(F.array().cast("array<int>"))
        return F.aggregate(steps, F.lit(0.0), lambda s, i: s + F.get(x, i * j) * F.get(x, (i - 1) * j)) / total

    strides = F.when(n >= 2, F.sequence(F.lit(1), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.when(total > 0, F.array_max(F.transform(strides, at_stride)))


def _best_stride(numbered: DataFrame, keys: list[str]) -> DataFrame:
    """``score`` of each key as ``strided_autocorrelation`` has it, of rows with the place ``p`` (from 0) and the value ``x``.

    The product of the values at p - j and p counts for stride j where j divides p, so each row meets the rows at its
    divisors' distance: n log n pairs of a key, joined on key and place, so that a busy key is no hot group.
    """
    low = F.filter(F.sequence(F.lit(1), F.floor(F.sqrt("p")).cast("int")), lambda j: F.col("p") % j == 0)
    strides = F.array_union(low, F.transform(low, lambda j: (F.col("p") / j).cast("int")))
    ends = numbered.where("p > 0").select(*keys, "p", "x", F.explode(strides).alias("j")).withColumn("at", F.col("p") - F.col("j"))
    starts = numbered.select(*keys, F.col("p").alias("at"), F.col("x").alias("y"))
    sums = ends.join(starts, [*keys, "at"]).groupBy(*keys, "j").agg(F.sum(F.col("x") * F.col("y")).alias("s")).groupBy(*keys).agg(F.max("s").alias("s"))
    totals = numbered.groupBy(*keys).agg(F.sum(F.col("x") * F.col("x")).alias("total"), F.count(F.lit(1)).cast("int").alias("n_gaps"))
    return totals.join(sums, keys, "left").select(*keys, "n_gaps", F.when((F.col("total") > 0) & F.col("s").isNotNull(), F.round(F.col("s") / F.col("total"), 6)).alias("score"))


def periodicity(df: DataFrame, keys: list[str], at: str, tie: str, least: int = 4, row_gaps: int = ROW_GAPS) -> DataFrame:
    """Of each key with ``least`` records: number of gaps and ``score`` (strided autocorrelation over all of them).

    Lists of at most ``row_gaps`` gaps are scored within a row, made of the key's sorted times in one shuffle; longer ones
    row by row, with the same result.  Rows without a time or a key are left out.
    """
    rows = df.where(F.col(at).isNotNull())
    for c in keys:
        rows = rows.where(F.col(c).isNotNull())
    rows = rows.select(*keys, at, tie)
    busy = written(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > row_gaps + 1).select(*keys), "busy-keys")
    any_busy = not busy.isEmpty()
    short = rows.join(bounded(busy), keys, "left_anti") if any_busy else rows
    # Records at one time are zero apart in any order, so the tie does not matter here.
    listed = short.groupBy(*keys).agg(F.array_sort(F.collect_list(at)).alias("__at")).where(F.size("__at") >= max(least, 2))
    n = F.size("__at") - 1
    spaced = listed.select(*keys, F.zip_with(F.slice("__at", F.lit(2), n), F.slice("__at", F.lit(1), n), lambda b, a: (b - a).cast("double")).alias("x"))
    scored = spaced.select(*keys, F.size("x").alias("n_gaps"), F.round(strided_autocorrelation(F.col("x")), 6).alias("score"))
    if not any_busy:
        return scored
    numbered = gaps(rows.join(bounded(busy), keys, "left_semi"), keys, at, tie, least).select(*keys, (F.col("k") - 2).alias("p"), F.col("gap").cast("double").alias("x"))
    return scored.unionByName(_best_stride(written(numbered, "gaps"), keys))


def presence_autocorrelation(df: DataFrame, keys: list[str], slot: str) -> DataFrame:
    """Lag-one autocorrelation of the 0/1 presence over slots: neighbouring slots that are both there, per slot there."""
    present = df.select(*keys, slot).distinct()
    follows = F.lead(slot).over(Window.partitionBy(*keys).orderBy(slot)) == F.col(slot) + 1
    pairs = present.select(*keys, F.when(follows, 1).otherwise(0).alias("pair"))
    return pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("slots"), F.round(F.sum("pair") / F.count(F.lit(1)), 6).alias("ak"))


def runs(df: DataFrame, keys: list[str], slot: str, flag: str) -> DataFrame:
    """Islands of equal flags in consecutive slots (whole numbers): ``flag``, first and last slot, length.

    A slot that is absent ends an island.  Of one key, all slots are sorted in one task; where only the longest run is
    wanted, ``operators.runs`` deals a key out.
    """
    island = F.col(slot) - F.row_number().over(Window.partitionBy(*keys, flag).orderBy(slot))
    marked = df.select(*keys, slot, flag).distinct().select("*", island.alias("__island"))
    return marked.groupBy(*keys, flag, "__island").agg(F.min(slot).alias("first"), F.max(slot).alias("last"), F.count(F.lit(1)).alias("length")).drop("__island")


def longest_run(df: DataFrame, keys: list[str], slot: str, flag: str) -> DataFrame:
    """The longest run of set flags in consecutive slots of each key that has one."""
    return longest_slot_run(df, keys, slot, flag).select(*keys, "longest")


def slot_baseline(df: DataFrame, keys: list[str], day: str, slot: str, value: str, days: int = 7, k: float = 3.0) -> DataFrame:
    """Rows with the mean, number and upper limit of the same slot on the ``days`` days before, by a range frame."""
    w = Window.partitionBy(*keys, slot).orderBy(day).rangeBetween(-days, -1)
    n, mean = F.count(value).over(w), F.avg(value).over(w)
    limit = F.when(n == 1, k * mean).when(n > 1, mean + k * F.stddev_pop(value).over(w))
    return df.select("*", n.alias("n_base"), mean.alias("base_mean"), limit.alias("upper"))


def complete_grid(df: DataFrame, keys: list[str], slot: str, first: int, last: int, value: str) -> DataFrame:
    """Every key with every slot from first to last, the value null where there was none."""
    grid = df.select(*keys).distinct().withColumn(slot, F.explode(F.sequence(F.lit(first), F.lit(last))))
    return grid.join(df.select(*keys, F.col(slot).cast("int").alias(slot), value), [*keys, slot], "left")


def three_window_presence(df: DataFrame, key: str, at: str, width: int) -> DataFrame:
    """Keys active in the first, the middle and the last window of their span of at least three windows."""
    spans = df.groupBy(key).agg(F.min(at).alias("lo"), F.max(at).alias("hi")).where(F.col("hi") - F.col("lo") >= 3 * width)
    mid = (F.col("lo") + F.col("hi")) / 2
    part = F.when(F.col(at) < F.col("lo") + width, 0).when(F.col(at) > F.col("hi") - width, 2).when(F.abs(F.col(at) - mid) <= width / 2, 1)
    named = df.select(F.col(key), at).join(spans, key).select(key, part.alias("part")).where("part is not null")
    return named.groupBy(key).agg(F.countDistinct("part").alias("parts")).where("parts = 3").select(key)


def first_of_each(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first record of each entity. Combined before the shuffle."""
    rest = [c for c in df.columns if c not in (key, *order)]
    return df.groupBy(key).agg(F.min(F.struct(*order, *rest)).alias("__one")).select(key, *(F.col(f"__one.{c}").alias(c) for c in (*order, *rest)))


def idle_days(last_seen: DataFrame, today: Column, day: str, idle: int, retired: int) -> DataFrame:
    """``flag`` 4 where an entity was not seen for ``idle`` days, 5 for ``retired`` days; others go."""
    gap = F.datediff(today, F.col(day))
    return last_seen.withColumn("gap_days", gap).withColumn("flag", F.when(gap >= retired, 5).when(gap >= idle, 4)).where("flag is not null")
