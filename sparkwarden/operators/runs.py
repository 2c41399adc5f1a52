"""Longest runs of set slots, from summaries that merge.

A run is a row of consecutive slot numbers that are set; a slot that is absent ends it like one that is not set.  Of a
range of slots, (prefix, suffix, best, best_from) says all that its neighbours need: how many set slots it begins and
ends with, its longest run and where that starts.  Summaries of neighbouring ranges merge, so a key's timeline is cut
into ranges of ``FAN`` slots, these into ranges of ``FAN`` ranges, and so on: no group is larger than ``FAN``, however
many slots or rows one key has, and rows are combined before the first shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Slots of a range, and ranges of a larger one.
FAN = 1024


def _merged(parts: Column, width: int, first: Column, last: Column) -> Column:
    """The summary of sorted neighbours ``(at, prefix, suffix, best, best_from)``, each ``width`` slots wide.

    ``first`` and ``last`` are the numbers of the first and last part that the range has room for.
    """
    zero = F.lit(0).cast("long")
    start = F.struct((first - 1).alias("at"), zero.alias("tail"), zero.alias("prefix"), F.lit(True).alias("unbroken"), zero.alias("best"), zero.alias("best_from"))

    def step(s: Column, e: Column) -> Column:
        next_to = e["at"] == s["at"] + 1
        before = F.when(next_to, s["tail"]).otherwise(zero)
        joined, joined_from = before + e["prefix"], e["at"] * width - before
        best = F.greatest(s["best"], joined, e["best"])
        best_from = F.when(s["best"] == best, s["best_from"]).when(joined == best, joined_from).otherwise(e["best_from"])
        goes_on = s["unbroken"] & next_to
        return F.struct(
            e["at"].alias("at"), F.when(e["suffix"] == width, before + width).otherwise(e["suffix"]).alias("tail"),
            F.when(goes_on, s["prefix"] + e["prefix"]).otherwise(s["prefix"]).alias("prefix"), (goes_on & (e["prefix"] == width)).alias("unbroken"),
            best.alias("best"), best_from.alias("best_from"),
        )

    def done(s: Column) -> Column:
        return F.struct(s["prefix"].alias("prefix"), F.when(s["at"] == last, s["tail"]).otherwise(zero).alias("suffix"), s["best"].alias("best"), s["best_from"].alias("best_from"))

    return F.aggregate(parts, start, step, done)


def longest_slot_run(df: DataFrame, keys: list[str], slot: str, flag: str) -> DataFrame:
    """``longest`` and ``first_slot`` (of the earliest such run) of each key that has a set slot.

    ``slot`` is a whole number; rows with a null slot or flag do not count, and a slot that is repeated is set if one
    of its rows is.
    """
    at = F.col(slot).cast("long")
    rows = df.where((F.col(flag) == 1) & at.isNotNull()).select(*keys, F.floor(at / FAN).alias("__range"), at.alias("__at"))
    lists = rows.groupBy(*keys, "__range").agg(F.array_sort(F.collect_set("__at")).alias("__slots"))
    one = F.lit(1).cast("long")
    singles = F.transform("__slots", lambda x: F.struct(x.alias("at"), one.alias("prefix"), one.alias("suffix"), one.alias("best"), x.alias("best_from")))
    low = F.col("__range") * FAN
    summary = lists.select(*keys, F.col("__range").alias("__at"), _merged(singles, 1, low, low + FAN - 1).alias("__s"))
    part = F.struct(F.col("__at").alias("at"), F.col("__s.prefix").alias("prefix"), F.col("__s.suffix").alias("suffix"), F.col("__s.best").alias("best"), F.col("__s.best_from").alias("best_from"))
    wider = summary.groupBy(*keys, F.floor(F.col("__at") / FAN).alias("__range")).agg(F.array_sort(F.collect_list(part)).alias("__parts"))
    summary = wider.select(*keys, F.col("__range").alias("__at"), _merged(F.col("__parts"), FAN, low, low + FAN - 1).alias("__s"))
    # Ranges of FAN * FAN slots: as few as the numbers have room for.
    top = summary.groupBy(*keys).agg(F.array_sort(F.collect_list(part)).alias("__parts"))
    whole = _merged(F.col("__parts"), FAN * FAN, F.element_at("__parts", 1)["at"], F.element_at("__parts", -1)["at"])
    return top.select(*keys, whole.alias("__s")).select(*keys, F.col("__s.best").alias("longest"), F.col("__s.best_from").alias("first_slot"))
