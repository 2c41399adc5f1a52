"""Runs of exceeding slots of each host as a stream, in event time."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructType

_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_SHORT = StructType().add("now", "long").add("longest", "long").add("last", "long").add("seen", "long")
_PENDING = StructType().add("slots", ArrayType(LongType())).add("exceeds", ArrayType(IntegerType())).add("at", ArrayType(LongType()))
#: What ``running_exceedances`` gives: the current and the longest run, and the latest slot.
RUNNING = StructType().add("ip", "string").add("now", "long").add("longest", "long").add("slot", "long")


@contextmanager
def keyed_state(spark: SparkSession):
    """Streams that are started inside keep their state in RocksDB, which timers need."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)


def extended(now: int, longest: int, last: int | None, slots: list[tuple[int, int]]) -> tuple[int, int, int | None]:
    """A run after more slots, in order: an absent slot ends it like one that does not exceed."""
    for slot, exceeds in sorted(slots):
        now = (now + 1 if slot - 1 == last else 1) if exceeds else 0
        longest, last = max(longest, now), slot
    return now, longest, last


class RunTracker(StatefulProcessor):
    """Of each host, the run up to the watermark as four numbers, and later slots until the watermark passes them.

    Slots come in any order within the watermark: each answer puts the pending ones in order behind the settled run.  They
    are one value, read and written once for each host and batch.  A timer at the first pending slot settles what the
    watermark has passed; one ``idle_ms`` after the last slot clears a silent host's state.
    """

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", _SHORT)
        self.pending = handle.getValueState("pending", _PENDING)

    def _settled(self) -> tuple[int, int, int | None, int]:
        found = self.run.get()
        return tuple(found) if found else (0, 0, None, 0)

    def _waiting(self) -> dict[int, tuple[int, int]]:
        found = self.pending.get()
        return {slot: (exceeds, at) for slot, exceeds, at in zip(*found, strict=True)} if found else {}

    def _keep(self, waiting: dict[int, tuple[int, int]]) -> None:
        if waiting:
            self.pending.update((list(waiting), [e for e, _ in waiting.values()], [at for _, at in waiting.values()]))
            self.handle.registerTimer(min(at for _, at in waiting.values()) + 1)
        else:
            self.pending.clear()

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        now, longest, last, seen = self._settled()
        waiting = self._waiting()
        for r in rows:
            if r.slot is None or r.at is None or (last is not None and r.slot <= last):
                continue  # settled by now
            at = int(r.at.timestamp() * 1000)
            waiting[r.slot] = (max(int(r.exceeds or 0), waiting[r.slot][0] if r.slot in waiting else 0), at)
            seen = max(seen, at)
        self._keep(waiting)
        self.run.update((now, longest, last, seen))
        if seen:
            self.handle.registerTimer(seen + self.idle_ms)
        now, longest, last = extended(now, longest, last, [(s, e) for s, (e, _) in waiting.items()])
        if last is not None:
            yield Row(ip=key[0], now=now, longest=longest, slot=last)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs()
        now, longest, last, seen = self._settled()
        waiting = self._waiting()
        left = {s: x for s, x in waiting.items() if x[1] >= passed}
        done = [(s, e) for s, (e, _) in waiting.items() if s not in left]
        if done:
            self._keep(left)
        if not left and seen + self.idle_ms <= passed:
            self.run.clear()
        elif done:
            self.run.update((*extended(now, longest, last, done), seen))
        yield from ()

    def close(self) -> None:
        pass


def running_exceedances(slots: DataFrame, late: str = "2 hours", idle_hours: int = 48) -> DataFrame:
    """Current and longest run of exceeding slots of each host, over all batches, as updates.

    ``slots`` has ``ip``, ``slot`` (whole number), ``at`` (when the slot begins) and ``exceeds``.  Slots may come in any
    order up to ``late`` behind the latest one and give the rows that a batch over all of them gives; later ones are
    dropped.  A host that is silent for ``idle_hours`` is forgotten: its ``longest`` starts anew, so take the largest of
    its updates.  Start the query inside ``keyed_state``.
    """
    kept = slots.where("ip is not null").select("ip", "slot", "at", "exceeds").withWatermark("at", late)
    return kept.groupBy("ip").transformWithState(RunTracker(idle_hours * 3_600_000), RUNNING, "Update", "EventTime")
