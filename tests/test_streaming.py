"""Streams over several files, one a batch: state across batches, late rows, restarts, replays."""

import random
from collections import Counter
from datetime import datetime, timezone
from types import SimpleNamespace

from pyspark.sql import functions as F

from sparkwarden.streaming import jobs, runs

FLOWS = "ts timestamp, sec long, srcip string, dstip string, upbytesize long, downbytesize long"


def put(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def flow(minute, src, dst, up, down=0):
    return (minute * 60, src, dst, up, down)


def put_flows(spark, path, rows):
    plain = spark.createDataFrame(rows, "sec long, srcip string, dstip string, upbytesize long, downbytesize long")
    plain.select(F.timestamp_seconds("sec").alias("ts"), *plain.columns).coalesce(1).write.mode("append").parquet(path)


def test_each_file_is_read_once(spark, tmp_path):
    """Over three batches, a restart with a new file, a restart with nothing new, and a batch that is written again."""
    source, folder = str(tmp_path / "in"), str(tmp_path / "out")
    for k in range(3):
        put(spark, source, [(k, 10 * k), (k, 10 * k + 1)], "a int, b int")
    run = lambda: jobs.drained(jobs.new_files(spark, source, "a int, b int"), folder=folder)
    first = run()
    assert first.select("batch").distinct().count() == 3 and first.count() == 6
    put(spark, source, [(9, 90)], "a int, b int")
    assert sorted((r["a"], r["b"]) for r in run().collect()) == [(0, 0), (0, 1), (1, 10), (1, 11), (2, 20), (2, 21), (9, 90)]
    assert run().count() == 7
    # The last batch's commit is lost: it runs again and replaces its rows.
    last = max(int(p.name) for p in (tmp_path / "out/checkpoint/commits").iterdir() if p.name.isdigit())
    for name in (str(last), f".{last}.crc"):
        (tmp_path / "out/checkpoint/commits" / name).unlink(missing_ok=True)
    assert run().count() == 7


def test_volumes_across_batches_and_late_rows(spark, tmp_path):
    """A window's bytes add up over batches; a row behind the watermark of earlier batches no longer counts."""
    source = str(tmp_path / "in")
    put_flows(spark, source, [flow(0, "a", "b", 5, 1), flow(1, "a", "b", 7)])
    put_flows(spark, source, [flow(4, "a", "c", 2), flow(60, "a", "c", 100)])
    put_flows(spark, source, [flow(61, "a", "c", 1)])  # Spark judges lateness by the watermark of the batch before the last
    put_flows(spark, source, [flow(2, "a", "b", 1000)])
    rows = jobs.drained(jobs.slot_volumes(jobs.new_files(spark, source, FLOWS)), "update")
    got = {(r["slot"], r["ip"]): r["bytes"] for r in jobs.last_updates(rows, ["slot", "ip"]).collect()}
    assert got == {(0, "a"): 14, (0, "b"): 1, (0, "c"): 0, (12, "a"): 101, (12, "c"): 0}


def test_closed_windows_are_appended_once(spark, tmp_path):
    source = str(tmp_path / "in")
    for minutes in ((0, 1), (3, 30), (31, 90)):
        put_flows(spark, source, [flow(m, "a", "b", 10) for m in minutes])
    got = jobs.drained(jobs.slot_volumes(jobs.new_files(spark, source, FLOWS)), "append").where("ip = 'a'").collect()
    assert Counter((r["slot"], r["bytes"]) for r in got) >= Counter({(0, 30): 1, (6, 20): 1}) and all(n == 1 for n in Counter(r["slot"] for r in got).values())


def test_repeats_across_batches(spark, tmp_path):
    """A key that comes again within the horizon, in another batch, is left out by the stream itself; later it counts anew."""
    source = str(tmp_path / "in")
    put_flows(spark, source, [flow(0, "a", "b", 1), flow(0, "a", "b", 2)])
    put_flows(spark, source, [flow(5, "a", "b", 3), flow(5, "a", "c", 4)])
    put_flows(spark, source, [flow(120, "x", "y", 5)])
    put_flows(spark, source, [flow(121, "x", "z", 5)])  # here the watermark passes minute 5, and the key is forgotten
    put_flows(spark, source, [flow(122, "a", "b", 6)])
    got = jobs.drained(jobs.without_repeats(jobs.new_files(spark, source, FLOWS), ["srcip", "dstip"])).collect()
    assert Counter((r["srcip"], r["dstip"]) for r in got) == Counter({("a", "b"): 2, ("a", "c"): 1, ("x", "y"): 1, ("x", "z"): 1})


SLOTS = "ip string, slot long, exceeds int"


def put_slots(spark, path, rows):
    plain = spark.createDataFrame(rows, SLOTS)
    plain.select("*", F.timestamp_seconds(F.col("slot") * 3600).alias("at")).coalesce(1).write.mode("append").parquet(path)


def tracked(spark, source, folder, **options):
    """After a run over what is there: of each host, all updates."""
    with runs.keyed_state(spark):
        stream = jobs.new_files(spark, source, SLOTS + ", at timestamp")
        rows = jobs.drained(runs.running_exceedances(stream, **options), "update", folder=folder)
    last = {r["ip"]: (r["now"], r["slot"]) for r in jobs.last_updates(rows, ["ip"]).collect()}
    longest = {r["ip"]: r["m"] for r in rows.groupBy("ip").agg(F.max("longest").alias("m")).collect()}
    return {ip: (*last[ip], longest[ip]) for ip in last}


def test_runs_go_on_in_the_next_batch(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "out")
    put_slots(spark, source, [("a", 1, 1), ("a", 2, 1), ("b", 1, 0)])
    put_slots(spark, source, [("a", 3, 1), ("b", 2, 1)])
    assert tracked(spark, source, folder) == {"a": (3, 3, 3), "b": (1, 2, 1)}
    put_slots(spark, source, [("a", 5, 1), ("b", 3, 1)])  # a misses a slot; the state comes back from the checkpoint
    assert tracked(spark, source, folder) == {"a": (1, 5, 3), "b": (2, 3, 2)}


def test_slots_out_of_order_are_put_in_order(spark, tmp_path):
    """1, 3, 2 in three batches, a repeated slot, a slot behind the watermark, nulls."""
    source, folder = str(tmp_path / "in"), str(tmp_path / "out")
    for rows in ([("a", 1, 1), (None, 1, 1)], [("a", 3, 1), ("a", 3, 0)], [("a", 2, 1)]):
        put_slots(spark, source, rows)
    assert tracked(spark, source, folder, late="4 hours") == {"a": (3, 3, 3)}
    put_slots(spark, source, [("a", 20, 1), ("a", 21, 0)])
    put_slots(spark, source, [("a", 22, 1)])
    tracked(spark, source, folder, late="4 hours")
    put_slots(spark, source, [("a", 4, 1), ("a", 23, 1)])  # 4 is behind: it can't make the run of 1 to 3 longer
    assert tracked(spark, source, folder, late="4 hours") == {"a": (2, 23, 3)}


def test_batches_in_any_order_equal_one_batch(spark, tmp_path):
    r = random.Random(3)
    slots = [(ip, s, int(r.random() < 0.8)) for ip in "abc" for s in range(30) if r.random() < 0.85]
    want = {ip: runs.extended(0, 0, None, [(s, e) for i, s, e in slots if i == ip]) for ip in "abc"}
    r.shuffle(slots)
    for k in range(4):
        put_slots(spark, str(tmp_path / "in"), slots[k::4])
    got = tracked(spark, str(tmp_path / "in"), str(tmp_path / "out"), late="40 hours")
    assert got == {ip: (now, last, longest) for ip, (now, longest, last) in want.items()}


def test_silent_hosts_leave_the_state(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "out")
    put_slots(spark, source, [("a", 1, 1), ("a", 2, 1), ("b", 1, 1)])
    for k in (2, 60, 61, 62):
        put_slots(spark, source, [("b", k, 1)])
    tracked(spark, source, folder, late="1 hour", idle_hours=24)
    state = lambda name: spark.read.format("statestore").option("path", f"{folder}/checkpoint").option("stateVarName", name)
    assert [x.key.ip for x in state("run").load().collect()] == ["b"]
    assert {x.key.ip for x in state("pending").option("flattenCollectionTypes", "true").load().collect()} <= {"b"}
    put_slots(spark, source, [("a", 63, 1)])  # it comes back and starts anew; what it had is in the rows
    assert tracked(spark, source, folder, late="1 hour", idle_hours=24)["a"] == (1, 63, 2)


def test_state_is_read_and_written_once_for_each_host():
    """However many slots a batch has, a host's state is asked for the same number of times."""
    calls = []

    class Value:
        def __init__(self):
            self.held = None

        def get(self):
            calls.append("get")
            return self.held

        def update(self, new):
            calls.append("update")
            self.held = new

        def clear(self):
            self.held = None

    class Handle:
        def getValueState(self, name, schema):
            return Value()

        def registerTimer(self, at):
            calls.append("timer")

    counts = []
    for n in (2, 500):
        tracker = runs.RunTracker(1000)
        tracker.init(Handle())
        calls.clear()
        slots = [SimpleNamespace(slot=k, at=datetime.fromtimestamp(3600 * k, timezone.utc), exceeds=1) for k in range(n)]
        out = list(tracker.handleInputRows(("a",), iter(slots), None))
        assert [(r.now, r.longest, r.slot) for r in out] == [(n, n, n - 1)]
        counts.append(len(calls))
    assert counts[0] == counts[1] <= 6
