"""Versions and batches: publishing, replays, torn entries, learning streams that run again."""

import shutil

import pytest
from pyspark.sql import functions as F

from sparkwarden.plans import flows
from sparkwarden.sources.versions import Batches, Versions
from sparkwarden.streaming import jobs


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_versions_are_published_whole(spark, tmp_path):
    table = Versions(spark, str(tmp_path / "t"), "a int, b string")
    assert table.latest() is None and rows(table.read()) == []
    add = lambda n: lambda base: base.union(spark.createDataFrame([(n, "x")], "a int, b string"))
    assert table.merge("s", 0, add(1)) == 1 and table.merge("s", 1, add(2)) == 2
    assert table.merge("s", 1, add(99)) == 2 and table.merge("s", 0, add(99)) == 2  # applied before: nothing happens
    assert rows(table.read()) == [(1, "x"), (2, "x")] and rows(table.read(1)) == [(1, "x")]
    assert rows(table.as_of("s", 1)) == [(1, "x")] and rows(table.as_of("s", 0)) == [] and rows(table.as_of("s", 7)) == [(1, "x"), (2, "x")]
    assert table.merge("other", 0, add(3)) == 3 and rows(table.as_of("s", 2)) == [(1, "x"), (2, "x"), (3, "x")]
    with pytest.raises(Exception, match="exist"):
        table.files.create(f"{table.root}/_published/00000003", "{}")
    # A writer that died: rows without an entry, and an entry cut short. Readers do not see either, writers go past it.
    (tmp_path / "t/v00000004-lost").mkdir()
    (tmp_path / "t/_published/00000004").write_text('{"fold')
    assert table.latest() == 3 and table.merge("s", 2, add(4)) == 5 and len(rows(table.read())) == 4
    table.prune(keep=1)
    assert table.latest() == 5 and len(rows(table.read())) == 4 and [e[0] for e in table._entries()] == [5]


def test_batches_replace_themselves(spark, tmp_path):
    table = Batches(spark, str(tmp_path / "t"), "a int, day int", by=["day"])
    assert rows(table.read()) == []
    make = lambda *r: spark.createDataFrame(list(r), "a int, day int")
    table.write(make((1, 1), (2, 2)), "x")
    table.write(make((3, 1)), "y")
    table.write(make((4, 2)), "x")  # fewer rows and days than before: the old ones are gone
    assert rows(table.read()) == [(3, 1, "y"), (4, 2, "x")]
    plan = table.read().where("batch = 'x' AND day = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(" in plan and "PartitionFilters: []" not in plan


def test_learned_periods(spark):
    base = spark.createDataFrame([("a", "noon")], "ip string, period string")
    flow = spark.createDataFrame([("a", 2000, 80, 9_000, 10), ("b", 2000, 80, 9_000, 20), ("c", 2000, 80, 10, 20)], "srcip string, srcport int, dstport int, upbytesize long, hh int")
    confirmed = spark.createDataFrame([("a", "night")], "ip string, period string")
    assert rows(flows.learned_periods(base, flow, confirmed, 1000)) == [("a", "night"), ("a", "noon"), ("b", "evening")]


FLOW = "flow_id long, srcip string, upbytesize long, downbytesize long, hh int"


def test_learning_stream_survives_replays(spark, tmp_path):
    """The last batch's commit is lost: it is judged by the same baseline again, its alerts replace themselves, it trains once."""
    source, folder = str(tmp_path / "in"), str(tmp_path / "out")
    table = Versions(spark, f"{folder}/baseline", "ip string, period string, max_ratio double")
    detect = lambda batch, base: flows.ratio_anomalies(batch, base).select("flow_id", "ip")
    learn = lambda batch, base: flows.raised_ratios(base, flows.normal_ratios(batch, base, batch.where("flow_id >= 100")))

    def run(*batch):
        if batch:
            spark.createDataFrame(list(batch), FLOW).coalesce(1).write.mode("append").parquet(source)
        jobs.learning(jobs.new_files(spark, source, FLOW), table, "flows", detect, learn, folder)
        return rows(Batches(spark, f"{folder}/alerts", "flow_id long, ip string").read().select("flow_id")), rows(table.read())

    assert run((1, "a", 30, 10, 10), (2, "a", 20, 10, 10)) == ([], [("a", "morning", 3.0)])
    # 3 is an anomaly; 100 is one too, but rejected, and raises the limit for later batches only; b is new.
    second = run((3, "a", 90, 10, 10), (100, "a", 50, 10, 10), (4, "b", 10, 0, 20))
    assert second == ([(3,), (100,)], [("a", "morning", 5.0), ("b", "evening", 10.0)])
    last = max(int(p.name) for p in (tmp_path / "out/checkpoint/commits").iterdir() if p.name.isdigit())
    for name in (str(last), f".{last}.crc"):
        (tmp_path / "out/checkpoint/commits" / name).unlink(missing_ok=True)
    shutil.rmtree(tmp_path / f"out/alerts/batch={last}")
    version = table.latest()
    assert run() == second and table.latest() == version
    assert run((5, "a", 45, 10, 10), (6, "a", 60, 10, 10))[0] == [(3,), (6,), (100,)]


def test_raised_ratios_leave_out_what_is_no_number(spark):
    base = spark.createDataFrame([("a", "noon", 2.0)], "ip string, period string, max_ratio double")
    normal = spark.createDataFrame([("a", "noon", float("inf")), ("a", "noon", float("nan")), ("a", "noon", None), ("a", "noon", 1.5), ("b", "noon", 7.0)], "ip string, period string, ratio double")
    assert rows(flows.raised_ratios(base, normal)) == [("a", "noon", 2.0), ("b", "noon", 7.0)]
    assert rows(flows.raised_ratios(base, normal.where(F.lit(False)))) == [("a", "noon", 2.0)]
