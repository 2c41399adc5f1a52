"""The event table, fusion and verdicts by hand; a run that is repeated changes nothing."""

from pyspark.sql import functions as F

from sparkwarden.plans import events as E
from sparkwarden.queries import verdicts as V

from .conftest import SF


def event(spark, kind, ip, at, **more):
    row = {"event_id": f"{kind}{ip}{at}", "ip": ip, "peer": "", "at": at, "n": 1, "first_id": at, "kind": kind, "day": 21, "evidence": f"{kind} x1 #{at}"} | more
    return spark.createDataFrame([tuple(row.get(n) for n in E.EVENT.names)], E.EVENT)


def test_a_repeated_run_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "events")
    first = sorted(map(tuple, V.event_table(spark, SF, root).collect()), key=repr)
    again = sorted(map(tuple, V.event_table(spark, SF, root).collect()), key=repr)
    assert first == again and len({r[0] for r in first}) == len(first) > 100
    table = E.event_log(spark, root)
    # A later, smaller run of the same batch replaces all of it; another batch stands beside it.
    few = spark.createDataFrame(table.read().where("kind = 'botnet'").drop("batch").limit(3).collect(), E.EVENT)
    table.write(few, "days-21-30")
    table.write(few, "other")
    assert table.read().groupBy("batch").count().orderBy("batch").collect() == [("days-21-30", 3), ("other", 3)]


def test_conditions_look_at_the_latest_event(spark):
    rows = [
        event(spark, "heartbeat", "a", 1, tag=2, mean_up=10.0), event(spark, "heartbeat", "a", 2, tag=2, mean_up=90.0),  # the later one is too large
        event(spark, "heartbeat", "b", 2, tag=2, mean_up=69.0), event(spark, "heartbeat", "c", 2, tag=3, mean_up=1.0), event(spark, "heartbeat", "d", 2, tag=None, mean_up=1.0),
        event(spark, "up_down", "b", 1, tag=1), event(spark, "up_down", "c", 1, tag=0), event(spark, "abnormal_ports", "d", 5),
        event(spark, "threat", "b", 9, threat=1), event(spark, "security_event", "b", 9, threat=1), event(spark, "security_event", "c", 3, threat=0),
        event(spark, "threat", "stranger", 9, threat=1), event(spark, "botnet", "stranger", 9),  # reported by no detector
    ]
    got = {r.ip: r for r in E.fused(E.all_events(rows)).collect()}
    assert set(got) == {"b", "c", "d"}
    on = lambda ip: {k for k in E.KINDS if got[ip][k]}
    assert on("b") == {"heartbeat", "up_down", "threat", "security_event"} and on("c") == {"security_event"} and on("d") == {"abnormal_ports"}
    assert (got["b"].first_at, got["b"].last_at) == (1, 9) and got["b"].evidence == "heartbeat x1 #2@security_event x1 #9@threat x1 #9@up_down x1 #1"


def test_events_of_a_detector(spark):
    found = spark.createDataFrame([("a", "p", 5, 1, 7), ("a", "p", 9, 1, 3), ("a", None, 4, 2, 8), (None, "p", 1, 1, 1)], "ip string, to string, sec long, dd int, flow_id long")
    got = sorted((r.ip, r.peer, r.day, r["at"], r.n, r.first_id, r.score, r.tag) for r in E.detected("botnet", found, "ip", peer="to", score=F.avg("sec")).collect())
    assert got == [("a", "", 2, 4, 1, 8, 4.0, None), ("a", "p", 1, 9, 2, 3, 7.0, None)]
    assert E.detected("botnet", found.limit(0), "ip").count() == 0


def test_verdicts(spark):
    flags = lambda *on: [1 if k in on else 0 for k in E.KINDS]
    columns = "ip string, " + ", ".join(f"{k} int" for k in E.KINDS)
    found = spark.createDataFrame([("a", *flags("threat")), ("b", *flags("heartbeat", "botnet")), ("c", *flags("up_down")), ("d", *flags("covert_channel"))], columns)
    found = found.withColumn("evidence", F.lit("e")).withColumn("first_at", F.lit(1).cast("long")).withColumn("last_at", F.lit(2).cast("long"))
    patterns = spark.createDataFrame([(*flags("up_down"), 75.0)], ", ".join(f"{k} int" for k in E.KINDS) + ", pattern_score double")
    weights = dict.fromkeys(E.KINDS, 0.1) | {"heartbeat": 0.55}
    rows = {r.ip: (r.score, r.score_type, r.level, r.indicators) for r in E.verdicts(found, weights, patterns, cut_off=10).collect()}
    assert rows == {"a": (60.0, 2, "low", "threat"), "b": (65.0, 2, "low", "heartbeat,botnet"), "c": (75.0, 1, "medium", "up_down")}
    feedback = spark.createDataFrame([(*flags("threat"), 2), (*flags("up_down"), 1), (*flags("up_down"), 2)], ", ".join(f"{k} int" for k in E.KINDS) + ", flag int")
    assert [r.ip for r in E.verdicts(found, weights, patterns, feedback).collect()] == ["c"]
