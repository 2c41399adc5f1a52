"""The relational reader and writer against a database in memory (Derby, which Spark brings along), and messages."""

import json
import uuid

from pyspark.sql import functions as F

from sparkwarden.sources import readers, sinks


def test_rows_go_to_a_database_and_come_back(spark, tmp_path):
    """Appended twice, read by a query with a condition and a time range that the database answers."""
    spark._jvm.java.lang.System.setProperty("derby.stream.error.file", str(tmp_path / "derby.log"))
    url = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"
    options = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    rows = spark.createDataFrame([(k, "port" if k % 2 else "volume", 100 * k) for k in range(10)], "id long, kind string, at long")
    sinks.append_relational(rows.where("id < 6"), url, "events", createTableColumnTypes="kind VARCHAR(20)", **options)
    sinks.append_relational(rows.where("id >= 6"), url, "events", **options)
    assert readers.read_relational(spark, url, 'SELECT * FROM events', **options).count() == 10
    found = readers.read_relational(spark, url, """SELECT "id", "at" FROM events WHERE "kind" = 'port' AND "at" BETWEEN 200 AND 800""", **options)
    assert sorted(map(tuple, found.collect())) == [(3, 300), (5, 500), (7, 700)]
    assert found.columns == ["id", "at"]
    # A filter put on afterwards goes to the database as well.
    plan = found.where(F.col("id") > 4)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThan(id,4)" in plan


def test_messages(spark):
    rows = spark.createDataFrame([(1, "a", None), (2, None, 0.5)], "id long, ip string, score double")
    got = sorted((json.loads(r["value"]) for r in sinks.messages(rows).collect()), key=lambda m: m["id"])
    assert got == [{"id": 1, "ip": "a"}, {"id": 2, "score": 0.5}]
