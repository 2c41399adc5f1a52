"""Operators that work differently on large keys or tables give the same there; plans hold what they should."""

import math
import random
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sparkwarden.adapters import VIEWS, view
from sparkwarden.ml import features, models
from sparkwarden.operators import graph as G
from sparkwarden.operators import sequences as Q

from .conftest import SF

ROOT = Path(__file__).resolve().parent.parent


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_periodicity_of_long_lists(spark):
    """Scores are the same whether gaps are listed in a row or joined row by row, and those of plain Python."""
    rng = random.Random(3)
    data = [(k, t, i) for k, n in ((1, 200), (2, 4), (3, 37), (4, 3), (5, 60)) for i, t in enumerate(sorted(rng.randrange(5000) for _ in range(n)))] + [(6, 7, i) for i in range(9)]
    df = spark.createDataFrame(data, "host int, at long, tie int")
    got = rows(Q.periodicity(df, ["host"], "at", "tie", row_gaps=2))
    assert got == rows(Q.periodicity(df, ["host"], "at", "tie"))
    for k, n, score in got:
        at = sorted(t for key, t, _ in data if key == k)
        x = [b - a for a, b in zip(at, at[1:], strict=False)]
        total = sum(v * v for v in x)
        best = max(sum(x[i * j] * x[(i - 1) * j] for i in range(1, math.ceil(len(x) / j))) for j in range(1, len(x)))
        assert n == len(x) and (score is None if not total else abs(score - best / total) < 2e-6)


def test_cosine_components(spark):
    """Components are those of all links, also for a crowd of alike entities and for chains."""
    rng = random.Random(4)
    data = [(f"c{k}", f"x{j}") for k in range(40) for j in range(12) if rng.random() < 0.9]
    data += [(f"r{k}", f"y{rng.randrange(40)}") for k in range(60) for _ in range(6)]
    data += [(f"s{k}", f"z{j}") for k in range(20) for j in range(k, k + 6)] + [("lone", "q")]
    visits = spark.createDataFrame(data, "e string, x string")
    for least in (0.6, 0.8):
        want = G.connected_components(G.cosine_links(visits, "e", "x", least), "a", "b")
        assert rows(G.cosine_components(visits, "e", "x", least).select("node", "component")) == rows(want.select("node", "component"))


def test_frequency_index(spark):
    rng = random.Random(5)
    data = [rng.randrange(200) for _ in range(3000)]
    order = sorted(set(data), key=lambda v: (-data.count(v), v))
    got = G.frequency_index(spark.createDataFrame([(v,) for v in data], "v int"), "v").collect()
    assert sorted((r["v"], r["n"], r["index"]) for r in got) == sorted((v, data.count(v), k) for k, v in enumerate(order))


def test_nearest_votes_in_blocks(spark):
    base = view(spark, SF, "v_xy")
    queries = base.where("vec_id % 5 = 0")
    assert rows(features.nearest_votes(queries, base, block=3)) == rows(features.nearest_votes(queries, base))


@pytest.mark.parametrize("name", sorted(VIEWS))
def test_views_join_by_keys(spark, name):
    """No view pairs the rows of two tables, whatever is filtered afterwards."""
    df = view(spark, SF, name)
    plan = df.where(F.xxhash64(*df.columns) % 2 == 0)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_saved_models_come_back(spark, tmp_path):
    texts = spark.createDataFrame([("drop table a", 1.0), ("select b from c", 1.0), ("page two", 0.0), ("news of today", 0.0)], "text string, label double")
    model = models.text_classifier(texts)
    models.save(model, str(tmp_path / "model"))
    models.save(model, str(tmp_path / "model"))  # again, in its place
    assert rows(models.load(str(tmp_path / "model")).transform(texts).select("text", "prediction")) == rows(model.transform(texts).select("text", "prediction"))


def test_entry_without_the_llm_folder(tmp_path):
    """With the subpackage and its tests away, with and without the pipeline, the rest can still be imported."""
    for keep in (True, False):
        to = tmp_path / str(keep)
        to.mkdir()
        shutil.copytree(ROOT / "sparkwarden", to / "sparkwarden", ignore=shutil.ignore_patterns("llm", "__pycache__"))
        shutil.copy(ROOT / "__spark_entry__.py", to)
        if keep:
            shutil.copy(ROOT / "corpus_pipeline.py", to)
        said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; q = e.queries(); print(len(q), 'pipeline' in q, any(k.startswith('op') for k in q))"], cwd=to, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(to)}, capture_output=True, text=True)
        assert said.stdout.split()[1:] == ["False", "False"], said.stderr
