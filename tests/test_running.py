import random
import time
from collections import defaultdict

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from wattline import session
from wattline.operators import running
from wattline.operators.running import bounded_running_sum

SCHEMA = "g string, d date, n long, delta double"


def brute_force(rows, start, low, high):
    groups = defaultdict(list)
    for g, d, n, delta in rows:
        groups[g, d].append((n, delta))
    levels = {}
    for key, members in groups.items():
        level = start
        for n, delta in sorted(members):
            step = 0.0 if delta is None or delta != delta else delta
            level = max(low, min(high, level + step))
            levels[(*key, n)] = level
    return levels


def data(seed, rows=3000):
    from datetime import date

    rng = random.Random(seed)
    days = [date(2025, 8, 1), date(2025, 8, 2), None]
    made = [
        (rng.choice(["a", "b", None, "c"]), rng.choice(days), n, rng.choice([None, float("nan"), rng.gauss(0, 30)]))
        for n in range(rows // 2)
    ]
    hot = [("hot", days[0], n, rng.gauss(0.3, 30)) for n in range(rows // 2)]
    return made + hot


def agree(found, rows):
    wanted = brute_force(rows, 50.0, 0.0, 100.0)
    got = {(r.g, r.d, r.n): r.level for r in found.collect()}
    assert got.keys() == wanted.keys()
    assert all(abs(got[k] - wanted[k]) < 1e-9 for k in wanted)


@pytest.mark.parametrize("most_gathered", [1, 100, 10_000])
def test_matches_brute_force(spark, most_gathered):
    rows = data(most_gathered)
    df = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), SCHEMA).repartition(5)
    found = bounded_running_sum(df, ["g", "d"], ["n"], "delta", 50.0, (0.0, 100.0), "level", most_gathered)
    assert found.columns == ["g", "d", "n", "delta", "level"]
    agree(found, rows)


def test_tree_of_several_tiers(spark, monkeypatch):
    monkeypatch.setattr(running, "_FAN_BITS", 2)
    monkeypatch.setattr(running, "_FAN", 4)
    rows = data(8)
    df = spark.createDataFrame(random.Random(2).sample(rows, len(rows)), SCHEMA).repartition(5)
    agree(bounded_running_sum(df, ["g", "d"], ["n"], "delta", 50.0, (0.0, 100.0), "level", 1), rows)


@pytest.mark.parametrize("most_gathered", [1, 10_000])
def test_infinite_steps(spark, most_gathered):
    inf = float("inf")
    rows = [("a", None, n, [inf, -inf, 3.0, -1.0, 1e308, -1e308][n * 7 % 6]) for n in range(600)]
    df = spark.createDataFrame(rows, SCHEMA)
    agree(bounded_running_sum(df, ["g", "d"], ["n"], "delta", 50.0, (0.0, 100.0), "level", most_gathered), rows)


def test_large_group_is_spread_over_tasks_and_never_gathered(spark, settings):
    settings(spark__sql__adaptive__coalescePartitions__enabled="false")
    rows = 80_000
    df = spark.range(rows).selectExpr("'hot' AS device", "hash(id) % 41 AS delta", "id AS n")
    begun = time.time()
    found = bounded_running_sum(df, ["device"], ["n"], "delta", 50.0, (0.0, 100.0), "level")
    spread = found.groupBy(F.spark_partition_id()).count().collect()
    assert time.time() - begun < 20  # a quadratic fold takes minutes
    assert len(spread) >= 6 and max(r["count"] for r in spread) < rows / 3
    plan = plan_of(found)
    assert not any(x in plan for x in ("MapInArrow", "Python", "Window", "Cartesian", "NestedLoop"))
    level, steps = 50.0, [r.delta for r in df.orderBy("n").collect()]
    wanted = [level := max(0.0, min(100.0, level + x)) for x in steps]
    assert [r.level for r in found.orderBy("n").collect()] == wanted


def test_no_row_gathers_more_than_a_block(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(running, "stored", lambda df, label: kept.append(session.stored(df, label)) or kept[-1])
    df = spark.range(40_000).selectExpr("id % 2 AS device", "1.0 AS delta", "id AS n")
    bounded_running_sum(df, ["device"], ["n"], "delta", 0.0, (0.0, 9.0), "level").count()
    (blocks,) = kept
    assert blocks.agg(F.max(F.size("rows"))).first()[0] <= 256 and blocks.agg(F.sum(F.size("rows"))).first()[0] == 40_000


@pytest.mark.parametrize("most_gathered", [0, 10])
def test_columns_may_have_the_names_used_inside(spark, most_gathered):
    df = spark.createDataFrame([(1, 1, 5.0, "a"), (1, 2, -9.0, "b")], "node int, rows int, step double, g0 string")
    found = bounded_running_sum(df, ["node"], ["rows"], "step", 1.0, (0.0, 4.0), "level", most_gathered)
    assert sorted(tuple(r) for r in found.collect()) == [(1, 1, 5.0, "a", 4.0), (1, 2, -9.0, "b", 0.0)]


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert bounded_running_sum(df, ["g", "d"], ["n"], "delta", 50.0, (0.0, 100.0), "level").count() == 0
