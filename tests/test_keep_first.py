import random

import pytest
from conftest import plan_of, rows_of
from pyspark.sql import functions as F

from wattline.operators.cleaning import keep_first
from wattline.operators.quality import key_counts

SCHEMA = "k string, t long, x double, s string"


def smallest(rows):
    """One row per (k, t), smallest by x then s, None last and NaN just before None."""
    def order(row):
        x, s = row[2], row[3]
        number = (2, 0.0) if x is None else (1, 0.0) if x != x else (0, x)
        return number, (s is None, s or "")

    best = {}
    for row in rows:
        key = row[:2]
        if key not in best or order(row) < order(best[key]):
            best[key] = row
    return sorted(map(repr, best.values()))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    pick = lambda *xs: rng.choice(xs)
    some = [
        (pick("a", "b", None), pick(1, 2, None), pick(None, float("nan"), -1.0, 0.0, 5.0), pick(None, "", "u", "v"))
        for _ in range(600)
    ]
    hot = [("hot", 9, float(i % 97), "u") for i in range(300)]
    return some + hot


def as_text(df):
    return sorted(repr(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_matches_brute_force_in_any_order_and_partitioning(spark, rows, partitions):
    shuffled = random.Random(partitions).sample(rows, len(rows))
    df = spark.createDataFrame(shuffled, SCHEMA).repartition(partitions)
    found = keep_first(df, ["k", "t"], ["x"], copies="n")
    assert as_text(found.drop("n")) == smallest(rows)
    assert found.agg(F.sum("n")).first()[0] == len(rows)


def test_columns_keep_their_order_and_type(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    assert keep_first(df, ["k", "t"]).dtypes == df.dtypes


def test_all_columns_may_be_keys(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(keep_first(df, ["k", "t", "x", "s"])) == rows_of(df.distinct())


def test_hot_key_is_reduced_before_the_shuffle(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    for found, reduced in ((keep_first(df, ["k", "t"], copies="n"), "partial_min"), (keep_first(df, ["k", "t"]), "Partial")):
        plan = plan_of(found)
        assert plan.count("Exchange") == 1
        assert plan.index(reduced) > plan.index("Exchange")  # printed from the top down


def test_both_forms_keep_the_same_rows(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert as_text(keep_first(df, ["k", "t"], ["x"])) == smallest(rows)


def test_key_counts(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    distinct = len({r[:2] for r in rows})
    assert tuple(key_counts(df, ["k", "t"]).first()) == (len(rows), distinct, len(rows) - distinct)
    assert tuple(key_counts(df.limit(0), ["k", "t"]).first()) == (0, 0, 0)
    assert "partial_count" in plan_of(key_counts(df, ["k", "t"]))


def test_null_keys_count_as_values(spark):
    df = spark.createDataFrame([(None, None), (None, None), ("a", None), ("a", None)], "k string, t long")
    assert key_counts(df, ["k", "t"]).first().distinct_keys == 2
    assert keep_first(df, ["k", "t"]).count() == 2
