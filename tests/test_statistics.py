import random

import pytest
from pyspark.sql import functions as F

from locuswave.operators import nulls, ranking
from tests import brute
from tests.conftest import rows

M5 = {1.0: 6, 2.0: 3, 4.0: 1}


def null_of(spark, values, name="n"):
    return spark.createDataFrame([(name, float(k), v) for k, v in values.items()], "null_id string, stat double, cnt long")


def ps(spark, null, xs):
    probes = spark.createDataFrame([("n", float(x)) for x in xs], "null_id string, stat double")
    return {r.stat: r.p for r in nulls.p_value_table(null_of(spark, null), probes).collect()}


def test_every_branch(spark):
    got = ps(spark, M5, [0.5, 1, 1.5, 2, 3, 4, 9])
    assert got == pytest.approx({0.5: 1, 1: 1, 1.5: 0.7, 2: 0.4, 3: 0.25, 4: 0.1, 9: 0.1})


def test_thresholds(spark):
    got = nulls.thresholds(null_of(spark, M5), {"a": 1.0, "b": 0.25, "c": 0.1, "d": 0.05})
    assert {r.name: r.value for r in got.collect()} == pytest.approx({"a": 1, "b": 3, "c": 4, "d": 4})


def test_single_value_null(spark):
    assert ps(spark, {2.0: 5}, [1, 2, 3]) == pytest.approx({1: 1.0, 2: 1.0, 3: 0.2})


def test_random_nulls_against_counting(spark):
    rng = random.Random(4)
    null = {round(rng.expovariate(0.2), 6): rng.randrange(1, 50) for _ in range(300)}
    xs = [round(rng.uniform(-1, 60), 6) for _ in range(300)] + list(null)[:50]
    got = ps(spark, null, xs)
    for x in xs:
        assert got[round(x, 6)] == pytest.approx(brute.p_value(null, x), abs=1e-15)
    levels = {str(p): p for p in (0.9, 0.5, 0.1, 0.01, 1e-6)}
    for r in nulls.thresholds(null_of(spark, null), levels).collect():
        assert r.value == pytest.approx(brute.threshold(null, r.p))
    ordered = [got[x] for x in sorted(got)]
    assert ordered == sorted(ordered, reverse=True)


def test_value_with_most_rows_is_looked_up_once(spark):
    hot = spark.range(3000).select(F.lit("n").alias("null_id"), F.when(F.col("id") % 3 == 0, F.lit(1.5)).otherwise(
        F.col("id") / 100.0).alias("x"))
    got = nulls.with_p_value(hot, null_of(spark, M5), F.col("x"), "null_id", "p")
    assert got.count() == 3000
    assert got.filter("x = 1.5 and abs(p - 0.7) > 1e-12").count() == 0


def test_histogram_overwrite(spark):
    hist = spark.createDataFrame([("g", 3.0, 1.0, 4), ("g", 2.9999999, 1.0, 7)], "grp string, total double, mean double, cnt long")
    assert nulls.null_from_histogram(hist).first().cnt == 11
    assert nulls.null_from_histogram(hist, overwrite=True).first().cnt == 7


@pytest.mark.parametrize("flagged", [True, False])
def test_rank_starts_at_zero_only_with_the_flag(spark, flagged):
    df = spark.createDataFrame([("g", "c", 5, 2.0, flagged), ("g", "c", 1, 2.0, False), ("g", "c", 2, 9.0, False)],
                               "grp string, chrom string, pos long, s double, hit boolean")
    ranked = ranking.rank_from_zero_if(
        ranking.ordinal(df, ["grp"], [F.desc("hit"), F.desc("s"), F.asc("pos")]), ["grp"], "hit", "ordinal", "rank")
    expected = [(1, 2), (2, 1), (5, 0)] if flagged else [(1, 2), (2, 1), (5, 3)]
    assert rows(ranked.select("pos", "rank")) == expected


def test_rank_of_a_dominant_group_over_many_partitions(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, F.lit("x")).otherwise(F.lit("hot")).alias("g"), F.lit(1.0).alias("s"), "id")
    got = ranking.ordinal(df, ["g"], [F.desc("s"), F.asc("id")])
    expected = {}
    for i in range(5000):
        expected.setdefault("x" if i % 3 == 0 else "hot", []).append(i)
    assert rows(got.select("g", "id", "ordinal")) == sorted(
        (g, i, k) for g, ids in expected.items() for k, i in enumerate(ids, 1))
