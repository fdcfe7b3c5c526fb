"""Distributed order primitives against plain Python."""

import numpy as np
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from ebbtide.functions.ordered import exact_quantiles, ranked, running_totals


def test_running_totals_match_cumsum(spark):
    rng = np.random.default_rng(3)
    rows = [(g, float(v), int(rng.integers(0, 9))) for g in "ab" for v in rng.permutation(400)[:250]]
    frame = spark.createDataFrame(rows, "g string, v double, n bigint")
    out = running_totals(frame, ["v"], {"n": "cum"}, ["g"]).collect()
    assert len(out) == len(rows)
    for g in "ab":
        expected, total = {}, 0
        for _, v, n in sorted(r for r in rows if r[0] == g):
            total += n
            expected[v] = total
        assert {r.v: r.cum for r in out if r.g == g} == expected


def test_null_group_keeps_its_rows(spark):
    frame = spark.createDataFrame([(None, 1.0, 2), (None, 2.0, 3), ("x", 1.0, 5)], "g string, v double, n bigint")
    out = running_totals(frame, ["v"], {"n": "cum"}, ["g"])
    assert sorted((r.g or "", r.v, r.cum) for r in out.collect()) == [("", 1.0, 2), ("", 2.0, 5), ("x", 1.0, 5)]


def test_rank_is_a_permutation_of_positions(spark):
    frame = spark.range(3000).select(F.xxhash64("id").alias("h"))
    out = ranked(frame, ["h"]).orderBy("h").select("rank").collect()
    assert [r["rank"] for r in out] == list(range(1, 3001))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=60))
def test_quantiles_match_numpy(spark, values):
    frame = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = exact_quantiles(frame, "v", [(i, 10) for i in range(11)]).collect()[0]
    assert got.n == len(values)
    assert np.allclose(got.quantiles, np.quantile(values, np.linspace(0, 1, 11)))


def test_quantiles_ignore_nulls_and_nan(spark):
    frame = spark.createDataFrame([("a", 1.0), ("a", None), ("a", float("nan")), ("a", 3.0), ("b", 7.0)], "g string, v double")
    got = {r.g: (r.n, list(r.quantiles)) for r in exact_quantiles(frame, "v", [(1, 2)], ["g"]).collect()}
    assert got == {"a": (2, [2.0]), "b": (1, [7.0])}


def test_one_value_with_most_rows(spark):
    frame = spark.range(3000).select(F.when(F.col("id") < 2500, 5.0).otherwise(F.col("id").cast("double")).alias("v"))
    values = [5.0] * 2500 + [float(i) for i in range(2500, 3000)]
    got = exact_quantiles(frame, "v", [(1, 2), (9, 10)]).collect()[0].quantiles
    assert np.allclose(got, np.quantile(values, [0.5, 0.9]))
