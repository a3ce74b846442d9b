"""Python-exact rounding, exact distributed quantiles and prefix sums."""

import random

import pandas as pd
from pyspark.sql import functions as F

from roadpulse.functions.rounding import py_round
from roadpulse.operators.quantiles import exact_quantiles, prefix_before


def test_py_round_equals_python(spark):
    rnd = random.Random(7)
    vals = [j / 20 for j in range(-400, 400)] + [rnd.uniform(-1e4, 1e4) for _ in range(3000)]
    vals += [0.15, 0.25, 2.675, 1.005, 0.125, 2.5, 3.5, -0.5, 1e-9, 123456.785]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for nd in (0, 1, 2, 3):
        got = df.select("x", py_round(F.col("x"), nd).alias("r")).collect()
        assert all(r.r == round(r.x, nd) for r in got), nd


def test_exact_quantiles_equal_pandas(spark):
    rnd = random.Random(3)
    rows = [("hot" if rnd.random() < 0.9 else f"k{rnd.randint(0, 5)}", float(rnd.randint(0, 50)) / 4) for _ in range(5000)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r for r in exact_quantiles(df, "v", [0.1, 0.25, 0.5, 0.9], "g", buckets=16).collect()}
    pdf = pd.DataFrame(rows, columns=["g", "v"])
    for g, grp in pdf.groupby("g"):
        for p, name in [(0.1, "q10"), (0.25, "q25"), (0.5, "q50"), (0.9, "q90")]:
            assert abs(getattr(got[g], name) - grp.v.quantile(p)) < 1e-9


def test_prefix_before_strict(spark):
    rows = [(float(i % 37) / 7, 1) for i in range(2000)]
    df = spark.createDataFrame(rows, "s double, c long")
    out = prefix_before(df, "s", ["c"], buckets=8).collect()
    for r in out:
        assert r.c_before == sum(1 for x, _ in rows if x < r.s)


def test_buckets_hold_equal_shares_under_heavy_tails(spark):
    """One outlier of 1e12 and a heavy tail: the largest bucket stays within twice the mean, and quantiles are exact."""
    import numpy as np
    from pyspark.sql import functions as F

    from roadpulse.operators.quantiles import exact_quantiles, prefix_before, rank_buckets

    rng = np.random.default_rng(5)
    values = np.r_[rng.pareto(0.7, 20000), -rng.pareto(1.1, 5000), 1e12]
    df = spark.createDataFrame([(int(i % 3 == 0), float(v)) for i, v in enumerate(values)], "g int, v double").repartition(5)
    sizes = [r["count"] for r in rank_buckets(df, "v", "b", 256).groupBy("b").count().collect()]
    assert max(sizes) <= 2 * len(values) / 256 and len(sizes) >= 200
    got = exact_quantiles(df, "v", [0.1, 0.5, 0.99], ["g"], buckets=64).collect()
    for r in got:
        own = values[[int(i % 3 == 0) == r.g for i in range(len(values))]]
        assert np.allclose([r.q10, r.q50, r.q99], np.quantile(own, [0.1, 0.5, 0.99]), rtol=1e-12)
    few = df.withColumn("one", F.lit(1)).withColumn("v", F.round("v", 1))
    before = {r.v: r.one_before for r in prefix_before(few.groupBy("v").agg(F.sum("one").alias("one")), "v", ["one"], 64).collect()}
    rounded = np.array([r.v for r in few.select("v").collect()])
    assert all(before[v] == (rounded < v).sum() for v in list(before)[:200])
