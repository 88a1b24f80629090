"""Order statistics by radix refinement."""

import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from servicelens.operators.selection import exact_quantile, ordered_bits

EDGES = [0.0, -0.0, 1.0, -1.0, 2.0, 1.9999999999999998, 2.0000000000000004, 0.5, 0.49999999999999994, 1e-308, 5e-324, -5e-324,
         2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, float("inf"), float("-inf"), 8.0, 7.999999999999999,
         9007199254740993.0, 3e-310, 2.0**1023, 2.0**-1022, 2.0**-1074 * 3]


def ieee(v):
    bits = struct.unpack(">q", struct.pack(">d", abs(v)))[0]
    return -bits if v < 0 else bits


def test_bits_are_the_ieee_ones(spark):
    rng = random.Random(1)
    values = EDGES + [struct.unpack(">d", rng.randbytes(8))[0] for _ in range(4000)] + [2.0**e for e in range(-1074, 1024)]
    values = [v for v in values if v == v]
    out = spark.createDataFrame([(v,) for v in values], "v double").select("v", ordered_bits(F.col("v")).alias("b"))
    assert all(r.b == ieee(r.v) for r in out.collect())


@pytest.mark.parametrize("q", [0.0, 0.1, 0.5, 0.9, 0.975, 1.0])
def test_quantiles_equal_sorting(spark, q):
    rng = random.Random(5)
    groups = {
        "hot": [rng.choice([1.0, 1.0, 2.5]) for _ in range(3000)],
        "wide": [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(501)],
        "close": [1.0 + k * 2.0**-52 for k in range(200)],
        "one": [7.0],
        None: [5.0, -6.0],
    }
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("one", None), ("one", float("nan")), ("none", None)]
    frame = spark.createDataFrame(rows, "g string, x double")
    got = {r.g: r["quantile"] for r in exact_quantile(frame, "x", q, ("g",)).collect()}
    assert got == {k: pytest.approx(float(np.quantile(vs, q)), rel=1e-12) for k, vs in groups.items()}
    alone = exact_quantile(frame.where("g = 'hot'"), "x", q).collect()
    assert [r["quantile"] for r in alone] == [pytest.approx(float(np.quantile(groups["hot"], q)))]


def test_no_values_no_quantile(spark):
    frame = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    assert exact_quantile(frame, "x", 0.5).count() == 0


def test_plan_has_no_range_sort_and_writes_nothing(spark):
    frame = spark.range(1000).selectExpr("cast(id as double) as x")
    plan = exact_quantile(frame, "x", 0.9)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Scan parquet" not in plan
