"""Grouped forms (all product types at once) against one run per type, and
the parts they stand on: segmented ordinals, level-wise itemsets, rules by
consequent growth."""

import collections
import itertools
import random

import pytest
from pyspark.sql import functions as F

from servicelens.operators import demand, ordinal, rules
from servicelens.operators.itemsets import frequent_itemsets_by


def sets_of(df, by=("product_type",)):
    return {(*[r[c] for c in by], tuple(r["items"])): (r["freq"], round(r["support"], 12)) for r in df.collect()}


def baskets(spark, rows):
    return spark.createDataFrame(rows, "product_type string, order_id long, items array<string>")


def random_baskets(seed, sizes, vocabulary="abcdefgh"):
    rng = random.Random(seed)
    rows, order = [], 0
    for kind, n in sizes.items():
        weight = {x: rng.random() ** 2 for x in vocabulary}
        for _ in range(n):
            order += 1
            rows.append((kind, order, sorted(x for x in vocabulary if rng.random() < weight[x])))
    rng.shuffle(rows)
    return [r for r in rows if r[2]]


def brute_sets(rows, min_support):
    counts, totals = collections.Counter(), collections.Counter()
    for kind, _, items in rows:
        totals[kind] += 1
        for n in range(1, len(items) + 1):
            counts.update((kind, c) for c in itertools.combinations(items, n))
    return {k: (n, round(n / totals[k[0]], 12)) for k, n in counts.items() if n / totals[k[0]] >= min_support}


@pytest.mark.parametrize("seed,support", [(1, 0.2), (2, 0.05)])
def test_itemsets_equal_brute_force(spark, seed, support):
    rows = random_baskets(seed, {"T1": 300, "T2": 40, "T3": 1})
    assert sets_of(frequent_itemsets_by(baskets(spark, rows), support, ["product_type"])) == brute_sets(rows, support)


def test_itemsets_equal_fp_growth_per_type(spark):
    rows = random_baskets(5, {"T1": 200, "T2": 60})
    frame = baskets(spark, rows)
    grouped = sets_of(frequent_itemsets_by(frame, 0.1, ["product_type"]))
    single = {}
    for kind in ("T1", "T2"):
        found = rules.frequent_itemsets(frame.where(F.col("product_type") == kind), 0.1)
        single.update({(kind, *k): v for k, v in sets_of(found, ()).items()})
    assert grouped == single


def test_hot_item_spreads_over_tasks(spark):
    """An item in every basket of more than one bitmap bucket: its work is cut
    by bucket, and its counts are right."""
    n = 100_000
    frame = spark.range(n).select(
        F.lit("T").alias("product_type"),
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 2 == 0, F.array(F.lit("hot"), F.lit("even"))).otherwise(F.array(F.lit("hot"))).alias("items"),
    )
    frame = frame.withColumn("items", F.array_sort("items"))
    found = sets_of(frequent_itemsets_by(frame, 0.3, ["product_type"]))
    assert found == {("T", ("hot",)): (n, 1.0), ("T", ("even",)): (n // 2, 0.5), ("T", ("even", "hot")): (n // 2, 0.5)}


def test_itemsets_of_no_baskets(spark):
    assert frequent_itemsets_by(baskets(spark, []), 0.5, ["product_type"]).count() == 0


def rules_of(df, by=()):
    names = [*by, "antecedents", "consequents", "confidence", "lift", "zhang"]
    return sorted(tuple(tuple(r[c]) if isinstance(r[c], list) else (round(r[c], 9) if isinstance(r[c], float) else r[c]) for c in names) for r in df.collect())


@pytest.mark.parametrize("threshold", [0.0, 0.4, 0.8, 1.0])
def test_grown_rules_equal_every_split(spark, threshold):
    rows = random_baskets(7, {"T1": 150, "T2": 150}, "abcdef")
    sets = frequent_itemsets_by(baskets(spark, rows), 0.08, ["product_type"]).persist()
    grown = rules.association_rules(sets, "confidence", threshold, ("product_type",))
    every = rules.association_rules(sets, "support", 0.0, ("product_type",)).where(F.col("confidence") >= threshold)
    assert rules_of(grown, ("product_type",)) == rules_of(every, ("product_type",))
    alone = rules.association_rules(sets.where("product_type = 'T2'").drop("product_type"), "confidence", threshold)
    assert rules_of(alone) == [r[1:] for r in rules_of(grown, ("product_type",)) if r[0] == "T2"]


def test_growth_tests_few_splits_of_a_long_itemset(spark):
    """15 items that mostly occur without each other: 32,766 splits to enumerate."""
    names = [f"i{k:02d}" for k in range(15)]
    sets = []
    for n in range(1, 16):
        for c in itertools.combinations(names, n):
            sets.append((list(c), n, 0.01 if n == 15 else 0.5 / n))
    frame = spark.createDataFrame(sets, "items array<string>, size int, support double")
    tested = []
    levels = rules.consequent_levels(frame.where("size < 3 or size = 15 or size = 14"), 0.3, generated=tested)
    # all pairs hold at 0.25 / 0.5, the long set at none
    assert sum(level.count() for level in levels) > 0
    assert sum(tested) < 1000 < 2**15 - 2


def monthly_rows(seed):
    rng = random.Random(seed)
    rows = []
    for kind, parts in (("T1", 60), ("T2", 7), ("T3", 1)):
        for part in range(parts):
            for month in range(rng.randint(1, 20)):
                if rng.random() < 0.7:
                    rows.append((kind, f"K{part}", f"{2000 + month // 12}-{month % 12 + 1:02d}-15", float(rng.randint(1, 9))))
    return rows


def test_grouped_demand_equals_single_runs(spark):
    rows = spark.createDataFrame(monthly_rows(3), "product_type string, part_no string, d string, quantity double")
    rows = rows.withColumn("d_goods_out", F.to_date("d")).persist()
    grouped = demand.demand_dataset(rows, 0.5, 3, ("product_type",)).persist()
    columns = ["part_no", "target_month", "sample_idx", "split", "inputs", "target"]
    assert grouped.count() > 0
    for kind in ("T1", "T2", "T3"):
        alone = demand.demand_dataset(rows.where(F.col("product_type") == kind), 0.5, 3).select(*columns).collect()
        mine = grouped.where(F.col("product_type") == kind).select(*columns).collect()
        assert sorted(map(tuple, alone), key=str) == sorted(map(tuple, mine), key=str)


def test_grouped_quantile_with_ties_and_a_hot_group(spark):
    import numpy as np

    rng = random.Random(4)
    values = {"hot": [rng.choice([1.0, 1.0, 1.0, 2.5, -3.0]) for _ in range(3000)], "one": [7.0], "two": [1.0, 2.0], None: [5.0, 6.0, 9.0]}
    frame = spark.createDataFrame([(k, v) for k, vs in values.items() for v in vs] + [("two", None)], "g string, x double")
    for q in (0.0, 0.25, 0.9, 1.0):
        got = {r.g: r["quantile"] for r in demand.exact_quantile(frame, "x", q, ("g",)).collect()}
        assert got == {k: pytest.approx(float(np.quantile(vs, q))) for k, vs in values.items()}


@pytest.mark.parametrize("rows", [[], [("a", 1)], [(None, 2), (None, 1), ("", 3)]])
def test_segmented_ordinals_of_small_tables(spark, rows):
    out = ordinal.segmented_ordinal(spark.createDataFrame(rows, "g string, x int"), ["g"], ["x"], "at", total="n").collect()
    got = sorted((str(r.g), r.x, r["at"], r.n) for r in out)
    want, seen = [], collections.Counter()
    sizes = collections.Counter(g for g, _ in rows)
    for g, x in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        want.append((str(g), x, seen[g], sizes[g]))
        seen[g] += 1
    assert got == want


def test_segmented_ordinals_of_a_hot_segment(spark):
    frame = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(-1).alias("g"), F.xxhash64("id").alias("x"))
    out = ordinal.segmented_ordinal(frame.repartition(7), ["g"], ["x"], "at", base=1, total="n").toPandas()
    ranks = out.sort_values("x").groupby("g").cumcount() + 1
    assert (out.sort_values("x")["at"] == ranks).all() and (out.groupby("g")["x"].transform("size") == out["n"]).all()
