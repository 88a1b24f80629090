"""The fused k-means against plain loops over the same first centres."""

import random

import numpy as np
import pytest

from servicelens.operators import clusters, kmeans

SCHEMA = "product_type string, part_no string, part_name string, quantity double, frequency long"


def features(spark, seed, sizes):
    rng = random.Random(seed)
    rows = []
    for kind, n in sizes.items():
        for i in range(n):
            centre = rng.choice([5, 40, 90])
            rows.append((kind, f"{kind}-{i}", "n", float(centre + rng.randint(0, 9)), rng.randint(1, 6)))
    return spark.createDataFrame(rows, SCHEMA)


def lloyd(x, centres, tolerance=clusters.TOLERANCE):
    centres = np.array(centres)
    while True:
        near = ((x[:, None] - centres) ** 2).sum(-1).argmin(1)
        new = np.array([x[near == i].mean(0) if (near == i).any() else c for i, c in enumerate(centres)])
        if ((new - centres) ** 2).sum(-1).max() <= tolerance**2:
            return new
        centres = new


def silhouette(x, centres):
    """Mean squared-Euclidean silhouette from all pairs."""
    near = ((x[:, None] - centres) ** 2).sum(-1).argmin(1)
    d = ((x[:, None] - x[None]) ** 2).sum(-1)
    out = []
    for i, own in enumerate(near):
        if (near == own).sum() == 1 or len(set(near)) == 1:
            out.append(0.0)
            continue
        a = d[i, near == own].sum() / ((near == own).sum() - 1)
        b = min(d[i, near == c].mean() for c in set(near) - {own})
        out.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return float(np.mean(out))


def test_runs_equal_plain_loops(spark):
    frame = features(spark, 2, {"T1": 120, "T2": 9, "T3": 2})
    by = ("product_type",)
    points = kmeans.weighted_points(frame, by).persist()
    start = kmeans.starting_runs(points, (2, 6), by)
    assert sorted({(r.group[0], r.k) for r in start}) == [("T1", k) for k in range(2, 7)] + [("T2", k) for k in range(2, 7)]
    done, left = kmeans.fit(points, start, clusters.TOLERANCE, by)
    scores = kmeans.silhouettes(points, done, by)
    assert not left and len(done) == len(start)
    pdf = frame.toPandas()
    first = {(r.group, r.k): r.centres for r in start}
    for run in done:
        x = pdf[pdf.product_type == run.group[0]][["quantity", "frequency"]].to_numpy(float)
        assert np.allclose(run.centres, lloyd(x, first[run.group, run.k]))
        assert scores[run.group, run.k] == pytest.approx(silhouette(x, np.array(run.centres)))


def test_centres_for_all_k_start_alike_and_differ(spark):
    points = kmeans.weighted_points(features(spark, 3, {"T": 80}))
    runs = kmeans.starting_runs(points, (2, 7))
    longest = runs[-1].centres
    assert len(set(longest)) == 7 and all(r.centres == longest[: r.k] for r in runs)


def test_a_fit_goes_on_from_written_centres(spark):
    points = kmeans.weighted_points(features(spark, 5, {"T": 150})).persist()
    start = kmeans.starting_runs(points, (2, 8))
    whole, _ = kmeans.fit(points, start, 0.0)
    some, left = kmeans.fit(points, start, 0.0, iterations=2)
    assert left
    more, none = kmeans.fit(points, kmeans.runs_of(kmeans.run_table(points, left)), 0.0)
    assert not none and sorted(some + more) == sorted(whole)


def test_sweeps_by_type_equal_single_sweeps(spark, monkeypatch):
    frame = features(spark, 7, {"T1": 60, "T2": 25, "T3": 4, "T4": 1})
    monkeypatch.setattr(kmeans, "LOCAL_CENTRES", 150)  # one or two groups a slice
    grouped = {(r.product_type, r.k): (round(r.silhouette, 9), r.chosen) for r in clusters.k_sweep(frame, by=("product_type",)).collect()}
    single = {}
    for kind in ("T1", "T2", "T3"):
        for r in clusters.k_sweep(frame.where(f"product_type = '{kind}'")).collect():
            single[kind, r.k] = (round(r.silhouette, 9), r.chosen)
    assert grouped == single
    with pytest.raises(ValueError):
        clusters.k_sweep(frame.where("product_type = 'T4'"))


def test_equal_parts_are_one_point(spark):
    frame = spark.createDataFrame([("T", f"p{i}", "n", float(i // 50), 1) for i in range(100)], SCHEMA)
    assert [r.k for r in clusters.k_sweep(frame).collect()] == [2]
    labelled, centres, _ = clusters.cluster_parts(frame)
    assert labelled.groupBy("cluster").count().select("count").collect() == [(50,), (50,)] and centres.count() == 2


def test_missing_and_non_finite_features_are_left_out(spark):
    rows = [("T", f"p{i}", "n", float(i), 1) for i in range(6)] + [("T", "a", "n", None, 1), ("T", "b", "n", float("nan"), 1), ("T", "c", "n", float("inf"), 1)]
    points = kmeans.weighted_points(spark.createDataFrame(rows, SCHEMA))
    assert sorted(r.x for r in points.collect()) == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0]
