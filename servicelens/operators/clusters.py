"""Part clustering by quantity and frequency, critical parts.

Per part: total quantity and number of orders using it (one hash aggregate).
k-means runs for k = 2..10 on the unscaled two features, all k (and, grouped, all
product types) in the same passes (``operators.kmeans``); each run ends by
its tolerance and is scored by the squared-Euclidean silhouette in its linear
form (the original's Euclidean one needs all point pairs).  The first k with the
best score wins, and its centres give the labels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from servicelens import schema as S
from servicelens.functions.dates import parse_arg_date
from servicelens.operators import kmeans
from servicelens.plans import physical

FEATURES = ("quantity", "frequency")
TOLERANCE = 1e-4


def part_features(rows: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Quantity, frequency (distinct orders) and first-seen name per part (of
    each group of ``by``) (M7, A6, A8, A9).  Where one position of an order
    names a part twice, the least name is the first."""
    return rows.groupBy(*by, "part_no").agg(
        F.min_by("part_name", F.struct("order_id", "position", "part_name")).alias("part_name"),
        F.sum("quantity").cast("double").alias("quantity"),
        F.countDistinct("order_id").cast("long").alias("frequency"),
    )


def swept_runs(
    features: DataFrame, k_range=S.DEFAULT_K_RANGE, tolerance: float = TOLERANCE, by: tuple[str, ...] = ()
) -> DataFrame:
    """Finished runs (by, k, centres, silhouette, chosen) of every k of the
    range that is below the (group's) number of parts; ``chosen`` marks the
    first k of the best score (M9-M11, O4)."""
    points = physical.materialize(kmeans.weighted_points(features, by), "points")
    out = None
    for some in kmeans.group_slices(points, k_range[1], by):
        runs, _ = kmeans.fit(some, kmeans.starting_runs(some, tuple(k_range), by), tolerance, by)
        scores = kmeans.silhouettes(some, runs, by)
        best: dict[tuple, tuple] = {}
        for (group, k), score in scores.items():
            best[group] = max(best.get(group, (float("-inf"), 0)), (score, -k))
        table = kmeans.run_table(some, runs, by)
        verdicts = [(*r.group, r.k, scores[r.group, r.k], best[r.group] == (scores[r.group, r.k], -r.k)) for r in runs]
        fields = [*[some.schema[c] for c in by], table.schema["k"], T.StructField("silhouette", T.DoubleType()), T.StructField("chosen", T.BooleanType())]
        table = table.join(kmeans.local_rows(points.sparkSession, verdicts, T.StructType(fields)), [*by, "k"])
        out = table if out is None else out.unionByName(table)
    if out is None:  # no group
        out = kmeans.run_table(points, [], by).select("*", F.lit(0.0).alias("silhouette"), F.lit(True).alias("chosen"))
    return physical.materialize(out, "runs")


def _runs(features: DataFrame, k_range, tolerance: float, by: tuple[str, ...]) -> DataFrame:
    runs = swept_runs(features, k_range, tolerance, by)
    if not by and runs.isEmpty():
        raise ValueError("clustering needs at least 3 parts")
    return runs


def _scores(runs: DataFrame, by: tuple[str, ...]) -> DataFrame:
    return runs.select(*by, "k", "silhouette", "chosen").orderBy(*by, "k")


def k_sweep(features: DataFrame, k_range=S.DEFAULT_K_RANGE, tolerance: float = TOLERANCE, by: tuple[str, ...] = ()) -> DataFrame:
    """Silhouette per k (M10, M11) with a ``chosen`` flag on the first k of
    the best score (O4), for each group of ``by``.  k ends at parts - 1, the largest that a
    silhouette is defined for, and at the number of different feature rows.
    Fewer than 3 parts is an error (no k >= 2 can be scored); grouped, such a
    group has no row."""
    return _scores(_runs(features, k_range, tolerance, by), by)


def fit_clusters(features: DataFrame, k: int, tolerance: float = TOLERANCE) -> tuple[DataFrame, DataFrame]:
    """Fit k-means with ``k`` clusters: (parts with ``cluster``, centres)."""
    runs = _runs(features, (k, k), tolerance, ())
    return kmeans.labelled(features, runs), kmeans.centre_rows(runs)


def cluster_parts(features: DataFrame, k_range=S.DEFAULT_K_RANGE, tolerance: float = TOLERANCE, by: tuple[str, ...] = ()):
    """Sweep and pick k (M11, M12): (labelled parts, centres, scores).  The
    labels are those of the very centres that won the sweep.

    The part table is written to the checkpoint folder once and shared by the
    sweep and the labelling."""
    features = physical.materialize(features)
    runs = _runs(features, k_range, tolerance, by)
    chosen = runs.where("chosen")
    labelled = physical.materialize(kmeans.labelled(features, chosen, by), "labelled")
    return labelled, kmeans.centre_rows(chosen, by), _scores(runs, by)


def cluster_facts(labelled: DataFrame, centres: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """What must hold of any finished clustering, whatever its labels: per part
    whether its own centre is the nearest one, and whether its own centre is
    the mean of its members (up to ``tolerance`` of the spread of the values).

    The centres (as many as k) are broadcast."""
    means = labelled.groupBy("cluster").agg(*[F.avg(c).alias(f"mean_{c}") for c in FEATURES])
    spread = labelled.agg(*[(F.max(c) - F.min(c) + 1).alias(f"spread_{c}") for c in FEATURES])
    own = centres.join(means, "cluster").crossJoin(F.broadcast(spread))
    close = [F.abs(F.col(c) - F.col(f"mean_{c}")) <= tolerance * F.col(f"spread_{c}") for c in FEATURES]
    own = own.select("cluster", (close[0] & close[1]).alias("centre_is_mean"))
    all_centres = centres.agg(F.collect_list(F.struct("cluster", *FEATURES)).alias("__centres"))
    square = lambda x: x * x
    distance = lambda c: square(c["quantity"] - F.col("quantity")) + square(c["frequency"] - F.col("frequency"))
    least = F.array_min(F.transform("__centres", distance))
    mine = F.element_at(F.transform(F.filter("__centres", lambda c: c["cluster"] == F.col("cluster")), distance), 1)
    held = labelled.crossJoin(F.broadcast(all_centres)).withColumn("own_centre_nearest", mine <= least * (1 + tolerance) + tolerance)
    return held.drop("__centres").join(F.broadcast(own), "cluster")


def critical_parts(features: DataFrame, n: int = S.DEFAULT_TOP_N) -> DataFrame:
    """Parts whose *name* is among the names of the top ``n`` parts by
    (quantity, frequency) (M13: O3, F10); may return more than ``n``.  The
    features are written once: the top list and the result both read them."""
    features = physical.materialize(features, "features")
    top = features.orderBy(F.col("quantity").desc(), F.col("frequency").desc(), F.col("part_no")).limit(n)
    return features.join(top.select("part_name").distinct(), "part_name", "left_semi")


def critical_list(labelled: DataFrame, n: int = S.DEFAULT_TOP_N) -> DataFrame:
    """Part number, name and cluster of the critical parts."""
    return critical_parts(labelled, n).select("part_no", "part_name", "cluster")


def with_period(df: DataFrame, product_type: str, start, end) -> DataFrame:
    """The report's period and product type as first columns."""
    day = lambda d: F.lit(parse_arg_date(d))
    return df.select(day(start).alias("start_date"), day(end).alias("end_date"), F.lit(product_type).alias("product_type"), *df.columns)


def translate_names(df: DataFrame, translations=None, name_col: str = "part_name") -> DataFrame:
    """English part names, falling back to the original (P11, J6).  The
    lookup is a literal table; its size decides whether it is broadcast."""
    translations = translations if translations is not None else S.PART_NAME_TRANSLATIONS
    import pandas as pd

    spark = df.sparkSession
    pairs = pd.DataFrame(list(translations.items()) or [("", "")], columns=[name_col, "__en"])
    lookup = spark.createDataFrame(pairs, f"{name_col} string, __en string")
    return df.join(lookup, name_col, "left").withColumn(
        "english_name", F.coalesce(F.col("__en"), F.col(name_col))
    ).drop("__en")


def scatter_table(labelled: DataFrame, n: int = S.DEFAULT_TOP_N, translations=None) -> DataFrame:
    """Parts with cluster, critical flag and English name."""
    crit = critical_parts(labelled, n).select("part_no", F.lit(True).alias("is_critical"))
    out = labelled.join(crit, "part_no", "left").withColumn("is_critical", F.coalesce("is_critical", F.lit(False)))
    return translate_names(out, translations)
