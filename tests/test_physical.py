"""Materialised tables leave no shuffle files behind."""

import time

from servicelens.plans.physical import SHUFFLE_CLEANUP, materialize


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for k in range(files.size()) if (name := files.apply(k).getName()).startswith("shuffle_")}


def test_shuffle_files_go_with_the_write(spark):
    before = shuffle_files(spark)
    table = materialize(spark.range(20_000).selectExpr("id % 999 k").groupBy("k").count())
    for _ in range(50):  # removed by another thread
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left
    assert table.count() == 999 and table.agg({"count": "sum"}).first()[0] == 20_000
    assert spark.conf.get(SHUFFLE_CLEANUP, None) is None


def test_a_frame_is_read_again_after_the_write(spark):
    df = spark.range(5_000).selectExpr("id % 37 k").groupBy("k").count()
    rows = sorted(df.collect())
    materialize(df)
    assert sorted(df.collect()) == rows
    spark.conf.set(SHUFFLE_CLEANUP, "false")
    try:
        assert sorted(materialize(df).collect()) == rows
        assert spark.conf.get(SHUFFLE_CLEANUP) == "false"
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP)
