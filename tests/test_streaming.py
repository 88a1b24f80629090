import tempfile

from pyspark.sql import functions as F

from servicelens.operators import prepare
from servicelens.sources import csv as csvio
from servicelens.sources import driver_tables as dt
from servicelens.streaming import ingest

from conftest import SF_SMALL


def test_incremental_ingest_equals_batch(spark):
    base = tempfile.mkdtemp(prefix="servicelens-stream-")
    raw = dt.raw_position_view(spark, SF_SMALL)
    first = raw.where(F.col("SERVICEAUFTRAG").cast("long") % 2 == 0)
    second = raw.where(F.col("SERVICEAUFTRAG").cast("long") % 2 == 1)
    csvio.write_csv(first, f"{base}/landing/a", sep=";")
    q = ingest.start_ingest(spark, f"{base}/landing/*", f"{base}/stage", f"{base}/ckpt")
    q.awaitTermination()
    csvio.write_csv(second, f"{base}/landing/b", sep=";")
    q = ingest.start_ingest(spark, f"{base}/landing/*", f"{base}/stage", f"{base}/ckpt")
    q.awaitTermination()
    got = ingest.read_ingested(spark, f"{base}/stage").drop("batch_id")
    want, _ = prepare.clean_positions(raw)
    key = lambda df: sorted(tuple(str(x) for x in r) for r in df.select(*sorted(df.columns)).collect())
    assert key(got) == key(want)
    assert spark.read.parquet(f"{base}/stage/positions").select("batch_id").distinct().count() == 2


def test_header_stream_quarantines_unparsed_dates(spark):
    base = tempfile.mkdtemp(prefix="servicelens-stream-h-")
    raw = dt.raw_header_view(spark, SF_SMALL)
    csvio.write_csv(raw, f"{base}/landing/a", sep=";")
    q = ingest.start_ingest(spark, f"{base}/landing/*", f"{base}/stage", f"{base}/ckpt", kind="headers")
    q.awaitTermination()
    got = ingest.read_ingested(spark, f"{base}/stage", "headers").drop("batch_id")
    want, bad = prepare.clean_headers(raw)
    assert got.count() == want.count() > 0
    stream_bad = spark.read.parquet(f"{base}/stage/headers_quarantine")
    assert stream_bad.count() == bad.count() > 0
    assert {r.reject_reason for r in stream_bad.select("reject_reason").distinct().collect()} == {"unparsed_date", "bad_address"}
