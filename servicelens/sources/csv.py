"""CSV in and out, delimiter profiling, stage tables.

Raw exports are read with every column as text (``schema.HEADER_SCHEMA`` /
``POSITION_SCHEMA`` or all-string by header); typing happens in
``operators.prepare.clean_*`` where bad cells go to a quarantine frame
instead of failing the job.
"""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from servicelens.plans import physical

CANDIDATE_DELIMITERS = (";", ",", "\t", "|")


def _occurrences(line: Column, ch: str) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(ch), F.lit("")))


def delimiter_profile(lines: DataFrame, candidates=CANDIDATE_DELIMITERS, col: str = "value") -> DataFrame:
    """Per candidate delimiter: occurrences per line (min, max, total) over
    all non-empty lines, whether the count is the same on every line, and the
    choice (S2): the consistent candidate with the most occurrences per line,
    else the one with the highest mean.  One distributed aggregate; quoted
    cells are taken out first.
    """
    bare = F.regexp_replace(F.col(col), '"(?:[^"]|"")*"', "")
    text = lines.select(F.col(col).alias("whole"), bare.alias("line")).where(F.length("whole") > 0)
    aggs = []
    for i, ch in enumerate(candidates):
        n = _occurrences(F.col("line"), ch)
        aggs += [F.min(n).alias(f"mn{i}"), F.max(n).alias(f"mx{i}"), F.sum(n).alias(f"sm{i}")]
    stats = text.agg(F.count(F.lit(1)).alias("lines"), *aggs)  # one row, one pass
    per_candidate = F.array(
        *[
            F.struct(
                F.lit(ch).alias("delimiter"),
                F.lit(i).alias("candidate_ord"),
                F.col("lines").cast("long").alias("lines"),
                F.col(f"mn{i}").cast("long").alias("min_count"),
                F.col(f"mx{i}").cast("long").alias("max_count"),
                F.col(f"sm{i}").cast("long").alias("total_count"),
            )
            for i, ch in enumerate(candidates)
        ]
    )
    prof = stats.select(F.explode(per_candidate).alias("c")).select("c.*")
    prof = prof.withColumn("consistent", (F.col("min_count") == F.col("max_count")) & (F.col("min_count") > 0))
    # Rank: consistent first, then per-line count, then candidate order.  The
    # window spans only the candidate rows (four by default).
    w = Window.orderBy(F.col("consistent").desc(), F.col("total_count").desc(), "candidate_ord")
    return prof.withColumn("chosen", F.row_number().over(w) == 1)


def sniff_delimiter(spark: SparkSession, path: str, candidates=CANDIDATE_DELIMITERS, encoding: str = "UTF-8") -> str:
    """The chosen delimiter of a text file or folder (S2); reads it once."""
    lines = spark.read.option("encoding", encoding).text(path)
    row = delimiter_profile(lines, candidates).where("chosen").first()
    if row is None or row["max_count"] == 0:
        raise ValueError(f"no delimiter found in {path}")
    return row["delimiter"]


def split_records(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """The records of CSV files as text (record, is_header), where quoted cells
    may hold line breaks; files are read in splits.

    Whether a line break stands inside quotes depends on the number of quotes
    before it.  Each block (split) of a file adds up its quotes, a running
    parity over the blocks tells how each one begins, and a running count inside the
    block does the rest: a line that begins outside quotes begins a record.
    Lines that are records by themselves stay where they are; only the pieces
    of longer records are brought together, also across blocks.  No task holds
    more than a block, and the windows over blocks one row for each.  Records come in no order.

    A cell that holds a quote must be quoted (with its quotes doubled), as in
    the files that ``write_csv`` writes.  Line breaks of any kind become ``\\n``.
    """
    lines = spark.read.option("encoding", encoding).text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
    )
    lines = physical.materialize(lines.withColumn("quotes", _occurrences(F.col("value"), '"')), "csv-lines")
    blocks = lines.groupBy("file", "block").agg(F.sum("quotes").alias("n"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("file", "block").orderBy("at")
    count = F.col("before") + F.coalesce(F.sum("quotes").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    lines = lines.join(blocks, ["file", "block"]).withColumn("count", count)
    lines = lines.withColumn("begins", F.col("count") % 2 == 0).withColumn("ends", (F.col("count") + F.col("quotes")) % 2 == 0)
    number = F.sum(F.col("begins").cast("int")).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    lines = physical.materialize(lines.withColumn("number", number), "csv-records")
    # a block's first lines can belong to the last record of an earlier block
    last = lines.groupBy("file", "block").agg(F.max("number").alias("most"))
    known = F.last(F.when(F.col("most") > 0, F.struct("block", "most")), ignorenulls=True).over(earlier)
    last = last.select("file", "block", known.alias("open"))
    alone = F.col("begins") & F.col("ends")
    header = (F.col("block") == 0) & (F.col("number") == 1)
    whole = lines.where(alone).select(F.col("value").alias("record"), header.alias("is_header"))
    pieces = lines.where(~alone).join(last, ["file", "block"])
    own = F.when(F.col("number") > 0, F.struct("block", F.col("number").alias("most"))).otherwise(F.col("open"))
    pieces = pieces.groupBy("file", own.alias("record")).agg(F.sort_array(F.collect_list(F.struct("block", "at", "value"))).alias("lines"))
    header = (F.col("record.block") == 0) & (F.col("record.most") == 1)
    joined = pieces.select(F.array_join("lines.value", "\n").alias("text"), header.alias("is_header"))
    return joined.withColumnRenamed("text", "record").unionByName(whole)


def _read_records(spark: SparkSession, path: str, sep: str, encoding: str, schema: T.StructType | None, ragged: str | None) -> DataFrame:
    """``read_csv`` over ``split_records``."""
    records = split_records(spark, path, encoding)
    options = {"sep": sep, "escape": '"', "mode": "PERMISSIVE", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    headers = [r["record"] for r in records.where("is_header").select("record").distinct().limit(2).collect()]
    if len(headers) > 1:
        raise ValueError(f"the files of {path} have different headers")
    if schema is None:
        if not headers:
            raise ValueError(f"no header in {path}")
        cells = next(csv.reader([headers[0].removeprefix("\ufeff")], delimiter=sep))
        schema = T.StructType([T.StructField(c.strip(), T.StringType(), True) for c in cells])
    fields = list(schema.fields)
    kept = [f.name for f in fields]
    if ragged:
        fields.append(T.StructField(ragged, T.StringType(), True))
        options["columnNameOfCorruptRecord"] = ragged
        kept.append(ragged)
    rows = records.where(~F.col("is_header") & (F.length("record") > 0))
    parsed = rows.select(F.from_csv("record", T.StructType(fields).toDDL(), options).alias("row"))
    return parsed.select(*[F.col("row").getField(name).alias(name) for name in kept])


def read_csv(
    spark: SparkSession,
    path: str,
    sep: str | None = None,
    encoding: str = "UTF-8",
    schema: T.StructType | None = None,
    multi_line: bool = False,
    ragged: str | None = None,
) -> DataFrame:
    """Header CSV as all-string columns (S1, S3).  ``sep=None`` profiles the
    file for its delimiter first (S2).  Empty cells are kept as empty text so
    the missing-marker rules (S4) see them; nothing is inferred.

    Quotes inside a quoted cell are doubled.  ``multi_line`` allows line
    breaks in quoted cells (``split_records``).  ``ragged``
    names an extra column that holds the text of rows with too many or too
    few cells (null for whole rows).  All files must have the first one's
    header: another order or name is an error, not a shift of columns."""
    sep = sep or sniff_delimiter(spark, path, encoding=encoding)
    if multi_line:
        return _read_records(spark, path, sep, encoding, schema, ragged)
    reader = (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("mode", "PERMISSIVE")
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
    if schema is None:
        raw = reader.csv(path).columns  # all text: reads the header only
        names = [c.removeprefix("\ufeff").strip().strip('"') for c in raw]
        schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names])
        # a header with a byte-order mark or blanks cannot be held against the names
        reader = reader.option("enforceSchema", names != raw)
    if ragged:
        schema = T.StructType([*schema.fields, T.StructField(ragged, T.StringType(), True)])
        reader = reader.option("columnNameOfCorruptRecord", ragged)
    return reader.schema(schema).csv(path)


def render_for_csv(df: DataFrame, joiner: str = ",") -> DataFrame:
    """Arrays become delimiter-joined text so the table fits CSV."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.ArrayType):
            cols.append(F.concat_ws(joiner, F.col(f.name).cast("array<string>")).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    """Header CSV folder, overwritten by default (S6, S9).  Cell text is
    written as is (Spark trims surrounding blanks by default; " NA" must
    stay " NA")."""
    (
        render_for_csv(df)
        .write.mode(mode)
        .option("header", True)
        .option("sep", sep)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def stage_exists(spark: SparkSession, path: str) -> bool:
    """Whether a finished stage stands at ``path``: a run that was killed
    leaves a folder without the committer's ``_SUCCESS`` marker."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return p.getFileSystem(conf).exists(p)


def write_stage(df: DataFrame, path: str, partition_by: list[str] | None = None) -> bool:
    """Write-once stage table (S7): skipped when the target is complete, and
    written anew over the rest of a run that was killed.  Parquet,
    optionally partitioned (e.g. by product type, so type filters prune
    whole folders).  Returns True when written."""
    spark = df.sparkSession
    if stage_exists(spark, path):
        return False
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return True


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """Re-read a stage table."""
    return spark.read.parquet(path)
