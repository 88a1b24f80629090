"""Service-order views over the TPC-H-style driver tables.

No repair data ships with the project, so headers and positions are derived
from ``orders``/``customer`` and ``lineitem``/``part`` with portable integer
and date arithmetic.  The same expressions exist as DuckDB SQL in
``servicelens.plans.oracle`` so both engines see identical inputs.

* header   = orders x customer: order key, product type = market segment,
             product article and address code from the customer key, seven
             stage dates = order date plus cumulative offsets from the key.
* position = lineitem x part: part number from the part key (every 20th key
             books labour KK002, the next KK060, the next is a non-part
             article), name = part name, quantity, and the part type as a
             coarse item for basket mining.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from servicelens import schema as S
from servicelens.functions.scalar import drop_third_char
from servicelens.plans import physical

# Day offsets from the order key for the six stage transitions (cumulative).
STAGE_OFFSET_MODULI = (5, 7, 3, 11, 13, 4)


# Natural key of each fact table: later joins and aggregates group by it.
TABLE_KEYS = {"orders": "o_orderkey", "lineitem": "l_orderkey"}


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """Hash-partition a scan by ``key`` when it has fewer partitions than the
    cluster's default parallelism (e.g. one unsplittable row group); large
    inputs already arrive split and pass through unchanged.  Partitioning by
    the order key lets the order joins and aggregates downstream reuse it."""
    target = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    # Shuffle-partition count, so order-keyed joins downstream line up.
    return df.repartition(key) if key else df.repartition(target)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df, TABLE_KEYS.get(name)) if name in TABLE_KEYS else df


def _pad6(c: Column) -> Column:
    # Zero-pad to at least six digits; longer keys are kept whole.
    return F.format_string("%06d", c.cast("long"))


def raw_address(custkey: Column) -> Column:
    """Address code as exported, e.g. "99.899.9"."""
    return F.concat(
        F.format_string("%02d", (custkey % 100).cast("long")), F.lit("."), custkey.cast("string"),
        F.lit("."), (custkey % 10).cast("string"),
    )


def header_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed, cleaned header table (state after L1): one row per order."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = physical.lookup(read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"))
    k, ck = F.col("o_orderkey"), F.col("o_custkey")
    d = F.col("o_orderdate").cast("date")
    offsets = []
    acc = F.lit(0)
    for m in STAGE_OFFSET_MODULI:
        acc = acc + (k % m)
        offsets.append(acc)
    stage_cols = [d.alias(S.STAGE_DATES[0])] + [
        F.date_add(d, off.cast("int")).alias(name) for off, name in zip(offsets, S.STAGE_DATES[1:])
    ]
    return o.join(c, o.o_custkey == c.c_custkey, "inner").select(
        k.alias("order_id"),
        drop_third_char(raw_address(ck)).alias("address_code"),
        F.concat(F.lit(S.PART_PREFIX), _pad6(ck % 19)).alias("product_article"),
        F.col("c_mktsegment").alias("product_type"),
        *stage_cols,
    )


def position_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed position table: one row per order line (parts and labour)."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity"
    )
    p = physical.lookup(read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type"))
    pk = F.col("l_partkey")
    part_no = (
        F.when(pk % 20 == 0, F.lit(S.LABOUR_CODES[0]))
        .when(pk % 20 == 1, F.lit(S.LABOUR_CODES[1]))
        .when(pk % 20 == 2, F.concat(F.lit("X"), _pad6(pk)))
        .otherwise(F.concat(F.lit(S.PART_PREFIX), _pad6(pk)))
    )
    return li.join(p, li.l_partkey == p.p_partkey, "inner").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("position"),
        part_no.alias("part_no"),
        F.col("p_name").alias("part_name"),
        F.col("l_quantity").alias("quantity"),
        F.col("p_type").alias("part_type"),
    )


def raw_quantity(c: Column) -> Column:
    """Quantity rendered as decimal-comma text, as in the raw exports."""
    return F.replace(c.cast("string"), F.lit("."), F.lit(","))


# ---------------------------------------------------------------------------
# Raw-text forms (as exported, German column names, everything a string)
# ---------------------------------------------------------------------------

DATE_RENDER_CYCLE = 12  # ten valid formats, a two-digit year, an impossible day
NA_EVERY = 37           # every 37th order's address is a missing-value marker
KEPT_TEXT_EVERY = 41    # every 41st order's address is " NA" (stays text)
EXTRA_PART_EVERY = 50   # customers whose address has a third dot-part


# Rendering pattern of each cycle slot (Spark datetime syntax);
# slot 11 is the impossible day "31.02.<year>".
RENDER_PATTERNS = (
    "dd-MM-yyyy", "d.M.yyyy", "dd/MM/yyyy", "yyyy-MM-dd", "yyyy.MM.dd", "yyyy/MM/dd",
    "yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "dd.MM.yyyy HH:mm",
    "dd.MM.yy",
)


def render_date(d: Column, key: Column, shift: int = 0) -> Column:
    """A date as text in one of the row-level formats, chosen by the key;
    time of day and fraction are derived from the key too.  Evaluated inside
    a one-element ``transform``: seven rendered columns inlined into one stage
    would pass the JVM's 64 KB method limit."""
    return F.get(F.transform(F.array(d), lambda x: _render_date(x, key, shift)), 0)


def _render_date(d: Column, key: Column, shift: int) -> Column:
    # a year of four digits and a key that is not negative (all there are in
    # practice) are put together from the pieces of the date's own text
    usual = (key >= 0) & F.year(d).between(1, 9999)
    return F.when(usual, _put_together(d, key, shift)).otherwise(_formatted(d, key, shift))


def _put_together(d: Column, key: Column, shift: int) -> Column:
    iso = d.cast("string")
    year, month, day = F.substring(iso, 1, 4), F.substring(iso, 6, 2), F.substring(iso, 9, 2)
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    minutes = F.concat(two(key % 24), F.lit(":"), two(key % 60))
    seconds = F.concat(minutes, F.lit(":"), two(F.floor(key / 7) % 60))
    joined = lambda sep, *parts: F.concat_ws(sep, *parts)
    forms = (  # in the order of RENDER_PATTERNS
        joined("-", day, month, year),
        joined(".", F.dayofmonth(d), F.month(d), year),
        joined("/", day, month, year),
        iso,
        joined(".", year, month, day),
        joined("/", year, month, day),
        F.concat(iso, F.lit(" "), seconds, F.lit("."), F.lpad((key % 1000000).cast("string"), 6, "0")),
        F.concat(iso, F.lit(" "), seconds),
        F.concat(iso, F.lit(" "), minutes),
        F.concat(joined(".", day, month, year), F.lit(" "), minutes),
        joined(".", day, month, F.substring(year, 3, 2)),
    )
    k = (key + shift) % DATE_RENDER_CYCLE
    out = F.when(k == len(forms), F.concat(F.lit("31.02."), F.year(d).cast("string")))
    for i, form in enumerate(forms):
        out = out.when(k == i, form)
    return out


def _formatted(d: Column, key: Column, shift: int) -> Column:
    secs = ((F.floor(key / 7) % 60) * 1000000 + key % 1000000).cast("decimal(18,0)") / F.lit(1000000).cast("decimal(18,0)")
    ts = d.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), (key % 24).cast("int"), (key % 60).cast("int"), secs)
    k = (key + shift) % DATE_RENDER_CYCLE
    out = F.when(k == len(RENDER_PATTERNS), F.concat(F.lit("31.02."), F.year(d).cast("string")))
    for i, pattern in enumerate(RENDER_PATTERNS):
        out = out.when(k == i, F.date_format(ts, pattern))
    return out


def raw_header_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header export as text: German names, dates in mixed formats, some
    addresses replaced by missing-value markers or given a third part."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = physical.lookup(read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"))
    k, ck = F.col("o_orderkey"), F.col("o_custkey")
    d = F.col("o_orderdate").cast("date")
    markers = F.array(*[F.lit(x) for x in S.NA_MARKERS])
    addr = raw_address(ck)
    addr = F.when(ck % EXTRA_PART_EVERY == 0, F.concat(addr, F.lit(".7"))).otherwise(addr)
    addr = (
        F.when(k % NA_EVERY == 0, F.get(markers, (F.floor(k / NA_EVERY) % len(S.NA_MARKERS)).cast("int")))
        .when(k % KEPT_TEXT_EVERY == 0, F.lit(" NA"))
        .otherwise(addr)
    )
    acc, dates = F.lit(0), [d]
    for m in STAGE_OFFSET_MODULI:
        acc = acc + (k % m)
        dates.append(F.date_add(d, acc.cast("int")))
    src = list(S.HEADER_SOURCE_COLUMNS)  # serviceauftrag, adresse, artikel, typ, 7 dates
    return o.join(c, o.o_custkey == c.c_custkey, "inner").select(
        k.cast("string").alias(src[0]),
        addr.alias(src[1]),
        F.concat(F.lit(S.PART_PREFIX), _pad6(ck % 19)).alias(src[2]),
        F.col("c_mktsegment").alias(src[3]),
        *[render_date(dd, k, j).alias(name) for j, (dd, name) in enumerate(zip(dates, src[4:]))],
    )


def raw_position_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position export as text: decimal-comma quantities, a few malformed."""
    pos = position_view(spark, sf_dir)
    q = raw_quantity(F.col("quantity"))
    q = (
        F.when(F.col("position") == 7, F.concat(q, F.lit(",5")))
        .when(F.col("position") == 6, F.concat(F.lit("1."), q))
        .otherwise(q)
    )
    src = list(S.POSITION_SOURCE_COLUMNS)  # SERVICEAUFTRAG, POSITION, ARTIKEL, NAME, MENGE
    return pos.select(
        F.col("order_id").cast("string").alias(src[0]),
        F.col("position").cast("string").alias(src[1]),
        F.col("part_no").alias(src[2]),
        F.col("part_name").alias(src[3]),
        q.alias(src[4]),
    )
