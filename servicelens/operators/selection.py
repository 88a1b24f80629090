"""Order statistics without a sort: radix refinement on the values' bits.

A double's 64 bits, read as a signed whole number (negative values mirrored),
order like the values.  Each of three rounds counts the rows by their next 20 or 22
bits, as one aggregate with map-side partial counts, finds the digit that holds
the wanted rank by a running sum over at most 4,194,304 counts a group, and
goes on with the rows of that digit only.  After the last round the digit is the
value.  Nothing is sorted, written or collected, and a value held by a third of
all rows is one counter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHIFTS = (44, 22, 0)  # bits to the right of each round's digit
DIGIT_BITS = 22  # of all digits but the first, which has the rest
ROUNDS = len(SHIFTS)


def ordered_bits(v: Column) -> Column:
    """The IEEE 754 bits of a double as a long that orders like it; both zeros
    are 0, NaN is null.  By exact steps only: scaling by powers of two, and
    subtracting 1 from [1, 2)."""
    size = F.abs(v)
    guess = F.floor(F.log2(size)).cast("int")
    # the logarithm may be off by one next to a power of two
    scale = lambda e: F.pow(F.lit(2.0), e)
    exponent = F.greatest(F.when(size >= scale(guess + 1), guess + 1).when(size < scale(guess), guess - 1).otherwise(guess), F.lit(-1022))
    fraction = size / scale(exponent)  # below 1 where the number is subnormal
    # subnormals have the exponent field 0 and no leading 1
    field = F.when(fraction < 1, F.lit(0)).otherwise(exponent + 1023).cast("long")
    mantissa = (F.when(fraction < 1, fraction).otherwise(fraction - 1) * F.lit(float(2**52))).cast("long")
    bits = F.when(size == F.lit(float("inf")), F.lit(2047 << 52)).when(size == 0, F.lit(0).cast("long"))
    bits = bits.otherwise(F.shiftleft(field, 52) + mantissa)
    return F.when(F.isnan(v), F.lit(None)).when(v < 0, -bits).otherwise(bits)


def _digit(bits: Column, turn: int) -> Column:
    """The ``turn``-th digit from the left; the first one carries the sign."""
    shifted = F.shiftright(bits, SHIFTS[turn])
    return shifted if turn == 0 else shifted.bitwiseAND(F.lit((1 << DIGIT_BITS) - 1))


def _beside(left: DataFrame, right: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """Inner join on ``keys``, null groups included; one row of ``right`` a
    group, so without ``by`` it is broadcast."""
    if not by:
        right = F.broadcast(right)
    if not keys:
        return left.crossJoin(right)
    renamed = right.select(*[F.col(c).alias(f"__{c}" if c in keys else c) for c in right.columns])
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return left.join(renamed, same).drop(*[f"__{c}" for c in keys])


def exact_quantile(df: DataFrame, col: str, q: float, by: tuple[str, ...] = ()) -> DataFrame:
    """Exact linearly interpolated quantile (A11) of the values that are neither
    null nor NaN, as one row ``quantile`` (one for each group of ``by``).

    position = (n - 1) q; value = v[floor] + (v[ceil] - v[floor]) * frac.
    """
    by = list(by)
    rows = df.select(*by, F.col(col).cast("double").alias("v")).withColumn("bits", ordered_bits(F.col("v"))).where("bits is not null")
    # the first round counts every row once, for both ranks
    counts = rows.groupBy(*by, _digit(F.col("bits"), 0).alias("digit")).agg(F.count(F.lit(1)).alias("k"))
    n = counts.groupBy(*by).agg(F.sum("k").alias("n"))
    pos = (F.col("n") - 1) * F.lit(q)
    ends = F.explode(F.array(F.struct(F.lit(0).alias("end"), F.floor(pos).alias("rank")), F.struct(F.lit(1).alias("end"), F.ceil(pos).alias("rank"))))
    wanted = n.select(*by, (pos - F.floor(pos)).alias("part"), ends.alias("w")).select(*by, "part", "w.end", "w.rank")
    counts = _beside(counts, wanted, by, by)
    for turn in range(ROUNDS):
        if turn:
            # a row belongs to the ranks whose digits so far it has
            prefix = F.shiftright(F.col("bits"), SHIFTS[turn - 1])
            matched = _beside(rows.withColumn("prefix", prefix), found, [*by, "prefix"], by)
            counts = matched.groupBy(*by, "part", "end", "rank", "prefix", _digit(F.col("bits"), turn).alias("digit"))
            counts = counts.agg(F.count(F.lit(1)).alias("k"), F.min("v").alias("v"))
        before = Window.partitionBy(*by, "end").orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
        placed = counts.withColumn("before", F.coalesce(F.sum("k").over(before), F.lit(0)))
        placed = placed.where((F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("before") + F.col("k")))
        if turn == ROUNDS - 1:
            break
        grown = F.col("digit") if turn == 0 else F.shiftleft(F.col("prefix"), DIGIT_BITS).bitwiseOR(F.col("digit"))
        found = placed.select(*by, "part", "end", (F.col("rank") - F.col("before")).alias("rank"), grown.alias("prefix"))
    low, high = F.max(F.when(F.col("end") == 0, F.col("v"))), F.max(F.when(F.col("end") == 1, F.col("v")))
    return placed.groupBy(*by).agg((low + (high - low) * F.max("part")).alias("quantile")).where("quantile is not null")
