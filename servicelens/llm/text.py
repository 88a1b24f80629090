"""Column helpers shared by the text operators (built-in functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The ASCII blanks that separate words, as a character class and as a list.
BLANK_CLASS = r"[\x20\x09-\x0D]"
BLANKS = " \t\n\x0b\f\r"
# Fixed value: everything that is not part of an ASCII-alphanumeric or non-ASCII word.
NON_WORD_CLASS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"

# Row identity inside the operators: an id may be null or repeated, so rows are
# told apart by id and text together; rows equal in both are copies.
KEY = ["__id", "__text_hash"]


def blank_words(text: Column) -> Column:
    """Maximal runs without ASCII blanks; null and blank texts give []."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_CLASS + "+"))


def ascii_lower(text: Column) -> Column:
    """``lower`` for comparisons with ASCII words: A-Z fold, and no other
    character may become an ASCII letter.  The Kelvin sign is the only one
    whose lower case is a single ASCII letter, so it is swapped first."""
    return F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u212b")))


def plain_words(text: Column) -> Column:
    """Lower-cased runs of ASCII letters, digits and non-ASCII characters."""
    return F.array_remove(F.split(ascii_lower(text), NON_WORD_CLASS + "+"), "")


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(__id, __text_hash, __text): the only columns an operator looks at, so
    extra columns of any name cannot clash.  Null texts are empty."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").alias("__id"), F.xxhash64(text).alias("__text_hash"), text.alias("__text"))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def fenced(df: DataFrame) -> DataFrame:
    """``df`` behind a filter that the optimizer cannot move.  A later filter on
    a column computed from lists would otherwise be pushed below them, and
    each list would be built anew for every element of another."""
    return df.withColumn("__fence", F.spark_partition_id()).where("__fence >= 0").drop("__fence")
