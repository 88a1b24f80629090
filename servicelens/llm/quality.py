"""Quality rules by line-first cleaning (built-in functions only).

Every line is judged on its own; failing lines are removed, and a document
that loses too large a share of its words is rejected.

Line rules (a line without a word is neither kept nor lost):

* punctuation: symbol characters, ``!!`` runs and words that only repeat the
  one before come to more than ``MAX_NOISE`` per cent of its words, or fewer than ``short_line`` words and no mark
  that ends a sentence, clause or quotation;
* navigation: at least one stand-alone separator (``| » › • · >``) for every
  four words;
* boilerplate: phrases of ``BOILERPLATE``, between word borders, are at least
  ``MIN_PHRASE`` per cent of its words.

One row per input row.  Null text counts as empty: all counts 0, base_failed
true.  Repeated rows and ids give repeated rows; empty tables an empty result;
other columns are ignored, whatever their names, but one named as the result is replaced by it (as
``withColumn`` does).  A text is judged whole, in one row's memory, whatever its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from servicelens.llm.text import blank_words, fenced, free_name

# Fixed values of the rules.
SYMBOLS = "[#*$%&|<>]"
END_MARKS = r"[.!?…:;\"'”’»)\]][\x20\x09-\x0D]*\z"
SEPARATORS = ["|", "»", "›", "•", "·", ">"]
BOILERPLATE = [
    "all rights reserved",
    "click here",
    "cookie policy",
    "enable javascript",
    "lorem ipsum",
    "privacy policy",
    "read more",
    "share on facebook",
    "sign in",
    "subscribe to our newsletter",
    "terms of service",
    "terms of use",
    "uses cookies",
]
PHRASE = r"(?i)(?<![\p{L}\p{M}\p{N}_])(?:" + "|".join(BOILERPLATE) + r")(?![\p{L}\p{M}\p{N}_])"

WINDOW = 8  # words of a window that counts as repeated
MIN_WORDS = 20
MAX_REPEAT = 30  # per cent of words in repeated windows
MAX_NOISE = 30  # per cent of a line's words
SHORT_LINE = 5  # words
MIN_PHRASE = 20  # per cent of a line's words
MAX_LOST = 50  # per cent of a document's words


def _matches(text: Column, pattern: str) -> Column:
    return F.size(F.split(text, pattern)) - 1


def _window_hashes(hashes: Column, n: Column, width: int) -> Column:
    return F.when(
        n >= width,
        F.transform(F.sequence(F.lit(0), n - width), lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(width)])),
    ).otherwise(F.array().cast("array<bigint>"))


def repeated_window_words(df: DataFrame, words: str, out: str, width: int = WINDOW) -> DataFrame:
    """Add ``out``: words inside ``width``-word windows that occur at least
    twice in the row's word list.  Window hashes are sorted with their
    positions, neighbours with equal hashes are marked, and the marked
    windows' lengths are summed up to the next one's start: n log n in the
    row, and only where a cheap distinct count shows a repeat."""
    n = F.size(words)
    df = df.withColumn("__h", F.transform(words, lambda w: F.xxhash64(w)))
    df = df.withColumn("__w", _window_hashes(F.col("__h"), n, width))
    repeats = F.size(F.array_distinct("__w")) < F.size("__w")
    df = df.withColumn(
        "__s",
        F.when(repeats, F.sort_array(F.transform("__w", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))),
    )

    def marked(x, j):
        same = lambda k: F.get(F.col("__s"), k)["h"] == x["h"]
        return F.coalesce(same(j + 1), F.lit(False)) | ((j > 0) & F.coalesce(same(F.greatest(j - 1, F.lit(0))), F.lit(False)))

    df = df.withColumn("__p", F.sort_array(F.transform(F.filter("__s", marked), lambda x: x["i"])))
    spans = F.transform("__p", lambda p, j: F.least(F.lit(width), F.coalesce(F.get(F.col("__p"), j + 1) - p, F.lit(width))))
    covered = F.aggregate(spans, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return df.withColumn(out, F.coalesce(covered, F.lit(0).cast("bigint"))).drop("__h", "__w", "__s", "__p")


def line_verdict(line: Column, words: Column, n_words: Column) -> Column:
    """'' for a kept line, else the name of the rule it fails."""
    stutter = F.filter(words, lambda w, i: (i > 0) & (w == F.get(words, F.greatest(i - 1, F.lit(0)))))
    noise = _matches(line, SYMBOLS) + _matches(line, "!!+") + F.size(stutter)
    unended = (n_words < SHORT_LINE) & ~line.rlike(END_MARKS)
    separators = F.size(F.filter(words, lambda w: w.isin(SEPARATORS)))
    phrase_words = F.size(F.split(F.array_join(F.regexp_extract_all(line, F.lit(PHRASE), F.lit(0)), " "), " "))
    return (
        F.when(n_words == 0, "")
        .when((separators > 0) & (4 * separators >= n_words), "navigation")
        .when((100 * noise > MAX_NOISE * n_words) | unended, "punctuation")
        .when(line.rlike(PHRASE) & (100 * phrase_words >= MIN_PHRASE * n_words), "boilerplate")
        .otherwise("")
    )


def _lines_where(other: str, condition) -> Column:
    """The lines whose partner in the list ``other`` meets the condition."""
    return F.array_compact(F.zip_with("__lines", other, lambda line, x: F.when(condition(x), line)))


def quality_scan(docs: DataFrame, text_col: str = "text", max_lost: int = MAX_LOST, out_col: str = "quality") -> DataFrame:
    """The rows of ``docs`` with a struct column ``out_col``: the counts, the
    cleaned text (kept lines joined by line breaks) and the verdicts."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    others = [F.col(f"`{c}`") for c in docs.columns if c.lower() != out_col.lower()]
    df = docs.select((F.struct(*others) if others else F.struct(F.lit(0).alias("__none"))).alias("__row"), text.alias("__text"))
    df = df.withColumn("__lines", F.split("__text", "\n"))
    df = df.withColumn("__lw", F.transform("__lines", blank_words))
    df = df.withColumn("__words", F.flatten("__lw"))
    df = df.withColumn("__n", F.transform("__lw", F.size))
    # lists meet by zip_with: a list that a lambda only indexes could be moved
    # into it, and then be built anew for every element
    df = df.withColumn("__full", _lines_where("__n", lambda n: n > 0))
    df = df.withColumn("__why", F.transform("__lines", lambda x, i: line_verdict(x, F.get(F.col("__lw"), i), F.get(F.col("__n"), i))))
    # numbers and texts the later steps need, so that the lists are dropped here
    df = df.select(
        "__row",
        "__words",
        F.size("__words").cast("bigint").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("bigint").alias("word_chars"),
        _matches(F.col("__text"), SYMBOLS).cast("bigint").alias("n_symbols"),
        (F.size("__full") - F.size(F.array_distinct("__full"))).cast("bigint").alias("n_dup_lines"),
        F.size(F.filter("__why", lambda w: w != "")).cast("bigint").alias("lines_removed"),
        F.aggregate(
            F.zip_with("__n", "__why", lambda k, why: F.when(why == "", 0).otherwise(k)),
            F.lit(0).cast("bigint"),
            lambda a, x: a + x,
        ).alias("words_lost"),
        F.array_join(_lines_where("__why", lambda why: why == ""), "\n").alias("clean_text"),
    )
    df = repeated_window_words(df, "__words", "n_repeat_words").drop("__words")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    df = df.withColumn("base_failed", failed)
    df = df.withColumn("kept", ~failed & (100 * F.col("words_lost") <= max_lost * F.col("n_words")))
    df = fenced(df)
    return df.select(*(["__row.*"] if others else []), F.struct(*[c for c in df.columns if c != "__row"]).alias(out_col))


def drop_rejected(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows that the rules keep, columns unchanged."""
    name = free_name(docs, "__quality")
    return quality_scan(docs, text_col, out_col=name, **options).where(f"{name}.kept").drop(name)


def op7_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    q = quality_scan(docs)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return q.select("doc_id", *[f"quality.{c}" for c in [*names, "lines_removed", "words_lost"]])
