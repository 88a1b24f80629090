"""Benchmark decontamination by template canonicalisation (built-in functions only).

Documents and benchmark items become sequences of canonical words: numbers,
units and names turn into typed placeholders, other words are lower-cased and
freed of outer punctuation.  Windows of five canonical words (templates) and of
five lower-cased words (literal windows) are hashed and joined, hits are
gathered into alignments (document position minus item position, with a little
drift), and an alignment is a leak when

* it covers at least ``min_cover`` of the item's windows or words, or one run
  of windows without drift holds ``run_words`` equal words, and
* its slots are consistent: every number, unit or name of the item stands for
  one value of the document throughout, case ignored, where a window's value is
  that of the longest run of windows on one diagonal; and one of its windows holds an
  ordinary word, one that is neither a slot nor made of marks; or its literal windows
  alone cover that much.

A word of arithmetic marks only (``+``, ``=``) stands for itself, so sums are told apart by them, and
lists of numbers are leaks only where they are literally equal.

``cover`` is the share of the item's windows, and below ``min_cover`` for a
partial copy.  Where the templates alone cover enough windows, its cover and place are theirs, else
those of all hits.  A leak is ``verbatim`` when all slots keep their values (case ignored) and
``reparameterised`` otherwise.

The item windows are broadcast while the benchmark's texts have at most
``broadcast_chars`` characters (measured first); a larger benchmark is
shuffle-joined.  Only hits are shuffled by document.

Defined results: null, empty and blank texts have no windows and no leaks; a
text of fewer than five words is one window; an item of two to four words is
also found literally inside a longer text, one of a single word only as the
whole text, all in the same pass over the texts; ``drop_leaks`` drops a document for a hit of at least
``min_words`` words, or one that is the whole document: a shorter one is reported only; a text of any length is cut into windows inside its task, and
hits are gathered by document and item; equal rows (same id and text)
give one row per leak, as do repeated items; null ids are kept; an empty table
on either side gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from servicelens.llm.text import KEY, blank_words, free_name, keyed

WINDOW = 5
MIN_COVER = 0.8
MAX_SHIFT = 3
MIN_WORDS = 5  # words of a hit that drops a longer document
RUN_WORDS = 14  # equal words of one run that make a partial copy
BROADCAST_CHARS = 4_000_000

# Marks that may surround a word, marks that are kept where they
# are a word of their own, marks that end a sentence, number words and units.
OUTER_MARKS = ".,;:!?\"'`()[]{}<>*_|/\\#$€£%+-=~^&…“”„‘’«»–—"
ARITHMETIC_MARKS = "+-*/=<>%^"
SENTENCE_MARKS = [".", "!", "?", ":", "…"]
NUMBER_WORDS = (
    "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen"
    " eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
).split()
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms pound pounds ounce"
    " ounces ml l litre litres liter liters gallon gallons second seconds minute minutes hour hours day days week weeks"
    " month months year years cent cents dollar dollars euro euros percent degree degrees mph kmh watt watts volt volts"
).split()


KINDS = ["<number>", "<unit>", "<name>"]


def stripped(word: Column) -> Column:
    """The word without outer marks; words of arithmetic marks stay as they are."""
    bare = F.btrim(word, F.lit(OUTER_MARKS))
    return F.when((bare == "") & (F.btrim(word, F.lit(ARITHMETIC_MARKS)) == ""), word).otherwise(bare)


def starts_upper(word: Column) -> Column:
    return ((word >= "A") & (word < "[")) | ((word >= "À") & (word < "ß"))


def canonical_word(word: Column, before: Column) -> Column:
    """The canonical form of a stripped ``word``; ``before`` is the raw word in
    front of it (null at the start).  A capital marks a name unless the word
    opens a sentence."""
    lower = F.lower(word)
    capital = starts_upper(word)
    opens = before.isNull() | F.substring(before, -1, 1).isin(SENTENCE_MARKS)
    return (
        F.when((word >= "0") & (word < ":"), "<number>")
        .when(capital & ~opens, "<name>")
        .when(lower.isin(NUMBER_WORDS), "<number>")
        .when(lower.isin(UNITS), "<unit>")
        .otherwise(lower)
    )


def with_windows(df: DataFrame, keep: list[str], width: int, short: list[int] = ()) -> DataFrame:
    """keep + words, canon, n_windows, grams (hashes of the canonical windows, then
    of the literal ones, null where equal, then of the literal windows of each length
    of ``short`` in texts longer than it) from ``__text``."""
    df = df.select(*keep, blank_words(F.col("__text")).alias("raw"))
    df = df.withColumn("words", F.transform("raw", stripped))
    df = df.withColumn(
        "canon",
        F.transform("words", lambda w, i: canonical_word(w, F.when(i > 0, F.get(F.col("raw"), F.greatest(i - 1, F.lit(0)))))),
    ).drop("raw")
    df = df.withColumn("n", F.size("words"))
    df = df.withColumn("hashes", F.transform("canon", lambda w: F.xxhash64(w)))
    df = df.withColumn("plain", F.transform("words", lambda w: F.xxhash64(F.lower(w))))
    shorter = [F.when(F.col("n") > k, _windows("plain", k)).otherwise(F.array().cast("array<bigint>")).alias(f"short{k}") for k in short]
    df = df.select(*keep, "words", "canon", _windows("hashes", width).alias("grams"), _windows("plain", width).alias("same"), *shorter)
    # a literal window is named only where it differs from the template
    literal = F.zip_with("same", "grams", lambda x, y: F.when(x != y, x))
    grams = F.concat("grams", literal, *[f"short{k}" for k in short])
    return df.select(*keep, "words", "canon", F.size("grams").alias("n_windows"), grams.alias("grams"))


def place_and_width(width: int, short: list[int]) -> tuple[Column, Column]:
    """The first word and the width of window ``at`` of the list of ``with_windows``."""
    at, begin = F.col("at"), 2 * F.col("n_windows")
    place, wide = at % F.col("n_windows"), F.lit(width)
    for k in short:
        place, wide = F.when(at >= begin, at - begin).otherwise(place), F.when(at >= begin, k).otherwise(wide)
        begin = begin + F.greatest(F.when(F.size("words") > k, F.size("words") - k + 1).otherwise(0), F.lit(0))
    return place.cast("int"), wide


def _windows(hashes: str, width: int) -> Column:
    """The hashes of the windows of ``width`` words; a shorter text is one window."""
    n = F.col("n")
    return (
        F.when(
            n >= width,
            F.transform(
                F.sequence(F.lit(0), n - width),
                lambda i: F.xxhash64(*[F.get(F.col(hashes), i + j) for j in range(width)]),
            ),
        )
        .when(n > 0, F.array(F.xxhash64(*[F.get(F.col(hashes), F.lit(j)) for j in range(width)])))
        .otherwise(F.array().cast("array<bigint>"))
    )


def item_windows(benchmark: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """One row per window of each distinct item; an item's capitalised first
    word stands as a name as well, as it does inside a sentence."""
    items = keyed(benchmark, id_col, text_col).dropDuplicates(KEY)
    items = items.withColumnRenamed("__id", "item").withColumnRenamed("__text_hash", "item_hash")
    items = with_windows(items, ["item", "item_hash"], width).withColumn("n_words", F.size("words"))
    keep = ["item", "item_hash", "n_windows", "n_words", "t_pos", "gram", "inner"]
    as_name = F.concat(F.array(F.lit("<name>")), F.slice("canon", 2, width - 1))
    inner = items.where((F.col("n_words") >= width) & starts_upper(F.get(F.col("words"), F.lit(0)))).withColumn("canon", as_name)
    inner = inner.select(
        "*", F.lit(0).alias("t_pos"), F.xxhash64(*[F.xxhash64(F.get(F.col("canon"), F.lit(j))) for j in range(width)]).alias("gram")
    )
    items = items.select("*", F.posexplode_outer("grams").alias("at", "gram")).where("gram is not null")
    items = items.withColumn("t_pos", (F.col("at") % F.col("n_windows")).cast("int")).drop("at")
    rows = items.withColumn("inner", F.lit(False)).unionByName(inner.withColumn("inner", F.lit(True)))
    return rows.select(
        *keep, F.slice("words", F.col("t_pos") + 1, width).alias("t_words"), F.slice("canon", F.col("t_pos") + 1, width).alias("t_canon")
    )


def window_hits(docs: DataFrame, windows: DataFrame, small: bool, width: int, short: list[int]) -> DataFrame:
    """One row per equal pair of windows, with the slot values of both sides.
    ``short``: the lengths of the items with fewer than ``width`` words."""
    df = with_windows(docs, KEY, width, short)
    # outer: else the optimizer filters on the array's size first, below the
    # word list, and splits the text anew for every window
    exploded = df.select(*KEY, "words", "canon", "n_windows", F.posexplode_outer("grams").alias("at", "gram"))
    pos, wide = place_and_width(width, short)
    return compared(exploded.withColumn("pos", pos).withColumn("wide", wide).drop("at", "n_windows"), windows, small, width)


def compared(df: DataFrame, windows: DataFrame, small: bool, width: int) -> DataFrame:
    """The hits of exploded document windows of ``wide`` words; those of fewer than ``width`` are hits of items of that length."""
    here = [F.slice(c, F.col("pos") + 1, F.col("wide")).alias(alias) for c, alias in (("words", "here"), ("canon", "here_canon"))]
    if small:  # the lists stand by for the few hits
        hits = df.join(F.broadcast(windows), "gram").select("*", *here)
    else:  # a window goes through the shuffle with its own words only
        hits = df.where("gram is not null").select(*KEY, "pos", "wide", "gram", *here).join(windows, "gram")
    # joined, not a lambda: a lambda in the join's condition takes the join out of
    # generated code, and all windows of a text then wait with its whole lists
    literal = F.lower(F.array_join("here", " ")) == F.lower(F.array_join("t_words", " "))
    alike = F.col("here_canon") == F.col("t_canon")
    hits = hits.withColumn("literal", literal).withColumn("alike", alike).where("literal or alike")
    whole = (F.col("n_words") == F.col("wide")) & (F.size(F.array_remove("t_words", "")) > 1)
    hits = hits.where((F.col("wide") == width) | (F.col("literal") & whole))
    paired = F.transform(
        "t_canon",
        lambda c, j: F.struct(c.alias("kind"), F.lower(F.get(F.col("t_words"), j)).alias("theirs"), F.lower(F.get(F.col("here"), j)).alias("ours")),
    )
    hits = hits.withColumn("paired", paired)
    slots = F.filter("paired", lambda p: p["kind"].isin(KINDS))
    ordinary = F.exists("t_canon", lambda c: ~c.isin(KINDS) & (F.btrim(c, F.lit(OUTER_MARKS)) != ""))
    equal = F.transform("paired", lambda p: (p["theirs"] == p["ours"]).cast("int"))
    return hits.select(
        *KEY,
        "item",
        "item_hash",
        "n_windows",
        "n_words",
        "t_pos",
        "pos",
        "literal",
        (F.col("alike") & ~F.col("inner")).alias("template"),
        ordinary.alias("ordinary"),
        slots.alias("slots"),
        equal.alias("equal"),
    )


def alignments(hits: DataFrame, max_shift: int, width: int) -> DataFrame:
    """One row per alignment, of the templates alone (by_template 1), of all hits
    (0) and of all hits in a band around a strongest diagonal (-1): covered
    share of the item's windows (cover) and words (word_cover), share covered
    literally (same), equal words of its best run, its distinct slots."""
    pair = [*KEY, "item", "item_hash", "n_windows", "n_words", "by_template"]
    ways = F.when(F.col("template"), F.array(*map(F.lit, (1, 0, -1)))).otherwise(F.array(*map(F.lit, (0, -1))))
    hits = hits.select("*", F.explode(ways).alias("by_template"))
    one = [F.max(c).alias(c) for c in ("literal", "ordinary")]
    hits = hits.repartition(*KEY).groupBy(*pair, (F.col("pos") - F.col("t_pos")).alias("diagonal"), "t_pos").agg(
        *one, F.max("slots").alias("slots"), F.max("equal").alias("equal"), F.max("pos").alias("pos")
    )
    # runs: hits of consecutive windows on one diagonal
    along = Window.partitionBy(*pair, "diagonal")
    hits = hits.withColumn("run", F.col("t_pos") - F.row_number().over(along.orderBy("t_pos")))
    run = Window.partitionBy(*pair, "diagonal", "run")
    hits = hits.withColumn("length", F.count("*").over(run)).withColumn("anchored", F.max("ordinary").over(run))
    # equal words of a run: the first word of every window, and the rest of the last one
    last = F.max(F.struct("t_pos", "equal")).over(run)["equal"]
    equal = F.sum(F.get(F.col("equal"), F.lit(0))).over(run) + F.aggregate(F.slice(last, 2, width), F.lit(0), lambda a, x: a + x)
    hits = hits.withColumn("equal", equal)
    diagonals = hits.groupBy(*pair, "diagonal").agg(
        F.collect_list(F.struct("t_pos", "length", "anchored", "literal", "equal", "slots")).alias("hits"),
        F.min("pos").alias("first"),
        F.max("pos").alias("last"),
    )
    order = Window.partitionBy(*pair).orderBy("first", "diagonal")
    apart = (F.abs(F.col("diagonal") - F.lag("diagonal").over(order)) > max_shift) | (
        F.col("first") - F.lag("last").over(order) > F.col("n_windows")
    )
    # stray hits between two diagonals cut a chain, but not the band of a strongest one
    near = Window.partitionBy(*pair).orderBy("diagonal").rangeBetween(-max_shift, max_shift)
    strongest = F.max(F.struct(F.size("hits"), -F.col("diagonal"), "diagonal")).over(near)["diagonal"]
    chain = F.sum("apart").over(order)
    spans = diagonals.withColumn("apart", F.coalesce(apart, F.lit(True)).cast("int"))
    spans = spans.withColumn("span", F.when(F.col("by_template") < 0, strongest.cast("bigint")).otherwise(chain))
    span = [*pair, "span"]
    # a window of slots alone also hits on neighbouring diagonals: for every
    # window of the item the hit of the longest run counts, and where a run
    # with an ordinary word stands, runs without one count only unchanged
    unchanged = F.forall("hit.slots", lambda x: x["theirs"] == x["ours"])
    of_span = Window.partitionBy(*span)
    chosen = (
        spans.withColumn("first", F.min("first").over(of_span))
        .withColumn("last", F.max("last").over(of_span))
        .select(*span, "first", "last", "diagonal", F.explode("hits").alias("hit"))
        .withColumn("has_anchor", F.max("hit.anchored").over(of_span))
        .where(F.col("hit.anchored") | ~F.col("has_anchor") | unchanged)
        .groupBy(*span, "first", "last", "has_anchor", F.col("hit.t_pos").alias("t_pos"))
        .agg(
            F.max(F.struct("hit.length", unchanged.cast("int").alias("unchanged"), -F.col("diagonal"), "hit.slots"))["slots"].alias("slots"),
            F.max("hit.literal").alias("literal"),
            F.max("hit.equal").alias("equal"),
        )
    )
    # words of a window up to the next covered one
    wide = F.least(F.lit(width), F.col("n_words"))
    reach = F.transform("covered", lambda p, j: F.least(wide, F.coalesce(F.get(F.col("covered"), j + 1) - p, wide)))
    return (
        chosen.groupBy(*span, "first", "last", "has_anchor")
        .agg(
            F.count("*").alias("n_covered"),
            F.count(F.when(F.col("literal"), 1)).alias("n_same"),
            F.max("equal").alias("run_words"),
            F.sort_array(F.collect_list("t_pos")).alias("covered"),
            F.array_distinct(F.flatten(F.collect_list("slots"))).alias("slots"),
        )
        .withColumn("cover", F.col("n_covered") / F.col("n_windows"))
        .withColumn("same", F.col("n_same") / F.col("n_windows"))
        .withColumn("word_cover", F.aggregate(reach, F.lit(0), lambda a, x: a + x) / F.col("n_words"))
        .drop("covered")
    )


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    width: int = WINDOW,
    min_cover: float = MIN_COVER,
    max_shift: int = MAX_SHIFT,
    broadcast_chars: int = BROADCAST_CHARS,
    run_words: int = RUN_WORDS,
) -> DataFrame:
    """One row per leaked item of a document: __id, __text_hash, item, cover,
    first and last word of the best alignment, kind."""
    item_text = F.col(f"`{item_text_col}`").cast("string")
    item_words = F.size(blank_words(item_text))
    short = F.collect_set(F.when((item_words > 1) & (item_words < width), item_words))
    chars, short = benchmark.agg(F.sum(F.length(item_text)), F.sort_array(short)).first()
    windows = item_windows(benchmark, width, item_id_col, item_text_col)
    hits = window_hits(keyed(docs, id_col, text_col), windows, (chars or 0) <= broadcast_chars, width, short)
    spans = alignments(hits, max_shift, width)
    consistent = F.size(F.array_distinct(F.transform("slots", lambda s: F.struct(s["kind"], s["theirs"])))) == F.size("slots")
    partly = (F.col("by_template") < 1) & ((F.col("word_cover") >= min_cover) | (F.col("run_words") >= run_words))
    leaks = spans.where((F.col("same") >= min_cover) | ((F.col("cover") >= min_cover) | partly) & consistent & F.col("has_anchor"))
    verbatim = F.forall("slots", lambda s: s["theirs"] == s["ours"])
    best = F.struct("by_template", "cover", verbatim.cast("int").alias("verbatim"), (-F.col("first")).alias("from"), "last", "n_words")
    return (
        leaks.groupBy(*KEY, "item")
        .agg(F.max(best).alias("b"))
        .select(
            *KEY,
            "item",
            F.col("b.cover").alias("cover"),
            (-F.col("b.from")).cast("bigint").alias("first_word"),
            (F.col("b.last") + F.least(F.lit(width), F.col("b.n_words")) - 1).cast("bigint").alias("last_word"),
            F.when(F.col("b.verbatim") == 1, "verbatim").otherwise("reparameterised").alias("kind"),
        )
    )


def drop_leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, **options
) -> DataFrame:
    """The rows of ``docs`` without a leak of at least ``min_words`` words (or of all
    words of a shorter text), columns unchanged."""
    found = find_leaks(docs, benchmark, id_col, text_col, **options)
    found = found.groupBy(*KEY).agg(F.max(F.col("last_word") - F.col("first_word") + 1).alias("__words_hit"))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    # rows without any id and text twin on the right stay; null ids compare equal
    hashed = free_name(docs, "__hash_here")
    rows = docs.withColumn(hashed, F.xxhash64(text))
    match = rows[f"`{id_col}`"].eqNullSafe(found["__id"]) & (rows[hashed] == found["__text_hash"])
    enough = (found["__words_hit"] >= min_words) | (found["__words_hit"] >= F.size(blank_words(rows[f"`{text_col}`"].cast("string"))))
    return rows.join(found, match & enough, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def op9_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaks = find_leaks(docs, benchmark)
    return leaks.select(F.col("__id").alias("doc_id"), F.col("item").alias("item_id"), "cover", "first_word", "last_word", "kind")
