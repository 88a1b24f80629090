"""Chat formatting with typed content parts.

A message is a list of parts: text, image, audio or document.  A visitor turns
each part into its place in the formatted text: texts are escaped, the others
become numbered placeholders, and their references and expanded token counts
are recorded as attachments of the turn.

One formatted turn:

    <|turn|>ROLE
    CONTENT<|end|>

Control strings inside roles and texts are escaped reversibly: every backslash
is doubled, then a backslash is put after the first character of ``<|``,
``<s>``, ``</s>``, ``[INST]`` and ``[/INST]``; line breaks in a role become
backslash n.  The loss mask covers the content of assistant turns.

Turns of a conversation are ordered by turn number (null first), then role,
then content, so ties and repeated rows have one order.  The output is a table
of turns, each with its place in the conversation's formatted text; a
conversation is never gathered into one row.  ``read_back`` streams the sorted
turns of each conversation and parses the formatted text alone.

Defined results: null role and null text are empty; a null part or a null list of parts
holds nothing; a null conversation id is a conversation of its own; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from servicelens.plans.physical import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The template's marks and the strings that must not occur in texts.
TURN = "<|turn|>"
END = "<|end|>\n"
CONTROL = r"(<(?=\||/?s>)|\[(?=/?INST\]))"

# Tokens that one unit of an attachment stands for.
UNIT_TOKENS = {"image": 256, "audio": 25, "document": 600}  # a tile, a second, a page

PARTS = "array<struct<type:string,text:string,ref:string,units:int>>"


def text_parts(text: Column) -> Column:
    """A message of one text part."""
    part = F.struct(
        F.lit("text").alias("type"),
        F.coalesce(text.cast("string"), F.lit("")).alias("text"),
        F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("int").alias("units"),
    )
    return F.array(part).cast(PARTS)


def escaped(text: Column) -> Column:
    doubled = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, CONTROL, r"$1\\")


def _tokens(part: Column) -> Column:
    """Expanded tokens of an attachment: whole units, one at least."""
    units = F.greatest(F.coalesce(part["units"], F.lit(1)), F.lit(1))
    per_unit = F.create_map(*[F.lit(x) for kv in UNIT_TOKENS.items() for x in kv])
    return units * F.coalesce(F.try_element_at(per_unit, part["type"]), F.lit(1))


def visited(parts: Column) -> Column:
    """The content: every part at its place.  An attachment's number is its
    place among the turn's attachments."""

    def visit(part: Column, i: Column) -> Column:
        number = F.size(F.filter(F.slice(parts, F.lit(1), i + 1), lambda p: F.coalesce(p["type"], F.lit("text")) != "text"))
        mark = F.concat(F.lit("<|"), escaped(part["type"]), F.lit(":"), number.cast("string"), F.lit("|>"))
        return F.when(part.isNull(), "").when(F.coalesce(part["type"], F.lit("text")) == "text", escaped(part["text"])).otherwise(mark)

    return F.coalesce(F.array_join(F.transform(parts, visit), ""), F.lit(""))


def format_turns(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", parts_col: str = "parts") -> DataFrame:
    """One row per turn: conv_id, turn, place (0, 1, ...), formatted, start
    (characters of the conversation before it), loss_start and loss_end
    (characters of the conversation's text; null outside the mask),
    attachments (kind, ref, tokens)."""
    col = lambda c: F.col(f"`{c}`")
    parts = F.col("parts")
    df = messages.select(
        col(conv_col).alias("conv_id"), col(turn_col).alias("turn"), F.coalesce(col(role_col), F.lit("")).alias("role"), col(parts_col).cast(PARTS).alias("parts")
    )
    other = F.filter(parts, lambda p: F.coalesce(p["type"], F.lit("text")) != "text")
    df = df.withColumn(
        "attachments", F.transform(other, lambda p: F.struct(p["type"].alias("kind"), p["ref"].alias("ref"), _tokens(p).alias("tokens")))
    )
    df = df.withColumn("content", visited(parts))
    head = F.concat(F.lit(TURN), F.replace(escaped(F.col("role")), F.lit("\n"), F.lit("\\n")), F.lit("\n"))
    df = df.withColumn("head", head).withColumn("formatted", F.concat("head", "content", F.lit(END)))
    before = Window.partitionBy("conv_id").orderBy("turn", "role", "content")
    length = F.length("formatted").cast("bigint")
    df = df.withColumn("place", F.row_number().over(before) - 1)
    df = df.withColumn("start", F.coalesce(F.sum(length).over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("bigint")))
    masked = F.col("role") == "assistant"
    loss = F.col("start") + F.length("head")
    return df.select(
        "conv_id",
        "turn",
        "place",
        "formatted",
        "start",
        F.when(masked, loss).alias("loss_start"),
        F.when(masked, loss + F.length("content")).alias("loss_end"),
        "attachments",
    )


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def conversation_reader():
    """Sorted batches of formatted turns -> one row per conversation, read from
    the formatted text and the mask alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

        def row(s) -> pa.RecordBatch:
            values = (s["conv_id"], s["turns"], s["all"].hexdigest(), s["loss_chars"], s["loss"].hexdigest(), s["chars"])
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

        now = None
        for batch in batches:
            for r in batch.to_pylist():
                if now is None or now["conv_id"] != r["conv_id"]:
                    if now is not None:
                        yield row(now)
                    now = {"conv_id": r["conv_id"], "turns": 0, "loss_chars": 0, "chars": 0, "all": hashlib.sha256(), "loss": hashlib.sha256()}
                piece = r["formatted"]
                if not (piece.startswith(TURN) and piece.endswith(END)):
                    raise ValueError(f"damaged turn in conversation {r['conv_id']}")
                role, _, content = piece[len(TURN) : -len(END)].partition("\n")
                role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role, flags=re.DOTALL)
                now["all"].update(f"{role}\n{unescaped(content)}\n".encode("utf-8"))
                now["turns"] += 1
                if r["loss_start"] is not None:
                    text = unescaped(piece[r["loss_start"] - now["chars"] : r["loss_end"] - now["chars"]])
                    now["loss"].update(text.encode("utf-8"))
                    now["loss_chars"] += len(text)
                now["chars"] += len(piece)
        if now is not None:
            yield row(now)

    return run


def read_back(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    rows = turns.select("conv_id", "place", "formatted", "loss_start", "loss_end").repartition("conv_id").sortWithinPartitions("conv_id", "place")
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return rows.mapInArrow(conversation_reader(), schema)


def op10_query(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    planted = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", planted), (-7, 1, "assistant", planted)], "conv_id long, turn long, role string, text string")
    messages = rows.unionByName(extra).withColumn("parts", text_parts(F.col("text")))
    return read_back(materialize(format_turns(messages), "chat"))
