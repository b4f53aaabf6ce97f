"""Chat records, their text form, padding and label masks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import alt_label, id_to_name
from millrace.functions.columns import fresh_name, quoted

TURNS_PER_BLOCK = 256


def _part(kind: str, text: Column | None = None) -> Column:
    """One content part; an image part has no text."""
    text = F.lit(None).cast("string") if text is None else text
    return F.struct(F.lit(kind).alias("type"), text.alias("text"))


def _turn(role: str, *parts: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), F.array(*parts).alias("content"))


def chat_messages(
    df: DataFrame,
    prompt: Column | str,
    names: Sequence[str] | None = None,
    label: str = "label",
    with_answer: bool = True,
    column: str = "messages",
) -> DataFrame:
    """Add a record of turns: the user shows an image and asks; the assistant names the class.

    ``with_answer=False`` leaves the assistant turn out, for records to be answered by a model.
    """
    prompt = F.lit(prompt) if isinstance(prompt, str) else prompt
    turns = [_turn("user", _part("image"), _part("text", prompt))]
    if with_answer:
        turns.append(_turn("assistant", _part("text", id_to_name(label, names))))
    return df.withColumn(column, F.array(*turns))


def _fill(template: str, role: Column, text: Column) -> Column:
    """Put role and text into a ``{role}``/``{text}`` template."""
    before, _, rest = template.partition("{role}")
    middle, _, after = rest.partition("{text}")
    return F.concat(F.lit(before), role, F.lit(middle), text, F.lit(after))


def render_chat(
    messages: Column | str, turn_template: str = "<{role}>\n{text}\n", image_token: str = "<image>"
) -> Column:
    """One string per record: every turn through the template, the ends stripped."""
    messages = F.col(messages) if isinstance(messages, str) else messages

    def part_text(part: Column) -> Column:
        return F.when(part["type"] == "image", F.lit(image_token)).otherwise(F.coalesce(part["text"], F.lit("")))

    def turn_text(turn: Column) -> Column:
        return _fill(turn_template, turn["role"], F.array_join(F.transform(turn["content"], part_text), ""))

    return _strip(F.array_join(F.transform(messages, turn_text), ""))


def _strip(text: Column) -> Column:
    """Without blanks, tabs and line ends at both ends."""
    return F.btrim(text, F.lit(" \t\n\r\f\v"))


def render_turns(
    df: DataFrame,
    key: str,
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    turn_template: str = "<{role}>\n{text}\n",
    column: str = "rendered",
) -> DataFrame:
    """Turn rows to one string per conversation, in turn order.

    Blocks of consecutive turns are joined first, so a very long conversation is split over tasks
    and only its joined blocks meet in the end. Turns that share a number are ordered by role and
    text.
    """
    line = _fill(turn_template, F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit("")))
    lines = df.select(
        key, F.floor(F.col(turn) / TURNS_PER_BLOCK).alias("_block"), F.col(turn).alias("_turn"), line.alias("_line")
    )

    def joined(order: str, line: str) -> Column:
        ordered = F.sort_array(F.collect_list(F.struct(order, line)))
        return F.array_join(F.transform(ordered, lambda x: x[line]), "")

    blocks = lines.groupBy(key, "_block").agg(joined("_turn", "_line").alias("_text"))
    return blocks.groupBy(key).agg(_strip(joined("_block", "_text")).alias(column))


def pad_tokens(
    df: DataFrame, column: str, batch_key: str, pad_id: int = 0, side: str = "right", output: str = "input_ids"
) -> DataFrame:
    """Pad token arrays to the longest of their batch.

    The longest length per batch is an aggregate joined back, so a large batch is not gathered in
    one task.
    """
    if side not in ("left", "right"):
        raise ValueError("side must be left or right")
    batch, most = (fresh_name([*df.columns, output], c) for c in ("batch", "longest"))
    longest = df.groupBy(quoted(batch_key).alias(batch)).agg(F.max(F.size(quoted(column))).alias(most))
    joined = df.join(longest, quoted(batch_key).eqNullSafe(F.col(batch)))
    padding = F.array_repeat(F.lit(pad_id), (F.col(most) - F.size(quoted(column))).cast("int"))
    parts = (padding, quoted(column)) if side == "left" else (quoted(column), padding)
    return joined.withColumn(output, F.concat(*parts)).drop(batch, most)


def class_table(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """``id, name, alt_name`` of an ordered class list."""
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "id int, name string")
    return rows.withColumn("alt_name", alt_label("name"))
