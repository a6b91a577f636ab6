"""Chat formatting by incremental black-box rendering.

A template is any function from turns to text.  Successive prefixes of a
conversation are rendered, and the part by which an output grows is the turn's
span; an output that does not start with the one before shows a template that
rewrites history, and its conversation gets no spans.  The loss mask covers the
assistants' texts inside their spans.

The library's own template marks each turn and escapes control strings inside
roles and texts: a backslash is put after a control string's first character, so
no text can be read as a mark, and dropping those backslashes gives the text back.

Nulls: a null text or role is empty; rows with a null conv_id form one
conversation of their own; a null turn comes first.  Turns of equal number are
ordered by role and text.  Repeated rows are turns of their own.  An empty table
gives an empty result.  Other columns are ignored.

Conversations are hash-dealt and sorted on disk if need be; a task holds one
conversation at a time.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from hashlib import sha256

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"

#: Strings with which chat formats control a model.
CONTROL = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
ESCAPED = re.compile(r"\\|" + "|".join(f"{re.escape(x[0])}(?={re.escape(x[1:])})" for x in CONTROL))

#: Turns that a prefix of a template declared to render turn by turn starts back.
CONTEXT = 4


def escape(text: str) -> str:
    return ESCAPED.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    """Drops the backslash after a control string's first character, and one of each doubled backslash."""
    return re.sub(r"(\\)\\|([<\[])\\", lambda m: m[1] or m[2], text)


def escaped_role(role: str) -> str:
    """On one line: a role's line breaks and backslashes are written out before its control strings are escaped."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def plain_role(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(text))


def marked_turns(turns: list[Turn]) -> str:
    """The library's template."""
    return "".join(f"{OPEN}{escaped_role(role)}\n{escape(text)}{CLOSE}" for role, text in turns)


def turn_spans(turns: list[Turn], template: Template, context: int | None = None) -> tuple[str, list[tuple[int, int]] | None]:
    """The whole output and each turn's span in it; None for the spans if the template rewrites history.

    Nothing is known of a template, so every whole prefix is rendered, whatever the length
    (the square of a conversation).  A template that is declared to render turn by turn may be
    given a ``context``: prefixes then start that many turns back, and the grown parts must add up to
    the whole output; if not, whole prefixes decide.
    """
    whole = template(turns)

    def grown(context: int) -> list[str] | None:
        parts, before, began = [], template([]), 0
        for k in range(1, len(turns) + 1):
            start = max(0, k - context)
            if start != began:
                before, began = template(turns[start : k - 1]), start
            now = template(turns[start:k])
            if not now.startswith(before):
                return None
            parts.append(now[len(before) :])
            before = now
        return parts

    first = len(template([]))
    parts = grown(context or len(turns))
    if context and (parts is None or whole[first:] != "".join(parts)):
        parts = grown(len(turns))
    if parts is None or whole[first:] != "".join(parts):
        return whole, None
    spans, at = [], first
    for part in parts:
        spans.append((at, at + len(part)))
        at += len(part)
    return whole, spans


def body(output: str, span: tuple[int, int]) -> tuple[str, tuple[int, int]]:
    """A turn's role and where its text lies, read from the output by the template's marks."""
    start, end = span
    line = output.index("\n", start)
    return plain_role(output[start + len(OPEN) : line]), (line + 1, end - len(CLOSE))


FORMATTED = "conv_id long, formatted string, roles array<string>, starts array<int>, ends array<int>, rewrites boolean"


def formatted(rows: DataFrame, template: Template = marked_turns, context: int | None = None) -> DataFrame:
    """(conv_id, formatted, roles, starts, ends, rewrites): each turn's role and its span in the output.

    ``context`` declares that the template renders turn by turn, as the library's own does.
    """
    context = CONTEXT if template is marked_turns else context

    def conversations(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int | None, list[Turn]]]:
        open_id, turns, any_yet = None, [], False
        for batch in batches:
            for conv, role, text in zip(batch["conv_id"].array, batch["role"].array, batch["text"].array, strict=True):
                conv = None if pd.isna(conv) else int(conv)
                if any_yet and conv != open_id:
                    yield open_id, turns
                    turns = []
                open_id, any_yet = conv, True
                turns.append((role, text))
        if any_yet:
            yield open_id, turns

    def render(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        size = 0
        for conv, turns in conversations(batches):
            output, spans = turn_spans(turns, template, context)
            out.append((conv, output, [r for r, _ in turns], *([[s[i] for s in spans or []] for i in (0, 1)]), spans is None))
            size += len(output)
            if size > 4_000_000:
                yield frame(out)
                out, size = [], 0
        if out:
            yield frame(out)

    def frame(out: list[tuple]) -> pd.DataFrame:
        made = pd.DataFrame(out, columns=["conv_id", "formatted", "roles", "starts", "ends", "rewrites"])
        return made.assign(conv_id=made["conv_id"].astype("Int64"))

    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    turns = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *text)
    # decimal text keeps 64-bit ids whole beside nulls, which pandas would read as floats
    dealt = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select(F.col("conv_id").cast("string").alias("conv_id"), "role", "text")
    return dealt.mapInPandas(render, FORMATTED)


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewrites boolean"


def digest(rows: DataFrame) -> DataFrame:
    """The contract's figures, read back from the formatted text by its spans and marks."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for output, starts, ends in zip(batch["formatted"], batch["starts"], batch["ends"], strict=True):
                turns, loss, chars = sha256(), sha256(), 0
                for span in zip(starts, ends, strict=True):
                    role, (a, b) = body(output, span)
                    text = unescape(output[a:b])
                    turns.update(f"{role}\n{text}\n".encode())
                    if role == "assistant":
                        loss.update(text.encode())
                        chars += len(text)
                out.append((len(starts), turns.hexdigest(), chars, loss.hexdigest(), len(output)))
            made = pd.DataFrame(out, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
            yield pd.concat([batch["conv_id"].reset_index(drop=True).astype("Int64"), made, batch["rewrites"].reset_index(drop=True)], axis=1)

    kept = formatted(rows).select(F.col("conv_id").cast("string").alias("conv_id"), "formatted", "starts", "ends", "rewrites")
    return kept.mapInPandas(read, DIGEST)


def with_control_conversation(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """The contract's conversation -1, whose texts hold control strings."""
    own = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text")
    )
    return rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(own)


def oracle() -> str:
    """What a lossless format must give back, taken from the table; lengths by the template's rule."""
    added = " + ".join([r"(length(x) - length(replace(x, '\', '')))", *[f"(length(x) - length(replace(x, '{c}', ''))) // {len(c)}" for c in CONTROL]])
    over = len(OPEN) + 1 + len(CLOSE)
    return f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -1, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]' FROM range(2) r(i)),
e AS (SELECT conv_id, turn, role, t, (SELECT {added} FROM (SELECT t AS x)) + (SELECT {added} + 2 * (length(x) - length(replace(replace(x, chr(10), ''), '\', ''))) FROM (SELECT role AS x)) AS added FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn, role, t)) AS turns_sha256,
  coalesce(sum(length(t)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars, sha256(coalesce(string_agg(t, '' ORDER BY turn, role, t) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum({over} + length(role) + length(t) + added)::BIGINT AS formatted_chars, false AS rewrites FROM e GROUP BY conv_id"""
