"""Chat formatting with typed content parts.

A message is a list of parts (kind, text, ref, units). The visitor writes text parts escaped and
every other part as a placeholder of its kind, in order; the attachments go to a list beside the
text, with the number of tokens each placeholder expands to. Formatting is row by row: a
conversation is the concatenation of its turns' segments, so its length bounds nothing.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Control strings. All begin with one of the characters that ``escape`` guards inside texts.
BEGIN, INST, INST_END, END = "<s>", "[INST]", "[/INST]", "</s>"
PLACEHOLDERS = {"image": "<image>", "audio": "<audio>", "document": "<document>"}
#: Tokens per unit: an image's unit is a 14 x 14 patch, an audio's 20 ms, a document's a page.
UNIT_TOKENS = {"image": 1, "audio": 1, "document": 512}
PART = "struct<kind:string,text:string,ref:string,units:bigint>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<\[])", r"\\$1")


def text_part(text: Column) -> Column:
    """A text as a list of one part."""
    null = F.lit(None).cast("string")
    part = F.struct(F.lit("text").alias("kind"), text.alias("text"), null.alias("ref"), F.lit(None).cast("long").alias("units"))
    return F.array(part)


def _visit(part: Column) -> Column:
    shown = F.when(part["kind"] == "text", escape(F.coalesce(part["text"], F.lit(""))))
    for kind, mark in PLACEHOLDERS.items():
        shown = shown.when(part["kind"] == kind, F.lit(mark))
    return shown.otherwise(F.lit(""))


def _attachment(part: Column) -> Column:
    tokens = F.lit(0).cast("long")
    for kind, each in UNIT_TOKENS.items():
        tokens = F.when(part["kind"] == kind, F.greatest(F.coalesce(part["units"], F.lit(0)), F.lit(0)) * each).otherwise(tokens)
    return F.struct(part["kind"].alias("kind"), part["ref"].alias("ref"), tokens.cast("long").alias("tokens"))


def format_turns(messages: DataFrame) -> DataFrame:
    """One formatted segment per row of ``messages`` (conv_id, turn, role, parts).

    Returns (conv_id, turn, segment, loss_start, loss_end, attachments, expanded_tokens). A segment is
    ``<s>[INST]role[/INST]text</s>``; the span [loss_start, loss_end) of an assistant's segment covers its
    escaped content in code points, other spans are empty. Null texts, roles and part lists are empty;
    parts of an unknown kind are left out of the text and kept among the attachments with 0 tokens.
    Repeated rows give repeated segments.
    """
    parts = F.coalesce(F.col("parts"), F.array().cast(f"array<{PART}>"))
    role = escape(F.coalesce(F.col("role"), F.lit("")))
    body = F.array_join(F.transform(parts, _visit), "")
    others = F.filter(parts, lambda p: F.coalesce(p["kind"], F.lit("")) != "text")
    head = F.concat(F.lit(BEGIN + INST), role, F.lit(INST_END))
    shaped = messages.select(
        "conv_id", "turn", head.alias("head"), body.alias("body"), F.col("role").eqNullSafe("assistant").alias("learn"),
        F.transform(others, _attachment).alias("attachments"))
    start = F.length("head").cast("long")
    return shaped.select(
        "conv_id", "turn", F.concat("head", "body", F.lit(END)).alias("segment"), start.alias("loss_start"),
        F.when(F.col("learn"), start + F.length("body")).otherwise(start).alias("loss_end"), "attachments",
        F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias("expanded_tokens"))


_SEGMENT = re.compile(r"<s>\[INST\]((?:\\.|[^\\<\[])*)\[/INST\]((?:\\.|[^\\<\[]|<(?:image|audio|document)>)*)</s>", re.DOTALL)
_ESCAPE = re.compile(r"\\(.)", re.DOTALL)


def parse(segment: str) -> tuple[str, str]:
    """Role and text of a segment; placeholders stay as they are."""
    role, body = _SEGMENT.fullmatch(segment).groups()
    return unescape(role), unescape(body)


def unescape(text: str) -> str:
    return _ESCAPE.sub(r"\1", text)


READ_BACK = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def row():
        return [conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars]

    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    conv, n, done = None, 0, []
    turns = loss = None
    loss_chars = chars = 0
    for batch in batches:
        for key, segment, low, high in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "segment", "loss_start", "loss_end"))):
            if key != conv or not n:
                if n:
                    done.append(row())
                conv, n, turns, loss, loss_chars, chars = key, 0, hashlib.sha256(), hashlib.sha256(), 0, 0
            role, text = parse(segment)
            turns.update(f"{role}\n{text}\n".encode())
            learnt = unescape(segment[low:high])
            loss.update(learnt.encode())
            n, loss_chars, chars = n + 1, loss_chars + len(learnt), chars + len(segment)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
            done = []
    if n:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*[row()]), schema)], schema=schema)


def read_back(segments: DataFrame) -> DataFrame:
    """Digest per conversation of what the formatted segments hold.

    Conversations stream through their task turn by turn: memory holds one batch, however long a
    conversation is. Rows of the same turn are ordered by their segment; rows without conv_id are one conversation. Repeated
    rows count as often as they occur; an empty table gives no rows.
    """
    ordered = segments.select("conv_id", "turn", "segment", "loss_start", "loss_end").repartition("conv_id").sortWithinPartitions(
        "conv_id", "turn", "segment")
    return ordered.mapInArrow(_read_back, READ_BACK)
