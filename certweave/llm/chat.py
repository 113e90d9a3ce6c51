"""Chat formatting: conversations rendered by a compiled template, with the spans to learn from."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship
from .templates import compile_template

#: Turns are bracketed by ``<turn role>`` and ``</turn>``; neither can occur inside, as ``<``, ``>`` and ``\`` are escaped there.
TEMPLATE = """{% for turn in messages %}<turn {{ turn.role | escape }}>
{% if turn.role == "assistant" %}{% generation %}{{ turn.text | escape }}{% endgeneration %}{% else %}{{ turn.text | escape }}{% endif %}</turn>
{% endfor %}"""
TURN = re.compile(r"<turn ((?:[^\\<>]|\\.)*)>\n((?:[^\\<>]|\\.)*)</turn>\n", re.S)
ROOM = 1 << 20  # code points of a conversation's output in one row, unless a single turn has more
SCHEMA = "conv_id long, part long, start long, text string, learned array<struct<start:long,length:long>>, last boolean"


def escape(text: str) -> str:
    return re.sub(r"[\\<>]", r"\\\g<0>", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


FILTERS = {"escape": escape, "trim": str.strip, "lower": str.lower, "upper": str.upper}


def _by_conversation(rows: Iterator) -> Iterator:
    """(key, rows of the key) of neighbours; the rows must be used up before the next key is asked for."""
    from itertools import groupby

    return groupby(rows, key=lambda r: r[0])


def format_conversations(turns: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """The output of every conversation, in parts: conv_id, part, start, text, learned, last.

    A conversation's parts follow each other inside one partition; nearly all have one part.
    ``start`` counts the code points before a part, ``learned`` the spans inside it (from its
    own start) that the template generates for learning. Turns are in the order of turn
    (null last), role, text. Null roles and texts are empty, null ids are one conversation,
    repeated rows are turns of their own, other columns are ignored. A conversation is
    streamed through its task, never held, so its length does not matter.
    """
    ship(turns.sparkSession)
    compile_template(template, FILTERS)  # an error shows here, not in a task

    def run(batches):
        import pyarrow as pa

        render = compile_template(template, FILTERS)
        span = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
        schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("start", pa.int64()), ("text", pa.string()), ("learned", span), ("last", pa.bool_())])
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        out, held = [], 0
        for key, own in _by_conversation(rows):
            part, start, at, texts, spans = 0, 0, 0, [], []
            for segment in render({"messages": ({"role": r[1], "text": r[2]} for r in own)}):
                if segment is None:
                    if at >= ROOM:
                        out.append((key, part, start, "".join(texts), spans, False))
                        part, start, held, at, texts, spans = part + 1, start + at, held + at, 0, [], []
                        if held >= 4 * ROOM:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                            out, held = [], 0
                    continue
                text, learned = segment
                if learned:
                    spans.append({"start": at, "length": len(text)})
                texts.append(text)
                at += len(text)
            out.append((key, part, start, "".join(texts), spans, True))
            held += at
            if held >= 4 * ROOM or len(out) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                out, held = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    empty = F.lit("")
    plain = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"), "turn")
    ordered = plain.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_last(), "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(run, SCHEMA)


READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(formatted: DataFrame) -> DataFrame:
    """What the formatted output says: a row per conversation with digests of its turns and of the learned text.

    formatted: as ``format_conversations`` with the default template returns it, parts in order.
    """
    def run(batches):
        import pyarrow as pa

        schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
        n = chars = loss = 0
        turns, learned = hashlib.sha256(), hashlib.sha256()
        for batch in batches:
            out = []
            for key, _, _, text, spans, last in zip(*(c.to_pylist() for c in batch.columns)):
                at = 0
                for m in TURN.finditer(text):
                    if m.start() != at:
                        break
                    turns.update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode())
                    n, at = n + 1, m.end()
                if at != len(text):
                    raise ValueError(f"conversation {key}: no turn at {at} of a part")
                for s in spans:
                    plain = unescape(text[s["start"]:s["start"] + s["length"]])
                    learned.update(plain.encode())
                    loss += len(plain)
                chars += len(text)
                if last:
                    out.append((key, n, turns.hexdigest(), loss, learned.hexdigest(), chars))
                    n = chars = loss = 0
                    turns, learned = hashlib.sha256(), hashlib.sha256()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return formatted.mapInArrow(run, READ)
