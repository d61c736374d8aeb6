"""Conversations as text in which every turn can be found again, and back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerline.session import ship_package

# The template. A turn is its head line, its text and its end mark.
HEAD = "### "
AFTER_ROLE = ":\n"
END = "\n</turn>\n"

ESCAPE = "\\"
# What the parser would take for the template, with any number of escapes before it.
_HEAD_LINE = re.compile(r"(?m)^(\\*### )")
_END_MARK = re.compile(r"(\\*</turn>)")
_ESCAPED_HEAD = re.compile(r"(?m)^\\(\\*### )")
_ESCAPED_END = re.compile(r"\\(\\*</turn>)")
_BARE = re.compile(r"(?m)^### |(?<!\\)</turn>")
_NAME_ESCAPES = {"\\": "\\\\", "\n": "\\n", ":": "\\c"}
_NAME_ORIGINALS = {v[1]: k for k, v in _NAME_ESCAPES.items()}


def escape(text: str) -> str:
    """One more escape before each head at the start of a line and each end mark.

    Escapes that are there already are followed by one more, so that taking one away restores the text.
    """
    return _END_MARK.sub(r"\\\1", _HEAD_LINE.sub(r"\\\1", text))


def unescape(text: str) -> str:
    return _ESCAPED_HEAD.sub(r"\1", _ESCAPED_END.sub(r"\1", text))


def escape_role(role: str) -> str:
    return "".join(_NAME_ESCAPES.get(c, c) for c in role)


def unescape_role(name: str) -> str:
    return re.sub(r"\\(.)", lambda m: _NAME_ORIGINALS[m[1]], name)


def parse(turns: str) -> Iterator[tuple[str, str, int, int]]:
    """Role, text and place of the text of each turn, by the grammar ``(HEAD role AFTER_ROLE text END)*``.

    Deterministic: the first end mark ends a turn. A head line or an end mark inside a text needs an
    escape; one without, and whatever else does not fit, is an error.
    """
    at = 0
    while at < len(turns):
        name_end = turns.find(AFTER_ROLE, at)
        start = name_end + len(AFTER_ROLE)
        end = turns.find(END, start)
        if not turns.startswith(HEAD, at) or name_end < 0 or end < 0:
            raise ValueError(f"no turn at {at}")
        body = turns[start:end]
        if _BARE.search(body):
            raise ValueError(f"the template occurs inside the turn at {at}")
        yield unescape_role(turns[at + len(HEAD) : name_end]), unescape(body), start, end
        at = end + len(END)


def render(role: str, text: str) -> str:
    """A turn in the template that the parser reads as ``role`` and ``text``.

    The text goes in as it is. If what the parser recovers differs from the source, or nothing is
    recovered, the conflicting content is escaped.
    """
    for body in (text, escape(text)):
        turn = f"{HEAD}{escape_role(role)}{AFTER_ROLE}{body}{END}"
        try:
            if [found[:2] for found in parse(turn)] == [(role, text)]:
                return turn
        except ValueError:
            continue
    raise ValueError("the text cannot be told from the template")


_TURN = "formatted string, loss_start int, loss_end int, role_read string, text_read string"


def format_turns(
    rows: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    trained: str = "assistant",
) -> DataFrame:
    """Each row in the template: ``formatted``, and what the parser reads back from it.

    ``loss_start`` and ``loss_end`` bound the text in ``formatted`` (characters) if the role is
    ``trained``, else both are 0. ``role_read`` and ``text_read`` come from the parsed output. A
    conversation is its turns' ``formatted`` one after the other; turns do not look at each other,
    so no conversation is gathered. A null role or text is empty. Other columns are left out.
    """
    ship_package(rows.sparkSession)
    wanted = rows.select(
        F.col(conversation).alias("conversation"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for name, body in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist()):
                formatted = render(name, body)
                ((name_read, text_read, start, end),) = parse(formatted)
                mask = (start, end) if name_read == trained else (0, 0)
                out.append((formatted, *mask, name_read, text_read))
            columns = list(zip(*out)) or [()] * 5
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string()]
            made = [pa.array(c, k) for c, k in zip(columns, kinds)]
            names = ["conversation", "turn", "formatted", "loss_start", "loss_end", "role_read", "text_read"]
            yield pa.RecordBatch.from_arrays([batch.column("conversation"), batch.column("turn"), *made], names)

    kinds = wanted.schema
    schema = T.StructType([kinds["conversation"], kinds["turn"], *T._parse_datatype_string(_TURN).fields])
    return wanted.mapInArrow(apply, schema)


def conversation_digests(turns: DataFrame) -> DataFrame:
    """Per conversation, from the output of :func:`format_turns`: counts and digests in order of turns.

    ``conversation``, ``n_turns``, ``turns_sha256`` (role and text, a line feed after each),
    ``loss_chars`` and ``loss_sha256`` (all trained text, read back) and ``formatted_chars``. Turns with
    equal numbers (null first) follow each other by role and text. Rows are sorted within their
    partition and read once, so a conversation of any length needs the memory of one batch.
    """
    ship_package(turns.sparkSession)
    keys = ["conversation", "turn", "role_read", "text_read"]
    placed = turns.repartition("conversation").sortWithinPartitions(*keys)
    kind = turns.schema["conversation"].dataType.simpleString()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def closed(state: list) -> pa.RecordBatch:
            key, n, whole, chars, loss, size = state
            row = [key, n, whole.hexdigest(), chars, loss.hexdigest(), size]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], names)

        names = ["conversation", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        state = None
        for batch in batches:
            kinds = [batch.schema.field("conversation").type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            for row in batch.to_pylist():
                if state is None or state[0] != row["conversation"]:
                    if state is not None:
                        yield closed(state)
                    state = [row["conversation"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                masked = unescape(row["formatted"][row["loss_start"] : row["loss_end"]])
                state[1] += 1
                state[2].update(f"{row['role_read']}\n{row['text_read']}\n".encode())
                state[3] += len(masked)
                state[4].update(masked.encode())
                state[5] += len(row["formatted"])
        if state is not None:
            yield closed(state)

    schema = (
        f"conversation {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long"
    )
    return placed.mapInArrow(apply, schema)
