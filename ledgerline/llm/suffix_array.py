"""Removing byte strings that also start in an earlier document, by radix sort of suffixes."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from ledgerline.llm.repeats import Shown, Task, Tokens, losing, mark_repeats, ranges, split_bytes

LENGTH = 50
GRAM = 16
DIGIT = 8  # bytes that one pass sorts by


def radix_groups(data: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes whose first ``depth`` bytes (``DIGIT`` at least) occur twice or more, and the group of each.

    Passes go from the most significant digit on. Each sorts the suffixes within their groups by
    the next digit, and a suffix that is alone is done: no later digit is read for it. The last
    digit may overlap the one before.
    """
    codes = data.astype(np.uint64)
    for step in (1, 2, 4):
        codes = (codes[:-step] << np.uint64(8 * step)) | codes[step:]
    alive, group = np.arange(len(starts)), np.zeros(len(starts), np.int64)
    for at in [*range(0, depth - DIGIT, DIGIT), depth - DIGIT]:
        if not len(alive):
            break
        digit = codes[starts[alive] + at]
        order = np.lexsort((digit, group))
        g, d = group[order], digit[order]
        new = np.r_[True, (g[1:] != g[:-1]) | (d[1:] != d[:-1])]
        number = np.cumsum(new) - 1
        several = np.bincount(number)[number] > 1
        alive, group = alive[order[several]], number[several]
    return alive, group


def _resolve(shown: list[Shown], task: Task) -> list[np.ndarray]:
    data = np.frombuffer(b"".join(s.data for s in shown), np.uint8)
    sizes = np.concatenate([s.sizes for s in shown])
    windows = np.concatenate([s.windows for s in shown])
    ids = np.repeat(np.concatenate([s.ids for s in shown]), windows)
    starts = ranges(np.cumsum(sizes) - sizes, windows)
    alive, group = radix_groups(data, starts, task.length)
    lost = np.zeros(len(starts), bool)
    lost[alive] = losing(group, ids[alive], task.first_stays)
    return np.split(lost, np.cumsum([s.windows.sum() for s in shown])[:-1])


def byte_task(id_column: str, text_column: str, length: int, gram: int) -> Task:
    if not DIGIT <= gram <= length:
        raise ValueError(f"needs {DIGIT} <= gram <= length")
    return Task(id_column, text_column, split_bytes, length, gram, True, _resolve)


def drop_repeated_bytes(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
) -> DataFrame:
    """Remove each byte covered by a ``length``-byte string that also starts in a row with a smaller id.

    Columns: the id, ``n_bytes``, ``n_removed``, ``spans`` (start and end of each maximal removed
    run, in bytes of the input) and ``kept`` (the bytes that are left). A null text is empty. Rows
    that share an id do not remove from each other; a null id comes after every other. Other columns
    are not read. An empty table gives an empty result.
    """
    docs = docs.select(id_column, text_column)
    schema = (
        f"`{id_column}` {docs.schema[id_column].dataType.simpleString()}, n_bytes long, n_removed long, "
        "spans array<struct<start:long,end:long>>, kept binary"
    )
    return mark_repeats(docs, byte_task(id_column, text_column, length, gram), _with_spans(id_column), schema)


def _with_spans(id_column: str) -> Callable:
    def finish(rows: pa.Table, data: np.ndarray, covered: np.ndarray, tokens: Tokens) -> pa.Table:
        offsets = tokens.offsets
        removed = np.diff(np.r_[0, np.cumsum(covered)][offsets])
        inside = covered.copy()
        inside[offsets[(offsets > 0) & (offsets < len(covered))]] = False  # a run ends with its row
        starts = np.nonzero(covered & ~np.r_[False, covered[:-1]] | covered & ~inside)[0]
        ends = np.r_[starts[1:], len(covered)]
        if len(starts):
            ends = starts + np.add.reduceat(covered, starts, dtype=np.int64)
        row = np.searchsorted(offsets, starts, "right") - 1
        spans = pa.StructArray.from_arrays([starts - offsets[row], ends - offsets[row]], ["start", "end"])
        return pa.table(
            {
                id_column: rows.column(id_column),
                "n_bytes": np.diff(offsets),
                "n_removed": removed.astype(np.int64),
                "spans": pa.ListArray.from_arrays(np.searchsorted(row, np.arange(len(offsets))).astype(np.int32), spans),
                "kept": binary_array(data[~covered], np.diff(offsets) - removed),
            }
        )

    return finish


def binary_array(data: np.ndarray, sizes: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    offsets = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    large = pa.Array.from_buffers(pa.large_binary(), len(sizes), buffers)
    return large.cast(pa.binary()) if kind is None else large.cast(kind)


def clean_repeated_bytes(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    size_column: str | None = "n_chars",
    length: int = LENGTH,
    gram: int = GRAM,
) -> DataFrame:
    """``docs`` with the repeated byte strings cut out of ``text_column``, all columns kept.

    A character goes only if each of its bytes does, so the text stays valid. ``size_column`` gets
    the new number of characters. A row that loses its whole text is left out, a row that had
    none is not; a null text stays null.
    """
    names = docs.columns

    def finish(rows: pa.Table, data: np.ndarray, covered: np.ndarray, tokens: Tokens) -> pa.Table:
        offsets = tokens.offsets
        head = (data & 0xC0) != 0x80
        if len(data):
            whole = np.logical_and.reduceat(covered, np.nonzero(head)[0])
            covered = whole[np.cumsum(head) - 1]
        before = np.diff(offsets)
        sizes = before - np.diff(np.r_[0, np.cumsum(covered)][offsets])
        text = binary_array(data[~covered], sizes, pa.string())
        old = rows.column(text_column)
        text = pc.if_else(pc.is_null(old), pa.scalar(None, pa.string()), text)
        at = rows.schema.get_field_index(text_column)
        rows = rows.set_column(at, rows.schema.field(at).with_type(pa.string()), text)
        if size_column in names:
            at = rows.schema.get_field_index(size_column)
            length_now = pc.utf8_length(text)
            field = rows.schema.field(at)
            rows = rows.set_column(at, field, length_now.cast(field.type))
        return rows.filter(pa.array((sizes > 0) | (before == 0)))

    return mark_repeats(docs, byte_task(id_column, text_column, length, gram), finish, docs.schema)
