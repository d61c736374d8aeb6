"""Removing repeated passages of words, by suffix trees over groups of suffixes with a common prefix."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerline.llm.repeats import Shown, Task, Tokens, losing, mark_repeats, ranges, slices, split_words
from ledgerline.llm.suffix_array import binary_array

LENGTH = 35
GRAM = 8
SUBTREE_SUFFIXES = 200_000


def prefix_groups(words: np.ndarray, starts: np.ndarray, depth: int, most: int) -> Iterator[np.ndarray]:
    """Suffixes in groups of about ``most``: each prefix is as long as its group needs.

    A prefix with more suffixes is made a word longer, up to ``depth``; groups with few suffixes are
    handed over together.
    """
    group = np.zeros(len(starts), np.int64)
    for at in range(depth):
        large = np.bincount(group)[group] > most
        if not large.any():
            break
        code = np.where(large, words[starts + at], -1)
        _, group = np.unique(np.stack([group, code]), axis=1, return_inverse=True)
        group = group.ravel()
    order = np.argsort(group, kind="stable")
    sizes = np.bincount(group)
    load = (np.cumsum(sizes) - sizes) // max(most, 1)
    for _, lo, hi in slices(load[group[order]]):
        yield order[lo:hi]


def deep_nodes(words: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes below an internal node of at least ``depth`` words, and the node of each.

    The subtree is built from the root down: a node's suffixes branch by their next word, one that
    branches off alone is a leaf and needs no more words. What is left at ``depth`` is below the
    nodes that are maximal repeats.
    """
    alive, node = np.arange(len(starts)), np.zeros(len(starts), np.int64)
    for at in range(depth):
        if not len(alive):
            break
        word = words[starts[alive] + at]
        order = np.lexsort((word, node))
        n, w = node[order], word[order]
        number = np.cumsum(np.r_[True, (n[1:] != n[:-1]) | (w[1:] != w[:-1])]) - 1
        several = np.bincount(number)[number] > 1
        alive, node = alive[order[several]], number[several]
    return alive, node


def _resolve(shown: list[Shown], task: Task, most: int = SUBTREE_SUFFIXES) -> list[np.ndarray]:
    known: dict[bytes, int] = {}
    codes = []
    for part in shown:
        edges = np.cumsum(np.r_[0, part.sizes])
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
            codes.extend(known.setdefault(w, len(known)) for w in part.data[lo:hi].split())
    words = np.array(codes, np.int64)
    windows = np.concatenate([s.windows for s in shown])
    ids = np.repeat(np.concatenate([s.ids for s in shown]), windows)
    sizes = windows + task.length - 1
    starts = ranges(np.cumsum(sizes) - sizes, windows)
    lost = np.zeros(len(starts), bool)
    for some in prefix_groups(words, starts, task.length, most):
        alive, node = deep_nodes(words, starts[some], task.length)
        value = ids[some][alive] if task.first_stays else np.ones(len(alive), np.int64)
        lost[some[alive]] = losing(node, value, task.first_stays)
    return np.split(lost, np.cumsum([s.windows.sum() for s in shown])[:-1])


def drop_repeated_words(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
) -> DataFrame:
    """Remove each word covered by a window of ``length`` words that occurs more than once anywhere.

    Columns: the id, ``n_words``, ``n_removed`` and ``kept``, the other words joined by one space.
    Words are what lies between spaces and the bytes 0x09 to 0x0D, unchanged. All occurrences go, in
    whichever document; windows are judged on the input. A null text has no words, equal rows
    repeat each other, ids (null, equal) do not matter. Other columns are not read.
    """
    docs = docs.select(id_column, text_column)
    task = Task(id_column, text_column, split_words, length, gram, False, _resolve)

    def finish(rows: pa.Table, data: np.ndarray, covered: np.ndarray, tokens: Tokens) -> pa.Table:
        offsets = tokens.offsets
        stays = np.nonzero(~covered)[0]
        row = np.searchsorted(offsets, stays, "right") - 1
        n_words = np.diff(offsets)
        n_kept = np.bincount(row, minlength=len(n_words))
        size = tokens.end[stays] - tokens.first[stays]
        space = np.r_[row[1:] == row[:-1], np.zeros(min(1, len(row)), bool)]
        place = np.cumsum(size + space) - size - space
        out = np.full(int((size + space).sum()), 32, np.uint8)
        out[ranges(place, size)] = data[ranges(tokens.first[stays], size)]
        sizes = np.bincount(row, size + space, len(n_words)).astype(np.int64)
        return pa.table(
            {
                id_column: rows.column(id_column),
                "n_words": n_words.astype(np.int64),
                "n_removed": (n_words - n_kept).astype(np.int64),
                "kept": binary_array(out, sizes, pa.string()),
            }
        )

    kind = docs.schema[id_column].dataType.simpleString()
    return mark_repeats(docs, task, finish, f"`{id_column}` {kind}, n_words long, n_removed long, kept string")
