"""License wording found by templates that are compiled to token automata.

A template is license wording with markup: ``<<beginOptional>> … <<endOptional>>`` may be left out, and
``<<var;name="…";least="0";most="9">>`` stands for that many words of any kind. All other words must be
there, exactly and in order. Texts are lower-cased (A to Z) and read as words of digits, the letters a to z
and characters beyond ASCII; everything else only separates words.

The templates are one nondeterministic automaton over words, run as a deterministic one whose states are
made when they are first met. It starts at every place of a text that holds a word some template can begin
with, ends where nothing can follow, and accepts for each template the longest wording that starts there. Plain
phrases are templates without markup. Nothing is shuffled; a whole text is read once, whatever its length.

Null and empty texts have no words. Repeated rows are scanned one by one; other columns are not used.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.session import ship_package

SLICE_BYTES = 4 * 1024 * 1024
STATES = 20_000  # made states that a worker keeps

# Phrases whose words must stand one after the other, and their labels.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

# Public license notices, shortened to the wording that identifies them.
TEMPLATES = (
    (
        "agpl-3",
        "gnu affero general public license <<beginOptional>>as published by the free software foundation"
        "<<endOptional>> <<beginOptional>>either<<endOptional>> version 3",
    ),
    (
        "apache-2",
        "licensed under the <<beginOptional>>terms of the<<endOptional>> apache <<beginOptional>>software"
        "<<endOptional>> license <<beginOptional>>version<<endOptional>> 2 <<beginOptional>>0<<endOptional>>",
    ),
    (
        "bsd",
        "redistribution and use <<beginOptional>>of this software<<endOptional>> in source and binary forms with or "
        "without modification are permitted provided that the following conditions are met",
    ),
    ("cc-by-nc", "creative commons attribution noncommercial"),
    ("cc-by-nc", "creative commons attribution non commercial"),
    (
        "cc-by-nc",
        "licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>> cc by nc "
        "<<beginOptional>><<var;name=\"version\";least=\"1\";most=\"1\">> 0<<endOptional>>",
    ),
    ("cc-by-sa", "creative commons attribution share <<beginOptional>>alike<<endOptional>>"),
    ("cc-by-sa", "licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>> cc by sa"),
    (
        "gpl-2",
        "gnu general public license <<beginOptional>>as published by the free software foundation"
        "<<endOptional>> <<beginOptional>>either<<endOptional>> version 2",
    ),
    (
        "gpl-3",
        "gnu general public license <<beginOptional>>as published by the free software foundation"
        "<<endOptional>> <<beginOptional>>either<<endOptional>> version 3",
    ),
    (
        "gpl-3",
        "licensed under the <<beginOptional>>terms of the<<endOptional>> gnu general public license "
        "<<beginOptional>>gpl<<endOptional>> version 3",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is "
        "hereby granted",
    ),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of "
        "<<var;name=\"work\";least=\"1\";most=\"9\">> to deal in <<var;name=\"title\";least=\"1\";most=\"5\">> "
        "without restriction",
    ),
    (
        "mit",
        "released under the <<beginOptional>>terms of the<<endOptional>> mit <<beginOptional>>x11<<endOptional>> license",
    ),
    (
        "mpl-2",
        "mozilla public license <<beginOptional>>version<<endOptional>> <<beginOptional>>v<<endOptional>> 2",
    ),
    ("unlicense", "free and unencumbered software released into the public domain"),
)

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_MARKS = re.compile(r"<<(.*?)>>")
_COUNT_BLOCK = 1 << 12


def words_of(text: str) -> list[bytes]:
    return _WORD.findall(text.encode().lower())


def parse_template(markup: str) -> list:
    """Parts in order: a word, ``("optional", parts)`` or ``("any", least, most)``."""
    open_parts: list[list] = [[]]
    for k, piece in enumerate(_MARKS.split(markup)):
        if k % 2 == 0:
            open_parts[-1] += words_of(piece)
        elif piece == "beginOptional":
            open_parts.append([])
        elif piece == "endOptional" and len(open_parts) > 1:
            inner = open_parts.pop()
            open_parts[-1].append(("optional", inner))
        elif piece.startswith("var;"):
            given = dict(re.findall(r'(\w+)="([^"]*)"', piece))
            open_parts[-1].append(("any", int(given["least"]), int(given["most"])))
        else:
            raise ValueError(f"unknown markup: <<{piece}>>")
    if len(open_parts) > 1:
        raise ValueError("an optional region is not closed")
    return open_parts[0]


class Automaton:
    """The automaton of some templates, numbered as given."""

    def __init__(self, templates: Sequence[str]) -> None:
        self.by_word: list[dict[bytes, int]] = []  # state to next state, by word
        self.by_any: list[int | None] = []  # by any word
        self.free: list[list[int]] = []  # without a word
        self.ends: dict[int, int] = {}
        first = []
        for number, markup in enumerate(templates):
            begin = self._state()
            end = self._add(begin, parse_template(markup))
            self.ends[end] = number
            first.append(begin)
        opening = self._closure(first)
        if any(self.by_any[s] is not None or s in self.ends for s in opening):
            raise ValueError("a template must begin with a word of its own")
        first_words = sorted({w for s in opening for w in self.by_word[s]})
        # The word comes first in the pattern, which lets the search skip ahead.
        self.searches = [re.compile(w + rb"(?![0-9a-z\x80-\xff])") for w in first_words]
        self.vocabulary = {w for words in self.by_word for w in words}
        self.opening = opening
        self._forget()

    def _state(self) -> int:
        self.by_word.append({})
        self.by_any.append(None)
        self.free.append([])
        return len(self.free) - 1

    def _add(self, at: int, parts: list) -> int:
        for part in parts:
            after = self._state()
            if isinstance(part, bytes):
                self.by_word[at][part] = after
            elif part[0] == "optional":
                self.free[at].append(after)
                inner = self._state()
                self.free[at].append(inner)
                self.free[self._add(inner, part[1])].append(after)
            else:
                _, least, most = part
                for k in range(most + 1):
                    if k >= least:
                        self.free[at].append(after)
                    if k < most:
                        further = self._state()
                        self.by_any[at] = further
                        at = further
            at = after
        return at

    def _closure(self, states) -> frozenset[int]:
        reached, todo = set(states), list(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in reached:
                    reached.add(s)
                    todo.append(s)
        return frozenset(reached)

    def _forget(self) -> None:
        """Keep only the opening state: it is number 0."""
        self.sets, self.numbers = [self.opening], {self.opening: 0}
        self.accepts: list[tuple[int, ...]] = [()]
        self.next: list[dict[bytes | None, int]] = [{}]

    def _step(self, state: int, word: bytes | None) -> int:
        """The state after ``word`` (None: a word of no template); -1 if nothing can follow."""
        after = set()
        for s in self.sets[state]:
            if word in self.by_word[s]:
                after.add(self.by_word[s][word])
            if self.by_any[s] is not None:
                after.add(self.by_any[s])
        met = self._closure(after)
        if not met:
            found = -1
        elif met in self.numbers:
            found = self.numbers[met]
        else:
            found = self.numbers[met] = len(self.sets)
            self.sets.append(met)
            self.accepts.append(tuple(sorted({self.ends[s] for s in met if s in self.ends})))
            self.next.append({})
        self.next[state][word] = found
        return found

    def longest(self, words: Iterator[bytes]) -> dict[int, int]:
        """Templates with wording at the front of ``words``, and how many words of it."""
        if len(self.sets) > STATES:
            self._forget()
        state, found = 0, {}
        for n, word in enumerate(words, 1):
            key = word if word in self.vocabulary else None
            after = self.next[state].get(key)
            state = self._step(state, key) if after is None else after
            if state < 0:
                break
            for number in self.accepts[state]:
                found[number] = n
        return found

    def scan(self, data: bytes, edges: Sequence[int]) -> tuple[np.ndarray, list[list[tuple[int, int, int]]]]:
        """Words of each text, and its places (template, first word, words).

        ``data`` is lower-cased; text k lies from ``edges[k]`` up to one separator before ``edges[k + 1]``.
        """
        letter = _LETTER[np.frombuffer(data, np.uint8)]
        starts = letter.copy()
        starts[1:] &= ~letter[:-1]
        blocks = np.add.reduceat(starts.view(np.uint8), np.arange(0, len(data), _COUNT_BLOCK), dtype=np.int64)
        before = np.concatenate([[0], np.cumsum(blocks)])

        def words_before(at: int) -> int:
            block = at // _COUNT_BLOCK
            return int(before[block]) + int(np.count_nonzero(starts[block * _COUNT_BLOCK : at]))

        base = [words_before(e) for e in edges]
        places: list[list[tuple[int, int, int]]] = [[] for _ in edges[1:]]
        for word in self.searches:
            for hit in word.finditer(data):
                at = hit.start()
                if not starts[at]:
                    continue
                k = bisect_right(edges, at) - 1
                found = self.longest(m.group() for m in _WORD.finditer(data, at, edges[k + 1]))
                if found:
                    first = words_before(at) - base[k]
                    places[k] += [(number, first, n) for number, n in found.items()]
        return np.diff(base), places


def covered(places: Sequence[tuple[int, int, int]]) -> int:
    """Words that lie in at least one place."""
    total = reached = 0
    for first, end in sorted((first, first + n) for _, first, n in places):
        total += max(0, end - max(first, reached))
        reached = max(reached, end)
    return total


@lru_cache(maxsize=4)
def automaton(markups: tuple[str, ...]) -> Automaton:
    return Automaton(markups)


def scan_licenses(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    phrases: Sequence[tuple[str, str]] = PHRASES,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
) -> DataFrame:
    """``id``, ``n_words``, ``places`` (label, base, first_word, n_words; by first word) and ``score`` of each row.

    ``base`` tells the places of plain phrases from those of templates. ``score`` is the share of the text's
    words that lie in some place, 0 for a text without words.
    """
    ship_package(docs.sparkSession)
    labels = [(label, True) for label, _ in phrases] + [(label, False) for label, _ in templates]
    markups = tuple(markup for _, markup in (*phrases, *templates))
    Automaton(markups)  # a faulty template ends the call and not a task
    place = pa.struct([("label", pa.string()), ("base", pa.bool_()), ("first_word", pa.int64()), ("n_words", pa.int64())])
    names = ["id", "n_words", "places", "score"]

    def scanned(ids: pa.Array, texts: list[bytes]) -> pa.RecordBatch:
        edges = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).tolist()
        counts, found = automaton(markups).scan(b"\n".join(texts) + b"\n", edges)
        rows = [
            [
                {"label": labels[t][0], "base": labels[t][1], "first_word": first, "n_words": n}
                for t, first, n in sorted(some, key=lambda p: (p[1], p[0]))
            ]
            for some in found
        ]
        scores = [covered(some) / n if n else 0.0 for some, n in zip(found, counts.tolist())]
        columns = [ids, pa.array(counts, pa.int64()), pa.array(rows, pa.list_(place)), pa.array(scores, pa.float64())]
        return pa.RecordBatch.from_arrays(columns, names)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[bytes] = []
            size = first = 0
            for k, text in enumerate(batch.column(1)):
                held.append((text.as_py() or "").encode().lower())
                size += len(held[-1])
                if size >= SLICE_BYTES or k + 1 == batch.num_rows:
                    yield scanned(batch.column(0).slice(first, len(held)), held)
                    held, size, first = [], 0, k + 1

    kind = docs.schema[id_column].dataType.simpleString()
    struct = "struct<label: string, base: boolean, first_word: bigint, n_words: bigint>"
    asked = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return asked.mapInArrow(scan, f"id {kind}, n_words bigint, places array<{struct}>, score double")


def license_summary(scanned: DataFrame) -> DataFrame:
    """Per row of :func:`scan_licenses`: counts and first and last place of the phrases, and the labels of both kinds."""
    base = F.filter("places", lambda p: p["base"])
    first = F.transform(base, lambda p: p["first_word"])

    def joined(places: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")

    return scanned.select(
        "id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(first).alias("first_word"),
        F.array_max(first).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.col("places")).alias("labels"),
        "score",
    )
