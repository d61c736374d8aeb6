"""Byte-level BPE: texts to token ids and back."""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.llm.repeats import ranges, slices, text_bytes
from ledgerline.llm.suffix_array import binary_array
from ledgerline.session import ship_package

KEYS_PER_BUCKET = 2
WORDS = 200_000  # words whose ids a worker remembers, the first that it meets
PIECES = 400_000  # pre-tokens that it remembers, until there are more
SLICE_BYTES = 500_000
SLICE_ROWS = 1_000

_MASK = (1 << 64) - 1


def load_ranks(path: str) -> dict[bytes, int]:
    """Byte strings and their ids from a file of base64 strings and ranks, one a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PerfectHash:
    """A minimal perfect hash: n keys have the n slots 0 to n - 1, one each.

    Keys are dealt into small buckets. From the largest bucket on, the first displacement that sends
    all keys of the bucket to free slots is kept; a lookup is one hash, one displacement and one
    comparison with the key in the slot, since strings that are no keys have a slot as well.
    """

    def __init__(self, keys: list[bytes]) -> None:
        self.size = len(keys)
        self.buckets = max(1, self.size // KEYS_PER_BUCKET)
        self.shift = [0] * self.buckets
        slots: list[bytes | None] = [None] * self.size
        members: list[list[tuple[int, bytes]]] = [[] for _ in range(self.buckets)]
        for key in keys:
            code = xxhash.xxh64_intdigest(key)
            members[code % self.buckets].append((code, key))
        for bucket in sorted(range(self.buckets), key=lambda b: -len(members[b])):
            displacement = 0
            while True:
                found = [self._slot(code, displacement) for code, _ in members[bucket]]
                if len(set(found)) == len(found) and all(slots[s] is None for s in found):
                    break
                displacement += 1
            self.shift[bucket] = displacement
            for slot, (_, key) in zip(found, members[bucket]):
                slots[slot] = key
        self.keys = slots

    def _slot(self, code: int, displacement: int) -> int:
        mixed = ((code ^ (displacement * 0x9E3779B97F4A7C15)) * 0xD6E8FEB86659FD93) & _MASK
        return (mixed >> 32) % self.size

    def find(self, key: bytes) -> int:
        """The slot of ``key``, or -1."""
        if not self.size:
            return -1
        code = xxhash.xxh64_intdigest(key)
        slot = self._slot(code, self.shift[code % self.buckets])
        return slot if self.keys[slot] == key else -1


# Classes whose members depend on the version of Unicode that a library knows.
CLASSES = (r"\p{L}", r"\p{N}", r"\s", r"\S")


def every_character() -> str:
    return "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))


def library_class(name: str, text: str) -> str:
    """The characters of ``text`` that the tokenizer library takes as members of a class.

    The library encodes what its pattern matches and passes over the rest; with the 256 bytes as its only tokens
    the ids are the bytes of the members.
    """
    import tiktoken

    bytes_only = {bytes([b]): b for b in range(256)}
    asked = tiktoken.Encoding("members", pat_str=name, mergeable_ranks=bytes_only, special_tokens={})
    return bytes(asked.encode_ordinary(text)).decode()


def class_ranges(members: str) -> str:
    """Members in ascending order as ranges, to stand between brackets."""
    codes = np.array([ord(c) for c in members], np.int64)
    cut = np.nonzero(np.diff(codes, prepend=-2) != 1)[0]
    ends = np.append(cut[1:], len(codes)) - 1
    return "".join(f"\\U{codes[a]:08x}-\\U{codes[b]:08x}" for a, b in zip(cut, ends))


@lru_cache(maxsize=1)
def unicode_differences() -> tuple[dict[str, str], frozenset[str]]:
    """The library's classes as ranges, and all characters that belong to a class here but not there or the reverse."""
    text, ranges_of, odd = every_character(), {}, set()
    for name in CLASSES:
        theirs = library_class(name, text)
        ranges_of[name] = class_ranges(theirs)
        odd |= set(theirs) ^ set(regex.findall(name, text))
    return ranges_of, frozenset(odd)


def with_classes(pattern: str, ranges_of: dict[str, str]) -> str:
    """``pattern`` with each class spelled out."""
    out, inside = [], False
    for part in regex.findall(r"\\p\{\w+\}|\\.|.", pattern, regex.DOTALL):
        if part in ranges_of:
            out.append(ranges_of[part] if inside else f"[{ranges_of[part]}]")
            continue
        inside = (inside or part == "[") and part != "]"
        out.append(part)
    return "".join(out)


class Encoder:
    """Ids of pre-tokens: the whole pre-token by perfect hash, else by merging its bytes."""

    def __init__(self, path: str, pattern: str) -> None:
        self.ranks = load_ranks(path)
        self.whole = PerfectHash(list(self.ranks))
        self.ids = [self.ranks[key] for key in self.whole.keys]
        self.split = regex.compile(pattern).findall
        # Most texts hold no character that another version of Unicode sees otherwise, and single classes are fast.
        ranges_of, self.odd = unicode_differences()
        self.split_odd = regex.compile(with_classes(pattern, ranges_of)).findall if self.odd else self.split
        lowest = min(map(ord, self.odd), default=0x10FFFF)
        self.may_be_odd = regex.compile(f"[\\U{lowest:08x}-\\U0010ffff]").search
        self.blank_edge = regex.compile(r"\A\s|\s\Z").search
        self.known: dict[str, bytes] = {}
        self.made: dict[str, bytes] = {}
        self.pairs = {tuple(key): rank for key, rank in self.ranks.items() if len(key) == 2}

    def pretoken(self, piece: bytes) -> list[int]:
        slot = self.whole.find(piece)
        return [self.ids[slot]] if slot >= 0 else self.merge(piece)

    def merge(self, piece: bytes) -> list[int]:
        """Merge the neighbours of lowest rank, leftmost first, until no two make a token.

        Bytes are a doubly linked list. Each mergeable pair waits in a heap, its rank, place and end
        in one number; a pair is stale if a side was merged meanwhile, which shows in the ends.
        """
        n, get = len(piece), self.ranks.get
        heap = [
            rank << 64 | i << 32 | i + 2
            for i, rank in enumerate(map(self.pairs.get, zip(piece, piece[1:])))
            if rank is not None
        ]
        heapq.heapify(heap)
        end, before = list(range(1, n + 1)), list(range(-1, n))
        while heap:
            top = heapq.heappop(heap)
            i, stop = top >> 32 & 0xFFFFFFFF, top & 0xFFFFFFFF
            j = end[i]
            if not j or j >= n or end[j] != stop:
                continue
            end[i], end[j], before[stop] = stop, 0, i
            if stop < n:
                rank = get(piece[i : end[stop]])
                if rank is not None:
                    heapq.heappush(heap, rank << 64 | i << 32 | end[stop])
            if i:
                h = before[i]
                rank = get(piece[h:stop])
                if rank is not None:
                    heapq.heappush(heap, rank << 64 | h << 32 | stop)
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i : end[i]]])
            i = end[i]
        return out

    def encode(self, text: str) -> bytes:
        """The ids of a text as 32-bit integers.

        No pre-token crosses a lone space or line feed between two other characters, but for taking
        the space in front. Words cut there are looked up whole; a text with other white space
        next to a cut goes through the pattern as it is.
        """
        if not text:
            return b""
        if not text.isascii() and self.may_be_odd(text) and not self.odd.isdisjoint(text):
            return self.pieces(text, self.split_odd)
        first, *words = text.replace("\n", " \n").split(" ")
        if not first or self.blank_edge(first):
            return self.pieces(text)
        known, found = self.known, [self.pieces(first)]  # no space comes before it, so it is not in ``known``
        add = found.append
        for word in words:
            ids = known.get(word)
            if ids is None:
                bare = word.removeprefix("\n")
                if not bare or self.blank_edge(bare):
                    return self.pieces(text)
                ids = self.pieces(word if word[0] == "\n" else " " + word)
                if len(known) < WORDS:
                    known[word] = ids
            add(ids)
        return b"".join(found)

    def pieces(self, text: str, split=None) -> bytes:
        made, out = self.made, []
        for piece in (split or self.split)(text):
            ids = made.get(piece)
            if ids is None:
                if len(made) >= PIECES:
                    made.clear()
                ids = made[piece] = array("i", self.pretoken(piece.encode())).tobytes()
            out.append(ids)
        return b"".join(out)


class Decoder:
    """The bytes of all tokens, one after the other, and where each is."""

    def __init__(self, path: str) -> None:
        ranks = load_ranks(path)
        by_id = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            by_id[rank] = token
        self.sizes = np.array([len(t) for t in by_id], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(by_id), np.uint8)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids, one after the other, and how many each has."""
        sizes = self.sizes[ids]
        return self.bytes[ranges(self.starts[ids], sizes)], sizes


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> Encoder:
    """Read and built once per worker."""
    return Encoder(path, pattern)


@lru_cache(maxsize=4)
def decoder(path: str) -> Decoder:
    return Decoder(path)


def _with_columns(docs: DataFrame, likes: dict[str, Column], make) -> DataFrame:
    """Add columns made from each batch, some rows at a time; columns of those names are replaced."""
    ship_package(docs.sparkSession)
    docs = docs.drop(*likes)
    names = [*docs.columns, *likes]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(lo, SLICE_ROWS)
                yield pa.RecordBatch.from_arrays([*part.columns, *make(part)], names)

    return docs.mapInArrow(apply, docs.withColumns(likes).schema)


def _encoded(texts: pa.Array, coder: Encoder) -> pa.ListArray:
    found = [coder.encode(text or "") for text in texts.to_pylist()]
    offsets = np.cumsum([0, *map(len, found)]) // 4
    return pa.ListArray.from_arrays(offsets.astype(np.int32), np.frombuffer(b"".join(found), np.int32))


def _decoded(lists: pa.ListArray, coder: Decoder) -> pa.Array:
    ids, counts = lists.flatten().to_numpy(), lists.value_lengths().fill_null(0).to_numpy()
    edges, parts, sizes = np.concatenate([[0], np.cumsum(counts)]), [], []
    for _, lo, hi in slices(edges[:-1] // (SLICE_BYTES // 4)):
        data, size = coder.decode(ids[edges[lo] : edges[hi]])
        total = np.concatenate([[0], np.cumsum(size)])
        parts.append(data)
        sizes.append(np.diff(total[edges[lo : hi + 1] - edges[lo]]))
    if not parts:
        return pa.array([], pa.binary())
    return binary_array(np.concatenate(parts), np.concatenate(sizes))


def encode_texts(
    docs: DataFrame,
    path: str,
    pattern: str,
    text_column: str = "text",
    ids_column: str = "ids",
    decoded_column: str | None = None,
) -> DataFrame:
    """Add the token ids of each whole text; a null or empty text has none.

    Every match of ``pattern`` is encoded by itself and special tokens are ordinary text. Nothing is
    shuffled. ``path`` must be readable where tasks run. ``decoded_column`` also adds what the ids decode
    to, in the same pass.
    """
    likes = {ids_column: F.array(F.lit(0))} | ({decoded_column: F.lit(b"")} if decoded_column else {})

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        ids = _encoded(batch.column(text_column), encoder(path, pattern))
        return [ids, _decoded(ids, decoder(path))] if decoded_column else [ids]

    return _with_columns(docs, likes, make)


def decode_ids(docs: DataFrame, path: str, ids_column: str = "ids", bytes_column: str = "decoded") -> DataFrame:
    """Add the bytes that the ids stand for; null ids give none. An unknown id is an error."""
    return _with_columns(docs, {bytes_column: F.lit(b"")}, lambda batch: [_decoded(batch.column(ids_column), decoder(path))])
