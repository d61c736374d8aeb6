"""Repeated windows over all documents, in bounded memory.

A window is ``length`` consecutive tokens of one document. Shuffling every window would move many
times the text, so suffixes are sampled first: the smallest hash among the ``gram``-token grams of a
window is its anchor. The anchor depends on nothing but the window, hence equal windows have equal
anchors at equal places, and the windows of one anchor are a run of neighbouring starts. All of a
run is one entry: the hash of its anchor (the prefix that groups entries) and of its whole text.

1. Documents are packed into chunks, compressed, and written once, so that every later read sees the
   same chunks whatever executors are lost.
2. Each chunk sends its distinct entries to buckets by the anchor's hash. Entries with equal text are
   settled there. Where one anchor has several texts, one holder of each must show it.
3. The holders send the text of those runs, and the resolver of the operator compares their windows.
   An anchor with more than ``HOT`` texts (the edge of a passage that a large part of all
   documents holds) sends each window by the window's own hash instead, so no bucket holds it all.
4. Answers return to the chunks, which mark the tokens they cover.

A chunk sends equal entries once, so a text with a third of all rows meets a bucket once per chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ledgerline.session import materialize, ship_package

CHUNK_BYTES = 1_000_000
SLICE_TOKENS = 1 << 16
BUCKET_BYTES = 6_000_000
HOT = 2_000
LONG_WORD = 64

LAST_ID = np.iinfo(np.int64).max

_U = np.uint64
_LOW = _U(0xFFFFFFFF)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


@dataclass(frozen=True)
class Task:
    """``first_stays``: only rows with a larger id than another holder's lose a window, else all do."""

    id_column: str
    text_column: str
    split: Callable[[np.ndarray, np.ndarray], "Tokens"]
    length: int
    gram: int
    first_stays: bool
    resolve: Callable[[list["Shown"], "Task"], list[np.ndarray]]
    buckets: int = 1
    hot: int = HOT


@dataclass
class Tokens:
    """The tokens, where those of each document start, and the bytes of each token.

    Without ``first`` and ``end`` a token is a byte; else it is given by its code.
    """

    raw: np.ndarray
    offsets: np.ndarray
    first: np.ndarray | None = None
    end: np.ndarray | None = None

    def codes(self, lo: int, hi: int | None = None) -> np.ndarray:
        return BYTE_CODES[self.raw[lo:hi]] if self.first is None else self.raw[lo:hi]

    def bytes_of(self, start: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (start, last + 1) if self.first is None else (self.first[start], self.end[last])


@dataclass
class Shown:
    """Runs that one chunk shows: the bytes of each, its number of windows, its row's id."""

    data: bytes
    sizes: np.ndarray
    windows: np.ndarray
    ids: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


BYTE_CODES = mix(np.arange(1, 257, dtype=_U) * _U(_BASE))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, kept for the next chunk."""
    if len(_powers[0]) < n:
        for i, factor in enumerate((_BASE, _INVERSE)):
            steps = np.full(n, factor, _U)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers[0], _powers[1]


class SpanHash:
    """Hash of any span of a sequence of codes, by differences of one running sum."""

    def __init__(self, codes: np.ndarray) -> None:
        up, self.down = _power(len(codes) + 1)
        self.sums = np.zeros(len(codes) + 1, _U)
        np.cumsum(codes * up[: len(codes)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def grams(self, n: int) -> np.ndarray:
        k = len(self.sums) - n
        return mix((self.sums[n:] - self.sums[:k]) * self.down[:k])


def split_bytes(data: np.ndarray, offsets: np.ndarray) -> Tokens:
    return Tokens(data, offsets)


def split_words(data: np.ndarray, offsets: np.ndarray) -> Tokens:
    """Words are what lies between bytes 0x20 and 0x09 to 0x0D and the ends of a document."""
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    starts[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    first, end = np.nonzero(starts)[0], np.nonzero(ends)[0] + 1
    codes = SpanHash(BYTE_CODES[data])(first, end)
    # Sums modulo a power of two can be made equal by words of a thousand bytes: long ones get another hash.
    for k in np.nonzero(end - first > LONG_WORD)[0].tolist():
        codes[k] = xxhash.xxh64_intdigest(data[first[k] : end[k]].tobytes(), _BASE)
    return Tokens(codes, np.searchsorted(first, offsets), first, end)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All of starts[i], starts[i] + 1, ... (counts[i] of them), one after the other."""
    total = int(counts.sum())
    before = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, counts)


def runs_of(codes: np.ndarray, offsets: np.ndarray, task: Task) -> tuple[np.ndarray, ...]:
    """First window, number of windows, anchor and hash of the whole text of each run."""
    n = len(codes) - task.length + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(_U), none.astype(_U)
    span = SpanHash(codes)
    grams = span.grams(task.gram)
    packed = (grams & ~_LOW) | np.arange(len(grams), dtype=_U)
    least = sliding_min(packed, task.length - task.gram + 1)[:n]
    inside = np.ones(n, bool)
    for lo, hi in zip(np.maximum(offsets[:-1], offsets[1:] - task.length + 1).tolist(), offsets[1:].tolist()):
        inside[lo:hi] = False  # a window from here on would cross the end of its document
    starts = np.nonzero(inside)[0]
    at = (least[starts] & _LOW).astype(np.int64)
    first = np.nonzero(np.concatenate([[True], at[1:] != at[:-1]]))[0] if len(at) else at
    start, count = starts[first], np.diff(np.append(first, len(starts)))
    text = mix(span(start, start + count - 1 + task.length) ^ count.astype(_U))
    return start, count, grams[at[first]], text


class Chunk:
    """The runs of a chunk and its distinct entries, the same each time it is built."""

    def __init__(self, blob: bytes, task: Task) -> None:
        self.task = task
        self.batch = pa.ipc.open_stream(blob).read_all().combine_chunks()
        self.data, offsets = text_bytes(self.batch.column(task.text_column))
        ids = self.batch.column(task.id_column).cast(pa.int64())
        self.ids = pc.fill_null(ids, int(LAST_ID)).to_numpy()
        self.tokens = task.split(self.data, offsets)
        self._runs()
        self._entries()

    def _runs(self) -> None:
        """Slice by slice of whole documents, so that the arrays stay in the processor's cache."""
        offsets = self.tokens.offsets
        found = [
            runs_of(self.tokens.codes(offsets[lo], offsets[hi]), offsets[lo : hi + 1] - offsets[lo], self.task)
            for _, lo, hi in slices(offsets[:-1] // SLICE_TOKENS)
        ]
        base = [offsets[lo] for _, lo, _ in slices(offsets[:-1] // SLICE_TOKENS)]
        if not found:
            found, base = [runs_of(self.tokens.codes(0, 0), np.zeros(1, np.int64), self.task)], [0]
        self.start = np.concatenate([f[0] + at for f, at in zip(found, base)])
        self.count, self.anchor, self.text = (np.concatenate([f[k] for f in found]) for k in (1, 2, 3))
        self.row = np.searchsorted(offsets, self.start, "right") - 1

    def _entries(self) -> None:
        """Sorted by bucket and id: anchor, text, and the smallest id or (two at most) the number of runs."""
        ids = self.ids[self.row]
        order = np.lexsort((ids, self.text, self.anchor))
        anchor, text = self.anchor[order], self.text[order]
        new = np.r_[True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])] if len(order) else np.zeros(0, bool)
        head = np.nonzero(new)[0]
        amount = np.diff(np.r_[head, len(order)])
        value = ids[order[head]] if self.task.first_stays else np.minimum(amount, 2)
        bucket = bucket_of(mix(anchor[head]), self.task.buckets)  # anchors are small: they are minima
        place = np.lexsort((value, bucket))
        rank = np.empty(len(place), np.int64)
        rank[place] = np.arange(len(place))
        self.entry = np.empty(len(order), np.int64)
        self.entry[order] = rank[np.cumsum(new) - 1]
        self.shown_run = order[head][place]
        self.bucket, self.value = bucket[place], value[place]
        self.low = (anchor[head][place] & _LOW).astype(np.uint32)
        self.full = text[head][place]

    def status(self, replies: dict[tuple[int, int], bytes]) -> np.ndarray:
        out = np.zeros(len(self.bucket), np.uint8)
        for b, lo, hi in slices(self.bucket):
            out[lo:hi] = np.frombuffer(replies[0, b], np.uint8)
        return out

    def shown(self, status: np.ndarray) -> tuple[list[tuple[int, np.ndarray]], "Windows"]:
        """Runs to show by bucket, and the windows that go by their own hash."""
        calm = np.nonzero((status & 2 > 0) & (status & 4 == 0))[0]
        by_bucket = [(b, self.shown_run[calm[lo:hi]]) for b, lo, hi in slices(self.bucket[calm])]
        return by_bucket, Windows(self, self.shown_run[np.nonzero(status & 4)[0]])


class Windows:
    """The windows of some runs, each distinct one once, by the hash of the window."""

    def __init__(self, chunk: Chunk, runs: np.ndarray) -> None:
        task = chunk.task
        self.runs = runs
        start = ranges(chunk.start[runs], chunk.count[runs])
        ids = np.repeat(chunk.ids[chunk.row[runs]], chunk.count[runs])
        window = SpanHash(chunk.tokens.codes(0))(start, start + task.length)
        order = np.lexsort((ids, window))
        new = np.r_[True, window[order][1:] != window[order][:-1]] if len(order) else np.zeros(0, bool)
        head = np.nonzero(new)[0]
        amount = np.diff(np.r_[head, len(order)])
        self.window = window[order[head]]
        self.value = ids[order[head]] if task.first_stays else np.minimum(amount, 2)
        self.bucket = bucket_of(self.window, task.buckets)
        self.which = np.empty(len(order), np.int64)
        self.which[order] = np.cumsum(new) - 1
        self.ids = ids


def bucket_of(x: np.ndarray, buckets: int) -> np.ndarray:
    return (((x >> _U(32)) * _U(buckets)) >> _U(32)).astype(np.int64)


def slices(sorted_keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
    if len(sorted_keys):
        edges = np.r_[0, np.nonzero(np.diff(sorted_keys))[0] + 1, len(sorted_keys)]
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
            yield int(sorted_keys[lo]), lo, hi


def text_bytes(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column, null as empty, and where each row starts."""
    array = pc.fill_null(column, "")
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
        array = pa.concat_arrays(array.chunks) if isinstance(array, pa.ChunkedArray) else array
    array = array.cast(pa.large_string())
    _, where, data = array.buffers()
    offsets = np.frombuffer(where, np.int64)[array.offset : array.offset + len(array) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    low, high = int(offsets[0]), int(offsets[-1])
    return whole[low:high], offsets - low


def _small(*arrays: np.ndarray) -> bytes:
    return zstandard.compress(b"".join(a.tobytes() for a in arrays), 1)


def _differences(values: np.ndarray) -> np.ndarray:
    return np.diff(values, prepend=0).astype(np.int64)


def packer(text_column: str, chunk_bytes: int = CHUNK_BYTES) -> Callable:
    """Puts rows in chunks of about ``chunk_bytes`` of text, numbered within the task."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(text_column)), 0).to_numpy(zero_copy_only=False)
            part = (np.cumsum(sizes, dtype=np.int64) - sizes) // chunk_bytes
            for _, lo, hi in slices(part):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema, options=options) as writer:
                    writer.write_batch(batch.slice(lo, hi - lo))
                blob = sink.getvalue().to_pybytes()
                yield pa.RecordBatch.from_pydict({"chunk": [number], "size": [int(sizes[lo:hi].sum())], "blob": [blob]})
                number += 1

    return pack


def _one(table: pa.Table, name: str) -> object:
    return table.column(name)[0].as_py()


def _rows(*kinds: tuple[str, pa.DataType], rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[] for _ in kinds]
    return pa.table({n: pa.array(list(c), t) for (n, t), c in zip(kinds, columns)})


_SEND = (("bucket", pa.int64()), ("kind", pa.int32()), ("chunk", pa.int64()), ("blob", pa.binary()))
_SEND_SQL = "bucket long, kind int, chunk long, blob binary"


def _by_pair(table: pa.Table) -> dict[tuple[int, int], bytes]:
    got = table.to_pydict()
    return {
        (k, b): zstandard.decompress(x) for k, b, x in zip(got["kind"], got["bucket"], got["blob"])
    }


def mark_repeats(
    docs: DataFrame,
    task: Task,
    finish: Callable[[pa.Table, np.ndarray, np.ndarray, Tokens], pa.Table],
    schema: str,
) -> DataFrame:
    """Apply ``finish`` to each chunk: its rows, its bytes, which tokens are covered, its tokens.

    ``finish`` sees every column of ``docs`` and returns the columns of ``schema``, a row per row.
    """
    spark = docs.sparkSession
    ship_package(spark)
    packed = docs.mapInArrow(packer(task.text_column), "chunk long, size long, blob binary")
    chunks = materialize(packed, "chunks")
    size = chunks.agg(F.sum("size").alias("size")).first()["size"] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // BUCKET_BYTES + 1)
    task = replace(task, buckets=buckets)
    placed = chunks.select("chunk", "blob").repartition(buckets, "chunk")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, blob in zip(*(batch.column(c).to_pylist() for c in ("chunk", "blob"))):
                chunk = Chunk(blob, task)
                rows = [
                    (b, 0, number, _small(chunk.low[lo:hi], chunk.full[lo:hi], _differences(chunk.value[lo:hi])))
                    for b, lo, hi in slices(chunk.bucket)
                ]
                yield from _rows(*_SEND, rows=rows).to_batches()

    def settle(table: pa.Table) -> pa.Table:
        bucket, parts = _one(table, "bucket"), []
        for blob in table.column("blob").to_pylist():
            raw = zstandard.decompress(blob)
            n = len(raw) // 20
            low = np.frombuffer(raw, np.uint32, n)
            full = np.frombuffer(raw, np.uint64, n, 4 * n)
            value = np.cumsum(np.frombuffer(raw, np.int64, n, 12 * n))
            parts.append((low, full, value))
        low, full, value = (np.concatenate(x) for x in zip(*parts))
        status = settled(low, full, value, task)
        edges = np.cumsum([0, *(len(p[0]) for p in parts)])
        rows = [
            (bucket, 0, c, _small(status[lo:hi]))
            for c, lo, hi in zip(table.column("chunk").to_pylist(), edges[:-1], edges[1:])
        ]
        return _rows(*_SEND, rows=rows)

    def show(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _rows(*_SEND, rows=[])
        chunk, number = Chunk(_one(left, "blob"), task), _one(left, "chunk")
        by_bucket, windows = chunk.shown(chunk.status(_by_pair(right)))
        rows = [(b, 1, number, _small(*_text_of(chunk, runs))) for b, runs in by_bucket]
        rows += [
            (b, 2, number, _small(windows.window[lo:hi], windows.value[lo:hi]))
            for b, lo, hi in slices(windows.bucket)
        ]
        return _rows(*_SEND, rows=rows)

    def compare(table: pa.Table) -> pa.Table:
        bucket, kind = _one(table, "bucket"), _one(table, "kind")
        blobs = [zstandard.decompress(x) for x in table.column("blob").to_pylist()]
        if kind == 1:
            found = task.resolve([_shown_from(x) for x in blobs], task)
        else:
            sizes = [len(x) // 16 for x in blobs]
            window = np.concatenate([np.frombuffer(x, np.uint64, n) for x, n in zip(blobs, sizes)])
            value = np.concatenate([np.frombuffer(x, np.int64, n, 8 * n) for x, n in zip(blobs, sizes)])
            edges = np.cumsum([0, *sizes])
            lost = losing(np.unique(window, return_inverse=True)[1], value, task.first_stays)
            found = [lost[lo:hi] for lo, hi in zip(edges[:-1], edges[1:])]
        numbers = table.column("chunk").to_pylist()
        return _rows(*_SEND, rows=[(bucket, kind, c, _small(np.packbits(f))) for c, f in zip(numbers, found)])

    def close(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk, replies = Chunk(_one(left, "blob"), task), _by_pair(right)
        covered = _covered(chunk, replies)
        return finish(chunk.batch, chunk.data, covered, chunk.tokens)

    def by_chunk(answers: DataFrame):
        return placed.groupBy("chunk").cogroup(answers.groupBy("chunk"))

    sent = placed.mapInArrow(send, _SEND_SQL)
    first = sent.groupBy("bucket").applyInArrow(settle, _SEND_SQL).repartition(buckets, "chunk")
    shown = by_chunk(first).applyInArrow(show, _SEND_SQL)
    second = shown.groupBy("bucket", "kind").applyInArrow(compare, _SEND_SQL)
    return by_chunk(first.union(second)).applyInArrow(close, schema)


def settled(low: np.ndarray, full: np.ndarray, value: np.ndarray, task: Task) -> np.ndarray:
    """For each entry of a bucket: 1 if its windows go, 2 if it shows its text, 4 if by window."""
    order = np.lexsort((value, full, low))
    a, t, v = low[order], full[order], value[order]
    n = len(order)
    new_anchor = np.r_[True, a[1:] != a[:-1]] if n else np.zeros(0, bool)
    new_text = new_anchor | np.r_[True, t[1:] != t[:-1]] if n else new_anchor
    head = np.nonzero(new_text)[0]
    of_text = np.cumsum(new_text) - 1
    texts = np.bincount(np.cumsum(new_anchor)[head] - 1) if n else np.zeros(0, np.int64)
    texts = texts[np.cumsum(new_anchor) - 1]
    if task.first_stays:
        goes = v > v[head][of_text]
        shows = (texts > 1) & ~goes
    else:
        goes = np.add.reduceat(v, head)[of_text] > 1 if n else new_text
        shows = (texts > 1) & new_text
    status = goes * 1 + shows * 2 + (shows & (texts > task.hot)) * 4
    out = np.empty(n, np.uint8)
    out[order] = status
    return out


def losing(group: np.ndarray, value: np.ndarray, first_stays: bool) -> np.ndarray:
    """Which windows go, given which are equal and the id (or number) that each stands for."""
    if not len(group):
        return np.zeros(0, bool)
    if not first_stays:
        return np.bincount(group, value)[group] > 1
    least = np.full(group.max() + 1, LAST_ID)
    np.minimum.at(least, group, value)
    return value > least[group]


def _text_of(chunk: Chunk, runs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Number of runs, then their sizes, windows, ids and bytes."""
    last = chunk.start[runs] + chunk.count[runs] + chunk.task.length - 2
    first, end = chunk.tokens.bytes_of(chunk.start[runs], last)
    sizes = end - first
    ids = chunk.ids[chunk.row[runs]]
    return np.array([len(runs)]), sizes, chunk.count[runs], ids, chunk.data[ranges(first, sizes)]


def _shown_from(raw: bytes) -> Shown:
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    sizes, windows, ids = np.frombuffer(raw, np.int64, 3 * n, 8).reshape(3, n)
    return Shown(raw[8 + 24 * n :], sizes, windows, ids)


def _covered(chunk: Chunk, replies: dict[tuple[int, int], bytes]) -> np.ndarray:
    """Which tokens a window covers that goes."""
    edges = np.zeros(len(chunk.tokens.raw) + 1, np.int32)
    if not len(chunk.start):
        return edges[:-1] > 0
    status, length = chunk.status(replies), chunk.task.length
    goes = status[chunk.entry] & 1 > 0
    if chunk.task.first_stays:
        goes |= chunk.ids[chunk.row] > chunk.value[chunk.entry]
    np.add.at(edges, chunk.start[goes], 1)
    np.add.at(edges, chunk.start[goes] + chunk.count[goes] - 1 + length, -1)
    by_bucket, windows = chunk.shown(status)
    found, counts = {}, chunk.count
    for b, runs in by_bucket:
        total = int(counts[runs].sum())
        bits = np.unpackbits(np.frombuffer(replies[1, b], np.uint8), count=total)
        found |= dict(zip(chunk.entry[runs].tolist(), np.split(bits, np.cumsum(counts[runs])[:-1])))
    if len(windows.runs):
        lost = np.concatenate(
            [np.unpackbits(np.frombuffer(replies[2, b], np.uint8), count=hi - lo) for b, lo, hi in slices(windows.bucket)]
        )[windows.which]
        if chunk.task.first_stays:
            lost = lost | (windows.ids > windows.value[windows.which])
        split = np.split(lost, np.cumsum(counts[windows.runs])[:-1])
        found |= dict(zip(chunk.entry[windows.runs].tolist(), split))
    if found:
        rest = np.nonzero(~goes & np.isin(chunk.entry, np.fromiter(found, np.int64)))[0]
        bits = np.concatenate([found[e] for e in chunk.entry[rest].tolist()]) if len(rest) else np.zeros(0)
        starts = ranges(chunk.start[rest], counts[rest])[bits > 0]
        np.add.at(edges, starts, 1)
        np.add.at(edges, starts + length, -1)
    return np.cumsum(edges[:-1]) > 0
