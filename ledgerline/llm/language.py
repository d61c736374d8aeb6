"""Language of a text by multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.llm.repeats import mix, slices, text_bytes
from ledgerline.session import ship_package

ORDERS = (1, 2, 3)
FEATURES = 1 << 16
SPREAD = 4.0  # standard errors by which a text may differ from what is usual in its language
SMOOTHING = 0.5
UNKNOWN = "und"
SLICE_BYTES = 250_000
PARTS = 16  # a language's counts are added in so many pieces
SUMS = 64  # and each piece first in so many groups of tasks

_U = np.uint64
_tables: list[np.ndarray] = []


def _characters() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: its lower case, with a space for all that is no letter, and whether it is a letter."""
    if not _tables:
        folded, letter = np.full(0x110000, 32, np.uint32), np.zeros(0x110000, bool)
        for point in range(0x110000):
            char = chr(point)
            if char.isalpha():
                low = char.lower()
                letter[point], folded[point] = True, ord(low) if len(low) == 1 else point
        _tables.extend([folded, letter])
    return _tables[0], _tables[1]


@dataclass(frozen=True)
class Model:
    """Log-probabilities of features (row) by language (column), and of the languages."""

    languages: list[str]
    features: np.ndarray
    priors: np.ndarray

    def expected(self) -> tuple[np.ndarray, np.ndarray]:
        """Mean and standard deviation of the log-probability of a feature, by language."""
        share = np.exp(self.features)
        mean = (share * self.features).sum(0)
        return mean, np.sqrt(np.maximum((share * self.features**2).sum(0) - mean**2, 0))


def ngrams(data: np.ndarray, offsets: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For each order the features and the first feature of each text; and which texts have a letter.

    Letters are lower-cased, everything else is a space, and runs of spaces count as one, also
    at the ends of a text, so that n-grams see where words begin and end.
    """
    fold, is_letter = _characters()
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    head = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    letters = is_letter[points]
    has_letter = np.diff(np.concatenate([[0], np.cumsum(letters)])[head]) > 0
    char = fold[points].astype(_U)
    stays = letters.copy()
    stays[1:] |= letters[:-1]  # the first space after a letter
    kept = char[stays]
    at = np.concatenate([[0], np.cumsum(stays)])[head]
    rows = len(offsets) - 1
    # A space in front of each text, so that its first word begins like any other.
    front = at[:-1] + np.arange(rows)
    text = np.full(len(kept) + rows + max(ORDERS), 32, _U)
    place = np.ones(len(kept) + rows, bool)
    place[front] = False
    text[: len(place)][place] = kept
    edges = at + np.arange(rows + 1)
    out, code = [], np.zeros(len(place), _U)
    row = np.repeat(np.arange(rows), np.diff(edges))
    for order in range(1, max(ORDERS) + 1):
        code = code * _U(0x110000) + text[order - 1 : order - 1 + len(place)] + _U(1)
        if order in ORDERS:
            inside = np.arange(len(place)) + order <= edges[1:][row]
            feature = (mix(code[inside] * _U(8) + _U(order)) >> _U(48)).astype(np.int64)
            out.append((feature, np.concatenate([[0], np.cumsum(np.bincount(row[inside], minlength=rows))])))
    return out, has_letter


def _cut(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    for _, lo, hi in slices(offsets[:-1] // SLICE_BYTES):
        yield lo, hi


def train(texts: DataFrame, text_column: str, language_column: str) -> Model:
    """Counts over all rows that have a text and a language, smoothed.

    Each task counts on its own and sends its totals, in pieces; no text leaves its task. The model
    has ``FEATURES`` numbers per language. Without any row there are no languages.
    """
    ship_package(texts.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            names = batch.column("language").to_pylist()
            for lo, hi in _cut(offsets):
                part = offsets[lo : hi + 1]
                found, _ = ngrams(data[part[0] : part[-1]], part - part[0])
                codes, which = np.unique(np.array(names[lo:hi], object), return_inverse=True)
                counts = np.zeros(len(codes) * FEATURES, np.int64)
                for feature, edges in found:
                    row = np.repeat(which, np.diff(edges))
                    counts += np.bincount(row * FEATURES + feature, minlength=len(counts))
                for k, name in enumerate(codes):
                    mine = counts[k * FEATURES : (k + 1) * FEATURES]
                    totals[name] = totals[name] + mine if name in totals else mine
                    docs[name] = docs.get(name, 0) + int((which == k).sum())
        group = TaskContext.get().partitionId() % SUMS
        for name, counts in totals.items():
            for part, piece in enumerate(np.split(counts, PARTS)):
                yield _piece(name, part, group, docs[name] if part == 0 else 0, piece)

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(zstandard.decompress(b), np.int64) for b in table.column("counts").to_pylist())
        name, part = table.column("language")[0].as_py(), table.column("part")[0].as_py()
        return pa.Table.from_batches([_piece(name, part, 0, pc.sum(table.column("docs")).as_py(), total)])

    shape = "language string, part long, group long, docs long, counts binary"
    rows = texts.select(F.col(text_column).alias("text"), F.col(language_column).alias("language")).dropna()
    counted = rows.mapInArrow(count, shape).groupBy("language", "part", "group").applyInArrow(add, shape)
    pieces = counted.groupBy("language", "part").applyInArrow(add, shape).collect()
    return _fit(pieces)


def _piece(name: str, part: int, group: int, docs: int, counts: np.ndarray) -> pa.RecordBatch:
    blob = zstandard.compress(counts.tobytes(), 1)
    values = {"language": [name], "part": [part], "group": [group], "docs": [docs], "counts": [blob]}
    return pa.RecordBatch.from_pydict(values)


def _fit(pieces: list) -> Model:
    languages = sorted({p["language"] for p in pieces})
    counts = np.zeros((FEATURES, len(languages)))
    docs = np.zeros(len(languages))
    size = FEATURES // PARTS
    for piece in pieces:
        k = languages.index(piece["language"])
        values = np.frombuffer(zstandard.decompress(bytes(piece["counts"])), np.int64)
        counts[piece["part"] * size : (piece["part"] + 1) * size, k] = values
        docs[k] += piece["docs"]
    counts += SMOOTHING
    return Model(languages, np.log(counts / counts.sum(0)), np.log(docs / max(docs.sum(), 1)))


def identify(
    docs: DataFrame,
    model: Model,
    text_column: str = "text",
    language_name: str = "lang_pred",
    score_name: str = "score",
    fit_name: str | None = None,
) -> DataFrame:
    """Add the predicted language and the probability of that language to ``docs``.

    ``und`` and 0 for a text that is null or has no letter, or if the model knows no language. Ties
    go to the language that sorts first. The probability is one among the learned languages, so a text in none
    of them has a high one too. ``fit_name`` adds a column that tells these: by how much the log-probability of the
    text's n-grams in its language falls short, on average, of what all rows that taught the language
    lead to expect, beyond ``SPREAD`` standard errors for its length (0 or less; 0 for ``und``). Columns that have
    one of the names are replaced.
    """
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)
    added = [language_name, score_name, *([fit_name] if fit_name else [])]
    docs = docs.drop(*added)
    names = docs.columns

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        usual = model.expected()
        for batch in batches:
            data, offsets = text_bytes(batch.column(text_column))
            best, score, fit = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            for lo, hi in _cut(offsets):
                part = offsets[lo : hi + 1]
                best[lo:hi], score[lo:hi], fit[lo:hi] = _predict(data[part[0] : part[-1]], part - part[0], model, usual)
            table = pa.array([*model.languages, UNKNOWN])
            columns = [*batch.columns, table.take(pa.array(best)), pa.array(score), pa.array(fit)]
            yield pa.RecordBatch.from_arrays(columns[: len(names) + len(added)], [*names, *added])

    likes = [F.lit("").alias(language_name), *[F.lit(0.0).alias(n) for n in added[1:]]]
    return docs.mapInArrow(apply, docs.select("*", *likes).schema)


def _predict(
    data: np.ndarray, offsets: np.ndarray, model: Model, usual: tuple[np.ndarray, np.ndarray]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    found, has_letter = ngrams(data, offsets)
    rows, unknown = len(offsets) - 1, len(model.languages)
    if not unknown:
        return np.full(rows, unknown), np.zeros(rows), np.zeros(rows)
    total = np.tile(model.priors, (rows, 1))
    size = np.zeros(rows)
    for feature, edges in found:
        size += np.diff(edges)
        some = np.nonzero(np.diff(edges))[0]
        for k in range(unknown if len(some) else 0):
            total[some, k] += np.add.reduceat(model.features[:, k][feature], edges[some])
    best = total.argmax(1)
    score = 1 / np.exp(total - total.max(1)[:, None]).sum(1)
    mean, spread = usual
    size = np.maximum(size, 1)
    short = (total[np.arange(rows), best] - model.priors[best]) / size - mean[best] + SPREAD * spread[best] / np.sqrt(size)
    fit = np.where(has_letter, np.minimum(short, 0), 0.0)
    return np.where(has_letter, best, unknown), np.where(has_letter, score, 0.0), fit


def held_out(id_column: str = "doc_id") -> Column:
    """A fixed third of the ids, by checksum; a null id is not among them."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 3 == 1, F.lit(False))


def language_id(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    language_column: str = "lang",
) -> DataFrame:
    """``docs`` with ``held_out``, ``lang_pred`` and ``score``, learned from the rows not held out."""
    docs = docs.withColumn("held_out", held_out(id_column))
    model = train(docs.where(~F.col("held_out")), text_column, language_column)
    return identify(docs, model, text_column)
