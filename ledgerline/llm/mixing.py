"""Mixing documents to target weights of domains that they belong to in part.

A classifier learned from labelled rows gives each document a probability per domain. The rate of a
document is how often it is to be taken. Rates are nonnegative and fitted by projected-gradient least squares:
the expected tokens of each domain, the sum of rate x tokens x probability, are to be the targets.
Rates start at one, and a document's tokens scale its step, so documents of like membership
get like rates. All documents take part in each step; a step moves one vector with a number per domain,
and a task finds a document's rate again from the steps so far, so no rates are shuffled or written.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.llm.repeats import mix, slices, split_words, text_bytes
from ledgerline.session import materialize, ship_package

BYTES = 128
SAMPLE = 6_000  # labelled rows that the classifier learns from, at most
LEAST_DOCS = 3  # a word counts if it is in so many of them
DEVIATIONS = 5.0  # and so many standard deviations off in some domain
SHRINK = 0.005  # taken off each word's weight in each round
ROUNDS = 150
STEPS = 40
SLICE_BYTES = 500_000
TOLERANCE = 1e-6

DOMAINS = ("clean", "poor", "toxic")
WEIGHTS = (0.945, 0.05, 0.005)

_U = np.uint64


@dataclass(frozen=True)
class Classifier:
    """Softmax over presence of chosen words (ascending hashes) and shares of ASCII bytes."""

    codes: np.ndarray
    words: np.ndarray
    bytes: np.ndarray
    bias: np.ndarray

    def chosen(self, row: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and positions of the words that the classifier knows."""
        if not len(self.codes):
            return row[:0], code[:0].astype(np.int64)
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        known = self.codes[at] == code
        return row[known], at[known]

    def posteriors(self, rows: int, row: np.ndarray, word: np.ndarray, shares: np.ndarray) -> np.ndarray:
        total = shares @ self.bytes + self.bias
        for k in range(total.shape[1]):
            total[:, k] += np.bincount(row, self.words[word, k], rows)
        total = np.exp(total - total.max(1)[:, None])
        return total / total.sum(1)[:, None]


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows and 32-bit hashes of the distinct words of each text, its shares of bytes, its number of words.

    For the hashes a word is a run of letters in lower case; what counts as a token is any word
    between white space.
    """
    rows = len(offsets) - 1
    tokens = np.diff(split_words(data, offsets).offsets)
    lower = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    letters = np.where((lower >= 128) | ((lower >= 97) & (lower <= 122)), lower, 32).astype(np.uint8)
    words = split_words(letters, offsets)
    row = np.repeat(np.arange(rows), np.diff(words.offsets)).astype(_U)
    pairs = np.unique((row << _U(32)) | (mix(words.raw) >> _U(32)))
    owner = np.repeat(np.arange(rows), np.diff(offsets))
    ascii_ = data < BYTES
    shares = np.bincount(owner[ascii_] * BYTES + data[ascii_], minlength=rows * BYTES).reshape(rows, BYTES)
    shares = 4 * np.sqrt(shares / np.maximum(np.diff(offsets), 1)[:, None])
    return (pairs >> _U(32)).astype(np.int64), pairs.astype(np.uint32), shares, tokens


def _feature_rows(docs: DataFrame, text_column: str, kept: Sequence[str]) -> DataFrame:
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(text_column))
            for _, lo, hi in slices(offsets[:-1] // SLICE_BYTES):
                part = offsets[lo : hi + 1]
                row, word, shares, _ = features(data[part[0] : part[-1]], part - part[0])
                at = np.searchsorted(row, np.arange(hi - lo + 1)).tolist()
                columns = [batch.column(c).slice(lo, hi - lo) for c in kept]
                words = pa.array([word[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())
                shared = pa.array([s.astype(np.float32).tobytes() for s in shares], pa.binary())
                yield pa.RecordBatch.from_arrays([*columns, words, shared], [*kept, "words", "shares"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)
    return docs.select(*kept, text_column).mapInArrow(apply, f"{kinds}, words binary, shares binary")


def learn(
    docs: DataFrame,
    labels: DataFrame,
    domain: Column,
    domains: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    sample: int = SAMPLE,
) -> Classifier:
    """Fit on the ``sample`` labelled rows that come first by the hash of their id.

    ``domain`` numbers the domain of a row of ``labels``; rows without one do not count, of several
    the smallest does. Only the sample's features reach the driver: ``sample`` bounds them.
    Without labelled rows every domain is equally likely.
    """
    ship_package(docs.sparkSession)
    named = labels.select(F.col(id_column).alias("_id"), domain.cast("int").alias("domain")).dropna()
    named = named.groupBy("_id").agg(F.min("domain").alias("domain"))
    chosen = named.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    rows = docs.join(F.broadcast(chosen), docs[id_column] == F.col("_id"))
    # Rows of one id count once, by the smallest text: the same rows teach in every run, ``sample`` at most.
    rows = rows.groupBy("_id", "domain").agg(F.min(text_column).alias(text_column))
    found = _feature_rows(rows, text_column, ["domain"]).toPandas()
    found = found.sort_values(["domain", "words", "shares"], ignore_index=True)
    words = [np.frombuffer(w, np.uint32) for w in found["words"]]
    row = np.repeat(np.arange(len(words)), [len(w) for w in words])
    word = np.concatenate([*words, np.zeros(0, np.uint32)])
    shares = np.array([np.frombuffer(s, np.float32) for s in found["shares"]]).reshape(-1, BYTES).astype(float)
    return _fit(row, word, shares, found["domain"].to_numpy().astype(int), domains)


def telling_words(row: np.ndarray, code: np.ndarray, domain: np.ndarray, domains: int) -> np.ndarray:
    """Words that occur in some domain far more or less often than by chance."""
    codes, which = np.unique(code, return_inverse=True)
    docs = np.bincount(which, minlength=len(codes))
    size, rows = np.bincount(domain, minlength=domains), len(domain)
    most = np.zeros(len(codes))
    for k in range(domains):
        inside = np.bincount(which, domain[row] == k, len(codes))
        mean = docs * size[k] / rows
        spread = np.sqrt(np.maximum(mean * (1 - size[k] / rows) * (1 - docs / rows), 1e-9))
        most = np.maximum(most, np.abs(inside - mean) / spread)
    return codes[(docs >= LEAST_DOCS) & (most >= DEVIATIONS)]


def _fit(row: np.ndarray, code: np.ndarray, shares: np.ndarray, domain: np.ndarray, domains: int) -> Classifier:
    """Softmax regression by Adam over all rows at once; weights of words shrink towards zero."""
    rows = len(shares)
    codes = telling_words(row, code, domain, domains) if rows else code[:0]
    flat, n = np.zeros((len(codes) + BYTES + 1, domains)), len(codes)
    now = Classifier(codes, flat[:n], flat[n:-1], flat[-1])
    if not rows:
        return now
    row, word = now.chosen(row, code)
    target = np.eye(domains)[domain]
    first, second = np.zeros_like(flat), np.zeros_like(flat)
    for step in range(1, ROUNDS + 1):
        wrong = (now.posteriors(rows, row, word, shares) - target) / rows
        slope = np.zeros_like(flat)
        for k in range(domains):
            slope[:n, k] = np.bincount(word, wrong[row, k], n)
        slope[n:-1], slope[-1] = shares.T @ wrong, wrong.sum(0)
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope * slope
        flat = flat - 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
        flat[:n] = np.sign(flat[:n]) * np.maximum(np.abs(flat[:n]) - SHRINK, 0)
        now = Classifier(codes, flat[:n], flat[n:-1], flat[-1])
    return now


def memberships(docs: DataFrame, classifier: Classifier, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id``, ``copy`` (hash of the text), ``n_tokens`` and ``posteriors`` of each row; null is empty."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(classifier)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for _, lo, hi in slices(offsets[:-1] // SLICE_BYTES):
                part = offsets[lo : hi + 1]
                row, code, shares, tokens = features(data[part[0] : part[-1]], part - part[0])
                p = shared.value.posteriors(hi - lo, *shared.value.chosen(row, code), shares)
                edges = np.arange(hi - lo + 1, dtype=np.int32) * p.shape[1]
                columns = [batch.column(c).slice(lo, hi - lo) for c in ("id", "copy")]
                lists = pa.ListArray.from_arrays(edges, p.ravel())
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(tokens.astype(np.int64)), lists], ["id", "copy", "n_tokens", "posteriors"]
                )

    text = F.col(text_column)
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.xxhash64(text).alias("copy"), text.alias("text"))
    return rows.mapInArrow(apply, "id long, copy long, n_tokens long, posteriors array<double>")


def rates_after(posteriors: np.ndarray, steps: Sequence[np.ndarray]) -> np.ndarray:
    """Rates from one on: down each gradient step, and up to zero again where it led below."""
    rate = np.ones(len(posteriors))
    for step in steps:
        rate = np.maximum(rate - posteriors @ step, 0)
    return rate


def _sums(table: DataFrame, steps: list[np.ndarray], domains: int) -> tuple[np.ndarray, np.ndarray]:
    """Expected tokens of each domain, and the curvature over the documents that are not at zero."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, curve = np.zeros(domains), np.zeros((domains, domains))
        for batch in batches:
            p = batch.column("posteriors").flatten().to_numpy().reshape(-1, domains)
            tokens = batch.column("n_tokens").to_numpy().astype(float)
            rate = rates_after(p, steps)
            total += (rate * tokens) @ p
            free = p * (tokens * (rate > 0))[:, None]
            curve += free.T @ p
        yield pa.RecordBatch.from_pydict({"at": np.arange(domains * (domains + 1)), "x": np.append(total, curve)})

    found = table.mapInArrow(apply, "at long, x double").groupBy("at").agg(F.sum("x").alias("x")).collect()
    flat = np.zeros(domains * (domains + 1))
    for r in found:
        flat[r["at"]] = r["x"]
    return flat[:domains], flat[domains:].reshape(domains, domains)


def fit_rates(table: DataFrame, targets: np.ndarray, steps: int = STEPS, tolerance: float = TOLERANCE) -> list[np.ndarray]:
    """Gradient steps, one vector of domains each, after which the expected tokens are ``targets``.

    ``table`` has ``n_tokens`` and ``posteriors`` and is read once per step. The gradient is scaled by the
    curvature, and a step that does not bring the totals nearer is taken back and halved. Targets that
    no nonnegative rates can meet are met as nearly as the steps lead.
    """
    domains, taken = len(targets), []
    goal = max(float(np.abs(targets).sum()), 1.0)
    total, curve = _sums(table, taken, domains)
    length = 1.0
    for _ in range(steps):
        off = total - targets
        if np.abs(off).max() <= tolerance * goal:
            break
        ridge = 1e-9 * max(np.trace(curve), 1e-9) * np.eye(domains)
        step = length * np.linalg.solve(curve + ridge, off)
        after, curve_after = _sums(table, [*taken, step], domains)
        if np.linalg.norm(after - targets) < np.linalg.norm(off):
            taken.append(step)
            total, curve, length = after, curve_after, min(1.0, 2 * length)
        else:
            length /= 2
            if length < 1e-3:
                break
    return taken


def apply_rates(table: DataFrame, steps: list[np.ndarray]) -> DataFrame:
    """Add ``rate`` to the rows of ``table``."""
    names = table.columns

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("posteriors")
            p = lists.flatten().to_numpy().reshape(len(lists), -1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rates_after(p, steps))], [*names, "rate"])

    return table.mapInArrow(apply, table.withColumn("rate", F.lit(0.0)).schema)


def label_domain() -> Column:
    """Position in ``DOMAINS`` of a row of labels: toxic, else by quality."""
    by_quality = F.when(F.col("quality") == 1, 0).when(F.col("quality") == 0, 1)
    return F.when(F.col("toxic") == 1, 2).otherwise(by_quality)


def domain_targets(now: np.ndarray, weights: Sequence[float]) -> np.ndarray:
    """Token totals in the proportion of ``weights`` in which the first domain stays as it is."""
    weights = np.asarray(weights, float)
    return now[0] * weights / weights[0]


def mixing_rates(
    docs: DataFrame,
    labels: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``id``, ``copy``, ``n_tokens``, ``posteriors`` (as ``DOMAINS``) and ``rate`` of each row of ``docs``.

    Targets are in the proportion of ``weights``, with the tokens of the first domain unchanged. A null or
    empty text has no tokens and does not matter to the totals; equal rows get equal rates; an
    empty table gives an empty result.
    """
    classifier = learn(docs, labels, label_domain(), len(weights), id_column, text_column)
    table = materialize(memberships(docs, classifier, id_column, text_column), "memberships")
    now, _ = _sums(table, [], len(weights))
    return apply_rates(table, fit_rates(table, domain_targets(now, weights)))


def mixed(
    docs: DataFrame,
    labels: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The rows of ``docs``, each as often as its rate says.

    The fraction of a rate decides by the hash of id and text, so that the expected number of copies is the
    rate; but a document that most likely belongs to the first domain stays at least once, and one
    that is most likely toxic goes, however rare these are. Columns are those of ``docs``.
    """
    rates = mixing_rates(docs, labels, weights, id_column, text_column)
    chance = F.pmod(F.xxhash64(F.lit("mix"), "id", "copy"), F.lit(1 << 30)) / float(1 << 30)
    first = F.col("posteriors")[0] >= F.array_max("posteriors")
    toxic = ~first & (F.col("posteriors")[DOMAINS.index("toxic")] >= F.array_max("posteriors"))
    copies = F.greatest(F.floor(F.col("rate") + chance).cast("int"), first.cast("int"))
    copies = F.when(toxic, 0).otherwise(copies)
    wanted = rates.select(F.col("id").alias("__id"), F.col("copy").alias("__copy"), copies.alias("__n"))
    wanted = wanted.groupBy("__id", "__copy").agg(F.max("__n").alias("__n")).where("__n > 0")
    keyed = docs.withColumn("__hash", F.xxhash64(text_column))
    same = keyed[id_column].cast("long").eqNullSafe(wanted["__id"]) & (keyed["__hash"] == wanted["__copy"])
    repeated = F.explode(F.sequence(F.lit(1), F.col("__n"))).alias("__time")
    return keyed.join(wanted, same).select(*docs.columns, repeated).drop("__time")
