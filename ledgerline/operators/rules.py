"""Lookups by rules: exact keys, key ranges, prefixes and a default, the lowest priority number first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerline.operators.joins import keyed_join
from ledgerline.session import materialize

EXACT, PREFIX, RANGE, ANY = "exact", "prefix", "range", "any"

# The priority of a rule that names none, and the order of kinds among equal priorities.
DEFAULT_PRIORITY = 5
KINDS = (EXACT, PREFIX, RANGE, ANY)

# Bounds of ranges and keys that fall into them lie within this much of zero.
FARTHEST = 1 << 62
_LEVELS = 63


def lookup_rules(records: DataFrame, rules: DataFrame, key: str, answers: Sequence[str], broadcast_bytes: int | None = None) -> DataFrame:
    """Add ``exists``, ``rule`` (its kind; null if none fits) and the ``answers`` of the rule that wins; no record is dropped.

    ``rules`` has ``kind``, ``key`` (text, for exact and prefix), ``low`` and ``high`` (for range, both included, null is
    open), ``priority`` (null: 5), ``exists`` (null: true) and the answers. Of the rules that fit a key the lowest
    priority number wins, then exact before prefix before range before any, then the smallest answers.
    Ranges compare whole numbers only: keys that are none fit no range. A null key fits no rule.

    No rule is compared with a key that it does not fit. A range is the few blocks of 2^k numbers that make
    it up, so keys meet ranges, prefixes and exact rules by equality: a key asks once for itself, once for
    each length that some prefix has, and once for each size that some block has. Each distinct key is
    decided once. Rules of kind any are one row.
    """
    options = {} if broadcast_bytes is None else {"broadcast_bytes": broadcast_bytes}
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    verdict = F.struct(
        F.coalesce(F.col("priority").cast("int"), F.lit(DEFAULT_PRIORITY)).alias("priority"),
        rank.alias("rank"),
        F.col("kind").alias("rule"),
        F.coalesce("exists", F.lit(True)).alias("exists"),
        *answers,
    ).alias("verdict")
    of_kind = rules.where(F.col("kind").isin(*KINDS))
    default = of_kind.where(F.col("kind") == ANY).agg(F.min(verdict).alias("verdict"))
    forms = F.when(F.col("kind") == EXACT, F.array(_exact(F.col("key")))).when(
        F.col("kind") == PREFIX, F.array(_prefix(F.col("key")))
    )
    forms = forms.otherwise(_blocks(F.col("low"), F.col("high")))
    shaped = of_kind.where(F.col("kind") != ANY).select(F.explode(forms).alias("form"), verdict)
    best = shaped.groupBy("form").agg(F.min("verdict").alias("verdict"))
    best = materialize(best, "rules").where(F.col("form").isNotNull())
    # Lengths and block sizes that occur: as many as there are sizes of prefixes, and 63 at most.
    sizes = best.select(F.substring("form", 1, 1).alias("k"), F.substring_index("form", ":", 1).alias("s")).distinct().collect()
    lengths = sorted(int(r["s"][1:]) for r in sizes if r["k"] == "p")
    levels = sorted(int(r["s"][1:]) for r in sizes if r["k"] == "r")
    asked = records.select(F.col(key).alias("_key")).where(F.col("_key").isNotNull()).distinct()
    asked = materialize(asked.select("_key", F.explode(_asks(F.col("_key"), records.schema[key].dataType, lengths, levels)).alias("form")), "asked")
    fit = keyed_join(asked, best, "form", "left", **options)
    won = fit.groupBy("_key").agg(F.min("verdict").alias("verdict")).withColumnRenamed("_key", key)
    joined = keyed_join(records, materialize(won, "verdicts"), key, "left", **options)
    kind = joined.schema["verdict"].dataType
    fallback = default.first()["verdict"]  # one row
    any_rule = F.lit(None).cast(kind)
    if fallback is not None:
        values = [F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(fallback, kind)]
        any_rule = F.when(F.col(key).isNotNull(), F.struct(*values))
    wins = F.least(F.col("verdict"), any_rule)  # passes over nulls
    joined = joined.select(*records.columns, wins.alias("_won"))
    return joined.select(
        *records.columns,
        F.coalesce("_won.exists", F.lit(False)).alias("exists"),
        F.col("_won.rule").alias("rule"),
        *[F.col(f"_won.{a}").alias(a) for a in answers],
    )


def _exact(key: Column) -> Column:
    return F.concat(F.lit("e:"), key.cast("string"))


def _prefix(key: Column) -> Column:
    return F.concat(F.lit("p"), F.length(key.cast("string")).cast("string"), F.lit(":"), key.cast("string"))


def _block(level: Column | int, number: Column) -> Column:
    level = F.lit(level) if isinstance(level, int) else level
    return F.concat(F.lit("r"), level.cast("string"), F.lit(":"), number.cast("string"))


def _blocks(low: Column, high: Column) -> Column:
    """The blocks of 2^k numbers, k from 0, that a range is made of: two of each size at most."""
    first = F.greatest(F.coalesce(low.cast("long"), F.lit(-FARTHEST)), F.lit(-FARTHEST))
    last = F.least(F.coalesce(high.cast("long"), F.lit(FARTHEST)), F.lit(FARTHEST))

    def at(level: Column) -> Column:
        # Blocks from ``start`` on and before ``end`` are not part of a larger one only at odd ends.
        start = F.call_function("negative", F.call_function("shiftright", F.call_function("negative", first), level))
        end = F.call_function("shiftright", last + F.lit(1), level)
        some = start < end
        return F.array(
            F.when(some & (F.call_function("pmod", start, F.lit(2)) == 1), _block(level, start)),
            F.when(some & (F.call_function("pmod", end, F.lit(2)) == 1), _block(level, end - 1)),
        )

    return F.filter(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(_LEVELS - 1)), at)), lambda b: b.isNotNull())


def _asks(key: Column, kind: T.DataType, lengths: Sequence[int], levels: Sequence[int]) -> Column:
    """What a key asks for."""
    text = key.cast("string")
    number = key.cast("long") if isinstance(kind, T.IntegralType) else F.when(text.rlike(r"^-?[0-9]+$"), text.try_cast("long"))
    number = F.when(number.between(-FARTHEST, FARTHEST), number)
    asks = [_exact(key)]
    asks += [F.when(F.length(text) >= n, _prefix(F.substring(text, 1, n))) for n in lengths]
    asks += [_block(k, F.shiftright(number, k)) for k in levels]
    return F.filter(F.array(*asks), lambda a: a.isNotNull())
