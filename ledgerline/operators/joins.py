"""Joins of a large table with a table that has one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerline.session import materialize

# A table whose rows measure at most this many bytes as text may be broadcast.
BROADCAST_BYTES = 32 * 1024 * 1024

# A key is hot if it holds at least one row in this many; at most this many keys can.
HOT_SHARE = 1000

# Places that the rows of a hot key are dealt over.
SALTS = 64

# So many copies of one row may lie in one place: as many as there are places.
COPIES = SALTS

_SALT = "_salt"


def text_bytes(df: DataFrame) -> int:
    """About the size of the rows of ``df``: texts in UTF-8, nested values as JSON, 8 bytes for others."""

    def size(field: T.StructField) -> Column:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(field.name), F.lit(0))
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.coalesce(F.octet_length(F.to_json(F.col(field.name))), F.lit(0))
        return F.lit(8)

    per_row = sum((size(f).cast("long") for f in df.schema), F.lit(0).cast("long"))
    return df.agg(F.sum(per_row).alias("bytes")).first()["bytes"] or 0


def hot_keys(df: DataFrame, key: str) -> list:
    """Keys, null among them, that hold at least 1/HOT_SHARE of the rows.

    A frequent-items sketch per task, merged to one row, finds the candidates: no shuffle of the
    keys. Only the choice of join strategy rests on it, never the result.
    """
    return [item for item, _ in _frequent(df, F.col(key))[0]]


def _frequent(df: DataFrame, *values: Column) -> list[list[tuple[object, int]]]:
    """For each of ``values``, found in one pass: what holds at least 1/HOT_SHARE of the rows, and about how many."""
    named = df.select(*[v.alias(f"v{i}") for i, v in enumerate(values)])
    sketches = [F.expr(f"approx_top_k(v{i}, {HOT_SHARE}, {10 * HOT_SHARE})").alias(f"top{i}") for i in range(len(values))]
    found = named.agg(F.count(F.lit(1)).alias("n"), *sketches).first()
    return [
        [(entry["item"], entry["count"]) for entry in found[f"top{i}"] if entry["count"] * HOT_SHARE >= found["n"]]
        for i in range(len(values))
    ]


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns: rows that agree in it are taken for copies, which are interchangeable."""
    return F.xxhash64(*df.columns) if df.columns else F.lit(0).cast("long")


def has_many_copies(df: DataFrame) -> bool:
    """Whether some row occurs so often that its copies must be dealt over several places."""
    return _many(_frequent(df, row_hash(df))[0])


def _many(rows: list[tuple[object, int]]) -> bool:
    return any(n > COPIES for _, n in rows)


def places_of(df: DataFrame, places: int, many_copies: bool) -> tuple[DataFrame, Column]:
    """``df`` and the place of each row in it: the same if a task runs again on its rows in another order.

    The place is a hash of the row. Only copies of a row cannot be told apart by that: where there are many,
    the rows are written first, and dealt by where they lie in the files, which stays as it is.
    """
    if many_copies:
        return materialize(df, "copies"), F.pmod(F.monotonically_increasing_id(), F.lit(places)).cast("int")
    return df, F.pmod(row_hash(df), F.lit(places)).cast("int")


def keyed_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "left",
    broadcast_bytes: int = BROADCAST_BYTES,
    measure: DataFrame | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Join on ``key``, which is unique in ``right``; ``how`` is left, left_anti or left_semi.

    A small right side is broadcast: ``right`` is measured, or ``measure`` if that is cheaper to
    compute and at least as large; or ``small`` says it. Beyond that both sides are shuffled once, the
    rows of a hot key dealt over ``SALTS`` places; the right side has at most HOT_SHARE rows for such keys,
    which are repeated in each. ``left`` is read to find them and to join, and written between if it has many
    copies of one row.
    """
    if small is None:
        small = text_bytes(right if measure is None else measure) <= broadcast_bytes
    if small:
        return left.join(F.broadcast(right), key, how)
    frequent, copies = _frequent(left, F.col(key), row_hash(left))
    hot = [item for item, _ in frequent]
    if not hot:
        return left.join(right.hint("shuffle_merge"), key, how)
    left, dealt = places_of(left, SALTS, _many(copies))
    everywhere = F.sequence(F.lit(0), F.lit(SALTS - 1))
    salted = left.withColumn(_SALT, F.when(one_of(F.col(key), hot), dealt).otherwise(0))
    places = F.when(one_of(F.col(key), hot), everywhere).otherwise(F.array(F.lit(0)))
    repeated = right.withColumn(_SALT, F.explode(places))
    return salted.join(repeated.hint("shuffle_merge"), [key, _SALT], how).drop(_SALT)


def one_of(key: Column, values: list) -> Column:
    """Never null, also for a null key."""
    named = [v for v in values if v is not None]
    among = F.coalesce(key.isin(named), F.lit(False)) if named else F.lit(False)
    return among | key.isNull() if None in values else among
