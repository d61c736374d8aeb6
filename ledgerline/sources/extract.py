"""Extraction by SQL text, over registered tables or a JDBC source."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.schemas import LOOKUP_ANSWER

# Counts that come back from the database at a time, and how often it is asked for them.
CELLS, ROUNDS = 1000, 8


def sql_extract(
    spark: SparkSession,
    query: str,
    tables: Mapping[str, DataFrame] | None = None,
    args: Mapping[str, object] | None = None,
) -> DataFrame:
    """Run the user's SQL; ``tables`` are visible to it by name, ``args`` fill its ``:name`` markers."""
    for name, table in (tables or {}).items():
        table.createOrReplaceTempView(name)
    return spark.sql(query, args=dict(args) if args else None)


def jdbc_options(
    url: str,
    user: str,
    password: str,
    query: str,
    driver: str = "org.postgresql.Driver",
    fetch_size: int | None = None,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    num_partitions: int | None = None,
) -> dict[str, str]:
    """Options of a JDBC read. A split read needs the query as a derived table and its key range."""
    options = {"url": url, "user": user, "password": password, "driver": driver}
    if fetch_size:
        options["fetchsize"] = str(fetch_size)
    if partition_column is None:
        options["query"] = query
        return options
    if bounds is None or not num_partitions:
        raise ValueError("a split read needs bounds and num_partitions")
    options |= {
        "dbtable": f"({query}) t",
        "partitionColumn": partition_column,
        "lowerBound": str(bounds[0]),
        "upperBound": str(bounds[1]),
        "numPartitions": str(num_partitions),
    }
    return options


def jdbc_extract(
    spark: SparkSession,
    url: str,
    user: str,
    password: str,
    query: str,
    driver: str = "org.postgresql.Driver",
    fetch_size: int | None = None,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    num_partitions: int | None = None,
    predicates: Sequence[str] | None = None,
    even: bool = False,
) -> DataFrame:
    """Load the result of ``query`` from a database.

    With ``partition_column`` the read is split into ``num_partitions`` key ranges of equal length; bounds that are
    not given are asked from the database. ``even`` makes them ranges of about equally many rows (see
    :func:`even_predicates`), for a column whose values are uneven. ``predicates`` split it by hand
    instead. A split read has no order: sort afterwards.
    """
    if even and not predicates:
        if not partition_column or not num_partitions:
            raise ValueError("an even split needs partition_column and num_partitions")

        def ask(question: str) -> DataFrame:
            return spark.read.format("jdbc").options(**jdbc_options(url, user, password, question, driver)).load()

        predicates = even_predicates(ask, query, partition_column, num_partitions)
        partition_column = None
    if predicates:
        properties = jdbc_options(url, user, password, query, driver, fetch_size)
        for name in ("url", "query"):
            properties.pop(name)
        return spark.read.jdbc(url, f"({query}) t", predicates=list(predicates), properties=properties)
    if partition_column and bounds is None:
        ends = f"SELECT min({partition_column}) AS lo, max({partition_column}) AS hi FROM ({query}) q"
        lo, hi = spark.read.format("jdbc").options(**jdbc_options(url, user, password, ends, driver)).load().first()
        if lo is None:
            partition_column = None
        bounds = (lo, hi)
    options = jdbc_options(
        url, user, password, query, driver, fetch_size, partition_column, bounds, num_partitions
    )
    return spark.read.format("jdbc").options(**options).load()


def even_predicates(
    ask: Callable[[str], DataFrame], query: str, column: str, num_partitions: int, cells: int = CELLS, rounds: int = ROUNDS
) -> list[str]:
    """Conditions on the numbers in ``column`` that part the rows of ``query`` into ranges of about equally many.

    ``ask`` runs SQL where the data is. Rows are counted per range of equal length, and ranges that hold much
    are counted again by finer ones, up to ``rounds`` times; each time at most ``cells`` counts come back. Ranges
    are then put together in order. A single value that holds more than its part stays whole. Each row fits
    exactly one condition, also if it came after the counting; null keys fit the first. No rows, or all keys
    equal or null: no conditions.
    """
    named = f"(SELECT {column} AS k FROM ({query}) q) q"
    low, high, rows = ask(f"SELECT min(k) AS lo, max(k) AS hi, count(k) AS n FROM {named}").first()
    if not rows:
        return []
    if isinstance(low, bool) or not isinstance(low, (int, float, Decimal)):
        raise ValueError(f"{column} holds no numbers")
    part = rows / num_partitions
    spans = [(low, high, rows)]
    for _ in range(rounds):
        full = [s for s in spans if s[2] > part / 4 and s[0] < s[1]]  # 4 x num_partitions at most
        if not full or len(full) * 2 > cells:
            break
        each = cells // len(full)
        cell = " ".join(
            f"WHEN k BETWEEN {lo} AND {hi} THEN {i * each} + floor((k - {lo}) * {each - 0.5} / ({hi} - {lo}))"
            for i, (lo, hi, _) in enumerate(full)
        )
        inside = " OR ".join(f"k BETWEEN {lo} AND {hi}" for lo, hi, _ in full)
        counted = f"SELECT k, CASE {cell} END AS cell FROM {named} WHERE {inside}"
        finer = ask(f"SELECT min(k) AS lo, max(k) AS hi, count(*) AS n FROM ({counted}) c GROUP BY cell").collect()
        spans = sorted([s for s in spans if s not in full] + [tuple(r) for r in finer])
    cuts, seen, place = [], 0, 0
    for lo, _, n in spans:
        # A range goes to the part that its middle row belongs to.
        now = min(int((seen + n / 2) / part), num_partitions - 1)
        if now > place and seen:
            cuts.append(lo)
        place, seen = now, seen + n
    if not cuts:
        return []
    between = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *between, f"{column} >= {cuts[-1]}"]


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    """A lookup table from its answers, one JSON object per line."""
    return spark.read.schema(LOOKUP_ANSWER).json(path)


def top_n(df: DataFrame, order_by: Sequence[str], n: int = 1) -> DataFrame:
    """The first ``n`` rows by key: a top-k in every task, then one of their winners."""
    return df.orderBy(*order_by).limit(n)


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def count_rows(df: DataFrame, name: str = "records") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))
