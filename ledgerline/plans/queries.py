"""The registered queries: each operator over the given tables, whole."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerline.functions.answers import answer_line, exists_by_field, exists_by_text, lookup_url
from ledgerline.functions.text import split_lines
from ledgerline.operators.contract import contract_check
from ledgerline.operators.files import path_filter, unseen
from ledgerline.operators.lookup import Call, ask_keys, lookup_exists, lookup_external
from ledgerline.operators.messages import message_rejects, parse_messages, to_messages
from ledgerline.operators.numbering import message_batches, number_rows
from ledgerline.operators.records import REASON, parse_records, parse_rejects
from ledgerline.operators.seen import add_seen, merge_seen, unseen_by_index
from ledgerline.operators.summary import result_line, run_summary
from ledgerline.plans.jobs import land, process_messages, publish_files, trace_lines
from ledgerline.plans.stream_queries import STREAM_QUERIES
from ledgerline.plans.views import (
    clean_line,
    faulty_line,
    land_faulty_lines,
    land_nested_lines,
    land_ordered_files,
    order_records,
    plain,
    positioned_lines,
    table,
)
from ledgerline.schemas import ORDER_RECORD
from ledgerline.session import resolve_option, scratch_path, ship_package
from ledgerline.sources.catalog import catalog_table, create_table, reload_table
from ledgerline.sources.delimited import read_delimited, read_lines, write_delimited
from ledgerline.sources.extract import distinct_values, even_predicates, sql_extract, top_n
from ledgerline.streaming.files import read_parsed, read_rejects, stream_files, stream_publish
from ledgerline.streaming.messages import (
    arriving_messages,
    lookup_check,
    read_messages,
    stream_lookup,
    stream_messages,
)

Query = Callable[[SparkSession, str], DataFrame]

PROPS = T.StructType([T.StructField("k", T.LongType())])
ONCE = {"availableNow": True}
NULL = "\\N"
ENDPOINT = "http://lookup"

SQL_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def user_sql(query: str) -> Query:
    """A query that is the user's own SQL text over the tables it names."""
    named = [name for name in SQL_TABLES if re.search(rf"\b{name}\b", query)]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return sql_extract(spark, query, {name: table(spark, sf_dir, name) for name in named})

    return run


def extract_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = order_records(spark, sf_dir)
    return plain(sql_extract(spark, "SELECT * FROM records ORDER BY rec_id", {"records": records}))


def delimited_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "delimited")
    write_delimited(order_records(spark, sf_dir), path, order_by=["rec_id"], unique_order=True)
    return plain(read_delimited(spark, path, ORDER_RECORD))


def delimited_ordered_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in order of their names hold the rows in order: each row with its place over all files."""
    path = scratch_path(spark, "ordered")
    write_delimited(order_records(spark, sf_dir), path, order_by=["rec_group", "rec_id"], unique_order=True)
    lines = read_lines(spark, path, position=True)
    placed = number_rows(lines, ["file", "block", "seq"], name="place", unique=True)
    return placed.select("place", F.split("line", r"\|")[0].cast("long").alias("rec_id"))


def delimited_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipes, quotes and newlines inside values survive."""
    documents = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "texts")
    write_delimited(documents, path, null_value=NULL, max_records_per_file=10_000)
    return read_delimited(spark, path, documents.schema, null_value=NULL, multiline=True)


def landed_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "landed")
    write_delimited(order_records(spark, sf_dir), path)
    return run_summary(read_delimited(spark, path, ORDER_RECORD), "rec_group")


def land_and_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier")
    check = lookup_check(suppliers.select(F.col("s_suppkey").alias("rec_id")), "rec_id")
    checked = land(order_records(spark, sf_dir), scratch_path(spark, "checked"), "rec_id", check)
    return run_summary(checked, "rec_group", counts={"matched": F.col("exists")})


def land_reordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query with its columns in another order, landed in order and looked up by name."""
    records = sql_extract(
        spark,
        "SELECT o_totalprice, o_orderstatus, o_custkey, o_orderkey FROM orders",
        {"orders": table(spark, sf_dir, "orders")},
    )
    check = lookup_check(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("o_orderkey")), "o_orderkey")
    return land(records, scratch_path(spark, "reordered"), "o_orderkey", check, ["o_orderkey"], unique_order=True)


def split_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query read by ranges of an uneven key: every row comes in one of them."""
    orders = table(spark, sf_dir, "orders")
    keyed = orders.selectExpr("o_orderkey", "CASE WHEN o_orderkey % 10 < 9 THEN o_custkey ELSE o_orderkey * o_orderkey END AS k")
    ask = lambda query: sql_extract(spark, query, {"uneven": keyed})
    parts = even_predicates(ask, "SELECT * FROM uneven", "k", 8)
    rows = [ask(f"SELECT o_orderkey, k FROM uneven WHERE {part}") for part in parts or ["true"]]
    return reduce(DataFrame.union, rows)


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = split_lines(F.col("text"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.size(lines).cast("long").alias("n_lines"), F.array_join(lines, "\n").alias("joined")
    )


def parse_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(parse_records(read_lines(spark, land_faulty_lines(spark, sf_dir)), ORDER_RECORD))


def parse_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_records(read_lines(spark, land_faulty_lines(spark, sf_dir)), ORDER_RECORD, compat=True)


def rejects_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_summary(parse_rejects(read_lines(spark, land_faulty_lines(spark, sf_dir)), ORDER_RECORD), REASON)


def parse_stop_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(parse_records(positioned_lines(spark, sf_dir), ORDER_RECORD, on_error="stop_file"))


def nested_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of files in nested folders, read at once and as a stream."""
    path = land_nested_lines(spark, sf_dir)
    out, checkpoint = scratch_path(spark, "nested"), scratch_path(spark, "nested-log")
    stream_files(spark, path, out, checkpoint, ORDER_RECORD, trigger=ONCE).awaitTermination()
    at_once = parse_records(read_lines(spark, path), ORDER_RECORD).select("rec_id", F.lit("batch").alias("way"))
    return at_once.union(read_parsed(spark, out, ORDER_RECORD)[0].select("rec_id", F.lit("stream").alias("way")))


def message_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(parse_messages(to_messages(order_records(spark, sf_dir)), ORDER_RECORD))


def message_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return parse_messages(events.select("event_id", F.col("props").alias("value")), PROPS, strict_fields=True)


def damaged_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event messages, some cut short, some with a field too many, some with text for a number."""
    fault = F.pmod("event_id", F.lit(50))
    value = (
        F.when(fault == 0, F.expr("left(props, length(props) - 1)"))
        .when(fault == 1, F.expr("replace(props, '{', '{\"extra\": 1, ')"))
        .when(fault == 2, F.lit('{"k": "many"}'))
        .otherwise(F.col("props"))
    )
    return table(spark, sf_dir, "events").select("event_id", value.alias("value"))


def rejected_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return message_rejects(damaged_props(spark, sf_dir), PROPS, strict_fields=True).drop("value")


def accepted_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_messages(damaged_props(spark, sf_dir), PROPS, strict_fields=True)


def published_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    published = publish_files(spark, land_faulty_lines(spark, sf_dir), scratch_path(spark, "sent"), ORDER_RECORD)
    return result_line(published, "Published")


def processed_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = scratch_path(spark, "to-process")
    to_messages(order_records(spark, sf_dir)).write.text(sent)
    lookup = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("rec_id"))
    checked = process_messages(spark.read.text(sent), ORDER_RECORD, "rec_id", lookup)
    return run_summary(checked, counts={"matched": F.col("exists")})


def customer_lookup(spark: SparkSession, sf_dir: str, **options: object) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return lookup_exists(customers, table(spark, sf_dir, "supplier"), "c_custkey", "s_suppkey", **options)


def lookup_with_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers as text, since some are null."""
    checked = customer_lookup(spark, sf_dir, answers=["s_suppkey", "s_name", "s_nationkey"])
    return checked.withColumns({c: F.col(c).cast("string") for c in ("s_suppkey", "s_nationkey")})


def lookup_disabled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_lookup(spark, sf_dir, enabled=False)


def lookup_large_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way taken when the lookup table is too large to broadcast; most order keys are no customer's."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer")
    return lookup_exists(orders, customers, "o_orderkey", "c_custkey", answers=["c_name"], broadcast_bytes=0)


def lookup_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookup rows that carry their own status and ``exists``, both derived from the account."""
    rows = table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        F.when(F.col("s_acctbal") < 0, 404).otherwise(200).alias("status"),
        (F.col("s_nationkey") < 20).alias("found"),
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    return lookup_exists(customers, rows, "c_custkey", "s_suppkey", exists_column="found", status_column="status")


def lookup_answer_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    form = F.pmod("c_custkey", F.lit(5))
    answer = (
        F.when(form == 0, F.lit('{"exists": true}'))
        .when(form == 1, F.lit('{"exists":true}'))
        .when(form == 2, F.lit('{"exists" : true}'))
        .when(form == 3, F.lit('{"exists": false}'))
        .otherwise(F.lit('{"exists": true}'))
    )
    status = F.when(form == 4, 404).otherwise(200)
    asked = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", answer.alias("answer"), status.alias("status")
    )
    return asked.select(
        "c_custkey",
        lookup_url(ENDPOINT, F.col("c_custkey")).alias("url"),
        exists_by_text(F.col("answer"), F.col("status")).alias("by_text"),
        exists_by_field(F.col("answer"), F.col("status")).alias("by_field"),
        answer_line(F.col("c_custkey"), F.col("c_name"), F.col("answer")).alias("log_line"),
    )


def lookup_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of lookups at the place that a parameter names, or its default where it is not set."""
    place = resolve_option(spark, "spark.ledgerline.endpoint", default=ENDPOINT)
    return table(spark, sf_dir, "customer").select("c_custkey", lookup_url(place, F.col("c_custkey")).alias("url"))


def nation_service() -> Call:
    """Stands in for a service: some nations exist, some are not found, some calls fail."""

    def call(nation: int) -> tuple[int, str]:
        if nation >= 20:
            raise TimeoutError("no answer")
        return (404 if nation >= 15 else 200), '{"exists": %s}' % ("true" if nation < 10 else "false")

    return call


def lookup_by_call(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    checked = lookup_external(customers, "c_nationkey", nation_service, tasks=8, calls_per_task=2)
    return checked.withColumn("status", F.col("status").cast("string"))


def lookup_request_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calls that are made: one per distinct key when customers are landed, and when they come as messages."""
    ship_package(spark)
    landed = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    handled = parse_messages(to_messages(landed), landed.schema)
    calls = [
        ask_keys(records, "c_nationkey", nation_service, tasks=8).select(F.lit(stage).alias("stage"))
        for stage, records in (("extract", landed), ("message", handled))
    ]
    return run_summary(calls[0].union(calls[1]), "stage")


def distinct_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_values(table(spark, sf_dir, "customer"), "c_mktsegment")


def first_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(top_n(order_records(spark, sf_dir), ["rec_id"], 1))


def top_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = order_records(spark, sf_dir)
    return plain(top_n(records, [F.desc("amount"), "rec_id"], 100))


def event_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return message_batches(events, "event_type", ["event_id"], unique=True)


def unseen_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    def paths(df: DataFrame, key: str) -> DataFrame:
        return df.select(F.concat(F.lit("data/"), F.col(key).cast("string"), F.lit(".csv")).alias("path"))

    listing = paths(table(spark, sf_dir, "customer"), "c_custkey")
    return unseen(listing, paths(table(spark, sf_dir, "supplier"), "s_suppkey"), "path")


def unseen_by_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through an index of seen names in two segments, then merged."""

    def paths(df: DataFrame, key: str) -> DataFrame:
        return df.select(F.concat(F.lit("data/"), F.col(key).cast("string"), F.lit(".csv")).alias("path"))

    index, suppliers = scratch_path(spark, "seen-index"), table(spark, sf_dir, "supplier")
    for part in ("s_nationkey < 10", "s_nationkey >= 10"):
        add_seen(paths(suppliers.where(part), "s_suppkey"), index, "path", parts=8)
    listing = paths(table(spark, sf_dir, "customer"), "c_custkey")
    by_segments = unseen_by_index(listing, index, "path").withColumn("way", F.lit("segments"))
    merge_seen(spark, index)
    return by_segments.union(unseen_by_index(listing, index, "path").withColumn("way", F.lit("merged")))


def page_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return path_filter(pages, "url", prefix="https://", suffix=".html")


def contract_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract_check(
        table(spark, sf_dir, "lineitem"),
        "l_orderkey",
        required=["l_returnflag", "l_shipdate"],
        max_length={"l_linestatus": 1},
        decimals={"l_extendedprice": (6, 2), "l_quantity": (4, 2)},
    )


def contract_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return contract_check(documents, "doc_id", required=["text", "lang"], max_length={"text": 1000, "source": 5})


def reload_dense_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reloaded twice: first with all rows in another order, then in the order that counts."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    path = scratch_path(spark, "reloaded")
    name = "reloaded_" + path.rsplit("-", 1)[1]
    reload_table(orders, name, "row_id", ["o_orderkey"], location=path, unique=True)
    reloaded = reload_table(orders, name, "row_id", ["o_orderdate", "o_orderkey"], unique=True)
    return reloaded.drop("o_orderdate")


def number_repeated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dense key over rows of which many are copies of each other."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus")
    path = scratch_path(spark, "repeated")
    name = "repeated_" + path.rsplit("-", 1)[1]
    return reload_table(lines, name, "row_id", ["l_returnflag", "l_linestatus"], location=path)


def catalog_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "catalog")
    name = "records_" + path.rsplit("-", 1)[1]
    create_table(spark, name, ORDER_RECORD, path)
    order_records(spark, sf_dir).write.insertInto(name, overwrite=True)
    return plain(catalog_table(spark, name))


def stream_files_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, checkpoint = scratch_path(spark, "parsed"), scratch_path(spark, "parsed-log")
    stream_files(
        spark, land_faulty_lines(spark, sf_dir), out, checkpoint, ORDER_RECORD, trigger=ONCE
    ).awaitTermination()
    return plain(read_parsed(spark, out, ORDER_RECORD)[0])


def stream_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in, messages out, read back."""
    out, checkpoint = scratch_path(spark, "published"), scratch_path(spark, "published-log")
    stream_publish(
        spark, land_faulty_lines(spark, sf_dir), out, checkpoint, ORDER_RECORD, trigger=ONCE
    ).awaitTermination()
    return plain(parse_messages(spark.read.text(out), ORDER_RECORD))


def stream_publish_stop_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of the records before the first bad one of each file."""
    out, checkpoint = scratch_path(spark, "sent-until"), scratch_path(spark, "sent-until-log")
    path = land_ordered_files(spark, sf_dir)
    stream_publish(
        spark, path, out, checkpoint, ORDER_RECORD, on_error="stop_file", trigger=ONCE
    ).awaitTermination()
    return plain(parse_messages(spark.read.text(out).select("value"), ORDER_RECORD))


def stream_publish_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published messages and kept rejects of one run, counted."""
    out, rejects, checkpoint = (scratch_path(spark, n) for n in ("sent-all", "sent-rejects", "sent-all-log"))
    path = land_faulty_lines(spark, sf_dir)
    stream_publish(spark, path, out, checkpoint, ORDER_RECORD, rejects=rejects, trigger=ONCE).awaitTermination()
    sent = run_summary(spark.read.text(out).select(F.lit("none").alias(REASON)), REASON)
    return sent.union(run_summary(read_rejects(spark, rejects), REASON))


def stream_files_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, checkpoint = scratch_path(spark, "stopped"), scratch_path(spark, "stopped-log")
    stream_files(
        spark, land_ordered_files(spark, sf_dir), out, checkpoint, ORDER_RECORD, on_error="stop_file", trigger=ONCE
    ).awaitTermination()
    return plain(spark.read.parquet(out).select(*ORDER_RECORD.names))


def arriving_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "messages")
    damaged_props(spark, sf_dir).select("value").write.text(path)
    return arriving_messages(spark, path)


def stream_messages_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, checkpoint = scratch_path(spark, "handled"), scratch_path(spark, "handled-log")
    stream_messages(
        arriving_props(spark, sf_dir), out, checkpoint, PROPS, strict_fields=True, trigger=ONCE
    ).awaitTermination()
    good, bad = read_messages(spark, out, PROPS)
    handled = run_summary(good, "k").select(F.lit("none").alias(REASON), "k", "records")
    return handled.unionByName(run_summary(bad, REASON).select(REASON, F.lit(-1).cast("long").alias("k"), "records"))


def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event messages that come twice, damaged and without a key among them: only copies of keyed ones go."""
    fault = F.pmod("event_id", F.lit(50))
    whole = F.to_json(F.struct("event_id", "user_id"))
    value = (
        F.when(fault == 0, F.expr("left(whole, length(whole) - 1)"))
        .when(fault == 1, F.expr("replace(whole, 'event_id', 'other')"))
        .otherwise(F.col("whole"))
    )
    messages = table(spark, sf_dir, "events").withColumn("whole", whole).select(value.alias("value"))
    path, out, checkpoint = (scratch_path(spark, n) for n in ("repeated-mail", "once", "once-log"))
    messages.write.text(f"{path}/first")
    messages.write.text(f"{path}/second")
    fields = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType())])
    arriving = arriving_messages(spark, path, max_files_per_trigger=1, arrival=True)
    stream_messages(arriving, out, checkpoint, fields, dedupe=["event_id"], trigger=ONCE).awaitTermination()
    kept = spark.read.parquet(out)
    kind = F.coalesce(F.col(REASON), F.when(F.col("event_id").isNull(), "no_key").otherwise("keyed"))
    return run_summary(kept.select(F.pmod("user_id", F.lit(10)).alias("g"), kind.alias("kind")), "g", "kind").select(
        F.coalesce("g", F.lit(-1)).alias("g"), "kind", "records"
    )


def stream_lookup_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, out, checkpoint = (scratch_path(spark, n) for n in ("customers", "looked-up", "looked-up-log"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    customers.write.parquet(path)
    arriving = spark.readStream.schema(customers.schema).parquet(path)
    stream_lookup(
        arriving,
        table(spark, sf_dir, "supplier"),
        "c_custkey",
        out,
        checkpoint,
        table_key="s_suppkey",
        answers=["s_name"],
        trigger=ONCE,
    ).awaitTermination()
    return spark.read.parquet(out).drop("batch_id")


def records_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: extract, parse, publish, process and look up in one plan, counted per group."""
    return trace_lines(
        order_records(spark, sf_dir),
        faulty_line(),
        ORDER_RECORD,
        "rec_id",
        table(spark, sf_dir, "supplier"),
        "s_suppkey",
        "rec_group",
    )


def lines_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records to lines and back in one plan, malformed lines ending the job."""
    lines = order_records(spark, sf_dir).select(clean_line().alias("line"))
    return plain(parse_records(lines, ORDER_RECORD, on_error="fail"))


# User SQL: the text is the query, here and in the other engine.
USER_SQL = {
    "sql_extract": """
        SELECT c_custkey, c_name, n_name, c_acctbal
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        WHERE c_acctbal > 5000 AND c_mktsegment = 'BUILDING'
    """,
    "sql_price_summary": """
        SELECT l_returnflag, l_linestatus, count(*) AS n_lines,
               sum(CAST(l_quantity AS BIGINT)) AS sum_qty, max(l_extendedprice) AS max_price
        FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02 00:00:00'
        GROUP BY l_returnflag, l_linestatus
    """,
    "sql_join_chain": """
        SELECT r_name, n_name, count(*) AS n_lines, count(DISTINCT o_orderkey) AS n_orders
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
             JOIN customer ON o_custkey = c_custkey
             JOIN nation ON c_nationkey = n_nationkey
             JOIN region ON n_regionkey = r_regionkey
        WHERE l_returnflag = 'R'
        GROUP BY r_name, n_name
    """,
    "sql_rollup": """
        SELECT o_orderstatus, o_orderpriority, count(*) AS n_orders
        FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)
    """,
    "sql_semi_anti": """
        SELECT c_custkey, c_name FROM customer
        WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')
          AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)
    """,
    "sql_set_operations": """
        SELECT c_nationkey AS nationkey FROM customer WHERE c_acctbal < 0
        EXCEPT
        SELECT s_nationkey AS nationkey FROM supplier WHERE s_acctbal > 9000
    """,
    "sql_union_intersect": """
        SELECT c_nationkey AS nationkey, 'customer' AS side FROM customer WHERE c_acctbal > 9900
        UNION ALL
        (SELECT s_nationkey, 'both' FROM supplier INTERSECT SELECT c_nationkey, 'both' FROM customer)
    """,
    "sql_grouping_sets": """
        SELECT p_brand, coalesce(p_size, -1) AS p_size, count(*) AS n_parts, max(p_retailprice) AS max_price
        FROM part GROUP BY GROUPING SETS ((p_brand), (p_size), ()) HAVING count(*) > 10
    """,
    "sql_scalar_subquery": """
        SELECT o_orderkey, o_totalprice FROM orders
        WHERE o_totalprice > 0.95 * (SELECT max(o_totalprice) FROM orders WHERE o_orderstatus = 'F')
    """,
    "sql_right_join": """
        SELECT s.s_name AS supplier, c.c_custkey AS c_custkey
        FROM (SELECT * FROM supplier WHERE s_acctbal > 0) s
        RIGHT JOIN (SELECT * FROM customer WHERE c_mktsegment = 'MACHINERY') c ON s.s_suppkey = c.c_custkey
    """,
    "sql_full_join": """
        SELECT coalesce(c.c_custkey, s.s_suppkey) AS id, c.c_name AS customer, s.s_name AS supplier
        FROM (SELECT * FROM customer WHERE c_acctbal > 0) c
        FULL OUTER JOIN (SELECT * FROM supplier WHERE s_acctbal < 5000) s ON c.c_custkey = s.s_suppkey
    """,
}

QUERIES: dict[str, Query] = {
    "records_end_to_end": records_end_to_end,
    "extract_ordered": extract_ordered,
    "delimited_roundtrip": delimited_roundtrip,
    "delimited_ordered_files": delimited_ordered_files,
    "delimited_text_roundtrip": delimited_text_roundtrip,
    "run_summary": landed_summary,
    "land_and_check": land_and_check,
    "land_reordered": land_reordered,
    "split_extract": split_extract,
    "document_lines": document_lines,
    "lines_roundtrip": lines_roundtrip,
    "parse_records": parse_default,
    "parse_records_compat": parse_compat,
    "parse_rejects": rejects_by_reason,
    "parse_records_stop_file": parse_stop_file,
    "message_roundtrip": message_roundtrip,
    "message_field": message_field,
    "message_rejects": rejected_messages,
    "message_accepts": accepted_messages,
    "published_result": published_result,
    "processed_result": processed_result,
    "lookup_exists": lookup_with_answer,
    "lookup_disabled": lookup_disabled,
    "lookup_large_table": lookup_large_table,
    "lookup_status": lookup_status,
    "lookup_answer_text": lookup_answer_text,
    "lookup_address": lookup_address,
    "lookup_external": lookup_by_call,
    "lookup_request_count": lookup_request_count,
    "distinct_values": distinct_segments,
    "first_record": first_record,
    "top_n": top_amounts,
    "message_batches": event_batches,
    "unseen_files": unseen_files,
    "unseen_index": unseen_by_filters,
    "path_filter": page_paths,
    "contract_check": contract_lines,
    "contract_check_text": contract_documents,
    "reload_table_dense_key": reload_dense_key,
    "reload_table_copies": number_repeated_rows,
    "catalog_table": catalog_records,
    "stream_files": stream_files_records,
    "stream_publish": stream_published,
    "stream_publish_stop_file": stream_publish_stop_file,
    "stream_publish_rejects": stream_publish_rejects,
    "stream_files_stop_file": stream_files_stop,
    "nested_files": nested_files,
    "stream_dedupe": stream_dedupe,
    "stream_messages": stream_messages_summary,
    "stream_lookup": stream_lookup_customers,
    **STREAM_QUERIES,
    **{name: user_sql(query) for name, query in USER_SQL.items()},
}
