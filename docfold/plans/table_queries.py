"""Every operator applied to whole tables, with the SQL that must give the same rows."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docfold.functions.documents import field, parse_document, trailing_id
from docfold.operators import checks as C
from docfold.operators.flatten import bridge, cast_rejects, flatten
from docfold.operators.keys import ROWS, digest
from docfold.operators.merge import insert_only, merge_conflicts, reject_null_keys, upsert, upsert_actions
from docfold.operators.reconcile import preview, reconcile_envelopes, record_counts, verify_load
from docfold.operators.snapshots import latest_snapshot, page_audit, page_counts, retain_snapshots, union_pages
from docfold.plans import documents as D
from docfold.session import shared_folder, written_together
from docfold.sources.landing import load_by_name, load_raw, load_records, read_latest_records, to_snapshot, write_snapshot
from docfold.sources.tables import (
    create_database,
    create_table,
    enforce_required,
    parts_for,
    replace_table,
    scan,
    upsert_table,
)
from docfold.specs import Column, Field, FlattenSpec, TableSpec

Query = Callable[[SparkSession, str], DataFrame]

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
LOAD_TIME = dt.datetime(2024, 3, 1, 12, 30, 45)

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function under its own name, with its SQL counterpart."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_records(D.order_records(table(spark, sf_dir, "orders")), load_ts=LOAD_TIME)


def raw_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_records(D.part_records(table(spark, sf_dir, "part")), load_ts=LOAD_TIME)


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_records(D.line_records(table(spark, sf_dir, "lineitem")), load_ts=LOAD_TIME)


def raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_records(D.page_records(table(spark, sf_dir, "pages")), load_ts=LOAD_TIME)


def enveloped_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    envelopes = D.page_envelopes(table(spark, sf_dir, "pages")).select("file_name", parse_document("value").alias("doc"))
    return envelopes.select(
        "file_name",
        field("doc", "$.total_records", "bigint").alias("total_records"),
        field("doc", "$.data", "array<variant>").alias("data"),
    )


# Loading


@query(
    """
    SELECT o_orderkey AS id, o_orderstatus AS status, o_orderpriority AS priority,
           TIMESTAMP '2024-03-01 12:30:45' AS ingested_at, 'orders.json' AS source_file
    FROM orders
    """
)
def raw_load_orders(spark, sf_dir):
    return raw_orders(spark, sf_dir).select(
        "id",
        field("raw_data", "$.status").alias("status"),
        field("raw_data", "$.priority").alias("priority"),
        "ingested_at",
        "source_file",
    )


@query(
    """
    WITH found AS (
      SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS links FROM pages
    ), numbered AS (
      SELECT page_id, links, unnest(generate_series(1, len(links))) AS i FROM found
    )
    SELECT CAST(i - 1 AS BIGINT) AS id, links[i] AS url, 'page_' || page_id || '.json' AS source_file FROM numbered
    """
)
def envelope_load(spark, sf_dir):
    envelopes = D.page_envelopes(table(spark, sf_dir, "pages"))
    raw = load_raw(envelopes.select("file_name", parse_document("value").alias("doc")), load_ts=LOAD_TIME)
    return raw.select("id", field("raw_data", "$.url").alias("url"), "source_file")


@query(
    """
    SELECT 'page_' || page_id || '.json' AS source_file,
           CAST((length(html) - length(replace(html, 'href=', ''))) / 5 AS BIGINT) AS declared,
           CAST(len(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS BIGINT) AS loaded,
           CASE WHEN (length(html) - length(replace(html, 'href=', ''))) / 5
                     = len(regexp_extract_all(html, 'href="([^"]*)"', 1)) THEN 'PASS' ELSE 'FAIL' END AS status
    FROM pages
    """
)
def envelope_reconcile(spark, sf_dir):
    return reconcile_envelopes(enveloped_pages(spark, sf_dir))


@query(
    """
    WITH links AS (
      SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS link FROM pages
    )
    SELECT page_id, count(*) AS loaded, count(DISTINCT link) AS stored,
           CASE WHEN count(*) = count(DISTINCT link) THEN 'PASS' ELSE 'FAIL' END AS status
    FROM links GROUP BY page_id
    """
)
def load_verification(spark, sf_dir):
    links = table(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit(D.HREF), F.lit(1))))
    stored = bridge(raw_pages(spark, sf_dir), D.PAGE_LINKS)
    return verify_load(links, stored, ["page_id"])


@query(
    """
    SELECT event_id, ts, user_id, event_type, value,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(NULL AS VARCHAR) AS channel
    FROM events
    """
)
def json_by_name_load(spark, sf_dir):
    lines = table(spark, sf_dir, "events").select(
        F.to_json(
            F.struct(
                F.col("event_id").alias("EVENT_ID"),
                F.col("ts").cast("string").alias("Ts"),
                F.col("user_id").alias("userNumber"),
                F.col("user_id").alias("User_Id"),
                "event_type",
                F.col("value").alias("VALUE"),
                F.from_json("props", "k int").alias("Props"),
            )
        ).alias("value")
    )
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props variant, channel string"
    return load_by_name(lines, schema).withColumn("k", field("props", "$.k", "int")).drop("props")


@query(
    """
    SELECT o_orderkey AS id, 'Order#' || o_orderkey AS name, o_orderstatus AS status
    FROM orders ORDER BY o_orderkey LIMIT 5
    """
)
def raw_preview(spark, sf_dir):
    columns = ["id", field("raw_data", "$.name").alias("name"), field("raw_data", "$.status").alias("status")]
    return preview(raw_orders(spark, sf_dir), columns, "id")


@query(
    """
    SELECT 'events_2024-03-01T12-30-45.json' AS snapshot, '2024-03-01T12:30:45' AS ingested_at,
           'events feed' AS source, count(*) AS total_records
    FROM events
    """
)
def snapshot_manifest(spark, sf_dir):
    return to_snapshot(table(spark, sf_dir, "events"), "events", "events feed", LOAD_TIME)[1]


@query("SELECT event_id, user_id, event_type, value, props FROM events")
def snapshot_records(spark, sf_dir):
    records, _ = to_snapshot(table(spark, sf_dir, "events"), "events", "events feed", LOAD_TIME)
    doc = parse_document("value")
    return records.select(doc.alias("doc")).select(
        field("doc", "$.event_id", "bigint").alias("event_id"),
        field("doc", "$.user_id", "bigint").alias("user_id"),
        field("doc", "$.event_type").alias("event_type"),
        field("doc", "$.value", "double").alias("value"),
        field("doc", "$.props").alias("props"),
    )


@query("SELECT event_id AS id, event_type, value, 'events_2024-03-01T12-30-45.json' AS source_file FROM events")
def landed_events(spark, sf_dir):
    """Written as a snapshot, found again as the newest one, and loaded."""
    root = f"{shared_folder(spark)}/docfold/{uuid.uuid4().hex}"
    events = table(spark, sf_dir, "events").withColumnRenamed("event_id", "id")
    write_snapshot(events, root, "events", "events feed", LOAD_TIME)
    raw = load_records(read_latest_records(spark, root, "events"), load_ts=LOAD_TIME)
    return raw.select(
        "id",
        field("raw_data", "$.event_type").alias("event_type"),
        field("raw_data", "$.value", "double").alias("value"),
        "source_file",
    )


# Flattening and bridges


@query(
    """
    SELECT o_orderkey AS order_id, 'Order#' || o_orderkey AS name, o_orderstatus AS status, o_orderpriority AS priority,
           CASE WHEN o_orderstatus <> 'P' THEN 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') END AS customer_name,
           CASE WHEN o_orderstatus <> 'P' THEN 'https://shop.example/api/customer/' || o_custkey END AS customer_url,
           o_totalprice AS total, o_orderdate AS created
    FROM orders
    """
)
def flatten_dim_orders(spark, sf_dir):
    return flatten(raw_orders(spark, sf_dir), D.ORDER_FIELDS)


@query(
    """
    SELECT p_partkey AS part_id, p_name AS name, p_brand AS brand, p_type AS part_type, p_size AS part_size FROM part
    """
)
def flatten_dim_parts(spark, sf_dir):
    return flatten(raw_parts(spark, sf_dir), D.PART_FIELDS)


@query("SELECT DISTINCT l_orderkey AS order_id, l_partkey AS part_id FROM lineitem")
def bridge_order_parts(spark, sf_dir):
    return reject_null_keys(bridge(raw_lines(spark, sf_dir), D.ORDER_PARTS), ["order_id", "part_id"])[0]


@query("SELECT DISTINCT l_orderkey AS order_id, CAST(NULL AS BIGINT) AS part_id FROM lineitem WHERE l_returnflag = 'A'")
def bridge_rejects(spark, sf_dir):
    return reject_null_keys(bridge(raw_lines(spark, sf_dir), D.ORDER_PARTS), ["order_id", "part_id"])[1]


@query("SELECT DISTINCT page_id, unnest(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) AS link FROM pages")
def bridge_page_links(spark, sf_dir):
    return bridge(raw_pages(spark, sf_dir), D.PAGE_LINKS)


PAGE_ITEMS = FlattenSpec((Field("$.id", "page_id", "bigint"), Field("$.item", "item", "bigint")))


@query("SELECT page_id, TRY_CAST(string_split(url, '/')[-1] AS BIGINT) AS item FROM pages")
def flatten_lenient_pages(spark, sf_dir):
    return flatten(raw_pages(spark, sf_dir), PAGE_ITEMS, strict=False)


@query(
    """
    SELECT page_id AS id, string_split(url, '/')[-1] AS item, 'item' AS bad_columns
    FROM pages WHERE TRY_CAST(string_split(url, '/')[-1] AS BIGINT) IS NULL
    """
)
def cast_rejects_pages(spark, sf_dir):
    return cast_rejects(raw_pages(spark, sf_dir), PAGE_ITEMS).select(
        "id", field("raw_data", "$.item").alias("item"), F.array_join("bad_columns", ",").alias("bad_columns")
    )


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def json_path_events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", field(parse_document("props"), "$.k", "int").alias("k"))


@query("SELECT page_id, CAST(nullif(regexp_extract(url, '[0-9]+$'), '') AS BIGINT) AS url_id FROM pages")
def url_trailing_id(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", trailing_id("url").alias("url_id"))


# Merging: the stored table holds what was ordered until the end of one year, the incoming snapshot the last years again,
# with the priority of some orders withdrawn.

STORED_UNTIL, INCOMING_FROM = "1999-01-01", "1997-01-01"
MERGE_SQL = """
    WITH stored AS (
      SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice FROM orders WHERE o_orderdate < DATE '1999-01-01'
    ), incoming AS (
      SELECT o_orderkey, lower(o_orderstatus) AS o_orderstatus,
             CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS o_orderpriority,
             o_totalprice * 2 AS o_totalprice
      FROM orders WHERE o_orderdate >= DATE '1997-01-01'
    )
"""


def stored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderdate") < F.to_date(F.lit(STORED_UNTIL)))
    return orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")


def incoming_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderdate") >= F.to_date(F.lit(INCOMING_FROM)))
    return orders.select(
        "o_orderkey",
        F.lower("o_orderstatus").alias("o_orderstatus"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("o_orderpriority"),
        (F.col("o_totalprice") * 2).alias("o_totalprice"),
    )


@query(
    MERGE_SQL
    + """
    SELECT * FROM incoming
    UNION ALL SELECT * FROM stored t WHERE NOT EXISTS (SELECT 1 FROM incoming s WHERE s.o_orderkey = t.o_orderkey)
    """
)
def upsert_orders(spark, sf_dir):
    return upsert(stored_orders(spark, sf_dir), incoming_orders(spark, sf_dir), ["o_orderkey"])


ORDER_COLUMNS = (
    Column("o_orderkey", "bigint", required=True),
    Column("o_orderstatus", width=1),
    Column("o_orderpriority", width=50),
    Column("o_totalprice", "double"),
)


def own_database(spark: SparkSession) -> str:
    """A database for one query, stored in the shared folder."""
    database = f"docfold_{uuid.uuid4().hex}"
    create_database(spark, database, f"{shared_folder(spark)}/{database}")
    return database


def merged_table(spark: SparkSession, sf_dir: str, spec: TableSpec) -> DataFrame:
    """The same merge into a stored table."""
    database = own_database(spark)
    create_table(spark, database, spec)
    replace_table(spark, database, spec, stored_orders(spark, sf_dir))
    upsert_table(spark, database, spec, incoming_orders(spark, sf_dir))
    return scan(spark, database, spec.name)


@query(ORACLES["upsert_orders"])
def upsert_bucketed_table(spark, sf_dir):
    buckets = parts_for(spark, f"{sf_dir}/orders.parquet")
    return merged_table(spark, sf_dir, TableSpec("orders", ORDER_COLUMNS, ("o_orderkey",), buckets=buckets))


@query(ORACLES["upsert_orders"])
def upsert_sliced_table(spark, sf_dir):
    slices = parts_for(spark, f"{sf_dir}/orders.parquet")
    return merged_table(spark, sf_dir, TableSpec("orders", ORDER_COLUMNS, ("o_orderkey",), slices=slices))


@query(
    MERGE_SQL
    + """
    SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, t.o_orderkey IS NULL AS is_new,
           CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
           CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderpriority ELSE t.o_orderpriority END AS o_orderpriority,
           CASE WHEN t.o_orderkey IS NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice
    FROM stored t FULL JOIN incoming s ON t.o_orderkey = s.o_orderkey
    """
)
def upsert_orders_partial(spark, sf_dir):
    stored = stored_orders(spark, sf_dir).withColumn("is_new", F.lit(False))
    incoming = incoming_orders(spark, sf_dir).withColumn("is_new", F.lit(True))
    return upsert(stored, incoming, ["o_orderkey"], update_cols=["o_orderstatus", "o_orderpriority"])


@query(
    MERGE_SQL
    + """
    , tagged AS (
      SELECT CASE WHEN t.o_orderkey IS NULL THEN 'insert' WHEN s.o_orderkey IS NULL THEN 'keep' ELSE 'update' END AS action
      FROM stored t FULL JOIN incoming s ON t.o_orderkey = s.o_orderkey
    )
    SELECT action, count(*) AS n FROM tagged GROUP BY action
    """
)
def upsert_orders_actions(spark, sf_dir):
    return upsert_actions(stored_orders(spark, sf_dir), incoming_orders(spark, sf_dir), ["o_orderkey"])


@query(ORACLES["flatten_dim_orders"])
def full_refresh_orders(spark, sf_dir):
    """A table that was emptied first takes whatever its source holds."""
    database = own_database(spark)
    create_table(spark, database, D.DIM_ORDERS)
    upsert_table(spark, database, D.DIM_ORDERS, flatten(raw_orders(spark, sf_dir), D.ORDER_FIELDS))
    return scan(spark, database, D.DIM_ORDERS.name)


@query(
    """
    WITH stored AS (
      SELECT DISTINCT l_orderkey, l_partkey, 1 AS load_no FROM lineitem WHERE l_shipdate < DATE '1999-01-01'
    ), incoming AS (
      SELECT DISTINCT l_orderkey, l_partkey, 2 AS load_no FROM lineitem
    )
    SELECT * FROM stored
    UNION ALL SELECT * FROM incoming s
    WHERE NOT EXISTS (SELECT 1 FROM stored t WHERE t.l_orderkey = s.l_orderkey AND t.l_partkey = s.l_partkey)
    """
)
def insert_only_pairs(spark, sf_dir):
    keys = ["l_orderkey", "l_partkey"]
    lineitem = table(spark, sf_dir, "lineitem")
    shipped = lineitem.where(F.col("l_shipdate") < F.to_date(F.lit(STORED_UNTIL)))
    stored = shipped.select(*keys).distinct().withColumn("load_no", F.lit(1))
    incoming = lineitem.select(*keys).distinct().withColumn("load_no", F.lit(2))
    return insert_only(stored, incoming, keys)


@query(
    """
    SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)
    GROUP BY l_orderkey HAVING count(*) > 1
    """
)
def merge_conflict_keys(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    return merge_conflicts(orders, table(spark, sf_dir, "lineitem"), ["l_orderkey"]).withColumnRenamed(ROWS, "n")


# Snapshots and pages


@query(
    """
    SELECT event_id, event_type, ts, value FROM (
      SELECT *, CAST(ts AS DATE) AS day, max(CAST(ts AS DATE)) OVER (PARTITION BY event_type) AS last_day FROM events
    ) WHERE day = last_day
    """
)
def latest_snapshots(spark, sf_dir):
    days = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return latest_snapshot(days, ["event_type"], "day").select("event_id", "event_type", "ts", "value")


@query("SELECT event_id, ts FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)")
def latest_snapshot_overall(spark, sf_dir):
    days = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return latest_snapshot(days, [], "day").select("event_id", "ts")


@query(
    """
    SELECT event_id, user_id, ts, value FROM (
      SELECT *, dense_rank() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC) AS age FROM events
    ) WHERE age <= 3
    """
)
def retained_snapshots(spark, sf_dir):
    days = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return retain_snapshots(days, ["user_id"], "day", keep=3).select("event_id", "user_id", "ts", "value")


@query(
    """
    WITH split AS (SELECT conv_id, turn, string_split(text, chr(10)) AS lines FROM conversations),
    numbered AS (SELECT conv_id, turn, lines, unnest(generate_series(1, len(lines))) AS i FROM split)
    SELECT conv_id, turn, CAST(i - 1 AS INTEGER) AS pos, lines[i] AS record FROM numbered
    """
)
def page_union(spark, sf_dir):
    pages = D.turn_pages(table(spark, sf_dir, "conversations"))
    pages = pages.withColumn("results", field("doc", "$.results", "array<variant>"))
    return union_pages(pages, ["conv_id", "turn"]).withColumn("record", field("record", "$"))


@query(
    """
    WITH pages_read AS (
      SELECT conv_id, turn, CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS records
      FROM conversations GROUP BY conv_id, turn
    )
    SELECT conv_id, turn, records,
           CAST(sum(records) OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS total_so_far
    FROM pages_read
    """
)
def page_totals(spark, sf_dir):
    return page_counts(D.turn_pages(table(spark, sf_dir, "conversations")), ["conv_id"], "turn", "records")


@query(
    """
    SELECT conv_id, count(DISTINCT turn) AS pages, min(turn) AS first_page, max(turn) AS last_page,
           max(turn) - min(turn) + 1 - count(DISTINCT turn) AS missing_pages,
           count(*) - count(DISTINCT turn) AS repeated_pages,
           CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS records
    FROM conversations GROUP BY conv_id
    """
)
def page_audits(spark, sf_dir):
    return page_audit(D.turn_pages(table(spark, sf_dir, "conversations")), ["conv_id"], "turn", "records")


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in TABLES))
def table_counts(spark, sf_dir):
    return record_counts({t: table(spark, sf_dir, t) for t in TABLES})


# Checks


def check_sql(name: str, kind: str, table_name: str, measure: str, expected: str = "0", severity: str = "FAIL") -> str:
    return f"""
    SELECT '{name}' AS check_name, '{kind}' AS check_type, '{table_name}' AS table_name,
           measure, expected, CASE WHEN measure = expected THEN 'PASS' ELSE '{severity}' END AS status
    FROM (SELECT CAST(({measure}) AS BIGINT) AS measure, CAST(({expected}) AS BIGINT) AS expected)
    """


def repeated_sql(table_name: str, keys: str) -> str:
    return f"""
    SELECT count(*) FROM (SELECT 1 FROM {table_name} QUALIFY count(*) OVER (PARTITION BY {keys}) > 1)
    """


def orphan_sql(child: str, parent: str, condition: str) -> str:
    return f"SELECT count(*) FROM {child} c WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE {condition})"


LINE_KEY = ["l_orderkey", "l_linenumber"]
TABLE_CHECK_SQL = [
    check_sql("PK_ORDERS_UNIQUE", "unique", "orders", repeated_sql("orders", "o_orderkey")),
    check_sql("PK_LINEITEM_UNIQUE", "unique", "lineitem", repeated_sql("lineitem", "l_orderkey, l_linenumber")),
    check_sql("PK_EVENTS_UNIQUE", "unique", "events", repeated_sql("events", "event_id")),
    *[
        check_sql(f"NOT_NULL_EVENTS_{c.upper()}", "not_null", "events", f"SELECT count(*) FROM events WHERE {c} IS NULL")
        for c in ("event_id", "user_id", "value", "props")
    ],
    check_sql(
        "FK_LINEITEM_TO_ORDERS", "foreign_key", "lineitem", orphan_sql("lineitem", "orders", "p.o_orderkey = c.l_orderkey")
    ),
    check_sql(
        "FK_LABELS_TO_DOCUMENTS", "foreign_key", "labels", orphan_sql("labels", "documents", "p.doc_id = c.doc_id")
    ),
    check_sql(
        "ROW_COUNT_LABELS", "row_count_match", "labels", "SELECT count(*) FROM labels", "SELECT count(*) FROM documents"
    ),
    check_sql(
        "MIN_LINES_PER_ORDER", "min_children", "orders",
        orphan_sql("orders", "lineitem", "p.l_orderkey = c.o_orderkey"), severity="WARNING",
    ),
]


def table_checks(spark: SparkSession, sf_dir: str) -> list[C.Check]:
    orders, lineitem, events, labels, documents = (
        table(spark, sf_dir, t) for t in ("orders", "lineitem", "events", "labels", "documents")
    )
    return [
        C.unique(orders, ["o_orderkey"], "PK_ORDERS_UNIQUE", "orders"),
        C.unique(lineitem, LINE_KEY, "PK_LINEITEM_UNIQUE", "lineitem"),
        C.unique(events, ["event_id"], "PK_EVENTS_UNIQUE", "events"),
        *C.not_null(events, {f"NOT_NULL_EVENTS_{c.upper()}": c for c in ("event_id", "user_id", "value", "props")}, "events"),
        C.foreign_key(lineitem, orders, ["l_orderkey"], ["o_orderkey"], "FK_LINEITEM_TO_ORDERS", "lineitem"),
        C.foreign_key(labels, documents, ["doc_id"], ["doc_id"], "FK_LABELS_TO_DOCUMENTS", "labels"),
        C.row_count_match(documents, labels, "ROW_COUNT_LABELS", "labels"),
        C.min_children(orders, lineitem, ["o_orderkey"], ["l_orderkey"], "MIN_LINES_PER_ORDER", "orders"),
    ]


SUITE_SQL = " UNION ALL ".join(TABLE_CHECK_SQL)


@query(SUITE_SQL)
def quality_suite(spark, sf_dir):
    return C.run_suite(table_checks(spark, sf_dir))


@query(
    f"""
    SELECT *, CASE WHEN total = 0 THEN 0.0 ELSE round(100.0 * passed / total, 1) END AS success_rate,
           CASE WHEN failed > 0 OR errors > 0 OR total = 0 THEN 'FAILED'
                WHEN warnings > 0 THEN 'PASSED WITH WARNINGS' ELSE 'ALL CHECKS PASSED' END AS verdict
    FROM (
      SELECT count(*) AS total, count(*) FILTER (status = 'PASS') AS passed, count(*) FILTER (status = 'FAIL') AS failed,
             count(*) FILTER (status = 'WARNING') AS warnings, count(*) FILTER (status = 'ERROR') AS errors
      FROM ({SUITE_SQL})
    )
    """
)
def quality_summary(spark, sf_dir):
    return C.summarise(C.run_suite(table_checks(spark, sf_dir)))


@query(f"SELECT check_name, measure, status FROM ({SUITE_SQL}) WHERE status IN ('FAIL', 'ERROR')")
def blocking_checks(spark, sf_dir):
    return C.blocking(C.run_suite(table_checks(spark, sf_dir))).select("check_name", "measure", "status")


@query(
    check_sql(
        "PAGE_LINK_TOTALS", "envelope_totals", "pages",
        """
        SELECT count(*) FROM pages
        WHERE (length(html) - length(replace(html, 'href=', ''))) / 5 <> len(regexp_extract_all(html, 'href="([^"]*)"', 1))
        """,
    )
)
def envelope_totals(spark, sf_dir):
    return C.run_suite([C.envelope_totals(enveloped_pages(spark, sf_dir), "PAGE_LINK_TOTALS", "pages")])


@query(TABLE_CHECK_SQL[1])
def pk_unique_lineitem(spark, sf_dir):
    return C.run_suite([C.unique(table(spark, sf_dir, "lineitem"), LINE_KEY, "PK_LINEITEM_UNIQUE", "lineitem")])


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
    QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1
    """
)
def pk_violations_lineitem(spark, sf_dir):
    check = C.unique(table(spark, sf_dir, "lineitem"), LINE_KEY, "PK_LINEITEM_UNIQUE", "lineitem")
    return C.violations(check).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@query(TABLE_CHECK_SQL[2])
def pk_unique_events(spark, sf_dir):
    return C.run_suite([C.unique(table(spark, sf_dir, "events"), ["event_id"], "PK_EVENTS_UNIQUE", "events")])


@query(" UNION ALL ".join(TABLE_CHECK_SQL[3:7]))
def not_null_suite(spark, sf_dir):
    columns = {f"NOT_NULL_EVENTS_{c.upper()}": c for c in ("event_id", "user_id", "value", "props")}
    return C.run_suite(C.not_null(table(spark, sf_dir, "events"), columns, "events"))


@query("SELECT o_orderkey AS order_id, o_orderstatus AS status FROM orders WHERE o_orderstatus = 'P'")
def not_null_violations(spark, sf_dir):
    dim = flatten(raw_orders(spark, sf_dir), D.ORDER_FIELDS)
    (check,) = C.not_null(dim, {"NOT_NULL_ORDERS_CUSTOMER": "customer_name"}, "dim_orders")
    return C.violations(check).select("order_id", "status")


@query(TABLE_CHECK_SQL[7])
def fk_lineitem_orders(spark, sf_dir):
    lineitem, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return C.run_suite([C.foreign_key(lineitem, orders, ["l_orderkey"], ["o_orderkey"], "FK_LINEITEM_TO_ORDERS", "lineitem")])


@query(TABLE_CHECK_SQL[8])
def fk_labels_documents(spark, sf_dir):
    labels, documents = table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents")
    return C.run_suite([C.foreign_key(labels, documents, ["doc_id"], ["doc_id"], "FK_LABELS_TO_DOCUMENTS", "labels")])


def closed_order_check(spark: SparkSession, sf_dir: str) -> C.Check:
    closed = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
    lineitem = table(spark, sf_dir, "lineitem")
    return C.foreign_key(lineitem, closed, ["l_orderkey"], ["o_orderkey"], "FK_LINEITEM_TO_CLOSED_ORDERS", "lineitem")


@query(
    check_sql(
        "FK_LINEITEM_TO_CLOSED_ORDERS", "foreign_key", "lineitem",
        orphan_sql("lineitem", "orders", "p.o_orderkey = c.l_orderkey AND p.o_orderstatus = 'F'"),
    )
)
def fk_orphan_count(spark, sf_dir):
    return C.run_suite([closed_order_check(spark, sf_dir)])


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem c
    WHERE NOT EXISTS (SELECT 1 FROM orders p WHERE p.o_orderkey = c.l_orderkey AND p.o_orderstatus = 'F')
    """
)
def fk_orphan_rows(spark, sf_dir):
    orphans = C.violations(closed_order_check(spark, sf_dir))
    return orphans.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query(
    check_sql("ROW_COUNT_ORDERS", "row_count_match", "dim_orders", "SELECT count(*) FROM orders", "SELECT count(*) FROM orders")
)
def row_count_match(spark, sf_dir):
    dim = flatten(raw_orders(spark, sf_dir), D.ORDER_FIELDS)
    return C.run_suite([C.row_count_match(table(spark, sf_dir, "orders"), dim, "ROW_COUNT_ORDERS", "dim_orders")])


@query(TABLE_CHECK_SQL[10])
def min_children_orders(spark, sf_dir):
    orders, lineitem = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    return C.run_suite([C.min_children(orders, lineitem, ["o_orderkey"], ["l_orderkey"], "MIN_LINES_PER_ORDER", "orders")])


@query(
    """
    SELECT o_orderkey, o_custkey, o_orderstatus FROM orders c
    WHERE NOT EXISTS (SELECT 1 FROM lineitem p WHERE p.l_orderkey = c.o_orderkey)
    """
)
def childless_orders(spark, sf_dir):
    orders, lineitem = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    check = C.min_children(orders, lineitem, ["o_orderkey"], ["l_orderkey"], "MIN_LINES_PER_ORDER", "orders")
    return C.violations(check).select("o_orderkey", "o_custkey", "o_orderstatus")


@query(
    """
    SELECT doc_id, lang, source, n_chars FROM documents QUALIFY count(*) OVER (PARTITION BY text) > 1
    """
)
def duplicate_documents(spark, sf_dir):
    documents = digest(table(spark, sf_dir, "documents"), "text")
    check = C.unique(documents, ["__digest"], "PK_DOCUMENTS_TEXT_UNIQUE", "documents")
    return C.violations(check).select("doc_id", "lang", "source", "n_chars")


@query(
    check_sql("PK_DOCUMENTS_TEXT_UNIQUE", "unique", "documents", repeated_sql("documents", "text"))
)
def duplicate_document_count(spark, sf_dir):
    documents = digest(table(spark, sf_dir, "documents"), "text")
    return C.run_suite([C.unique(documents, ["__digest"], "PK_DOCUMENTS_TEXT_UNIQUE", "documents")])


# The whole way: documents to a model of two dimensions and a bridge, then its thirteen checks

PAIRS = "(SELECT DISTINCT l_orderkey AS order_id, l_partkey AS part_id FROM lineitem)"
MODEL_CHECK_SQL = [
    check_sql("PK_ORDERS_UNIQUE", "unique", "dim_orders", repeated_sql("orders", "o_orderkey")),
    check_sql("PK_PARTS_UNIQUE", "unique", "dim_parts", repeated_sql("part", "p_partkey")),
    check_sql("PK_BRIDGE_UNIQUE", "unique", "bridge_order_parts", repeated_sql(PAIRS, "order_id, part_id")),
    check_sql("NOT_NULL_ORDERS_ID", "not_null", "dim_orders", "SELECT count(*) FROM orders WHERE o_orderkey IS NULL"),
    check_sql("NOT_NULL_ORDERS_NAME", "not_null", "dim_orders", "SELECT count(*) FROM orders WHERE o_orderkey IS NULL"),
    check_sql("NOT_NULL_PARTS_ID", "not_null", "dim_parts", "SELECT count(*) FROM part WHERE p_partkey IS NULL"),
    check_sql("NOT_NULL_PARTS_NAME", "not_null", "dim_parts", "SELECT count(*) FROM part WHERE p_name IS NULL"),
    check_sql("NOT_NULL_PARTS_BRAND", "not_null", "dim_parts", "SELECT count(*) FROM part WHERE p_brand IS NULL"),
    check_sql(
        "FK_BRIDGE_TO_ORDERS", "foreign_key", "bridge_order_parts", orphan_sql(PAIRS, "orders", "p.o_orderkey = c.order_id")
    ),
    check_sql(
        "FK_BRIDGE_TO_PARTS", "foreign_key", "bridge_order_parts", orphan_sql(PAIRS, "part", "p.p_partkey = c.part_id")
    ),
    check_sql(
        "ROW_COUNT_ORDERS", "row_count_match", "dim_orders", "SELECT count(*) FROM orders", "SELECT count(*) FROM orders"
    ),
    check_sql("ROW_COUNT_PARTS", "row_count_match", "dim_parts", "SELECT count(*) FROM part", "SELECT count(*) FROM part"),
    check_sql(
        "BRIDGE_MIN_PARTS_PER_ORDER", "min_children", "bridge_order_parts",
        orphan_sql("orders", PAIRS, "p.order_id = c.o_orderkey"), severity="WARNING",
    ),
]


@query(" UNION ALL ".join(MODEL_CHECK_SQL))
def model_quality(spark, sf_dir):
    order_docs, part_docs = raw_orders(spark, sf_dir), raw_parts(spark, sf_dir)
    model = {
        D.DIM_ORDERS: flatten(order_docs, D.ORDER_FIELDS),
        D.DIM_PARTS: flatten(part_docs, D.PART_FIELDS),
        D.BRIDGE_ORDER_PARTS: bridge_order_parts(spark, sf_dir),
    }
    stored = written_together({spec.name: enforce_required(df, spec) for spec, df in model.items()})
    orders, parts, pairs = (stored[spec.name] for spec in model)
    return C.run_suite(
        [
            C.unique(orders, ["order_id"], "PK_ORDERS_UNIQUE", "dim_orders"),
            C.unique(parts, ["part_id"], "PK_PARTS_UNIQUE", "dim_parts"),
            C.unique(pairs, ["order_id", "part_id"], "PK_BRIDGE_UNIQUE", "bridge_order_parts"),
            *C.not_null(orders, {"NOT_NULL_ORDERS_ID": "order_id", "NOT_NULL_ORDERS_NAME": "name"}, "dim_orders"),
            *C.not_null(
                parts,
                {"NOT_NULL_PARTS_ID": "part_id", "NOT_NULL_PARTS_NAME": "name", "NOT_NULL_PARTS_BRAND": "brand"},
                "dim_parts",
            ),
            C.foreign_key(pairs, orders, ["order_id"], ["order_id"], "FK_BRIDGE_TO_ORDERS", "bridge_order_parts"),
            C.foreign_key(pairs, parts, ["part_id"], ["part_id"], "FK_BRIDGE_TO_PARTS", "bridge_order_parts"),
            C.row_count_match(order_docs, orders, "ROW_COUNT_ORDERS", "dim_orders"),
            C.row_count_match(part_docs, parts, "ROW_COUNT_PARTS", "dim_parts"),
            C.min_children(orders, pairs, ["order_id"], ["order_id"], "BRIDGE_MIN_PARTS_PER_ORDER", "bridge_order_parts"),
        ]
    )
