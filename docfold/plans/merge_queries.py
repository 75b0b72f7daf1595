"""Queries over stored merges, and over what two tables have in common, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docfold.operators import checks as C
from docfold.operators.bitmaps import orphan_buckets, orphan_rows
from docfold.operators.differences import differing_keys
from docfold.plans.maintained_checks import MaintainedUnique
from docfold.plans.table_queries import (
    MERGE_SQL,
    ORACLES,
    ORDER_COLUMNS,
    STORED_UNTIL,
    check_sql,
    incoming_orders,
    merged_table,
    own_database,
    query,
    stored_orders,
    table,
)
from docfold.sources.tables import create_table, insert_only_table, replace_table, scan, upsert_table
from docfold.specs import Column, TableSpec

RANGES = 16


@query(ORACLES["upsert_orders"])
def upsert_ranged_table(spark, sf_dir):
    """The merge of the other layouts; here the source touches most files, so the table is written anew."""
    return merged_table(spark, sf_dir, TableSpec("orders", ORDER_COLUMNS, ("o_orderkey",), ranges=RANGES))


@query(
    """
    WITH stored AS (SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice FROM orders),
    newest AS (SELECT * FROM stored WHERE o_orderkey > (SELECT max(o_orderkey) * 95 // 100 FROM orders)),
    incoming AS (
      SELECT o_orderkey, o_orderstatus, 'again' AS o_orderpriority, o_totalprice + 1 AS o_totalprice FROM newest
      UNION ALL SELECT o_orderkey + (SELECT max(o_orderkey) FROM orders), 'N', 'new', o_totalprice FROM newest
    )
    SELECT * FROM incoming
    UNION ALL SELECT * FROM stored t WHERE NOT EXISTS (SELECT 1 FROM incoming s WHERE s.o_orderkey = t.o_orderkey)
    """
)
def upsert_touched_files(spark, sf_dir):
    """Newest keys changed and newer ones added; files that hold none of them stay as they are."""
    spec = TableSpec("orders", ORDER_COLUMNS, ("o_orderkey",), ranges=RANGES)
    database, orders = own_database(spark), table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    replace_table(spark, database, spec, orders)
    last = orders.agg(F.max("o_orderkey")).first()[0] or 0
    newest = orders.where(F.col("o_orderkey") > last * 95 // 100)
    again = newest.withColumns({"o_orderpriority": F.lit("again"), "o_totalprice": F.col("o_totalprice") + 1})
    new = newest.withColumns({"o_orderkey": F.col("o_orderkey") + last, "o_orderstatus": F.lit("N"), "o_orderpriority": F.lit("new")})
    upsert_table(spark, database, spec, again.unionByName(new))
    return scan(spark, database, spec.name)


LINE_COLUMNS = (Column("l_orderkey", "bigint", required=True), Column("l_quantity", "double"), Column("l_returnflag", width=1))


@query(
    """
    WITH stored AS (SELECT l_orderkey, l_quantity, l_returnflag FROM lineitem WHERE l_shipdate < DATE '1999-01-01'),
    incoming AS (SELECT l_orderkey, CAST(sum(l_quantity) AS DOUBLE) AS l_quantity, 'X' AS l_returnflag FROM lineitem WHERE l_orderkey % 3 = 0 GROUP BY l_orderkey)
    SELECT t.l_orderkey, coalesce(s.l_quantity, t.l_quantity) AS l_quantity, coalesce(s.l_returnflag, t.l_returnflag) AS l_returnflag
    FROM stored t LEFT JOIN incoming s ON t.l_orderkey = s.l_orderkey
    UNION ALL SELECT * FROM incoming s WHERE NOT EXISTS (SELECT 1 FROM stored t WHERE t.l_orderkey = s.l_orderkey)
    """
)
def upsert_repeated_target(spark, sf_dir):
    """A stored key that several rows share: all of them are updated."""
    spec = TableSpec("lines", LINE_COLUMNS, ("l_orderkey",))
    database, lines = own_database(spark), table(spark, sf_dir, "lineitem")
    replace_table(spark, database, spec, lines.where(F.col("l_shipdate") < F.to_date(F.lit(STORED_UNTIL))).select(*spec.column_names))
    totals = lines.where("l_orderkey % 3 = 0").groupBy("l_orderkey").agg(F.sum("l_quantity").cast("double").alias("l_quantity"), F.lit("X").alias("l_returnflag"))
    upsert_table(spark, database, spec, totals)
    return scan(spark, database, spec.name)


@query(ORACLES["insert_only_pairs"])
def insert_only_table_pairs(spark, sf_dir):
    """New pairs as a part of their own beside the stored ones."""
    columns = (Column("l_orderkey", "bigint"), Column("l_partkey", "bigint"), Column("load_no", "int"))
    spec = TableSpec("pairs", columns, ("l_orderkey", "l_partkey"))
    database, lines = own_database(spark), table(spark, sf_dir, "lineitem")
    shipped = lines.where(F.col("l_shipdate") < F.to_date(F.lit(STORED_UNTIL)))
    create_table(spark, database, spec)
    insert_only_table(spark, database, spec, shipped.select(*spec.key).distinct().withColumn("load_no", F.lit(1)))
    insert_only_table(spark, database, spec, lines.select(*spec.key).distinct().withColumn("load_no", F.lit(2)))
    return scan(spark, database, spec.name)


@query(
    MERGE_SQL
    + """
    SELECT s.o_orderkey, s.o_orderstatus, s.o_orderpriority, coalesce(t.o_totalprice, 7.5) AS o_totalprice, coalesce(t.origin, 'unknown') AS origin
    FROM incoming s LEFT JOIN (SELECT *, 'given' AS origin FROM stored) t ON s.o_orderkey = t.o_orderkey
    UNION ALL SELECT *, 'given' AS origin FROM stored t WHERE NOT EXISTS (SELECT 1 FROM incoming s WHERE s.o_orderkey = t.o_orderkey)
    """
)
def upsert_with_default(spark, sf_dir):
    """Columns that the source lacks: kept in updated rows, their default in inserted ones."""
    columns = (*ORDER_COLUMNS[:3], Column("o_totalprice", "double", default="7.5D"), Column("origin", default="'unknown'"))
    spec = TableSpec("orders", columns, ("o_orderkey",))
    database = own_database(spark)
    replace_table(spark, database, spec, stored_orders(spark, sf_dir).withColumn("origin", F.lit("given")))
    upsert_table(spark, database, spec, incoming_orders(spark, sf_dir).drop("o_totalprice"))
    return scan(spark, database, spec.name)


@query(
    """
    SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 's2' ELSE 's' || (1 + event_id % 3) END AS stamp,
           CASE WHEN event_id % 3 = 0 THEN -1.0 ELSE value END AS value
    FROM events
    """
)
def upsert_newest_snapshot(spark, sf_dir):
    """A snapshot that lands after a newer one changes only rows that are older than itself."""
    spec = TableSpec("events", (Column("event_id", "bigint", required=True), Column("stamp"), Column("value", "double")), ("event_id",))
    database, events = own_database(spark), table(spark, sf_dir, "events")
    create_table(spark, database, spec)
    first = events.select("event_id", F.concat(F.lit("s"), 1 + F.col("event_id") % 3).alias("stamp"), "value")
    upsert_table(spark, database, spec, first, newest_by="stamp")
    # newer than rows stamped s1, older than those stamped s3
    late = events.where("event_id % 3 <> 1").select("event_id", F.lit("s2").alias("stamp"), F.lit(-1.0).alias("value"))
    upsert_table(spark, database, spec, late, newest_by="stamp")
    return scan(spark, database, spec.name)


@query(
    MERGE_SQL
    + """
    SELECT 'replace' AS step, count(*) AS n FROM stored
    UNION ALL SELECT 'upsert', count(*) FROM (SELECT o_orderkey FROM stored UNION SELECT o_orderkey FROM incoming)
    UNION ALL SELECT 'insert', (SELECT count(*) FROM orders) - (SELECT count(*) FROM (SELECT o_orderkey FROM stored UNION SELECT o_orderkey FROM incoming))
    """
)
def written_counts(spark, sf_dir):
    """Rows written by each step, as the writes observed them."""
    spec = TableSpec("orders", ORDER_COLUMNS, ("o_orderkey",), buckets=8)
    database, orders = own_database(spark), table(spark, sf_dir, "orders")
    replaced = replace_table(spark, database, spec, stored_orders(spark, sf_dir))
    merged = upsert_table(spark, database, spec, incoming_orders(spark, sf_dir))
    plain = TableSpec("plain", ORDER_COLUMNS, ("o_orderkey",))
    replace_table(spark, database, plain, scan(spark, database, "orders"))
    added = insert_only_table(spark, database, plain, orders.select(*spec.column_names))
    return spark.createDataFrame([("replace", replaced), ("upsert", merged), ("insert", added)], "step string, n bigint")


# Checks


def null_counts_sql() -> str:
    measures = {"USER": "event_id % 7 = 0", "VALUE": "value < 50", "PROPS": "event_id % 5 <> 0", "ID": "event_id IS NULL"}
    return " UNION ALL ".join(check_sql(f"NOT_NULL_{n}", "not_null", "holed", f"SELECT count(*) FROM events WHERE {c}") for n, c in measures.items())


@query(null_counts_sql())
def not_null_counts(spark, sf_dir):
    """NOT NULL checks that fail, with their counts."""
    events, n = table(spark, sf_dir, "events"), F.col("event_id")
    holed = events.select(
        n,
        F.when(n % 7 != 0, F.col("user_id")).alias("user_id"),
        F.when(F.col("value") >= 50, F.col("value")).alias("value"),
        F.when(n % 5 == 0, F.col("props")).alias("props"),
    )
    return C.run_suite(C.not_null(holed, {"NOT_NULL_USER": "user_id", "NOT_NULL_VALUE": "value", "NOT_NULL_PROPS": "props", "NOT_NULL_ID": "event_id"}, "holed"))


def closed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")


@query(
    """
    SELECT CASE WHEN l_orderkey > 0 THEN 1 + (l_orderkey - 1) // 32768 ELSE l_orderkey // 32768 END AS bucket,
           count(DISTINCT l_orderkey) AS orphans
    FROM lineitem c WHERE NOT EXISTS (SELECT 1 FROM orders p WHERE p.o_orderkey = c.l_orderkey AND p.o_orderstatus = 'F')
    GROUP BY 1
    """
)
def fk_orphan_bitmap(spark, sf_dir):
    """Different orphaned keys per bucket; no key of a row is shuffled."""
    return orphan_buckets(table(spark, sf_dir, "lineitem"), closed_orders(spark, sf_dir), "l_orderkey", "o_orderkey")


@query(ORACLES["fk_orphan_rows"])
def fk_orphan_rows_by_bitmap(spark, sf_dir):
    orphans = orphan_rows(table(spark, sf_dir, "lineitem"), closed_orders(spark, sf_dir), "l_orderkey", "o_orderkey")
    return orphans.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


#: The lines as another system holds them: some changed, some gone, some twice, one key more.
OTHER_LINES = """
    SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 997 = 5 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity, l_returnflag
    FROM lineitem WHERE l_orderkey % 1009 <> 7
    UNION ALL SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem WHERE l_orderkey % 1013 = 11
    UNION ALL SELECT max(l_orderkey) + 5000000, 1, 1, 'N' FROM lineitem
"""


@query(
    f"""
    WITH here AS (SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem), there AS ({OTHER_LINES}),
    unlike AS (
      SELECT DISTINCT l_orderkey FROM (
        (SELECT * FROM here EXCEPT ALL SELECT * FROM there) UNION ALL (SELECT * FROM there EXCEPT ALL SELECT * FROM here)
      )
    )
    SELECT l_orderkey, (SELECT count(*) FROM here h WHERE h.l_orderkey = u.l_orderkey) AS left_rows,
           (SELECT count(*) FROM there t WHERE t.l_orderkey = u.l_orderkey) AS right_rows
    FROM unlike u
    """
)
def differing_line_keys(spark, sf_dir):
    """Keys under which two copies of a table differ."""
    lines = table(spark, sf_dir, "lineitem")
    lines.createOrReplaceTempView("lineitem")
    here = lines.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    return differing_keys(here, spark.sql(OTHER_LINES).select(*[F.col(c).cast(here.schema[c].dataType) for c in here.columns]), "l_orderkey")


@query(
    MERGE_SQL
    + """
    , merged AS (
      SELECT * FROM incoming UNION ALL SELECT * FROM stored t WHERE NOT EXISTS (SELECT 1 FROM incoming s WHERE s.o_orderkey = t.o_orderkey)
    )
    SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS repeated
    FROM (SELECT count(*) AS n FROM merged GROUP BY o_orderstatus, o_orderpriority)
    """
)
def maintained_unique(spark, sf_dir):
    """Rows that share status and priority, kept up to date by a merge."""
    spec = TableSpec("orders", ORDER_COLUMNS, ("o_orderkey",), ranges=RANGES)
    database = own_database(spark)
    replace_table(spark, database, spec, stored_orders(spark, sf_dir))
    kept = MaintainedUnique(spark, database, spec, ["o_orderstatus", "o_orderpriority"], ranges=1)
    kept.rebuild()
    kept.upsert(incoming_orders(spark, sf_dir))
    return kept.measures()
