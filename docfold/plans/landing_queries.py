"""Queries over landed files and page chains, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docfold.functions.documents import field
from docfold.operators.chains import chain_faults, page_chain
from docfold.operators.drift import schema_drift
from docfold.operators.reconcile import reconcile_stored
from docfold.operators.snapshots import page_audit, page_faults
from docfold.plans.table_queries import LOAD_TIME, query, table
from docfold.session import shared_folder
from docfold.sources.envelopes import read_split_envelopes
from docfold.sources.landing import by_name_rejects, load_raw, load_records, read_envelopes
from docfold.specs import Field, FlattenSpec

#: What surrounds the records of the one envelope that the queries below read; its notes are there to mislead.
HEAD = '{"ingested_at": "2024-03-01T12:30:45", "notes": ["data: [", {"data": [{}, "}"]}], "source": "events \\"feed\\" {", "total_records": '


def events_envelope(spark: SparkSession, sf_dir: str) -> str:
    """Folder with one enveloped file of all events. One file has one writer, so this part does not spread over tasks; it is given the columns,
    which are smaller than the records, and makes the text itself."""
    events = table(spark, sf_dir, "events")
    given = ["event_type", "value", "props", "user_id"]
    head = events.agg(F.concat(F.lit(HEAD), F.count(F.lit(1)).cast("string"), F.lit(', "data": [')).alias("text")).select(F.lit(0).alias("part"), F.lit(-1).cast("bigint").alias("id"), "text")
    first = events.agg(F.min("event_id")).scalar()
    lines = events.select(F.lit(1).alias("part"), F.col("event_id").alias("id"), *given)
    tail = spark.range(1).select(F.lit(2).alias("part"), "id", F.lit("]}").alias("text"))
    rows = lines.unionByName(head, True).unionByName(tail, True).repartition(1).sortWithinPartitions("part", "id")
    note = F.concat(F.lit('"}, {\\'), F.col("props"), F.lit("]}"))
    record = F.to_json(F.struct("id", "event_type", "value", "props", note.alias("note"), F.struct(F.array(F.struct("user_id")).alias("data")).alias("more")))
    line = F.concat(F.when(F.col("id") == first, "").otherwise(","), record)
    path = f"{shared_folder(spark)}/docfold/{uuid.uuid4().hex}/events"
    rows.select(F.when(F.col("part") == 1, line).otherwise(F.col("text")).alias("value")).write.text(path)
    return path


def _event_rows(raw: DataFrame) -> DataFrame:
    return raw.select(
        "id",
        field("raw_data", "$.event_type").alias("event_type"),
        field("raw_data", "$.value", "double").alias("value"),
        field("raw_data", "$.note").alias("note"),
        field("raw_data", "$.more.data[0].user_id", "bigint").alias("user_id"),
    )


EVENT_ROWS = """SELECT event_id AS id, event_type, value, '"}, {\\' || props || ']}' AS note, user_id FROM events"""


@query(EVENT_ROWS)
def envelope_split_load(spark, sf_dir):
    """The envelope read by as many tasks as it has splits."""
    _, records = read_split_envelopes(spark, events_envelope(spark, sf_dir))
    return _event_rows(load_raw(records, load_ts=LOAD_TIME))


@query(EVENT_ROWS)
def envelope_whole_load(spark, sf_dir):
    """The same envelope read as one value, or in parts if it is too large for that."""
    return _event_rows(load_raw(read_envelopes(spark, events_envelope(spark, sf_dir)), load_ts=LOAD_TIME))


@query(
    """
    SELECT '2024-03-01T12:30:45' AS ingested_at, 'events "feed" {' AS source, count(*) AS declared, count(*) AS stored, 'PASS' AS status
    FROM events
    """
)
def stored_totals(spark, sf_dir):
    """The total that a split envelope announces against the records loaded from it."""
    heads, records = read_split_envelopes(spark, events_envelope(spark, sf_dir))
    about = heads.select(F.col("file_name").alias("source_file"), "ingested_at", "source", "total_records")
    found = reconcile_stored(about.select("source_file", "total_records"), load_raw(records, load_ts=LOAD_TIME))
    return found.join(about, "source_file").select("ingested_at", "source", "declared", "stored", "status")


# Pages

#: Links of the turns of each conversation, taken as pages: whole chains, cycles, skipped pages, links to nowhere, copies that differ.
LINKED_PAGES = """
    SELECT conv_id, turn,
           CASE WHEN conv_id % 6 = 1 AND turn = last THEN 0
                WHEN conv_id % 6 = 2 AND turn = 0 AND last > 1 THEN 2
                WHEN conv_id % 6 = 3 AND turn = 1 THEN 1000
                WHEN conv_id % 6 = 4 AND turn = last THEN turn
                WHEN turn = last THEN NULL
                ELSE turn + 1 END AS follows
    FROM (SELECT conv_id, turn, max(turn) OVER (PARTITION BY conv_id) AS last FROM conversations)
    UNION ALL
    SELECT conv_id, turn, 0 AS follows FROM conversations WHERE conv_id % 6 = 5 AND turn = 1
"""


def linked_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "conversations").createOrReplaceTempView("conversations")
    return spark.sql(LINKED_PAGES)


CHAIN_SQL = f"""
    WITH RECURSIVE given AS ({LINKED_PAGES}),
    node AS (
      SELECT conv_id, turn, min(follows) AS next, count(*) AS n,
             count(DISTINCT follows) + max(CASE WHEN follows IS NULL THEN 1 ELSE 0 END) AS variants
      FROM given GROUP BY conv_id, turn
    ),
    back AS (
      SELECT conv_id, turn, 0 AS steps FROM node
      WHERE next IS NULL OR NOT EXISTS (SELECT 1 FROM node t WHERE t.conv_id = node.conv_id AND t.turn = node.next)
      UNION ALL
      SELECT node.conv_id, node.turn, back.steps + 1 FROM node JOIN back ON node.conv_id = back.conv_id AND node.next = back.turn
    ),
    chain AS (
      SELECT node.*, back.steps,
             EXISTS (SELECT 1 FROM node t WHERE t.conv_id = node.conv_id AND t.turn = node.next) AS found,
             (SELECT count(*) FROM node t WHERE t.conv_id = node.conv_id AND t.next = node.turn) AS linked
      FROM node LEFT JOIN back ON node.conv_id = back.conv_id AND node.turn = back.turn
    )
"""


@query(f"{CHAIN_SQL} SELECT conv_id, turn, next, found, linked, steps FROM chain")
def page_chains(spark, sf_dir):
    chain = page_chain(linked_pages(spark, sf_dir), ["conv_id"], "turn", "follows")
    return chain.select("conv_id", "turn", "next", "found", "linked", "steps")


@query(
    f"""{CHAIN_SQL}
    SELECT conv_id, count(*) AS pages, arg_min(steps, turn) FILTER (WHERE turn = 0) + 1 AS chain_length,
           count(*) FILTER (WHERE linked = 0 AND turn <> 0) AS heads, abs(count(*) FILTER (WHERE next IS NULL) - 1) AS ends,
           CAST(sum(greatest(linked - 1, 0)) AS BIGINT) AS merged, count(*) FILTER (WHERE next IS NOT NULL AND NOT found) AS dangling,
           count(*) FILTER (WHERE steps IS NULL) AS cyclic, count(*) FILTER (WHERE next <> turn + 1) AS misnumbered,
           CAST(sum(n - 1) AS BIGINT) AS repeated, count(*) FILTER (WHERE variants > 1) AS conflicting
    FROM chain GROUP BY conv_id
    """
)
def page_chain_faults(spark, sf_dir):
    chain = page_chain(linked_pages(spark, sf_dir), ["conv_id"], "turn", "follows")
    return chain_faults(chain, ["conv_id"], "turn").drop("first_page")


#: Turns as pages with gaps and copies.
GAPPED_PAGES = """
    SELECT conv_id, turn + 1 AS page, text FROM conversations WHERE (conv_id + turn) % 5 <> 2
    UNION ALL
    SELECT conv_id, turn + 1 AS page, text FROM conversations WHERE (conv_id + turn) % 7 = 3
"""


def gapped_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "conversations").createOrReplaceTempView("conversations")
    return spark.sql(GAPPED_PAGES).withColumn("records", F.length("text").cast("bigint"))


@query(
    f"""
    WITH given AS ({GAPPED_PAGES}), page AS (SELECT conv_id, page, count(*) AS n, sum(length(text)) AS records FROM given GROUP BY conv_id, page)
    SELECT conv_id, count(*) AS pages, min(page) AS first_page, max(page) AS last_page, max(page) - min(page) + 1 - count(*) AS missing_pages,
           CAST(sum(n - 1) AS BIGINT) AS repeated_pages, CAST(sum(records) AS BIGINT) AS records
    FROM page GROUP BY conv_id
    """
)
def page_audit_gaps(spark, sf_dir):
    return page_audit(gapped_pages(spark, sf_dir), ["conv_id"], "page", "records")


@query(
    f"""
    WITH given AS ({GAPPED_PAGES}), page AS (SELECT conv_id, page, count(*) AS n FROM given GROUP BY conv_id, page)
    SELECT conv_id, max(page) - count(*) AS missing_pages, 0 AS unfinished, 0 AS early_ends,
           CAST(sum(n - 1) AS BIGINT) AS repeated_pages, 0 AS without_results, 0 AS unnumbered
    FROM page GROUP BY conv_id
    """
)
def page_fault_counts(spark, sf_dir):
    pages = gapped_pages(spark, sf_dir)
    ends = pages.groupBy("conv_id").agg(F.max("page").alias("last"))
    linked = pages.join(ends, "conv_id").withColumn("next", F.when(F.col("page") < F.col("last"), F.col("page") + 1))
    return page_faults(linked, ["conv_id"], "page", "next", "records")


@query(
    """
    SELECT 'line ' || event_id || CASE WHEN event_id % 3 = 0 THEN ' {' ELSE ' [1]' END AS value FROM events WHERE event_id % 3 <> 1
    UNION ALL SELECT '[' || event_id || ']' FROM events WHERE event_id % 3 = 1 AND event_id % 2 = 0
    """
)
def by_name_rejected(spark, sf_dir):
    """Lines that are no JSON objects, among those that are."""
    events, n = table(spark, sf_dir, "events"), F.col("event_id")
    bad = F.concat(F.lit("line "), n, F.when(n % 3 == 0, " {").otherwise(" [1]"))
    good = F.when(n % 2 == 0, F.concat(F.lit("["), n, F.lit("]"))).otherwise(F.to_json(F.struct("event_id", "props")))
    return by_name_rejects(events.select(F.when(n % 3 != 1, bad).otherwise(good).alias("value")))


@query(
    """
    WITH held AS (
      SELECT max(CASE WHEN json_type(props, '$.k') IN ('UBIGINT', 'BIGINT') THEN 'bigint' ELSE lower(json_type(props, '$.k')) END) AS k,
             count(DISTINCT json_type(props, '$.k')) AS kinds
      FROM events
    )
    SELECT '$.event' AS path, 'bigint' AS declared, 'bigint' AS observed, 'same' AS status
    UNION ALL SELECT '$.gone', 'string', NULL, 'vanished'
    UNION ALL SELECT '$.kind', NULL, 'string', 'new'
    UNION ALL SELECT '$.props.k', 'string', k, CASE WHEN k = 'varchar' THEN 'same' ELSE 'changed' END FROM held
    UNION ALL SELECT '$.value', 'double', CASE WHEN count(*) > 0 THEN 'number' END, 'same' FROM events
    """
)
def event_schema_drift(spark, sf_dir):
    """Paths of event documents that a declaration does not know, no longer finds, or expects to be of another type."""
    events = table(spark, sf_dir, "events")
    text = F.concat(F.lit('{"event": '), "event_id", F.lit(', "kind": '), F.to_json(F.array("event_type")).substr(F.lit(2), F.length(F.to_json(F.array("event_type"))) - 2), F.lit(', "value": '), "value", F.lit(', "props": '), "props", F.lit("}"))
    raw = load_records(events.select(text.alias("value"), F.lit("events.json").alias("file_name")), id_path="$.event", load_ts=LOAD_TIME)
    spec = FlattenSpec((Field("$.event", "event", "bigint"), Field("$.value", "value", "double"), Field("$.props.k", "k"), Field("$.gone", "gone")))
    found = schema_drift(raw, spec)
    # how wide the numbers are depends on the data
    return found.withColumn("observed", F.when((F.col("path") == "$.value") & F.col("observed").rlike("^(decimal|double|bigint)"), "number").otherwise(F.col("observed")))
