"""JSON documents made from the relational and web tables, every array built inside its own row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfold.functions.documents import TRAILING_DIGITS, document_text
from docfold.specs import BridgeSpec, Column, Field, FlattenSpec, ForeignKey, TableSpec

SITE = "https://shop.example/api"
HREF = 'href="([^"]*)"'

ORDER_FIELDS = FlattenSpec(
    (
        Field("$.id", "order_id", "bigint"),
        Field("$.name", "name"),
        Field("$.status", "status"),
        Field("$.priority", "priority"),
        Field("$.customer.name", "customer_name"),
        Field("$.customer.url", "customer_url"),
        Field("$.total", "total", "double"),
        Field("$.created", "created", "timestamp_ntz"),
    )
)
PART_FIELDS = FlattenSpec(
    (
        Field("$.id", "part_id", "bigint"),
        Field("$.name", "name"),
        Field("$.brand", "brand"),
        Field("$.details.type", "part_type"),
        Field("$.details.size", "part_size", "int"),
    )
)
ORDER_PARTS = BridgeSpec(Field("$.id", "order_id", "bigint"), "$.part", "part_id", "bigint", TRAILING_DIGITS)
PAGE_LINKS = BridgeSpec(Field("$.id", "page_id", "bigint"), "$.link", "link", "string")

DIM_ORDERS = TableSpec(
    "dim_orders",
    (
        Column("order_id", "bigint", required=True),
        Column("name", width=50, required=True),
        Column("status", width=1),
        Column("priority", width=50),
        Column("customer_name", width=50),
        Column("customer_url", width=500),
        Column("total", "double"),
        Column("created", "timestamp_ntz"),
    ),
    key=("order_id",),
)
DIM_PARTS = TableSpec(
    "dim_parts",
    (
        Column("part_id", "bigint", required=True),
        Column("name", width=100, required=True),
        Column("brand", width=50, required=True),
        Column("part_type", width=50),
        Column("part_size", "int"),
    ),
    key=("part_id",),
)
BRIDGE_ORDER_PARTS = TableSpec(
    "bridge_order_parts",
    (Column("order_id", "bigint", required=True), Column("part_id", "bigint", required=True)),
    key=("order_id", "part_id"),
    foreign_keys=(ForeignKey(("order_id",), "dim_orders", ("order_id",)), ForeignKey(("part_id",), "dim_parts", ("part_id",))),
)


def order_records(orders: DataFrame) -> DataFrame:
    """One JSON text per order with its customer nested; orders in progress have no customer object."""
    customer = F.struct(
        F.format_string("Customer#%09d", "o_custkey").alias("name"),
        F.concat(F.lit(f"{SITE}/customer/"), F.col("o_custkey")).alias("url"),
    )
    text = document_text(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("Order#"), F.col("o_orderkey")).alias("name"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.when(F.col("o_orderstatus") != "P", customer).alias("customer"),
        F.col("o_totalprice").alias("total"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("created"),
    )
    return orders.select(text.alias("value"), F.lit("orders.json").alias("file_name"))


def part_records(part: DataFrame) -> DataFrame:
    """One JSON text per part; the id is written as text, as some services do."""
    text = document_text(
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("brand"),
        F.struct(F.col("p_type").alias("type"), F.col("p_size").alias("size")).alias("details"),
    )
    return part.select(text.alias("value"), F.lit("parts.json").alias("file_name"))


def line_records(lineitem: DataFrame) -> DataFrame:
    """One JSON text per order line with the parts it refers to.

    Returned lines repeat the reference, new lines carry a JSON null, accepted lines a reference without a number.
    """
    url = F.concat(F.lit(f"{SITE}/part/"), F.col("l_partkey"))
    extra = (
        F.when(F.col("l_returnflag") == "R", url)
        .when(F.col("l_returnflag") == "A", F.lit(f"{SITE}/part/unknown"))
    )
    text = document_text(
        F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"), F.array(url, extra).alias("part")
    )
    return lineitem.select(text.alias("value"), F.lit("lines.json").alias("file_name"))


def page_records(pages: DataFrame) -> DataFrame:
    """One JSON text per web page: its address, the last step of the address as ``item``, and its links."""
    text = document_text(
        F.col("page_id").alias("id"),
        "url",
        F.substring_index("url", "/", -1).alias("item"),
        F.regexp_extract_all("html", F.lit(HREF), F.lit(1)).alias("link"),
    )
    return pages.select(text.alias("value"), F.lit("pages.json").alias("file_name"))


def page_envelopes(pages: DataFrame) -> DataFrame:
    """One enveloped document per web page; the total is counted apart from the records it announces."""
    links = F.regexp_extract_all("html", F.lit(HREF), F.lit(1))
    total = F.length("html") - F.length(F.replace(F.col("html"), F.lit("href="), F.lit("href")))
    text = document_text(
        F.lit("2024-01-01T00:00:00").alias("ingested_at"),
        F.col("url").alias("source"),
        total.alias("total_records"),
        F.transform(links, lambda link, i: F.struct(i.alias("id"), link.alias("url"))).alias("data"),
    )
    return pages.select(F.concat(F.lit("page_"), F.col("page_id"), F.lit(".json")).alias("file_name"), text.alias("value"))


def turn_pages(conversations: DataFrame) -> DataFrame:
    """Each turn of a conversation as an API page whose records are its lines."""
    lines = F.split("text", "\n")
    return conversations.select(
        "conv_id", "turn", F.parse_json(document_text(lines.alias("results"))).alias("doc"), F.size(lines).cast("bigint").alias("records")
    )
