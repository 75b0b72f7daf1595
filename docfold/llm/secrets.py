"""Credentials in texts, told apart by how many repositories and owners hold them.

Patterns propose candidates: assignments to a name such as ``password``, access key ids, long hexadecimal runs, and the further
kinds in ``MORE``. The value of each is hashed and counted over the corpus by distinct repositories (``source``) and owners
(``source`` up to its first ``/``). A value in ``WIDE`` owners or more is a widely copied example; any other is owned. An
owned value looks live if it has ``LIVE_CHARACTERS`` different characters, as placeholders such as ``xxxxxxxx`` have not. Forks of one
owner add repositories but no owners, so they don't make a value widely copied. Counting goes by (value, owner, repository), then
(value, owner), then value, each summed before it is shuffled, so a value that a third of all rows hold costs each task one row.

Null texts have no spans. A null source counts as one owner. Repeated rows are reported each; their values count once per
source. Places are in code points, end exclusive. An empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docfold.llm.spans import INNER, MARK, clean, count_kind, joined, with_found
from docfold.session import written

#: Fixed patterns of the base kinds; matches that are too short are dropped afterwards or can't arise.
ASSIGN = "((?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?)([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
BASE = ("assign", "access", "hex")
#: Fixed patterns of the added kinds, each with a text that every match contains.
MORE = {
    "github": ("_", "gh[pousr]_[A-Za-z0-9]{36,}"),
    "slack": ("xox", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    "jwt": ("eyJ", "eyJ[A-Za-z0-9_-]{10,}\\.eyJ[A-Za-z0-9_-]{10,}\\.[A-Za-z0-9_-]{10,}"),
    "pem": ("PRIVATE KEY", "-----BEGIN (?:[A-Z]{1,12} ){0,3}PRIVATE KEY-----"),
}
WIDE = 3
LIVE_CHARACTERS = 8
KINDS = (*BASE, *MORE)
COUNTS = ("n_copied", "n_owned", "n_live", "max_repositories", "max_owners")


def _kind(order: int, spans: Column) -> Column:
    kind = KINDS[order]
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("order"), F.lit(kind).alias("kind"), s["end"].alias("end"), F.sha2(s["value"], 256).alias("hash"), (F.size(F.array_distinct(F.split(s["value"], ""))) >= LIVE_CHARACTERS).alias("varied")))


def with_candidates(df: DataFrame) -> DataFrame:
    """``df`` with ``spans`` in place of ``text``: array of ``start, order, kind, end, hash, varied`` by start, then kind."""
    df = df.withColumn("text", clean(F.col("text")))
    text = F.col("text")
    after_inner = lambda m: F.substring_index(m, INNER, -1)
    df = with_found(df, "assign", text, ASSIGN, f"{MARK}$1{INNER}$2{MARK}", valid=lambda m: F.length(after_inner(m)) >= 8, value=after_inner)
    df = with_found(df, "access", text, ACCESS, needs=F.contains(text, F.lit("AKIA")))
    df = with_found(df, "hex", text, HEX)
    for kind, (needed, pattern) in MORE.items():
        df = with_found(df, kind, text, pattern, needs=F.contains(text, F.lit(needed)))
    spans = F.array_sort(F.concat(*(_kind(i, F.col(kind)) for i, kind in enumerate(KINDS))))
    return df.withColumn("spans", spans).drop("text", *KINDS)


def ownership(spans: DataFrame) -> DataFrame:
    """``hash, n_repositories, n_owners`` of each value, from ``hash, source``."""
    owner = F.substring_index("source", "/", 1)
    by_repository = spans.groupBy("hash", owner.alias("owner"), "source").agg(F.lit(1).alias("one"))
    by_owner = by_repository.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repositories"))
    return by_owner.groupBy("hash").agg(F.sum("repositories").alias("n_repositories"), F.count(F.lit(1)).alias("n_owners"))


def scan(docs: DataFrame, wide: int = WIDE) -> DataFrame:
    """Each row's ``doc_id`` and ``spans``; how many hold a widely copied value, an owned one, and an owned one that looks live (``n_copied``,
    ``n_owned``, ``n_live``); and the most repositories and owners that hold one of its values (0 without spans)."""
    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["source"].cast("string").alias("source"), docs["text"].cast("string").alias("text"))
    rows = written(with_candidates(rows).withColumn("row", F.monotonically_increasing_id()), "candidates")
    each = rows.where(F.size("spans") > 0).select("row", "source", F.explode("spans").alias("s")).select("row", "source", "s.hash", "s.varied")
    counted = ownership(each.select("hash", "source"))
    of_row = each.groupBy("row", "hash").agg(F.count(F.lit(1)).alias("n"), F.max("varied").alias("varied")).join(counted, "hash")
    copied = F.col("n_owners") >= wide
    total = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    of_row = of_row.groupBy("row").agg(
        total(copied).alias("n_copied"), total(~copied).alias("n_owned"), total(~copied & F.col("varied")).alias("n_live"),
        F.max("n_repositories").alias("max_repositories"), F.max("n_owners").alias("max_owners"),
    )
    out = rows.join(of_row, "row", "left")
    none = F.lit(0).cast("bigint")
    return out.select("doc_id", "spans", *[F.coalesce(c, none).alias(c) for c in COUNTS])


def secret_digest(found_spans: DataFrame) -> DataFrame:
    """Counts and digest of the base kinds, all spans as text, and the ownership counts."""
    base = F.filter("spans", lambda s: s["order"] < len(BASE))
    counts = [count_kind(kind).alias(f"n_{kind}") for kind in BASE]
    return found_spans.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), *COUNTS)
