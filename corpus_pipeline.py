"""A corpus from raw documents to packed sequences: five stages, each on what the one before has kept.

Each stage takes ``(spark, docs, sf_dir)`` and gives a DataFrame, which is written as Parquet and read again as the next one's
documents. All but the last give the columns of ``documents``; ``n_chars`` follows a text that has changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docfold.llm import decontaminate, line_dedup, near_duplicates, packing, toxicity
from docfold.llm.common import table
from docfold.session import written


def _with_text(docs: DataFrame, columns: list[str], old: str, new: str) -> DataFrame:
    """``columns`` of the struct ``doc`` with the text ``new``; a text that has lost all its words is left out."""
    changed = ~F.col(old).eqNullSafe(F.col(new))
    fields = {"text": F.col(new), "n_chars": F.when(changed, F.length(new)).otherwise(F.col("doc.n_chars") if "n_chars" in columns else None).cast("bigint")}
    emptied = changed & ~F.col(new).rlike("[^\\x20\\x09-\\x0D]")
    return docs.where(~F.coalesce(emptied, F.lit(False))).select(*[fields[c].alias(c) if c in fields else F.col("doc")[c].alias(c) for c in columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half, by a classifier of the labelled rows outside the held-out fold.

    Null and empty texts are scored by the bias alone and stay where toxic rows are the fewer. Repeated rows, ties and null ids are scored each by
    their text. Without positive labels, or without documents, nothing is dropped.
    """
    labels = table(spark, sf_dir, "labels")
    classifier = toxicity.train(docs, labels.where(toxicity.fold(labels, 5) != 0))
    name, taken = "toxicity", {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return toxicity.score(docs, classifier, name).where(F.col(name) < 0.5).drop(name)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of line runs; a document that was nothing else goes.

    The first place by ``doc_id`` keeps a run; of one id, that with the lesser hash of its text. Null ids come first. Null and empty texts
    stay as they are, rows equal in id and text get the same result, and an empty table stays empty.
    """
    return _with_text(line_dedup.delete_repeated_lines(docs), docs.columns, "doc.text", "text")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the least by ``doc_id``, then by hash of the text.

    Null texts, texts without words and rows without ``doc_id`` are no duplicates and stay. Of rows equal in id and text one
    stays. An empty table stays empty.
    """
    return near_duplicates.one_of_each_group(docs)


def cut_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of benchmark items; a document that was nothing else goes.

    Null and empty texts stay as they are; repeated rows, ties and null ids are cut each by their text. An empty benchmark cuts
    nothing, and an empty table stays empty.
    """
    twice = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), F.col("text"))
    cut = decontaminate.remove_overlaps(twice, table(spark, sf_dir, "benchmark"))
    return _with_text(cut, docs.columns, "doc.text", "text")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences along the curve, with checksums of their ids.

    A null or empty text is its end id alone; repeated rows and null ids are packed each. Equal keys go by ``doc_id``, then
    by ids. An empty table gives no piece. Columns beyond ``doc_id`` and ``text`` are left out.
    """
    return packing.with_checksums(packing.pack(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", cut_benchmark_passages),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs


#: The stages that learn, tokenise or search trees have no SQL; tests hold them against brute force.
ORACLE_SQL = None
