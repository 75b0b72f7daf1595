"""Deletes later copies of runs of lines that repeat within or across documents.

Lines are ranked by prefix doubling over the line sequences of all documents: a line's first rank is the class of its text; the
rank of 2k lines from a place is the class of the two ranks of k lines there and k lines on. Only classes with two
members or more go on, which are the intervals of the suffix array with a common prefix of that length; ranks only have to
tell intervals apart, so they are numbered, not sorted. A run of any length between is the pair of ranks of two overlapping
powers of two, as in a sparse table.

A run counts from ``min_words`` words. From each line the shortest such run forwards and backwards is looked up; their union
over the repeated ones is exactly the union of all maximal repeated runs of that size. A run's first place, by ``doc_id``,
then text, then line, keeps it; every other place loses its lines. Lines are compared without white space at either end;
blank lines do not count, do not part a run, and stay. A repeated run of lines has at most ``min_words`` lines
when shortest, so six doublings do for 50 words.

Null texts stay null, empty ones empty. Rows equal in ``doc_id`` and ``text`` are one document given twice, and both get the
same result; that alone is no copy. Null ``doc_id`` come first. A line that very many documents hold is summed before it is
shuffled and joined by its class, where Spark splits skewed keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docfold.session import written

MIN_WORDS = 50
_NO_ID = -(1 << 63)


def _keyed(docs: DataFrame) -> DataFrame:
    """All columns in ``doc``, and the two that name a document: ``k1`` its id, ``k2`` the hash of its text."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), F.coalesce(docs["doc_id"].cast("bigint"), F.lit(_NO_ID)).alias("k1"), F.xxhash64(text).alias("k2"), text.alias("text"))


def _lines(keyed: DataFrame, min_words: int, repeated: bool) -> DataFrame:
    """Each line that isn't blank: ``k1, k2, i`` (its number among these), ``at`` (among all), ``h, g`` (its text), and ``ahead,
    back``: how many lines the shortest run of enough words from it or up to it has, null without one."""
    split = F.split("text", "\n")
    each = F.filter(F.transform(split, lambda line, at: F.struct(at.alias("at"), F.btrim(line, F.lit(" \t\r\x0b\x0c")).alias("line"))), lambda x: x["line"] != "")
    rows = keyed.select("k1", "k2", F.posexplode(each).alias("i", "x"))
    rows = rows.select("k1", "k2", "i", F.col("x.at").alias("at"), F.xxhash64("x.line").alias("h"), F.xxhash64(F.lit(1), F.col("x.line")).alias("g"), F.size(F.split("x.line", "\\s+")).cast("bigint").alias("words"))
    if repeated:
        rows = rows.groupBy("k1", "k2", "i").agg(*[F.max(c).alias(c) for c in ("at", "h", "g", "words")])
    doc = Window.partitionBy("k1", "k2")
    rows = rows.withColumn("end", F.sum("words").over(doc.orderBy("i"))).withColumn("begin", F.col("end") - F.col("words"))
    total = F.max("end").over(doc)
    ahead = F.count(F.lit(1)).over(doc.orderBy("begin").rangeBetween(0, min_words - 1))
    back = F.count(F.lit(1)).over(doc.orderBy("end").rangeBetween(1 - min_words, 0))
    rows = rows.select("*", F.when(F.col("begin") + min_words <= total, ahead).alias("ahead"), F.when(F.col("end") >= min_words, back).alias("back"))
    return rows.drop("begin", "end", "words")


def _ranked(places: DataFrame, *key: str) -> DataFrame:
    """``k1, k2, i, rank`` of the places whose ``key`` occurs at two places or more; equal keys have equal ranks."""
    classes = places.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*key, F.monotonically_increasing_id().alias("rank"))
    return written(places.join(written(classes, "classes"), list(key)).select("k1", "k2", "i", "rank"), "ranks")


def _at(ranks: DataFrame, step: Column, name: str) -> DataFrame:
    """``ranks`` as seen from ``step`` lines before."""
    return ranks.select("k1", "k2", (F.col("i") - step).cast("int").alias("i"), F.col("rank").alias(name))


def later_copies(keyed: DataFrame, min_words: int, repeated: bool) -> DataFrame:
    """``k1, k2, at``: the lines of each document that belong to later copies of repeated runs."""
    lines = written(_lines(keyed, min_words, repeated), "lines")
    ranks = _ranked(lines.select("k1", "k2", "i", "h", "g"), "h", "g")
    runs = lines.where("ahead is not null").select("k1", "k2", "i", F.col("ahead").alias("size"))
    runs = runs.unionAll(lines.where("back is not null").select("k1", "k2", (F.col("i") - F.col("back") + 1).cast("int").alias("i"), F.col("back").alias("size"))).distinct()
    length, found = 1, None
    while True:
        of_length = runs.where(F.col("size").between(length, 2 * length - 1))
        both = of_length.join(_at(ranks, F.lit(0), "a"), ["k1", "k2", "i"])
        both = both.withColumn("last", (F.col("i") + F.col("size") - length).cast("int")).join(ranks.select("k1", "k2", F.col("i").alias("last"), F.col("rank").alias("b")), ["k1", "k2", "last"])
        here = both.select("k1", "k2", "i", "size", "a", "b")
        found = here if found is None else found.unionAll(here)
        if 2 * length > min_words:
            break
        pairs = _at(ranks, F.lit(0), "a").join(_at(ranks, F.lit(length), "b"), ["k1", "k2", "i"])
        ranks, length = _ranked(pairs, "a", "b"), 2 * length
    found = written(found, "runs")
    # ranks of another length are numbered anew; the size tells the length
    first = found.groupBy("size", "a", "b").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("k1", "k2", "i")).alias("first")).where("n > 1").drop("n")
    copies = found.join(written(first, "firsts"), ["size", "a", "b"]).where(F.struct("k1", "k2", "i") > F.col("first"))
    hit = copies.select("k1", "k2", F.explode(F.sequence(F.col("i"), (F.col("i") + F.col("size") - 1).cast("int"))).alias("i")).distinct()
    return hit.join(lines.select("k1", "k2", "i", "at"), ["k1", "k2", "i"]).select("k1", "k2", "at")


def delete_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc`` (all columns of a row), ``text`` without later copies (null if it was null), ``n_lines`` and ``n_deleted``.

    ``n_lines`` counts all lines of the text, blank ones too.
    """
    keyed = _keyed(docs)
    repeated = bool(docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").take(1)) or docs.where("doc_id is null").limit(2).count() > 1
    gone = later_copies(keyed, min_words, repeated).groupBy("k1", "k2").agg(F.collect_list("at").alias("gone"))
    out = keyed.join(gone, ["k1", "k2"], "left").select("doc", "gone", F.split("text", "\n").alias("lines"))
    numbers = F.sequence(F.lit(0), F.size("lines") - 1)
    kept = F.transform(F.array_except(numbers, F.coalesce("gone", F.array().cast("array<int>"))), lambda at: F.get(F.col("lines"), at))
    text = F.when(F.col("gone").isNull(), F.col("doc.text").cast("string")).otherwise(F.array_join(kept, "\n"))
    return out.select("doc", text.alias("text"), F.size("lines").cast("bigint").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_deleted"))
