"""Places of regular-expression matches in texts, with built-in functions only.

Spark returns what a pattern matches, not where. So marks are set around the matches, the text is split at the marks, and
every second part is a match; its place is the length of all parts before it, in code points. Characters used as marks are
first exchanged for one that no pattern here knows, so the places stay right.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Around a match; inside it, before the group that counts as its value; for a separator within a match.
MARK, INNER, JOINT = "\x01", "\x02", "\x04"
_OTHER = "\x06"


def clean(text: Column) -> Column:
    """``text`` without the marks; null as empty."""
    text = F.coalesce(text, F.lit(""))
    return F.when(text.rlike("[\x01\x02\x04]"), F.translate(text, MARK + INNER + JOINT, _OTHER * 3)).otherwise(text)


def with_found(
    df: DataFrame,
    name: str,
    text: Column,
    pattern: str,
    replacement: str = f"{MARK}$0{MARK}",
    needs: Column | None = None,
    valid: Callable[[Column], Column] = lambda match: F.lit(True),
    value: Callable[[Column], Column] = lambda match: match,
) -> DataFrame:
    """``df`` with the column ``name``: valid matches of ``pattern`` in a cleaned ``text``.

    It is an array of ``start, end, value, before, after`` in order. ``valid`` and ``value`` get a match as ``replacement`` writes it
    between the marks. ``before`` and ``after`` are up to 40 characters around it, as far as the matches next to it. A text
    for which ``needs`` is false cannot match and is not searched. One step uses the column of the one before more than once, so
    each stays a projection of its own and is worked out once.
    """
    parts = F.split(F.regexp_replace(text, pattern, replacement), MARK)
    df = df.withColumn(name, parts if needs is None else F.when(needs, parts).otherwise(F.array(F.lit(""))))

    def part(p: Column, i: Column) -> Column:
        return F.struct(
            p.alias("part"),
            F.length(F.translate(p, INNER, "")).alias("size"),
            ((i % 2 == 1) & F.coalesce(valid(p), F.lit(False))).alias("hit"),
            F.when(i % 2 == 1, F.right(F.get(F.col(name), i - 1), F.lit(40))).alias("before"),
            F.when(i % 2 == 1, F.left(F.get(F.col(name), i + 1), F.lit(40))).alias("after"),
        )

    def step(acc: Column, p: Column) -> Column:
        starts = F.when(p["hit"], F.concat(acc["starts"], F.lit(","), acc["at"])).otherwise(acc["starts"])
        return F.struct((acc["at"] + p["size"]).alias("at"), starts.alias("starts"))

    def span(p: Column, s: Column) -> Column:
        start = s.cast("int")
        return F.struct(start.alias("start"), (start + p["size"]).alias("end"), value(p["part"]).alias("value"), p["before"].alias("before"), p["after"].alias("after"))

    df = df.withColumn(name, F.transform(name, part))
    at = F.aggregate(name, F.struct(F.lit(0).alias("at"), F.lit("").alias("starts")), step)["starts"]
    df = df.withColumn(name, F.struct(F.filter(name, lambda p: p["hit"]).alias("hits"), F.split(at, ",").alias("starts")))
    starts = F.slice(F.col(name)["starts"], F.lit(2), F.size(F.col(name)["starts"]))  # the first element is empty
    return df.withColumn(name, F.zip_with(F.col(name)["hits"], starts, span))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each element of an array of ``kind, start, end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_kind(kind: str) -> Column:
    """How many elements of the column ``spans`` have this kind."""
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
