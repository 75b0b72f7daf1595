"""One large enveloped file read by many tasks.

``{"ingested_at": ..., "data": [{...}, {...}]}`` is one JSON value, so a reader of whole values gives one file to one task. Here the
text is cut at every ``}`` by Spark's splittable text reader. A first scan says how each split changes the nesting: how many quotes it
holds, and by how much it deepens the nesting if it starts outside a string and if it starts inside one. These changes compose, so
they are summed along the few splits of a file; a second scan starts each split from its sum and so knows the state at every piece. Both scans
go along a split in the task that reads it, so text is neither sorted nor shuffled. Pieces between two
closings down to depth two or less form a segment, and a segment that starts with a comma and an object is one element of an array.

Only the other segments are looked at in detail, and there are few: the one in which ``data`` opens, the one in which it closes, and
those around further nested fields or plain values. What stands outside ``data`` is put together as the envelope's own fields.

Text in strings, escapes, braces in strings and white space are as in any JSON. A file that is cut off, or whose brackets do not
fit, fails; so does one with two ``data`` arrays. The name of the array must be written without escapes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docfold.functions.documents import field
from docfold.session import written

_FILE, _SPLIT = "file_path", "split"


#: The characters that change the nesting or the quoting, by number; 0 is any other.
_QUOTE, _OPENS, _SHUTS = 1, 2, 3
_KINDS = np.zeros(256, np.uint8)
_KINDS[list(b'"')], _KINDS[list(b"{[")], _KINDS[list(b"}]")] = _QUOTE, _OPENS, _SHUTS


def _escapes_masked(text: Column) -> Column:
    """``text`` with two plain characters for each escape, so that every quote left begins or ends a string."""
    return F.regexp_replace(text, r"(?s)\\.", "__")


def _pieces(spark: SparkSession, path: str, pattern: str | None, larger_than: int = -1) -> DataFrame:
    """Text up to each ``}``, in the order of each split."""
    reader = spark.read.option("lineSep", "}")
    reader = reader.option("pathGlobFilter", pattern) if pattern else reader
    rows = reader.text(path)
    rows = rows if larger_than < 0 else rows.where(F.col("_metadata.file_size") > larger_than)
    return rows.select(
        F.col("_metadata.file_path").alias(_FILE),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_modification_time").alias("modified_at"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_block_start").alias(_SPLIT),
        F.concat("value", F.lit("}")).alias("text"),
    )


def _changes(data: np.ndarray, inside: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where whole pieces of text change the nesting or the quoting, whether a string is open behind each such place, and by how much the text
    outside strings has deepened the nesting by then. ``inside`` is 1 if the text starts in a string."""
    slashes = np.flatnonzero(data == ord("\\"))
    if len(slashes):  # what follows an odd number of them is escaped; a piece ends with }, so they end before it does
        breaks = np.diff(slashes) != 1
        begin, end = slashes[np.r_[True, breaks]], slashes[np.r_[breaks, True]]
        data = data.copy()
        data[end[(end - begin) % 2 == 0] + 1] = ord("_")
    kinds = _KINDS[data]
    at = np.flatnonzero(kinds)
    kinds = kinds[at]
    quotes = kinds == _QUOTE
    open_string = (np.cumsum(quotes) + inside) % 2
    step = (kinds == _OPENS).astype(np.int64) - (kinds == _SHUTS)
    return at, open_string, np.cumsum(np.where(open_string == 1, 0, step))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of a batch that belong to one split each, with their text as bytes and the ends of the pieces in it."""
    number = batch.column("number").to_numpy()
    cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(number)]
    for start, stop in zip(cuts, cuts[1:]):
        if start == stop:
            continue
        text = batch.column("text").slice(start, stop - start)
        wide = pa.types.is_large_string(text.type)
        _, offsets, data = text.buffers()
        ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
        yield batch.slice(start, stop - start), np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends[1:] - ends[0]


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each split changes: ``quotes`` modulo 2, ``depth0`` deeper if it starts outside a string, ``depth1`` if inside."""
    sums: dict[int, list[int]] = {}
    for batch in batches:
        for part, data, _ in _runs(batch):
            found = sums.setdefault(part.column("number")[0].as_py(), [0, 0, 0])
            quotes = found[0]
            for start in (0, 1):
                _, open_string, depth = _changes(data, (quotes + start) % 2)
                found[1 + start] += int(depth[-1])
                if start == 0:
                    found[0] = int(open_string[-1])
    yield pa.RecordBatch.from_pydict({"number": [*sums], **{c: [x[i] for x in sums.values()] for i, c in enumerate(("quotes", "depth0", "depth1"))}}, _TOTALS)


def _between_closings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Text of each split cut behind the pieces that close down to depth two or less. What is open at the end of a batch goes on in the next."""
    number = None
    for batch in batches:
        for part, data, ends in _runs(batch):
            if part.column("number")[0].as_py() != number:
                if number is not None:
                    yield _rest(number, n, held, from_depth)
                number, n, held = part.column("number")[0].as_py(), 0, []
                inside, depth = part.column("starts")[0].as_py(), part.column("base")[0].as_py()
                from_depth = depth
            at, open_string, deeper = _changes(data, inside)
            last = np.searchsorted(at, ends) - 1  # a piece that ends with an escaped } may have no change of its own
            strings = np.where(last < 0, inside, open_string[last])
            depths = depth + np.where(last < 0, 0, deeper[last])
            inside, depth = int(strings[-1]), int(depths[-1])
            closing = np.flatnonzero((strings == 0) & (depths <= 2))
            cuts = ends[closing]
            begun = 0
            if len(cuts) and held:  # the first goes together with what was open
                begun = int(cuts[0])
                held.append(data[:begun].tobytes())
                text = pa.array([b"".join(held)], pa.binary()).cast(pa.string())
                yield _found(number, n, text, [from_depth], [True], [n == 0])
                n, held, from_depth, cuts, closing = n + 1, [], int(depths[closing[0]]), cuts[1:], closing[1:]
            if len(cuts):
                offsets = np.r_[begun, cuts].astype(np.int32)
                text = pa.StringArray.from_buffers(len(cuts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))
                edge = np.zeros(len(cuts), bool)
                edge[0] = n == 0
                yield _found(number, n, text, np.r_[from_depth, depths[closing[:-1]]], np.ones(len(cuts), bool), edge)
                n, from_depth, begun = n + len(cuts), int(depths[closing[-1]]), int(cuts[-1])
            if begun < len(data):
                held.append(data[begun:].tobytes())
    if number is not None:
        yield _rest(number, n, held, from_depth)


def _found(number: int, n: int, text: pa.Array, from_depth, closes, edge) -> pa.RecordBatch:
    size = len(text)
    columns = [np.full(size, number, np.int64), np.arange(n, n + size, dtype=np.int64), text, np.asarray(from_depth, np.int64), closes, edge]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) if not isinstance(c, pa.Array) else c for c, f in zip(columns, _FRAGMENTS)], schema=_FRAGMENTS)


def _rest(number: int, n: int, held: list[bytes], from_depth: int) -> pa.RecordBatch:
    """What is open at the end of a split, if anything."""
    text = pa.array([b"".join(held)] if held else [], pa.binary()).cast(pa.string())
    return _found(number, n, text, [from_depth][: len(text)], [False][: len(text)], [True][: len(text)])


_TOTALS = pa.schema([("number", pa.int64()), ("quotes", pa.int64()), ("depth0", pa.int64()), ("depth1", pa.int64())])
_FRAGMENTS = pa.schema([("number", pa.int64()), ("n", pa.int64()), ("text", pa.string()), ("from_depth", pa.int64()), ("closes", pa.bool_()), ("edge", pa.bool_())])


def _fragments(pieces: DataFrame) -> DataFrame:
    """Texts between closings within a split: ``file_path, split, n`` (place), ``text``, ``from_depth``, ``closes``, and ``edge``: whether
    it may go on in another split."""
    about = [_FILE, "file_name", "modified_at", "file_size", _SPLIT]
    # one row for each split, which is as long as the list of them that the driver holds
    splits = pieces.select(*about).distinct().withColumn("number", F.row_number().over(Window.orderBy(_FILE, _SPLIT)).cast("bigint"))
    splits = written(splits, "splits")
    numbers = F.broadcast(splits.select(_FILE, _SPLIT, "number"))
    totals = pieces.join(numbers, [_FILE, _SPLIT]).select("number", "text").mapInArrow(_totals, "number bigint, quotes bigint, depth0 bigint, depth1 bigint")
    totals = splits.join(totals, "number")
    earlier = Window.partitionBy(_FILE).orderBy(_SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("starts", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
    gained = F.when(F.col("starts") == 1, F.col("depth1")).otherwise(F.col("depth0"))
    totals = totals.select(_FILE, _SPLIT, "number", "starts", F.coalesce(F.sum(gained).over(earlier), F.lit(0)).alias("base"))

    rows = pieces.join(F.broadcast(totals), [_FILE, _SPLIT]).select("number", "starts", "base", "text")
    rows = rows.mapInArrow(_between_closings, "number bigint, n bigint, text string, from_depth bigint, closes boolean, edge boolean")
    return rows.join(F.broadcast(splits), "number").select(*about, "n", "text", F.octet_length("text").alias("bytes"), "from_depth", "closes", "edge")


def _together(rows: DataFrame, *key: str) -> DataFrame:
    """Texts of a key in order, with the place and depth of the first and whether the last closes."""
    about = [_FILE, "file_name", "modified_at", "file_size"]
    ordered = F.sort_array(F.collect_list(F.struct(F.col(_SPLIT).alias("at"), "n", "text", "from_depth", "closes")))
    out = rows.groupBy(*about, *key).agg(ordered.alias("x"))
    first, last, text = F.element_at("x", 1), F.element_at("x", -1), F.array_join("x.text", "")
    kept = [F.col(c) for c in key if c != _SPLIT]
    return out.select(*about, *kept, first["at"].alias(_SPLIT), first["n"].alias("n"), text.alias("text"), F.octet_length(text).alias("bytes"), first["from_depth"].alias("from_depth"), last["closes"].alias("closes"))


def segments(spark: SparkSession, path: str, pattern: str | None = None, larger_than: int = -1) -> DataFrame:
    """Segments of enveloped files: place (``file_path, split, n``), ``text``, and the depth before it.

    The text is written once where it is read; only fragments at the ends of splits are shuffled.
    """
    fragments = written(_fragments(_pieces(spark, path, pattern, larger_than)), "fragments")
    edges = fragments.where("edge")  # two for each split at most
    order = Window.partitionBy(_FILE).orderBy(_SPLIT, "n").rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.withColumn("number", F.coalesce(F.sum(F.col("closes").cast("int")).over(order), F.lit(0)))
    columns = [_FILE, "file_name", "modified_at", "file_size", _SPLIT, "n", "text", "bytes", "from_depth"]
    return fragments.where("not edge").select(*columns).unionByName(_together(edges, "number").select(*columns))


#: One plain element of whatever array is open.
_PLAIN = r"from_depth = 2 AND text RLIKE r'^[ \t\r\n]*,[ \t\r\n]*\{'"


def _marks(rows: DataFrame, array: str) -> DataFrame:
    """``rows`` with the depth behind them (``to_depth``), how often the array opens, and the places in ``text``, or -1, at which the array opens (``enter``), closes again (``leave``), and at which whatever was
    open at depth two before closes (``close``)."""
    kept = F.transform(F.split(_escapes_masked(F.col("text")), '"'), lambda x, i: F.when((i % 2 == 1) & (x != array), F.repeat(F.lit("_"), F.length(x))).otherwise(x))
    token = F.regexp_extract_all(F.array_join(kept, '"'), F.lit(rf'("{array}"\s*:\s*\[|[\[\]{{}}]|[^\[\]{{}}"]+|")'), F.lit(1))
    none = F.lit(-1)
    start = F.struct(F.lit(0).alias("pos"), F.col("from_depth").cast("int").alias("depth"), F.lit(0).alias("opened"), none.alias("enter"), none.alias("leave"), none.alias("close"))

    def step(s: Column, t: Column) -> Column:
        opens = t.endswith("[") | t.endswith("{")
        shuts = t.isin("]", "}")
        enters = (s["depth"] == 1) & t.startswith(f'"{array}"')
        up = shuts & (s["depth"] == 2)
        own = up & (s["enter"] >= 0) & (s["leave"] < 0)
        return F.struct(
            (s["pos"] + F.length(t)).alias("pos"),
            (s["depth"] + opens.cast("int") - shuts.cast("int")).alias("depth"),
            (s["opened"] + enters.cast("int")).alias("opened"),
            F.when(enters, s["pos"] + F.length(t)).otherwise(s["enter"]).alias("enter"),
            F.when(own, s["pos"]).otherwise(s["leave"]).alias("leave"),
            F.when(up & (s["enter"] < 0) & (s["close"] < 0), s["pos"]).otherwise(s["close"]).alias("close"),
        )

    return rows.withColumn("m", F.aggregate(token, start, step)).select("*", F.col("m.depth").alias("to_depth"), "m.opened", "m.enter", "m.leave", F.when(F.col("from_depth") == 2, F.col("m.close")).otherwise(-1).alias("close")).drop("m")


def _frames(odd: DataFrame) -> DataFrame:
    """Per file, the places of the segments in which the array opens and closes; one row for each, and the driver lists them anyway."""
    opened = odd.groupBy(_FILE).agg(F.sum("opened").alias("arrays"), F.min(F.when(F.col("enter") >= 0, F.struct(_SPLIT, "n", "leave"))).alias("open"))
    opened = opened.select(_FILE, "arrays", F.when(F.col("open").isNotNull(), F.struct(f"open.{_SPLIT}", "open.n")).alias("opens"), F.col("open.leave").alias("leaves"))
    later = odd.where("close >= 0").join(F.broadcast(opened), _FILE).where((F.col("leaves") < 0) & (F.col("place") > F.col("opens")))
    closing = later.groupBy(_FILE).agg(F.min("place").alias("closing"))
    here = F.when(F.col("leaves") >= 0, F.col("opens")).otherwise(F.col("closing"))
    return opened.join(closing, _FILE, "left").select(_FILE, "arrays", "opens", here.alias("closing"))


def _records(every: DataFrame, odd: DataFrame, frames: DataFrame, array: str) -> DataFrame:
    """``file_path, file_name, value`` of the elements of each file's array."""
    place, opens = F.col("place"), F.col("opens")
    why = F.concat("file_name", F.when(F.col("arrays") == 0, F.lit(f" holds no {array}")).otherwise(F.lit(f" holds {array} more than once")))
    named = odd.select(_FILE, "file_name").distinct()
    faulty = frames.where("arrays != 1").join(F.broadcast(named), _FILE).where(F.raise_error(why).cast("boolean"))
    faulty = faulty.select(_FILE, "file_name", F.lit(None).cast("variant").alias("value"))
    plain = every.where(_PLAIN).withColumn("place", F.struct(_SPLIT, "n")).join(F.broadcast(frames), _FILE)
    plain = plain.where((place > opens) & (place < F.col("closing"))).select(_FILE, "file_name", F.substring("text", F.locate("{", "text"), F.length("text")).alias("text"))
    plain = plain.select(_FILE, "file_name", F.explode(F.array(F.parse_json("text"))).alias("value"))
    odd = odd.join(F.broadcast(frames), _FILE).where((place >= opens) & (place <= F.col("closing")))
    begin = F.when(place == F.col("opens"), F.col("enter")).otherwise(0)
    end = F.when(place != F.col("closing"), F.length("text")).when(place == F.col("opens"), F.col("leave")).otherwise(F.col("close"))
    odd = odd.select(_FILE, "file_name", (place == F.col("opens")).alias("first"), F.substring("text", begin + 1, end - begin).alias("text"))
    # a segment but the first one starts with its comma, so an element is put before it, and dropped again
    body = F.concat(F.when(F.col("first"), "[").otherwise("[0"), F.col("text"), F.lit("]"))
    held = F.variant_get(F.parse_json(body), "$", "array<variant>")
    held = F.when(F.col("first"), held).otherwise(F.slice(held, F.lit(2), F.greatest(F.size(held) - 1, F.lit(0))))
    return plain.unionByName(odd.select(_FILE, "file_name", F.explode(held).alias("value"))).unionByName(faulty)


def _headers(every: DataFrame, odd: DataFrame, frames: DataFrame, array: str) -> DataFrame:
    """The envelopes' own fields, out of the text outside the array."""
    place = F.col("place")
    rows = odd.join(F.broadcast(frames), _FILE)
    text = F.col("text")
    opened = F.concat(F.substring(text, F.lit(1), F.col("enter")), F.when(F.col("leave") >= 0, F.substring(text, F.col("leave") + 1, F.length(text))).otherwise(""))
    outside = (
        F.when(F.col("opens").isNull() | (place < F.col("opens")), text)
        .when(place == F.col("opens"), opened)
        .when(place < F.col("closing"), "")
        .when((place == F.col("closing")) & (F.col("close") >= 0), F.substring(text, F.col("close") + 1, F.length(text)))
        .otherwise(text)
    )
    about = [_FILE, "file_name", "modified_at", "file_size"]
    rows = rows.groupBy(*about).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", outside.alias("text")))), lambda x: x["text"]), "").alias("text"), F.max_by("to_depth", "place").alias("to_depth"))
    size = every.groupBy(_FILE).agg(F.sum("bytes").alias("bytes"))
    rows = rows.join(F.broadcast(size), _FILE)
    # behind the last piece the separator may not have been there
    text = F.when(F.col("bytes") > F.col("file_size"), F.expr("left(text, length(text) - 1)")).otherwise(F.col("text"))
    depth = F.col("to_depth") + F.col("bytes") - F.col("file_size")
    doc = F.parse_json(F.when(depth != 0, F.raise_error(F.concat("file_name", F.lit(": brackets do not fit")))).otherwise(text))
    # the filter keeps every row; it has the text looked at even if no field is asked for
    return rows.select(_FILE, "file_name", "modified_at", doc.alias("doc")).where("doc IS NOT NULL").select(
        _FILE, "file_name", "modified_at", field("doc", "$.ingested_at").alias("ingested_at"), field("doc", "$.source").alias("source"), F.try_variant_get("doc", "$.total_records", "bigint").alias("total_records")
    )


def read_split_envelopes(spark: SparkSession, path: str, pattern: str | None = None, array: str = "data") -> tuple[DataFrame, DataFrame]:
    """Envelopes and their records: ``(file_name, modified_at, ingested_at, source, total_records)`` and ``(file_name, value)``.

    A file is read by as many tasks as it has splits. Files without the array, or with two, fail when their records are read. A file
    of no bytes is no envelope and is passed over.
    """
    heads, records = split_parts(spark, path, pattern, array)
    return heads.drop(_FILE), records.drop(_FILE)


def split_parts(spark: SparkSession, path: str, pattern: str | None = None, array: str = "data", larger_than: int = -1) -> tuple[DataFrame, DataFrame]:
    """:func:`read_split_envelopes` of the files of more than ``larger_than`` bytes, with the ``file_path`` of both."""
    every = segments(spark, path, pattern, larger_than)
    odd = written(_marks(every.where(f"NOT ({_PLAIN})"), array).withColumn("place", F.struct(_SPLIT, "n")), "segments")
    frames = _frames(odd)
    return _headers(every, odd, frames, array), _records(every, odd, frames, array)
