"""What documents hold against what a declaration expects of them.

Spark merges the types of all documents into one, partial results before the shuffle, so a table of any size gives one row, which lists
each path once. Declared paths are then found in it or not.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docfold.specs import FlattenSpec

SAME, NEW, VANISHED, CHANGED = "same", "new", "vanished", "changed"


def observed_types(raw: DataFrame, doc: str = "raw_data") -> dict[str, str]:
    """Type of each path that any document holds; ``variant`` where documents differ, ``void`` where all hold null.

    Objects are listed by their fields, arrays by their type. The number of paths must fit the driver, as it must fit one row.
    """
    merged = raw.agg(F.schema_of_variant_agg(doc).alias("s")).first().s
    if merged is None or merged.upper() == "VOID":
        return {}
    kind = T.DataType.fromDDL(re.sub(r"\bOBJECT<", "STRUCT<", merged))
    found: dict[str, str] = {}

    def walk(path: str, kind: T.DataType) -> None:
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                walk(f"{path}.{f.name}", f.dataType)
        else:
            found[path] = kind.simpleString()

    walk("$", kind)
    return found


def _fits(declared: str, observed: str) -> bool:
    """Whether values of the observed type are of the declared one without being converted."""
    a, b = (T.DataType.fromDDL(x) for x in (declared, observed))
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    if isinstance(b, T.NullType) or isinstance(a, T.VariantType) or type(a) is type(b):
        return True
    if isinstance(b, whole):
        return isinstance(a, (*whole, T.DecimalType, T.FloatType, T.DoubleType))
    return isinstance(a, (T.FloatType, T.DoubleType, T.DecimalType)) and isinstance(b, (T.DecimalType, T.DoubleType))


def schema_drift(raw: DataFrame, spec: FlattenSpec, doc: str = "raw_data") -> DataFrame:
    """``path, declared, observed, status`` of every path that is declared or held: the same, new, vanished, or of another type."""
    observed = observed_types(raw, doc)
    declared = {f.path: f.type for f in spec.fields}
    rows = []
    for path in sorted({*declared, *observed}):
        a, b = declared.get(path), observed.get(path)
        inner = b is None and any(p.startswith(f"{path}.") for p in observed)  # an object taken as a whole
        b = "object" if inner else b
        status = NEW if a is None else VANISHED if b is None else SAME if inner or _fits(a, b) else CHANGED
        rows.append((path, a, b, status))
    return raw.sparkSession.createDataFrame(rows, "path string, declared string, observed string, status string")
