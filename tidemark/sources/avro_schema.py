"""Spark ``StructType`` from the text of an Avro record schema (``.avsc``).

Only the schema text is interpreted; records themselves arrive as JSON and
are decoded by ``from_json`` on the executors.
"""

from __future__ import annotations

import json

from pyspark.sql import types as T

_PRIMITIVES = {
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "bytes": T.BinaryType(),
    "null": T.NullType(),
}


def _to_spark(t) -> tuple[T.DataType, bool]:
    """Avro type -> (Spark type, nullable)."""
    if isinstance(t, list):
        branches = [b for b in t if b != "null"]
        nullable = len(branches) != len(t)
        if len(branches) == 1:
            dt, _ = _to_spark(branches[0])
            return dt, nullable
        # multi-branch unions: a struct with one member per branch, as Spark's Avro reader does
        fields = [T.StructField(f"member{i}", _to_spark(b)[0], True) for i, b in enumerate(branches)]
        return T.StructType(fields), nullable
    if isinstance(t, str):
        if t not in _PRIMITIVES:
            raise ValueError(f"unsupported Avro type {t!r}")
        return _PRIMITIVES[t], False
    if isinstance(t, dict):
        logical = t.get("logicalType")
        base = t.get("type")
        if logical == "decimal":
            return T.DecimalType(int(t.get("precision", 38)), int(t.get("scale", 0))), False
        if logical == "date":
            return T.DateType(), False
        if logical in ("timestamp-millis", "timestamp-micros"):
            return T.TimestampType(), False
        if logical in ("local-timestamp-millis", "local-timestamp-micros"):
            return T.TimestampNTZType(), False
        if base == "record":
            return _record(t), False
        if base == "array":
            return T.ArrayType(_to_spark(t["items"])[0], True), False
        if base == "map":
            return T.MapType(T.StringType(), _to_spark(t["values"])[0], True), False
        if base == "enum":
            return T.StringType(), False
        if base == "fixed":
            return T.BinaryType(), False
        return _to_spark(base)
    raise ValueError(f"unsupported Avro type {t!r}")


def _record(rec: dict) -> T.StructType:
    fields = []
    for f in rec.get("fields", []):
        dt, nullable = _to_spark(f["type"])
        fields.append(T.StructField(f["name"], dt, nullable or "default" in f and f["default"] is None))
    return T.StructType(fields)


def schema_from_avsc(text: str) -> T.StructType:
    """Parse ``.avsc`` text into a ``StructType`` (all fields nullable, as JSON input may omit any)."""
    st = _record(json.loads(text))
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in st.fields])
