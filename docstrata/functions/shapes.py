"""Shapes of VARIANT values as Spark types, and the least type that holds two given ones."""

from __future__ import annotations

import re

from pyspark.sql import types as T

_TOKEN = re.compile(r"`((?:[^`]|``)*)`|(DECIMAL\(\d+,\s*\d+\)|[^\s:<>,`]+)|([:<>,])")
_PLAIN = {"BIGINT": T.LongType(), "DOUBLE": T.DoubleType(), "FLOAT": T.DoubleType(), "BOOLEAN": T.BooleanType(), "VOID": T.NullType()}


def shape_type(text: str) -> T.DataType:
    """The type that a shape's text names, as inference from JSON would: fractions are doubles, values of mixed types text.

    Whole numbers beyond 64 bits are decimals; what is always null stays without a type until ``settled``.
    """
    tokens = [(m[1].replace("``", "`") if m[1] is not None else m[2] or m[3], m[1] is None) for m in _TOKEN.finditer(text)]
    place = 0

    def read() -> T.DataType:
        nonlocal place
        word = tokens[place][0]
        place += 1
        if word in ("OBJECT", "ARRAY"):
            place += 1  # the opening bracket
            if word == "ARRAY":
                found: T.DataType = T.ArrayType(read())
            else:
                fields = []
                while tokens[place] != (">", True):
                    name = tokens[place][0]
                    place += 2  # name and colon
                    fields.append(T.StructField(name, read()))
                    if tokens[place] == (",", True):
                        place += 1
                found = T.StructType(fields)
            place += 1  # the closing bracket
            return found
        if word.startswith("DECIMAL"):
            digits, scale = map(int, re.findall(r"\d+", word))
            return T.DoubleType() if scale else T.LongType() if digits <= 18 else T.DecimalType(38, 0)
        return _PLAIN.get(word, T.StringType())

    return read()


def merged_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds all values of both: fields of records together, numbers as the wider one, else text.

    Fields keep the order of ``a``; those of ``b`` alone follow.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        other = {f.name: f.dataType for f in b.fields}
        own = [T.StructField(f.name, merged_type(f.dataType, other.pop(f.name)) if f.name in other else f.dataType) for f in a.fields]
        return T.StructType([*own, *(T.StructField(f.name, f.dataType) for f in b.fields if f.name in other)])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merged_type(a.elementType, b.elementType))
    maps, records = ([t for t in (a, b) if isinstance(t, kind)] for kind in (T.MapType, T.StructType))
    if maps and len(maps) + len(records) == 2:
        values = [t.valueType for t in maps] + [f.dataType for r in records for f in r.fields]
        least: T.DataType = T.NullType()
        for value in values:
            least = merged_type(least, value)
        return T.MapType(maps[0].keyType, least)
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    if isinstance(a, whole) and isinstance(b, whole):
        return max(a, b, key=lambda t: whole.index(type(t)))
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        decimals = [t for t in (a, b) if isinstance(t, T.DecimalType)]
        if decimals and not any(isinstance(t, (T.FloatType, T.DoubleType)) for t in (a, b)):
            scale = max(d.scale for d in decimals)
            digits = max([d.precision - d.scale for d in decimals] + [19 for t in (a, b) if isinstance(t, whole)])
            return T.DecimalType(min(38, digits + scale), scale)
        return T.DoubleType()
    return T.StringType()


def settled(found: T.DataType) -> T.DataType:
    """With text for what never had a value."""
    if isinstance(found, T.StructType):
        return T.StructType([T.StructField(f.name, settled(f.dataType)) for f in found.fields])
    if isinstance(found, T.ArrayType):
        return T.ArrayType(settled(found.elementType))
    if isinstance(found, T.MapType):
        return T.MapType(found.keyType, settled(found.valueType))
    return T.StringType() if isinstance(found, T.NullType) else found
