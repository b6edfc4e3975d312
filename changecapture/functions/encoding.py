"""Canonical text of a value, as a Column expression.

Rules: equal values give equal text, different values give different text, and the
text depends neither on the session (time zone, locale) nor on how a value happens to
be stored (entry order of a map, sign of zero). Every value is framed by its length,
so that the borders between values cannot shift and null differs from ''.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_MARK = "~"

_PRINTABLE = (
    T.BooleanType,
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.DecimalType,
    T.DateType,
    T.TimestampNTZType,
)
_TEXT = (T.StringType, T.CharType, T.VarcharType)


def text(column: Column, data_type: T.DataType) -> Column:
    """Canonical text of one value; null stays null."""
    if isinstance(data_type, _TEXT):
        return column.cast("string")
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        # adding zero turns -0.0 into 0.0 and leaves all other values alone
        return (column + F.lit(0.0).cast(data_type)).cast("string")
    if isinstance(data_type, _PRINTABLE):
        return column.cast("string")
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(column).cast("string")
    if isinstance(data_type, T.BinaryType):
        return F.hex(column)
    if isinstance(data_type, T.ArrayType):
        return F.array_join(F.transform(column, lambda x: framed(x, data_type.elementType)), "")
    if isinstance(data_type, T.StructType):
        parts = [framed(column.getField(f.name), f.dataType) for f in data_type.fields]
        return F.when(column.isNotNull(), F.concat(F.lit(""), *parts))
    if isinstance(data_type, T.MapType):
        entries = F.transform(
            F.map_entries(column),
            lambda e: F.concat(
                framed(e.getField("key"), data_type.keyType),
                framed(e.getField("value"), data_type.valueType),
            ),
        )
        return F.array_join(F.array_sort(entries), "")
    raise TypeError(f"no canonical text for type {data_type.simpleString()}")


def framed(column: Column, data_type: T.DataType) -> Column:
    """Text of one value with its length in front; never null."""
    shown = text(column, data_type)
    return F.coalesce(F.concat(F.length(shown).cast("string"), F.lit(":"), shown), F.lit(NULL_MARK))


def framed_literal(value: str) -> str:
    return f"{len(value)}:{value}"


def encode(fields: Iterable[T.StructField]) -> Column:
    """Text of a row: the framed values of the fields, in the given order."""
    parts = [framed(F.col(quoted(f.name)), f.dataType) for f in fields]
    return F.concat(*parts) if parts else F.lit("")


def quoted(name: str) -> str:
    """Column name as an identifier, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"
