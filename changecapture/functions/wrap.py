"""Snapshots whose columns arrive wrapped as ``struct<value: T, ...>``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changecapture.functions.encoding import quoted


def unwrap(df: DataFrame) -> DataFrame:
    """Replace every struct column that has a ``value`` field by that field.

    Other columns, structs without such a field included, pass unchanged. The choice is
    made from the schema, so it costs nothing per row and the scan reads only the field.
    """
    out = []
    for field in df.schema.fields:
        column = F.col(quoted(field.name))
        if isinstance(field.dataType, T.StructType):
            inner = [n for n in field.dataType.fieldNames() if n.lower() == "value"]
            if inner:
                column = column.getField(inner[0])
        out.append(column.alias(field.name))
    return df.select(*out)
