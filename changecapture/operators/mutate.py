"""Synthetic next snapshot: same keys, other values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changecapture.config import name_list
from changecapture.functions.encoding import encode, framed_literal, quoted
from changecapture.functions.wrap import unwrap

TEXT_LENGTH = 20

_WHOLE = {T.ByteType: 7, T.ShortType: 15, T.IntegerType: 31, T.LongType: 31}


def mutate(df: DataFrame, keys, exclusions=(), seed: str = "") -> DataFrame:
    """Replace every column that is neither key nor excluded.

    Text becomes 20 characters of a digest of seed, column name and key; numbers become
    a number of the same type drawn from that digest. Columns of other types pass
    unchanged. The result depends on the row only, so it can be computed again.
    """
    df = unwrap(df)
    keys, kept = name_list(keys), set(name_list(exclusions))
    ids = [f for f in df.schema.fields if f.name.lower() in keys]
    key = encode(ids)

    def changed(field: T.StructField) -> Column:
        column = F.col(quoted(field.name))
        if field.name.lower() in kept or field in ids:
            return column
        mark = framed_literal(seed) + framed_literal(field.name.lower())
        drawn = F.md5(F.concat(F.lit(mark), key))
        number = F.conv(F.substring(drawn, 1, 8), 16, 10).cast("bigint")
        kind = type(field.dataType)
        if kind is T.StringType:
            column = F.substring(drawn, 1, TEXT_LENGTH)
        elif kind in _WHOLE:
            column = (number % F.lit(2 ** _WHOLE[kind])).cast(field.dataType)
        elif kind in (T.FloatType, T.DoubleType):
            column = ((number % F.lit(1000000)) / F.lit(100)).cast(field.dataType)
        elif kind is T.DecimalType:
            digits = min(field.dataType.precision - field.dataType.scale, 9)
            column = (number % F.lit(10**digits)).cast(field.dataType)
        return column.alias(field.name)

    return df.select(*[changed(f) for f in df.schema.fields])
