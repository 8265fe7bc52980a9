"""Rows as JSON records."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candor.functions.scalars import finite


def json_safe(df: DataFrame) -> DataFrame:
    """Dates and timestamps as ``YYYY-MM-DD`` text; NaN and infinities as null; structs alike."""

    def safe(c: Column, t: T.DataType) -> Column:
        if isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return F.date_format(c, "yyyy-MM-dd")
        if isinstance(t, (T.DoubleType, T.FloatType)):
            return finite(c)
        if isinstance(t, T.StructType):
            return F.when(c.isNotNull(), F.struct(*[safe(c[f.name], f.dataType).alias(f.name) for f in t.fields]))
        return c

    return df.select(*[safe(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields])


# All digits of a double without an exponent, and one after the point at least.
_PLAIN = "0.0" + "#" * 339


def _json_value(c: Column, t: T.DataType) -> Column:
    """JSON text of one value. Numbers are in plain notation, also where a double's own text has an exponent."""
    if isinstance(t, T.StructType):
        fields = [F.concat(F.lit(json.dumps(f.name) + ":"), _json_value(c[f.name], f.dataType)) for f in t.fields]
        return F.when(c.isNotNull(), F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))).otherwise("null")
    if isinstance(t, T.DoubleType):
        text = c.cast("string")
        return F.coalesce(F.when(text.contains("E"), F.call_function("format_number", c, F.lit(_PLAIN))).otherwise(text),
                          F.lit("null"))
    alone = F.to_json(F.struct(c.alias("x")), {"ignoreNullFields": "false"})  # {"x":...}
    return F.substring(alone, F.lit(6), F.length(alone) - 6)


def json_records(df: DataFrame) -> DataFrame:
    """One JSON text per row, with nulls spelled out and numbers in plain notation."""
    safe = json_safe(df)
    return safe.select(_json_value(F.struct("*"), safe.schema).alias("record"))
