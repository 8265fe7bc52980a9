"""Column expressions shared by the operators. All run inside Spark's own code generation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def finite(c) -> Column:
    """Double value of ``c``; NaN and infinities become null."""
    c = F.col(c) if isinstance(c, str) else c
    d = c.cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) != F.lit(float("inf"))), d)


def lenient_number(c) -> Column:
    """Text or number to double; whatever does not parse, or is not finite, becomes null."""
    c = F.col(c) if isinstance(c, str) else c
    return finite(c.try_cast("double"))


def wall_clock(c) -> Column:
    """Text to a timestamp without time zone; unreadable text becomes null."""
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast("timestamp_ntz")


def friend_count(df: DataFrame, name: str = "friends") -> Column:
    """Length of a list of names: an array, an array as JSON text, or names with commas between.

    Null, blank and "none" stand for the empty list. Commas are counted in the
    text, so no list of thousands of names is built only to be measured.
    """
    if isinstance(df.schema[name].dataType, T.ArrayType):
        return F.coalesce(F.array_size(name), F.lit(0))
    text = F.lower(F.trim(name))
    as_json = F.coalesce(F.json_array_length(text), F.lit(0))
    return (F.when(F.coalesce(text, F.lit("")).isin("", "none"), 0)
            .when(F.startswith(text, F.lit("[")), as_json)
            .otherwise(F.regexp_count(text, F.lit(",")) + 1))


def ratio(n, d) -> Column:
    """``n / d`` where ``d`` is positive, else null."""
    n = F.col(n) if isinstance(n, str) else n
    d = F.col(d) if isinstance(d, str) else d
    return F.when(d > 0, n / d)


def int_flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or null."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def wall_micros(c) -> Column:
    """Microseconds since 1970 as the clock on the wall shows them.

    Built from the fields of the timestamp, so no time zone or change of clocks
    enters a difference of two of them.
    """
    c = F.col(c) if isinstance(c, str) else c
    t = c.cast("timestamp_ntz")
    days = F.date_diff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("long")
    minutes = (days * 24 + F.hour(t)) * 60 + F.minute(t)
    return minutes * 60_000_000 + (F.date_part(F.lit("SECOND"), t) * 1_000_000).cast("long")


def two_digits(c) -> Column:
    """Text with two decimals; halves go to the even digit and a negative zero keeps its sign."""
    c = F.col(c) if isinstance(c, str) else c
    near = F.bround(c, 2)
    return F.when((c < 0) & (near == 0), "-0.00").otherwise(F.format_string("%.2f", near))


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column; for comparing results across engines."""
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields
    ])
