"""Row numbers over a whole table or within groups, without one large task.

A window without partitions, or over a key that holds a large share of the
rows, sorts everything in a single task. Here the sort is a distributed range
sort; a row's number is its place inside its sorted slice plus the number of
rows in the slices before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candor.session import stored

# monotonically_increasing_id puts the partition number above this bit.
_SLICE_BITS = 33


def global_row_number(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Add ``name`` = 1..N in the given total order.

    The sorted slices are written once, because range bounds are sampled and
    must not be drawn a second time. Sampling also reads the input twice, so
    pass a stored table if it is costly to compute. The offset table has one row per sorted
    slice, hence never more rows than shuffle partitions, and is broadcast.
    """
    place = "_place"
    slices = stored(df.orderBy(*order).withColumn(place, F.monotonically_increasing_id()), "sorted")
    slice_no = F.shiftright(place, _SLICE_BITS)
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        slices.groupBy(slice_no.alias("_slice")).agg(F.count(F.lit(1)).alias("_rows"))
        .select("_slice", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    inside = F.col(place) - F.shiftleft(F.col("_slice").cast("long"), _SLICE_BITS)
    return (
        slices.withColumn("_slice", slice_no)
        .join(F.broadcast(offsets), "_slice")
        .withColumn(name, inside + F.col("_offset") + 1)
        .drop("_slice", "_offset", place)
    )


def hot_keys(df: DataFrame, key: str, hot_rows: int) -> DataFrame:
    """Keys with more than ``hot_rows`` rows: at most N / hot_rows of them."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
            .filter(F.col("_rows") > hot_rows).select(key))


def sequence_within(df: DataFrame, key: str, order: list[Column], name: str,
                    hot_rows: int = 5_000_000) -> DataFrame:
    """Add ``name`` = 1..n inside each ``key``, whatever share of the rows a key holds.

    Ordinary keys use a plain window. Keys above ``hot_rows`` are numbered by
    one distributed sort over (key, order), less the first number of their key.
    Null keys count as one key, as a window treats them.
    """
    hot = hot_keys(df, key, hot_rows)
    plain = F.row_number().over(Window.partitionBy(key).orderBy(*order)).cast("long")
    if hot.isEmpty():
        return df.withColumn(name, plain)
    hot = stored(hot.select(F.col(key).alias("_hot")), "hot-keys")
    match = F.col(key).eqNullSafe(F.col("_hot"))
    cold = df.join(hot, match, "left_anti").withColumn(name, plain)
    numbered = global_row_number(df.join(hot, match, "left_semi"), [F.col(key).asc_nulls_first(), *order], "_number")
    first = numbered.groupBy(F.col(key).alias("_hot")).agg(F.min("_number").alias("_first"))
    split = (
        # One row per hot key, so bounded by N / hot_rows as above.
        numbered.join(F.broadcast(first), match)
        .withColumn(name, F.col("_number") - F.col("_first") + 1)
        .select(*df.columns, name)
    )
    return cold.unionByName(split)
