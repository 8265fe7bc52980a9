"""Readers and writers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candor.operators.prepare import add_review_year
from candor.schemas import RAW_DATASETS, RAW_SCHEMAS

CORRUPT = "_corrupt_record"


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """One JSON object per line. With a schema there is no inference pass; lines
    that do not parse keep their text in ``_corrupt_record``."""
    reader = spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if schema is None:
        return reader.json(path)
    return reader.schema(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])).json(path)


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_business_names(spark: SparkSession, path: str) -> DataFrame:
    return business_names(read_table(spark, path, ["business_id", "name"]))


def business_names(businesses: DataFrame) -> DataFrame:
    """One text name per text business id; of repeated ids the smallest name is kept."""
    return (
        businesses.select(F.col("business_id").cast("string").alias("business_id"),
                          F.col("name").cast("string").alias("name"))
        .groupBy("business_id").agg(F.min("name").alias("name"))
    )


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Overwrite a Parquet table.

    Partitioned output is rebalanced by the partition value first: adaptive
    execution then gives a small value one task and one file, and splits a
    value that holds a large share of the rows into tasks of the advisory size.
    """
    if partition_by is None:
        df.write.mode("overwrite").parquet(path)
        return
    df.hint("rebalance", partition_by).write.mode("overwrite").partitionBy(partition_by).parquet(path)


# Values come back as they were: blanks kept, quotes doubled, line breaks inside quotes.
_CSV = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**_CSV).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).options(**_CSV, multiLine=True).csv(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path)
        return True
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def raw_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines with every field they have, and ``_corrupt_record`` for lines that are no JSON.

    Declared fields are read as text and then cast, so a number that was written
    as text counts and a value that cannot be read is null; a declared field that
    no line has is null. A list in a text field keeps its JSON form. Other fields
    have the types that the data shows.
    """
    seen = read_json_lines(spark, path).schema
    declared = {f.name: f.dataType for f in schema.fields}
    fields = [T.StructField(n, T.StringType()) for n in declared]
    fields += [f for f in seen.fields if f.name not in declared and f.name != CORRUPT]
    df = read_json_lines(spark, path, T.StructType(fields))
    return df.withColumns({n: F.col(n).try_cast(kind) for n, kind in declared.items() if kind != T.StringType()})


def convert_raw(spark: SparkSession, raw_dir: str, out_dir: str, prefix: str = "",
                declared: bool = True) -> dict[str, dict[str, int]]:
    """Raw JSON datasets to Parquet; an absent file is skipped. Reviews are laid out by year.

    Every field is kept. ``declared`` gives the declared columns their declared
    types, otherwise all types are inferred. Lines that are no JSON go to
    ``<out_dir>/_corrupt/<name>`` with their text. Returns the counts of rows
    and of corrupt lines by dataset.
    """
    done = {}
    for name in RAW_DATASETS:
        source = f"{raw_dir}/{prefix}{name}.json"
        if not path_exists(spark, source):
            continue
        df = raw_table(spark, source, RAW_SCHEMAS[name]) if declared else read_json_lines(spark, source)
        if CORRUPT not in df.columns:
            df = df.withColumn(CORRUPT, F.lit(None).cast("string"))
        seen = Observation()
        good = (df.observe(seen, F.count_if(F.col(CORRUPT).isNull()).alias("rows"),
                           F.count_if(F.col(CORRUPT).isNotNull()).alias("corrupt"))
                .filter(F.col(CORRUPT).isNull()).drop(CORRUPT))
        if name == "review" and "date" in df.columns:
            write_table(add_review_year(good), f"{out_dir}/{name}", "review_year")
        else:
            write_table(good, f"{out_dir}/{name}")
        done[name] = dict(seen.get)
        if done[name]["corrupt"]:
            write_table(df.filter(F.col(CORRUPT).isNotNull()), f"{out_dir}/_corrupt/{name}")
    return done
