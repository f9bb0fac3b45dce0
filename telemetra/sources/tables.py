"""CSV files, delimited text loads, catalog tables and local rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header-less CSV: string columns ``_c0``, ``_c1``, ..."""
    return spark.read.csv(path)


def load_text_table(spark: SparkSession, name: str, schema: str, path: str, location: str, separator: str = "\t") -> DataFrame:
    """Create a catalog table and fill it from delimited text files."""
    rows = spark.read.schema(schema).option("sep", separator).csv(path)
    return save_table(rows, name, location)


def save_table(df: DataFrame, name: str, location: str) -> DataFrame:
    """Replace a catalog table with the rows of ``df`` and read it back.

    ``location`` must be a new folder: the old files stay readable for running queries.
    """
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    df.write.option("path", location).saveAsTable(name)
    return spark.table(name)


def table_rows(spark: SparkSession, name: str, order: list[str], limit: int) -> DataFrame:
    """The first ``limit`` rows of a table in a stated order."""
    return spark.table(name).orderBy(*order).limit(limit)


def numbered_records(spark: SparkSession, view: str, last_key: int = 99) -> DataFrame:
    """Records ``(key, 'val_<key>')`` for 1..last_key as a temporary view."""
    records = spark.range(1, last_key + 1).select(
        F.col("id").cast("int").alias("key"), F.concat(F.lit("val_"), F.col("id").cast("string")).alias("value")
    )
    records.createOrReplaceTempView(view)
    return records


def record_lines(records: DataFrame, below: int) -> DataFrame:
    """``Key: k, Value: v`` for keys below a bound, in key order. The arrival number only spreads
    a frequent key over several sort partitions."""
    chosen = records.where(F.col("key") < below).withColumn("arrival", F.monotonically_increasing_id())
    return chosen.orderBy("key", "value", "arrival").select(F.concat(F.lit("Key: "), F.col("key"), F.lit(", Value: "), F.col("value")).alias("line"))
