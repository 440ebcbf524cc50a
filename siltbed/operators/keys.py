"""Surrogate keys, and checks for the keys Parquet does not enforce."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from siltbed.session import scratch_folder


def number_rows(spark: SparkSession, path: str, columns: list[str], start: int = 0, id_: str = "id") -> DataFrame:
    """Rows of a Parquet folder with dense ids from ``start + 1``.

    An id is a file's offset plus the row's position in the file, so it depends on the files alone: a
    task that runs again after its executor is lost gives every row the same id. The offsets are one
    row per file, counted from the footers, so the running sum in one partition stays small. They are broadcast by hint: their
    estimate is that of the rows, and without it all rows would be shuffled by their file.
    """
    rows = spark.read.parquet(path).select(
        *columns, F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row")
    )
    before = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("__file")
        .agg(F.count("*").alias("n"))
        .select("__file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__offset"))
    )
    id_value = F.lit(start + 1).cast("bigint") + F.col("__offset") + F.col("__row")
    return rows.join(F.broadcast(offsets), "__file").select(id_value.alias(id_), *columns)


def assign_surrogate_ids(df: DataFrame, start: int = 0, id_: str = "id") -> DataFrame:
    """``df`` with unique increasing ids. The rows are written once to the shared folder and numbered there."""
    spark = df.sparkSession
    path = scratch_folder(spark, "numbered")
    df.write.parquet(path)
    return number_rows(spark, path, df.columns, start, id_)


#: Rows a task can number in its own range of ids.
RANGE = 1 << 27


def reserved_ids(start: int = 0, id_: str = "id") -> Column:
    """Unique ids above ``start`` for the rows a write puts out: each task has a range of its own, so no row is looked at twice.

    Ids have gaps, and are settled by the write: a task that runs again numbers its rows anew, in the same range, and only one of its
    attempts is kept. More rows in a task than its range stop the write.
    """
    row = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)
    full = F.raise_error(F.lit(f"a task has more than {RANGE} rows; read with smaller partitions"))
    value = F.lit(start + 1).cast("long") + F.spark_partition_id().cast("long") * RANGE + row
    return F.when(row < RANGE, value).otherwise(full.cast("long")).alias(id_)


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("count")).where(F.col("count") > 1)


def check_reference(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child key values without a parent, with their row count. NULL refers to nothing and passes.

    Both sides come to the join with one row per key, so no key can be hot there, and the
    partitioning of the two aggregates is the one the join needs.
    """
    used = child.where(F.col(child_key).isNotNull()).groupBy(child_key).agg(F.count("*").alias("count"))
    known = parent.select(F.col(parent_key).alias(child_key)).distinct()
    return used.join(known, child_key, "left_anti")
