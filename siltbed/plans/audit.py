"""Audit of how the size of a dataset changes from run to run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from siltbed.schemas import AUDIT
from siltbed.session import make_folder

RUN_KINDS = ("manual", "scheduled")


def _message(run_kind: Column, dataset: Column, previous: Column, current: Column) -> Column:
    now = current.cast("string")
    change = F.concat(F.lit(" from "), previous.cast("string"), F.lit(" to "), now)
    said = (
        F.when(previous.isNull(), F.concat(F.lit("first check, count is "), now))
        .when(previous == current, F.concat(F.lit("unchanged, count is still "), now))
        .when(previous > current, F.concat(F.lit("count dropped"), change))
        .otherwise(F.concat(F.lit("count increased"), change))
    )
    return F.concat(F.initcap(run_kind), F.lit(" run. "), dataset, F.lit(": "), said)


def _judge(runs: DataFrame) -> DataFrame:
    """Audit rows of (run_ts, dataset, run_kind, previous, current)."""
    previous, current = F.col("previous"), F.col("current")
    return runs.select(
        "run_ts",
        "dataset",
        "run_kind",
        "previous",
        "current",
        (current - previous).alias("change"),
        # Only an unchanged count is no warning; a first count is one.
        F.when(previous.eqNullSafe(current), "INFO").otherwise("WARNING").alias("level"),
        _message(F.col("run_kind"), F.col("dataset"), previous, current).alias("message"),
    )


def audit_history(counts: DataFrame) -> DataFrame:
    """Audit rows for a whole history of (run_ts, dataset, run_kind, current).

    The window sees one row per run of a dataset, never the rows that were counted.
    """
    order = Window.partitionBy("dataset").orderBy("run_ts")
    return _judge(counts.withColumn("previous", F.lag("current").over(order)))


def count_audit(
    spark: SparkSession, path: str, dataset: str, catalog: DataFrame, run_kind: str = "manual", run_ts: Column | None = None
) -> DataFrame:
    """Count ``catalog``, compare with the last count of the dataset, append the audit row, return it."""
    if run_kind not in RUN_KINDS:
        raise ValueError(f"run_kind is one of {RUN_KINDS}")
    make_folder(spark, path)  # without files it reads as an empty log
    log = spark.read.schema(AUDIT).parquet(path).where(F.col("dataset") == dataset)
    previous = log.agg(F.max_by("current", "run_ts")).scalar()
    run = catalog.agg(F.count("*").alias("current")).select(
        (F.current_timestamp() if run_ts is None else run_ts).alias("run_ts"),
        F.lit(dataset).alias("dataset"),
        F.lit(run_kind).alias("run_kind"),
        previous.alias("previous"),
        "current",
    )
    # One driver row: what is returned is what was appended, not a second count.
    row = _judge(run).collect()
    written = spark.createDataFrame(row, AUDIT)
    written.coalesce(1).write.mode("append").parquet(path)
    return written


def log_lines(rows: DataFrame) -> DataFrame:
    """Audit rows as lines of a text log: time, level and message, with the count last."""
    at = F.date_format("run_ts", "yyyy-MM-dd HH:mm:ss")
    return rows.select(F.concat_ws(" => ", at, "level", "message").alias("line"))


def count_from_log_line(line: Column | str) -> Column:
    """The count a line of a text log ends with; NULL when it does not end with one."""
    return F.nullif(F.regexp_extract(line, r"(\d+)\s*$", 1), F.lit("")).try_cast("bigint")
