import pytest
from pyspark.sql import functions as F

from siltbed.plans.audit import audit_history, count_audit, count_from_log_line
from siltbed.schemas import AUDIT


def at(day):
    return F.make_timestamp(F.lit(2024), F.lit(1), F.lit(day), F.lit(0), F.lit(0), F.lit(0))


@pytest.mark.parametrize("kind", ["manual", "scheduled"])
def test_runs(spark, tmp_path, kind):
    path = str(tmp_path / "audit")
    seen = []
    for day, size in enumerate([9, 9, 11, 4], start=1):
        row = count_audit(spark, path, "cohort", spark.range(size), kind, at(day)).first()
        seen.append((row.previous, row.current, row.change, row.level, row.message))
    start = kind.capitalize() + " run. cohort: "
    assert seen == [
        (None, 9, None, "WARNING", start + "first check, count is 9"),
        (9, 9, 0, "INFO", start + "unchanged, count is still 9"),
        (9, 11, 2, "WARNING", start + "count increased from 9 to 11"),
        (11, 4, -7, "WARNING", start + "count dropped from 11 to 4"),
    ]
    log = spark.read.parquet(path)
    assert log.count() == 4 and log.schema == AUDIT
    assert count_audit(spark, path, "other", spark.range(3), kind).first().previous is None


def test_run_kind(spark, tmp_path):
    with pytest.raises(ValueError):
        count_audit(spark, str(tmp_path / "a"), "x", spark.range(1), "nightly")


def test_history_equals_runs(spark):
    runs = [(d, n) for d, n in enumerate([9, 9, 11, 4], start=1)]
    df = spark.createDataFrame(runs, "d int, current long").select(
        at(F.col("d")).alias("run_ts"), F.lit("x").alias("dataset"), F.lit("manual").alias("run_kind"), "current"
    )
    levels = [(r.previous, r.level) for r in audit_history(df).orderBy("run_ts").collect()]
    assert levels == [(None, "WARNING"), (9, "INFO"), (9, "WARNING"), (11, "WARNING")]


def test_log_line(spark):
    lines = ["2024 => INFO => still 9", "from 9 to 12 \n", "no number", "9 left", None]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    assert [r[0] for r in df.select(count_from_log_line("line")).collect()] == [9, 12, None, None, None]
