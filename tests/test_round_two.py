"""Late-dated files, repeated runs, malformed listings, whole-path patterns, exact decimal sums, options of the marts."""

import os
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from siltbed.operators.dimensions import latest_per_key, latest_rows
from siltbed.operators.totals import joined_counts, joined_sums
from siltbed.plans.marts import register_marts
from siltbed.sources.records import matching_path, read_json_records, resource_catalog, unreadable_payloads
from siltbed.streaming.ingest import ingest_stream


def land(folder, name, text, days_ago):
    path = folder / name
    path.mkdir()
    file = path / "part.json"
    file.write_text(text)
    then = time.time() - days_ago * 86_400
    os.utime(file, (then, then))


def test_files_with_old_dates_are_staged(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    for i, days in enumerate([0, 8, 400, 3]):
        land(landing, f"run={i}", f'{{"id": {i}}}', days)
        ingest_stream(spark, str(landing), str(tmp_path / "staging"), str(tmp_path / "checkpoint")).awaitTermination()
    staged = spark.read.parquet(str(tmp_path / "staging")).select(F.try_variant_get("json_data", "$.id", "int").alias("id"))
    assert sorted(r.id for r in staged.collect()) == [0, 1, 2, 3]


def test_pattern_covers_the_whole_path(spark, tmp_path):
    for name in ("entity.json", "entity.json.bak", "x_entity.json_old"):
        (tmp_path / name).write_text('{"id": 1}')
    assert read_json_records(spark, str(tmp_path), pattern=".*/entity[.]json").count() == 1
    assert matching_path(spark.read.text(str(tmp_path)), ".*[.]bak").count() == 1


def test_malformed_listing_stops_the_read(spark):
    good, cut = '{"results": [{"url": "https://a/b/1/"}]}', '{"results": [{"url": "https://a/'
    listing = spark.createDataFrame([(good,), (cut,), (None,)], "payload string")
    with pytest.raises(Exception, match="MALFORMED"):
        resource_catalog(listing).collect()
    assert [r.payload for r in unreadable_payloads(listing).collect()] == [cut]
    assert resource_catalog(listing.join(unreadable_payloads(listing), "payload", "left_anti")).count() == 1


@pytest.mark.parametrize("kind", ["decimal(18,10)", "decimal(38,10)", "bigint"])
def test_sums_are_those_of_the_plain_join(spark, kind):
    entities = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "id long, name string")
    facts = spark.createDataFrame([(1, "0.1234567891"), (1, "2.0000000001"), (2, "7")], "key long, text string")
    facts = facts.select("key", F.expr(f"cast(cast(text as decimal(38, 10)) as {kind})").alias("value"))
    plain = entities.join(facts, F.col("id") == F.col("key")).groupBy("name").agg(F.sum("value").alias("total"))
    got = joined_sums(entities, "id", facts, "key", "value", ["name"])
    assert sorted(got.collect()) == sorted(plain.collect()) and got.schema["total"].dataType == plain.schema["total"].dataType


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_wide_sums_are_exact_or_raise(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        once = spark.createDataFrame([(1, "a"), (2, "a")], "id long, name string")
        twice = spark.createDataFrame([(1, "a"), (1, "a")], "id long, name string")
        wide = Decimal("12345678901234567890123456789.5")
        facts = spark.createDataFrame([(1, wide), (1, Decimal(1)), (2, None)], "key long, value decimal(38,5)")
        assert joined_sums(once, "id", facts, "key", "value", ["name"]).first().total == Decimal("12345678901234567890123456790.5")
        with pytest.raises(Exception, match="a sum does not fit: 2 times"):
            joined_sums(twice, "id", facts, "key", "value", ["name"]).collect()
        narrow = spark.createDataFrame([(1, Decimal("12345678901234567890123.45678"))], "key long, value decimal(38,5)")
        assert joined_sums(twice, "id", narrow, "key", "value", ["name"]).first().total == Decimal("24691357802469135780246.91356")
        none = spark.createDataFrame([(1, None)], "key long, value decimal(38,5)")
        assert joined_sums(twice, "id", none, "key", "value", ["name"]).first().total is None
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_group_columns_follow_the_sessions_rules(spark):
    entities = spark.createDataFrame([(1, "x")], "id long, Cohort string")
    members = spark.createDataFrame([(1, "c")], "key long, category string")
    assert joined_counts(entities, "id", members, "key", ["cohort", "category"]).collect()[0].n == 1
    with pytest.raises(ValueError, match="both sides"):
        joined_counts(entities, "id", members.withColumn("cohort", F.lit("y")), "key", ["cohort"])


def test_latest_record_of_each_key(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, None, "c"), (2, 1, "d"), (None, 1, "e")], "id long, run long, name string")
    assert sorted(r.name for r in latest_per_key(df, "id", "run").collect()) == ["b", "d", "e"]
    assert latest_per_key(df, "id", "run").columns == df.columns


def test_latest_rows_of_several_runs(spark):
    records = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (3, 1), (3, 2)], "id long, run long")
    rows = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (1, "b", 2), (1, "c", 2), (2, "a", 1), (3, "a", 1)], "entity_id long, name string, run long")
    got = latest_rows(rows, "entity_id", "run", records, "id")
    assert sorted(map(tuple, got.collect())) == [(1, "b"), (1, "b"), (1, "c"), (2, "a")]
    pairs = latest_per_key(rows, ["entity_id", "name"], "run")
    assert sorted(map(tuple, pairs.collect())) == [(1, "a", 1), (1, "b", 2), (1, "c", 2), (2, "a", 1), (3, "a", 1)]


def test_mart_options(spark):
    tables = {
        "entity": spark.createDataFrame([(1, "n", "x"), (2, "n", "x")], "id long, name string, cohort string"),
        "category_a": spark.createDataFrame([(1, 7, 1, "p"), (2, 7, 1, "p")], "id long, category_id long, entity_id long, category_name string"),
        "category_b": spark.createDataFrame([(1, 8, 1, "q"), (2, 8, 1, "q")], "id long, category_id long, entity_id long, category_name string"),
        "entity_measure": spark.createDataFrame([(1, 1, 1, 5), (2, 1, 1, 5), (3, 2, 1, 4)], "id long, entity_id long, measure_id long, value long"),
    }
    register_marts(spark, tables)
    assert spark.table("category_a_rank_gap").first().n == 2
    assert [r.strength for r in spark.table("strength_rating").collect()] == [14]
    register_marts(spark, tables, dedup=True, distinct=True, key="id", flags=True, ordered=False)
    assert spark.table("category_a_rank_gap").first().n == 1
    assert sorted(r.strength for r in spark.table("strength_rating").collect()) == [4, 5]
    assert {r.quantity for r in spark.table("cohort_category_totals").collect()} == {1}
    assert len(spark.table("cohort_category_totals").columns) > 3
