"""Plans over a key that holds a third of the rows, with thresholds lowered to test size."""

import pytest
from pyspark.sql import functions as F

from siltbed.operators.dimensions import new_dimension_rows
from siltbed.operators.keys import check_reference
from siltbed.operators.lookups import fact_to_dimension, lookup_chain, refresh_lookup
from siltbed.operators.totals import joined_counts, joined_sums

ROWS = 60_000
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def skewed(spark):
    """Facts whose key 0 holds a third of the rows."""
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    key = F.when(F.col("n") % 3 == 0, 0).otherwise(F.col("n"))
    yield spark.range(0, ROWS, 1, 8).toDF("n").select(key.alias("key"), "n", (F.col("n") % 7).alias("few"))
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def dimension(spark):
    return spark.range(0, ROWS, 1, 8).toDF("key").withColumn("label", F.concat(F.lit("l"), "key"))


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def assert_split(df):
    assert "skew=true" in final_plan(df)


def test_lookup_is_split(spark, skewed, dimension):
    members = dimension.select("key", (F.col("key") % 100).alias("link"))
    labels = spark.range(0, 100).toDF("link").withColumn("label", F.lit("x"))
    out = lookup_chain(skewed, "key", members, labels, "link")
    assert out.count() == ROWS
    assert_split(out.select("n", "label"))


def test_fact_to_dimension_is_split(skewed, dimension):
    out = fact_to_dimension(skewed, dimension, "key")
    assert out.count() == ROWS
    assert_split(out)


def test_refresh_is_split(skewed, dimension):
    stored = skewed.withColumn("label", F.lit(None).cast("string"))
    out = refresh_lookup(stored, "key", "label", dimension)
    assert out.where("label is not null").count() == ROWS
    assert_split(out)


def test_hot_key_with_few_groups_is_aggregated_before_the_join(skewed, dimension):
    out = joined_counts(dimension, "key", skewed, "key", ["few"])
    assert out.agg(F.sum("n")).first()[0] == ROWS


def test_hot_key_with_many_groups_is_split(skewed, dimension):
    out = joined_counts(dimension, "key", skewed, "key", ["n"], count="c")
    assert out.agg(F.sum("c")).first()[0] == ROWS
    assert_split(out)


def test_hot_entity_with_many_names_is_split(skewed, dimension):
    names = skewed.select("key", F.col("n").cast("string").alias("name"))
    facts = dimension.select("key", F.lit(1).cast("bigint").alias("value"))
    out = joined_sums(names, "key", facts, "key", "value", ["name"])
    assert out.count() == ROWS
    assert_split(out)


def test_new_dimension_rows_are_split(spark, skewed):
    candidates = skewed.select(F.col("key").alias("id"), F.col("n").cast("string").alias("name"))
    existing = spark.range(ROWS, 2 * ROWS, 1, 8)
    out = new_dimension_rows(candidates, existing, "id")
    assert out.count() == ROWS
    assert_split(out)


def test_hot_reference_is_one_row(spark, skewed):
    out = check_reference(skewed, "key", spark.range(1, ROWS, 1, 8), "id")
    assert [tuple(r) for r in out.collect()] == [(0, ROWS // 3)]


def test_copies_do_not_multiply_rows(spark, skewed):
    """A third of both sides under one key: the join sees one row per side, not the square."""
    copies = skewed.select("key")
    out = joined_counts(copies, "key", skewed, "key", ["few"])
    assert out.agg(F.sum("n")).first()[0] == (ROWS // 3) ** 2 + ROWS * 2 // 3
