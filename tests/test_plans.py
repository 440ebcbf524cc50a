"""What reaches the scans, and how often the large side is moved."""

import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from siltbed import schemas
from siltbed.operators.lookups import lookup_chain
from siltbed.sources.records import read_json_records
from siltbed.streaming import loads

SF = "/root/testdata/sf0.001"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df):
    return [line for line in physical(df).splitlines() if "FileScan" in line]


@pytest.fixture
def shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def staging(spark, tmp_path):
    record = F.struct(
        F.col("id"),
        F.array(F.struct(F.struct(F.lit("n").alias("name"), F.lit("u/1/").alias("url")).alias("type"))).alias("types"),
        F.array_repeat(F.lit("long"), 20).alias("moves"),
    )
    path = str(tmp_path / "staging")
    spark.range(100).select(F.to_variant_object(record).alias("json_data")).write.parquet(path)
    return spark.read.schema(schemas.STAGING).parquet(path)


def test_a_load_reads_its_own_paths_only(staging):
    flat = loads.membership_rows(staging, *schemas.CATEGORY_B)
    (scan,) = scans(flat)
    assert "ReadSchema: struct<json_data:struct<0:bigint,1:array<struct<type:struct<name:string" in scan
    assert "Exchange" not in physical(flat) and flat.count() == 100


@pytest.mark.parametrize(
    "name, wanted",
    [
        ("rank_gap_category_b", ["struct<p_partkey:bigint,p_size:int>", "struct<l_partkey:bigint>"]),
        ("rank_gap_category_a", ["struct<o_orderkey:bigint>", "struct<l_orderkey:bigint,l_suppkey:bigint>"]),
        ("strength_rating", ["struct<p_partkey:bigint,p_name:string>", "struct<l_partkey:bigint,l_quantity:double>"]),
        ("json_path_filter", ["struct<event_id:bigint,props:string>"]),
    ],
)
def test_columns_are_pruned(spark, name, wanted):
    df = contract.queries()[name](spark, SF)
    found = {line.split("ReadSchema: ")[1] for line in scans(df)}
    assert found == set(wanted)


def test_filters_reach_the_scan(spark):
    df = contract.queries()["check_reference"](spark, SF)
    assert any("GreaterThan(p_size,10)" in line for line in scans(df))


def test_cube_expands_grouped_counts(spark):
    lines = physical(contract.queries()["cohort_category_cube"](spark, SF)).splitlines()
    depth = next(i for i, line in enumerate(lines) if "Expand" in line)
    assert "HashAggregate" in lines[depth + 1] + lines[depth + 2]


def test_lookup_chain_moves_the_large_side_once(spark, shuffled):
    big = spark.range(0, 1000, 1, 8).withColumn("key", F.col("id") % 10).withColumn("payload", F.lit("x"))
    members = spark.range(10).selectExpr("id as key", "id % 3 as link")
    labels = spark.range(3).selectExpr("id as link", "'l' as label")
    plan = physical(lookup_chain(big, "key", members, labels, "link"))
    # One exchange for the large side, one per dimension, one for the two of them joined.
    assert plan.count("Exchange hashpartitioning") == 4


def test_file_pattern_prunes_files(spark, tmp_path):
    for i in range(6):
        folder = tmp_path / ("entity" if i % 3 == 0 else "cohort")
        folder.mkdir(exist_ok=True)
        (folder / f"{i}.json").write_text(json.dumps({"id": i}))
    df = read_json_records(spark, f"{tmp_path}/*", pattern=".*/entity/.*")
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    leaves = plan.collectLeaves()
    files = [leaves.apply(i).metrics().get("numFiles").get().value() for i in range(leaves.size())]
    assert files == [2]
