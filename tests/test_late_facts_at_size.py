"""Late facts at size: what is written, moved and evaluated for each fact."""

import pytest
from pyspark.sql import functions as F

from siltbed.functions.paths import id_from_url
from siltbed.operators.keys import number_rows
from siltbed.sources.records import run_order
from siltbed.streaming import loads
from test_late_facts import FACTS, MEASURES, load
from test_streams import House


def plan(df, capsys):
    df.explain()
    return capsys.readouterr().out


@pytest.mark.parametrize("ids", ["dense", "reserved"])
def test_facts_are_written_flat_and_once_more_to_be_numbered(spark, tmp_path, monkeypatch, ids):
    house, settle, names = House(spark, tmp_path), loads._settle, []
    monkeypatch.setattr(loads, "_settle", lambda spark, warehouse, name, *rest: names.append(name) or settle(spark, warehouse, name, *rest))
    house.land("entity", FACTS, 1)
    load(house, ids=ids)
    house.land("measure", MEASURES, 2)
    assert load(house, ids=ids) == ([(1, 1, 10), (1, 2, 20), (2, 1, 30)], [])
    assert names == ["entity_measure", "entity_measure_joined"][: 2 if ids == "dense" else 1] * 2


def test_numbering_does_not_move_the_rows(spark, tmp_path, capsys):
    spark.range(0, 1000, 1, 5).withColumn("v", F.col("id") * 2).drop("id").write.parquet(f"{tmp_path}/rows")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")  # as if there were more rows than it allows
    try:
        rows = number_rows(spark, f"{tmp_path}/rows", ["v"], 7)
        assert "SortMergeJoin" not in plan(rows, capsys)
        assert [tuple(r) for r in rows.orderBy("id").collect()] == [(i + 8, 2 * i) for i in range(1000)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_an_id_is_cut_out_of_a_url_as_splitting_gave_it(spark):
    urls = ["https://x/v2/stat/12/", "a/7/", "5/", "/-3/x", "a/ 9 /b", None]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    split = F.element_at(F.split("url", "/"), -2).cast("bigint")
    assert all(r.got == r.want for r in df.select(id_from_url("url").alias("got"), split.alias("want")).collect())
    for bad in ("5", "", "a//", "a/b/", "x/1.5/"):
        for read in (id_from_url("url"), split):
            with pytest.raises(Exception, match="INVALID_ARRAY_INDEX|CAST_INVALID_INPUT"):
                spark.createDataFrame([(bad,)], "url string").select(read).collect()


def test_run_order_of_a_run_without_a_number_replaces_nothing(spark, capsys):
    df = spark.createDataFrame([(f"file:/a/run={r}/x",) for r in ("late", "7", "7\n", "a7", "٣")], "path string")
    assert [r[0] for r in df.select(run_order("path")).collect()] == ["late", "0" * 19 + "7", "0" * 19 + "7\n", "a" + "0" * 19 + "7", "٣"]
    assert plan(df.select(run_order("path")), capsys).lower().count("rlike") >= 2
