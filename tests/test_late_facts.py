"""Facts that come before their measure wait for it."""

import pytest
from pyspark.sql import functions as F

from siltbed.operators.lookups import left_facts
from siltbed.streaming import loads
from test_streams import House, entity


@pytest.fixture
def house(spark, tmp_path):
    return House(spark, tmp_path)


def load(house, **how):
    loads.load_measures(house.spark, house.warehouse, dimension="records", **how).awaitTermination()
    waiting = loads.waiting_facts(house.spark, house.warehouse).collect()
    facts = sorted((e, m, v) for _, e, m, v in house.rows("entity_measure"))
    return facts, sorted((r.entity_id, r.measure_name, r.value) for r in waiting)


FACTS = [entity(1, stats=[(1, "hp", 10), (2, "speed", 20)]), entity(2, stats=[(1, "hp", 30)])]
MEASURES = [{"id": 1, "name": "hp"}, {"id": 2, "name": "speed"}]


@pytest.mark.parametrize("ids", ["dense", "reserved"])
def test_a_fact_waits_for_its_measure(house, ids):
    house.land("entity", FACTS, 1)
    assert load(house, ids=ids) == ([], [(1, "hp", 10), (1, "speed", 20), (2, "hp", 30)])
    house.land("measure", MEASURES[:1], 2)  # a measure alone starts a batch
    assert load(house, ids=ids) == ([(1, 1, 10), (2, 1, 30)], [(1, "speed", 20)])
    house.land("entity", [entity(3, stats=[(2, "speed", 40), (1, "hp", 50)])], 3)
    assert load(house, ids=ids)[1] == [(1, "speed", 20), (3, "speed", 40)]
    house.land("measure", MEASURES[1:], 4)
    late, waiting = load(house, ids=ids)
    assert (late, waiting) == ([(1, 1, 10), (1, 2, 20), (2, 1, 30), (3, 1, 50), (3, 2, 40)], [])
    numbers = [r[0] for r in house.rows("entity_measure")]
    assert len(set(numbers)) == len(numbers)
    if ids == "dense":
        assert sorted(numbers) == [1, 2, 3, 4, 5]


def test_two_batches_equal_one(spark, tmp_path):
    apart, together = House(spark, tmp_path / "a"), House(spark, tmp_path / "b")
    apart.land("entity", FACTS, 1)
    load(apart)
    apart.land("measure", MEASURES, 2)
    for endpoint, records in (("measure", MEASURES), ("entity", FACTS)):
        together.land(endpoint, records, 1)
    assert load(apart) == load(together)


@pytest.mark.parametrize("lost_at", ["/storage/measure", "/storage/entity_measure_waiting", "/storage/entity_measure", "/ledger/entity_measure"])
def test_a_batch_that_runs_again_loses_and_doubles_nothing(house, monkeypatch, lost_at):
    house.land("entity", FACTS, 1)
    before = load(house)
    house.land("measure", MEASURES, 2)
    write = loads.write_batch

    def write_then_fail(df, path, batch_id):
        write(df, path, batch_id)
        if path.endswith(lost_at):
            raise RuntimeError("lost")

    monkeypatch.setattr(loads, "write_batch", write_then_fail)
    with pytest.raises(Exception, match="lost"):
        load(house)
    assert [(r.entity_id, r.measure_name, r.value) for r in loads.waiting_facts(house.spark, house.warehouse).orderBy("entity_id", "measure_name").collect()] == before[1]
    monkeypatch.setattr(loads, "write_batch", write)
    assert load(house) == ([(1, 1, 10), (1, 2, 20), (2, 1, 30)], [])


def test_facts_without_a_name_wait_and_nothing_to_load_is_fine(house):
    assert load(house) == ([], [])
    nameless = entity(5, stats=[(7, "x", 1)])
    nameless["stats"][0]["stat"]["name"] = None
    house.land("entity", [nameless], 1)
    house.land("measure", MEASURES, 1)
    assert load(house) == ([], [(5, None, 1)])
    with pytest.raises(ValueError, match="dimension"):
        loads.load_measures(house.spark, house.warehouse, dimension="both")


def test_left_facts_keeps_each_fact(spark):
    facts = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("a", 4)], "name string, v int")
    dim = spark.createDataFrame([("a", 10), ("a", 11), (None, 12)], "name string, id int")
    rows = {(r.name, r.v, r.id, r.there) for r in left_facts(facts, dim, "name", "there").collect()}
    assert rows == {("a", 1, 10, True), ("a", 1, 11, True), ("a", 4, 10, True), ("a", 4, 11, True), ("b", 2, None, False), (None, 3, None, False)}
    assert left_facts(facts, dim, "name", "there").where(F.col("there")).drop("there", "name").exceptAll(facts.join(dim, "name").drop("name")).isEmpty()
