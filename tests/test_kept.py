"""Kept counts equal the full query after every batch, and an update reads new batches and the ranges their keys are in."""

from collections import Counter

import pytest

from siltbed.operators.totals import joined_counts
from siltbed.streaming import kept
from test_streams import House, entity


@pytest.fixture
def house(spark, tmp_path):
    return House(spark, tmp_path)


def full(house, by=("cohort", "category_name")):
    tables = [house.warehouse.read(house.spark, t) for t in ("entity", "category_b")]
    return Counter(map(tuple, joined_counts(tables[0], "id", tables[1].drop("id"), "entity_id", list(by)).select(*by, "n").collect()))


def now(house, by=("cohort", "category_name")):
    return Counter(map(tuple, kept.kept_counts(house.spark, house.warehouse, by=by).select(*by, "n").collect()))


def batches(house):
    yield from (
        (1, [entity(i, types=[i % 3, 7]) for i in range(20)], ("types", "entities")),
        (2, [entity(3, types=[5]), entity(3, types=[6]), entity(30, types=[1])], ("entities", "types")),  # repeated entities multiply
        (3, [entity(3), entity(31), entity(19, types=[7, 7])], ("types", "entities")),
    )


def test_counts_are_kept_over_batches_of_both_sides(house):
    assert kept.update_counts(house.spark, house.warehouse) == -1 and now(house) == Counter()
    for by in (("cohort", "category_name"), ("category_name",)):
        kept.update_counts(house.spark, house.warehouse, by=by)
    for run, rows, order in batches(house):
        house.land("entity", rows, run)
        for side in order:
            getattr(house, side)()
            kept.update_counts(house.spark, house.warehouse)
            assert now(house) == full(house)
        kept.update_counts(house.spark, house.warehouse, by=("category_name",))
        assert now(house, ("category_name",)) == full(house, ("category_name",))
    version = kept.update_counts(house.spark, house.warehouse)
    assert version == 5 and kept.update_counts(house.spark, house.warehouse) == version


def test_an_update_reads_new_batches_and_touched_ranges(house, monkeypatch):
    house.land("entity", [entity(i, types=[i % 3]) for i in range(200)], 1)
    house.entities()
    house.types()
    kept.update_counts(house.spark, house.warehouse)
    house.land("entity", [entity(5, types=[9])], 2)
    house.types()
    plans, ranges = [], []
    count, rows = kept.new_counts, kept._kept_rows
    monkeypatch.setattr(kept, "new_counts", lambda *a: plans.append(out := count(*a)) or out)
    monkeypatch.setattr(kept, "_kept_rows", lambda *a: ranges.append(a[-1]) or rows(*a))
    kept.update_counts(house.spark, house.warehouse)
    assert now(house) == full(house)
    assert [len(r) for r in ranges] == [1, 0]  # entities in the range of the new member's key, no members, as no entity is new
    plan = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(version" in plan and "PartitionFilters: [isnotnull(batch_id" in plan


def test_an_update_that_is_cut_short_is_done_again(house, monkeypatch):
    house.land("entity", [entity(i, types=[1]) for i in range(5)], 1)
    house.entities()
    house.types()
    kept.update_counts(house.spark, house.warehouse)
    before = now(house)
    house.land("entity", [entity(9, types=[1])], 2)
    house.entities()
    house.types()
    make = kept.make_folder

    def lost(spark, path):
        if "/done/" in path:
            raise OSError("lost")
        make(spark, path)

    monkeypatch.setattr(kept, "make_folder", lost)
    with pytest.raises(OSError, match="lost"):
        kept.update_counts(house.spark, house.warehouse)
    assert now(house) == before
    monkeypatch.setattr(kept, "make_folder", make)
    assert kept.update_counts(house.spark, house.warehouse) == 1
    assert now(house) == full(house) != before
