"""Key checks of a batch against all before it equal checks of the whole table."""

import pytest

from siltbed.operators.keys import check_reference, check_unique
from siltbed.schemas import STORAGE
from siltbed.streaming import keychecks
from siltbed.streaming.warehouse import Warehouse, commit, write_batch

ENTITIES, FACTS = "id long, name string, cohort string, lookup_key string", "id long, entity_id long, measure_id long, value long"


@pytest.fixture
def house(spark, tmp_path):
    return Warehouse(str(tmp_path)).create(spark)


def batch(spark, house, table, number, rows, schema):
    write_batch(spark.createDataFrame(rows, schema).select(*STORAGE[table].names), house.table(table), number)
    commit(spark, house.table(table), number, "q")


def entities(spark, house, number, ids, name="n"):
    batch(spark, house, "entity", number, [(i, name if i != 4 else None, None, None) for i in ids], ENTITIES)


def facts(spark, house, number, ids):
    batch(spark, house, "entity_measure", number, [(None, i, 1, 1) for i in ids], FACTS)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def unique_agrees(spark, house, keys, buckets=4):
    version = keychecks.update_unique(spark, house, "entity", keys, buckets)
    kept = keychecks.duplicate_keys(spark, house, "entity", keys)
    full = check_unique(house.read(spark, "entity"), keys)
    assert kept.dtypes == full.dtypes and rows(kept) == rows(full)
    return version, rows(kept)


def references_agree(spark, house, buckets=4):
    args = ("entity_measure", "entity_id", "entity", "id")
    version = keychecks.update_reference(spark, house, *args, buckets)
    kept = keychecks.orphan_keys(spark, house, *args)
    full = check_reference(house.read(spark, "entity_measure"), "entity_id", house.read(spark, "entity"), "id")
    assert kept.dtypes == full.dtypes and rows(kept) == rows(full)
    return version, rows(kept)


@pytest.mark.parametrize("keys", [["id"], ["id", "name"]])
def test_duplicates_per_batch_equal_the_full_check(spark, house, keys):
    assert unique_agrees(spark, house, keys) == (-1, [])
    entities(spark, house, 0, [1, 2, 3, None])
    assert unique_agrees(spark, house, keys) == (0, [])
    entities(spark, house, 1, [4, 4, 2, None])
    assert len(unique_agrees(spark, house, keys)[1]) == 3  # NULL is a key too
    assert unique_agrees(spark, house, keys)[0] == 1  # no new batch, no new version
    entities(spark, house, 2, [4, 9])
    entities(spark, house, 3, [2, 2, 10], name="other")  # two batches in one check
    assert unique_agrees(spark, house, keys)[0] == 2


def test_orphans_per_batch_equal_the_full_check(spark, house):
    assert references_agree(spark, house)[1] == []
    facts(spark, house, 0, [1, 1, 2, None])  # children before parents
    assert references_agree(spark, house)[1] == [(1, 2), (2, 1)]
    entities(spark, house, 0, [1, 5])
    assert references_agree(spark, house)[1] == [(2, 1)]
    facts(spark, house, 1, [2, 5, 7])
    assert references_agree(spark, house)[1] == [(2, 2), (7, 1)]
    entities(spark, house, 1, [2, 7])
    version, orphans = references_agree(spark, house)
    assert orphans == [] and references_agree(spark, house)[0] == version


@pytest.mark.parametrize("lost_at", ["_save_report", "_mark"])
def test_a_check_that_was_cut_short_is_done_again(spark, house, monkeypatch, lost_at):
    entities(spark, house, 0, [1, 2])
    unique_agrees(spark, house, ["id"])
    entities(spark, house, 1, [2, 3])
    step = getattr(keychecks, lost_at)

    def fail(*args):
        if lost_at == "_save_report":
            step(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(keychecks, lost_at, fail)
    with pytest.raises(RuntimeError, match="lost"):
        keychecks.update_unique(spark, house, "entity", ["id"])
    assert rows(keychecks.duplicate_keys(spark, house, "entity", ["id"])) == []
    monkeypatch.setattr(keychecks, lost_at, step)
    assert unique_agrees(spark, house, ["id"]) == (1, [(2, 2)])


def test_a_ledger_is_merged(spark, house, monkeypatch):
    monkeypatch.setattr(keychecks, "MERGED_AFTER", 2)
    for number in range(8):
        entities(spark, house, number, [number, number + 1, 100])
        _, found = unique_agrees(spark, house, ["id"])
    assert (100, 8) in found and len(found) == 8
    with keychecks._Ledger(spark, house.key_ledger("entity", ["id"]), 99) as ledger:
        assert ledger.buckets == 4 and len({f.rsplit("/", 2)[1] for f in spark.table(ledger.name).inputFiles()}) <= 4


def test_what_came_before_is_not_shuffled(spark, house, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        entities(spark, house, 0, range(50))
        keychecks.update_unique(spark, house, "entity", ["id"], 4)
        entities(spark, house, 1, range(40, 60))
        facts(spark, house, 0, range(70))
        plans, save = [], keychecks._save_report

        def record(report, *args):
            plans.append(report._jdf.queryExecution().executedPlan().toString())
            save(report, *args)

        monkeypatch.setattr(keychecks, "_save_report", record)
        references_agree(spark, house)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for plan in plans:
        for above in above_scans(plan):
            assert any("SortMergeJoin" in line for line in above) and not any("Exchange" in line for line in above[: 1 + next(i for i, line in enumerate(above) if "SortMergeJoin" in line)])


def above_scans(plan):
    """The lines above each scan of a ledger, the nearest first."""
    lines, depth = plan.splitlines(), lambda line: len(line) - len(line.lstrip(" :+-"))
    found = []
    for i, line in enumerate(lines):
        if "FileScan parquet spark_catalog" in line:
            assert "Bucketed: true" in line
            above, at = [], depth(line)
            for other in reversed(lines[:i]):
                if depth(other) < at:
                    above.append(other)
                    at = depth(other)
            found.append(above)
    assert found
    return found


def test_a_hot_key_is_counted_before_it_moves(spark, house):
    batch(spark, house, "entity", 0, [(1 if i % 3 else i, "n", None, None) for i in range(3000)], ENTITIES)
    assert unique_agrees(spark, house, ["id"])[1] == [(1, 2000)]
