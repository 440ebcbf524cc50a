"""Texts that are no records: set aside in the pass that stages the others, and staged once when repaired. Runs told by their paths."""

import json
import os

import pytest
from pyspark.sql import functions as F

from siltbed import schemas
from siltbed.operators.dimensions import latest_rows
from siltbed.plans.bindings import ingest_endpoint
from siltbed.sources.records import run_order, strict_json
from siltbed.streaming import ingest, loads
from siltbed.streaming.warehouse import Warehouse


@pytest.fixture
def house(spark, tmp_path):
    return Warehouse(str(tmp_path / "house")).create(spark)


def land(house, run, name, data: bytes, endpoint="entity"):
    folder = f"{house.root}/landing/run={run}/{endpoint}"
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{name}.json"
    with open(path, "wb") as f:
        f.write(data)
    return path


def stage(spark, house, **how):
    ingest_endpoint(spark, house, "entity", malformed="QUARANTINE", **how).awaitTermination()
    found = loads.staged(spark, house.staging("entity")).select(F.variant_get("json_data", "$.id", "int").alias("id"))
    return sorted(r.id for r in found.collect())


def aside(spark, house):
    return ingest.quarantined(spark, house.staging("entity"))


def test_good_files_are_staged_and_the_cut_record_is_set_aside_once(spark, house):
    land(house, 1, "a", b'{"id": 1}\n')
    path = land(house, 1, "b", '{"id": 2, "s": "é"}\r\n\n{"id": 3, "na'.encode())
    land(house, 1, "c", b'[{"id": 4}, {"id": 5}]\n   \n[]\n')
    assert stage(spark, house) == [1, 2, 4, 5]
    (row,) = aside(spark, house).collect()
    assert (row.file, row.start, row.offset, row.text) == (f"file:{path}", 0, len('{"id": 2, "s": "é"}\r\n\n'.encode()), '{"id": 3, "na')
    assert open(path, "rb").read()[row.offset :].decode() == row.text
    loads.load_entities(spark, house).awaitTermination()
    assert sorted(r.id for r in house.read(spark, "entity").collect()) == [1, 2, 4, 5]


def test_a_repaired_record_is_staged_once(spark, house, monkeypatch):
    land(house, 7, "b", b'{"id": 3, "na\nnot json\n{"id": 8}')
    assert stage(spark, house) == [8]

    def repaired():
        return aside(spark, house).withColumn("text", F.when(F.col("text").startswith('{"id": 3'), F.lit('{"id": 3}')).otherwise(F.col("text")))

    def again():
        return ingest.replay(spark, repaired(), house.landing(), house.replays("entity"), "entity")

    def lost(*_):
        raise OSError("lost")

    move = ingest.move_folder
    monkeypatch.setattr(ingest, "move_folder", lost)
    with pytest.raises(OSError, match="lost"):
        again()
    assert stage(spark, house) == [8]  # what is half landed is not read
    monkeypatch.setattr(ingest, "move_folder", move)
    assert [again(), again()] == [0, 0]  # the first one lands what the lost call had written down
    assert stage(spark, house) == [3, 8]
    assert {r[schemas.LANDED] for r in loads.staged(spark, house.staging("entity")).collect()} == {"0" * 19 + "7"}
    assert stage(spark, house) == [3, 8]


def test_replay_of_nothing_lands_nothing(spark, house):
    land(house, 1, "a", b'{"id": 1}')
    assert stage(spark, house) == [1]
    assert ingest.replay(spark, aside(spark, house), house.landing(), house.replays("entity"), "entity") == 0


def test_offsets_in_many_batches_and_files(spark, house):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        texts = {}
        for name in "abc":
            lines = [("x" * (i % 11) + f"ü{i}" if i % 5 else json.dumps({"id": i})) for i in range(60)]
            texts[name] = "\n".join(lines).encode()
            land(house, 1, name, texts[name])
        assert stage(spark, house) == sorted(list(range(0, 60, 5)) * 3)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    rows = aside(spark, house).collect()
    assert len(rows) == 3 * 48
    for r in rows:
        data = texts[r.file[-6]]
        assert data[r.offset :].split(b"\n")[0].decode() == r.text


def test_whole_files_are_set_aside_too(spark, house):
    land(house, 1, "a", b'[{"id": 1},\n {"id": 2}]')
    land(house, 1, "b", b'[{"id": 3},\n {"id":')
    assert stage(spark, house, multi_line=True) == [1, 2]
    assert [(r.offset, r.text) for r in aside(spark, house).collect()] == [(0, '[{"id": 3},\n {"id":')]


def test_a_text_is_one_value_or_none(spark):
    good = ['{"id": 1}', " [1, 2]\r", "null", "7", '"],[0"']
    bad = ['{"id": 2}]', '{"id": 2}}', '{"id": 1} {"id": 2}', "1, 2", '{"id": 2}],[{"x": 1}', '{"id":', "", "// {}"]
    df = spark.createDataFrame([(t,) for t in good + bad], "text string").select("text", strict_json("text").isNotNull().alias("ok"))
    assert {r.text for r in df.collect() if r.ok} == set(good)


def test_runs_sort_by_their_names(spark):
    paths = ["/x/run=9/entity/p", "/x/run=10/entity/p", "/x/run=2024-5-9/e/p", "/x/run=2024-5-10/e/p", "/x/run=b/e/p", "/x/e/p"]
    df = spark.createDataFrame([(p, i) for i, p in enumerate(paths)], "path string, i int").select("i", run_order("path").alias("o"))
    rows = {r.i: r.o for r in df.collect()}
    assert rows[0] < rows[1] < rows[2] < rows[3] < rows[4] and rows[5] is None


@pytest.mark.parametrize("times", [(5, 5), (9, 1)])
def test_the_latest_run_is_told_by_its_path_not_by_file_times(spark, house, times):
    for run, (when, name) in enumerate(zip(times, ("old", "new"), strict=True), start=9):
        path = land(house, run, "a", json.dumps({"id": 1, "name": name}).encode())
        os.utime(path, (10**9 + when, 10**9 + when))
    stage(spark, house)
    loads.load_entities(spark, house).awaitTermination()
    rows = latest_rows(house.read(spark, "entity", landed=True), "id", schemas.LANDED).collect()
    assert [r.name for r in rows] == ["new"]


def test_rewritten_files_are_found(spark, house):
    path, other = land(house, 1, "a b", b'{"id": 1}'), land(house, 1, "c", b'{"id": 2}')
    for p in (path, other):
        os.utime(p, (10**9, 10**9))
    stage(spark, house)
    checkpoint = house.checkpoint("ingest_entity")
    assert ingest.rewritten_files(spark, house.landing(), checkpoint).count() == 0
    land(house, 1, "a b", b'{"id": 3}')
    found = ingest.rewritten_files(spark, house.landing(), checkpoint).collect()
    assert [r.path for r in found] == [f"file:{path}"] and found[0].now > found[0].read
