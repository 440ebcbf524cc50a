import json
import subprocess
import sys
import time
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from siltbed.functions.paths import endpoint_from_url, id_from_url, json_path, json_text_path
from siltbed.sources.records import (
    land_records,
    landing_path,
    project_keys,
    read_json_records,
    read_literal_records,
    resource_catalog,
    run_order,
)

from siltbed.streaming.ingest import ingest_stream


def texts(df):
    return sorted(r[0] for r in df.select(F.to_json("json_data")).collect())


def parsed(df):
    return sorted((json.loads(t) for t in texts(df)), key=lambda r: r["id"])


@pytest.mark.parametrize("multi_line", [False, True])
def test_outer_array_is_stripped(spark, tmp_path, multi_line):
    (tmp_path / "a.json").write_text('[{"id":1},{"id":2}]')
    (tmp_path / "b.json").write_text('{"id":3}')
    (tmp_path / "c.json").write_text('[{"id":4},\n {"id":5}]' if multi_line else '[{"id":4}]\n{"id":5}')
    assert [r["id"] for r in parsed(read_json_records(spark, str(tmp_path), multi_line=multi_line))] == [1, 2, 3, 4, 5]


def test_empty_outer_array_has_no_records(spark, tmp_path):
    (tmp_path / "a.json").write_text('[]\n{"id":1}')
    assert texts(read_json_records(spark, str(tmp_path))) == ['{"id":1}']


@pytest.mark.parametrize("multi_line", [False, True])
def test_keys_keep_null_and_missing_apart(spark, tmp_path, multi_line):
    (tmp_path / "a.json").write_text('[{"id":1,"name":null,"x":{"a":[1,null]},"more":0},{"id":2.5}]')
    (tmp_path / "b.json").write_text('{"id":3}')
    rows = texts(read_json_records(spark, str(tmp_path), multi_line=multi_line, keys=["id", "name", "x"]))
    assert rows == ['{"id":1,"name":null,"x":{"a":[1,null]}}', '{"id":2.5}', '{"id":3}']


def test_array_beyond_one_value(spark, tmp_path):
    """150 MB in one line: too large for a variant, read record by record in batch and stream."""
    record = '{"id":%d,"name":null,"more":"' + "x" * 990 + '"}'
    landing = tmp_path / "landing"
    (landing / "run=1").mkdir(parents=True)
    with open(landing / "run=1" / "a.json", "w") as f:
        f.write("[" + ",".join(record % i for i in range(150_000)) + "]")
    got = read_json_records(spark, str(landing), keys=["id", "name", "absent"])
    told = got.select(F.to_json("json_data").alias("t")).agg(F.count("*"), F.countDistinct("t"), F.min("t")).first()
    assert tuple(told) == (150_000, 150_000, '{"id":0,"name":null}')
    ingest_stream(spark, str(landing), str(tmp_path / "staging"), str(tmp_path / "checkpoint"), keys=["id", "name"]).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "staging")).count() == 150_000


def test_malformed_record_is_an_error(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id":1}\n{"id":2,\n{"id":3}')
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE"):
        read_json_records(spark, str(tmp_path)).collect()
    assert [r["id"] for r in parsed(read_json_records(spark, str(tmp_path), malformed="DROPMALFORMED"))] == [1, 3]


def test_path_pattern(spark, tmp_path):
    for name, i in (("cohort.json", 1), ("entity.json", 2), ("old_entity.json", 3)):
        (tmp_path / name).write_text(json.dumps({"id": i}))
    found = read_json_records(spark, str(tmp_path), pattern=".*entity.json")
    assert [r["id"] for r in parsed(found)] == [2, 3]


LITERALS = [
    {"id": 1, "name": "it's", "flag": True, "none": None, "list": [{"a": 1}, {"b": 2}]},
    {"id": 2, "name": 'both \' and "', "nested": {"x": {}}},
    {"id": 3, "name": "non\xa0breaking, né, \\ \n \t", "f": 1.5},
    {"id": 4},
]


def literal_file(path, rows):
    path.write_text(",".join(str(r) for r in rows), encoding="utf-8")


@pytest.mark.parametrize("whole_files", [False, True])
@pytest.mark.parametrize("count", [1, 2, 3, 4])
def test_literals(spark, tmp_path, whole_files, count):
    literal_file(tmp_path / "a.json", LITERALS[:count])
    literal_file(tmp_path / "b.json", [{"id": 9, "name": "alone"}])
    (tmp_path / "empty.json").write_text("")
    assert parsed(read_literal_records(spark, str(tmp_path), whole_files)) == LITERALS[:count] + [{"id": 9, "name": "alone"}]


@pytest.mark.parametrize("whole_files", [False, True])
def test_separator_inside_a_string(spark, tmp_path, whole_files):
    rows = [{"id": 1, "s": "a},{b"}, {"id": 2, "s": "},{},{"}, {"id": 3, "s": ",},{"}, {"id": 4, "s": " },{ "}]
    literal_file(tmp_path / "a.json", rows)
    assert parsed(read_literal_records(spark, str(tmp_path), whole_files)) == rows


TEXT = st.text(st.sampled_from(list("ab{}[],:'\"\\ \n\t\xa0é\u2028")) | st.characters(codec="utf-8", exclude_categories=["Cs"]), max_size=12)
VALUE = st.recursive(
    st.none() | st.booleans() | st.integers(-(2**63), 2**63 - 1) | TEXT | st.just("},{"),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(TEXT, inner, max_size=3),
    max_leaves=6,
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(VALUE, max_size=20), whole_files=st.booleans())
def test_any_literal(spark, tmp_path_factory, values, whole_files):
    folder = tmp_path_factory.mktemp("literals")
    rows = [{"id": i, "value": value} for i, value in enumerate(values)]
    literal_file(folder / "a.json", rows)
    assert parsed(read_literal_records(spark, str(folder), whole_files)) == rows


@pytest.mark.parametrize("size", [17, 64, 100, 333])
def test_literal_file_in_many_splits(spark, tmp_path, size):
    rows = [{"id": i, "name": "x" * (i % 23), "list": [{"n": i}, {"n": i + 1}]} for i in range(200)]
    literal_file(tmp_path / "a.json", rows)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        df = read_literal_records(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 10
        assert parsed(df) == rows
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize(
    "text, place, problem",
    [
        ("{'id': 1},{'id': oops},{'id': 2}", 10, "oops"),
        ("{'id': 1},{'id': 2, 'x': nan, 'y': -inf}", 10, "inf, nan"),
        ("{'id': 1e999}", 0, "no record of JSON"),
        ("{'id': 1},{'s': 'no end},{'id': 2}", 10, "no end"),
        ("{'id': 1},{'s': 'no end},{}", 10, "no end"),
        ("{'id': 1},['a']", 0, "no"),
        ("{'id': {1, 2}}", 0, "no record of JSON"),
    ],
)
def test_unreadable_literal_is_named(spark, tmp_path, text, place, problem):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(PythonException, match=rf"a[.]json, byte {place} of the split at 0: .*{problem}"):
        read_literal_records(spark, str(tmp_path)).collect()
    rows = read_literal_records(spark, str(tmp_path), malformed="QUARANTINE").collect()
    bad = [(r.bad_start, r.bad_offset) for r in rows if r.bad_text is not None]
    assert bad == [(0, place)] and all((r.json_data is None) == (r.bad_text is not None) for r in rows)


def test_one_bad_literal_among_many_is_found_at_once(spark, tmp_path):
    rows = [str({"id": i, "name": "x" * 20, "about": {"s": "a},{b"}}) for i in range(100_000)]
    rows[50_000] = "{'id': 50000, 'name': 'it's'}"
    (tmp_path / "a.json").write_text(",".join(rows))
    begun = time.time()
    with pytest.raises(PythonException, match="a[.]json, byte"):
        read_literal_records(spark, str(tmp_path)).collect()
    assert time.time() - begun < 20
    got = read_literal_records(spark, str(tmp_path), malformed="QUARANTINE")
    assert got.where("json_data is not null").count() + got.where("bad_text is not null").count() <= 100_000
    assert got.where("bad_text like '%50000%'").count() == 1


@pytest.mark.parametrize("size", [16, 50, 131, 1000])
def test_separators_in_strings_where_splits_meet(spark, tmp_path, size):
    tricky = ["},{", "'},{'", '"},{"', "\\},{", "it's },{ \"", "},{" * 30, "x" * 40 + "},{'", "é},{\n"]
    rows = [{"id": i, "s": tricky[i % len(tricky)] * (1 + i % 3), "d": {"k": tricky[-i % len(tricky)]}} for i in range(120)]
    literal_file(tmp_path / "a.json", rows)
    literal_file(tmp_path / "b.json", rows[:3])
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        assert parsed(read_literal_records(spark, str(tmp_path))) == sorted(rows + rows[:3], key=lambda r: r["id"])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_project_keys_keeps_types(spark):
    record = F.parse_json(F.lit('{"id":1,"name":"a","types":[{"x":[1,"2"]}],"height":7,"species":null}'))
    assert texts(spark.range(1).select(project_keys(record).alias("json_data"))) == [
        '{"id":1,"name":"a","species":null,"types":[{"x":[1,"2"]}]}'
    ]


def test_land_records(spark, tmp_path):
    rows = spark.range(3).select(F.to_variant_object(F.struct("id")).alias("json_data"))
    path = land_records(rows, str(tmp_path), "entity", "1")
    assert path == landing_path(str(tmp_path), "entity", "1")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        land_records(rows, str(tmp_path), "entity", "1")
    land_records(spark.range(5), str(tmp_path), "entity", "1", replace=True)
    assert len(texts(read_json_records(spark, path))) == 5


def test_listing(spark):
    payload = '{"results":[{"url":"https://x/api/entity/1/"},{"url":"https://x/api/entity/2/"}]}'
    listing = spark.createDataFrame([(payload,), ('{"results":[]}',), (None,)], "payload string")
    assert sorted(r.endpoint for r in resource_catalog(listing).collect()) == ["1", "2"]


def urls(spark, url):
    return spark.createDataFrame([(url,)], "url string")


@pytest.mark.parametrize(
    "url, want", [("https://x/type/7/", 7), ("https://x/type/7", None), ("alone", None), ("", None), (None, None), ("a/12/q=1", 12)]
)
def test_tolerant_id(spark, url, want):
    assert urls(spark, url).select(id_from_url("url", strict=False)).first()[0] == want


def test_strict_id(spark):
    assert urls(spark, "https://x/type/7/").select(id_from_url("url")).first()[0] == 7
    assert urls(spark, None).select(id_from_url("url")).first()[0] is None
    for bad in ("https://x/type/7", "alone"):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT|INVALID_ARRAY_INDEX"):
            urls(spark, bad).select(id_from_url("url")).collect()


def test_endpoint(spark):
    assert urls(spark, "https://x/api/v2/entity/").select(endpoint_from_url("url")).first()[0] == "entity"
    assert urls(spark, "x").select(endpoint_from_url("url")).first()[0] is None


def test_paths(spark):
    text = '{"a":{"b":"5"},"n":3}'
    df = spark.range(1).select(F.parse_json(F.lit(text)).alias("v"), F.lit(text).alias("t"))
    row = df.select(
        json_path("v", "$.n", "bigint").alias("n"),
        json_path("v", "$.a.x.y", "string").alias("missing"),
        json_path("v", "$.a", "bigint", strict=False).alias("wrong"),
        json_text_path("t", "$.a.b", "bigint").alias("text"),
        json_text_path("t", "$.a", "bigint", strict=False).alias("wrong_text"),
    ).first()
    assert tuple(row) == (3, None, None, 5, None)
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        df.select(json_path("v", "$.a", "bigint")).collect()


def test_parsers_need_no_package_on_the_executors(tmp_path):
    """They are pickled by value: a Python process without this package on its path can run them."""
    from pyspark import cloudpickle

    from siltbed.sources.records import _literal_parser, _whole_file_parser

    (tmp_path / "parsers").write_bytes(cloudpickle.dumps((_literal_parser(), _whole_file_parser())))
    code = (
        "import pickle, sys, pandas as pd\n"
        f"first, whole = pickle.load(open({str(tmp_path / 'parsers')!r}, 'rb'))\n"
        "frame = pd.DataFrame({'path': ['p'], 'start': [0], 'value': [\"{'id': None}\"]})\n"
        "print([list(f['text']) for parse in (first, whole) for f in parse([frame])])\n"
        "assert 'siltbed' not in sys.modules\n"
    )
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert run.stdout.strip() == """[['{"id": null}'], ['{"id": null}']]""", run.stderr


@pytest.mark.parametrize("variant", [False, True])
def test_landed_records_take_little_room(spark, tmp_path, variant):
    rows = spark.range(0, 20000, 1, 1).selectExpr("id", "'https://api.example.org/v2/type/7/' as url", "array('a', null) as types")
    written = rows.select(F.to_variant_object(F.struct("*")).alias("json_data")) if variant else rows
    path = land_records(written, str(tmp_path), "entity", "1")
    size = sum(f.stat().st_size for f in Path(path).iterdir() if f.name.startswith("part-"))
    assert size < 20000 * 40 / 4  # the URL alone is 34 bytes
    got = read_json_records(spark, path).select(*(F.variant_get("json_data", f"$.{c}", t).alias(c) for c, t in rows.dtypes))
    assert got.exceptAll(rows).count() == 0 and rows.exceptAll(got).count() == 0


def test_run_order_of_a_number_needs_no_patterns(spark, capsys):
    runs = ["7", "0007", "0", "12345678901234567890", "123456789012345678901234", "0" * 25 + "5", "2024-05-01", "measures-1", "٣"]
    df = spark.createDataFrame([(f"file:/a/run={r}/entity/x.json", r) for r in runs], "path string, run string")
    padded = F.regexp_replace(F.regexp_replace("run", "([0-9]+)", "00000000000000000000$1"), "0*([0-9]{20})", "$1")
    for row in df.select(run_order("path").alias("got"), padded.alias("want")).collect():
        assert row.got == row.want
    df.select(run_order("path")).explain()
    assert "lpad(" in capsys.readouterr().out
    assert df.select(run_order(F.lit("file:/a/b/x.json"))).first()[0] is None


def test_a_task_lands_many_records_in_several_files(spark, tmp_path):
    path = land_records(spark.range(0, 250000, 1, 1), str(tmp_path), "entity", "1")
    assert len([f for f in Path(path).iterdir() if f.name.startswith("part-")]) == 3
    assert read_json_records(spark, path).count() == 250000
