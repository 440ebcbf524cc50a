import pytest
from pyspark.sql import functions as F

from siltbed.operators.dimensions import new_dimension_rows
from siltbed.operators.flatten import flatten_array, pick_localised
from siltbed.operators.keys import assign_surrogate_ids, check_reference, check_unique
from siltbed.operators.lookups import lookup_chain, refresh_lookup
from siltbed.operators.totals import joined_counts, joined_sums


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_flatten_drops_parents_without_elements(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None), (4, [None])], "id long, xs array<string>")
    assert rows(flatten_array(df, "xs", "x", ["id"])) == [(1, "a"), (1, "b"), (4, None)]


def test_localised(spark):
    names = "array<struct<name string, language struct<name string>>>"
    df = spark.createDataFrame(
        [
            (1, [("one", ("en",)), ("un", ("fr",))]),
            (2, [("two", ("en",)), ("too", ("en",))]),
            (3, [("trois", ("fr",))]),
            (4, [("four", (None,))]),
            (5, None),
        ],
        f"id long, names {names}",
    )
    assert rows(pick_localised(df, "names", "en", "label", ["id"])) == [(1, "one"), (2, "too"), (2, "two")]


def test_lookup_chain_equals_two_left_joins(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "x"), (4, None), (5, "c")], "id long, key string")
    members = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), ("c", 9), (None, 1)], "key string, link long")
    labels = spark.createDataFrame([(1, "A"), (2, "B"), (2, "BB"), (3, "C"), (None, "N")], "link long, label string")
    plain = df.join(members, "key", "left").join(labels, "link", "left").select("id", "label")
    assert rows(lookup_chain(df, "key", members, labels, "link").select("id", "label")) == rows(plain)


def test_refresh_leaves_resolved_rows_alone(spark):
    df = spark.createDataFrame([(1, "a", "A"), (2, "b", None), (3, "x", None)], "id long, k string, label string")
    lookup = spark.createDataFrame([("a", "other"), ("a", "third"), ("b", "B")], "k string, label string")
    assert rows(refresh_lookup(df, "k", "label", lookup)) == [(1, "a", "A"), (2, "b", "B"), (3, "x", None)]


@pytest.mark.parametrize("existing", [[], [1], [1, None], [None], [1, 1, 7]])
def test_not_in_equals_sql(spark, existing):
    """NULL rules of NOT IN, against Spark's own."""
    candidates = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (2, "c"), (None, "n")], "id long, name string")
    known = spark.createDataFrame([(i, "x") for i in existing], "id long, name string")
    candidates.createOrReplaceTempView("candidates")
    known.createOrReplaceTempView("known")
    want = spark.sql("select distinct id, name from candidates where id not in (select id from known)")
    assert rows(new_dimension_rows(candidates, known, "id")) == rows(want)


def test_not_in_does_not_broadcast_by_force(spark):
    candidates = spark.range(10).withColumn("name", F.lit("x"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = new_dimension_rows(candidates, spark.range(100), "id")
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("start", [0, 41])
def test_surrogate_ids(spark, start):
    df = spark.range(0, 1000, 1, 7).where("id % 5 <> 0").withColumnRenamed("id", "n")
    ids = assign_surrogate_ids(df, start)
    assert ids.columns == ["id", "n"]
    first, second = rows(ids), rows(ids)
    assert first == second
    assert sorted(i for i, _ in first) == list(range(start + 1, start + 801))


def test_surrogate_ids_of_nothing(spark):
    assert assign_surrogate_ids(spark.range(0)).count() == 0


def test_checks(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, None), (2, None)], "a long, b long")
    assert rows(check_unique(df, ["a", "b"])) == [(1, 1, 2), (2, None, 2)]
    parent = spark.createDataFrame([(1,), (1,), (None,)], "id long")
    assert rows(check_reference(df, "b", parent, "id")) == [(2, 1)]
    assert rows(check_reference(df, "a", parent, "id")) == [(2, 2)]


@pytest.fixture
def bags(spark):
    entities = spark.createDataFrame(
        [(1, "a", "x"), (1, "a", "x"), (2, "b", "x"), (3, "a", None), (None, "n", "x")], "id long, name string, cohort string"
    )
    members = spark.createDataFrame(
        [(1, "p", 5), (1, "p", 7), (2, "q", None), (3, None, 2), (4, "p", 1), (None, "p", 9)], "eid long, cat string, value long"
    )
    return entities, members


@pytest.mark.parametrize("by", [["cat"], ["cohort"], ["cohort", "cat"], ["name", "cat"]])
def test_joined_counts_equal_the_join(bags, by):
    entities, members = bags
    plain = entities.join(members, entities.id == members.eid).groupBy(*by).agg(F.count("id"))
    assert rows(joined_counts(entities, "id", members, "eid", by)) == rows(plain)


@pytest.mark.parametrize("by", [["name"], ["id", "name"], ["cohort"]])
def test_joined_sums_equal_the_join(bags, by):
    entities, members = bags
    plain = entities.join(members, entities.id == members.eid).groupBy(*by).agg(F.sum("value"))
    assert rows(joined_sums(entities, "id", members, "eid", "value", by)) == rows(plain)


def test_dedup(bags):
    entities, members = bags
    once = joined_counts(entities, "id", members, "eid", ["cat"], dedup=True)
    assert rows(once) == [("p", 1), ("q", 1), (None, 1)]
    twice = members.union(members)
    assert rows(joined_sums(entities, "id", twice, "eid", "value", ["name"], dedup=True)) == [("a", 14), ("b", None)]
