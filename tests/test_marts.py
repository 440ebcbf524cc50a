import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window, functions as F

from siltbed.plans import marts


def rank_gap_window(counts, key):
    """The same as one window over all rows, which needs every row in one partition: the check for ``rank_gap``."""
    order = Window.orderBy(F.desc_nulls_first("n"), F.asc_nulls_last(key))
    above, below = F.lag("n").over(order) - F.col("n"), F.col("n") - F.lead("n").over(order)
    zero = F.lit(0).cast("bigint")
    out = counts.select(key, "n", F.coalesce(above, zero).alias("up"), F.coalesce(below, zero).alias("down"))
    return out.orderBy(F.desc_nulls_first("n"), F.asc_nulls_last(key))


def rows(df):
    return [tuple(r) for r in df.collect()]


def counts(spark, pairs, kind="string"):
    return spark.createDataFrame(pairs, f"key {kind}, n long")


def test_gaps_show_at_the_edges_of_a_tie(spark):
    df = counts(spark, [("d", 1), ("b", 5), ("a", 5), ("c", 5), ("e", 9)])
    assert rows(marts.rank_gap(df, "key")) == [("e", 9, 0, 4), ("a", 5, 4, 0), ("b", 5, 0, 0), ("c", 5, 0, 4), ("d", 1, 4, 0)]


def test_null_key_comes_last_in_its_tie(spark):
    df = counts(spark, [(None, 5), ("b", 5), ("a", 5), ("z", 2), ("y", 9)])
    want = [("y", 9, 0, 4), ("a", 5, 4, 0), ("b", 5, 0, 0), (None, 5, 0, 3), ("z", 2, 3, 0)]
    assert rows(marts.rank_gap(df, "key")) == want
    assert rows(rank_gap_window(df, "key")) == want


def test_no_rows(spark):
    assert rows(marts.rank_gap(counts(spark, []), "key")) == []


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.one_of(st.none(), st.integers(0, 40)), st.integers(1, 8), max_size=25))
def test_level_form_equals_window_form(spark, by_key):
    df = counts(spark, list(by_key.items()), "long")
    assert rows(marts.rank_gap(df, "key")) == rows(rank_gap_window(df, "key"))


def test_only_the_levels_meet_in_one_partition(spark):
    base = spark.range(0, 5000, 1, 8).groupBy((F.col("id") % 700).alias("key")).agg(F.count("*").alias("n"))
    df = marts.rank_gap(base, "key", ordered=False)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    single = plan.split("Exchange SinglePartition")[1]
    assert "HashAggregate(keys=[n#" in single.splitlines()[1]
    assert "ReusedExchange" in plan


@pytest.fixture
def tables(spark):
    entity = spark.createDataFrame(
        [(1, "one", "G1"), (2, "two", "G1"), (3, "three", None), (4, "one", "All cohorts")], "id long, name string, cohort string"
    )
    b = [(1, 10, 1, "p"), (2, 11, 1, "q"), (3, 10, 2, "p"), (4, 10, 3, "p"), (5, 11, 4, "q")]
    facts = [(1, 1, 1, 5), (2, 2, 1, 1), (3, 3, 1, 50), (4, 4, 1, 10), (5, 4, 2, None)]
    membership = "id long, category_id long, entity_id long, category_name string"
    return {
        "entity": entity,
        "category_a": spark.createDataFrame(b[:3], membership),
        "category_b": spark.createDataFrame(b, membership),
        "entity_measure": spark.createDataFrame(facts, "id long, entity_id long, measure_id long, value long"),
    }


def test_views(spark, tables):
    views = marts.register_marts(spark, tables)
    assert views == ["category_a_rank_gap", "category_b_rank_gap", "strength_rating", "cohort_category_totals"]
    assert rows(spark.table("category_a_rank_gap")) == [("p", 2, 0, 1), ("q", 1, 1, 0)]
    assert rows(spark.table("category_b_rank_gap")) == [("p", 3, 0, 1), ("q", 2, 1, 0)]
    assert rows(spark.table("strength_rating")) == [("three", 50), ("one", 15), ("two", 1)]
    assert spark.table("cohort_category_totals").columns == ["cohort", "category", "quantity"]
    marts.register_marts(spark, tables)


def test_rating_by_id(tables):
    by_id = marts.strength_rating(tables["entity"], "id", tables["entity_measure"], "entity_id", "value", key="id")
    assert rows(by_id) == [(3, "three", 50), (4, "one", 10), (1, "one", 5), (2, "two", 1)]


def test_rating_without_values_comes_first(spark):
    entity = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    facts = spark.createDataFrame([(1, 3), (2, None)], "eid long, value long")
    assert rows(marts.strength_rating(entity, "id", facts, "eid", "value")) == [("b", None), ("a", 3)]


def test_cube(tables):
    args = (tables["entity"], "id", "cohort", tables["category_b"].drop("id"), "entity_id", "category_name")
    cube = marts.cohort_category_cube(*args, flags=True)
    found = {(r.cohort, r.category_name, r.is_all_cohort, r.is_all_category_name): r.quantity for r in cube.collect()}
    assert found[("All cohorts", "All categories", 1, 1)] == 5
    # A NULL cohort and a cohort named like the label stay apart from the subtotal.
    assert found[(None, "All categories", 0, 1)] == 1
    assert found[("All cohorts", "All categories", 0, 1)] == 1
    cells = sum(n for key, n in found.items() if key[2:] == (0, 0))
    assert cells == 5 and len(found) == 10
    assert marts.cohort_category_cube(*args).columns == ["cohort", "category_name", "quantity"]
    with_distinct = marts.cohort_category_cube(*args, distinct=True).where("cohort = 'G1' and category_name = 'All categories'")
    assert rows(with_distinct) == [("G1", "All categories", 3, 2)]


def test_cube_fanout(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 1), (None, 3)], "key string, id long")
    found = {r.key: (r.quantity, r.n_distinct) for r in marts.cube_fanout(df, "key", "id").collect()}
    assert found == {"a": (3, 2), "b": (1, 1), None: (1, 1), "All": (5, 3)}


def test_bitmaps_count_distinct_ids_of_any_size(spark):
    from siltbed.plans.marts import cohort_category_cube

    ids = [1, 2, 32768, 32769, 65536, 65537, 2**40, 2**40 + 1, 0, -1, -32768, -40000]
    entities = spark.createDataFrame([(i, f"c{i % 2}" if i % 3 else None) for i in ids] + [(1, "c1"), (None, "c1")], "id long, cohort string")
    members = spark.createDataFrame([(i, f"k{j}") for i in ids for j in range(abs(i) % 4)] + [(1, "k0"), (7, "k0"), (None, "k0")], "key long, category string")
    how = (entities, "id", "cohort", members, "key", "category")
    want = cohort_category_cube(*how, distinct=True)
    got = cohort_category_cube(*how, distinct=True, bitmaps=True)
    assert got.schema.names == want.schema.names and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
