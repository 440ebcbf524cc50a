"""The four marts: two rank-gap reports, a rating, and labelled cube totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from siltbed.operators.dimensions import latest_rows
from siltbed.operators.totals import joined_counts, joined_rows, joined_sums

HIGHER = "change_from_next_higher"
LOWER = "change_from_next_lower"


def _gap(of: Column) -> Column:
    return F.coalesce(of, F.lit(0).cast("bigint"))


def _ordered(df: DataFrame, key: str, n: str) -> DataFrame:
    return df.orderBy(F.desc_nulls_first(n), F.asc_nulls_last(key))


def rank_gap(counts: DataFrame, key: str, n: str = "n", ordered: bool = True) -> DataFrame:
    """Distance of each count to the next higher and the next lower row, in the order (n desc, key asc).

    Inside a group of equal counts all distances are 0; only its first key sees the level above and its
    last key the level below. So the ordering runs over the distinct counts alone. For N counted
    rows there are at most sqrt(2N) of those, which bounds the one partition the window needs: a million
    million rows have fewer than 1.5 million levels. The gaps then return to the rows by key, and
    each key is one row, so no count level that most keys share can become hot.
    """
    levels = counts.groupBy(n).agg(
        F.min(key).alias("first"), F.max(key).alias("last"), F.max(F.col(key).isNull()).alias("has_null")
    )
    down = Window.orderBy(F.desc_nulls_first(n))
    levels = levels.select(
        "first",
        # NULL orders after every other key, so where there is one it is the last.
        F.when(~F.col("has_null"), F.col("last")).alias("last"),
        _gap(F.lag(n).over(down) - F.col(n)).alias("up"),
        _gap(F.col(n) - F.lead(n).over(down)).alias("down"),
    )
    zero = F.lit(0).cast("bigint")
    edge = F.explode(
        F.array(
            F.struct(F.col("first").alias("key"), F.col("up").alias("up"), zero.alias("down")),
            F.struct(F.col("last").alias("key"), zero.alias("up"), F.col("down").alias("down")),
        )
    ).alias("edge")
    edges = (
        levels.select(edge)
        .groupBy(F.col("edge.key").alias("__edge"))
        .agg(F.sum("edge.up").alias("up"), F.sum("edge.down").alias("down"))
    )
    out = counts.join(edges, F.col(key).eqNullSafe(F.col("__edge")), "left").select(
        key, n, _gap(F.col("up")).alias(HIGHER), _gap(F.col("down")).alias(LOWER)
    )
    return _ordered(out, key, n) if ordered else out


def category_rank_gap(
    entities: DataFrame,
    entity_key: str,
    members: DataFrame,
    member_key: str,
    category: str,
    ordered: bool = True,
    dedup: bool = False,
) -> DataFrame:
    """Categories by number of entities, with the gaps to their neighbours."""
    counts = joined_counts(entities, entity_key, members, member_key, [category], dedup=dedup)
    return rank_gap(counts, category, ordered=ordered)


def strength_rating(
    entities: DataFrame,
    entity_key: str,
    facts: DataFrame,
    fact_key: str,
    value: str,
    name: str = "name",
    key: str = "name",
    ordered: bool = True,
    dedup: bool = False,
) -> DataFrame:
    """Entities by the sum of their measures.

    Entities of one name are one row; with ``key="id"`` each id is a row of its own.
    """
    by = [name] if key == "name" else [entity_key, name]
    out = joined_sums(entities, entity_key, facts, fact_key, value, by, total="strength", dedup=dedup)
    if not ordered:
        return out
    return out.orderBy(F.desc_nulls_first("strength"), *[F.asc_nulls_last(c) for c in by[::-1]])


def labelled_cube(
    counts: DataFrame,
    keys: list[str],
    labels: list[str],
    n: str = "n",
    quantity: str = "quantity",
    flags: bool = False,
    distinct: str | None = None,
) -> DataFrame:
    """Totals over all subsets of the keys, of counts that are already grouped by them.

    A subtotal row has a label in place of its key. ``flags`` adds the grouping flags, which keep a key that
    reads like a label, and a NULL key, apart from the subtotal. Only the grouped counts are expanded into
    the grouping sets, not the rows behind them. With ``distinct``, a column the counts are grouped by as
    well, ``n_distinct`` tells how many of its values are behind each total.
    """
    flag = {key: f"__all_{key}" for key in keys}
    totals = [F.sum(n).alias("__n")] + [F.grouping(key).cast("int").alias(flag[key]) for key in keys]
    if distinct:
        totals.append(F.countDistinct(distinct).alias("n_distinct"))
    columns = [
        F.when(F.col(flag[key]) == 1, F.lit(label)).otherwise(F.col(key).cast("string")).alias(key)
        for key, label in zip(keys, labels)
    ]
    columns.append(F.col("__n").alias(quantity))
    if distinct:
        columns.append(F.col("n_distinct"))
    if flags:
        columns += [F.col(flag[key]).alias(f"is_all_{key}") for key in keys]
    return counts.cube(*keys).agg(*totals).select(*columns)


def distinct_cube(rows: DataFrame, keys: list[str], labels: list[str], id_: str, n: str = "n", quantity: str = "quantity") -> DataFrame:
    """Totals of ``n`` over all subsets of the keys with the exact number of distinct ids behind each total, by bitmaps that merge.

    Ids (whole numbers) become bits: a group has one bitmap for each 32,768 consecutive ids it has any of. A subtotal is the union of its
    groups' bitmaps, so the grouping sets expand bitmaps instead of a row for each id and group, and rows are reduced to bitmaps before they
    are shuffled. It pays where ids are many to a group; a group with few ids in a range still moves that range's 4 KB.
    """
    bit, bucket = F.bitmap_bit_position(id_), F.bitmap_bucket_number(id_).alias("__bucket")
    maps = rows.groupBy(*keys, bucket).agg(F.sum(n).alias("__n"), F.bitmap_construct_agg(bit).alias("__ids"), F.count(id_).alias("__some"))
    flag = {key: f"__all_{key}" for key in keys}
    sets = [[k for i, k in enumerate(keys) if not mask >> i & 1] for mask in range(1 << len(keys))]
    merged = maps.groupingSets([[*map(F.col, s), F.col("__bucket")] for s in sets], *keys, "__bucket").agg(
        F.sum("__n").alias("__n"),
        F.when(F.sum("__some") > 0, F.bitmap_count(F.bitmap_or_agg("__ids"))).otherwise(0).alias("__distinct"),
        *(F.grouping(key).cast("int").alias(flag[key]) for key in keys),
    )
    totals = merged.groupBy(*keys, *flag.values()).agg(F.sum("__n").alias(quantity), F.sum("__distinct").alias("n_distinct"))
    named = [
        F.when(F.col(flag[key]) == 1, F.lit(label)).otherwise(F.col(key).cast("string")).alias(key) for key, label in zip(keys, labels, strict=True)
    ]
    return totals.select(*named, quantity, "n_distinct")


def cohort_category_cube(
    entities: DataFrame,
    entity_key: str,
    cohort: str,
    members: DataFrame,
    member_key: str,
    category: str,
    labels: tuple[str, str] = ("All cohorts", "All categories"),
    flags: bool = False,
    distinct: bool = False,
    dedup: bool = False,
    bitmaps: bool = False,
) -> DataFrame:
    """Memberships per cohort and category, with labelled totals.

    A total over categories counts memberships: an entity in two categories counts twice. ``distinct``
    adds the number of entities; ``bitmaps`` counts them by ``distinct_cube``, for whole-number keys and without ``flags`` and ``dedup``.
    """
    if distinct and bitmaps:
        rows = joined_rows(entities, entity_key, members, member_key, [cohort, category], "__id")
        return distinct_cube(rows, [cohort, category], list(labels), "__id")
    by = [cohort, category] + ([entity_key] if distinct else [])
    counts = joined_counts(entities, entity_key, members, member_key, by, dedup=dedup)
    return labelled_cube(
        counts, [cohort, category], list(labels), flags=flags, distinct=entity_key if distinct else None
    )


def cube_fanout(df: DataFrame, key: str, id_: str, label: str = "All") -> DataFrame:
    """Rows and distinct ids per key, with a total: how far a total of memberships exceeds its entities.

    Rows are counted per (key, id) first, so the distinct count shuffles each pair once.
    """
    pairs = df.groupBy(key, id_).agg(F.count(id_).alias("n"))
    return labelled_cube(pairs, [key], [label], distinct=id_)


def marts(
    entities: DataFrame,
    category_a: DataFrame,
    category_b: DataFrame,
    facts: DataFrame,
    labels: tuple[str, str] = ("All cohorts", "All categories"),
    dedup: bool = False,
    distinct: bool = False,
    key: str = "name",
    flags: bool = False,
    ordered: bool = True,
    latest: str | None = None,
) -> dict[str, DataFrame]:
    """The four marts over the storage tables, by view name.

    ``dedup`` counts repeated memberships and facts once, ``distinct`` counts each entity once per group of the totals, ``key="id"``
    rates entities that share a name apart, ``flags`` adds the grouping flags of the totals, ``ordered`` sorts.
    ``latest``, the column that orders the runs, reads each entity, its memberships and its facts as its latest run has them.
    """
    if latest:
        records = entities
        entities = latest_rows(entities, "id", latest)
        category_a, category_b, facts = (latest_rows(t, "entity_id", latest, records, "id") for t in (category_a, category_b, facts))
    members = {"category_a_rank_gap": category_a, "category_b_rank_gap": category_b}
    out = {
        name: category_rank_gap(entities, "id", table.drop("id"), "entity_id", "category_name", ordered=ordered, dedup=dedup)
        for name, table in members.items()
    }
    out["strength_rating"] = strength_rating(
        entities, "id", facts.drop("id"), "entity_id", "value", key=key, ordered=ordered, dedup=dedup
    )
    out["cohort_category_totals"] = cohort_category_cube(
        entities, "id", "cohort", category_b.drop("id"), "entity_id", "category_name", labels, flags, distinct, dedup
    ).withColumnsRenamed({"category_name": "category"})
    return out


def register_marts(spark: SparkSession, tables: dict[str, DataFrame], **options) -> list[str]:
    """Create or replace the four marts as temporary views; they stay lazy. ``options`` are those of ``marts``.

    For cohorts that came after their entities pass ``loads.refreshed_entities`` as ``tables["entity"]``; for records landed in
    several runs, tables of ``Warehouse.read(..., landed=True)`` and ``latest="landed"``, with ``latest=True`` on the loads.
    """
    views = marts(tables["entity"], tables["category_a"], tables["category_b"], tables["entity_measure"], **options)
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return list(views)
