"""Left lookups of a large input in (usually) small dimensions.

Nothing is broadcast by hint. A dimension below ``spark.sql.autoBroadcastJoinThreshold`` is broadcast
by Spark after its own size check; a larger one is sort-merge joined. The large input is always the left
side of a left (or inner) join followed by a projection, the shape in which adaptive execution may split a
partition that holds a hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def lookup_table(members: DataFrame, labels: DataFrame, link: str) -> DataFrame:
    """``members`` with the columns of ``labels``; members without a label are kept."""
    return members.join(labels, link, "left").drop(link)


def lookup_chain(df: DataFrame, key: str, members: DataFrame, labels: DataFrame, link: str) -> DataFrame:
    """``df`` left-joined to ``members`` on ``key`` and on to ``labels`` on ``link``.

    The two dimensions are joined to each other first. Both joins are left joins and the second one
    only looks at ``members``, so the result is the same while the large input is moved once, not twice.
    """
    return df.join(lookup_table(members, labels, link), key, "left")


def fact_to_dimension(facts: DataFrame, dimension: DataFrame, on: str) -> DataFrame:
    """Inner join on the dimension's name; facts without a dimension row are dropped."""
    return facts.join(dimension, on).drop(on)


def left_facts(facts: DataFrame, dimension: DataFrame, on: str, found: str) -> DataFrame:
    """``facts`` with the columns of ``dimension``, and whether a row of it was there; facts without a name do not move.

    Where the dimension has a name more than once, its facts come as often, as in ``fact_to_dimension``.
    """
    named = facts.where(F.col(on).isNotNull()).join(dimension.withColumn(found, F.lit(True)), on, "left")
    named = named.withColumn(found, F.coalesce(found, F.lit(False)))
    return named.unionByName(facts.where(F.col(on).isNull()).withColumn(found, F.lit(False)), allowMissingColumns=True)


def refresh_lookup(df: DataFrame, key: str, label: str, lookup: DataFrame) -> DataFrame:
    """Resolve ``label`` again for rows stored before their lookup row arrived.

    Rows that already have a label pass by untouched, only the others are joined.
    ``lookup`` has the columns (``key``, ``label``).
    """
    late = df.where(F.col(label).isNull()).drop(label).join(lookup.select(key, label), key, "left")
    return df.where(F.col(label).isNotNull()).unionByName(late.select(*df.columns))
