"""Counts and sums over a join, aggregated before the join where that makes the input smaller.

A join of two bags yields (left copies x right copies) rows per key, so counting a side per join key and multiplying
gives the same totals. Copies of an entity are one row at the join, so two hot sides never multiply row by row.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, DecimalType


def _per_key(df: DataFrame, key: str, by: list[str], *totals: Column) -> DataFrame:
    """Totals per join key and group.

    The hash beside the key groups nothing further. It keeps the aggregate's partitioning from being taken over
    by the join: only a join whose two inputs were each shuffled for it can have a skewed partition split by
    adaptive execution, and a key with very many groups still is one.
    """
    keyed = df.where(F.col(key).isNotNull()).withColumns({"__key": F.col(key), "__hash": F.xxhash64(key)})
    return keyed.groupBy("__key", "__hash", *by).agg(*totals).drop("__hash")


def _copies(df: DataFrame, key: str, by: list[str], count: str, dedup: bool) -> DataFrame:
    return _per_key(df, key, by, (F.lit(1).cast("bigint") if dedup else F.count("*")).alias(count))


def _owners(entities: DataFrame, members: DataFrame, by: list[str]) -> tuple[list[str], list[str]]:
    """The group columns of either side, by the session's rules for names. A column both sides have is ambiguous."""
    exact = entities.sparkSession.conf.get("spark.sql.caseSensitive") == "true"

    def among(name: str, columns: list[str]) -> bool:
        return name in columns if exact else name.lower() in {c.lower() for c in columns}

    both = [c for c in by if among(c, entities.columns) and among(c, members.columns)]
    if both:
        raise ValueError(f"both sides have {both}: rename or drop one")
    return [c for c in by if among(c, entities.columns)], [c for c in by if not among(c, entities.columns)]


def _times(copies: Column, subtotal: Column, kind: DataType) -> Column:
    """``copies * subtotal``, exact for decimals: Spark would cut the scale of a product this wide.

    A subtotal of an entity without copies stands as it is. Others have room for 28 digits and 999,999,999 copies; more raise an error, with or
    without ANSI mode.
    """
    if not isinstance(kind, DecimalType):
        return copies * subtotal
    wide = subtotal.cast(DecimalType(38, kind.scale))
    fits = (copies < 10**9) & (F.abs(wide) < F.lit(Decimal(10) ** (28 - kind.scale)))
    product = F.try_multiply(copies.cast(DecimalType(9, 0)), F.when(fits, wide).cast(DecimalType(28, kind.scale)))
    told = F.raise_error(F.concat(F.lit("a sum does not fit: "), copies.cast("string"), F.lit(" times "), wide.cast("string")))
    return F.when(subtotal.isNull(), None).when(copies == 1, wide).when(fits, product).otherwise(told.cast(DecimalType(38, kind.scale)))


def joined_counts(
    entities: DataFrame,
    entity_key: str,
    members: DataFrame,
    member_key: str,
    by: list[str],
    count: str = "n",
    dedup: bool = False,
) -> DataFrame:
    """``count(entity_key)`` of entities joined to members, per ``by`` (columns of either side).

    Repeated rows multiply, as they do in the join; with ``dedup`` each (key, group) counts once per side.

    Members are counted per key before the join if no group is taken from them. Otherwise (key, group) is all
    but unique in a membership table, and counting it would be one more shuffle of the large side for nothing. A hot key's
    members are then spread over many tasks by adaptive execution.
    """
    of_entities, of_members = _owners(entities, members, by)
    left = _copies(entities, entity_key, of_entities, "__left", dedup)
    if of_members and not dedup:
        right = members.select(F.col(member_key).alias("__key"), *of_members)
        total = F.sum("__left")
    else:
        right = _copies(members, member_key, of_members, "__right", dedup)
        total = F.sum(F.col("__left") * F.col("__right"))
    return left.join(right, "__key").groupBy(*by).agg(total.alias(count))


def joined_rows(
    entities: DataFrame, entity_key: str, members: DataFrame, member_key: str, by: list[str], key: str, count: str = "n"
) -> DataFrame:
    """The rows that ``joined_counts`` counts, before they are grouped: ``by``, ``key``, and ``count`` for copies of the entity."""
    of_entities, of_members = _owners(entities, members, by)
    left = _copies(entities, entity_key, of_entities, count, dedup=False)
    right = members.select(F.col(member_key).alias("__key"), *of_members)
    return left.join(right, "__key").select(*by, F.col("__key").alias(key), count)


def joined_sums(
    entities: DataFrame,
    entity_key: str,
    facts: DataFrame,
    fact_key: str,
    value: str,
    by: list[str],
    total: str = "total",
    dedup: bool = False,
) -> DataFrame:
    """``sum(value)`` of facts joined to entities, per ``by`` (columns of the entities)."""
    if dedup:
        facts = facts.dropDuplicates()
    left = _copies(entities, entity_key, by, "__left", dedup)
    right = _per_key(facts, fact_key, [], F.sum(value).alias("__sum"))
    kind = right.schema["__sum"].dataType
    out = F.sum(_times(F.col("__left"), F.col("__sum"), kind))
    if isinstance(kind, DecimalType):
        out = out.cast(kind)
    return left.join(right, "__key").groupBy(*by).agg(out.alias(total))
