"""Insert-if-new for dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def new_dimension_rows(candidates: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Distinct candidates whose key is NOT IN the existing keys, with SQL's NULL rules.

    A NULL among the existing keys lets nothing through; a NULL candidate passes only when nothing exists.
    Spark plans a literal NOT IN as a null-aware anti join that broadcasts the existing keys whatever
    their size. Here one scalar says how the existing keys look, and the rest is a plain anti join that
    shuffles when both sides are large.
    """
    keys = existing.select(F.col(key).alias(key))
    state = keys.agg(
        F.when(F.count("*") == 0, "empty").when(F.count("*") > F.count(key), "has_null").otherwise("plain")
    ).scalar()
    passes = (state == "empty") | ((state == "plain") & F.col(key).isNotNull())
    return candidates.distinct().where(passes).join(keys, key, "left_anti")


def latest_per_key(df: DataFrame, key: str | list[str], order: str) -> DataFrame:
    """The row with the largest ``order`` of each ``key``, one column or several: one row per key, whatever was landed again.

    Rows are reduced before they are shuffled, so a key landed very often is no hot key. Of equally late rows the largest
    by all columns stays. A NULL order comes first.
    """
    whole = F.struct(F.col(order).alias("__order"), *df.columns)
    keys = [key] if isinstance(key, str) else key
    latest = df.groupBy(*(F.col(k).alias(f"__key{i}") for i, k in enumerate(keys))).agg(F.max(whole).alias("__row"))
    return latest.select(*(F.col(f"__row.{c}").alias(c) for c in df.columns))


def latest_rows(df: DataFrame, key: str, order: str, of: DataFrame | None = None, of_key: str | None = None) -> DataFrame:
    """All rows of each ``key`` that have its largest ``order``, without ``order``: what its latest run holds.

    With ``of``, a table of the records themselves, its ``of_key`` tells the largest order, so a key whose latest record holds no row here
    has none left. Only keys and orders of ``of`` are grouped, and the rows are the left side of a join.
    """
    last = (df if of is None else of).groupBy(F.col(of_key or key).alias("__key")).agg(F.max(order).alias("__last"))
    same = F.col(key).eqNullSafe(F.col("__key")) & F.col(order).eqNullSafe(F.col("__last"))
    return df.join(last, same, "left_semi").drop(order)
