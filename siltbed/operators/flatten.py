"""Flattening of nested arrays. Narrow: no shuffle, one output row per element."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def flatten_array(df: DataFrame, array: Column | str, element: str, keep: list) -> DataFrame:
    """One row per array element next to the ``keep`` columns; parents without elements disappear.

    The array is projected first and exploded second. In that order the optimiser pushes the typed
    path into the scan, so a shredded variant column is read for these paths only.
    """
    array = F.col(array) if isinstance(array, str) else array
    return df.select(*keep, array.alias(element)).withColumn(element, F.explode(element))


def pick_localised(df: DataFrame, names: Column | str, language: str, label: str, keep: list) -> DataFrame:
    """One row per name in ``language``; several names in it give several rows."""
    named = flatten_array(df, names, "__named", keep).where(F.col("__named.language.name") == language)
    return named.withColumn(label, F.col("__named.name")).drop("__named")
