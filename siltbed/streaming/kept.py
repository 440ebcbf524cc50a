"""Counts of entities per group, kept from batch to batch.

What new batches add to the counts of a join is the join of the new entities with all members, and of the new members with the
entities before. The narrow rows a join needs are kept by ranges of a hash of their key, so an update reads the new batches and, of what
came before, the ranges that hold their keys. An update is a version: its rows and counts are written first, then a marker makes it seen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from siltbed import schemas
from siltbed.operators.totals import joined_counts
from siltbed.session import drop_folder, folder_names, make_folder
from siltbed.streaming.warehouse import Warehouse, read_batches

#: Ranges of the hash of a key.
RANGES = 256


def _marker(spark: SparkSession, home: str) -> tuple[int, int, int]:
    """(version, last batch of the entities in it, last batch of the members in it) of the last update, -1 for none."""
    told = [tuple(map(int, name.split("_"))) for name in folder_names(spark, f"{home}/done")]
    return max(told, default=(-1, -1, -1))


def _range(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(RANGES)).cast("int")


def _kept_rows(spark: SparkSession, path: str, like: DataFrame, version: int, ranges: list[int]) -> DataFrame:
    fields = [*like.schema.fields, T.StructField("version", T.IntegerType()), T.StructField("range", T.IntegerType())]
    rows = spark.read.schema(T.StructType(fields)).parquet(path)
    return rows.where((F.col("version") <= version) & F.col("range").isin(ranges)).select(*like.columns)


def _ranges_of(rows: DataFrame, key: str) -> list[int]:
    return [r[0] for r in rows.select(_range(key)).distinct().collect()]


def new_counts(
    new: tuple[DataFrame, DataFrame], before: tuple[DataFrame, DataFrame], keys: tuple[str, str], by: list[str], count: str = "n"
) -> DataFrame:
    """What new entities and members add to ``joined_counts`` of those before: the joins of new with all, and of before with new."""
    (new_entities, new_members), (entities, members) = new, before
    added = joined_counts(new_entities, keys[0], members.unionByName(new_members), keys[1], by, count)
    return added.unionByName(joined_counts(entities, keys[0], new_members, keys[1], by, count)).groupBy(*by).agg(F.sum(count).alias(count))


def update_counts(spark: SparkSession, warehouse: Warehouse, table: str = "category_b", by: tuple[str, ...] = ("cohort", "category_name")) -> int:
    """Bring the kept counts of entities joined to a membership table up to the committed batches of both; returns the version.

    Nothing is written where there is no new batch. An update that was cut short is done again under its own number.
    """
    by, home = list(by), warehouse.kept(table, by)
    state = warehouse.state(spark)
    version, entities_done, members_done = _marker(spark, home)
    if (entities_done, members_done) == (state["entity"], state[table]):
        return version

    def added(name: str, done: int, columns: list[str]) -> DataFrame:
        rows = read_batches(spark, warehouse.table(name), schemas.STORAGE[name])
        return rows.where((F.col("batch_id") > done) & (F.col("batch_id") <= state[name])).select(*columns)

    keys = ("id", "entity_id")
    columns = (["id", *[c for c in by if c in schemas.STORAGE["entity"].names]], ["entity_id", *[c for c in by if c in schemas.STORAGE[table].names]])
    new = (added("entity", entities_done, columns[0]), added(table, members_done, columns[1]))
    paths = (f"{home}/entities", f"{home}/members")
    for path in (*paths, f"{home}/counts"):
        make_folder(spark, path)
    # each side meets the keys the other one adds
    before = tuple(
        _kept_rows(spark, paths[i], new[i], version, _ranges_of(new[1 - i], keys[1 - i])) for i in (0, 1)
    )
    change = new_counts(new, before, keys, by)
    kept = spark.read.schema(change.schema).parquet(f"{home}/counts/version={version}") if version >= 0 else change.limit(0)
    number = version + 1
    kept.unionByName(change).groupBy(*by).agg(F.sum("n").alias("n")).write.mode("overwrite").parquet(f"{home}/counts/version={number}")
    for rows, key, path in zip(new, keys, paths, strict=True):
        rows.withColumn("range", _range(key)).write.mode("overwrite").partitionBy("range").parquet(f"{path}/version={number}")
    make_folder(spark, f"{home}/done/{number}_{state['entity']}_{state[table]}")
    drop_folder(spark, f"{home}/counts/version={number - 2}")  # a reader may still use the one before
    return number


def kept_counts(spark: SparkSession, warehouse: Warehouse, table: str = "category_b", by: tuple[str, ...] = ("cohort", "category_name")) -> DataFrame:
    """The counts as the last update has them, with ``n``; no rows before the first one."""
    home = warehouse.kept(table, list(by))
    kinds = {f.name: f for name in (table, "entity") for f in schemas.STORAGE[name].fields}
    schema = T.StructType([*(kinds[c] for c in by), T.StructField("n", T.LongType())])
    version = _marker(spark, home)[0]
    if version < 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{home}/counts/version={version}")
