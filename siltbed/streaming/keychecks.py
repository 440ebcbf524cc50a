"""Key checks that are kept from batch to batch.

A ledger holds the keys of a table's committed batches with their counts, bucketed by key. A check groups the keys of the new batches, deals them
into the same buckets and joins them to the ledger: new keys are shuffled, what came before is only scanned. What is reported is
kept too, so a report holds all that a check of the whole table would find. A check is a version: its keys and report are written
first, then a marker makes it seen.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from siltbed import schemas
from siltbed.session import drop_folder, folder_names, make_folder
from siltbed.streaming.warehouse import Warehouse, read_batches

#: Buckets of a new ledger; an existing one keeps its own number, which its folder tells.
BUCKETS = 256
#: Versions after which a ledger is merged into one, bucket by bucket.
MERGED_AFTER = 32
_KEY = "key"


def _key(columns: list[str]) -> Column:
    """The columns as one text that is never NULL and tells apart whatever their texts tell apart (numbers, strings, dates, timestamps)."""
    return F.to_json(F.array(*(F.col(c).cast("string") for c in columns)), {"ignoreNullFields": "false"}).alias(_KEY)


def _columns(fields: list[T.StructField]) -> list[Column]:
    """The columns a key was made of, with their types."""
    texts = F.from_json(_KEY, "array<string>")
    return [texts[i].cast(f.dataType).alias(f.name) for i, f in enumerate(fields)]


def _fields(table: str, columns: list[str]) -> list[T.StructField]:
    return [schemas.STORAGE[table][c] for c in columns]


def _marker(spark: SparkSession, home: str) -> tuple[int, ...]:
    """(version, last batches it has seen) of the last check, empty for none."""
    return max((tuple(map(int, n.split("_"))) for n in folder_names(spark, f"{home}/done")), default=())


def _mark(spark: SparkSession, home: str, *told: int) -> None:
    make_folder(spark, f"{home}/done/{'_'.join(map(str, told))}")


class _Ledger:
    """The keys of one table: a bucketed table over a folder of the warehouse, known to the session while a check runs."""

    def __init__(self, spark: SparkSession, home: str, buckets: int):
        made = [int(n.split("=")[1]) for n in folder_names(spark, home) if n.startswith("buckets=")]
        self.spark, self.home, self.buckets = spark, home, made[0] if made else buckets
        self.path = f"{home}/buckets={self.buckets}"
        self.name = f"siltbed_keys_{hashlib.sha256(home.encode()).hexdigest()[:16]}"

    def __enter__(self) -> _Ledger:
        make_folder(self.spark, self.path)
        self.spark.sql(f"drop table if exists {self.name}")
        # an external table: dropping it leaves the files
        self.spark.sql(
            f"create table {self.name} ({_KEY} string, n long, version int) using parquet partitioned by (version) "
            f"clustered by ({_KEY}) into {self.buckets} buckets location '{self.path}'"
        )
        self.spark.catalog.recoverPartitions(self.name)
        return self

    def __exit__(self, *_) -> None:
        self.spark.sql(f"drop table if exists {self.name}")

    def dealt(self, keys: DataFrame) -> DataFrame:
        """Keys with their row count, in the ledger's buckets. Rows are counted before they move, so no key is hot."""
        counted = keys.groupBy(_KEY).agg(F.count("*").alias("n"))
        return counted.repartition(self.buckets, _KEY)

    def versions(self, base: int, last: int) -> DataFrame:
        """Keys and counts of some versions; a key is there once for each version that brought it."""
        return self.spark.table(self.name).where(F.col("version").between(base, last)).select(_KEY, "n")

    def add(self, counted: DataFrame, version: int) -> DataFrame:
        """Writes the keys of a version and reads them again; one that is written again replaces what was there."""
        drop_folder(self.spark, f"{self.path}/version={version}")
        staged = f"{self.name}_new"
        self.spark.sql(f"drop table if exists {staged}")
        counted.write.bucketBy(self.buckets, _KEY).option("path", f"{self.path}/version={version}").format("parquet").saveAsTable(staged)
        self.spark.sql(f"drop table if exists {staged}")
        self.spark.catalog.recoverPartitions(self.name)
        return self.versions(version, version)

    def merged(self, base: int, last: int) -> DataFrame:
        """Each key once; counted inside its bucket."""
        return self.versions(base, last).groupBy(_KEY).agg(F.sum("n").alias("n"))


_REPORT = f"{_KEY} string, count long"


def _report(spark: SparkSession, home: str, version: int) -> DataFrame:
    make_folder(spark, f"{home}/report/version={version}")
    return spark.read.schema(_REPORT).parquet(f"{home}/report/version={version}")


def _save_report(report: DataFrame, home: str, version: int) -> None:
    report.select(_KEY, "count").write.mode("overwrite").parquet(f"{home}/report/version={version}")
    drop_folder(report.sparkSession, f"{home}/report/version={version - 2}")  # a reader may still use the one before


def _new_rows(spark: SparkSession, warehouse: Warehouse, table: str, seen: int, last: int) -> DataFrame:
    rows = read_batches(spark, warehouse.table(table), schemas.STORAGE[table])
    return rows.where((F.col("batch_id") > seen) & (F.col("batch_id") <= last))


def update_unique(spark: SparkSession, warehouse: Warehouse, table: str, keys: list[str], buckets: int = BUCKETS) -> int:
    """Check the keys of a table's new committed batches against all before them; returns the version of the report.

    Without a new batch nothing is read or written. A check that was cut short is done again under its own number.
    """
    home, last = warehouse.key_ledger(table, keys), warehouse.state(spark)[table]
    version, seen, base = _marker(spark, home) or (-1, -1, 0)
    if seen == last:
        return version
    with _Ledger(spark, home, buckets) as ledger:
        number, old_base = version + 1, base
        if version - base >= MERGED_AFTER:
            ledger.add(ledger.merged(base, version), number)
            base, number = number, number + 1
        rows = _new_rows(spark, warehouse, table, seen, last)
        new = ledger.add(ledger.dealt(rows.select(_key(keys))), number)
        before = ledger.versions(base, number - 1).withColumnRenamed("n", "n_before")
        # the join comes first, so that of all keys before only those of the new batches are counted
        found = new.join(before, _KEY, "left").groupBy(_KEY).agg((F.first("n") + F.coalesce(F.sum("n_before"), F.lit(0))).alias("count"))
        found = found.where("count > 1")
        kept = _report(spark, home, version) if version >= 0 else found.limit(0)
        _save_report(kept.unionByName(found).groupBy(_KEY).agg(F.max("count").alias("count")), home, number)
        _mark(spark, home, number, last, base)
        for merged in range(old_base, base):
            drop_folder(spark, f"{ledger.path}/version={merged}")
    return number


def duplicate_keys(spark: SparkSession, warehouse: Warehouse, table: str, keys: list[str]) -> DataFrame:
    """What ``check_unique`` finds in the table as the last ``update_unique`` saw it: the keys that occur more than once, with ``count``."""
    told = _marker(spark, warehouse.key_ledger(table, keys)) or (-1,)
    report = _report(spark, warehouse.key_ledger(table, keys), told[0])
    return report.select(*_columns(_fields(table, keys)), "count")


def _reference_home(warehouse: Warehouse, child: str, child_key: str, parent: str, parent_key: str) -> str:
    return f"{warehouse.key_ledger(child, [child_key])}-of-{parent}-{parent_key}"


def update_reference(
    spark: SparkSession, warehouse: Warehouse, child: str, child_key: str, parent: str, parent_key: str, buckets: int = BUCKETS
) -> int:
    """Check the child keys of new batches, and those reported before, against all parent keys; returns the version of the report.

    A key leaves the report when its parent comes. The child rows of a key are in the new batches or in the report, so none
    of the older ones is read. The parents' ledger, that of ``update_unique``, is brought up to date first.
    """
    home, last = _reference_home(warehouse, child, child_key, parent, parent_key), warehouse.state(spark)[child]
    update_unique(spark, warehouse, parent, [parent_key], buckets)
    parents_home = warehouse.key_ledger(parent, [parent_key])
    parents = _marker(spark, parents_home) or (-1, -1, 0)
    version, seen, parents_seen = _marker(spark, home) or (-1, -1, -1)
    if (seen, parents_seen) == (last, parents[1]):
        return version
    with _Ledger(spark, parents_home, buckets) as ledger:
        rows = _new_rows(spark, warehouse, child, seen, last).where(F.col(child_key).isNotNull())
        open_keys = rows.groupBy(_key([child_key])).agg(F.count("*").alias("count"))
        if version >= 0:
            open_keys = open_keys.unionByName(_report(spark, home, version))
        open_keys = open_keys.groupBy(_KEY).agg(F.sum("count").alias("count")).repartition(ledger.buckets, _KEY)
        # an anti join would be moved below the dealing, and the ledger be shuffled with it
        known = ledger.versions(parents[2], parents[0]).select(_KEY, F.lit(True).alias("known"))
        orphans = open_keys.join(known, _KEY, "left").where("known is null")
        _save_report(orphans, home, version + 1)
        _mark(spark, home, version + 1, last, parents[1])
    return version + 1


def orphan_keys(spark: SparkSession, warehouse: Warehouse, child: str, child_key: str, parent: str, parent_key: str) -> DataFrame:
    """What ``check_reference`` finds in the tables as the last ``update_reference`` saw them, with ``count`` of child rows."""
    home = _reference_home(warehouse, child, child_key, parent, parent_key)
    told = _marker(spark, home) or (-1,)
    return _report(spark, home, told[0]).select(*_columns(_fields(child, [child_key])), "count")
