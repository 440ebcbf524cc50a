"""Where the staging, storage and checkpoint folders of one warehouse lie."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.schemas import LEDGER, STORAGE, with_landed
from siltbed.session import drop_folder, folder_names, make_folder

#: Folder of a table with the marker of its last committed batch; readers of rows do not look into it.
_COMMITS = "_commits"
#: Tables that are written by the load of another one and committed with it.
COMMITTED_WITH = {"measure": "entity_measure"}
#: The kept lookup of cohorts: each of its batches holds it whole.
COHORTS = "cohort_lookup"
#: Facts that wait for their measure: each batch holds all of them.
WAITING = "entity_measure_waiting"


@dataclass(frozen=True)
class Warehouse:
    """A folder on shared storage. Checkpoints live beside the tables they belong to."""

    root: str

    def landing(self) -> str:
        return f"{self.root}/landing"

    def staging(self, name: str) -> str:
        return f"{self.root}/staging/{name}"

    def table(self, name: str) -> str:
        return f"{self.root}/storage/{name}"

    def ledger(self, name: str) -> str:
        return f"{self.root}/ledger/{name}"

    def replays(self, name: str) -> str:
        return f"{self.root}/replays/{name}"

    def key_ledger(self, name: str, keys: list[str]) -> str:
        return f"{self.root}/keys/{name}-{'-'.join(keys)}"

    def kept(self, name: str, by: list[str]) -> str:
        return f"{self.root}/kept/{name}-{'-'.join(by)}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"

    def create(self, spark: SparkSession) -> "Warehouse":
        """Empty landing, staging and storage, where there is none yet.

        Folders only: a folder without files reads as an empty table, and an empty file in staging would hide
        the ingest stream's commit log from its readers.
        """
        tables = [self.table(name) for name in [*STORAGE, COHORTS]]
        for path in (self.landing(), self.staging("entity"), self.staging("cohort"), *tables):
            make_folder(spark, path)
        return self

    def state(self, spark: SparkSession) -> dict[str, int]:
        """The last committed batch of each storage table, -1 for none. Tables of one load have one state."""
        return {name: last_commit(spark, self.table(COMMITTED_WITH.get(name, name)))[0] for name in [*STORAGE, COHORTS]}

    def read(self, spark: SparkSession, name: str, landed: bool = False, state: dict[str, int] | None = None) -> DataFrame:
        """A storage table with its declared columns, as its committed batches have it; ``landed`` adds the run order of the record behind a row.

        A batch that is being written, or was cut short, is not seen, in any of its tables. ``state``, that of an earlier call, reads the tables
        as they were then, so that several reads agree.
        """
        schema = with_landed(STORAGE[name]) if landed and name != "measure" else STORAGE[name]
        last = (state or self.state(spark))[name]
        return read_batches(spark, self.table(name), schema).where(F.col("batch_id") <= last).drop("batch_id")


def last_commit(spark: SparkSession, table: str) -> tuple[int, str]:
    """The last committed batch of a table and the query it belongs to."""
    told = [name.split("-", 1) for name in folder_names(spark, f"{table}/{_COMMITS}")]
    return max(((int(batch), query) for batch, query in told), default=(-1, ""))


def commit(spark: SparkSession, table: str, batch_id: int, query: str) -> None:
    """Make a batch seen: one marker appears, after all of its tables are written. Batches are committed in order, so the last marker says all."""
    before = folder_names(spark, f"{table}/{_COMMITS}")
    make_folder(spark, f"{table}/{_COMMITS}/{batch_id}-{query}")
    for name in before:
        if name != f"{batch_id}-{query}":
            drop_folder(spark, f"{table}/{_COMMITS}/{name}")


def withdraw(spark: SparkSession, table: str) -> None:
    """Make all batches of a table unseen."""
    drop_folder(spark, f"{table}/{_COMMITS}")


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All batches, committed or not; a filter on ``batch_id`` prunes folders."""
    return spark.read.schema(T.StructType(schema.fields + [T.StructField("batch_id", T.LongType())])).parquet(path)


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Append as a folder of its own. A batch that runs again replaces its folder, so one copy remains; no reader sees it before it is committed."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def last_id_before(spark: SparkSession, path: str, batch_id: int) -> int:
    """The last surrogate id given out before this batch.

    Batch ids are consecutive and a batch starts when the one before has written its ledger row, so that
    row is all there is to read, however many batches there were.
    """
    if batch_id == 0:
        return 0
    return spark.read.schema(LEDGER).parquet(f"{path}/batch_id={batch_id - 1}").first()["last_id"]
