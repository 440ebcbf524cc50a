"""What the operators of this subpackage share: Arrow mapping, tables written once, bounded labelled samples."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltbed.llm.bpe import forget_unused
from siltbed.session import drop_folder, scratch_folder

#: Bytes of text that one Arrow batch is cut to before it is worked on, whatever its row count.
BATCH_BYTES = 12 << 20
#: The same where a batch is cut into tokens or features, which take many times its size.
TOKEN_BATCH_BYTES = 4 << 20


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator works on, so that no other column can clash or be read."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name in taken:
            name = f"_{name}"
        taken.add(name)
        out.append(name)
    return out


#: Setting that removes an execution's shuffle files when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _written(spark: SparkSession, df: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = scratch_folder(spark, name)
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path), path


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder: later reads depend on files, not on executors.

    Shuffle files of the write are of no use after it and are removed with its end. The table stays; one that an operator
    needs for itself only is made by ``WorkTables``.
    """
    return _written(spark, df, name)[0]


class WorkTables:
    """Tables of one operator in the shared folder, each deleted after its last reader; those left go when the block ends, also by an error.

    What the block returns may read no table of it but those given to ``keep``.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def __enter__(self) -> WorkTables:
        return self

    def __exit__(self, *_) -> None:
        self.drop(*self.paths)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        table, path = _written(self.spark, df, name)
        self.paths[table] = path
        return table

    def keep(self, table: DataFrame) -> DataFrame:
        del self.paths[table]
        return table

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            drop_folder(self.spark, self.paths.pop(table))


def slices(batch: pa.RecordBatch, column: str = "text", size: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that each part holds at most ``size`` bytes of ``column``, or one row."""
    sizes = [0 if n is None else n for n in pc.binary_length(batch.column(column)).to_pylist()]
    start = held = 0
    for i, n in enumerate(sizes):
        if held and held + n > size:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield batch.slice(start)


def map_batches(
    df: DataFrame,
    work: Callable[[pa.RecordBatch], dict],
    schema: str | StructType,
    column: str | None = "text",
    size: int = BATCH_BYTES,
) -> DataFrame:
    """Applies ``work`` (a batch to a dict of columns) to every Arrow batch of ``df``, cut by the bytes of ``column``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    fields = to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column, size) if column else [batch]:
                made = work(part)
                yield pa.RecordBatch.from_arrays([made[f.name] if isinstance(made[f.name], pa.Array) else pa.array(made[f.name], f.type) for f in fields], schema=fields)
                del part, made
            del batch
            pa.default_memory_pool().release_unused()  # workers are used again: what a wide batch took is not theirs to keep
        forget_unused()

    return df.mapInArrow(run, schema)


def raw(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    """A string column's values as UTF-8 bytes."""
    return batch.column(column).cast(pa.binary()).to_pylist()


def labelled(rows: DataFrame, labels: DataFrame, key: str, sample: int) -> DataFrame:
    """``rows`` joined with at most ``sample`` labelled rows, those of the smallest key hash.

    ``sample`` bounds what is broadcast here and what a fit gathers on the driver: of repeated keys, each label takes the row that is
    smallest by a hash of its columns, and rows are reduced to it before they are moved.
    """
    chosen = labels.where(F.col(key).isNotNull()).orderBy(F.xxhash64(key), key).limit(sample)
    chosen = chosen.withColumn("__label", F.monotonically_increasing_id())
    both = rows.join(F.broadcast(chosen), key)
    columns = [c for c in both.columns if c != "__label"]
    first = F.min(F.struct(F.xxhash64(*rows.columns).alias("__hash"), *columns)).alias("__row")
    return both.groupBy("__label").agg(first).select(*(F.col(f"__row.{c}").alias(c) for c in columns))


def all_labelled(rows: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """``rows`` joined with all labelled rows. Of repeated keys, each label takes the row that is smallest by a hash of its columns.

    Rows are reduced to one for each key before they meet the labels, so no key is hot there. ``rows`` should be narrow, as all of them may move.
    """
    others = [c for c in rows.columns if c != key]
    first = F.min(F.struct(F.xxhash64(*rows.columns).alias("__hash"), *others)).alias("__row")
    one = rows.where(F.col(key).isNotNull()).groupBy(key).agg(first).select(key, *(F.col(f"__row.{c}").alias(c) for c in others))
    return one.join(labels, key)


def nth_smallest(rows: DataFrame, column: str, n: int, bins: int = 4096) -> float:
    """The value with exactly ``n`` rows before it when all are sorted (from 0), by counts in bins that narrow down to it.

    The driver sees ``bins`` counts a round. A round goes on inside one bin, from its smallest value to its largest.
    """
    value = F.col(column)
    low, high = rows.agg(F.min(value), F.max(value)).first()
    while low < high:
        place = F.least(F.floor((value - low) / ((high - low) / bins)), F.lit(bins - 1)).alias("place")
        told = rows.where(value.between(low, high)).groupBy(place).agg(F.count("*").alias("n"), F.min(value).alias("low"), F.max(value).alias("high"))
        for r in sorted(told.collect()):
            if n < r.n:
                low, high = r.low, r.high
                break
            n -= r.n
    return low
