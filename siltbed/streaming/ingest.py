"""Continuous copy of landed files into staging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader, StreamingQuery

from siltbed import schemas
from siltbed.session import drop_folder, folder_exists, folder_names, move_folder
from siltbed.sources.records import RECORD, json_options, keyed_record, keyed_schema, matching_path, run_order, set_aside_malformed, strict_json, strip_outer_array


def trigger(mode: str, interval: str) -> dict:
    """``once`` drains what is there and stops; ``interval`` goes on in micro-batches."""
    if mode == "once":
        return {"availableNow": True}
    if mode == "interval":
        return {"processingTime": interval}
    raise ValueError("mode is 'once' or 'interval'")


#: Age beyond which a file stream forgets a file. Spark's own default of a week silently leaves out files that keep an older date.
MAX_FILE_AGE = "36500d"

#: Bytes of a row group in staging: Spark's least split, so that a load whose batch is one file still reads it in several tasks.
ROW_GROUP = 4 << 20


def bounded(
    source: DataStreamReader,
    max_files: int | None = None,
    max_bytes: str | None = None,
    max_age: str = MAX_FILE_AGE,
    archive: str | None = None,
) -> DataStreamReader:
    """Bound the micro-batches of a file stream by file count or by size (``"2t"``).

    A large backfill then commits in steps, and a failure repeats one step only. A file is read whatever its date,
    unless it is older than the newest one by more than ``max_age``. The stream remembers each file of that age, one entry on the
    driver; for a stream that runs for years, ``archive`` is a folder it moves the files to that it has read.
    """
    source = source.option("maxFileAge", max_age)
    if archive is not None:
        source = source.options(cleanSource="archive", sourceArchiveDir=archive)
    if max_files is not None:
        source = source.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        source = source.option("maxBytesPerTrigger", max_bytes)
    return source


def ingest_stream(
    spark: SparkSession,
    landing: str,
    staging: str,
    checkpoint: str,
    pattern: str | None = None,
    mode: str = "once",
    interval: str = "5 minutes",
    multi_line: bool = False,
    malformed: str = "FAILFAST",
    limits: dict | None = None,
    keys: list[str] | None = None,
) -> StreamingQuery:
    """Copy new JSON files below ``landing`` whose path matches ``pattern`` into a one-column staging table.

    Beside the record it keeps the place of its run, by the ``run=`` folder it was landed in (without one, the time the file was
    written), which tells the runs of a record apart.

    ``malformed`` is a mode of Spark's JSON reader, or ``QUARANTINE``: then a text that is no record neither stops the stream nor is lost. The same
    pass stages it in columns of its own, with its file and place, where ``quarantined`` finds it and no load does; ``replay`` stages it once it is repaired.

    ``keys`` are those of ``read_json_records``: arrays beyond 128 MiB can then be read, by a mode of Spark's reader.

    A fresh checkpoint takes the files that are already there first; see ``bounded`` for ``limits``.
    """
    if keys is not None and malformed == "QUARANTINE":
        raise ValueError("QUARANTINE looks at whole texts, keys at records")
    source = bounded(spark.readStream, **(limits or {})).option("recursiveFileLookup", True)
    written = F.date_format(F.col("_metadata.file_modification_time"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    landed = F.coalesce(run_order("_metadata.file_path"), written)
    if malformed == "QUARANTINE":
        texts = source.text(landing, wholetext=multi_line, lineSep=None if multi_line else "\n")
        records = set_aside_malformed(matching_path(texts, pattern), landed, multi_line)
    elif keys is not None:
        source = source.schema(keyed_schema(keys)).options(multiLine=multi_line, mode=malformed)
        records = matching_path(source.json(landing), pattern).select(keyed_record(keys), landed.alias(schemas.LANDED))
    else:
        source = source.options(**json_options(multi_line, malformed))
        records = strip_outer_array(matching_path(source.json(landing), pattern), RECORD, landed.alias(schemas.LANDED))
    writer = records.writeStream.format("parquet").option("path", staging).option("checkpointLocation", checkpoint)
    # a file sink takes this from the session alone, of which a stream keeps its own copy from its start on
    name = "parquet.block.size"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(ROW_GROUP))
    try:
        return writer.trigger(**trigger(mode, interval)).start()
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def quarantined(spark: SparkSession, staging: str) -> DataFrame:
    """The texts of a staging table that are no records: file, start of the split, offset there in bytes, text, and run order.

    The three places name a text: no other has them. Files read by one task have their start at 0.
    """
    schema = T.StructType([*schemas.with_landed(schemas.SET_ASIDE).fields])
    rows = spark.read.schema(schema).parquet(staging).where("bad_text is not null")
    return rows.withColumnsRenamed({f"bad_{c}": c for c in ("file", "start", "offset", "text")})


_REPLAYED = "file string, start long, offset long, run string, value string"


def replay(spark: SparkSession, repaired: DataFrame, landing: str, ledger: str, endpoint: str) -> int:
    """Land the repaired texts (``file``, ``start``, ``offset`` as in ``quarantined``, and the new ``text``) that are records now; returns how many.

    They keep the run of the file they come from. Each place is landed once, however often it is given: what a call lands is first written to
    the ``ledger``, under a number; a call that was cut short in between is finished by the next one. Texts that are still no records are left
    for a later call.
    """

    def land(number: str) -> None:
        rows = spark.read.schema(_REPLAYED).parquet(f"{ledger}/{number}")
        hidden = f"{landing}/_{endpoint}-{number}"  # no reader looks into it
        rows.select("run", "value").write.mode("overwrite").partitionBy("run").text(hidden)
        move_folder(spark, hidden, f"{landing}/{endpoint}/{number}")

    numbers = [n for n in folder_names(spark, ledger) if n.startswith("replay=") and "_SUCCESS" in folder_names(spark, f"{ledger}/{n}")]
    for number in numbers:
        if not folder_exists(spark, f"{landing}/{endpoint}/{number}"):
            land(number)
    place = ["file", "start", "offset"]
    record = strict_json("text")
    new = repaired.where(record.isNotNull()).groupBy(*place).agg(F.min(F.to_json(record)).alias("value"))
    if numbers:
        new = new.join(spark.read.schema(_REPLAYED).parquet(*(f"{ledger}/{n}" for n in numbers)), place, "left_anti")
    run = F.coalesce(F.nullif(F.regexp_extract("file", "/run=([^/]+)/", 1), F.lit("")), F.lit("0"))
    number = f"replay={len(numbers)}"
    new.select(*place, run.alias("run"), "value").write.mode("overwrite").parquet(f"{ledger}/{number}")
    count = spark.read.schema(_REPLAYED).parquet(f"{ledger}/{number}").count()
    if count:
        land(number)
    else:
        drop_folder(spark, f"{ledger}/{number}")
    return count


def rewritten_files(spark: SparkSession, landing: str, checkpoint: str) -> DataFrame:
    """Files below ``landing`` that were written again after the ingest with this checkpoint had read them: path, time read, time now.

    A file stream reads a path once. This compares its own log of files with those there are; contents are not read.
    """

    def plain(path: str) -> Column:  # the log has paths as URLs, the listing as they are
        return F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/").alias("path")

    log = spark.read.text(f"{checkpoint}/sources/0").where("value like '{%'")
    seen = log.select(F.from_json("value", "path string, timestamp long").alias("f"))
    seen = seen.select(F.url_decode(F.replace("f.path", F.lit("+"), F.lit("%2B"))).alias("path"), "f.timestamp")
    seen = seen.groupBy(plain("path")).agg(F.max("timestamp").alias("read"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(landing)
    now = files.select(plain("path"), F.unix_millis("modificationTime").alias("now"))
    return now.join(seen, "path").where("now > read").select("path", F.timestamp_millis("read").alias("read"), F.timestamp_millis("now").alias("now"))
