"""Incremental loads from staging into storage, one independent stream per load.

Each load flattens in the stream itself, where typed paths reach the scan; inside a batch function they no longer would.
A load that needs its rows twice, or their positions, writes the flattened rows once to a work table: flattening is
not repeated, and the rest of the batch does not depend on executors that are gone.
A batch is delivered at least once, therefore it writes a folder named after itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from siltbed import schemas
from siltbed.functions.paths import id_from_url, json_path
from siltbed.operators.dimensions import latest_rows, new_dimension_rows
from siltbed.operators.flatten import flatten_array, pick_localised
from siltbed.operators.keys import number_rows, reserved_ids
from siltbed.operators.lookups import fact_to_dimension, left_facts, lookup_chain, lookup_table, refresh_lookup
from siltbed.session import drop_folder, folder_exists, make_folder, scratch_home
from siltbed.sources.records import RECORD
from siltbed.streaming.ingest import bounded, trigger
from siltbed.streaming.warehouse import COHORTS, WAITING, Warehouse, commit, last_commit, last_id_before, read_batches, withdraw, write_batch

Finish = Callable[[DataFrame, int], None]


_STAGED = T.StructType([*schemas.with_landed(schemas.STAGING).fields, schemas.SET_ASIDE["bad_text"]])


def _records(staged: DataFrame) -> DataFrame:
    """The rows that hold a record; a table written without the columns of other texts holds nothing else."""
    return staged.where("bad_text is null").drop("bad_text")


def changes(spark: SparkSession, staging: str, limits: dict | None = None) -> DataFrame:
    """Records added to a staging table since the reading query last committed."""
    return _records(bounded(spark.readStream.schema(_STAGED), **(limits or {})).parquet(staging))


def staged(spark: SparkSession, staging: str) -> DataFrame:
    """All records of a staging table, with their run order."""
    return _records(spark.read.schema(_STAGED).parquet(staging))


def _landed(staging: DataFrame) -> list:
    """The run order, where a table has it."""
    return [F.col(schemas.LANDED)] if schemas.LANDED in staging.columns else []


def _distinct(batch: DataFrame) -> DataFrame:
    """Rows that are equal but for the run, once, as its latest run has them."""
    if schemas.LANDED not in batch.columns:
        return batch.dropDuplicates()
    rest = [c for c in batch.columns if c != schemas.LANDED]
    return batch.groupBy(*rest).agg(F.max(schemas.LANDED).alias(schemas.LANDED))


def run_load(
    spark: SparkSession,
    warehouse: Warehouse,
    name: str,
    rows: DataFrame,
    finish: Finish,
    mode: str = "once",
    interval: str = "5 minutes",
    dedup: bool = False,
) -> StreamingQuery:
    """Start one load. ``finish`` gets the new rows and the batch id; without new files it is not called.

    When it has written all tables of the batch, the batch is committed and readers see it, in all of them at once.

    A load belongs to its checkpoint. With a new one it starts over, which a table that is further on refuses: its
    first folder would be replaced and the others would stay.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        table = warehouse.table(name)
        if batch_id == 0 and folder_exists(spark, f"{table}/batch_id=1"):
            raise ValueError(f"{table} was loaded with another checkpoint; empty it to start over")
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
        last, owner = last_commit(spark, table)
        if last >= batch_id and owner == query:
            return  # it was committed, and the stream was cut short before it noted that
        if last >= batch_id:
            withdraw(spark, table)  # a new checkpoint starts over on a table of one batch
        finish(_distinct(batch) if dedup else batch, batch_id)
        commit(spark, table, batch_id, query)

    return (
        rows.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", warehouse.checkpoint(name))
        .trigger(**trigger(mode, interval))
        .start()
    )


def _settle(spark: SparkSession, warehouse: Warehouse, name: str, rows: DataFrame) -> str:
    """Write rows to the load's work table. Each batch replaces it, so it holds one batch at most."""
    owner = hashlib.sha256(warehouse.root.encode()).hexdigest()[:16]
    path = f"{scratch_home(spark)}/work-{owner}/{name}"
    rows.write.mode("overwrite").parquet(path)
    return path


def _write_numbered(spark: SparkSession, warehouse: Warehouse, name: str, path: str, batch_id: int) -> None:
    """Append a work table's rows with surrogate ids that go on after the earlier batches."""
    columns = [f.name for f in schemas.with_landed(schemas.STORAGE[name]).fields if f.name != "id"]
    start = last_id_before(spark, warehouse.ledger(name), batch_id)
    write_batch(number_rows(spark, path, columns, start), warehouse.table(name), batch_id)
    given = spark.read.parquet(path).agg((F.count("*") + F.lit(start)).alias("last_id"))
    write_batch(given, warehouse.ledger(name), batch_id)


def _write_reserved(spark: SparkSession, warehouse: Warehouse, name: str, rows: DataFrame, batch_id: int) -> None:
    """Append rows with ids from ranges of their tasks, in one write; the ledger notes the last id given."""
    columns = [f.name for f in schemas.with_landed(schemas.STORAGE[name]).fields if f.name != "id"]
    start = last_id_before(spark, warehouse.ledger(name), batch_id)
    write_batch(rows.select(reserved_ids(start), *columns), warehouse.table(name), batch_id)
    own = spark.read.schema(schemas.STORAGE[name]).parquet(f"{warehouse.table(name)}/batch_id={batch_id}")
    given = own.agg(F.greatest(F.max("id"), F.lit(start).cast("long")).alias("last_id"))
    write_batch(given, warehouse.ledger(name), batch_id)


def _checked(ids: str) -> str:
    if ids not in ("dense", "reserved"):
        raise ValueError("ids is 'dense' or 'reserved'")
    return ids


def entity_rows(staging: DataFrame) -> DataFrame:
    return staging.select(
        json_path(RECORD, "$.id", "bigint").alias("id"),
        json_path(RECORD, "$.name", "string").alias("name"),
        json_path(RECORD, "$.species.name", "string").alias("lookup_key"),
        *_landed(staging),
    )


def cohort_lookup(staging: DataFrame, language: str = "en", latest: bool = False) -> tuple[DataFrame, DataFrame]:
    """(members, labels) of the cohort records: member name to cohort id, and cohort id to its name.

    ``latest`` takes each cohort as its last run landed it, once; without it a cohort landed twice is two.
    """
    cohort_id = json_path(RECORD, "$.id", "bigint").alias("cohort_id")
    names = json_path(RECORD, f"$.{schemas.COHORT_NAMES}", schemas.LOCALISED_NAMES)
    if latest:
        labels = _latest(pick_localised(staging, names, language, "cohort", [cohort_id, *_landed(staging)]), staging, cohort_id)
    else:
        labels = pick_localised(staging, names, language, "cohort", [cohort_id])
    member_names = json_path(RECORD, f"$.{schemas.COHORT_MEMBERS}", schemas.MEMBER_NAMES)
    members = flatten_array(staging, member_names, "m", [cohort_id, *(_landed(staging) if latest else [])])
    members = members.select("cohort_id", F.col("m.name").alias("lookup_key"), *_landed(members))
    return _latest(members, staging, cohort_id) if latest else members, labels


def _latest(rows: DataFrame, staging: DataFrame, record_id: Column) -> DataFrame:
    """Rows of the latest run of each record, each once."""
    return latest_rows(rows, "cohort_id", schemas.LANDED, staging.select(record_id, schemas.LANDED)).distinct()


def _cohorts(spark: SparkSession, warehouse: Warehouse, language: str, latest: bool) -> tuple[DataFrame, DataFrame]:
    return cohort_lookup(staged(spark, warehouse.staging("cohort")), language, latest)


_KEPT = T.StructType(
    [
        T.StructField("cohort_id", T.LongType()),
        T.StructField("lookup_key", T.StringType()),
        T.StructField("cohort", T.StringType()),
        T.StructField(schemas.LANDED, T.StringType()),
    ]
)


def cohort_rows(staging: DataFrame, language: str = "en") -> DataFrame:
    """Cohort records flattened to what a lookup needs: a row for each member and name in the language, one with NULLs where there is none."""
    cohort_id = json_path(RECORD, "$.id", "bigint").alias("cohort_id")
    members = json_path(RECORD, f"$.{schemas.COHORT_MEMBERS}", schemas.MEMBER_NAMES)
    names = F.filter(json_path(RECORD, f"$.{schemas.COHORT_NAMES}", schemas.LOCALISED_NAMES), lambda n: n["language"]["name"] == language)
    flat = staging.select(cohort_id, schemas.LANDED, names.alias("names"), F.explode_outer(members).alias("m"))
    flat = flat.select("cohort_id", schemas.LANDED, F.col("m.name").alias("lookup_key"), F.explode_outer("names").alias("n"))
    return flat.select("cohort_id", "lookup_key", F.col("n.name").alias("cohort"), schemas.LANDED)


def kept_cohorts(spark: SparkSession, warehouse: Warehouse, batch_id: int | None = None) -> DataFrame:
    """The kept lookup: each cohort as its latest run has it. ``batch_id`` reads an earlier version."""
    last = last_commit(spark, warehouse.table(COHORTS))[0] if batch_id is None else batch_id
    return read_batches(spark, warehouse.table(COHORTS), _KEPT).where(F.col("batch_id") == last).drop("batch_id")


def load_cohorts(spark: SparkSession, warehouse: Warehouse, language: str = "en", limits=None, **how) -> StreamingQuery:
    """Keep the lookup of cohorts up to date: a version of it for each batch of new cohort records.

    A batch reads the version before and its own records, not the staging table. Of a cohort's records the latest run counts, the later batch
    where runs are the same; a record of an earlier run that comes late changes nothing. A batch that runs again reads the same version
    before and writes the same one after. Two versions stay, as a reader may still use the one before the last.
    """

    def finish(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        path = _settle(session, warehouse, COHORTS, batch)
        new, kept = session.read.schema(_KEPT).parquet(path), kept_cohorts(session, warehouse, batch_id - 1)
        order = F.coalesce(schemas.LANDED, F.lit(""))
        latest = new.groupBy("cohort_id").agg(F.max(order).alias("new"))
        before = kept.groupBy("cohort_id").agg(F.max(order).alias("old"))
        judged = latest.join(before, "cohort_id", "left").select("cohort_id", "new", F.coalesce(F.col("new") >= F.col("old"), F.lit(True)).alias("wins"))
        stays = kept.join(judged.where("wins").select("cohort_id"), "cohort_id", "left_anti")
        comes = new.join(judged.where("wins"), (new.cohort_id == judged.cohort_id) & (order == F.col("new")), "left_semi")
        columns = _KEPT.names
        write_batch(stays.select(*columns).union(comes.select(*columns).distinct()), warehouse.table(COHORTS), batch_id)
        drop_folder(session, f"{warehouse.table(COHORTS)}/batch_id={batch_id - 2}")

    rows = cohort_rows(changes(spark, warehouse.staging("cohort"), limits), language)
    return run_load(spark, warehouse, COHORTS, rows, finish, **how)


def membership_rows(staging: DataFrame, array: str, child: str, strict: bool = True) -> DataFrame:
    """(category_id, entity_id, category_name) of each element of a membership array.

    A URL without an id stops the load, or gives a NULL category id when ``strict`` is off.
    """
    entity_id = json_path(RECORD, "$.id", "bigint").alias("entity_id")
    elements = json_path(RECORD, f"$.{array}", schemas.membership_array(child))
    flat = flatten_array(staging, elements, "e", [entity_id, *_landed(staging)])
    return flat.select(
        id_from_url(F.col(f"e.{child}.url"), strict).alias("category_id"),
        "entity_id",
        F.col(f"e.{child}.name").alias("category_name"),
        *_landed(staging),
    )


def measure_rows(staging: DataFrame, array: str, child: str) -> DataFrame:
    """(entity_id, measure_id, measure_name, value) of each element of a measure array."""
    entity_id = json_path(RECORD, "$.id", "bigint").alias("entity_id")
    flat = flatten_array(staging, json_path(RECORD, f"$.{array}", schemas.measure_array(child)), "e", [entity_id, *_landed(staging)])
    return flat.select(
        "entity_id",
        id_from_url(F.col(f"e.{child}.url")).alias("measure_id"),
        F.col(f"e.{child}.name").alias("measure_name"),
        F.col("e.base_stat").alias("value"),
        *_landed(staging),
    )


def load_entities(
    spark: SparkSession, warehouse: Warehouse, language: str = "en", limits=None, latest: bool = False, kept: bool = False, **how
) -> StreamingQuery:
    """New entities with the name of their cohort; an entity without one is kept with NULL.

    Cohort staging has no cursor: each batch reads all of it anew; ``latest`` takes each cohort once, as its last run has it.
    ``kept`` reads the lookup that ``load_cohorts`` keeps instead, which is ``latest`` without the staging table.
    """

    def finish(batch: DataFrame, batch_id: int) -> None:
        if kept:
            lookup = kept_cohorts(batch.sparkSession, warehouse).where("lookup_key is not null").select("lookup_key", "cohort")
            found = batch.join(lookup, "lookup_key", "left")
        else:
            members, labels = _cohorts(batch.sparkSession, warehouse, language, latest)
            found = lookup_chain(batch, "lookup_key", members, labels, "cohort_id")
        write_batch(found.select(*schemas.with_landed(schemas.STORAGE["entity"]).names), warehouse.table("entity"), batch_id)

    rows = entity_rows(changes(spark, warehouse.staging("entity"), limits))
    return run_load(spark, warehouse, "entity", rows, finish, **how)


def refreshed_entities(
    spark: SparkSession, warehouse: Warehouse, language: str = "en", latest: bool = False, landed: bool = False
) -> DataFrame:
    """The stored entities, those without a cohort resolved again with today's cohort records.

    The entity table is append-only, so an entity that came before its cohort stays without one there. ``latest`` is that of
    ``load_entities``, ``landed`` that of ``Warehouse.read``.
    """
    members, labels = _cohorts(spark, warehouse, language, latest)
    lookup = lookup_table(members, labels, "cohort_id")
    return refresh_lookup(warehouse.read(spark, "entity", landed), "lookup_key", "cohort", lookup)


def load_membership(
    spark: SparkSession, warehouse: Warehouse, table: str, array: str, child: str, strict=True, limits=None, ids: str = "dense", **how
) -> StreamingQuery:
    """New (entity, category) rows of one membership array.

    ``ids="reserved"`` numbers rows with gaps as they are written, once; ``dense`` ids need a work table first. A table can go over from
    one to the other.
    """
    reserved = _checked(ids) == "reserved"

    def finish(batch: DataFrame, batch_id: int) -> None:
        if reserved:
            _write_reserved(spark, warehouse, table, batch, batch_id)
            return
        _write_numbered(spark, warehouse, table, _settle(spark, warehouse, table, batch), batch_id)

    rows = membership_rows(changes(spark, warehouse.staging("entity"), limits), array, child, strict)
    return run_load(spark, warehouse, table, rows, finish, **how)


def load_measure_dim(spark: SparkSession, warehouse: Warehouse, rows: DataFrame, batch_id: int) -> None:
    """Insert the measures of a batch whose id no earlier batch has.

    The batch's own folder is left out of the comparison, so a batch that runs again inserts the same rows.
    """
    schema = schemas.STORAGE["measure"]
    existing = read_batches(spark, warehouse.table("measure"), schema).where(F.col("batch_id") < batch_id)
    candidates = rows.select(F.col("measure_id").alias("id"), "measure_name")
    write_batch(new_dimension_rows(candidates, existing, "id"), warehouse.table("measure"), batch_id)


def dimension_rows(staging: DataFrame) -> DataFrame:
    """(measure_id, measure_name) of each measure record."""
    return staging.select(
        json_path(RECORD, "$.id", "bigint").alias("measure_id"),
        json_path(RECORD, "$.name", "string").alias("measure_name"),
        *_landed(staging),
    )


_WAITING = T.StructType(
    [
        T.StructField("entity_id", T.LongType()),
        T.StructField("measure_name", T.StringType()),
        T.StructField("value", T.LongType()),
        T.StructField(schemas.LANDED, T.StringType()),
    ]
)


def waiting_facts(spark: SparkSession, warehouse: Warehouse, batch_id: int | None = None) -> DataFrame:
    """Facts whose measure had not come by the last committed batch of ``load_measures``. ``batch_id`` reads an earlier version."""
    last = last_commit(spark, warehouse.table("entity_measure"))[0] if batch_id is None else batch_id
    return read_batches(spark, warehouse.table(WAITING), _WAITING).where(F.col("batch_id") == last).drop("batch_id")


def load_measures(
    spark: SparkSession,
    warehouse: Warehouse,
    array: str = "stats",
    child: str = "stat",
    limits=None,
    ids: str = "dense",
    dimension: str = "facts",
    **how,
) -> StreamingQuery:
    """Insert new measures, then the facts of the same batch.

    Both in one stream: a fact that arrives with its measure would otherwise be dropped by the join. ``ids`` is that of ``load_membership``:
    reserved ones save the facts a work table.

    ``dimension`` says where measures come from: the facts themselves, or with ``records`` the landed records of the endpoint ``measure``. Then a
    fact may come before its measure. It waits: each batch joins its own facts and the waiting ones, stores those that find their measure,
    and keeps the others (``waiting_facts``), those without a name among them. New measures alone start a batch too. A batch that
    runs again reads the same waiting facts and keeps the same ones. One table keeps to one way.
    """
    reserved = _checked(ids) == "reserved"
    if dimension not in ("facts", "records"):
        raise ValueError("dimension is 'facts' or 'records'")
    own = dimension == "records"
    columns = ["entity_id", "measure_id", "value", schemas.LANDED]

    def known(batch_id: int) -> DataFrame:
        rows = read_batches(spark, warehouse.table("measure"), schemas.STORAGE["measure"])
        return rows.where(F.col("batch_id") <= batch_id).select(F.col("id").alias("measure_id"), "measure_name")

    def matched(rows: DataFrame, batch_id: int) -> DataFrame:
        load_measure_dim(spark, warehouse, rows, batch_id)
        return fact_to_dimension(rows.drop("measure_id"), known(batch_id), "measure_name")

    def matched_or_waiting(rows: DataFrame, batch_id: int) -> DataFrame:
        """The facts found, not yet worked out; those that wait are written. Each side joins for itself, which takes less than writing both once more."""
        load_measure_dim(spark, warehouse, rows.where("is_measure"), batch_id)
        facts = rows.where("not is_measure").select(*_WAITING.names).unionByName(waiting_facts(spark, warehouse, batch_id - 1))
        found = left_facts(facts, known(batch_id), "measure_name", "found")
        write_batch(found.where("not found").select(*_WAITING.names), warehouse.table(WAITING), batch_id)
        return found.where("found")

    def finish(batch: DataFrame, batch_id: int) -> None:
        rows = spark.read.parquet(_settle(spark, warehouse, "entity_measure", batch))
        facts = (matched_or_waiting if own else matched)(rows, batch_id).select(*columns)
        if reserved:
            _write_reserved(spark, warehouse, "entity_measure", facts, batch_id)
        else:
            joined = _settle(spark, warehouse, "entity_measure_joined", facts)
            _write_numbered(spark, warehouse, "entity_measure", joined, batch_id)
        if own:
            drop_folder(spark, f"{warehouse.table(WAITING)}/batch_id={batch_id - 2}")

    rows = measure_rows(changes(spark, warehouse.staging("entity"), limits), array, child)
    if own:
        make_folder(spark, warehouse.staging("measure"))
        make_folder(spark, warehouse.table(WAITING))
        measures = dimension_rows(changes(spark, warehouse.staging("measure"), limits))
        measures = measures.withColumn("is_measure", F.lit(True))
        rows = rows.withColumn("is_measure", F.lit(False)).unionByName(measures, allowMissingColumns=True)
    return run_load(spark, warehouse, "entity_measure", rows, finish, **how)


def run_all(
    spark: SparkSession,
    warehouse: Warehouse,
    mode: str = "once",
    latest: bool = False,
    kept: bool = False,
    ids: str = "dense",
    dimension: str = "facts",
    **how,
) -> list[StreamingQuery]:
    """Start every load. The streams are independent; with ``once`` this waits until each has drained.

    ``latest`` and ``kept`` are those of ``load_entities``, ``ids`` those of ``load_membership``, ``dimension`` that of ``load_measures``; with ``kept`` the lookup of cohorts is loaded too, with ``once`` before the entities.
    """
    first = [load_cohorts(spark, warehouse, mode=mode, **how)] if kept else []
    if mode == "once":
        for query in first:
            query.awaitTermination()
    queries = first + [
        load_entities(spark, warehouse, mode=mode, latest=latest, kept=kept, **how),
        load_membership(spark, warehouse, "category_a", *schemas.CATEGORY_A, mode=mode, ids=ids, **how),
        load_membership(spark, warehouse, "category_b", *schemas.CATEGORY_B, mode=mode, ids=ids, **how),
        load_measures(spark, warehouse, *schemas.MEASURES, mode=mode, ids=ids, dimension=dimension, **how),
    ]
    if mode == "once":
        for query in queries:
            query.awaitTermination()
    return queries
