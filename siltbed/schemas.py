"""Record contract, staging and storage schemas.

Primary and foreign keys are invariants that ``operators.keys`` can check; Parquet does not enforce them.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The top-level keys of a record that are kept when it is landed.
RECORD_KEYS = ["id", "name", "names", "species", "pokemon_species", "types", "moves", "stats"]

# Where the record contract keeps its nested arrays, as (array key, child key) or as a key.
CATEGORY_A = ("moves", "move")
CATEGORY_B = ("types", "type")
MEASURES = ("stats", "stat")
COHORT_NAMES = "names"
COHORT_MEMBERS = "pokemon_species"

LISTING = "results array<struct<url: string>>"

STAGING = T.StructType([T.StructField("json_data", T.VariantType())])

NAMED = "struct<name: string, url: string>"
LOCALISED_NAMES = "array<struct<name: string, language: struct<name: string>>>"
MEMBER_NAMES = "array<struct<name: string>>"


def membership_array(child: str) -> str:
    return f"array<struct<{child}: {NAMED}>>"


def measure_array(child: str) -> str:
    return f"array<struct<base_stat: bigint, {child}: {NAMED}>>"


#: Column beside those of staging and storage: the place of a record's run among all runs, as text that sorts like it.
LANDED = "landed"


def with_landed(schema: T.StructType) -> T.StructType:
    """A schema with the run order of its records; null where files were written without it."""
    return T.StructType([*schema.fields, T.StructField(LANDED, T.StringType())])


# A text that is no record is staged beside the records, in columns of its own: the file, the byte at which its split
# starts, the byte from there at which the text starts, and the text. They are null in rows that hold a record.
SET_ASIDE = T.StructType(
    [
        T.StructField("bad_file", T.StringType()),
        T.StructField("bad_start", T.LongType()),
        T.StructField("bad_offset", T.LongType()),
        T.StructField("bad_text", T.StringType()),
    ]
)


def _table(**columns: str) -> T.StructType:
    kinds = {"long": T.LongType(), "text": T.StringType(), "time": T.TimestampType()}
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in columns.items()])


_MEMBERSHIP = _table(id="long", category_id="long", entity_id="long", category_name="text")

# ``lookup_key`` is the raw key an entity was resolved by; it lets a late cohort be resolved again.
STORAGE = {
    "entity": _table(id="long", name="text", cohort="text", lookup_key="text"),
    "category_a": _MEMBERSHIP,
    "category_b": _MEMBERSHIP,
    "measure": _table(id="long", measure_name="text"),
    "entity_measure": _table(id="long", entity_id="long", measure_id="long", value="long"),
}

# One row per load batch: the last surrogate id it gave out.
LEDGER = _table(last_id="long")

AUDIT = _table(
    run_ts="time",
    dataset="text",
    run_kind="text",
    previous="long",
    current="long",
    change="long",
    level="text",
    message="text",
)
