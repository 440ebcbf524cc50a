"""Each operator bound to the driver's tables, with the SQL its result must equal.

Every query reads its tables whole. Records with nested arrays are built from the columns of one row, never by
collecting a group, so a hot key stays spread over its rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from siltbed import schemas
from siltbed.functions.paths import endpoint_from_url, id_from_url, json_path, json_text_path
from siltbed.operators.dimensions import latest_per_key, new_dimension_rows
from siltbed.operators.flatten import flatten_array, pick_localised
from siltbed.operators.keys import assign_surrogate_ids, check_reference, check_unique
from siltbed.operators.lookups import fact_to_dimension, lookup_chain, refresh_lookup
from siltbed.operators.totals import joined_counts
from siltbed.plans import audit, marts
from siltbed.session import scratch_folder
from siltbed.sources import records
from siltbed.sources.records import RECORD
from siltbed.streaming import ingest, kept, keychecks, loads
from siltbed.streaming.warehouse import Warehouse, commit, write_batch

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def binding(sql: str) -> Callable[[Query], Query]:
    """Register a query under its function's name together with its SQL.

    A trailing underscore, there to keep the operator's own name free, is not part of the name.
    """

    def register(query: Query) -> Query:
        name = query.__name__.rstrip("_")
        QUERIES[name] = query
        ORACLE[name] = sql
        return query

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- marts

def _rank_gap_sql(counts: str, key: str) -> str:
    return f"""
    select {key}, n,
           coalesce(lag(n) over (order by n desc, {key}) - n, 0) as change_from_next_higher,
           coalesce(n - lead(n) over (order by n desc, {key}), 0) as change_from_next_lower
    from ({counts}) c
    """


@binding(
    _rank_gap_sql("select p_size, count(p_partkey) as n from part join lineitem on l_partkey = p_partkey group by 1", "p_size")
)
def rank_gap_category_b(spark, sf_dir):
    part, lineitem = _table(spark, sf_dir, "part"), _table(spark, sf_dir, "lineitem")
    return marts.category_rank_gap(part, "p_partkey", lineitem, "l_partkey", "p_size")


@binding(
    _rank_gap_sql(
        "select l_suppkey, count(o_orderkey) as n from orders join lineitem on l_orderkey = o_orderkey group by 1", "l_suppkey"
    )
)
def rank_gap_category_a(spark, sf_dir):
    orders, lineitem = _table(spark, sf_dir, "orders"), _table(spark, sf_dir, "lineitem")
    return marts.category_rank_gap(orders, "o_orderkey", lineitem, "l_orderkey", "l_suppkey")


@binding(
    _rank_gap_sql(
        "select l_suppkey, count(*) as n from (select distinct l_orderkey, l_suppkey from lineitem) "
        "join orders on l_orderkey = o_orderkey group by 1",
        "l_suppkey",
    )
)
def rank_gap_dedup(spark, sf_dir):
    orders, lineitem = _table(spark, sf_dir, "orders"), _table(spark, sf_dir, "lineitem")
    return marts.category_rank_gap(orders, "o_orderkey", lineitem, "l_orderkey", "l_suppkey", dedup=True)


@binding(_rank_gap_sql("select user_id, count(event_id) as n from events group by 1", "user_id"))
def rank_gap_levels(spark, sf_dir):
    counts = _table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("event_id").alias("n"))
    return marts.rank_gap(counts, "user_id")


@binding(_rank_gap_sql("select event_type, count(event_id) as n from events group by 1", "event_type"))
def rank_gap_window(spark, sf_dir):
    counts = _table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("event_id").alias("n"))
    return marts.rank_gap(counts, "event_type")


@binding(
    "select p_name, cast(sum(cast(l_quantity as bigint)) as bigint) as strength "
    "from lineitem join part on p_partkey = l_partkey group by 1"
)
def strength_rating(spark, sf_dir):
    facts = _table(spark, sf_dir, "lineitem").select("l_partkey", F.col("l_quantity").cast("bigint").alias("value"))
    return marts.strength_rating(_table(spark, sf_dir, "part"), "p_partkey", facts, "l_partkey", "value", "p_name")


@binding(
    "select p_partkey, p_name, cast(sum(cast(l_quantity as bigint)) as bigint) as strength "
    "from lineitem join part on p_partkey = l_partkey group by 1, 2"
)
def strength_rating_by_id(spark, sf_dir):
    facts = _table(spark, sf_dir, "lineitem").select("l_partkey", F.col("l_quantity").cast("bigint").alias("value"))
    part = _table(spark, sf_dir, "part")
    return marts.strength_rating(part, "p_partkey", facts, "l_partkey", "value", "p_name", key="id")


_CENTS = "cast(cast(l_quantity as bigint) * 1000000007 + l_orderkey as decimal(18, 0))"


@binding(
    f"select p_name, cast(sum(cast({_CENTS} / 10000000000.0 as decimal(18, 10))) as decimal(28, 10)) as strength "
    "from (select p_name, l_quantity, l_orderkey from lineitem join part on p_partkey = l_partkey) j group by 1"
)
def strength_rating_decimal(spark, sf_dir):
    """Ten decimals in use: they must survive the totals."""
    value = F.expr(f"cast({_CENTS} / cast(10000000000 as decimal(11, 0)) as decimal(18, 10))")
    facts = _table(spark, sf_dir, "lineitem").select("l_partkey", value.alias("value"))
    return marts.strength_rating(_table(spark, sf_dir, "part"), "p_partkey", facts, "l_partkey", "value", "p_name")


@binding(
    "select o_custkey, o_orderkey, o_orderstatus from orders "
    "qualify row_number() over (partition by o_custkey order by o_orderkey desc) = 1"
)
def latest_per_key_(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    return latest_per_key(orders.union(orders), "o_custkey", "o_orderkey")


def _customer_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _table(spark, sf_dir, "nation").selectExpr("n_nationkey as c_nationkey", "n_regionkey as regionkey")
    region = _table(spark, sf_dir, "region").selectExpr("r_regionkey as regionkey", "r_name as cohort")
    return lookup_chain(_table(spark, sf_dir, "customer"), "c_nationkey", nation, region, "regionkey")


@binding(
    """
select case when grouping(r_name) = 1 then 'All cohorts' else r_name end as cohort,
       case when grouping(o_orderpriority) = 1 then 'All categories' else o_orderpriority end as category,
       count(c_custkey) as quantity
from customer join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey
join orders on o_custkey = c_custkey
group by cube (r_name, o_orderpriority)
"""
)
def cohort_category_cube(spark, sf_dir):
    customers = _customer_regions(spark, sf_dir)
    orders = _table(spark, sf_dir, "orders").withColumnRenamed("o_orderpriority", "category")
    return marts.cohort_category_cube(customers, "c_custkey", "cohort", orders, "o_custkey", "category")


DISTINCT_CUBE = """
select case when grouping(r_name) = 1 then 'All cohorts' else r_name end as cohort,
       case when grouping(o_orderpriority) = 1 then 'All categories' else o_orderpriority end as category,
       count(c_custkey) as quantity, count(distinct c_custkey) as n_distinct
from customer join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey
join orders on o_custkey = c_custkey
group by cube (r_name, o_orderpriority)
"""


@binding(DISTINCT_CUBE)
def cohort_category_cube_distinct(spark, sf_dir):
    customers = _customer_regions(spark, sf_dir)
    orders = _table(spark, sf_dir, "orders").withColumnRenamed("o_orderpriority", "category")
    return marts.cohort_category_cube(customers, "c_custkey", "cohort", orders, "o_custkey", "category", distinct=True)


@binding(DISTINCT_CUBE)
def cohort_category_cube_bitmaps(spark, sf_dir):
    customers = _customer_regions(spark, sf_dir)
    orders = _table(spark, sf_dir, "orders").withColumnRenamed("o_orderpriority", "category")
    return marts.cohort_category_cube(customers, "c_custkey", "cohort", orders, "o_custkey", "category", distinct=True, bitmaps=True)


def _part_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _table(spark, sf_dir, "nation").selectExpr("n_nationkey as p_size", "n_name", "n_regionkey as regionkey")
    region = _table(spark, sf_dir, "region").selectExpr("r_regionkey as regionkey", "r_name")
    return lookup_chain(_table(spark, sf_dir, "part"), "p_size", nation, region, "regionkey")


PART_REGIONS = "part left join nation on n_nationkey = p_size left join region on r_regionkey = n_regionkey"


@binding(
    f"""
select case when grouping(r_name) = 1 then 'Every region' else r_name end as r_name,
       case when grouping(l_returnflag) = 1 then 'Every flag' else l_returnflag end as l_returnflag,
       count(p_partkey) as quantity,
       cast(grouping(r_name) as integer) as is_all_r_name,
       cast(grouping(l_returnflag) as integer) as is_all_l_returnflag
from {PART_REGIONS} join lineitem on l_partkey = p_partkey
group by cube (r_name, l_returnflag)
"""
)
def cube_with_null_cohort(spark, sf_dir):
    return marts.cohort_category_cube(
        _part_regions(spark, sf_dir),
        "p_partkey",
        "r_name",
        _table(spark, sf_dir, "lineitem"),
        "l_partkey",
        "l_returnflag",
        labels=("Every region", "Every flag"),
        flags=True,
    )


@binding(
    """
select case when grouping(event_type) = 1 then 'All' else event_type end as event_type,
       count(user_id) as quantity, count(distinct user_id) as n_distinct
from events group by cube (event_type)
"""
)
def cube_fanout(spark, sf_dir):
    return marts.cube_fanout(_table(spark, sf_dir, "events"), "event_type", "user_id")


@binding("select l_returnflag, p_brand, count(p_partkey) as n from part join lineitem on l_partkey = p_partkey group by 1, 2")
def joined_counts_both_sides(spark, sf_dir):
    part, lineitem = _table(spark, sf_dir, "part"), _table(spark, sf_dir, "lineitem")
    return joined_counts(part, "p_partkey", lineitem, "l_partkey", ["l_returnflag", "p_brand"])


# ---------------------------------------------------------------- lookups, dimensions, keys


@binding(f"select p_partkey, n_name, r_name from {PART_REGIONS}")
def lookup_chain_(spark, sf_dir):
    return _part_regions(spark, sf_dir).select("p_partkey", "n_name", "r_name")


@binding(f"select p_type, count(r_name) as n from {PART_REGIONS} group by 1")
def count_nullable(spark, sf_dir):
    return _part_regions(spark, sf_dir).groupBy("p_type").agg(F.count("r_name").alias("n"))


@binding(
    """
select o_orderkey, c_mktsegment as cohort from orders left join customer on c_custkey = o_custkey
"""
)
def refresh_cohorts(spark, sf_dir):
    customers = _table(spark, sf_dir, "customer").selectExpr("c_custkey as o_custkey", "c_mktsegment as cohort", "c_acctbal")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    early = customers.where("c_acctbal >= 5000").drop("c_acctbal")
    stored = orders.join(early, "o_custkey", "left")
    return refresh_lookup(stored, "o_custkey", "cohort", customers.drop("c_acctbal")).drop("o_custkey")


@binding(
    """
select distinct l_partkey as id, l_returnflag as name from lineitem
where l_partkey not in (select p_partkey from part where p_size < 30)
"""
)
def new_dimension_rows_(spark, sf_dir):
    candidates = _table(spark, sf_dir, "lineitem").selectExpr("l_partkey as id", "l_returnflag as name")
    existing = _table(spark, sf_dir, "part").where("p_size < 30").selectExpr("p_partkey as id")
    return new_dimension_rows(candidates, existing, "id")


@binding("select l_orderkey, l_linenumber, p_size, p_type from lineitem join part on p_partkey = l_partkey")
def fact_to_dimension_(spark, sf_dir):
    facts = _table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_partkey as name")
    dimension = _table(spark, sf_dir, "part").selectExpr("p_partkey as name", "p_size", "p_type")
    return fact_to_dimension(facts, dimension, "name")


@binding(
    "select count(*) as n_rows, count(*) as n_ids, cast(min(1) as bigint) as first_id, count(*) as last_id from lineitem"
)
def surrogate_ids(spark, sf_dir):
    rows = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    numbered = assign_surrogate_ids(rows)
    return numbered.agg(
        F.count("*").alias("n_rows"),
        F.countDistinct("id").alias("n_ids"),
        F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
    )


@binding('select l_orderkey, l_linenumber, count(*) as "count" from lineitem group by 1, 2 having count(*) > 1')
def check_unique_(spark, sf_dir):
    return check_unique(_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@binding(
    'select l_partkey, count(*) as "count" from lineitem '
    "where not exists (select 1 from part where p_partkey = l_partkey and p_size > 10) group by 1"
)
def check_reference_(spark, sf_dir):
    part = _table(spark, sf_dir, "part").where("p_size > 10")
    return check_reference(_table(spark, sf_dir, "lineitem"), "l_partkey", part, "p_partkey")


# ---------------------------------------------------------------- paths and records


@binding("select event_id, cast(json_extract_string(props, '$.k') as integer) as k from events")
def json_text_path_(spark, sf_dir):
    return _table(spark, sf_dir, "events").select("event_id", json_text_path("props", "$.k", "int").alias("k"))


@binding("select event_id, cast(json_extract_string(props, '$.k') as bigint) as k, cast(null as varchar) as missing from events")
def json_path_(spark, sf_dir):
    events = _table(spark, sf_dir, "events").select("event_id", F.parse_json("props").alias(RECORD))
    return events.select(
        "event_id",
        json_path(RECORD, "$.k", "bigint").alias("k"),
        json_path(RECORD, "$.no.such", "string").alias("missing"),
    )


@binding("select event_id from events where cast(json_extract_string(props, '$.k') as integer) = 69")
def json_path_filter(spark, sf_dir):
    return _table(spark, sf_dir, "events").where(json_text_path("props", "$.k", "int") == 69).select("event_id")


def _named(name: Column, id_: Column, child: str) -> Column:
    """One element of a membership array."""
    url = F.concat(F.lit(f"https://api.example.org/v2/{child}/"), id_.cast("string"), F.lit("/"))
    return F.struct(F.struct(name.alias("name"), url.alias("url")).alias(child))


def _measured(name: Column, id_: Column, value: Column, child: str = "stat") -> Column:
    url = F.concat(F.lit(f"https://api.example.org/v2/{child}/"), id_.cast("string"), F.lit("/"))
    return F.struct(
        value.cast("bigint").alias("base_stat"), F.struct(name.alias("name"), url.alias("url")).alias(child)
    )


def _as_variant(df: DataFrame) -> DataFrame:
    return df.select(F.to_variant_object(F.struct("*")).alias(RECORD))


def _line_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record per line item: two categories, or none for small quantities."""
    both = F.array(*[_named(F.col(c), F.ascii(c), "type") for c in ("l_returnflag", "l_linestatus")])
    types = F.when(F.col("l_quantity") > 10, both).otherwise(F.slice(both, 1, 0))
    return _table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.lit("line").alias("name"), types.alias("types")
    )


LINE_MEMBERSHIP = """
select l_orderkey as entity_id, cast(ascii(l_returnflag) as bigint) as category_id, l_returnflag as category_name
from lineitem where l_quantity > 10
union all
select l_orderkey, cast(ascii(l_linestatus) as bigint), l_linestatus from lineitem where l_quantity > 10
"""


@binding(LINE_MEMBERSHIP)
def flatten_membership(spark, sf_dir):
    staging = scratch_folder(spark, "staging")
    _as_variant(_line_records(spark, sf_dir)).write.parquet(staging)
    return loads.membership_rows(spark.read.schema(schemas.STAGING).parquet(staging), *schemas.CATEGORY_B)


@binding(
    """
select o_orderkey, cast(n as bigint) as n, o_orderstatus || n as label
from orders, (values (1), (2), (3)) v(n) where o_orderpriority <> '1-URGENT'
"""
)
def flatten_array_(spark, sf_dir):
    def element(n: int) -> Column:
        return F.struct(F.lit(n).cast("bigint").alias("n"), F.concat("o_orderstatus", F.lit(str(n))).alias("label"))

    # A missing array (NULL) drops its parent just as an empty one does.
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderpriority") != "1-URGENT", F.array(*map(element, (1, 2, 3)))).alias("a")
    )
    return flatten_array(orders, "a", "e", ["o_orderkey"]).select("o_orderkey", "e.n", "e.label")


@binding("select doc_id, source as label from documents where lang = 'en'")
def pick_localised_(spark, sf_dir):
    def name(text: Column, language: Column) -> Column:
        return F.struct(text.alias("name"), F.struct(language.alias("name")).alias("language"))

    names = F.array(name(F.col("source"), F.col("lang")), name(F.concat("source", F.lit("-fr")), F.lit("fr")))
    documents = _table(spark, sf_dir, "documents").select("doc_id", names.alias("names"))
    return pick_localised(documents, "names", "en", "label", ["doc_id"])


@binding("select l_orderkey as order_id, l_partkey as part_id, cast(null as bigint) as bad_id from lineitem")
def id_from_url_(spark, sf_dir):
    lineitem = _table(spark, sf_dir, "lineitem")
    order_url = F.concat(F.lit("https://api.example.org/order/"), F.col("l_orderkey").cast("string"), F.lit("/"))
    part_url = F.concat(F.lit("https://api.example.org/part/"), F.col("l_partkey").cast("string"), F.lit("/x"))
    no_slash = F.concat(F.lit("https://api.example.org/part/"), F.col("l_partkey").cast("string"))
    return lineitem.select(
        id_from_url(order_url).alias("order_id"),
        id_from_url(part_url, strict=False).alias("part_id"),
        id_from_url(no_slash, strict=False).alias("bad_id"),
    )


@binding("select page_id, string_split(url, '/')[-2] as endpoint from pages")
def endpoint_from_url_(spark, sf_dir):
    return _table(spark, sf_dir, "pages").select("page_id", endpoint_from_url("url").alias("endpoint"))


@binding(
    """
select event_id, json_object('event_type', event_type, 'user_id', user_id)::varchar as record from events
"""
)
def project_keys_(spark, sf_dir):
    whole = F.to_variant_object(F.struct("event_id", "event_type", "user_id", "props"))
    kept = records.project_keys(whole, ["user_id", "event_type", "absent"])
    return _table(spark, sf_dir, "events").select("event_id", F.to_json(kept).alias("record"))


@binding(
    """
select url, string_split(url, '/')[-2] as endpoint from pages
union all select 'https://api.example.org/page/' || page_id || '/', cast(page_id as varchar) from pages
"""
)
def resource_catalog_(spark, sf_dir):
    own = F.concat(F.lit("https://api.example.org/page/"), F.col("page_id").cast("string"), F.lit("/"))
    results = F.array(F.struct(F.col("url").alias("url")), F.struct(own.alias("url")))
    listing = _table(spark, sf_dir, "pages").select(F.to_json(F.struct(results.alias("results"))).alias("payload"))
    return records.resource_catalog(listing)


@binding(
    """
select c_custkey as id, c_name as name from customer
union all select c_custkey + 1, c_mktsegment from customer where c_acctbal >= 0
"""
)
def read_json_records_(spark, sf_dir):
    """Lines that are an array of two records, mixed with lines that are one record."""
    return records.read_json_records(spark, _landed_arrays(spark, sf_dir)).select(
        json_path(RECORD, "$.id", "bigint").alias("id"), json_path(RECORD, "$.name", "string").alias("name")
    )


@binding(
    """
select c_custkey as id, c_name as name, false as whole from customer
union all select c_custkey + 1, c_mktsegment, false from customer where c_acctbal >= 0
"""
)
def read_json_keys(spark, sf_dir):
    """The same lines, taken apart record by record; a key that is not asked for is not there."""
    rows = records.read_json_records(spark, _landed_arrays(spark, sf_dir), keys=["id", "name", "absent"])
    return rows.select(
        json_path(RECORD, "$.id", "bigint").alias("id"),
        json_path(RECORD, "$.name", "string").alias("name"),
        F.to_json(RECORD).like("%absent%").alias("whole"),
    )


def _landed_arrays(spark: SparkSession, sf_dir: str) -> str:
    customer = _table(spark, sf_dir, "customer")
    first = F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    second = F.struct((F.col("c_custkey") + 1).alias("id"), F.col("c_mktsegment").alias("name"))
    line = F.when(F.col("c_acctbal") >= 0, F.to_json(F.array(first, second))).otherwise(F.to_json(first))
    path = scratch_folder(spark, "json-arrays")
    customer.select(line.alias("value")).write.text(path)
    return path


@binding("select c_custkey as id, c_name as name, cast(null as varchar) as not_kept from customer")
def land_records_(spark, sf_dir):
    root = scratch_folder(spark, "landing")
    whole = _as_variant(_table(spark, sf_dir, "customer").withColumnsRenamed({"c_custkey": "id", "c_name": "name"}))
    records.land_records(whole.select(records.project_keys(RECORD).alias(RECORD)), root, "entity", "1")
    records.land_records(_table(spark, sf_dir, "nation"), root, "cohort", "1")
    landed = records.read_json_records(spark, f"{root}/*/*", pattern=".*/entity/.*")
    return landed.select(
        json_path(RECORD, "$.id", "bigint").alias("id"),
        json_path(RECORD, "$.name", "string").alias("name"),
        json_path(RECORD, "$.c_mktsegment", "string").alias("not_kept"),
    )


def _landed_literals(spark: SparkSession, sf_dir: str, nothing: Column) -> str:
    quoted = F.col("text")
    for raw, escaped in (("\\", "\\\\"), ("'", "\\'"), ("\n", "\\n"), ("\r", "\\r")):
        quoted = F.replace(quoted, F.lit(raw), F.lit(escaped))
    literal = F.concat(
        F.lit("{'doc_id': "), F.col("doc_id").cast("string"), F.lit(", 'text': '"), quoted,
        F.lit("', 'seen': True, 'nothing': "), nothing, F.lit(", 'about': {'lang': '"), F.col("lang"), F.lit("'}}"),
    )
    path = scratch_folder(spark, "literals")
    _table(spark, sf_dir, "documents").select(literal.alias("value")).write.option("lineSep", ",").text(path)
    return path


@binding("select doc_id, lang in ('de', 'fr') as bad from documents")
def literal_quarantine(spark, sf_dir):
    """Literal records, those of two languages with a value that is none."""
    nothing = F.when(F.col("lang") == "fr", "nan").when(F.col("lang") == "de", "-inf").otherwise("None")
    rows = records.read_literal_records(spark, _landed_literals(spark, sf_dir, nothing), malformed="QUARANTINE")
    told = F.regexp_extract("bad_text", "^[{]'doc_id': ([0-9]+),", 1).cast("bigint")
    return rows.select(
        F.coalesce(json_path(RECORD, "$.doc_id", "bigint"), told).alias("doc_id"), F.col("bad_text").isNotNull().alias("bad")
    )


@binding("select doc_id, text, lang, true as seen, cast(null as varchar) as nothing from documents")
def read_literal_records_(spark, sf_dir):
    """Documents landed as comma-joined Python literals."""
    return records.read_literal_records(spark, _landed_literals(spark, sf_dir, F.lit("None"))).select(
        json_path(RECORD, "$.doc_id", "bigint").alias("doc_id"),
        json_path(RECORD, "$.text", "string").alias("text"),
        json_path(RECORD, "$.about.lang", "string").alias("lang"),
        json_path(RECORD, "$.seen", "boolean").alias("seen"),
        json_path(RECORD, "$.nothing", "string").alias("nothing"),
    )


# ---------------------------------------------------------------- audit


MONTHLY_AUDIT = """
select run_ts, dataset, 'scheduled' as run_kind, previous, "current", "current" - previous as change,
       case when previous = "current" then 'INFO' else 'WARNING' end as "level",
       'Scheduled run. ' || dataset || ': ' || case
         when previous is null then 'first check, count is ' || "current"
         when previous = "current" then 'unchanged, count is still ' || "current"
         when previous > "current" then 'count dropped from ' || previous || ' to ' || "current"
         else 'count increased from ' || previous || ' to ' || "current" end as message
from (
  select *, lag("current") over (partition by dataset order by run_ts) as previous
  from (select date_trunc('month', o_orderdate)::timestamp as run_ts, o_orderpriority as dataset, count(*) as "current"
        from orders group by 1, 2) m
) r
"""


@binding(MONTHLY_AUDIT)
def audit_history_(spark, sf_dir):
    monthly = (
        _table(spark, sf_dir, "orders")
        .groupBy(F.date_trunc("month", "o_orderdate").alias("run_ts"), F.col("o_orderpriority").alias("dataset"))
        .agg(F.count("*").alias("current"))
        .withColumn("run_kind", F.lit("scheduled"))
    )
    return audit.audit_history(monthly)


@binding(
    f"""
select strftime(run_ts, '%Y-%m-%d %H:%M:%S') || ' => ' || "level" || ' => ' || message as line, "current" as n
from ({MONTHLY_AUDIT}) a
"""
)
def audit_log_lines(spark, sf_dir):
    lines = audit.log_lines(QUERIES["audit_history"](spark, sf_dir))
    return lines.select("line", audit.count_from_log_line("line").alias("n"))


@binding(
    """
select 'orders' as dataset, 'manual' as run_kind, cast(null as bigint) as previous, count(*) as "current",
       cast(null as bigint) as change, 'WARNING' as "level",
       'Manual run. orders: first check, count is ' || count(*) as message from orders
union all
select 'orders', 'scheduled', (select count(*) from orders), count(*), count(*) - (select count(*) from orders), 'WARNING',
       'Scheduled run. orders: count increased from ' || (select count(*) from orders) || ' to ' || count(*) from lineitem
union all
select 'orders', 'scheduled', (select count(*) from lineitem), count(*), 0, 'INFO',
       'Scheduled run. orders: unchanged, count is still ' || count(*) from lineitem
"""
)
def count_audit_(spark, sf_dir):
    path = scratch_folder(spark, "audit")
    runs = [("orders", "manual"), ("lineitem", "scheduled"), ("lineitem", "scheduled")]
    for day, (table, kind) in enumerate(runs, start=1):
        run_ts = F.make_timestamp(F.lit(2024), F.lit(1), F.lit(day), F.lit(0), F.lit(0), F.lit(0))
        audit.count_audit(spark, path, "orders", _table(spark, sf_dir, table), kind, run_ts)
    return spark.read.schema(schemas.AUDIT).parquet(path).drop("run_ts")


@binding("select o_orderkey, o_custkey as n, cast(null as bigint) as no_count from orders")
def count_from_log_line_(spark, sf_dir):
    line = F.concat(F.col("o_orderdate").cast("string"), F.lit(" => INFO => The count is "), F.col("o_custkey").cast("string"))
    return _table(spark, sf_dir, "orders").select(
        "o_orderkey",
        audit.count_from_log_line(line).alias("n"),
        audit.count_from_log_line(F.concat(line, F.lit(" rows"))).alias("no_count"),
    )


# ---------------------------------------------------------------- ingest and loads


def _order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record per order: its customer as the cohort key, two categories, three measures."""
    priority = F.substring("o_orderpriority", 1, 1)

    def month(form: str) -> Column:
        return F.date_format("o_orderdate", form)

    measures = [
        _measured(F.lit("year"), F.lit(1), F.year("o_orderdate")),
        _measured(F.lit("month"), F.lit(2), F.month("o_orderdate")),
        _measured(F.concat(F.lit("status-"), "o_orderstatus"), F.ascii("o_orderstatus"), F.dayofmonth("o_orderdate")),
    ]
    return _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("customer "), F.col("o_custkey").cast("string")).alias("name"),
        F.struct(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("name")).alias("species"),
        F.array(
            _named(F.col("o_orderstatus"), F.ascii("o_orderstatus"), "type"),
            _named(F.col("o_orderpriority"), priority, "type"),
        ).alias("types"),
        F.array(_named(month("yyyy-MM"), month("yyyyMM"), "move")).alias("moves"),
        F.array(*measures).alias("stats"),
    )


DEBTOR = "c_acctbal < 0"


def _cohort_records(customers: DataFrame, english: str = f"not {DEBTOR}") -> DataFrame:
    """A record per customer: the market segment is its name, in English where the condition holds, always in French."""

    def name(text: Column, language: str) -> Column:
        return F.struct(text.alias("name"), F.struct(F.lit(language).alias("name")).alias("language"))

    french = name(F.concat(F.lit("fr-"), "c_mktsegment"), "fr")
    names = F.when(F.expr(english), F.array(french, name(F.col("c_mktsegment"), "en"))).otherwise(F.array(french))
    members = F.array(F.struct(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("name")))
    return customers.select(
        F.col("c_custkey").alias("id"), names.alias("names"), members.alias(schemas.COHORT_MEMBERS)
    )


def _ingested(spark: SparkSession, runs: list[dict[str, DataFrame]]) -> Warehouse:
    """A new warehouse with the runs' records landed and copied into staging."""
    warehouse = Warehouse(scratch_folder(spark, "warehouse")).create(spark)
    for number, endpoints in enumerate(runs):
        for endpoint, rows in endpoints.items():
            records.land_records(rows, warehouse.landing(), endpoint, str(number))
        for query in [ingest_endpoint(spark, warehouse, endpoint) for endpoint in endpoints]:
            query.awaitTermination()
    return warehouse


def ingest_endpoint(spark: SparkSession, warehouse: Warehouse, endpoint: str, **how):
    return ingest.ingest_stream(
        spark,
        warehouse.landing(),
        warehouse.staging(endpoint),
        warehouse.checkpoint(f"ingest_{endpoint}"),
        pattern=f".*/{endpoint}/.*",
        **how,
    )


ORDER_COHORTS = "orders left join customer on c_custkey = o_custkey and c_acctbal >= 0"


@binding("select o_orderkey as id, 'customer ' || o_custkey as name from orders union all select n_nationkey, n_name from nation")
def ingest_stream_(spark, sf_dir):
    """Two runs into one staging table, with another endpoint's files beside them."""
    nation = _table(spark, sf_dir, "nation").selectExpr("n_nationkey as id", "n_name as name")
    warehouse = _ingested(
        spark, [{"cohort": _cohort_records(_table(spark, sf_dir, "customer")), "entity": _order_records(spark, sf_dir)}, {"entity": nation}]
    )
    return loads.entity_rows(spark.read.schema(schemas.STAGING).parquet(warehouse.staging("entity"))).select("id", "name")


_LINE = """'{"id":' || c_custkey || ',"name":"' || c_name || '"}'"""


def _set_aside(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A record per customer, ingested; those of debtors were landed cut short, by one to five characters."""
    customers = _table(spark, sf_dir, "customer")
    line = F.to_json(F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")))
    line = F.when(F.expr(DEBTOR), F.substring(line, F.lit(1), F.length(line) - 1 - F.col("c_custkey") % 5)).otherwise(line)
    warehouse = Warehouse(scratch_folder(spark, "warehouse")).create(spark)
    customers.select(line.alias("value")).write.text(records.landing_path(warehouse.landing(), "entity", "1"))
    ingest_endpoint(spark, warehouse, "entity", malformed="QUARANTINE").awaitTermination()
    return warehouse


@binding(
    f"""
select c_custkey as id, cast(null as varchar) as text from customer where not {DEBTOR}
union all select null, left(line, length(line)::int - 1 - (c_custkey % 5)::int)
from (select c_custkey, {_LINE} as line from customer where {DEBTOR}) c
"""
)
def quarantine_stream(spark, sf_dir):
    """The records of one ingest, and the texts it set aside."""
    staging = _set_aside(spark, sf_dir).staging("entity")
    staged = loads.staged(spark, staging).select(json_path(RECORD, "$.id", "bigint").alias("id"), F.lit(None).cast("string").alias("text"))
    return staged.union(ingest.quarantined(spark, staging).select(F.lit(None).cast("bigint"), "text"))


@binding("select c_custkey as id, c_name as name from customer")
def replay_stream(spark, sf_dir):
    """What was set aside is repaired, landed again and ingested, each text once though it is given twice."""
    warehouse = _set_aside(spark, sf_dir)
    whole = _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.to_json(F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))).alias("text")
    )
    cut = ingest.quarantined(spark, warehouse.staging("entity"))
    cut = cut.select("file", "start", "offset", F.regexp_extract("text", ":([0-9]+),", 1).cast("bigint").alias("id"))
    for _ in range(2):
        ingest.replay(spark, cut.join(whole, "id").drop("id"), warehouse.landing(), warehouse.replays("entity"), "entity")
        ingest_endpoint(spark, warehouse, "entity", malformed="QUARANTINE").awaitTermination()
    return loads.entity_rows(loads.staged(spark, warehouse.staging("entity"))).select("id", "name")


@binding(f"select o_orderkey as id, 'customer ' || o_custkey as name, c_mktsegment as cohort from {ORDER_COHORTS}")
def load_entities_stream(spark, sf_dir):
    warehouse = _ingested(
        spark, [{"cohort": _cohort_records(_table(spark, sf_dir, "customer")), "entity": _order_records(spark, sf_dir)}]
    )
    loads.load_entities(spark, warehouse).awaitTermination()
    return warehouse.read(spark, "entity").drop("lookup_key")


@binding(f"select o_orderkey as id, 'customer ' || o_custkey as name, c_mktsegment as cohort from {ORDER_COHORTS}")
def load_entities_kept_stream(spark, sf_dir):
    """Cohorts landed in two runs, the first with names for all of them; the lookup that is kept has each as the second run has it."""
    customers = _table(spark, sf_dir, "customer")
    old = {"cohort": _cohort_records(customers, english="true")}
    warehouse = _ingested(spark, [old, {"cohort": _cohort_records(customers), "entity": _order_records(spark, sf_dir)}])
    loads.load_cohorts(spark, warehouse, limits={"max_files": 1}).awaitTermination()
    loads.load_entities(spark, warehouse, kept=True).awaitTermination()
    return warehouse.read(spark, "entity").drop("lookup_key")


@binding(
    """
select 'then' as seen, o_orderkey as id from orders where o_orderstatus = 'F' union all select 'now', o_orderkey from orders
"""
)
def warehouse_state(spark, sf_dir):
    """A table as it was after the first of two batches, and as it is."""
    rows = _order_records(spark, sf_dir).withColumn("status", F.col("types")[0]["type"]["name"])
    first, rest = rows.where("status = 'F'").drop("status"), rows.where("status <> 'F'").drop("status")
    warehouse = _ingested(spark, [{"entity": first}])
    loads.load_entities(spark, warehouse).awaitTermination()
    state = warehouse.state(spark)
    records.land_records(rest, warehouse.landing(), "entity", "later")
    ingest_endpoint(spark, warehouse, "entity").awaitTermination()
    loads.load_entities(spark, warehouse).awaitTermination()
    then, now = warehouse.read(spark, "entity", state=state), warehouse.read(spark, "entity")
    return then.select(F.lit("then").alias("seen"), "id").union(now.select(F.lit("now"), "id"))


@binding("select o_orderkey as id, c_mktsegment as cohort from orders left join customer on c_custkey = o_custkey")
def refreshed_entities_stream(spark, sf_dir):
    """Entities that were loaded before the cohorts of some of them arrived."""
    customers = _table(spark, sf_dir, "customer")
    early = _cohort_records(customers.where(f"not {DEBTOR}"))
    warehouse = _ingested(spark, [{"cohort": early, "entity": _order_records(spark, sf_dir)}])
    loads.load_entities(spark, warehouse).awaitTermination()
    late = _cohort_records(customers.where(DEBTOR), english="true")
    records.land_records(late, warehouse.landing(), "cohort", "late")
    ingest_endpoint(spark, warehouse, "cohort").awaitTermination()
    return loads.refreshed_entities(spark, warehouse).select("id", "cohort")


@binding(LINE_MEMBERSHIP)
def load_membership_stream(spark, sf_dir):
    warehouse = _ingested(spark, [{"entity": _line_records(spark, sf_dir)}])
    loads.load_membership(spark, warehouse, "category_b", *schemas.CATEGORY_B).awaitTermination()
    return warehouse.read(spark, "category_b").drop("id")


@binding(f"select entity_id, category_id, category_name, 1::bigint as n_of_id from ({LINE_MEMBERSHIP}) m")
def load_membership_reserved_stream(spark, sf_dir):
    """Two batches with ids given as rows are written: each id belongs to one row."""
    lines, returned = _line_records(spark, sf_dir), "coalesce(get(types, 0).type.name = 'R', false)"
    warehouse = _ingested(spark, [{"entity": lines.where(returned)}, {"entity": lines.where(f"not {returned}")}])
    how = {"limits": {"max_files": 1}, "ids": "reserved"}
    loads.load_membership(spark, warehouse, "category_b", *schemas.CATEGORY_B, **how).awaitTermination()
    rows = warehouse.read(spark, "category_b")
    return rows.join(rows.groupBy("id").agg(F.count("*").alias("n_of_id")), "id").drop("id")


def _line_measures_warehouse(spark: SparkSession, sf_dir: str, **how) -> Warehouse:
    """Measures loaded in two runs: the second finds a dimension that is not empty and adds to it."""
    warehouse = _ingested(spark, [{"entity": _line_measures(spark, sf_dir, "A")}])
    loads.load_measures(spark, warehouse, **how).awaitTermination()
    records.land_records(_line_measures(spark, sf_dir, None), warehouse.landing(), "entity", "2")
    ingest_endpoint(spark, warehouse, "entity").awaitTermination()
    loads.load_measures(spark, warehouse, **how).awaitTermination()
    return warehouse


def _line_measures(spark: SparkSession, sf_dir: str, flag: str | None) -> DataFrame:
    """A record per line item of a return flag (None: of all others): quantity under its flag and status."""
    lineitem = _table(spark, sf_dir, "lineitem")
    lineitem = lineitem.where(F.col("l_returnflag") == flag if flag else F.col("l_returnflag") != "A")
    stats = [
        _measured(F.concat(F.lit(f"{c}-"), F.col(c)), F.ascii(c) + offset, F.col("l_quantity"))
        for c, offset in (("l_returnflag", 0), ("l_linestatus", 1000))
    ]
    return lineitem.select(F.col("l_orderkey").alias("id"), F.array(*stats).alias("stats"))


LINE_MEASURES = """
select l_orderkey as entity_id, cast(ascii(l_returnflag) as bigint) as measure_id,
       'l_returnflag-' || l_returnflag as measure_name, cast(l_quantity as bigint) as value from lineitem
union all
select l_orderkey, cast(ascii(l_linestatus) + 1000 as bigint), 'l_linestatus-' || l_linestatus, cast(l_quantity as bigint)
from lineitem
"""


@binding(f"select distinct measure_id as id, measure_name from ({LINE_MEASURES}) m")
def load_measure_dim_stream(spark, sf_dir):
    return _line_measures_warehouse(spark, sf_dir).read(spark, "measure")


@binding(f"select entity_id, measure_id, value from ({LINE_MEASURES}) m")
def load_measures_stream(spark, sf_dir):
    return _line_measures_warehouse(spark, sf_dir).read(spark, "entity_measure").drop("id")


@binding(f"select entity_id, measure_id, value from ({LINE_MEASURES}) m")
def load_measures_reserved_stream(spark, sf_dir):
    return _line_measures_warehouse(spark, sf_dir, ids="reserved").read(spark, "entity_measure").drop("id")


@binding(
    f"""
select case when measure_name = 'l_linestatus-F' then 'waiting' else 'stored' end as place, entity_id,
       case when measure_name <> 'l_linestatus-F' then measure_id end as measure_id, value
from ({LINE_MEASURES}) m
"""
)
def late_facts_stream(spark, sf_dir):
    """Facts land before their measures, which come in two later runs; one measure never comes."""
    warehouse = _ingested(spark, [{"entity": _line_measures(spark, sf_dir, "A")}])
    loads.load_measures(spark, warehouse, dimension="records").awaitTermination()
    lineitem = _table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus").distinct()
    names = [lineitem.select(F.concat(F.lit(f"{c}-"), c).alias("name"), (F.ascii(c) + offset).alias("id")) for c, offset in (("l_returnflag", 0), ("l_linestatus", 1000))]
    measures = names[0].union(names[1]).where("name <> 'l_linestatus-F'").distinct()
    for run, part in enumerate(("id < 1000", "id > 1000")):
        records.land_records(measures.where(part), warehouse.landing(), "measure", f"measures-{run}")
        ingest_endpoint(spark, warehouse, "measure").awaitTermination()
        if run:
            records.land_records(_line_measures(spark, sf_dir, None), warehouse.landing(), "entity", "late")
            ingest_endpoint(spark, warehouse, "entity").awaitTermination()
        loads.load_measures(spark, warehouse, dimension="records").awaitTermination()
    stored = warehouse.read(spark, "entity_measure").select(F.lit("stored").alias("place"), "entity_id", "measure_id", "value")
    waiting = loads.waiting_facts(spark, warehouse).select(F.lit("waiting"), "entity_id", F.lit(None).cast("long"), "value")
    return stored.union(waiting)


@binding(
    """
select 'entity' as of, o_custkey as key, count(*) as n from orders group by o_custkey having count(*) > 1
union all
select 'category_a', l_orderkey, count(*) from lineitem
where l_orderkey not in (select o_custkey from orders) group by l_orderkey
"""
)
def key_checks_stream(spark, sf_dir):
    """Three batches of entities with repeated ids and two of children, each checked against what came before it."""
    orders, lineitem = _table(spark, sf_dir, "orders"), _table(spark, sf_dir, "lineitem")
    warehouse = Warehouse(scratch_folder(spark, "warehouse")).create(spark)
    for run, status in enumerate(("F", "O", "P")):
        rows = orders.where(F.col("o_orderstatus") == status).select(F.col("o_custkey").alias("id"), F.lit("c").alias("name"))
        records.land_records(rows, warehouse.landing(), "entity", str(run))
        ingest_endpoint(spark, warehouse, "entity").awaitTermination()
        loads.load_entities(spark, warehouse).awaitTermination()
        if run < 2:
            part = lineitem.where(F.col("l_linestatus") == status)
            children = part.selectExpr("l_linenumber as id", "l_partkey as category_id", "l_orderkey as entity_id", "l_linestatus as category_name")
            write_batch(children.selectExpr(*(f"cast({f.name} as {f.dataType.simpleString()}) as {f.name}" for f in schemas.STORAGE["category_a"])), warehouse.table("category_a"), run)
            commit(spark, warehouse.table("category_a"), run, "children")
        keychecks.update_reference(spark, warehouse, "category_a", "entity_id", "entity", "id", 16)
    found = keychecks.duplicate_keys(spark, warehouse, "entity", ["id"]).selectExpr("'entity' as of", "id as key", "count as n")
    orphans = keychecks.orphan_keys(spark, warehouse, "category_a", "entity_id", "entity", "id")
    return found.union(orphans.selectExpr("'category_a'", "entity_id", "count"))


def _loaded_orders(spark: SparkSession, sf_dir: str) -> Warehouse:
    warehouse = _ingested(
        spark, [{"cohort": _cohort_records(_table(spark, sf_dir, "customer")), "entity": _order_records(spark, sf_dir)}]
    )
    loads.run_all(spark, warehouse)
    return warehouse


ORDER_STATS = f"""
with entity as (select o_orderkey as id, 'customer ' || o_custkey as name, c_mktsegment as cohort from {ORDER_COHORTS}),
category_b as (select o_orderkey as entity_id, o_orderstatus as category_name from orders
               union all select o_orderkey, o_orderpriority from orders),
category_a as (select o_orderkey as entity_id, strftime(o_orderdate, '%Y-%m') as category_name from orders),
gap_a as (select category_name, count(id) as n from entity join category_a on entity_id = id group by 1),
gap_b as (select category_name, count(id) as n from entity join category_b on entity_id = id group by 1),
strength as (
  select 'customer ' || o_custkey as name, cast(sum(year(o_orderdate) + month(o_orderdate) + day(o_orderdate)) as bigint) as n
  from orders group by 1)
"""


MART_ROWS = (
    ORDER_STATS
    + """
select 'category_a_rank_gap' as mart, category_name as key, cast(null as varchar) as category, n,
       coalesce(lag(n) over (order by n desc, category_name) - n, 0) as higher,
       coalesce(n - lead(n) over (order by n desc, category_name), 0) as lower from gap_a
union all
select 'category_b_rank_gap', category_name, null, n,
       coalesce(lag(n) over (order by n desc, category_name) - n, 0),
       coalesce(n - lead(n) over (order by n desc, category_name), 0) from gap_b
union all
select 'strength_rating', name, null, n, null, null from strength
union all
select 'cohort_category_totals', case when grouping(cohort) = 1 then 'All cohorts' else cohort end,
       case when grouping(category_name) = 1 then 'All categories' else category_name end, count(id), null, null
from entity join category_b on entity_id = id group by cube (cohort, category_name)
"""
)


@binding(MART_ROWS)
def warehouse_marts(spark, sf_dir):
    """Land, ingest, load everything, register the marts, and read all four of them."""
    warehouse = _loaded_orders(spark, sf_dir)
    tables = {name: warehouse.read(spark, name) for name in schemas.STORAGE}
    marts.register_marts(spark, tables)
    return _mart_rows(spark)


@binding(
    ORDER_STATS
    + """
select cohort, category_name, count(id) as n from entity join category_b on entity_id = id group by 1, 2
"""
)
def kept_counts_stream(spark, sf_dir):
    """Counts kept over three batches of entities and members, each brought up to date before the next one comes."""
    orders, warehouse = _order_records(spark, sf_dir), _ingested(spark, [{"cohort": _cohort_records(_table(spark, sf_dir, "customer"))}])
    status = F.col("types")[0]["type"]["name"]
    for run, part in enumerate(("F", "O", "P")):
        records.land_records(orders.where(status == part), warehouse.landing(), "entity", f"part-{run}")
        ingest_endpoint(spark, warehouse, "entity").awaitTermination()
        # members come before their entities in the second run
        steps = [lambda: loads.load_entities(spark, warehouse), lambda: loads.load_membership(spark, warehouse, "category_b", *schemas.CATEGORY_B)]
        for step in steps[:: -1 if run == 1 else 1]:
            step().awaitTermination()
            kept.update_counts(spark, warehouse)
    return kept.kept_counts(spark, warehouse)


@binding(MART_ROWS)
def warehouse_marts_two_runs(spark, sf_dir):
    """Every record landed in two runs, the first with other categories, measures and cohorts: the marts are those of the second alone."""
    cohorts, entities = _cohort_records(_table(spark, sf_dir, "customer")), _order_records(spark, sf_dir)
    old = entities.withColumns({"types": F.concat("types", "types"), "stats": F.slice("stats", 1, 1), "name": F.lit("old")})
    runs = [{"cohort": _cohort_records(_table(spark, sf_dir, "customer"), english="true"), "entity": old}, {"cohort": cohorts, "entity": entities}]
    warehouse = _ingested(spark, runs)
    loads.run_all(spark, warehouse, latest=True)
    tables = {name: warehouse.read(spark, name, landed=True) for name in schemas.STORAGE}
    marts.register_marts(spark, tables, latest=schemas.LANDED)
    return _mart_rows(spark)


def _mart_rows(spark: SparkSession) -> DataFrame:
    gap = "select '{0}' as mart, category_name as key, cast(null as string) as category, n, " + (
        "change_from_next_higher as higher, change_from_next_lower as lower from {0}"
    )
    return spark.sql(
        f"""
        {gap.format("category_a_rank_gap")} union all {gap.format("category_b_rank_gap")}
        union all select 'strength_rating', name, null, strength, null, null from strength_rating
        union all select 'cohort_category_totals', cohort, category, quantity, null, null from cohort_category_totals
        """
    )
