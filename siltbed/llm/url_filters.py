"""URL rules as a sort-merge range join.

With its labels reversed, a host starts with the reversed host of every rule that covers it, so a rule's host is an interval of
keys, and intervals nest or lie apart. One sorted sweep over interval ends and pages carries the stack of rules whose intervals are
open: the state after each end is known from the rules alone, and a page takes the state of the last end before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Pages a bucket of the sweep holds about; each bucket sweeps all rules' ends.
PAGES_A_BUCKET = 500_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without a ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_host(host: Column) -> Column:
    """Labels from the last to the first, each ended by a dot: a sub-domain's key starts with its domain's."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _ends(rules: DataFrame) -> DataFrame:
    """``key``, ``kind``, ``stack``: the rules open after each end of an interval. An end sorts before a start at the same key."""
    host = F.translate(F.substring_index("rule", "/", 1), _UPPER, _LOWER)
    one = F.struct(F.length("rule").alias("length"), "rule", "verdict", "path")
    told = rules.select("rule", F.lower("verdict").alias("verdict"), host.alias("host"))
    told = told.withColumn("path", F.expr("substring(rule, length(host) + 1)")).where("rule is not null and verdict is not null")
    # of equal rules the strictest verdict holds
    told = told.groupBy("rule", "host", "path").agg(F.max("verdict").alias("verdict"))
    hosts = told.groupBy(reversed_host(F.col("host")).alias("key")).agg(F.sort_array(F.collect_list(one)).alias("own"))
    # the hosts above a host are the starts of its key
    up = F.expr("transform(sequence(1, size(split(key, '[.]')) - 1), i -> concat(substring_index(key, '.', i), '.'))")
    chain = hosts.select("key", F.explode(F.array_distinct(up)).alias("above"))
    above = hosts.select(F.col("key").alias("above"), F.col("own").alias("theirs"))
    stacks = chain.join(above, "above").groupBy("key").agg(F.sort_array(F.flatten(F.collect_list("theirs"))).alias("stack"))
    parents = chain.where("above <> key").join(above, "above").groupBy("key").agg(F.sort_array(F.flatten(F.collect_list("theirs"))).alias("outer"))
    both = stacks.join(parents, "key", "left")
    opened = both.select("key", F.lit(1).alias("kind"), "stack")
    # "/" is the character after "."
    closed = both.select(
        F.expr("concat(substring(key, 1, length(key) - 1), '/')").alias("key"),
        F.lit(0).alias("kind"),
        F.coalesce("outer", F.expr("slice(stack, 1, 0)")).alias("stack"),
    )
    return opened.union(closed)


def judge_urls(
    spark: SparkSession,
    pages: DataFrame,
    rules: DataFrame,
    otherwise: str = "allow",
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """Per page: ``host``, ``path``, the longest ``rule`` that fits, and its ``verdict`` (``otherwise`` where none fits).

    ``rules`` has ``rule`` (host, then path, like ``example.com/en/``) and ``verdict`` (allow or block). A rule fits its host and
    sub-domains where the page's path starts with the rule's. The longest rule wins, of equally long ones the one that sorts
    last; of one rule given twice, block. Null or malformed urls have an empty host and path. Repeated rows are judged each.

    Pages are dealt to buckets at random, so a host that has most pages is swept in many tasks. Every bucket meets all ends, which
    are twice the rules: rules are meant to be far fewer than pages.
    """
    url = F.col(url_col).cast("string")
    found = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    buckets = max(spark.sparkContext.defaultParallelism, pages.select(id_col).count() // PAGES_A_BUCKET + 1)
    ends = _ends(rules)
    empty = F.lit(None).cast(ends.schema["stack"].dataType)
    spread = F.pmod(F.xxhash64("page_id", "host", "path", F.monotonically_increasing_id()), F.lit(buckets))
    page_rows = found.select(
        reversed_host(F.col("host")).alias("key"),
        F.lit(2).alias("kind"),
        empty.alias("stack"),
        "page_id",
        "host",
        "path",
        spread.alias("bucket"),
    )
    none = [F.lit(None).cast(found.schema[c].dataType).alias(c) for c in ("page_id", "host", "path")]
    every = F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))
    end_rows = ends.select("key", "kind", "stack", *none, F.explode(every).alias("bucket"))
    sweep = Window.partitionBy("bucket").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = page_rows.union(end_rows).withColumn("open", F.last("stack", ignorenulls=True).over(sweep)).where("kind = 2")
    fits = F.filter("open", lambda r: F.startswith(F.col("path"), r["path"]))
    best = F.element_at(F.when(F.size(fits) > 0, fits), -1)
    return swept.withColumn("best", best).select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict"),
    )
