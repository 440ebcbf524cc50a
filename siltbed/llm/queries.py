"""The queries of this subpackage over the given tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: The url rules of the query.
URL_RULES = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]

#: Shares of tokens that the mix aims at, by domain.
TARGETS = {"en": 0.55, "de": 0.15, "fr": 0.17, "es": 0.13}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer() -> str:
    """The vocabulary file of the token queries."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltbed.llm.token_counts import token_counts

    return token_counts(_table(spark, sf_dir, "documents"), tokenizer(), limit=1024)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltbed.llm.quality_rules import quality_rules

    return quality_rules(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltbed.llm.topk import top_k

    vectors = _table(spark, sf_dir, "embeddings")
    return top_k(spark, vectors, vectors.where("vec_id % 100 = 0"), k=10, scale=1024)


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltbed.llm.url_filters import judge_urls

    rules = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    return judge_urls(spark, _table(spark, sf_dir, "pages"), rules)


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltbed.llm.chat import format_chats

    return format_chats(_table(spark, sf_dir, "conversations"))


def domain_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The labelled table of the mixing: the language of documents that have a label."""
    known = labels.select("doc_id").distinct()
    return docs.select("doc_id", F.col("lang").alias("domain")).join(known, "doc_id", "left_semi")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltbed.llm.mixing import mix

    docs = _table(spark, sf_dir, "documents")
    return mix(spark, docs, domain_labels(docs, _table(spark, sf_dir, "labels")), TARGETS, tokenizer())


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltbed.llm.rule_ensemble import quality_scores

    return quality_scores(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltbed.llm.near_dedup import near_duplicates

    return near_duplicates(spark, _table(spark, sf_dir, "documents"), threshold=0.8, width=2)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltbed.llm.packing import pack

    return pack(_table(spark, sf_dir, "documents"), tokenizer(), capacity=1024)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltbed.llm.repeats import remove_repeats

    cut = remove_repeats(spark, _table(spark, sf_dir, "documents"), length=50)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltbed.llm.cosine_dedup import near_vectors

    return near_vectors(spark, _table(spark, sf_dir, "embeddings"), threshold=0.98)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltbed.llm.whitening import whiten

    return whiten(spark, _table(spark, sf_dir, "embeddings"), components=32, scale=64, offset=1_000_000)


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltbed.llm.centroids import cluster_vectors

    return cluster_vectors(spark, _table(spark, sf_dir, "embeddings"), clusters=8, rounds=10, width=64, scale=1024, seed="3")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_quality_rules,
        op3_topk,
        op4_url_filters,
        op5_chat_format,
        op6_mixing,
        op7_quality_classifier,
        op8_near_dedup,
        op9_packing,
        op10_suffix_dedup,
        op11_embedding_dedup,
        op12_whitening,
        op13_centroids,
    )
}

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _centroid_sql(clusters: int = 8, rounds: int = 10) -> str:
    """The rounds one after another, vectors and centroids as rows of one component."""

    def assigned(k: int) -> str:
        return f"""
        a{k} as materialized (
            select vec_id, cluster, distance from (
                select *, row_number() over (partition by vec_id order by distance, cluster) as n from (
                    select vec_id, cluster, sum((v.x - c{k}.x) * (v.x - c{k}.x))::bigint as distance
                    from v join c{k} using (i) group by vec_id, cluster
                )
            ) where n = 1
        )"""

    def moved(k: int) -> str:
        return f""",
        c{k + 1} as materialized (
            select cluster, i, coalesce(((s - ((s % n) + n) % n) // n)::bigint, x) as x
            from c{k} left join (
                select cluster, i, sum(x) as s, count(*) as n from a{k} join v using (vec_id) group by cluster, i
            ) using (cluster, i)
        ),"""

    steps = "".join(assigned(k) + moved(k) for k in range(rounds)) + assigned(rounds)
    return f"""
        with whole as (
            select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as x from embeddings
            where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ),
        v as materialized (select vec_id, unnest(range(64)) as i, unnest(x) as x from whole),
        first as (select vec_id, row_number() over (order by sha256('3:' || vec_id)) - 1 as cluster from whole),
        c0 as materialized (select cluster, i, x from first join v using (vec_id) where cluster < {clusters}),{steps},
        told as (select cluster, sha256(string_agg(x::varchar, ',' order by i)) as centroid_sha256 from c{rounds} group by cluster)
        select vec_id, cluster::int as cluster, distance, (sum(distance) over (partition by cluster))::bigint as cluster_inertia,
            (sum(distance) over ())::bigint as inertia, centroid_sha256
        from a{rounds} join told using (cluster)
    """


ORACLE: dict[str, str] = {
    "op3_topk": """
        with v as (
            select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as x from embeddings
            where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ),
        s as (
            select q.vec_id as query_id, v.vec_id, list_dot_product(q.x, v.x)::bigint as score
            from v as q join v on q.vec_id % 100 = 0 and v.vec_id <> q.vec_id
        ),
        r as (select query_id, (row_number() over (partition by query_id order by score desc, vec_id))::int as rank, vec_id, score from s)
        select * from r where rank <= 10
    """,
    "op4_url_filters": """
        with rules(rule, verdict, host, path) as (
            values ('com/', 'allow', 'com', '/'), ('example.com/en/', 'block', 'example.com', '/en/'),
                ('www.example.com/en/', 'allow', 'www.example.com', '/en/'),
                ('net/es/', 'block', 'net', '/es/'), ('net/fr/', 'block', 'net', '/fr/')
        ),
        rest as (
            select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest from pages
        ),
        split as (select page_id, regexp_extract(rest, '^[^/?#]*') as given, rest from rest),
        p as (
            select page_id, translate(given, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                regexp_extract(substr(rest, length(given) + 1), '^[^?#]*') as path
            from split
        ),
        best as (
            select page_id, p.host, p.path, r.rule, r.verdict,
                row_number() over (partition by page_id order by length(r.rule) desc nulls last) as n
            from p left join rules as r
                on (p.host = r.host or ends_with(p.host, '.' || r.host)) and starts_with(p.path, r.path)
        )
        select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from best where n = 1
    """,
    "op5_chat_format": """
        with c as (
            select conv_id, list({'role': role, 'text': text} order by turn nulls first, role nulls first, text nulls first) as turns
            from conversations where conv_id is not null group by conv_id
        ),
        one as (select turns, min(conv_id) as conv_id, count(*) as n_copies from c group by turns)
        select conv_id, len(turns)::bigint as n_turns, n_copies,
            list_aggregate(list_transform(turns, lambda t: '<|im_start|>' || coalesce(t.role, 'user') || chr(10)
                || coalesce(t.text, '') || '<|im_end|>' || chr(10)), 'string_agg', '') as rendered
        from one as a
        where not exists (
            select 1 from c as b where len(b.turns) > len(a.turns) and list_slice(b.turns, 1, len(a.turns)) = a.turns
        )
    """,
    "op8_near_dedup": f"""
        with recursive w as (
            select doc_id, regexp_extract_all({_LOWERED}, '[^\\x20\\x09-\\x0D]+') as w from documents
        ),
        s as (
            select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) = 1 then [w[1]]
                else list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) end) as shingle
            from w
        ),
        n as (select doc_id, count(*) as n from s group by doc_id),
        common as (
            select a.doc_id as a, b.doc_id as b, count(*) as c from s as a join s as b using (shingle)
            where a.doc_id <> b.doc_id group by all
        ),
        links as (
            select a, b from common join n as x on x.doc_id = a join n as y on y.doc_id = b where 100 * c >= 80 * (x.n + y.n - c)
        ),
        reach(doc_id, other) as (
            select doc_id, doc_id from documents union select reach.doc_id, links.b from reach join links on links.a = reach.other
        ),
        found as (select doc_id, min(other) as component_id from reach group by doc_id)
        select doc_id, coalesce(n.n, 0) as n_shingles, component_id, doc_id = component_id as kept
        from found left join n using (doc_id)
    """,
    "op10_suffix_dedup": """
        with d as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
        -- 500 starts at a time: a place far into a string is slow to reach
        parts as (select doc_id, c, substr(h, (1000 * c + 1)::bigint, 1098) as part
            from (select doc_id, h, unnest(range(0, len(h) // 1000 + 1)) as c from d)),
        g as (
            select doc_id, 500 * c + j as i, substr(part, (2 * j + 1)::bigint, 100) as gram
            from (select doc_id, c, part, unnest(range(0, least(500, len(part) // 2 - 49))) as j from parts)
        ),
        f as (select gram, min(doc_id) as first from g group by gram),
        starts as (select doc_id, i from g join f using (gram) where first < doc_id),
        spans as (
            select doc_id, min(i) as a, max(i) + 50 as b
            from (
                select doc_id, i, sum(case when i <= before + 50 then 0 else 1 end) over (partition by doc_id order by i) as span
                from (select doc_id, i, lag(i) over (partition by doc_id order by i) as before from starts)
            ) group by doc_id, span
        ),
        cut as (
            select doc_id, list(a order by a) as a, list(b order by b) as b, sum(b - a)::bigint as n_removed, count(*) as n_spans
            from spans group by doc_id
        ),
        kept as (
            select d.doc_id, (len(h) // 2)::bigint as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
                case when cut.doc_id is null then h else list_aggregate(list_transform(range(0, len(a) + 1), lambda k:
                    substr(h, (2 * (case when k = 0 then 0 else b[k] end) + 1)::bigint,
                        (2 * ((case when k = len(a) then len(h) // 2 else a[k + 1] end) - (case when k = 0 then 0 else b[k] end)))::bigint)
                ), 'string_agg', '') end as rest
            from d left join cut using (doc_id)
        )
        select doc_id, n_bytes, n_removed, n_spans, sha256(unhex(rest)) as kept_sha256 from kept
    """,
    "op11_embedding_dedup": """
        with recursive v as (
            select vec_id, label, list_transform(embedding, lambda x: x::double) as x from embeddings
            where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x <> 0)) > 0
                and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ),
        links as (
            select a.vec_id as a, b.vec_id as b from v as a join v as b on a.label = b.label and a.vec_id <> b.vec_id
            where list_cosine_similarity(a.x, b.x) >= 0.98
        ),
        reach(vec_id, other) as (
            select vec_id, vec_id from embeddings union select reach.vec_id, links.b from reach join links on links.a = reach.other
        ),
        found as (select vec_id, min(other) as component_id from reach group by vec_id),
        counted as (select a as vec_id, count(*) as n from links group by a)
        select vec_id, coalesce(n, 0) as n_links, component_id, vec_id = component_id as kept from found left join counted using (vec_id)
    """,
    "op13_centroids": _centroid_sql(),
}
