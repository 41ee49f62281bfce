"""The registered queries of this subpackage, with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .audit import audit_filters
from .decontamination import contaminated
from .forest import near_duplicates
from .jaccard import jaccard_components
from .language_id import identify
from .metric_search import top_k
from .packing import pack_documents
from .sharding import shuffle_shards, write_shards
from .storage import new_path
from .substrings import dedup_substrings
from .toxicity import score_documents
from .url_filter import TWO_LABEL_SUFFIXES, filter_urls, url_host
from .warc import round_trip
from .whitening import whiten

RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns)


def tokenizer() -> tuple[str, str]:
    """Path and pattern of the public byte-level BPE that the packing query uses."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold benchmark items, with the items and how much of them."""
    return contaminated(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens; digests are those of the token ids in their sequences."""
    packed = pack_documents(table(spark, sf_dir, "documents", "doc_id", "text"), *tokenizer())
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op3_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages through archives and back."""
    return round_trip(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle sets and components of all documents."""
    return jaccard_components(table(spark, sf_dir, "documents", "doc_id", "text"))


def op7_metric_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best inner products of every vector whose id is divisible by 20, over all others."""
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return top_k(vectors, F.col("vec_id") % 20 == 0)


def op6_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts for every page; a page's outcome is the label of the document of the same id, bad where it is toxic or of low quality."""
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    bad = F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 1).when(F.col("toxic").isNotNull() | F.col("quality").isNotNull(), 0)
    outcomes = pages.join(labels, F.col("page_id") == F.col("doc_id")).select(url_host(F.col("url")).alias("host"), bad.alias("bad"))
    return filter_urls(pages, outcomes, RULES).select("page_id", "host", "path", "rule", "verdict")


def op8_shuffle_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their whole texts over 24 shards by the law ``rows``; sizes and digests are those of the shards as written."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    bytes_of = F.octet_length(F.coalesce(F.col("text"), F.lit(""))) + 8
    out = shuffle_shards(docs.withColumn("size", bytes_of), 24, size="size").drop("size")
    path = new_path(spark, "shards")
    write_shards(out, path)
    shards = spark.read.schema(out.schema).parquet(path)
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return shards.select("doc_id", bytes_of.cast("long").alias("size"), crc.alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents."""
    return identify(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op9_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    return score_documents(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "toxic"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without their repeated passages: what is left, and what was cut."""
    kept = dedup_substrings(table(spark, sf_dir, "documents", "doc_id", "text"))
    cut = F.coalesce(F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["length"]), F.lit(0).cast("long"))
    text = F.coalesce(F.col("text"), F.lit(""))
    return kept.select("doc_id", "text", F.coalesce(F.size("spans"), F.lit(0)).alias("n_spans"), cut.alias("removed_bytes"), F.crc32(text.cast("binary")).alias("text_crc32"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings along their first 32 principal components, a row for each."""
    found = whiten(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    each = found.select("vec_id", "n", F.col("deviation").cast("long").alias("deviation"), "explained", "identity_error", F.posexplode("whitened").alias("at", "whitened"))
    return each.select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened", F.get("explained", F.col("at")).alias("explained"), "identity_error")


def op12_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sets of three-word shingles and components of all documents."""
    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from each source in every order."""
    return audit_filters(table(spark, sf_dir, "documents", "doc_id", "text", "source"), table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


OP3_SQL = """
with p as (select page_id, cast(strlen(coalesce(html, '')) as bigint) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages),
m as (select *, case when payload_bytes >= 1000 then max(page_id) over (partition by payload_digest) end as last from p)
select page_id, payload_bytes, payload_digest, case when last is not null and page_id is distinct from last then 'revisit' else 'response' end as record_type,
    case when page_id is distinct from last then last end as refers_to from m
"""


def _components_sql(size: int, percent: int, more: str = "") -> str:
    """Sets of ``size``-word shingles, links and components by brute force."""
    return rf"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
g as (select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < {size} then [array_to_string(w, ' ')] else list_transform(range(1, len(w) - {size - 2}), lambda k: array_to_string(w[k:k + {size - 1}], ' ')) end) as gram from w),
n as (select doc_id, count(*) as n from g group by doc_id),
links as (select a.doc_id as a, b.doc_id as b from g a join g b on a.gram = b.gram and a.doc_id <> b.doc_id join n x on x.doc_id = a.doc_id join n y on y.doc_id = b.doc_id
    group by a.doc_id, b.doc_id, x.n, y.n having 100 * count(*) >= {percent} * (x.n + y.n - count(*))),
reach(doc, other) as (select doc_id, doc_id from w union select r.doc, l.b from reach r join links l on l.a = r.other)
select r.doc as doc_id, coalesce(max(n.n), 0) as n_shingles, min(r.other) as component_id{more} from reach r left join n on n.doc_id = r.doc group by r.doc
"""


OP4_SQL = _components_sql(5, 80)
OP12_SQL = _components_sql(3, 85, ", min(r.other) = r.doc as kept")

OP13_SQL = r"""
with recursive w as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
m as (select w.doc_id, part, len(words) < 200 as a, 100 * len(list_distinct(words)) < 50 * len(words) as b, 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) as c,
    regexp_matches(text, '[#$%&*|]') as d, coalesce(doc_id > min(doc_id) over (partition by text), false) as e from w),
f as (select part, list_filter(['A', 'B', 'C', 'D', 'E'], lambda x, k: [a, b, c, d, e][k]) as fails, coalesce(l.good, false) as good, coalesce(l.toxic, false) as toxic
    from m left join (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id) l using (doc_id)),
orders(o) as (select '' union all select o || x from orders, unnest(['A', 'B', 'C', 'D', 'E']) t(x) where not contains(o, x)),
steps as (select o, cast(k as integer) as step, o[k:k] as letter, o[1:k - 1] as earlier from orders, range(1, 6) r(k) where length(o) = 5),
s as (select part, o as filter_order, step, letter, count(*) filter (where not gone and not now) as kept, count(*) filter (where now and not gone) as removed, count(*) filter (where now and gone) as redundant,
    count(*) filter (where now and len(fails) = 1) as unique_fails, count(*) filter (where now and not gone and good) as good_lost, count(*) filter (where now and not gone and toxic) as toxic_lost
    from (select *, len(list_filter(fails, lambda x: contains(earlier, x))) > 0 as gone, list_contains(fails, letter) as now from f, steps) group by all)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, cast(sum(removed) over (partition by part, letter) as bigint) as shapley from s
"""

OP7_SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as v from embeddings
    where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id, cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
    from v q, v c where q.vec_id % 20 = 0 and q.vec_id <> c.vec_id)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score from s
qualify rank <= 20
"""

_SUFFIXES = ", ".join(f"'{x}'" for x in TWO_LABEL_SUFFIXES)
OP6_SQL = rf"""
with p as (select page_id, url,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path from pages),
q as (select *, regexp_replace(host, '\.*(:[0-9]*)?\z', '') as name from p),
r as (select *, regexp_full_match(name, '[0-9]{{1,3}}(\.[0-9]{{1,3}}){{3}}') or starts_with(name, '[') as address, regexp_extract(name, '([^.]*\.[^.]*)$', 1) in ({_SUFFIXES}) as wide from q),
s as (select *, case when address then name when wide then regexp_extract(name, '([^.]*\.[^.]*)$', 1) else regexp_extract(name, '([^.]*)$', 1) end as suffix,
    case when address then name else coalesce(nullif(case when wide then regexp_extract(name, '([^.]*\.[^.]*\.[^.]*)$', 1) else regexp_extract(name, '([^.]*\.[^.]*)$', 1) end, ''), name) end as domain from r),
h as (select name as host, domain, suffix, count(*) as n, sum(case when toxic = 1 or quality = 0 then 1 else 0 end) as bad
    from s join labels on page_id = doc_id where toxic is not null or quality is not null group by all),
t0 as (select coalesce(sum(bad), 0) + 1.0 as a, coalesce(sum(n), 0) - coalesce(sum(bad), 0) + 1.0 as b from h),
s1 as (select suffix, sum(n) as n, sum(bad) as bad, max(a / (a + b)) as m from h, t0 group by suffix),
sk as (select round(coalesce(case when sum((n-1)*m*(1-m)) > 0 and sum(n*pow(bad/n-m,2))-sum(m*(1-m)) > 0
    then least(1000.0, greatest(1.0, sum((n-1)*m*(1-m)) / (sum(n*pow(bad/n-m,2))-sum(m*(1-m))) - 1)) end, 1000.0), 6) as k from s1),
sp as (select suffix, k*m+bad as a, k*(1-m)+n-bad as b from s1, sk),
d1 as (select domain, suffix, sum(n) as n, sum(bad) as bad, max(a/(a+b)) as m from h join sp using (suffix) group by domain, suffix),
dk as (select round(coalesce(case when sum((n-1)*m*(1-m)) > 0 and sum(n*pow(bad/n-m,2))-sum(m*(1-m)) > 0
    then least(1000.0, greatest(1.0, sum((n-1)*m*(1-m)) / (sum(n*pow(bad/n-m,2))-sum(m*(1-m))) - 1)) end, 1000.0), 6) as k from d1),
dp as (select domain, k*m+bad as a, k*(1-m)+n-bad as b from d1, dk),
h1 as (select host, n, bad, a/(a+b) as m from h join dp using (domain)),
hk as (select round(coalesce(case when sum((n-1)*m*(1-m)) > 0 and sum(n*pow(bad/n-m,2))-sum(m*(1-m)) > 0
    then least(1000.0, greatest(1.0, sum((n-1)*m*(1-m)) / (sum(n*pow(bad/n-m,2))-sum(m*(1-m))) - 1)) end, 1000.0), 6) as k from h1),
hp as (select host, k*m+bad as a, k*(1-m)+n-bad as b from h1, hk),
j as (select page_id, s.host, path, coalesce(hp.a, dp.a, sp.a, t0.a) as a, coalesce(hp.b, dp.b, sp.b, t0.b) as b
    from s left join hp on s.name = hp.host left join dp on s.domain = dp.domain left join sp on s.suffix = sp.suffix, t0),
v as (select *, case
    when (host = 'example.net' or ends_with(host, '.example.net')) and starts_with(path, '/en/') then 'example.net/en/'
    when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/de/') then 'example.com/de/'
    when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/fr/') then 'org/fr/'
    when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/') then 'net/' end as rule from j)
select page_id, host, path, rule, case when rule in ('net/', 'example.com/de/') then 'block' when rule is not null then 'allow'
    when a/(a+b) - 1.645 * sqrt(a/(a+b) * (1 - a/(a+b)) / (a+b+1)) > 0.25 then 'block' else 'allow' end as verdict from v
"""

QUERIES = {"op1_decontamination": op1_decontamination, "op2_best_fit_packing": op2_best_fit_packing, "op3_warc_round_trip": op3_warc_round_trip, "op4_jaccard_join": op4_jaccard_join, "op5_language_id": op5_language_id, "op7_metric_search": op7_metric_search, "op6_url_reputation": op6_url_reputation, "op8_shuffle_shards": op8_shuffle_shards, "op9_compression_toxicity": op9_compression_toxicity, "op10_substring_dedup": op10_substring_dedup, "op11_embedding_whitening": op11_embedding_whitening, "op12_minhash_forest": op12_minhash_forest, "op13_filter_audit": op13_filter_audit}
ORACLE_SQL = {"op3_warc_round_trip": OP3_SQL, "op4_jaccard_join": OP4_SQL, "op7_metric_search": OP7_SQL, "op6_url_reputation": OP6_SQL, "op12_minhash_forest": OP12_SQL, "op13_filter_audit": OP13_SQL}
