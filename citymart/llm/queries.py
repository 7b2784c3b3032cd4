"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citymart.llm.alignment import align_documents
from citymart.llm.inner_product import top_products
from citymart.llm.labelled import held_out
from citymart.llm.mixing import mixing_positions
from citymart.llm.packing import pack_documents
from citymart.llm.passages import shared_passages
from citymart.llm.repeats import periodic_runs
from citymart.llm.resampling import resample
from citymart.llm.secrets import digest, find_secrets
from citymart.llm.simhash import simhash_duplicates
from citymart.llm.token_files import read_token_files, write_token_files
from citymart.llm.toxicity import fit, score_documents
from citymart.llm.urls import judge_pages
from citymart.llm.vector_links import vector_links
from citymart.session import staged_path

#: Rules of the url query: verdict, host, beginning of the path.
URL_RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECE_TOKENIZER = public_tokenizers.path("piece_bpe_32k.model")

#: The run of the greatest length over period; of equal ones the first, then the one of the smallest period. Products
#: compare the quotients exactly.
BEST_RUN = """
aggregate(runs, cast(null as struct<start: bigint, length: bigint, period: bigint>), (best, r) ->
  if(best is null or cast(r.length as decimal(19)) * best.period > cast(best.length as decimal(19)) * r.period, r, best))
"""


def op1_vector_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_links(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), cosine=0.95)


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet")))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources weighed by the square root of their size, blocks of 100,000 characters."""
    places = mixing_positions(spark.read.parquet(f"{sf_dir}/documents.parquet"), alpha=0.5)
    return places.select(F.col("id").alias("doc_id"), "source", "block", "release", "deadline", "slot")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), label_col="toxic")
    return score_documents(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op5_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return resample(docs, labels, label_col="quality")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), words=3, bits=2)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), TOKENIZER, size=2048, end_id=1)


def op8_inner_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), every=50, k=5, scale=256.0)


def op9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_passages(spark.read.parquet(f"{sf_dir}/documents.parquet"), least=50)


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"), URL_RULES)


def with_periods(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; in the documents that a checksum of their id picks, words from one on repeat those
    behind it. No document without words, or without an id, is picked."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    picked = docs.select("doc_id", "text", (h % 10 == 0).alias("picked"), F.floor(h / 10).cast("long").alias("g"))
    words = F.when(F.col("picked"), F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    picked = picked.withColumn("words", words).withColumn("n", F.greatest(F.size("words"), F.lit(1)).cast("long"))
    picked = picked.withColumn("a", F.col("g") % F.col("n"))
    picked = picked.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    repeated = F.expr("array_join(transform(words, (w, i) -> if(i >= a, words[cast(a + (i - a) % p as int)], w)), ' ')")
    text = F.when(F.col("picked") & (F.size("words") > 0), repeated).otherwise(F.col("text"))
    return picked.select("doc_id", text.alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = periodic_runs(with_periods(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    runs = runs.withColumn("best", F.expr(BEST_RUN))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return runs.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    files = write_token_files(docs, staged_path(spark, "token-files"), BYTE_TOKENIZER, end_id=2)
    return read_token_files(files, docs.schema["doc_id"].dataType.simpleString())


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, _ = align_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), BYTE_TOKENIZER, PIECE_TOKENIZER)
    return documents


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_vector_links": op1_vector_links,
    "op2_secrets": op2_secrets,
    "op3_mixing": op3_mixing,
    "op4_toxicity": op4_toxicity,
    "op5_resampling": op5_resampling,
    "op6_simhash": op6_simhash,
    "op7_packing": op7_packing,
    "op8_inner_product": op8_inner_product,
    "op9_passages": op9_passages,
    "op10_urls": op10_urls,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_token_files": op12_token_files,
    "op13_alignment": op13_alignment,
}

ORACLES: dict[str, str] = {
    "op1_vector_links": """
with recursive vector as (
  select vec_id, embedding::double[] as x from embeddings
  where vec_id is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0
    and len(list_filter(embedding, lambda c: c <> 0)) > 0
),
link as (
  select a.vec_id as a, b.vec_id as b from vector a join vector b
    on a.vec_id <> b.vec_id and len(a.x) = len(b.x) and list_cosine_similarity(a.x, b.x) >= 0.95
),
reach(a, b) as (select a, b from link union select r.a, l.b from reach r join link l on r.b = l.a)
select vec_id,
  (select count(*) from link l where l.a = vec_id) as n_links,
  least(vec_id, coalesce((select min(b) from reach r where r.a = vec_id), vec_id)) as component_id,
  vec_id <= coalesce((select min(b) from reach r where r.a = vec_id), vec_id) as kept
from embeddings
""",
    "op8_inner_product": """
with vector as (
  select vec_id, list_transform(embedding, lambda c: floor(256 * c::double)) as x from embeddings
  where vec_id is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0
),
ranked as (
  select q.vec_id as query_id, c.vec_id, list_dot_product(q.x, c.x)::bigint as score,
    row_number() over (partition by q.vec_id order by list_dot_product(q.x, c.x) desc, c.vec_id)::integer as rank
  from vector q join vector c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id and len(q.x) = len(c.x)
)
select query_id, rank, vec_id, score from ranked where rank <= 5
""",
    "op10_urls": r"""
with recursive page as (
  select page_id, url, html,
    translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) as path
  from pages
),
tag as (
  select url, host, path, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>')) as tag
  from page where contains(url, '://')
),
target as (
  select url, 'http://' || host as site, path,
    replace(case when regexp_matches(tag, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b')
        then regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)
      when regexp_matches(tag, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b')
        then regexp_extract(tag, '(?is)\burl\s*=\s*["'']?([^"''\s>]+)', 1) end, '&amp;', '&') as t
  from tag
),
absolute as (
  select url, case when starts_with(t, '//') then 'http:' || t
      when starts_with(t, '/') then site || t
      when starts_with(t, '?') then site || path || t
      when regexp_matches(t, '^([A-Za-z][A-Za-z0-9+.-]*:|#)') or regexp_matches(t, '^[^?#]*://') then t
      when path <> '' then site || regexp_extract(path, '^(?s:.*)/') || t end as t
  from target where t <> ''
),
part as (
  select u, translate(regexp_extract(u, '^(?s:.*?)://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(u, '^(?s:.*?)://[^/?#]*([^?#]*)', 1) as path,
    regexp_extract(u, '^[^?#]*(\?[^#]*)', 1) as query
  from (select url as u from page union select t from absolute) where contains(u, '://')
),
address as (
  select u, host || case when path = '' then '/' when not contains(path, '/.') then path
    else '/' || array_to_string(list_reduce(
      list_transform(string_split(regexp_replace(path, '/(\.\.?)$', '/\1/'), '/')[2:], lambda s: [s]),
      lambda a, x: case x[1] when '..' then a[:-2] when '.' then a else a || x end, []::varchar[]), '/') end || query as at
  from part
),
edge as (
  select x.at as a, y.at as b from absolute l join address x on l.url = x.u join address y on l.t = y.u where x.at <> y.at
  union
  select y.at, x.at from absolute l join address x on l.url = x.u join address y on l.t = y.u where x.at <> y.at
),
reach(a, b) as (
  select a, a from edge
  union
  select r.a, e.b from reach r join edge e on r.b = e.a
),
rules(verdict, host, path) as (
  values ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
    ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
),
known as (
  select distinct b as address, regexp_extract(b, '^([^/?#]*)', 1) as host,
    regexp_extract(b, '^[^/?#]*([^?#]*)', 1) as path from reach
),
decided as (
  select k.address, arg_max(r.verdict, length(r.host || r.path)) as verdict
  from known k join rules r
    on (k.host = r.host or ends_with(k.host, '.' || r.host)) and starts_with(k.path, r.path)
  group by k.address
),
fate as (select x.a as address, min(d.verdict) as fate from reach x join decided d on x.b = d.address group by x.a),
own as (
  select p.page_id, arg_max(r.host || r.path, length(r.host || r.path)) as rule,
    arg_max(r.verdict, length(r.host || r.path)) as verdict
  from page p join rules r
    on (p.host = r.host or ends_with(p.host, '.' || r.host)) and starts_with(p.path, r.path)
  group by p.page_id
)
select p.page_id, p.host, p.path, o.rule, coalesce(o.verdict, f.fate, 'allow') as verdict
from page p left join own o using (page_id) left join address x on p.url = x.u left join fate f on x.at = f.address
""",
}
