"""The numbered operators as queries over whole tables, with SQL oracles where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm import toxicity
from lakeloom.llm.alignment import align_tokens
from lakeloom.llm.exact_dedup import exact_dedup
from lakeloom.llm.html_text import extract_text
from lakeloom.llm.mix_sources import mix_sources
from lakeloom.llm.packing import pack
from lakeloom.llm.prefix_trie import prefix_trie
from lakeloom.llm.quality import quality_scores, train
from lakeloom.llm.simhash import simhash_groups
from lakeloom.llm.substring_dedup import substring_dedup
from lakeloom.llm.suffix_dedup import suffix_dedup
from lakeloom.llm.topk import top_k
from lakeloom.llm.warc import arc_to_warc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLES[fn.__name__] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(r"""
with t as (
  select doc_id, coalesce(text, '') as text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm
  from documents)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from (
  select doc_id, first_value(doc_id) over (partition by norm order by length(text) desc, doc_id) as keep_id,
    count(*) over (partition by norm) as group_size, sha256(norm) as text_sha256
  from t)
""")
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


@query(r"""
with recursive sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size
  from documents),
sources as (
  select source, sum(size)::bigint as source_size,
    [3, 1, 2][(row_number() over (order by source is null, source) - 1) % 3 + 1]::double as weight
  from sized group by source),
levels as (
  select 0 as round, 0.0::double as level
  union all
  select round + 1, (select (sum(source_size) * 1.5
      - sum(case when weight * level > 2 * source_size then 2.0 * source_size else 0 end))
      / sum(case when weight * level > 2 * source_size then 0 else weight end) from sources)
  from levels where round < 60),
targets as (
  select source, source_size,
    coalesce(least(weight * (select level from levels order by round desc limit 1), 2.0 * source_size), 0.0) as target,
    ('0x' || substr(md5('mix:' || coalesce('=' || source, '')), 1, 8))::bigint / 4294967296.0::double as u
  from sources),
placed as (
  select doc_id, size, source_size, target, u,
    case when source_size > 0 then target / source_size else 0.0 end as r,
    row_number() over (partition by s.source order by size, doc_id) as i
  from sized s join targets t on s.source is not distinct from t.source)
select doc_id, size, source_size, target,
  size * least((floor(i * r + u) - floor((i - 1) * r + u))::bigint, 2) as taken
from placed
""")
def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = mix_sources(table(spark, sf_dir, "documents"))
    return report.select("doc_id", "size", "source_size", "target", "taken")


@query()
def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"), shingle=3, distance=2)


@query()
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = substring_dedup(table(spark, sf_dir, "documents"), length=50)
    return report.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query()
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = suffix_dedup(table(spark, sf_dir, "documents"), length=100)
    kept = F.sha2("kept", 256).alias("kept_sha256")
    return report.select("doc_id", "n_bytes", "n_removed", "n_spans", kept)


@query()
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"), max_rows=20_000)
    return quality_scores(docs, model, keep_from=0.7)


@query()
def op5_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), capacity=2048)


@query("""
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as x from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scores as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.x, c.x)::bigint as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.x) = len(c.x) where q.vec_id % 50 = 0),
ranked as (
  select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
  from scores)
select * from ranked where rank <= 5
""")
def op7_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5, scale=256)


@query("""
with p as (
  select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes, sha1(coalesce(html, '')) as payload_digest,
    max(page_id) over (partition by coalesce(html, '')) as top
  from pages)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 1000 and page_id <> top then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 1000 and page_id <> top then top end as refers_to
from p
""")
def op9_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arc_to_warc(table(spark, sf_dir, "pages"))


@query()
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@query()
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(table(spark, sf_dir, "documents")).drop("n_together")


@query("""
with turns as (
  select conv_id, coalesce(text, '') as text, [coalesce(role, ''), coalesce(text, '')] as said,
    row_number() over (partition by conv_id order by turn nulls first, role, text) as place
  from conversations where conv_id is not null),
own as (
  select conv_id, list(said order by place) as said,
    xor(list_reduce(
      list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda c: ord(c)::bigint)),
      lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda r, i: xor(r // 2, 3988292384 * (r % 2) + i))), 4294967295) % 6 as h
  from turns group by conv_id),
rebuilt as (
  select o.conv_id, list_concat(coalesce(g.said, [])[1:o.h], o.said[o.h + 1:]) as said
  from own o left join own g on g.conv_id = o.conv_id - o.conv_id % 100),
begun as (
  select conv_id, d as depth, said[1:d] as node, d = len(said) as here
  from rebuilt, unnest(range(0, len(said) + 1)) as t(d)),
nodes as (
  select node, any_value(depth) as depth, min(conv_id) as conv_id, count(*) as n_convs,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where here), '')) as ends_sha256
  from begun group by node),
weighed as (
  select n.*, coalesce(c.n_children, 0) as n_children,
    (n_convs - 1) * (case when n.depth > 0 then length(n.node[n.depth][2]) else 0 end) as own_saved
  from nodes n left join (
    select node[1:depth - 1] as above, count(*) as n_children from nodes where depth > 0 group by 1) c on c.above = n.node),
sums as (
  select node[1:d] as node, sum((n_children = 0)::int)::bigint as n_leaves, sum(own_saved)::bigint as saved_tokens
  from weighed, unnest(range(0, depth + 1)) as t(d) group by 1)
select w.conv_id, w.depth, p.conv_id as parent_conv_id, w.n_convs, w.n_children, s.n_leaves, s.saved_tokens, w.ends_sha256
from weighed w join sums s on s.node = w.node
  left join nodes p on w.depth > 0 and p.node = w.node[1:w.depth - 1]
""")
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


@query()
def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), most=2000)
    return toxicity.toxicity_scores(docs, model, toxic_from=0.7)
