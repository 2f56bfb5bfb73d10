"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.plans.registry import Registry
from haulmark.session import scratch_folder

from . import byte_bpe, centroids, codes, exact, language, licenses, mixing, near, personal, token_files, topk, toxicity, vector_links
from .blocks import held_out, table

LLM = Registry()

BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: A flatter mix of sources and languages; topics keep their shares.
MIXTURE = mixing.Mixture(
    sources=[f"src{i}" for i in range(20)],
    langs=["de", "en", "es", "fr"],
    topics=[
        ("legal", r"[Ll]icen[sc]ed? |[Cc]opyright|[Aa]ll rights reserved"),
        ("contact", r"[A-Za-z0-9]@[A-Za-z0-9]|\+[0-9]+ "),
        ("table", r" \| "),
        ("noise", r"[#$%&*][#$%&*][#$%&*]"),
    ],
    powers={"source": 0.7, "lang": 0.8, "topic": 1.0},
    # A rare name does not cost more than half of the tokens.
    least=0.5,
)

COPIES_SQL = r"""
with flat as (
  select doc_id, length(coalesce(text, '')) as n_points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as flat
  from documents)
select doc_id, first_value(doc_id) over by_text as keep_id, count(*) over (partition by flat) as group_size,
  doc_id = first_value(doc_id) over by_text as kept, sha256(flat) as text_sha256
from flat
window by_text as (partition by flat order by n_points desc, doc_id)
"""


@LLM.add("op1_exact_copies", "1", COPIES_SQL)
def op1_exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.copies(table(spark, sf_dir, "documents")).drop("n_chunks", "text_key")


@LLM.add("op9_language", "9")
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs, ~held_out())
    return language.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), "lang_rejected"
    )


@LLM.add("op6_near_copies", "6")
def op6_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_copies(table(spark, sf_dir, "documents")).drop("text_key")


@LLM.add("op7_byte_bpe", "7")
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = byte_bpe.encode(docs, BYTE_RANKS).drop("text")
    return byte_bpe.decode(coded, BYTE_RANKS).select(
        "doc_id",
        F.size("token_ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@LLM.add("op8_mixture", "8", mixing.rake_sql(MIXTURE))
def op8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), MIXTURE).drop("text_key")


TOP_K_SQL = """
with v as (
  select vec_id, [floor(64 * x::double)::bigint for x in embedding] as vec from embeddings
  where vec_id is not null and embedding is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
s as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.vec::double[], c.vec::double[])::bigint as score
  from v q join v c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, rank::int as rank, vec_id, score from r where rank <= 20
"""


@LLM.add("op3_top_k", "3", TOP_K_SQL)
def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=20, is_query=F.col("vec_id") % 20 == 0)


@LLM.add("op2_token_files", "2")
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{scratch_folder(spark)}/tokens-{uuid.uuid4().hex}"
    token_files.write(table(spark, sf_dir, "documents"), folder, WORD_TOKENIZER)
    return token_files.read(spark, folder, with_ids=False)


@LLM.add("op10_toxicity", "10")
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out())
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id", held_out().alias("held_out"), F.col("toxic_score").alias("score"), (F.col("toxic_score") >= 0.5).cast("int").alias("predicted")
    )


@LLM.add("op4_personal_data", "4")
def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.find(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


@LLM.add("op5_licences", "5")
def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


@LLM.add("op11_centroids", "11", centroids.cluster_sql())
def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


@LLM.add("op12_vector_codes", "12", codes.compress_sql())
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(table(spark, sf_dir, "embeddings"))


VECTOR_LINKS_SQL = """
with recursive v as (
  select vec_id, label, [x::double for x in embedding] as vec from embeddings
  where label is not null and embedding is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0 and len([x for x in embedding if x <> 0]) > 0),
link as materialized (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id
  where list_cosine_similarity(a.vec, b.vec) >= 0.93),
reach as (
  select a, b from link
  union
  select r.a, l.b from reach r join link l on r.b = l.a),
n as (select a, count(*) as n_links from link group by a),
c as (select a, min(b) as low from reach group by a)
select e.vec_id, coalesce(n.n_links, 0) as n_links, least(e.vec_id, coalesce(c.low, e.vec_id)) as component_id,
  e.vec_id <= coalesce(c.low, e.vec_id) as kept
from embeddings e left join n on n.a = e.vec_id left join c on c.a = e.vec_id
"""


@LLM.add("op13_near_vectors", "13", VECTOR_LINKS_SQL)
def op13_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_links.near_vectors(table(spark, sf_dir, "embeddings"))
