"""The registered queries of this subpackage: each operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kithscope.llm.frames import documents
from kithscope.llm.op10_substring_dedup import dedup_substrings
from kithscope.llm.op11_whitening import whiten
from kithscope.llm.op12_hard_negatives import mine_hard_negatives
from kithscope.llm.op13_embedding_duplicates import near_embeddings
from kithscope.llm.op1_sharding import shard_documents
from kithscope.llm.op2_packing import pack
from kithscope.llm.op3_disclosure import KINDS, TERM, find_disclosures, written
from kithscope.llm.op4_url_trust import LINK_HOST, judge_urls
from kithscope.llm.op5_toxicity_chain import toxicity_chain
from kithscope.llm.op6_decontaminate import find_benchmark
from kithscope.llm.op7_near_duplicates import near_duplicates
from kithscope.llm.op8_line_dedup import dedup_lines
from kithscope.llm.op9_quality_votes import quality_votes


#: Small, so that the small tables split too.
SHARD_BYTES = 1 << 20


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = shard_documents(documents(spark, sf_dir), max_bytes=SHARD_BYTES)
    return sharded.select(F.col("row.doc_id").alias("doc_id"), "n_bytes", "shard", "depth", "shard_bytes", "shard_rows")


def packed(docs: DataFrame) -> DataFrame:
    import public_tokenizers as tokens

    pieces = pack(docs, tokens.path("byte_bpe_50k.json"), ranks_path=tokens.path("byte_bpe_50k.tiktoken"), pattern=tokens.PATTERN, capacity=2048)
    return pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir))


def op3_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_disclosures(documents(spark, sf_dir))
    return found.select(
        "doc_id",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(written(KINDS), 256).alias("base_sha256"),
        written([*KINDS, TERM]).alias("spans"),
    )


URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
#: Rounds of the SQL only. The operator goes on until ranks are settled; the given pages have no links that take more.
URL_ROUNDS = 10


def op4_url_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), URL_RULES, damping=0.85)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def _url_sql() -> str:
    """The same ranks, one common table per round."""
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)
    link = LINK_HOST.replace("'", "''")
    lower = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    rounds = "".join(
        f""", r{k + 1} as (
    select kind, host, sum(rank) as rank from (
        select kind, host, 0.15 * share as rank from seeds
        union all select e.kind, e.dst, 0.85 * e.share * r.rank from edges e join r{k} r on r.kind = e.kind and r.host = e.src
    ) group by kind, host
)"""
        for k in range(URL_ROUNDS)
    )
    return f"""
with rules(verdict, rule_host, rule_path) as (values {rules}),
rest as (
    select page_id, html, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages
), named as (
    select page_id, html, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), {lower}) as host,
        regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) as path
    from rest
), judged as (
    select n.*, rule_host || rule_path as rule, verdict,
        row_number() over (partition by page_id order by length(rule_host || rule_path) desc nulls last, rule_host || rule_path) as place
    from named n left join rules on (host = rule_host or suffix(host, '.' || rule_host)) and starts_with(path, rule_path)
), firsts as (select * from judged where place = 1),
hosts as (select host, count(*) as n, count(*) filter (verdict = 'allow') as n_allow, count(*) filter (verdict = 'block') as n_block from firsts group by host),
seeds as (
    select 'trust' as kind, host, 1.0::double / count(*) over () as share from hosts where host <> '' and 2 * n_allow > n
    union all select 'distrust', host, 1.0::double / count(*) over () from hosts where host <> '' and 2 * n_block > n
), links as (
    select host as src, translate(unnest(regexp_extract_all(html, '{link}', 1)), {lower}) as dst from named where host <> ''
), both_ways as (
    select 'trust' as kind, src, dst, count(*) as links from links where src <> dst group by all
    union all select 'distrust', dst, src, count(*) from links where src <> dst group by all
), edges as (select kind, src, dst, links::double / sum(links) over (partition by kind, src) as share from both_ways),
r0 as (select kind, host, 0.15 * share as rank from seeds){rounds},
ranks as (
    select host, coalesce(sum(rank) filter (kind = 'trust'), 0) as trust, coalesce(sum(rank) filter (kind = 'distrust'), 0) as distrust
    from r{URL_ROUNDS} group by host
)
select page_id, f.host, path, rule, coalesce(verdict, case when coalesce(distrust, 0) > coalesce(trust, 0) then 'block' else 'allow' end) as verdict
from firsts f left join ranks r on r.host = f.host
"""


def op5_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").withColumn("junk", 1 - F.col("quality"))
    scored = toxicity_chain(documents(spark, sf_dir), labels, ["junk", "toxic"])
    return scored.select("doc_id", F.round("p_junk", 4).alias("p_junk"), F.round("p_toxic", 4).alias("p_toxic"), (F.col("p_toxic") >= 0.5).alias("toxic"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_benchmark(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), threshold=0.8, shingle_words=5).select("doc_id", "class_id")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(documents(spark, sf_dir)).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op9_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_votes(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("quality", 6).alias("quality")
    )


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(documents(spark, sf_dir), length=20).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whiten(embeddings(spark, sf_dir), components=16, scale=64)
    each = white.select("vec_id", "n", "deviation", "explained", "identity_error", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", F.col("deviation").cast("long").alias("deviation"), "whitened",
        F.get("explained", F.col("at")).alias("explained"), "identity_error",
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(embeddings(spark, sf_dir).withColumn("label", moved), lambda c: c % 100 == 0, n_positives=5, n_negatives=10, low=30, high=90, scale=256)


def op13_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_embeddings(embeddings(spark, sf_dir), threshold=0.93).select("vec_id", "n_links", "component_id", "kept")


USABLE = "len(embedding) > 0 and len(list_filter(embedding, lambda c: c is not null and isfinite(c))) = len(embedding)"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_packing": op2_packing,
    "op3_disclosure": op3_disclosure,
    "op4_url_trust": op4_url_trust,
    "op5_toxicity_chain": op5_toxicity_chain,
    "op6_decontaminate": op6_decontaminate,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_line_dedup": op8_line_dedup,
    "op9_quality_votes": op9_quality_votes,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_whitening": op11_whitening,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_embedding_duplicates": op13_embedding_duplicates,
}
SQL: dict[str, str] = {
    "op1_sharding": f"""
with d as (
    select doc_id, coalesce(strlen(text), 0) as n_bytes,
        lpad(bin(cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), chr(0))), 1, 15) as bigint)), 60, '0') as bits
    from documents
), sizes as (
    select substr(bits, 1, k) as shard, k, sum(n_bytes) as shard_bytes, count(*) as shard_rows
    from d, range(0, 61) t(k) group by all
), depths as (
    select doc_id, bits, n_bytes, min(k) as depth
    from d join sizes on shard = substr(bits, 1, k) and (shard_bytes <= {SHARD_BYTES} or shard_rows = 1) group by all
)
select doc_id, n_bytes, shard, cast(depth as int) as depth, cast(shard_bytes as bigint) as shard_bytes, shard_rows
from depths join sizes on shard = substr(bits, 1, k) and k = depth
""",
    "op4_url_trust": _url_sql(),
    "op8_line_dedup": r"""
with lines as (
    select doc_id, generate_subscripts(parts, 1) as i, unnest(parts) as line
    from (select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents)
), keyed as (
    select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
    from lines
), repeated as (
    select k, max(doc_id) as keeper from keyed where length(k) >= 20 group by k having count(distinct doc_id) >= 3
)
select l.doc_id, count(*) as n_lines, count(*) filter (keeper is not null and keeper <> l.doc_id) as n_dropped,
    sha256(coalesce(string_agg(line, chr(10) order by i) filter (keeper is null or keeper = l.doc_id), '')) as kept_sha256
from keyed l left join repeated r on r.k = l.k
group by l.doc_id
""",
    "op12_hard_negatives": f"""
with usable as (
    select distinct vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        list_transform(embedding, lambda c: floor(256 * cast(c as double))) as x
    from embeddings where vec_id is not null and label is not null and {USABLE}
), scored as (
    select a.vec_id as anchor_id, r.vec_id, r.label = a.label as same, cast(list_dot_product(a.x, r.x) as bigint) as score
    from usable a join usable r on len(a.x) = len(r.x) where a.vec_id % 100 = 0
), positives as (
    select anchor_id, vec_id as positive_id, score as positive_score from scored where same and vec_id <> anchor_id
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select anchor_id, positive_id, cast(row_number() over w as int) as rank, vec_id as negative_id, positive_score, score as negative_score
from positives join scored using (anchor_id)
where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
window w as (partition by anchor_id, positive_id order by score desc, vec_id)
qualify row_number() over w <= 10
""",
    "op13_embedding_duplicates": f"""
with recursive usable as (
    select vec_id, label, list_transform(embedding, lambda c: cast(c as double)) as x
    from embeddings where vec_id is not null and label is not null and {USABLE} and list_max(list_transform(embedding, lambda c: abs(c))) > 0
), links as (
    select a.vec_id as a, b.vec_id as b from usable a join usable b on a.label = b.label and a.vec_id <> b.vec_id and len(a.x) = len(b.x)
    where list_cosine_similarity(a.x, b.x) >= 0.93
), reached(a, b) as (
    select vec_id, vec_id from embeddings union select r.a, l.b from reached r join links l on l.a = r.b
), components as (select a, min(b) as component_id from reached group by a)
select vec_id, (select count(*) from links l where l.a = vec_id) as n_links, component_id, vec_id = component_id as kept
from embeddings join components on a = vec_id
""",
}
