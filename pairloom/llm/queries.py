"""Registered queries of the corpus operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions.text import bound
from pairloom.llm import (
    embedding_links, exact_dedup, hard_negatives, mixing, near_dedup, nearest, paragraphs, periodic, quality, sharding, tokens,
    toxicity, url_filter,
)
from pairloom.llm.common import WORD

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
MODEL = "piece_bpe_32k.model"
SHARD_BYTES = 1 << 20


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(MODEL))


@query
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # How buckets split depends on the index and not on the rows' meaning.
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents")).drop("bucket_depth", "bucket", "link")


ORACLES["op6_exact_dedup"] = """
select doc_id, max(doc_id) over (partition by coalesce(text, '')) as keep_id,
       count(*) over (partition by coalesce(text, '')) as group_size,
       doc_id = max(doc_id) over (partition by coalesce(text, '')) as kept,
       sha256(coalesce(text, '')) as text_sha256
from documents
"""


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("repeats")


ORACLES["op8_mixing"] = r"""
with docs as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         ('0x' || substr(md5(coalesce(doc_id::varchar, '') || ':' || md5(coalesce(text, ''))), 1, 15))::bigint as spot
  from documents
), sources as (
  select source, sum(size)::bigint as source_size,
         ([3.0, 1.0, 2.0])[((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::double as w
  from docs group by source
), ranked as (
  select *, 2.0::double * source_size as cap,
         coalesce(sum(2.0::double * source_size) over before, 0) as full_caps, coalesce(sum(w) over before, 0) as full_w,
         1.5::double * sum(source_size) over () as budget, sum(w) over () as all_w
  from sources
  window before as (order by 2.0::double * source_size / w, source nulls last rows between unbounded preceding and 1 preceding)
), leveled as (
  select source, source_size, least(cap, w * max((budget - full_caps) / (all_w - full_w)) over ()) as target from ranked
), planned as (
  select *, case when source_size > 0 then floor(target / source_size) else 0 end::bigint as whole from leveled
), placed as (
  select d.doc_id, d.size, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size as wanted,
         sum(d.size) over (partition by d.source order by d.spot) as upto,
         sum(d.size) over (partition by d.source, d.spot) as held
  from docs d join planned p on d.source is not distinct from p.source
)
select doc_id, size, source_size, target,
       (size * (whole + (2 * upto - held <= 2 * wanted)::int))::bigint as taken
from placed
"""


@query
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), SHARD_BYTES)


ORACLES["op10_sharding"] = f"""
with docs as (
  select doc_id, (coalesce(strlen(text), 0) + 16)::bigint as n_bytes,
         ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 15))::bigint as key
  from documents
), loads as (
  select depth, key >> (60 - depth) as prefix, sum(n_bytes)::bigint as load
  from docs, (select unnest(range(0, 33))::int as depth) group by all
), found as (
  select d.doc_id, d.n_bytes, l.depth, l.prefix, l.load,
         row_number() over (partition by d.doc_id order by l.depth) as pick
  from docs d, loads l where l.load <= {SHARD_BYTES} and (d.key >> (60 - l.depth)) = l.prefix
)
select doc_id, n_bytes, depth::int as depth, prefix, 0::bigint as part,
       case when depth = 0 then '' else lpad(bin(prefix), depth, '0') end || '-0' as shard, load as shard_bytes
from found where pick = 1
"""


@query
def op3_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


ORACLES["op3_nearest_vectors"] = """
with vectors as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
  from vectors q join vectors c on c.vec_id <> q.vec_id where q.vec_id % 50 = 0
), ranked as (
  select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score from scored
)
select * from ranked where rank <= 5
"""

# (host, path, verdict)
URL_RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


@query
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES).drop("component")


# The tables have no canonical links or refreshes, so no page there has an alias
# and the SQL needs none; tests cover what links add.
ORACLES["op2_url_filter"] = """
with rules(host, path, decision) as (values {rules}),
places as (
  select page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
  from pages
), fitting as (
  select p.*, r.host || r.path as rule, decision
  from places p left join rules r on (p.host = r.host or suffix(p.host, '.' || r.host)) and starts_with(p.path, r.path)
)
select page_id, host, path, rule, coalesce(decision, 'allow') as verdict
from fitting qualify row_number() over (partition by page_id order by length(rule) desc nulls last) = 1
""".format(rules=", ".join(str(r) for r in URL_RULES))


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rate_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_held_out(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"))


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.repeated_passages(table(spark, sf_dir, "documents"))


@query
def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links.near_vectors(table(spark, sf_dir, "embeddings"))


ORACLES["op12_embedding_dedup"] = """
with recursive vectors as (
  select vec_id, label, embedding::double[] as v from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), sized as (
  select *, sqrt(list_inner_product(v, v)) as size from vectors
), pairs as (
  select a.vec_id as a, b.vec_id as b from sized a join sized b on a.label = b.label and a.vec_id <> b.vec_id
  where a.size > 0 and b.size > 0 and list_inner_product(a.v, b.v) / (a.size * b.size) >= 0.93
), reach(node, least) as (
  select vec_id, vec_id from embeddings
  union select p.b, r.least from reach r join pairs p on p.a = r.node where r.least < p.b
), components as (
  select node, min(least) as component_id from reach group by node
)
select e.vec_id, (select count(*) from pairs p where p.a = e.vec_id) as n_links, component_id, e.vec_id = component_id as kept
from embeddings e join components c on c.node = e.vec_id
"""


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", moved), F.col("vec_id") % 50 == 0)


ORACLES["op13_hard_negatives"] = """
with vectors as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, list_inner_product(a.v, b.v)::bigint as score
  from vectors a join vectors b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0
), positives as (
  select anchor_id, vec_id as positive_id, score as positive_score,
         row_number() over (partition by anchor_id order by score desc, vec_id)::int as positive_rank
  from scored where same qualify positive_rank <= 5
)
select p.*, row_number() over (partition by p.anchor_id, positive_id order by n.score desc, n.vec_id)::int as rank,
       n.vec_id as negative_id, n.score as negative_score
from positives p join scored n on n.anchor_id = p.anchor_id and not n.same
where 50 * positive_score <= 100 * n.score and 100 * n.score <= 95 * positive_score
qualify rank <= 3
"""


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` where every tenth document repeats itself from some word on, by a hash of its doc_id."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = F.pmod(g, n)
        period = F.lit(1) + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        at = lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, period))
        return F.array_join(F.transform(words, lambda w, i: F.get(words, at(i.cast("long")))), " ")

    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    planted = bound(words, lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise(F.lit("")))
    return docs.withColumn("text", F.when(h % 10 == 0, planted).otherwise(F.col("text")))


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    # The longest run; of those the first, then the one with the smallest period.
    best = F.get(F.array_sort("runs", lambda x, y: F.when(
        x["length"] != y["length"], F.when(x["length"] > y["length"], -1).otherwise(1)
    ).otherwise(F.when(x["start"] != y["start"], F.when(x["start"] < y["start"], -1).otherwise(1)).otherwise(
        F.when(x["period"] < y["period"], -1).otherwise(1)
    ))), 0)
    line = lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))
    longest = found.withColumn("best", best)
    return longest.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform("runs", line)), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


ORACLES["op11_periodic_runs"] = r"""
with hashed as (
  select doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as original,
         xor(list_reduce(list_concat([4294967295::bigint], list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
           lambda r, b: list_reduce([xor(r, b), 0, 0, 0, 0, 0, 0, 0, 0]::bigint[],
             lambda x, z: xor(x >> 1, (x & 1) * 3988292384::bigint))), 4294967295::bigint) as h
  from documents
), planned as (
  select doc_id, original, len(original) as n, h % 10 = 0 and len(original) > 0 as moved, h // 10 as g from hashed
), placed as (
  select *, case when moved then g % n end as a, case when moved then 1 + (n - g % n) // (3 + g % 8) end as p from planned
), texts as (
  select doc_id, n, case when moved
    then list_transform(range(0, n), lambda i: original[(case when i < a then i else a + (i - a) % p end) + 1]) else original end as words
  from placed
), word_rows as (
  select doc_id, unnest(range(0, n)) as i, unnest(words) as w from texts
), matches as (
  select x.doc_id, x.i, y.i - x.i as period from word_rows x join word_rows y on x.doc_id = y.doc_id and x.w = y.w and y.i > x.i
  join texts t on t.doc_id = x.doc_id where 2 * (y.i - x.i) <= t.n
), islands as (
  select doc_id, period, i, i - row_number() over (partition by doc_id, period order by i) as island from matches
), stretches as (
  select doc_id, period, min(i) as start, max(i) + 1 - min(i) + period as length from islands group by doc_id, period, island
), runs as (
  select doc_id, start, length, min(period) as period from stretches
  where length >= 12 and length >= 2 * period group by all
), best as (
  select * from runs qualify row_number() over (partition by doc_id order by length desc, start, period) = 1
), listed as (
  select doc_id, count(*) as n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as text
  from runs group by doc_id
), kept as (
  select w.doc_id, string_agg(w.w, ' ' order by w.i) as text from word_rows w
  where not exists (select 1 from runs r where r.doc_id = w.doc_id and w.i >= r.start + r.period and w.i < r.start + r.length)
  group by w.doc_id
)
select t.doc_id, coalesce(n_runs, 0)::bigint as n_runs, b.start::bigint as start, b.length::bigint as length,
       b.period::bigint as period, (1000 * b.length // b.period)::bigint as exponent_milli,
       sha256(coalesce(l.text, '')) as runs_sha256, sha256(coalesce(k.text, '')) as collapsed_sha256
from texts t left join listed l on l.doc_id = t.doc_id left join best b on b.doc_id = t.doc_id left join kept k on k.doc_id = t.doc_id
"""
