"""Product-match tables derived from the driver's TPC-H-like tables.

Each text in ``SQL`` is valid in both Spark SQL and DuckDB, so the query under
test and its oracle start from the same rows. ``{name}`` stands for a driver
table or another fixture.
"""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

TENANT = "acme"
SEGMENT = "pets"
COMPETITORS = ["r0", "r1", "r2", "r3"]
STORES = [f"{c}_{c}" for c in COMPETITORS]
RUN_DATE = "1998-06-01"

_BASE = "concat(cast(l_partkey as varchar(20)), 'a')"
_COMP = "concat(cast(l_suppkey as varchar(20)), 'c')"
_R = "concat('r', cast(l_suppkey % 5 as varchar(2)))"
_UNDER = f"concat({_R}, '_', {_R})"
_BRACKET = f"concat({_R}, '<>', {_R})"
_DAY = "cast(cast(l_shipdate as date) as varchar(10))"
_PARTS = f"substr({_DAY}, 1, 4) as year, substr({_DAY}, 6, 2) as month, substr({_DAY}, 9, 2) as day"
_PAIR = f"{_BASE} as base_sku, 'acme_acme' as base_source_store, {_COMP} as comp_sku, {_UNDER} as comp_source_store"
_SEGMENT = "case when l_quantity < 40 then 'pets' else 'home' end"
_SCORE = "abs(l_discount)"

_CATALOG = """
select concat(cast(p_partkey as varchar(20)), case when p_partkey % 7 = 0 then 'A' else 'a' end) as sku,
  'acme' as source, 'acme_acme' as source_store, '{date}' as capture_date,
  case when p_partkey % 11 = 0 then 'False' else 'True' end as is_active,
  case when p_partkey % 13 = 0 then 'True' else 'False' end as is_discontinued,
  case when p_partkey % 4 = 0 then 'home' else 'pets' end as segment,
  case when p_partkey % 17 = 0 then '' else p_name end as product_title,
  concat('{note} ', p_name) as product_description, p_brand as brand,
  case when p_size < 10 then 'own' else 'other' end as brand_type,
  p_type as category, p_brand as subcategory, cast(p_size % 3 as varchar(5)) as sub_subcategory,
  case when p_partkey % 19 = 0 then 'nan' else cast(p_retailprice as varchar(20)) end as list_price,
  cast(p_size as varchar(5)) as list_price_alt, cast(p_size as varchar(5)) as size,
  cast(p_size + 1 as varchar(5)) as size_alt, 'oz' as uom, 'g' as uom_alt, '1' as pack_size,
  concat(cast(p_size as varchar(5)), 'x1') as dimension, '2' as shipping_weight,
  case when p_partkey % 3 = 0 then concat('00', cast(p_partkey as varchar(20)), ',99') else concat('00', cast(p_partkey as varchar(20))) end as upc,
  concat('m', cast(p_partkey as varchar(20))) as manufacturer_part_number,
  concat('ps', cast(p_partkey as varchar(20))) as parent_sku, concat('cs', cast(p_partkey as varchar(20))) as custom_sku,
  concat('http://acme/', cast(p_partkey as varchar(20))) as product_url, concat('http://img/', cast(p_partkey as varchar(20))) as image_url,
  '{attributes}' as additional_attributes
from {part} where {filter}
"""

_WAREHOUSE = """
select concat(cast(s_suppkey as varchar(20)), case when s_suppkey % 7 = 0 then 'C' else 'c' end) as sku,
  concat('r', cast(s_suppkey % 5 as varchar(2)), '<>r', cast(s_suppkey % 5 as varchar(2))) as source_store,
  concat('r', cast(s_suppkey % 5 as varchar(2))) as source_name, concat('r', cast(s_suppkey % 5 as varchar(2))) as store_name,
  {segment} as product_segment, '{date}' as capture_date, '2024' as year, '0{month}' as month, '01' as day,
  {title} as product_title, concat('sold by ', s_name) as product_description,
  concat('Brand#', cast(s_suppkey % 25 as varchar(3))) as standardized_brand, concat('brand ', cast(s_suppkey % 25 as varchar(3))) as crawled_brand,
  concat('cat', cast(s_nationkey % 4 as varchar(2))) as category, concat('sub', cast(s_nationkey as varchar(3))) as subcategory,
  concat('subsub', cast(s_suppkey % 3 as varchar(2))) as sub_subcategory,
  concat('000', cast(s_suppkey as varchar(20))) as upc, concat('http://r/', cast(s_suppkey as varchar(20))) as product_url,
  concat('http://rimg/', cast(s_suppkey as varchar(20))) as image_url, concat('mc', cast(s_suppkey as varchar(20))) as manufacturer_part_number,
  concat('pc', cast(s_suppkey as varchar(20))) as parent_sku, concat('cc', cast(s_suppkey as varchar(20))) as custom_sku,
  '3' as size, '4' as size_alt, 'lb' as uom, 'kg' as uom_alt, '2' as pack_size, '2x2' as dimension, '5' as shipping_weight,
  abs(s_acctbal) as list_price, abs(s_acctbal) + 1 as effective_price,
  split(concat('0', cast(s_suppkey as varchar(20)), ',00', cast(s_suppkey as varchar(20))), ',') as upc_list
from {supplier} where {filter}
"""

_ML_BASE = """
select concat(cast(p_partkey as varchar(20)), 'a') as sku, 'acme_acme' as source_store, '{segment}' as segment,
  '2024' as year, '{month}' as month, '05' as day, '2024-{month}-05' as capture_date,
  case when p_partkey % 5 = 0 then '' else concat('ml ', p_name) end as product_title,
  '' as product_description, p_brand as brand, p_type as category, '' as subcategory, cast(p_size as varchar(5)) as sub_subcategory,
  concat('00', cast(p_partkey as varchar(20))) as upc, case when p_partkey % 6 = 0 then '' else concat('ms', cast(p_partkey as varchar(20))) end as match_sku,
  '' as parent_sku, '' as manufacturer_part_number, '' as image_url, '' as product_url,
  case when p_partkey % 9 = 0 then '' else cast(p_retailprice as varchar(20)) end as effective_price,
  '' as size, '7' as size_alt, '' as uom, '' as uom_alt, '' as dimension, '' as shipping_weight
from {part} where {filter}
"""

_ML_COMP = """
select concat(cast(s_suppkey as varchar(20)), 'c') as sku,
  concat('r', cast(s_suppkey % 5 as varchar(2)), '_r', cast(s_suppkey % 5 as varchar(2))) as source_store, '{segment}' as segment,
  '2024' as year, '{month}' as month, '05' as day, '2024-{month}-05' as capture_date,
  concat('ml ', s_name) as product_title, '' as product_description, '' as brand, '' as category, '' as subcategory, '' as sub_subcategory,
  '' as upc, case when s_suppkey % 4 = 0 then '' else concat('mc', cast(s_suppkey as varchar(20))) end as match_sku,
  '' as parent_sku, '' as manufacturer_part_number, '' as image_url, '' as product_url, '' as effective_price,
  '' as size, '' as size_alt, '' as uom, '' as uom_alt, '' as dimension, '' as shipping_weight
from {supplier} where {filter}
"""

_MODEL = f"""
select concat(case when l_linenumber = 1 then '000<>' else '' end, {_BASE}, '<>acme<>acme') as base_sku_uuid,
  concat({_COMP}, '<>', {_BRACKET}) as comp_sku_uuid, 'acme<>acme' as base_source_store, {_BRACKET} as comp_source_store,
  {_SEGMENT} as segment, {_PARTS}, {_SCORE} as score
from {{lineitem}} where l_returnflag = 'FLAG'
"""


def _fill(text: str, **values: str) -> str:
    """Replace only the given placeholders, leave table placeholders alone."""
    for name, value in values.items():
        text = text.replace("{" + name + "}", value)
    return text


SQL = {
    "fx_pairs": f"select {_PAIR}, {_SCORE} as score from {{lineitem}}",
    "fx_library": f"""
        select {_PAIR}, 'acme' as company_code, {_SEGMENT} as segment,
          case l_returnflag when 'A' then 'exact' when 'N' then 'equivalent' else 'not_a_match' end as match,
          l_linestatus = 'F' as active, case when l_quantity < 10 then {_DAY} end as deleted_date,
          concat(substr({_DAY}, 1, 4), '-01-01') as load_date, {_DAY} as match_date,
          case when l_linenumber = 1 then concat('title ', cast(l_partkey as varchar(20))) else ' ' end as base_title,
          '' as base_description, '' as base_brand, concat('0', cast(l_partkey as varchar(20))) as base_upc,
          cast(l_partkey as varchar(20)) as base_price, '1' as base_pack_size,
          '' as comp_title, '' as comp_description, 'own' as comp_brand, concat('0', cast(l_suppkey as varchar(20))) as comp_upc,
          cast(l_suppkey as varchar(20)) as comp_price, '1' as comp_pack_size, 'checked' as matcher_comments
        from {{lineitem}} where l_linenumber <= 2""",
    "fx_reviews": f"""
        select {_PAIR}, concat('0', cast(l_partkey as varchar(20))) as base_upc, concat('0', cast(l_suppkey as varchar(20))) as comp_upc,
          {_SEGMENT} as segment,
          case l_returnflag when 'A' then 'exact' when 'N' then 'equivalent' else 'not_a_match' end as answer,
          concat('q', l_linestatus) as queue_name, {_DAY} as match_date, {_DAY} as inserted_date,
          substr({_DAY}, 1, 4) as year, substr({_DAY}, 6, 2) as month, l_linestatus = 'F' as is_active, {_SCORE} as score
        from {{lineitem}} where l_linenumber >= 2""",
    "fx_catalog": " union all ".join([
        _fill(_CATALOG, date="2024-01-01", note="old", attributes='{"cadence": "daily"}', filter="true"),
        _fill(_CATALOG, date="2024-02-01", note="new", attributes='{"cadence": "weekly"}', filter="p_partkey % 10 <> 0"),
    ]),
    "fx_warehouse": " union all ".join([
        _fill(_WAREHOUSE, date="2024-01-01", month="1", title="s_name",
              segment="case when s_nationkey % 2 = 0 then 'pets' else 'home' end", filter="true"),
        _fill(_WAREHOUSE, date="2024-02-01", month="2", title="concat('again ', s_name)",
              segment="case when s_nationkey % 2 = 0 then 'home' else 'pets' end", filter="s_suppkey % 3 = 0"),
    ]),
    "fx_input_precision": " union all ".join(
        [_fill(_ML_BASE, segment="pets", month=m, filter=f) for m, f in (("01", "true"), ("02", "p_partkey % 3 <> 0"))]
        + [_fill(_ML_COMP, segment="pets", month="02", filter="s_suppkey % 2 = 0")]
    ),
    "fx_input_generic": " union all ".join(
        [_fill(_ML_BASE, segment="pets", month="03", filter="p_partkey % 4 = 0"),
         _fill(_ML_COMP, segment="pets", month="03", filter="s_suppkey % 3 = 0"),
         _fill(_ML_COMP, segment="home", month="03", filter="s_suppkey % 3 = 1")]
    ),
    "fx_precision": _MODEL.replace("FLAG", "A"),
    "fx_generic": _MODEL.replace("FLAG", "N"),
    "fx_semantic": _MODEL.replace("FLAG", "R"),
    "fx_upc": f"""
        select concat('000', cast(l_partkey as varchar(20)), '<>', {_BASE}, '<>acme<>acme') as uuid_a,
          concat('000', cast(l_suppkey as varchar(20)), '<>', {_COMP}, '<>', {_BRACKET}) as uuid_b,
          {_SEGMENT} as segment, {_PARTS}, {_SCORE} as score
        from {{lineitem}} where l_linenumber = 3""",
    "fx_mpn": f"""
        select concat({_BASE}, '<>acme<>acme') as uuid_a, concat('000<>', {_COMP}, '<>', {_BRACKET}) as uuid_b,
          'acme<>acme' as base_source_store, {_BRACKET} as comp_source_store, {_SEGMENT} as segment, {_PARTS}, {_SCORE} as score
        from {{lineitem}} where l_linenumber = 4""",
    "fx_queue": f"""
        select {_PAIR}, o_orderpriority as queue_name, 'acme' as tenant, {_SEGMENT} as segment, {_PARTS}, {_SCORE} as aggregated_score
        from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey where l_linenumber = 5""",
    "fx_requests": f"""
        select 'acme' as company_code, {_SEGMENT} as product_segment, {_BASE} as base_sku, {_UNDER} as comp_source_store,
          concat('k', cast(l_partkey as varchar(20))) as search_key, case when l_quantity < 20 then 'upc' else 'title' end as search_key_type,
          case when l_tax < 0.04 then 'auto' else 'manual' end as search_type
        from {{lineitem}} where l_linenumber = 6""",
    "fx_crawl": f"""
        select concat(cast(l_suppkey as varchar(20)), 'C') as sku, case when l_quantity < 5 then null else concat('000', cast(l_suppkey as varchar(20))) end as upc,
          {_R} as source_name, {_R} as store_name, {_DAY} as capture_date, substr({_DAY}, 1, 4) as year
        from {{lineitem}} where l_suppkey % 8 <> 0""",
    "fx_domains": """
        select distinct 'acme' as client, concat('r', cast(s_suppkey % 5 as varchar(2)), '_r', cast(s_suppkey % 5 as varchar(2))) as primary_store
        from {supplier} where s_suppkey % 5 < 4""",
    "fx_drop": f"""
        select concat('00', {_BASE}) as base_sku, {_COMP} as comp_sku,
          case when l_linenumber = 1 then concat(' ', {_BRACKET}) else upper({_UNDER}) end as comp_source_store,
          cast(cast(round({_SCORE} * 100) as int) as varchar(5)) as score,
          case when l_returnflag = 'A' then 'exact' else 'equivalent' end as match
        from {{lineitem}} where l_linenumber >= 3""",
    "fx_recall": f"""
        select concat(case when l_linenumber % 2 = 0 then '000<>' else '' end, {_BASE}, '<>acme<>acme') as base_sku_uuid,
          concat(case when l_linenumber % 3 = 0 then '111<>' else '' end, {_COMP}, '<>', {_BRACKET}) as comp_sku_uuid,
          cast(cast(round({_SCORE} * 100) as int) as varchar(5)) as score,
          concat('comp_source_store=', {_BRACKET}) as part, concat('f', cast(l_orderkey % 4 as varchar(2))) as file
        from {{lineitem}}""",
}

SQL |= {
    "fx_titles": """
        select b.p_name as base_title, c.p_name as comp_title, l_orderkey, l_linenumber
        from {lineitem} join {part} b on l_partkey = b.p_partkey join {part} c on l_suppkey = c.p_partkey""",
    "fx_lemmas": """
        select distinct word, substr(word, 1, 3) as lemma from (
          select split_part(p_name, ' ', 1) as word from {part} union all select split_part(p_name, ' ', 2) as word from {part}
        ) w where length(word) > 3""",
    "fx_finished": """
        select concat('s3://inbox/drop/company_code=u', cast(user_id as varchar(20)), '/product_segment=', event_type, '/load_date=',
          cast(cast(ts as date) as varchar(10)), '/') as input_prefix, ts
        from {events} where event_id % 3 = 0 and event_type <> 'view'""",
    "fx_title_embeddings": """
        select n.title, e.embedding from
          (select title, HASH(title) % (select count(*) from {embeddings}) as vec_id from (select distinct p_name as title from {part}) p) n
        join {embeddings} e on n.vec_id = e.vec_id""",
    "fx_tax_base": """
        select distinct p_type as category, p_brand as subcategory, case when p_size % 3 < 2 then concat('line ', cast(p_size % 3 as varchar(5))) end as sub_subcategory
        from {part}""",
    "fx_tax_comp": """
        select distinct lower(r_name) as retailer, c_mktsegment as category, n_name as subcategory, case when c_custkey % 3 < 2 then concat('line ', cast(c_custkey % 3 as varchar(5))) end as sub_subcategory
        from {customer} join {nation} on c_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey""",
    "fx_tax_texts": """
        select distinct concat_ws(' ', category, subcategory, sub_subcategory) as title from
        (select category, subcategory, sub_subcategory from {fx_tax_base} union select category, subcategory, sub_subcategory from {fx_tax_comp}) t""",
    "fx_tax_embeddings": """
        select t.title, e.embedding from (select title, HASH(title) % (select count(*) from {embeddings}) as vec_id from {fx_tax_texts}) t
        join {embeddings} e on t.vec_id = e.vec_id""",
    "fx_docs": "select doc_id as row_id, text as q from {documents}",
    "fx_asked": "select item_id as query_id, text as q from {benchmark}",
    "fx_events": """
        select case when event_id % 37 = 0 then null else event_id end as event_id, ts, 'inbox' as bucket,
          concat('drop/company_code%3Du', cast(user_id as varchar(20)), '/product_segment=', event_type,
            case when event_type = 'view' then '/x/' else concat('/load_date=', cast(cast(ts as date) as varchar(10)), '/') end,
            case when event_type = 'error' then 'part-0.csv' else '_SUCCESS' end) as key
        from (select * from {events} union all select * from {events} where event_id % 10 = 0) e""",
    "fx_vectors": """
        select a.vec_id, b.vec_id as other_id, a.embedding as base_embedding, b.embedding as comp_embedding
        from {embeddings} a join {embeddings} b on b.vec_id = a.vec_id + 1""",
}

for _name in ("fx_library", "fx_reviews"):
    SQL[f"{_name}_m"] = SQL[_name].replace("'exact'", "'exact_match'").replace("'equivalent'", "'equivalent_match'")


# HASH(column) in a text: the first 32 bits of the MD5 digest, in each engine's words.
_SPARK_HASH = r"cast(conv(substr(md5(\1), 1, 8), 16, 10) as bigint)"
_DUCK_HASH = r"cast('0x' || substr(md5(\1), 1, 8) as bigint)"


def _hashed(text: str, form: str) -> str:
    return re.sub(r"HASH\((\w+)\)", form, text)


def _needs(text: str) -> list[str]:
    return [n for n in dict.fromkeys(re.findall(r"\{(\w+)\}", text)) if n in TABLES or n in SQL]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str, known: dict[str, DataFrame] | None = None) -> DataFrame:
    """A driver table or a fixture as a lazy frame; ``known`` avoids building one twice."""
    known = {} if known is None else known
    if name not in known:
        if name in TABLES:
            known[name] = table(spark, sf_dir, name)
        else:
            inputs = {n: fixture(spark, sf_dir, n, known) for n in _needs(SQL[name])}
            known[name] = spark.sql(_hashed(SQL[name], _SPARK_HASH).replace('{"', '{{"').replace('"}', '"}}'), **inputs)
    return known[name]


@cache
def _closure(name: str) -> tuple[str, ...]:
    found: list[str] = []
    for need in _needs(SQL[name]):
        if need in SQL:
            found += _closure(need)
    return tuple(dict.fromkeys([*found, name]))


def with_fixtures(names: list[str], query: str) -> str:
    """DuckDB text: the fixtures as common table expressions, then ``query``."""
    wanted = dict.fromkeys(n for name in names for n in _closure(name))
    parts = []
    for name in wanted:
        text = _hashed(SQL[name], _DUCK_HASH)
        for need in _needs(text):
            text = text.replace("{" + need + "}", need)
        parts.append(f"{name} as ({text})")
    body = query.strip()
    if body.lower().startswith("with "):
        return "with " + ", ".join(parts) + ", " + body[5:]
    return "with " + ", ".join(parts) + " " + body
