"""DuckDB statements that state, in plain SQL, what each query must return."""

from __future__ import annotations

from fixtures import SEGMENT, TENANT, COMPETITORS, with_fixtures
from pairloom.functions.text import ENGLISH_STOP_WORDS

COMP_B = ", ".join(f"'{c}<>{c}'" for c in COMPETITORS)
COMP_U = ", ".join(f"'{c}_{c}'" for c in COMPETITORS)
COMP_N = ", ".join(f"'{c}'" for c in COMPETITORS)
YEARS = "'1998', '1997', '1996'"
PAIR = "base_sku, comp_sku, comp_source_store"

ORACLES: dict[str, str] = {}


def oracle(name: str, fixtures: list[str], sql: str) -> None:
    ORACLES[name] = with_fixtures(fixtures, sql) if fixtures else sql


def pick(source: str, keys: str, order: str) -> str:
    """First row per key; ``order`` is a comma list, ascending and nulls last unless it says otherwise."""
    parts = [o.strip() for o in order.split(",")]
    full = ", ".join(p if "nulls" in p else f"{p} nulls last" for p in parts)
    return f"select * from ({source}) qualify row_number() over (partition by {keys} order by {full}) = 1"


def newest(columns: str, table: str) -> str:
    """``columns`` of the latest row per SKU."""
    return f"select {columns} from {table} qualify row_number() over (partition by sku order by capture_date desc nulls last) = 1"


def canonical(uuid: str) -> str:
    parts = f"string_split({uuid}, '<>')"
    return f"case when len({parts}) < 3 then {uuid} else array_to_string({parts}[-3:], '<>') end"


def sku_of(uuid: str) -> str:
    return f"split_part({canonical(uuid)}, '<>', 1)"


def store_after_two(uuid: str) -> str:
    return f"array_to_string(string_split({uuid}, '<>')[3:], '<>')"


def under(store: str) -> str:
    return f"replace({store}, '<>', '_')"


BETWEEN = f"base_source_store = 'acme<>acme' and comp_source_store in ({COMP_B}) and segment = '{SEGMENT}'"

# --- signals -----------------------------------------------------------------

SIGNALS = {
    "spine": """
        select lower(base_sku) as base_sku, lower(comp_sku) as comp_sku, lower(comp_source_store) as comp_source_store,
          min(lower(base_source_store)) as base_source_store
        from fx_pairs group by 1, 2, 3""",
    "catalog": pick(
        f"""select lower(sku) as base_sku, product_title as base_title, upc, segment, manufacturer_part_number as base_mpn
        from fx_catalog where source = '{TENANT}'
          and capture_date = (select max(capture_date) from fx_catalog where source = '{TENANT}')
          and is_active = 'True' and is_discontinued = 'False'""",
        "base_sku", "base_title, upc, segment, base_mpn"),
    "crawl": f"""
        select lower(sku) as comp_sku, lower(concat_ws('_', source_name, store_name)) as comp_source_store,
          lower(upc) as dc_upc, min(capture_date) as comp_sku_first_date
        from fx_crawl where year in ({YEARS}) and source_name in ({COMP_N}) group by 1, 2, 3""",
    "warehouse": f"""
        select distinct lower(sku) as comp_sku, lower({under('source_store')}) as comp_source_store, product_title as comp_title,
          product_url as comp_url, lower(upc) as pdp_upc, manufacturer_part_number as pdp_mpn, year || month || day as pdp_date
        from fx_warehouse where source_store in ({COMP_B}) and product_segment = '{SEGMENT}'""",
    "review": f"""
        select lower(base_sku) as base_sku, lower(comp_sku) as comp_sku, lower({under('comp_source_store')}) as comp_source_store,
          score, match_date, inserted_date, answer, list_sort(list_distinct(list(queue_name))) as fl_queue_name
        from fx_reviews where base_source_store = 'acme_acme' and comp_source_store in ({COMP_U}) and segment = '{SEGMENT}'
        group by 1, 2, 3, 4, 5, 6, 7""",
    "upc": f"""
        select lower(split_part(uuid_a, '<>', 2)) as base_sku, lower(split_part(uuid_b, '<>', 2)) as comp_sku,
          lower({under(store_after_two('uuid_b'))}) as comp_source_store, split_part(uuid_a, '<>', 1) as csf_base_upc,
          split_part(uuid_b, '<>', 1) as csf_comp_upc, score as csf_upc_score, min(year || month || day) as csf_upc_first_sugg_date
        from fx_upc where {store_after_two('uuid_a')} = 'acme<>acme' and {store_after_two('uuid_b')} in ({COMP_B})
          and segment = '{SEGMENT}' group by 1, 2, 3, 4, 5, 6""",
    "mpn": f"""
        select lower({sku_of('uuid_a')}) as base_sku, lower({sku_of('uuid_b')}) as comp_sku,
          lower({under('comp_source_store')}) as comp_source_store, score as csf_mpn_score, min(year || month || day) as csf_mpn_first_sugg_date
        from fx_mpn where {BETWEEN} group by 1, 2, 3, 4""",
    "library": f"""
        select lower(base_sku) as base_sku, lower(comp_sku) as comp_sku, lower(comp_source_store) as comp_source_store,
          base_upc, comp_upc, match_date, matcher_comments, max(deleted_date is null) as is_present_in_match_library,
          max(deleted_date is not null) as is_deleted_in_match_library, max(deleted_date) as last_deleted_date,
          min(load_date) as match_library_inserted_date
        from fx_library where active and deleted_date is null and base_source_store = 'acme_acme' and comp_source_store in ({COMP_U})
          and load_date = (select max(load_date) from fx_library where base_source_store = 'acme_acme' and active and deleted_date is null)
        group by 1, 2, 3, 4, 5, 6, 7""",
    "input": " union ".join(
        f"""select lower(sku) as sku, lower(source_store) as source_store, product_title as title, capture_date, upc from {t}
        where source_store in ({COMP_U}, 'acme_acme') and segment = '{SEGMENT}' and year || month || day =
          (select max(year || month || day) from {t} where source_store in ({COMP_U}, 'acme_acme'))"""
        for t in ("fx_input_precision", "fx_input_generic")),
    "queue": f"""
        select lower(base_sku) as base_sku, lower(comp_sku) as comp_sku, lower(comp_source_store) as comp_source_store,
          max(aggregated_score) as csf_queue_score, min(year || month || day) as csf_queue_date,
          list_sort(list_distinct(list(queue_name))) as csf_queue_name
        from fx_queue where tenant = '{TENANT}' and segment = '{SEGMENT}' group by 1, 2, 3""",
    "request": f"""
        select lower(base_sku) as base_sku, lower(comp_source_store) as comp_source_store,
          base_sku || '<>' || replace(comp_source_store, '_', '<>') as afm_request_key, search_type as afm_search_type,
          search_key_type as afm_search_key_type, search_key as afm_search_key
        from fx_requests where company_code = '{TENANT}' and comp_source_store in ({COMP_U}) and product_segment = '{SEGMENT}'""",
}
for model in ("precision", "generic", "semantic"):
    SIGNALS[model] = f"""
        select lower({sku_of('base_sku_uuid')}) as base_sku, lower({sku_of('comp_sku_uuid')}) as comp_sku,
          lower({under('comp_source_store')}) as comp_source_store, max(score) as model_score, min(year || month || day) as first_sugg_date
        from fx_{model} where {BETWEEN} group by 1, 2, 3"""

SIGNAL_FIXTURES = {
    "crawl": ["fx_crawl"], "warehouse": ["fx_warehouse"], "review": ["fx_reviews"], "upc": ["fx_upc"],
    "mpn": ["fx_mpn"], "library": ["fx_library"], "input": ["fx_input_precision", "fx_input_generic"],
    "precision": ["fx_precision"], "generic": ["fx_generic"], "semantic": ["fx_semantic"],
    "queue": ["fx_queue"], "request": ["fx_requests"],
}
for _name, _needed in SIGNAL_FIXTURES.items():
    oracle(f"sig_{_name}", _needed, f"select * from ({SIGNALS[_name]})")
oracle("sig_catalog", ["fx_pairs", "fx_catalog"], f"""
    with spine as ({SIGNALS['spine']}), products as ({SIGNALS['catalog']})
    select s.*, base_title, upc, segment, base_mpn, base_title is not null as base_sku_in_catalog
    from spine s left join products using (base_sku)""")


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^0+', '')"


def _coverage() -> str:
    ctes = [f"spine as ({SIGNALS['spine']})", f"products as ({SIGNALS['catalog']})", f"inputs as ({SIGNALS['input']})"]
    first = {
        "f": pick(f"select {PAIR}, inserted_date, answer, fl_queue_name from ({SIGNALS['review']})", PAIR,
                  "inserted_date, answer, fl_queue_name"),
        "h": pick(f"select {PAIR}, is_present_in_match_library, is_deleted_in_match_library, last_deleted_date, "
                  f"match_library_inserted_date, matcher_comments from ({SIGNALS['library']})", PAIR,
                  "matcher_comments, is_present_in_match_library, is_deleted_in_match_library, last_deleted_date, match_library_inserted_date"),
        "cg": SIGNALS["generic"], "cs": SIGNALS["semantic"], "cp": SIGNALS["precision"], "cq": SIGNALS["queue"],
        "cu": pick(SIGNALS["upc"], PAIR, "csf_base_upc, csf_comp_upc, csf_upc_score, csf_upc_first_sugg_date"),
        "cm": pick(SIGNALS["mpn"], PAIR, "csf_mpn_score, csf_mpn_first_sugg_date"),
        "dc": pick(SIGNALS["crawl"], "comp_sku, comp_source_store", "dc_upc, comp_sku_first_date"),
        "pdp": pick(SIGNALS["warehouse"], "comp_sku, comp_source_store", "comp_title, pdp_upc, pdp_mpn, pdp_date"),
        "ic": pick("select sku as comp_sku, source_store as comp_source_store, title, capture_date from inputs",
                   "comp_sku, comp_source_store", "title, capture_date"),
        "ib": pick("select sku as base_sku, source_store as base_source_store, title, capture_date from inputs",
                   "base_sku, base_source_store", "title, capture_date"),
        "afm": pick(SIGNALS["request"], "base_sku, comp_source_store",
                    "afm_request_key, afm_search_type, afm_search_key_type, afm_search_key"),
    }
    ctes += [f"{name} as ({text})" for name, text in first.items()]
    by_pair = " ".join(f"left join {n} using ({PAIR})" for n in ("f", "h", "cg", "cs", "cp", "cq", "cu", "cm"))

    def model(alias: str, label: str, flag: str) -> str:
        return (f"{alias}.model_score is not null as {flag}, {alias}.model_score as csf_{label}_score, "
                f"{alias}.first_sugg_date as csf_{label}_first_sugg_date")

    return f"""
    with {', '.join(ctes)}
    select base_sku, base_title is not null as base_sku_in_catalog, upc, base_title, comp_sku, comp_source_store, base_source_store,
      products.segment, base_mpn,
      dc.comp_sku is not null as sku_in_dc, comp_sku_first_date, dc_upc, dc_upc is not null as upc_in_dc,
      pdp.comp_sku is not null as sku_in_pdp, pdp_date, pdp_upc, pdp_mpn, pdp_upc is not null as upc_in_pdp,
      inserted_date is not null as is_fl_attempted, inserted_date, answer, fl_queue_name, comp_title,
      coalesce(is_present_in_match_library, false) as is_present_in_match_library, is_deleted_in_match_library, last_deleted_date,
      match_library_inserted_date, matcher_comments,
      {strip('upc')} as normalized_base_upc, {strip('dc_upc')} as normalized_dc_upc, {strip('pdp_upc')} as normalized_pdp_upc,
      coalesce({strip('upc')} = {strip('dc_upc')}, false) or coalesce({strip('upc')} = {strip('pdp_upc')}, false) as has_upc_overlap,
      csf_upc_score is not null as is_suggested_by_csf_upc, csf_upc_score, csf_upc_first_sugg_date, csf_base_upc, csf_comp_upc,
      csf_mpn_score is not null as is_suggested_by_csf_mpn, csf_mpn_score, csf_mpn_first_sugg_date,
      {model('cp', 'precision', 'is_suggested_by_csf_precision')}, {model('cg', 'generic', 'is_suggested_by_csf_generic')},
      {model('cs', 'semantic', 'is_suggested_by_semantic')},
      csf_queue_score is not null as is_pair_in_csf_queue, csf_queue_score, csf_queue_date, csf_queue_name,
      ib.base_sku is not null as base_sku_is_present_in_csf_ml_input, ib.title as base_title_csf_ml_input, ib.capture_date as base_capture_date_csf,
      ic.comp_sku is not null as comp_sku_is_present_in_csf_ml_input, ic.title as comp_title_csf_ml_input, ic.capture_date as comp_capture_date_csf,
      afm_request_key is not null as has_afm_request, afm_search_type, afm_search_key_type
    from spine {by_pair}
      left join dc using (comp_sku, comp_source_store) left join pdp using (comp_sku, comp_source_store)
      left join ic using (comp_sku, comp_source_store) left join products using (base_sku)
      left join ib using (base_sku, base_source_store) left join afm using (base_sku, comp_source_store)"""


COVERAGE_FIXTURES = [
    "fx_pairs", "fx_catalog", "fx_crawl", "fx_warehouse", "fx_reviews", "fx_library", "fx_upc", "fx_mpn",
    "fx_input_precision", "fx_input_generic", "fx_precision", "fx_generic", "fx_semantic", "fx_queue", "fx_requests",
]
oracle("coverage_report", COVERAGE_FIXTURES, _coverage())


# --- review queue and auto approval ------------------------------------------

def _fallbacks(fields: dict, first: str, second: str) -> str:
    lines = []
    for target, (own, other) in fields.items():
        spare = f"cast({second}.{other} as varchar)"
        if target == "base_upc":
            spare = f"split_part({spare}, ',', 1)"
        price = ", '0.0'" if target.endswith("_price") else ""
        lines.append(f"coalesce(nullif({first}.{own}, ''), {spare}{price}) as {target}")
    return ",\n      ".join(lines)


def _queue() -> str:
    from pairloom.plans import review_queue as q

    base_needed = sorted({o for o, _ in q.BASE_FIELDS.values()}) + ["match_sku"]
    comp_needed = sorted({o for o, _ in q.COMP_FIELDS.values()}) + ["match_sku"]
    cat_needed = sorted({o for _, o in q.BASE_FIELDS.values()})
    pdp_needed = sorted({o for _, o in q.COMP_FIELDS.values()})
    newest = """select * from fx_input_precision where segment = 'pets' and year || month || day =
        (select max(year || month || day) from fx_input_precision where segment = 'pets')"""
    ctes = {
        "wanted": pick("select * from fx_pairs", "base_sku, comp_sku, base_source_store, comp_source_store", "score"),
        "matched": """select distinct lower(base_sku) as b, lower(comp_source_store) as cs, lower(base_source_store) as bs from fx_library
            where load_date = (select max(load_date) from fx_library) and company_code = 'acme' and active and deleted_date is null""",
        "newest": newest,
        "scope": "select distinct comp_source_store from fx_pairs where comp_source_store in (select primary_store from fx_domains)",
        "i_base": pick("select lower(sku) as k, * from newest where source_store = 'acme_acme'", "k", ", ".join(base_needed)),
        "cat": pick("select lower(sku) as k, * from fx_catalog where source = 'acme' and is_active = 'True'", "k",
                    ", ".join(["capture_date desc nulls last", *cat_needed])),
        "i_comp": pick("select lower(sku) as k, lower(source_store) as s, * from newest where source_store in (from scope)", "k, s",
                       ", ".join(comp_needed)),
        "pdp": pick("select lower(sku) as k, lower(replace(source_store, '<>', '_')) as s, * from fx_warehouse "
                    "where replace(source_store, '<>', '_') in (from scope)", "k, s",
                    ", ".join(["capture_date desc nulls last", *pdp_needed])),
    }
    c = {
        "base_attributes": q.BASE_ATTRIBUTES,
        "comp_attributes": q.COMP_ATTRIBUTES,
    }
    base_match = "coalesce(nullif(i_base.match_sku, ''), w.base_sku)"
    comp_match = "coalesce(nullif(i_comp.match_sku, ''), w.base_sku)"
    pair_id = "w.base_sku || '_' || w.base_source_store || '<>' || w.comp_sku || '_' || w.comp_source_store"
    heads = ", ".join(f"{n} as ({t})" for n, t in ctes.items())
    return f"""
    with {heads}
    select {pair_id} as pair_id, 'True' as active, {_fallbacks(q.BASE_FIELDS, 'i_base', 'cat')}, {_fallbacks(q.COMP_FIELDS, 'i_comp', 'pdp')},
      '{c['base_attributes']}' as base_custom_attributes, '{c['comp_attributes']}' as comp_custom_attributes,
      w.base_sku, w.base_source_store, w.comp_sku, w.comp_source_store,
      {base_match} as match_sku,
      {base_match} || '_' || w.base_source_store || '_' || w.comp_source_store as match_sku_base_source_store_comp_source_store,
      w.base_source_store || '_' || w.comp_sku || '_' || w.comp_source_store as base_source_store_comp_sku_comp_source_store,
      w.comp_sku || '_' || w.comp_source_store || '_' || w.base_source_store as comp_sku_comp_source_store_base_source_store,
      w.comp_source_store || '_' || {comp_match} || '_' || w.base_source_store as comp_source_store_match_sku_base_source_store,
      'Acme' as base_store_name_display, 'verified' as internal_review_state, 'reviewers' as company_code,
      'reviewers_' || w.base_source_store as company_code_base_source_store, split_part(w.comp_source_store, '_', 2) as comp_store_name_display,
      'unverified' as customer_review_state, 'retail' as domain,
      cast(cast('0x' || substr(md5({pair_id}), 1, 8) as bigint) % 90000 + 10000 as int) as enqueue_index,
      cast(epoch(timestamp '2024-03-01' + interval 21 day) as int) as expiration_date, 'new' as item_status, 'exact' as match,
      'MODEL' as matcher, cast(epoch(timestamp '2024-03-01') as int) as match_date, 'run-1' as match_id,
      'product_found' as match_status, 'title-model' as model_used, 'adhoc_new' as queue_name_item_status, w.score,
      'completed' as status, 'adhoc' as queue_name, 'adhoc' as adhoc_queue_name, '2024-03-01' as load_date
    from wanted w
      left join i_base on lower(w.base_sku) = i_base.k left join cat on lower(w.base_sku) = cat.k
      left join i_comp on lower(w.comp_sku) = i_comp.k and lower(w.comp_source_store) = i_comp.s
      left join pdp on lower(w.comp_sku) = pdp.k and lower(w.comp_source_store) = pdp.s
    where not exists (select 1 from matched m where m.b = lower(w.base_sku) and m.cs = lower(w.comp_source_store)
      and m.bs = lower(w.base_source_store))"""


oracle("review_queue", ["fx_pairs", "fx_library", "fx_input_precision", "fx_catalog", "fx_warehouse", "fx_domains"], _queue())


def price(x: str) -> str:
    return f"try_cast(nullif(lower(trim({x})), 'nan') as double)"


def _approve() -> str:
    from pairloom.plans import approval as a

    comp_fields = ", ".join(f"cast({source} as varchar) as {name}" for name, source in a.COMP_FIELDS.items())
    empty = ", ".join(f"'' as {n}" for n in a.EMPTY_COLUMNS)
    order = ", ".join(["try_cast(score as double) desc nulls last", "comp_source_store", "comp_sku",
                       *[n for n in a.APPROVAL_COLUMNS if n not in ("base_sku", "comp_sku", "comp_source_store")]])
    ratio = f"abs({price('base_price')} - {price('comp_price')}) / {price('base_price')}"
    return f"""
    with decided as (
      select distinct lower(trim(base_sku)) as base_sku, lower(trim(comp_sku)) as comp_sku,
        lower(replace(trim(comp_source_store), '<>', '_')) as comp_source_store, score, match from fx_drop
      where trim(coalesce(base_sku, '')) <> '' and trim(coalesce(comp_sku, '')) <> ''
        and lower(replace(trim(comp_source_store), '<>', '_')) in (select primary_store from fx_domains)),
    base as (
      select distinct {strip('lower(sku)')} as bk, list_price as base_price, product_title as base_title,
        split_part(upc, ',', 1) as base_upc, parent_sku as base_parent_sku from fx_catalog
      where source = 'acme' and capture_date = (select max(capture_date) from fx_catalog where source = 'acme')
        and additional_attributes like '%weekly%'),
    comp as (
      select distinct {strip('lower(sku)')} as ck, lower(source_name || '_' || store_name) as cs, {comp_fields} from fx_warehouse
      where lower(replace(source_store, '<>', '_')) in (select primary_store from fx_domains) and product_segment = 'pets'),
    lib as (
      select {strip('lower(base_sku)')} as bk, {strip('lower(comp_sku)')} as ck, comp_source_store as cs, deleted_date from fx_library
      where company_code = 'acme' and load_date = (select max(load_date) from fx_library where company_code = 'acme')),
    shaped as (
      select 'acme_acme' as base_source_store, 'ml-V2.0' as model_used, {empty}, d.*, base.* exclude (bk), comp.* exclude (ck, cs)
      from decided d join base on {strip('d.base_sku')} = base.bk
        join comp on {strip('d.comp_sku')} = comp.ck and d.comp_source_store = comp.cs
      where not exists (select 1 from lib where lib.bk = {strip('d.base_sku')} and lib.cs = d.comp_source_store and lib.deleted_date is null)
        and not exists (select 1 from lib where lib.bk = {strip('d.base_sku')} and lib.ck = {strip('d.comp_sku')} and lib.cs = d.comp_source_store)
        and {price('base_price')} > 0 and {ratio} < 0.8)
    select {', '.join(a.APPROVAL_COLUMNS)} from ({pick('select * from shaped', 'base_sku', order)})"""


oracle("auto_approve", ["fx_drop", "fx_catalog", "fx_warehouse", "fx_library", "fx_domains"], _approve())
oracle("unknown_stores", ["fx_drop", "fx_domains"], """
    select distinct lower(replace(trim(comp_source_store), '<>', '_')) as comp_source_store from fx_drop
    where trim(coalesce(comp_source_store, '')) <> ''
      and lower(replace(trim(comp_source_store), '<>', '_')) not in (select primary_store from fx_domains)""")


# --- training pairs and similarity -------------------------------------------

STOP = "'old', 'the', 'of'"


def english() -> str:
    """The default stop words as a SQL list."""
    return ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH_STOP_WORDS)


UUID_BASE = "concat_ws('<>', base_sku, replace(base_source_store, '_', '<>'))"
UUID_COMP = "concat_ws('<>', comp_sku, replace(comp_source_store, '_', '<>'))"


def blank(x: str) -> str:
    return f"nullif(trim({x}), '')"


def _training() -> str:
    texts = [f"{side}_{f}" for side in ("base", "comp") for f in ("title", "description", "brand")]
    extras = ["base_price", "base_pack_size", "comp_price", "comp_pack_size"]
    pair = "base_sku, base_source_store, comp_sku, comp_source_store"
    rest = ", ".join(["source_priority", "base_sku", "base_source_store", "comp_sku", "comp_source_store", "answer", "segment",
                      "base_upc", "comp_upc", *texts, *extras])
    pdp = pick(f"""select sku, replace(source_store, '<>', '_') as store, product_segment, {blank('product_title')} as t,
        {blank('product_description')} as d, {blank('standardized_brand')} as b, manufacturer_part_number as m, upc_list from fx_warehouse""",
               "sku, store", "product_segment, t, d, b, m, upc_list")
    cat = pick(f"""select sku, source || '_' || source as store, capture_date, {blank('product_title')} as t,
        {blank('product_description')} as d, {blank('brand')} as b, manufacturer_part_number as m from fx_catalog where source = 'acme'""",
               "sku, store", "capture_date desc nulls last, t, d, b, m")
    filled = ", ".join(
        f"coalesce(r.{side}_{f}, {alias}.{f[0]}) as {side}_{f}"
        for side, alias in (("base", "cat"), ("comp", "pdp")) for f in ("title", "description", "brand"))
    return f"""
    with merged as (
      select {pair}, match as answer, segment, base_upc, comp_upc, {', '.join(f'{blank(t)} as {t}' for t in texts)}, {', '.join(extras)}, 1 as source_priority
      from fx_library where active and deleted_date is null and company_code = 'acme' and load_date = '1998-01-01' and match in ('exact', 'equivalent')
      union all
      select {pair}, answer, segment, base_upc, comp_upc, {', '.join(f'null as {t}' for t in [*texts, *extras])}, 2
      from fx_reviews where year || month >= '199401' and answer in ('exact', 'equivalent', 'not_a_match') and base_source_store = 'acme_acme'),
    r as ({pick(f"select *, {UUID_BASE} || '<>' || {UUID_COMP} as pair_id from merged", 'pair_id', rest)}),
    cat as ({cat}), pdp as ({pdp})
    select {UUID_BASE} as sku_uuid_a, {UUID_COMP} as sku_uuid_b, pair_id, answer, segment, base_sku, base_source_store, comp_sku, comp_source_store,
      {filled}, base_upc, comp_upc, {', '.join(extras)}, cat.m as base_mpn, pdp.m as comp_mpn, pdp.upc_list as comp_upc_list, source_priority
    from r left join cat on r.base_sku = cat.sku and r.base_source_store = cat.store
      left join pdp on r.comp_sku = pdp.sku and r.comp_source_store = pdp.store
    where coalesce(r.base_title, cat.t) is not null and coalesce(r.comp_title, pdp.t) is not null"""


TRAINING_FIXTURES = ["fx_library", "fx_reviews", "fx_catalog", "fx_warehouse"]
oracle("training_pairs", TRAINING_FIXTURES, _training())


def grams(text: str, stop: str = STOP, lemmas: str | None = None) -> str:
    """Words of two letters or more without stop words, then their bigrams; ``lemmas`` is a table of (word, lemma)."""
    words = f"string_split(trim(regexp_replace(lower({text}), '[^a-z]+', ' ', 'g')), ' ')"
    source = ""
    if lemmas:
        source = f" from (select map_from_entries(list((word, lemma))) as known from {lemmas})"
        words = f"list_transform(list_filter({words}, lambda w: w not in ({stop})), lambda w: coalesce(known[w], w))"
    words = f"list_filter({words}, lambda w: len(w) >= 2 and w not in ({stop}))"
    return f"(select list_concat(w, [w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) from (select {words} as w{source}))"


def tfidf_ctes(docs: str, fit: str, terms: str, features: int, sublinear: bool = False, p: str = "") -> str:
    """CTEs ending in {p}unit(key, term, w). ``docs`` and ``fit`` are CTEs with (key, text)."""
    tf = "(ln(tf) + 1)" if sublinear else "tf"
    same = docs == fit
    counts = f"{p}counts as (select key, term, count(*) as tf from (select key, unnest({terms}) as term from {docs}) group by 1, 2)"
    fitted = f"{p}counts" if same else f"(select key, term, count(*) as tf from (select key, unnest({terms}) as term from {fit}) group by 1, 2)"
    return f"""
    {counts},
    {p}vocab as (select term, ln((1 + (select count(*) from {fit})) / (1 + df)) + 1 as idf from
      (select term, sum(tf) as corpus_tf, count(*) as df from {fitted} group by 1 order by corpus_tf desc, term limit {features})),
    {p}raw as (select key, term, {tf} * idf as w from {p}counts join {p}vocab using (term)),
    {p}unit as (select key, term, w / norm as w from {p}raw join (select key, sqrt(sum(w * w)) as norm from {p}raw group by 1) using (key))"""


def pair_scores(pairs: str, digits: int, p: str = "") -> str:
    """(base_title, comp_title, tfidf_similarity) for a CTE of distinct pairs."""
    return f"""select q.base_title, q.comp_title, round(coalesce(sum(a.w * b.w), 0), {digits}) as tfidf_similarity
      from {pairs} q left join {p}unit a on a.key = q.base_title left join {p}unit b on b.key = q.comp_title and b.term = a.term group by 1, 2"""


DOT = "list_inner_product(cast({a} as double[]), cast({b} as double[]))"
TITLE_DOCS = """titles as (select base_title as key, base_title as text from pairs union select comp_title, comp_title from pairs)"""

oracle("embedding_similarity", ["fx_titles", "fx_title_embeddings"], f"""
    select t.*, round({DOT.format(a='a.embedding', b='b.embedding')}, 6) as bert_similarity from fx_titles t
    left join fx_title_embeddings a on a.title = base_title left join fx_title_embeddings b on b.title = comp_title""")
oracle("tfidf_similarity", ["fx_titles"], f"""
    with pairs as (select distinct base_title, comp_title from fx_titles), {TITLE_DOCS},
    {tfidf_ctes('titles', 'titles', grams('text', english()), 5000)},
    scores as ({pair_scores('pairs', 3)})
    select t.*, tfidf_similarity from fx_titles t join scores using (base_title, comp_title)""")
oracle("tfidf_lemmas", ["fx_titles", "fx_lemmas"], f"""
    with pairs as (select distinct base_title, comp_title from fx_titles), {TITLE_DOCS},
    {tfidf_ctes('titles', 'titles', grams('text', lemmas='fx_lemmas'), 5000)},
    scores as ({pair_scores('pairs', 3)})
    select t.*, tfidf_similarity from fx_titles t join scores using (base_title, comp_title)""")
oracle("training_similarity", [*TRAINING_FIXTURES, "fx_title_embeddings"], f"""
    with training as ({_training()}), pairs as (select distinct base_title, comp_title from training), {TITLE_DOCS},
    {tfidf_ctes('titles', 'titles', grams('text'), 5000)},
    scores as ({pair_scores('pairs', 3)})
    select pair_id, base_title, comp_title, tfidf_similarity, round({DOT.format(a='a.embedding', b='b.embedding')}, 6) as bert_similarity
    from training join scores using (base_title, comp_title)
    left join fx_title_embeddings a on a.title = base_title left join fx_title_embeddings b on b.title = comp_title""")
oracle("vector_dot", ["fx_vectors"], f"""
    select vec_id, other_id, round({DOT.format(a='base_embedding', b='comp_embedding')}, 6) as score from fx_vectors""")


# --- taxonomy ----------------------------------------------------------------

LEVELS = ["category", "subcategory", "sub_subcategory"]
TAX_FIXTURES = ["fx_tax_base", "fx_tax_comp", "fx_tax_embeddings"]
TAX_THRESHOLD = 0.45
NODE = ", ".join(f"base_{level}" for level in LEVELS) + ", retailer, " + ", ".join(f"comp_{level}" for level in LEVELS)
SAME = " and ".join(f"o.{k.strip()} is not distinct from n.{k.strip()}" for k in NODE.split(","))


def _nodes(side: str, source: str) -> str:
    names = ", ".join(f"{level} as {side}_{level}" for level in LEVELS)
    retailer = "retailer, " if side == "comp" else ""
    return f"select distinct {retailer}{names}, concat_ws(' ', {', '.join(LEVELS)}) as {side}_title from {source}"


def _tax_ctes(p: str, base: str, comp: str, fit: str | None = None) -> str:
    """CTEs {p}scored: node pairs at or above the threshold."""
    fitted = fit or f"{p}texts"
    return f"""
    {p}base as ({_nodes('base', base)}), {p}comp as ({_nodes('comp', comp)}),
    {p}texts as (select base_title as key, base_title as text from {p}base union select comp_title, comp_title from {p}comp),
    {p}pairs as (select distinct base_title, comp_title from (select distinct base_title from {p}base) cross join (select distinct comp_title from {p}comp)),
    {tfidf_ctes(f'{p}texts', fitted, grams('text'), 5000, p=p)},
    {p}sparse as ({pair_scores(f'{p}pairs', 4, p)}),
    {p}scores as (select s.*, {DOT.format(a='a.embedding', b='b.embedding')} as bert_similarity from {p}sparse s
      join fx_tax_embeddings a on a.title = base_title join fx_tax_embeddings b on b.title = comp_title),
    {p}scored as (select {NODE}, bert_similarity, tfidf_similarity, round(0.7 * bert_similarity + 0.3 * tfidf_similarity, 4) as combined_score
      from {p}scores join {p}base using (base_title) join {p}comp using (comp_title)
      where round(0.7 * bert_similarity + 0.3 * tfidf_similarity, 4) >= {TAX_THRESHOLD})"""


def _tax_rank(source: str) -> str:
    base = ", ".join(f"base_{level}" for level in LEVELS)
    comp = ", ".join(f"comp_{level} nulls last" for level in LEVELS)
    return f"""select {NODE}, round(bert_similarity, 6) as bert_similarity, tfidf_similarity, combined_score,
      cast(row_number() over (partition by {base}, retailer order by combined_score desc, {comp}) as int) as rank from {source}"""


oracle("taxonomy_full", TAX_FIXTURES, f"with {_tax_ctes('', 'fx_tax_base', 'fx_tax_comp')} {_tax_rank('scored')}")
OLD = """old_base as (select * from fx_tax_base where category <> 'SMALL'), old_comp as (select * from fx_tax_comp where retailer <> 'asia'),
    new_comp as (select * from fx_tax_comp where retailer in ('africa', 'america', 'asia', 'europe'))"""
KEPT = "kept as (select * from p_scored where retailer in ('africa', 'america', 'asia', 'europe'))"
MERGED = f"every as (select * from kept union all by name select * from c_scored n where not exists (select 1 from kept o where {SAME}))"


def _same_levels(left: str, right: str) -> str:
    return " and ".join(f"{left.format(x)} is not distinct from {right.format(x)}" for x in LEVELS)


oracle("taxonomy_previous", TAX_FIXTURES, f"with {OLD}, {_tax_ctes('', 'old_base', 'old_comp')} {_tax_rank('scored')}")
oracle("taxonomy_rescored", TAX_FIXTURES, f"""
    with {OLD}, {_tax_ctes('p_', 'old_base', 'old_comp')}, {KEPT},
    n_base as ({_nodes('base', 'fx_tax_base')}), n_comp as ({_nodes('comp', 'new_comp')}),
    unstored as (select base_title, comp_title from n_base n1 cross join n_comp n2 where not exists (select 1 from kept o where
      {_same_levels('o.base_{}', 'n1.base_{}')} and {_same_levels('o.comp_{}', 'n2.comp_{}')} and o.retailer = n2.retailer)),
    fit as (select base_title as key, base_title as text from unstored union select comp_title, comp_title from unstored),
    {_tax_ctes('c_', 'fx_tax_base', 'new_comp', 'fit')}, {MERGED}
    {_tax_rank('every')}""")
# Pairs of two nodes of the earlier run are settled, stored or not.
oracle("taxonomy_incremental", TAX_FIXTURES, f"""
    with {OLD}, {_tax_ctes('p_', 'old_base', 'old_comp')}, {KEPT},
    n_base as (select *, exists (select 1 from old_base o where {_same_levels('o.{}', 'n.base_{}')}) as known from ({_nodes('base', 'fx_tax_base')}) n),
    n_comp as (select *, exists (select 1 from old_comp o where {_same_levels('o.{}', 'n.comp_{}')} and o.retailer = n.retailer) as known
      from ({_nodes('comp', 'new_comp')}) n),
    open as (select n1.*, n2.* from (select * exclude (known), known as base_known from n_base) n1
      cross join (select * exclude (known), known as comp_known from n_comp) n2 where not (base_known and comp_known)),
    fit as (select base_title as key, base_title as text from open union select comp_title, comp_title from open),
    {_tax_ctes('a_', 'fx_tax_base', 'new_comp', 'fit')},
    c_scored as (select n.* from a_scored n where exists (select 1 from open o where {SAME})), {MERGED}
    {_tax_rank('every')}""")
oracle("taxonomy_base_nodes", ["fx_catalog"], """
    select distinct category, subcategory, sub_subcategory from fx_catalog
    where source = 'acme' and capture_date = (select max(capture_date) from fx_catalog where source = 'acme')""")
oracle("taxonomy_comp_nodes", ["fx_warehouse"], f"""
    select distinct split_part(source_store, '<>', 1) as retailer, category, subcategory, sub_subcategory from fx_warehouse
    where source_store in ({COMP_B})""")


# --- examples and retrieval --------------------------------------------------

EXAMPLE_FIXTURES = ["fx_library_m", "fx_reviews_m", "fx_catalog", "fx_warehouse"]
E_PAIR = "base_sku, base_source_store, comp_sku, comp_source_store"
LABEL_LIST = "'exact_match', 'equivalent_match', 'not_a_match'"
PRODUCT_FIELDS = ["title", "brand", "category", "subcategory", "sub_subcategory"]


def _examples(scope: str, catalog_filter: str, extra: str = "") -> str:
    cat = pick(f"select lower(sku) as k, source_store as s, * from fx_catalog where {catalog_filter}", "k, s",
               "capture_date desc nulls last, product_title, brand, category, subcategory, sub_subcategory, segment")
    pdp = pick("select lower(sku) as k, replace(source_store, '<>', '_') as s, * from fx_warehouse", "k, s",
               "product_segment, product_title, standardized_brand, category, subcategory, sub_subcategory")
    return f"""select d.*, c.product_title as base_title, c.brand as base_brand, c.category as base_category, c.subcategory as base_subcategory,
        c.sub_subcategory as base_sub_subcategory, p.product_title as comp_title, p.standardized_brand as comp_brand, p.category as comp_category,
        p.subcategory as comp_subcategory, p.sub_subcategory as comp_sub_subcategory, c.segment as base_segment
      from (select {E_PAIR}, match as match_norm from fx_library_m where active and deleted_date is null and comp_sku is not null
          and company_code = 'acme' and load_date = (select max(load_date) from fx_library_m where company_code = 'acme') and match in ({LABEL_LIST}) and {scope}
        union select {E_PAIR}, answer from fx_reviews_m where is_active and answer in ({LABEL_LIST}) and {scope}) d
      join ({cat}) c on lower(d.base_sku) = c.k and d.base_source_store = c.s
      join ({pdp}) p on lower(d.comp_sku) = p.k and d.comp_source_store = p.s {extra}"""


OWN = f"select * exclude (base_segment) from ({_examples(chr(39) + 'acme' + chr(39) + ' = split_part(base_source_store, ' + chr(39) + '_' + chr(39) + ', 1)', chr(39) + 'acme' + chr(39) + ' = source')})"
SYNTH = _examples(
    "split_part(comp_source_store, '_', 1) in ('r0', 'r1', 'r2', 'r3')", "true",
    f"""where c.segment = 'pets' and exists (select 1 from fx_warehouse m where m.source_store in ({COMP_B})
      and split_part(m.source_store, '<>', 1) = split_part(d.comp_source_store, '_', 1) and m.category = p.category
      and m.subcategory = p.subcategory and m.sub_subcategory = p.sub_subcategory)""")
EXAMPLE_FIELDS = ", ".join([f"base_{f}" for f in PRODUCT_FIELDS] + [f"comp_{f}" for f in PRODUCT_FIELDS])
ALL_EXAMPLES = "select * exclude (src) from (" + pick(
    f"select *, 1 as src from ({OWN}) union all by name select *, 2 as src from ({SYNTH})",
    E_PAIR, f"src, match_norm, {EXAMPLE_FIELDS}, base_segment") + ")"
oracle("examples_own", EXAMPLE_FIXTURES, f"select * from ({OWN})")
oracle("examples_synth", EXAMPLE_FIXTURES, f"select * from ({SYNTH})")
oracle("examples", EXAMPLE_FIXTURES, ALL_EXAMPLES)
oracle("label_distribution", EXAMPLE_FIXTURES, f"""
    with e as ({ALL_EXAMPLES}), valid as (select unnest([{LABEL_LIST}]) as match_norm)
    select v.match_norm, count(e.base_sku) as count, round(count(e.base_sku) * 100.0 / (select count(*) from e), 1) as percent,
      count(e.base_sku) < 3 as low from valid v left join e using (match_norm) group by 1""")
oracle("brand_counts", EXAMPLE_FIXTURES, f"select coalesce(base_brand, 'unknown') as brand, count(*) as count from ({OWN}) group by 1")
oracle("example_metrics", EXAMPLE_FIXTURES, f"""
    with every as (select 'own_data' as source, base_brand from ({OWN}) union all select 'synth_data', base_brand from ({SYNTH}))
    select source, coalesce(base_brand, 'unknown') as brand, count(*) as count, sum(count(*)) over (partition by source) as total
    from every group by 1, 2""")

WORDS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"


def _topk(docs: str, asked: str, k: int) -> str:
    """Top k documents per question; ``docs`` and ``asked`` give (key, text)."""
    return f"""
    with docs as ({docs}), asked as ({asked}),
    {tfidf_ctes('docs', 'docs', WORDS, 50000, sublinear=True)},
    q_counts as (select key, term, count(*) as tf from (select key, unnest({WORDS}) as term from asked) group by 1, 2),
    q_raw as (select key, term, (ln(tf) + 1) * idf as w from q_counts join vocab using (term)),
    q_unit as (select key, term, w / norm as w from q_raw join (select key, sqrt(sum(w * w)) as norm from q_raw group by 1) using (key)),
    hits as (select q.key as qk, u.key as dk, sum(q.w * u.w) as s from q_unit q join unit u using (term) group by 1, 2),
    grid as (select a.key as query_id, d.key as row_id, round(coalesce(s, 0), 9) as s from asked a cross join docs d left join hits on qk = a.key and dk = d.key)
    select query_id, row_id, round(s, 6) as score, cast(rank as int) as rank from
      (select *, row_number() over (partition by query_id order by s desc, row_id) as rank from grid) where rank <= {k}"""


oracle("retriever_topk", ["fx_docs", "fx_asked"],
       _topk("select row_id as key, q as text from fx_docs", "select query_id as key, q as text from fx_asked", 20))
oracle("retriever_examples", EXAMPLE_FIXTURES, _topk(
    f"""select base_sku || '<>' || base_source_store || '<>' || comp_sku || '<>' || comp_source_store as key,
      concat_ws(' ', coalesce(base_title, ''), coalesce(comp_title, ''), nullif(base_brand, ''), nullif(base_brand, ''), nullif(base_brand, ''),
        nullif(comp_brand, ''), nullif(comp_brand, ''), nullif(comp_brand, ''), nullif(base_category, ''), nullif(base_category, '')) as text
      from ({ALL_EXAMPLES})""",
    """select sku || '@' || source_store || '@' || capture_date as key, product_title || ' ' || standardized_brand as text from fx_warehouse""", 5))


# --- recall and drop events --------------------------------------------------

TIDY = f"select {canonical('base_sku_uuid')} as base_sku_uuid, {canonical('comp_sku_uuid')} as comp_sku_uuid, score, part, file from fx_recall"
oracle("recall_dedupe", ["fx_recall"], f"select distinct * from ({TIDY})")
oracle("recall_dedupe_global", ["fx_recall"], f"select distinct base_sku_uuid, comp_sku_uuid, score from ({TIDY})")
STATS = f"""
    select part, file, count(*) as rows_in, count(distinct (base_sku_uuid, comp_sku_uuid, score)) as rows_out,
      count(*) - count(distinct (base_sku_uuid, comp_sku_uuid, score)) as removed, cast(0 as bigint) as malformed,
      round((count(*) - count(distinct (base_sku_uuid, comp_sku_uuid, score))) * 100.0 / count(*), 1) as percent
    from ({TIDY}) group by 1, 2"""
oracle("recall_stats", ["fx_recall"], f"select * from ({STATS})")
oracle("recall_summary", ["fx_recall"], f"""
    select part, count(*) as files, cast(sum(rows_in) as bigint) as rows_in, cast(sum(rows_out) as bigint) as rows_out,
      cast(sum(removed) as bigint) as removed, cast(sum(malformed) as bigint) as malformed from ({STATS}) group by 1""")


def _drops(runs: bool = False) -> str:
    def part(name: str) -> str:
        return f"nullif(regexp_extract(k, '(?:^|.*/){name}=([^/]+)(?:/|$)', 1), '')"

    names = ["company_code", "product_segment", "load_date"]
    run = "(select count(distinct f.ts) from fx_finished f where f.input_prefix = j.prefix and f.ts <= j.ts)" if runs else "0"
    shown = "" if runs else ", ".join(names) + ","
    values = ", ".join(f"{part(n)} as {n}" for n in names)
    absent = "concat_ws(', ', " + ", ".join(f"case when {n} is null then '{n}' end" for n in names) + ")"
    return f"""
    with decoded as (select event_id, ts, url_decode(key) as k from fx_events),
    parts as (select event_id, ts, k, {values} from decoded),
    judged as (select *, case when not suffix(k, '_SUCCESS') then 'suffix mismatch' when {absent} <> '' then 'missing ' || {absent} end as why,
      's3://inbox/' || regexp_replace(k, '[^/]*$', '') as prefix from parts),
    started as (select *, {run} as run from judged j),
    numbered as (select *, row_number() over (partition by prefix, run, why is null order by ts, event_id nulls last, k) as nth from started)
    select event_id, k as key, {shown}
      case when why is not null then 'ignored' when nth = 1 then 'accepted' else 'skipped' end as action,
      case when why is not null then why when nth > 1 then 'repeated event' end as reason,
      case when why is null then prefix end as input_prefix from numbered"""


oracle("drop_events", ["fx_events"], _drops())
oracle("drop_runs", ["fx_events", "fx_finished"], _drops(runs=True))


# --- keys, text and values ---------------------------------------------------

oracle("store_form", ["fx_pairs"], """
    select distinct comp_source_store as under, replace(comp_source_store, '_', '<>') as bracket, comp_source_store as back,
      split_part(comp_source_store, '_', 1) as retailer from fx_pairs""")
oracle("uuid_canonical", ["fx_recall"], f"select distinct base_sku_uuid, {canonical('base_sku_uuid')} as canonical from fx_recall")
oracle("uuid_parts", ["fx_upc", "fx_recall"], f"""
    select uuid_a as uuid, split_part(uuid_a, '<>', 1) as upc, split_part(uuid_a, '<>', 2) as sku, {store_after_two('uuid_a')} as store from fx_upc
    union select base_sku_uuid, null, {sku_of('base_sku_uuid')}, array_to_string(string_split({canonical('base_sku_uuid')}, '<>')[2:], '<>') from fx_recall""")
oracle("pair_id", ["fx_pairs"], f"""
    select distinct {UUID_BASE} || '<>' || {UUID_COMP} as training_id, {UUID_BASE} as sku_uuid,
      base_sku || '_' || base_source_store || '<>' || comp_sku || '_' || comp_source_store as queue_id,
      base_sku || '<>' || replace(comp_source_store, '_', '<>') as request_key
    from fx_pairs""")
oracle("strip_zeros", ["fx_catalog"], "select sku, capture_date, ltrim(split_part(upc, ',', 1), '0') as upc from fx_catalog")
oracle("blank_to_null", ["fx_catalog"], """
    select sku, capture_date, nullif(trim(product_title), '') as title, trim(coalesce(product_title, '')) <> '' as filled,
      coalesce(nullif(product_title, ''), brand) as shown from fx_catalog""")
oracle("price_gate", ["fx_pairs", "fx_catalog", "fx_warehouse"], f"""
    with q as (select distinct base_sku, comp_sku from fx_pairs),
    b as ({newest('lower(sku) as base_sku, list_price as bp', 'fx_catalog')}),
    c as ({newest('lower(sku) as comp_sku, list_price as cp', 'fx_warehouse')})
    select base_sku, comp_sku, {price('bp')} as base_number, coalesce({price('bp')} > 0 and abs({price('bp')} - cp) / {price('bp')} < 0.8, false) as near
    from q join b using (base_sku) join c using (comp_sku)""")
oracle("upc_overlap", ["fx_pairs", "fx_catalog", "fx_crawl"], f"""
    with q as (select distinct base_sku, comp_sku from fx_pairs),
    b as ({newest('lower(sku) as base_sku, upc as base_upc', 'fx_catalog')}),
    c as (select distinct comp_sku, dc_upc from ({SIGNALS['crawl']}))
    select base_sku, comp_sku, dc_upc, coalesce({strip('base_upc')} = {strip('dc_upc')}, false) as overlap from q join b using (base_sku) join c using (comp_sku)""")
oracle("queue_keys", ["fx_pairs", "fx_input_precision"], f"""
    with q as (select distinct base_sku, base_source_store as bs, comp_sku, comp_source_store as cs from fx_pairs),
    m as ({newest('sku as base_sku, match_sku as m', 'fx_input_precision')})
    select base_sku, comp_sku, coalesce(nullif(m, ''), base_sku) as match_sku,
      coalesce(nullif(m, ''), base_sku) || '_' || bs || '_' || cs as match_sku_base_source_store_comp_source_store,
      bs || '_' || comp_sku || '_' || cs as base_source_store_comp_sku_comp_source_store,
      comp_sku || '_' || cs || '_' || bs as comp_sku_comp_source_store_base_source_store,
      cs || '_' || base_sku || '_' || bs as comp_source_store_match_sku_base_source_store
    from q left join m using (base_sku)""")
oracle("taxonomy_text", ["fx_tax_base"], "select *, concat_ws(' ', category, subcategory, sub_subcategory) as text from fx_tax_base")
oracle("weighted_text", ["fx_catalog"], """
    select sku, capture_date, product_title || ' ' || product_description || ' ' || brand || ' ' || brand || ' ' || brand || ' ' || category || ' ' || category as text
    from fx_catalog""")
LETTERS = f"list_filter(string_split(trim(regexp_replace(lower(q), '[^a-z]+', ' ', 'g')), ' '), lambda w: w <> '' and w not in ({STOP}))"
oracle("clean_tokens", ["fx_docs"], f"select row_id, {LETTERS} as letters, {WORDS.replace('text', 'q')} as words from fx_docs")
oracle("ngrams", ["fx_docs"], f"""
    select row_id, list_concat(w, [w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) as grams from (select row_id, {LETTERS} as w from fx_docs)""")
oracle("vocabulary", ["fx_docs"], f"""
    select term, cast(row_number() over (order by term) as int) as term_id, round(ln((1 + (select count(*) from fx_docs)) / (1 + df)) + 1, 6) as idf
    from (select term, count(*) as tf, count(distinct row_id) as df from (select row_id, unnest({WORDS.replace('text', 'q')}) as term from fx_docs)
      group by 1 order by tf desc, term limit 5000)""")
oracle("epoch_dates", ["fx_reviews"], """
    select distinct inserted_date as day, cast(epoch(cast(inserted_date as timestamp)) as int) as match_date,
      cast(epoch(cast(inserted_date as timestamp) + interval 21 day) as int) as expiration_date, true as iso from fx_reviews""")
oracle("store_override", ["fx_crawl"], """
    select distinct source_name, store_name, case source_name when 'r1' then 'main_main' when 'r9' then 'x_x'
      else lower(source_name || '_' || store_name) end as store from fx_crawl""")
oracle("enqueue_index", ["fx_pairs"], """
    select distinct pair_id, cast(cast('0x' || substr(md5(pair_id), 1, 8) as bigint) % 90000 + 10000 as int) as at
    from (select base_sku || '_' || base_source_store || '<>' || comp_sku || '_' || comp_source_store as pair_id from fx_pairs)""")
oracle("json_field", [], "select event_id, json_extract_string(props, '$.k') as k from events")


# --- row picking, snapshots and joins ----------------------------------------

oracle("latest_per_key", ["fx_catalog"], pick(
    "select sku, source_store, capture_date, product_description from fx_catalog", "sku, source_store",
    "capture_date desc nulls last, product_description"))
oracle("first_by_segment", ["fx_warehouse"], pick(
    "select sku, source_store, product_segment, product_title from fx_warehouse", "sku, source_store", "product_segment, product_title"))
LABELLED = f"""
    select {UUID_BASE} || '<>' || {UUID_COMP} as pair_id, 1 as source_priority, match as answer from fx_library
    where active and deleted_date is null and company_code = 'acme' and load_date = '1998-01-01' and match in ('exact', 'equivalent')
    union all select {UUID_BASE} || '<>' || {UUID_COMP}, 2, answer from fx_reviews where year || month >= '199401' and base_source_store = 'acme_acme'"""
oracle("priority_dedupe", ["fx_library", "fx_reviews"], pick(LABELLED, "pair_id", "source_priority, answer"))
oracle("best_per_base", ["fx_drop"], pick(
    "select * from fx_drop", "base_sku", "try_cast(score as double) desc nulls last, comp_source_store, comp_sku, score, match"))
oracle("dedupe_pairs", ["fx_pairs"], pick("select * from fx_pairs", "base_sku, comp_sku, base_source_store, comp_source_store", "score"))
oracle("latest_snapshot", ["fx_library"], """
    select base_sku, comp_sku, load_date, match from fx_library where active and deleted_date is null
      and load_date = (select max(load_date) from fx_library where company_code = 'acme')""")
oracle("latest_composite", ["fx_input_precision"], """
    select sku, source_store, year, month, day from fx_input_precision where year || month || day =
      (select max(year || month || day) from fx_input_precision where segment = 'pets')""")
oracle("latest_value", ["fx_library"], "select max(load_date) as load_date from fx_library")
oracle("stores_in_scope", ["fx_pairs", "fx_domains"], """
    select distinct primary_store as comp_source_store from fx_domains where primary_store in (select comp_source_store from fx_pairs)""")
oracle("anti_store", ["fx_pairs", "fx_library"], """
    select * from fx_pairs p where not exists (select 1 from fx_library l where l.base_sku = p.base_sku and l.comp_source_store = p.comp_source_store
      and active and deleted_date is null and load_date = (select max(load_date) from fx_library))""")
oracle("anti_pair", ["fx_pairs", "fx_library"], """
    select * from fx_pairs p where not exists (select 1 from fx_library l where l.base_sku = p.base_sku and l.comp_sku = p.comp_sku
      and l.comp_source_store = p.comp_source_store)""")
oracle("anti_pair_id", ["fx_library", "fx_reviews"], f"""
    with l as ({LABELLED}) select pair_id, answer from l
    where source_priority = 2 and not exists (select 1 from l known where known.source_priority = 1 and known.pair_id = l.pair_id)""")
oracle("semi_keys", ["fx_catalog", "fx_library"], "select sku, capture_date from fx_catalog where sku in (select base_sku from fx_library)")
oracle("anti_null_safe", ["fx_tax_base"], "select * from fx_tax_base where category <> 'SMALL'")
oracle("bridge_join", ["fx_pairs", "fx_warehouse"], """
    select q.*, w.product_title from (select distinct comp_sku, comp_source_store from fx_pairs) q
    left join fx_warehouse w on lower(w.sku) = q.comp_sku and replace(w.source_store, '<>', '_') = q.comp_source_store""")
oracle("zero_join", ["fx_drop", "fx_catalog"], f"""
    select q.base_sku, c.product_title from (select distinct base_sku from fx_drop) q
    join ({newest('sku, product_title', 'fx_catalog')}) c on ltrim(lower(q.base_sku), '0') = ltrim(lower(c.sku), '0')""")
oracle("fallback_join", ["fx_pairs", "fx_input_precision", "fx_catalog"], f"""
    with q as (select distinct base_sku from fx_pairs),
    own as ({newest('sku as base_sku, product_title as own', 'fx_input_precision')}),
    spare as ({pick("select lower(sku) as base_sku, product_title as spare, capture_date from fx_catalog", "base_sku", "capture_date desc, spare")})
    select base_sku, coalesce(nullif(own, ''), spare) as title from q left join own using (base_sku) left join spare using (base_sku)""")
