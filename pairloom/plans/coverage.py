"""Coverage report: for every input pair, which upstream source knew it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import keys as K
from ..functions import text as X
from ..functions import values as V
from ..operators import skew
from ..operators.fold import Source, fold, newest_row, taken
from ..session import Workspace
from . import signals as S

PAIR = ["base_sku", "comp_sku", "comp_source_store"]
PRODUCT = ["comp_sku", "comp_source_store"]

# The report's columns in order.
COVERAGE_COLUMNS = [
    "base_sku", "base_sku_in_catalog", "upc", "base_title", "comp_sku", "comp_source_store",
    "base_source_store", "segment", "base_mpn",
    "sku_in_dc", "comp_sku_first_date", "dc_upc", "upc_in_dc",
    "sku_in_pdp", "pdp_date", "pdp_upc", "pdp_mpn", "upc_in_pdp",
    "is_fl_attempted", "inserted_date", "answer", "fl_queue_name",
    "comp_title",
    "is_present_in_match_library", "is_deleted_in_match_library", "last_deleted_date",
    "match_library_inserted_date", "matcher_comments",
    "normalized_base_upc", "normalized_dc_upc", "normalized_pdp_upc", "has_upc_overlap",
    "is_suggested_by_csf_upc", "csf_upc_score", "csf_upc_first_sugg_date", "csf_base_upc", "csf_comp_upc",
    "is_suggested_by_csf_mpn", "csf_mpn_score", "csf_mpn_first_sugg_date",
    "is_suggested_by_csf_precision", "csf_precision_score", "csf_precision_first_sugg_date",
    "is_suggested_by_csf_generic", "csf_generic_score", "csf_generic_first_sugg_date",
    "is_suggested_by_semantic", "csf_semantic_score", "csf_semantic_first_sugg_date",
    "is_pair_in_csf_queue", "csf_queue_score", "csf_queue_date", "csf_queue_name",
    "base_sku_is_present_in_csf_ml_input", "base_title_csf_ml_input", "base_capture_date_csf",
    "comp_sku_is_present_in_csf_ml_input", "comp_title_csf_ml_input", "comp_capture_date_csf",
    "has_afm_request", "afm_search_type", "afm_search_key_type",
]


@dataclass(frozen=True)
class CoverageSources:
    """The upstream tables, one frame each."""

    catalog: DataFrame
    crawl: DataFrame
    warehouse: DataFrame
    reviews: DataFrame
    library: DataFrame
    upc_matches: DataFrame
    mpn_matches: DataFrame
    precision_input: DataFrame
    generic_input: DataFrame
    precision_pairs: DataFrame
    generic_pairs: DataFrame
    semantic_pairs: DataFrame
    queue: DataFrame
    requests: DataFrame


def coverage_report(
    pairs: DataFrame, sources: CoverageSources, tenant: str, segment: str, competitors: Sequence[str],
    run_date: str, years: Sequence[str] | None = None, load_date: str | None = None,
    strict: bool = False, hot_parts: int | None = None,
) -> DataFrame:
    """One row per (base_sku, comp_sku, comp_source_store) with 62 columns.

    The sources are read once each and folded under three sets of keys: pairs
    (together with the spine), products of a store, and base products. A fold is
    one shuffle, cut to one row per key and task before it. The spine is then
    joined once to the products and once to the base products, where a product
    that occurs in a large share of the pairs is spread over many tasks.
    """
    s, names, tables = sources, list(competitors), Workspace(pairs.sparkSession, "coverage")
    by_pair = [
        Source("spine", S.folded(pairs, strict).withColumn("_present", F.lit(True)), null_keys=True,
               totals={"_present": (F.max, "_present"), "base_source_store": (F.min, "base_source_store")}),
        *_pair_sources(s, tenant, segment, names, load_date, strict),
    ]
    known = tables.save(fold(PAIR, by_pair))
    rows = known.where("_present").select(*PAIR, *[c.alias(n) for x in by_pair for n, c in taken(known, x).items()])
    products = _products(s, tenant, segment, names, S.crawl_years(run_date, years), strict, tables)
    catalog = Source("catalog", S.catalog_rows(s.catalog, tenant), S.CATALOG_FIELDS, version=F.col("_version"), when=F.col("_live"))
    base = _base_products(products, catalog, tables)

    hot_base, hot_comp = skew.hot_key_sets(rows, [["base_sku"], PRODUCT], hot_parts)
    sold = products.select(
        F.col("sku").alias("comp_sku"), F.col("source_store").alias("comp_source_store"), "crawl", "warehouse", "input"
    )
    rows = skew.join_spread(rows, sold, PRODUCT, "left", hot_comp, PAIR).withColumnRenamed("input", "comp_input")
    rows = skew.join_spread(rows, base, ["base_sku"], "left", hot_base, PAIR)

    def of_store(store: str, what: str) -> Column:
        return F.try_element_at("stores", F.col(store))[what]

    rows = rows.withColumns({"base_input": of_store("base_source_store", "input"), "request": of_store("comp_source_store", "request")})
    return _finish(rows.withColumns({
        "dc_upc": F.col("crawl.dc_upc"), "comp_sku_first_date": F.col("crawl.comp_sku_first_date"), "sku_in_dc": F.col("crawl").isNotNull(),
        **{c: F.col(f"warehouse.{c}") for c in WAREHOUSE_FIELDS}, "sku_in_pdp": F.col("warehouse").isNotNull(),
        **{c: F.col(f"request.{c}") for c in REQUEST_FIELDS},
        **{f"{side}_{name}": F.col(f"{side}_input.{c}") for side in ("base", "comp")
           for name, c in (("title_csf_ml_input", "title"), ("capture_date_csf", "capture_date"))},
        **{f"{side}_sku_is_present_in_csf_ml_input": F.col(f"{side}_input").isNotNull() for side in ("base", "comp")},
    }))


STORED = ["sku", "source_store"]
WAREHOUSE_FIELDS = ["comp_title", "pdp_upc", "pdp_mpn", "pdp_date"]
REQUEST_FIELDS = ["afm_request_key", "afm_search_type", "afm_search_key_type", "afm_search_key"]
MODELS = ["generic", "semantic", "precision"]


def _pair_sources(
    s: CoverageSources, tenant: str, segment: str, names: list[str], load_date: str | None, strict: bool
) -> list[Source]:
    """The sources that know pairs."""
    library = S.library_rows(s.library, tenant, names, strict)
    if load_date is not None:
        library = library.where(F.col("_version") == load_date)
    entry = ["matcher_comments", "is_present_in_match_library", "is_deleted_in_match_library", "last_deleted_date", "match_library_inserted_date"]
    found = [
        Source("review", S.review_signal(s.reviews, tenant, names, segment, strict), ["inserted_date", "answer", "fl_queue_name"]),
        Source("library", library, entry, version=F.col("_version"), when=F.col("_in")),
        Source("queue", S.queue_signal(s.queue, tenant, segment, strict), ["csf_queue_score", "csf_queue_date", "csf_queue_name"]),
        Source("upc", S.upc_rows(s.upc_matches, tenant, names, segment, strict),
               ["csf_base_upc", "csf_comp_upc", "csf_upc_score", "csf_upc_first_sugg_date"]),
        Source("mpn", S.mpn_rows(s.mpn_matches, tenant, names, segment, strict), ["csf_mpn_score", "csf_mpn_first_sugg_date"]),
    ]
    for label in MODELS:
        score, day = f"csf_{label}_score", f"csf_{label}_first_sugg_date"
        rows = S.model_rows(getattr(s, f"{label}_pairs"), tenant, names, segment, strict)
        rows = rows.withColumnsRenamed({"model_score": score, "first_sugg_date": day})
        if strict:
            # The first day on which the best score was given.
            found.append(Source(label, rows, [score, day], order=[F.col(score).isNull(), -F.col(score)]))
        else:
            found.append(Source(label, rows, totals={score: (F.max, score), day: (F.min, day)}))
    return found


def _products(
    s: CoverageSources, tenant: str, segment: str, names: list[str], years: list[str], strict: bool, tables: Workspace
) -> DataFrame:
    """Per sku and source_store what the crawl, the warehouse, the newest model inputs and the requests say, as structs."""
    def stored(rows: DataFrame, sku: str, store: str) -> DataFrame:
        return rows.withColumnsRenamed({sku: "sku", store: "source_store"})

    inputs = [
        Source(name, S.input_rows(table, tenant, names, segment, strict), ["title", "capture_date"], version=F.col("_version"), when=F.col("_in"))
        for name, table in (("precision", s.precision_input), ("generic", s.generic_input))
    ]
    every = [
        Source("crawl", stored(S.crawl_rows(s.crawl, names, years), *PRODUCT), ["dc_upc", "comp_sku_first_date"]),
        Source("warehouse", stored(S.warehouse_rows(s.warehouse, names, segment, strict), *PRODUCT), WAREHOUSE_FIELDS),
        Source("request", stored(S.request_signal(s.requests, tenant, names, segment, strict), "base_sku", "comp_source_store"), REQUEST_FIELDS),
        *inputs,
    ]
    known = tables.save(fold(STORED, every))

    def fields(source: Source) -> Column:
        """The product in the newest input of one model, whatever its version, in an order in which nulls come last."""
        row = newest_row(known, source)
        pairs = F.struct(*[f for c in source.take for f in (row[c].isNull().alias(f"_no_{c}"), row[c].alias(c))])
        return F.when(row.isNotNull(), pairs)

    return known.select(
        *STORED, F.col("_crawl").alias("crawl"), F.col("_warehouse").alias("warehouse"), F.col("_request").alias("request"),
        F.least(*[fields(i) for i in inputs]).alias("input"),
    )


def _base_products(products: DataFrame, catalog: Source, tables: Workspace) -> DataFrame:
    """Per base_sku its catalog fields, and in the map ``stores`` its model input and request by store (of which there are few)."""
    entry = F.struct("source_store", F.struct("input", "request").alias("_said")).alias("_entry")
    listed = products.where(F.col("input").isNotNull() | F.col("request").isNotNull()).select(F.col("sku").alias("base_sku"), entry)
    known = tables.save(fold(["base_sku"], [catalog, Source("stores", listed, totals={"stores": (F.collect_list, "_entry")})]))
    stores = F.map_from_entries("stores").alias("stores")
    return known.select("base_sku", stores, *[c.alias(n) for n, c in taken(known, catalog).items()])


def _finish(rows: DataFrame) -> DataFrame:
    found = {
        "base_sku_in_catalog": "base_title",
        "upc_in_dc": "dc_upc",
        "upc_in_pdp": "pdp_upc",
        "is_fl_attempted": "inserted_date",
        "is_suggested_by_csf_upc": "csf_upc_score",
        "is_suggested_by_csf_mpn": "csf_mpn_score",
        "is_suggested_by_csf_precision": "csf_precision_score",
        "is_suggested_by_csf_generic": "csf_generic_score",
        "is_suggested_by_semantic": "csf_semantic_score",
        "is_pair_in_csf_queue": "csf_queue_score",
        "has_afm_request": "afm_request_key",
    }
    marks = [
        "sku_in_dc", "sku_in_pdp", "is_present_in_match_library",
        "base_sku_is_present_in_csf_ml_input", "comp_sku_is_present_in_csf_ml_input",
    ]
    upcs = {"base": "upc", "dc": "dc_upc", "pdp": "pdp_upc"}
    return rows.withColumns(
        {flag: V.present(F.col(source)) for flag, source in found.items()}
        | {mark: V.truthy(F.col(mark)) for mark in marks}
        | {f"normalized_{name}_upc": K.strip_zeros(F.col(source)) for name, source in upcs.items()}
        | {"has_upc_overlap": X.upc_overlap(*[F.col(source) for source in upcs.values()])}
    ).select(*COVERAGE_COLUMNS)
