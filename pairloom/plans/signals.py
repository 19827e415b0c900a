"""Signals: what each upstream source knows about a pair or product.

Each function returns the rows of one source under the join keys the coverage
report uses. With ``strict=False`` every key is lower-cased and product ids are
brought to canonical form first; ``strict=True`` keeps the uneven treatment of
the original queries, where some keys keep their case, the SKU is always the
first part of an id, and each model score is a row of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import keys as K
from ..functions import values as V
from ..operators import relational as R
from ..operators import skew

def _day() -> Column:
    return V.composite_date(F.col("year"), F.col("month"), F.col("day"))


def _case(strict: bool) -> Callable[[Column], Column]:
    return (lambda c: c) if strict else F.lower


def _store(name: str, strict: bool) -> Column:
    return _case(strict)(K.store_underscore(F.col(name)))


def folded(pairs: DataFrame, strict: bool = False) -> DataFrame:
    fold = _case(strict)
    return pairs.select(
        F.lower("base_sku").alias("base_sku"),
        F.lower("comp_sku").alias("comp_sku"),
        fold(F.col("comp_source_store")).alias("comp_source_store"),
        fold(F.col("base_source_store")).alias("base_source_store"),
    )


def spine(pairs: DataFrame, strict: bool = False) -> DataFrame:
    """Distinct pairs with folded keys, the grain of the report."""
    return (
        folded(pairs, strict)
        .groupBy("base_sku", "comp_sku", "comp_source_store")
        .agg(F.min("base_source_store").alias("base_source_store"))
    )


# Columns that a catalog product gives to the report.
CATALOG_FIELDS = ["base_title", "upc", "segment", "base_mpn"]


def catalog_rows(catalog: DataFrame, tenant: str) -> DataFrame:
    """The tenant's products of every snapshot: base_sku, the report's fields, ``_version`` and ``_live``."""
    return catalog.where(F.col("source") == tenant).select(
        F.lower("sku").alias("base_sku"),
        F.col("product_title").alias("base_title"),
        "upc",
        "segment",
        F.col("manufacturer_part_number").alias("base_mpn"),
        F.col("capture_date").alias("_version"),
        ((F.col("is_active") == "True") & (F.col("is_discontinued") == "False")).alias("_live"),
    )


def catalog_products(catalog: DataFrame, tenant: str) -> DataFrame:
    """Active products of the tenant's newest catalog snapshot."""
    current = R.latest_snapshot(catalog_rows(catalog, tenant), "_version")
    return current.where("_live").drop("_version", "_live")


def catalog_signal(spine_rows: DataFrame, catalog: DataFrame, tenant: str, hot: skew.HotKeys | None = None) -> DataFrame:
    """Is the base SKU in the catalog, and under which title and UPC?"""
    products = catalog_products(catalog, tenant)
    hot = hot or skew.hot_keys(spine_rows, ["base_sku"])
    return skew.attach_first(spine_rows, products, ["base_sku"], hot).withColumn(
        "base_sku_in_catalog", V.present(F.col("base_title"))
    )


def crawl_rows(crawl: DataFrame, competitors: Sequence[str], years: Sequence[str]) -> DataFrame:
    """Crawled products with the date in ``comp_sku_first_date``; only the columns named here are read."""
    return crawl.where(F.col("year").isin(list(years)) & F.col("source_name").isin(list(competitors))).select(
        F.lower("sku").alias("comp_sku"),
        F.lower(F.concat_ws("_", "source_name", "store_name")).alias("comp_source_store"),
        F.lower("upc").alias("dc_upc"),
        F.col("capture_date").alias("comp_sku_first_date"),
    )


def crawl_signal(crawl: DataFrame, competitors: Sequence[str], years: Sequence[str]) -> DataFrame:
    """First crawl date per SKU, UPC and store."""
    rows = crawl_rows(crawl, competitors, years)
    return rows.groupBy("comp_sku", "comp_source_store", "dc_upc").agg(F.min("comp_sku_first_date").alias("comp_sku_first_date"))


def crawl_years(run_date: str, override: Sequence[str] | None = None) -> list[str]:
    """Given years, else the run year and the two before it."""
    if override:
        return [y.strip() for y in override if y.strip()]
    newest = int(run_date[:4])
    return [str(newest - back) for back in range(3)]


def warehouse_rows(
    warehouse: DataFrame, competitors: Sequence[str], segment: str, strict: bool = False
) -> DataFrame:
    return warehouse.where(
        F.col("source_store").isin(K.store_names(list(competitors), K.BRACKET))
        & (F.col("product_segment") == segment)
    ).select(
        F.lower("sku").alias("comp_sku"),
        _store("source_store", strict).alias("comp_source_store"),
        F.col("product_title").alias("comp_title"),
        F.col("product_url").alias("comp_url"),
        F.lower("upc").alias("pdp_upc"),
        F.col("manufacturer_part_number").alias("pdp_mpn"),
        _day().alias("pdp_date"),
    )


def warehouse_signal(
    warehouse: DataFrame, competitors: Sequence[str], segment: str, strict: bool = False
) -> DataFrame:
    return warehouse_rows(warehouse, competitors, segment, strict).distinct()


def review_signal(
    reviews: DataFrame, tenant: str, competitors: Sequence[str], segment: str, strict: bool = False
) -> DataFrame:
    """Answers given by reviewers with the queues each one came from."""
    return (
        reviews.where(
            (F.col("base_source_store") == K.store_name(tenant))
            & F.col("comp_source_store").isin(K.store_names(list(competitors)))
            & (F.col("segment") == segment)
        )
        .groupBy(
            F.lower("base_sku").alias("base_sku"),
            F.lower("comp_sku").alias("comp_sku"),
            _store("comp_source_store", strict).alias("comp_source_store"),
            "score", "match_date", "inserted_date", "answer",
        )
        .agg(F.array_sort(F.collect_set("queue_name")).alias("fl_queue_name"))
    )


def upc_rows(
    matches: DataFrame, tenant: str, competitors: Sequence[str], segment: str, strict: bool = False
) -> DataFrame:
    """UPC suggestions, each with its date in ``csf_upc_first_sugg_date``."""
    base, comp = F.col("uuid_a"), F.col("uuid_b")
    fold = _case(strict)
    return matches.where(
        (K.prefixed_store(base) == K.store_name(tenant, K.BRACKET))
        & K.prefixed_store(comp).isin(K.store_names(list(competitors), K.BRACKET))
        & (F.col("segment") == segment)
    ).select(
        F.lower(K.prefixed_sku(base)).alias("base_sku"),
        F.lower(K.prefixed_sku(comp)).alias("comp_sku"),
        fold(K.store_underscore(K.prefixed_store(comp))).alias("comp_source_store"),
        K.prefixed_upc(base).alias("csf_base_upc"),
        K.prefixed_upc(comp).alias("csf_comp_upc"),
        F.col("score").alias("csf_upc_score"),
        _day().alias("csf_upc_first_sugg_date"),
    )


def upc_signal(
    matches: DataFrame, tenant: str, competitors: Sequence[str], segment: str, strict: bool = False
) -> DataFrame:
    """UPC suggestions with the date each was first made."""
    rows = upc_rows(matches, tenant, competitors, segment, strict)
    keys = [c for c in rows.columns if c != "csf_upc_first_sugg_date"]
    return rows.groupBy(*keys).agg(F.min("csf_upc_first_sugg_date").alias("csf_upc_first_sugg_date"))


def _between(tenant: str, competitors: Sequence[str], segment: str) -> Column:
    return (
        (F.col("base_source_store") == K.store_name(tenant, K.BRACKET))
        & F.col("comp_source_store").isin(K.store_names(list(competitors), K.BRACKET))
        & (F.col("segment") == segment)
    )


def mpn_rows(
    matches: DataFrame, tenant: str, competitors: Sequence[str], segment: str, strict: bool = False
) -> DataFrame:
    """Part-number suggestions; ``strict`` reads part 1 of one id and part 2 of the other."""
    base = K.uuid_sku(F.col("uuid_a"), canonical=not strict)
    comp = K.prefixed_sku(F.col("uuid_b")) if strict else K.uuid_sku(F.col("uuid_b"))
    return matches.where(_between(tenant, competitors, segment)).select(
        F.lower(base).alias("base_sku"),
        F.lower(comp).alias("comp_sku"),
        _store("comp_source_store", strict).alias("comp_source_store"),
        F.col("score").alias("csf_mpn_score"),
        _day().alias("csf_mpn_first_sugg_date"),
    )


def mpn_signal(
    matches: DataFrame, tenant: str, competitors: Sequence[str], segment: str, strict: bool = False
) -> DataFrame:
    """Part-number suggestions with the date each was first made."""
    rows = mpn_rows(matches, tenant, competitors, segment, strict)
    keys = [c for c in rows.columns if c != "csf_mpn_first_sugg_date"]
    return rows.groupBy(*keys).agg(F.min("csf_mpn_first_sugg_date").alias("csf_mpn_first_sugg_date"))


def library_rows(
    library: DataFrame, tenant: str, competitors: Sequence[str], strict: bool = False
) -> DataFrame:
    """The tenant's live entries of every snapshot, with ``_in`` for those of the competitors."""
    own = R.live(library).where(F.col("base_source_store") == K.store_name(tenant))
    fold = _case(strict)
    return own.select(
        F.lower("base_sku").alias("base_sku"),
        fold(F.col("comp_sku")).alias("comp_sku"),
        fold(F.col("comp_source_store")).alias("comp_source_store"),
        "matcher_comments",
        F.col("deleted_date").isNull().alias("is_present_in_match_library"),
        F.col("deleted_date").isNotNull().alias("is_deleted_in_match_library"),
        F.col("deleted_date").alias("last_deleted_date"),
        F.col("load_date").alias("match_library_inserted_date"),
        F.col("load_date").alias("_version"),
        F.col("comp_source_store").isin(K.store_names(list(competitors))).alias("_in"),
    )


def library_signal(
    library: DataFrame, tenant: str, competitors: Sequence[str], load_date: str | None = None,
    strict: bool = False,
) -> DataFrame:
    """Live library entries of the newest snapshot in which the tenant has any."""
    own = R.live(library).where(F.col("base_source_store") == K.store_name(tenant))
    current = R.latest_snapshot(own, "load_date", override=load_date)
    fold = _case(strict)
    return (
        current.where(F.col("comp_source_store").isin(K.store_names(list(competitors))))
        .groupBy(
            F.lower("base_sku").alias("base_sku"),
            fold(F.col("comp_sku")).alias("comp_sku"),
            fold(F.col("comp_source_store")).alias("comp_source_store"),
            "base_upc", "comp_upc", "match_date", "matcher_comments",
        )
        .agg(
            F.bool_or(F.col("deleted_date").isNull()).alias("is_present_in_match_library"),
            F.bool_or(F.col("deleted_date").isNotNull()).alias("is_deleted_in_match_library"),
            F.max("deleted_date").alias("last_deleted_date"),
            F.min("load_date").alias("match_library_inserted_date"),
        )
    )


def input_rows(table: DataFrame, tenant: str, competitors: Sequence[str], segment: str, strict: bool = False) -> DataFrame:
    """Products of every partition of a model input, with ``_version`` and ``_in`` for those of the segment."""
    return table.where(F.col("source_store").isin(K.store_names([*competitors, tenant]))).select(
        F.lower("sku").alias("sku"),
        _case(strict)(F.col("source_store")).alias("source_store"),
        F.col("product_title").alias("title"),
        F.col("capture_date"),
        F.col("upc"),
        F.concat("year", "month", "day").alias("_version"),
        (F.col("segment") == segment).alias("_in"),
    )


def input_signal(
    precision: DataFrame, generic: DataFrame, tenant: str, competitors: Sequence[str], segment: str,
    strict: bool = False,
) -> DataFrame:
    """Products in the newest model input of either model."""
    def newest(table: DataFrame) -> DataFrame:
        rows = input_rows(table, tenant, competitors, segment, strict)
        return R.latest_snapshot(rows, "_version").where("_in").drop("_version", "_in")

    return newest(precision).unionByName(newest(generic)).distinct()


def model_rows(
    pairs: DataFrame, tenant: str, competitors: Sequence[str], segment: str, strict: bool = False
) -> DataFrame:
    """Suggestions of one model with their score and date."""
    fold = _case(strict)
    return pairs.where(_between(tenant, competitors, segment)).select(
        fold(K.uuid_sku(F.col("base_sku_uuid"), canonical=not strict)).alias("base_sku"),
        fold(K.uuid_sku(F.col("comp_sku_uuid"), canonical=not strict)).alias("comp_sku"),
        _store("comp_source_store", strict).alias("comp_source_store"),
        F.col("score").alias("model_score"),
        _day().alias("first_sugg_date"),
    )


def model_signal(
    pairs: DataFrame, tenant: str, competitors: Sequence[str], segment: str, strict: bool = False
) -> DataFrame:
    """Suggestions of one model: best score and first date per pair.

    The same function serves the precision, generic and semantic tables.
    ``strict`` groups by score, so a pair appears once per score.
    """
    rows = model_rows(pairs, tenant, competitors, segment, strict).withColumn("_score", F.col("model_score"))
    keys = ["base_sku", "comp_sku", "comp_source_store", *(["_score"] if strict else [])]
    return rows.groupBy(*keys).agg(
        F.max("model_score").alias("model_score"), F.min("first_sugg_date").alias("first_sugg_date")
    ).drop("_score")


def queue_signal(queue: DataFrame, tenant: str, segment: str, strict: bool = False) -> DataFrame:
    fold = _case(strict)
    return (
        queue.where((F.col("tenant") == tenant) & (F.col("segment") == segment))
        .groupBy(
            F.lower("base_sku").alias("base_sku"),
            F.lower("comp_sku").alias("comp_sku"),
            fold(F.col("comp_source_store")).alias("comp_source_store"),
        )
        .agg(
            F.max("aggregated_score").alias("csf_queue_score"),
            F.min(_day()).alias("csf_queue_date"),
            F.array_sort(F.collect_set("queue_name")).alias("csf_queue_name"),
        )
    )


def request_signal(
    requests: DataFrame, tenant: str, competitors: Sequence[str], segment: str, strict: bool = False
) -> DataFrame:
    fold = _case(strict)
    return requests.where(
        (F.col("company_code") == tenant)
        & F.col("comp_source_store").isin(K.store_names(list(competitors)))
        & (F.col("product_segment") == segment)
    ).select(
        fold(F.col("base_sku")).alias("base_sku"),
        fold(F.col("comp_source_store")).alias("comp_source_store"),
        K.request_key(F.col("base_sku"), F.col("comp_source_store")).alias("afm_request_key"),
        F.col("search_type").alias("afm_search_type"),
        F.col("search_key_type").alias("afm_search_key_type"),
        F.col("search_key").alias("afm_search_key"),
    )
