"""Auto approval: enrich decided pairs, apply the heuristics, keep the best per base SKU."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import keys as K
from ..functions import values as V
from ..functions.text import first_of_list, not_blank
from ..operators import relational as R
from ..operators import skew

# The columns the promotion step reads, in order.
APPROVAL_COLUMNS = [
    "base_source_store", "base_parent_sku", "base_sku", "base_upc",
    "base_custom_attributes", "match", "match_reason",
    "comp_source_store", "comp_sku", "comp_upc", "comp_parent_sku", "comp_custom_sku",
    "comp_url", "comp_img", "comp_brand",
    "base_title", "comp_title", "comp_description",
    "comp_category", "comp_subcategory", "comp_sub_subcategory",
    "comp_size", "comp_uom", "comp_pack_size", "comp_total_size", "comp_custom_attributes",
    "base_price", "comp_price", "comp_alt_size", "comp_alt_uom", "comp_alt_price",
    "comp_dimension", "comp_shipping_weight", "comp_mfr_part_number",
    "model_used", "score",
]
REQUIRED_COLUMNS = ["base_sku", "comp_sku", "comp_source_store"]
EMPTY_COLUMNS = [
    "base_custom_attributes", "match_reason", "comp_total_size", "comp_custom_attributes", "comp_alt_price",
]
# Report column -> warehouse column.
COMP_FIELDS = {
    "comp_category": "category", "comp_subcategory": "subcategory", "comp_sub_subcategory": "sub_subcategory",
    "comp_title": "product_title", "comp_description": "product_description", "comp_url": "product_url",
    "comp_brand": "crawled_brand", "comp_uom": "uom", "comp_size": "size", "comp_pack_size": "pack_size",
    "comp_img": "image_url", "comp_upc": "upc", "comp_custom_sku": "custom_sku", "comp_price": "list_price",
    "comp_alt_size": "size_alt", "comp_alt_uom": "uom_alt", "comp_dimension": "dimension",
    "comp_parent_sku": "parent_sku", "comp_shipping_weight": "shipping_weight",
    "comp_mfr_part_number": "manufacturer_part_number",
}


@dataclass(frozen=True)
class ApprovalConfig:
    tenant: str
    segment: str
    price_ratio: float = 0.8
    default_score: str = "100"
    default_match: str = "exact"
    model_used: str = "ml-V2.0"
    load_date: str | None = None
    catalog_filter: Column | str | None = None
    store_overrides: dict[str, str] = field(default_factory=dict)
    competitors: Sequence[str] | None = None
    strict: bool = False


def auto_approve(
    drop: DataFrame, catalog: DataFrame, warehouse: DataFrame, library: DataFrame, domains: DataFrame,
    config: ApprovalConfig, hot_parts: int | None = None,
) -> DataFrame:
    """Best approvable competitor product per base SKU, 36 columns.

    A pair is left out when the base SKU already has an undeleted match at that
    store, when the pair was ever in the library, deleted or not, or when the
    prices are too far apart. SKUs are compared without leading zeros. A
    negative base price fails the price rule unless ``strict``.
    """
    c = config
    missing = [n for n in REQUIRED_COLUMNS if n not in drop.columns]
    if missing:
        raise ValueError(f"the drop lacks the columns {missing}")
    registered = R.require_rows(
        R.competitor_stores(domains, c.tenant, c.competitors), f"no competitor store is registered for {c.tenant}"
    )
    raw = _decided(drop, registered, c)
    hot_base, hot_comp = skew.hot_key_sets(raw, [["_base"], ["_comp", "comp_source_store"]], hot_parts)
    known = R.latest_snapshot(
        library.where(F.col("company_code") == c.tenant), "load_date", override=c.load_date
    ).select(
        K.strip_zeros(F.lower("base_sku")).alias("_base"),
        K.strip_zeros(F.lower("comp_sku")).alias("_comp"),
        "comp_source_store", "deleted_date",
    )
    matched_at_store = known.where(F.col("deleted_date").isNull()).select("_base", "comp_source_store").distinct()
    ever_paired = known.select("_base", "_comp", "comp_source_store").distinct()

    # Dealt out by pair here, so the distinct rows need no shuffle of their own.
    open_pairs = raw.join(ever_paired, ["_base", "_comp", "comp_source_store"], "left_anti").distinct()
    open_pairs = skew.join_spread(open_pairs, matched_at_store, ["_base", "comp_source_store"], "left_anti", hot_base)
    matches = skew.join_spread(open_pairs, _base_side(catalog, c), ["_base"], "inner", hot_base)
    matches = skew.join_spread(matches, _comp_side(warehouse, registered, c), ["_comp", "comp_source_store"], "inner", hot_comp)
    near = matches.where(V.price_gate(F.col("base_price"), F.col("comp_price"), c.price_ratio, c.strict))

    shaped = near.withColumns(
        {name: F.lit("") for name in EMPTY_COLUMNS}
        | {"base_source_store": F.lit(K.store_name(c.tenant)), "model_used": F.lit(c.model_used)}
    ).select(*APPROVAL_COLUMNS)
    best = [F.col("score").try_cast("double").desc_nulls_last(), F.col("comp_source_store"), F.col("comp_sku")]
    return R.first_row(shaped, ["base_sku"], best)


def _decided(drop: DataFrame, registered: DataFrame, c: ApprovalConfig) -> DataFrame:
    store = F.lower(K.store_underscore(F.trim(F.col("comp_source_store"))))
    rows = drop.where(not_blank(F.col("base_sku")) & not_blank(F.col("comp_sku"))).select(
        F.lower(F.trim("base_sku")).alias("base_sku"),
        F.lower(F.trim("comp_sku")).alias("comp_sku"),
        store.alias("comp_source_store"),
        R.column_or(drop, "score", c.default_score).alias("score"),
        R.column_or(drop, "match", c.default_match).alias("match"),
    )
    return (
        rows.join(R.short_list(registered), "comp_source_store", "left_semi")
        .withColumns({"_base": K.strip_zeros(F.col("base_sku")), "_comp": K.strip_zeros(F.col("comp_sku"))})
    )


def _base_side(catalog: DataFrame, c: ApprovalConfig) -> DataFrame:
    own = R.latest_snapshot(catalog.where(F.col("source") == c.tenant), "capture_date")
    rows = R.optional_filter(own, c.catalog_filter).select(
        K.strip_zeros(F.lower("sku")).alias("_base"),
        F.col("list_price").alias("base_price"),
        F.col("product_title").alias("base_title"),
        first_of_list(F.col("upc")).alias("base_upc"),
        F.col("parent_sku").alias("base_parent_sku"),
    )
    return _one_per_price(rows, ["_base", "base_price"])


def _one_per_price(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of rows with one key and price, the one that the final order would pick.

    The price rule looks at nothing else, and that order compares the columns of
    both sides in the order of the result, so the others could never win. A pair
    then meets each different price once, however many versions a product has.
    """
    order = [F.col(n).asc_nulls_last() for n in APPROVAL_COLUMNS if n in rows.columns and n not in keys]
    return R.first_row(rows, keys, order)


def _comp_side(warehouse: DataFrame, registered: DataFrame, c: ApprovalConfig) -> DataFrame:
    stores = R.short_list(registered.select(F.col("comp_source_store").alias("_in")))
    rows = warehouse.where(F.col("product_segment") == c.segment).join(
        stores, F.lower(K.store_underscore(F.col("source_store"))) == F.col("_in"), "left_semi"
    )
    sold = rows.select(
        K.strip_zeros(F.lower("sku")).alias("_comp"),
        K.remapped_store(F.col("source_name"), F.col("store_name"), c.store_overrides).alias("comp_source_store"),
        *[F.col(source).cast("string").alias(name) for name, source in COMP_FIELDS.items()],
    )
    return _one_per_price(sold, ["_comp", "comp_source_store", "comp_price"])
