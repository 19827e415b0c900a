"""Labelled, enriched examples from the tenant's own and from mapped competitors' matches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import keys as K
from ..operators import relational as R
from ..operators import skew
from ..session import cut_lineage

PAIR = ["base_sku", "base_source_store", "comp_sku", "comp_source_store"]
# The labels an example may carry.
LABELS = ["exact_match", "equivalent_match", "not_a_match"]
EXAMPLE_COLUMNS = [
    *PAIR, "match_norm",
    "base_title", "base_brand", "base_category", "base_subcategory", "base_sub_subcategory",
    "comp_title", "comp_brand", "comp_category", "comp_subcategory", "comp_sub_subcategory",
]
MAPPING_KEYS = ["retailer", "comp_category", "comp_subcategory", "comp_sub_subcategory"]


def _labelled(library: DataFrame, reviews: DataFrame, scope: Column, company: str | None) -> DataFrame:
    """Distinct labelled pairs of the newest library snapshot and of the active reviews."""
    entries = library if company is None else library.where(F.col("company_code") == company)
    newest = R.live(R.latest_snapshot(entries, "load_date"))
    from_library = newest.where(F.col("comp_sku").isNotNull()).select(*PAIR, F.col("match").alias("match_norm"))
    from_reviews = reviews.where("is_active").select(*PAIR, F.col("answer").alias("match_norm"))
    both = from_library.unionByName(from_reviews)
    return both.where(F.col("match_norm").isin(LABELS) & scope)


def _with_products(labelled: DataFrame, base: DataFrame, comp: DataFrame, hot_parts: int | None) -> DataFrame:
    """Inner joins to one catalog and one warehouse row per product."""
    # Read for the hot keys and again for the joins.
    keyed = cut_lineage(labelled.distinct().withColumns({"_base": F.lower("base_sku"), "_comp": F.lower("comp_sku")}))
    hot_base, hot_comp = skew.hot_key_sets(keyed, [["_base"], ["_comp", "comp_source_store"]], hot_parts)
    newest = [F.col("capture_date").desc_nulls_last()]
    by_segment = [F.col("product_segment").asc_nulls_last()]
    rows = skew.attach_all(
        keyed, [(base, ["_base", "base_source_store"], newest)], hot_base, [*PAIR, "match_norm"], "inner"
    )
    return skew.attach_all(
        rows, [(comp, ["_comp", "comp_source_store"], by_segment)], hot_comp, [*PAIR, "match_norm"], "inner"
    )


def _catalog_side(catalog: DataFrame) -> DataFrame:
    return catalog.select(
        F.lower("sku").alias("_base"),
        F.col("source_store").alias("base_source_store"),
        F.col("product_title").alias("base_title"), F.col("brand").alias("base_brand"),
        F.col("category").alias("base_category"), F.col("subcategory").alias("base_subcategory"),
        F.col("sub_subcategory").alias("base_sub_subcategory"), F.col("segment").alias("base_segment"),
        "capture_date",
    )


def _warehouse_side(warehouse: DataFrame) -> DataFrame:
    return warehouse.select(
        F.lower("sku").alias("_comp"),
        K.store_underscore(F.col("source_store")).alias("comp_source_store"),
        F.col("product_title").alias("comp_title"), F.col("standardized_brand").alias("comp_brand"),
        F.col("category").alias("comp_category"), F.col("subcategory").alias("comp_subcategory"),
        F.col("sub_subcategory").alias("comp_sub_subcategory"),
        "product_segment",
    )


def own_examples(
    library: DataFrame, reviews: DataFrame, catalog: DataFrame, warehouse: DataFrame, tenant: str,
    hot_parts: int | None = None,
) -> DataFrame:
    """The tenant's labelled pairs with product fields of both sides."""
    scope = K.retailer_of(F.col("base_source_store")) == tenant
    labelled = _labelled(library, reviews, scope, tenant)
    base = _catalog_side(catalog.where(F.col("source") == tenant))
    return _with_products(labelled, base, _warehouse_side(warehouse), hot_parts).select(*EXAMPLE_COLUMNS)


def synthetic_examples(
    library: DataFrame, reviews: DataFrame, catalog: DataFrame, warehouse: DataFrame, mapping: DataFrame,
    competitors: Sequence[str], company: str | None, segment: str | None = None, hot_parts: int | None = None,
) -> DataFrame:
    """Labelled pairs of mapped competitors whose product falls in a mapped taxonomy node.

    ``company`` scopes the library (None: every company); ``segment`` limits the
    base products. The mapping lists a node once per base node, so it only
    filters and never multiplies rows. Null levels match nothing.
    """
    scope = K.retailer_of(F.col("comp_source_store")).isin(list(competitors))
    labelled = _labelled(library, reviews, scope, company)
    rows = _with_products(labelled, _catalog_side(catalog), _warehouse_side(warehouse), hot_parts)
    rows = rows.withColumn("retailer", K.retailer_of(F.col("comp_source_store")))
    if segment is not None:
        rows = rows.where(F.col("base_segment") == segment)
    nodes = mapping.select(*MAPPING_KEYS).distinct()
    if R.is_short(nodes):
        mapped = rows.join(F.broadcast(nodes), MAPPING_KEYS, "left_semi")
    else:
        mapped = skew.join_spread(rows, nodes, MAPPING_KEYS, "left_semi", skew.hot_keys(rows, MAPPING_KEYS, hot_parts), PAIR)
    return mapped.select(*EXAMPLE_COLUMNS, "base_segment")


def combine_examples(own: DataFrame, synthetic: DataFrame | None = None) -> DataFrame:
    """Own and synthetic examples, one label per pair.

    Own examples win; within a source the alphabetically first label does.
    """
    rows = own.withColumn("_source", F.lit(1))
    if synthetic is not None:
        rows = rows.unionByName(synthetic.withColumn("_source", F.lit(2)), allowMissingColumns=True)
    return R.first_row(rows, PAIR, [F.col("_source"), F.col("match_norm")]).drop("_source")


def collect_examples(
    own: DataFrame, synthetic: DataFrame | None, include_other_tenants: bool
) -> DataFrame:
    """``include_other_tenants`` is the master switch for synthetic examples."""
    return combine_examples(own, synthetic if include_other_tenants else None)
