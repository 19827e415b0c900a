"""Labelled training pairs with product fields and similarity scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import keys as K
from ..functions.text import blank_to_null
from ..operators import relational as R
from ..operators import skew

# Key columns and the labels that count, per source.
PAIR = ["base_sku", "base_source_store", "comp_sku", "comp_source_store"]
LIBRARY_LABELS = ["exact", "equivalent"]
REVIEW_LABELS = ["exact", "equivalent", "not_a_match"]
TEXTS = [f"{side}_{field}" for side in ("base", "comp") for field in ("title", "description", "brand")]
LIBRARY_EXTRAS = ["base_price", "base_pack_size", "comp_price", "comp_pack_size"]
# The data set's columns in order.
TRAINING_COLUMNS = [
    "sku_uuid_a", "sku_uuid_b", "pair_id", "answer", "segment",
    "base_sku", "base_source_store", "base_title", "base_description", "base_brand",
    "base_upc", "base_price", "base_pack_size",
    "comp_sku", "comp_source_store", "comp_title", "comp_description", "comp_brand",
    "comp_upc", "comp_price", "comp_pack_size",
    "base_mpn", "comp_mpn", "comp_upc_list", "source_priority",
]


def labelled(library: DataFrame, reviews: DataFrame, tenant: str, load_date: str, since: str) -> DataFrame:
    """Library matches and review answers in one shape, before duplicates are dropped."""
    from_library = R.live(library).where(
        (F.col("company_code") == tenant) & (F.col("load_date") == load_date) & F.col("match").isin(LIBRARY_LABELS)
    ).select(
        *PAIR, F.col("match").alias("answer"), "segment", "base_upc", "comp_upc",
        *[blank_to_null(F.col(c)).alias(c) for c in TEXTS], *LIBRARY_EXTRAS, F.lit(1).alias("source_priority"),
    )
    from_reviews = reviews.where(
        (F.concat("year", "month") >= since)
        & F.col("answer").isin(REVIEW_LABELS)
        & (F.col("base_source_store") == K.store_name(tenant))
    ).select(*PAIR, "answer", "segment", "base_upc", "comp_upc", F.lit(2).alias("source_priority"))
    both = from_library.unionByName(from_reviews, allowMissingColumns=True)
    base = (F.col("base_sku"), F.col("base_source_store"))
    comp = (F.col("comp_sku"), F.col("comp_source_store"))
    return both.withColumn("pair_id", K.training_pair_id(*base, *comp))


def training_pairs(
    library: DataFrame, reviews: DataFrame, catalog: DataFrame, warehouse: DataFrame, tenant: str, load_date: str,
    since: str = "202401", hot_parts: int | None = None,
) -> DataFrame:
    """One row per labelled pair that has a title on both sides.

    A pair in the library wins over its review answers: keeping the row of the
    best source per pair id also does the work of excluding reviewed pairs that
    the library has. Ids made of the pair are dropped while rows are moved and
    made anew at the end.
    """
    both = labelled(library, reviews, tenant, load_date, since)
    hot_base, hot_comp = skew.hot_key_sets(both, [["base_sku"], ["comp_sku", "comp_source_store"]], hot_parts)
    rows = R.first_row(both, ["pair_id"], [F.col("source_priority")]).drop("pair_id")

    base = catalog.where(F.col("source") == tenant).select(
        F.col("sku").alias("base_sku"),
        F.concat("source", F.lit("_"), "source").alias("base_source_store"),
        blank_to_null(F.col("product_title")).alias("cat_title"),
        blank_to_null(F.col("product_description")).alias("cat_description"),
        blank_to_null(F.col("brand")).alias("cat_brand"),
        F.col("manufacturer_part_number").alias("base_mpn"),
        "capture_date",
    )
    comp = warehouse.select(
        F.col("sku").alias("comp_sku"),
        K.store_underscore(F.col("source_store")).alias("comp_source_store"),
        "product_segment",
        blank_to_null(F.col("product_title")).alias("pdp_title"),
        blank_to_null(F.col("product_description")).alias("pdp_description"),
        blank_to_null(F.col("standardized_brand")).alias("pdp_brand"),
        F.col("manufacturer_part_number").alias("comp_mpn"),
        F.col("upc_list").alias("comp_upc_list"),
    )

    rows = skew.attach_all(
        rows, [(base, ["base_sku", "base_source_store"], [F.col("capture_date").desc_nulls_last()])], hot_base, PAIR
    )
    rows = skew.attach_all(
        rows, [(comp, ["comp_sku", "comp_source_store"], [F.col("product_segment").asc_nulls_last()])], hot_comp, PAIR
    )
    filled = {}
    for side, spare in (("base", "cat"), ("comp", "pdp")):
        for part in ("title", "description", "brand"):
            filled[f"{side}_{part}"] = F.coalesce(f"{side}_{part}", f"{spare}_{part}")
    titled = rows.withColumns(filled).where(F.col("base_title").isNotNull() & F.col("comp_title").isNotNull())
    base, comp = [(F.col(f"{side}_sku"), F.col(f"{side}_source_store")) for side in ("base", "comp")]
    ids = {"pair_id": K.training_pair_id(*base, *comp), "sku_uuid_a": K.sku_uuid(*base), "sku_uuid_b": K.sku_uuid(*comp)}
    return titled.withColumns(ids).select(*TRAINING_COLUMNS)
