"""Input schemas as DDL text, in the order the sources publish their columns."""

from __future__ import annotations

from pyspark.sql import types as T


def _text(*names: str) -> str:
    return ", ".join(f"{n} string" for n in names)


PAIR = ("base_sku", "base_source_store", "comp_sku", "comp_source_store")
DATE_PARTS = ("year", "month", "day")

INPUT_PAIRS = _text(*PAIR) + ", score double"
CATALOG = _text(
    "sku", "source", "source_store", "capture_date", "is_active", "is_discontinued", "segment",
    "product_title", "product_description", "brand", "brand_type", "category", "subcategory",
    "sub_subcategory", "list_price", "list_price_alt", "size", "size_alt", "uom", "uom_alt",
    "pack_size", "dimension", "shipping_weight", "upc", "manufacturer_part_number", "parent_sku",
    "custom_sku", "product_url", "image_url", "additional_attributes",
)
WAREHOUSE = _text(
    "sku", "source_store", "source_name", "store_name", "product_segment", "capture_date",
    *DATE_PARTS, "product_title", "product_description", "standardized_brand", "crawled_brand",
    "category", "subcategory", "sub_subcategory", "upc", "product_url", "image_url",
    "manufacturer_part_number", "parent_sku", "custom_sku", "size", "size_alt", "uom", "uom_alt",
    "pack_size", "dimension", "shipping_weight",
) + ", list_price double, effective_price double, upc_list array<string>"
LIBRARY = _text(
    *PAIR, "company_code", "segment", "match", "deleted_date", "load_date", "match_date",
    "base_title", "base_description", "base_brand", "base_upc", "base_price", "base_pack_size",
    "comp_title", "comp_description", "comp_brand", "comp_upc", "comp_price", "comp_pack_size",
    "matcher_comments",
) + ", active boolean"
REVIEWS = _text(
    *PAIR, "base_upc", "comp_upc", "segment", "answer", "queue_name", "match_date",
    "inserted_date", "year", "month",
) + ", is_active boolean, score double"
UPC_MATCHES = _text("uuid_a", "uuid_b", "segment", *DATE_PARTS) + ", score double"
MPN_MATCHES = (
    _text("uuid_a", "uuid_b", "base_source_store", "comp_source_store", "segment", *DATE_PARTS)
    + ", score double"
)
DIRECTED_PAIRS = (
    _text("base_sku_uuid", "comp_sku_uuid", "base_source_store", "comp_source_store", "segment", *DATE_PARTS)
    + ", score double"
)
QUEUE = _text(*PAIR, "queue_name", "tenant", "segment", *DATE_PARTS) + ", aggregated_score double"
REQUESTS = _text(
    "company_code", "product_segment", "base_sku", "comp_source_store", "search_key",
    "search_key_type", "search_type",
)
CRAWL = _text("sku", "upc", "source_name", "store_name", "capture_date", "year")
ML_INPUT = _text(
    "sku", "source_store", "segment", *DATE_PARTS, "capture_date", "product_title",
    "product_description", "brand", "category", "subcategory", "sub_subcategory", "upc",
    "match_sku", "parent_sku", "manufacturer_part_number", "image_url", "product_url",
    "effective_price", "size", "size_alt", "uom", "uom_alt", "dimension", "shipping_weight",
)
DOMAINS = _text("client", "primary")
MAPPING = (
    _text("base_category", "base_subcategory", "base_sub_subcategory", "retailer", "comp_category",
          "comp_subcategory", "comp_sub_subcategory")
    + ", bert_similarity double, tfidf_similarity double, combined_score double, rank int"
)
RECALL = _text("base_sku_uuid", "comp_sku_uuid", "score")
EMBEDDINGS = "title string, embedding array<float>"
OBJECT_EVENTS = "bucket string, key string, ts timestamp"


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)
