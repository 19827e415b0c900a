"""Product, store and pair identifiers.

Stores appear as ``source_store`` or ``source<>store``; product ids as
``sku<>source<>store``, sometimes with a UPC in front.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

BRACKET = "<>"
UNDERSCORE = "_"


def store_underscore(store: Column) -> Column:
    return F.replace(store, F.lit(BRACKET), F.lit(UNDERSCORE))


def store_bracket(store: Column) -> Column:
    return F.replace(store, F.lit(UNDERSCORE), F.lit(BRACKET))


def store_name(source: str, separator: str = UNDERSCORE) -> str:
    """``acme`` -> ``acme_acme``: a retailer's default store."""
    return f"{source}{separator}{source}"


def store_names(sources: list[str], separator: str = UNDERSCORE) -> list[str]:
    return [store_name(s, separator) for s in sources]


def retailer_of(store: Column) -> Column:
    """Source part of a store id in either form."""
    return F.split_part(store_underscore(store), F.lit(UNDERSCORE), F.lit(1))


def sku_uuid(sku: Column, store: Column) -> Column:
    return F.concat_ws(BRACKET, sku, store_bracket(store))


def training_pair_id(base_sku: Column, base_store: Column, comp_sku: Column, comp_store: Column) -> Column:
    """Null parts are skipped, as ``concat_ws`` does."""
    return F.concat_ws(BRACKET, base_sku, store_bracket(base_store), comp_sku, store_bracket(comp_store))


def queue_pair_id(base_sku: Column, base_store: Column, comp_sku: Column, comp_store: Column) -> Column:
    """Null if any part is null, as ``concat`` does."""
    return F.concat(
        base_sku, F.lit(UNDERSCORE), base_store, F.lit(BRACKET), comp_sku, F.lit(UNDERSCORE), comp_store
    )


def request_key(base_sku: Column, comp_store: Column) -> Column:
    return F.concat(base_sku, F.lit(BRACKET), store_bracket(comp_store))


def canonical_uuid(uuid: Column) -> Column:
    """Last three parts; ids with fewer parts stay as they are."""
    return F.substring_index(uuid, BRACKET, -3)


def _part(text: Column, position: int) -> Column:
    return F.nullif(F.split_part(text, F.lit(BRACKET), F.lit(position)), F.lit(""))


def uuid_sku(uuid: Column, canonical: bool = True) -> Column:
    """SKU of a product id; without ``canonical`` simply the first part."""
    return _part(canonical_uuid(uuid) if canonical else uuid, 1)


def uuid_store(uuid: Column) -> Column:
    """``source<>store`` of a canonical or UPC-prefixed id."""
    return F.get(F.split(canonical_uuid(uuid), BRACKET, 2), 1)


def prefixed_upc(uuid: Column) -> Column:
    return _part(uuid, 1)


def prefixed_sku(uuid: Column) -> Column:
    """SKU of an id that is known to start with a UPC."""
    return _part(uuid, 2)


def prefixed_store(uuid: Column) -> Column:
    """Everything after the second separator."""
    return F.get(F.split(uuid, BRACKET, 3), 2)


def strip_zeros(text: Column) -> Column:
    """Drop leading zeros; an all-zero id becomes the empty string."""
    return F.ltrim(text, F.lit("0"))


def queue_index_keys(
    base_sku: Column, base_store: Column, comp_sku: Column, comp_store: Column,
    base_match_sku: Column, comp_match_sku: Column,
) -> dict[str, Column]:
    """The concatenated look-up keys of a review-queue row.

    Either match SKU falls back to the *base* SKU when blank.
    """
    def link(*parts: Column) -> Column:
        joined = [parts[0]]
        for part in parts[1:]:
            joined += [F.lit(UNDERSCORE), part]
        return F.concat(*joined)

    base_match = F.coalesce(F.nullif(base_match_sku, F.lit("")), base_sku)
    comp_match = F.coalesce(F.nullif(comp_match_sku, F.lit("")), base_sku)
    return {
        "match_sku": base_match,
        "match_sku_base_source_store_comp_source_store": link(base_match, base_store, comp_store),
        "base_source_store_comp_sku_comp_source_store": link(base_store, comp_sku, comp_store),
        "comp_sku_comp_source_store_base_source_store": link(comp_sku, comp_store, base_store),
        "comp_source_store_match_sku_base_source_store": link(comp_store, comp_match, base_store),
    }


def remapped_store(source: Column, store: Column, overrides: dict[str, str] | None = None) -> Column:
    """``lower(source_store)`` unless ``overrides`` names the store of that source."""
    plain = F.lower(F.concat(source, F.lit(UNDERSCORE), store))
    if not overrides:
        return plain
    lookup = F.create_map(*[F.lit(v) for item in sorted(overrides.items()) for v in item])
    return F.coalesce(F.try_element_at(lookup, source), plain)


def check_overrides(overrides: Mapping[str, str]) -> dict[str, str]:
    """Source -> store, stripped; blank or null names, and stores without a form such as ``shop_shop``, are errors."""
    found = {(source or "").strip(): (store or "").strip() for source, store in overrides.items()}
    wrong = sorted(f"{s}: {t}" for s, t in found.items() if not s or UNDERSCORE not in t.strip(UNDERSCORE))
    if wrong:
        raise ValueError(f"store overrides without a source or a full store name: {'; '.join(wrong)}")
    return found
