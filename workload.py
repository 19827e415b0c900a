"""The registered queries: each one runs an operator over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixtures import COMPETITORS, RUN_DATE, SEGMENT, TENANT, fixture
from pairloom.functions import keys, text, values
from pairloom.operators import relational, scorers, skew, tfidf
from pairloom.plans import (
    approval, coverage, examples, recall, reports, retriever, review_queue, signals, taxonomy, training,
)
from pairloom.session import Workspace
from pairloom.sources import readers
from pairloom.streaming import drops

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(*fixtures: str, name: str | None = None):
    """Register a function of the named fixtures as a query."""
    def add(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        def run(spark: SparkSession, sf: str) -> DataFrame:
            known: dict[str, DataFrame] = {}
            return build(*[fixture(spark, sf, f, known) for f in fixtures])

        QUERIES[name or build.__name__] = run
        return build
    return add


# --- coverage ----------------------------------------------------------------

@query("fx_pairs", "fx_catalog")
def sig_catalog(pairs, catalog):
    return signals.catalog_signal(signals.spine(pairs), catalog, TENANT)


@query("fx_crawl")
def sig_crawl(crawl):
    return signals.crawl_signal(crawl, COMPETITORS, signals.crawl_years(RUN_DATE))


@query("fx_warehouse")
def sig_warehouse(warehouse):
    return signals.warehouse_signal(warehouse, COMPETITORS, SEGMENT)


@query("fx_reviews")
def sig_review(reviews):
    return signals.review_signal(reviews, TENANT, COMPETITORS, SEGMENT)


@query("fx_upc")
def sig_upc(matches):
    return signals.upc_signal(matches, TENANT, COMPETITORS, SEGMENT)


@query("fx_mpn")
def sig_mpn(matches):
    return signals.mpn_signal(matches, TENANT, COMPETITORS, SEGMENT)


@query("fx_library")
def sig_library(library):
    return signals.library_signal(library, TENANT, COMPETITORS)


@query("fx_input_precision", "fx_input_generic")
def sig_input(precision, generic):
    return signals.input_signal(precision, generic, TENANT, COMPETITORS, SEGMENT)


for _model in ("precision", "generic", "semantic"):
    query(f"fx_{_model}", name=f"sig_{_model}")(
        lambda pairs: signals.model_signal(pairs, TENANT, COMPETITORS, SEGMENT)
    )


@query("fx_queue")
def sig_queue(queue):
    return signals.queue_signal(queue, TENANT, SEGMENT)


@query("fx_requests")
def sig_request(requests):
    return signals.request_signal(requests, TENANT, COMPETITORS, SEGMENT)


SOURCES = {
    "catalog": "fx_catalog", "crawl": "fx_crawl", "warehouse": "fx_warehouse", "reviews": "fx_reviews",
    "library": "fx_library", "upc_matches": "fx_upc", "mpn_matches": "fx_mpn",
    "precision_input": "fx_input_precision", "generic_input": "fx_input_generic",
    "precision_pairs": "fx_precision", "generic_pairs": "fx_generic", "semantic_pairs": "fx_semantic",
    "queue": "fx_queue", "requests": "fx_requests",
}


@query("fx_pairs", *SOURCES.values())
def coverage_report(pairs, *tables):
    sources = coverage.CoverageSources(**dict(zip(SOURCES, tables, strict=True)))
    return coverage.coverage_report(pairs, sources, TENANT, SEGMENT, COMPETITORS, RUN_DATE)


# --- review queue and auto approval ------------------------------------------

def newest(frame: DataFrame, *keys: str) -> DataFrame:
    return relational.latest_row(frame, list(keys), "capture_date")


def domains_of(frame: DataFrame) -> DataFrame:
    return frame.withColumnRenamed("primary_store", "primary")


QUEUE_CONFIG = review_queue.QueueConfig(
    base_store="acme_acme", segment=SEGMENT, domain="retail", queue_name="adhoc", store_display="Acme",
    company_code="reviewers", match_id="run-1", model_used="title-model", score_column="score", run_date="2024-03-01",
)


@query("fx_pairs", "fx_library", "fx_input_precision", "fx_catalog", "fx_warehouse", "fx_domains", name="review_queue")
def build_queue(pairs, library, ml_input, catalog, warehouse, domains):
    return review_queue.build_review_queue(
        pairs, library, ml_input, catalog, warehouse, domains_of(domains), QUEUE_CONFIG
    )


@query("fx_drop", "fx_catalog", "fx_warehouse", "fx_library", "fx_domains")
def auto_approve(drop, catalog, warehouse, library, domains):
    config = approval.ApprovalConfig(
        TENANT, SEGMENT, catalog_filter="get_json_object(additional_attributes, '$.cadence') = 'weekly'",
        store_overrides={"r1": "r1_r1"},
    )
    return approval.auto_approve(drop, catalog, warehouse, library, domains_of(domains), config)


@query("fx_drop", "fx_domains")
def unknown_stores(drop, domains):
    return relational.unknown_stores(drop, relational.competitor_stores(domains_of(domains), TENANT))


# --- training pairs and similarity -------------------------------------------

STOP_WORDS = ("old", "the", "of")
SINCE = "199401"


@query("fx_library", "fx_reviews", "fx_catalog", "fx_warehouse")
def training_pairs(library, reviews, catalog, warehouse):
    return training.training_pairs(library, reviews, catalog, warehouse, TENANT, "1998-01-01", SINCE)


@query("fx_titles", "fx_title_embeddings")
def embedding_similarity(titles, embeddings):
    scored = scorers.run_scorers(titles, [scorers.embedding_scorer(embeddings)])
    return scored.withColumn("bert_similarity", F.round("bert_similarity", 6))


@query("fx_titles")
def tfidf_similarity(titles):
    return scorers.run_scorers(titles, [scorers.tfidf_scorer()])


@query("fx_titles", "fx_lemmas")
def tfidf_lemmas(titles, lemmas):
    return scorers.run_scorers(titles, [scorers.tfidf_scorer(STOP_WORDS, lemmas)])


@query("fx_library", "fx_reviews", "fx_catalog", "fx_warehouse", "fx_title_embeddings")
def training_similarity(library, reviews, catalog, warehouse, embeddings):
    rows = training_pairs(library, reviews, catalog, warehouse)
    scored = scorers.run_scorers(rows, [scorers.embedding_scorer(embeddings), scorers.tfidf_scorer(STOP_WORDS)])
    return scored.select(
        "pair_id", "base_title", "comp_title", F.round("bert_similarity", 6).alias("bert_similarity"), "tfidf_similarity"
    )


@query("fx_vectors")
def vector_dot(vectors):
    score = F.round(values.dot(F.col("base_embedding"), F.col("comp_embedding")), 6)
    return vectors.select("vec_id", "other_id", score.alias("score"))


# --- taxonomy ----------------------------------------------------------------

THRESHOLD = 0.45
MAPPING = taxonomy.MappingConfig(threshold=THRESHOLD, stop_words=STOP_WORDS)


def _rounded(mapping: DataFrame) -> DataFrame:
    return mapping.withColumn("bert_similarity", F.round("bert_similarity", 6))


@query("fx_tax_base", "fx_tax_comp", "fx_tax_embeddings")
def taxonomy_full(base, comp, embeddings):
    return _rounded(taxonomy.map_taxonomy(base, comp, embeddings, MAPPING))


CURRENT = ["africa", "america", "asia", "europe"]


def previous_nodes(base, comp):
    """Nodes before two product lines and one retailer came in."""
    return base.where("category <> 'SMALL'"), comp.where("retailer <> 'asia'")


def previous_mapping(base, comp, embeddings):
    return taxonomy.map_taxonomy(*previous_nodes(base, comp), embeddings, MAPPING)


@query("fx_tax_base", "fx_tax_comp", "fx_tax_embeddings")
def taxonomy_rescored(base, comp, embeddings):
    """Incremental mapping without a record of what was compared: all pairs not stored are scored."""
    mapping = taxonomy.map_taxonomy_incremental(
        base, comp.where(F.col("retailer").isin(CURRENT)), previous_mapping(base, comp, embeddings), CURRENT, embeddings, MAPPING,
    )
    return _rounded(mapping)


_STORES: dict[tuple[str, str], taxonomy.MappingStore] = {}


def _previous_store(spark: SparkSession, sf: str) -> taxonomy.MappingStore:
    """The mapping of the earlier nodes in a store of its own, made once per application and folder of tables."""
    mark = (spark.sparkContext.applicationId, sf)
    if mark not in _STORES:
        base, comp, embeddings = (fixture(spark, sf, f) for f in ("fx_tax_base", "fx_tax_comp", "fx_tax_embeddings"))
        store = taxonomy.MappingStore(spark, Workspace(spark, "mapping").root)
        store.commit(previous_mapping(base, comp, embeddings), *previous_nodes(base, comp), embeddings)
        _STORES[mark] = store
    return _STORES[mark]


def taxonomy_previous(spark: SparkSession, sf: str) -> DataFrame:
    """The stored mapping that `taxonomy_incremental` starts from."""
    return _rounded(_previous_store(spark, sf).newest()[0])


def taxonomy_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Only pairs with a node that the stored version doesn't know are compared."""
    base, comp, embeddings = (fixture(spark, sf, f) for f in ("fx_tax_base", "fx_tax_comp", "fx_tax_embeddings"))
    previous, *compared = _previous_store(spark, sf).newest()
    mapping = taxonomy.map_taxonomy_incremental(
        base, comp.where(F.col("retailer").isin(CURRENT)), previous, CURRENT, embeddings, MAPPING, tuple(compared)
    )
    return _rounded(mapping)


QUERIES |= {"taxonomy_previous": taxonomy_previous, "taxonomy_incremental": taxonomy_incremental}


@query("fx_catalog")
def taxonomy_base_nodes(catalog):
    return taxonomy.base_nodes(catalog, TENANT)


@query("fx_warehouse")
def taxonomy_comp_nodes(warehouse):
    return taxonomy.comp_nodes(warehouse, COMPETITORS)


# --- examples and retrieval --------------------------------------------------

EXAMPLE_TABLES = ("fx_library_m", "fx_reviews_m", "fx_catalog", "fx_warehouse")


def mapping_of(warehouse: DataFrame) -> DataFrame:
    """A mapping of the warehouse's nodes, each for two base nodes."""
    nodes = taxonomy.comp_nodes(warehouse, COMPETITORS).select(
        "retailer", *[F.col(c).alias(f"comp_{c}") for c in taxonomy.LEVELS]
    )
    return nodes.unionByName(nodes)


@query(*EXAMPLE_TABLES)
def examples_own(library, reviews, catalog, warehouse):
    return examples.own_examples(library, reviews, catalog, warehouse, TENANT)


@query(*EXAMPLE_TABLES)
def examples_synth(library, reviews, catalog, warehouse):
    return examples.synthetic_examples(
        library, reviews, catalog, warehouse, mapping_of(warehouse), COMPETITORS, TENANT, SEGMENT
    )


def _combined(*tables):
    return examples.collect_examples(examples_own(*tables), examples_synth(*tables), True)


@query(*EXAMPLE_TABLES, name="examples")
def examples_all(library, reviews, catalog, warehouse):
    return _combined(library, reviews, catalog, warehouse)


@query(*EXAMPLE_TABLES)
def label_distribution(library, reviews, catalog, warehouse):
    return reports.label_distribution(_combined(library, reviews, catalog, warehouse), examples.LABELS)


@query(*EXAMPLE_TABLES)
def brand_counts(library, reviews, catalog, warehouse):
    return reports.brand_counts(examples_own(library, reviews, catalog, warehouse))


@query(*EXAMPLE_TABLES)
def example_metrics(*tables):
    return reports.example_metrics(examples_own(*tables), examples_synth(*tables))


@query("fx_docs", "fx_asked")
def retriever_topk(docs, asked):
    found = retriever.query(retriever.build_index(docs), asked, k=20)
    return found.withColumn("score", F.round("score", 6))


@query(*EXAMPLE_TABLES)
def retriever_examples(library, reviews, catalog, warehouse):
    """Nearest examples of every warehouse product's title and brand."""
    index = retriever.build_retriever(
        _combined(library, reviews, catalog, warehouse), "category", labels=examples.LABELS
    )
    asked = warehouse.select(
        F.concat_ws("@", "sku", "source_store", "capture_date").alias("query_id"),
        F.concat_ws(" ", "product_title", "standardized_brand").alias("q"),
    )
    return retriever.query(index, asked, k=5).withColumn("score", F.round("score", 6))


# --- recall and drop events --------------------------------------------------

@query("fx_recall")
def recall_dedupe(rows):
    return recall.dedupe_recall(rows)


@query("fx_recall")
def recall_dedupe_global(rows):
    return recall.dedupe_recall(rows.select(*recall.FIELDS), by_file=False)


@query("fx_recall")
def recall_stats(rows):
    return recall.recall_stats(rows)


@query("fx_recall")
def recall_summary(rows):
    return recall.recall_summary(recall.recall_stats(rows))


@query("fx_events")
def drop_events(events):
    return drops.accept_once(events).select(
        "event_id", "key", *drops.PARTITIONS, "action", "reason", "input_prefix"
    )


@query("fx_events", "fx_finished")
def drop_runs(events, finished):
    """Several runs per prefix, each from its first event until it is reported finished."""
    return drops.accept_once(events, finished=finished).select("event_id", "key", "action", "reason", "input_prefix")


# --- keys, text and values ---------------------------------------------------

@query("fx_pairs")
def store_form(pairs):
    store = F.col("comp_source_store")
    return pairs.select(
        store.alias("under"), keys.store_bracket(store).alias("bracket"),
        keys.store_underscore(keys.store_bracket(store)).alias("back"), keys.retailer_of(store).alias("retailer"),
    ).distinct()


@query("fx_recall")
def uuid_canonical(rows):
    return rows.select("base_sku_uuid", keys.canonical_uuid(F.col("base_sku_uuid")).alias("canonical")).distinct()


@query("fx_upc", "fx_recall")
def uuid_parts(matches, recall_rows):
    prefixed, either = F.col("uuid_a"), F.col("base_sku_uuid")
    known = matches.select(
        prefixed.alias("uuid"), keys.prefixed_upc(prefixed).alias("upc"), keys.prefixed_sku(prefixed).alias("sku"),
        keys.prefixed_store(prefixed).alias("store"),
    )
    found = recall_rows.select(
        either.alias("uuid"), F.lit(None).cast("string").alias("upc"), keys.uuid_sku(either).alias("sku"),
        keys.uuid_store(either).alias("store"),
    )
    return known.unionByName(found).distinct()


@query("fx_pairs")
def pair_id(pairs):
    parts = [F.col(c) for c in ("base_sku", "base_source_store", "comp_sku", "comp_source_store")]
    return pairs.select(
        keys.training_pair_id(*parts).alias("training_id"), keys.queue_pair_id(*parts).alias("queue_id"),
        keys.sku_uuid(parts[0], parts[1]).alias("sku_uuid"), keys.request_key(parts[0], parts[3]).alias("request_key"),
    ).distinct()


@query("fx_catalog")
def strip_zeros(catalog):
    return catalog.select("sku", "capture_date", keys.strip_zeros(text.first_of_list(F.col("upc"))).alias("upc"))


@query("fx_catalog")
def blank_to_null(catalog):
    title = F.col("product_title")
    return catalog.select(
        "sku", "capture_date", text.blank_to_null(title).alias("title"), text.not_blank(title).alias("filled"),
        values.fallback(title, F.col("brand")).alias("shown"),
    )


@query("fx_pairs", "fx_catalog", "fx_warehouse")
def price_gate(pairs, catalog, warehouse):
    base = newest(catalog, "sku").select(F.lower("sku").alias("base_sku"), F.col("list_price").alias("base_price"))
    comp = newest(warehouse, "sku").select(
        F.lower("sku").alias("comp_sku"), F.col("list_price").cast("string").alias("comp_price")
    )
    joined = pairs.select("base_sku", "comp_sku").distinct().join(base, "base_sku").join(comp, "comp_sku")
    return joined.select(
        "base_sku", "comp_sku", values.price_number(F.col("base_price")).alias("base_number"),
        values.price_gate(F.col("base_price"), F.col("comp_price"), 0.8).alias("near"),
    )


@query("fx_pairs", "fx_catalog", "fx_crawl")
def upc_overlap(pairs, catalog, crawl):
    base = newest(catalog, "sku").select(F.lower("sku").alias("base_sku"), F.col("upc").alias("base_upc"))
    seen = signals.crawl_signal(crawl, COMPETITORS, signals.crawl_years(RUN_DATE)).select("comp_sku", "dc_upc").distinct()
    joined = pairs.select("base_sku", "comp_sku").distinct().join(base, "base_sku").join(seen, "comp_sku")
    return joined.select(
        "base_sku", "comp_sku", "dc_upc", text.upc_overlap(F.col("base_upc"), F.col("dc_upc"), F.lit(None)).alias("overlap")
    )


@query("fx_pairs", "fx_input_precision")
def queue_keys(pairs, ml_input):
    own = newest(ml_input, "sku").select(F.col("sku").alias("base_sku"), F.col("match_sku").alias("base_match"))
    rows = pairs.select("base_sku", "base_source_store", "comp_sku", "comp_source_store").distinct().join(own, "base_sku", "left")
    made = keys.queue_index_keys(
        *[F.col(c) for c in ("base_sku", "base_source_store", "comp_sku", "comp_source_store", "base_match")],
        F.lit(None).cast("string"),
    )
    return rows.select("base_sku", "comp_sku", *[c.alias(n) for n, c in made.items()])


@query("fx_tax_base")
def taxonomy_text(nodes):
    return nodes.select("*", text.taxonomy_text(*[F.col(c) for c in taxonomy.LEVELS]).alias("text"))


@query("fx_catalog")
def weighted_text(catalog):
    made = text.weighted_text(
        F.col("product_title"), F.col("product_description"), F.col("brand"), F.lit(None).cast("string"), F.col("category")
    )
    return catalog.select("sku", "capture_date", made.alias("text"))


@query("fx_docs")
def clean_tokens(docs):
    return docs.select("row_id", text.letter_tokens(F.col("q"), STOP_WORDS).alias("letters"), text.word_tokens(F.col("q")).alias("words"))


@query("fx_docs")
def ngrams(docs):
    return docs.select("row_id", text.ngrams(text.letter_tokens(F.col("q"), STOP_WORDS), 1, 2).alias("grams"))


@query("fx_docs")
def vocabulary(docs):
    counts = tfidf.term_counts(docs, "row_id", text.word_tokens(F.col("q")))
    return tfidf.vocabulary(counts, docs, 5000).select("term", "term_id", F.round("idf", 6).alias("idf"))


@query("fx_pairs", "fx_reviews")
def epoch_dates(pairs, reviews):
    day = F.col("inserted_date")
    return reviews.select(
        day.alias("day"), values.epoch_day(day).alias("match_date"), values.epoch_day(day, 21).alias("expiration_date"),
        values.is_iso_date(day).alias("iso"),
    ).distinct()


@query("fx_crawl")
def store_override(crawl):
    mapped = keys.remapped_store(F.col("source_name"), F.col("store_name"), keys.check_overrides({"r1": "main_main", " r9": "x_x"}))
    return crawl.select("source_name", "store_name", mapped.alias("store")).distinct()


@query("fx_pairs")
def enqueue_index(pairs):
    pair = keys.queue_pair_id(*[F.col(c) for c in ("base_sku", "base_source_store", "comp_sku", "comp_source_store")])
    return pairs.select(pair.alias("pair_id"), values.hash_index(pair).alias("at")).distinct()


@query("events")
def json_field(events):
    return events.select("event_id", values.json_field(F.col("props"), "$.k").alias("k"))


# --- row picking, snapshots and joins ----------------------------------------

@query("fx_catalog")
def latest_per_key(catalog):
    return relational.latest_row(catalog.select("sku", "source_store", "capture_date", "product_description"), ["sku", "source_store"], "capture_date")


@query("fx_warehouse")
def first_by_segment(warehouse):
    rows = warehouse.select("sku", "source_store", "product_segment", "product_title")
    return relational.first_row(rows, ["sku", "source_store"], [F.col("product_segment")])


@query("fx_library", "fx_reviews")
def priority_dedupe(library, reviews):
    both = training.labelled(library, reviews, TENANT, "1998-01-01", SINCE).select("pair_id", "source_priority", "answer")
    return relational.first_row(both, ["pair_id"], [F.col("source_priority")])


@query("fx_drop")
def best_per_base(drop):
    order = [F.col("score").try_cast("double").desc_nulls_last(), F.col("comp_source_store"), F.col("comp_sku")]
    return relational.first_row(drop, ["base_sku"], order)


@query("fx_pairs")
def dedupe_pairs(pairs):
    return relational.first_row(pairs, ["base_sku", "comp_sku", "base_source_store", "comp_source_store"])


@query("fx_library")
def latest_snapshot(library):
    """Live rows of the newest partition with rows of the tenant; older ones aren't opened."""
    spark = library.sparkSession
    stored = Workspace(spark, "library").save(library, "load_date")
    own = readers.latest_rows(spark, stored._pairloom_path, ["load_date"], F.col("company_code") == TENANT)
    return relational.live(own).select("base_sku", "comp_sku", "load_date", "match")


@query("fx_input_precision")
def latest_composite(ml_input):
    spark, parts = ml_input.sparkSession, ["year", "month", "day"]
    stored = Workspace(spark, "input").save(ml_input, *parts)
    newest = readers.latest_rows(spark, stored._pairloom_path, parts, F.col("segment") == SEGMENT)
    return newest.select("sku", "source_store", *parts)


@query("fx_library")
def latest_value(library):
    """Newest partition of the stored table by its folder names; only that one is scanned."""
    spark = library.sparkSession
    stored = Workspace(spark, "library").save(library.select("base_sku", "load_date"), "load_date")
    newest_date = readers.latest_partition_value(spark, stored._pairloom_path, "load_date")
    return relational.latest_value(stored.where(F.col("load_date") == F.lit(newest_date)), "load_date")


@query("fx_pairs", "fx_domains")
def stores_in_scope(pairs, domains):
    return relational.stores_in_scope(pairs, relational.competitor_stores(domains_of(domains), TENANT))


@query("fx_pairs", "fx_library")
def anti_store(pairs, library):
    matched = relational.live(relational.latest_snapshot(library, "load_date")).select("base_sku", "comp_source_store").distinct()
    hot = skew.hot_keys(pairs, ["base_sku"])
    return skew.join_spread(pairs, matched, ["base_sku", "comp_source_store"], "left_anti", hot)


@query("fx_pairs", "fx_library")
def anti_pair(pairs, library):
    on = ["base_sku", "comp_sku", "comp_source_store"]
    return pairs.join(library.select(*on).distinct(), on, "left_anti")


@query("fx_library", "fx_reviews")
def anti_pair_id(library, reviews):
    both = training.labelled(library, reviews, TENANT, "1998-01-01", SINCE)
    known = both.where("source_priority = 1").select("pair_id")
    return both.where("source_priority = 2").join(known, "pair_id", "left_anti").select("pair_id", "answer")


@query("fx_catalog", "fx_library")
def semi_keys(catalog, library):
    used = library.select(F.col("base_sku").alias("sku")).distinct()
    return catalog.join(used, "sku", "left_semi").select("sku", "capture_date")


@query("fx_tax_base", "fx_tax_base")
def anti_null_safe(nodes, others):
    return skew.anti_null_safe(nodes, others.where("category = 'SMALL'"), taxonomy.LEVELS)


@query("fx_pairs", "fx_warehouse")
def bridge_join(pairs, warehouse):
    sold = warehouse.select(
        F.lower("sku").alias("comp_sku"), keys.store_underscore(F.col("source_store")).alias("comp_source_store"), "product_title"
    )
    rows = pairs.select("comp_sku", "comp_source_store").distinct()
    return rows.join(sold, ["comp_sku", "comp_source_store"], "left")


@query("fx_drop", "fx_catalog")
def zero_join(drop, catalog):
    base = newest(catalog, "sku").select(keys.strip_zeros(F.lower("sku")).alias("k"), "product_title")
    rows = drop.select("base_sku", keys.strip_zeros(F.lower("base_sku")).alias("k")).distinct()
    return rows.join(base, "k").drop("k")


@query("fx_pairs", "fx_input_precision", "fx_catalog")
def fallback_join(pairs, ml_input, catalog):
    skus = pairs.select("base_sku").distinct()
    own = newest(ml_input, "sku").select(F.col("sku").alias("base_sku"), F.col("product_title").alias("own"))
    spare = catalog.select(F.lower("sku").alias("base_sku"), F.col("product_title").alias("spare"), "capture_date")
    rows = skew.attach_first(skus, own, ["base_sku"])
    rows = skew.attach_first(rows, spare, ["base_sku"], order=[F.col("capture_date").desc()])
    return rows.select("base_sku", values.fallback(F.col("own"), F.col("spare")).alias("title"))
