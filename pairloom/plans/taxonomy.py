"""Mapping one retailer's taxonomy onto its competitors', in full or incrementally."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys as K
from ..functions import text as X
from ..functions import values as V
from ..operators import relational as R
from ..operators import scorers, skew, tfidf
from ..operators.blocks import scored_above
from ..session import cut_lineage
from ..sources import versions

LEVELS = ["category", "subcategory", "sub_subcategory"]
BASE = [f"base_{level}" for level in LEVELS]
COMP = [f"comp_{level}" for level in LEVELS]
PAIR_KEYS = [*BASE, "retailer", *COMP]
MAPPING_COLUMNS = [*PAIR_KEYS, "bert_similarity", "tfidf_similarity", "combined_score", "rank"]

Embeddings = DataFrame | Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class MappingConfig:
    threshold: float = 0.5
    embedding_weight: float = 0.7
    tfidf_weight: float = 0.3
    stop_words: Sequence[str] | None = None
    lemmas: DataFrame | None = None
    max_features: int = 5000
    fit_on: str = "new"
    prune_vanished: bool = False

    @property
    def weights(self) -> tuple[float, float]:
        return self.embedding_weight, self.tfidf_weight


def base_nodes(catalog: DataFrame, tenant: str) -> DataFrame:
    """Distinct taxonomy nodes of the tenant's newest catalog snapshot."""
    own = R.latest_snapshot(catalog.where(F.col("source") == tenant), "capture_date")
    return own.select(*LEVELS).distinct()


def comp_nodes(warehouse: DataFrame, competitors: Sequence[str]) -> DataFrame:
    """Distinct taxonomy nodes of each competitor."""
    stores = K.store_names(list(competitors), K.BRACKET)
    rows = warehouse.where(F.col("source_store").isin(stores))
    return rows.select(K.retailer_of(F.col("source_store")).alias("retailer"), *LEVELS).distinct()


def _named(nodes: DataFrame, side: str) -> DataFrame:
    keys = [F.col(level).alias(f"{side}_{level}") for level in LEVELS]
    rest = ["retailer"] if side == "comp" else []
    return nodes.select(*rest, *keys, X.taxonomy_text(*[F.col(c) for c in LEVELS]).alias(f"{side}_text")).distinct()


def _texts(*sides: DataFrame) -> DataFrame:
    """Distinct texts of the given node frames, as ``title``."""
    found = None
    for side in sides:
        name = next(c for c in side.columns if c.endswith("_text"))
        texts = side.select(F.col(name).alias("title"))
        found = texts if found is None else found.union(texts)
    return found.distinct()


def _vectors(texts: DataFrame, fit_texts: DataFrame, embeddings: Embeddings, c: MappingConfig) -> DataFrame:
    """(text, embedding, ids, weights); the TF-IDF vocabulary comes from ``fit_texts``."""
    stop_words = X.stop_words_or_english(c.stop_words)
    if c.lemmas is None:
        def counts_of(df: DataFrame) -> DataFrame:
            return tfidf.term_counts(df, "title", scorers.title_terms(stop_words))
    else:
        def counts_of(df: DataFrame) -> DataFrame:
            words = F.filter("words", lambda w: (F.length(w) >= 2) & ~w.isin([*stop_words, ""]))
            return tfidf.term_counts(scorers.lemmatised(df, c.lemmas, stop_words), "title", X.ngrams(words))

    vocab = tfidf.vocabulary(counts_of(fit_texts), fit_texts, c.max_features)
    sparse = tfidf.unit_vectors(counts_of(texts), vocab, "title")
    dense = embeddings(texts) if callable(embeddings) else embeddings
    return (
        texts.join(dense.select("title", "embedding"), "title", "left")
        .join(sparse, "title", "left")
        .withColumnRenamed("title", "text")
    )


def _scored(base: DataFrame, comp: DataFrame, fit_texts: DataFrame, embeddings: Embeddings, c: MappingConfig) -> DataFrame:
    """Node pairs at or above the threshold, with their three scores.

    Each distinct text is scored once; node pairs are put together only for
    text pairs that pass, so the product of all nodes is never formed.
    """
    vectors = cut_lineage(_vectors(_texts(base, comp), fit_texts, embeddings, c))
    base_vectors = vectors.join(base.select(F.col("base_text").alias("text")).distinct(), "text", "left_semi")
    comp_vectors = vectors.join(comp.select(F.col("comp_text").alias("text")).distinct(), "text", "left_semi")
    pairs = scored_above(base_vectors, comp_vectors, c.threshold, c.weights)
    passed = pairs.select(
        "base_text", "comp_text",
        F.col("embedding_similarity").alias("bert_similarity"),
        F.bround("tfidf_similarity", 4).alias("tfidf_similarity"),
    ).withColumn(
        "combined_score", V.combined_score(F.col("bert_similarity"), F.col("tfidf_similarity"), c.weights)
    ).where(F.col("combined_score") >= c.threshold)
    return passed.join(base, "base_text").join(comp, "comp_text").drop("base_text", "comp_text")


def _rank(rows: DataFrame) -> DataFrame:
    """Position by score within each base node and retailer, from 1 without gaps."""
    by_score = [F.col("combined_score").desc(), *[F.col(k).asc_nulls_last() for k in COMP]]
    return R.ranked(rows, [*BASE, "retailer"], by_score).select(*MAPPING_COLUMNS)


def map_taxonomy(base: DataFrame, comp: DataFrame, embeddings: Embeddings, config: MappingConfig) -> DataFrame:
    """Score all base nodes against all competitor nodes, keep and rank the good ones.

    ``base`` has the three levels, ``comp`` also ``retailer``; ``embeddings`` is
    a (title, embedding) table or a function of the distinct texts.
    """
    base, comp = cut_lineage(_named(base, "base")), cut_lineage(_named(comp, "comp"))
    return _rank(_scored(base, comp, _texts(base, comp), embeddings, config))


def map_taxonomy_incremental(
    base: DataFrame, comp: DataFrame, previous: DataFrame, competitors: Sequence[str], embeddings: Embeddings,
    config: MappingConfig, compared: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Keep earlier scores, add pairs not stored yet, rank everything again.

    Rows of retailers no longer in ``competitors`` go. Earlier rows keep their
    scores. Only nodes with a partner they are not stored with are scored, since
    a pair that isn't stored has two such nodes; that includes pairs which fell
    below the threshold before. ``compared`` (base and comp nodes of the earlier
    runs, shaped like ``base`` and ``comp``; see `MappingStore`) says that those
    are settled: then only new base nodes meet all, and the others new comp nodes,
    so an unchanged input scores nothing. If they have a ``version``, a node whose
    embedding has changed since is new, and its earlier rows go. ``fit_on='new'``
    fits TF-IDF on the nodes that occur in a pair to be scored, ``'all'`` on every
    node. Levels may be null, and null equals null. The threshold applies to
    earlier rows too. ``prune_vanished`` also drops rows whose base node is gone.
    """
    if config.fit_on not in ("new", "all"):
        raise ValueError("fit_on must be 'new' or 'all'")
    comp_keys = ["retailer", *COMP]
    base, comp = cut_lineage(_named(base, "base")), cut_lineage(_named(comp, "comp"))
    kept = previous.where(F.col("retailer").isin(list(competitors))).drop("rank")
    if config.prune_vanished:
        current = base.select(*[F.col(k).alias(f"_r_{k}") for k in BASE])
        kept = kept.join(current, R.null_safe(BASE), "left_semi")
    if compared is None:
        left, right = (cut_lineage(nodes) for nodes in _unfinished(base, comp, kept))
        meetings = [(left, right)]
    else:
        new_base, old_base, changed_base = _split(base, compared[0], "base", BASE, embeddings)
        new_comp, _, changed_comp = _split(comp, compared[1], "comp", comp_keys, embeddings)
        kept = skew.anti_null_safe(skew.anti_null_safe(kept, changed_base, BASE), changed_comp, comp_keys)
        meetings = [(new_base, comp), (old_base, new_comp)]
    meetings = [(left, right) for left, right in meetings if not left.isEmpty() and not right.isEmpty()]
    rows = kept.where(F.col("combined_score") >= config.threshold)
    if meetings:
        every = [(base, comp)] if config.fit_on == "all" else meetings
        fit_texts = _texts(*[side for meeting in every for side in meeting])
        for left, right in meetings:
            fresh = skew.anti_null_safe(_scored(left, right, fit_texts, embeddings, config), kept, PAIR_KEYS)
            rows = rows.unionByName(fresh.select(*kept.columns))
    return _rank(rows)


def with_versions(nodes: DataFrame, embeddings: Embeddings, text: Column | None = None) -> DataFrame:
    """``nodes`` with ``version``, a hash of the embedding of their text; null if there is none or it is computed."""
    if callable(embeddings):
        return nodes.withColumn("version", F.lit(None).cast("long"))
    hashed = embeddings.select(F.col("title").alias("_title"), F.xxhash64("embedding").alias("version")).dropDuplicates(["_title"])
    text = X.taxonomy_text(*[F.col(c) for c in LEVELS]) if text is None else text
    return nodes.withColumn("_title", text).join(hashed, "_title", "left").drop("_title")


def _split(
    nodes: DataFrame, known: DataFrame, side: str, keys: list[str], embeddings: Embeddings
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The nodes that are not ``known`` in their present version, those that are, and the keys of the changed ones."""
    versioned = "version" in known.columns
    then = F.col("version") if versioned else F.lit(None).cast("long")
    before = known.select(*[F.col(k.removeprefix(f"{side}_")).alias(f"_r_{k}") for k in keys], then.alias("_then")).distinct()
    now = with_versions(nodes, embeddings, F.col(f"{side}_text")) if versioned else nodes.withColumn("version", F.lit(None).cast("long"))
    met = now.join(before.withColumn("_known", F.lit(True)), R.null_safe(keys), "left")
    state = F.when(F.col("_known").isNull(), "new").when(F.col("version").eqNullSafe(F.col("_then")), "old").otherwise("changed")
    marked = cut_lineage(met.select(*nodes.columns, state.alias("_state")))
    fresh, old = marked.where("_state <> 'old'").drop("_state"), marked.where("_state = 'old'").drop("_state")
    return fresh, old, marked.where("_state = 'changed'").select(*keys)


class MappingStore:
    """A mapping and the versions of the nodes it compared, on shared files; one manifest commits both."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def newest(self) -> tuple[DataFrame, DataFrame, DataFrame] | None:
        """Mapping, base nodes and comp nodes (with ``version``) of the newest version, None before the first."""
        found = versions.newest(self.spark, self.path)
        if found is None:
            return None
        return tuple(self.spark.read.parquet(f"{self.path}/{found[1]['data']}/{name}") for name in ("mapping", "base", "comp"))

    def commit(self, mapping: DataFrame, base: DataFrame, comp: DataFrame, embeddings: Embeddings) -> int:
        """Write a mapping with the nodes that it rests on; returns the version.

        Nodes compared earlier stay known, in their newest version, so a node that
        comes back isn't compared again.
        """
        data, before = f"data/{uuid.uuid4().hex}", self.newest()
        mapping.write.parquet(f"{self.path}/{data}/mapping")
        for at, (name, nodes) in enumerate((("base", base), ("comp", comp)), 1):
            columns = LEVELS if name == "base" else ["retailer", *LEVELS]
            known = with_versions(nodes.select(*columns).distinct(), embeddings).select(*columns, "version")
            if before is not None:
                known = known.unionByName(skew.anti_null_safe(before[at], known, columns))
            known.write.parquet(f"{self.path}/{data}/{name}")
        return versions.commit(self.spark, self.path, lambda _: {"data": data})


def update_mapping(
    base: DataFrame, comp: DataFrame, competitors: Sequence[str], embeddings: Embeddings, config: MappingConfig, store: MappingStore
) -> DataFrame:
    """The mapping of ``base`` and ``comp`` by what ``store`` knows, committed there and read back.

    Without an earlier version everything is compared; later only pairs with a
    node that the store doesn't know in its present version.
    """
    found = store.newest()
    if found is None:
        mapping = map_taxonomy(base, comp, embeddings, config)
    else:
        previous, *compared = found
        mapping = map_taxonomy_incremental(base, comp, previous, competitors, embeddings, config, tuple(compared))
    store.commit(mapping, base, comp, embeddings)
    return store.newest()[0]


def _unfinished(base: DataFrame, comp: DataFrame, kept: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Base and comp nodes with at least one partner they are not stored with.

    Such a node has fewer stored pairs than there are nodes on the other side,
    so counting the stored pairs is enough.
    """
    def current(pairs: DataFrame, nodes: DataFrame, keys: list[str]) -> DataFrame:
        return pairs.join(nodes.select(*[F.col(k).alias(f"_r_{k}") for k in keys]), R.null_safe(keys), "left_semi")

    comp_keys = ["retailer", *COMP]
    stored = current(current(kept.select(*PAIR_KEYS).distinct(), base, BASE), comp, comp_keys)

    def unfinished(nodes: DataFrame, keys: list[str], partners: DataFrame) -> DataFrame:
        counts = stored.groupBy(*[F.col(k).alias(f"_r_{k}") for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
        every = partners.select(F.count(F.lit(1))).scalar()
        open_ = nodes.join(counts, R.null_safe(keys), "left").where(F.coalesce("_n", F.lit(0)) < every)
        return open_.select(*nodes.columns)

    return unfinished(base, BASE, comp), unfinished(comp, comp_keys, base)
