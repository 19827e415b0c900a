"""Nearest labelled examples by TF-IDF cosine."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import inverted, tfidf
from ..session import Workspace, cut_lineage

# What an example must have, and the taxonomy column of each level.
REQUIRED = ["base_title", "comp_title", "match_norm", "base_brand", "comp_brand", "base_category", "base_subcategory"]
LEVELS = {"category": "base_category", "segment": "base_subcategory"}


@dataclass(frozen=True)
class Retriever:
    """An index: vocabulary, inverted lists on shared files, and the example rows."""

    vocab: DataFrame
    lists: inverted.InvertedIndex
    rows: DataFrame
    level: str


def validate_examples(examples: DataFrame, labels: list[str]) -> DataFrame:
    """``examples`` unchanged; raises on missing columns, no rows or unknown labels."""
    missing = [c for c in REQUIRED if c not in examples.columns]
    if missing:
        raise ValueError(f"examples lack the columns {missing}")
    totals = examples.select(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(F.coalesce(F.col("match_norm").isin(labels), F.lit(False)), 0).otherwise(1)).alias("bad"),
        F.min(F.when(~F.col("match_norm").isin(labels), F.col("match_norm"))).alias("example"),
    ).first()
    if not totals["n"]:
        raise ValueError("no examples to build a retriever from")
    if totals["bad"]:
        raise ValueError(f"{totals['bad']} examples have an unknown label, such as {totals['example']!r}")
    return examples


def example_text(level: str, brand_weight: int = 3, taxonomy_weight: int = 2):
    """Weighted text of an example; ``level`` picks the taxonomy column."""
    return X.weighted_text(
        F.col("base_title"), F.col("comp_title"), F.col("base_brand"), F.col("comp_brand"),
        F.col(LEVELS[level]), brand_weight, taxonomy_weight,
    )


def with_row_id(examples: DataFrame) -> DataFrame:
    """Add a ``row_id`` made of the pair's keys, so ids do not depend on row order."""
    keys = ["base_sku", "base_source_store", "comp_sku", "comp_source_store"]
    return examples.withColumn("row_id", F.concat_ws("<>", *[F.coalesce(F.col(k), F.lit("")) for k in keys]))


def build_index(docs: DataFrame, level: str = "text", max_features: int = 50_000, path: str | None = None) -> Retriever:
    """Index of ``docs`` with unique ``row_id`` and text ``q``: unigrams, sublinear tf, no stop words.

    The inverted lists are written below ``path`` (by default in the session's
    shared folder) and stay there for every later query.
    """
    texts = docs.select("row_id", "q")
    with Workspace(docs.sparkSession, "vectors") as tables:
        # Read for repeated ids, for the vocabulary and for the vectors.
        listed = tables.save(tfidf.term_lists(texts, "row_id", X.word_tokens(F.col("q"))))
        lists = tfidf.merged_lists(listed, "row_id")
        vocab = cut_lineage(tfidf.list_vocabulary(lists, texts, max_features))
        vectors = tables.save(tfidf.list_vectors(lists, vocab, "row_id", sublinear=True))
        tables.drop(listed)
        return Retriever(vocab, inverted.write_index(vectors, path), docs, level)


def build_retriever(
    examples: DataFrame, level: str, brand_weight: int = 3, taxonomy_weight: int = 2, max_features: int = 50_000,
    labels: Sequence[str] | None = None,
) -> Retriever:
    """Index of combined examples at one taxonomy level.

    With ``labels`` the examples are validated first and the finished index has
    to find one of its own rows.
    """
    docs = cut_lineage(with_row_id(examples).withColumn("q", example_text(level, brand_weight, taxonomy_weight)))
    if labels is not None:
        validate_examples(docs, list(labels))
    index = build_index(docs, level, max_features)
    if labels is not None:
        self_check(index)
    return index


def query(retriever: Retriever, texts: DataFrame, k: int = 20, pad: bool = True) -> DataFrame:
    """Nearest rows for each text of (query_id, q): (query_id, row_id, score, rank).

    With ``pad`` every query gets ``k`` rows if there are as many, the last ones
    with score 0 if need be. Rows of the index aren't shuffled.
    """
    counts = tfidf.term_counts(texts, "query_id", X.word_tokens(F.col("q")))
    known = tfidf.unit_vectors(counts, retriever.vocab, "query_id", sublinear=True)
    found = inverted.search(retriever.lists, known, k)
    return inverted.padded(found, texts, retriever.rows, k) if pad else found


def self_check(retriever: Retriever) -> str:
    """Ask the index for the text of one of its rows; returns that row's id, raises if it isn't the best.

    The row with the smallest id among those with a known term is asked for;
    rows that score the same count as found.
    """
    known = retriever.lists.lists.where("term_id < 0").agg(F.min(F.array_min("keys"))).first()[0]
    if known is None:
        raise RuntimeError("no row of the index has a known term")
    text = retriever.rows.where(F.col("row_id") == known).select(F.lit(0).alias("query_id"), "q").limit(1)
    found = query(retriever, text, k=1).first()
    if found is None or found["row_id"] != known and found["score"] < 1 - 1e-6:
        raise RuntimeError(f"the index doesn't find its row {known!r} by that row's text")
    return known
