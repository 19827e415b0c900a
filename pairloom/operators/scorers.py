"""Similarity scorers over pairs of titles.

Titles are looked up in a dictionary of 64-bit ids, made once; from then on only
ids, counts and vectors are shuffled. A scorer takes the distinct pairs of ids and
the dictionary and adds one score column, so each pair is scored once however many
rows it stands for.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import values as V
from ..session import cut_lineage
from . import skew, tfidf

SIDES = ("base_title", "comp_title")
IDS = ("_base_id", "_comp_id")
# With 64 bits even 10**9 titles rarely need a second try.
TRIES = 8


@dataclass(frozen=True)
class Titles:
    """Every title once: ``table`` has title_id, check and title.

    ``title_id`` is a hash of the title under ``salt`` that no other title of the
    table has; ``check`` is a second hash, which tells titles from elsewhere apart.
    """

    table: DataFrame
    salt: int

    def id(self, title: Column) -> Column:
        """Null for a null title."""
        return _hashed(title, self.salt)

    def keyed(self, rows: DataFrame, title: str = "title") -> DataFrame:
        """``rows`` of titles in the table, with title_id in the place of the title."""
        named = rows.withColumns({"title_id": self.id(F.col(title)), "check": _hashed(F.col(title), ~self.salt)}).drop(title)
        return named.join(self.table.select("title_id", "check"), ["title_id", "check"], "left_semi").drop("check")


Scorer = Callable[[DataFrame, Titles], DataFrame]


def _hashed(title: Column, salt: int) -> Column:
    return F.when(title.isNotNull(), F.xxhash64(F.lit(salt), title))


def dictionary(rows: DataFrame) -> Titles:
    """The titles of both sides of ``rows``; ids that two titles would share are avoided by another salt."""
    each = rows.select(F.explode(F.array(*SIDES)).alias("title")).where(F.col("title").isNotNull())
    for salt in range(TRIES):
        named = each.select(_hashed(F.col("title"), salt).alias("title_id"), _hashed(F.col("title"), ~salt).alias("check"), "title")
        table = cut_lineage(named.groupBy("title_id").agg(
            F.min("check").alias("check"), F.max("check").alias("_other"), F.any_value("title").alias("title")
        ))
        if table.where(F.col("check") != F.col("_other")).isEmpty():
            return Titles(table.drop("_other"), salt)
    raise RuntimeError(f"titles share ids under {TRIES} salts")


def run_scorers(rows: DataFrame, scorers: Sequence[Scorer], hot_parts: int | None = None) -> DataFrame:
    """``rows`` with one column per scorer.

    Rows, titles and distinct pairs are checkpointed, because the scorers read them
    several times, and the scores are joined back by ids in one go; title pairs
    that stand for a large share of the rows are spread.
    """
    rows = cut_lineage(rows)
    titles = dictionary(rows)
    keyed = rows.withColumns({i: titles.id(F.col(s)) for i, s in zip(IDS, SIDES, strict=True)})
    pairs = cut_lineage(keyed.groupBy(*IDS).agg(F.count(F.lit(1)).alias("n")))
    hot = skew.hot_keys(pairs, IDS, hot_parts, weight="n")
    scored = reduce(lambda df, scorer: scorer(df, titles), scorers, pairs).drop("n")
    return skew.join_spread(keyed, scored, IDS, "left", hot, rows.columns).drop(*IDS)


def title_terms(stop_words: Sequence[str] = (), grams: tuple[int, int] = (1, 2)) -> Column:
    """n-grams of a ``title`` column: letters only, two or more per word, no stop words."""
    words = F.filter(X.letter_tokens(F.col("title"), stop_words), lambda w: F.length(w) >= 2)
    return X.ngrams(words, *grams)


def lemmatised(titles: DataFrame, lemmas: DataFrame, stop_words: Sequence[str] = (), key: str = "title") -> DataFrame:
    """(key, words): the tokens of ``title`` replaced through a (word, lemma) table, order kept.

    Words are counted first, and only those of the titles are looked up, each once.
    The frequent ones, more than a task's even share, are fewer than there are
    tasks and are broadcast, so their occurrences aren't shuffled to be replaced.
    """
    parts = int(titles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = titles.select(key, F.posexplode_outer(X.letter_tokens(F.col("title"), stop_words)).alias("at", "word"))
    counted = words.where(F.col("word").isNotNull()).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    known = cut_lineage(counted.join(lemmas.select("word", "lemma").dropDuplicates(["word"]), "word").where(F.col("lemma").isNotNull()))
    frequent = F.col("n") * parts > (known.agg(F.sum("n")).first()[0] or 0)
    first = words.join(F.broadcast(known.where(frequent).drop("n")), "word", "left")
    rare = first.where(F.col("lemma").isNull()).drop("lemma").join(known.where(~frequent).drop("n"), "word", "left")
    looked_up = first.where(F.col("lemma").isNotNull()).unionByName(rare)
    at_word = F.struct("at", F.coalesce("lemma", "word").alias("word"))
    grouped = looked_up.groupBy(key).agg(F.array_sort(F.collect_list(at_word)).alias("w"))
    return grouped.select(key, F.col("w.word").alias("words"))


def _score(pairs: DataFrame, vectors: DataFrame, name: str, score: Column, hot_parts: int | None) -> DataFrame:
    """Attach ``vectors`` (title_id, ...) to both sides of each pair and score.

    ``score`` refers to the vector columns as ``base_*`` and ``comp_*``. Titles
    that occur in a large share of the pairs are spread.
    """
    scored = pairs
    hot = skew.hot_key_sets(pairs, [[i] for i in IDS], hot_parts)
    for side, own in zip(IDS, hot, strict=True):
        prefix = side.removesuffix("_id")
        named = vectors.select(
            F.col("title_id").alias(side), *[F.col(c).alias(f"{prefix}_{c}") for c in vectors.columns if c != "title_id"],
        )
        scored = skew.join_spread(scored, named, [side], "left", own, IDS)
    return scored.select(*pairs.columns, score.alias(name))


def embedding_scorer(
    embeddings: DataFrame | Callable[[DataFrame], DataFrame], name: str = "bert_similarity",
    hot_parts: int | None = None,
) -> Scorer:
    """Dot product of unit embeddings; null when a title has none.

    ``embeddings`` is a (title, embedding) table, unique by title, or a function
    that computes one from the distinct titles.
    """
    def score(pairs: DataFrame, titles: Titles) -> DataFrame:
        table = embeddings(titles.table.select("title")) if callable(embeddings) else embeddings
        # Computed embeddings are costly, and all are read twice.
        vectors = cut_lineage(titles.keyed(table.select("title", "embedding")))
        return _score(pairs, vectors, name, V.dot(F.col("_base_embedding"), F.col("_comp_embedding")), hot_parts)
    return score


def tfidf_scorer(
    stop_words: Sequence[str] | None = None, lemmas: DataFrame | None = None, max_features: int = 5000,
    grams: tuple[int, int] = (1, 2), digits: int = 3, name: str = "tfidf_similarity",
    hot_parts: int | None = None,
) -> Scorer:
    """TF-IDF cosine, fitted on all distinct titles; 0 when no known term is shared.

    ``stop_words`` None stands for the English list.
    """
    def score(pairs: DataFrame, titles: Titles) -> DataFrame:
        left_out = X.stop_words_or_english(stop_words)
        if lemmas is None:
            counts = tfidf.row_counts(titles.table, "title_id", title_terms(left_out, grams))
        else:
            words = F.filter("words", lambda w: (F.length(w) >= 2) & ~w.isin([*left_out, ""]))
            counts = tfidf.row_counts(lemmatised(titles.table, lemmas, left_out, "title_id"), "title_id", X.ngrams(words, *grams))
        counts = cut_lineage(counts)
        vectors = cut_lineage(tfidf.unit_vectors(counts, tfidf.vocabulary(counts, titles.table, max_features), "title_id"))
        overlap = tfidf.sparse_dot(*[F.col(f"_{s}_{c}") for s in ("base", "comp") for c in ("ids", "weights")])
        return _score(pairs, vectors, name, F.bround(overlap, digits), hot_parts)
    return score
