"""Text columns: blanks, tokens, n-grams and composed texts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Maximal runs of at least two letters, digits or underscores, in any script.
WORD = r"[\p{L}\p{N}_]{2,}"
# The English stop words of Spark ML, the default of the similarity scores.
ENGLISH_STOP_WORDS = tuple("""
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
herself it its itself they them their theirs themselves what which who whom this that these those am is are
was were be been being have has had having do does did doing a an the and but if or because as until while of
at by for with about against between into through during before after above below to from up down in out on
off over under again further then once here there when where why how all any both each few more most other
some such no nor not only own same so than too very s t can will just don should now i'll you'll he'll she'll
we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't
mustn't can't couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
would
""".split())


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value`` computed once per row.

    An expression inside a lambda is evaluated per element, so a costly array
    is passed in as a lambda variable instead.
    """
    return F.get(F.transform(F.array(value), body), 0)


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def not_blank(text: Column) -> Column:
    return F.trim(F.coalesce(text, F.lit(""))) != ""


def first_of_list(text: Column) -> Column:
    return F.split_part(text, F.lit(","), F.lit(1))


def upc_overlap(base: Column, *others: Column) -> Column:
    """True if ``base`` equals any other UPC, leading zeros ignored; null counts as false."""
    from .keys import strip_zeros

    hits = [F.coalesce(strip_zeros(base) == strip_zeros(o), F.lit(False)) for o in others]
    result = hits[0]
    for hit in hits[1:]:
        result = result | hit
    return result


def stop_words_or_english(words: Sequence[str] | None) -> list[str]:
    """``words``, or the English list for None."""
    return list(ENGLISH_STOP_WORDS if words is None else words)


def letter_tokens(text: Column, stop_words: Sequence[str] = ()) -> Column:
    """Lower-case runs of ``a-z``, stop words removed."""
    words = F.split(F.trim(F.regexp_replace(F.lower(text), "[^a-z]+", " ")), " ")
    return _without(words, ["", *stop_words])


def word_tokens(text: Column, stop_words: Sequence[str] = ()) -> Column:
    """Lower-case words of two or more characters, stop words removed."""
    words = F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
    return _without(words, stop_words)


def _without(words: Column, unwanted: Sequence[str]) -> Column:
    if not unwanted:
        return words
    return F.filter(words, lambda w: ~w.isin(list(unwanted)))


def ngrams(tokens: Column, low: int = 1, high: int = 2) -> Column:
    """All n-grams for ``low <= n <= high``, shorter ones first."""
    def of_size(words: Column, n: int) -> Column:
        if n == 1:
            return words
        starts = F.sequence(F.lit(1), F.size(words) - (n - 1))
        grams = F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))
        return F.when(F.size(words) >= n, grams).otherwise(F.array().cast("array<string>"))

    return bound(tokens, lambda words: F.concat(*[of_size(words, n) for n in range(low, high + 1)]))


def taxonomy_text(*levels: Column) -> Column:
    """Non-blank levels joined by a space."""
    return F.concat_ws(" ", *[blank_to_null(level) for level in levels])


def weighted_text(
    base_title: Column, comp_title: Column, base_brand: Column, comp_brand: Column,
    taxonomy: Column, brand_weight: int = 3, taxonomy_weight: int = 2,
) -> Column:
    """Titles once, brands and taxonomy repeated by their weight; blanks add nothing."""
    def times(value: Column, n: int) -> Column:
        return F.array_repeat(F.nullif(value, F.lit("")), n)

    return F.concat_ws(
        " ",
        F.array(F.coalesce(base_title, F.lit("")), F.coalesce(comp_title, F.lit(""))),
        times(base_brand, brand_weight),
        times(comp_brand, brand_weight),
        times(taxonomy, taxonomy_weight),
    )
