"""Column functions on hand-made values."""

import datetime

import pytest
from pyspark.sql import functions as F

from pairloom.functions import keys as K
from pairloom.functions import text as X
from pairloom.functions import values as V


def column(spark, values, build, ddl="x string"):
    """Values of ``build(x)`` in input order."""
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {ddl}").select("i", build(F.col("x")).alias("y"))
    return [r["y"] for r in rows.orderBy("i").collect()]


def test_strip_zeros(spark):
    assert column(spark, ["007", "000", "0A0", None], K.strip_zeros) == ["7", "", "A0", None]


def test_canonical_uuid(spark):
    ids = ["a", "a<>b", "a<>b<>c", "u<>a<>b<>c", "x<>u<>a<>b<>c", "", None]
    assert column(spark, ids, K.canonical_uuid) == ["a", "a<>b", "a<>b<>c", "a<>b<>c", "a<>b<>c", "", None]
    assert column(spark, ids[2:4], K.uuid_sku) == ["a", "a"]
    assert column(spark, ids[2:4], lambda c: K.uuid_sku(c, canonical=False)) == ["a", "u"]
    assert column(spark, ids[2:4], K.uuid_store) == ["b<>c", "b<>c"]
    assert column(spark, ids[3:4] + ["a"], K.prefixed_store) == ["b<>c", None]


def test_store_forms(spark):
    assert column(spark, ["r_r", "r<>r"], K.store_bracket) == ["r<>r", "r<>r"]
    assert column(spark, ["r_r", "r<>r"], K.store_underscore) == ["r_r", "r_r"]
    assert column(spark, ["r_s", "r<>s"], K.retailer_of) == ["r", "r"]


def test_pair_ids_and_nulls(spark):
    df = spark.createDataFrame([("1", "a_a", "2", "b_b"), ("1", "a_a", None, "b_b")], "b string, bs string, c string, cs string")
    cols = [F.col(x) for x in ("b", "bs", "c", "cs")]
    rows = df.select(K.training_pair_id(*cols), K.queue_pair_id(*cols)).collect()
    assert tuple(rows[0]) == ("1<>a<>a<>2<>b<>b", "1_a_a<>2_b_b")
    assert tuple(rows[1]) == ("1<>a<>a<>b<>b", None)


def test_overrides(spark):
    assert K.check_overrides({" north ": "north_main", "south": " main_south "}) == {"north": "north_main", "south": "main_south"}
    for bad in ({"north": ""}, {"": "a_b"}, {"north": "main"}, {"north": None}):
        with pytest.raises(ValueError):
            K.check_overrides(bad)
    remap = lambda c: K.remapped_store(c, F.lit("S"), {"north": "x_x"})
    assert column(spark, ["north", "Other"], remap) == ["x_x", "other_s"]


def test_price_number_and_gate(spark):
    texts = ["nan", "", "$5", " 12 ", "1.0d", "0", "-3", None, "NaN", "1e2", ".5"]
    assert column(spark, texts, V.price_number) == [None, None, None, 12.0, None, 0.0, -3.0, None, None, 100.0, 0.5]
    gate = lambda c: V.price_gate(c, F.lit("10"), 0.8)
    assert column(spark, texts, gate) == [False, False, False, True, False, False, False, False, False, False, False]
    strict = lambda c: V.price_gate(c, F.lit("10"), 0.8, strict=True)
    assert column(spark, ["-3", "0"], strict) == [True, False]


def test_fallback_and_blank(spark):
    assert column(spark, ["", None, "a", " "], lambda c: V.fallback(c, F.lit("z"))) == ["z", "z", "a", " "]
    assert column(spark, ["", None, "a", " "], X.blank_to_null) == [None, None, "a", None]
    assert column(spark, ["", None, "a", " "], X.not_blank) == [False, False, True, False]


def test_upc_overlap(spark):
    assert column(spark, ["0012", "12", "3", None], lambda c: X.upc_overlap(c, F.lit("012"), F.lit(None))) == [True, True, False, False]


def test_tokens_and_ngrams(spark):
    assert column(spark, ["The Cat-2 sat!"], lambda c: X.letter_tokens(c, ["the"])) == [["cat", "sat"]]
    assert column(spark, ["Über a b2 x_y 'é"], X.word_tokens) == [["über", "b2", "x_y"]]
    assert column(spark, ["a b c", "a", ""], lambda c: X.ngrams(X.letter_tokens(c))) == [["a", "b", "c", "a b", "b c"], ["a"], []]
    assert column(spark, ["a b c d"], lambda c: X.ngrams(X.letter_tokens(c), 2, 3)) == [["a b", "b c", "c d", "a b c", "b c d"]]
    words = X.stop_words_or_english(None)
    assert len(words) == len(set(words)) == 181 and words[0] == "i" and words[-1] == "would" and "isn't" in words
    assert X.stop_words_or_english(["a"]) == ["a"]


def test_texts(spark):
    assert column(spark, ["a", None, " "], lambda c: X.taxonomy_text(c, F.lit(" b "))) == ["a b", "b", "b"]
    made = lambda c: X.weighted_text(F.lit("t"), F.lit("u"), c, F.lit(None).cast("string"), F.lit("k"))
    assert column(spark, ["b", None, ""], made) == ["t u b b b k k", "t u k k", "t u k k"]


def test_dates_and_index(spark):
    assert column(spark, ["1970-01-02"], V.epoch_day) == [86400]
    assert column(spark, ["1970-01-02"], lambda c: V.epoch_day(c, 2)) == [3 * 86400]
    assert column(spark, ["2024-01-31", "2024-1-3"], V.is_iso_date) == [True, False]
    assert V.split_iso_date("2024-01-31") == ("2024", "01", "31")
    with pytest.raises(ValueError):
        V.split_iso_date("2024-13-01")
    first, second = (column(spark, ["a", "b"], V.hash_index) for _ in range(2))
    assert first == second and all(10000 <= v <= 99999 for v in first)
    assert all(10000 <= v <= 99999 for v in column(spark, ["a"] * 50, lambda c: V.random_index(seed=1)))


def test_scores(spark):
    df = spark.createDataFrame([([1.0, 2.0], [3.0, 4.0]), (None, [1.0, 1.0])], "a array<float>, b array<float>")
    assert [r[0] for r in df.select(V.dot(F.col("a"), F.col("b"))).collect()] == [11.0, None]
    assert column(spark, [0.5], lambda c: V.combined_score(c, F.lit(0.25)), "x double") == [0.425]
    assert column(spark, ['{"cadence": "daily"}'], lambda c: V.json_field(c, "$.cadence")) == ["daily"]


def test_today_is_utc_midnight(spark):
    day = spark.range(1).select(V.epoch_day(F.current_date())).first()[0]
    assert day % 86400 == 0 and abs(day - datetime.datetime.now(datetime.UTC).timestamp()) < 2 * 86400
