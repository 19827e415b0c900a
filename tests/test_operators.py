"""Operators against brute force, with and without hot keys."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import workload
from fixtures import fixture
from pairloom.functions import text as X
from pairloom.operators import blocks, embed, relational as R, scorers, skew, tfidf
from pairloom.plans import taxonomy
from pairloom.session import cut_lineage


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns or df.columns).collect())


def test_first_row_is_deterministic_and_null_last(spark):
    df = spark.createDataFrame(
        [("a", None, 1), ("a", "2024-01-02", 3), ("a", "2024-01-02", 2), ("b", None, 9)], "k string, d string, v int"
    )
    assert rows(R.latest_row(df, ["k"], "d")) == [("a", "2024-01-02", 2), ("b", None, 9)]
    assert rows(R.latest_row(df.repartition(5), ["k"], "d")) == [("a", "2024-01-02", 2), ("b", None, 9)]


def test_top_rows_and_ranks(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    assert rows(R.top_rows(df, ["k"], [F.col("v").desc()], 2)) == [(0, 6, 2), (0, 8, 1), (1, 7, 2), (1, 9, 1)]
    ranks = R.ranked(df, ["k"], [F.col("v")]).groupBy("k").agg(F.sort_array(F.collect_list("rank")).alias("r"))
    assert all(r["r"] == [1, 2, 3, 4, 5] for r in ranks.collect())


def test_hot_first_row_is_cut_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    plan = R.first_row(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def test_snapshots(spark, tmp_path):
    df = spark.createDataFrame([("t", "2024-01-01", 1), ("t", "2024-02-01", 2), ("u", "2024-03-01", 3)], "s string, d string, v int")
    own = F.col("s") == "t"
    assert rows(R.latest_snapshot(df.where(own), "d"), "v") == [(2,)]
    assert rows(R.latest_snapshot(df, "d", override="2024-01-01"), "v") == [(1,)]
    df.write.partitionBy("d").parquet(str(tmp_path / "p"))
    stored = spark.read.parquet(str(tmp_path / "p"))
    plan = R.latest_snapshot(stored, "d")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan
    meta = R.latest_value(stored, "d")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in meta


def test_latest_partition(spark):
    parts = spark.createDataFrame([("2023", "12", "31", 1), ("2024", "01", "02", 2), ("2024", "01", "02", 3)], "year string, month string, day string, v int")
    assert rows(R.latest_partition(parts), "v") == [(2,), (3,)]
    assert rows(R.latest_partition(parts, override=("2023", "12", "31")), "v") == [(1,)]


def test_scope_falls_back(spark):
    registered = spark.createDataFrame([("a_a",), ("b_b",)], "comp_source_store string")
    pairs = lambda *s: spark.createDataFrame([(x,) for x in s], "comp_source_store string")
    assert rows(R.stores_in_scope(pairs("a_a", "z_z"), registered)) == [("a_a",)]
    assert rows(R.stores_in_scope(pairs("z_z"), registered)) == [("a_a",), ("b_b",)]


def test_competitors_and_filters(spark):
    domains = spark.createDataFrame([("acme", "b_b"), ("acme", "a_a"), ("acme", "a_a"), ("x", "c_c")], "client string, primary string")
    assert rows(R.competitor_stores(domains, "acme")) == [("a_a",), ("b_b",)]
    assert rows(R.competitor_stores(domains, "acme", [" z_z ", ""])) == [("z_z",)]
    with pytest.raises(ValueError):
        R.competitor_stores(domains, "acme", [" "])
    with pytest.raises(ValueError):
        R.require_rows(R.competitor_stores(domains, "nobody"), "none")
    filled = R.required_filled(spark.createDataFrame([("a", "b"), ("", "b"), (None, "b")], "x string, y string"), ["x", "y"])
    assert rows(filled) == [("a", "b")]
    assert R.optional_filter(domains, " ").count() == 4 and R.optional_filter(domains, "client = 'x'").count() == 1
    assert R.optional_filter(domains, F.col("client") == "x").count() == 1
    assert rows(domains.select(R.column_or(domains, "score", "100")))[0] == ("100",)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("parts", [10, 1])
def test_spread_join_equals_plain_join(spark, how, parts):
    """A third of the rows share one key, another part has a null key."""
    left = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("v"),
    )
    right = spark.createDataFrame([("hot", 1), ("1", 2), ("2", 3), (None, 4)], "k string, w int")
    hot = skew.hot_keys(left, ["k"], parts)
    # 300 and 86 of 900 rows; a share of 90 each, the second just below it.
    assert [tuple(r) for r in hot.frame.collect()] == [("hot", 4)] if parts == 10 else hot.frame is None
    order = [F.col(c).asc_nulls_first() for c in (["k", "v", "w"] if how in ("left", "inner") else ["k", "v"])]
    joined = skew.join_spread(left, right, ["k"], how, hot)
    assert joined.orderBy(*order).collect() == left.join(right, "k", how).orderBy(*order).collect()


def test_hot_rows_reach_many_salts(spark):
    left = spark.range(5000).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    hot = skew.hot_keys(left, ["k"], 50)
    assert skew.salt_many(left, hot).select(skew.SALT).distinct().count() == 50


def test_largest_task_is_bounded(spark):
    """One key with 30% of the rows, one just under the even share, the rest apart."""
    parts, total = 20, 10_000
    key = F.when(F.col("id") < 3000, -1).when(F.col("id") < 3490, -2).otherwise(F.col("id"))
    left = spark.range(total).select(key.alias("k"), F.col("id").alias("v"))
    both = left.withColumn("other", F.lit("x"))
    one, two, all_same = skew.hot_key_sets(both, [["k"], ["k", "other"], ["other"]], parts)
    assert [tuple(r) for r in one.frame.collect()] == [(-1, 6)] and [tuple(r) for r in two.frame.collect()] == [(-1, "x", 6)]
    assert [tuple(r) for r in all_same.frame.collect()] == [("x", parts)]
    loads = skew.salt_many(left, one).groupBy("k", skew.SALT).count()
    assert loads.agg(F.max("count")).first()[0] <= 1.3 * total / parts
    weighted = left.groupBy("k").count()
    assert [tuple(r) for r in skew.hot_keys(weighted, ["k"], parts, weight="count").frame.collect()] == [(-1, 6)]


def test_keys_are_counted_by_buckets_first(spark, monkeypatch):
    """Only keys of buckets above the share are counted themselves, so no shuffle holds every key."""
    counted = []
    plain = skew._most_frequent
    monkeypatch.setattr(skew, "_most_frequent", lambda rows, sets, *rest: counted.append((rows, sets)) or plain(rows, sets, *rest))
    even = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") % 7000).alias("other"))
    assert [h.frame for h in skew.hot_key_sets(even, [["k"], ["k", "other"]], 20)] == [None, None]
    assert [rows.distinct().count() <= 320 ** 2 and "k" not in rows.columns for rows, _ in counted] == [True]
    counted.clear()
    hot = even.withColumn("k", F.when(F.col("k") < 3000, None).otherwise(F.col("k")))
    null, none = skew.hot_key_sets(hot, [["k"], ["other"]], 20)
    assert [tuple(r) for r in null.frame.collect()] == [(None, 3)] and none.frame is None
    assert counted[1][1] == [["k"]] and counted[1][0].count() < 5000


def test_no_rows_have_no_hot_keys(spark):
    assert skew.hot_keys(spark.range(0).withColumnRenamed("id", "k"), ["k"]).frame is None


def test_attach_keeps_row_count(spark):
    left = spark.range(300).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    right = spark.createDataFrame([("hot", "b"), ("hot", "a")], "k string, w string")
    for hot in (None, skew.hot_keys(left, ["k"], 9)):
        out = skew.attach_first(left, right, ["k"], hot)
        assert out.count() == 300 and rows(out.select("w").distinct()) == [("a",)]


def test_semi_and_anti_partition_the_input(spark):
    left = spark.createDataFrame([("a", None), ("a", "x"), (None, None), ("b", "y")], "k string, l string")
    right = left.where("k is null or l = 'x'")
    anti = skew.anti_null_safe(left, right, ["k", "l"])
    assert sorted(map(str, anti.collect())) == sorted(map(str, left.where("(k = 'a' and l is null) or k = 'b'").collect()))


def tfidf_by_hand(docs, features, sublinear):
    counts = [{t: d.count(t) for t in d} for d in docs]
    total, df = {}, {}
    for c in counts:
        for t, n in c.items():
            total[t] = total.get(t, 0) + n
            df[t] = df.get(t, 0) + 1
    vocab = sorted(sorted(total), key=lambda t: -total[t])[:features]
    out = []
    for c in counts:
        w = {t: (1 + np.log(n) if sublinear else n) * (np.log((1 + len(docs)) / (1 + df[t])) + 1) for t, n in c.items() if t in vocab}
        norm = np.sqrt(sum(v * v for v in w.values()))
        out.append({t: v / norm for t, v in w.items()})
    return out


@pytest.mark.parametrize("sublinear", [False, True])
def test_tfidf_matches_the_formula(spark, sublinear):
    texts = ["a a b", "b c", "c c c d", "e", "zz a d"]
    docs = spark.createDataFrame(list(enumerate(texts)), "key int, t string")
    vocab, vectors = tfidf.fit_transform(docs, "key", X.letter_tokens(F.col("t")), 4, sublinear)
    names = {r["term_id"]: r["term"] for r in vocab.collect()}
    got = {r["key"]: {names[i]: w for i, w in zip(r["ids"], r["weights"])} for r in vectors.collect()}
    want = tfidf_by_hand([t.split() for t in texts], 4, sublinear)
    for key, weights in enumerate(want):
        assert got.get(key, {}) == pytest.approx(weights)


def sparse_frame(spark, data, key):
    return spark.createDataFrame([(k, list(map(int, i)), list(map(float, w))) for k, i, w in data], f"{key} int, ids array<int>, weights array<double>")


def random_sparse(rng, n, terms=30):
    out = []
    for k in range(n):
        ids = np.sort(rng.choice(terms, size=rng.integers(0, 6), replace=False))
        w = rng.random(len(ids))
        out.append((k, ids, w / (np.linalg.norm(w) or 1)))
    return out


@pytest.mark.parametrize("repeated", [False, True])
def test_term_lists_give_the_vectors_of_term_counts(spark, repeated):
    """Counted per row and without a shuffle of texts; rows of a repeated or null key count as one."""
    rng = np.random.default_rng(9)
    rows = [(f"k{i}", " ".join(f"w{rng.integers(40)}" for _ in range(rng.integers(30)))) for i in range(80)] + [("none", None), ("", "W1 w1 \u00c9t\u00e9")]
    rows += [(None, "w1 w2 w2"), (None, "w2 w77"), ("k3", "w1 w5")] if repeated else []
    docs = spark.createDataFrame(rows, "row_id string, q string").repartition(3)
    terms = X.word_tokens(F.col("q"))
    listed = tfidf.term_lists(docs.coalesce(1), "row_id", terms)
    assert "Exchange hash" not in listed._jdf.queryExecution().executedPlan().toString()
    lists = tfidf.merged_lists(listed, "row_id")
    vocab = tfidf.list_vocabulary(lists, docs, 35)
    expected_vocab, expected = tfidf.fit_transform(docs, "row_id", terms, 35, sublinear=True)
    assert sorted(vocab.collect()) == sorted(expected_vocab.collect())
    by_key = lambda df: {r["row_id"]: (r["ids"], r["weights"]) for r in df.collect()}
    found, plain = by_key(tfidf.list_vectors(lists, vocab, "row_id", sublinear=True)), by_key(expected)
    assert found.keys() == plain.keys() and "none" not in found
    for k, (ids, weights) in plain.items():
        assert found[k][0] == ids and np.allclose(found[k][1], weights, rtol=0, atol=1e-12)


def test_nearest_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(blocks, "ROWS_PER_BLOCK", 16)
    monkeypatch.setattr(blocks, "QUERIES_PER_BLOCK", 4)
    monkeypatch.setattr(blocks, "SLICE", 3)
    rng = np.random.default_rng(1)
    index, asked = random_sparse(rng, 90), random_sparse(rng, 13)
    dense = lambda data: np.array([np.bincount(np.asarray(i, int), w, minlength=30) if len(i) else np.zeros(30) for _, i, w in data])
    scores = np.round(dense(asked) @ dense(index).T, 9)
    got = blocks.nearest(sparse_frame(spark, index, "row_id"), sparse_frame(spark, asked, "query_id"), 5)
    want = []
    for q in range(13):
        order = np.lexsort((np.arange(90), -scores[q]))[:5]
        want += [(q, int(r), n + 1) for n, r in enumerate(order)]
    assert rows(got, "query_id", "row_id", "rank") == sorted(want)
    trimmed = blocks.nearest(sparse_frame(spark, index, "row_id"), sparse_frame(spark, asked, "query_id"), 5, pad=False)
    assert trimmed.where("score <= 0").count() == 0


@pytest.mark.parametrize("threshold", [0.2, 0.6, 0.9])
def test_scored_above_equals_all_pairs(spark, monkeypatch, threshold):
    """Clustered vectors, small blocks: pruning and splitting lose nothing."""
    monkeypatch.setattr(blocks, "NODES_PER_BLOCK", 7)
    monkeypatch.setattr(blocks, "PIVOTS", 6)
    monkeypatch.setattr(blocks, "SLICE", 4)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(5, 8))

    def side(n, seed):
        local = np.random.default_rng(seed)
        v = centres[local.integers(0, 5, n)] + 0.15 * local.normal(size=(n, 8))
        return (v / np.linalg.norm(v, axis=1, keepdims=True)).astype("float32"), random_sparse(local, n)

    (bv, bs), (cv, cs) = side(60, 3), side(50, 4)
    frame = lambda v, s, p: spark.createDataFrame(
        [(f"{p}{k}", v[k].tolist(), list(map(int, i)), list(map(float, w))) for k, i, w in s],
        "text string, embedding array<float>, ids array<int>, weights array<double>",
    )
    got = blocks.scored_above(frame(bv, bs, "b"), frame(cv, cs, "c"), threshold)
    dense = lambda data: np.array([np.bincount(np.asarray(i, int), w, minlength=30) if len(i) else np.zeros(30) for _, i, w in data])
    total = 0.7 * (bv.astype("float64") @ cv.astype("float64").T) + 0.3 * np.round(dense(bs) @ dense(cs).T, 9)
    want = sorted((f"b{i}", f"c{j}") for i, j in zip(*np.nonzero(total >= threshold - 2e-4)))
    assert rows(got, "base_text", "comp_text") == want


@pytest.mark.parametrize("least", [0.3, 0.5, 0.8])
def test_prefix_pairs_lose_nothing_and_are_few(spark, least):
    """Texts of a common word and two rare ones, as of taxonomies: few pairs share a rare word."""
    rng = np.random.default_rng(7)

    def side(n, p):
        out = []
        for k in range(n):
            ids = np.unique(np.concatenate(([0], rng.choice(np.arange(1, 60), 2))))
            w = np.where(ids == 0, 0.2, rng.random(len(ids)) + 0.5)
            out.append((f"{p}{k}", ids.tolist(), (w / np.linalg.norm(w)).tolist()))
        return out + [(f"{p}x", None, None), (f"{p}y", [], [])]

    base, comp = side(150, "b"), side(120, "c")
    frame = lambda data: spark.createDataFrame(data, "text string, ids array<int>, weights array<double>")
    got = set(rows(blocks.prefix_pairs(frame(base), frame(comp), least), "base_text", "comp_text"))
    dense = lambda data: np.array([np.bincount(i, w, minlength=60) if i else np.zeros(60) for _, i, w in data])
    total = dense(base) @ dense(comp).T
    want = {(base[i][0], comp[j][0]) for i, j in zip(*np.nonzero(total >= least))}
    assert want <= got and len(got) < 0.1 * len(base) * len(comp)


def test_few_pairs_of_the_taxonomy_are_scored(spark):
    """Of all pairs of texts only those that share a rare word or lie near each other are scored in full."""
    base, comp, embeddings = (cut_lineage(fixture(spark, "/root/testdata/sf0.01", n)) for n in ("fx_tax_base", "fx_tax_comp", "fx_tax_embeddings"))
    base, comp = taxonomy._named(base, "base"), taxonomy._named(comp, "comp")
    vectors = cut_lineage(taxonomy._vectors(taxonomy._texts(base, comp), taxonomy._texts(base, comp), embeddings, workload.MAPPING))
    sides = [vectors.join(s.select(F.col(f"{n}_text").alias("text")).distinct(), "text", "left_semi") for n, s in (("base", base), ("comp", comp))]
    every = sides[0].count() * sides[1].count()
    shared = blocks.prefix_pairs(*sides, blocks.TEXT).count()
    dense = [np.array([r["embedding"] for r in s.collect()], dtype="float64") for s in sides]
    near = int((0.7 * (dense[0] @ dense[1].T) + 0.3 * blocks.TEXT >= workload.THRESHOLD).sum())
    print("pairs", every, "that share a rare word", shared, "that lie near", near)
    assert every > 10_000 and shared + near < 0.1 * every


def test_scored_above_without_vectors(spark):
    empty = spark.createDataFrame([("a", None, None, None)], "text string, embedding array<float>, ids array<int>, weights array<double>")
    assert blocks.scored_above(empty, empty, 0.5).count() == 0


def test_encoder_and_scorers(spark):
    def length_encoder():
        return lambda texts: np.array([[len(t), 1.0] for t in texts])

    pairs = spark.createDataFrame(
        [("red ball", "red ball", 1), ("red ball", "blue car", 2), ("red ball", "blue car", 3), ("the", "xx", 4)],
        "base_title string, comp_title string, v int",
    )
    encoded = lambda titles: embed.encode(titles, length_encoder, "length", batch=2)
    out = scorers.run_scorers(pairs, [scorers.embedding_scorer(encoded, hot_parts=10**6), scorers.tfidf_scorer(["the"], hot_parts=10**6)], 10**6)
    got = {r["v"]: (round(r["bert_similarity"], 4), r["tfidf_similarity"]) for r in out.collect()}
    assert got[1] == (1.0, 1.0) and got[2] == got[3] == (1.0, 0.0) and got[4][1] == 0.0
    lemmas = spark.createDataFrame([("balls", "ball"), ("cars", "car")], "word string, lemma string")
    more = spark.createDataFrame([("red balls", "red ball", 1)], "base_title string, comp_title string, v int")
    assert scorers.run_scorers(more, [scorers.tfidf_scorer(lemmas=lemmas)]).first()["tfidf_similarity"] == 1.0


def test_embedding_scorer_leaves_unknown_titles_null(spark):
    table = spark.createDataFrame([("a", [1.0])], "title string, embedding array<float>")
    pairs = spark.createDataFrame([("a", "b")], "base_title string, comp_title string")
    assert scorers.run_scorers(pairs, [scorers.embedding_scorer(table)]).first()["bert_similarity"] is None
