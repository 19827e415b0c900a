"""Tokens against the library, models by held-out accuracy, the pipeline stage by stage."""

import hashlib
import random
import struct

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from pairloom.session import Workspace
from pairloom.llm import pieces, quality, segments, tokens, toxicity

SF = "/root/testdata/sf0.01"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def test_pieces_equal_the_library():
    library, ours = sentencepiece.SentencePieceProcessor(model_file=MODEL), pieces.encoder(MODEL)
    rng = random.Random(1)
    alphabet = ["a", "b", "th", "ing", " ", "  ", "▁", "\n", "\t", "\x00", "é", "漢", "𝒳", "<0x41>", "<s>", "\u00a0", "1", ".", "the "]
    texts = ["", " ", "  ", "x" * 3000, " " * 500, "�", "<unk>"] + ["".join(rng.choices(alphabet, k=rng.randrange(40))) for _ in range(4000)]
    for text in texts:
        ids = library.encode(text, add_bos=True, add_eos=True)
        packed = ours.encode(text)
        assert list(struct.unpack(f"<{len(packed) // 4}I", packed)) == ids, text
        assert ours.decode(packed).decode() == library.decode(ids), text


def test_encode_query_equals_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    found = contract.queries()["op5_sentencepiece"](spark, "/root/testdata/sf0.001").collect()
    assert len(found) == len(texts)
    for r in found:
        ids = library.encode(texts[r["doc_id"]], add_bos=True, add_eos=True)
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_tokens_of_odd_rows(spark, odd_docs):
    texts = {r["doc_id"]: r["text"] or "" for r in odd_docs.collect()}
    again = {r["doc_id"]: r["text"] for r in tokens.decode(tokens.encode(odd_docs, MODEL), MODEL).collect()}
    assert again == texts
    empty = {r["doc_id"]: r["n_tokens"] for r in tokens.encode_digests(odd_docs, MODEL).collect()}
    assert empty[2] == empty[3] == 2 and len(empty) == len(texts)
    assert tokens.encode_digests(odd_docs.where("false"), MODEL).count() == 0


def test_segments_by_brute_force():
    """All maximal segments: each is found by repeatedly taking the best one and what is left of and right of it."""
    def best(scores, a, b):
        top = None
        for i in range(a, b):
            total = 0.0
            for j in range(i, b):
                total += scores[j]
                if total > 0 and (top is None or total > top[2] or total == top[2] and j - i < top[1] - top[0]):
                    top = (i, j, total)
        return [] if top is None else [*best(scores, a, top[0]), top, *best(scores, top[1] + 1, b)]

    rng = random.Random(6)
    for _ in range(300):
        # Powers of two keep every sum different.
        scores = np.array([rng.choice([-1, 1]) * 2.0 ** rng.randrange(-20, 20) for _ in range(rng.randrange(1, 14))])
        found = segments.segments(scores)
        assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in best(scores.tolist(), 0, len(scores))]
        assert all(s == pytest.approx(scores[a:b + 1].sum()) for a, b, s in found)
    assert segments.segments(np.zeros(0)) == [] and segments.segments(-np.ones(5)) == []


def test_toxicity_of_held_out_documents(spark):
    rows = contract.queries()["op9_toxicity"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    right = sum(r["predicted"] == r["toxic"] for r in rows)
    assert right / len(rows) >= 0.9 and sum(r["predicted"] for r in rows if not r["toxic"]) <= 2
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_held_out_labels_are_not_seen(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    held = toxicity.fold(F.col("doc_id")) == 0
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    score = lambda t: {r["doc_id"]: r["score"] for r in toxicity.score_held_out(docs, t).collect()}
    assert score(labels) == score(turned)


def test_toxicity_of_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1, 0), (5, 1, 0), (10, 0, 1), (11, 0, 1), (11, 0, None), (None, 1, 1), (6, None, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(odd_docs, labels)
    found = toxicity.score(odd_docs, model).collect()
    assert len(found) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in found)
    assert toxicity.passages(odd_docs, model).columns[0] == "doc_id"
    for some in (labels.where("toxic = 0"), labels.where("false")):
        assert {r["predicted"] for r in toxicity.score(odd_docs, toxicity.fit(odd_docs, some)).collect()} == {0}
    assert toxicity.score(odd_docs.where("false"), model).count() == 0


def test_passages_find_the_toxic_words(spark):
    rng = random.Random(2)
    plain = lambda n: [f"w{rng.randrange(300)}" for _ in range(n)]
    bad = ["vile1", "vile2", "vile3"]
    texts = [(i, " ".join(plain(60) + (rng.choices(bad, k=4) if i % 4 == 0 else []) + plain(60)), int(i % 4 == 0)) for i in range(800)]
    table = spark.createDataFrame(texts, "doc_id long, text string, toxic int")
    model = toxicity.fit(table, table)
    found = {r["doc_id"]: (r["first_word"], r["last_word"]) for r in toxicity.passages(table, model).collect()}
    assert len(found) >= 190 and all(d % 4 == 0 for d in found)
    assert all(60 <= a <= b <= 63 for a, b in found.values())


def test_ordinal_regression_learns_grades():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 6)).astype(np.float32)
    hidden = x @ np.array([2.0, -1.0, 0.5, 0, 0, 0]) + rng.logistic(size=3000) * 0.3
    y = np.digitize(hidden, [-1.5, 0.2, 1.9]) + 1
    model = quality.fit_ordinal(x, y, rounds=400)
    assert model.grades == [1, 2, 3, 4] and (np.diff(model.thresholds) > 0).all()
    expected, best = model.rate(x)
    assert np.abs(expected - y).mean() < 0.35 and ((best >= 0.5) == (y == 4)).mean() > 0.93
    tail = model.tail(x)
    assert (np.diff(tail, axis=1) <= 0).all()
    assert quality.fit_ordinal(x[:3], np.array([2, 2, 2])).rate(x[:2])[0].tolist() == [2.0, 2.0]


def test_quality_keeps_clean_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
    rated = quality.rate_documents(docs, labels.join(held, "doc_id", "left_anti")).join(held, "doc_id").collect()
    assert not [r for r in rated if r["quality"] == 1 and not r["selected"]]
    assert sum(r["selected"] == (r["quality"] == 1) for r in rated) / len(rated) >= 0.95


def test_quality_of_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1), (5, 0), (5, 1), (10, 0), (None, 1), (6, None)], "doc_id long, quality int")
    rated = quality.rate_documents(odd_docs, labels)
    assert rated.count() == odd_docs.count() and rated.columns == ["doc_id", "expected_grade", "best_chance", "selected"]
    kept = quality.select(odd_docs, labels.where("false"))
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    assert quality.select(odd_docs.where("false"), labels).count() == 0


def test_pipeline_stages(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "near dedup", "mixing", "piece encoding"]
    counts = [docs.count()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] > counts[3] and counts[4] == counts[5]
    whole = corpus_pipeline.run(spark, sf)
    assert sorted(whole.collect()) == sorted(docs.select(*whole.columns).collect())
    none = spark.read.parquet(f"{sf}/documents.parquet").where("false")
    assert all(stage(spark, none, sf).count() == 0 for _, stage in corpus_pipeline.STAGES)


@pytest.mark.parametrize("own, want", [(10_000, 1_024), (0, 1_024), (100, 100)])
def test_pipeline_sends_bounded_batches(spark, own, want):
    """Python gets some whole texts at a time, at most as many as the session allows."""
    name, sf = "spark.sql.execution.arrow.maxRecordsPerBatch", "/root/testdata/sf0.001"
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("a text").alias("text")).coalesce(1)
    before = spark.conf.get(name)
    spark.conf.set(name, own)
    try:
        stage = corpus_pipeline.token_stage(spark, docs, sf)
        sizes = docs.mapInArrow(lambda batches: (b.slice(0, 0) if b.num_rows <= want else b for b in batches), docs.schema).count()
        assert (stage.count(), sizes, int(spark.conf.get(name))) == (3000, 0, want)
    finally:
        spark.conf.set(name, before)


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Nulls in every column, repeated rows and ids, and columns that clash with the stages' own, through all stages."""
    text = " ".join(f"word{i}" for i in range(40))
    rows = [
        (1, text, "en", "s1", 3, "x", 1), (1, text, "en", "s1", 3, "x", 1), (2, text + " more", "en", "s1", 3, "x", 1), (2, "a text of its own", "en", "s2", None, "x", 1),
        (None, text + " and", None, None, None, None, None), (None, "alone in the table", None, None, None, None, None), (None, None, None, None, None, None, None),
        (3, "", "en", "s1", 0, "x", 1), (4, "w " * 50_000, "en", "s2", 3, "x", 1), (5, "é ê 漢字", "fr", "é", 3, "x", 1), (5, "é ê 漢字", "fr", "é", 3, "x", 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _row string, _at long")
    docs.withColumn("shard", F.lit("s")).withColumn("spot", F.lit(1)).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    labels = "doc_id long, quality int, toxic int, _row string"
    spark.createDataFrame([(1, 1, 0, "x"), (None, 1, None, None), (9, None, 1, "x")], labels).write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns, seen = docs.columns, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = Workspace(spark, "test").save(stage(spark, docs, str(tmp_path)))
        assert docs.columns == columns
        seen.append(sorted((str(r["doc_id"]), (r["text"] or "")[:20]) for r in docs.collect()))
    same = sorted({(str(d), (t or "")[:20]) for d, t, *_ in rows})
    # All texts are kept by a model of one grade; of equal and near texts one stays each.
    assert len(seen[0]) == len(rows) and len(seen[1]) == 8 and set(seen[1]) <= set(same)
    assert seen[2] == sorted([("1", text[:20]), ("2", "a text of its own"), ("None", "alone in the table"), ("3", ""), ("4", "w " * 10), ("5", "é ê 漢字")])
    assert set(seen[3]) <= set(seen[2])
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(str(r["doc_id"]) for r in whole.collect()) == sorted(d for d, _ in seen[3])
