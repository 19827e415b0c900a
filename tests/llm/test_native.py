"""Exact dedup, mixing and sharding: odd rows, collisions, skew, and registered queries against SQL."""

import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import compare
from pairloom.llm import exact_dedup, mixing, sharding
from pairloom.llm.common import attach, maybe_in, without_rows
from pairloom.llm.extendible import split_buckets
from pairloom.session import Workspace

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(n for n in contract.oracle_sql() if n.startswith("op")))
def test_query_matches_oracle(spark, name):
    assert compare.difference(contract.queries()[name](spark, SF), compare.connect(SF), contract.oracle_sql()[name]) is None


def by_hand(rows):
    same = defaultdict(list)
    for doc_id, text in rows:
        same[text or ""].append(doc_id)
    return {(d, hashlib.sha256((t or "").encode()).hexdigest(), max(same[t or ""]), len(same[t or ""])) for d, t in rows}


@pytest.mark.parametrize("key_bits", [60, 2, 0])
def test_exact_groups(spark, odd_docs, key_bits):
    found = exact_dedup.exact_groups(odd_docs, capacity=2, key_bits=key_bits).collect()
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert len(found) == len(rows)
    assert {(r["doc_id"], r["text_sha256"], r["keep_id"], r["group_size"]) for r in found} == by_hand(rows)
    assert {r["doc_id"] for r in found if r["kept"]} == {r["keep_id"] for r in found}


@pytest.mark.parametrize("key_bits", [60, 1, 0])
def test_exact_groups_with_null_and_repeated_ids(spark, key_bits):
    rows = [(None, "a"), (3, "a"), (None, "a"), (1, "b"), (None, None), (None, ""), (3, "c"), (3, "c"), (4, "b"), (None, "alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = [(r["doc_id"], r["text_sha256"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_groups(docs, capacity=1, key_bits=key_bits).collect()]
    same = defaultdict(list)
    for doc_id, text in rows:
        same[text or ""].append(doc_id)
    keep = {t: max((d for d in ids if d is not None), default=None) for t, ids in same.items()}
    want = [(d, hashlib.sha256((t or "").encode()).hexdigest(), keep[t or ""], len(same[t or ""]), d == keep[t or ""]) for d, t in rows]
    assert sorted(found, key=str) == sorted(want, key=str)


def test_groups_come_from_the_owners_chains(spark, monkeypatch, odd_docs):
    """What the owners of the key ranges say is what rows get: without chains only texts that come once have a group."""
    real = exact_dedup._chains
    monkeypatch.setattr(exact_dedup, "_chains", lambda texts: real(texts).withColumn("keep_id", F.lit(-7).cast("long")))
    found = exact_dedup.exact_groups(odd_docs).collect()
    assert {r["keep_id"] for r in found if r["group_size"] > 1} == {-7}
    assert all(r["keep_id"] == r["doc_id"] for r in found if r["group_size"] == 1)


def test_chains_number_different_texts_of_a_key(spark):
    texts = [(1, 5, "x"), (2, 5, "y"), (3, 5, "x"), (None, 5, "y"), (4, 6, "x"), (9, 6, "x")]
    found = exact_dedup._chains(spark.createDataFrame(texts, "doc_id long, key long, text string").repartition(4)).collect()
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert sorted((r["key"], r["link"], r["links"], r["text_sha256"], r["group_size"], r["keep_id"]) for r in found) == [
        (5, 1, 2, digest("x"), 2, 3), (5, 2, 2, digest("y"), 2, 2), (6, 1, 1, digest("x"), 2, 9),
    ]


def test_exact_groups_with_a_hot_text(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("text"))
    found = exact_dedup.exact_groups(docs, capacity=64)
    assert found.where("group_size = 1000 and keep_id = 2997").count() == 1000 and found.where("kept").count() == 2001
    kept = exact_dedup.drop_copies(docs.withColumn("_row", F.lit(1)).withColumn("_maybe", F.lit(2)))
    assert kept.columns == ["doc_id", "text", "_row", "_maybe"] and kept.count() == 2001


def test_empty_tables(spark, odd_docs):
    none = odd_docs.where("false")
    assert exact_dedup.exact_groups(none).count() == 0 and exact_dedup.drop_copies(none).count() == 0
    assert mixing.mix(none).count() == 0 and mixing.mixed(none).columns == odd_docs.columns
    assert sharding.assign_shards(none).count() == 0


def test_buckets_split_only_where_they_must(spark):
    keys = [(i, 1) for i in range(64)] + [((1 << 59) + i * (1 << 50), 1) for i in range(20)] + [((1 << 60) - 1, 50)]
    found = split_buckets(spark.createDataFrame(keys, "key long, weight long"), 16, Workspace(spark)).collect()
    loads = Counter()
    for r in found:
        assert r["key"] >> (60 - r["depth"]) == r["prefix"]
        loads[r["depth"], r["prefix"]] += r["weight"]
    assert len(found) == len(keys)
    assert all(r["load"] == loads[r["depth"], r["prefix"]] for r in found)
    assert all(load <= 16 or depth == 60 for (depth, _), load in loads.items())
    # Every bucket's parent was too full.
    total = lambda depth, prefix: sum(w for k, w in keys if k >> (60 - depth) == prefix)
    assert all(depth == 0 or total(depth - 1, prefix >> 1) > 16 for depth, prefix in loads)


def test_shards_keep_their_limit(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.expr("repeat('x', int(id % 50) * 10)").alias("text"), F.lit(1).alias("load"))
    found = sharding.assign_shards(docs, 3000).collect()
    sizes = Counter()
    for r in found:
        sizes[r["shard"]] += r["n_bytes"]
    assert len(found) == 500 and max(sizes.values()) <= 3000
    assert all(r["shard_bytes"] == sizes[r["shard"]] for r in found)


def test_shards_of_repeated_and_null_ids(spark):
    rows = [(7, "y" * 84)] * 100 + [(None, None)] * 300 + [(8, "z" * 5000), (9, "")]
    found = sharding.assign_shards(spark.createDataFrame(rows, "doc_id long, text string"), 1000).collect()
    sizes, holds = Counter(), Counter()
    for r in found:
        sizes[r["depth"], r["prefix"], r["part"]] += r["n_bytes"]
        holds[r["depth"], r["prefix"], r["part"]] += 1
    assert len(found) == len(rows)
    assert all(size <= 1000 or holds[k] == 1 for k, size in sizes.items())
    assert all(r["shard_bytes"] == sizes[r["depth"], r["prefix"], r["part"]] for r in found)


def test_write_shards(spark, tmp_path, odd_docs):
    sharding.write_shards(odd_docs, str(tmp_path / "s"), 200_000)
    again = spark.read.parquet(str(tmp_path / "s"))
    assert again.count() == odd_docs.count() and set(odd_docs.columns) < set(again.columns)


def test_write_shards_with_a_column_of_that_name(spark, tmp_path, odd_docs):
    docs = odd_docs.withColumn("shard", F.lit("mine")).withColumn("SHARD_", F.lit("too"))
    sharding.write_shards(docs, str(tmp_path / "s"), 200_000)
    again = spark.read.parquet(str(tmp_path / "s"))
    assert set(again.columns) == {*docs.columns, "shard__"}
    assert Counter((r["doc_id"], r["shard"]) for r in again.collect()) == Counter((r["doc_id"], "mine") for r in docs.collect())


def test_mix_decides_rows_without_ids_one_by_one(spark):
    docs = spark.createDataFrame([(None, "w " * n, s) for s in "ab" for n in range(1, 200)], "doc_id long, text string, source string")
    found = mixing.mix(docs).collect()
    taken = sum(r["taken"] for r in found if r["target"] == found[0]["target"])
    assert abs(taken - found[0]["target"]) <= 200 / 2 and len({r["repeats"] for r in found}) > 1


def mix_by_hand(rows, weights=(3, 1, 2)):
    """rows: (doc_id, size, source); the whole-document mix, source by source."""
    sizes = Counter()
    for _, size, source in rows:
        sizes[source] += size
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, budget = {}, 1.5 * sum(sizes.values())
    open_ = set(names)
    while open_:
        level = (budget - sum(target.values())) / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: 2.0 * sizes[s] for s in full}
        open_ -= full
    return sizes, target


def test_mix(spark, odd_docs):
    found = mixing.mix(odd_docs).collect()
    size = lambda t: len([w for w in (t or "").encode().split() if w])
    rows = [(r["doc_id"], size(r["text"]), r["source"]) for r in odd_docs.collect()]
    sizes, target = mix_by_hand(rows)
    known = {d: (n, s) for d, n, s in rows}
    taken = Counter()
    for r in found:
        n, source = known[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (n, sizes[source]) and r["target"] == pytest.approx(target[source])
        assert r["taken"] == n * r["repeats"] and 0 <= r["repeats"] <= 2
        taken[source] += r["taken"]
    largest = {s: max(n for _, n, x in rows if x == s) for s in sizes}
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6 for s in sizes)
    again = {(r["doc_id"], r["taken"]) for r in mixing.mix(odd_docs.repartition(3)).collect()}
    assert again == {(r["doc_id"], r["taken"]) for r in found}
    copies = Counter(r["doc_id"] for r in mixing.mixed(odd_docs).collect())
    assert copies == Counter({r["doc_id"]: r["repeats"] for r in found if r["repeats"]})


def test_mix_with_a_hot_source_and_shuffled_sources(spark, monkeypatch):
    docs = spark.range(2000).select(
        F.col("id").alias("doc_id"), F.expr("repeat('w ', int(id % 17) + 1)").alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 40).cast("string"))).alias("source"),
    )
    plain = sorted(mixing.mix(docs).collect())
    monkeypatch.setattr(mixing, "FEW_SOURCES", 1)
    assert sorted(mixing.mix(docs).collect()) == plain
    source, taken, target = {r["doc_id"]: r["source"] for r in docs.collect()}, Counter(), {}
    for r in plain:
        taken[source[r["doc_id"]]] += r["taken"]
        target[source[r["doc_id"]]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 17 / 2 for s in target)


def test_filters(spark):
    docs = spark.createDataFrame([(1, "a"), (None, "b"), (-5, "c"), (1 << 40, "d")], "doc_id long, _map string")
    gone = spark.createDataFrame([(-5,), (None,), (9,)], "doc_id long")
    assert {r["_map"] for r in without_rows(docs, gone).collect()} == {"a", "b", "d"}
    flags = maybe_in(docs.drop("_map"), "doc_id", gone, "hit").collect()
    assert {r["doc_id"]: r["hit"] for r in flags} == {1: False, None: False, -5: True, 1 << 40: False}


def test_copies_with_null_and_repeated_ids_are_dropped(spark):
    """Copies that share an id or have none, and a unique text under the id of a copy."""
    rows = [(1, "a")] * 40 + [(None, "a")] * 20 + [(2, "b"), (3, "b"), (2, "alone"), (None, "c"), (None, "c"), (None, "d"), (None, None), (None, ""), (5, "e")]
    docs = spark.createDataFrame([(d, t, n) for n, (d, t) in enumerate(rows)], "doc_id long, text string, n int").repartition(4)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    found = sorted([(r["doc_id"], r["text"] or "") for r in kept.collect()], key=str)
    assert found == sorted([(1, "a"), (3, "b"), (2, "alone"), (None, "c"), (None, "d"), (None, ""), (5, "e")], key=str)


def test_write_shards_of_repeated_and_null_ids(spark, tmp_path):
    rows = [(7, "y" * 84, n) for n in range(40)] + [(None, None, n) for n in range(90)] + [(8, "z" * 5000, 0), (9, "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(3)
    sharding.write_shards(docs, str(tmp_path / "s"), 1000)
    again = spark.read.parquet(str(tmp_path / "s")).collect()
    assert Counter((r["doc_id"], r["text"], r["n"]) for r in again) == Counter(rows)
    sizes, holds = Counter(), Counter()
    for r in again:
        sizes[r["shard"]] += len(r["text"] or "") + 16
        holds[r["shard"]] += 1
    assert all(size <= 1000 or holds[s] == 1 for s, size in sizes.items())


def test_a_hot_source_is_spread_without_a_broadcast(spark, monkeypatch):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.lit("w w").alias("text"),
        F.when(F.col("id") % 3 > 0, F.when(F.col("id") % 3 == 1, "hot")).otherwise(F.concat(F.lit("s"), F.col("id").cast("string"))).alias("source"),
    )
    plain = sorted((r["doc_id"], r["source"] or "") for r in mixing.mixed(docs).collect())
    monkeypatch.setattr(mixing, "FEW_SOURCES", 1)
    monkeypatch.setattr(mixing, "attach", lambda *a: calls.append(a[3]) or attach(*a))
    calls = []
    assert sorted((r["doc_id"], r["source"] or "") for r in mixing.mixed(docs).collect()) == plain and calls == ["_rows"]
