"""The stored inverted index against brute force, and where its rows are read."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.operators import inverted

TERMS = 40


def unit_rows(rng, n, first=0):
    """Sparse unit vectors; a few rows are empty, null, copies, or of the one most common term."""
    rows = []
    for i in range(n):
        if i % 29 == 0:
            rows.append((first + i, None if i % 2 else [], None if i % 2 else []))
            continue
        ids = sorted(rng.choice(TERMS, size=rng.integers(1, 7), replace=False, p=np.arange(TERMS, 0, -1) / (TERMS * (TERMS + 1) / 2)).tolist())
        if i % 7 == 0:
            ids = [0]
        weights = rng.random(len(ids)) + 0.1 if i % 5 else np.ones(len(ids))
        rows.append((first + i, ids, (weights / np.linalg.norm(weights)).tolist()))
    return rows


def table(spark, rows, key, kind="long"):
    return spark.createDataFrame([(f"k{i:04d}" if kind == "string" else i, a, b) for i, a, b in rows], f"{key} {kind}, ids array<int>, weights array<double>")


def by_hand(rows, asked, k):
    out = set()
    for q, ids, weights in asked:
        own, scored = dict(zip(ids or [], weights or [])), []
        for r, a, b in rows:
            score = round(sum(own.get(t, 0.0) * w for t, w in zip(a or [], b or [])), 9)
            if score > 0:
                scored.append((-score, r))
        out |= {(q, r, -s, n) for n, (s, r) in enumerate(sorted(scored)[:k], 1)}
    return out


@pytest.mark.parametrize(("per_segment", "kind"), [(60, "string"), (10_000, "long")])
def test_search_equals_brute_force(spark, monkeypatch, tmp_path, per_segment, kind):
    monkeypatch.setattr(inverted, "BLOCK", 4)
    monkeypatch.setattr(inverted, "FIRST_BLOCKS", 2)
    rng = np.random.default_rng(8)
    rows, asked = unit_rows(rng, 400), unit_rows(rng, 40, 1000)
    index = inverted.write_index(table(spark, rows, "row_id", kind), str(tmp_path / "index"), per_segment=per_segment)
    assert (index.n_segments > 5) == (per_segment == 60)
    for k in (3, 500):
        found = inverted.search(index, table(spark, asked, "query_id"), k).collect()
        got = {(r["query_id"], int(str(r["row_id"]).lstrip("k")), r["score"], r["rank"]) for r in found}
        assert {(q, r, n) for q, r, _, n in got} == {(q, r, n) for q, r, _, n in by_hand(rows, asked, k)}
        assert sorted(s for _, _, s, _ in got) == pytest.approx(sorted(s for _, _, s, _ in by_hand(rows, asked, k)), abs=2e-9)
    assert inverted.search(index, table(spark, [], "query_id"), 3).count() == 0


def test_blocks_that_cannot_reach_the_kth_score_are_not_scored(spark, tmp_path, monkeypatch):
    """A strong match ends the search after the first blocks."""
    rows = [(i, [0, 1], [0.6, 0.8]) if i < 64 else (i, [1, 2 + i % 9], [0.1, (1 - 0.01) ** 0.5]) for i in range(4000)]
    index = inverted.write_index(table(spark, rows, "row_id"), str(tmp_path / "index"))
    segment = inverted._Segment(index.lists.toPandas())
    scored = []
    real = np.flatnonzero
    monkeypatch.setattr(inverted.np, "flatnonzero", lambda x: scored.append(int(real(x).size)) or real(x))
    found, scores = segment.best(np.array([1]), np.array([1.0]), 10, 0.0)
    assert len(found) == 10 and scores.tolist() == [0.8] * 10
    # Eight of the blocks, and the rows found in them.
    assert sum(scored) < 100 and segment.n_blocks == 63


def test_no_row_of_the_index_is_shuffled(spark, tmp_path):
    rng = np.random.default_rng(3)
    index = inverted.write_index(table(spark, unit_rows(rng, 400), "row_id"), str(tmp_path / "index"), per_segment=100)
    asked = inverted._asked(table(spark, unit_rows(rng, 20), "query_id"), "query_id")
    sent = asked.withColumn("segment", F.lit(0)).withColumn("least", F.lit(0.0))
    for plan in (inverted._search(index, sent, 3), inverted._bounds(index, asked)):
        text = plan._jdf.queryExecution().executedPlan().toString()
        left = text[text.index("FlatMapCoGroupsInPandas"):]
        side = left[:left.index("Exchange")]
        # The index comes first, sorted where it was read; the only exchanges are of the queries.
        assert "Bucketed: true" in side and "FileScan parquet" in side
        assert all("segment" not in line or "FileScan" not in line for line in left[left.index("Exchange"):].splitlines())


def test_only_lists_of_asked_terms_are_read(spark, tmp_path):
    rows = [(i, [i % 50, 60 + i % 7], [0.6, 0.8]) for i in range(300)]
    index = inverted.write_index(table(spark, rows, "row_id"), str(tmp_path / "index"), per_segment=200)
    asked = inverted._asked(table(spark, [(1, [3, 62], [0.6, 0.8]), (2, [99], [1.0])], "query_id"), "query_id")
    assert {r["term_id"] for r in inverted._asked_lists(index, asked).collect()} == {-1, 3, 62}


def test_fillers(spark):
    found = spark.createDataFrame([(1, 5, 0.9, 1), (1, 0, 0.4, 2), (2, 3, 0.2, 1)], "query_id int, row_id long, score double, rank int")
    asked = spark.createDataFrame([(1,), (2,), (3,), (3,)], "query_id int")
    got = inverted.padded(found, asked, spark.range(6).withColumnRenamed("id", "row_id"), 3).collect()
    assert sorted((r["query_id"], r["rank"], r["row_id"]) for r in got) == [(1, 1, 5), (1, 2, 0), (1, 3, 1), (2, 1, 3), (2, 2, 0), (2, 3, 1), (3, 1, 0), (3, 2, 1), (3, 3, 2)]


def test_an_index_is_opened_again(spark, tmp_path):
    rows = unit_rows(np.random.default_rng(1), 60)
    index = inverted.write_index(table(spark, rows, "row_id"), str(tmp_path / "a"), per_segment=50)
    copy = inverted.copy_index(index, str(tmp_path / "b"))
    again = inverted.InvertedIndex(spark, copy.path, copy.n_buckets, copy.row_type, copy.n_segments)
    asked = table(spark, rows[:9], "query_id")
    assert inverted.search(again, asked, 4).orderBy("query_id", "rank").collect() == inverted.search(index, asked, 4).orderBy("query_id", "rank").collect()
    nothing = inverted.write_index(table(spark, [(1, None, None)], "row_id"), str(tmp_path / "c"))
    assert inverted.search(nothing, asked, 4).count() == 0


def test_equal_queries_are_searched_once(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows, asked = unit_rows(rng, 120), unit_rows(rng, 12, 900)
    copies = [(i + 100 * n, a, b and [w + n * 1e-16 for w in b]) for n in range(4) for i, a, b in asked]
    index = inverted.write_index(table(spark, rows, "row_id"), None, per_segment=60)
    searched = []
    plain = inverted._bounds
    monkeypatch.setattr(inverted, "_bounds", lambda index, some: searched.append(some.count()) or plain(index, some))
    found = inverted.search(index, table(spark, copies, "query_id"), 5)
    assert {tuple(r) for r in found.select("query_id", "row_id", "score", "rank").collect()} == by_hand(rows, copies, 5)
    assert searched == [len({(*a, *b) for _, a, b in asked if a})]
