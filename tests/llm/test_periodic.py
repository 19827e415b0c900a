"""Periodic runs against a plain scan of every period."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pairloom.llm import periodic, queries

SF = "/root/testdata/sf0.001"


def plain_runs(words):
    """(start, length, period) of every run, by start, then period."""
    found, n = {}, len(words)
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            start = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            if i - start + p >= max(12, 2 * p):
                found.setdefault((start, i - start + p), p)
            i += 1
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def plain_collapsed(words, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def solved(words, tile_words, together):
    """Runs from the tiles of every octave, alone or with what shorter periods explain left out."""
    numbers = np.array(words, np.int32)
    groups = {o.least: list(periodic.tiles(0, numbers, o, tile_words)) for o in periodic.octaves(len(words))}
    if together:
        parts = [b.to_pandas() for b in periodic._solved(groups, [(1, 2)])]
        parts = [p[["mark", "period", "low", "high"]].to_numpy() for p in parts]
    else:
        parts = [periodic.solve([t], periodic.Octave(least)) for least, some in groups.items() for t in some]
    rows = periodic.joined(np.concatenate(parts)) if parts else np.zeros((0, 4), np.int64)
    runs = [(low, high - low + p, p) for _, p, low, high in rows.tolist() if high - low + p >= max(12, 2 * p)]
    return sorted(runs, key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=90), st.integers(1, 40), st.integers(0, 60), st.sampled_from([8, 16, 64, 4096]))
def test_tiles_give_every_run(words, period, repeated, tile_words):
    words = words + [words[-period:][i % min(period, len(words))] for i in range(repeated)] if words else words
    assert solved(words, tile_words, True) == solved(words, tile_words, False) == plain_runs(words)


@pytest.mark.parametrize("words", [[0] * 500, [0, 1] * 300, list(range(40)) * 9 + [0] * 40, [0] * 11, [0] * 12, list(range(6)) * 2])
def test_regular_texts(words):
    assert solved(words, 16, True) == solved(words, 4096, True) == solved(words, 16, False) == plain_runs(words)


def odd_texts():
    rng = random.Random(3)
    texts = [None, "", " \t\n", "a " * 11, "a " * 12, "\x0bé 漢 " * 9 + "é", "a b c d e f " * 2, "x\xa0y z " * 7]
    for n in (30, 300, 3000):
        words = [rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(n)]
        start, period = n // 5, n // 7
        texts.append(" ".join(words[:start] + [words[start + i % period] for i in range(3 * period)] + words[start:]))
    return texts


@pytest.mark.parametrize(("spread", "tile"), [(1 << 20, 4096), (100, 32)])
def test_operator_on_odd_rows(spark, spread, tile):
    texts = odd_texts()
    rows = [(i % 7 if i % 5 else None, t, "x", i) for i, t in enumerate([*texts, *texts])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, mark string, runs int")
    got = periodic.periodic_runs(docs, spread, tile).collect()
    as_row = lambda i, t: (repr(i), len((t or "").encode().split()), tuple(plain_runs((t or "").encode().split())))
    assert sorted((repr(r["doc_id"]), r["n_words"], tuple(tuple(x) for x in r["runs"])) for r in got) == sorted(as_row(r[0], r[1]) for r in rows)
    texts_of = lambda t: plain_collapsed([w.decode() for w in (t or "").encode().split()], plain_runs((t or "").encode().split()))
    assert sorted(r["collapsed"] for r in got) == sorted(texts_of(r[1]) for r in rows)
    assert periodic.periodic_runs(docs.limit(0)).count() == 0


def test_query_follows_its_contract(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = {r["doc_id"]: r for r in queries.op11_periodic_runs(spark, SF).collect()}
    assert set(got) == set(docs)
    for doc_id, text in docs.items():
        words = [w.decode() for w in (text or "").encode().split()]
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        runs, row = plain_runs(words), got[doc_id]
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        assert (row["n_runs"], row["start"], row["length"], row["period"]) == (len(runs), *best)
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        text = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        assert row["runs_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(plain_collapsed(words, runs).encode()).hexdigest()
