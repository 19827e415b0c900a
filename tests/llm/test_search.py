"""URL filter, nearest vectors, near copies and passages against plain versions."""

import math
import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from pairloom.llm import near_dedup, near_links, nearest, paragraphs, shingles, url_filter
from pairloom.llm.components import components
from pairloom.session import Workspace

SF = "/root/testdata/sf0.001"


def test_components(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1100)] + [(5000, i) for i in range(2000, 2300)]
    edges = spark.createDataFrame([*pairs, (None, 3), (7, 7)], "a long, b long")
    found = {r["node"]: r["component"] for r in components(edges, Workspace(spark)).collect()}
    real = [(a, b) for a, b in pairs if a != b]
    assert found == brute.union_find({n for p in real for n in p}, real)
    assert components(edges.where("false"), Workspace(spark)).count() == 0
    names = {r["node"]: r["component"] for r in components(spark.createDataFrame([("b", "c"), ("a", "c")], "a string, b string"), Workspace(spark)).collect()}
    assert names == dict.fromkeys("abc", "a")


RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def parts_of(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    ends = [rest.find(c) for c in "/?#" if c in rest]
    host, tail = (rest[:min(ends)], rest[min(ends):]) if ends else (rest, "")
    for c in "?#":
        tail = tail.split(c, 1)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), tail


def rule_of(url):
    host, path = parts_of(url)
    fits = [(h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda f: len(f[0]), default=(None, None))


def test_rules_without_links(spark):
    urls = [
        None, "", "no scheme", "http://EXAMPLE.org/es/x?q#f", "https://a.example.org/en/12", "http://notexample.org/es/", "http://example.org/en/2",
        "http://com/fr/", "http://x.com/fr/1", "http://x.com/de/1", "http://x.com/de", "http://x.net/", "http://org", "http://org?x", "ftp://a.b.com#/fr/",
        "http://É.com/de/", "x://://com/de/", "http://x.com/fr/\n?", "http://example.org.com/de/#a?b",
    ] * 2
    pages = spark.createDataFrame([(i, u, None, "z") for i, u in enumerate(urls)], "page_id long, url string, html string, component string")
    found = {r["page_id"]: r for r in url_filter.judge(pages, RULES).collect()}
    assert len(found) == len(urls)
    for i, url in enumerate(urls):
        rule, verdict = rule_of(url)
        assert (found[i]["host"], found[i]["path"], found[i]["rule"], found[i]["verdict"]) == (*parts_of(url), rule, verdict or "allow"), url


def test_block_decisions_reach_aliases(spark):
    link = '<html><head><link href="{}" rel="canonical"></head>'
    pages = spark.createDataFrame([
        (1, "http://a.net/1", link.format("http://x.com/de/1")),            # blocked target that is no page
        (2, "http://a.net/2#top", '<META http-equiv="Refresh" content="0; url=/1">'),  # relative, joins page 1
        (3, "http://b.net/1", link.format("http://x.com/de/2")),            # blocked, but
        (4, "http://b.net/1", link.format("http://x.com/fr/2")),            # explicitly allowed too
        (5, "http://x.com/de/9", link.format("http://x.com/fr/2")),         # own rule comes first
        (6, "http://c.net/", "<!-- " + link.format("http://x.com/de/1") + " -->"),
        (7, "http://c.net/?a=1&b=2", "<link rel='shortcut canonical' href='//c.net/z?a=1&amp;b=2'>"),
        (8, "http://c.net/z?a=1&b=2", None), (9, None, link.format("http://x.com/de/1")), (10, "http://d.net/x/y?z", None),
    ], "page_id long, url string, html string")
    moved = spark.createDataFrame([("http://d.net/x/y?z#q", "HTTP://D.net/w"), ("HTTP://D.net/w", "http://x.com/de/1"), (None, "x")], "a string, b string")
    found = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages, RULES, moved).collect()}
    assert found == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "block", 6: "allow", 7: "allow", 8: "allow", 9: "allow", 10: "block"}
    parts = {r["page_id"]: r["component"] for r in url_filter.judge(pages, RULES).collect()}
    assert parts[1] == parts[2] is not None and parts[7] == parts[8] == "http://c.net/?a=1&b=2" and parts[6] is None
    assert url_filter.judge(pages.where("false"), RULES).count() == 0 and url_filter.judge(pages, []).where("verdict = 'block'").count() == 0


def test_large_components_take_part(spark):
    rows = [(50, [40000.0, 1.0]), (51, [50000.0, -2.0]), (52, [3e38, 3e38]), (100, [-3e38, 2.0]), (101, [0.5, 0.25]), (102, [2.0**40, 1.0]), (103, [2.0**40, 1.5])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = {tuple(r) for r in nearest.top_k(table, F.col("vec_id") % 50 == 0).select("query_id", "rank", "vec_id", "score").collect()}
    real = [(i, np.array(v, np.float32).astype(float).tolist()) for i, v in rows]
    clip = lambda x: min(max(x, -(1 << 63)), (1 << 63) - 1)
    want = set()
    for q, v in real:
        if q % 50 == 0:
            scored = sorted((-clip(sum(math.floor(256 * a) * math.floor(256 * b) for a, b in zip(v, w))), i) for i, w in real if i != q)
            want |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:5])}
    assert found == want


def top_by_hand(rows, k=5):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good[i] = [math.floor(256 * x) for x in v]
    out = set()
    for q, v in good.items():
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good.items() if i != q and len(w) == len(v))
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])}
    return out


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(nearest, "VECTORS_PER_BLOCK", 64)
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 0.2, 8).astype(np.float32).tolist()) for i in range(300)]
    rows += [(300 + i, rows[50][1]) for i in range(120)]  # ties beyond k
    rows += [(1000, None), (1001, [None] * 8), (1002, [float("nan")] * 8), (1003, [float("inf")] * 8), (None, rows[0][1])]
    rows += [(1050, [0.5] * 3), (1051, [1.0] * 3), (1100, []), (1101, []), rows[7], (1150, [90.0] * 8), (1151, [-90.0] * 8)]
    table = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, query_id string")
    found = nearest.top_k(table, F.col("vec_id") % 50 == 0)
    assert {tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect()} == top_by_hand(rows)
    assert nearest.top_k(table.where("false"), F.col("vec_id") % 50 == 0).count() == 0


def near_by_hand(docs):
    return {d: (n, c, d == c) for d, (n, c) in brute.near_groups(docs).items()}


def test_near_groups_of_the_small_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = {r["doc_id"]: tuple(r)[1:] for r in contract.queries()["op4_near_dedup"](spark, SF).collect()}
    assert found == near_by_hand({r["doc_id"]: r["text"] for r in docs.collect()})


def test_near_groups_of_odd_and_hot_rows(spark, odd_docs):
    """Chains of changed copies, a hot group, and a passage that many share."""
    rng = random.Random(9)
    word = lambda: f"v{rng.randrange(5000)}"
    docs = {r["doc_id"]: r["text"] for r in odd_docs.collect()}
    base, common = [word() for _ in range(120)], [word() for _ in range(60)]
    for i in range(150):
        if i % 3 == 0:
            text = list(base)
            for _ in range(rng.randrange(4)):
                text[rng.randrange(120)] = word()
        elif i % 3 == 1:
            text = [word() for _ in range(50)] + common + [word() for _ in range(10)]
        else:
            base = base[4:] + [word() for _ in range(4)]
            text = base
        docs[100 + i] = " ".join(text)
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string").withColumn("bucket", F.lit(1))
    found = {r["doc_id"]: tuple(r)[1:] for r in near_dedup.near_groups(frame).collect()}
    assert found == near_by_hand(docs)
    kept = near_dedup.drop_near_copies(frame)
    assert kept.columns == frame.columns and {r["doc_id"] for r in kept.collect()} == {d for d, v in found.items() if v[2]}


def test_members_of_many_buckets_meet_together(monkeypatch):
    """Links join the same labels as each two members one by one; few groups need no call each."""
    monkeypatch.setattr(near_links, "PAIRS", 200)
    rng, hashing, rows = random.Random(4), shingles.MinHash(4, 2), []
    bounds = shingles.posterior_bounds(8, 4, 0.5, 1e-9)
    for bucket in range(60):
        base = [rng.randrange(1 << 40) for _ in range(12)]
        for i in range(rng.choice([2, 3, 30]) if bucket else 1):
            own = np.unique(np.array(base[:rng.randrange(4, 12)] + [rng.randrange(1 << 40) for _ in range(3)], np.uint64))
            two = bucket % 2
            rows.append((bucket, 0, two, rng.randrange(4), rng.randrange(2) if two else 0, 1000 * bucket + i, 1000 * bucket + i // 2,
                hashing.signatures(own, np.zeros(1, np.int64)).astype("<u4").tobytes(), own.astype("<u8").tobytes()))
    rows.sort(key=lambda r: (*r[:3], r[4]))
    names = ["bucket", "low", "high", "band", "own", "id", "label", "signature", "set"]
    batch = pa.record_batch([pa.array(c) for c in zip(*rows, strict=True)], names)
    calls, real = [], shingles.likely
    monkeypatch.setattr(near_links, "likely", lambda *a: calls.append(1) or real(*a))
    found = near_links._met([batch.slice(0, 7), batch.slice(7)], 4, 2, 50, bounds)
    assert 0 < len(calls) < len(rows) / 4
    links, every = [], {r[6] for r in rows}
    for x in rows:
        for y in rows:
            if x[0] != y[0] or x[5] >= y[5] or x[6] == y[6] or x[2] and x[4] == y[4]:
                continue
            a, b = (np.frombuffer(r[7], "<u4").reshape(1, -1) for r in (x, y))
            p, q = (set(np.frombuffer(r[8], "<u8").tolist()) for r in (x, y))
            same = (a == b).reshape(4, 2).all(1)
            if len(real(a, b, bounds)) and same.argmax() == (x if x[4] <= y[4] and (x[2] or x[5] < y[5]) else y)[3] and 100 * len(p & q) >= 50 * len(p | q):
                links.append((x, y))
    label = {r[5]: r[6] for r in rows}
    want = brute.union_find(every, [(x[6], y[6]) for x, y in links])
    assert links and brute.union_find(every, [(label[a], label[b]) for a, b in found]) == want
    assert len(found) == len(every) - len(set(want.values()))


def test_groups_that_reach_over_batches(spark):
    name, rng = "spark.sql.execution.arrow.maxRecordsPerBatch", random.Random(8)
    base = [f"w{i}" for i in range(80)]
    docs = {}
    for i in range(60):
        base = base[3:] + [f"w{rng.randrange(9000)}" for _ in range(3)]
        docs[i] = " ".join(base)
    before = spark.conf.get(name)
    spark.conf.set(name, 3)
    try:
        found = {r["doc_id"]: tuple(r)[1:] for r in near_dedup.near_groups(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()}
    finally:
        spark.conf.set(name, before)
    assert found == near_by_hand(docs)


def test_bands_of_paragraphs_are_numbered_in_generated_code(spark, monkeypatch):
    """Bands leave the table as they are stored: no function runs on each array in between."""
    seen, real = [], paragraphs.linked_components
    monkeypatch.setattr(paragraphs, "linked_components", lambda items, *a: seen.append(items) or real(items, *a))
    docs = spark.createDataFrame([(i, "the same line of ten words stands in all texts") for i in range(3)], "doc_id long, text string")
    assert paragraphs.repeated_passages(docs, min_passage=8).count() == 3
    assert dict(seen[0].dtypes)["buckets"] == "array<int>"


def test_near_copies_are_dropped_row_by_row(spark):
    """A near copy and a text of its own under one id, copies without an id, and repeated rows."""
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text), (2, text + " more"), (2, "something else of its own to keep here"), (None, text + " and"), (None, "alone " * 9 + "x"),
            (3, "one two three four five"), (3, "one two three four five"), (None, None), (4, ""), (None, "q r s t u v"), (None, "q r s t u v")]
    docs = spark.createDataFrame([(d, t, n) for n, (d, t) in enumerate(rows)], "doc_id long, text string, _at int").repartition(3)
    kept = near_dedup.drop_near_copies(docs)
    assert kept.columns == docs.columns
    found = sorted((str(r["doc_id"]), r["text"] or "") for r in kept.collect())
    want = [rows[i] for i in (0, 2, 4, 5, 7, 8, 9)]
    assert found == sorted((str(d), t or "") for d, t in want)


def test_near_groups_without_ids_or_rows(spark):
    rows = [(None, "a b"), (3, "a b"), (4, "A\tB"), (None, None)]
    found = near_dedup.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted([tuple(r) for r in found], key=str) == sorted([(None, 1, 3, False), (3, 1, 3, True), (4, 1, 3, False), (None, 0, None, False)], key=str)
    assert near_dedup.near_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_posterior_bounds():
    bounds = shingles.posterior_bounds(128, 16, 0.75, 1e-6)
    for n, fewest in bounds:
        tail = lambda k: sum(math.comb(n + 1, i) * 0.75**i * 0.25 ** (n + 1 - i) for i in range(k + 1))
        assert tail(fewest) >= 1e-6 and tail(fewest - 1) < 1e-6


def test_signatures_by_group():
    hashing, rng = shingles.MinHash(3, 4), np.random.default_rng(2)
    items = rng.integers(0, 1 << 63, 5000, dtype=np.uint64)
    starts = np.array([0, 1, 2048, 2049, 4096, 4999])
    found = hashing.signatures(items, starts)
    for i, (a, b) in enumerate(zip(starts, [*starts[1:], 5000], strict=True)):
        assert (found[i] == (items[a:b].astype(np.uint32)[None, :] * hashing.a + hashing.b).min(1)).all()


def sentences(rng, n, size=12):
    return " ".join(" ".join(f"{rng.choice('abcdefgh')}{rng.randrange(9999)}" for _ in range(size)) + "." for _ in range(n))


def test_repeated_passages(spark, odd_docs):
    rng = random.Random(4)
    passage, line = sentences(rng, 12), sentences(rng, 5)
    rows = [
        (1, sentences(rng, 9) + " mid " + passage + " then " + sentences(rng, 3)), (2, sentences(rng, 2) + "\n" + passage + "\n" + sentences(rng, 4)),
        (3, sentences(rng, 20)), (4, line + "\n" + sentences(rng, 3)), (5, sentences(rng, 3) + "\n" + line), (6, line + " tail"),
        (7, "short line here\n" * 5), (8, "short line here\nshort line here"), (None, passage), (9, None), (10, ""), (11, sentences(rng, 8)),
    ]
    docs = spark.createDataFrame([(d, t, 0) for d, t in rows], "doc_id long, text string, number int")
    found = paragraphs.repeated_passages(docs).collect()
    assert {r["doc_id"] for r in found} == {1, 2, 4, 5, 6}
    assert {r["doc_id"] for r in found if r["removed"]} == {2, 5, 6}
    text = dict(rows)
    for r in found:
        words = text[r["doc_id"]].split()[r["first_word"]:r["first_word"] + r["n_words"]]
        assert max(len(set(words) & set(t.split())) for t in (passage, line + " tail")) >= 0.6 * len(set(words))
    odd = {r["doc_id"] for r in paragraphs.repeated_passages(odd_docs).collect()}
    assert odd == {6, 7}
    assert paragraphs.repeated_passages(odd_docs.where("false")).count() == 0


def test_paragraphs_of_a_passage_are_the_same_wherever_it_stands():
    rng = random.Random(8)
    passage = sentences(rng, 15)
    plain = set(paragraphs.Paragraphs(passage.encode()).ids.tolist())
    inside = set(paragraphs.Paragraphs(("before " * 7 + passage + " after" * 30).encode()).ids.tolist())
    assert len(plain & inside) >= len(plain) - 2 >= 1


def test_every_exact_repeat_of_fifty_words_is_found(spark):
    """Passages without sentence ends, set into other words, wrapped anew, and of one word."""
    rng = random.Random(12)
    word = lambda: f"u{rng.randrange(99999)}"
    words = lambda n: [word() for _ in range(n)]
    texts, spans = {}, {}
    for i in range(60):
        passage = words(50 + i % 3) if i else ["same"] * 50
        for j in (0, 1):
            before = words(rng.randrange(90))
            spans[2 * i + j] = (len(before), len(passage))
            body, size = before + passage + words(rng.randrange(90)), (7 if i % 2 else 1000) - j
            texts[2 * i + j] = "\n".join(" ".join(body[a:a + size]) for a in range(0, len(body), size))
    docs = spark.createDataFrame([*texts.items(), (1000, " ".join(words(300)))], "doc_id long, text string")
    covered = {d: set() for d in texts}
    for r in paragraphs.repeated_passages(docs).collect():
        assert r["doc_id"] in covered and r["passage_words"] >= 50 and r["removed"] == (r["doc_id"] % 2 == 1 or r["doc_id"] == 0 and r["removed"])
        covered[r["doc_id"]] |= set(range(r["first_word"], r["first_word"] + r["n_words"]))
    # The whole passage is reported, with no more than the edges of paragraphs that are nearly equal.
    for d, (a, n) in spans.items():
        assert set(range(a, a + n)) <= covered[d] <= set(range(a - 12, a + n + 12))


def test_short_lines_are_joined_to_paragraphs():
    """Changed copies of verse: lines of 3 to 7 words between lines of their own."""
    rng = random.Random(21)
    line = lambda n: " ".join(f"z{rng.randrange(9999)}" for _ in range(n))
    verse = [line(rng.randrange(3, 8)) for _ in range(40)]
    wrapped = " ".join(verse).split()
    wrapped = [" ".join(wrapped[i:i + 6]) for i in range(0, len(wrapped), 6)]
    texts = ["\n".join([line(12), *some, line(20)]) for some in (verse, [line(4), *verse, line(5)], [*wrapped, line(5)])]
    found = [paragraphs.Paragraphs(t.encode()) for t in texts]
    for p in found:
        assert (p.last - p.first >= 8).all() and sum(p.last - p.first) >= len(p.marks) - 7
        assert len(set(p.ids.tolist()) & set(found[0].ids.tolist())) >= 7
    alone = paragraphs.Paragraphs(("\n".join([line(9), "one two", line(9)])).encode())
    assert (alone.last - alone.first).tolist() == [9, 9]


def test_texts_are_worked_on_together_as_each_alone(monkeypatch):
    """Paragraphs and runs of many texts at once, whose different words are hashed once."""
    rng = random.Random(31)
    piece = lambda: rng.choice(["a", "B", "c.", "d!", "\u00e9?", f"x{rng.randrange(50)}"]) + rng.choice([" ", "\n", " \t", "\r\n", "  ", " ", " "])
    sizes = [0, 1, 4, 7, 8, 15, 17, 18, 19, 49, 50, 51, 90, 400]
    texts = [None, b"", b"\n"] + [("".join(piece() for _ in range(rng.choice(sizes)))).encode() for _ in range(300)] + [b"", None]
    hashed, marks = [], paragraphs.word_marks
    monkeypatch.setattr(paragraphs, "word_marks", lambda words: hashed.append(len(words)) or marks(words))
    together = paragraphs.Paragraphs(*texts).find_runs().rows()
    assert hashed == [len({w for t in texts for w in (t or b"").lower().split()})]
    for n, text in enumerate(texts):
        alone = paragraphs.Paragraphs(text).find_runs().rows()
        own = together["whose"] == n
        for name in alone.keys() - {"whose"}:
            assert together[name][own].tolist() == alone[name].tolist()
