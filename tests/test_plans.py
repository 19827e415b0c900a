"""Composite queries: hot keys, options and the traps of hand-made rows."""

import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import workload as W
from fixtures import COMPETITORS, RUN_DATE, SEGMENT, TENANT, fixture
from pairloom import schemas
from pairloom.operators import relational as R
from pairloom.plans import approval, coverage, examples, recall, reports, retriever, review_queue, taxonomy, training
from pairloom.session import cut_lineage
from pairloom.streaming import drops

SF = "/root/testdata/sf0.001"


def frame(spark, ddl, *rows):
    """Rows given as dicts; missing columns are null."""
    schema = schemas.struct(ddl)
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)


def same(left, right):
    key = lambda df: sorted(map(repr, (tuple(r) for r in df.select(*sorted(df.columns)).collect())))
    assert key(left) == key(right)


def skewed(pairs):
    """A third of the pairs moves to one base SKU and another part to one competitor product."""
    return pairs.withColumns({
        "base_sku": F.when(F.crc32("comp_sku") % 3 == 0, "1a").otherwise(F.col("base_sku")),
        "comp_sku": F.when(F.crc32("base_sku") % 3 == 1, "1c").otherwise(F.col("comp_sku")),
    })


@pytest.mark.parametrize("strict", [False, True])
def test_coverage_with_hot_keys(spark, strict):
    pairs = skewed(fixture(spark, SF, "fx_pairs"))
    sources = coverage.CoverageSources(**{k: fixture(spark, SF, n) for k, n in W.SOURCES.items()})
    run = lambda hot: coverage.coverage_report(
        pairs, sources, TENANT, SEGMENT, COMPETITORS, RUN_DATE, strict=strict, hot_parts=hot
    )
    report = run(1000)
    assert len(report.columns) == 62
    same(report, run(1))
    assert report.count() == report.select("base_sku", "comp_sku", "comp_source_store").distinct().count()


def test_queue_with_hot_keys_and_options(spark):
    pairs = skewed(fixture(spark, SF, "fx_pairs"))
    tables = [fixture(spark, SF, n) for n in ("fx_library", "fx_input_precision", "fx_catalog", "fx_warehouse")]
    domains = W.domains_of(fixture(spark, SF, "fx_domains"))
    run = lambda config, hot=1: review_queue.build_review_queue(pairs, *tables, domains, config, hot)
    plain = run(W.QUEUE_CONFIG)
    assert plain.columns == review_queue.QUEUE_COLUMNS and len(plain.columns) == 71
    same(plain, run(W.QUEUE_CONFIG, 1000))
    same(plain, run(replace(W.QUEUE_CONFIG, strict=True)))
    filled = run(replace(W.QUEUE_CONFIG, mandatory=("base_title", "comp_title")))
    assert 0 < filled.count() < plain.count() and filled.where("base_title = '' or comp_title is null").count() == 0
    few = run(replace(W.QUEUE_CONFIG, pair_filter="comp_source_store = 'r0_r0'"))
    assert few.select("comp_source_store").distinct().collect()[0][0] == "r0_r0"
    random = run(replace(W.QUEUE_CONFIG, random_index=True, partition_date="2024-01-05"))
    assert random.where("enqueue_index not between 10000 and 99999").count() == 0


def approval_inputs(spark, drop, **changes):
    catalog = frame(spark, schemas.CATALOG, *[
        {"sku": s, "source": "acme", "capture_date": "2024-02-01", "list_price": p, "product_title": "t", "upc": "1,2"}
        for s, p in changes.get("prices", {"7": "10"}).items()
    ])
    warehouse = frame(spark, schemas.WAREHOUSE, *[
        {"sku": "5", "source_store": f"{r}<>{r}", "source_name": r, "store_name": r, "product_segment": "pets", "list_price": 11.0}
        for r in ("r0", "r1")
    ])
    library = frame(spark, schemas.LIBRARY, *changes.get("library", []))
    domains = frame(spark, schemas.DOMAINS, *[{"client": "acme", "primary": f"{r}_{r}"} for r in ("r0", "r1")])
    config = approval.ApprovalConfig("acme", "pets", **changes.get("config", {}))
    return approval.auto_approve(frame(spark, "base_sku string, comp_sku string, comp_source_store string", *drop),
                                 catalog, warehouse, library, domains, config)


DROP = [{"base_sku": " 007 ", "comp_sku": "05", "comp_source_store": "R0<>R0"}]
ENTRY = {"company_code": "acme", "load_date": "2024-01-01", "base_sku": "07", "comp_sku": "0005", "comp_source_store": "r0_r0"}


def test_approve_joins_without_zeros_and_uses_defaults(spark):
    row = approval_inputs(spark, DROP).first()
    assert (row["base_sku"], row["comp_sku"], row["comp_source_store"], row["score"], row["match"]) == ("007", "05", "r0_r0", "100", "exact")
    assert row["base_upc"] == "1" and row["base_source_store"] == "acme_acme" and len(row) == 36


@pytest.mark.parametrize("entry, rows", [
    ({}, 0),                                                         # live match of this pair
    ({"deleted_date": "2024-01-01"}, 0),                             # rejected before
    ({"comp_sku": "9"}, 0),                                          # base matched at this store
    ({"comp_sku": "9", "deleted_date": "2024-01-01"}, 1),            # that match was deleted
    ({"comp_sku": "9", "comp_source_store": "r1_r1"}, 1),            # matched elsewhere
    ({"company_code": "other"}, 1),
    ({"base_sku": None}, 1),
])
def test_approve_exclusions(spark, entry, rows):
    assert approval_inputs(spark, DROP, library=[ENTRY | entry]).count() == rows


@pytest.mark.parametrize("price, rows", [("10", 1), ("nan", 0), ("0", 0), ("", 0), ("6", 0), ("-50", 0), (None, 0)])
def test_approve_price_rule(spark, price, rows):
    assert approval_inputs(spark, DROP, prices={"7": price}).count() == rows


def test_approve_negative_price_strict_and_best_row(spark):
    assert approval_inputs(spark, DROP, prices={"7": "-50"}, config={"strict": True}).count() == 1
    two = DROP + [{"base_sku": "007", "comp_sku": "05", "comp_source_store": "r1_r1"}]
    assert approval_inputs(spark, two).collect()[0]["comp_source_store"] == "r0_r0"
    assert approval_inputs(spark, two, config={"competitors": ["r1_r1"]}).collect()[0]["comp_source_store"] == "r1_r1"


def test_approve_needs_a_registered_store(spark):
    drop = spark.createDataFrame([("a", "b", "r<>r")], "base_sku string, comp_sku string, comp_source_store string")
    with pytest.raises(ValueError, match="acme"):
        approval.auto_approve(drop, *[spark.range(1)] * 3, frame(spark, schemas.DOMAINS), approval.ApprovalConfig("acme", "pets"))


def test_approve_meets_each_price_once(spark):
    """Repeated and all-zero SKUs: a pair meets each different price of a product, not each version of it."""
    domains = frame(spark, schemas.DOMAINS, {"client": "acme", "primary": "r_r"})
    catalog = frame(spark, schemas.CATALOG, *[
        {"sku": "0" * (n % 3 + 1), "source": "acme", "capture_date": "d", "list_price": str(10 + n % 2), "product_title": f"t{n}"} for n in range(40)
    ])
    config = approval.ApprovalConfig("acme", "pets")
    side = approval._base_side(catalog, config)
    assert sorted((r["_base"], r["base_price"], r["base_title"]) for r in side.collect()) == [("", "10", "t0"), ("", "11", "t1")]
    warehouse = frame(spark, schemas.WAREHOUSE, *[
        {"sku": "00", "source_store": "r<>r", "source_name": "r", "store_name": "r", "product_segment": "pets",
         "list_price": 10.0, "product_title": f"w{n}"} for n in range(30)
    ])
    sold = approval._comp_side(warehouse, R.competitor_stores(domains, "acme"), config)
    assert [(r["_comp"], r["comp_title"]) for r in sold.collect()] == [("", "w0")]


def test_approve_needs_columns(spark):
    with pytest.raises(ValueError, match="comp_sku"):
        approval.auto_approve(spark.createDataFrame([("a",)], "base_sku string"), *[spark.range(1)] * 3,
                              frame(spark, schemas.DOMAINS), approval.ApprovalConfig("acme", "pets"))


def test_training_prefers_the_library(spark):
    pair = {"base_sku": "1", "base_source_store": "acme_acme", "comp_sku": "2", "comp_source_store": "r_r"}
    library = frame(spark, schemas.LIBRARY, pair | {"company_code": "acme", "load_date": "d", "active": True, "match": "exact", "base_title": "b", "comp_title": " "})
    reviews = frame(spark, schemas.REVIEWS, pair | {"answer": "not_a_match", "year": "2024", "month": "01"},
                    pair | {"comp_sku": "3", "answer": "not_a_match", "year": "2023", "month": "12"})
    catalog = frame(spark, schemas.CATALOG)
    warehouse = frame(spark, schemas.WAREHOUSE, {"sku": "2", "source_store": "r<>r", "product_segment": "b", "product_title": "later"},
                      {"sku": "2", "source_store": "r<>r", "product_segment": "a", "product_title": "first"})
    for hot in (1000, 1):
        rows = training.training_pairs(library, reviews, catalog, warehouse, "acme", "d", hot_parts=hot).collect()
        assert [(r["answer"], r["base_title"], r["comp_title"]) for r in rows] == [("exact", "b", "first")]
        assert rows[0]["pair_id"] == "1<>acme<>acme<>2<>r<>r"


# --- taxonomy ----------------------------------------------------------------

def nodes(spark):
    tables = [fixture(spark, SF, n) for n in ("fx_tax_base", "fx_tax_comp", "fx_tax_embeddings")]
    return tables


def test_incremental_over_a_full_mapping_changes_nothing(spark):
    base, comp, vectors = nodes(spark)
    names = ["africa", "america", "asia", "europe", "middle east"]
    full = taxonomy.map_taxonomy(base, comp, vectors, W.MAPPING)
    same(full, taxonomy.map_taxonomy_incremental(base, comp, full, names, vectors, replace(W.MAPPING, fit_on="all")))
    ranks = full.groupBy(*taxonomy.BASE, "retailer").agg(F.max("rank").alias("m"), F.count("*").alias("n"))
    assert full.count() > 0 and ranks.where("m <> n").count() == 0
    part = full.where("crc32(comp_subcategory) % 2 = 0 and base_sub_subcategory is not null")
    same(full, taxonomy.map_taxonomy_incremental(base, comp, part, names, vectors, replace(W.MAPPING, fit_on="all")))


def counted_meetings(monkeypatch):
    """Numbers of base and comp nodes that are scored against each other from now on."""
    met, real = [], taxonomy._scored
    monkeypatch.setattr(taxonomy, "_scored", lambda b, c, *a: met.append((b.count(), c.count())) or real(b, c, *a))
    return met


def test_incremental_scores_nothing_for_an_unchanged_input(spark, monkeypatch):
    base, comp, vectors = nodes(spark)
    names = ["africa", "america", "asia", "europe", "middle east"]
    full = cut_lineage(taxonomy.map_taxonomy(base, comp, vectors, W.MAPPING))
    met = counted_meetings(monkeypatch)
    same(full, taxonomy.map_taxonomy_incremental(base, comp, full, names, vectors, W.MAPPING, compared=(base, comp)))
    assert met == []
    old = W.previous_nodes(base, comp)
    known = full.where("base_category <> 'SMALL' and retailer <> 'asia'")
    config = replace(W.MAPPING, fit_on="all")
    # Blocks of another shape may differ in the last digit of a product.
    again = taxonomy.map_taxonomy_incremental(base, comp, known, names, vectors, config, compared=old)
    same(W._rounded(full), W._rounded(again))
    small, asia = base.where("category = 'SMALL'").count(), comp.where("retailer = 'asia'").count()
    assert met == [(small, comp.count()), (base.count() - small, asia)]


def test_mapping_store(spark, tmp_path, monkeypatch):
    """Runs one after the other: first in full, then nothing, then only changed and new nodes."""
    base, comp, vectors = (cut_lineage(t) for t in nodes(spark))
    names, config = ["africa", "america", "asia", "europe", "middle east"], replace(W.MAPPING, fit_on="all")
    store = taxonomy.MappingStore(spark, str(tmp_path / "m"))
    met = counted_meetings(monkeypatch)
    full = taxonomy.update_mapping(base, comp, names, vectors, config, store)
    n_base, n_comp = base.count(), comp.count()
    assert store.newest() is not None and met == [(n_base, n_comp)]
    same(full, taxonomy.update_mapping(base, comp, names, vectors, config, store))
    assert len(met) == 1
    # One base node's text gets another embedding: it alone meets all competitors again, and its earlier rows go.
    best = full.orderBy(F.desc("combined_score"), *taxonomy.PAIR_KEYS).first()
    text = " ".join(best[c] for c in taxonomy.BASE if best[c])
    turned = vectors.withColumn("embedding", F.when(F.col("title") == text, F.transform("embedding", lambda x: -x)).otherwise(F.col("embedding")))
    changed = taxonomy.update_mapping(base, comp, names, turned, config, store)
    assert len(met) == 2 and met[1][0] < 5 and met[1][1] == n_comp
    same(W._rounded(changed), W._rounded(taxonomy.map_taxonomy(base, comp, turned, config)))
    # A node that is gone for a run and comes back isn't compared again.
    fewer = base.where("category <> 'SMALL'")
    taxonomy.update_mapping(fewer, comp, names, turned, config, store)
    calls = len(met)
    taxonomy.update_mapping(base, comp, names, turned, config, store)
    assert len(met) == calls


def test_a_mapping_that_stops_before_its_manifest_changes_nothing(spark, tmp_path, monkeypatch):
    base, comp, vectors = nodes(spark)
    store = taxonomy.MappingStore(spark, str(tmp_path / "m"))
    mapping = spark.createDataFrame([], taxonomy.map_taxonomy(base.limit(1), comp.limit(1), vectors, W.MAPPING).schema)
    store.commit(mapping, base.limit(2), comp.limit(1), vectors)
    monkeypatch.setattr(taxonomy.versions, "commit", lambda *_: (_ for _ in ()).throw(OSError()))
    with pytest.raises(OSError):
        store.commit(mapping, base, comp, vectors)
    assert store.newest()[1].count() == 2


def test_incremental_drops_retailers_and_vanished_nodes(spark):
    levels = "category string, subcategory string, sub_subcategory string"
    base = spark.createDataFrame([("SMALL", "toys", None), ("PROMO", "toys", None), ("PROMO", "food", "raw")], levels)
    comp = spark.createDataFrame([("asia", "toys", "balls", None), ("asia", "food", "raw", "x"), ("europe", "toys", None, None)], f"retailer string, {levels}")
    texts = taxonomy._texts(taxonomy._named(base, "base"), taxonomy._named(comp, "comp"))
    # Alike enough that every pair passes.
    vectors = texts.select("title", F.array(F.lit(1.0), F.length("title") / 100).cast("array<float>").alias("embedding"))
    full = taxonomy.map_taxonomy(base, comp, vectors, W.MAPPING)
    assert full.where("base_category = 'SMALL' and retailer = 'asia'").count() == 2
    run = lambda b, **kw: taxonomy.map_taxonomy_incremental(
        b, comp.where("retailer = 'asia'"), full, ["asia"], vectors, replace(W.MAPPING, fit_on="all", **kw))
    assert {r[0] for r in run(base).select("retailer").distinct().collect()} == {"asia"}
    fewer = base.where("category <> 'SMALL'")
    assert run(fewer).where("base_category = 'SMALL'").count() > 0
    assert run(fewer, prune_vanished=True).where("base_category = 'SMALL'").count() == 0
    high = taxonomy.map_taxonomy_incremental(base, comp, full, ["asia"], vectors, replace(W.MAPPING, threshold=0.75))
    assert high.where("combined_score < 0.75").count() == 0 and full.where("combined_score < 0.75").count() > 0
    with pytest.raises(ValueError):
        taxonomy.map_taxonomy_incremental(base, comp, full, ["asia"], vectors, replace(W.MAPPING, fit_on="old"))


# --- examples and retriever --------------------------------------------------

def test_combine_prefers_own_and_label_order(spark):
    ddl = ", ".join(f"{c} string" for c in examples.EXAMPLE_COLUMNS)
    pair = {"base_sku": "1", "base_source_store": "a_a", "comp_sku": "2", "comp_source_store": "r_r"}
    own = frame(spark, ddl, pair | {"match_norm": "not_a_match"}, pair | {"match_norm": "exact_match"})
    synth = frame(spark, ddl + ", base_segment string", pair | {"match_norm": "equivalent_match", "base_segment": "s"},
                  pair | {"comp_sku": "3", "match_norm": "equivalent_match", "base_segment": "s"})
    both = examples.collect_examples(own, synth, True)
    assert sorted((r["comp_sku"], r["match_norm"], r["base_segment"]) for r in both.collect()) == [("2", "exact_match", None), ("3", "equivalent_match", "s")]
    assert examples.collect_examples(own, synth, False).count() == 1
    dist = {r["match_norm"]: (r["count"], r["percent"], r["low"]) for r in reports.label_distribution(both, examples.LABELS).collect()}
    assert dist == {"exact_match": (1, 50.0, True), "equivalent_match": (1, 50.0, True), "not_a_match": (0, 0.0, True)}
    assert reports.brand_counts(both).first().asDict() == {"brand": "unknown", "count": 2}


def test_examples_with_hot_keys(spark):
    tables = [fixture(spark, SF, n) for n in W.EXAMPLE_TABLES]
    mapping = W.mapping_of(tables[3])
    same(examples.own_examples(*tables, TENANT, hot_parts=1000), examples.own_examples(*tables, TENANT))
    run = lambda hot: examples.synthetic_examples(*tables, mapping, COMPETITORS, TENANT, None, hot)
    same(run(1), run(1000))


def test_validation(spark):
    good = {c: "x" for c in retriever.REQUIRED} | {"match_norm": "exact_match"}
    ddl = ", ".join(f"{c} string" for c in retriever.REQUIRED)
    assert retriever.validate_examples(frame(spark, ddl, good), examples.LABELS).count() == 1
    for bad, message in ((frame(spark, ddl), "no examples"), (frame(spark, ddl, good | {"match_norm": "maybe"}), "maybe"),
                         (frame(spark, ddl, good | {"match_norm": None}), "unknown label"), (frame(spark, "a string"), "lack")):
        with pytest.raises(ValueError, match=message):
            retriever.validate_examples(bad, examples.LABELS)


def test_retriever_levels_null_brand_and_unknown_terms(spark):
    ddl = ", ".join(f"{c} string" for c in examples.EXAMPLE_COLUMNS)
    rows = frame(spark, ddl, *[
        {"base_sku": str(i), "base_source_store": "a_a", "comp_sku": "c", "comp_source_store": "r_r", "base_title": t, "comp_title": t,
         "base_category": "cat", "base_subcategory": f"sub{i}"}
        for i, t in enumerate(["red ball", "blue ball", "green car"])
    ])
    index = retriever.build_retriever(rows, "segment")
    assert index.rows.where("q like '%None%' or q like '%null%'").count() == 0
    asked = spark.createDataFrame([(1, "blue ball"), (2, "sub2"), (3, "zzz")], "query_id int, q string")
    found = retriever.query(index, asked, 20)
    best = {r["query_id"]: r["row_id"] for r in found.where("rank = 1").collect()}
    assert best[1].startswith("1<>") and best[2].startswith("2<>")
    assert found.groupBy("query_id").count().where("count <> 3").count() == 0
    assert found.where("query_id = 3 and score <> 0").count() == 0
    one = retriever.build_index(spark.createDataFrame([("x", "only one")], "row_id string, q string"))
    assert retriever.query(one, asked).count() == 3


# --- recall and drops --------------------------------------------------------

def test_recall_is_idempotent(spark):
    rows = fixture(spark, SF, "fx_recall")
    once = recall.dedupe_recall(rows)
    same(once, recall.dedupe_recall(once))
    assert recall.recall_stats(once).where("removed > 0").count() == 0


KEYS = [
    ("in/company_code%3Da/product_segment=p/load_date=2024-01-01/_SUCCESS", "accepted", None),
    ("in/company_code=a/product_segment=p/load_date=2024-01-01/_SUCCESS", "skipped", "repeated event"),
    ("in/company_code=a/product_segment=x%3Dy/load_date=2024-01-01/_SUCCESS", "accepted", None),
    ("in/company_code=a/product_segment=p/load_date=2024-01-01/part.csv", "ignored", "suffix mismatch"),
    ("in/company_code=/product_segment=p/_SUCCESS", "ignored", "missing company_code, load_date"),
    ("in/%zz/company_code=a/company_code=b/company_code=/product_segment=p/load_date=d/_SUCCESS", "accepted", None),
    ("in/xcompany_code=a/product_segment=p/load_date=d/_SUCCESS", "ignored", "missing company_code"),
]


def test_drop_keys(spark):
    events = spark.createDataFrame(
        [(i, "b", k, None) for i, (k, _, _) in enumerate(KEYS)], "event_id long, bucket string, key string, ts timestamp"
    )
    rows = drops.accept_once(events).orderBy("event_id").collect()
    assert [(r["action"], r["reason"]) for r in rows] == [(a, w) for _, a, w in KEYS]
    assert rows[0]["input_prefix"] == "s3://b/in/company_code=a/product_segment=p/load_date=2024-01-01/"
    assert rows[2]["product_segment"] == "x=y" and rows[5]["company_code"] == "b"


def test_drop_stream_matches_batch(spark, tmp_path):
    events = fixture(spark, SF, "fx_events").withColumn("ts", F.col("ts").cast("timestamp"))
    events.write.parquet(str(tmp_path / "events"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "events"))
    writer = drops.accept_stream(stream, delay="400 days").writeStream.outputMode("append").format("parquet")
    run = writer.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(str(tmp_path / "out"))
    run.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out")).select("input_prefix")
    want = drops.accept_once(events).where("action = 'accepted'").select("input_prefix")
    same(got, want)


def test_repeated_and_null_event_ids(spark):
    key = "in/company_code=a/product_segment=p/load_date=d/_SUCCESS"
    other = key.replace("=a/", "=b/")
    rows = [(1, "b", key, 5), (1, "b", key, 5), (None, "b", other, 3), (None, "b", other, 4), (None, "b", other, 3), (2, "b", "x", 1)]
    events = spark.createDataFrame(rows, "event_id long, bucket string, key string, at long").withColumn("ts", F.timestamp_seconds("at"))
    found = drops.accept_once(events)
    assert found.count() == len(rows)
    accepted = [(r["event_id"], r["at"]) for r in found.where("action = 'accepted'").collect()]
    assert sorted(accepted, key=str) == [(1, 5), (None, 3)]
    assert found.where("action = 'skipped'").count() == 3


def test_drop_stream_forgets_after_the_delay(spark, tmp_path):
    key = "in/company_code={}/product_segment=p/load_date=d/_SUCCESS"
    ddl = "event_id long, bucket string, key string, at long"
    for n, (name, minute) in enumerate([("a", 0), ("a", 30), ("b", 300), ("c", 360), ("a", 370), ("a", 375)]):
        row = spark.createDataFrame([(n, "b", key.format(name), minute * 60)], ddl)
        row.withColumn("ts", F.timestamp_seconds("at")).coalesce(1).write.parquet(str(tmp_path / "in" / f"{n}"))
        for file in (tmp_path / "in" / f"{n}").glob("*.parquet"):
            os.utime(file, (1_700_000_000 + n, 1_700_000_000 + n))  # files are taken in this order
    schema = spark.read.parquet(str(tmp_path / "in" / "0")).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    writer = drops.accept_stream(stream, delay="1 hour").writeStream.outputMode("append").format("parquet")
    run = writer.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(str(tmp_path / "out"))
    run.awaitTermination(180)
    got = sorted(r["event_id"] for r in spark.read.parquet(str(tmp_path / "out")).collect())
    # Of the first two, within the delay, one counts; after it the drop is accepted anew.
    assert got[0] in (0, 1) and got[1:] == [2, 3, 4]


def drop_events_of(spark, folder, rows, ddl, order):
    """One file per row, taken by a stream in this order."""
    spark.createDataFrame([rows], ddl).withColumn("ts", F.timestamp_seconds("at")).coalesce(1).write.parquet(str(folder / f"{order}"))
    for file in (folder / f"{order}").glob("*.parquet"):
        os.utime(file, (1_700_000_000 + order, 1_700_000_000 + order))


def test_drop_stream_releases_a_prefix_when_its_run_ends(spark, tmp_path):
    """Drops at 0, 10, 30, 45 and 300 minutes; the run ends at 20, so the drop at 30 starts another, and one that never ends expires."""
    key, prefix = "in/company_code={}/product_segment=p/load_date=d/_SUCCESS", "s3://b/in/company_code={}/product_segment=p/load_date=d/"
    events, ends = "event_id long, bucket string, key string, at long", "input_prefix string, at long"
    for n, (who, minute) in enumerate([("a", 0), ("a", 10), ("b", 15), ("a", 30), ("a", 45), ("a", 300), ("b", 310)]):
        drop_events_of(spark, tmp_path / "in", (n, "b", key.format(who), 1_700_000_000 + minute * 60), events, n)
    drop_events_of(spark, tmp_path / "done", (prefix.format("a"), 1_700_000_000 + 20 * 60), ends, 0)
    read = lambda name, ddl: spark.readStream.schema(schemas.struct(ddl + ", ts timestamp")).parquet(str(tmp_path / name / "*"))
    stream = drops.accept_stream(read("in", events), delay="2 hours", finished=read("done", ends))
    run = stream.writeStream.outputMode("append").format("parquet").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True)
    run.start(str(tmp_path / "out")).awaitTermination(120)
    got = {r["event_id"]: (r["action"], r["reason"], r["input_prefix"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    busy = "skipped", "in flight"
    assert {k: v[:2] for k, v in got.items()} == {
        0: ("accepted", None), 1: busy, 2: ("accepted", None), 3: ("accepted", None), 4: busy, 5: ("accepted", None), 6: ("accepted", None),
    }
    assert got[2][2] == prefix.format("b")


def test_runs_of_a_hot_prefix_and_of_null_times(spark):
    """Batch: a third of the events under one prefix, a third ignored ones without prefix; the hot one is spread and judged alike."""
    key = "in/company_code={}/product_segment=p/load_date=d/_SUCCESS"
    rows = [(i, "b", key.format("hot") if i % 3 == 0 else "x" if i % 3 == 1 else key.format(i), i if i % 30 else None) for i in range(600)]
    events = spark.createDataFrame(rows, "event_id long, bucket string, key string, at long").withColumn("ts", F.timestamp_seconds("at"))
    prefix = "s3://b/in/company_code=hot/product_segment=p/load_date=d/"
    ends = spark.createDataFrame([(prefix, 100), (prefix, 301), ("s3://none/", 5), (None, 6)], "input_prefix string, at long").withColumn("ts", F.timestamp_seconds("at"))
    for parts in (1, 50):
        found = drops.accept_once(events, finished=ends, hot_parts=parts)
        assert found.count() == 600 and found.where("action = 'ignored'").count() == 200
        starts = [r["event_id"] for r in found.where("action = 'accepted'").where(F.col("input_prefix") == prefix).orderBy("at").collect()]
        assert starts == [3, 102, 303]


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_training_reads_labels_once(spark):
    tables = [fixture(spark, SF, n) for n in ("fx_library", "fx_reviews", "fx_catalog", "fx_warehouse")]
    rows = training.training_pairs(*tables, TENANT, "1998-01-01", W.SINCE)
    assert plan_of(rows).count("l_orderkey") <= plan_of(training.labelled(*tables[:2], TENANT, "1998-01-01", W.SINCE)).count("l_orderkey")


def test_approval_moves_decided_pairs_once_before_they_are_distinct(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = W.QUERIES["auto_approve"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Distinct by all seven columns, without an exchange by them.
    assert not [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "score" in x.split("]")[0].split(", ENSURE")[0]]


def test_queue_works_products_out_before_joining(spark):
    assert "_extract_" not in plan_of(W.QUERIES["review_queue"](spark, SF))


def test_coverage_looks_stores_up_in_a_map(spark, monkeypatch):
    joined, plain = {}, coverage.skew.join_spread
    monkeypatch.setattr(coverage.skew, "join_spread", lambda left, right, *rest: joined.update(dict(right.dtypes)) or plain(left, right, *rest))
    W.QUERIES["coverage_report"](spark, SF)
    assert joined["stores"].startswith("map<string,struct<")


def test_a_short_mapping_is_broadcast(spark):
    tables = [fixture(spark, SF, n) for n in W.EXAMPLE_TABLES]
    rows = examples.synthetic_examples(*tables, W.mapping_of(tables[-1]), COMPETITORS, TENANT, SEGMENT)
    assert any("LeftSemi" in x and "strategy=broadcast" in x for x in plan_of(rows).splitlines())


def test_examples_read_labels_once(spark):
    tables = [fixture(spark, SF, n) for n in W.EXAMPLE_TABLES]
    assert "l_orderkey" not in plan_of(examples.own_examples(*tables, TENANT))
