"""Tagged unions folded by one aggregate, against first_row and latest_snapshot."""

import pytest
from pyspark.sql import functions as F

import workload as W
from fixtures import fixture
from pairloom.operators import relational as R
from pairloom.operators.fold import Source, descending, fold, taken
from pairloom.session import cut_lineage

SF = "/root/testdata/sf0.001"


def rows(df, *columns):
    return sorted(map(repr, (tuple(r) for r in df.select(*columns).collect())))


def test_descending_texts(spark):
    texts = ["", "a", "ab", "b", "a\x00", "é", "漢", "Z", "2024-01-01", "2024-01", "~"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    up = [r["t"] for r in df.orderBy(descending(F.col("t"))).collect()]
    assert up == [r["t"] for r in df.orderBy(F.desc("t")).collect()]


def test_first_rows_totals_and_newest_versions(spark):
    one = spark.createDataFrame(
        [("a", 1, "x", None), ("a", 1, None, 3.0), ("a", 1, "b", 2.0), ("b", 1, None, None), (None, 1, "n", 1.0), ("a", None, "n", 1.0)],
        "k string, j int, t string, d double",
    )
    two = spark.createDataFrame(
        [("a", 1, "old", "2023"), ("b", 1, "new", "2024"), ("b", 1, "also", "2024"), ("c", 2, "gone", "2022"), (None, 1, "x", "2025"), ("a", 1, "?", None)],
        "k string, j int, u string, v string",
    )
    plain = Source("one", one, ["t", "d"])
    by_d = Source("best", one.withColumnsRenamed({"t": "bt", "d": "bd"}), ["bd", "bt"], order=[F.col("bd").isNull(), -F.col("bd")])
    total = Source("sum", one, totals={"top": (F.max, "d"), "n": (F.count, "j")})
    versioned = Source("two", two.where("k is not null"), ["u"], version=F.col("v"), when=F.col("u") != "new")
    sources = [plain, by_d, total, versioned]
    known = cut_lineage(fold(["k", "j"], sources))
    every = known.select("k", "j", *[c.alias(n) for s in sources for n, c in taken(known, s).items()]).where("k is not null and j is not null")
    got = {(r["k"], r["j"]): (r["t"], r["d"], r["bd"], r["bt"], r["top"], r["n"], r["u"]) for r in every.collect()}
    assert got == {
        ("a", 1): ("b", 2.0, 3.0, None, 3.0, 3, None), ("b", 1): (None, None, None, None, None, 1, "also"),
        ("c", 2): (None, None, None, None, None, 0, None),
    }
    # A newer version that a row without key, or one that isn't taken, brings still counts.
    later = Source("two", two, ["u"], version=F.col("v"))
    known = cut_lineage(fold(["k", "j"], [later]))
    assert known.select(*[c.alias(n) for n, c in taken(known, later).items()]).where("u is not null").count() == 0


@pytest.mark.parametrize("keys", [["sku"], ["sku", "source_store"]])
def test_fold_equals_first_row(spark, keys):
    catalog = fixture(spark, SF, "fx_catalog").select("sku", "source_store", "capture_date", "product_title", "list_price")
    source = Source("c", catalog, ["product_title", "list_price", "capture_date"], [F.col("capture_date").isNull(), descending(F.col("capture_date"))])
    known = cut_lineage(fold(keys, [source]))
    names = ["product_title", "list_price", "capture_date"]
    found = known.select(*keys, *[c.alias(n) for n, c in taken(known, source).items()])
    want = R.first_row(catalog.select(*keys, *names), keys, [F.col("capture_date").desc_nulls_last()])
    assert rows(found, *keys, *names) == rows(want, *keys, *names)


def test_each_source_of_the_report_is_scanned_once(spark, tmp_path, monkeypatch):
    """Every source is a table of its own, so its scans can be counted in all plans that run."""
    from pairloom.plans import coverage
    from pairloom import session

    plans, paths = [], {}
    real = session.Workspace.save

    def save(self, df, *by):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(self, df, *by)

    for name in ("fx_pairs", *W.SOURCES.values()):
        paths[name] = str(tmp_path / name)
        fixture(spark, SF, name).write.parquet(paths[name])
    tables = {n: spark.read.parquet(p) for n, p in paths.items()}
    monkeypatch.setattr(session.Workspace, "save", save)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    sources = coverage.CoverageSources(**{k: tables[n] for k, n in W.SOURCES.items()})
    report = coverage.coverage_report(tables["fx_pairs"], sources, W.TENANT, W.SEGMENT, W.COMPETITORS, W.RUN_DATE)
    plans.append(report._jdf.queryExecution().executedPlan().toString())
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = {n: sum(line.count(f"{p}]") for plan in plans for line in plan.splitlines() if "FileScan" in line) for n, p in paths.items()}
    assert scans == dict.fromkeys(paths, 1)
    assert plans[-1].count("Exchange hashpartitioning") <= 4
