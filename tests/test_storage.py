"""Readers and writers on small files."""

import json

import pytest
from pyspark.sql import functions as F

from pairloom.plans import recall, retriever
from pairloom.schemas import struct
from pairloom.sources import readers, writers

REQUIRED = ["base_sku", "comp_sku", "comp_source_store"]


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)
    return str(folder)


def test_read_partitions_skips_missing(spark, tmp_path):
    base = str(tmp_path / "t")
    spark.range(3).withColumn("v", F.lit("x")).write.parquet(f"{base}/segment=pets/year=2025/month=12")
    paths = readers.partition_paths(["2025-12", "2026-01"], segment="pets")
    assert paths == ["segment=pets/year=2025/month=12", "segment=pets/year=2026/month=01"]
    df = readers.read_partitions(spark, base, paths, struct("id bigint, v string, segment string, year int, month int"))
    assert sorted(df.collect())[0].asDict() == {"id": 0, "v": "x", "segment": "pets", "year": 2025, "month": 12}
    assert readers.read_partitions(spark, base, paths).count() == 3


def test_read_partitions_merges_schemas_and_skips_corrupt_files(spark, tmp_path):
    base = tmp_path / "t"
    spark.range(2).write.parquet(f"{base}/p=1")
    spark.range(2).withColumn("extra", F.lit(1)).write.parquet(f"{base}/p=2")
    (base / "p=2" / "broken.parquet").write_text("not parquet")
    df = readers.read_partitions(spark, str(base), ["p=1", "p=2"], skip_bad=True)
    assert df.count() == 4 and "extra" in df.columns
    skipped = [r["file"] for r in readers.files_without_rows(spark, str(base), ["p=1", "p=2"]).collect()]
    assert [s.rsplit("/", 1)[1] for s in skipped if "broken" in s] == ["broken.parquet"]
    assert all("part-" in s for s in skipped if "broken" not in s)
    with pytest.raises(Exception, match="broken"):
        readers.read_partitions(spark, str(base), ["p=1", "p=2"]).collect()


def test_read_partitions_empty_is_typed(spark, tmp_path):
    schema = struct("a string, b double")
    df = readers.read_partitions(spark, str(tmp_path / "none"), ["x=1"], schema)
    assert df.schema == schema and df.count() == 0
    assert readers.read_partitions(spark, str(tmp_path / "none")).columns == ["dummy"]


def test_read_partitions_falls_back_to_recursive(spark, tmp_path):
    base = str(tmp_path / "t")
    spark.range(1).write.parquet(f"{base}/a=1")
    spark.range(1).write.parquet(f"{base}/a=1/b=2/c")
    assert readers.read_partitions(spark, base).count() == 2


def test_latest_partition_comes_from_folder_names(spark, tmp_path):
    for day in ("2024-01-02", "2024-03-01", "2023-12-31"):
        put(tmp_path / "t" / f"load_date={day}", "part-0.parquet", "not parquet at all")
    put(tmp_path / "t" / "load_date=__HIVE_DEFAULT_PARTITION__", "x", "")
    put(tmp_path / "t" / "other=9", "x", "")
    assert readers.latest_partition_value(spark, str(tmp_path / "t"), "load_date") == "2024-03-01"
    assert readers.latest_partition_value(spark, str(tmp_path / "t"), "day") is None


def test_read_drop(spark, tmp_path):
    folder = put(tmp_path / "d", "a.csv", '"Base_SKU",comp_sku,COMP_SOURCE_STORE,score\n007,"1,2",r<>r,9\n')
    put(tmp_path / "d", "_SUCCESS", "")
    df = readers.read_drop(spark, folder, REQUIRED)
    assert df.collect()[0].asDict() == {"base_sku": "007", "comp_sku": "1,2", "comp_source_store": "r<>r", "score": "9"}


@pytest.mark.parametrize("name, text, message", [
    ("a.csv", "base_sku,comp_sku\n", "lacks"),
    ("a.csv", "base_sku,comp_sku,comp_source_store,comp_sku\n", "repeats"),
    ("a.json", "{}", "not a csv"),
    ("_SUCCESS", "x", "is empty"),
])
def test_read_drop_rejects(spark, tmp_path, name, text, message):
    with pytest.raises(ValueError, match=message):
        readers.read_drop(spark, put(tmp_path / "d", name, text), REQUIRED)


def test_read_drop_checks_every_header(spark, tmp_path):
    put(tmp_path / "d", "a.csv", "base_sku,comp_sku,comp_source_store\n1,2,r<>r\n")
    put(tmp_path / "d", "b.csv", "comp_sku,base_sku,comp_source_store\n3,4,r<>r\n")
    with pytest.raises(Exception, match="header"):
        readers.read_drop(spark, str(tmp_path / "d"), REQUIRED).collect()
    put(tmp_path / "e", "a.csv", "Base_SKU,comp_sku,comp_source_store\n1,2,r<>r\n")
    put(tmp_path / "e", "b.csv", "base_sku,COMP_SKU,comp_source_store\n3,4,r<>r\n")
    rows = readers.read_drop(spark, str(tmp_path / "e"), REQUIRED).collect()
    assert sorted((r["base_sku"], r["comp_sku"]) for r in rows) == [("1", "2"), ("3", "4")]


RECALL = (
    "base_sku_uuid,comp_sku_uuid,score\n"
    '1<>a<>s<>s,b<>r<>r,0.9\na<>s<>s,2<>b<>r<>r,0.9\na<>s<>s,b<>r<>r,0.90\n\n"x,y<>s<>s",b<>r<>r,1\ntwo,fields\nf,o,u,r\n'
)


def recall_tree(tmp_path):
    put(tmp_path / "in" / "comp_source_store=r<>r", "1.csv", RECALL)
    put(tmp_path / "in" / "comp_source_store=r<>r", "2.csv", "base_sku_uuid,comp_sku_uuid,score\na<>s<>s,b<>r<>r,0.9\n")
    put(tmp_path / "in" / "other", "3.csv", RECALL)
    return str(tmp_path / "in")


def test_recall_round_trip(spark, tmp_path):
    rows = readers.read_recall(spark, recall_tree(tmp_path))
    stats = {r["file"][-5:]: r for r in recall.recall_stats(rows).collect()}
    assert {k: (r["rows_in"], r["rows_out"], r["removed"], r["malformed"]) for k, r in stats.items()} == {
        "1.csv": (6, 5, 1, 2), "2.csv": (1, 1, 0, 0)
    }
    assert stats["1.csv"]["part"] == "comp_source_store=r<>r" and stats["1.csv"]["percent"] == 16.7
    clean = recall.dedupe_recall(rows)
    out = str(tmp_path / "out")
    assert not writers.write_recall(clean, out, dry_run=True) and not (tmp_path / "out").exists()
    assert writers.write_recall(clean, out)
    lines = [l for f in (tmp_path / "out" / "comp_source_store=r<>r").glob("*.csv") for l in f.read_text().splitlines()]
    assert sorted(l for l in lines if l != "base_sku_uuid,comp_sku_uuid,score") == sorted([
        "a<>s<>s,b<>r<>r,0.9", "a<>s<>s,b<>r<>r,0.90", '"x,y<>s<>s",b<>r<>r,1', "two,fields", "f,o,u,r", "a<>s<>s,b<>r<>r,0.9",
    ])
    again = readers.read_recall(spark, out)
    assert recall.dedupe_recall(again, by_file=False).count() == 5


def tree(folder):
    """Data files, manifests left out."""
    names = [p.relative_to(folder) for p in folder.rglob("*") if p.is_file()]
    return sorted(str(n) for n in names if not any(part.startswith((".", "_")) for part in n.parts))


def test_recall_in_place(spark, tmp_path):
    root = recall_tree(tmp_path)
    put(tmp_path / "in" / "comp_source_store=r<>r", "notes.txt", "keep me")
    put(tmp_path / "in" / "late" / "comp_source_store=q<>q", "4.csv", "base_sku_uuid,comp_sku_uuid,score\na<>s<>s,b<>q<>q,1\n")
    others = {n: (tmp_path / "in" / n).read_text() for n in ("other/3.csv", "comp_source_store=r<>r/notes.txt")}
    rows = readers.read_recall(spark, root, marker="comp_source_store=")
    assert writers.write_recall(recall.dedupe_recall(rows), root, in_place=True)
    assert readers.read_recall(spark, root).count() == 7
    assert {n: (tmp_path / "in" / n).read_text() for n in others} == others
    names = tree(tmp_path / "in")
    assert not any(n.endswith(("1.csv", "2.csv", "4.csv")) for n in names)
    assert sorted({n.rsplit("/", 1)[0] for n in names}) == ["comp_source_store=r<>r", "late/comp_source_store=q<>q", "other"]
    assert not (tmp_path / "in__new").exists()


def test_recall_without_partitions_stays_in_the_root(spark, tmp_path):
    rows = readers.read_recall(spark, recall_tree(tmp_path), marker="")
    assert writers.write_recall(recall.dedupe_recall(rows, by_file=False), str(tmp_path / "out"))
    assert all("/" not in n for n in tree(tmp_path / "out"))
    assert readers.read_recall(spark, str(tmp_path / "out"), marker="").count() == 3 + 4


def test_recall_empty_marker_reads_everything(spark, tmp_path):
    assert readers.read_recall(spark, recall_tree(tmp_path), marker="").count() == 13


@pytest.mark.parametrize("content", [["a", "b"], {"competitors": ["a", "b"]}])
def test_read_mapping(spark, tmp_path, content):
    folder = str(tmp_path / "m")
    spark.range(2).write.parquet(folder)
    put(tmp_path / "m", "competitor_list.json", json.dumps(content))
    mapping, names = readers.read_mapping(spark, folder)
    assert mapping.count() == 2 and names == ["a", "b"]


def test_read_mapping_rejects(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.read_mapping(spark, str(tmp_path / "none"))
    put(tmp_path / "m", "competitor_list.json", "[1]")
    with pytest.raises(ValueError):
        readers.read_mapping(spark, str(tmp_path / "m"))
    put(tmp_path / "m", "competitor_list.json", '["a"]')
    with pytest.raises(FileNotFoundError):
        readers.read_mapping(spark, str(tmp_path / "m"))


def test_sidecar_written_by_us_is_readable(spark, tmp_path):
    folder = str(tmp_path / "m")
    writers.write_scores(spark.range(2), folder)
    writers.write_competitors(spark, folder, "acme", ["b", "a"], "2024-01-01")
    mapping, names = readers.read_mapping(spark, folder)
    assert names == ["a", "b"] and mapping.count() == 2
    assert readers.read_previous(spark, folder).count() == 2
    assert readers.read_previous(spark, str(tmp_path / "none")) is None


def test_replace_partitions(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = spark.range(3)
    assert writers.replace_partitions(rows, path, ["tenant", "run_date"], tenant="a", run_date="d1").rows == 3
    writers.replace_partitions(rows, path, ["tenant", "run_date"], tenant="b", run_date="d1")
    writers.replace_partitions(spark.range(1), path, ["tenant", "run_date"], tenant="a", run_date="d1")
    empty = writers.replace_partitions(rows.where("id > 9"), path, ["tenant", "run_date"], tenant="b", run_date="d1")
    assert empty.rows == 0 and empty.kept_old
    counts = {r["tenant"]: r["count"] for r in spark.read.parquet(path).groupBy("tenant").count().collect()}
    assert counts == {"a": 1, "b": 3}


def test_replace_by_varying_partition(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = spark.range(30).withColumn("k", F.when(F.col("id") < 20, 0).otherwise(1))
    assert writers.replace_partitions(rows, path, ["tenant", "k"], tenant="a").rows == 30
    assert writers.replace_partitions(rows.where("k = 1").limit(2), path, ["tenant", "k"], tenant="a").rows == 2
    assert sorted((r["k"], r["count"]) for r in spark.read.parquet(path).groupBy("k").count().collect()) == [(0, 20), (1, 2)]


def test_failed_replace_keeps_old_data(spark, tmp_path):
    path = str(tmp_path / "out")
    writers.replace_partitions(spark.range(3), path, ["tenant"], tenant="a")
    bad = spark.range(3).select(F.when(F.col("id") == 2, F.raise_error("no")).otherwise(F.lit("x")).alias("id"))
    with pytest.raises(Exception):
        writers.replace_partitions(bad, path, ["tenant"], tenant="a")
    assert spark.read.parquet(path).count() == 3


def test_report_layout_and_scores(spark, tmp_path):
    writers.write_report(spark.range(1), str(tmp_path / "r"), "auto", "pets", "acme", "2024-01-01")
    assert list((tmp_path / "r" / "report=auto" / "product_segment=pets" / "company_code=acme" / "load_date=2024-01-01").glob("*.parquet"))
    df = spark.range(40).coalesce(1).withColumn("x_embedding", F.lit(1))
    assert writers.write_scores(df, str(tmp_path / "s"), rows_per_file=10).rows == 40
    assert len(list((tmp_path / "s").glob("*.parquet"))) == 4
    assert spark.read.parquet(str(tmp_path / "s")).columns == ["id"]


def test_append_and_verify(spark, tmp_path):
    path = str(tmp_path / "q")
    rows = spark.createDataFrame([("q1", "2024-01-01"), ("q1", "2024-01-01")], "queue_name string, load_date string")
    assert writers.verify_path(spark, path, "q1", "2024-01-01").first()["status"] == "failure"
    assert writers.append_files(rows, path, ["load_date"]).rows == 2
    assert writers.verify_path(spark, path, "q1", "2024-01-01").first().asDict() == {"status": "success", "rows": 2}
    assert writers.verify_path(spark, path, "q2", "2024-01-01").first().asDict() == {"status": "warning", "rows": 0}


def test_append_by_position(spark, tmp_path):
    spark.sql(f"create table positional (first string, second int) using parquet location '{tmp_path}/tab'")
    df = spark.createDataFrame([("x", 1)], "a string, b int")
    assert writers.append_by_position(df, "positional").rows == 1
    assert spark.table("positional").first().asDict() == {"first": "x", "second": 1}
    spark.sql("drop table positional")


def test_retriever_round_trip(spark, tmp_path):
    docs = spark.createDataFrame([("a", "red ball"), ("b", "blue ball"), ("c", "green car")], "row_id string, q string")
    index = retriever.build_index(docs, "category")
    writers.save_retriever(index, str(tmp_path))
    loaded = readers_loaded = writers.load_retriever(spark, str(tmp_path), "category")
    asked = spark.createDataFrame([(1, "red car")], "query_id int, q string")
    assert retriever.query(loaded, asked, 2).collect() == retriever.query(index, asked, 2).collect()
    assert retriever.self_check(readers_loaded) == "a"


def test_register(spark):
    readers.register(spark.range(2), "two_rows")
    assert readers.read_table(spark, "two_rows", ["id"]).count() == 2
