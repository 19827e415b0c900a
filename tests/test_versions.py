"""Manifests: a run that stops between any two steps leaves the old or the new rows, whole."""

import pytest
from pyspark.sql import functions as F

from pairloom.operators import inverted
from pairloom.plans import recall, retriever
from pairloom.sources import readers, storage, versions, writers

HEAD = "base_sku_uuid,comp_sku_uuid,score\n"


class Stop(Exception):
    pass


def stop_at(monkeypatch, step):
    """Let the file-system step number ``step`` fail; returns the list of steps made."""
    done = []
    for name in ("write_new", "move_in", "remove"):
        real = getattr(storage, name)

        def wrapped(*args, _real=real, _name=name):
            if len(done) == step:
                raise Stop(_name)
            done.append(_name)
            return _real(*args)

        monkeypatch.setattr(storage, name, wrapped)
    return done


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_versioned_table(spark, tmp_path):
    table = versions.VersionedTable(spark, str(tmp_path / "t"))
    assert table.version() is None and table.read() is None
    assert table.overwrite(spark.range(3)) == 1 and table.append(spark.range(5, 6)) == 2
    assert ids(table.read()) == [0, 1, 2, 5] and ids(table.read(1)) == [0, 1, 2]
    assert table.overwrite(spark.range(1)) == 3 and table.clean() == 2
    assert ids(table.read()) == [0] and table.read(1) is None


def test_partitions_are_replaced_alone(spark, tmp_path):
    table = versions.VersionedTable(spark, str(tmp_path / "t"))
    rows = spark.range(8).select("id", (F.col("id") % 2).cast("int").alias("p"), F.when(F.col("id") > 5, None).otherwise("a=b/c").alias("q"))
    table.replace_partitions(rows, ["p", "q"])
    assert [(f.name, f.dataType) for f in table.read().schema] == [(f.name, f.dataType) for f in rows.schema]
    assert sorted(map(str, table.read().collect())) == sorted(map(str, rows.collect()))
    table.replace_partitions(rows.where("id = 2"), ["p", "q"])
    assert ids(table.read()) == [1, 2, 3, 5, 6, 7]
    assert table.replace_partitions(rows.where("false"), ["p", "q"]) is None and table.version() == 2
    with pytest.raises(ValueError, match="partitioned by"):
        table.replace_partitions(rows, ["p"])


def test_unfinished_manifests_do_not_count(spark, tmp_path):
    table = versions.VersionedTable(spark, str(tmp_path / "t"))
    table.overwrite(spark.range(3))
    (tmp_path / "t" / "_versions" / "2.json").write_text('{"content": {"schema"')
    (tmp_path / "t" / "_versions" / "3.json").write_text("")
    assert table.version() == 1 and ids(table.read()) == [0, 1, 2]
    assert table.overwrite(spark.range(1)) == 4 and ids(table.read()) == [0]


def test_writers_at_the_same_time(spark, tmp_path, monkeypatch):
    """The number is taken between looking and writing: the loser builds on the winner's version."""
    table = versions.VersionedTable(spark, str(tmp_path / "t"))
    table.overwrite(spark.range(1))
    real, raced = storage.write_new, []

    def late(s, path, text):
        if not raced:
            raced.append(1)
            versions.VersionedTable(spark, table.path).append(spark.range(10, 11))
        return real(s, path, text)

    monkeypatch.setattr(storage, "write_new", late)
    table.append(spark.range(20, 21))
    assert ids(table.read()) == [0, 10, 20]


@pytest.mark.parametrize("step", range(8))
def test_recall_in_place_is_seen_whole(spark, tmp_path, monkeypatch, step):
    folder = tmp_path / "in" / "comp_source_store=r<>r"
    folder.mkdir(parents=True)
    old = {("a", "b", "1"), ("c", "d", "2")}
    (folder / "1.csv").write_text(HEAD + "a<>s<>s,b<>r<>r,1\n" * 2)
    (folder / "2.csv").write_text(HEAD + "c<>s<>s,d<>r<>r,2\n" * 3)
    root = str(tmp_path / "in")
    seen = lambda: readers.read_recall(spark, root).select(*recall.FIELDS).collect()
    before, after = 5, 2
    with monkeypatch.context() as patched:
        done = stop_at(patched, step)
        try:
            writers.write_recall(recall.dedupe_recall(readers.read_recall(spark, root)), root, in_place=True)
        except Stop:
            pass
    rows = seen()
    assert len(rows) == (before if done.count("write_new") < 2 else after)
    assert len({tuple(r) for r in rows}) == len(old)
    # The next run settles what was left.
    writers.write_recall(recall.dedupe_recall(readers.read_recall(spark, root)), root, in_place=True)
    assert len(seen()) == after and versions.newest(spark, root)[1] == writers.EVERY_FILE
    assert len(list(folder.glob("*.csv"))) <= 2


@pytest.mark.parametrize("step", range(2))
def test_retriever_changes_whole(spark, tmp_path, monkeypatch, step):
    build = lambda *texts: retriever.build_index(spark.createDataFrame(list(enumerate(texts)), "row_id long, q string"), "category")
    asked = spark.createDataFrame([(1, "red car")], "query_id int, q string")
    top = lambda: [r["row_id"] for r in retriever.query(writers.load_retriever(spark, str(tmp_path), "category"), asked, 1).collect()]
    writers.save_retriever(build("red ball", "red car"), str(tmp_path))
    assert top() == [1]
    with monkeypatch.context() as patched:
        done = stop_at(patched, step)
        try:
            writers.save_retriever(build("red car", "blue"), str(tmp_path))
        except Stop:
            pass
    assert top() == ([0] if done else [1])


def test_copying_an_index_that_stops_changes_nothing(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(0, "red ball"), (1, "red car")], "row_id long, q string")
    writers.save_retriever(retriever.build_index(docs, "category"), str(tmp_path))
    index = retriever.build_index(docs.where("row_id = 0"), "category")
    monkeypatch.setattr(inverted, "copy_index", lambda *_: (_ for _ in ()).throw(Stop()))
    with pytest.raises(Stop):
        writers.save_retriever(index, str(tmp_path))
    assert writers.load_retriever(spark, str(tmp_path), "category").rows.count() == 2


def test_the_newest_partition_in_scope_is_found_without_opening_others(spark, tmp_path):
    """Older partitions hold files that can't be read, a newer one only rows out of scope."""
    path = tmp_path / "t"
    for day, who in (("2024-03-01", "other"), ("2024-02-01", "acme")):
        spark.range(3).withColumn("who", F.lit(who)).write.parquet(f"{path}/load_date={day}")
    for day in ("2024-01-01", "__HIVE_DEFAULT_PARTITION__"):
        (path / f"load_date={day}").mkdir()
        (path / f"load_date={day}" / "part-0.parquet").write_text("not parquet")
    (path / "load_date=2024-04-01").mkdir()
    opened = []
    real = spark.read.__class__.parquet
    spark.read.__class__.parquet = lambda self, *p, **o: opened.extend(p) or real(self, *p, **o)
    try:
        found = readers.latest_rows(spark, str(path), ["load_date"], F.col("who") == "acme")
    finally:
        spark.read.__class__.parquet = real
    assert {r["load_date"] for r in found.collect()} == {"2024-02-01"} and found.count() == 3
    assert [p.rsplit("=", 1)[1] for p in opened] == ["2024-03-01", "2024-02-01"]
    assert readers.latest_rows(spark, str(path), ["load_date"], override=["2024-03-01"]).first()["who"] == "other"
    assert readers.latest_rows(spark, str(tmp_path / "none"), ["load_date"]) is None


def test_composite_partitions_are_walked_from_the_newest(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("2023", "12", "31", 1), ("2024", "01", "02", 2), ("2024", "01", "10", 3)], "year string, month string, day string, v int")
    rows.write.partitionBy("year", "month", "day").parquet(path)
    parts = ["year", "month", "day"]
    assert [tuple(r) for r in readers.latest_rows(spark, path, parts).select(*parts, "v").collect()] == [("2024", "01", "10", 3)]
    assert readers.latest_rows(spark, path, parts, F.col("v") < 2).first()["year"] == "2023"
    assert readers.latest_rows(spark, path, parts, F.col("v") > 9) is None
