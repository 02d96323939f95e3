import pytest
from pyspark.sql import functions as F

from panelspark.operators.upsert import merge
from panelspark.sources import files
from panelspark.sources.partitioned import PartitionedTable
from panelspark.sources.pointers import Conflict, Pointers
from panelspark.sources.tables import Tables, read_path


@pytest.fixture
def base(spark):
    return spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "id int, name string, v double")


def test_merge_replaces_whole_rows(spark, base, rows):
    new = spark.createDataFrame([(2, 9, 7), (3, 8, 7)], "id int, v int, extra int")
    out = merge(base, new, ["id"], fill_missing=True)
    assert dict(out.dtypes) == {"id": "int", "name": "string", "v": "double", "extra": "string"}
    assert rows(out) == [(1, "a", 1.0, None), (2, None, 9.0, "7"), (3, None, 8.0, "7")]


def test_merge_needs_equal_columns(spark, base):
    with pytest.raises(ValueError, match="name"):
        merge(base, base.drop("name"), ["id"])


def test_upsert_creates_replaces_and_is_idempotent(spark, base, tables, rows):
    assert tables.upsert("t", None, ["id"]) is None
    tables.upsert("t", base, ["id"])
    new = spark.createDataFrame([(2, "c", 5.0), (3, "d", 6.0)], base.schema)
    once = rows(tables.upsert("t", new, ["id"]))
    assert once == rows(tables.upsert("t", new, ["id"]))
    assert once == [(1, "a", 1.0), (2, "c", 5.0), (3, "d", 6.0)]
    before = tables.versions("t")
    tables.upsert("t", new.limit(0), ["id"])
    assert tables.versions("t") == before
    assert not [c for c in tables._pointers("t").children(f"{tables.root}/t") if "_staged" in c]


def test_upsert_refuses_bad_keys(spark, base, tables, rows):
    tables.upsert("t", base, ["id"])
    twice = spark.createDataFrame([(1, "x", 1.0), (1, "y", 1.0)], base.schema)
    missing = spark.createDataFrame([(None, "x", 1.0)], base.schema)
    for bad in (twice, missing):
        with pytest.raises(ValueError, match="not unique"):
            tables.upsert("t", bad, ["id"])
    assert rows(tables.read("t")) == [(1, "a", 1.0), (2, "b", 2.0)]
    both = tables.upsert("t", twice, ["id"], one_row_per_key=False)
    assert rows(both) == [(1, "x", 1.0), (1, "y", 1.0), (2, "b", 2.0)]


def test_an_unfinished_version_is_not_seen(spark, base, tables, rows):
    tables.overwrite(base, "t")
    base.limit(1).write.parquet(f"{tables.root}/t/data-dead")  # a writer that died
    assert rows(tables.read("t")) == rows(base)
    tables.overwrite(base.limit(1), "t")
    assert tables.versions("t")[-1] == 2 and tables.read("t").count() == 1


def test_a_version_is_published_once(spark, base, tables):
    tables.overwrite(base, "t")
    with pytest.raises(Conflict):
        tables._write(base.limit(1), "t", 0)
    assert tables.read("t").count() == 2
    left = [c for c in tables._pointers("t").children(f"{tables.root}/t") if c.startswith("data")]
    assert len(left) == 1  # the loser leaves nothing behind


def test_two_upserts_from_one_base_are_both_kept(spark, base, tables, rows, monkeypatch):
    tables.upsert("t", base, ["id"])
    other = Tables(spark, tables.root)
    publish, late = Tables._publish, []

    def overtaken(self, name, at, content, folders):
        if not late:  # the other writer publishes between our merge and our pointer
            late.append(1)
            other.upsert("t", spark.createDataFrame([(8, "other", 8.0)], base.schema), ["id"])
        return publish(self, name, at, content, folders)

    monkeypatch.setattr(Tables, "_publish", overtaken)
    got = tables.upsert("t", spark.createDataFrame([(9, "mine", 9.0)], base.schema), ["id"])
    assert rows(got, "id") == [(1,), (2,), (8,), (9,)] and tables.versions("t") == [1, 2, 3]


def data_files(tables, name):
    """Data files of the buckets of a table's newest version."""
    return {p.split("/")[-2] + "/" + p.split("/")[-1] for p in tables.read(name).inputFiles()}


def test_untouched_buckets_keep_their_files(spark, tmp_path, rows):
    tables = Tables(spark, str(tmp_path / "t"), buckets=16)
    many = spark.range(4000).select("id", F.when(F.col("id") > 0, F.col("id")).alias("k"), F.lit("a").alias("v"))
    tables.upsert("t", many.drop("id"), ["k"], nullable_keys=True)
    first = data_files(tables, "t")
    daily = spark.createDataFrame([(7, "b"), (None, "n"), (9000, "c"), (8, "d")], "k int, v string")
    got = tables.upsert("t", daily, ["k"], nullable_keys=True)
    assert got.count() == 4001 and dict(got.dtypes) == {"k": "bigint", "v": "string"}
    assert rows(got.filter("v <> 'a'")) == sorted([(7, "b"), (8, "d"), (9000, "c"), (None, "n")], key=repr)
    gone = first - data_files(tables, "t")
    assert 1 <= len({f.split("/")[0] for f in gone}) <= 4 and len(first) - len(gone) >= 12
    # a new column leaves the other buckets' files in place too
    wide = spark.createDataFrame([(7, "e", "x")], "k int, v string, w string")
    second = data_files(tables, "t")
    got = tables.upsert("t", wide, ["k"], fill_missing=True)
    assert len({f.split("/")[0] for f in second - data_files(tables, "t")}) == 1
    assert rows(got.filter("w IS NOT NULL")) == [(7, "e", "x")] and got.count() == 4001


def test_only_the_buckets_of_wanted_keys_are_read(spark, tmp_path, rows):
    tables = Tables(spark, str(tmp_path / "t"), buckets=16)
    pairs = spark.range(600).select((F.col("id") % 60).cast("int").alias("k"), (F.col("id") % 7).alias("j"), "id")
    tables.overwrite(pairs, "t", by=["k"], unique=["id"])
    wanted = spark.createDataFrame([(5,), (6,), (5,)], "k long")
    got = tables.read_keys("t", wanted)
    assert rows(got) == rows(pairs.filter("k IN (5, 6)"))
    assert len(data_files(tables, "t")) > 8 and len(got.inputFiles()) <= 2
    assert rows(tables.read_keys("t", wanted.selectExpr("k AS j"))) == rows(pairs.filter("j IN (5, 6)"))


def test_replacing_groups_and_rows_that_were_replaced(spark, tables, rows):
    data = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z"), (None, 1, "n")], "g string, k int, v string")
    tables.upsert("t", data, ["g", "k"], by=["g"], nullable_keys=True, changes=True)
    assert tables.before("t") is None
    new = spark.createDataFrame([("a", 2, "Y"), (None, 1, "N"), ("c", 1, "w")], data.schema)
    tables.upsert("t", new, ["g", "k"], by=["g"], nullable_keys=True, changes=True)
    assert rows(tables.before("t")) == sorted([("a", 2, "y"), (None, 1, "n")], key=repr)
    touched = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1), ("d", 1)], "g string, k int")
    put = spark.createDataFrame([("c", 1, "W"), ("d", 1, "D")], data.schema)
    got = tables.replace("t", put, touched, ["g", "k"], by=["g"], unique=["g", "k"])
    assert rows(got) == sorted([("a", 2, "Y"), (None, 1, "N"), ("c", 1, "W"), ("d", 1, "D")], key=repr)
    with pytest.raises(ValueError, match="not unique"):
        tables.replace("t", put.unionByName(put), touched, ["g", "k"], unique=["g", "k"])
    with pytest.raises(ValueError, match="part of the key"):
        tables.upsert("t", new, ["g"], by=["k"], one_row_per_key=False)


def test_an_overwritten_table_becomes_bucketed(spark, base, tables, rows):
    tables.overwrite(base, "t")
    new = spark.createDataFrame([(2, "c", 5.0)], base.schema)
    assert rows(tables.upsert("t", new, ["id"])) == [(1, "a", 1.0), (2, "c", 5.0)]
    assert rows(tables.upsert("t", new.withColumn("v", F.lit(6.0)), ["name"])) == [(1, "a", 1.0), (2, "c", 6.0)]
    tables.overwrite(base, "t")
    assert rows(tables.read("t")) == rows(base)


def test_a_batch_is_taken_once(spark, base, tables, rows):
    tables.upsert("t", base, ["id"], batch=("s", 0))
    tables.upsert("t", base.withColumn("v", F.lit(9.0)), ["id"], batch=("s", 0))
    assert tables.versions("t") == [1] and rows(tables.read("t")) == rows(base)
    tables.upsert("t", base.withColumn("v", F.lit(9.0)), ["id"], batch=("other", 0))
    tables.upsert("t", base, ["id"], batch=("s", 1))
    tables.upsert("t", base.withColumn("v", F.lit(7.0)), ["id"], batch=("other", 0))
    assert tables.versions("t") == [1, 2, 3] and rows(tables.read("t")) == rows(base)


class Raising:
    """File contexts whose rename takes effect and raises all the same."""

    def __init__(self, spark):
        self.spark = spark

    def __enter__(self):
        self.old = Pointers.publish

        def publish(pointers, version, content):
            self.old(pointers, version, content)
            return self.old(pointers, version, content)  # the target is there, rename raises

        Pointers.publish = publish

    def __exit__(self, *_):
        Pointers.publish = self.old


def test_a_rename_that_raises_after_success_loses_nothing(spark, base, tables, rows, tmp_path):
    with Raising(spark):
        tables.overwrite(base, "t")
        tables.upsert("u", base, ["id"])
        parted = PartitionedTable(spark, str(tmp_path / "p"), ["id", "name"], ["name"])
        parted.upsert(base)
    assert rows(tables.read("t")) == rows(tables.read("u")) == rows(base) and tables.versions("t") == [1]
    assert parted.read().count() == 2


def test_an_unclear_error_leaves_the_folder(spark, base, tables, rows, monkeypatch):
    def lost(self, version, content):
        publish(self, version, content)
        raise OSError("connection lost")

    publish = Pointers.publish
    monkeypatch.setattr(Pointers, "publish", lost)
    with pytest.raises(OSError):
        tables.overwrite(base, "t")
    monkeypatch.setattr(Pointers, "publish", publish)
    assert rows(tables.read("t")) == rows(base)


def test_snapshot_of_all_tables(spark, base, tables, rows, tmp_path):
    one, two = base, base.withColumn("name", F.lit("second"))
    tables.overwrite(one, "a")
    tables.upsert("b", one, ["id"])
    seen = tables.publish_all()
    tables.overwrite(two, "a")
    assert rows(tables.snapshot().read("a")) == rows(tables.snapshot().read("b")) == rows(one)
    with pytest.raises(ValueError, match="b: 2 rows, at least 3"):
        tables.publish_all(min_rows={"b": 3})
    assert tables.snapshot().pins == seen.pins and rows(tables.snapshot().read("a")) == rows(one)
    tables.upsert("b", two, ["id"])
    now = tables.publish_all(versions={"a": 2, "b": 2})
    assert rows(now.read("a")) == rows(now.read("b")) == rows(two)
    for _ in range(3):
        tables.overwrite(one.limit(1), "a")
    tables.prune("a", keep=1)
    assert rows(tables.snapshot().read("a")) == rows(two) and tables.read("a").count() == 1
    with pytest.raises(ValueError):
        Tables(spark, str(tmp_path / "none")).snapshot()


def test_push_shows_all_tables_at_once(spark, base, tables, rows, tmp_path):
    tables.overwrite(base, "a")
    tables.upsert("b", base, ["id"])
    there = Tables(spark, str(tmp_path / "stage"))
    tables.publish_all().push(there)
    assert there.snapshot().names() == ["a", "b"] and rows(there.snapshot().read("b")) == rows(base)
    tables.overwrite(base.limit(0), "a")
    tables.overwrite(base.withColumn("name", F.lit("new")), "b")
    with pytest.raises(ValueError, match="a: 0 rows"):
        tables.publish_all(min_rows=0).push(there)
    assert rows(there.snapshot().read("b")) == rows(base)  # the new copy of b is not shown


def test_snapshot_waits_for_a_run_that_goes_on(spark, base, tables, monkeypatch):
    tables.overwrite(base, "a")
    tables.overwrite(base, "b")
    count, late = Tables.read, []

    def read(self, name, version=None):
        if name == "b" and not late:  # both tables change while they are checked
            late.append(1)
            tables.overwrite(base, "a")
            tables.overwrite(base, "b")
        return count(self, name, version)

    monkeypatch.setattr(Tables, "read", read)
    assert tables.publish_all().pins == {"a": 2, "b": 2}


def test_a_bad_version_is_never_visible(spark, base, tables):
    tables.overwrite(base, "t")
    with pytest.raises(ValueError, match="not unique"):
        tables.overwrite(base.unionByName(base), "t", unique=["id"])
    assert tables.versions("t") == [1] and tables.read("t").count() == 2


def test_keys_with_missing_parts(spark, tables, rows):
    schema = "a int, b string, v int"
    df = spark.createDataFrame([(1, None, 1), (12, "3", 2), (1, "23", 3)], schema)
    tables.upsert("t", df, ["a", "b"], nullable_keys=True)
    new = spark.createDataFrame([(1, None, 9)], schema)
    got = tables.upsert("t", new, ["a", "b"], nullable_keys=True)
    assert rows(got) == [(1, "23", 3), (1, None, 9), (12, "3", 2)]
    with pytest.raises(ValueError):
        tables.upsert("t", new.unionByName(new), ["a", "b"], nullable_keys=True)


def test_snapshot_guard_and_prune(spark, base, tables):
    tables.publish_snapshot(base, "t", min_rows=2)
    with pytest.raises(ValueError, match="at least 2"):
        tables.publish_snapshot(base.limit(1), "t", min_rows=2)
    assert tables.read("t").count() == 2
    for _ in range(3):
        tables.overwrite(base, "t")
    tables.prune("t", keep=1)
    assert len(tables.versions("t")) == 1 and tables.read("t").count() == 2
    with pytest.raises(ValueError):
        tables.prune("t", keep=0)


def test_missing_table(spark, tables):
    assert not tables.exists("none") and tables.read_if_exists("none") is None
    with pytest.raises(ValueError):
        tables.read("none")


def test_export_every_table(spark, base, tables, tmp_path, rows):
    tables.overwrite(base.withColumn("name", F.lit(None).cast("string")), "one")
    tables.overwrite(base, "two")
    assert tables.names() == ["one", "two"]
    targets = files.export_all(tables, str(tmp_path / "csv"))
    assert [t.rsplit("/", 1)[1] for t in targets] == ["one.csv", "two.csv"]
    text = spark.read.text(targets[0]).collect()
    assert {r[0] for r in text} >= {"id,name,v", "1,NA,1.0"}
    back = files.read_csv(spark, targets[1], "id int, name string, v double")
    assert rows(back) == rows(base)


def test_partitioned_write(spark, tmp_path, rows):
    df = spark.createDataFrame([("d", "A", 1), ("e", "B", 2)], "disease string, country_iso3c string, n int")
    path = str(tmp_path / "parts")
    files.write_partitioned(df, path)
    back = spark.read.parquet(path).filter("disease = 'd'")
    assert rows(back, "disease", "country_iso3c", "n") == [("d", "A", 1)]


def test_documents(spark, tmp_path, rows):
    folder = tmp_path / "docs"
    folder.mkdir()
    (folder / "CHE_2020_sem1.html").write_text("<p>\nx</p>")
    got = files.read_raw_documents(spark, str(folder))
    assert rows(got) == [("CHE_2020_sem1.html", "<p>\nx</p>")]
    (tmp_path / "d.json").write_text('{"a": {"b": 1}}\n{"c": 2}\n')
    docs = files.read_documents(spark, str(tmp_path / "d.json"), "a struct<b: int>")
    assert rows(docs.select("a.b")) == [(1,), (None,)]


def test_many_raw_documents(spark, tmp_path):
    """A file for every text, in folders of bounded size, and few tasks that read them."""
    path = tmp_path / "raw"
    texts = spark.range(0, 2500, 1, 1).select(F.concat(F.lit("é\r\nline "), "id", F.lit("\n")).alias("text"))
    files.write_raw_documents(texts.unionByName(texts.limit(1)), str(path))
    found = [f for f in path.rglob("*") if f.is_file()]
    assert len(found) == len({f.name for f in found}) == 2501
    assert max(len(list(f.iterdir())) for f in path.glob("*/*")) == files.FOLDER_FILES
    got = files.read_raw_documents(spark, str(path))
    assert got.rdd.getNumPartitions() <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert {r.file_name: r.value for r in got.collect()} == {f.name: f.read_bytes().decode() for f in found}
    assert sorted(r.value for r in got.collect()) == sorted(
        [f"é\r\nline {i}\n" for i in range(2500)] + ["é\r\nline 0\n"]
    )
    with pytest.raises(ValueError, match="exists"):
        files.write_raw_documents(texts, str(path))


def test_raw_documents_null_and_none(spark, tmp_path, rows):
    df = spark.createDataFrame([(None,), ("",), ("a",)], "text string")
    files.write_raw_documents(df, f"file://{tmp_path}/raw")
    assert sorted(f.stat().st_size for f in (tmp_path / "raw").rglob("*.txt")) == [0, 0, 1]
    assert [r.value for r in files.read_raw_documents(spark, str(tmp_path / "raw")).collect()] == ["a"]
    files.write_raw_documents(df.limit(0), str(tmp_path / "none"))
    assert rows(files.read_raw_documents(spark, str(tmp_path / "none"))) == []


def test_raw_documents_are_listed_in_tasks(spark, tmp_path, rows, monkeypatch):
    """The driver knows no name; names and bytes are those of Spark's reader."""
    named = {
        "a b%é#[x]{y}^`|\u00a0&+=~.txt": b"1", "q'!()*,;@$\\\"<>.txt": b"2", "raw.gz": b"3", "_n=v": b"4", "bad": b"\xff\x00",
        "_SUCCESS": b"no", ".a.crc": b"no", "b._COPYING_": b"no", "empty": b"", "plain/in.txt": b"no",
    }
    parted = {"t=1/f=0/a": b"1", "t=1/f=1/b": b"2", "t=2/f=0/c": b"3", "t=2/_temporary/f=0/d": b"no", "t=2/f=0/.e": b"no"}

    def read(path):
        got = files.read_raw_documents(spark, str(path))
        return got, rows(got.select("file_name", F.hex(F.col("value").cast("binary"))))

    for top, content in (("named", named), ("parted", parted)):
        for name, data in content.items():
            (tmp_path / top / name).parent.mkdir(parents=True, exist_ok=True)
            (tmp_path / top / name).write_bytes(data)
        with monkeypatch.context() as m:
            m.setattr(files, "_reached", lambda *a: None, raising=False)
            by_spark, want = read(tmp_path / top)
        got, found = read(tmp_path / top)
        assert found == want and len(found) >= 3
        assert by_spark.inputFiles() and not got.inputFiles()
        assert read(f"file:{tmp_path}/{top}/")[1] == want
    assert [r[0] for r in read(tmp_path / "parted/t=*/f=0")[1]] == ["a", "c"]
    assert [r[0] for r in read(tmp_path / "named/raw.gz")[1]] == ["raw.gz"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read(tmp_path / "missing")


def test_raw_documents_in_several_batches(spark, tmp_path):
    for k in range(7):
        (tmp_path / f"t={k % 2}").mkdir(exist_ok=True)
        (tmp_path / f"t={k % 2}" / str(k)).write_text("x" * (1 << 21) + str(k))
    small = files.read_raw_documents(spark, str(tmp_path)).select("file_name", F.right("value", F.lit(1)).alias("k"), F.length("value").alias("n"))
    assert sorted(small.collect()) == [(str(k), str(k), (1 << 21) + 1) for k in range(7)]
    one_task = "spark.sql.shuffle.partitions"
    before = spark.conf.get(one_task)
    try:
        spark.conf.set(one_task, "1")
        assert files.read_raw_documents(spark, str(tmp_path)).distinct().count() == 7
    finally:
        spark.conf.set(one_task, before)


def test_read_path_prunes(spark, base, tmp_path):
    base.write.parquet(str(tmp_path / "p"))
    assert read_path(spark, str(tmp_path / "p"), "id").columns == ["id"]


def test_stream_upsert(spark, tmp_path, rows):
    from panelspark.streaming.ingest import stream_upsert

    tables = Tables(spark, str(tmp_path / "tables"))
    source = tmp_path / "in"
    source.mkdir()

    def run():
        q = stream_upsert(spark, str(source), "id int, v int, at int", tables, "t", ["id"],
                          str(tmp_path / "cp"), [F.col("at").desc()])
        q.awaitTermination()

    (source / "1.json").write_text('{"id": 1, "v": 1, "at": 1}\n{"id": 1, "v": 2, "at": 2}\n')
    run()
    assert rows(tables.read("t")) == [(1, 2, 2)]
    versions = tables.versions("t")
    run()
    assert tables.versions("t") == versions
    (source / "2.json").write_text('{"id": 1, "v": 3, "at": 3}\n{"id": 2, "v": 9, "at": 1}\n')
    run()
    assert rows(tables.read("t")) == [(1, 3, 3), (2, 9, 1)]


@pytest.fixture
def parts(spark, tmp_path):
    from panelspark.sources.partitioned import PartitionedTable

    return PartitionedTable(spark, str(tmp_path / "big"), ["c", "id"], ["c"])


def folder_files(parts, name):
    import glob

    return sorted(glob.glob(f"{parts.path}/data/c={name}/*/*.parquet"))


def test_partitioned_upsert_rewrites_touched_folders_only(spark, parts, rows):
    schema = "c string, id int, v double"
    parts.upsert(spark.createDataFrame([("A", 1, 1.0), ("B", 1, 2.0), ("B", 2, 3.0)], schema))
    before = folder_files(parts, "A")
    new = spark.createDataFrame([("B", 2, 9, "n"), ("C", 1, 4, "n")], "c string, id int, v int, note string")
    with pytest.raises(ValueError):
        parts.upsert(new)
    for _ in range(2):
        out = parts.upsert(new, fill_missing=True)
        assert rows(out, "c", "id", "v", "note") == [
            ("A", 1, 1.0, None),
            ("B", 1, 2.0, None),
            ("B", 2, 9.0, "n"),
            ("C", 1, 4.0, "n"),
        ]
    assert folder_files(parts, "A") == before
    assert parts.upsert(new.limit(0), fill_missing=True).count() == 4
    with pytest.raises(ValueError):
        parts.upsert(new.unionByName(new), fill_missing=True)


def test_readers_see_whole_versions_and_never_write(spark, parts, rows, monkeypatch):
    from panelspark.sources.pointers import Pointers

    schema = "c string, id int, v double"
    parts.upsert(spark.createDataFrame([("A", 1, 1.0), ("B", 1, 2.0)], schema))
    seen, publish = [], Pointers.publish

    def watched(self, version, content):
        seen.append(rows(parts.read(), "c", "v"))  # all folders are in place, unpublished
        publish(self, version, content)

    monkeypatch.setattr(Pointers, "publish", watched)
    parts.upsert(spark.createDataFrame([("A", 1, 7.0), ("B", 1, 8.0)], schema))
    assert seen == [[("A", 1.0), ("B", 2.0)]]
    assert rows(parts.read(), "c", "v") == [("A", 7.0), ("B", 8.0)]

    def fails(self, version, content):
        raise OSError("driver lost")

    monkeypatch.setattr(Pointers, "publish", fails)
    with pytest.raises(OSError):
        parts.upsert(spark.createDataFrame([("A", 1, 9.0)], schema))
    assert rows(parts.read(), "c", "v") == [("A", 7.0), ("B", 8.0)]
    monkeypatch.undo()
    parts.prune()
    assert len(folder_files(parts, "A")) == 1 and rows(parts.read(), "v") == [(7.0,), (8.0,)]


def test_partitioned_upserts_from_one_base_are_both_kept(spark, parts, rows, monkeypatch):
    from panelspark.sources.pointers import Pointers

    schema = "c string, id int, v double"
    parts.upsert(spark.createDataFrame([("A", 1, 1.0)], schema))
    late, publish = [], Pointers.publish

    def overtaken(self, version, content):
        if not late:
            late.append(1)
            parts.upsert(spark.createDataFrame([("A", 2, 2.0)], schema))
        publish(self, version, content)

    monkeypatch.setattr(Pointers, "publish", overtaken)
    got = parts.upsert(spark.createDataFrame([("A", 3, 3.0)], schema))
    assert rows(got, "id") == [(1,), (2,), (3,)]


def test_upsert_over_many_folders(spark, tmp_path):
    from panelspark.sources.partitioned import PartitionedTable

    table = PartitionedTable(spark, str(tmp_path / "many"), ["c", "id"], ["c"])
    df = spark.range(300).select(F.col("id").alias("c"), F.lit(1).alias("id"), F.lit(0).alias("v"))
    table.upsert(df.repartition(2, "c"))
    got = table.upsert(df.withColumn("v", F.lit(1)).repartition(2, "c"))
    assert got.agg(F.sum("v"), F.count("v")).first() == (300, 300)


def test_partition_columns_belong_to_the_key(spark, tmp_path):
    from panelspark.sources.partitioned import PartitionedTable

    with pytest.raises(ValueError):
        PartitionedTable(spark, str(tmp_path), ["id"], ["c"])
