"""The archive sink, filters that reach the source, and the stream of months."""

import os
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from regiscope.sources import feeds, months, zipcsv
from regiscope.streaming import snapshots

TEXT = StructType([StructField(c, StringType()) for c in ("a", "b")])


def files_below(folder):
    return sorted(os.path.join(d, n) for d, _, names in os.walk(folder) for n in names)


def read_back(spark, folder, prefix, **options):
    return feeds.read_zip_csv(spark, f"{folder}/{prefix}*.zip", TEXT, **options)


def test_archives_hold_what_was_written(spark, tmp_path):
    folder = str(tmp_path / "out")
    rows = [(str(i), [None, "", 'q"uote', "line\nbreak", "açaí;"][i % 5]) for i in range(50)]
    df = spark.createDataFrame(rows, TEXT).repartitionByRange(4, "a")
    feeds.write_zip_csv(df, folder, "X")
    assert [os.path.basename(f) for f in files_below(folder)] == [f"X{i:06d}.zip" for i in range(4)]
    got = {r.a: r.b for r in read_back(spark, folder, "X").collect()}
    assert got == dict(rows)
    feeds.write_zip_csv(df.limit(3).coalesce(1), folder, "X", mode="overwrite")
    assert len(files_below(folder)) == 1 and read_back(spark, folder, "X").count() == 3
    feeds.write_zip_csv(df.filter("a = 'none'"), folder, "Y")
    assert len(files_below(folder)) == 1


def test_json_documents_through_the_sink(spark, tmp_path):
    folder = str(tmp_path / "docs")
    docs = spark.range(20).select(F.col("id").cast("string").alias("a"), F.to_json(F.struct("id", F.lit('x"\n;').alias("t"))).alias("b"))
    feeds.write_zip_csv(docs.repartition(2), folder, "docs", charset="utf8", members=2)
    back = read_back(spark, folder, "docs", charset="utf8")
    assert back.select(F.get_json_object("b", "$.t").alias("t")).distinct().collect()[0].t == 'x"\n;' and back.count() == 20
    with zipfile.ZipFile(files_below(folder)[0]) as z:
        assert len(z.namelist()) == 2


def test_a_failed_job_leaves_no_file(spark, tmp_path):
    folder = str(tmp_path / "out")
    feeds.write_zip_csv(spark.createDataFrame([("1", "old")], TEXT).coalesce(1), folder, "X")
    bad = spark.range(0, 400, 1, 4).select(
        F.col("id").cast("string").alias("a"), F.when(F.col("id") == 399, F.raise_error(F.lit("broken row"))).otherwise("b").alias("b"))
    with pytest.raises(Exception, match="broken row"):
        feeds.write_zip_csv(bad, folder, "X", mode="overwrite")
    assert [os.path.basename(f) for f in files_below(folder)] == ["X000000.zip"]
    assert read_back(spark, folder, "X").first().b == "old" and os.listdir(folder) == ["X000000.zip"]


def test_a_repeated_task_leaves_one_file(tmp_path, monkeypatch):
    import pyarrow as pa

    writer = zipcsv.ZipCsvWriter(TEXT, {"path": str(tmp_path / "w"), "prefix": "X", "numbered": "false"}, False)
    batch = pa.RecordBatch.from_pydict({"a": ["1"], "b": [None]})
    first, again = writer.write(iter([batch])), writer.write(iter([batch]))
    assert first.parts != again.parts and len(files_below(tmp_path)) == 2
    writer.commit([again, zipcsv.Written(), None])
    assert [os.path.relpath(f, tmp_path) for f in files_below(tmp_path)] == ["w/X.zip"] and os.listdir(tmp_path / "w") == ["X.zip"]
    twice = zipcsv.ZipCsvWriter(TEXT, {"path": str(tmp_path / "v"), "numbered": "false"}, False)
    with pytest.raises(ValueError, match="number them"):
        twice.commit([twice.write(iter([batch])), twice.write(iter([batch]))])
    assert files_below(tmp_path / "v") == []


def test_a_task_that_outlives_its_job_leaves_no_file(tmp_path):
    import pyarrow as pa

    writer = zipcsv.ZipCsvWriter(TEXT, {"path": str(tmp_path / "w"), "numbered": "false"}, False)
    batch = pa.RecordBatch.from_pydict({"a": ["1"], "b": [None]})

    def batches():
        yield batch
        writer.abort([])
        yield batch

    writer.write(batches())
    assert os.listdir(tmp_path / "w") == []
    with pytest.raises(OSError):
        writer.write(iter([batch]))
    assert os.listdir(tmp_path / "w") == []


# --- filters


def test_filters_on_the_file_decide_what_is_opened(spark, tmp_path, monkeypatch):
    from pyspark.sql.datasource import EqualTo, In, StringStartsWith

    folder = str(tmp_path)
    df = spark.range(0, 60, 1, 6).select(F.col("id").cast("string").alias("a"), F.lit("x").alias("b"))
    feeds.write_zip_csv(df, folder, "X", members=2)
    opened = []
    real = zipcsv.zipfile.ZipFile
    monkeypatch.setattr(zipcsv.zipfile, "ZipFile", lambda f, *a: opened.append(f) or real(f, *a))

    def members(*filters):
        opened.clear()
        reader = zipcsv.ZipCsvReader(feeds._with_arrival(TEXT), {"path": f"{folder}/X*.zip"})
        assert list(reader.pushFilters(list(filters))) == list(filters)
        return len(reader.partitions()), len(opened)

    third = f"{folder}/X000002.zip"
    assert members() == (12, 6)
    assert members(StringStartsWith(("_file",), f"{third}!")) == (2, 1)
    assert members(EqualTo(("_file",), f"{third}!part1.csv")) == (1, 1)
    assert members(In(("_file",), (f"{third}!part0.csv", f"{folder}/X000005.zip!part1.csv"))) == (2, 2)
    assert members(StringStartsWith(("_file",), f"{folder}/X00000")) == (12, 6)
    assert members(StringStartsWith(("_file",), f"{third}!"), EqualTo(("a",), "5")) == (2, 1)
    assert members(EqualTo(("_file",), "elsewhere")) == (0, 0)
    monkeypatch.undo()
    some = read_back(spark, folder, "X").filter(F.col("_file").startswith(f"{third}!"))
    assert some.count() == 10 and some.rdd.getNumPartitions() == 2


# --- months


def archives(folder, *names):
    os.makedirs(folder, exist_ok=True)
    for n in names:
        with zipfile.ZipFile(f"{folder}/{n}", "w") as z:
            z.writestr("x.csv", '"1";"2"\n')


def test_offsets_are_complete_months(tmp_path):
    stream = months.MonthStream({"path": str(tmp_path), "files": "*.zip", "required": '["^A", "^B"]'})
    assert stream.latestOffset() == stream.initialOffset() == {"month": ""}
    archives(f"{tmp_path}/2026-02", "A.zip", "B.zip")
    archives(f"{tmp_path}/2026-03", "A.zip")
    archives(f"{tmp_path}/month=2026-01", "A.zip", "B1.zip")
    archives(f"{tmp_path}/misc", "A.zip", "B.zip")
    assert stream.latestOffset() == {"month": "2026-02"}
    (part,) = stream.partitions({"month": ""}, {"month": "2026-02"})
    assert list(stream.read(part)) == [("2026-01", f"{tmp_path}/month=2026-01"), ("2026-02", f"{tmp_path}/2026-02")]
    (part,) = stream.partitions({"month": "2026-02"}, {"month": "2026-02"})
    assert list(stream.read(part)) == []


def test_months_out_of_order_incomplete_and_failing(spark, tmp_path):
    from regiscope.plans import publish

    root, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    loads, broken = [], {"2026-05"}

    def load(session, folder, month):
        if month in broken:
            raise RuntimeError(f"cannot load {month}")
        loads.append((month, folder))
        publish.publish(session.range(3), target, "t", month=month)

    def run():
        snapshots.ingest_new_months(spark, root, target, state, load, ["^A", "^B"], "*.zip")

    archives(f"{root}/2026-03", "A.zip", "B.zip")
    run()
    archives(f"{root}/2026-02", "A.zip", "B.zip")  # older, later
    archives(f"{root}/2026-04", "A.zip")  # incomplete
    run()
    archives(f"{root}/2026-05", "A.zip", "B.zip")
    for _ in range(2):
        with pytest.raises(Exception, match="cannot load 2026-05"):
            run()
    archives(f"{root}/2026-04", "B.zip")
    broken.clear()
    run()
    run()
    assert loads == [("2026-03", f"{root}/2026-03"), ("2026-05", f"{root}/2026-05")]
