import io
import tracemalloc
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from fixtures import star
from fixtures.archives import write_archives
from regiscope.schemas import DOMAINS, STAGING_SCHEMAS
from regiscope.sources import feeds, zipcsv
from regiscope.sources.domains import domain_dim
from tests.conftest import plan_of

TWO = StructType([StructField("a", StringType()), StructField("b", StringType())])


def archive(path, **members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in members.items():
            z.writestr(name, data)


def rows(df):
    return [(r.a, r.b) for r in df.orderBy("_file", "_line").collect()]


CASES = [
    ('"x";""\n', ("x", "")), ('"x";\n', ("x", None)), ('"a;b";"c"\n', ("a;b", "c")),
    ('"say ""hi""";"y"\n', ('say "hi"', "y")), ('"two\nlines";"y"\n', ("two\nlines", "y")),
    ('"back\\";"y"\n', ("back\\", "y")), ('"n\x00ul";"y"\n', ("nul", "y")),
    ('"€ ŠœŸ é";"y"\n', ("€ ŠœŸ é", "y")),
    ("bare;word\n", ("bare", "word")), ('"last";"line"', ("last", "line")),
]


def test_zip_dialect(spark, tmp_path):
    body = "".join(c[0] for c in CASES).encode("iso8859-15")
    archive(tmp_path / "F0.zip", **{"one.csv": body})
    assert rows(feeds.read_zip_csv(spark, f"{tmp_path}/F*.zip", TWO)) == [c[1] for c in CASES]


def test_plain_dialect(spark, tmp_path):
    body = "".join(c[0] for c in CASES).encode("iso8859-15")
    (tmp_path / "f.csv").write_bytes(body)
    assert rows(feeds.read_registry_csv(spark, str(tmp_path / "f.csv"), TWO)) == [c[1] for c in CASES]


def test_plain_split_files_keep_line_order(spark, tmp_path):
    count = 60_000
    (tmp_path / "f.csv").write_text("".join(f'"{i:06d}";"{"x" * 100}"\n' for i in range(count)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 2 << 20)
    try:
        df = feeds.read_registry_csv(spark, str(tmp_path / "f.csv"), TWO, multiline=False)
        got = df.select("a", "_line").collect()
        assert df.rdd.getNumPartitions() > 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.a for r in sorted(got, key=lambda r: r._line)] == [f"{i:06d}" for i in range(count)]


def test_every_member_of_every_archive(spark, tmp_path):
    archive(tmp_path / "F1.zip", **{"b.csv": "3;z\n", "a.csv": "2;y\n", "empty.csv": ""})
    archive(tmp_path / "F0.zip", **{"a.csv": "0;v\n1;w\n"})
    archive(tmp_path / "G0.zip", **{"a.csv": "9;no\n"})
    df = feeds.read_zip_csv(spark, f"{tmp_path}/F*.zip", TWO)
    assert rows(df) == [("0", "v"), ("1", "w"), ("2", "y"), ("3", "z")]
    assert df.rdd.getNumPartitions() == 4
    lines = [(r._file.rpartition("/")[2], r._line) for r in df.orderBy("_file", "_line").collect()]
    assert lines == [("F0.zip!a.csv", 1), ("F0.zip!a.csv", 2), ("F1.zip!a.csv", 1), ("F1.zip!b.csv", 1)]


def test_line_numbers_run_across_blocks(spark, tmp_path):
    count = 300_000
    archive(tmp_path / "F0.zip", **{"a.csv": "".join(f'{i};{"y" * 60}\n' for i in range(count))})
    df = feeds.read_zip_csv(spark, f"{tmp_path}/F0.zip", TWO)
    assert df.filter("_line <> cast(a as bigint) + 1").count() == 0
    assert df.count() == count


def test_wrong_width_fails(spark, tmp_path):
    archive(tmp_path / "F0.zip", **{"a.csv": "1;x\nshort\n2;y\n"})
    with pytest.raises(Exception, match="Expected 2 columns"):
        feeds.read_zip_csv(spark, f"{tmp_path}/F0.zip", TWO).collect()


def test_wrong_width_to_quarantine(spark, tmp_path):
    archive(tmp_path / "F0.zip", **{"a.csv": "1;x\nshort\n2;y\na;b;c\n"})
    df = feeds.read_zip_csv(spark, f"{tmp_path}/F0.zip", TWO, mode="quarantine")
    good = df.filter("_corrupt_record is null")
    assert sorted((r.a, r.b) for r in good.collect()) == [("1", "x"), ("2", "y")]
    bad = df.filter("_corrupt_record is not null").collect()
    assert sorted(r._corrupt_record.strip() for r in bad) == ["a;b;c", "short"]


def test_wrong_width_fails_in_plain_files(spark, tmp_path):
    (tmp_path / "f.csv").write_text("1;x\nshort\n")
    with pytest.raises(Exception):
        feeds.read_registry_csv(spark, str(tmp_path / "f.csv"), TWO).collect()


def test_header_option(spark, tmp_path):
    archive(tmp_path / "F0.zip", **{"a.csv": "a;b\n1;x\n"})
    assert rows(feeds.read_zip_csv(spark, f"{tmp_path}/F0.zip", TWO, header=True)) == [("1", "x")]


def test_regime_headers_and_carriage_returns(spark, tmp_path):
    head = "ano,cnpj,cnpj_da_scp,forma_de_tributacao,quantidade_de_escrituracoes\r\n"
    line = '2024,00.000.000/0001-91,0,"LUCRO REAL",1\r\n'
    archive(tmp_path / "entidades-a.zip", **{
        "2023.csv": head + line + head.upper() + line.replace("2024", "2023"),
        "2024.csv": head.title() + ',,,,\r\n' + line.replace("LUCRO REAL", "ISENTO, É"),
    })
    got = feeds.read_feed(spark, str(tmp_path), "regime").orderBy("_file", "_line").collect()
    assert [(r.ano, r.forma_de_tributacao) for r in got] == [
        ("2024", "LUCRO REAL"), ("2023", "LUCRO REAL"), (None, None), ("2024", "ISENTO, É")]
    assert {r.quantidade_de_escrituracoes for r in got} == {"1", None}


def test_missing_feed_is_empty(spark, tmp_path):
    df = feeds.read_feed(spark, str(tmp_path / "nowhere"), "socios")
    assert df.count() == 0
    assert df.columns[:-2] == STAGING_SCHEMAS["socios"].fieldNames()


def test_archives_written_batch_by_batch(spark, tmp_path):
    rows_ = [(str(i), f'é;"{i}"' if i % 3 else None, "") for i in range(100)]
    df = spark.createDataFrame(rows_, "a string, b string, c string").coalesce(1)
    held = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        write_archives(df, str(tmp_path), "Feed", header=True, members=3)
        write_archives(df, str(tmp_path / "plain"), "Feed", zipped=False)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", held)
    with zipfile.ZipFile(tmp_path / "Feed000000.zip") as z:
        assert [z.read(n).decode("iso8859-15").count("\n") for n in z.namelist()] == [4, 4, 95]
        assert z.testzip() is None
    schema = StructType([StructField(c, StringType()) for c in "abc"])
    for got in (feeds.read_zip_csv(spark, f"{tmp_path}/Feed*.zip", schema, header=True),
                feeds.read_registry_csv(spark, str(tmp_path / "plain"), schema)):
        assert sorted(tuple(r)[:3] for r in got.select("a", "b", "c").collect()) == sorted(rows_)


def test_lookup(spark, tmp_path):
    archive(tmp_path / "Paises.zip", **{"p.csv": '"105";"BRASIL"\n"013";"AFEGANISTÃO"\n'.encode("iso8859-15")})
    got = feeds.read_lookup(spark, f"{tmp_path}/Paises.zip").collect()
    assert [(r.codigo, r.descricao) for r in got] == [("105", "BRASIL"), ("013", "AFEGANISTÃO")]


def test_file_uri(tmp_path):
    archive(tmp_path / "F0.zip", **{"a.csv": "1;x\n"})
    assert zipcsv.list_archives(f"file:{tmp_path}/F*.zip") == [f"file:{tmp_path}/F0.zip"]
    assert zipcsv.list_archives(f"file://{tmp_path}/F*.zip") == [f"file://{tmp_path}/F0.zip"]


def test_unwanted_bytes_are_left_out_of_the_stream():
    stream = zipcsv._Without(io.BytesIO(b"\x00\x00a\x00b\x00"), b"\x00")
    assert io.BufferedReader(stream, 2).read() == b"ab"


def test_domains(spark):
    for name, values in DOMAINS.items():
        got = domain_dim(spark, name)
        assert [tuple(r) for r in got.orderBy("codigo").collect()] == list(values)
        assert got.schema["codigo"].dataType.simpleString() == "smallint"


def test_a_reader_holds_its_block_in_one_form(tmp_path):
    line = '"00000001";"2";"Supplier é €";"***000001**";"03";"19980412";"105";"";"";"00";"7"\n'.encode("iso8859-15")
    archive(tmp_path / "Socios0.zip", **{"one.csv": line * 300_000})
    reader = zipcsv.ZipCsvReader(STAGING_SCHEMAS["socios"], {"path": f"{tmp_path}/S*.zip"})
    tracemalloc.start()
    rows = sum(b.num_rows for p in reader.partitions() for b in reader.read(p))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 300_000 and most < 48 << 20, most


@pytest.mark.parametrize("charset", ["shift_jis", "gb18030", "utf8", "iso8859-15"])
def test_characters_across_pieces(spark, tmp_path, monkeypatch, charset):
    monkeypatch.setattr(zipcsv._Without, "PIECE", 3)
    told = [("x", "é€" if charset == "iso8859-15" else "表示のテ"), ("longer than one piece", "y")] * 5
    archive(tmp_path / "F0.zip", **{"a.csv": "".join(f'"{a}";"{b}"\n' for a, b in told).encode(charset)})
    r = zipcsv.ZipCsvReader(TWO, {"path": f"{tmp_path}/F*.zip", "charset": charset})
    assert [tuple(x.values()) for p in r.partitions() for b in r.read(p) for x in b.to_pylist()] == told


def test_archives_are_ranged_before_rows_become_text(spark, sf):
    for feed in ("socios", "estabelecimentos", "regime"):
        plan = plan_of(star.arriving(spark, sf, feed, lambda rows: 3))
        assert plan.index("Project") < plan.index("Exchange rangepartitioning")
        found, all_rows = star.arriving(spark, sf, feed, lambda rows: 3), star.staging(spark, sf, feed)[feed]
        assert found.exceptAll(all_rows).isEmpty() and all_rows.exceptAll(found).isEmpty()
        split = found.select(F.spark_partition_id().alias("p"), "_line").groupBy("p").agg(F.min("_line").alias("a"), F.max("_line").alias("b"))
        ends = [(r.a, r.b) for r in split.orderBy("p").collect()]
        assert all(b <= c for (_, b), (c, _) in zip(ends, ends[1:]))
