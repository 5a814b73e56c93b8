from pyspark.sql import functions as F

from fixtures import star
from regiscope.operators import lookup, sample
from regiscope.schemas import ARRIVAL

FEEDS = ("empresas", "estabelecimentos", "socios", "simples", "regime", "cnaes")


def test_sample_is_closed_and_whole(spark, sf):
    staging = star.staging(spark, sf, *FEEDS)
    kept = sample.coherent_sample(staging, 40)
    anchor = kept["estabelecimentos"].collect()
    assert len(anchor) == 40
    ids = {r.cnpj_basico for r in anchor}
    for name in ("empresas", "socios", "simples"):
        want = sorted(map(str, (r for r in staging[name].collect() if r.cnpj_basico in ids)))
        assert sorted(map(str, kept[name].collect())) == want
    assert kept["regime"].count() == 0 and kept["cnaes"].count() == staging["cnaes"].count()


def test_anchor_is_the_head_of_the_first_archive(spark):
    rows = [(f"{f}!{m}", i) for f in ("b.zip", "a.zip") for m in ("y.csv", "x.csv") for i in range(1, 6)]
    df = spark.createDataFrame(rows, list(ARRIVAL)).repartition(4)
    got = [tuple(r) for r in sample.first_archive_anchor(df, 7).orderBy(*ARRIVAL).collect()]
    assert got == [("a.zip!x.csv", i) for i in range(1, 6)] + [("a.zip!y.csv", 1), ("a.zip!y.csv", 2)]
    assert sample.first_archive_anchor(df, 100).count() == 10
    plain = df.withColumn(ARRIVAL[1], F.col(ARRIVAL[1]) + 600)  # a running number, as plain files have
    assert sample.first_archive_anchor(plain, 7).count() == 7


def test_large_anchor_is_not_broadcast(spark, sf, monkeypatch):
    staging = star.staging(spark, sf, *FEEDS)
    few = {n: d.count() for n, d in sample.coherent_sample(staging, 40).items()}
    monkeypatch.setattr(sample, "MAX_BROADCAST_KEYS", 0)
    assert {n: d.count() for n, d in sample.coherent_sample(staging, 40).items()} == few
    assert lookup.MAX_BROADCAST_KEYS > 0
