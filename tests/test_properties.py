"""Random small inputs against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from regiscope.operators import dedup, quality
from regiscope.operators.aggregates import regime_distribution, regime_summary


def rows(seed, n=400):
    rng = random.Random(seed)
    # A third of the rows share one key.
    return [
        (1 if rng.random() < 0.34 else rng.randrange(30), rng.choice("ab"), rng.randrange(50), i)
        for i in range(n)
    ]


@pytest.mark.parametrize("seed", range(3))
def test_first_and_top_per_key(spark, seed):
    data = rows(seed)
    df = spark.createDataFrame(data, "k int, f string, line int, i int").repartition(6)
    order = ["f", "line", "i"]
    first = {r.k: r.i for r in dedup.keep_first(df, ["k"], order).collect()}
    ranked = {}
    for r in sorted(data, key=lambda r: (r[1], r[2], r[3])):
        ranked.setdefault(r[0], []).append(r[3])
    assert first == {k: v[0] for k, v in ranked.items()}
    top = dedup.top_per_key(df, ["k"], [F.col(c) for c in order], 4).collect()
    assert sorted((r.k, r.i) for r in top) == sorted((k, i) for k, v in ranked.items() for i in v[:4])


@pytest.mark.parametrize("seed", range(3))
def test_regime_reports(spark, seed):
    data = [(f, str(k), 2016 + line % 9) for k, f, line, _ in rows(seed)]
    df = spark.createDataFrame(data, "forma_de_tributacao string, cnpj_basico string, ano int").repartition(5)
    got = [tuple(r) for r in regime_distribution(df, 2018).collect()]
    want = []
    for form in {d[0] for d in data}:
        own = [d for d in data if d[0] == form and d[2] == 2018]
        if own:
            want.append((form, len(own), len({d[1] for d in own})))
    assert got == sorted(want, key=lambda w: (-w[1], w[0]))
    summary = regime_summary(df).first()
    years = [d[2] for d in data]
    assert tuple(summary) == (len(data), len({d[1] for d in data}), min(years), max(years))


@pytest.mark.parametrize("seed", range(3))
def test_orphans_and_duplicates(spark, seed):
    data = rows(seed)
    df = spark.createDataFrame([(None if r[0] == 3 else r[0], r[1]) for r in data], "k int, f string")
    dim = spark.createDataFrame([(k,) for k in range(0, 30, 2)], "codigo int")
    got = {r.k: r.linhas for r in quality.orphan_codes(df, dim, "k").collect()}
    keys = [r[0] for r in data if r[0] != 3]
    assert got == {k: keys.count(k) for k in set(keys) if k % 2}
    copies = {r.k: r.copies for r in quality.duplicate_keys(df.filter("k is not null"), ["k"]).collect()}
    assert copies == {k: keys.count(k) for k in set(keys) if keys.count(k) > 1}
