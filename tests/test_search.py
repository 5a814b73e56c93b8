import pytest

from regiscope.functions import trigram
from regiscope.operators import search
from tests.conftest import plan_of

NAMES = ["Padaria São João Ltda", "PADARIA SAO JOAO", "padaria-joao", "João & Filhos", "", " ", "x", "Ação 24h",
         "a b c", "aaa aaa", "Mercado Central S/A", None, "joa", "PADARIA"]


def python_trigrams(text):
    import re

    return {f"  {w} "[i: i + 3] for w in re.findall(r"[^\W_]+", text.lower()) for i in range(len(w) + 1)}


@pytest.mark.parametrize("query", ["padaria joão", "a", "AAA", "mercado", "x y z", "joao"])
@pytest.mark.parametrize("threshold", [0.01, 0.3, 0.6, 1.0])
def test_similarity_is_exact(spark, query, threshold):
    df = spark.createDataFrame([(n,) for n in NAMES], "name string")
    got = {r.name: r.similaridade for r in search.name_similarity(df, "name", query, threshold).collect()}
    asked = python_trigrams(query)
    want = {}
    for n in NAMES:
        grams = python_trigrams(n or "")
        score = len(grams & asked) / len(grams | asked) if n else 0
        if score >= threshold:
            want[n] = score
    assert got == pytest.approx(want)


def test_names_are_normalised_once(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "name string").repartition(2)
    assert plan_of(search.name_similarity(df, "name", "padaria joao da silva")).count("regexp_replace") <= 2


@pytest.mark.parametrize("threshold", [0.1, 0.3, 0.6, 1.0])
def test_batch_gives_what_single_queries_give(spark, threshold):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(NAMES + NAMES[:3])], "k int, name string")
    asked = ["padaria joão", "AAA", "mercado", "nothing of the kind", "", None, "AAA"]
    queries = spark.createDataFrame([(q,) for q in asked], "query string")
    got = {(r.k, r["query"]): r.similaridade for r in
           search.name_similarity_batch(df, "name", queries, threshold=threshold).collect()}
    want = {(r.k, q): r.similaridade for q in set(asked) - {"", None}
            for r in search.name_similarity(df, "name", q, threshold).collect()}
    assert got == pytest.approx(want)
    with pytest.raises(ValueError):
        search.name_similarity_batch(df, "name", queries, threshold=0)


def test_trigram_sets(spark):
    df = spark.createDataFrame([(n,) for n in NAMES if n is not None], "name string")
    for r in df.select("name", trigram.trigrams(df.name).alias("g")).collect():
        assert sorted(r.g) == sorted(python_trigrams(r.name))
    assert trigram.query_trigrams("Cat") == ["  c", " ca", "at ", "cat"]


def test_empty_query_finds_nothing(spark):
    df = spark.createDataFrame([("a",)], "name string")
    assert search.name_similarity(df, "name", " - ").collect() == []


def test_substring_takes_wildcards_literally(spark):
    df = spark.createDataFrame([("100% Pão",), ("1000 pães",)], "name string")
    assert [r.name for r in search.name_search(df, "name", "0% P").collect()] == ["100% Pão"]


def test_activity(spark):
    estab = spark.createDataFrame([("a", 1), ("b", 2), ("c", None), ("d", 1)], "cnpj string, cnae_fiscal_principal int")
    bridge = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1), ("c", 2)], "cnpj string, cnae_cod int")
    got = sorted((r.cnpj, r.origem) for r in search.establishments_by_activity(estab, bridge, 1).collect())
    assert got == [("a", "principal"), ("b", "secundaria"), ("c", "secundaria"), ("d", "principal")]
    only = search.establishments_by_activity(estab, bridge, 1, include_primary=False).collect()
    assert sorted(r.cnpj for r in only) == ["a", "b", "c"]
