import datetime

import pytest
from pyspark.sql import functions as F

from regiscope.operators import dedup, quality, transform
from regiscope.schemas import ARRIVAL, STAGING_COLUMNS, TYPED_COLUMNS, staging_schema


def feed(spark, name, *rows):
    """Staging rows from dicts; fields left out are blank, arrival is the given order."""
    full = [
        tuple(r.get(c, "") for c in STAGING_COLUMNS[name]) + (r.get("_file", "f"), r.get("_line", i))
        for i, r in enumerate(rows, 1)
    ]
    return spark.createDataFrame(full, staging_schema(name, arrival=True)).repartition(3)


COMPANY = {"cnpj_basico": "12345678", "razao_social": "A", "natureza_juridica": "206",
           "capital_social": "5000,00", "porte": "05"}


def test_company_types(spark):
    df = transform.transform_empresa(feed(spark, "empresas", COMPANY))
    assert df.dtypes == [
        ("cnpj_basico", "string"), ("razao_social", "string"), ("natureza_juridica_cod", "smallint"),
        ("qualificacao_resp_cod", "smallint"), ("capital_social", "decimal(18,2)"),
        ("porte_cod", "smallint"), ("ente_federativo", "string")]
    row = df.first()
    assert (row.natureza_juridica_cod, float(row.capital_social), row.porte_cod) == (206, 5000.0, 5)
    assert row.qualificacao_resp_cod is None and row.ente_federativo is None


def test_first_copy_wins_in_file_and_line_order(spark):
    df = transform.transform_empresa(feed(
        spark, "empresas",
        COMPANY | {"razao_social": "late", "_file": "b", "_line": 1},
        COMPANY | {"razao_social": "second", "_file": "a", "_line": 10},
        COMPANY | {"razao_social": "first", "_file": "a", "_line": 9},
        COMPANY | {"cnpj_basico": "1234567"}, COMPANY | {"cnpj_basico": "12345678\n"},
    ))
    assert [r.razao_social for r in df.collect()] == ["first"]


BRANCH = {"cnpj_basico": "12345678", "cnpj_ordem": "0001", "cnpj_dv": "95", "uf": "SP"}


def test_branch(spark):
    df = transform.transform_estabelecimento(feed(
        spark, "estabelecimentos",
        BRANCH | {"data_inicio_atividade": "20240229", "data_situacao_cadastral": "0", "ddd_1": "11",
                  "telefone_1": "3000", "ddd_2": None, "telefone_2": "4000", "municipio": "7107"},
        BRANCH | {"uf": " "}, BRANCH | {"uf": "SP "},
    ))
    assert [c for c in df.columns] == [c for c, _, _ in TYPED_COLUMNS["estabelecimento"]]
    got = {r.uf: r for r in df.collect()}
    assert set(got) == {"SP", "??"}
    assert got["SP"].cnpj == "12345678000195"
    assert got["SP"].data_inicio_atividade == datetime.date(2024, 2, 29)
    assert got["SP"].data_situacao_cadastral is None
    assert (got["SP"].ddd_telefone_1, got["SP"].ddd_telefone_2, got["SP"].municipio_cod) == ("113000", None, 7107)


def test_missing_part_of_a_required_id_fails(spark):
    rows = feed(spark, "estabelecimentos", BRANCH | {"cnpj_ordem": None})
    with pytest.raises(Exception, match="estabelecimento.cnpj must not be null"):
        transform.transform_estabelecimento(rows).collect()


def test_partners_keep_copies(spark):
    row = {"cnpj_basico": "12345678", "nome_socio": "B", "cnpj_cpf_socio": "***123456**"}
    assert transform.transform_socio(feed(spark, "socios", row, row)).count() == 2


REGIME = {"ano": "2024", "cnpj": "00.000.000/0001-91", "cnpj_da_scp": "0",
          "forma_de_tributacao": "LUCRO REAL", "quantidade_de_escrituracoes": "2"}


def test_regime(spark):
    df = transform.transform_regime(feed(
        spark, "regime", REGIME, REGIME | {"_file": "g", "cnpj_da_scp": ""}, REGIME | {"cnpj": "0000000000019"},
        REGIME | {"ano": ""}, REGIME | {"forma_de_tributacao": None}, REGIME | {"ano": "2023"},
    ))
    assert sorted(tuple(r) for r in df.collect()) == [
        ("00000000000191", "00000000", 2023, "LUCRO REAL", 2, None),
        ("00000000000191", "00000000", 2024, "LUCRO REAL", 2, None)]


def test_code_list(spark):
    df = transform.explode_codes(feed(
        spark, "estabelecimentos", BRANCH | {"cnae_secundaria": "1,,2, 3 ,x,2"}, BRANCH | {"cnae_secundaria": "03"},
        BRANCH | {"cnae_secundaria": ""}, BRANCH | {"cnae_secundaria": None},
        BRANCH | {"cnpj_basico": "bad", "cnae_secundaria": "9"},
    ))
    assert sorted(tuple(r) for r in df.collect()) == [("12345678000195", c) for c in (1, 2, 3)]


def test_lookup(spark):
    rows = [{"codigo": c, "descricao": c or "blank"} for c in ("7", "007", "", "x", " 1", "0")]
    df = transform.transform_lookup(feed(spark, "municipios", *rows), "dim_municipio")
    assert df.columns == ["codigo", "nome", "codigo_ibge", "uf"]
    assert sorted((r.codigo, r.nome) for r in df.collect()) == [(0, "0"), (7, "7")]
    with pytest.raises(Exception, match="dim_pais.nome must not be null"):
        transform.transform_lookup(feed(spark, "paises", {"codigo": "1", "descricao": None}), "dim_pais").collect()


def test_strict_and_rejects(spark):
    rows = feed(spark, "empresas", COMPANY, COMPANY | {"cnpj_basico": "00000001", "porte": "x", "capital_social": "1.2,3"})
    with pytest.raises(Exception, match="cannot read"):
        transform.transform_empresa(rows).collect()
    loose = transform.transform_empresa(rows, strict=False)
    assert loose.filter("porte_cod is null").count() == 1
    bad = transform.rejects(rows, "empresa").collect()
    assert [(r.cnpj_basico, sorted(r._rejects)) for r in bad] == [("00000001", ["capital_social", "porte_cod"])]


def test_missing_required_values_go_to_rejects(spark):
    rows = feed(spark, "estabelecimentos", BRANCH, BRANCH | {"cnpj_basico": "00000002", "cnpj_dv": None})
    kept = transform.transform_estabelecimento(rows, strict=False)
    assert [r.cnpj for r in kept.collect()] == ["12345678000195"]
    assert [r._rejects for r in transform.rejects(rows, "estabelecimento").collect()] == [["cnpj"]]
    blank = transform.transform_lookup(
        feed(spark, "paises", {"codigo": "1", "descricao": None}, {"codigo": "1", "descricao": "x"}), "dim_pais", False)
    assert [r.nome for r in blank.collect()] == ["x"]


def test_dense_ids_with_ties_and_copies(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("k"), F.lit("same").alias("v")).repartition(7)
    numbered = dedup.with_dense_id(df, ["k"]).collect()
    assert sorted(r.id for r in numbered) == list(range(1, 5001))
    by_id = [r.k for r in sorted(numbered, key=lambda r: r.id)]
    assert by_id == sorted(by_id)


def test_unique_ids(spark):
    df = dedup.with_surrogate_id(spark.range(1000).repartition(5).withColumnRenamed("id", "v"))
    assert df.select("id").distinct().count() == 1000 and df.columns == ["id", "v"]


def test_quality(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, None)], "k int, v string")
    assert {r.column_name: r.nulls for r in quality.null_counts(df, ["k", "v"]).collect()} == {"k": 0, "v": 2}
    assert [tuple(r) for r in quality.duplicate_keys(df, ["k"]).collect()] == [(1, 2)]
    with pytest.raises(ValueError, match="not unique"):
        quality.assert_unique(df, ["k"])
    quality.assert_unique(df, ["k", "v"])
    kept, held = quality.split_not_null(df, ["v"])
    assert (kept.count(), held.count()) == (1, 2)
    with pytest.raises(Exception, match="t.v must not be null"):
        quality.guard_not_null(df, ["v"], "t").collect()
    dim = spark.createDataFrame([(1,)], "codigo int")
    assert [tuple(r) for r in quality.orphan_codes(df, dim, "k").collect()] == [(2, 1)]


def test_arrival_columns_are_gone(spark):
    df = transform.transform_empresa(feed(spark, "empresas", COMPANY))
    assert not set(ARRIVAL) & set(df.columns)
