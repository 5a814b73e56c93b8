"""The parameterised questions as SQL table functions, next to their DataFrame forms."""

from fixtures import registered, star
from regiscope.functions.sql import register_queries
from regiscope.operators import aggregates, branches, network
from regiscope.plans import marts
from tests.conftest import plan_of


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_functions_equal_their_dataframe_forms(spark, sf):
    names = {*registered._BRANCH_TABLES, *registered._NETWORK_TABLES, "regime_tributario"}
    t = star.typed(spark, sf, *names)
    t[marts.CAPITAL] = aggregates.mart_capital_by_category(t["empresa"])
    assert register_queries(spark, t) == ["contar_estabelecimentos", "distribuicao_regimes", "ranking_capital", "rede_socio", "filial"]
    ask = lambda text: rows_of(spark.sql(f"SELECT * FROM {text}"))
    assert ask("contar_estabelecimentos('SP', 17, 2)") == rows_of(aggregates.count_establishments(t["estabelecimento"], "SP", 17, 2))
    assert ask("contar_estabelecimentos(p_cnae => 18)") == rows_of(aggregates.count_establishments(t["estabelecimento"], cnae=18))
    assert ask("distribuicao_regimes()") == rows_of(aggregates.regime_distribution(t["regime_tributario"]))
    assert ask("distribuicao_regimes(1900)") == []
    best = spark.sql("SELECT natureza_juridica, empresas, capital_total FROM ranking_capital(5) ORDER BY posicao").collect()
    assert list(map(tuple, best)) == list(map(tuple, marts.capital_ranking(t, 5).collect()))
    assert ask("rede_socio('***000007**')") == rows_of(network.partner_network(t, "***000007**").select(
        "cnpj_basico", "razao_social", "nome_socio", "qualificacao"))
    one = t["estabelecimento"].first().cnpj
    view = branches.branch_view(t, one).select("cnpj", "uf", "razao_social", "situacao", "cnae_principal", "municipio", "natureza_juridica")
    assert ask(f"filial('{one}')") == rows_of(view) != [] and ask(f"filial('{one}', 'XX')") == []


def test_a_function_without_its_tables_is_left_out(spark, sf):
    assert register_queries(spark, star.typed(spark, sf, "regime_tributario")) == ["distribuicao_regimes"]


def test_arguments_reach_the_scan(spark, sf):
    from pyspark.sql import functions as F

    orders = star.source(spark, sf, "orders").select(F.col("o_orderpriority").alias("uf"), F.col("o_orderkey").cast("int").alias("cnae_fiscal_principal"),
                                                     F.col("o_custkey").alias("situacao_cadastral"))
    register_queries(spark, {"estabelecimento": orders})
    plan = plan_of(spark.sql("SELECT * FROM contar_estabelecimentos(p_uf => '5-LOW', p_situacao => 7)"))
    assert "EqualTo(o_orderpriority,5-LOW)" in plan and "EqualTo(o_custkey,7)" in plan and "o_orderkey" not in plan.split("ReadSchema")[1]
