"""What the plans must look like at scale."""

import re

from fixtures import registered, star
from regiscope.operators import aggregates, branches, dedup, documents, network
from regiscope.plans import marts
from tests.conftest import plan_of


def typed(spark, sf, *names):
    return star.typed(spark, sf, *names)


def test_ranking_broadcasts_the_dimension_and_keeps_only_the_top(spark, sf):
    plan = plan_of(marts.capital_ranking(typed(spark, sf, "empresa", "dim_natureza_juridica"), 10))
    assert "TakeOrderedAndProject" in plan and "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_count_reads_only_the_filter_columns(spark, sf):
    estab = typed(spark, sf, "estabelecimento")["estabelecimento"]
    plan = plan_of(aggregates.count_establishments(estab, uf="SP"))
    assert "ReadSchema: struct<o_orderpriority:string>" in plan


def test_source_filters_are_pushed(spark, sf):
    orders = star.source(spark, sf, "orders").withColumnsRenamed(
        {"o_orderpriority": "uf", "o_custkey": "cnae_fiscal_principal"})
    plan = plan_of(aggregates.count_establishments(orders, uf="5-LOW", cnae="7"))
    assert "EqualTo(o_orderpriority,5-LOW)" in plan and "EqualTo(o_custkey,7)" in plan


def test_keep_first_cuts_before_the_shuffle(spark, sf):
    plan = plan_of(dedup.keep_first(star.source(spark, sf, "lineitem"), ["l_orderkey"], ["l_partkey"]))
    below = plan[plan.index("Exchange hashpartitioning"):]
    assert re.search(r"WindowGroupLimit .*row_number\(\), 1, Partial", below)


def test_distinct_companies_are_shuffled_by_form_and_company(spark, sf):
    plan = plan_of(aggregates.regime_distribution(typed(spark, sf, "regime_tributario")["regime_tributario"]))
    assert re.search(r"hashpartitioning\(forma_de_tributacao#\d+, cnpj_basico#\d+", plan)
    assert "Expand" not in plan


def test_branch_view_has_no_cartesian_and_broadcasts_dimensions(spark, sf):
    plan = plan_of(branches.branch_view(typed(spark, sf, *registered._BRANCH_TABLES)))
    assert plan.count("BroadcastHashJoin") >= 5
    assert "Cartesian" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_branch_view_shuffles_only_for_the_company_when_it_is_large(spark, sf):
    tables = typed(spark, sf, *registered._BRANCH_TABLES)
    tables["empresa"] = tables["empresa"].hint("merge")
    plan = plan_of(branches.branch_view(tables))
    assert plan.count("SortMergeJoin") == 1 and plan.count("Exchange hashpartitioning") == 2


def test_network_does_not_shuffle_the_facts(spark, sf):
    plan = plan_of(network.partner_network(typed(spark, sf, *registered._NETWORK_TABLES), "***000007**", 50))
    assert "TakeOrderedAndProject" in plan and "SortMergeJoin" not in plan


def test_documents_shuffle_each_child_once(spark, sf):
    tables = typed(spark, sf, *registered._DOCUMENT_TABLES)
    for name in ("empresa", "simples"):
        tables[name] = tables[name].hint("merge")
    empty = spark.createDataFrame([], "cnpj_basico string, child string, n long")
    plan = plan_of(documents.company_documents(tables, hot=empty))
    # Three children, the company and its flags; the joins reuse those partitions.
    assert plan.count("Exchange hashpartitioning(cnpj_basico") == 5


def test_no_python_in_any_query_plan(spark, sf):
    for name in ("c1_estabelecimento", "c1_regime", "d6_company_documents", "l1_name_similarity", "i12_explode_codes"):
        plan = plan_of(registered.QUERIES[name](spark, sf))
        assert "Python" not in plan and "MapInArrow" not in plan, name
