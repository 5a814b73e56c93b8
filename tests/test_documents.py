import datetime
import json

import pytest
from pyspark.sql import functions as F

from fixtures import registered, star
from regiscope.functions import ids
from regiscope.operators import branches, documents, network
from regiscope.plans.load import CLUSTERED
from regiscope.plans.publish import publish, tables as published
from tests.conftest import plan_of

NAMES = registered._DOCUMENT_TABLES


def registry(spark, sf, hot: int = 0):
    """The star registry; company 1 also gets ``hot`` copies of one partner, and as many
    branches and regimes."""
    t = star.typed(spark, sf, *NAMES)
    if hot:
        key = "00000001"
        copies = spark.range(hot)
        partner = t["socio"].limit(1).withColumn("cnpj_basico", F.lit(key))
        t["socio"] = t["socio"].unionByName(partner.crossJoin(copies.select()))
        branch = t["estabelecimento"].limit(1).drop("cnpj", "cnpj_basico", "uf")
        number = F.concat(F.lit(key), F.lpad((F.col("id") + 900000).cast("string"), 6, "0"))
        more = branch.crossJoin(copies).select(
            number.alias("cnpj"), F.lit(key).alias("cnpj_basico"), F.lit("SP").alias("uf"), *branch.columns)
        t["estabelecimento"] = t["estabelecimento"].unionByName(more)
        regime = t["regime_tributario"].limit(1).drop("cnpj_basico", "qtd_escrituracoes")
        years = regime.crossJoin(copies).select(
            F.lit(key).alias("cnpj_basico"), F.col("id").cast("int").alias("qtd_escrituracoes"), *regime.columns)
        t["regime_tributario"] = t["regime_tributario"].unionByName(years)
    return t


def merged(rows):
    """Children of all pages of a company, as sorted texts."""
    out = {}
    for r in rows:
        for child in documents.CHILD_TABLES:
            out.setdefault((r.cnpj_basico, child), []).extend(
                json.dumps(e.asDict(), default=str, sort_keys=True) for e in r[child])
    return {k: sorted(v) for k, v in out.items()}


def test_pages_hold_everything_once(spark, sf):
    t = registry(spark, sf, hot=700)
    whole = documents.company_documents(t).collect()
    paged = documents.company_documents(t, page_size=50).collect()
    assert all(r.pages == 1 and r.page == 0 for r in whole)
    hot = [r for r in paged if r.cnpj_basico == "00000001"]
    assert hot[0].pages >= 14 and sorted(r.page for r in hot) == list(range(hot[0].pages))
    assert merged(paged) == merged(whole)
    assert max(len(r.qsa) for r in hot) < 150, "copies of one partner are spread over the pages"
    assert max(len(r.estabelecimentos) for r in hot) < 150
    assert len({r.cnpj_basico for r in paged}) == len(whole)


def test_every_company_and_child_is_there(spark, sf):
    t = registry(spark, sf)
    docs = documents.company_documents(t)
    assert docs.count() == t["empresa"].count()
    for child, table in documents.CHILD_TABLES.items():
        want = t[table].join(t["empresa"], "cnpj_basico", "left_semi").count()
        assert docs.agg(F.sum(F.size(child))).first()[0] == want


def test_absent_children(spark, sf):
    t = registry(spark, sf)
    for name in ("socio", "regime_tributario", "estabelecimento", "simples"):
        t[name] = t[name].filter(F.lit(False))
    row = documents.company_document(t, "00000003").first()
    assert row.qsa == [] and row.regime_tributario == [] and row.estabelecimentos == []
    assert row.simples is None and row.cnpj_consultado is None


def test_order_and_fields(spark, sf):
    row = documents.company_document(registry(spark, sf), "00000001").first()
    assert row.estabelecimentos[0].__fields__[:3] == ["cnpj", "consultado", "matriz_filial"]
    kinds = [e.matriz_filial for e in row.estabelecimentos]
    assert kinds == sorted(kinds, key=lambda k: {"Matriz": 0, "Filial": 1, None: 2}[k])
    years = [(-r.ano, r.cnpj) for r in row.regime_tributario]
    assert years == sorted(years)
    assert not any(e.consultado for e in row.estabelecimentos)


def test_branch_request_marks_the_branch(spark, sf):
    t = registry(spark, sf)
    branch = t["estabelecimento"].filter("cnpj_basico = '00000001'").first().cnpj
    row = documents.company_document(t, branch).first()
    assert row.cnpj_consultado == branch
    assert [e.cnpj for e in row.estabelecimentos if e.consultado] == [branch]
    echo = documents.company_document(t, "00000001999999").first()
    assert echo.cnpj_consultado == "00000001999999" and not any(e.consultado for e in echo.estabelecimentos)


def test_bad_and_unknown_ids(spark, sf):
    t = registry(spark, sf)
    with pytest.raises(ValueError):
        documents.company_document(t, "1234567890")
    assert documents.company_document(t, "99999999").count() == 0
    with pytest.raises(ValueError):
        branches.branch_view(t, cnpj="123")
    assert branches.branch_view(t, cnpj="99999999000199").count() == 0
    with pytest.raises(ValueError):
        network.partner_network(t, "")
    assert network.partner_network(t, "nobody").count() == 0


def test_enrich_pages_and_flags(spark, sf):
    t = registry(spark, sf, hot=120)
    asked = spark.createDataFrame(
        [("00000001",), ("00000001900007",), ("00000002",), ("99999999",), ("123",), (None,)], "registry_id string")
    answers, docs = documents.enrich(asked, t, page_size=100)
    state = {(r.registry_id, r.valid, r.found) for r in answers.collect()}
    assert state == {("00000001", True, True), ("00000001900007", True, True), ("00000002", True, True),
                     ("99999999", True, False), ("123", False, False), (None, False, False)}
    rows = docs.collect()
    marked = [e.cnpj for r in rows for e in r.estabelecimentos if e.consultado]
    assert marked == ["00000001900007"]
    whole = documents.company_documents(t).filter("cnpj_basico = '00000001'").first()
    pages = [r for r in rows if r.cnpj_basico == "00000001"]
    assert len(pages) == pages[0].pages > 1 and sum(len(r.qsa) for r in pages) == len(whole.qsa)
    assert documents.to_documents(docs).filter("document like '%\"pages\":2%'").count() == 2


def test_enrich_grows_with_the_requests(spark, sf):
    t = registry(spark, sf)
    company = t["estabelecimento"].groupBy("cnpj_basico").count().orderBy(F.desc("count")).first()[0]
    ids = t["estabelecimento"].filter(F.col("cnpj_basico") == company).select(F.col("cnpj").alias("registry_id"))
    answers, docs = documents.enrich(ids, t)
    one = docs.collect()
    assert len(one) == 1 and len(one[0].estabelecimentos) == ids.count() == answers.count() > 3
    assert all(e.consultado for e in one[0].estabelecimentos)


def test_key_lists_too_long_to_broadcast(spark, sf, monkeypatch):
    from regiscope.operators import lookup

    t = registry(spark, sf, hot=120)
    keys, docs = t["empresa"].select("cnpj_basico"), t["socio"].select("cnpj_cpf_socio")
    few = merged(documents.company_documents(t, keys, page_size=100).collect())
    links = sorted(map(str, network.partner_network_batch(t, docs, 5).collect()))
    monkeypatch.setattr(lookup, "MAX_BROADCAST_KEYS", 0)
    monkeypatch.setattr(documents, "_BROADCAST_HOT", 0)
    assert merged(documents.company_documents(t, keys, page_size=100).collect()) == few
    assert sorted(map(str, network.partner_network_batch(t, docs, 5).collect())) == links


def test_hot_list_of_a_published_registry(spark, sf, tmp_path):
    t = registry(spark, sf, hot=90)
    t[documents.HOT_TABLE] = documents.hot_companies(t, 50)
    for name, df in t.items():
        publish(df, str(tmp_path), name, cluster_by=CLUSTERED.get(name, ()))
    p = published(spark, str(tmp_path))
    paged = documents.company_documents(p, page_size=80, hot=p[documents.HOT_TABLE]).collect()
    assert merged(paged) == merged(documents.company_documents(t).collect())
    assert max(r.pages for r in paged) == 2


def test_network_limit_and_unknown_company(spark, sf):
    t = registry(spark, sf)
    doc = t["socio"].groupBy("cnpj_cpf_socio").count().orderBy(F.desc("count")).first()[0]
    assert network.partner_network(t, doc, 3).count() == 3
    assert network.partner_network(t, doc, ids.clamp_limit("x", network.DEFAULT_LIMIT, network.MAX_LIMIT)).count() == 50
    every = t["socio"].filter(F.col("cnpj_cpf_socio") == doc).count()
    assert network.partner_network(t, doc).count() == every > 50
    docs = t["socio"].select("cnpj_cpf_socio")
    whole = network.partner_network_batch(t, docs)
    assert "Window" not in plan_of(whole) and whole.count() == t["socio"].filter("cnpj_cpf_socio is not null").count()
    cut = network.partner_network_batch(t, docs, 1000)
    assert plan_of(cut).count("Window") >= 2 and cut.count() == whole.count()
    only = t | {"empresa": t["empresa"].filter(F.lit(False))}
    assert {r.razao_social for r in network.partner_network(only, doc).collect()} == {None}


def test_branch_in_two_states_gives_one_row(spark, sf):
    t = registry(spark, sf)
    branch = t["estabelecimento"].first()
    t["estabelecimento"] = t["estabelecimento"].unionByName(
        t["estabelecimento"].filter(F.col("cnpj") == branch.cnpj).withColumn("uf", F.lit("AA")))
    assert [r.uf for r in branches.branch_view(t, cnpj=branch.cnpj).collect()] == ["AA"]
    assert [r.uf for r in branches.branch_view(t, cnpj=branch.cnpj, uf=branch.uf).collect()] == [branch.uf]


def test_json_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None, datetime.date(2024, 1, 2))], "a int, b string, d date")
    assert documents.to_documents(df).first()[0] == '{"a":1,"b":null,"d":"2024-01-02"}'
