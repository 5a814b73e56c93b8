"""What is published next to the tables: postings of names, bitmaps, sketches, and aggregates kept by differences."""

import random
import re

import pytest
from pyspark.sql import functions as F

from fixtures import registered, star
from regiscope.functions import trigram
from regiscope.operators import aggregates, search
from regiscope.plans import bitmaps, incremental, load, marts, name_index, publish, sketches
from regiscope.session import work_path
from tests.conftest import plan_of

WORDS = ["padaria", "joão", "comercio", "açaí", "ltda", "rs", "a", "s/a", "123", "irmãos-silva", "PADARIA", "  "]


def published(spark, root, names, keys=("id",)):
    """Names in many small files, with their index."""
    path = f"{root}/lojas/1"
    names.repartitionByRange(40, *keys).sortWithinPartitions(*keys).write.parquet(path)
    made = name_index.write_index(root, "lojas", spark.read.parquet(path), "nome", keys)
    publish.commit(spark, root, {"lojas": path} | made)
    return name_index.name_index(publish.tables(spark, root), "lojas", "nome", keys)


@pytest.fixture(scope="module")
def index(spark, request):
    draw = random.Random(4)
    rows = [(i, " ".join(draw.choices(WORDS, k=draw.randint(0, 5))) + (f" unica{i}" if i % 500 == 0 else ""), "x") for i in range(3000)]
    rows += [(7, "padaria joão", "again"), (7, "padaria joão", "and again"), (8, None, "none"), (None, "padaria sem id", "null key")]
    return published(spark, work_path(spark, "idx"), spark.createDataFrame(rows, "id long, nome string, mais string"))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("pattern", ["padaria", "Joã", "oão co", "s/a", "s", "", "rs a", "12", "unica1500", "ilva ltda", "nothing like it", "a  a"])
def test_postings_search_equals_a_scan(spark, index, pattern):
    assert rows_of(name_index.search(index, pattern)) == rows_of(search.name_search(index.fact, "nome", pattern))


@pytest.mark.parametrize("query,threshold", [("padaria joao", 0.3), ("Unica 500", 0.5), ("ltda", 1.0), ("", 0.3), ("zzz", 0.2), ("açaí irmãos", 0.1)])
def test_postings_similarity_equals_a_scan(spark, index, query, threshold):
    want = rows_of(search.name_similarity(index.fact, "nome", query, threshold))
    assert rows_of(name_index.similar(index, query, threshold)) == want


def test_postings_batch_equals_the_join(spark, index):
    queries = spark.createDataFrame([(q,) for q in ("padaria joao", "açaí ltda", "unica 1000", None, "", "padaria joao", "xyz")], "query string")
    for threshold in (0.3, 0.7):
        want = rows_of(search.name_similarity_batch(index.fact, "nome", queries, threshold=threshold))
        assert want and rows_of(name_index.similar_batch(index, queries, threshold=threshold)) == want


def test_few_and_many_found_give_the_same(spark, index, monkeypatch):
    want = rows_of(name_index.search(index, "padaria"))
    for few in (0, 10, 100_000):
        monkeypatch.setattr(name_index, "FEW", few)
        assert rows_of(name_index.search(index, "padaria")) == want and len(want) > 1000
    monkeypatch.setattr(name_index, "RANGES", 2)
    assert rows_of(name_index.search(index, "unica")) == rows_of(search.name_search(index.fact, "nome", "unica"))


def rows_scanned(df, root_part) -> int:
    """Rows that scans of a table gave in the plan that ran."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found = 0
    stack = [plan]
    while stack:
        node = stack.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            stack.append(node.executedPlan())
            continue
        if node.nodeName().startswith("Scan parquet") and f"/{root_part}/" in node.relation().location().rootPaths().mkString(",") + "/":
            found += node.metrics().apply("numOutputRows").value()
        if "QueryStage" in node.nodeName():
            stack.append(node.plan())
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    return found


def test_the_table_is_read_for_candidates_only(spark, index):
    found = name_index.search(index, "unica1500")
    assert found.count() == 1
    plan = plan_of(found)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(id,1500\)", plan) and re.search(r"LessThanOrEqual\(id,1500\)", plan)
    assert 0 < rows_scanned(found, "lojas") <= 3000 // 40 + 5


def test_a_hot_trigram_is_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(name_index, "BLOCK", 64)
    names = spark.range(1000).selectExpr("id", "if(id % 3 = 0, 'padaria', concat('loja', id)) nome")
    index = published(spark, work_path(spark, "hot"), names)
    sizes = index.lists.filter("trigrama = 'pad'").select(F.size("lugares").alias("n")).collect()
    assert len(sizes) == 16 and max(r.n for r in sizes) <= 22
    assert name_index.search(index, "adari").count() == 334 and name_index.search(index, "loja7").count() == 75


def test_implied_trigrams_are_in_every_name_with_the_text():
    draw = random.Random(1)
    for _ in range(2000):
        name = " ".join(draw.choices(WORDS, k=3)).lower()
        a = draw.randrange(len(name))
        pattern = name[a : a + draw.randint(1, 9)]
        assert set(trigram.implied_trigrams(pattern)) <= set(trigram.query_trigrams(name))


def test_a_load_renews_what_is_derived_and_a_replaced_table_retires_it(spark, sf):
    root, folder = work_path(spark, "reg"), registered._snapshot(spark, sf)
    load.load_registry(spark, folder, root, month="2026-01", name_index=["empresa"], bitmaps=True, sketches=True)
    first = publish.current_versions(spark, root)
    t = publish.tables(spark, root)
    index = name_index.name_index(t, "empresa")
    assert rows_of(name_index.search(index, "#00000001")) == rows_of(search.name_search(t["empresa"], "razao_social", "#00000001")) != []
    assert bitmaps.count_branches(t, uf="SP").first().total == aggregates.count_establishments(t["estabelecimento"], uf="SP").first().total
    load.load_registry(spark, folder, root, month="2026-02")
    second = publish.current_versions(spark, root)
    derived = [n for n in first if n.startswith(publish.DERIVED)]
    assert len(derived) == 5 and all(second[n] != first[n] for n in derived)
    publish.publish(publish.read_table(spark, root, "empresa").limit(5), root, "empresa")
    third = publish.current_versions(spark, root)
    assert not [n for n in third if n.startswith("indice_empresa_")] and publish.BITMAPS in third
    publish.publish(t["estabelecimento_cnae_secundario"].limit(5), root, "estabelecimento_cnae_secundario")
    assert publish.BITMAPS not in publish.current_versions(spark, root)


# --- bitmaps


def test_bitmap_counts_read_no_branches(spark, sf):
    t = registered._bitmaps(spark, sf)
    assert set(t) == {publish.BITMAPS}
    plan = plan_of(bitmaps.count_branches(t, uf="SP", cnae="17", secondary=True))
    assert "indice_estabelecimento_bits" in plan and re.search(r"PushedFilters: \[[^\]]*EqualTo\(coluna,uf\)", plan)
    assert "Cartesian" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_bitmaps_over_several_buckets(spark):
    rows = spark.range(100_000).selectExpr(
        "lpad(cast(id as string), 14, '0') cnpj", "lpad(cast(id div 4 as string), 8, '0') cnpj_basico",
        "case when id % 5 = 0 then null when id % 3 = 0 then 'SP' else 'RJ' end uf", "cast(id % 7 as int) municipio_cod",
        "cast(id % 11 as int) cnae_fiscal_principal", "cast(if(id % 2 = 0, 2, 8) as short) situacao_cadastral")
    bridge = rows.selectExpr("cnpj", "cast(cast(cnpj as long) % 13 as int) cnae_cod")
    root = work_path(spark, "many")
    publish.commit(spark, root, bitmaps.write_bitmaps(root, rows, bridge.unionByName(bridge.limit(9))))
    t = publish.tables(spark, root)
    assert t[publish.BITMAPS].select("balde").distinct().count() == 4
    total = bitmaps.count_branches(t, uf="SP", cnae=4, situacao=2, secondary=True).first().total
    n = range(100_000)
    assert total == sum(i % 5 > 0 and i % 3 == 0 and i % 2 == 0 and (i % 11 == 4 or i % 13 == 4) for i in n)
    got = {r.codigo: r.qtd for r in bitmaps.count_by(t, "uf", situacao=8).collect()}
    assert got == {None: sum(i % 5 == 0 and i % 2 for i in n), "SP": sum(i % 5 > 0 and i % 3 == 0 and i % 2 for i in n),
                   "RJ": sum(i % 5 > 0 and i % 3 > 0 and i % 2 for i in n)}
    assert bitmaps.count_branches(t).first().total == 100_000
    empty = work_path(spark, "none")
    publish.commit(spark, empty, bitmaps.write_bitmaps(empty, rows.limit(0), bridge))
    assert bitmaps.count_branches(publish.tables(spark, empty), uf="SP").first().total == 0


def test_rare_codes_take_no_more_than_their_branches(spark):
    rows = spark.range(20_000).selectExpr(
        "lpad(cast(id as string), 14, '0') cnpj", "lpad(cast(id div 4 as string), 8, '0') cnpj_basico", "'SP' uf",
        "cast(id % 30 as int) municipio_cod", "cast(id * 7 % 5000 as int) cnae_fiscal_principal", "cast(2 as short) situacao_cadastral")
    root = work_path(spark, "rare")
    publish.commit(spark, root, bitmaps.write_bitmaps(root, rows, rows.selectExpr("cnpj", "cnae_fiscal_principal + 1 cnae_cod")))
    t = publish.tables(spark, root)
    stored = t[publish.BITMAPS].groupBy("coluna").agg(F.count("*"), F.sum(F.length(F.col("bits").cast("string")))).collect()
    assert all(n <= 20_000 and length <= 20 * n for _, n, length in stored)
    assert {r.coluna: r["count(1)"] for r in stored}["uf"] == 20_000 // 64 + 1
    assert bitmaps.count_branches(t, cnae=70, secondary=True).first().total == 8
    assert {r.qtd for r in bitmaps.count_by(t, "cnae_fiscal_principal", uf="SP").collect()} == {4}


# --- sketches


def test_sketches_within_their_error(spark):
    regime = spark.range(300_000).selectExpr(
        "lpad(cast(id as string), 14, '0') cnpj", "lpad(cast(id * 7 % 120000 as string), 8, '0') cnpj_basico",
        "cast(2020 + id % 3 as short) ano", "if(id % 2 = 0, 'LUCRO REAL', 'IMUNE DO IRPJ') forma_de_tributacao")
    estab = regime.limit(0).selectExpr("cnpj", "forma_de_tributacao uf")
    root = work_path(spark, "sk")
    publish.commit(spark, root, sketches.write_sketches(root, regime, estab))
    t = publish.tables(spark, root)
    exact = {r.forma_de_tributacao: r for r in aggregates.regime_distribution(regime).collect()}
    for r in sketches.distribution(t).collect():
        want = exact[r.forma_de_tributacao]
        assert r.registros == want.registros and abs(r.empresas_distintas / want.empresas_distintas - 1) < 0.03
    both = sketches.in_common(t, {"ano": 2020}, {"ano": 2021}).first()
    of = lambda year: regime.filter(F.col("ano") == year).select("cnpj_basico").distinct()
    want = of(2020).intersect(of(2021)).count()
    assert abs(both.ambas - want) <= 0.05 * of(2020).count() and 0 <= both.parte <= 1
    nothing = sketches.in_common(t, {"ano": 1900}, {"ano": 2020}).first()
    assert (nothing.primeira, nothing.ambas, nothing.parte) == (0, 0, None)
    assert "Scan parquet" in (plan := plan_of(sketches.distribution(t))) and "esbocos" in plan


def test_sets_of_many_companies_are_exact(spark):
    regime = spark.range(90_000).selectExpr(
        "lpad(cast(id as string), 14, '0') cnpj", "if(id % 30000 = 7, null, lpad(cast(id * 7 % 45000 as string), 8, '0')) cnpj_basico",
        "cast(2020 + id % 3 as short) ano", "if(id % 2 = 0, 'LUCRO REAL', null) forma_de_tributacao")
    estab = regime.limit(50).selectExpr("cnpj", "if(cnpj like '%1', 'SP', 'RJ') uf")
    root = work_path(spark, "exact")
    publish.commit(spark, root, sketches.write_sketches(root, regime, estab))
    t = publish.tables(spark, root)
    want = regime.groupBy("forma_de_tributacao").agg(F.count("*"), F.count_distinct("cnpj_basico"))
    assert rows_of(sketches.distribution(t)) == rows_of(want)
    assert tuple(sketches.distribution(t, []).first()) == (90_000, regime.select(F.count_distinct("cnpj_basico")).first()[0])
    of = lambda year: regime.filter(F.col("ano") == year).select("cnpj_basico").dropna().distinct()
    both = sketches.in_common(t, {"ano": 2020}, {"ano": 2021}).first()
    assert (both.primeira, both.ambas) == (of(2020).count(), of(2020).intersect(of(2021)).count())
    assert tuple(sketches.distribution(t, [], ano=1900).first()) == (0, 0)


# --- aggregates by differences

COMPANY = "cnpj_basico string, natureza_juridica_cod short, capital_social decimal(18,2)"
BRANCH = "cnpj_basico string, uf string, municipio_cod int, cnae_fiscal_principal int, situacao_cadastral short"


def recount(t):
    return [rows_of(df) for df in (aggregates.mart_capital_by_category(t["empresa"]), aggregates.mart_active_by_place_activity(t["estabelecimento"]))]


def test_three_loads_equal_a_recount(spark):
    from decimal import Decimal

    draw, root = random.Random(9), work_path(spark, "inc")
    companies = {i: (f"{i * 37:08d}", draw.choice([None, 1, 2, 3]), draw.choice([None, Decimal("1.50"), Decimal("7.00")])) for i in range(2000)}
    companies[-1] = ("00000037", 9, None)
    branches = [(f"{draw.randrange(2000) * 37:08d}", draw.choice(["SP", "??"]), draw.choice([1, None]), draw.randrange(3), draw.choice([2, 8, None]))
                for _ in range(3000)]
    seen = []
    for step in range(4):
        t = {"empresa": spark.createDataFrame(list(companies.values()), COMPANY), "estabelecimento": spark.createDataFrame(branches, BRANCH)}
        paths = {n: publish.write_version(df, root, n, cluster_by=["cnpj_basico"]) for n, df in t.items()}
        publish.commit(spark, root, paths)
        seen.append(incremental.refresh_incremental(spark, root))
        now = publish.tables(spark, root)
        assert [rows_of(now[m]) for m in (marts.CAPITAL, marts.ACTIVE)] == recount(t), step
        if step == 0:  # updates, deletions, insertions, repeated rows; a category's only company goes, another's capitals do
            del companies[-1], companies[5]
            companies[6] = (companies[6][0], 3, Decimal("9.99"))
            companies[5000] = ("99999999", 4, None)
            branches += [branches[0]] * 3 + [("00000000", "RJ", 5, 5, 2)]
        elif step == 1:
            branches = [b for b in branches if b[2] is not None or b[0] > "00040000"]
            companies = {i: (c[0], c[1], None if c[1] == 2 else c[2]) for i, c in companies.items()}
    assert seen[0] == {marts.CAPITAL: None, marts.ACTIVE: None}
    assert 0 < seen[1][marts.CAPITAL] <= 4 and 0 < seen[1][marts.ACTIVE] <= 2
    assert seen[3] == {marts.CAPITAL: 0, marts.ACTIVE: 0}


def test_unchanged_ranges_are_not_read(spark):
    root = work_path(spark, "rng")
    rows = spark.range(0, 100_000_000, 10_000).selectExpr(
        "lpad(cast(id as string), 8, '0') cnpj_basico", "cast(id % 3 as short) natureza_juridica_cod", "cast(1 as decimal(18,2)) capital_social")
    path = f"{root}/empresa/1"
    rows.repartitionByRange(50, "cnpj_basico").sortWithinPartitions("cnpj_basico").write.parquet(path)
    of, table = incremental.MARTS[0], spark.read.parquet(path)
    delta = incremental.changes(of, table, table.filter("cnpj_basico <> '00120000'"), ["0012", "0013", None])
    assert [tuple(r) for r in delta.select("cnpj_basico", "_vezes").collect()] == [("00120000", -1)]
    assert "GreaterThanOrEqual(cnpj_basico,0012)" in plan_of(delta)
    assert 0 < rows_scanned(delta, "empresa") <= 4 * 10_000 // 50


def test_a_lost_version_is_recounted(spark):
    from regiscope.session import remove

    root = work_path(spark, "lost")
    one = incremental.MARTS[:1]
    for n in (3, 5):
        df = spark.createDataFrame([(f"{i:08d}", 1, None) for i in range(n)], COMPANY)
        path = publish.write_version(df, root, "empresa", cluster_by=["cnpj_basico"])
        publish.commit(spark, root, {"empresa": path})
        got = incremental.refresh_incremental(spark, root, marts=one)
        assert got == {marts.CAPITAL: None} and publish.read_table(spark, root, marts.CAPITAL).first().empresas == n
        remove(spark, path)


def test_changes_are_a_multiset_difference(spark):
    of = incremental.MARTS[0]
    row = lambda *r: spark.createDataFrame(list(r), COMPANY)
    a = row(("1", 1, None), ("1", 1, None), ("2", 2, None), ("3", None, None))
    b = row(("1", 1, None), ("2", 3, None), ("3", None, None), ("3", None, None))
    got = {(r.cnpj_basico, r.natureza_juridica_cod): r._vezes for r in incremental.changes(of, a, b).collect()}
    assert got == {("1", 1): -1, ("2", 2): -1, ("2", 3): 1, ("3", None): 1}
