import datetime
import re
import zipfile

import pytest
from pyspark.sql import functions as F

from regiscope.operators import aggregates, documents, network
from regiscope.operators import branches as branches_
from regiscope.plans import load, marts, publish
from regiscope.schemas import DOMAINS, FACT_FEEDS, LOOKUPS, STAGING_COLUMNS
from regiscope.sources import feeds
from regiscope.streaming.snapshots import ingest_registry
from tests.conftest import plan_of


def branches(spark, n=200):
    states = F.element_at(F.array(*map(F.lit, ("SP", "SP", "SP", "RJ", "??"))), (F.col("id") % 5 + 1).cast("int"))
    return spark.range(n).select(
        F.lpad(F.col("id").cast("string"), 14, "0").alias("cnpj"), F.lpad(F.col("id").cast("string"), 8, "0").alias("cnpj_basico"),
        states.alias("uf"), (F.col("id") % 7).cast("int").alias("municipio_cod"),
        (F.col("id") % 3 + 1).cast("smallint").alias("situacao_cadastral"),
        F.col("id").cast("int").alias("cnae_fiscal_principal"))


def test_replace_is_repeatable_and_readers_keep_their_version(spark, tmp_path):
    root = str(tmp_path)
    publish.publish(spark.range(10), root, "t")
    before = publish.read_table(spark, root, "t")
    publish.publish(spark.range(3), root, "t")
    publish.publish(spark.range(3), root, "t")
    assert publish.read_table(spark, root, "t").count() == 3
    assert before.count() == 10, "a reader that opened the old version can finish"
    assert publish.drop_old_versions(spark, root) == 2
    assert publish.read_table(spark, root, "t").count() == 3


def test_written_but_not_committed_is_not_visible(spark, tmp_path):
    root = str(tmp_path)
    assert publish.tables(spark, root) == {} and publish.published_month(spark, root) is None
    publish.publish(spark.range(2), root, "t", month="2024-01")
    path = publish.write_version(spark.range(9), root, "t")
    assert publish.read_table(spark, root, "t").count() == 2
    publish.commit(spark, root, {"t": path, "u": path}, month="2024-02")
    assert {n: d.count() for n, d in publish.tables(spark, root, views=True).items()} == {"t": 9, "u": 9}
    assert spark.table("u").count() == 9
    assert publish.published_month(spark, root) == "2024-02"


def test_state_filter_reads_one_partition(spark, tmp_path):
    publish.publish(branches(spark), str(tmp_path), "estabelecimento", "uf", ("cnpj_basico",))
    got = publish.read_table(spark, str(tmp_path), "estabelecimento")
    one = got.filter("uf = '??'")
    assert one.count() == 40
    assert re.search(r"PartitionFilters: \[isnotnull\(uf#\d+\), \(uf#\d+ = \?\?\)\]", plan_of(one))
    assert got.count() == 200 and got.select("uf").distinct().count() == 3


def test_large_state_is_written_by_several_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        publish.publish(branches(spark, 4000), str(tmp_path), "estabelecimento", "uf", ("cnpj_basico", "cnpj"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = publish.read_table(spark, str(tmp_path), "estabelecimento").filter("uf = 'SP'")
    files = got.groupBy(F.input_file_name().alias("f")).agg(F.min("cnpj_basico").alias("lo"), F.max("cnpj_basico").alias("hi"))
    ranges = sorted((r.lo, r.hi) for r in files.collect())
    assert len(ranges) > 2
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:])), "files hold disjoint key ranges"


def test_bloom_columns(spark, tmp_path):
    path = publish.write_version(branches(spark, 5000), str(tmp_path), "t", bloom=("cnpj",))
    assert spark.read.parquet(path).filter("cnpj = '00000000000042'").count() == 1


def test_marts(spark, tmp_path):
    root = str(tmp_path)
    companies = spark.createDataFrame(
        [("1", 5, 1.5), ("2", 5, None), ("3", None, 2.0), ("4", 6, None)],
        "cnpj_basico string, natureza_juridica_cod int, v double",
    ).withColumn("capital_social", F.col("v").cast("decimal(18,2)"))
    publish.publish(companies, root, "empresa")
    publish.publish(branches(spark), root, "estabelecimento")
    marts.refresh_marts(spark, root)
    marts.refresh_marts(spark, root)
    t = publish.tables(spark, root)
    got = {r.natureza_juridica_cod: (r.empresas, r.capital_total and float(r.capital_total))
           for r in t[marts.CAPITAL].collect()}
    assert got == {5: (2, 1.5), None: (1, 2.0), 6: (1, None)}
    t["dim_natureza_juridica"] = spark.createDataFrame([(5, "five")], "codigo int, descricao string")
    ranking = [(r.natureza_juridica, r.empresas) for r in marts.capital_ranking(t, 2).collect()]
    assert ranking == [(None, 1), ("five", 2)]
    assert marts.capital_ranking(t).count() == 3
    assert t[marts.ACTIVE].agg(F.sum("qtd")).first()[0] == branches(spark).filter("situacao_cadastral = 2").count()


def snapshot(folder, month="2026-01", companies=30, without=()):
    """A small snapshot folder as it is delivered."""
    folder.mkdir(parents=True)

    def quoted(values):
        return ";".join('"' + v + '"' for v in values) + "\n"

    def write(name, *lines):
        if name not in without:
            with zipfile.ZipFile(folder / f"{name}.zip", "w") as z:
                z.writestr(f"{name}.csv", "".join(lines).encode("iso8859-15"))

    ids = [f"{i:08d}" for i in range(companies)]
    blank = {f: [""] * len(STAGING_COLUMNS[f]) for f in STAGING_COLUMNS}

    def row(feed, **values):
        cells = dict(zip(STAGING_COLUMNS[feed], blank[feed])) | values
        return quoted(cells.values())

    write("Empresas0", *[row("empresas", cnpj_basico=i, razao_social=f"Cia {i} é", natureza_juridica="206",
                             capital_social="10,50", porte="01") for i in ids[: companies // 2]])
    write("Empresas1", *[row("empresas", cnpj_basico=i, razao_social="x", natureza_juridica="999") for i in ids])
    for k in (0, 1):
        write(f"Estabelecimentos{k}", *[
            row("estabelecimentos", cnpj_basico=i, cnpj_ordem=f"{k + 1:04d}", cnpj_dv="01", uf="SP" if k else "",
                situacao_cadastral="02", cnae_principal="6201501", cnae_secundaria="6201501,123",
                identificador_matriz_filial=str(k + 1), data_inicio_atividade="20200102", municipio="7107")
            for i in ids])
    write("Socios0", *[row("socios", cnpj_basico=i, nome_socio="Ana", cnpj_cpf_socio="***000001**",
                           qualificacao_socio="49") for i in ids for _ in range(2)])
    write("Simples", *[row("simples", cnpj_basico=i, opcao_simples="S", opcao_mei="N") for i in ids])
    for name, code, text in (("Cnaes", "6201501", "Software"), ("Naturezas", "206", "Limitada"),
                             ("Qualificacoes", "49", "Sócio"), ("Municipios", "7107", "SÃO PAULO"),
                             ("Motivos", "00", "Sem"), ("Paises", "105", "BRASIL")):
        write(name, quoted((code, text)))
    if "entidades" not in without:
        head = ",".join(STAGING_COLUMNS["regime"]) + "\n"
        with zipfile.ZipFile(folder / "entidades-real.zip", "w") as z:
            for year in (2023, 2024):
                z.writestr(f"{year}.csv", head + "".join(
                    f'{year},{i[:2]}.{i[2:5]}.{i[5:]}/0001-01,0,LUCRO REAL,1\n' for i in ids))
    return folder


def test_full_load(spark, tmp_path):
    folder, root = snapshot(tmp_path / "2026-01"), str(tmp_path / "out")
    audit = {r.t: r["count"] for r in load.load_registry(spark, str(folder), root, month="2026-01").collect()}
    assert audit == {"empresa": 30, "estabelecimento": 60, "socio": 60, "simples": 30, "regime_tributario": 60}
    t = publish.tables(spark, root)
    assert set(t) >= {*LOOKUPS, *DOMAINS, marts.CAPITAL, marts.ACTIVE, documents.HOT_TABLE}
    assert t["empresa"].filter("razao_social = 'x'").count() == 15, "the earlier archive wins"
    assert t["estabelecimento_cnae_secundario"].count() == 120
    assert t["socio"].select("id").distinct().count() == 60
    top = marts.capital_ranking(t).collect()
    assert [(r.natureza_juridica, float(r.capital_total or 0)) for r in top] == [("Limitada", 157.5), (None, 0.0)]
    doc = documents.company_document(t, "00000003000201").first()
    assert [(e.matriz_filial, e.municipio, e.uf, e.consultado) for e in doc.estabelecimentos] == [
        ("Matriz", "SÃO PAULO", "??", False), ("Filial", "SÃO PAULO", "SP", True)]
    assert [p.qualificacao for p in doc.qsa] == ["Sócio", "Sócio"] and doc.simples.opcao_simples is True
    assert [r.ano for r in doc.regime_tributario] == [2024, 2023] and doc.porte == "Micro empresa"
    assert doc.estabelecimentos[0].data_inicio_atividade == datetime.date(2020, 1, 2)
    lookup = plan_of(branches_.branch_view(t, cnpj="00000003000201", uf="SP"))
    assert "EqualTo(cnpj,00000003000201)" in lookup and "EqualTo(cnpj_basico,00000003)" in lookup
    assert re.search(r"PartitionFilters: \[isnotnull\(uf#\d+\), \(uf#\d+ = SP\)\]", lookup)
    one = plan_of(documents.company_document(t, "00000003"))
    assert one.count("EqualTo(cnpj_basico,00000003)") >= 5, "the key reaches every scan"
    assert "EqualTo(cnpj_cpf_socio,***000001**)" in plan_of(network.partner_network(t, "***000001**"))
    again = {r.t: r["count"] for r in load.load_registry(spark, str(folder), root, month="2026-01").collect()}
    assert again == audit


def test_plain_files_load_like_archives(spark, tmp_path):
    zipped = snapshot(tmp_path / "zipped", companies=8)
    plain = tmp_path / "plain"
    for path in zipped.iterdir():
        with zipfile.ZipFile(path) as z:
            for name in z.namelist():
                z.extract(name, plain)
                if path.name.startswith("entidades"):
                    (plain / name).write_bytes((plain / name).read_bytes().replace(b"\n", b"\r\n"))
                    (plain / name).rename(plain / f"entidades-{name}")
    got = {}
    for folder in (zipped, plain):
        root = str(tmp_path / f"out-{folder.name}")
        load.load_registry(spark, str(folder), root)
        t = publish.tables(spark, root)
        got[folder.name] = {n: sorted(map(str, t[n].drop("id").collect())) for n in (*FACT_FEEDS, *LOOKUPS)}
    assert got["zipped"] == got["plain"] and len(got["plain"]["regime_tributario"]) == 16


def test_regime_alone(spark, tmp_path):
    root = str(tmp_path / "out")
    load.load_registry(spark, str(snapshot(tmp_path / "a", without=("entidades",))), root)
    before = publish.current_versions(spark, root)
    assert publish.read_table(spark, root, "regime_tributario").count() == 0
    summary = load.load_regime(spark, str(snapshot(tmp_path / "b", companies=12)), root).first()
    assert tuple(summary) == (24, 12, 2023, 2024)
    after = publish.current_versions(spark, root)
    changed = {n for n in after if after[n] != before[n]}
    assert changed == {"regime_tributario", documents.HOT_TABLE}


def test_a_replaced_child_retires_the_hot_list(spark, tmp_path):
    root = str(tmp_path / "out")
    load.load_registry(spark, str(snapshot(tmp_path / "in", companies=6)), root)
    t = publish.tables(spark, root)
    publish.publish(t["empresa"], root, "empresa")
    assert documents.HOT_TABLE in publish.current_versions(spark, root)
    publish.publish(t["socio"].unionByName(t["socio"]), root, "socio")
    now = publish.tables(spark, root)
    assert documents.HOT_TABLE not in now
    assert [len(r.qsa) for r in documents.company_documents(now).collect()] == [4] * 6


def test_sample_load_is_closed(spark, tmp_path):
    root = str(tmp_path / "out")
    load.load_registry(spark, str(snapshot(tmp_path / "a")), root, sample=7)
    t = publish.tables(spark, root)
    ids = {r.cnpj_basico for r in t["estabelecimento"].collect()}
    assert ids == {f"{i:08d}" for i in range(7)}
    for name in ("empresa", "socio", "simples"):
        assert {r.cnpj_basico for r in t[name].collect()} == ids
    assert t["regime_tributario"].count() == 0 and t["dim_cnae"].count() == 1


def test_failed_load_leaves_the_old_tables(spark, tmp_path):
    root = str(tmp_path / "out")
    load.load_registry(spark, str(snapshot(tmp_path / "a")), root, month="2026-01")
    bad = snapshot(tmp_path / "b", companies=5)
    with zipfile.ZipFile(bad / "Simples.zip", "w") as z:
        z.writestr("s.csv", '"00000001";"S";"20230230";"";"";"";""\n')
    before = sorted(str(p) for p in (tmp_path / "out").glob("*/*"))
    with pytest.raises(Exception, match="cannot read date"):
        load.load_registry(spark, str(bad), root, month="2026-02")
    assert sorted(str(p) for p in (tmp_path / "out").glob("*/*")) == before, "nothing of it stays"
    assert publish.read_table(spark, root, "empresa").count() == 30
    assert publish.published_month(spark, root) == "2026-01"
    audit = load.load_registry(spark, str(bad), root, month="2026-02", strict=False)
    assert {r.t: r["count"] for r in audit.collect()}["simples"] == 1
    held = publish.read_table(spark, root, "rejects_simples").collect()
    assert [(r.cnpj_basico, r._rejects) for r in held] == [("00000001", ["data_opcao_simples"])]
    assert publish.read_table(spark, root, "rejects_empresa").count() == 0


def test_monthly_ingest_of_archives(spark, tmp_path):
    root, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    snapshot(tmp_path / "in" / "2026-01", companies=6, without=("entidades",))
    snapshot(tmp_path / "in" / "2026-02", companies=4, without=("Paises", "entidades"))
    ingest_registry(spark, root, target, state)
    assert publish.published_month(spark, target) == "2026-01", "the newest month lacks a feed"
    with zipfile.ZipFile(tmp_path / "in" / "2026-02" / "Paises.zip", "w") as z:
        z.writestr("p.csv", '"105";"BRASIL"\n')
    ingest_registry(spark, root, target, state)
    assert publish.published_month(spark, target) == "2026-02"
    t = publish.tables(spark, target)
    assert t["empresa"].count() == 4 and t["regime_tributario"].count() == 0 and t[marts.ACTIVE].count() > 0


def test_approximate_distribution(spark):
    regime = spark.range(20_000).selectExpr("'x' as forma_de_tributacao", "cast(id % 4000 as string) as cnpj_basico", "1 as ano")
    rough = aggregates.regime_distribution(regime, approximate=True).first()
    assert rough.registros == 20_000 and abs(rough.empresas_distintas - 4000) < 400
    assert aggregates.regime_distribution(regime, "nonsense").first().empresas_distintas == 4000
    assert aggregates.regime_distribution(regime, 2).count() == 0


def test_profile(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("b", 2), (None, 3)], "x string, y int")
    row = aggregates.profile_pairs(df, "x", "y").first()
    assert tuple(row) == (4, 2, 2, 3, 0.5, 0.25)
    rough = aggregates.profile_pairs(df, "x", "y", approximate=True).first()
    assert tuple(rough) == (4, 2, 2, 3)
    empty = aggregates.profile_pairs(df.filter(F.lit(False)), "x", "y").first()
    assert (empty.linhas, empty.distintos_par) == (0, 0)


def test_missing_feeds(spark, tmp_path):
    lacking = ("Estabelecimentos0", "Estabelecimentos1", "Paises")
    folder, root = str(snapshot(tmp_path / "a", companies=4, without=lacking)), str(tmp_path / "out")
    assert feeds.missing_feeds(folder) == ["estabelecimentos", "paises"]
    audit = {r.t: r["count"] for r in load.load_registry(spark, folder, root).collect()}
    assert audit["estabelecimento"] == 0 and audit["empresa"] == 4
    t = publish.tables(spark, root)
    assert t["estabelecimento"].filter("uf = 'SP'").count() == 0 and t["dim_pais"].count() == 0
    assert documents.company_document(t, "00000001").first().estabelecimentos == []
    with pytest.raises(FileNotFoundError, match="estabelecimentos"):
        load.load_registry(spark, folder, root, sample=3)
    with pytest.raises(FileNotFoundError, match="paises"):
        load.load_registry(spark, folder, root, required=("paises", "empresas"))


def test_sample_reads_the_first_establishment_file_only(spark, tmp_path):
    folder = snapshot(tmp_path / "a", companies=9)
    (folder / "Estabelecimentos1.zip").write_bytes(b"no archive")
    (folder / "entidades-real.zip").write_bytes(b"no archive")
    kept = str(tmp_path / "kept")
    load.load_registry(spark, str(folder), str(tmp_path / "out"), sample=4, keep_staging=kept)
    assert publish.read_table(spark, str(tmp_path / "out"), "estabelecimento").count() == 4
    assert spark.read.parquet(f"{kept}/socios").count() == 8, "feeds are cut before they are landed"


def test_rejects_lose_nothing_and_go_with_a_clean_load(spark, tmp_path):
    folder, root = snapshot(tmp_path / "a", companies=3), str(tmp_path / "out")

    def rewrite(name, change):
        with zipfile.ZipFile(folder / name) as z:
            data = {n: change(z.read(n).decode("iso8859-15")) for n in z.namelist()}
        with zipfile.ZipFile(folder / name, "w") as z:
            for n, text in data.items():
                z.writestr(n, text.encode("iso8859-15"))

    rewrite("Estabelecimentos0.zip", lambda s: s.replace("6201501,123", "6201501,99999999999", 1))
    rewrite("Naturezas.zip", lambda s: s + '"99999";"Too large"\n')
    rewrite("Socios0.zip", lambda s: s + '"short";"record"\n')
    rewrite("entidades-real.zip", lambda s: s + '99999,00.000.001/0001-01,0,LUCRO REAL,1\n2024,x\n')
    with pytest.raises(Exception):
        load.load_registry(spark, str(folder), root)
    load.load_registry(spark, str(folder), root, strict=False)
    t = publish.tables(spark, root)
    assert t["estabelecimento_cnae_secundario"].count() == 11
    assert [r.code for r in t["rejects_estabelecimento_cnae_secundario"].collect()] == ["99999999999"]
    assert [r.codigo for r in t["rejects_dim_natureza_juridica"].collect()] == ["99999"]
    assert [(r.feed, r._corrupt_record) for r in t["rejects_records"].collect()] == [("socios", '"short";"record"')]
    assert t["socio"].count() == 6
    assert t["regime_tributario"].count() == 6 and t["rejects_regime_tributario"].count() == 2
    assert t["rejects_records_regime"].count() == 2
    load.load_regime(spark, str(folder), root, strict=False)
    t = publish.tables(spark, root)
    assert t["rejects_regime_tributario"].count() == 2 and t["rejects_records_regime"].count() == 2
    clean = str(snapshot(tmp_path / "b", companies=3))
    load.load_regime(spark, clean, root)
    left = {n for n in publish.current_versions(spark, root) if n.startswith("rejects_")}
    assert "rejects_socio" in left and not any("regime" in n for n in left)
    load.load_registry(spark, clean, root)
    assert not any(n.startswith("rejects_") for n in publish.current_versions(spark, root))
    assert publish.drop_old_versions(spark, root) > 0


def test_partners_are_ranged_by_document(spark, tmp_path):
    rows = spark.range(6000).selectExpr(
        "lpad(id % 900, 11, '0') cnpj_cpf_socio", "lpad(id, 8, '0') cnpj_basico", "'Ana' nome_socio")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = load.write_tables(str(tmp_path), {"socio": rows})["socio"]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = spark.read.parquet(path)
    assert got.select("id").distinct().count() == 6000
    place = got.withColumn("f", F.input_file_name())
    files = place.filter("cnpj_cpf_socio = '00000000450'").select("f").distinct().count()
    assert files <= 2 < place.select("f").distinct().count()
