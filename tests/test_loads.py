"""Files through readers and jobs into stored tables, and questions over them."""

import gzip
import json

import pytest

from agrolume import plans
from agrolume.operators import quality
from agrolume.schema import TABLES
from agrolume.sources import agrofit, conab, cultivares, fertilizantes, meteorologia, pam, readers, sementes, zarc


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    d = tmp_path_factory.mktemp("raw")
    write(
        d / "cultivares.csv",
        "CULTIVAR,NOME COMUM,GRUPO DA ESPÉCIE,SITUAÇÃO,MANTENEDOR (REQUERENTE) (NOME),Nº FORMULÁRIO,Nº REGISTRO,"
        "DATA DO REGISTRO,DATA DE VALIDADE DO REGISTRO\n"
        "'BONANZA' / BONA,Soja,Soja,REGISTRADA,EMBRAPA CERRADOS,1,10,02/01/2020,-\n"
        "OURO,Milho,Milho,REGISTRADA,EMPRESA X,2,11,15/10/2015,\n"
        "PRATA,Soja,Soja,CANCELADA,EMPRESA X,3,12,31/02/2015,\n",
    )

    def record(var, value, code):
        return {"D2N": var, "V": value, "D1C": code, "D1N": "M", "D3N": "2023"}

    (d / "pam").mkdir()
    write(
        d / "pam" / "pam_soja.json",
        json.dumps(
            [record("Variável", "Valor", "Município (Código)")]
            + [record("Área plantada", "100", c) for c in ("5107925", "5107909")]
            + [record("Quantidade produzida", v, c) for v, c in (("300", "5107925"), ("50", "5107909"))]
        ),
    )
    (d / "conab").mkdir()
    head = "ano_agricola;dsc_safra_previsao;uf;produto;area_plantada_mil_ha;producao_mil_t;produtividade_mil_ha_mil_t\n"
    write(d / "conab" / "SerieHistoricaGraos.txt", head + "2023/24;1ª Safra;MT;SOJA;1;0.2;1\n2022/23;1ª Safra;MT;SOJA;1;9;1\n", "latin1")
    write(d / "conab" / "LevantamentoGraos.txt", head + "2023/24;1ª Safra;MT;SOJA;1;0.4;1\nruim;1ª Safra;MT;SOJA;1;1;1\n", "latin1")
    price = "produto;uf;ano;mes;valor_produto_kg;dsc_nivel_comercializacao"
    write(d / "conab" / "PrecosMensalUF.txt", f"{price}\nSOJA;MT;2023;1;2,00;PRODUTOR\nSOJA;MT;2023;2;x;PRODUTOR\n", "latin1")
    write(
        d / "conab" / "PrecosMensalMunicipio.txt",
        f"{price};nom_municipio;cod_ibge\nSOJA;MT;2023;1;4,00;PRODUTOR;SORRISO;5107925\n",
        "latin1",
    )
    week = f"{price};semana;data_inicial_final_semana"
    write(d / "conab" / "PrecosSemanalUF.txt", week + "\n" + "".join(f"SOJA;MT;2023;1;1,0;ATACADO;{w};x\n" for w in (1, 2, 3, 4, 5)))
    write(
        d / "conab" / "PrecosSemanalMunicipio.txt",
        f"{week};nom_municipio;cod_ibge\nSOJA;MT;2023;1;1,0;ATACADO;6;x;SORRISO;5107925\n",
    )
    write(
        d / "agrofit.csv",
        "NR_REGISTRO;MARCA_COMERCIAL;INGREDIENTE_ATIVO;TITULAR_DE_REGISTRO;CLASSE;SITUACAO;CULTURA;PRAGA_NOME_COMUM\n"
        "1;MATA TUDO;G;A;Herbicida;R;Soja;Lagarta\n1;MATA TUDO;G;A;Herbicida;R;Soja;Percevejo\n"
        "2;;G;A;Inseticida;R;Soja;Lagarta\n3;X;G;A;C;R;Arroz;Y\n",
    )
    write(
        d / "fert.csv",
        "UNIDADE_DA_FEDERACAO;MUNICIPIO;NUMERO_REGISTRO_ESTABELECIMENTO;STATUS_DO_REGISTRO;ATIVIDADE\n"
        + "".join(f"MT;Sorriso;{i};{s};Comércio\n" for i, s in enumerate(["ATIVO", "Inativo", "ATIVO", "CANCELADO"])),
        "latin1",
    )
    (d / "sementes").mkdir()
    write(
        d / "sementes" / "campos_producao.csv",
        "DS_SAFRA;DS_ESPECIE;DS_CATEGORIA;DS_CULTIVAR;DS_MUNICIPIO;DS_UF;DS_STATUS;DT_PLANTIO;DT_COLHEITA;NR_AREA;"
        "NR_PRODUCAO_BRUTA;NR_PRODUCAO_EST\n2023/2023;Glycine max;C1;BRS;SORRISO;MT;ATIVO;01/10/2023;;100,5;300,25;1\n",
    )
    write(
        d / "sementes" / "reserva_semente.csv",
        "TIPOPERIODO;PERIODO;AREATOTAL;MUNICIPIO;UF;ESPECIE;CULTIVAR;AREAPLANTADA;AREAESTIMADA\nSafra;2023;50,0;SINOP;MT;SOJA;X;1;1\n",
    )
    (d / "zarc").mkdir()
    body = "cod_municipio_ibge;municipio;uf;cod_solo;dec1;dec2;dec3\n5107925;Sorriso;MT;1;20%;30%;30%\n5107925;Sorriso;MT;2;20%;;40%\n"
    (d / "zarc" / "zarc_soja.csv").write_bytes(gzip.compress(body.encode()))
    (d / "clima").mkdir()
    days = [f"2023-0{m}-01" for m in (1, 2)]
    daily = {
        "time": days, "precipitation_sum": [120.5, 0.0], "temperature_2m_max": [30.0, 31.0],
        "temperature_2m_min": [20.0, 21.0], "temperature_2m_mean": [25.0, 26.0],
    }
    write(d / "clima" / "5107925.json", json.dumps({"daily": daily}))
    write(d / "coords.csv", "codigo_ibge,latitude,longitude\n5107925,-12.5,-55.7\n")
    return d


def load_all(spark, tables, d):
    done = {}
    done |= cultivares.load(readers.read_cultivares(spark, str(d / "cultivares.csv")), tables)
    done |= pam.load(readers.read_pam_long(spark, str(d / "pam")), tables)
    done |= zarc.load(readers.read_zarc(spark, str(d / "zarc"), ["soja", "milho"]), tables)
    done |= conab.load(readers.read_conab_folder(spark, str(d / "conab")), tables)
    done |= agrofit.load(readers.read_agrofit(spark, str(d / "agrofit.csv")), tables)
    done |= fertilizantes.load(readers.read_fertilizantes(spark, str(d / "fert.csv")), tables)
    done |= sementes.load(readers.read_sigef_folder(spark, str(d / "sementes")), tables)
    weather, coords = readers.read_weather_json(spark, str(d / "clima")), readers.read_coords(spark, str(d / "coords.csv"))
    return done | meteorologia.load(weather, coords, tables)


def content(tables):
    return {n: sorted(map(str, t.read().drop("data_modificacao").collect())) for n, t in tables.items()}


@pytest.fixture(scope="module")
def loaded(spark, files, tmp_path_factory):
    from agrolume.sources.common import open_tables
    from agrolume.sources.dimensions import load_culturas

    t = open_tables(spark, str(tmp_path_factory.mktemp("star")))
    load_culturas(spark, t["dim_cultura"])
    places = [(1, "5107925", "Sorriso", "MT"), (2, "5107909", "Sinop", "MT"), (3, "1200013", "Outro", "AC")]
    t["dim_municipio"].insert_if_absent(spark.createDataFrame(places, "id_municipio int, codigo_ibge string, nome string, uf string"))
    return t, load_all(spark, t, files)


def test_rows_loaded(loaded):
    tables, done = loaded
    assert done == {
        "cultivares": 3, "pam": 2, "zarc": 5, "producao_historica": 2, "producao_estimativa": 2, "precos_uf_mensal": 2,
        "precos_mun_mensal": 1, "precos_uf_semanal": 5, "precos_mun_semanal": 1, "agrofit": 3, "fertilizantes": 4,
        "campos_producao": 1, "reserva_semente": 1, "meteorologia": 2,
    }
    sizes = {n: t.read().count() for n, t in tables.items()}
    assert (sizes["fato_producao_conab"], sizes["fato_precos_conab_mensal"], sizes["fato_precos_conab_semanal"]) == (3, 3, 6)
    conab_rows = {r.ano_agricola: r.producao_mil_t for r in tables["fato_producao_conab"].read().collect()}
    assert conab_rows == {"2023/24": 0.4, "2022/23": 9.0, "ruim": 1.0}


def test_constraints_hold(loaded):
    tables, _ = loaded
    star = plans.star(tables)
    for name, table in TABLES.items():
        assert quality.unique_violations(star[name], table.keys).count() == 0
        assert quality.unique_violations(star[name], [table.pk]).count() == 0
        for dim in table.references:
            key = TABLES[dim].pk
            assert quality.missing_references(star[name], star[dim], key).count() == 0
        assert all(r.n == 0 for r in quality.column_violations(star[name], table).collect() if r.check == "not_null")


def test_questions(loaded):
    t = plans.star(loaded[0])
    p = plans.raio_x_municipal(t, "5107925", "SOJA", 2023).first()
    assert (p.municipio, p.uf, p.cultura, p.risco_zarc_predominante, p.ocorreu_quebra_safra) == ("Sorriso", "MT", "soja", "20%", False)
    assert p.resumo_climatico == {"temp_media_c": 25.5, "umidade_media": 0.0, "precipitacao_anual_mm": 120.5}
    assert tuple(p.resultado_safra) == (2023, 100.0, 300.0)
    assert plans.raio_x_municipal(t, "5107909", "soja", 2023).first().ocorreu_quebra_safra is True
    empty = plans.raio_x_municipal(t, "1200013", "milho", 1990).first()
    assert (empty.resumo_climatico, empty.ocorreu_quebra_safra, empty.resultado_safra.area_plantada_ha) == (None, None, None)

    d = plans.dossie_insumos(t, "Soja").first()
    assert (d.cultivares_ativos, d.volume_sementes_sigef_ton, d.grau_de_tecnologia) == (1, 300.25, "Baixo")
    assert (d.defensivos_recomendados, d.principais_pragas_alvo) == (["MATA TUDO"], ["Lagarta", "Percevejo"])
    assert plans.dossie_insumos(t, "trigo").first().defensivos_recomendados == []

    v = plans.viabilidade_economica(t, "soja", "mt", 2023).first()
    # Mean of 2, 0 (unreadable) and 4 per kg.
    assert (v.producao_total_ton, v.preco_medio_anual_ton, v.valor_teto_atingido) == (350.0, 2000.0, 2400.0)
    assert (v.vgb_apurado_milhoes, v.renda_media_hectare) == (0.7, 3500.0)
    none = plans.viabilidade_economica(t, "trigo", "mt", 2023).first()
    assert (none.producao_total_ton, none.preco_medio_anual_ton, none.vgb_apurado_milhoes) == (None, None, None)

    j = plans.janela_aplicacao(t, "5107925", 2023, 1).first()
    assert (j.estabelecimentos_insumos, j.acumulado_chuvas_mm, j.janela_perfeita_aplicacao) == (3, 120.5, True)
    assert (j.mes_referencia, j.capacidade_de_atendimento) == ("2023-01", "Baixa")
    assert plans.janela_aplicacao(t, "5107925", 2023, 2).first().janela_perfeita_aplicacao is None  # a zero sum

    audit = {r.ano_safra: r for r in plans.auditoria_estimativas(t, "soja").collect()}
    assert set(audit) == {"2023/24", "2022/23"}
    a = audit["2023/24"]
    assert (a.estimativa_conab_mil_t, a.realizado_ibge_pam_mil_t, a.variacao_margem_erro) == (0.4, 0.35, -12.5)
    assert a.acuracidade_relatorio == "Boa (5–15%)"
    assert audit["2022/23"].variacao_margem_erro is None
    assert plans.auditoria_estimativas(t, "soja", "rs").count() == 0


def test_one_and_all_agree(loaded):
    t = plans.star(loaded[0])
    assert plans.viabilidade_all(t).where("uf = 'MT'").collect() == plans.viabilidade_economica(t, "soja", "MT", 2023).collect()
    assert plans.raio_x_all(t).where("municipio = 'Sorriso'").collect() == plans.raio_x_municipal(t, "5107925", "soja", 2023).collect()
    assert plans.dossie_all(t).where("cultura = 'soja'").collect() == plans.dossie_insumos(t, "soja").collect()
    assert set(plans.auditoria_all(t).collect()) == set(plans.auditoria_estimativas(t, "soja").collect())
    assert set(plans.janela_all(t).collect()) == {plans.janela_aplicacao(t, "5107925", 2023, m).first() for m in (1, 2)}


def test_listings(loaded):
    t = plans.star(loaded[0])
    assert plans.list_pam(t, "SOJA", "mt", 2023).count() == 2
    assert plans.list_pam(t, ano=0, cultura="").count() == 2
    assert plans.list_pam(t, page=2, page_size=1).first().municipio_nome == "Sorriso"
    assert plans.list_conab(t, ano_agricola="2022/23").first().producao_mil_t == 9.0
    assert plans.list_sigef(t, safra="2023/2023").first().especie == "Glycine max"
    assert plans.list_agrofit(t, classe="herbicida").count() == 2
    assert plans.list_fertilizantes(t, uf="mt", atividade="COMÉRCIO").count() == 4
    assert plans.list_clima(t, "5107925").count() == 2
    assert plans.list_zarc(t, "5107925", "Soja", 2).count() == 2
    assert plans.total_pages(plans.list_zarc(t, page=None), 1, 2).first() == (5, 1, 2, 3)
    with pytest.raises(ValueError):
        plans.list_zarc(t, page_size=501)
    assert plans.list_culturas(t).count() == 5
    assert plans.get_cultura(t, " SOJA").first().id_cultura == 1
    assert [r.nome for r in plans.list_municipios(t, "mt", "SORR").collect()] == ["Sorriso"]
    for missing in (
        lambda: plans.get_municipio(t, "0"),
        lambda: plans.get_cultura(t, "x"),
        lambda: plans.raio_x_municipal(t, "0", "soja", 2023),
        lambda: plans.dossie_insumos(t, " soja"),
    ):
        with pytest.raises(LookupError):
            missing()


def test_a_second_run_changes_nothing(spark, loaded, files):
    tables, _ = loaded
    before = content(tables)
    load_all(spark, tables, files)
    # Six weeks are stored, so the weekly table starts afresh and is filled again.
    assert content(tables) == before
