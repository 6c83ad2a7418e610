"""Raw rows as each source publishes them, and the cleaned rows expected."""

from datetime import datetime

from agrolume.sources import agrofit, conab, cultivares, dimensions, fertilizantes, meteorologia, pam, sementes, zarc


def cultivar(nome, comum, mantenedor, nr, data, **other):
    return {
        "CULTIVAR": nome, "NOME COMUM": comum, "GRUPO DA ESPÉCIE": comum, "SITUAÇÃO": "REGISTRADA",
        "MANTENEDOR (REQUERENTE) (NOME)": mantenedor, "Nº FORMULÁRIO": "1", "Nº REGISTRO": nr,
        "DATA DO REGISTRO": data, "DATA DE VALIDADE DO REGISTRO": None,
    } | other


def test_cultivares(rows, culturas):
    raw = rows(
        [
            cultivar("'BONANZA' / BONA", "Soja", "EMBRAPA CERRADOS", "10", "02/01/2020"),
            cultivar('"OURO"', "Milho", "EMPRESA PRIVADA X", "11", "15/10/2015"),
            cultivar('"OURO"', "Milho", "EMPRESA PRIVADA X", "11", "15/10/2015"),
        ]
    )
    cleaned = cultivares.clean(raw)
    got = {r.nr_registro: r for r in cleaned.collect()}
    assert cleaned.count() == 2
    a, b = got["10"], got["11"]
    assert (a.cultivar, a.nome_secundario, a.SETOR, a.ANO, a.cultura) == ("BONANZA", "BONA", "Público", 2020, "soja")
    assert (b.cultivar, b.nome_secundario, b.SETOR, b.cultura) == ("OURO", None, "Privado", "milho")
    assert b.data_reg == datetime(2015, 10, 15)


def test_first_cultivar_counts_even_without_a_crop(rows, culturas):
    raw = rows(
        [
            {**cultivar("A", "Arroz", "X", "1", None), "_seq": "1"},
            {**cultivar("B", "Soja", "X", "1", None), "_seq": "2"},
            {**cultivar("C", "Soja", "X", "2", None), "_seq": "3"},
            {**cultivar("D", "Soja", "X", None, None), "_seq": "4"},
        ]
    )
    cleaned = cultivares.clean(raw)
    owners = rows([(1, "X", None)], "id_mantenedor int, nome string, setor string")
    got = cultivares.fact(cleaned, culturas, owners).collect()
    assert [(r.nr_registro, r.id_cultura, r.id_mantenedor) for r in got] == [("2", 1, 1)]


def test_pam(rows, culturas, municipios):
    def line(var, value, code, name, crop):
        return {"D2N": var, "V": value, "D1C": code, "D1N": name, "D3N": "2022", "cultura_raw": crop}

    raw = rows(
        [
            line("Área plantada", "1000", "1200013", "Municipio A", "soja"),
            line("Área colhida", "-", "1200013", "Municipio A", "soja"),
            line("Quantidade produzida", "...", "1200013", "Municipio A", "soja"),
            line("Área plantada", "2000", "1200054", "Municipio B", "trigo"),
        ]
    )
    got = {r.cod_municipio_ibge: r for r in pam.clean(raw).collect()}
    assert len(got) == 2
    a = got["1200013"]
    assert (a.area_plantada_ha, a.area_colhida_ha, a.qtde_produzida_ton, a.valor_producao_mil_reais) == (
        1000.0, None, None, None,
    )
    fact = {(r.id_cultura, r.id_municipio) for r in pam.fact(pam.clean(raw), culturas, municipios).collect()}
    assert fact == {(1, 1), (3, 2)}
    assert {r.metric: r.value for r in pam.metrics(raw).collect()} == {"rows_in": 4, "values_unparsed": 2}


def test_zarc(rows, culturas, municipios):
    raw = rows(
        [
            (1200013, "Municipio A", "Soja", "Tipo 1", "20%", "40%"),
            (1200054, "Municipio B", "Algodao", "Tipo 2", "30%", None),
        ],
        "cd_mun int, municipio string, cultura_raw string, `cod_solo` string, dec1 string, dec2 string",
    )
    cleaned = zarc.clean(raw)
    assert cleaned.columns == ["cod_municipio_ibge", "municipio", "cod_solo", "dec1", "dec2", "cultura"]
    got = sorted(tuple(r) for r in zarc.fact(cleaned, culturas, municipios).collect())
    assert got == [
        (1, 1, "Tipo 1", "dec1", "20%"),
        (1, 1, "Tipo 1", "dec2", "40%"),
        (4, 2, "Tipo 2", "dec1", "30%"),
    ]
    no_code = zarc.clean(rows([{"cultura_raw": "Soja", "dec1": "20%"}]))
    assert zarc.fact(no_code, culturas, municipios).count() == 0


def test_zarc_already_long(rows, culturas, municipios):
    raw = rows([{"cd_mun": "1200013", "cultura_raw": "Soja", "tipo_solo": "1", "periodo_plantio": "p1", "risco_climatico": "20%"}])
    assert [tuple(r) for r in zarc.fact(zarc.clean(raw), culturas, municipios).collect()] == [(1, 1, "1", "p1", "20%")]


def test_conab(rows, culturas, municipios):
    production = rows(
        [
            {
                "ano_agricola": "2023/24", "dsc_safra_previsao": "1ª Safra", "uf": " MT ", "produto": "Milho",
                "area_plantada_mil_ha": "1000", "producao_mil_t": "5000", "produtividade_mil_ha_mil_t": "x",
            }
        ]
    )
    got = conab.clean_production(production).first()
    assert (got.cultura, got.uf, got.safra, got.producao_mil_t, got.produtividade_t_ha) == (
        "milho", "MT", "1ª Safra", 5000.0, 0.0,
    )
    price = {
        "produto": "Milho", "uf": "MT", "nom_municipio": "Sorriso", "cod_ibge": " 5107925", "ano": "2024", "mes": "1",
        "valor_produto_kg": "1,50", "dsc_nivel_comercializacao": "Produtor",
    }
    got = conab.fact(conab.clean_prices(rows([price])), culturas, municipios).first()
    assert (got.cultura, got.valor_kg, got.cod_municipio_ibge, got.id_municipio, got.ano) == (
        "milho", 1.5, "5107925", 3, 2024,
    )
    weekly = conab.clean_prices(rows([{**price, "semana": "x", "data_inicial_final_semana": "01-07"}]), weekly=True)
    assert (weekly.first().semana, weekly.first().data_referencia) == (0, "01-07")


def test_agrofit(rows, culturas):
    raw = rows(
        [
            {"NR_REGISTRO": "12321", "MARCA_COMERCIAL": "MATA TUDO", "CULTURA": "Soja", "PRAGA_NOME_COMUM": "x", "OUTRA": "1"},
            {"NR_REGISTRO": "45654", "MARCA_COMERCIAL": "CRESCE MAIS", "CULTURA": "Milho", "PRAGA_NOME_COMUM": "Lagarta"},
            {"NR_REGISTRO": "1", "CULTURA": "Arroz"},
        ]
    )
    cleaned = agrofit.clean(raw)
    assert "OUTRA" not in cleaned.columns
    assert {(r.nr_registro, r.cultura) for r in cleaned.collect()} == {("12321", "soja"), ("45654", "milho"), ("1", "arroz")}
    assert {r.nr_registro for r in agrofit.fact(cleaned, culturas).collect()} == {"12321", "45654"}
    assert {r.metric: r.value for r in agrofit.metrics(cleaned).collect()} == {"rows_out": 3, "distinct_crops": 3}


def test_fertilizantes(rows, municipios):
    raw = rows(
        [
            {"UNIDADE_DA_FEDERACAO": "MT ", "MUNICIPIO": "SORRISO", "NUMERO_REGISTRO_ESTABELECIMENTO": "7", "_seq": "1"},
            {"UNIDADE_DA_FEDERACAO": "MT", "MUNICIPIO": "SINOP", "NUMERO_REGISTRO_ESTABELECIMENTO": "7", "_seq": "2"},
            {"UNIDADE_DA_FEDERACAO": "RS", "MUNICIPIO": "X", "NUMERO_REGISTRO_ESTABELECIMENTO": "8", "_seq": "3"},
        ]
    )
    cleaned = fertilizantes.clean(raw)
    got = {r.nr_registro_estabelecimento: (r.uf, r.id_municipio) for r in fertilizantes.fact(cleaned, municipios).collect()}
    assert got == {"7": ("MT", 3), "8": ("RS", None)}
    assert {r.metric: r.value for r in fertilizantes.metrics(cleaned).collect()} == {"rows_out": 3, "missing_nr_registro": 0}


def test_seed_production_vintages(rows, culturas, municipios):
    new = {
        "DS_SAFRA": "2023/2023", "DS_ESPECIE": "SOJA", "DS_CATEGORIA": "C1", "DS_CULTIVAR ": "BRS 100",
        "DS_MUNICIPIO": "SORRISO", "DS_UF": "MT", "DS_STATUS": "ATIVO", "DT_PLANTIO": "01/10/2023",
        "DT_COLHEITA": "01/02/2024", "NR_AREA": "100,5", "NR_PRODUCAO_BRUTA": "300,0", "NR_PRODUCAO_EST": "n/d",
    }
    old = {"Safra": "2019/2019", "Especie": "Milho", "Municipio": "Lugar Nenhum", "UF": "MT", "Area": "1"}
    cleaned = sementes.clean_production(rows([new, old]))
    got = {r.especie: r for r in cleaned.collect()}
    a = got["SOJA"]
    assert (a.area_ha, a.producao_bruta_t, a.producao_est_t, a.cultura, a.cultivar_raw) == (
        100.5, 300.0, 0.0, "soja", "BRS 100",
    )
    assert a.data_plantio == datetime(2023, 10, 1)
    assert (got["Milho"].safra, got["Milho"].area_ha) == ("2019/2019", 1.0)
    fact = sementes.fact(cleaned, culturas, municipios).collect()
    assert [(r.id_cultura, r.id_municipio) for r in fact] == [(1, 3)]


def test_seed_reserve(rows, culturas, municipios):
    raw = rows(
        [
            {
                "TIPOPERIODO": "Safra", "PERIODO": "2023", "AREATOTAL": "50,0", "MUNICIPIO": "SORRISO", "UF": "MT",
                "ESPECIE": "MILHO", "CULTIVAR": "X", "AREAPLANTADA": "40,0", "AREAESTIMADA": "45,0",
            }
        ]
    )
    got = sementes.fact(sementes.clean_reserve(raw), culturas, municipios).first()
    assert (got.area_total_ha, got.area_plantada_ha, got.cultura, got.id_municipio) == (50.0, 40.0, "milho", 3)


def test_weather(rows, municipios):
    raw = rows(
        [
            ("1200013", "2024-01-01", 2.0, 25.0, 24.0, 24.5),
            ("1200013", "2024-01-02", 0.0, 30.0, 28.0, 29.0),
            ("1200013", None, 0.0, 30.0, 28.0, 29.0),
            ("9999999", "2024-01-01", 0.0, 30.0, 28.0, 29.0),
        ],
        "codigo_ibge string, time string, precipitation_sum double, temperature_2m_max double, "
        "temperature_2m_min double, temperature_2m_mean double",
    )
    coords = rows([("1200013", 0.0, 0.0)], "codigo_ibge string, latitude double, longitude double")
    got = meteorologia.fact(meteorologia.clean(raw), municipios, coords).orderBy("data").collect()
    assert [(r.id_municipio, r.data, r.precipitacao_total_mm, r.temp_media_c) for r in got] == [
        (1, datetime(2024, 1, 1), 2.0, 24.5),
        (1, datetime(2024, 1, 2), 0.0, 29.0),
    ]
    assert (got[0].estacao_id, got[0].umidade_media) == ("OPEN-METEO", None)


def test_dimensions(rows, spark, tables):
    names = dimensions.cultura_rows(rows([{"n": " Soja"}, {"n": "Milho"}, {"n": "Trigo "}, {"n": "soja"}]), "n")
    assert {r[0] for r in names.collect()} == {"soja", "milho", "trigo"}
    crops = {r.nome_padronizado: r.id_cultura for r in tables["dim_cultura"].read().collect()}
    assert crops == {"soja": 1, "milho": 2, "trigo": 3, "algodão": 4, "cana-de-açúcar": 5}
    assert dimensions.load_culturas(spark, tables["dim_cultura"], ["Soja", "Aveia"]) == 1
    owners = dimensions.mantenedor_rows(
        rows([{"mantenedor": m, "SETOR": s} for m, s in (("A", "Privado"), ("A", "Privado"), ("B", "Público"), (None, "Nulo"))])
    )
    assert {tuple(r) for r in owners.collect()} == {("A", "Privado"), ("B", "Público")}
    pam_rows = rows([{"cod_municipio_ibge": c, "municipio_nome": n, "uf": "ac "} for c, n in (("1200013", "Mun A"), ("1200054", "Mun B"))])
    risk = rows([{"cod_municipio_ibge": c, "municipio": n, "uf": "AM"} for c, n in (("1200013.0", "Outro"), ("1300021", "Mun C"))])
    got = {r.codigo_ibge: (r.nome, r.uf) for r in dimensions.municipio_rows(pam_rows, risk).collect()}
    assert got == {"1200013": ("Mun A", "AC"), "1200054": ("Mun B", "AC"), "1300021": ("Mun C", "AM")}
