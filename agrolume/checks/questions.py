"""Composite questions and listings."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolume import plans
from agrolume.checks.registry import query
from agrolume.checks.views import Star, sql

# ---- economic viability ---------------------------------------------------

_VIABILIDADE = {
    "prod": "SELECT cultura, uf, ano, sum(qtde_produzida_ton) AS ton, sum(area_plantada_ha) AS ha "
    "FROM pam JOIN municipio USING (id_municipio) GROUP BY 1, 2, 3",
    "preco": "SELECT cultura, uf, ano, avg(valor_kg) AS kg FROM precos GROUP BY 1, 2, 3",
    "tudo": "SELECT cultura, uf, ano, nullif(ton, 0) AS ton, nullif(ha, 0) AS ha, nullif(kg, 0) * 1000 AS preco, "
    "round(nullif(ton, 0) * (nullif(kg, 0) * 1000) / 1000000, 2) AS vgb FROM prod FULL JOIN preco USING (cultura, uf, ano)",
}
_VIABILIDADE_OUT = """SELECT ano, cultura, uf, round(ton, 6) AS producao_total_ton,
    round(preco, 2) AS preco_medio_anual_ton, round(preco * 1.2, 2) AS valor_teto_atingido,
    vgb AS vgb_apurado_milhoes,
    CASE WHEN ha > 0 THEN round(nullif(vgb, 0) * 1000000 / ha, 2) END AS renda_media_hectare FROM tudo"""


def _round_total(df: DataFrame) -> DataFrame:
    return df.withColumn("producao_total_ton", F.round("producao_total_ton", 6))


@query(sql("municipio", "pam", "precos", body=_VIABILIDADE_OUT, **_VIABILIDADE))
def viabilidade_all(spark, folder):
    return _round_total(plans.viabilidade_all(Star(spark, folder)))


@query(
    sql(
        "municipio", "pam", "precos",
        # One row also where there are no data.
        body=_VIABILIDADE_OUT
        + " RIGHT JOIN (SELECT 'promo' AS cultura, 'NATION_7' AS uf, CAST(1998 AS INTEGER) AS ano) USING (cultura, uf, ano)",
        **_VIABILIDADE,
    )
)
def viabilidade_uma(spark, folder):
    return _round_total(plans.viabilidade_economica(Star(spark, folder), "PROMO", "nation_7", 1998))


# ---- municipal profile ----------------------------------------------------

_RAIO_X = {
    "risco_n": "SELECT cultura, id_municipio, risco_climatico, count(*) AS n FROM zarc "
    "WHERE risco_climatico <> '' GROUP BY 1, 2, 3",
    "risco": "SELECT cultura, id_municipio, risco_climatico FROM risco_n QUALIFY row_number() OVER "
    "(PARTITION BY cultura, id_municipio ORDER BY n DESC, risco_climatico) = 1",
    "clima": "SELECT id_municipio, CAST(year(data) AS INTEGER) AS ano, avg(temp_media_c) AS temp, "
    "avg(umidade_media) AS umid, sum(precipitacao_total_mm) AS chuva FROM meteo GROUP BY 1, 2",
}


def _raio_x_sql(year: str) -> str:
    return f"""SELECT m.nome AS municipio, m.uf, p.cultura, p.ano, round(p.area_plantada_ha, 2) AS area_plantada_ha,
    round(p.qtde_produzida_ton, 6) AS qtde_produzida_ton, r.risco_climatico AS risco_zarc_predominante,
    round(c.temp, 2) AS temp_media_c,
    CASE WHEN c.temp IS NOT NULL THEN round(coalesce(c.umid, 0), 2) END AS umidade_media,
    CASE WHEN c.temp IS NOT NULL THEN round(coalesce(c.chuva, 0), 2) END AS precipitacao_anual_mm,
    nullif(p.qtde_produzida_ton, 0) / nullif(p.area_plantada_ha, 0) < 1.0 AS ocorreu_quebra_safra
    FROM p JOIN municipio m USING (id_municipio)
    LEFT JOIN risco r ON r.id_municipio = p.id_municipio AND r.cultura = p.cultura
    LEFT JOIN clima c ON c.id_municipio = p.id_municipio AND c.ano = {year}"""


def _flat_raio_x(df: DataFrame) -> DataFrame:
    climate = [F.col("resumo_climatico")[c].alias(c) for c in ("temp_media_c", "umidade_media", "precipitacao_anual_mm")]
    return df.select(
        "municipio", "uf", "cultura", "ano",
        F.round("resultado_safra.area_plantada_ha", 2).alias("area_plantada_ha"),
        F.round("resultado_safra.qtde_produzida_ton", 6).alias("qtde_produzida_ton"),
        "risco_zarc_predominante", *climate, "ocorreu_quebra_safra",
    )


# Weather exists for 2024 only and sales end in 2001, so the years are brought together.
_SAME_YEARS = {"p": "SELECT * REPLACE (CAST(ano + 23 AS INTEGER) AS ano) FROM pam"}


def _aligned(spark, folder) -> Star:
    return Star(spark, folder, fato_producao_pam=lambda df: df.withColumn("ano", F.col("ano") + 23))


@query(sql("municipio", "pam", "zarc", "meteo", body=_raio_x_sql("p.ano"), **_SAME_YEARS, **_RAIO_X))
def raio_x_all(spark, folder):
    return _flat_raio_x(plans.raio_x_all(_aligned(spark, folder)))


@query(
    sql(
        "municipio", "pam", "zarc", "meteo",
        body=_raio_x_sql("p.ano") + " WHERE m.codigo_ibge = '0000004' AND p.cultura = 'large' AND p.ano = 2024",
        **_SAME_YEARS, **_RAIO_X,
    )
)
def raio_x_um(spark, folder):
    return _flat_raio_x(plans.raio_x_municipal(_aligned(spark, folder), "0000004", "Large", 2024))


# ---- input dossier --------------------------------------------------------

_DOSSIE = {
    "ativos": "SELECT cultura, count(nr_registro) AS n FROM cultivares WHERE situacao ILIKE '%REGISTRAD%' GROUP BY 1",
    "sementes": "SELECT cultura, sum(producao_bruta_t) AS t FROM sigef GROUP BY 1",
    "registros": "SELECT cultura, count(*) AS n FROM agrofit GROUP BY 1",
    "marca": "SELECT DISTINCT cultura, marca_comercial FROM agrofit WHERE marca_comercial <> '' QUALIFY dense_rank() OVER "
    "(PARTITION BY cultura ORDER BY marca_comercial) <= 20",
    "marcas": "SELECT cultura, string_agg(marca_comercial, '|' ORDER BY marca_comercial) AS lista FROM marca "
    "WHERE marca_comercial <> '' GROUP BY 1",
    "praga": "SELECT cultura, praga_comum, count(*) AS n FROM agrofit WHERE praga_comum IS NOT NULL GROUP BY 1, 2",
    "praga_k": "SELECT *, row_number() OVER (PARTITION BY cultura ORDER BY n DESC, praga_comum) AS pos FROM praga",
    "pragas": "SELECT cultura, string_agg(praga_comum, '|' ORDER BY pos) AS lista FROM praga_k WHERE pos <= 10 GROUP BY 1",
}
_DOSSIE_OUT = """SELECT c.cultura, CAST(coalesce(a.n, 0) AS BIGINT) AS cultivares_ativos,
    round(nullif(s.t, 0), 2) AS volume_sementes_sigef_ton, coalesce(m.lista, '') AS defensivos_recomendados,
    coalesce(p.lista, '') AS principais_pragas_alvo,
    CASE WHEN coalesce(r.n, 0) >= 100 THEN 'Alto' WHEN coalesce(r.n, 0) >= 30 THEN 'Médio' ELSE 'Baixo' END
        AS grau_de_tecnologia
    FROM cultura c LEFT JOIN ativos a USING (cultura) LEFT JOIN sementes s USING (cultura)
    LEFT JOIN registros r USING (cultura) LEFT JOIN marcas m USING (cultura) LEFT JOIN pragas p USING (cultura)"""


def _flat_dossie(df: DataFrame) -> DataFrame:
    lists = ("defensivos_recomendados", "principais_pragas_alvo")
    return df.withColumns({c: F.array_join(c, "|") for c in lists})


@query(sql("cultura", "cultivares", "sigef", "agrofit", body=_DOSSIE_OUT, **_DOSSIE))
def dossie_all(spark, folder):
    return _flat_dossie(plans.dossie_all(Star(spark, folder)))


@query(sql("cultura", "cultivares", "sigef", "agrofit", body=_DOSSIE_OUT + " WHERE c.cultura = 'small'", **_DOSSIE))
def dossie_uma(spark, folder):
    return _flat_dossie(plans.dossie_insumos(Star(spark, folder), "Small"))


# ---- application window ---------------------------------------------------
# Weather covers one month; its days stand for the months of a year.

_JANELA = {
    "mensal": "SELECT id_municipio, CAST(day(data) % 12 + 1 AS INTEGER) AS mes, "
    "nullif(sum(precipitacao_total_mm), 0) AS chuva FROM meteo GROUP BY 1, 2",
    "lojas": "SELECT uf, count(*) AS n FROM fertilizantes WHERE status_registro ILIKE '%ATIVO%' GROUP BY 1",
}
_JANELA_OUT = """SELECT m.nome AS municipio, m.uf, '2024-' || lpad(CAST(mes AS VARCHAR), 2, '0') AS mes_referencia,
    CAST(coalesce(n, 0) AS BIGINT) AS estabelecimentos_insumos, round(chuva, 2) AS acumulado_chuvas_mm,
    CASE WHEN chuva IS NOT NULL THEN chuva BETWEEN 50 AND 200 AND coalesce(n, 0) >= 3 END AS janela_perfeita_aplicacao,
    CASE WHEN coalesce(n, 0) >= 50 THEN 'Alta' WHEN coalesce(n, 0) >= 15 THEN 'Média'
        WHEN coalesce(n, 0) >= 1 THEN 'Baixa' ELSE 'Sem cobertura' END AS capacidade_de_atendimento
    FROM mensal JOIN municipio m USING (id_municipio) LEFT JOIN lojas l ON l.uf = m.uf"""


def _months(spark, folder) -> Star:
    spread = F.expr("make_timestamp_ntz(2024, day(data) % 12 + 1, day(data) % 28 + 1, 0, 0, 0)")
    return Star(spark, folder, fato_meteorologia=lambda df: df.withColumn("data", spread))


@query(sql("municipio", "meteo", "fertilizantes", body=_JANELA_OUT, **_JANELA))
def janela_all(spark, folder):
    return plans.janela_all(_months(spark, folder))


@query(
    sql("municipio", "meteo", "fertilizantes", body=_JANELA_OUT + " WHERE codigo_ibge = '0000003' AND mes = 7", **_JANELA)
)
def janela_uma(spark, folder):
    return plans.janela_aplicacao(_months(spark, folder), "0000003", 2024, 7)


# ---- estimate audit -------------------------------------------------------


def _auditoria(conab: str) -> dict[str, str]:
    return {
        "est": f"SELECT cultura, uf, ano_agricola, nullif(sum(producao_mil_t), 0) AS est FROM conab {conab} "
        "GROUP BY 1, 2, 3",
        "realizado": "SELECT cultura, uf, ano, nullif(sum(qtde_produzida_ton), 0) / 1000 AS mil_t "
        "FROM pam JOIN municipio USING (id_municipio) GROUP BY 1, 2, 3",
        "par": "SELECT e.*, r.mil_t, CASE WHEN est > 0 THEN round((mil_t - est) / est * 100, 2) END AS var "
        "FROM est e LEFT JOIN realizado r ON r.cultura = e.cultura AND r.uf = e.uf "
        "AND r.ano = CAST(split_part(ano_agricola, '/', 1) AS INTEGER)",
    }


_AUDITORIA_OUT = """SELECT ano_agricola AS ano_safra, uf, cultura, round(est, 2) AS estimativa_conab_mil_t,
    round(mil_t, 2) AS realizado_ibge_pam_mil_t, var AS variacao_margem_erro,
    CASE WHEN abs(var) <= 5 THEN 'Excelente (≤5%)' WHEN abs(var) <= 15 THEN 'Boa (5–15%)'
        WHEN abs(var) <= 30 THEN 'Regular (15–30%)' WHEN var IS NOT NULL THEN 'Fraca (>30%)' END AS acuracidade_relatorio
    FROM par"""


@query(sql("municipio", "pam", "conab", body=_AUDITORIA_OUT, **_auditoria("")))
def auditoria_all(spark, folder):
    return plans.auditoria_all(Star(spark, folder))


@query(
    sql(
        "municipio", "pam", "conab", body=_AUDITORIA_OUT,
        **_auditoria("WHERE cultura = 'medium'"),
    )
)
def auditoria_uma(spark, folder):
    return plans.auditoria_estimativas(Star(spark, folder), "MEDIUM")


@query(
    sql(
        "municipio", "pam", "conab", body=_AUDITORIA_OUT,
        **_auditoria("WHERE cultura = 'medium' AND uf = 'NATION_3'"),
    )
)
def auditoria_uf(spark, folder):
    return plans.auditoria_estimativas(Star(spark, folder), "medium", "nation_3")


# ---- listings -------------------------------------------------------------


def _rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


_PAM_ROWS = """SELECT ano, round(area_plantada_ha, 2) AS area_plantada_ha, round(area_colhida_ha, 4) AS area_colhida_ha,
    round(qtde_produzida_ton, 6) AS qtde_produzida_ton, round(valor_producao_mil_reais, 5) AS valor_producao_mil_reais,
    cultura, nome AS municipio_nome, uf FROM pam JOIN municipio USING (id_municipio)"""


def _pam_out(df: DataFrame) -> DataFrame:
    df = _rounded(df.drop("id_producao"), 6, "qtde_produzida_ton")
    df = _rounded(df, 5, "valor_producao_mil_reais")
    return _rounded(_rounded(df, 4, "area_colhida_ha"), 2, "area_plantada_ha")


@query(sql("municipio", "pam", body=_PAM_ROWS + " ORDER BY cultura, municipio_nome, ano LIMIT 20"))
def list_pam(spark, folder):
    return _pam_out(plans.list_pam(Star(spark, folder)))


@query(sql("municipio", "pam", body=_PAM_ROWS + " WHERE cultura = 'promo' AND uf = 'NATION_7' AND ano = 1998"))
def list_pam_filtered(spark, folder):
    return _pam_out(plans.list_pam(Star(spark, folder), "Promo", "nation_7", 1998, page=None))


@query(
    sql(
        "municipio", "pam",
        body="SELECT count(*) AS total, CAST(2 AS INTEGER) AS page, CAST(20 AS INTEGER) AS page_size, "
        "CAST(ceil(count(*) / 20) AS BIGINT) AS total_pages FROM pam JOIN municipio USING (id_municipio) WHERE uf = 'NATION_7'",
    )
)
def page_totals(spark, folder):
    rows = plans.list_pam(Star(spark, folder), uf="NATION_7", page=None)
    return plans.total_pages(rows, page=2, page_size=20)


@query(
    sql(
        "municipio", "conab",
        body="""SELECT uf, ano_agricola, safra, round(area_plantada_mil_ha, 4) AS area_plantada_mil_ha,
        round(producao_mil_t, 6) AS producao_mil_t, round(produtividade_t_ha, 6) AS produtividade_t_ha, cultura
        FROM conab WHERE cultura = 'large' AND ano_agricola = '1997/98'
        ORDER BY uf, safra LIMIT 20 OFFSET 20""",
    )
)
def list_conab(spark, folder):
    page = plans.list_conab(Star(spark, folder), "LARGE", None, "1997/98", page=2)
    page = _rounded(page.drop("id_conab"), 6, "producao_mil_t", "produtividade_t_ha")
    return _rounded(page, 4, "area_plantada_mil_ha")


@query(
    sql(
        "municipio", "sigef",
        body="""SELECT safra, especie, categoria, area_ha, round(producao_bruta_t, 5) AS producao_bruta_t,
        round(producao_est_t, 6) AS producao_est_t, cultura, nome AS municipio_nome, uf
        FROM sigef JOIN municipio USING (id_municipio) WHERE uf = 'NATION_2' AND safra = '1999/1999'
        ORDER BY cultura, nome, safra, especie, cultivar_raw, categoria LIMIT 20""",
    )
)
def list_sigef(spark, folder):
    page = plans.list_sigef(Star(spark, folder), uf="nation_2", safra="1999/1999")
    return _rounded(_rounded(page.drop("id_sigef_producao"), 5, "producao_bruta_t"), 6, "producao_est_t")


@query(
    sql(
        "agrofit",
        body="""SELECT nr_registro, marca_comercial, classe, praga_comum, cultura FROM agrofit
        WHERE upper(classe) = 'BRAND#7' AND cultura = 'small'
        ORDER BY nr_registro, marca_comercial NULLS FIRST, praga_comum LIMIT 20""",
    )
)
def list_agrofit(spark, folder):
    return plans.list_agrofit(Star(spark, folder), "small", "brand#7").drop("id_agrofit")


@query(
    sql(
        "fertilizantes",
        body="""SELECT uf, municipio, nr_registro_estabelecimento, razao_social, area_atuacao, atividade
        FROM fertilizantes WHERE uf = 'NATION_4' AND atividade = 'BUILDING'
        ORDER BY nr_registro_estabelecimento LIMIT 20""",
    )
)
def list_fertilizantes(spark, folder):
    return plans.list_fertilizantes(Star(spark, folder), "nation_4", "building").drop("id_fertilizante")


@query(
    sql(
        "municipio", "meteo",
        body="""SELECT data, round(precipitacao_total_mm, 2) AS precipitacao_total_mm,
        round(temp_media_c, 6) AS temp_media_c, round(umidade_media, 6) AS umidade_media, nome AS municipio_nome, uf
        FROM meteo JOIN municipio USING (id_municipio) WHERE data BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'
        ORDER BY nome, data LIMIT 20 OFFSET 40""",
    )
)
def list_clima(spark, folder):
    page = plans.list_clima(Star(spark, folder), None, date(2024, 1, 5), date(2024, 1, 25), page=3)
    return _rounded(_rounded(page.drop("id_meteo"), 2, "precipitacao_total_mm"), 6, "temp_media_c", "umidade_media")


@query(
    sql(
        "municipio", "meteo",
        body="""SELECT data, round(precipitacao_total_mm, 2) AS precipitacao_total_mm, nome AS municipio_nome
        FROM meteo JOIN municipio USING (id_municipio) WHERE codigo_ibge = '0000009'""",
    )
)
def list_clima_municipio(spark, folder):
    rows = plans.list_clima(Star(spark, folder), "0000009", page=None)
    return _rounded(rows.select("data", "precipitacao_total_mm", "municipio_nome"), 2, "precipitacao_total_mm")


@query(
    sql(
        "municipio", "zarc",
        body="""SELECT periodo_plantio, tipo_solo, risco_climatico, cultura, nome AS municipio, uf
        FROM zarc JOIN municipio USING (id_municipio) WHERE cultura = 'economy' AND tipo_solo = 'O'
        ORDER BY nome, uf, tipo_solo, periodo_plantio LIMIT 50 OFFSET 50""",
    )
)
def list_zarc(spark, folder):
    return plans.list_zarc(Star(spark, folder), cultura="Economy", id_solo="O", page=2)


@query("SELECT DISTINCT lower(p_type) AS nome_padronizado FROM part")
def list_culturas(spark, folder):
    return plans.list_culturas(Star(spark, folder)).drop("id_cultura")


@query("SELECT DISTINCT lower(p_type) AS nome_padronizado FROM part WHERE lower(p_type) = 'promo'")
def get_cultura(spark, folder):
    return plans.get_cultura(Star(spark, folder), " PROMO ").drop("id_cultura")


@query(
    sql("municipio", body="SELECT * FROM municipio WHERE uf = 'NATION_5' AND nome ILIKE '%ER#0%' ORDER BY id_municipio LIMIT 50")
)
def list_municipios(spark, folder):
    return plans.list_municipios(Star(spark, folder), "nation_5", "er#0")


@query(sql("municipio", body="SELECT * FROM municipio WHERE codigo_ibge = '0000003'"))
def get_municipio(spark, folder):
    return plans.get_municipio(Star(spark, folder), "0000003")
