"""The source jobs: raw rows as the files hold them, through cleaning and key
resolution, to rows of the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolume import schema
from agrolume.checks.registry import Tables, query
from agrolume.checks.views import Star, sales, sql
from agrolume.operators.dedupe import SEQ, keep_last
from agrolume.operators.table import assign_ids
from agrolume.session import scratch_dir
from agrolume.sources import (
    agrofit,
    conab,
    cultivares,
    dimensions,
    fertilizantes,
    meteorologia,
    pam,
    sementes,
    zarc,
)
from agrolume.sources.common import open_tables

# The crop list the jobs resolve to; part types are spelled as crops below.  Two of
# them are the same crop, so rows of different spelling meet on one key.
CROPS = [(1, "soja"), (2, "milho"), (3, "pêra"), (4, "cana-de-açúcar")]
PRODUCT = (
    "CASE p_type WHEN 'ECONOMY' THEN 'Pera' WHEN 'SMALL' THEN 'CANA DE AÇÚCAR' WHEN 'LARGE' THEN 'Soja' "
    "WHEN 'MEDIUM' THEN 'Milho Verde' WHEN 'PROMO' THEN 'Zea mays L.' ELSE 'Centeio' END"
)
CROP = (
    "CAST(CASE p_type WHEN 'ECONOMY' THEN 3 WHEN 'SMALL' THEN 4 WHEN 'LARGE' THEN 1 WHEN 'MEDIUM' THEN 2 "
    "WHEN 'PROMO' THEN 2 END AS INTEGER)"
)


def _crops(spark) -> DataFrame:
    return spark.createDataFrame(CROPS, "id_cultura int, nome_padronizado string")


def _stored(fact: DataFrame, table: schema.Table) -> DataFrame:
    """The rows an upsert writes: declared columns, last row per key."""
    extra = (SEQ,) if SEQ in fact.columns else ()
    return keep_last(table.conform(fact, extra), table.keys).drop(*extra)


def _rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


# ---- cultivars ------------------------------------------------------------
# Two parts share a registry number; the first one counts, whatever its crop.

_CULTIVAR = """CASE p_size % 4 WHEN 0 THEN concat('''', split_part(p_name, ' ', 1), ''' / ', split_part(p_name, ' ', 2))
    WHEN 1 THEN concat('"', p_name, '"') WHEN 2 THEN concat('<b>', p_name, '</b>') ELSE replace(p_name, ' ', '/') END"""
_OWNER = """CASE WHEN p_size < 10 THEN NULL WHEN p_size < 25 THEN concat('Embrapa ', p_brand) ELSE concat('Empresa ', p_brand) END"""


def _raw_cultivares(t: Tables) -> DataFrame:
    return t.part.selectExpr(
        f"{_CULTIVAR} AS CULTIVAR", f"{PRODUCT} AS `NOME COMUM`", "p_type AS `GRUPO DA ESPÉCIE`",
        "CASE WHEN p_size % 2 = 0 THEN ' REGISTRADA ' ELSE '' END AS `SITUAÇÃO`",
        "cast(p_size as string) AS `Nº FORMULÁRIO`", "cast(p_partkey div 2 as string) AS `Nº REGISTRO`",
        "concat(lpad(p_size % 31 + 1, 2, '0'), '/02/2020') AS `DATA DO REGISTRO`",
        "cast(null as string) AS `DATA DE VALIDADE DO REGISTRO`",
        f"{_OWNER} AS `MANTENEDOR (REQUERENTE) (NOME)`", "named_struct('row', p_partkey) AS _seq",
    )


@query(
    f"""SELECT p_partkey // 2 AS nr_registro, {CROP} AS id_cultura, {_OWNER} AS mantenedor,
    CASE WHEN p_size % 4 IN (1, 2) THEN p_name ELSE split_part(p_name, ' ', 1) END AS cultivar,
    CASE WHEN p_size % 4 IN (0, 3) THEN split_part(p_name, ' ', 2) END AS nome_secundario,
    CASE WHEN p_size % 2 = 0 THEN 'REGISTRADA' END AS situacao, CAST(p_size AS BIGINT) AS nr_formulario,
    CAST(CASE WHEN p_size % 31 < 29 THEN make_date(2020, 2, CAST(p_size % 31 + 1 AS INTEGER)) END AS TIMESTAMP) AS data_reg
    FROM part WHERE p_partkey % 2 = 0 AND p_type <> 'STANDARD'"""
)
def job_cultivares(spark, folder):
    cleaned = cultivares.clean(_raw_cultivares(Tables(spark, folder)))
    owners = assign_ids(dimensions.mantenedor_rows(cleaned), ["nome"], "id_mantenedor")
    rows = _stored(cultivares.fact(cleaned, _crops(spark), owners), schema.REGISTRO_CULTIVARES)
    named = rows.join(owners.selectExpr("id_mantenedor", "nome AS mantenedor"), "id_mantenedor", "left")
    return named.drop("id_mantenedor", "data_val")


_CULTIVARES_METRICS = """SELECT 'cultivares' AS source, m.metric, CAST(m.value AS BIGINT) AS value FROM (SELECT count(*) AS a,
    count(*) FILTER (p_type = 'ECONOMY') AS b, count(*) FILTER (p_size % 31 >= 29) AS c,
    count(*) FILTER (p_size % 4 IN (0, 3)) AS d FROM part),
    LATERAL (VALUES ('rows_in', a), ('accents_corrected', b), ('dates_unparsed', c), ('rows_out', a),
        ('secondary_names', d), ('missing_nr_registro', 0), ('validity_unparsed', 0),
        ('duplicates_removed', 0)) AS m(metric, value)"""


@query(_CULTIVARES_METRICS)
def job_cultivares_metrics(spark, folder):
    # Every raw row differs in its form number, brand or registry number.
    raw = _raw_cultivares(Tables(spark, folder)).withColumn("linha", F.col("_seq.row").cast("string"))
    return cultivares.metrics(raw, cultivares.clean(raw))


@query(_CULTIVARES_METRICS)
def job_cultivares_observed(spark, folder):
    """The counts that come with the load, in its one scan of the raw rows."""
    raw = _raw_cultivares(Tables(spark, folder)).withColumn("linha", F.col("_seq.row").cast("string"))
    tables = open_tables(spark, scratch_dir(spark, "cultivares-load"))
    tables["dim_cultura"].insert_if_absent(_crops(spark))
    return cultivares.load_with_metrics(raw, tables)[1]


# ---- production statistics ------------------------------------------------


@query(
    sql(
        "municipio",
        body=f"""SELECT id_cultura, id_municipio, ano, round(a, 6) AS area_plantada_ha, round(c, 6) AS area_colhida_ha,
        round(q, 8) AS qtde_produzida_ton, CAST(NULL AS DOUBLE) AS valor_producao_mil_reais FROM (
        SELECT {CROP} AS id_cultura, id_municipio, ano, avg(l_quantity) AS a, avg(nullif(l_tax, 0)) AS c, avg(l_extendedprice) AS q
        FROM (SELECT *, CAST(year(l_shipdate) AS INTEGER) AS ano FROM lineitem JOIN part ON l_partkey = p_partkey)
        JOIN municipio ON id_municipio = l_suppkey WHERE p_type <> 'STANDARD' GROUP BY 1, 2, 3, p_type)
        QUALIFY row_number() OVER (PARTITION BY id_cultura, id_municipio, ano
            ORDER BY c DESC NULLS LAST, a DESC NULLS LAST, q DESC) = 1""",
    )
)
def job_pam(spark, folder):
    star = Star(spark, folder)
    raw = sales(star.source).selectExpr(
        "lpad(cast(l_suppkey as string), 7, '0') AS D1C", "concat('Município ', l_suppkey) AS D1N",
        "cast(year(l_shipdate) as string) AS D3N", f"{PRODUCT} AS cultura_raw",
        """stack(3, 'Área plantada', cast(l_quantity as string),
        'Área colhida (Hectares)', CASE WHEN l_tax = 0 THEN '-' ELSE cast(l_tax as string) END,
        'Quantidade produzida', cast(l_extendedprice as string)) AS (D2N, V)""",
    )
    fact = pam.fact(pam.clean(raw), _crops(spark), star["dim_municipio"])
    rows = _rounded(_stored(fact, schema.PRODUCAO_PAM), 6, "area_plantada_ha", "area_colhida_ha")
    return _rounded(rows, 8, "qtde_produzida_ton")


# ---- climate risk ---------------------------------------------------------


@query(
    sql(
        "municipio", "zarc_wide",
        body=f"""SELECT {CROP} AS id_cultura, id_municipio, l_linestatus AS tipo_solo, p.periodo_plantio,
        max(p.risco_climatico) AS risco_climatico FROM zarc_wide JOIN municipio ON codigo_ibge = cd_mun,
        LATERAL (VALUES ('dec1', dec1), ('dec2', dec2), ('dec3', dec3), ('dec4', dec4)) AS p(periodo_plantio, risco_climatico)
        WHERE p_type <> 'STANDARD' AND p.risco_climatico IS NOT NULL GROUP BY 1, 2, 3, 4""",
    )
)
def job_zarc(spark, folder):
    from agrolume.checks.views import zarc_wide

    star = Star(spark, folder)
    raw = zarc_wide(star.source).selectExpr(
        f"{PRODUCT} AS cultura_raw", "cd_mun AS `Geocodigo-Municipio`", "l_linestatus AS `Cod Solo`",
        "dec1 AS Dec1", "dec2 AS Dec2", "dec3 AS Dec3", "dec4 AS Dec4",
    )
    return _stored(zarc.fact(zarc.clean(raw), _crops(spark), star["dim_municipio"]), schema.RISCO_ZARC)


# ---- supply company -------------------------------------------------------


@query(
    sql(
        "municipio",
        body=f"""SELECT {CROP} AS id_cultura, n_name AS uf, safra AS ano_agricola, o_orderpriority AS safra,
        max_by(l_extendedprice, (l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity)) AS producao_mil_t,
        CAST(0 AS DOUBLE) AS area_plantada_mil_ha, CAST(NULL AS DOUBLE) AS produtividade_t_ha
        FROM (SELECT *, year(o_orderdate) || '/' || (year(o_orderdate) + 1) AS safra FROM orders)
        JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
        WHERE p_type <> 'STANDARD' GROUP BY 1, 2, 3, 4""",
    )
)
def job_conab_producao(spark, folder):
    t = Tables(spark, folder)
    raw = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(sales(t), F.col("o_orderkey") == F.col("l_orderkey"))
        .selectExpr(
            "concat(year(o_orderdate), '/', year(o_orderdate) + 1, ' ') AS ano_agricola",
            "o_orderpriority AS dsc_safra_previsao", "concat(' ', n_name) AS uf", f"{PRODUCT} AS produto",
            "'n/d' AS area_plantada_mil_ha", "cast(l_extendedprice as string) AS producao_mil_t",
            "struct(l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity) AS _seq",
        )
    )
    return _stored(conab.fact(conab.clean_production(raw), _crops(spark)), schema.PRODUCAO_CONAB)


_PRICE_ROWS = f"""SELECT {CROP} AS id_cultura, CASE WHEN l_linenumber < 7 THEN m.id_municipio END AS id_municipio, m.uf,
    CAST(year(l_shipdate) AS INTEGER) AS ano, CAST(month(l_shipdate) AS INTEGER) AS mes,
    CAST(CASE WHEN l_tax = 0 THEN 0 ELSE ceil(day(l_shipdate) / 7) END AS INTEGER) AS semana,
    l_returnflag AS nivel_comercializacao, CASE WHEN l_discount = 0 THEN 0 ELSE l_extendedprice END AS valor_kg,
    strftime(l_shipdate, '%Y-%m') AS data_referencia,
    (l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity) AS ord
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN municipio m ON m.id_municipio = l_suppkey
    WHERE p_type <> 'STANDARD'"""


def _raw_prices(star: Star) -> DataFrame:
    places = star["dim_municipio"].selectExpr("id_municipio AS l_suppkey", "nome", "uf")
    return (
        sales(star.source)
        .join(places, "l_suppkey")
        .selectExpr(
            f"{PRODUCT} AS produto", "uf", "nome AS nom_municipio",
            "CASE WHEN l_linenumber < 7 THEN concat(lpad(cast(l_suppkey as string), 7, '0'), ' ') END AS cod_ibge",
            "cast(year(l_shipdate) as string) AS ano", "concat(month(l_shipdate), '.0') AS mes",
            "CASE WHEN l_discount = 0 THEN 'x' ELSE replace(cast(l_extendedprice as string), '.', ',') END AS valor_produto_kg",
            "l_returnflag AS dsc_nivel_comercializacao",
            "CASE WHEN l_tax = 0 THEN NULL ELSE cast(ceil(day(l_shipdate) / 7) as string) END AS semana",
            "date_format(l_shipdate, 'yyyy-MM') AS data_inicial_final_semana",
            "struct(l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity) AS _seq",
        )
    )


@query(
    sql(
        "municipio",
        body=f"""SELECT id_cultura, id_municipio, uf, ano, mes, nivel_comercializacao, valor_kg FROM ({_PRICE_ROWS})
        QUALIFY row_number() OVER (PARTITION BY id_cultura, id_municipio, uf, ano, mes, nivel_comercializacao
        ORDER BY ord DESC) = 1""",
    )
)
def job_precos_mensal(spark, folder):
    star = Star(spark, folder)
    fact = conab.fact(conab.clean_prices(_raw_prices(star)), _crops(spark), star["dim_municipio"])
    return _stored(fact, schema.PRECOS_MENSAL)


@query(
    sql(
        "municipio",
        body=f"""SELECT id_cultura, id_municipio, uf, ano, mes, semana, data_referencia, nivel_comercializacao, valor_kg
        FROM ({_PRICE_ROWS}) QUALIFY row_number() OVER (PARTITION BY id_cultura, id_municipio, uf, ano, mes, semana,
        nivel_comercializacao ORDER BY ord DESC) = 1""",
    )
)
def job_precos_semanal(spark, folder):
    star = Star(spark, folder)
    fact = conab.fact(conab.clean_prices(_raw_prices(star), weekly=True), _crops(spark), star["dim_municipio"])
    return _stored(fact, schema.PRECOS_SEMANAL)


# ---- registers ------------------------------------------------------------


@query(
    f"""SELECT {CROP} AS id_cultura, CAST(l_suppkey AS VARCHAR) AS nr_registro, p_name AS marca_comercial,
    max_by(CAST(l_quantity AS VARCHAR), (l_orderkey, l_linenumber, l_partkey, l_quantity)) AS ingrediente_ativo,
    l_returnflag AS praga_comum, count(*) AS n
    FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_type <> 'STANDARD' GROUP BY 1, 2, 3, 5"""
)
def job_agrofit(spark, folder):
    t = Tables(spark, folder)
    raw = sales(t).selectExpr(
        "cast(l_suppkey as string) AS NR_REGISTRO", "p_name AS MARCA_COMERCIAL",
        "cast(l_quantity as string) AS INGREDIENTE_ATIVO", "p_brand AS CLASSE", f"{PRODUCT} AS CULTURA",
        "l_returnflag AS PRAGA_NOME_COMUM", "p_size AS OUTRA",
        "struct(l_orderkey, l_linenumber, l_partkey, l_quantity) AS _seq",
    )
    fact = agrofit.fact(agrofit.clean(raw), _crops(spark))
    keys = list(schema.AGROFIT.keys)
    counts = fact.groupBy(*keys).agg(F.count("*").alias("n"))
    return _stored(fact, schema.AGROFIT).select(*keys, "ingrediente_ativo").join(counts, keys)


@query(
    sql(
        "municipio",
        body="""SELECT n_name AS uf, replace(c_name, 'Customer', 'Supplier') AS municipio, m.id_municipio,
        CAST(c_custkey // 2 AS VARCHAR) AS nr_registro_estabelecimento, c_mktsegment AS atividade
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN municipio m ON m.nome = replace(c_name, 'Customer', 'Supplier') AND m.uf = n_name
        QUALIFY row_number() OVER (PARTITION BY c_custkey // 2 ORDER BY c_custkey) = 1""",
    )
)
def job_fertilizantes(spark, folder):
    star = Star(spark, folder)
    t = star.source
    raw = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).selectExpr(
        "concat(n_name, ' ') AS UNIDADE_DA_FEDERACAO", "concat(' ', replace(c_name, 'Customer', 'Supplier')) AS MUNICIPIO",
        "cast(c_custkey div 2 as string) AS NUMERO_REGISTRO_ESTABELECIMENTO", "c_mktsegment AS ATIVIDADE",
        "c_custkey AS _seq",
    )
    rows = _stored(fertilizantes.fact(fertilizantes.clean(raw), star["dim_municipio"]), schema.FERTILIZANTES)
    return rows.select("uf", "municipio", "id_municipio", "nr_registro_estabelecimento", "atividade")


# ---- seeds ----------------------------------------------------------------


@query(
    sql(
        "municipio",
        body=f"""SELECT {CROP} AS id_cultura, id_municipio, safra, p_name AS cultivar_raw, l_returnflag AS categoria,
        CAST(data AS TIMESTAMP) AS data_plantio, area_ha, 0.0::DOUBLE AS producao_bruta_t
        FROM (SELECT *, CAST(year(l_shipdate) AS VARCHAR) AS safra,
            CASE WHEN l_linenumber = 1 THEN NULL ELSE l_shipdate END AS data, l_quantity + 0.5 AS area_ha
            FROM lineitem JOIN part ON l_partkey = p_partkey) JOIN municipio ON id_municipio = l_suppkey
        WHERE p_type <> 'STANDARD'
        QUALIFY row_number() OVER (PARTITION BY p_type, id_municipio, safra, p_name, l_returnflag
            ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_quantity DESC, l_shipdate DESC) = 1""",
    )
)
def job_sementes_producao(spark, folder):
    star = Star(spark, folder)
    places = star["dim_municipio"].selectExpr("id_municipio AS l_suppkey", "nome", "uf")
    raw = sales(star.source).join(places, "l_suppkey").selectExpr(
        "cast(year(l_shipdate) as string) AS `DS_SAFRA `", f"{PRODUCT} AS DS_ESPECIE", "l_returnflag AS DS_CATEGORIA",
        "p_name AS DS_CULTIVAR", "lower(nome) AS DS_MUNICIPIO", "uf AS DS_UF",
        "CASE WHEN l_linenumber = 1 THEN '' ELSE date_format(l_shipdate, 'dd/MM/yyyy') END AS DT_PLANTIO",
        "replace(cast(l_quantity + 0.5 as string), '.', ',') AS NR_AREA", "'s/d' AS NR_PRODUCAO_BRUTA",
        "struct(l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate) AS _seq",
    )
    fact = sementes.fact(sementes.clean_production(raw), _crops(spark), star["dim_municipio"])
    rows = _stored(fact, schema.SEMENTES_PRODUCAO)
    return rows.select(
        "id_cultura", "id_municipio", "safra", "cultivar_raw", "categoria", "data_plantio", "area_ha", "producao_bruta_t"
    )


@query(
    sql(
        "municipio",
        body=f"""SELECT {CROP} AS id_cultura, id_municipio, periodo, p_brand AS cultivar_raw,
        max(l_quantity) AS area_total_ha, max(l_quantity) / 2 AS area_plantada_ha
        FROM (SELECT *, CAST(year(l_shipdate) AS VARCHAR) AS periodo FROM lineitem JOIN part ON l_partkey = p_partkey)
        JOIN municipio ON id_municipio = l_suppkey WHERE p_type <> 'STANDARD' GROUP BY 1, 2, 3, 4, p_type""",
    )
)
def job_sementes_reserva(spark, folder):
    star = Star(spark, folder)
    places = star["dim_municipio"].selectExpr("id_municipio AS l_suppkey", "nome", "uf")
    raw = sales(star.source).join(places, "l_suppkey").selectExpr(
        "'Safra' AS TIPOPERIODO", "cast(year(l_shipdate) as string) AS PERIODO", f"{PRODUCT} AS ESPECIE",
        "p_brand AS CULTIVAR", "upper(nome) AS MUNICIPIO", "lower(uf) AS UF",
        "replace(cast(l_quantity as string), '.', ',') AS AREATOTAL",
        "replace(cast(l_quantity / 2 as string), '.', ',') AS AREAPLANTADA", "l_quantity AS _seq",
    )
    fact = sementes.fact(sementes.clean_reserve(raw), _crops(spark), star["dim_municipio"])
    rows = _stored(fact, schema.SEMENTES_RESERVA)
    return rows.select("id_cultura", "id_municipio", "periodo", "cultivar_raw", "area_total_ha", "area_plantada_ha")


# ---- weather --------------------------------------------------------------


@query(
    sql(
        "municipio",
        body="""SELECT id_municipio, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS data, max(value) AS precipitacao_total_mm,
        min(value) AS temp_min_c, 'OPEN-METEO' AS estacao_id FROM events
        JOIN municipio ON id_municipio = user_id JOIN supplier ON s_suppkey = user_id
        WHERE s_acctbal > 1000 GROUP BY 1, 2""",
    )
)
def job_meteorologia(spark, folder):
    from agrolume.sources.readers import explode_daily

    star = Star(spark, folder)
    days = star.source.events.groupBy("user_id", F.expr("cast(ts as date) AS d")).agg(
        F.max("value").alias("hi"), F.min("value").alias("lo")
    )
    # The second element of every array is a day without a date.
    raw = days.selectExpr(
        "lpad(cast(user_id as string), 7, '0') AS codigo_ibge",
        "named_struct('time', array(cast(d as string), null), 'precipitation_sum', array(hi, hi), "
        "'temperature_2m_max', array(hi, hi), 'temperature_2m_min', array(lo, lo), "
        "'temperature_2m_mean', array(lo, hi)) AS daily",
    )
    coords = star.source.supplier.where("s_acctbal > 1000").selectExpr(
        "lpad(cast(s_suppkey as string), 7, '0') AS codigo_ibge", "s_acctbal AS latitude", "s_acctbal AS longitude"
    )
    cleaned = meteorologia.clean(explode_daily(raw))
    fact = meteorologia.fact(cleaned, star["dim_municipio"], coords, limit=None)
    rows = _stored(fact, schema.METEOROLOGIA)
    return rows.select("id_municipio", "data", "precipitacao_total_mm", "temp_min_c", "estacao_id")
