"""The star schema over the test tables, in Spark and as SQL fragments.

Crops are part types, municipalities are suppliers, states are nations.  In Spark
a crop id is a hash of the name and facts meet dimensions by id, as they would in
storage; the SQL uses the names themselves.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrolume.checks.registry import Tables
from agrolume.schema import TABLES

CROP_ID = "hash(lower(p_type))"
CODE = "lpad(cast(s_suppkey as string), 7, '0')"
# Scales a price into a harvest, so that yields fall on both sides of 1 t/ha.
QSCALE = 2000


def _with_pk(df: DataFrame, table: str) -> DataFrame:
    t = TABLES[table]
    return df.withColumn(t.pk, F.xxhash64(*t.keys)) if t.pk not in df.columns else df


def dim_cultura(t: Tables) -> DataFrame:
    return t.part.selectExpr(f"{CROP_ID} AS id_cultura", "lower(p_type) AS nome_padronizado").distinct()


def dim_municipio(t: Tables) -> DataFrame:
    nations = t.nation.selectExpr("n_nationkey AS s_nationkey", "n_name")
    return t.supplier.join(nations, "s_nationkey").selectExpr(
        "int(s_suppkey) AS id_municipio", f"{CODE} AS codigo_ibge", "s_name AS nome", "n_name AS uf"
    )


def sales(t: Tables) -> DataFrame:
    """Line items with their part."""
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).withColumn(
        "id_cultura", F.expr(CROP_ID)
    )


def pam(t: Tables) -> DataFrame:
    return (
        sales(t)
        .groupBy("id_cultura", F.expr("int(l_suppkey) AS id_municipio"), F.expr("year(l_shipdate) AS ano"))
        .agg(
            F.sum("l_quantity").alias("area_plantada_ha"),
            F.expr("sum(l_quantity * (1 - l_discount)) AS area_colhida_ha"),
            F.expr(f"sum(l_extendedprice / {QSCALE}) AS qtde_produzida_ton"),
            F.expr("sum(l_extendedprice / 1000) AS valor_producao_mil_reais"),
        )
    )


def precos(t: Tables) -> DataFrame:
    states = dim_municipio(t).select("id_municipio", "uf")
    return (
        sales(t)
        .withColumn("id_municipio", F.expr("int(l_suppkey)"))
        .join(states, "id_municipio")
        .groupBy(
            "id_cultura", "id_municipio", "uf", F.expr("year(l_shipdate) AS ano"),
            F.expr("month(l_shipdate) AS mes"), F.col("l_returnflag").alias("nivel_comercializacao"),
        )
        .agg(F.expr("avg(l_extendedprice / l_quantity / 1000) AS valor_kg"))
    )


def zarc_wide(t: Tables) -> DataFrame:
    """Wide risk rows per crop, municipality and soil."""
    return (
        sales(t)
        .groupBy(F.col("p_type"), F.expr("lpad(cast(l_suppkey as string), 7, '0') AS cd_mun"), "l_linestatus")
        .agg(
            F.expr("concat(cast(10 * (1 + min(l_linenumber)) as string), '%') AS dec1"),
            F.expr("concat(cast(10 * (1 + count(*) % 4) as string), '%') AS dec2"),
            F.expr("CASE WHEN min(l_tax) > 0 THEN '20%' END AS dec3"),
            F.expr("concat(cast(10 * (1 + max(l_linenumber) % 4) as string), '%') AS dec4"),
        )
    )


def zarc(t: Tables) -> DataFrame:
    from agrolume.operators.reshape import unpivot_dec

    wide = zarc_wide(t).selectExpr(
        f"{CROP_ID} AS id_cultura", "int(cd_mun) AS id_municipio", "l_linestatus AS cod_solo",
        "dec1", "dec2", "dec3", "dec4",
    )
    return unpivot_dec(wide)


def conab(t: Tables) -> DataFrame:
    states = dim_municipio(t).selectExpr("id_municipio AS l_suppkey", "uf")
    return (
        sales(t)
        .join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(states, "l_suppkey")
        .groupBy("id_cultura", "uf", F.expr(f"{CROP_YEAR} AS ano_agricola"), F.col("o_orderpriority").alias("safra"))
        .agg(
            F.expr("sum(l_quantity) / 1000 AS area_plantada_mil_ha"),
            F.expr(f"sum(l_extendedprice / {QSCALE}) / 1000 AS producao_mil_t"),
            F.expr(f"sum(l_extendedprice) / {QSCALE} / sum(l_quantity) AS produtividade_t_ha"),
        )
    )


CROP_YEAR = (
    "concat(cast(year(o_orderdate) as string), '/', "
    "lpad(cast((year(o_orderdate) + 1) % 100 as string), 2, '0'))"
)


def agrofit(t: Tables) -> DataFrame:
    return (
        sales(t)
        .join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .selectExpr(
            "id_cultura", "cast(l_orderkey as string) AS nr_registro", "nullif(p_name, 'red plate') AS marca_comercial",
            "p_brand AS classe", "concat(o_orderpriority, ' ', l_returnflag, l_linestatus) AS praga_comum",
        )
        .distinct()
    )


def sigef(t: Tables) -> DataFrame:
    return (
        sales(t)
        .groupBy(
            "id_cultura", F.expr("int(l_suppkey) AS id_municipio"),
            F.expr("concat(year(l_shipdate), '/', year(l_shipdate)) AS safra"), F.expr("upper(p_type) AS especie"),
            F.col("p_name").alias("cultivar_raw"), F.col("l_returnflag").alias("categoria"),
        )
        .agg(
            F.sum("l_quantity").alias("area_ha"),
            F.expr("sum(l_extendedprice / 1000) AS producao_bruta_t"),
            F.expr("sum(l_extendedprice / 2000) AS producao_est_t"),
        )
    )


STATUS = (
    "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'ATIVO' WHEN 'BUILDING' THEN 'Inativo' "
    "WHEN 'FURNITURE' THEN 'Ativo' ELSE 'CANCELADO' END"
)


def fertilizantes(t: Tables) -> DataFrame:
    states = t.nation.selectExpr("n_nationkey AS c_nationkey", "n_name AS uf")
    return t.customer.join(states, "c_nationkey").selectExpr(
        "uf", "c_name AS municipio", "cast(c_custkey as string) AS nr_registro_estabelecimento",
        f"{STATUS} AS status_registro", "upper(c_name) AS razao_social", "lower(c_mktsegment) AS area_atuacao",
        "c_mktsegment AS atividade",
    )


def meteorologia(t: Tables) -> DataFrame:
    return (
        t.events.groupBy(
            F.expr("int(user_id) AS id_municipio"), F.expr("cast(cast(ts as date) as timestamp_ntz) AS data")
        )
        .agg(
            F.sum("value").alias("precipitacao_total_mm"),
            F.max("value").alias("temp_max_c"),
            F.min("value").alias("temp_min_c"),
            # Root mean squares: a yearly mean of these never ends in an exact half.
            F.expr("sqrt(avg(value * value)) AS temp_media_c"),
            F.expr("sqrt(avg(pow(cast(get_json_object(props, '$.k') as double), 2))) AS umidade_media"),
        )
    )


def cultivares(t: Tables) -> DataFrame:
    return t.part.selectExpr(
        "p_partkey AS nr_registro", f"{CROP_ID} AS id_cultura", "split(p_name, ' ')[0] AS cultivar",
        f"{SITUACAO} AS situacao",
    )


SITUACAO = "CASE WHEN p_size < 20 THEN 'REGISTRADA' WHEN p_size < 40 THEN 'Registrado' ELSE 'CANCELADA' END"


VIEWS = {
    "dim_cultura": dim_cultura,
    "dim_municipio": dim_municipio,
    "fato_producao_pam": pam,
    "fato_precos_conab_mensal": precos,
    "fato_risco_zarc": zarc,
    "fato_producao_conab": conab,
    "fato_agrofit": agrofit,
    "fato_sigef_producao": sigef,
    "fato_fertilizantes_estabelecimentos": fertilizantes,
    "fato_meteorologia": meteorologia,
    "fato_registro_cultivares": cultivares,
}


class Star(Mapping):
    """The views by table name, built when asked for."""

    def __init__(self, spark: SparkSession, folder: str, **changed):
        self.source, self.changed, self.made = Tables(spark, folder), changed, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.made:
            df = _with_pk(VIEWS[name](self.source), name)
            self.made[name] = self.changed[name](df) if name in self.changed else df
        return self.made[name]

    def __iter__(self):
        return iter(VIEWS)

    def __len__(self):
        return len(VIEWS)


# ---- the same views in SQL ------------------------------------------------

_SALES = "lineitem JOIN part ON l_partkey = p_partkey"

SQL = {
    "cultura": "SELECT DISTINCT lower(p_type) AS cultura FROM part",
    "municipio": """SELECT CAST(s_suppkey AS INTEGER) AS id_municipio,
        lpad(CAST(s_suppkey AS VARCHAR), 7, '0') AS codigo_ibge, s_name AS nome, n_name AS uf
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "pam": f"""SELECT lower(p_type) AS cultura, CAST(l_suppkey AS INTEGER) AS id_municipio,
        CAST(year(l_shipdate) AS INTEGER) AS ano, sum(l_quantity) AS area_plantada_ha,
        sum(l_quantity * (1 - l_discount)) AS area_colhida_ha,
        sum(l_extendedprice / {QSCALE}) AS qtde_produzida_ton,
        sum(l_extendedprice / 1000) AS valor_producao_mil_reais
        FROM {_SALES} GROUP BY 1, 2, 3""",
    "precos": f"""SELECT lower(p_type) AS cultura, CAST(l_suppkey AS INTEGER) AS id_municipio, uf,
        CAST(year(l_shipdate) AS INTEGER) AS ano, CAST(month(l_shipdate) AS INTEGER) AS mes,
        l_returnflag AS nivel_comercializacao, avg(l_extendedprice / l_quantity / 1000) AS valor_kg
        FROM {_SALES} JOIN municipio ON id_municipio = l_suppkey GROUP BY 1, 2, 3, 4, 5, 6""",
    "zarc_wide": f"""SELECT p_type, lpad(CAST(l_suppkey AS VARCHAR), 7, '0') AS cd_mun, l_linestatus,
        (10 * (1 + min(l_linenumber))) || '%' AS dec1, (10 * (1 + count(*) % 4)) || '%' AS dec2,
        CASE WHEN min(l_tax) > 0 THEN '20%' END AS dec3, (10 * (1 + max(l_linenumber) % 4)) || '%' AS dec4
        FROM {_SALES} GROUP BY 1, 2, 3""",
    "zarc": """SELECT lower(p_type) AS cultura, CAST(cd_mun AS INTEGER) AS id_municipio, l_linestatus AS tipo_solo,
        p.periodo_plantio, p.risco_climatico
        FROM zarc_wide, LATERAL (VALUES ('dec1', dec1), ('dec2', dec2), ('dec3', dec3), ('dec4', dec4))
            AS p(periodo_plantio, risco_climatico)
        WHERE p.risco_climatico IS NOT NULL""",
    "conab": f"""SELECT lower(p_type) AS cultura, uf,
        year(o_orderdate) || '/' || lpad(CAST((year(o_orderdate) + 1) % 100 AS VARCHAR), 2, '0') AS ano_agricola,
        o_orderpriority AS safra, sum(l_quantity) / 1000 AS area_plantada_mil_ha,
        sum(l_extendedprice / {QSCALE}) / 1000 AS producao_mil_t,
        sum(l_extendedprice) / {QSCALE} / sum(l_quantity) AS produtividade_t_ha
        FROM {_SALES} JOIN orders ON l_orderkey = o_orderkey JOIN municipio ON id_municipio = l_suppkey
        GROUP BY 1, 2, 3, 4""",
    "agrofit": f"""SELECT DISTINCT lower(p_type) AS cultura, CAST(l_orderkey AS VARCHAR) AS nr_registro,
        nullif(p_name, 'red plate') AS marca_comercial, p_brand AS classe,
        o_orderpriority || ' ' || l_returnflag || l_linestatus AS praga_comum
        FROM {_SALES} JOIN orders ON l_orderkey = o_orderkey""",
    "sigef": f"""SELECT lower(p_type) AS cultura, CAST(l_suppkey AS INTEGER) AS id_municipio,
        year(l_shipdate) || '/' || year(l_shipdate) AS safra, upper(p_type) AS especie, p_name AS cultivar_raw,
        l_returnflag AS categoria, sum(l_quantity) AS area_ha, sum(l_extendedprice / 1000) AS producao_bruta_t,
        sum(l_extendedprice / 2000) AS producao_est_t
        FROM {_SALES} GROUP BY 1, 2, 3, 4, 5, 6""",
    "fertilizantes": f"""SELECT n_name AS uf, c_name AS municipio, CAST(c_custkey AS VARCHAR) AS nr_registro_estabelecimento,
        {STATUS} AS status_registro, upper(c_name) AS razao_social, lower(c_mktsegment) AS area_atuacao,
        c_mktsegment AS atividade
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "meteo": """SELECT CAST(user_id AS INTEGER) AS id_municipio, CAST(ts AS DATE) AS data,
        sum(value) AS precipitacao_total_mm, max(value) AS temp_max_c, min(value) AS temp_min_c,
        sqrt(avg(value * value)) AS temp_media_c,
        sqrt(avg(pow(CAST(props ->> '$.k' AS DOUBLE), 2))) AS umidade_media
        FROM events GROUP BY 1, 2""",
    "cultivares": f"""SELECT p_partkey AS nr_registro, lower(p_type) AS cultura, {SITUACAO} AS situacao FROM part""",
}
_NEEDS = {"precos": ["municipio"], "zarc": ["zarc_wide"], "conab": ["municipio"]}


def sql(*views: str, body: str, **extra: str) -> str:
    """``body`` over the named views; ``extra`` adds further ones, in order."""
    names: list[str] = []
    for v in views:
        names += [n for n in [*_NEEDS.get(v, []), v] if n not in names]
    parts = [f"{n} AS ({SQL[n]})" for n in names] + [f"{n} AS ({s})" for n, s in extra.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body
