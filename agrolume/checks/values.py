"""Column functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from agrolume import functions as A
from agrolume.checks.registry import Tables, query
from agrolume.functions.text import ACCENT_FIXES

_STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"


@query(
    """SELECT doc_id, CAST(length(f) AS INTEGER) AS n, md5(f) AS digest
    FROM (SELECT doc_id, trim(strip_accents(lower(text)), E' \\t\\n\\r') AS f FROM documents)"""
)
def fold_text(spark, folder):
    docs = Tables(spark, folder).documents.select("doc_id", A.fold("text").alias("f"))
    return docs.select("doc_id", F.length("f").alias("n"), F.md5("f").alias("digest"))


@query(
    r"""SELECT page_id, CAST(length(c) AS INTEGER) AS n, md5(c) AS digest FROM (
        SELECT page_id, nullif(trim(regexp_replace(regexp_replace(regexp_replace(
            trim(html, E' \t\n\r'), '^[''"](.*)[''"]$', '\1'),
            '<[^>]{0,30}>|</\\+>', '', 'g'), '\\+''', '''', 'g'), E' \t\n\r'), '') AS c FROM pages)"""
)
def clean_html(spark, folder):
    pages = Tables(spark, folder).pages.select("page_id", A.clean_text("html").alias("c"))
    return pages.select("page_id", F.length("c").alias("n"), F.md5("c").alias("digest"))


_NAMES = """CASE p_size % 4 WHEN 0 THEN concat('''', split_part(p_name, ' ', 1), ''' / ', split_part(p_name, ' ', 2))
    WHEN 1 THEN concat('"', p_name, '"') WHEN 2 THEN concat(p_name, '/') ELSE replace(p_name, ' ', '/') END"""


@query(
    """SELECT p_partkey, CASE p_size % 4 WHEN 1 THEN p_name WHEN 2 THEN p_name ELSE split_part(p_name, ' ', 1) END AS cultivar,
    CASE WHEN p_size % 4 IN (0, 3) THEN split_part(p_name, ' ', 2) END AS nome_secundario FROM part"""
)
def split_name(spark, folder):
    main, other = A.split_name("nome")
    parts = Tables(spark, folder).part.selectExpr("p_partkey", f"{_NAMES} AS nome")
    return parts.select("p_partkey", main.alias("cultivar"), other.alias("nome_secundario"))


# Part types stand for common names, some of them without their accent.
COMMON_NAME = (
    "CASE p_type WHEN 'ECONOMY' THEN 'Pera' WHEN 'SMALL' THEN 'Orquidea' WHEN 'LARGE' THEN 'Magnolia' "
    "WHEN 'MEDIUM' THEN 'Pera Dura' ELSE p_type END"
)


@query(
    f"""SELECT p_partkey, CASE nome WHEN 'Pera' THEN 'Pêra' WHEN 'Orquidea' THEN 'Orquídea'
    WHEN 'Magnolia' THEN 'Magnólia' ELSE nome END AS nome FROM (SELECT p_partkey, {COMMON_NAME} AS nome FROM part)"""
)
def replace_values(spark, folder):
    parts = Tables(spark, folder).part.selectExpr("p_partkey", f"{COMMON_NAME} AS nome")
    return parts.select("p_partkey", A.replace_values("nome", ACCENT_FIXES).alias("nome"))


MAINTAINER = (
    "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN concat('Embrapa ', c_name) WHEN 'FURNITURE' THEN "
    "concat('Empresa ', c_name) WHEN 'HOUSEHOLD' THEN concat('Centro da Universidade ', c_name) "
    "WHEN 'MACHINERY' THEN concat('Iapar ', c_name) END"
)


@query(
    """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Nulo' WHEN 'FURNITURE' THEN 'Privado'
    ELSE 'Público' END AS setor FROM customer"""
)
def classify_setor(spark, folder):
    names = Tables(spark, folder).customer.selectExpr("c_custkey", f"{MAINTAINER} AS nome")
    return names.select("c_custkey", A.classify_setor("nome").alias("setor"))


_NUMBERS = """CASE WHEN l_tax = 0 THEN '...' WHEN l_discount = 0 THEN '-' WHEN l_linenumber = 3 THEN '1d'
    ELSE concat(' ', replace(cast(l_extendedprice as string), '.', ',')) END"""
_NUMBERS_SQL = """CASE WHEN l_tax = 0 OR l_discount = 0 OR l_linenumber = 3 THEN NULL ELSE l_extendedprice END"""


@query(
    f"""SELECT l_returnflag, count(v) AS n_numbers, count(*) FILTER (v IS NULL) AS n_null, round(sum(v), 2) AS total,
    count(*) FILTER (coalesce(v, 0) = 0) AS n_zero, CAST(sum(CAST(trunc(coalesce(v, 0)) AS BIGINT)) AS BIGINT) AS whole,
    count(*) FILTER (v IS NOT NULL AND v = trunc(v)) AS n_plain
    FROM (SELECT l_returnflag, {_NUMBERS_SQL} AS v FROM lineitem) GROUP BY 1"""
)
def to_number(spark, folder):
    text = Tables(spark, folder).lineitem.selectExpr("l_returnflag", f"{_NUMBERS} AS v")
    number = A.to_number("v", decimal_comma=True)
    zeroed = A.to_number_or_zero("v", decimal_comma=True)
    whole = A.to_int_or_zero(F.translate("v", ",", "."))
    plain = A.to_number(F.regexp_replace("v", ",0$", ""))
    rows = text.select("l_returnflag", number.alias("v"), zeroed.alias("z"), whole.alias("w"), plain.alias("p"))
    return rows.groupBy("l_returnflag").agg(
        F.count("v").alias("n_numbers"),
        F.count_if(F.col("v").isNull()).alias("n_null"),
        F.round(F.sum("v"), 2).alias("total"),
        F.count_if(F.col("z") == 0).alias("n_zero"),
        F.sum("w").alias("whole"),
        F.count("p").alias("n_plain"),
    )


@query(
    """SELECT l_linestatus, CAST(sum(CAST(trunc(CASE WHEN l_linenumber <> 7 THEN l_extendedprice END) AS BIGINT)) AS BIGINT) AS total,
    count(*) FILTER (l_linenumber = 7) AS n_null FROM lineitem GROUP BY 1"""
)
def int_coerce(spark, folder):
    text = Tables(spark, folder).lineitem.selectExpr(
        "l_linestatus", "CASE WHEN l_linenumber = 7 THEN 'sem dado' ELSE cast(l_extendedprice as string) END AS v"
    )
    rows = text.select("l_linestatus", A.int_coerce("v").alias("i"))
    return rows.groupBy("l_linestatus").agg(
        F.sum("i").alias("total"), F.count_if(F.col("i").isNull()).alias("n_null")
    )


@query(
    """SELECT o_orderkey, CAST(CASE o_orderstatus WHEN 'P' THEN NULL ELSE o_orderdate END AS TIMESTAMP) AS data,
    CAST(CASE WHEN o_orderstatus <> 'P' THEN year(o_orderdate) END AS INTEGER) AS ano FROM orders"""
)
def parse_date(spark, folder):
    text = Tables(spark, folder).orders.selectExpr(
        "o_orderkey",
        "CASE o_orderstatus WHEN 'F' THEN date_format(o_orderdate, 'd/M/yyyy') "
        "WHEN 'O' THEN concat(date_format(o_orderdate, 'yyyy-MM-dd'), ' ') "
        "ELSE concat('31/02/', year(o_orderdate)) END AS d",
    )
    dated = text.select("o_orderkey", A.parse_date("d").alias("data"))
    return dated.withColumn("ano", A.year_of("data"))


@query(
    """SELECT ano, mes_referencia, count(*) AS n FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS ano,
    strftime(o_orderdate, '%Y-%m') AS mes_referencia FROM orders WHERE o_orderstatus <> 'P') GROUP BY 1, 2"""
)
def crop_year_start(spark, folder):
    text = Tables(spark, folder).orders.selectExpr(
        "CASE WHEN o_orderstatus = 'P' THEN 'safrinha' ELSE concat(year(o_orderdate), '/', "
        "lpad(cast((year(o_orderdate) + 1) % 100 as string), 2, '0')) END AS safra",
        "month(o_orderdate) AS mes",
    )
    years = text.withColumn("ano", A.crop_year_start("safra")).dropna(subset=["ano"])
    return years.groupBy("ano", A.month_label("ano", "mes").alias("mes_referencia")).agg(F.count("*").alias("n"))


@query(
    """SELECT event_type, count(k) AS n, CAST(sum(k) AS BIGINT) AS total FROM
    (SELECT event_type, CAST(props ->> '$.k' AS BIGINT) AS k FROM events) GROUP BY 1"""
)
def json_props(spark, folder):
    events = Tables(spark, folder).events.select("event_type", F.from_json("props", "k bigint").alias("p"))
    return events.groupBy("event_type").agg(F.count("p.k").alias("n"), F.sum("p.k").alias("total"))


@query(
    """SELECT s_suppkey, upper(CASE s_suppkey % 4 WHEN 0 THEN n_name WHEN 1 THEN n_name WHEN 2 THEN n_name ELSE 'XX' END) AS uf
    FROM supplier JOIN nation ON s_nationkey = n_nationkey"""
)
def uf_from_json(spark, folder):
    t = Tables(spark, folder)
    one = "'{\"mesorregiao\":{\"UF\":{\"sigla\":\"', lower(n_name), '\"}}}'"
    two = "'{\"regiao-intermediaria\":{\"UF\":{\"sigla\":\"', lower(n_name), '\"}}}'"
    text = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).selectExpr(
        "s_suppkey",
        f"""CASE s_suppkey % 4 WHEN 0 THEN concat('{{"microrregiao":', {one}, '}}')
            WHEN 1 THEN concat('{{"regiao-imediata":', {two}, '}}')
            WHEN 2 THEN concat('{{"microrregiao":null,"regiao-imediata":', {two}, '}}') ELSE '{{}}' END AS j""",
    )
    schema = (
        "microrregiao struct<mesorregiao: struct<UF: struct<sigla: string>>>, "
        "`regiao-imediata` struct<`regiao-intermediaria`: struct<UF: struct<sigla: string>>>"
    )
    return text.select("s_suppkey", F.from_json("j", schema).alias("r")).select("s_suppkey", "r.*").select(
        "s_suppkey", A.uf_from_json().alias("uf")
    )


@query(
    "SELECT lpad(CAST(l_suppkey AS VARCHAR), 7, '0') AS codigo, count(*) AS n, "
    "count(DISTINCT l_partkey) AS partes FROM lineitem GROUP BY 1"
)
def code7(spark, folder):
    text = Tables(spark, folder).lineitem.selectExpr(
        "concat(lpad(cast(l_suppkey as string), 7, '0'), '.', l_linenumber) AS c", "l_partkey"
    )
    return text.groupBy(A.code7("c").alias("codigo")).agg(
        F.count("*").alias("n"), F.count_distinct("l_partkey").alias("partes")
    )


@query(
    """SELECT n_name AS uf, c_mktsegment AS segmento, CASE WHEN n >= 100 THEN 'Alto' WHEN n >= 30 THEN 'Médio' ELSE 'Baixo' END AS tecnologia,
    CASE WHEN n >= 50 THEN 'Alta' WHEN n >= 15 THEN 'Média' WHEN n >= 1 THEN 'Baixa' ELSE 'Sem cobertura' END AS capacidade,
    CASE WHEN abs(v) <= 5 THEN 'Excelente (≤5%)' WHEN abs(v) <= 15 THEN 'Boa (5–15%)'
        WHEN abs(v) <= 30 THEN 'Regular (15–30%)' WHEN v IS NOT NULL THEN 'Fraca (>30%)' END AS acuracia
    FROM (SELECT n_name, c_mktsegment, count(c_custkey) AS n, nullif(n_nationkey, 3) * 3 - 40 AS v FROM nation
        LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_name, c_mktsegment, n_nationkey)"""
)
def grades(spark, folder):
    t = Tables(spark, folder)
    counts = (
        t.nation.join(t.customer, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .groupBy("n_name", "c_mktsegment", "n_nationkey")
        .agg(F.count("c_custkey").alias("n"))
        .withColumn("v", F.nullif("n_nationkey", F.lit(3)) * 3 - 40)
    )
    return counts.select(
        F.col("n_name").alias("uf"),
        F.col("c_mktsegment").alias("segmento"),
        A.technology_grade("n").alias("tecnologia"),
        A.capacity_grade("n").alias("capacidade"),
        A.estimate_accuracy("v").alias("acuracia"),
    )


@query(
    """SELECT lpad(CAST(s_suppkey AS VARCHAR), 7, '0') AS cod_municipio_ibge, s_name AS nome_municipio,
    CASE WHEN s_acctbal > 5000 THEN s_acctbal END AS area_ha FROM supplier"""
)
def snake_columns(spark, folder):
    raw = Tables(spark, folder).supplier.selectExpr(
        "concat(' ', lpad(cast(s_suppkey as string), 7, '0')) AS `CD_MUN-Código`",
        "concat('\\t', s_name, '  ') AS `Nome Município`",
        "CASE WHEN s_acctbal > 5000 THEN cast(s_acctbal as string) WHEN s_acctbal > 2000 THEN 'N/A' ELSE '' END AS `Área-ha`",
    )
    tidy = A.null_tokens(A.trim_all(A.snake_columns(raw)))
    return tidy.withColumn("area_ha", A.to_number("area_ha"))
