"""Dedupe, lookups, reshaping, ranking and checks over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from agrolume.checks.registry import Tables, query
from agrolume.checks.views import Star, sales, sql
from agrolume.operators import dedupe, lookup, quality, ranking, reshape
from agrolume.schema import Table
from agrolume.sources import dimensions, zarc

_LINE = (
    "l_partkey, l_suppkey, l_shipdate, l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus"
)
_ORDER = _LINE.split(", ")[2:]


def _kept(direction: str) -> str:
    order = ", ".join(f"{c} {direction}" for c in _ORDER)
    return (
        "SELECT l_partkey, l_suppkey, l_shipdate, l_orderkey, l_extendedprice FROM lineitem QUALIFY "
        f"row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY {order}) = 1"
    )


def _pairs(spark, folder, keep):
    lines = Tables(spark, folder).lineitem
    kept = keep(lines.select(*_LINE.split(", ")), ["l_partkey", "l_suppkey"], _ORDER)
    return kept.select("l_partkey", "l_suppkey", "l_shipdate", "l_orderkey", "l_extendedprice")


@query(_kept("DESC"))
def dedupe_last(spark, folder):
    return _pairs(spark, folder, dedupe.keep_last)


@query(_kept("ASC"))
def dedupe_first(spark, folder):
    return _pairs(spark, folder, dedupe.keep_first)


@query("SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def distinct_rows(spark, folder):
    return Tables(spark, folder).lineitem.select("l_suppkey", "l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query("SELECT l_returnflag, count(DISTINCT weekofyear(l_shipdate)) AS semanas FROM lineitem GROUP BY 1")
def count_distinct(spark, folder):
    lines = Tables(spark, folder).lineitem
    return lines.groupBy("l_returnflag").agg(F.count_distinct(F.weekofyear("l_shipdate")).alias("semanas"))


# Four (variable, value) rows per line item; a zero tax or discount has no value.
_LONG = """stack(4, 'Área plantada (Hectares)', l_quantity, 'Área colhida', nullif(l_tax, 0),
    'Quantidade produzida (Toneladas)', l_extendedprice, 'Valor da produção', nullif(l_discount, 0)) AS (variavel, valor)"""


@query(
    """SELECT cod_municipio_ibge, municipio_nome, ano, cultura,
    round(avg(l_quantity), 6) AS area_plantada_ha, round(avg(nullif(l_tax, 0)), 6) AS area_colhida_ha,
    round(avg(l_extendedprice), 8) AS qtde_produzida_ton, round(avg(nullif(l_discount, 0)), 6) AS valor_producao_mil_reais
    FROM (SELECT lpad(CAST(l_suppkey AS VARCHAR), 7, '0') AS cod_municipio_ibge, nullif(l_returnflag, 'N') AS municipio_nome,
        CAST(year(l_shipdate) AS INTEGER) AS ano, l_linestatus AS cultura, * FROM lineitem)
    WHERE municipio_nome IS NOT NULL GROUP BY 1, 2, 3, 4"""
)
def pivot_variables(spark, folder):
    long = Tables(spark, folder).lineitem.selectExpr(
        "lpad(cast(l_suppkey as string), 7, '0') AS cod_municipio_ibge", "nullif(l_returnflag, 'N') AS municipio_nome",
        "year(l_shipdate) AS ano", "l_linestatus AS cultura", _LONG,
    )
    wide = reshape.pivot_variables(long)
    digits = {"area_plantada_ha": 6, "area_colhida_ha": 6, "qtde_produzida_ton": 8, "valor_producao_mil_reais": 6}
    return wide.withColumns({c: F.round(c, d) for c, d in digits.items()})


@query(
    """SELECT l_suppkey, tipo_solo, periodo_plantio, risco_climatico, count(*) AS n FROM (
    SELECT l_suppkey, l_linestatus AS tipo_solo, p.periodo_plantio, p.risco_climatico FROM lineitem,
        LATERAL (VALUES ('dec1', l_linenumber || '%'), ('dec2', CASE WHEN l_tax > 0 THEN '20%' END),
        ('dec3', CASE WHEN l_discount > 0.05 THEN '30%' END)) AS p(periodo_plantio, risco_climatico))
    WHERE risco_climatico IS NOT NULL GROUP BY 1, 2, 3, 4"""
)
def unpivot_dec(spark, folder):
    wide = Tables(spark, folder).lineitem.selectExpr(
        "l_suppkey", "l_linestatus AS cod_solo", "concat(l_linenumber, '%') AS dec1",
        "CASE WHEN l_tax > 0 THEN '20%' END AS dec2", "CASE WHEN l_discount > 0.05 THEN '30%' END AS dec3",
    )
    long = reshape.unpivot_dec(wide)
    keys = ["l_suppkey", "tipo_solo", "periodo_plantio", "risco_climatico"]
    return long.groupBy(*keys).agg(F.count("*").alias("n"))


@query(
    """SELECT user_id, CAST(ts AS DATE) AS data, round(sum(value), 2) AS precipitation_sum, max(value) AS temperature_2m_max
    FROM events GROUP BY 1, 2"""
)
def explode_daily(spark, folder):
    from agrolume.sources.readers import explode_daily as explode

    packed = Tables(spark, folder).events.selectExpr(
        "user_id",
        "named_struct('time', array(cast(cast(ts as date) as string)), 'precipitation_sum', array(value), "
        "'temperature_2m_max', array(value), 'temperature_2m_min', array(value), 'temperature_2m_mean', array(value)) AS daily",
    )
    days = explode(packed)
    return days.groupBy("user_id", F.col("time").cast("date").alias("data")).agg(
        F.round(F.sum("precipitation_sum"), 2).alias("precipitation_sum"),
        F.max("temperature_2m_max").alias("temperature_2m_max"),
    )


# Crop names as files write them, one spelling per part type.
_SPELLING = """CASE p_type WHEN 'ECONOMY' THEN concat('Glycine max ', p_name) WHEN 'SMALL' THEN upper('Cana de açúcar')
    WHEN 'LARGE' THEN concat('Milho-', p_name) WHEN 'MEDIUM' THEN 'Saccharum officinarum' WHEN 'PROMO' THEN 'de'
    ELSE concat('Trigonella ', p_name) END"""
_CROPS = [(1, "soja"), (2, "milho"), (3, "trigo"), (4, "algodão"), (5, "cana-de-açúcar"), (6, "milho"), (7, None)]
_CROP_SQL = """SELECT CAST(CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'SMALL' THEN 5 WHEN 'LARGE' THEN 2
    WHEN 'MEDIUM' THEN {} WHEN 'PROMO' THEN 5 END AS INTEGER) AS id_cultura, p_brand, count(*) AS n,
    sum(l_quantity) AS total FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2"""


def _resolved(spark, folder, resolve=lookup.resolve_cultura, **options):
    crops = spark.createDataFrame(_CROPS, "id_cultura int, nome_padronizado string")
    named = sales(Tables(spark, folder)).selectExpr("p_brand", "l_quantity", f"{_SPELLING} AS nome")
    found = resolve(named, "nome", crops, **options)
    return found.groupBy("id_cultura", "p_brand").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("total"))


@query(_CROP_SQL.format(5))
def resolve_cultura(spark, folder):
    return _resolved(spark, folder)


@query(_CROP_SQL.format("NULL"))
def resolve_cultura_strict(spark, folder):
    return _resolved(spark, folder, strict_reference=True)


@query(_CROP_SQL.format(5))
def resolve_cultura_by_words(spark, folder):
    """The way for long crop lists."""
    return _resolved(spark, folder, lookup.resolve_cultura_by_words)


@query(
    """WITH cultivar AS (SELECT o_custkey, o_orderpriority, min(o_orderkey) AS id_cultura FROM orders GROUP BY 1, 2)
    SELECT id_cultura, count(*) AS n, sum(l_quantity) AS total FROM lineitem LEFT JOIN cultivar ON o_custkey = l_partkey
    AND o_orderpriority = CASE l_linestatus WHEN 'O' THEN '5-LOW' ELSE '4-NOT SPECIFIED' END GROUP BY 1"""
)
def resolve_long_list(spark, folder):
    """A crop for every order, looked for in long names, and short names looked for in the crops."""
    t = Tables(spark, folder)
    crops = t.orders.selectExpr("o_orderkey AS id_cultura", "concat('cultivar ', o_custkey, ' ', o_orderpriority) AS nome_padronizado")
    spelled = """CASE l_linestatus WHEN 'O' THEN concat(l_returnflag, ' Cultivar ', l_partkey, ' 5-Low ', l_linenumber)
        ELSE concat(l_partkey, '_4 NOT') END AS nome"""
    found = lookup.resolve_cultura_by_words(t.lineitem.selectExpr("l_quantity", spelled), "nome", crops)
    return found.groupBy("id_cultura").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("total"))


@query(
    sql(
        "municipio",
        body="""SELECT c_custkey, m.nome AS encontrado FROM customer JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN municipio m ON m.nome = replace(c_name, 'Customer', 'Supplier') AND m.uf = n_name""",
    )
)
def resolve_municipio_name(spark, folder):
    star = Star(spark, folder)
    t = star.source
    named = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).selectExpr(
        "c_custkey", "concat('  ', upper(replace(c_name, 'Customer', 'Supplier')), ' ') AS municipio", "lower(n_name) AS uf"
    )
    found = lookup.resolve_municipio_by_name(named, star["dim_municipio"])
    names = star["dim_municipio"].selectExpr("id_municipio", "nome AS encontrado")
    return found.join(names, "id_municipio", "left").select("c_custkey", "encontrado")


@query(
    sql(
        "municipio",
        body="""SELECT id_municipio, count(*) AS n, sum(l_quantity) AS total FROM lineitem
        LEFT JOIN municipio ON id_municipio = l_suppkey AND l_linestatus = 'O' GROUP BY 1""",
    )
)
def resolve_municipio_code(spark, folder):
    star = Star(spark, folder)
    coded = star.source.lineitem.selectExpr(
        "CASE WHEN l_linestatus = 'O' THEN concat(lpad(cast(l_suppkey as string), 7, '0'), '.0') ELSE 'x' END "
        "AS cod_municipio_ibge", "l_quantity",
    )
    found = lookup.resolve_municipio_by_code(coded, star["dim_municipio"])
    return found.groupBy("id_municipio").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("total"))


@query(
    """SELECT p_brand AS encontrado, count(*) AS n FROM (SELECT CASE WHEN p_size > 10 THEN p_brand END AS p_brand FROM part)
    GROUP BY 1"""
)
def resolve_mantenedor(spark, folder):
    part = Tables(spark, folder).part
    dim = part.selectExpr("p_brand AS nome", "hash(p_brand) AS id_mantenedor").distinct()
    named = part.selectExpr("CASE WHEN p_size > 10 THEN p_brand ELSE lower(p_brand) END AS mantenedor")
    found = lookup.resolve_mantenedor(named, dim)
    return (
        found.groupBy("id_mantenedor").agg(F.count("*").alias("n")).join(dim, "id_mantenedor", "left")
        .selectExpr("nome AS encontrado", "n")
    )


@query(
    sql(
        "municipio",
        body="""SELECT id_municipio, codigo_ibge, s_acctbal / 100 AS latitude, -s_acctbal / 200 AS longitude
        FROM municipio JOIN supplier ON s_suppkey = id_municipio WHERE s_acctbal > 1000""",
    )
)
def municipios_coords(spark, folder):
    star = Star(spark, folder)
    coords = star.source.supplier.where("s_acctbal > 1000").selectExpr(
        "lpad(cast(s_suppkey as string), 7, '0') AS codigo_ibge", "s_acctbal / 100 AS latitude",
        "-s_acctbal / 200 AS longitude",
    )
    return lookup.municipios_with_coordinates(star["dim_municipio"], coords)


@query(
    sql(
        "zarc",
        body="""SELECT cultura, id_municipio, risco_climatico AS risco FROM
        (SELECT cultura, id_municipio, risco_climatico, count(*) AS n FROM zarc GROUP BY 1, 2, 3)
        QUALIFY row_number() OVER (PARTITION BY cultura, id_municipio ORDER BY n DESC, risco_climatico) = 1""",
    )
)
def risk_mode(spark, folder):
    star = Star(spark, folder)
    mode = ranking.group_mode(star["fato_risco_zarc"], ["id_cultura", "id_municipio"], "risco_climatico", "risco")
    crops = star["dim_cultura"].selectExpr("id_cultura", "nome_padronizado AS cultura")
    return mode.join(crops, "id_cultura").drop("id_cultura")


@query(
    sql(
        "agrofit",
        body="""SELECT cultura, praga_comum, n, CAST(pos AS INTEGER) AS pos FROM (SELECT *, row_number() OVER
        (PARTITION BY cultura ORDER BY n DESC, praga_comum) AS pos FROM
        (SELECT cultura, praga_comum, count(*) AS n FROM agrofit GROUP BY 1, 2)) WHERE pos <= 10""",
    )
)
def top_pests(spark, folder):
    star = Star(spark, folder)
    top = ranking.top_k_counts(star["fato_agrofit"], ["id_cultura"], "praga_comum", 10)
    crops = star["dim_cultura"].selectExpr("id_cultura", "nome_padronizado AS cultura")
    return top.join(crops, "id_cultura").selectExpr("cultura", "praga_comum", "n", "_rank AS pos")


@query(
    sql(
        "agrofit",
        body="""SELECT cultura, string_agg(marca_comercial, '|' ORDER BY marca_comercial) AS marcas FROM
        (SELECT DISTINCT cultura, marca_comercial FROM agrofit WHERE marca_comercial <> '' QUALIFY dense_rank() OVER
        (PARTITION BY cultura ORDER BY marca_comercial) <= 20) GROUP BY 1""",
    )
)
def distinct_brands(spark, folder):
    star = Star(spark, folder)
    lists = ranking.distinct_k_list(star["fato_agrofit"], ["id_cultura"], "marca_comercial", 20, "marcas")
    crops = star["dim_cultura"].selectExpr("id_cultura", "nome_padronizado AS cultura")
    return lists.join(crops, "id_cultura").select("cultura", F.array_join("marcas", "|").alias("marcas"))


@query(
    """SELECT 'lineitem' AS source, m.metric, CAST(m.value AS BIGINT) AS value FROM (SELECT count(*) AS a,
    count(*) FILTER (l_tax = 0) AS b, count(DISTINCT l_partkey) AS c FROM lineitem),
    LATERAL (VALUES ('rows_in', a), ('newly_null', b), ('distinct_parts', c)) AS m(metric, value)"""
)
def dq_metrics(spark, folder):
    lines = Tables(spark, folder).lineitem.withColumn("_tax", F.nullif("l_tax", F.lit(0.0)))
    return quality.dq_metrics(
        lines,
        "lineitem",
        {
            "rows_in": F.count("*"),
            "newly_null": quality.newly_null("l_tax", "_tax"),
            "distinct_parts": F.count_distinct("l_partkey"),
        },
    )


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def unique_check(spark, folder):
    return quality.unique_violations(Tables(spark, folder).lineitem, ["l_orderkey", "l_linenumber"])


@query(
    """SELECT user_id, count(*) AS n FROM events WHERE NOT EXISTS
    (SELECT 1 FROM supplier WHERE s_suppkey = user_id) GROUP BY 1"""
)
def fk_check(spark, folder):
    t = Tables(spark, folder)
    dim = t.supplier.selectExpr("s_suppkey AS user_id")
    return quality.missing_references(t.events, dim, "user_id").groupBy("user_id").agg(F.count("*").alias("n"))


@query(
    """SELECT * FROM (SELECT 'not_null' AS "check", 'marca' AS "column", count(*) FILTER (p_name = 'red plate') AS n FROM part
    UNION ALL SELECT 'max_length', 'p_brand', count(*) FILTER (length(p_brand) > 7) FROM part)"""
)
def column_check(spark, folder):
    parts = Tables(spark, folder).part.selectExpr("p_partkey", "p_brand", "nullif(p_name, 'red plate') AS marca")
    table = Table(
        "part", "p_partkey bigint, p_brand string, marca string", ("p_partkey",), "p_partkey",
        required=("marca",), max_length={"p_brand": 7},
    )
    return quality.column_violations(parts, table)


@query(
    """SELECT * FROM (SELECT 'orders' AS dataset, count(*) AS rows FROM orders
    UNION ALL SELECT 'lineitem', count(*) FROM lineitem
    UNION ALL SELECT 'total', (SELECT count(*) FROM orders) + (SELECT count(*) FROM lineitem))"""
)
def load_totals(spark, folder):
    t = Tables(spark, folder)
    return quality.load_totals({"orders": t.orders, "lineitem": t.lineitem})


@query(
    """SELECT crop, count(*) AS n, count(DISTINCT o_orderkey) AS pedidos FROM orders,
    LATERAL (VALUES ('high', o_orderpriority = '2-HIGH'), ('urgent', o_orderpriority = '1-URGENT'),
        ('e', o_orderpriority IN ('1-URGENT', '3-MEDIUM', '4-NOT SPECIFIED'))) AS c(crop, hit)
    WHERE hit GROUP BY 1"""
)
def split_by_crop(spark, folder):
    raw = Tables(spark, folder).orders.selectExpr("o_orderkey", "replace(o_orderpriority, 'E', 'É') AS Nome_cultura")
    rows = zarc.split_by_crop(raw, ["high", "urgent", "e"])
    return rows.groupBy("crop").agg(F.count("*").alias("n"), F.count_distinct("o_orderkey").alias("pedidos"))


@query("SELECT DISTINCT lower(p_brand) AS nome_padronizado FROM part")
def dim_cultura(spark, folder):
    names = Tables(spark, folder).part.selectExpr("concat(' ', p_brand, '  ') AS nome")
    return dimensions.cultura_rows(names, "nome")


@query(
    """SELECT DISTINCT c_mktsegment || CASE WHEN c_acctbal < 0 THEN ' Instituto' ELSE '' END AS nome,
    CASE WHEN c_acctbal < 0 THEN 'Público' ELSE 'Privado' END AS setor FROM customer"""
)
def dim_mantenedor(spark, folder):
    from agrolume.functions import classify_setor

    names = Tables(spark, folder).customer.selectExpr(
        "concat(c_mktsegment, CASE WHEN c_acctbal < 0 THEN ' Instituto' ELSE '' END) AS mantenedor"
    )
    return dimensions.mantenedor_rows(names.withColumn("SETOR", classify_setor("mantenedor")))


@query(
    """SELECT coalesce(p.c, z.c) AS codigo_ibge, coalesce(p.nome, z.nome) AS nome, CASE WHEN p.c IS NULL THEN 'AM' END AS uf FROM
    (SELECT lpad(CAST(l_suppkey AS VARCHAR), 7, '0') AS c, min(l_returnflag) AS nome FROM lineitem GROUP BY 1) p
    FULL JOIN (SELECT lpad(CAST(user_id AS VARCHAR), 7, '0') AS c, min(event_type) AS nome FROM events GROUP BY 1) z
    ON p.c = z.c"""
)
def dim_municipio(spark, folder):
    t = Tables(spark, folder)
    pam = t.lineitem.selectExpr(
        "lpad(cast(l_suppkey as string), 7, '0') AS cod_municipio_ibge", "l_returnflag AS municipio_nome"
    )
    risk = t.events.selectExpr(
        "concat(lpad(cast(user_id as string), 7, '0'), '.0') AS cod_municipio_ibge", "event_type AS municipio", "' am ' AS uf"
    )
    return dimensions.municipio_rows(pam, risk)


@query(
    """SELECT p_brand, p_partkey, p_size FROM part WHERE (p_brand, p_partkey) > (SELECT (p_brand, p_partkey) FROM part
    ORDER BY p_brand, p_partkey LIMIT 1 OFFSET 99) ORDER BY p_brand, p_partkey LIMIT 50"""
)
def page_after(spark, folder):
    """The page that follows the hundredth row, by its key."""
    part, order = Tables(spark, folder).part, ["p_brand", "p_partkey"]
    last = ranking.page_after(part, order, page_size=100).orderBy(F.desc("p_brand"), F.desc("p_partkey")).first()
    return ranking.page_after(part, order, [last[c] for c in order], 50).select("p_brand", "p_partkey", "p_size")


@query(
    """SELECT o_orderdate, o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate NULLS FIRST, o_orderkey NULLS FIRST
    LIMIT 50 OFFSET (SELECT count(*) // 100 * 50 FROM orders)"""
)
def page_deep(spark, folder):
    """The page in the middle of all orders by date, by its number."""
    orders = Tables(spark, folder).orders.select("o_orderdate", "o_orderkey", "o_totalprice")
    return ranking.paginate(orders, ["o_orderdate", "o_orderkey"], orders.count() // 100 + 1, 50, deep=1_000)
