"""Stored tables, files and streams.

These write below ``spark.checkpoint.dir`` (a temporary folder where it is unset)
and read back what was written.
"""

from __future__ import annotations

import contextlib

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolume import schema
from agrolume.checks import files
from agrolume.checks.registry import Tables, query
from agrolume.checks.views import Star, sales, sql, zarc_wide
from agrolume.operators.table import StoredTable, weekly_reset_due
from agrolume.session import scratch_dir
from agrolume.sources import readers
from agrolume.sources.common import open_tables
from agrolume.streaming import stream_prices, stream_zarc, stream_zarc_files
from agrolume.streaming.loads import file_stream


def _files(spark) -> int:
    """Several files also on one machine, and more on a larger cluster."""
    return max(4, spark.sparkContext.defaultParallelism)


def _table(spark, table: schema.Table) -> StoredTable:
    return StoredTable(spark, scratch_dir(spark, table.name), table)


# ---- upsert ---------------------------------------------------------------
# Orders by customer, level and month; the last order counts, and a second batch
# overwrites part of the first.  Every sixth customer has no municipality.

_ORDERS = """SELECT CAST(length(o_orderstatus) AS INTEGER) AS id_cultura, CASE WHEN o_custkey % 6 > 0 THEN
    CAST(o_custkey AS INTEGER) END AS id_municipio, 'XX' AS uf, CAST(year(o_orderdate) AS INTEGER) AS ano,
    CAST(month(o_orderdate) AS INTEGER) AS mes, o_orderstatus AS nivel_comercializacao, o_totalprice AS valor_kg,
    o_orderkey FROM orders"""
_PRICE_KEYS = "id_cultura, id_municipio, uf, ano, mes, nivel_comercializacao"


def _prices(t: Tables) -> DataFrame:
    return t.orders.selectExpr(
        "length(o_orderstatus) AS id_cultura", "CASE WHEN o_custkey % 6 > 0 THEN int(o_custkey) END AS id_municipio",
        "'XX' AS uf", "year(o_orderdate) AS ano", "month(o_orderdate) AS mes", "o_orderstatus AS nivel_comercializacao",
        "o_totalprice AS valor_kg", "o_orderkey",
    )


@query(
    f"""SELECT {_PRICE_KEYS}, valor_kg FROM (SELECT *, 1 AS lote FROM ({_ORDERS})
    UNION ALL SELECT * REPLACE (valor_kg + 1 AS valor_kg), 2 FROM ({_ORDERS}) WHERE ano >= 1999 AND nivel_comercializacao <> 'P')
    QUALIFY row_number() OVER (PARTITION BY {_PRICE_KEYS} ORDER BY lote DESC, o_orderkey DESC) = 1"""
)
def upsert_merge(spark, folder):
    table, rows = _table(spark, schema.PRECOS_MENSAL), _prices(Tables(spark, folder))
    table.upsert(rows, order=["o_orderkey"])
    newer = rows.where("ano >= 1999 AND nivel_comercializacao <> 'P'").withColumn("valor_kg", F.col("valor_kg") + 1)
    table.upsert(newer, order=["o_orderkey"])
    table.upsert(newer, order=["o_orderkey"])  # a rerun changes nothing
    return table.read().selectExpr(*_PRICE_KEYS.split(", "), "valor_kg")


@query(
    f"""WITH f AS (SELECT id_cultura, id_municipio, nivel_comercializacao, ano, mes, o_orderkey % 11 = 0 AS a, o_orderkey % 7 = 0 AS b,
    coalesce(id_municipio % 5 = 0, false) AS c FROM ({_ORDERS}))
    SELECT 'not_null:mes' AS reason, count(*) AS n FROM f WHERE a UNION ALL SELECT 'max_length:uf', count(*) FROM f WHERE b
    UNION ALL SELECT 'reference:id_municipio', count(*) FROM f WHERE c UNION ALL SELECT 'stored', count(*) FROM (
    SELECT DISTINCT id_cultura, id_municipio, nivel_comercializacao, ano, mes FROM f WHERE NOT (a OR b OR c))"""
)
def upsert_checked(spark, folder):
    """Nulls, long texts and orphans land among the rejects with their reasons; the rest is stored."""
    table, rows = _table(spark, schema.PRECOS_MENSAL), _prices(Tables(spark, folder))
    rows = rows.withColumn("uf", F.expr("CASE WHEN o_orderkey % 7 = 0 THEN 'XYZ' ELSE uf END"))
    rows = rows.withColumn("mes", F.expr("CASE WHEN o_orderkey % 11 > 0 THEN mes END"))
    places = rows.select("id_municipio").distinct().where("id_municipio % 5 <> 0")
    table.upsert(rows, order=["o_orderkey"], references={"dim_municipio": places})
    stored = table.read().agg(F.count("*").alias("n")).select(F.lit("stored").alias("reason"), "n")
    return table.rejects().select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n")).union(stored)


@query(
    f"""SELECT CAST(1 AS INTEGER) AS version, count(*) AS n, round(sum(valor_kg), 2) AS total FROM (SELECT * FROM ({_ORDERS})
    WHERE ano < 1998 QUALIFY row_number() OVER (PARTITION BY {_PRICE_KEYS} ORDER BY o_orderkey DESC) = 1)
    UNION ALL SELECT 2, count(*), round(sum(valor_kg), 2) FROM (SELECT * FROM ({_ORDERS})
    QUALIFY row_number() OVER (PARTITION BY {_PRICE_KEYS} ORDER BY o_orderkey DESC) = 1)"""
)
def snapshot_history(spark, folder):
    """Earlier states stay readable."""
    table, rows = _table(spark, schema.PRECOS_MENSAL), _prices(Tables(spark, folder))
    table.upsert(rows.where("ano < 1998"), order=["o_orderkey"])
    table.upsert(rows, order=["o_orderkey"])
    states = [table.read(v).withColumn("version", F.lit(v)) for v in table.versions()]
    both = readers.union_all(states)
    return both.groupBy("version").agg(F.count("*").alias("n"), F.round(F.sum("valor_kg"), 2).alias("total"))


@query(
    """SELECT coalesce(a.nome, b.nome) AS nome, coalesce(a.setor, b.setor) AS setor FROM
    (SELECT p_brand AS nome, min(p_type) AS setor FROM part WHERE p_size < 10 AND p_name LIKE 's%' GROUP BY 1) a
    FULL JOIN (SELECT p_brand AS nome, max(p_type) AS setor FROM part GROUP BY 1) b ON a.nome = b.nome"""
)
def insert_if_absent(spark, folder):
    table, part = _table(spark, schema.DIM_MANTENEDOR), Tables(spark, folder).part
    first = part.where("p_size < 10 AND p_name LIKE 's%'").groupBy(F.col("p_brand").alias("nome"))
    table.insert_if_absent(first.agg(F.min("p_type").alias("setor")))
    table.insert_if_absent(part.groupBy(F.col("p_brand").alias("nome")).agg(F.max("p_type").alias("setor")))
    return table.read().select("nome", "setor")


_WEEKS = """SELECT CAST(1 AS INTEGER) AS id_cultura, CAST(l_suppkey AS INTEGER) AS id_municipio, 'XX' AS uf,
    CAST(year(l_shipdate) AS INTEGER) AS ano, CAST(month(l_shipdate) AS INTEGER) AS mes,
    CAST(l_linenumber AS INTEGER) AS semana, l_returnflag AS nivel_comercializacao, max(l_extendedprice) AS valor_kg
    FROM lineitem WHERE {} GROUP BY 1, 2, 3, 4, 5, 6, 7"""


def _weeks(t: Tables, where: str) -> DataFrame:
    return (
        t.lineitem.where(where)
        .groupBy(
            F.expr("1 AS id_cultura"), F.expr("int(l_suppkey) AS id_municipio"), F.expr("'XX' AS uf"),
            F.expr("year(l_shipdate) AS ano"), F.expr("month(l_shipdate) AS mes"), F.col("l_linenumber").alias("semana"),
            F.col("l_returnflag").alias("nivel_comercializacao"),
        )
        .agg(F.max("l_extendedprice").alias("valor_kg"))
    )


@query(_WEEKS.format("l_linenumber >= 5"))
def weekly_reset(spark, folder):
    """Weeks 1 to 3 and then 4 are stored; the run with week 5 starts afresh, and
    its second file (weeks 6 and 7) joins the first."""
    t, table = Tables(spark, folder), _table(spark, schema.PRECOS_SEMANAL)
    for weeks in ("l_linenumber <= 3", "l_linenumber = 4", "l_linenumber = 5"):
        table.upsert(_weeks(t, weeks), replace=weekly_reset_due(table))
    table.upsert(_weeks(t, "l_linenumber >= 6"))
    columns = [c for c in schema.PRECOS_SEMANAL.data_schema.names if c != "data_referencia"]
    return table.read().select(*columns)


# ---- files ----------------------------------------------------------------


@query(
    """SELECT c_mktsegment, count(*) AS n, count(nome) AS com_nome, round(sum(saldo), 2) AS total FROM (
    SELECT c_mktsegment, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name END AS nome,
    CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_acctbal END AS saldo FROM customer WHERE c_mktsegment <> 'MACHINERY')
    GROUP BY 1"""
)
def read_delimited(spark, folder):
    """Null spellings, short lines kept, overlong lines dropped, quoted separators."""
    path = scratch_dir(spark, "delimited")
    lines = Tables(spark, folder).customer.selectExpr(
        """concat_ws(';', c_custkey, c_mktsegment, CASE c_mktsegment WHEN 'BUILDING' THEN 'N/A'
        ELSE concat('"', c_name, ';"') END, CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE cast(c_acctbal as string) END,
        CASE WHEN c_mktsegment = 'MACHINERY' THEN 'demais' END) AS value"""
    )
    # As one unquoted column whose name is the header line, so every file starts with it.
    raw = lines.withColumnRenamed("value", "chave;segmento;nome;saldo").repartition(_files(spark))
    raw.write.csv(path, header=True, sep="\u0001", quote="", ignoreLeadingWhiteSpace=False)
    df = readers.read_delimited(spark, path, ";", bad_lines="skip")
    return df.groupBy(F.col("segmento").alias("c_mktsegment")).agg(
        F.count("*").alias("n"),
        F.count("nome").alias("com_nome"),
        F.round(F.sum(F.col("saldo").try_cast("double")), 2).alias("total"),
    )


@query(
    "SELECT l_returnflag, count(*) AS n, count(DISTINCT l_suppkey) AS locais, sum(l_quantity) AS total "
    "FROM lineitem GROUP BY 1"
)
def read_any_gzip(spark, folder):
    """Compressed files are known by their first bytes."""
    path = scratch_dir(spark, "gzip")
    lines = Tables(spark, folder).lineitem.select("l_returnflag", "l_suppkey", "l_quantity")
    lines.repartition(_files(spark)).write.csv(path, sep=";", header=True, compression="gzip")
    df = readers.read_any_gzip(spark, path)
    return df.groupBy("l_returnflag").agg(
        F.count("*").alias("n"),
        F.count_distinct("l_suppkey").alias("locais"),
        F.sum(F.col("l_quantity").try_cast("double")).alias("total"),
    )


@query(
    """SELECT o_orderpriority AS cultura_raw, count(*) AS n, round(sum(o_totalprice), 2) AS total, count(DISTINCT o_custkey) AS locais
    FROM orders GROUP BY 1"""
)
def read_pam_long(spark, folder):
    """One list per crop and file, the first record being the header."""
    path = scratch_dir(spark, "pam")
    records = Tables(spark, folder).orders.selectExpr(
        "o_orderpriority", "o_orderkey div 5000 AS bloco",
        "named_struct('D1C', cast(o_custkey as string), 'V', cast(o_totalprice as string)) AS r",
    )
    blocks = records.groupBy("o_orderpriority", "bloco").agg(F.collect_list("r").alias("rs"))
    header = F.expr("array(named_struct('D1C', 'Município (Código)', 'V', 'Valor'))")
    files = blocks.select("o_orderpriority", F.to_json(F.concat(header, "rs")).alias("value"))
    files.write.partitionBy("o_orderpriority").option("maxRecordsPerFile", 1).text(path)
    df = readers.read_pam_long(spark, f"{path}/*/*.txt", crop_in_path=r"o_orderpriority=([^/]+)/")
    return df.groupBy("cultura_raw").agg(
        F.count("*").alias("n"),
        F.round(F.sum(F.col("V").try_cast("double")), 2).alias("total"),
        F.count_distinct("D1C").alias("locais"),
    )


# ---- streams --------------------------------------------------------------


@query(
    sql(
        "municipio", "zarc",
        body="""SELECT cultura, codigo_ibge, tipo_solo, periodo_plantio, risco_climatico
        FROM zarc JOIN municipio USING (id_municipio)""",
    )
)
def zarc_stream(spark, folder):
    """Wide files in micro-batches give the table one batch would."""
    root, star = scratch_dir(spark, "zarc-stream"), Star(spark, folder)
    wide = zarc_wide(star.source).selectExpr(
        "p_type AS cultura_raw", "cd_mun", "l_linestatus AS cod_solo", "dec1", "dec2", "dec3", "dec4"
    )
    wide.repartition(_files(spark)).write.parquet(f"{root}/in")
    tables = open_tables(spark, f"{root}/tables")
    tables["dim_cultura"].insert_if_absent(star["dim_cultura"])
    tables["dim_municipio"].insert_if_absent(star["dim_municipio"])
    schema_ = spark.read.parquet(f"{root}/in").schema
    source = file_stream(spark, f"{root}/in", schema_, "parquet", maxFilesPerTrigger=_files(spark) // 2)
    stream_zarc(source, tables, f"{root}/checkpoint").awaitTermination()
    crops = star["dim_cultura"].selectExpr("id_cultura", "nome_padronizado AS cultura")
    places = star["dim_municipio"].select("id_municipio", "codigo_ibge")
    rows = tables["fato_risco_zarc"].read().join(crops, "id_cultura").join(places, "id_municipio")
    return rows.select("cultura", "codigo_ibge", "tipo_solo", "periodo_plantio", "risco_climatico")


class _Lost(Exception):
    """A run that stops between two chunks."""


@query(
    sql(
        "municipio", "zarc",
        body="""SELECT cultura, codigo_ibge, tipo_solo, periodo_plantio, risco_climatico
        FROM zarc JOIN municipio USING (id_municipio)""",
    )
)
def zarc_stream_packed(spark, folder):
    """Risk files, packed and plain, of two layouts, in chunks of rows; the first run stops inside a file."""
    root, star = scratch_dir(spark, "zarc-packed"), Star(spark, folder)
    wide = zarc_wide(star.source).selectExpr("p_type", "cd_mun", "l_linestatus", "dec1", "dec2", "dec3", "dec4")
    half = F.pmod(F.xxhash64("cd_mun"), F.lit(2))
    text = lambda *names: F.concat_ws(";", *[F.coalesce(F.col(n).cast("string"), F.lit("")) for n in names]).alias("value")
    decs = ("dec1", "dec2", "dec3", "dec4")
    files._write(wide.where(half == 0).select(text("p_type", "cd_mun", "l_linestatus", *decs)), "cultura_raw;cd_mun;cod_solo;" + ";".join(decs), f"{root}/in/plain")
    files._write(wide.where(half == 1).select(text("cd_mun", *decs, "l_linestatus", "p_type")), "cd_mun;" + ";".join(decs) + ";cod_solo;Nome_cultura", f"{root}/in/packed", compression="gzip")
    files._renamed(spark, f"{root}/in/packed", ".csv")
    tables = open_tables(spark, f"{root}/tables")
    tables["dim_cultura"].insert_if_absent(star["dim_cultura"])
    tables["dim_municipio"].insert_if_absent(star["dim_municipio"])
    # Chunks so that each half takes several of them.
    size = {"rows": max(1, wide.count() // 5), "files": 64}
    table, stored = tables["fato_risco_zarc"], []
    upsert = table.upsert

    def until_lost(*args, **kwargs):
        if len(stored) == 2:
            raise _Lost
        stored.append(upsert(*args, **kwargs))

    table.upsert = until_lost
    with contextlib.suppress(StreamingQueryException):
        stream_zarc_files(spark, f"{root}/in", tables, f"{root}/checkpoint", **size).awaitTermination()
    table.upsert = upsert
    stream_zarc_files(spark, f"{root}/in", tables, f"{root}/checkpoint", **size).awaitTermination()
    crops = star["dim_cultura"].selectExpr("id_cultura", "nome_padronizado AS cultura")
    places = star["dim_municipio"].select("id_municipio", "codigo_ibge")
    rows = table.read().join(crops, "id_cultura").join(places, "id_municipio")
    return rows.select("cultura", "codigo_ibge", "tipo_solo", "periodo_plantio", "risco_climatico")


@query(
    sql(
        "municipio",
        body="""SELECT lower(p_type) AS cultura, uf, CAST(year(l_shipdate) AS INTEGER) AS ano,
        CAST(ceil(month(l_shipdate) / 2) AS INTEGER) AS semana, max(l_extendedprice) AS valor_kg
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN municipio ON id_municipio = l_suppkey GROUP BY 1, 2, 3, 4""",
    )
)
def precos_stream(spark, folder):
    """Six weeks arrive over several micro-batches of one run and all stay."""
    root, star = scratch_dir(spark, "precos-stream"), Star(spark, folder)
    places = star["dim_municipio"].selectExpr("id_municipio AS l_suppkey", "uf")
    weeks = (
        sales(star.source)
        .join(places, "l_suppkey")
        .groupBy("p_type", "uf", F.expr("year(l_shipdate) AS ano"), F.expr("ceil(month(l_shipdate) / 2) AS semana"))
        .agg(F.max("l_extendedprice").alias("v"))
        .selectExpr(
            "p_type AS produto", "uf", "cast(ano as string) AS ano", "'1' AS mes", "cast(semana as string) AS semana",
            "replace(cast(v as string), '.', ',') AS valor_produto_kg", "'Produtor' AS dsc_nivel_comercializacao",
        )
    )
    weeks.repartition(_files(spark)).write.parquet(f"{root}/in")
    tables = open_tables(spark, f"{root}/tables")
    tables["dim_cultura"].insert_if_absent(star["dim_cultura"])
    schema_ = spark.read.parquet(f"{root}/in").schema
    source = file_stream(spark, f"{root}/in", schema_, "parquet", maxFilesPerTrigger=_files(spark) // 2)
    stream_prices(source, tables, f"{root}/checkpoint").awaitTermination()
    crops = star["dim_cultura"].selectExpr("id_cultura", "nome_padronizado AS cultura")
    rows = tables["fato_precos_conab_semanal"].read().join(crops, "id_cultura")
    return rows.select("cultura", "uf", "ano", "semana", "valor_kg")

