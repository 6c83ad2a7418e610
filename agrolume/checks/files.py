"""Readers and writers of files: the test tables written as the raw files, and read back."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolume import plans, schema
from agrolume.checks.jobs import PRODUCT
from agrolume.checks.questions import _AUDITORIA_OUT, _auditoria
from agrolume.checks.registry import Tables, query
from agrolume.checks.views import Star, sales, sql, zarc_wide
from agrolume.operators.quality import fresh_files as fresh
from agrolume.operators.table import StoredTable
from agrolume.session import scratch_dir
from agrolume.sources import agrofit, dimensions, fertilizantes, pam, readers, zarc
from agrolume.sources.common import write_bronze as bronze


def _write(lines: DataFrame, header: str, path: str, ends: str = "\n", **options) -> None:
    """Lines (one text column) as text files, each with the header; more files may be there already."""

    def headed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([header])], names=["value"])
        for batch in batches:
            yield pa.RecordBatch.from_arrays(batch.columns, names=["value"])

    lines.mapInArrow(headed, "value string").write.mode("append").option("lineSep", ends).options(**options).text(path)


@query(
    """SELECT p_type AS nome_comum, count(*) AS n, count(DISTINCT p_name) AS cultivares, CAST(sum(p_partkey) AS BIGINT) AS total
    FROM part GROUP BY 1"""
)
def read_cultivares(spark, folder):
    """Line breaks inside quotes; one half of the files ends its lines with CRLF."""
    path, part = scratch_dir(spark, "cultivares"), Tables(spark, folder).part
    for rest, ends in ((0, "\n"), (1, "\r\n")):
        rows = part.where(F.col("p_partkey") % 2 == rest)
        lines = rows.selectExpr("concat('\"', replace(p_name, ' ', '\\n'), '\",  ', p_type, ',', p_partkey) AS value")
        _write(lines, "CULTIVAR,NOME COMUM,Nº REGISTRO", path, ends)
    df = readers.read_cultivares(spark, path)
    return df.groupBy(F.col("NOME COMUM").alias("nome_comum")).agg(
        F.count("*").alias("n"),
        F.count_distinct(F.regexp_replace("CULTIVAR", "\\s+", " ")).alias("cultivares"),
        F.sum(F.col("`Nº REGISTRO`").cast("bigint")).alias("total"),
    )


@query("SELECT o_orderpriority || ' São' AS produto, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def read_conab_folder(spark, folder):
    """Latin-1; the datasets that are not there are left out."""
    root, orders = scratch_dir(spark, "conab"), Tables(spark, folder).orders
    raw = orders.selectExpr("concat('  ', o_orderpriority, ' São') AS produto", "cast(o_totalprice as string) AS valor")
    name = readers.CONAB_FILES["producao_historica"]
    raw.write.option("encoding", "ISO-8859-1").csv(f"{root}/{name}", sep=";", header=True, ignoreLeadingWhiteSpace=False)
    (df,) = readers.read_conab_folder(spark, root).values()
    return df.groupBy("produto").agg(F.count("*").alias("n"), F.round(F.sum(F.col("valor").cast("double")), 2).alias("total"))


@query(
    """SELECT c_mktsegment AS atividade, count(*) AS n, count(*) FILTER (c_custkey % 2 = 1) AS com_status,
    CAST(sum(c_custkey) AS BIGINT) AS total FROM customer GROUP BY 1"""
)
def read_fertilizantes(spark, folder):
    """Two layouts in one folder, each file by its own header."""
    path, customer = scratch_dir(spark, "fertilizantes"), Tables(spark, folder).customer
    customer.where("c_custkey % 2 = 0").selectExpr("c_custkey AS NUMERO", "c_mktsegment AS ATIVIDADE").write.csv(
        path, sep=";", header=True
    )
    other = customer.where("c_custkey % 2 = 1").selectExpr("c_mktsegment AS ATIVIDADE", "'ATIVO' AS STATUS", "c_custkey AS NUMERO")
    other.write.mode("append").csv(path, sep=";", header=True)
    return readers.read_fertilizantes(spark, path).groupBy(F.col("ATIVIDADE").alias("atividade")).agg(
        F.count("*").alias("n"), F.count("STATUS").alias("com_status"), F.sum(F.col("NUMERO").cast("bigint")).alias("total")
    )


@query(
    """SELECT CASE WHEN o_orderstatus = 'F' THEN 'campos_producao' ELSE 'reserva_semente' END AS dados, count(*) AS n,
    CAST(sum(o_custkey) AS BIGINT) AS total FROM orders WHERE o_custkey % 10 > 0 GROUP BY 1"""
)
def read_sigef_folder(spark, folder):
    """Two datasets, one under its alternate name; overlong lines (every tenth customer) are skipped."""
    root, orders = scratch_dir(spark, "sigef"), Tables(spark, folder).orders
    line = F.expr("concat_ws(';', o_orderkey, o_custkey, CASE WHEN o_custkey % 10 = 0 THEN 'demais' END)").alias("value")
    for name, own in (("campos_producao.csv", "o_orderstatus = 'F'"), ("reserva_semente.csv", "o_orderstatus <> 'F'")):
        _write(orders.where(own).select(line), "CHAVE;CLIENTE", f"{root}/{name}", "\r\n")
    frames = [df.withColumn("dados", F.lit(key)) for key, df in readers.read_sigef_folder(spark, root).items()]
    return readers.union_all(frames).groupBy("dados").agg(F.count("*").alias("n"), F.sum(F.col("CLIENTE").cast("bigint")).alias("total"))


@query(
    sql(
        "zarc_wide",
        body="SELECT p_type AS cultura_raw, count(*) AS n, count(DISTINCT cd_mun) AS locais, count(dec3) AS com_dec3 FROM zarc_wide GROUP BY 1",
    )
)
def read_zarc(spark, folder):
    """One file per crop, gzip or plain; the crop comes from the name; a crop without a file is left out."""
    root, wide = scratch_dir(spark, "zarc"), zarc_wide(Tables(spark, folder))
    crops = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
    line = F.concat_ws(";", "cd_mun", "l_linestatus", F.coalesce("dec3", F.lit("")))
    for i, crop in enumerate(crops):
        packed = {"compression": "gzip"} if i % 2 else {}
        _write(wide.where(F.col("p_type") == crop).select(line.alias("value")), "cd_mun;cod_solo;dec3", f"{root}/zarc_{crop}.csv", **packed)
    df = readers.read_zarc(spark, root, (*crops, "ABSENT"))
    return df.groupBy("cultura_raw").agg(
        F.count("*").alias("n"), F.count_distinct("cd_mun").alias("locais"), F.count("dec3").alias("com_dec3")
    )


@query(sql("municipio", body="SELECT codigo_ibge AS cod_municipio_ibge, nome AS municipio, uf FROM municipio"))
def zarc_places(spark, folder):
    """Municipalities of a wide risk file, of which three columns are parsed."""
    path, star = scratch_dir(spark, "places"), Star(spark, folder)
    rows = star.source.lineitem.select(F.col("l_suppkey").alias("id_municipio"), "l_linestatus", "l_tax")
    wide = rows.join(star["dim_municipio"], "id_municipio", "right").selectExpr(
        "codigo_ibge AS cod_municipio_ibge", "l_linestatus AS cod_solo", "nome AS municipio", "uf", "l_tax AS dec1"
    )
    wide.write.csv(path, sep=";", header=True)
    return readers.zarc_municipios(readers.read_zarc_places(spark, path))


@query(
    """SELECT CAST(s_suppkey AS VARCHAR) AS codigo_ibge, s_name AS nome, CASE WHEN s_suppkey % 3 < 2 THEN n_name ELSE 'XX' END AS uf
    FROM supplier JOIN nation ON s_nationkey = n_nationkey"""
)
def read_municipios_json(spark, folder):
    """Lists of records; the state from the first or the second region hierarchy, or XX."""
    path, t = scratch_dir(spark, "municipios"), Tables(spark, folder)
    record = F.expr(
        """named_struct('id', s_suppkey, 'nome', s_name,
        'microrregiao', CASE WHEN s_suppkey % 3 = 0 THEN named_struct('mesorregiao', named_struct('UF', named_struct('sigla', n_name))) END,
        'regiao-imediata', CASE WHEN s_suppkey % 3 = 1 THEN
            named_struct('regiao-intermediaria', named_struct('UF', named_struct('sigla', n_name))) END)"""
    )
    lists = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).groupBy(F.expr("s_suppkey div 1000 AS bloco"))
    lists.agg(F.to_json(F.collect_list(record)).alias("value")).write.partitionBy("bloco").text(path)
    return dimensions.municipio_rows_json(readers.read_municipios_json(spark, f"{path}/*"))


@query("SELECT lpad(CAST(s_suppkey AS VARCHAR), 7, '0') AS codigo_ibge, s_acctbal AS latitude, NULL::DOUBLE AS longitude FROM supplier")
def read_coords(spark, folder):
    path = scratch_dir(spark, "coords")
    raw = Tables(spark, folder).supplier.selectExpr(
        "lpad(cast(s_suppkey as string), 7, '0') AS codigo_ibge", "s_name AS nome", "s_acctbal AS latitude", "'x' AS longitude"
    )
    raw.write.csv(path, header=True)
    return readers.read_coords(spark, path)


def _renamed(spark, path: str, end: str) -> None:
    """Packed part files under a name that does not tell."""
    for file in readers.files_of(spark, path):
        fs, source = readers._fs(spark, file)
        fs.rename(source, readers._fs(spark, file.removesuffix(".txt.gz") + end)[1])


@query(
    """SELECT p_type AS nome_comum, count(*) AS n, count(DISTINCT p_name) AS cultivares, CAST(sum(p_partkey) AS BIGINT) AS total
    FROM part GROUP BY 1"""
)
def read_packed_register(spark, folder):
    """Gzip files called .csv, in folders inside folders, with line breaks inside quotes; two layouts."""
    path, part = scratch_dir(spark, "packed-register"), Tables(spark, folder).part
    named = "concat('\"', replace(p_name, ' ', '\\n'), '\"')"
    for rest, line, header in (
        (0, f"concat_ws(',', {named}, p_type, p_partkey)", "CULTIVAR,NOME COMUM,Nº REGISTRO"),
        (1, f"concat_ws(',', p_partkey, {named}, 'x', p_type)", "Nº REGISTRO,CULTIVAR,OUTRO,NOME COMUM"),
    ):
        inner = f"{path}/a/b{rest}"
        _write(part.where(F.col("p_partkey") % 2 == rest).selectExpr(f"{line} AS value"), header, inner, "\r\n", compression="gzip")
        _renamed(spark, inner, ".csv")
    df = readers.read_cultivares(spark, path)
    return df.groupBy(F.col("NOME COMUM").alias("nome_comum")).agg(
        F.count("*").alias("n"),
        F.count_distinct(F.regexp_replace("CULTIVAR", "\\s+", " ")).alias("cultivares"),
        F.sum(F.col("`Nº REGISTRO`").cast("bigint")).alias("total"),
    )


@query(sql("municipio", body="SELECT codigo_ibge AS cod_municipio_ibge, nome AS municipio, uf FROM municipio"))
def zarc_places_packed(spark, folder):
    """Municipalities of a gzip risk file of forty columns, of which three are taken out of each line."""
    path, star = scratch_dir(spark, "places-packed"), Star(spark, folder)
    rows = star.source.lineitem.select(F.col("l_suppkey").alias("id_municipio"), "l_linestatus", "l_tax")
    wide = rows.join(star["dim_municipio"], "id_municipio", "right")
    decs = [f"dec{i}" for i in range(1, 37)]
    tax, status = F.expr("coalesce(l_tax, 0)"), F.expr("coalesce(l_linestatus, '')")
    line = F.concat_ws(";", status, "codigo_ibge", F.concat(F.lit('"'), "nome", F.lit('"')), "uf", *[tax] * len(decs))
    _write(wide.select(line.alias("value")), ";".join(["cod_solo", *readers.PLACE_COLUMNS, *decs]), path, compression="gzip")
    _renamed(spark, path, ".csv")
    return readers.zarc_municipios(readers.read_zarc_places(spark, path))


@query(
    """SELECT o_orderstatus AS dados, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1
    UNION ALL SELECT 'falhou', count(DISTINCT o_orderstatus) - 2 FROM orders"""
)
def read_conab_one_bad(spark, folder):
    """A dataset without a readable file does not stop the other two."""
    root, orders, failed = scratch_dir(spark, "conab-bad"), Tables(spark, folder).orders, {}
    for key, status in (("producao_historica", "F"), ("precos_uf_mensal", "O")):
        rows = orders.where(F.col("o_orderstatus") == status).selectExpr("o_orderstatus AS dados")
        rows.write.csv(f"{root}/{readers.CONAB_FILES[key]}", header=True)
    bad = f"{root}/{readers.CONAB_FILES['producao_estimativa']}"  # a folder with a mark and no file
    orders.limit(0).selectExpr("o_orderkey", "o_orderstatus AS dados").write.partitionBy("dados").parquet(bad)
    found = readers.read_conab_folder(spark, root, failed)
    counts = [df.groupBy("dados").agg(F.count("*").alias("n")) for df in found.values()]
    return readers.union_all([*counts, spark.createDataFrame([("falhou", len(failed))], "dados string, n bigint")])


@query(
    """SELECT lpad(CAST(s_suppkey AS VARCHAR), 7, '0') AS codigo_ibge, count(*) AS n, round(sum(l_extendedprice), 2) AS chuva,
    count(*) FILTER (l_tax > 0) AS maximas, min(strftime(l_shipdate, '%Y-%m-%d')) AS primeiro
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1"""
)
def read_weather_json(spark, folder):
    """One JSON object of parallel arrays per municipality, the code in the file's name."""
    path, t = scratch_dir(spark, "weather"), Tables(spark, folder)
    day = F.expr("struct(date_format(l_shipdate, 'yyyy-MM-dd') AS time, l_extendedprice AS rain, CASE WHEN l_tax > 0 THEN l_tax END AS top)")
    days = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).groupBy(F.expr("lpad(cast(s_suppkey as string), 7, '0')").alias("code"))
    daily = days.agg(F.collect_list(day).alias("d")).selectExpr(
        "code", "to_json(named_struct('daily', named_struct('time', d.time, 'precipitation_sum', d.rain, 'temperature_2m_max', d.top))) AS value"
    )
    daily.repartition("code").write.partitionBy("code").text(path)
    got = readers.read_weather_json(spark, f"{path}/*", r"code=(\d+)/[^/]*$")
    return got.groupBy("codigo_ibge").agg(
        F.count("*").alias("n"), F.round(F.sum("precipitation_sum"), 2).alias("chuva"), F.count("temperature_2m_max").alias("maximas"), F.min("time").alias("primeiro")
    )


@query("SELECT true AS fresh, modified, count(*) AS n FROM (SELECT r_regionkey, true AS modified FROM region UNION ALL SELECT -1, false) GROUP BY 1, 2")
def fresh_files(spark, folder):
    """One file per region just written, and one that is not there."""
    path = scratch_dir(spark, "fresh")
    Tables(spark, folder).region.repartition("r_regionkey").write.partitionBy("r_regionkey").parquet(path)
    found = fresh(spark, [path, f"{path}-absent"])
    return found.groupBy("fresh", F.col("modified").isNotNull().alias("modified")).agg(F.count("*").alias("n"))


@query(
    "SELECT l_returnflag, count(*) AS n, CAST(max(l_orderkey) AS VARCHAR) AS maior FROM lineitem GROUP BY 1"
)
def write_bronze(spark, folder):
    """Raw rows keep their place in the file in the Parquet copy."""
    root = scratch_dir(spark, "bronze")
    lines = Tables(spark, folder).lineitem.select("l_returnflag", "l_orderkey")
    # A sort over ranges writes the ranges in the order of the file names.
    lines.orderBy("l_orderkey").write.csv(f"{root}/raw", header=True)
    bronze(readers.read_delimited(spark, f"{root}/raw"), f"{root}/bronze")
    copy = spark.read.parquet(f"{root}/bronze").select("l_returnflag", F.col("l_orderkey").cast("long").alias("chave"), "_seq.*")
    # First the last row of each split: long values aggregate by hash, where a struct would have all rows sorted.
    splits = copy.groupBy("l_returnflag", "file", "block").agg(F.count("*").alias("n"), F.max("row").alias("row"), F.max_by("chave", "row").alias("chave"))
    return splits.groupBy("l_returnflag").agg(
        F.sum("n").alias("n"), F.max_by("chave", F.struct("file", "block", "row")).cast("string").alias("maior")
    )


@query(
    """SELECT crop, count(*) AS n, CAST(sum(p_partkey) AS BIGINT) AS total FROM part, (VALUES ('small'), ('ring'), ('blue')) AS c(crop)
    WHERE contains(p_name, crop) GROUP BY 1"""
)
def write_by_crop(spark, folder):
    """A row goes to the folder of every target its crop name contains."""
    path, part = scratch_dir(spark, "by-crop"), Tables(spark, folder).part
    zarc.write_by_crop(part.selectExpr("upper(p_name) AS Nome_cultura", "p_partkey"), path, ("small", "ring", "blue"))
    return spark.read.parquet(path).groupBy("crop").agg(F.count("*").alias("n"), F.sum("p_partkey").alias("total"))


@query(
    """SELECT 'pam' AS source, m.metric, CAST(m.value AS BIGINT) AS value FROM (SELECT count(*) AS a, count(*) FILTER (l_tax = 0) AS b
    FROM lineitem), LATERAL (VALUES ('rows_in', a), ('values_unparsed', b)) AS m(metric, value)"""
)
def job_pam_metrics(spark, folder):
    raw = Tables(spark, folder).lineitem.selectExpr("CASE WHEN l_tax = 0 THEN 'n/d' ELSE cast(l_tax as string) END AS V")
    return pam.metrics(raw)


@query(
    """SELECT 'agrofit' AS source, m.metric, CAST(m.value AS BIGINT) AS value FROM (SELECT count(*) AS a, count(DISTINCT p_type) AS b
    FROM lineitem JOIN part ON l_partkey = p_partkey), LATERAL (VALUES ('rows_out', a), ('distinct_crops', b)) AS m(metric, value)"""
)
def job_agrofit_metrics(spark, folder):
    raw = sales(Tables(spark, folder)).selectExpr("cast(l_suppkey as string) AS NR_REGISTRO", f"{PRODUCT} AS CULTURA")
    return agrofit.metrics(agrofit.clean(raw))


@query(
    """SELECT 'fertilizantes' AS source, m.metric, CAST(m.value AS BIGINT) AS value FROM (SELECT count(*) AS a,
    count(*) FILTER (c_mktsegment = 'BUILDING') AS b FROM customer),
    LATERAL (VALUES ('rows_out', a), ('missing_nr_registro', b)) AS m(metric, value)"""
)
def job_fertilizantes_metrics(spark, folder):
    raw = Tables(spark, folder).customer.selectExpr(
        "CASE WHEN c_mktsegment <> 'BUILDING' THEN cast(c_custkey as string) END AS NUMERO_REGISTRO_ESTABELECIMENTO", "c_custkey AS _seq"
    )
    return fertilizantes.metrics(fertilizantes.clean(raw))


# ---- questions over stored tables -----------------------------------------


def _loaded(spark, folder, *names: str) -> dict[str, StoredTable]:
    """Views of the star, upserted into stored tables in two batches, the second one again."""
    root, star, tables = scratch_dir(spark, "star"), Star(spark, folder), {}
    for name in names:
        table = tables[name] = StoredTable(spark, f"{root}/{name}", schema.TABLES[name])
        if not table.table.is_fact:
            table.insert_if_absent(star[name])
            continue
        half = F.pmod(F.xxhash64(*table.table.keys), F.lit(2))
        # The view is made once, without the columns that a load adds.
        with table.staged(star[name].select(*[c for c in table.table.data_schema.names if c in star[name].columns])) as rows:
            for batch in (0, 1, 1):
                table.upsert(rows.where(half == batch))
    return tables


@query(sql("municipio", "pam", "conab", body=_AUDITORIA_OUT, **_auditoria("")))
def auditoria_stored(spark, folder):
    names = ("dim_cultura", "dim_municipio", "fato_producao_pam", "fato_producao_conab")
    return plans.auditoria_all(plans.star(_loaded(spark, folder, *names)))


@query(
    sql(
        "municipio", "pam",
        body="""SELECT cultura, uf, ano, count(*) AS n, round(sum(qtde_produzida_ton), 2) AS total FROM pam JOIN municipio USING (id_municipio)
        WHERE ano = 1998 GROUP BY 1, 2, 3""",
    )
)
def list_pam_stored(spark, folder):
    """One year of a stored table: no other year's folder is listed."""
    tables = _loaded(spark, folder, "dim_cultura", "dim_municipio", "fato_producao_pam")
    rows = plans.list_pam(plans.star(tables, {"fato_producao_pam": [1998]}), ano=1998, page=None)
    return rows.groupBy("cultura", "uf", "ano").agg(F.count("*").alias("n"), F.round(F.sum("qtde_produzida_ton"), 2).alias("total"))


@query(
    sql(
        "municipio", "zarc",
        body="""SELECT cultura, m.nome AS municipio, uf, tipo_solo, count(*) AS n FROM zarc JOIN municipio m USING (id_municipio)
        WHERE cultura = 'large' GROUP BY 1, 2, 3, 4""",
    )
)
def list_zarc_stored(spark, folder):
    """One crop of the stored risk table."""
    tables = _loaded(spark, folder, "dim_cultura", "dim_municipio", "fato_risco_zarc")
    rows = plans.list_zarc(plans.star(tables), cultura="Large", page=None)
    return rows.groupBy("cultura", "municipio", "uf", "tipo_solo").agg(F.count("*").alias("n"))


@query(
    """SELECT 'fato_producao_pam' AS tabela, CAST(0 AS BIGINT) AS repetidos FROM lineitem HAVING count(*) > 0
    UNION ALL SELECT 'fato_risco_zarc', 0 FROM lineitem HAVING count(*) > 0 UNION ALL SELECT 'fato_agrofit', 0 FROM lineitem HAVING count(*) > 0"""
)
def unique_ids_stored(spark, folder):
    """No surrogate id of a stored fact occurs twice."""
    names = ("fato_producao_pam", "fato_risco_zarc", "fato_agrofit")
    counts = [
        table.read().groupBy(table.table.pk).count().agg(F.count_if(F.col("count") > 1).alias("repetidos")).select(F.lit(name).alias("tabela"), "repetidos")
        for name, table in _loaded(spark, folder, *names).items()
    ]
    return readers.union_all(counts)
