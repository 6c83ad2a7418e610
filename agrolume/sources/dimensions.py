"""The three dimensions.  Rows are only ever added, by natural key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrolume.functions import code7, strip, uf_from_json
from agrolume.operators.dedupe import keep_first
from agrolume.operators.lookup import TARGET_CROPS
from agrolume.operators.table import StoredTable


def cultura_rows(names: DataFrame, column: str) -> DataFrame:
    """Crop names, stripped and lower case; accents are kept."""
    return names.select(F.lower(strip(column)).alias("nome_padronizado")).dropna().distinct()


def load_culturas(spark: SparkSession, table: StoredTable, crops: Sequence[str] = TARGET_CROPS) -> int:
    """Insert the target crops; ids follow their order in the list."""
    have = table.read()
    start = have.agg(F.max("id_cultura")).first()[0] or 0
    listed = spark.createDataFrame([(i, c) for i, c in enumerate(crops, 1)], "pos int, crop string")
    rows = keep_first(
        listed.select("pos", F.lower(strip("crop")).alias("nome_padronizado")), ["nome_padronizado"], ["pos"]
    )
    return table.insert_if_absent(rows.select((F.lit(start) + F.col("pos")).alias("id_cultura"), "nome_padronizado"))


def mantenedor_rows(cleaned: DataFrame) -> DataFrame:
    """Distinct maintainers with their sector."""
    setor = next((F.col(c) for c in ("SETOR", "setor") if c in cleaned.columns), F.lit(None).cast("string"))
    rows = cleaned.select(F.col("mantenedor").alias("nome"), setor.alias("setor")).dropna(subset=["nome"])
    return rows.groupBy("nome").agg(F.min("setor").alias("setor"))


def load_mantenedores(cleaned: DataFrame, table: StoredTable) -> int:
    return table.insert_if_absent(mantenedor_rows(cleaned)) if "mantenedor" in cleaned.columns else 0


def municipio_rows_json(raw: DataFrame) -> DataFrame:
    """Municipalities of the official list."""
    rows = raw.select(F.col("id").cast("string").alias("codigo_ibge"), "nome", uf_from_json().alias("uf"))
    return keep_first(rows, ["codigo_ibge"], ["nome", "uf"])


def municipio_rows(pam: DataFrame | None = None, zarc: DataFrame | None = None) -> DataFrame:
    """Municipalities named in statistics and risk files; statistics take
    precedence, and one code gives one row."""
    parts = []
    for rank, (df, name) in enumerate(((pam, "municipio_nome"), (zarc, "municipio"))):
        if df is not None and "cod_municipio_ibge" in df.columns:
            uf = F.col("uf") if "uf" in df.columns else F.lit(None).cast("string")
            parts.append(
                df.dropna(subset=["cod_municipio_ibge"]).select(
                    F.lit(rank).alias("rank"),
                    code7("cod_municipio_ibge").alias("codigo_ibge"),
                    F.col(name).alias("nome"),
                    F.upper(strip(uf)).alias("uf"),
                )
            )
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return keep_first(both, ["codigo_ibge"], ["rank", "nome", "uf"]).drop("rank")


def load_municipios(rows: DataFrame, table: StoredTable) -> int:
    return table.insert_if_absent(rows)
