"""Pesticide register."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolume.functions import fold
from agrolume.operators.lookup import resolve_cultura
from agrolume.operators.quality import dq_metrics
from agrolume.sources.common import rename_existing

# Raw to stored column names.
RENAMES = {
    "NR_REGISTRO": "nr_registro",
    "MARCA_COMERCIAL": "marca_comercial",
    "INGREDIENTE_ATIVO": "ingrediente_ativo",
    "TITULAR_DE_REGISTRO": "titular_registro",
    "CLASSE": "classe",
    "SITUACAO": "situacao",
    "CULTURA": "cultura_raw",
    "PRAGA_NOME_COMUM": "praga_comum",
}


def clean(raw: DataFrame) -> DataFrame:
    df = rename_existing(raw, RENAMES, only=True)
    return df.withColumn("cultura", fold("cultura_raw")) if "cultura_raw" in df.columns else df


def fact(cleaned: DataFrame, culturas: DataFrame) -> DataFrame:
    return resolve_cultura(cleaned, "cultura", culturas, folded=True).dropna(subset=["id_cultura"])


def metrics(cleaned: DataFrame) -> DataFrame:
    return dq_metrics(
        cleaned, "agrofit", {"rows_out": F.count("*"), "distinct_crops": F.count_distinct("cultura")}
    )


def load(raw: DataFrame, tables: dict) -> dict[str, int]:
    rows = fact(clean(raw), tables["dim_cultura"].read())
    return {"agrofit": tables["fato_agrofit"].upsert(rows)}
