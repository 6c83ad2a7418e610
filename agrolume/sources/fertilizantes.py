"""Fertilizer establishments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolume.functions import trim_all
from agrolume.operators.dedupe import keep_first
from agrolume.operators.lookup import resolve_municipio_by_name
from agrolume.operators.quality import dq_metrics, null_count
from agrolume.sources.common import rename_existing

# Raw to stored column names.
RENAMES = {
    "UNIDADE_DA_FEDERACAO": "uf",
    "MUNICIPIO": "municipio",
    "NUMERO_REGISTRO_ESTABELECIMENTO": "nr_registro_estabelecimento",
    "STATUS_DO_REGISTRO": "status_registro",
    "CNPJ": "cnpj",
    "RAZAO_SOCIAL": "razao_social",
    "NOME_FANTASIA": "nome_fantasia",
    "AREA_ATUACAO": "area_atuacao",
    "ATIVIDADE": "atividade",
    "CLASSIFICACAO": "classificacao",
}


def clean(raw: DataFrame) -> DataFrame:
    return trim_all(rename_existing(raw, RENAMES))


def fact(cleaned: DataFrame, municipios: DataFrame) -> DataFrame:
    """First row per registry number; an unknown municipality stays null."""
    firsts = keep_first(cleaned, ["nr_registro_estabelecimento"])
    firsts = firsts.dropna(subset=["nr_registro_estabelecimento"])
    return resolve_municipio_by_name(firsts, municipios)


def metrics(cleaned: DataFrame) -> DataFrame:
    return dq_metrics(
        cleaned,
        "fertilizantes",
        {"rows_out": F.count("*"), "missing_nr_registro": null_count("nr_registro_estabelecimento")},
    )


def load(raw: DataFrame, tables: dict) -> dict[str, int]:
    rows = fact(clean(raw), tables["dim_municipio"].read())
    return {"fertilizantes": tables["fato_fertilizantes_estabelecimentos"].upsert(rows)}
