"""Municipal crop production statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolume.functions import fold, to_number
from agrolume.operators.lookup import resolve_cultura, resolve_municipio_by_code
from agrolume.operators.quality import dq_metrics, newly_null
from agrolume.operators.reshape import pivot_variables
from agrolume.sources.common import rename_existing

# Raw to stored column names.
RENAMES = {
    "D2N": "variavel",
    "V": "valor",
    "D1C": "cod_municipio_ibge",
    "D1N": "municipio_nome",
    "D3N": "ano",
    "cultura_raw": "cultura",
}


def clean(raw: DataFrame) -> DataFrame:
    """One row per municipality, year and crop, with the four measures."""
    df = rename_existing(raw, RENAMES, only=True).withColumn("valor", to_number("valor"))
    return pivot_variables(df).withColumn("cultura", fold("cultura"))


def fact(cleaned: DataFrame, culturas: DataFrame, municipios: DataFrame) -> DataFrame:
    out = resolve_municipio_by_code(resolve_cultura(cleaned, "cultura", culturas, folded=True), municipios)
    return out.dropna(subset=["id_cultura", "id_municipio"])


def metrics(raw: DataFrame) -> DataFrame:
    df = raw.withColumn("_valor", to_number("V"))
    return dq_metrics(df, "pam", {"rows_in": F.count("*"), "values_unparsed": newly_null("V", "_valor")})


def load(raw: DataFrame, tables: dict) -> dict[str, int]:
    rows = fact(clean(raw), tables["dim_cultura"].read(), tables["dim_municipio"].read())
    return {"pam": tables["fato_producao_pam"].upsert(rows)}
