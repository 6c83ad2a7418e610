"""Seed production fields and seed reserve for own use."""

from __future__ import annotations

from pyspark.sql import DataFrame

from agrolume.functions import fold, parse_date, to_number_or_zero, trim_all
from agrolume.operators.lookup import resolve_cultura, resolve_municipio_by_name
from agrolume.sources.common import rename_existing, replace_columns

# Raw to stored column names, both vintages of the file.
PRODUCTION_RENAMES = {
    "Safra": "safra",
    "Especie": "especie",
    "Categoria": "categoria",
    "Cultivar": "cultivar_raw",
    "Municipio": "municipio",
    "UF": "uf",
    "Status": "status",
    "Data do Plantio": "data_plantio",
    "Data de Colheita": "data_colheita",
    "Area": "area_ha",
    "Producao bruta": "producao_bruta_t",
    "Producao estimada": "producao_est_t",
    "DS_SAFRA": "safra",
    "DS_ESPECIE": "especie",
    "DS_CATEGORIA": "categoria",
    "DS_CULTIVAR": "cultivar_raw",
    "DS_MUNICIPIO": "municipio",
    "DS_UF": "uf",
    "DS_STATUS": "status",
    "DT_PLANTIO": "data_plantio",
    "DT_COLHEITA": "data_colheita",
    "NR_AREA": "area_ha",
    "NR_PRODUCAO_BRUTA": "producao_bruta_t",
    "NR_PRODUCAO_EST": "producao_est_t",
}
RESERVE_RENAMES = {
    "TIPOPERIODO": "tipo_periodo",
    "PERIODO": "periodo",
    "AREATOTAL": "area_total_ha",
    "MUNICIPIO": "municipio",
    "UF": "uf",
    "ESPECIE": "especie",
    "CULTIVAR": "cultivar_raw",
    "AREAPLANTADA": "area_plantada_ha",
    "AREAESTIMADA": "area_estimada_ha",
    "QUANTRESERVADA": "quantidade_reservada_t",
    "DATAPLANTIA": "data_plantio",
    "DATAPLANTIO": "data_plantio",
}


def _clean(raw: DataFrame, renames: dict[str, str], numbers, dates) -> DataFrame:
    df = rename_existing(trim_all(raw), renames)
    df = replace_columns(
        df,
        **{c: to_number_or_zero(c, decimal_comma=True) for c in numbers},
        **{c: parse_date(c) for c in dates},
    )
    return df.withColumn("cultura", fold("especie")) if "especie" in df.columns else df


def clean_production(raw: DataFrame) -> DataFrame:
    return _clean(
        raw, PRODUCTION_RENAMES, ("area_ha", "producao_bruta_t", "producao_est_t"), ("data_plantio", "data_colheita")
    )


def clean_reserve(raw: DataFrame) -> DataFrame:
    numbers = ("area_total_ha", "area_plantada_ha", "area_estimada_ha", "quantidade_reservada_t")
    return _clean(raw, RESERVE_RENAMES, numbers, ())


def fact(cleaned: DataFrame, culturas: DataFrame, municipios: DataFrame) -> DataFrame:
    """Crop and municipality must both resolve."""
    out = resolve_cultura(cleaned, "cultura", culturas, folded=True).dropna(subset=["id_cultura"])
    return resolve_municipio_by_name(out, municipios).dropna(subset=["id_municipio"])


def load(datasets: dict[str, DataFrame], tables: dict) -> dict[str, int]:
    culturas, municipios = tables["dim_cultura"].read(), tables["dim_municipio"].read()
    done = {}
    if "campos_producao" in datasets:
        rows = fact(clean_production(datasets["campos_producao"]), culturas, municipios)
        done["campos_producao"] = tables["fato_sigef_producao"].upsert(rows)
    reserve = datasets.get("reserva_semente", datasets.get("uso_proprio"))
    if reserve is not None:
        rows = fact(clean_reserve(reserve), culturas, municipios)
        done["reserva_semente"] = tables["fato_sigef_reserva_semente"].upsert(rows)
    return done
