"""Supply company data: production estimates, monthly and weekly prices."""

from __future__ import annotations

from pyspark.sql import DataFrame

from agrolume.functions import fold, to_int_or_zero, to_number_or_zero, trim_all
from agrolume.operators.lookup import resolve_cultura, resolve_municipio_by_code
from agrolume.operators.table import weekly_reset_due
from agrolume.sources.common import rename_existing, replace_columns, select_existing

# Raw to stored column names.
PRODUCTION_RENAMES = {
    "ano_agricola": "ano_agricola",
    "dsc_safra_previsao": "safra",
    "uf": "uf",
    "produto": "produto_raw",
    "area_plantada_mil_ha": "area_plantada_mil_ha",
    "producao_mil_t": "producao_mil_t",
    "produtividade_mil_ha_mil_t": "produtividade_t_ha",
}
PRICE_RENAMES = {
    "produto": "produto_raw",
    "cod_ibge": "cod_municipio_ibge",
    "valor_produto_kg": "valor_kg",
    "dsc_nivel_comercializacao": "nivel_comercializacao",
    "data_inicial_final_semana": "data_referencia",
}
PRICE_COLUMNS = ["cultura", "uf", "ano", "mes", "valor_kg", "nivel_comercializacao", "cod_municipio_ibge"]
WEEK_COLUMNS = ["semana", "data_referencia"]


def clean_production(raw: DataFrame) -> DataFrame:
    df = rename_existing(trim_all(raw), PRODUCTION_RENAMES, only=True)
    measures = ("area_plantada_mil_ha", "producao_mil_t", "produtividade_t_ha")
    df = replace_columns(df, **{c: to_number_or_zero(c) for c in measures})
    df = df.withColumn("cultura", fold("produto_raw"))
    return select_existing(df, ["ano_agricola", "safra", "uf", "cultura", *measures])


def clean_prices(raw: DataFrame, weekly: bool = False) -> DataFrame:
    df = rename_existing(trim_all(raw), PRICE_RENAMES)
    df = replace_columns(
        df,
        valor_kg=to_number_or_zero("valor_kg", decimal_comma=True),
        **{c: to_int_or_zero(c) for c in ("ano", "mes", "semana")},
    )
    if "produto_raw" in df.columns:
        df = df.withColumn("cultura", fold("produto_raw"))
    return select_existing(df, PRICE_COLUMNS + (WEEK_COLUMNS if weekly else []))


def fact(cleaned: DataFrame, culturas: DataFrame, municipios: DataFrame | None = None) -> DataFrame:
    """State-level rows have no municipality."""
    out = resolve_cultura(cleaned, "cultura", culturas, folded=True).dropna(subset=["id_cultura"])
    if municipios is not None and "cod_municipio_ibge" in out.columns:
        out = resolve_municipio_by_code(out, municipios)
    return out


def load(datasets: dict[str, DataFrame], tables: dict) -> dict[str, int]:
    """History before estimates, so estimates win; state before municipal prices.

    When four weeks are stored, the weekly table starts afresh, decided once
    before the first weekly file of the run.
    """
    culturas, municipios = tables["dim_cultura"].read(), tables["dim_municipio"].read()
    done = {}
    for key in ("producao_historica", "producao_estimativa"):
        if key in datasets:
            rows = fact(clean_production(datasets[key]), culturas)
            done[key] = tables["fato_producao_conab"].upsert(rows)
    for key in ("precos_uf_mensal", "precos_mun_mensal"):
        if key in datasets:
            rows = fact(clean_prices(datasets[key]), culturas, municipios)
            done[key] = tables["fato_precos_conab_mensal"].upsert(rows)
    weekly = [k for k in ("precos_uf_semanal", "precos_mun_semanal") if k in datasets]
    if weekly:
        table = tables["fato_precos_conab_semanal"]
        reset = weekly_reset_due(table)
        for key in weekly:
            rows = fact(clean_prices(datasets[key], weekly=True), culturas, municipios)
            done[key] = table.upsert(rows, replace=reset)
            reset = False
    return done
