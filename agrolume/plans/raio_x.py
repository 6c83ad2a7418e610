"""Agro-climatic profile of a municipality: harvest, dominant risk, weather."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolume.functions import nonzero, year_of
from agrolume.operators.ranking import group_mode
from agrolume.plans.base import Star, crops, find_cultura, find_municipio, places, within

# Fixed value: below this yield (t/ha) the harvest counts as failed.
FAILURE_YIELD = 1.0

PAM_COLUMNS = ("id_municipio", "id_cultura", "ano", "area_plantada_ha", "qtde_produzida_ton")


def _profile(base: DataFrame, zarc: DataFrame, meteo: DataFrame, failure_yield: float) -> DataFrame:
    """Three keyed aggregates beside ``base``, whose keys are unique."""
    risk = group_mode(zarc, ["id_municipio", "id_cultura"], "risco_climatico", "risco_zarc_predominante")
    climate = meteo.groupBy("id_municipio", year_of("data").alias("ano")).agg(
        F.avg("temp_media_c").alias("_temp"),
        F.avg("umidade_media").alias("_umid"),
        F.sum("precipitacao_total_mm").alias("_chuva"),
    )

    def rounded(c: str):
        return F.round(F.coalesce(F.col(c), F.lit(0.0)), 2)

    summary = F.create_map(
        F.lit("temp_media_c"), rounded("_temp"),
        F.lit("umidade_media"), rounded("_umid"),
        F.lit("precipitacao_anual_mm"), rounded("_chuva"),
    )
    per_ha = nonzero("qtde_produzida_ton") / nonzero("area_plantada_ha")
    return (
        base.join(risk, ["id_municipio", "id_cultura"], "left")
        .join(climate, ["id_municipio", "ano"], "left")
        .select(
            "municipio",
            F.coalesce("uf", F.lit("")).alias("uf"),
            "cultura",
            "ano",
            F.struct("ano", "area_plantada_ha", "qtde_produzida_ton").alias("resultado_safra"),
            "risco_zarc_predominante",
            F.when(F.col("_temp").isNotNull(), summary).alias("resumo_climatico"),
            (per_ha < failure_yield).alias("ocorreu_quebra_safra"),
        )
    )


def raio_x_all(t: Star, failure_yield: float = FAILURE_YIELD) -> DataFrame:
    """The profile of every municipality, crop and year with production data."""
    pam = t["fato_producao_pam"].select(*PAM_COLUMNS)
    base = pam.join(crops(t), "id_cultura").join(places(t), "id_municipio")
    return _profile(base, t["fato_risco_zarc"], t["fato_meteorologia"], failure_yield)


def raio_x_municipal(
    t: Star, codigo_ibge: str, cultura: str, ano: int, failure_yield: float = FAILURE_YIELD
) -> DataFrame:
    """One row, also without production data.  The risk looks at all soils,
    periods and years."""
    mun, cult = find_municipio(t, codigo_ibge), find_cultura(t, cultura)
    here, crop = F.col("id_municipio") == mun.id_municipio, F.col("id_cultura") == cult.id_cultura
    start, end = F.lit(f"{ano}-01-01").cast("timestamp_ntz"), F.lit(f"{ano + 1}-01-01").cast("timestamp_ntz")
    keys = "id_municipio int, id_cultura int, ano int"
    asked = mun.asDict() | cult.asDict() | {"ano": ano}
    row = t["dim_municipio"].sparkSession.createDataFrame(
        [tuple(asked[c] for c in ("id_municipio", "id_cultura", "ano", "nome", "uf", "nome_padronizado"))],
        f"{keys}, municipio string, uf string, cultura string",
    )
    pam = within(t, "fato_producao_pam", [ano]).where(here & crop & (F.col("ano") == ano)).select(*PAM_COLUMNS)
    meteo = within(t, "fato_meteorologia", [ano]).where(here & (F.col("data") >= start) & (F.col("data") < end))
    base = row.join(pam, ["id_municipio", "id_cultura", "ano"], "left")
    risk = within(t, "fato_risco_zarc", [cult.id_cultura]).where(here & crop)
    return _profile(base, risk, meteo, failure_yield)
