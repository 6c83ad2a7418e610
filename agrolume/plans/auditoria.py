"""Audit of estimates: forecast against realised production."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolume.functions import crop_year_start, estimate_accuracy, nonzero
from agrolume.functions.grading import ACCURACY
from agrolume.plans.base import Star, crops, find_cultura, places


def _estimates(conab: DataFrame) -> DataFrame:
    """Forecast per state and crop year, over all harvests."""
    return conab.groupBy("id_cultura", "uf", "ano_agricola").agg(F.sum("producao_mil_t").alias("_est"))


def _answer(estimates: DataFrame, pam: DataFrame, t: Star, ladder) -> DataFrame:
    """Realised sums are grouped once and joined, instead of one query per row."""
    real = (
        pam.join(places(t), "id_municipio")
        .groupBy("id_cultura", "uf", "ano")
        .agg(F.sum("qtde_produzida_ton").alias("_ton"))
    )
    years = estimates.withColumn("ano", crop_year_start("ano_agricola")).dropna(subset=["ano"])
    est, realised = nonzero("_est"), nonzero("_ton") / 1000
    variation = F.when(est > 0, F.round((realised - est) / est * 100, 2))
    return (
        years.join(real, ["id_cultura", "uf", "ano"], "left")
        .join(crops(t), "id_cultura")
        .select(
            F.col("ano_agricola").alias("ano_safra"),
            "uf",
            "cultura",
            F.round(est, 2).alias("estimativa_conab_mil_t"),
            F.round(realised, 2).alias("realizado_ibge_pam_mil_t"),
            variation.alias("variacao_margem_erro"),
            estimate_accuracy(variation, ladder).alias("acuracidade_relatorio"),
        )
    )


def auditoria_all(t: Star, ladder=ACCURACY) -> DataFrame:
    """Every crop, state and crop year with a forecast; no limit."""
    return _answer(_estimates(t["fato_producao_conab"]), t["fato_producao_pam"], t, ladder)


def auditoria_estimativas(
    t: Star, cultura: str, uf: str | None = None, max_groups: int | None = None, ladder=ACCURACY
) -> DataFrame:
    """One crop by state and crop year; with ``max_groups`` the first groups whose year can be read."""
    crop = F.col("id_cultura") == find_cultura(t, cultura).id_cultura
    conab = t["fato_producao_conab"].where(crop)
    if uf:
        conab = conab.where(F.col("uf") == uf.upper())
    groups = _estimates(conab)
    if max_groups is not None:
        groups = groups.where(crop_year_start("ano_agricola").isNotNull()).orderBy("uf", "ano_agricola").limit(max_groups)
    return _answer(groups, t["fato_producao_pam"].where(crop), t, ladder)
