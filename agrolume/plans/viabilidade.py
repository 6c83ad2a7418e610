"""Economic viability of a crop in a state and year: production times price."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolume.functions import nonzero
from agrolume.plans.base import Star, crops, find_cultura, places

# Ceiling over the mean price, kilograms per ton, one million.
PRICE_CEILING = 1.2
KG_PER_TON = 1000
MILLION = 1_000_000

_KEY = ["id_cultura", "uf", "ano"]


def _production(pam: DataFrame, municipios: DataFrame) -> DataFrame:
    return (
        pam.join(municipios, "id_municipio")
        .groupBy(*_KEY)
        .agg(F.sum("qtde_produzida_ton").alias("_ton"), F.sum("area_plantada_ha").alias("_ha"))
    )


def _prices(precos: DataFrame) -> DataFrame:
    """Mean over all trade levels, zero prices included."""
    return precos.groupBy(*_KEY).agg(F.avg("valor_kg").alias("_kg"))


def _answer(df: DataFrame) -> DataFrame:
    """Zero counts as missing everywhere; income uses the rounded gross value."""
    ton, ha, price = nonzero("_ton"), nonzero("_ha"), nonzero("_kg") * KG_PER_TON
    vgb = F.round(ton * price / MILLION, 2)
    return df.select(
        "ano",
        "cultura",
        "uf",
        ton.alias("producao_total_ton"),
        F.round(price, 2).alias("preco_medio_anual_ton"),
        F.round(price * PRICE_CEILING, 2).alias("valor_teto_atingido"),
        vgb.alias("vgb_apurado_milhoes"),
        F.when(ha > 0, F.round(nonzero(vgb) * MILLION / ha, 2)).alias("renda_media_hectare"),
    )


def viabilidade_all(t: Star) -> DataFrame:
    """Every crop, state and year with production or prices."""
    both = _production(t["fato_producao_pam"], places(t)).join(
        _prices(t["fato_precos_conab_mensal"]), _KEY, "full"
    )
    return _answer(both.join(crops(t), "id_cultura"))


def viabilidade_economica(t: Star, cultura: str, uf: str, ano: int) -> DataFrame:
    """One row; measures without data are null."""
    cult, uf = find_cultura(t, cultura), uf.upper()
    asked = t["dim_cultura"].sparkSession.createDataFrame(
        [(cult.id_cultura, uf, ano, cult.nome_padronizado)], "id_cultura int, uf string, ano int, cultura string"
    )
    crop_year = (F.col("id_cultura") == cult.id_cultura) & (F.col("ano") == ano)
    pam = t["fato_producao_pam"].where(crop_year)
    precos = t["fato_precos_conab_mensal"].where(crop_year & (F.col("uf") == uf))
    here = places(t).where(F.col("uf") == uf)
    return _answer(asked.join(_production(pam, here), _KEY, "left").join(_prices(precos), _KEY, "left"))
