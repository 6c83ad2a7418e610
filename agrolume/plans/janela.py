"""Window for applying inputs: rain of the month and suppliers in the state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolume.functions import capacity_grade, month_label, nonzero
from agrolume.functions.grading import CAPACITY
from agrolume.plans.base import Star, find_municipio, places, within

# Rain in mm, suppliers needed, mark of an active one (it is also
# found inside INATIVO, which therefore counts).
RAIN_MIN, RAIN_MAX = 50.0, 200.0
MIN_SUPPLIERS = 3
ACTIVE = "%ATIVO%"


def _suppliers(fertilizantes: DataFrame) -> DataFrame:
    active = fertilizantes.where(F.col("status_registro").ilike(ACTIVE))
    return active.groupBy("uf").agg(F.count("*").alias("_n"))


def _answer(months: DataFrame, suppliers: DataFrame, ladder) -> DataFrame:
    count, rain = F.coalesce("_n", F.lit(0)), nonzero("_chuva")
    return months.join(suppliers, "uf", "left").select(
        "municipio",
        F.coalesce("uf", F.lit("")).alias("uf"),
        month_label("ano", "mes").alias("mes_referencia"),
        count.alias("estabelecimentos_insumos"),
        F.round(rain, 2).alias("acumulado_chuvas_mm"),
        F.when(rain.isNotNull(), rain.between(RAIN_MIN, RAIN_MAX) & (count >= MIN_SUPPLIERS)).alias(
            "janela_perfeita_aplicacao"
        ),
        capacity_grade(count, ladder).alias("capacidade_de_atendimento"),
    )


def janela_all(t: Star, ladder=CAPACITY) -> DataFrame:
    """Every municipality and month with weather data."""
    rain = (
        t["fato_meteorologia"]
        .groupBy("id_municipio", F.year("data").alias("ano"), F.month("data").alias("mes"))
        .agg(F.sum("precipitacao_total_mm").alias("_chuva"))
    )
    return _answer(rain.join(places(t), "id_municipio"), _suppliers(t["fato_fertilizantes_estabelecimentos"]), ladder)


def janela_aplicacao(t: Star, codigo_ibge: str, ano: int, mes: int, ladder=CAPACITY) -> DataFrame:
    """One row; without rain data (or with a zero sum) the window is unknown."""
    mun = find_municipio(t, codigo_ibge)
    start = F.make_timestamp_ntz(F.lit(ano), F.lit(mes), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    month = (F.col("data") >= start) & (F.col("data") < start + F.expr("interval 1 month"))
    rain = within(t, "fato_meteorologia", [ano]).where((F.col("id_municipio") == mun.id_municipio) & month)
    row = rain.agg(F.sum("precipitacao_total_mm").alias("_chuva")).select(
        F.lit(mun.nome).alias("municipio"),
        F.lit(mun.uf).cast("string").alias("uf"),
        F.lit(ano).alias("ano"),
        F.lit(mes).alias("mes"),
        "_chuva",
    )
    same_state = F.col("uf") == mun.uf if mun.uf is not None else F.lit(False)
    return _answer(row, _suppliers(t["fato_fertilizantes_estabelecimentos"].where(same_state)), ladder)
