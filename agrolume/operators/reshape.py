"""Long to wide and wide to long."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Text found in a variable's name, and the column it feeds.
PAM_VARIABLES = {
    "Área plantada": "area_plantada_ha",
    "Área colhida": "area_colhida_ha",
    "Quantidade produzida": "qtde_produzida_ton",
    "Valor da produção": "valor_producao_mil_reais",
}


def pivot_variables(
    df: DataFrame,
    keys: Sequence[str] = ("cod_municipio_ibge", "municipio_nome", "ano", "cultura"),
    variable: str = "variavel",
    value: str = "valor",
    variables: dict[str, str] = PAM_VARIABLES,
) -> DataFrame:
    """Mean of ``value`` per key, one column per known variable.

    Rows without a value, a variable or a full key do not count, so a key with
    nothing else disappears.  One partial aggregate; the columns are known, so
    no pass over the data is spent on finding them.  Missing values are counted
    out after the aggregate: a filter below it would parse every value twice.
    """
    means = [
        F.avg(F.when(F.contains(F.col(variable), F.lit(text)), F.col(value))).alias(name)
        for text, name in variables.items()
    ]
    grouped = df.dropna(subset=[*keys, variable]).groupBy(*keys).agg(*means, F.count(value).alias("_values"))
    return grouped.where("_values > 0").drop("_values")


def unpivot_dec(df: DataFrame) -> DataFrame:
    """One row per sowing period: every ``dec…`` column becomes
    (periodo_plantio, risco_climatico); null risks are dropped."""
    periods = [c for c in df.columns if c.lower().startswith("dec")]
    if periods:
        others = [F.col(c) for c in df.columns if c not in periods]
        df = df.select(*others, *[F.col(c).cast("string") for c in periods])
        df = df.unpivot(others, periods, "periodo_plantio", "risco_climatico")
    if "cod_solo" in df.columns and "tipo_solo" not in df.columns:
        df = df.withColumnRenamed("cod_solo", "tipo_solo")
    return df.where(F.col("risco_climatico").isNotNull())
