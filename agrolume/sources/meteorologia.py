"""Daily weather per municipality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolume.functions import parse_date
from agrolume.operators.lookup import municipios_with_coordinates

# Raw to stored column names, and the station mark.
RENAMES = {
    "time": "data",
    "precipitation_sum": "precipitacao_total_mm",
    "temperature_2m_max": "temp_max_c",
    "temperature_2m_min": "temp_min_c",
    "temperature_2m_mean": "temp_media_c",
}
STATION = "OPEN-METEO"


def clean(raw: DataFrame) -> DataFrame:
    df = raw.withColumnsRenamed(RENAMES).withColumn("data", parse_date("data")).dropna(subset=["data"])
    return df.withColumns({"umidade_media": F.lit(None).cast("double"), "estacao_id": F.lit(STATION)})


def fact(cleaned: DataFrame, municipios: DataFrame, coords: DataFrame, limit: int | None = None) -> DataFrame:
    """Days of the municipalities that have coordinates; with ``limit`` of the first ones."""
    chosen = municipios_with_coordinates(municipios, coords, limit)
    return cleaned.join(chosen.select("codigo_ibge", "id_municipio"), "codigo_ibge")


def load(raw: DataFrame, coords: DataFrame, tables: dict, limit: int | None = None) -> dict[str, int]:
    rows = fact(clean(raw), tables["dim_municipio"].read(), coords, limit)
    return {"meteorologia": tables["fato_meteorologia"].upsert(rows)}
