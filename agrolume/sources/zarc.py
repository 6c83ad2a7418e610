"""Climate risk zoning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolume.functions import fold, snake_columns
from agrolume.operators.lookup import resolve_cultura, resolve_municipio_by_code
from agrolume.operators.reshape import unpivot_dec
from agrolume.sources.common import select_existing

# The crops with a risk file of their own.
RISK_CROPS = ("soja", "milho", "trigo", "algodao", "cana-de-acucar")


def clean(raw: DataFrame) -> DataFrame:
    """Folded header, one municipality code column, normalised crop."""
    df = snake_columns(raw)
    if "cultura_raw" in df.columns:
        df = df.withColumn("cultura", fold("cultura_raw")).drop("cultura_raw")
    return df


def fact(cleaned: DataFrame, culturas: DataFrame, municipios: DataFrame) -> DataFrame:
    """Long form: one row per crop, municipality, soil and sowing period.

    Keys are resolved on the wide rows, before each becomes up to 36.
    """
    columns = ["id_cultura", "id_municipio", "tipo_solo", "periodo_plantio", "risco_climatico"]
    if "cod_municipio_ibge" not in cleaned.columns:
        ddl = "id_cultura int, id_municipio int, " + ", ".join(f"{c} string" for c in columns[2:])
        return cleaned.sparkSession.createDataFrame([], ddl)
    soil = [c for c in ("cod_solo", "tipo_solo") if c in cleaned.columns]
    decs = [c for c in cleaned.columns if c.lower().startswith("dec") or c in columns[3:]]
    wide = select_existing(cleaned, ["cultura", "cod_municipio_ibge", *soil, *decs])
    wide = resolve_municipio_by_code(resolve_cultura(wide, "cultura", culturas, folded=True), municipios)
    wide = wide.dropna(subset=["id_cultura", "id_municipio"]).drop("cultura", "cod_municipio_ibge")
    long = unpivot_dec(wide)
    return select_existing(long, columns)


def split_by_crop(raw: DataFrame, crops: Sequence[str] = RISK_CROPS) -> DataFrame:
    """Rows of one consolidated file with the target crops their name contains
    (``crop``); a row can go to several.  Empty when there is no crop column."""
    name = next((c for c in ("Nome_cultura", "cultura") if c in raw.columns), None)
    if name is None:
        return raw.limit(0).withColumn("crop", F.lit(None).cast("string"))
    found = F.array_compact(F.array(*[F.when(F.contains(fold(name), F.lit(c)), c) for c in crops]))
    return raw.withColumn("crop", F.explode(found))


def write_by_crop(raw: DataFrame, path: str, crops: Sequence[str] = RISK_CROPS) -> None:
    """One folder per crop.  A row order column is not kept."""
    rows = split_by_crop(raw, crops).drop("_seq")
    rows.hint("rebalance", "crop").write.partitionBy("crop").parquet(path)


def load(raw: DataFrame, tables: dict, **upsert) -> dict[str, int]:
    rows = fact(clean(raw), tables["dim_cultura"].read(), tables["dim_municipio"].read())
    return {"zarc": tables["fato_risco_zarc"].upsert(rows, **upsert)}


