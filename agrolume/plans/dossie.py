"""Input dossier of a crop: cultivars, seed volume, pesticides, pests."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agrolume.functions import nonzero, technology_grade
from agrolume.functions.grading import TECHNOLOGY
from agrolume.plans.base import Star, crops, find_cultura

# Fixed value: the mark of a registered cultivar.
REGISTERED = "%REGISTRAD%"

_KEY = ["id_cultura"]


def _pesticides(agrofit: DataFrame, brands: int, pests: int) -> DataFrame:
    """Registrations, brands and pests per crop, from one pass over the register.

    A row counts once as itself, once for its brand and once for its pest; what is
    left per crop, kind and value is ranked and listed.
    """
    kinds = agrofit.select(
        *_KEY,
        F.explode(
            F.array(
                F.struct(F.lit("row").alias("kind"), F.lit(None).cast("string").alias("value")),
                F.struct(F.lit("brand").alias("kind"), F.col("marca_comercial").alias("value")),
                F.struct(F.lit("pest").alias("kind"), F.col("praga_comum").alias("value")),
            )
        ).alias("x"),
    ).select(*_KEY, "x.*")
    wanted = (F.col("kind") == "row") | (F.col("value") != "") | ((F.col("kind") == "pest") & (F.col("value") == ""))
    counts = kinds.where(wanted).groupBy(*_KEY, "kind", "value").agg(F.count("*").alias("n"))
    by_kind = Window.partitionBy(*_KEY, "kind").orderBy(F.when(F.col("kind") == "pest", -F.col("n")), "value")
    ranked = counts.withColumn("rank", F.row_number().over(by_kind))
    kept = ranked.where(F.col("rank") <= F.when(F.col("kind") == "brand", brands).when(F.col("kind") == "pest", pests).otherwise(1))

    def listed(kind: str, alias: str):
        return F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct("rank", "value")))), lambda x: x["value"]).alias(alias)

    return kept.groupBy(*_KEY).agg(
        F.sum(F.when(F.col("kind") == "row", F.col("n"))).alias("_registros"), listed("brand", "_marcas"), listed("pest", "_pragas")
    )


def _dossier(base: DataFrame, t: Star, ladder, brands: int, pests: int) -> DataFrame:
    cultivars = (
        t["fato_registro_cultivares"]
        .where(F.col("situacao").ilike(REGISTERED))
        .groupBy(*_KEY)
        .agg(F.count("nr_registro").alias("_cultivares"))
    )
    seeds = t["fato_sigef_producao"].groupBy(*_KEY).agg(F.sum("producao_bruta_t").alias("_sementes"))
    out = base
    for part in (cultivars, seeds, _pesticides(t["fato_agrofit"], brands, pests)):
        out = out.join(part, "id_cultura", "left")
    none = F.array().cast("array<string>")
    return out.select(
        "cultura",
        F.coalesce("_cultivares", F.lit(0)).alias("cultivares_ativos"),
        F.round(nonzero("_sementes"), 2).alias("volume_sementes_sigef_ton"),
        F.coalesce("_marcas", none).alias("defensivos_recomendados"),
        F.coalesce("_pragas", none).alias("principais_pragas_alvo"),
        technology_grade(F.coalesce("_registros", F.lit(0)), ladder).alias("grau_de_tecnologia"),
    )


def dossie_all(t: Star, ladder=TECHNOLOGY, brands: int = 20, pests: int = 10) -> DataFrame:
    """The dossier of every crop."""
    return _dossier(crops(t), t, ladder, brands, pests)


def dossie_insumos(t: Star, cultura: str, ladder=TECHNOLOGY, brands: int = 20, pests: int = 10) -> DataFrame:
    """The dossier of one crop: the first ``brands`` brands by name, without empty
    names, and the ``pests`` most frequent pests, by name on a tie."""
    crop = F.col("id_cultura") == find_cultura(t, cultura).id_cultura
    facts = ("fato_agrofit", "fato_registro_cultivares", "fato_sigef_producao")
    return _dossier(crops(t).where(crop), {n: t[n].where(crop) for n in facts}, ladder, brands, pests)
