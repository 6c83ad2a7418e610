"""Filtered, paged listings and point lookups.

A parameter that is absent, empty or zero does not filter.  Pages follow the
listed columns and end with the surrogate key, so they never overlap; Spark
keeps only the rows up to the end of the page in each task.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolume.operators.ranking import page_envelope, paginate
from agrolume.plans.base import Star, crops, one, places, within, years

total_pages = page_envelope


def _filtered(df: DataFrame, **wanted) -> DataFrame:
    for column, value in wanted.items():
        if value:
            df = df.where(F.col(column) == value)
    return df


def _lower(x: str | None) -> str | None:
    return x.lower() if x else None


def _upper(x: str | None) -> str | None:
    return x.upper() if x else None


def _page(df: DataFrame, order: Sequence[str], page: int | None, page_size: int) -> DataFrame:
    """``page=None`` gives all rows, for ``total_pages`` or further work."""
    return df if page is None else paginate(df, order, page, page_size)


def _named_places(t: Star) -> DataFrame:
    return places(t).withColumnRenamed("municipio", "municipio_nome")


def list_pam(t: Star, cultura=None, uf=None, ano=None, page: int | None = 1, page_size: int = 20) -> DataFrame:
    fact = _filtered(within(t, "fato_producao_pam", [ano]) if ano else t["fato_producao_pam"], ano=ano)
    rows = fact.join(_filtered(crops(t), cultura=_lower(cultura)), "id_cultura").join(
        _filtered(_named_places(t), uf=_upper(uf)), "id_municipio"
    )
    out = rows.select(
        "id_producao", "ano", "area_plantada_ha", "area_colhida_ha", "qtde_produzida_ton",
        "valor_producao_mil_reais", "cultura", "municipio_nome", "uf",
    )
    return _page(out, ["cultura", "municipio_nome", "ano", "id_producao"], page, page_size)


def list_conab(
    t: Star, cultura=None, uf=None, ano_agricola=None, page: int | None = 1, page_size: int = 20
) -> DataFrame:
    fact = _filtered(t["fato_producao_conab"], uf=_upper(uf), ano_agricola=ano_agricola)
    rows = fact.join(_filtered(crops(t), cultura=_lower(cultura)), "id_cultura")
    out = rows.select(
        "id_conab", "uf", "ano_agricola", "safra", "area_plantada_mil_ha", "producao_mil_t",
        "produtividade_t_ha", "cultura",
    )
    return _page(out, ["cultura", "uf", "ano_agricola", "safra", "id_conab"], page, page_size)


def list_sigef(t: Star, cultura=None, uf=None, safra=None, page: int | None = 1, page_size: int = 20) -> DataFrame:
    fact = _filtered(t["fato_sigef_producao"], safra=safra)
    rows = fact.join(_filtered(crops(t), cultura=_lower(cultura)), "id_cultura").join(
        _filtered(_named_places(t), uf=_upper(uf)), "id_municipio"
    )
    out = rows.select(
        "id_sigef_producao", "safra", "especie", "categoria", "area_ha", "producao_bruta_t",
        "producao_est_t", "cultura", "municipio_nome", "uf", "cultivar_raw",
    )
    order = ["cultura", "municipio_nome", "safra", "especie", "cultivar_raw", "categoria", "id_sigef_producao"]
    return _page(out, order, page, page_size).drop("cultivar_raw")


def list_agrofit(t: Star, cultura=None, classe=None, page: int | None = 1, page_size: int = 20) -> DataFrame:
    """The class is compared without regard to case."""
    fact = t["fato_agrofit"]
    if classe:
        fact = fact.where(F.upper("classe") == classe.upper())
    rows = fact.join(_filtered(crops(t), cultura=_lower(cultura)), "id_cultura")
    out = rows.select("id_agrofit", "nr_registro", "marca_comercial", "classe", "praga_comum", "cultura")
    order = ["cultura", "nr_registro", "marca_comercial", "praga_comum", "id_agrofit"]
    return _page(out, order, page, page_size)


def list_fertilizantes(t: Star, uf=None, atividade=None, page: int | None = 1, page_size: int = 20) -> DataFrame:
    """The activity is compared without regard to case."""
    fact = _filtered(t["fato_fertilizantes_estabelecimentos"], uf=_upper(uf))
    if atividade:
        fact = fact.where(F.upper("atividade") == atividade.upper())
    out = fact.select(
        "id_fertilizante", "uf", "municipio", "nr_registro_estabelecimento", "razao_social",
        "area_atuacao", "atividade",
    )
    return _page(out, ["uf", "nr_registro_estabelecimento"], page, page_size)


def list_clima(
    t: Star,
    codigo_ibge: str | None = None,
    data_inicio: date | None = None,
    data_fim: date | None = None,
    page: int | None = 1,
    page_size: int = 20,
) -> DataFrame:
    """Days from ``data_inicio`` to ``data_fim``, both included."""
    both = data_inicio and data_fim
    fact = within(t, "fato_meteorologia", years(data_inicio, data_fim)) if both else t["fato_meteorologia"]
    if data_inicio:
        fact = fact.where(F.col("data") >= F.lit(data_inicio).cast("timestamp_ntz"))
    if data_fim:
        fact = fact.where(F.col("data") <= F.lit(data_fim).cast("timestamp_ntz"))
    dim = _filtered(t["dim_municipio"], codigo_ibge=codigo_ibge)
    dim = dim.select("id_municipio", F.col("nome").alias("municipio_nome"), "uf")
    out = fact.join(dim, "id_municipio").select(
        "id_meteo", F.col("data").cast("date").alias("data"), "precipitacao_total_mm", "temp_media_c",
        "umidade_media", "municipio_nome", "uf",
    )
    return _page(out, ["municipio_nome", "data", "id_meteo"], page, page_size)


def list_zarc(
    t: Star, codigo_ibge=None, cultura=None, id_solo=None, page: int | None = 1, page_size: int = 50
) -> DataFrame:
    """Soil is compared as text.  Pages start at 1 and hold 1 to 500 rows."""
    if page is not None and (page < 1 or not 1 <= page_size <= 500):
        raise ValueError("page starts at 1; page_size is 1 to 500")
    fact = _filtered(t["fato_risco_zarc"], tipo_solo=str(id_solo) if id_solo else None)
    dim = _filtered(t["dim_municipio"], codigo_ibge=codigo_ibge)
    dim = dim.select("id_municipio", F.col("nome").alias("municipio"), "uf")
    rows = fact.join(_filtered(crops(t), cultura=_lower(cultura)), "id_cultura").join(dim, "id_municipio")
    out = rows.select("periodo_plantio", "tipo_solo", "risco_climatico", "cultura", "municipio", "uf", "id_zarc")
    order = ["cultura", "municipio", "uf", "tipo_solo", "periodo_plantio", "id_zarc"]
    return _page(out, order, page, page_size).drop("id_zarc")


def list_culturas(t: Star, page: int | None = 1, page_size: int = 20) -> DataFrame:
    return _page(t["dim_cultura"], ["id_cultura"], page, page_size)


def get_cultura(t: Star, nome: str) -> DataFrame:
    """The crop of that name, stripped and in lower case; LookupError if unknown."""
    found = t["dim_cultura"].where(F.col("nome_padronizado") == nome.lower().strip()).limit(1)
    one(found, f"Cultura '{nome}'")
    return found


def list_municipios(t: Star, uf=None, nome=None, page: int | None = 1, page_size: int = 50) -> DataFrame:
    """``nome`` is found anywhere in the name, without regard to case; ``%`` and
    ``_`` in it are wildcards."""
    out = _filtered(t["dim_municipio"], uf=_upper(uf))
    if nome:
        out = out.where(F.col("nome").ilike(f"%{nome}%"))
    return _page(out, ["id_municipio"], page, page_size)


def get_municipio(t: Star, codigo_ibge: str) -> DataFrame:
    """The municipality of that code; LookupError if unknown."""
    found = t["dim_municipio"].where(F.col("codigo_ibge") == codigo_ibge).limit(1)
    one(found, f"Município {codigo_ibge}")
    return found
