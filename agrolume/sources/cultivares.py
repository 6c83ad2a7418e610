"""National cultivar register."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrolume.functions import classify_setor, clean_text, fold, parse_date, replace_values, split_name, year_of
from agrolume.operators.dedupe import SEQ, keep_first
from agrolume.operators.lookup import resolve_cultura, resolve_mantenedor
from agrolume.operators.quality import Observed, dq_metrics, null_count
from agrolume.sources.common import replace_columns
from agrolume.sources.dimensions import load_mantenedores

# Raw to stored column names.
RENAMES = {
    "CULTIVAR": "cultivar",
    "NOME COMUM": "nome_comum",
    "NOME CIENTÍFICO": "nome_cientifico",
    "GRUPO DA ESPÉCIE": "grupo_especie",
    "SITUAÇÃO": "situacao",
    "Nº FORMULÁRIO": "nr_formulario",
    "Nº REGISTRO": "nr_registro",
    "DATA DO REGISTRO": "data_reg",
    "DATA DE VALIDADE DO REGISTRO": "data_val",
    "MANTENEDOR (REQUERENTE) (NOME)": "mantenedor",
}
TEXTS = ("cultivar", "nome_comum", "nome_cientifico", "grupo_especie", "situacao", "mantenedor")


def clean(raw: DataFrame) -> DataFrame:
    df = raw.withColumnsRenamed(RENAMES)
    df = replace_columns(df, **{c: clean_text(c) for c in TEXTS})
    df = replace_columns(df, nome_comum=replace_values("nome_comum"))
    if "cultivar" in df.columns:
        main, other = split_name("cultivar")
        df = df.withColumns({"cultivar": main, "nome_secundario": other})
    crop = next((c for c in ("nome_comum", "grupo_especie") if c in df.columns), None)
    if crop:
        df = df.withColumn("cultura", fold(crop))
    df = replace_columns(df, data_reg=parse_date("data_reg"), data_val=parse_date("data_val"))
    if "data_reg" in df.columns:
        df = df.withColumn("ANO", year_of("data_reg"))
    if "mantenedor" in df.columns:
        df = df.withColumn("SETOR", classify_setor("mantenedor"))
    if SEQ not in df.columns:
        return df.distinct()
    return keep_first(df, [c for c in df.columns if c != SEQ])


def fact(cleaned: DataFrame, culturas: DataFrame, mantenedores: DataFrame) -> DataFrame:
    """First row per registry number; then rows without a cultivar or crop go."""
    firsts = keep_first(cleaned, ["nr_registro"]).dropna(subset=["nr_registro", "cultivar"])
    out = resolve_cultura(firsts, "cultura", culturas, folded=True).dropna(subset=["id_cultura"])
    return resolve_mantenedor(out, mantenedores)


def _raw_metrics(raw: DataFrame) -> dict[str, Column]:
    common = clean_text("`NOME COMUM`")
    unread = {"DATA DO REGISTRO": "dates_unparsed", "DATA DE VALIDADE DO REGISTRO": "validity_unparsed"}
    return {
        "rows_in": F.count(F.lit(1)),
        "accents_corrected": F.count_if(replace_values(common) != common),
        **{
            name: F.count_if(F.col(f"`{c}`").isNotNull() & parse_date(f"`{c}`").isNull())
            for c, name in unread.items()
            if c in raw.columns
        },
    }


def _clean_metrics() -> dict[str, Column]:
    return {
        "rows_out": F.count(F.lit(1)),
        "secondary_names": F.count("nome_secundario"),
        "missing_nr_registro": null_count("nr_registro"),
    }


def _with_removed(both: DataFrame) -> DataFrame:
    signed = F.when(F.col("metric") == "rows_in", F.col("value")).when(F.col("metric") == "rows_out", -F.col("value"))
    removed = both.groupBy("source").agg(F.sum(signed).alias("value"))
    return both.unionByName(removed.select("source", F.lit("duplicates_removed").alias("metric"), "value"))


def metrics(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Rows in and out and their difference, corrected accents, secondary names, missing
    numbers, dates that could not be read."""
    before = dq_metrics(raw, "cultivares", _raw_metrics(raw))
    return _with_removed(before.unionByName(dq_metrics(cleaned, "cultivares", _clean_metrics())))


def load(raw: DataFrame, tables: dict) -> dict[str, int]:
    return load_with_metrics(raw, tables)[0]


def load_with_metrics(raw: DataFrame, tables: dict) -> tuple[dict[str, int], DataFrame]:
    """Rows written, and ``metrics`` of the run, in one scan of the raw files.

    The cleaned rows are kept beside the table while both the maintainers and the fact
    are made from them; the counts come with that write.
    """
    table, seen = tables["fato_registro_cultivares"], Observed(raw.sparkSession, "cultivares")
    cleaned = seen.watch(clean(seen.watch(raw, _raw_metrics(raw))), _clean_metrics())
    with table.staged(cleaned) as kept:
        load_mantenedores(kept, tables["dim_mantenedor"])
        rows = fact(kept, tables["dim_cultura"].read(), tables["dim_mantenedor"].read())
        return {"cultivares": table.upsert(rows)}, _with_removed(seen.rows())
