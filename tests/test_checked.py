"""Checked loads, counts that come with a write, and partitions derived from a question."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from agrolume import plans
from agrolume.operators.quality import Observed
from agrolume.sources import cultivares, readers

PRICE = "id_cultura int, id_municipio int, uf string, ano int, mes int, valor_kg double, nivel_comercializacao string, _seq long"


def test_rejects_carry_their_reasons(spark, tables, rows):
    table = tables["fato_precos_conab_mensal"]
    dims = {"dim_municipio": tables["dim_municipio"].read(), "dim_cultura": tables["dim_cultura"].read()}
    good = [(1, 1, "AC", 2024, 1, 1.0, "P", 1), (1, None, "MT", 2024, 1, 2.0, "P", 2), (1, 1, "AC", 2024, 1, 3.0, "P", 3)]
    bad = [(1, 99, "AC", 2024, 1, 1.0, "P", 4), (77, 1, "ACX", None, 1, 1.0, "P", 5)]
    assert table.upsert(rows(good + bad, PRICE), references=dims) == 2
    assert sorted((r.uf, r.valor_kg) for r in table.read().collect()) == [("AC", 3.0), ("MT", 2.0)]
    got = {(r.id_cultura, r.id_municipio): sorted(r.reasons) for r in table.rejects().collect()}
    assert got == {(1, 99): ["reference:id_municipio"], (77, 1): ["max_length:uf", "not_null:ano", "reference:id_cultura"]}
    # Later loads keep the record; a load that is not checked turns nothing away.
    table.upsert(rows(bad[:1], PRICE))
    assert table.read().count() == 3 and table.rejects().count() == 2
    table.upsert(rows(good, PRICE), references=dims)
    assert table.rejects().count() == 2
    table.upsert(rows(bad, PRICE).where("id_cultura = 1"), references={})
    assert table.rejects().count() == 2  # without dimensions only columns are checked
    table.upsert(rows(bad, PRICE), references=dims, replace=True)
    assert table.read().count() == 0 and table.rejects().count() == 2


def test_rejects_are_seen_with_their_commit(tables, rows, monkeypatch):
    table = tables["fato_precos_conab_mensal"]
    monkeypatch.setattr(type(table), "_publish", lambda self, commit: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        table.upsert(rows([(1, 1, "ACX", 2024, 1, 1.0, "P", 4)], PRICE), references={})
    assert table.rejects().count() == 0


def test_observed_counts(spark, tmp_path):
    seen = Observed(spark, "s")
    df = seen.watch(spark.range(10), {"rows_in": F.count(F.lit(1)), "even": F.count_if(F.col("id") % 2 == 0)})
    seen.watch(df.where("id > 3"), {"rows_out": F.count(F.lit(1))}).write.parquet(str(tmp_path / "out"))
    assert seen.values() == {"rows_in": 10, "even": 5, "rows_out": 6}
    assert {tuple(r) for r in seen.rows().collect()} == {("s", "rows_in", 10), ("s", "even", 5), ("s", "rows_out", 6)}


def test_a_load_scans_its_files_once(spark, tables, tmp_path):
    lines = ["CULTIVAR,NOME COMUM,MANTENEDOR (REQUERENTE) (NOME),Nº REGISTRO,DATA DO REGISTRO"]
    lines += ["'A' / B,Soja,EMBRAPA,1,02/01/2020", "C,Pera,X,2,99/99/2020", "C,Pera,X,2,99/99/2020", "D,Milho,X,,"]
    (tmp_path / "c.csv").write_text("\n".join(lines) + "\n")
    raw = readers.read_cultivares(spark, str(tmp_path / "c.csv")).drop("_seq")
    reads = spark.sparkContext.accumulator(0)
    counted = F.udf(lambda v: reads.add(1) or v)
    want = {r.metric: r.value for r in cultivares.metrics(raw, cultivares.clean(raw)).collect()}
    done, found = cultivares.load_with_metrics(raw.withColumn("CULTIVAR", counted("CULTIVAR")), tables)
    assert {r.metric: r.value for r in found.collect()} == want
    assert done == {"cultivares": 1} and reads.value == 4
    assert [p for p in (tmp_path / "star" / "fato_registro_cultivares" / "staged").iterdir()] == []


@pytest.fixture
def weather(tables, rows):
    days = [(3, datetime(y, m, 1), 60.0, 20.0) for y in (2021, 2022, 2023) for m in (1, 2, 12)]
    tables["fato_meteorologia"].upsert(rows(days, "id_municipio int, data timestamp_ntz, precipitacao_total_mm double, temp_media_c double"))
    ddl = "id_cultura int, id_municipio int, ano int, area_plantada_ha double, qtde_produzida_ton double"
    tables["fato_producao_pam"].upsert(rows([(1, 3, y, 1.0, 2.0) for y in (2021, 2022, 2023)], ddl))
    return tables


def listed(df, table):
    """Folders of a table that a plan may read."""
    return {f.split("/")[-2] for f in df.inputFiles() if table in f}


def test_questions_list_only_their_year(weather):
    t = plans.star(weather)
    profile = plans.raio_x_municipal(t, "5107925", "soja", 2022)
    assert listed(profile, "fato_meteorologia") == {"part=2022"} and listed(profile, "fato_producao_pam") == {"ano=2022"}
    assert profile.first().resumo_climatico["precipitacao_anual_mm"] == 180.0
    window = plans.janela_aplicacao(t, "5107925", 2023, 2)
    assert listed(window, "fato_meteorologia") == {"part=2023"} and window.first().acumulado_chuvas_mm == 60.0
    days = plans.list_clima(t, data_inicio=date(2021, 12, 1), data_fim=date(2022, 1, 31))
    assert listed(days, "fato_meteorologia") == {"part=2021", "part=2022"} and days.count() == 2
    assert listed(plans.list_pam(t, ano=2021), "fato_producao_pam") == {"ano=2021"}
    assert len(listed(plans.raio_x_all(t), "fato_meteorologia")) == 3
    assert plans.janela_aplicacao(t, "5107925", 1999, 2).first().acumulado_chuvas_mm is None
    narrowed = plans.star(weather, {"fato_meteorologia": [2021]})
    assert listed(narrowed["fato_meteorologia"], "fato_meteorologia") == {"part=2021"}
    assert plans.raio_x_municipal(narrowed, "5107925", "soja", 2022).first().resumo_climatico is None


def test_a_star_is_one_moment(weather, rows):
    t = plans.star(weather)
    weather["fato_producao_pam"].upsert(rows([(1, 3, 2030, 1.0, 2.0)], "id_cultura int, id_municipio int, ano int, area_plantada_ha double, qtde_produzida_ton double"))
    assert t["fato_producao_pam"].count() == 3 and set(t) == set(weather) and len(t) == 14
