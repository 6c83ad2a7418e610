"""What reaches the scans and shuffles."""

import pytest

from agrolume.checks import QUERIES
from agrolume import plans
from agrolume.operators import dedupe, lookup
from agrolume.sources import pam, zarc


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def star(rows, tables):
    ddl = "id_cultura int, id_municipio int, ano int, area_plantada_ha double, qtde_produzida_ton double"
    tables["fato_producao_pam"].upsert(rows([(1, 3, y, 1.0, 2.0) for y in (2021, 2022, 2023)], ddl))
    tables["fato_risco_zarc"].upsert(
        rows([(1, 3, "1", "dec1", "20%")], "id_cultura int, id_municipio int, tipo_solo string, periodo_plantio string, risco_climatico string")
    )
    return plans.star(tables)


def test_single_answers_filter_in_the_scan(spark, star):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    text = plan(plans.raio_x_municipal(star, "5107925", "soja", 2023))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "EqualTo(id_municipio,3)" in text and "EqualTo(id_cultura,1)" in text and "(ano#" in text.split("PartitionFilters: [isnotnull(ano")[1][:60]
    assert "area_colhida_ha" not in text  # unread columns stay in the files


def test_pages_are_cut_in_every_task(star):
    assert "TakeOrderedAndProject" in plan(plans.list_pam(star, page=3))


def test_dimension_joins_do_not_shuffle_facts(star, rows, culturas):
    joined = star["fato_producao_pam"].join(star["dim_municipio"], "id_municipio")
    assert "BroadcastHashJoin" in plan(joined) and "Exchange hashpartitioning" not in plan(joined)
    raw = rows([{"cultura": "soja", "cod_municipio_ibge": "1200013", "dec1": "20%", "cod_solo": "1"}])
    assert "Exchange hashpartitioning" not in plan(zarc.fact(raw, culturas, star["dim_municipio"]))


def test_the_dossier_reads_the_pesticide_register_once(star):
    assert plan(plans.dossie_all(star)).count("fato_agrofit") <= 1


def test_names_are_folded_once(rows, culturas):
    df = lookup.resolve_cultura(rows([{"nome": "soja"}]), "nome", culturas).dropna(subset=["id_cultura"])
    assert plan(df).count("octet_length") == 1


def test_values_are_parsed_below_one_partial_aggregate(rows):
    raw = rows([{"D2N": "Área plantada", "V": "1", "D1C": "1", "D1N": "A", "D3N": "2022", "cultura_raw": "soja"}])
    text = plan(pam.clean(raw))
    assert text.count("Exchange hashpartitioning") == 1 and "partial_avg" in text


def test_a_hot_key_stays_correct(spark):
    """A third of the rows share one key."""
    df = spark.range(300_000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "id AS v", "id AS _seq")
    last = dedupe.keep_last(df, ["k"])
    assert last.where("k = 0").first().v == 299_997
    assert last.count() == 200_001


def test_last_rows_of_the_bronze_copy_are_found_by_hash(spark):
    plan = QUERIES["write_bronze"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().sparkPlan().toString()
    splits = [line for line in plan.splitlines() if "HashAggregate(keys=[l_returnflag" in line and "file" in line]
    assert len(splits) == 2 and "SortAggregate" not in plan[plan.index(splits[0]) :]
