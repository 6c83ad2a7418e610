from datetime import datetime

import pytest

from agrolume import schema
from agrolume.operators import dedupe, quality, ranking, reshape
from agrolume.sources import zarc


def test_keep_first_and_last(rows):
    df = rows([(1, None, "a", 1), (1, None, "b", 2), (2, "x", None, 3), (2, "x", "d", 4)], "k int, l string, v string, _seq int")
    first = {(r.k, r.l): r.v for r in dedupe.keep_first(df, ["k", "l"]).collect()}
    last = {(r.k, r.l): r.v for r in dedupe.keep_last(df, ["k", "l"]).collect()}
    assert first == {(1, None): "a", (2, "x"): None}
    assert last == {(1, None): "b", (2, "x"): "d"}
    assert dedupe.keep_last(df, ["k"]).columns == df.columns


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("0 AS k", "id AS v", "id AS _seq")
    plan = dedupe.keep_last(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan


def test_mode(rows):
    df = rows([(1, "b"), (1, "a"), (1, None), (1, ""), (1, ""), (1, ""), (2, "0"), (3, None)], "k int, v string")
    assert {r.k: r.m for r in ranking.group_mode(df, ["k"], "v", "m").collect()} == {1: "a", 2: "0"}


def test_lists(rows):
    df = rows([(1, v) for v in ("b", "a", "a", None, "", "c")] + [(2, None)], "k int, v string")
    assert {r.k: r.x for r in ranking.top_k_list(df, ["k"], "v", 2, "x").collect()} == {1: ["a", ""]}
    # Null and empty take no place.
    assert {r.k: r.x for r in ranking.distinct_k_list(df, ["k"], "v", 3, "x").collect()} == {1: ["a", "b", "c"]}


def test_groups_are_cut_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "cast(id as string) AS v")
    plan = ranking.distinct_k_list(df, ["k"], "v", 3, "x")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_pages(spark):
    df = spark.range(45).toDF("id")
    assert [r.id for r in ranking.paginate(df, ["id"], 3, 20).collect()] == [40, 41, 42, 43, 44]
    assert ranking.page_envelope(df, 2, 20).first() == (45, 2, 20, 3)
    assert ranking.page_envelope(df.limit(0)).first() == (0, 1, 20, 0)


def test_pivot_drops_empty_groups(rows):
    df = rows(
        [
            ("1", "A", "2022", "soja", "Área plantada (Hectares)", 1000.0),
            ("1", "A", "2022", "soja", "Área plantada (Hectares)", 3000.0),
            ("1", "A", "2022", "soja", "Área colhida", None),
            ("2", "B", "2022", "soja", "Área colhida", None),
            ("3", None, "2022", "soja", "Área colhida", 5.0),
            ("4", "D", "2022", "soja", "Outra", 5.0),
        ],
        "cod_municipio_ibge string, municipio_nome string, ano string, cultura string, variavel string, valor double",
    )
    got = {r.cod_municipio_ibge: r for r in reshape.pivot_variables(df).collect()}
    assert set(got) == {"1", "4"}
    assert (got["1"].area_plantada_ha, got["1"].area_colhida_ha) == (2000.0, None)
    assert got["4"].area_plantada_ha is None


def test_unpivot(rows):
    df = rows([{"id": "1", "cod_solo": "2", "dec1": "20%", "dec36": None}])
    got = reshape.unpivot_dec(df)
    assert got.columns == ["id", "tipo_solo", "periodo_plantio", "risco_climatico"]
    assert [tuple(r) for r in got.collect()] == [("1", "2", "dec1", "20%")]


def test_split_by_crop(rows, tmp_path, spark):
    raw = rows([{"Nome_cultura": n} for n in ("Milho 1ª safra", "Algodão e SOJA", "Arroz", None)])
    got = sorted((r.crop, r.Nome_cultura) for r in zarc.split_by_crop(raw).collect())
    assert got == [("algodao", "Algodão e SOJA"), ("milho", "Milho 1ª safra"), ("soja", "Algodão e SOJA")]
    assert zarc.split_by_crop(rows([{"x": "Soja"}])).count() == 0
    zarc.write_by_crop(raw, str(tmp_path / "by_crop"))
    assert spark.read.parquet(str(tmp_path / "by_crop")).where("crop = 'soja'").count() == 1


def test_constraints(rows, municipios):
    df = rows([(1, "AC"), (1, "ACX"), (7, None), (None, "AC")], "id_municipio int, uf string")
    assert quality.unique_violations(df, ["id_municipio"]).collect() == [(1, 2)]
    assert [r.id_municipio for r in quality.missing_references(df, municipios, "id_municipio").collect()] == [7]
    checks = quality.column_violations(df.selectExpr("*", "1 AS ano", "cast(null as int) AS mes"), schema.PRECOS_MENSAL)
    assert {(r.check, r.column): r.n for r in checks.collect()} == {
        ("not_null", "ano"): 0,
        ("not_null", "mes"): 4,
        ("max_length", "uf"): 1,
    }


def test_fresh_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x")
    new = quality.fresh_files(spark, str(tmp_path), days=7)
    old = quality.fresh_files(spark, str(tmp_path), days=7, now=datetime(2099, 1, 1))
    assert (new.first().fresh, old.first().fresh) == (True, False)


def test_conform(rows):
    df = rows([{"id_cultura": "4.0", "uf": "MT", "ano": "x", "outra": "1"}])
    got = schema.PRECOS_MENSAL.conform(df).first().asDict()
    assert (got["id_cultura"], got["ano"], got["valor_kg"], "outra" in got) == (4, None, None, False)


def test_pages_after_a_row(rows):
    df = rows([(None, 1), (None, 2), ("a", 1), ("a", 3), ("b", 2)], "k string, i int")
    got, last = [], None
    while page := ranking.page_after(df, ["k", "i"], last, 2).collect():
        last = tuple(page[-1])
        got += map(tuple, page)
    assert got == [(None, 1), (None, 2), ("a", 1), ("a", 3), ("b", 2)]


@pytest.mark.parametrize("size", [7, 40])
def test_deep_pages(rows, size):
    """Every page is that of plain sorting, with nulls, ties in the first column and pages beyond the end."""
    keys = [(None if i % 5 == 0 else "abc"[i % 3], i if i % 11 else None) for i in range(400)]
    keys = list(dict.fromkeys(keys))
    df = rows(keys, "k string, i int")
    wanted = sorted(keys, key=lambda x: (x[0] is not None, x[0] or "", x[1] is not None, x[1] or 0))
    last = len(wanted) // size + 2
    for page in (1, 2, last // 2, last - 2, last - 1, last):
        got = ranking.paginate(df, ["k", "i"], page, size, deep=size).collect()
        assert list(map(tuple, got)) == wanted[(page - 1) * size : page * size], page


def test_deep_page_sorts_one_range(spark):
    df = spark.range(200_000).selectExpr("id * 7 % 200000 AS id", "'x' AS v")
    part, skip = ranking._range_of(df, ["id"], 150_000, 20, most=1_000)
    assert part.count() <= 20_000 and skip < part.count()  # a sixty-fourth, give or take the draw
    assert [r.id for r in ranking.paginate(df, ["id"], 7_501, 20, deep=1_000).collect()] == list(range(150_000, 150_020))


def test_equal_keys_end_the_narrowing(rows):
    df = rows([(1,)] * 300 + [(2,)], "k int")
    assert [r.k for r in ranking.paginate(df, ["k"], 31, 10, deep=10).collect()] == [2]


def test_page_after_reaches_the_scan(spark, tmp_path):
    spark.range(100).selectExpr("id", "id % 3 AS j").write.parquet(str(tmp_path / "t"))
    page = ranking.page_after(spark.read.parquet(str(tmp_path / "t")), ["id", "j"], [50, 2], 5)
    assert "GreaterThanOrEqual(id,50)" in page._jdf.queryExecution().executedPlan().toString()
    assert [r.id for r in page.collect()] == [51, 52, 53, 54, 55]
