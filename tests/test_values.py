import unicodedata
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from agrolume import functions as A


def apply(rows, column, values):
    df = rows([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.out for r in df.select("i", column.alias("out")).orderBy("i").collect()]


def plain_fold(s):
    if s is None:
        return None
    return "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c)).lower().strip()


def test_fold(rows):
    latin = "".join(map(chr, range(0xA0, 0x250)))
    values = ["Ação ", "\tCANA-DE-AÇÚCAR\n", "½ ﬁm ª º", "Ångström\xa0", "Ｆｕｌｌ", "ά", "", None, "x́", latin, "№ 1… ™"]
    assert apply(rows, A.fold("v"), values) == [plain_fold(v) for v in values]
    assert apply(rows, A.fold_crop("v"), ["Cana-de_Açúcar "]) == ["cana de acucar"]


def test_fold_over_all_blocks(rows):
    """Every character that decomposes, Hangul syllables included, some to a text."""
    wide = [c for c in map(chr, range(0xA0, 0x110000)) if not 0xD800 <= ord(c) < 0xE000]
    wide = [c for c in wide if unicodedata.normalize("NFKD", c) != c or unicodedata.combining(c)]
    values = [f"A{''.join(wide[i : i + 7])} b" for i in range(0, len(wide), 7)] + ["한국어 … 한국어 ﬁ½", "각" * 500 + "½" * 500]
    assert apply(rows, A.fold("v"), values) == [plain_fold(v) for v in values]


def test_clean_text(rows):
    values = ["  'a' ", '"b"', "<b>x</b>", r"d\\'agua", "''", " <" + "y" * 31 + ">", None, "'a\"", "'a'b"]
    want = ["a", "b", "x", "d'agua", None, "<" + "y" * 31 + ">", None, "a", "'a'b"]
    assert apply(rows, A.clean_text("v"), values) == want


def test_split_name(rows):
    main, other = A.split_name("v")
    values = ["'BONANZA' / BONA", "OURO", "/x", "a/", "a/b/c", None]
    assert apply(rows, main, values) == ["BONANZA", "OURO", "", "a", "a", None]
    assert apply(rows, other, values) == ["BONA", None, "x", None, "b/c", None]


def test_replace_and_sector(rows):
    assert apply(rows, A.replace_values("v"), ["Pera", "Pera X", None, "OrquÍdea"]) == ["Pêra", "Pera X", None, "Orquídea"]
    sectors = apply(rows, A.classify_setor("v"), ["Embrapa Cerrados", "EMPRESA X", None, "a universidade"])
    assert sectors == ["Público", "Privado", "Nulo", "Público"]


def test_numbers(rows):
    values = ["1,50", "...", "-", "1d", " 3.7 ", "-2.9", "inf", "1e3", ".5", "5.", None, "1 2"]
    number = apply(rows, A.to_number("v", decimal_comma=True), values)
    assert number == [1.5, None, None, None, 3.7, -2.9, float("inf"), 1000.0, 0.5, 5.0, None, None]
    assert apply(rows, A.to_number("v"), ["1,50", "1.50"]) == [None, 1.5]
    assert apply(rows, A.to_number_or_zero("v"), ["x", None, "2"]) == [0.0, 0.0, 2.0]
    assert apply(rows, A.to_int_or_zero("v"), ["2024.0", "x", None, "-3.9"]) == [2024, 0, 0, -3]
    assert apply(rows, A.int_coerce("v"), ["4.0", "-3.9", "inf", "1d", "", None]) == [4, -3, None, None, None, None]


def test_dates(rows):
    values = ["02/01/2020", "2/1/2020", "31/02/2020", "2020-01-05", "15/10/2017 00:00", "2020", "x", None]
    want = [datetime(2020, 1, 2)] * 2 + [None, datetime(2020, 1, 5), datetime(2017, 10, 15), None, None, None]
    assert apply(rows, A.parse_date("v"), values) == want


def test_crop_year_and_month(rows):
    assert apply(rows, A.crop_year_start("v"), ["2023/24", "2023", "x/24", "", None]) == [2023, 2023, None, None, None]
    assert apply(rows, A.month_label(F.lit(2024), F.lit(3)), ["-"]) == ["2024-03"]


@pytest.mark.parametrize(
    ("grade", "cases"),
    [
        (A.technology_grade, {0: "Baixo", 29: "Baixo", 30: "Médio", 99: "Médio", 100: "Alto"}),
        (A.capacity_grade, {0: "Sem cobertura", 1: "Baixa", 15: "Média", 50: "Alta"}),
        (A.estimate_accuracy, {-5: "Excelente (≤5%)", 5.01: "Boa (5–15%)", 30: "Regular (15–30%)", -31: "Fraca (>30%)"}),
    ],
)
def test_grades(rows, grade, cases):
    got = apply(rows, grade(F.col("v").cast("double")), [str(k) for k in cases] + [None])
    assert got == [*cases.values(), None]


def test_header(rows):
    df = rows([{"CD_MUN": "1", "Nome Município": "a", "Código-IBGE": "2", "dec1": "20%"}])
    assert A.snake_columns(df).columns == ["cod_municipio_ibge", "nome_municipio", "codigo_ibge", "dec1"]


def test_uf_from_json(spark):
    uf = "{'UF': {'sigla': 'ac'}}"
    records = [
        f"{{'microrregiao': {{'mesorregiao': {uf}}}}}",
        f"{{'regiao-imediata': {{'regiao-intermediaria': {uf}}}}}",
        f"{{'microrregiao': null, 'regiao-imediata': {{'regiao-intermediaria': {uf}}}}}",
        "{}",
    ]
    schema = (
        "microrregiao struct<mesorregiao: struct<UF: struct<sigla: string>>>, "
        "`regiao-imediata` struct<`regiao-intermediaria`: struct<UF: struct<sigla: string>>>"
    )
    df = spark.createDataFrame([(i, r) for i, r in enumerate(records)], "i int, j string")
    out = df.select("i", F.from_json("j", schema, {"allowSingleQuotes": "true"}).alias("r")).select("i", "r.*")
    assert [r.uf for r in out.select("i", A.uf_from_json().alias("uf")).orderBy("i").collect()] == ["AC", "AC", "AC", "XX"]
