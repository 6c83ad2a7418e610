import gzip
import json

import pytest

from agrolume.sources import dimensions, readers
from agrolume.sources.common import write_bronze


def values(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.orderBy("_seq").collect()]


def test_delimited_bad_lines_and_nulls(spark, tmp_path):
    text = 'a;b;c\n1;2;3\n4;5\n6;7;8;9\n"x;y";NA;-\n7;8;9;\n"q""z"; s;\n'
    (tmp_path / "f.csv").write_text(text)
    df = readers.read_agrofit(spark, str(tmp_path / "f.csv"))
    assert values(df, "a", "b", "c") == [
        ("1", "2", "3"), ("4", "5", None), ("x;y", None, "-"), ('q"z', " s", None),
    ]
    # A narrow selection still skips the same lines.
    assert df.select("a").count() == 4


def test_cultivar_nulls_and_leading_space(spark, tmp_path):
    (tmp_path / "c.csv").write_text("CULTIVAR,NOME COMUM\nA,  Soja\n-,--\nnan,N/A\n")
    df = readers.read_cultivares(spark, str(tmp_path / "c.csv"))
    assert values(df, "CULTIVAR", "NOME COMUM") == [("A", "Soja"), (None, None), (None, None)]


def test_bronze_copy_keeps_rows_and_order(spark, tmp_path):
    (tmp_path / "c.csv").write_text("MANTENEDOR (REQUERENTE) (NOME),Nº REGISTRO\nA,2\nB,1\n")
    write_bronze(readers.read_cultivares(spark, str(tmp_path / "c.csv")), str(tmp_path / "bronze"))
    df = spark.read.parquet(str(tmp_path / "bronze"))
    assert values(df, "MANTENEDOR (REQUERENTE) (NOME)", "Nº REGISTRO") == [("A", "2"), ("B", "1")]


def test_latin1(spark, tmp_path):
    (tmp_path / "PrecosMensalUF.txt").write_bytes("produto;uf\n  Algodão ;MT\n".encode("latin1"))
    data = readers.read_conab_folder(spark, str(tmp_path))
    assert list(data) == ["precos_uf_mensal"]
    assert data["precos_uf_mensal"].first().produto == "Algodão "


def test_line_order_over_splits(spark, tmp_path):
    lines = [f"{i % 7};{i}" for i in range(20000)]
    for n in range(3):
        (tmp_path / f"f{n}.csv").write_text("k;v\n" + "\n".join(lines[n::3]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        from agrolume.operators.dedupe import keep_last

        df = readers.read_delimited(spark, str(tmp_path), ";")
        got = {r.k: r.v for r in keep_last(df, ["k"]).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = {}
    for n in range(3):
        want |= dict(x.split(";") for x in lines[n::3])
    assert got == want


def test_alternate_seed_file(spark, tmp_path):
    (tmp_path / "reserva_semente.csv").write_text("PERIODO\n1\n")
    (tmp_path / "uso_proprio.csv").write_text("PERIODO\n2\n")
    data = readers.read_sigef_folder(spark, str(tmp_path))
    assert list(data) == ["reserva_semente"] and data["reserva_semente"].first().PERIODO == "2"


def test_gzip_under_any_name(spark, tmp_path):
    plain = "Nome_cultura;cd_mun;dec1\nSoja;1200013;20%\nSoja;1;2;3\nSoja;1200054\n"
    packed = "cd_mun;dec1\n1200013;30%\n"
    (tmp_path / "zarc_soja.csv").write_text(plain)
    (tmp_path / "zarc_milho.csv").write_bytes(gzip.compress(packed.encode()))
    df = readers.read_zarc(spark, str(tmp_path), ["soja", "milho", "trigo"])
    got = {tuple(r) for r in df.select("cultura_raw", "cd_mun", "dec1").collect()}
    assert got == {("Soja", "1200013", "20%"), ("Soja", "1200054", None), ("milho", "1200013", "30%")}
    assert readers.is_gzip(spark, str(tmp_path / "zarc_milho.csv"))
    assert not readers.is_gzip(spark, str(tmp_path / "zarc_soja.csv"))
    lines = readers.read_any_gzip(spark, str(tmp_path / "zarc_soja.csv"))
    assert values(lines, "cd_mun", "dec1") == [("1200013", "20%"), ("1200054", None)]


def test_zarc_municipios(spark, tmp_path):
    (tmp_path / "z.csv").write_text("cod_municipio_ibge;municipio;uf;dec1\n1;A;AC;x\n1;B;AC;x\n2;C;AM;x\n")
    df = readers.read_delimited(spark, str(tmp_path / "z.csv"), ";")
    assert {tuple(r) for r in readers.zarc_municipios(df).collect()} == {("1", "A", "AC"), ("2", "C", "AM")}
    assert readers.zarc_municipios(df.drop("cod_municipio_ibge")).count() == 0


def test_pam_payload(spark, tmp_path):
    def record(v):
        return {"D1C": "1200013", "D1N": "A", "D2N": "Área plantada", "D3N": "2022", "V": v, "MC": "x"}

    (tmp_path / "pam_soja.json").write_text(json.dumps([record("Valor"), record("1"), record("...")]))
    (tmp_path / "pam_milho.json").write_text(json.dumps([record("Valor")]))
    got = {tuple(r) for r in readers.read_pam_long(spark, str(tmp_path)).select("cultura_raw", "V").collect()}
    assert got == {("soja", "1"), ("soja", "...")}


def test_municipality_list(spark, tmp_path):
    records = [
        {"id": 1, "nome": "A", "microrregiao": {"mesorregiao": {"UF": {"sigla": "ac"}}}},
        {"id": 2, "nome": "B", "microrregiao": None, "regiao-imediata": {"regiao-intermediaria": {"UF": {"sigla": "MT"}}}},
        {"id": 3, "nome": "C"},
    ]
    (tmp_path / "m.json").write_text(json.dumps(records))
    rows = dimensions.municipio_rows_json(readers.read_municipios_json(spark, str(tmp_path / "m.json")))
    assert {tuple(r) for r in rows.collect()} == {("1", "A", "AC"), ("2", "B", "MT"), ("3", "C", "XX")}


def test_weather_and_coordinates(spark, tmp_path):
    daily = {
        "time": ["2024-01-01", "2024-01-02"], "precipitation_sum": [2.0, None], "temperature_2m_max": [25.0, 30.0],
        "temperature_2m_min": [24.0, 28.0], "temperature_2m_mean": [24.5, 29.0],
    }
    (tmp_path / "clima_1200013.json").write_text(json.dumps({"latitude": 1, "daily": daily}))
    got = readers.read_weather_json(spark, str(tmp_path)).orderBy("time").collect()
    assert [(r.codigo_ibge, r.time, r.precipitation_sum) for r in got] == [
        ("1200013", "2024-01-01", 2.0), ("1200013", "2024-01-02", None),
    ]
    (tmp_path / "coords.csv").write_text("codigo_ibge,nome,latitude,longitude\n1200013,A,-9.8,x\n")
    assert tuple(readers.read_coords(spark, str(tmp_path / "coords.csv")).first()) == ("1200013", -9.8, None)


def test_line_ends_and_quoted_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'NR_REGISTRO;MARCA;praga_comum\r\n1;"A\nB";x\r\n2;C;y\r\n')
    df = readers.read_agrofit(spark, str(tmp_path / "a.csv"))
    assert df.columns[:3] == ["NR_REGISTRO", "MARCA", "praga_comum"]
    assert values(df, "NR_REGISTRO", "MARCA", "praga_comum") == [("1", "A\nB", "x"), ("2", "C", "y")]
    (tmp_path / "b.csv").write_bytes(b"a;b\r\n1;2\r\n")
    assert values(readers.read_delimited(spark, str(tmp_path / "b.csv"), ";"), "a", "b") == [("1", "2")]


def test_each_file_by_its_own_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a;b\n1;2\n")
    (tmp_path / "b.csv").write_text("\ufeffb;a;c\n3;4;5\n")
    (tmp_path / "c.csv").write_text("")
    df = readers.read_delimited(spark, str(tmp_path), ";")
    assert {(r.a, r.b, r.c) for r in df.collect()} == {("1", "2", None), ("4", "3", "5")}


def test_overlong_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a|b\n1|2\n3|4|5\n"6|"|7\n')
    path = str(tmp_path / "a.csv")
    with pytest.raises(Exception, match="more fields"):
        readers.read_delimited(spark, path, "|").collect()
    assert values(readers.read_delimited(spark, path, "|", bad_lines="skip"), "a", "b") == [("1", "2"), ("6|", "7")]
    assert values(readers.read_delimited(spark, path, "|", bad_lines="cut"), "a", "b")[1] == ("3", "4")
    assert [r.n for r in readers.bad_lines_of(spark, path, "|").collect()] == [1]


def test_places_parse_three_columns(spark, tmp_path):
    (tmp_path / "z.csv").write_text("cod_municipio_ibge;municipio;uf;dec1;dec2\n1;A;AC;x;y\n")
    df = readers.zarc_municipios(readers.read_zarc_places(spark, str(tmp_path / "z.csv")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<cod_municipio_ibge:string,municipio:string,uf:string>" in plan
    assert [tuple(r) for r in df.collect()] == [("1", "A", "AC")]


def test_folder_of_plain_and_packed_files(spark, tmp_path):
    (tmp_path / "p.csv").write_text("a;b\n1;2\n")
    (tmp_path / "q.txt").write_bytes(gzip.compress(b"b;a\r\n3;4\r\n"))
    (tmp_path / "r.gz").write_bytes(gzip.compress(b"a;b\n5;6\n"))
    df = readers.read_any_gzip(spark, str(tmp_path))
    assert {(r.a, r.b) for r in df.collect()} == {("1", "2"), ("4", "3"), ("5", "6")}
    assert readers.read_zarc(spark, str(tmp_path), ["soja"]).count() == 0


def test_heads_in_tasks_as_by_the_driver(spark, tmp_path, monkeypatch):
    texts = ["a;b\n1;2\n", "\ufeffa;c\r\n1;2\r\n", "", "\n1;2\n", "só;um", "a;b\n1;2;3\n4;5\n"]
    for i, text in enumerate(texts):
        (tmp_path / f"p {i}+ç%20.csv").write_text(text, encoding="utf-8")
        (tmp_path / f"q{i}.csv").write_bytes(gzip.compress(text.encode("utf-8")))
    files = readers.files_of(spark, str(tmp_path))
    one = readers.heads_of(spark, files)
    monkeypatch.setattr(readers, "DRIVER_HEADS", 0)
    assert readers.heads_of(spark, files) == one and list(one) == files
    assert [h.line for h in one.values()] == 2 * ["a;b", "a;c", None, "", "só;um", "a;b"]
    assert [h.packed for h in one.values()] == 6 * [False] + 6 * [True]
    df = readers.read_delimited(spark, [f for f, h in one.items() if h.line == "a;b"], ";", bad_lines="skip")
    assert sorted((r.a, r.b) for r in df.collect()) == 2 * [("1", "2")] + 2 * [("4", "5")]


def test_bad_lines_of_many_files(spark, tmp_path):
    for i in range(6):
        (tmp_path / f"f {i}+ç%20.csv").write_text("a;b\n" + i * "1;2;3\n" + "1;2\n", encoding="utf-8")
    (tmp_path / "g.csv").write_bytes(gzip.compress(b"a;b;c\n1;2;3\n1;2;3;4\n"))
    (tmp_path / "h.csv").write_text("")
    df = readers.bad_lines_of(spark, str(tmp_path), ";")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan text") == 1  # not one for each file
    files = readers.files_of(spark, str(tmp_path))
    assert {r.file: r.n for r in df.collect()} == {**{files[i]: i for i in range(6)}, files[6]: 1}


def test_places_are_reduced_by_hash_before_they_are_put_in_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("uf;cod_municipio_ibge;municipio;dec1\nMT;1;A;x\nMT;1;B;x\nMT;1;A;y\nAC;2;C;x\n")
    (tmp_path / "b.csv").write_text("cod_municipio_ibge;municipio;uf\n2;D;AC\n1;Z;MT\n;N;AC\n")
    places = readers.zarc_municipios(readers.read_zarc_places(spark, str(tmp_path)))
    assert {tuple(r) for r in places.collect()} == {("1", "A", "MT"), ("2", "C", "AC"), (None, "N", "AC")}
    plan = places._jdf.queryExecution().sparkPlan().toString()
    assert "min(row" in plan and plan.rindex("HashAggregate(keys=[cod_municipio_ibge") > plan.index("SortAggregate")


def test_quoted_fields_of_packed_lines_are_cut_as_csv_reads_them(spark, tmp_path):
    import gzip

    names = "cod_solo;cod_municipio_ibge;municipio;uf;dec1;dec2"
    lines = ['s;1;"A";MT;1;2', 's;2;"B;b";MT;1;2', 's;3;"C ""c""";MT;1;2', 's;4;"";MT;1;2', 's;5;E"e;MT;1;2', '"s";6;" F ";"MT";"x;y";2', 's;7;"G"', 's;8;H;MT;"1";2', '"s;9";9;I;MT;1;2', 's;10;" ";MT;1;2', 's;11;"J\nj";MT;1;2']
    (tmp_path / "p.csv").write_bytes(gzip.compress("\n".join([names, *lines]).encode()))
    (tmp_path / "plain").mkdir()
    (tmp_path / "plain" / "p.csv").write_text("\n".join([names, *lines]))
    cut = readers.read_any_gzip(spark, str(tmp_path / "p.csv"), columns=readers.PLACE_COLUMNS)
    whole = readers.read_any_gzip(spark, str(tmp_path / "p.csv"))
    columns = list(readers.PLACE_COLUMNS)
    assert sorted(map(str, cut.select(columns).collect())) == sorted(map(str, whole.select(columns).collect()))
    assert cut.count() == len(lines)


def test_folders_are_listed_in_few_tasks(spark, tmp_path):
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    with readers._listing(spark):
        assert int(spark.conf.get(name)) <= 4 * spark.sparkContext.defaultParallelism
    for i in range(50):
        (tmp_path / f"code={i:02}").mkdir()
        (tmp_path / f"code={i:02}" / "x.json").write_text('{"daily": {"time": ["2024-01-01"], "precipitation_sum": [1.5]}}')
    got = readers.read_weather_json(spark, f"{tmp_path}/*", r"code=(\d+)/[^/]*$")
    assert spark.conf.get(name) == before and got.select("codigo_ibge").distinct().count() == 50
