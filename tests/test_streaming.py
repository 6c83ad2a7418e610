import pytest
from pyspark.sql import functions as F

from agrolume.sources import readers, zarc
from agrolume.streaming import file_stream, stream_prices, stream_zarc
from agrolume.streaming.loads import query_id

HEAD = "cod_municipio_ibge;cultura_raw;cod_solo;dec1;dec2\n"
DDL = "cod_municipio_ibge string, cultura_raw string, cod_solo string, dec1 string, dec2 string"


def content(table):
    return sorted(tuple(r) for r in table.read().drop("id_zarc", "data_modificacao").collect())


def test_stream_equals_batch_and_later_files_win(spark, tables, municipios, culturas, tmp_path):
    raw = tmp_path / "in"
    raw.mkdir()
    for i in range(4):
        (raw / f"f{i}.csv").write_text(HEAD + f"1200013;Soja;1;{i}0%;\n5107925;Milho;1;{i}1%;x\n1200013;Soja;1;{i}5%;\n")

    def run(n):
        source = file_stream(spark, str(raw), DDL, sep=";", header=True, maxFilesPerTrigger=n)
        query = stream_zarc(source, tables, str(tmp_path / "checkpoint"))
        query.awaitTermination()
        return query

    run(2)
    got = content(tables["fato_risco_zarc"])
    assert tables["fato_risco_zarc"].commit().streams == {query_id(spark, str(tmp_path / "checkpoint")): 1}
    batch = zarc.fact(zarc.clean(readers.read_delimited(spark, str(raw), ";")), culturas, municipios)
    tables["fato_risco_zarc"].upsert(batch, replace=True)
    assert content(tables["fato_risco_zarc"]) == got
    assert {r[4] for r in got} == {"35%", "31%", "x"}

    # Only new files are read by the next run.
    (raw / "f9.csv").write_text(HEAD + "1200054;Soja;2;20%;\n")
    run(2)
    assert len(content(tables["fato_risco_zarc"])) == len(got) + 1
    assert tables["fato_risco_zarc"].commit().streams == {query_id(spark, str(tmp_path / "checkpoint")): 2}


def test_weekly_stream_resets_once_per_run(spark, tables, tmp_path):
    ddl = "produto string, uf string, ano string, mes string, semana string, valor_produto_kg string, dsc_nivel_comercializacao string"
    raw = tmp_path / "in"
    raw.mkdir()

    def put(*weeks):
        for w in weeks:
            (raw / f"w{w}.csv").write_text(",".join(c.split()[0] for c in ddl.split(", ")) + f'\nSoja,MT,2024,1,{w},"1,5",P\n')
        source = file_stream(spark, str(raw), ddl, header=True, maxFilesPerTrigger=1)
        stream_prices(source, tables, str(tmp_path / "checkpoint")).awaitTermination()
        return sorted(r.semana for r in tables["fato_precos_conab_semanal"].read().collect())

    assert put(1, 2, 3, 4, 5) == [1, 2, 3, 4, 5]
    assert put(6, 7) == [6, 7]
    assert put(8) == [6, 7, 8]
    assert tables["fato_precos_conab_semanal"].read().select(F.sum("valor_kg")).first()[0] == 4.5


WEEKLY = "produto string, uf string, ano string, mes string, semana string, valor_produto_kg string, dsc_nivel_comercializacao string"


def put_week(folder, week):
    head = ",".join(c.split()[0] for c in WEEKLY.split(", "))
    (folder / f"w{week}.csv").write_text(head + f'\nSoja,MT,2024,1,{week},"1,5",P\n')


@pytest.mark.parametrize("stored", [0, 4])
def test_an_interrupted_weekly_run_loses_nothing(spark, tables, tmp_path, monkeypatch, stored):
    table = tables["fato_precos_conab_semanal"]
    old, raw = tmp_path / "old", tmp_path / "in"

    def run(folder):
        source = file_stream(spark, str(folder), WEEKLY, header=True, maxFilesPerTrigger=1)
        stream_prices(source, tables, str(tmp_path / f"checkpoint-{folder.name}")).awaitTermination()

    for folder, weeks in ((old, range(40, 40 + stored)), (raw, range(1, 7))):
        folder.mkdir()
        for w in weeks:
            put_week(folder, w)
    if stored:
        run(old)
    upsert, calls = type(table).upsert, []

    def failing(self, *args, **kwargs):
        calls.append(1)
        if len(calls) == 5:
            raise RuntimeError("lost")
        return upsert(self, *args, **kwargs)

    monkeypatch.setattr(type(table), "upsert", failing)
    with pytest.raises(Exception, match="lost"):
        run(raw)
    monkeypatch.undo()
    assert len(table.read().collect()) == 4
    run(raw)
    assert sorted(r.semana for r in table.read().collect()) == [1, 2, 3, 4, 5, 6]
    assert table.commit().runs == {}


def test_a_new_checkpoint_reads_everything_again(spark, tables, tmp_path):
    raw = tmp_path / "in"
    raw.mkdir()
    for i in range(3):
        (raw / f"f{i}.csv").write_text(HEAD + f"1200013;Soja;{i};10%;\n")
    for name in ("first", "second"):
        source = file_stream(spark, str(raw), DDL, sep=";", header=True, maxFilesPerTrigger=1)
        stream_zarc(source, tables, str(tmp_path / name)).awaitTermination()
        got = len(content(tables["fato_risco_zarc"]))
        assert got == 3
        tables["fato_risco_zarc"].upsert(tables["fato_risco_zarc"].read().limit(0), replace=True)
