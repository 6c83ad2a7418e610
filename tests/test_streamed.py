"""Files streamed from their start: packing, quoted breaks, JSON lists, folders, flat memory."""

import gzip
import io
import json
import resource

import pytest
from pyspark.sql import functions as F

from agrolume.sources import readers, streamed
from agrolume.streaming import stream_chunks, stream_zarc_files
from agrolume.streaming.loads import MOST_CHUNKS, query_id


def text(value):
    return io.StringIO(value, newline="\n")


def test_records_join_lines_inside_quotes():
    raw = 'a;b\r\n1;"x\ny"\n5" pipe;z\n"q""\nr";2\n"a;""b"";c\n";t\n;" s\n"\nlast'
    want = ["a;b", '1;"x\ny"', '5" pipe;z', '"q""\nr";2', '"a;""b"";c\n";t', ';" s\n"', "last"]
    assert list(streamed.records(text(raw), ";")) == want
    assert list(streamed.records(text(""), ";")) == []


def test_a_stray_quote_is_told(monkeypatch):
    monkeypatch.setattr(streamed, "OPEN_CHARS", 50)
    with pytest.raises(ValueError, match="stays open"):
        list(streamed.records(text('"x\n' + "line\n" * 40), ";"))


@pytest.mark.parametrize("size", [1, 3, 1 << 20])
def test_elements_of_json_lists(monkeypatch, size):
    monkeypatch.setattr(streamed, "READ_CHARS", size)
    parts = [{"a": "]},[", "b": [1, {"c": "\\\""}]}, 12.5, None, "x\"y", {}, [], -3e5, True]
    for blank in ("", " \n"):
        raw = "\ufeff[" + f"{blank},{blank}".join(map(json.dumps, parts)) + f"{blank}]{blank}"
        assert [json.loads(e) for e in streamed.elements(text(raw))] == parts
    assert list(streamed.elements(text('{"erro": 1}'))) == list(streamed.elements(text("[]"))) == list(streamed.elements(text(""))) == []
    for bad in ('[{"a":1}', '[{"a":1},', "[1", '[{"a" 1}]'):
        with pytest.raises(ValueError):
            list(streamed.elements(text(bad)))


def values(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.orderBy("_seq").collect()]


def test_packed_registers_under_any_name(spark, tmp_path):
    inner = tmp_path / "a" / "b"
    inner.mkdir(parents=True)
    (inner / "x.csv").write_bytes(gzip.compress('NR_REGISTRO;MARCA;praga comum\r\n1;"A\nB";x\r\n2;C;y;z;w\r\n3;D\r\n'.encode()))
    (inner / "_SUCCESS").write_text("")
    df = readers.read_agrofit(spark, str(tmp_path))
    assert values(df, "NR_REGISTRO", "MARCA", "praga comum") == [("1", "A\nB", "x"), ("3", "D", None)]
    latin = gzip.compress("produto;uf\n  Algodão ;MT\n".encode("latin1"))
    (tmp_path / "PrecosMensalUF.txt").write_bytes(latin + gzip.compress("Pêra;SP\n".encode("latin1")))  # two members
    (tmp_path / "LevantamentoGraos.txt").write_bytes(latin[:20])
    failed = {}
    with pytest.warns(UserWarning, match="producao_estimativa"):
        data = readers.read_conab_folder(spark, str(tmp_path), failed)
    assert [r.produto for r in data["precos_uf_mensal"].orderBy("_seq").collect()] == ["Algodão ", "Pêra"]
    assert list(data) == ["precos_uf_mensal"] and list(failed) == ["producao_estimativa"]
    with pytest.raises(Exception, match="more fields"):
        (tmp_path / "c.csv").write_bytes(gzip.compress(b"a,b\n1,2,3\n"))
        readers.read_cultivares(spark, str(tmp_path / "c.csv")).collect()


def test_a_folder_without_files_is_an_error(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    with pytest.raises(FileNotFoundError):
        readers.read_delimited(spark, str(tmp_path))
    (tmp_path / "a" / "b" / "f.csv").write_text("x\n1\n")
    assert readers.read_delimited(spark, str(tmp_path)).count() == 1


def test_a_broken_gzip_file_stops_its_read(spark, tmp_path):
    whole = gzip.compress("a;b\n".encode() + b"1;2\n" * 200_000)
    (tmp_path / "f.csv").write_bytes(whole[: len(whole) // 2])
    with pytest.raises(Exception, match="end-of-stream|EOFError"):
        readers.read_any_gzip(spark, str(tmp_path / "f.csv")).count()


def test_file_systems_only_spark_knows(spark, tmp_path, monkeypatch):
    (tmp_path / "f.csv").write_bytes(gzip.compress(b'a;b\n1;"x\ny"\n'))
    monkeypatch.setattr(streamed, "reachable", lambda path: False)
    assert values(readers.read_any_gzip(spark, str(tmp_path / "f.csv")), "a", "b") == [("1", "x\ny")]


def test_three_columns_of_many_cost_little(spark, tmp_path):
    names = ["cod_solo", *readers.PLACE_COLUMNS, *(f"dec{i}" for i in range(1, 37))]
    row = ";".join(["1", "{}", '"São; X"', "MT", *["20%"] * 36])
    for name, end in (("plain", ""), ("packed", "")):
        lines = "\n".join([";".join(names), *(row.format(i) + end for i in range(20_000))]) + "\n"
        (tmp_path / f"{name}.csv").write_bytes(gzip.compress(lines.encode()) if name == "packed" else lines.encode())
    for name in ("plain", "packed"):
        df = readers.read_zarc_places(spark, str(tmp_path / f"{name}.csv"))
        assert set(df.columns) == {*readers.PLACE_COLUMNS, "_seq"}
        assert df.agg(F.count_distinct("cod_municipio_ibge"), F.min("municipio"), F.max("uf")).first()[:] == (20_000, "São; X", "MT")
    bare = (tmp_path / "packed.csv").read_bytes()
    (tmp_path / "bare.csv").write_bytes(gzip.compress(gzip.decompress(bare).replace(b'"S\xc3\xa3o; X"', b"Sinop")))
    plan = readers.read_zarc_places(spark, str(tmp_path / "bare.csv"))._jdf.queryExecution().optimizedPlan().toString()
    assert "split(value" in plan and ", 5)" in plan  # the fifth piece holds the other 36 columns


def test_pam_payload_of_any_size(spark, tmp_path):
    record = lambda i: {"D1C": f"{i:07d}", "D1N": "A, [x]", "D2N": "Área", "D3N": "2022", "V": "..." if i % 5 == 0 else i, "MC": "x"}
    (tmp_path / "pam_soja.json").write_text(json.dumps([record(-1), *map(record, range(50_000))]))
    (tmp_path / "pam_milho.json").write_bytes(gzip.compress(json.dumps([record(0), record(7)]).encode()))
    df = readers.read_pam_long(spark, str(tmp_path))
    got = df.groupBy("cultura_raw").agg(F.count("*"), F.count_distinct("D1C"), F.max(F.col("V").try_cast("int"))).collect()
    assert {tuple(r) for r in got} == {("soja", 50_000, 50_000, 49_999), ("milho", 1, 1, 7)}


def test_memory_stays_flat(tmp_path):
    """A file of 300 MB unpacked goes by in batches of a few megabytes."""
    path = tmp_path / "big.csv"
    with gzip.open(path, "wb", compresslevel=1) as out:
        block = b"".join(b"%d;Soja;1200013;20%%;30%%\n" % i for i in range(40_000))
        for _ in range(300):
            out.write(block)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    found = streamed.batches("f", streamed._opened(str(path)), "records", ";", "UTF-8")
    assert sum(b.num_rows for b in found) == 12_000_000
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 100_000  # KB


HEAD = "cod_municipio_ibge;cultura_raw;cod_solo;dec1;dec2\n"


def test_chunks_resume_inside_a_file(spark, tables, tmp_path):
    raw = tmp_path / "in"
    raw.mkdir()
    places = ("1200013", "1200054", "5107925", "5107909")
    lines = [f"{places[i % 4]};Soja;{i % 50};{i % 90}%;\n" for i in range(1_000)]
    (raw / "a.csv").write_bytes(gzip.compress((HEAD + "".join(lines)).encode()))
    (raw / "b.csv").write_text("dec1;cod_solo;cod_municipio_ibge;Nome_cultura\n" + "".join(f"{i}%;{i};1200013;Milho\n" for i in range(30)))
    table, calls, checkpoint = tables["fato_risco_zarc"], [], str(tmp_path / "checkpoint")
    upsert = table.upsert

    def failing(*args, **kwargs):
        calls.append(kwargs["batch_id"])
        if len(calls) == 3:
            raise RuntimeError("lost")
        return upsert(*args, **kwargs)

    table.upsert = failing
    with pytest.raises(Exception, match="lost"):
        stream_zarc_files(spark, str(raw), tables, checkpoint, rows=300).awaitTermination()
    stored = dict(table.commit().streams)
    stream_zarc_files(spark, str(raw), tables, checkpoint, rows=300).awaitTermination()
    assert calls[2] == calls[3] and len(set(calls)) == len(calls) - 1  # the lost chunk again, no other
    assert stored == {query_id(spark, checkpoint): calls[1]}
    got = {(r.id_cultura, r.id_municipio, r.tipo_solo): r.risco_climatico for r in table.read().collect()}
    want = {}
    for i in range(1_000):
        want[1, i % 4 + 1, str(i % 50)] = f"{i % 90}%"  # a later row wins
    want |= {(2, 1, str(i)): f"{i}%" for i in range(30)}
    assert got == want
    assert table.commit().streams[query_id(spark, checkpoint)] % MOST_CHUNKS == MOST_CHUNKS - 1
    # Only new files are read by the next run, and nothing stays landed.
    (raw / "c.csv").write_text(HEAD + "1200054;Trigo;2;20%;\n")
    stream_zarc_files(spark, str(raw), tables, checkpoint, rows=300).awaitTermination()
    assert table.read().count() == len(want) + 1
    assert list((tmp_path / "checkpoint-landed").iterdir()) == []


def test_an_empty_stream_folder(spark, tables, tmp_path):
    (tmp_path / "in").mkdir()
    read = lambda spark, files: readers.read_zarc_files(spark, files)
    stream_chunks(spark, str(tmp_path / "in"), tables["fato_risco_zarc"], read, lambda b: b, str(tmp_path / "c"), "none").awaitTermination()
    assert tables["fato_risco_zarc"].read().count() == 0


def test_many_small_files_share_a_task_and_are_not_sent_with_each(spark, tmp_path):
    import json
    import pickle

    from agrolume.sources import streamed as module

    paths = []
    for i in range(200):
        (tmp_path / f"f{i}.txt").write_text("x" * (1 if i else 40 << 20) + f"\n{i}")
        paths.append(f"file:{tmp_path}/f{i}.txt")
    dealt = module.packed(paths, 16)
    assert [p for part in dealt for p in part] == paths
    assert len(dealt) <= 34 and dealt[0] == paths[:1]
    source = module.StreamedFiles({"paths": json.dumps(paths), "parts": "16", "kind": "lines", "sep": ";", "encoding": "UTF-8"})
    reader = source.reader(None)
    assert len(pickle.dumps(reader)) < 1000 and not source.options
    assert [p.value for p in reader.partitions()] == dealt
    got = module.streamed(spark, paths)
    assert got.rdd.getNumPartitions() < 100
    assert {(r.file, r.value) for r in got.where("row = 1").collect()} == {(p, str(i)) for i, p in enumerate(paths)}
