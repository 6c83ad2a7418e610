import pytest
from pyspark.sql import functions as F

from agrolume import schema
from agrolume.operators.table import StoredTable, assign_ids, weekly_reset_due

KEYS = ["id_cultura", "id_municipio", "uf", "ano", "mes", "nivel_comercializacao"]
DDL = "id_cultura int, id_municipio int, uf string, ano int, mes int, nivel_comercializacao string, valor_kg double"


def price(ano, municipio, value, mes=1):
    return (1, municipio, "MT", ano, mes, "Produtor", value)


@pytest.fixture
def prices(spark, tmp_path):
    return StoredTable(spark, str(tmp_path / "precos"), schema.PRECOS_MENSAL)


def content(table):
    return sorted(((r.ano, r.id_municipio or 0, r.mes, r.valor_kg) for r in table.read().collect()), key=str)


def test_upsert_twice_gives_the_same_table(rows, prices):
    batch = rows([price(2023, 1, 1.0), price(2023, None, 2.0), price(2024, 1, 3.0)], DDL)
    assert prices.upsert(batch) == 3
    once = content(prices)
    assert prices.upsert(batch) == 3
    assert content(prices) == once == [(2023, 0, 1, 2.0), (2023, 1, 1, 1.0), (2024, 1, 1, 3.0)]


def test_last_row_of_a_batch_wins(rows, prices):
    batch = rows([(*price(2023, 1, v), i) for i, v in enumerate([5.0, 7.0, 6.0])], DDL + ", _seq int")
    assert prices.upsert(batch) == 1
    assert content(prices) == [(2023, 1, 1, 6.0)]


def test_absent_columns_become_null_and_ids_are_stable(rows, prices):
    prices.upsert(rows([price(2023, 1, 5.0)], DDL))
    before = prices.read().first()
    prices.upsert(rows([price(2023, 1, 5.0)], DDL).drop("valor_kg"))
    after = prices.read().first()
    assert (after.valor_kg, after.id_preco) == (None, before.id_preco)
    assert after.data_modificacao >= before.data_modificacao


def test_only_folders_with_a_hit_are_rewritten(rows, prices):
    prices.upsert(rows([price(2022, 1, 1.0), price(2023, 1, 1.0)], DDL))
    prices.upsert(rows([price(2023, 2, 2.0)], DDL))  # no equal key: nothing to rewrite
    state = prices.commit().folders
    assert [len(state[y]) for y in ("2022", "2023")] == [1, 2]
    prices.upsert(rows([price(2023, 1, 9.0)], DDL))
    changed = prices.commit().folders
    assert changed["2022"] == state["2022"]
    assert state["2023"][1] in changed["2023"] and state["2023"][0] not in changed["2023"]
    assert content(prices) == [(2022, 1, 1, 1.0), (2023, 1, 1, 9.0), (2023, 2, 1, 2.0)]


def test_compaction_merges_folders(rows, prices):
    for mes in range(1, 5):
        prices.upsert(rows([price(2023, 1, 1.0, mes), price(2022, 1, 2.0, mes)], DDL))
    before = content(prices)
    assert [len(w) for w in prices.commit().folders.values()] == [4, 4]
    assert prices.compact([2023]) == 1
    assert sorted(len(w) for w in prices.commit().folders.values()) == [1, 4]
    assert prices.compact() == 1 and prices.compact() == 0
    assert content(prices) == before


def test_history_and_parts(rows, prices):
    prices.upsert(rows([price(2022, 1, 1.0)], DDL))
    prices.upsert(rows([price(2023, 1, 2.0)], DDL))
    assert prices.versions() == [1, 2]
    assert prices.read(version=1).count() == 1
    assert [r.ano for r in prices.read(parts=[2023]).collect()] == [2023]
    assert prices.history().count() == 2


def test_a_crash_before_the_commit_changes_nothing(rows, prices, monkeypatch):
    prices.upsert(rows([price(2022, 1, 1.0)], DDL))
    monkeypatch.setattr(prices, "_publish", lambda c: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        prices.upsert(rows([price(2022, 1, 9.0)], DDL))
    monkeypatch.undo()
    assert content(prices) == [(2022, 1, 1, 1.0)]


def test_two_writers_of_one_commit(rows, prices):
    prices.upsert(rows([price(2022, 1, 1.0)], DDL))
    with pytest.raises(RuntimeError):
        prices._publish(prices.commit())


def test_replayed_stream_batch_is_skipped(rows, prices):
    batch = rows([price(2022, 1, 1.0)], DDL)
    assert prices.upsert(batch, stream="s", batch_id=0) == 1
    assert prices.upsert(batch.withColumn("valor_kg", F.lit(9.0)), stream="s", batch_id=0) == 0
    assert content(prices) == [(2022, 1, 1, 1.0)]


def test_empty_batch_and_empty_table(rows, prices):
    assert content(prices) == []
    assert prices.upsert(rows([], DDL)) == 0
    assert content(prices) == []


def test_text_partition_values(rows, spark, tmp_path):
    table = StoredTable(spark, str(tmp_path / "conab"), schema.PRODUCAO_CONAB)
    ddl = "id_cultura int, uf string, ano_agricola string, safra string, producao_mil_t double"
    table.upsert(rows([(1, "MT", "2023/24", "1ª", 1.0), (1, "MT", None, "1ª", 2.0)], ddl))
    table.upsert(rows([(1, "MT", "2023/24", "1ª", 3.0), (1, "MT", None, "1ª", 4.0)], ddl))
    got = {r.ano_agricola: r.producao_mil_t for r in table.read().collect()}
    assert got == {"2023/24": 3.0, None: 4.0}
    assert table.read(parts=["2023/24"]).count() == 1


def test_insert_if_absent_keeps_existing_rows(rows, spark, tmp_path):
    table = StoredTable(spark, str(tmp_path / "mant"), schema.DIM_MANTENEDOR)
    assert table.insert_if_absent(rows([{"nome": "A", "setor": "Privado"}])) == 1
    first = table.read().first()
    assert table.insert_if_absent(rows([{"nome": "A", "setor": "Público"}, {"nome": "B", "setor": None}])) == 1
    got = {r.nome: r for r in table.read().collect()}
    assert got["A"] == first and got["B"].id_mantenedor > first.id_mantenedor


def test_assigned_ids_are_unique_and_repeatable(spark):
    df = spark.range(1000).selectExpr("cast(id as string) AS nome")
    ids = {r.nome: r.i for r in assign_ids(df, ["nome"], "i", start=10).collect()}
    again = {r.nome: r.i for r in assign_ids(df.repartition(7), ["nome"], "i", start=10).collect()}
    assert ids == again and len(set(ids.values())) == 1000 and min(ids.values()) > 10


def test_weekly_reset(rows, spark, tmp_path):
    table = StoredTable(spark, str(tmp_path / "semanal"), schema.PRECOS_SEMANAL)
    ddl = DDL + ", semana int"
    assert not weekly_reset_due(table)
    table.upsert(rows([(*price(2024, 1, 1.0), w) for w in (1, 2, 3)], ddl))
    assert not weekly_reset_due(table)
    table.upsert(rows([(*price(2024, 1, 1.0), 4)], ddl))
    assert weekly_reset_due(table)
    table.upsert(rows([(*price(2024, 1, 1.0), 5)], ddl), replace=True)
    assert [r.semana for r in table.read().collect()] == [5]


def test_filters_on_the_split_column_prune(rows, spark, prices):
    prices.upsert(rows([price(2022, 1, 1.0), price(2023, 1, 2.0), (1, 1, "MT", None, 1, "P", 3.0)], DDL))
    prices.upsert(rows([(1, 1, "MT", None, 1, "P", 4.0)], DDL))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    one = prices.read().where("ano = 2023")
    plan = one._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters: [isnotnull(ano" in plan
    assert [r.valor_kg for r in one.collect()] == [2.0]
    assert [r.valor_kg for r in prices.read().where("ano IS NULL").collect()] == [4.0]
    assert prices.read().columns == schema.PRECOS_MENSAL.schema.names


def test_ids_tell_nulls_apart_and_collisions_stop_a_load(rows, spark, tmp_path, monkeypatch):
    table = StoredTable(spark, str(tmp_path / "agrofit"), schema.AGROFIT)
    ddl = "id_cultura int, nr_registro string, marca_comercial string, praga_comum string"
    both = rows([(1, "9", "A", None), (1, "9", None, "A"), (None, "9", "A", None)], ddl)
    assert table.upsert(both) == 3
    assert table.read().select("id_agrofit").distinct().count() == 3
    monkeypatch.setattr("agrolume.operators.table.surrogate_id", lambda keys: F.lit(7).cast("bigint"))
    with pytest.raises(ValueError, match="two keys"):
        table.upsert(rows([(1, "1", "A", None), (1, "2", "A", None)], ddl))
    assert table.read().count() == 3


def test_empty_and_null_partition_values(rows, spark, tmp_path):
    table = StoredTable(spark, str(tmp_path / "conab"), schema.PRODUCAO_CONAB)
    ddl = "id_cultura int, uf string, ano_agricola string, safra string, producao_mil_t double"
    for value in (1.0, 2.0, 3.0):
        table.upsert(rows([(1, "MT", y, "1ª", value) for y in ("", None, "null", "2023/24")], ddl))
    got = sorted((str(r.ano_agricola), r.producao_mil_t) for r in table.read().collect())
    assert got == [("", 3.0), ("2023/24", 3.0), ("None", 3.0), ("null", 3.0)]
    assert [r.ano_agricola for r in table.read(parts=[""]).collect()] == [""]


def test_insert_if_absent_takes_one_row_per_key(rows, spark, tmp_path):
    table = StoredTable(spark, str(tmp_path / "mant"), schema.DIM_MANTENEDOR)
    assert table.insert_if_absent(rows([{"nome": "A", "setor": "Privado"}, {"nome": "A", "setor": "Público"}])) == 1


def test_a_commit_cut_off_is_passed_over(rows, prices):
    prices.upsert(rows([price(2022, 1, 1.0)], DDL))
    fs, path = prices._fs(f"{prices.root}/commits/00000002.json")
    fs.create(path, False).close()
    assert content(prices) == [(2022, 1, 1, 1.0)]
    prices.upsert(rows([price(2023, 1, 2.0)], DDL))
    assert prices.versions() == [1, 2, 3] and len(content(prices)) == 2


def test_an_id_of_a_stored_row_with_another_key_stops_the_load(rows, prices, monkeypatch):
    monkeypatch.setattr("agrolume.operators.table.surrogate_id", lambda keys: F.lit(7).cast("long"))
    prices.upsert(rows([price(2023, 1, 1.0)], DDL))
    assert prices.upsert(rows([price(2023, 1, 2.0)], DDL)) == 1
    before = prices.commit()
    with pytest.raises(ValueError, match="two keys"):
        prices.upsert(rows([price(2023, 2, 3.0)], DDL))
    assert prices.commit() == before and content(prices) == [(2023, 1, 1, 2.0)]


def test_upsert_reads_the_touched_partitions_once_for_ids_and_folders(rows, prices, monkeypatch):
    prices.upsert(rows([price(2023, 1, 1.0)], DDL))
    loads = []
    load = prices._load
    monkeypatch.setattr(prices, "_load", lambda folders: loads.append(folders) or load(folders))
    prices.upsert(rows([price(2023, 2, 2.0)], DDL))
    assert len(loads) == 2  # what was written, and the touched partitions


def test_a_table_whose_key_is_its_id_is_updated(spark, tmp_path):
    table = StoredTable(spark, str(tmp_path / "cultivar"), schema.REGISTRO_CULTIVARES)
    assert table.table.keys == (table.table.pk,)
    ddl = "nr_registro bigint, cultivar string"
    for name in ("A", "B"):
        table.upsert(spark.createDataFrame([(9, name)], ddl))
    assert [r.cultivar for r in table.read().collect()] == ["B"]


def test_a_folder_that_a_batch_brings_again_as_a_whole_is_not_rewritten(rows, prices, monkeypatch):
    made = [{"id_cultura": i, "id_municipio": i, "uf": "MT", "ano": 2024, "mes": 1, "nivel_comercializacao": "P", "valor_kg": float(i)} for i in range(6)]
    batch = rows([tuple(r.values()) for r in made], "id_cultura int, id_municipio int, uf string, ano int, mes int, nivel_comercializacao string, valor_kg double")
    prices.upsert(batch)
    writes, write = [], prices._write
    monkeypatch.setattr(prices, "_write", lambda df: writes.append(df) or write(df))
    prices.upsert(batch)
    assert len(writes) == 1 and prices.read().count() == 6
    prices.upsert(batch.where("id_cultura < 2").withColumn("valor_kg", F.lit(9.0)))
    assert len(writes) == 3
    assert sorted(r.valor_kg for r in prices.read().collect()) == [2, 3, 4, 5, 9, 9]


def test_a_batch_without_order_is_aggregated_as_one_struct(rows):
    from agrolume.operators.dedupe import keep_first, keep_last

    df = rows([(1, "b", 2, None), (1, "a", 3, 4.0), (1, "b", 2, 5.0), (None, None, 1, 1.0), (None, "z", 0, 1.0)], "k int, z string, a int, m double")
    assert {tuple(r) for r in keep_last(df, ["k"]).collect()} == {(1, "a", 3, 4.0), (None, None, 1, 1.0)}
    assert {tuple(r) for r in keep_first(df, ["k"]).collect()} == {(1, "b", 2, None), (None, "z", 0, 1.0)}
    assert "max_by" not in keep_last(df, ["k"])._jdf.queryExecution().toString()
