"""The fourteen tables: columns, unique keys, references, storage partitioning."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agrolume.functions import int_coerce

STAMP = "data_modificacao"


@dataclass(frozen=True)
class Table:
    """One stored table.

    ``keys`` is the unique key an upsert matches on.  ``partition`` is the SQL
    expression that splits the storage; it must depend on the keys alone, so
    that a row and its later version always meet in one partition.
    """

    name: str
    columns: str
    keys: tuple[str, ...]
    pk: str
    partition: str | None = None
    sort: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    max_length: dict[str, int] = field(default_factory=dict)
    references: tuple[str, ...] = ()

    @property
    def is_fact(self) -> bool:
        return self.name.startswith("fato_")

    @property
    def data_schema(self) -> T.StructType:
        """Declared columns, without surrogate key and load time."""
        return T.StructType.fromDDL(self.columns)

    @property
    def schema(self) -> T.StructType:
        """All stored columns."""
        s = self.data_schema
        if self.is_fact:
            if self.pk not in s.names:
                s = T.StructType([T.StructField(self.pk, T.LongType()), *s.fields])
            s = T.StructType([*s.fields, T.StructField(STAMP, T.TimestampNTZType())])
        return s

    def conform(self, df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
        """Select and cast the declared columns; absent ones become typed nulls."""
        out = []
        for f in self.data_schema:
            if f.name not in df.columns:
                c = F.lit(None).cast(f.dataType)
            elif isinstance(f.dataType, (T.IntegerType, T.LongType)) and isinstance(df.schema[f.name].dataType, T.StringType):
                c = int_coerce(f.name, f.dataType.simpleString())
            else:
                c = F.col(f.name).try_cast(f.dataType)
            out.append(c.alias(f.name))
        return df.select(*out, *extra)




DIM_CULTURA = Table(
    "dim_cultura",
    "id_cultura int, nome_padronizado string",
    keys=("nome_padronizado",),
    pk="id_cultura",
    required=("nome_padronizado",),
)
DIM_MUNICIPIO = Table(
    "dim_municipio",
    "id_municipio int, codigo_ibge string, nome string, uf string",
    keys=("codigo_ibge",),
    pk="id_municipio",
    required=("codigo_ibge", "nome"),
)
DIM_MANTENEDOR = Table(
    "dim_mantenedor",
    "id_mantenedor int, nome string, setor string",
    keys=("nome",),
    pk="id_mantenedor",
    required=("nome",),
)
REGISTRO_CULTIVARES = Table(
    "fato_registro_cultivares",
    "nr_registro bigint, id_cultura int, id_mantenedor int, cultivar string, nome_secundario string, "
    "situacao string, nr_formulario bigint, data_reg timestamp_ntz, data_val timestamp_ntz",
    keys=("nr_registro",),
    pk="nr_registro",
    partition="pmod(xxhash64(nr_registro), 16)",
    sort=("id_cultura",),
    required=("nr_registro", "cultivar"),
    references=("dim_cultura", "dim_mantenedor"),
)
PRODUCAO_PAM = Table(
    "fato_producao_pam",
    "id_cultura int, id_municipio int, ano int, area_plantada_ha double, area_colhida_ha double, "
    "qtde_produzida_ton double, valor_producao_mil_reais double",
    keys=("id_cultura", "id_municipio", "ano"),
    pk="id_producao",
    partition="ano",
    sort=("id_cultura", "id_municipio"),
    required=("ano",),
    references=("dim_cultura", "dim_municipio"),
)
RISCO_ZARC = Table(
    "fato_risco_zarc",
    "id_cultura int, id_municipio int, tipo_solo string, periodo_plantio string, risco_climatico string",
    keys=("id_cultura", "id_municipio", "tipo_solo", "periodo_plantio"),
    pk="id_zarc",
    partition="id_cultura",
    sort=("id_municipio",),
    references=("dim_cultura", "dim_municipio"),
)
PRODUCAO_CONAB = Table(
    "fato_producao_conab",
    "id_cultura int, uf string, ano_agricola string, safra string, area_plantada_mil_ha double, "
    "producao_mil_t double, produtividade_t_ha double",
    keys=("id_cultura", "uf", "ano_agricola", "safra"),
    pk="id_conab",
    partition="ano_agricola",
    sort=("id_cultura", "uf"),
    max_length={"uf": 2, "ano_agricola": 10, "safra": 20},
    references=("dim_cultura",),
)
AGROFIT = Table(
    "fato_agrofit",
    "id_cultura int, nr_registro string, marca_comercial string, ingrediente_ativo string, "
    "titular_registro string, classe string, situacao string, praga_comum string",
    keys=("id_cultura", "nr_registro", "marca_comercial", "praga_comum"),
    pk="id_agrofit",
    partition="id_cultura",
    sort=("classe",),
    max_length={"nr_registro": 20},
    references=("dim_cultura",),
)
PRECOS_MENSAL = Table(
    "fato_precos_conab_mensal",
    "id_cultura int, id_municipio int, uf string, ano int, mes int, valor_kg double, nivel_comercializacao string",
    keys=("id_cultura", "id_municipio", "uf", "ano", "mes", "nivel_comercializacao"),
    pk="id_preco",
    partition="ano",
    sort=("id_cultura", "uf"),
    required=("ano", "mes"),
    max_length={"uf": 2},
    references=("dim_cultura", "dim_municipio"),
)
PRECOS_SEMANAL = Table(
    "fato_precos_conab_semanal",
    "id_cultura int, id_municipio int, uf string, ano int, mes int, semana int, data_referencia string, "
    "valor_kg double, nivel_comercializacao string",
    keys=("id_cultura", "id_municipio", "uf", "ano", "mes", "semana", "nivel_comercializacao"),
    pk="id_preco_semanal",
    partition="ano",
    sort=("id_cultura", "uf"),
    required=("ano", "mes"),
    max_length={"uf": 2},
    references=("dim_cultura", "dim_municipio"),
)
FERTILIZANTES = Table(
    "fato_fertilizantes_estabelecimentos",
    "uf string, municipio string, id_municipio int, nr_registro_estabelecimento string, status_registro string, "
    "cnpj string, razao_social string, nome_fantasia string, area_atuacao string, atividade string, "
    "classificacao string",
    keys=("nr_registro_estabelecimento",),
    pk="id_fertilizante",
    partition="pmod(xxhash64(nr_registro_estabelecimento), 16)",
    sort=("uf",),
    required=("nr_registro_estabelecimento",),
    max_length={"uf": 2},
    references=("dim_municipio",),
)
SEMENTES_PRODUCAO = Table(
    "fato_sigef_producao",
    "id_cultura int, id_municipio int, safra string, especie string, categoria string, cultivar_raw string, "
    "status string, data_plantio timestamp_ntz, data_colheita timestamp_ntz, area_ha double, "
    "producao_bruta_t double, producao_est_t double",
    keys=("id_cultura", "id_municipio", "safra", "especie", "cultivar_raw", "categoria"),
    pk="id_sigef_producao",
    partition="safra",
    sort=("id_cultura", "id_municipio"),
    max_length={"safra": 20},
    references=("dim_cultura", "dim_municipio"),
)
SEMENTES_RESERVA = Table(
    "fato_sigef_reserva_semente",
    "id_cultura int, id_municipio int, tipo_periodo string, periodo string, especie string, cultivar_raw string, "
    "area_total_ha double, area_plantada_ha double, area_estimada_ha double",
    keys=("id_cultura", "id_municipio", "periodo", "especie", "cultivar_raw"),
    pk="id_sigef_reserva",
    partition="periodo",
    sort=("id_cultura", "id_municipio"),
    references=("dim_cultura", "dim_municipio"),
)
METEOROLOGIA = Table(
    "fato_meteorologia",
    "id_municipio int, data timestamp_ntz, precipitacao_total_mm double, temp_max_c double, temp_min_c double, "
    "temp_media_c double, umidade_media double, estacao_id string",
    keys=("id_municipio", "data"),
    pk="id_meteo",
    partition="year(data)",
    sort=("id_municipio", "data"),
    required=("data",),
    max_length={"estacao_id": 50},
    references=("dim_municipio",),
)

TABLES = {
    t.name: t
    for t in (
        DIM_CULTURA, DIM_MUNICIPIO, DIM_MANTENEDOR, REGISTRO_CULTIVARES, PRODUCAO_PAM, RISCO_ZARC,
        PRODUCAO_CONAB, AGROFIT, PRECOS_MENSAL, PRECOS_SEMANAL, FERTILIZANTES, SEMENTES_PRODUCAO,
        SEMENTES_RESERVA, METEOROLOGIA,
    )
}
