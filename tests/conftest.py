import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from agrolume.session import local_session  # noqa: E402
from agrolume.sources.common import open_tables  # noqa: E402
from agrolume.sources.dimensions import load_culturas  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def rows(spark):
    """Rows of dicts as a DataFrame of strings (or of the given schema)."""

    def make(records, schema=None):
        if schema is None:
            names = list(dict.fromkeys(k for r in records for k in r))
            schema = ", ".join(f"`{n}` string" for n in names)
            records = [tuple(r.get(n) for n in names) for r in records]
        return spark.createDataFrame(records, schema)

    return make


@pytest.fixture
def culturas(rows):
    crops = ["soja", "milho", "trigo", "algodão", "cana-de-açúcar"]
    return rows(list(enumerate(crops, 1)), "id_cultura int, nome_padronizado string")


@pytest.fixture
def municipios(rows):
    places = [
        (1, "1200013", "Municipio A", "AC"),
        (2, "1200054", "Municipio B", "AC"),
        (3, "5107925", "Sorriso", "MT"),
        (4, "5107909", "Sinop", "MT"),
    ]
    return rows(places, "id_municipio int, codigo_ibge string, nome string, uf string")


@pytest.fixture
def tables(spark, tmp_path, municipios):
    """Stored tables with the two given dimensions."""
    t = open_tables(spark, str(tmp_path / "star"))
    load_culturas(spark, t["dim_cultura"])
    t["dim_municipio"].insert_if_absent(municipios)
    return t
