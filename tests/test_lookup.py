import random
import unicodedata

import pytest

from agrolume.operators import lookup

CROPS = [(1, "soja"), (2, "milho"), (3, "cana-de-açúcar"), (4, "algodão"), (5, "trigo mourisco"), (6, "milho doce")]


def plain_crop(name, crops, strict=False):
    """The rule, one name at a time."""

    def norm(s):
        s = unicodedata.normalize("NFKD", s.lower().strip())
        return "".join(c for c in s if unicodedata.category(c) != "Mn").replace("-", " ").replace("_", " ")

    if not name:
        return None
    for cid, crop in crops:
        if name == crop:
            return cid
    text = norm(name)
    for synonym, crop in lookup.CROP_SYNONYMS.items():
        if synonym in text:
            text = crop if strict else norm(crop)
            break
    for cid, crop in crops:
        if f" {norm(crop)} " in f" {text} " or f" {text} " in f" {norm(crop)} ":
            return cid
    return None


def names():
    fixed = [
        "soja", "SOJA", "Cana de Acucar", "Milho Verdin", "Arroz", "de", "cana", "Saccharum officinarum", "milho doce",
        "Glycine max (L.)", "strigosa", "", None, " ", "milho  doce", "trigo", "Zea mays Glycine max", "aveia", "#2",
        "Avena sativa", "cana-de-açúcar", "CANA_DE_AÇÚCAR",
    ]
    rng = random.Random(7)
    words = ["soja", "Milho", "cana", "de", "açúcar", "-", "trigo", "mourisco", "doce", "zea mays", "x", "algodão", ""]
    return fixed + [rng.choice([" ", "-", "_"]).join(rng.choices(words, k=rng.randint(1, 4))) for _ in range(400)]


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("resolve", [lookup.resolve_cultura, lookup.resolve_cultura_by_words])
def test_resolve_cultura(rows, strict, resolve):
    crops = rows(CROPS, "id_cultura int, nome_padronizado string")
    df = rows([(i, n) for i, n in enumerate(names())], "i int, nome string")
    found = resolve(df, "nome", crops, strict_reference=strict)
    got = {r.nome: r.id_cultura for r in found.collect()}
    assert got == {n: plain_crop(n, CROPS, strict) for n in names()}


def test_default_crops(rows, culturas):
    df = rows([{"nome": n} for n in ("Saccharum", "Avena sativa", "Algodao", "strigosa")])
    got = {r.nome: r.id_cultura for r in lookup.resolve_cultura(df, "nome", culturas).collect()}
    assert got == {"Saccharum": 5, "Avena sativa": None, "Algodao": 4, "strigosa": None}


def test_no_crops(rows, culturas):
    df = lookup.resolve_cultura(rows([{"nome": "soja"}]), "nome", culturas.limit(0))
    assert df.first().id_cultura is None


def test_municipio_by_code(rows, municipios):
    df = rows([{"cod_municipio_ibge": c} for c in ("1200013", "1200013.0", "99", None)])
    got = [(r.cod_municipio_ibge, r.id_municipio) for r in lookup.resolve_municipio_by_code(df, municipios).collect()]
    assert sorted(got, key=str) == [("1200013", 1), ("1200013.0", 1), ("99", None), (None, None)]


def test_municipio_by_name(rows, municipios):
    twice = municipios.union(rows([(9, "9", "SORRISO", "MT")], municipios.schema))
    df = rows(
        [
            {"municipio": " sorriso ", "uf": "mt"},
            {"municipio": "Municipio A", "uf": "AC "},
            {"municipio": "Municipio A", "uf": None},
            {"municipio": "Município A", "uf": "AC"},
        ]
    )
    got = {(r.municipio, r.uf): r.id_municipio for r in lookup.resolve_municipio_by_name(df, twice).collect()}
    assert got == {
        (" sorriso ", "mt"): 9,
        ("Municipio A", "AC "): None,
        ("Municipio A", None): None,
        ("Município A", "AC"): None,
    }


def test_coordinates(rows, municipios):
    coords = rows([(5107925, 1.0, 2.0), (1200013, 3.0, 4.0)], "codigo_ibge long, latitude double, longitude double")
    got = lookup.municipios_with_coordinates(municipios, coords).collect()
    assert {(r.id_municipio, r.latitude) for r in got} == {(1, 3.0), (3, 1.0)}
    assert lookup.municipios_with_coordinates(municipios, coords, limit=1).count() == 1


@pytest.mark.parametrize("resolve", [lookup.resolve_cultura, lookup.resolve_cultura_by_words])
def test_repeated_and_null_crop_names(rows, resolve):
    crops = rows([(5, "soja"), (2, "soja"), (1, None), (3, "milho")], "id_cultura int, nome_padronizado string")
    df = rows([{"nome": n} for n in ("soja", "Milho doce", None)])
    assert {r.nome: r.id_cultura for r in resolve(df, "nome", crops).collect()} == {"soja": 2, "Milho doce": 3, None: None}


def test_long_list(rows):
    """Thousands of crops of few words, long names among them, against the plain rule."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(400)] + ["de", "da", "do"]
    text = lambda low, high: " ".join(rng.choices(words + ["de"] * 200, k=rng.randint(low, high)))
    crops = list(enumerate(dict.fromkeys(text(1, 4) for _ in range(5500)), 1))
    asked = [text(1, 6) for _ in range(300)] + [text(200, 300), crops[-1][1], "de", "  ", "w1  w2"]
    df = rows([(n,) for n in asked], "nome string")
    got = lookup.resolve_cultura_by_words(df, "nome", rows(crops, "id_cultura int, nome_padronizado string"))
    assert {r.nome: r.id_cultura for r in got.collect()} == {n: plain_crop(n, crops) for n in asked}


def test_texts_within_emits_words_not_runs(rows):
    name = " ".join(f"w{i}" for i in range(2000))
    outer, inner = rows([(name,)], "o string"), rows([("w7 w8",), ("w8 w7",), ("x w8",), (name,)], "i string")
    assert lookup._words(outer, "o").count() == 2000
    assert {r.i for r in lookup.texts_within(inner, outer, "i", "o").collect()} == {"w7 w8", name}


@pytest.mark.parametrize("common", [1, 2, 10_000])
def test_common_words_are_looked_up_apart(rows, monkeypatch, common):
    monkeypatch.setattr(lookup, "COMMON", common)
    inner = ["a", "a b", "b c", "x", "a x", "", "c a"]
    outer = ["a b c", "b a", "c a b", "x y", "a", ""]
    pairs = lookup.texts_within(rows([(t,) for t in inner], "i string"), rows([(t,) for t in outer], "o string"), "i", "o")
    assert sorted(map(tuple, pairs.collect())) == sorted((i, o) for i in inner for o in outer if f" {i} " in f" {o} ")
