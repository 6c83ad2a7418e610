"""Names and codes to dimension ids.

Dimensions carry no hints: a stored one is a Parquet scan whose size Spark knows, so a
small one is broadcast and facts stay where they are; a larger one sort-merges, and
adaptive execution splits hot keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrolume.functions import code7, fold_crop, strip
from agrolume.functions.text import fold_text
from agrolume.operators.dedupe import keep_first
from agrolume.session import scratch_dir

# Scientific name found in a text, and the crop it stands for.
CROP_SYNONYMS = {
    "glycine max": "soja",
    "zea mays": "milho",
    "triticum aestivum": "trigo",
    "gossypium hirsutum": "algodao",
    "avena strigosa": "aveia",
    "avena sativa": "aveia",
    "saccharum": "cana-de-acucar",
}
# The crops loaded by default, in order.
TARGET_CROPS = ("soja", "milho", "trigo", "algodão", "cana-de-açúcar")

def _crop_words(value: str) -> str:
    return fold_text(value).replace("-", " ").replace("_", " ")


def _canonical(folded: Column, strict_reference: bool) -> Column:
    """Folded name, replaced as a whole by the first synonym it contains."""
    cases = [
        F.when(F.contains(folded, F.lit(text)), crop) for text, crop in _synonyms(strict_reference).items()
    ]
    return F.coalesce(*cases, folded)


def _synonyms(strict_reference: bool) -> dict[str, str]:
    """With ``strict_reference`` the replacement keeps its hyphens, which leaves
    sugar cane unresolved; by default it is folded like any name."""
    return CROP_SYNONYMS if strict_reference else {k: _crop_words(v) for k, v in CROP_SYNONYMS.items()}


def resolve_cultura(
    df: DataFrame,
    name: str,
    culturas: DataFrame,
    order_by: str = "id_cultura",
    strict_reference: bool = False,
    folded: bool = False,
) -> DataFrame:
    """Add ``id_cultura`` for the crop named in ``name``.

    An exact match wins.  Otherwise the first crop (by ``order_by``) whose words
    occur in the name, or in whose words the name occurs.  Null when none does.
    ``folded`` tells that ``name`` went through ``fold`` already.

    The crop list becomes one expression, so facts are not shuffled; its cost per
    row grows with the list.  ``resolve_cultura_by_words`` gives the same answer
    for lists of thousands.  Crops without a name are passed over; of a repeated
    name the first counts.
    """
    crops = culturas.where("nome_padronizado IS NOT NULL").select("id_cultura", "nome_padronizado", order_by)
    targets = [(r["id_cultura"], r["nome_padronizado"]) for r in crops.orderBy(order_by, "id_cultura").collect()]
    if not targets:
        return df.withColumn("id_cultura", F.lit(None).cast("int"))

    raw, padded = F.col(f"`{name}`"), F.col("_crop")
    words = [(cid, f" {_crop_words(nome)} ") for cid, nome in targets]

    def first_match(value: str) -> int | None:
        return next((cid for cid, w in words if w in f" {value} " or f" {value} " in w), None)

    # A synonym decides alone, also when its crop is not among the targets.
    cases = [
        (F.contains(padded, F.lit(text)), first_match(crop)) for text, crop in _synonyms(strict_reference).items()
    ]
    cases += [(F.contains(padded, F.lit(w)) | F.contains(F.lit(w), padded), cid) for cid, w in words]
    found = reduce(lambda case, c: case.when(c[0], F.lit(c[1])), cases[1:], F.when(cases[0][0], F.lit(cases[0][1])))
    by_name = {nome: cid for cid, nome in reversed(targets)}
    exact = F.element_at(F.create_map(*[F.lit(x) for item in by_name.items() for x in item]), raw)

    # One-element explode: the folded name becomes a column computed once per row.
    # As a plain expression, a filter on the id would carry copies of it to the scan.
    text = F.translate(raw, "-_", "  ") if folded else fold_crop(raw)
    padding = F.concat(F.lit(" "), text, F.lit(" "))
    named = df.select("*", F.explode(F.array(padding)).alias("_crop"))
    return named.withColumn("id_cultura", F.when(raw != "", F.coalesce(exact, found)).cast("int")).drop("_crop")


def _stored(df: DataFrame, purpose: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Texts that hold a word from which it counts as common.
COMMON = 10_000


def _words(texts: DataFrame, text: str) -> DataFrame:
    """A row per different word of each text: (_text, _word), both as hashes."""
    return texts.select(F.xxhash64(text).alias("_text"), F.explode(F.array_distinct(F.split(text, " "))).alias("_word")).select(
        "_text", F.xxhash64("_word").alias("_word")
    )


def texts_within(inner: DataFrame, outer: DataFrame, inside: str, around: str) -> DataFrame:
    """Pairs of texts (column ``inside`` of the one, ``around`` of the other) of which
    the first's words stand in a row within the second.

    A text that lies within another shares all of its words with it, so each is
    looked up by the one word that the fewest of the others hold, and confirmed on the
    texts.  Keys grow with the words, and carry hashes instead of texts and words; a hash
    that two share only proposes a pair more.  Common words are few and stored apart, so
    their rows are not dealt by word, but for those words that are the rarest of some text.
    Both sides are expected without repeats.
    """
    held = _words(outer, around).withColumnRenamed("_text", "_outer")
    asked = _words(inner, inside).withColumnRenamed("_text", "_inner")
    counts = held.groupBy("_word").agg(F.count("*").alias("_n"))
    common = _stored(counts.where(F.col("_n") >= COMMON), "common-words")
    seldom = asked.join(common, "_word", "left_anti").join(counts, "_word", "left").select("_inner", "_word", F.coalesce("_n", F.lit(0)).alias("_n"))
    known = seldom.unionByName(asked.join(common, "_word"))
    # Long values, so that this aggregates by hash.
    rarest = known.groupBy("_inner").agg(F.min_by("_word", "_n").alias("_word"), F.min("_n").alias("_n"))
    # A word that no other text holds settles that there is no pair.
    rarest = _stored(rarest.where("_n > 0"), "rarest-words")
    used = _stored(rarest.where(F.col("_n") >= COMMON).select("_word").distinct(), "common-words-used")
    of = lambda rows, words: words.join(rows, "_word").select("_inner", "_outer")
    pairs = of(rarest.where(F.col("_n") < COMMON), held.join(common, "_word", "left_anti"))
    pairs = pairs.union(of(rarest.where(F.col("_n") >= COMMON), held.join(used, "_word", "left_semi")))
    pairs = pairs.join(inner.select(inside, F.xxhash64(inside).alias("_inner")), "_inner")
    pairs = pairs.join(outer.select(around, F.xxhash64(around).alias("_outer")), "_outer")
    padded = [F.concat(F.lit(" "), c, F.lit(" ")) for c in (around, inside)]
    return pairs.where(F.contains(*padded)).select(inside, around)


def resolve_cultura_by_words(
    df: DataFrame, name: str, culturas: DataFrame, order_by: str = "id_cultura", strict_reference: bool = False
) -> DataFrame:
    """``resolve_cultura`` through equi-joins over the distinct names, for long crop lists.

    The distinct names and the crops are folded once, into the shared scratch folder, when
    this is called; the rows of ``df`` are joined when the result is used.
    Crops within a name and names within a crop are found by ``texts_within``, so the
    cost grows with the words of both lists and the pairs that share a rare word.
    """
    key = F.col(f"`{name}`")
    names = df.where(key != "").select(key.alias("_name")).distinct()
    # Exploding one element keeps the long folding expression a column of its own, once.
    names = names.select("_name", F.explode(F.array(fold_crop("_name"))).alias("_folded"))
    names = _stored(names.select("_name", _canonical(F.col("_folded"), strict_reference).alias("_crop")), "names")
    crops = culturas.where("nome_padronizado IS NOT NULL").select(
        "nome_padronizado",
        F.explode(F.array(fold_crop("nome_padronizado"))).alias("_target"),
        F.struct(F.col(order_by).alias("ord"), F.col("id_cultura").alias("id")).alias("_place"),
    )
    crops = _stored(crops, "crops")
    exact = crops.groupBy(F.col("nome_padronizado").alias("_name")).agg(F.min("_place").alias("_exact"))
    targets = crops.groupBy("_target").agg(F.min("_place").alias("_place"))
    texts, asked = names.select("_crop").distinct(), targets.select("_target")
    found = texts_within(asked, texts, "_target", "_crop").unionByName(texts_within(texts, asked, "_crop", "_target"))
    first = found.join(targets, "_target").groupBy("_crop").agg(F.min("_place").alias("_found"))
    chosen = names.join(exact, "_name", "left").join(first, "_crop", "left")
    chosen = chosen.select("_name", F.coalesce("_exact", "_found")["id"].alias("id_cultura"))
    return df.join(chosen, key == F.col("_name"), "left").drop("_name")


def resolve_municipio_by_code(df: DataFrame, municipios: DataFrame, code: str = "cod_municipio_ibge") -> DataFrame:
    """Add ``id_municipio`` by the first seven characters of the code; null if unknown."""
    dim = municipios.select(F.col("codigo_ibge").alias("_code"), "id_municipio")
    return df.join(dim, code7(code) == F.col("_code"), "left").drop("_code")


def resolve_municipio_by_name(df: DataFrame, municipios: DataFrame) -> DataFrame:
    """Add ``id_municipio`` by (municipio, uf): lower case, stripped, accents kept.

    Two municipalities of one name in a state resolve to the higher id.
    """
    dim = (
        municipios.where(F.col("uf").isNotNull() & F.col("nome").isNotNull())
        .groupBy(strip(F.lower("nome")).alias("_nome"), F.col("uf").alias("_uf"))
        .agg(F.max("id_municipio").alias("id_municipio"))
    )
    on = (strip(F.lower(df["municipio"])) == F.col("_nome")) & (F.upper(df["uf"]) == F.col("_uf"))
    return df.join(dim, on, "left").drop("_nome", "_uf")


def resolve_mantenedor(df: DataFrame, mantenedores: DataFrame, name: str = "mantenedor") -> DataFrame:
    """Add ``id_mantenedor`` by exact name."""
    dim = mantenedores.select(F.col("nome").alias("_nome"), "id_mantenedor")
    return df.join(dim, F.col(name) == F.col("_nome"), "left").drop("_nome")


def municipios_with_coordinates(municipios: DataFrame, coords: DataFrame, limit: int | None = None) -> DataFrame:
    """Municipalities that have coordinates; with ``limit`` the first ones by id."""
    points = keep_first(
        coords.withColumn("codigo_ibge", F.col("codigo_ibge").cast("string")), ["codigo_ibge"]
    ).select("codigo_ibge", "latitude", "longitude")
    out = municipios.select("id_municipio", "codigo_ibge").join(points, "codigo_ibge")
    return out if limit is None else out.orderBy("id_municipio").limit(limit)
