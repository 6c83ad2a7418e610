"""Text cleaning as Column expressions."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values -------------------------------------------------------------
# Texts a reader takes as null, in every file.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
# The cultivar register also uses dashes.
STRICT_NULL_TOKENS = (*NULL_TOKENS, "-", "--")

# Maintainer names holding one of these are public bodies.
PUBLIC_TOKENS = (
    "EMBRAPA", "UNIVERSIDADE", "INSTITUTO", "EPAGRI", "PESAGRO", "IAPAR",
    "SECRETARIA", "FACULDADE",
)

# Common names whose accent is missing or wrong in the register.
ACCENT_FIXES = {
    "Alocasia": "Alocásia",
    "Amarilis": "Amarílis",
    "Aralia": "Arália",
    "Bicuiba": "Bicuíba",
    "Bromelia": "Bromélia",
    "Cainga": "Caingá",
    "Catuaba": "Catuába",
    "Croton": "Cróton",
    "Euforbia": "Eufórbia",
    "Gipsofila": "Gipsófila",
    "Guaraiuva": "Guaraiúva",
    "Magnolia": "Magnólia",
    "Orquidea": "Orquídea",
    "OrquÍdea": "Orquídea",
    "Peperomia": "Peperômia",
    "Pera": "Pêra",
}

HTML_TAG = r"<[^>]{0,30}>|</\\+>"
ENCLOSING_QUOTES = r"(?d)^['\"](.*)['\"]$"
ESCAPED_APOSTROPHE = r"\\+'"
# --------------------------------------------------------------------------

# White space at the ends of a field; folding turns the typographic spaces into these.
WHITESPACE = "".join(c for c in map(chr, range(256)) if c.isspace())

# Hangul syllables decompose by arithmetic: a lead, a vowel and perhaps a tail.
_HANGUL = range(0xAC00, 0xD7A4)
_LEAD, _VOWEL, _TAIL = 0x1100, 0x1161, 0x11A7
_VOWELS, _TAILS = 21, 28


@lru_cache(maxsize=1)
def _fold_tables() -> tuple[str, str, list[tuple[str, str]]]:
    """(from, to, expansions) for compatibility decomposition without marks, over all of Unicode.

    Characters that become one character, and marks that vanish, go through a single
    ``translate``.  Those that expand (``½``, ``ﬁ``, ``㎏``) come longest first, so that
    the n-th characters of the expansions make one ``translate`` each.
    """
    one, marks, many = {}, [], {}
    for code in range(0xA0, 0x110000):
        if 0xD800 <= code < 0xE000 or code in _HANGUL:
            continue
        ch = chr(code)
        if unicodedata.combining(ch):
            marks.append(ch)
            continue
        flat = unicodedata.normalize("NFKD", ch)
        if flat == ch:
            continue
        base = "".join(x for x in flat if not unicodedata.combining(x))
        if len(base) == 1 and base != ch:
            one[ch] = base
        elif len(base) > 1:
            many[ch] = base
        elif not base:
            marks.append(ch)
    return "".join(one) + "".join(marks), "".join(one.values()), sorted(many.items(), key=lambda x: (-len(x[1]), x[0]))


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: str | Column) -> Column:
    """Remove white space of any kind from both ends."""
    return F.trim(as_col(c), F.lit(WHITESPACE))


def _jamo(syllable: Column) -> Column:
    """The letters of one Hangul syllable."""
    place = F.ascii(syllable) - _HANGUL.start
    lead, vowel, tail = F.floor(place / (_VOWELS * _TAILS)), F.floor(place % (_VOWELS * _TAILS) / _TAILS), place % _TAILS
    letters = lambda first, n: F.lit("".join(map(chr, range(first, first + n))))
    at = lambda c: c.cast("int") + 1
    return F.concat(
        F.substr(letters(_LEAD, 19), at(lead), F.lit(1)),
        F.substr(letters(_VOWEL, _VOWELS), at(vowel), F.lit(1)),
        F.when(tail > 0, F.substr(letters(_TAIL, _TAILS), at(tail), F.lit(1))).otherwise(""),
    )


def _each_replaced(c: Column, found: Column, change) -> Column:
    """``c`` with ``change`` of each of the ``found`` characters in its place."""
    return F.aggregate(found, c, lambda text, ch: F.replace(text, ch, change(ch)))


def _unaccent(c: Column) -> Column:
    src, dst, many = _fold_tables()
    wide = "".join(ch for ch, _ in many)
    nth = ["".join(base[n] for _, base in many if len(base) > n) for n in range(len(many[0][1]))]
    # Few texts hold a character that becomes several.  A dictionary tells which, and
    # there each different one is replaced.
    widened = _each_replaced(
        c, F.array_intersect(F.split(c, ""), F.split(F.lit(wide), "")), lambda ch: F.concat(*[F.translate(ch, wide, own) for own in nth])
    )
    flat = F.when(F.translate(c, wide, "") != c, widened).otherwise(c)
    first, last = chr(_HANGUL.start), chr(_HANGUL.stop - 1)
    syllables = F.filter(F.array_distinct(F.split(flat, "")), lambda ch: (ch >= first) & (ch <= last))
    flat = F.when(c.rlike(f"[{first}-{last}]"), _each_replaced(flat, syllables, _jamo)).otherwise(flat)
    # Plain ASCII, told by its length in bytes, has nothing to fold.
    return F.when(F.octet_length(c) > F.length(c), F.translate(flat, src, dst)).otherwise(c)


def fold(c: str | Column) -> Column:
    """Accent-free, lower case, stripped.  Null stays null."""
    return strip(F.lower(_unaccent(as_col(c))))


def fold_crop(c: str | Column) -> Column:
    """As ``fold``, with hyphen and underscore read as a space."""
    return F.translate(F.lower(_unaccent(strip(as_col(c)))), "-_", "  ")


def fold_text(value: str) -> str:
    """``fold`` for one driver-side constant, such as a header or a target crop."""
    flat = unicodedata.normalize("NFKD", value)
    return "".join(ch for ch in flat if not unicodedata.combining(ch)).lower().strip()


def _without_quotes(c: Column) -> Column:
    return strip(F.regexp_replace(c, ENCLOSING_QUOTES, "$1"))


def clean_text(c: str | Column) -> Column:
    """Drop one pair of enclosing quotes, HTML tags and escaping before
    apostrophes; empty becomes null."""
    text = F.regexp_replace(strip(c), ENCLOSING_QUOTES, "$1")
    text = F.regexp_replace(text, HTML_TAG, "")
    text = strip(F.regexp_replace(text, ESCAPED_APOSTROPHE, "'"))
    return F.nullif(text, F.lit(""))


def replace_values(c: str | Column, mapping: dict[str, str] = ACCENT_FIXES) -> Column:
    """Replace whole values found in ``mapping``; others stay."""
    c = as_col(c)
    pairs = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.element_at(pairs, c), c)


def split_name(c: str | Column) -> tuple[Column, Column]:
    """(main, secondary) around the first slash.

    The main part may end up empty; an empty secondary part is null.
    """
    parts = F.split(as_col(c), "/", 2)
    main = _without_quotes(strip(F.get(parts, F.lit(0))))
    other = F.nullif(_without_quotes(strip(F.get(parts, F.lit(1)))), F.lit(""))
    return main, other


def classify_setor(c: str | Column) -> Column:
    """Público, Privado, or Nulo for a missing maintainer."""
    c = as_col(c)
    return (
        F.when(c.isNull(), "Nulo")
        .when(F.upper(c).rlike("|".join(map(re.escape, PUBLIC_TOKENS))), "Público")
        .otherwise("Privado")
    )


def code7(c: str | Column) -> Column:
    """First seven characters of a municipality code (``1200013.0`` works too)."""
    return F.substring(as_col(c).cast("string"), 1, 7)


def uf_from_json() -> Column:
    """State of a municipality record: by micro-region, else by immediate region, else XX."""
    first = F.nullif(F.col("microrregiao.mesorregiao.UF.sigla"), F.lit(""))
    second = F.nullif(F.col("`regiao-imediata`.`regiao-intermediaria`.UF.sigla"), F.lit(""))
    return F.upper(F.coalesce(first, second, F.lit("XX")))


def _string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def _update(df: DataFrame, change) -> DataFrame:
    names = set(_string_columns(df))
    return df.select(
        *[change(F.col(f"`{n}`")).alias(n) if n in names else F.col(f"`{n}`") for n in df.columns]
    )


def trim_all(df: DataFrame) -> DataFrame:
    """Strip every string column, and the column names."""
    return _update(df, strip).toDF(*[n.strip() for n in df.columns])


def null_tokens(df: DataFrame, tokens: tuple[str, ...] = NULL_TOKENS) -> DataFrame:
    """Read the null spellings of the files as null, in every string column."""
    return _update(df, lambda c: F.when(~c.isin(*tokens), c))


def fold_header(name: str) -> str:
    """Lower case, ASCII only, with underscores for spaces and hyphens."""
    flat = unicodedata.normalize("NFKD", re.sub("[ -]", "_", name.lower()))
    return flat.encode("ascii", "ignore").decode()


CODE_HEADER_HINTS = ("ibge", "cd_mun", "codigo_mun", "geocodigo")


def snake_columns(df: DataFrame) -> DataFrame:
    """Fold the header; the first column that looks like a municipality code is
    named ``cod_municipio_ibge``."""
    names = [fold_header(n) for n in df.columns]
    code = next((i for i, n in enumerate(names) if any(h in n for h in CODE_HEADER_HINTS)), None)
    if code is not None:
        names[code] = "cod_municipio_ibge"
    return df.toDF(*names)
