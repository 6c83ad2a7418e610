"""Language identification: known words first, then ever shorter character n-grams.

From a bounded sample of labelled documents (about ``SAMPLE`` of each language, by hash
of doc_id) words are counted per language; the ``VOCABULARY`` most frequent of each
language are known and score their log frequency in every language.  A word that is not
known falls back to its 5-grams with marks at both ends, and if none of those is known
to 4-, 3-, 2- and 1-grams; it scores their mean.  A text's language is the one with the
highest sum over all its words; the score is the share of that language when the sums
are scaled by the square root of the number of words.

The tables are of fixed size for a number of languages and are broadcast; documents are
scored where they lie.

Edges: a null text or one without a letter is ``und`` with score 0, as is every text if
nothing was learned; ties go to the first language by code point; rows that repeat are
scored each; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agrolume.llm.common import sliced, stored

#: Labelled documents per language that are counted; the model does not grow with the table.
SAMPLE = 1500
VOCABULARY, GRAMS = 20_000, 10_000
LONGEST = 5
#: What an unseen word or n-gram counts as.
SMALL = 0.5
CACHED_WORDS = 300_000
UNKNOWN = "und"


def letters(word: str) -> str:
    return word if word.isalpha() else "".join(filter(str.isalpha, word))


def grams(word: str, n: int) -> list[str]:
    """n-grams of the word with marks at its ends; single letters come without marks."""
    marked = f"^{word}$" if n > 1 else word
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        langs, words, counts = [], [], []
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = Counter(map(letters, (text or "").lower().split()))
            found.pop("", None)
            langs += [lang] * len(found)
            words += found.keys()
            counts += found.values()
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(counts, pa.int64())], names=["lang", "word", "n"])


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: Counter = Counter()
        for lang, word, count in zip(*(batch.column(i).to_pylist() for i in range(3))):
            for n in range(1, LONGEST + 1):
                for gram in grams(word, n):
                    found[lang, n, gram] += count
        rows = list(zip(*found)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows[0], pa.string()), pa.array(rows[1], pa.int32()), pa.array(rows[2], pa.string()), pa.array(list(found.values()), pa.int64())],
            names=["lang", "length", "term", "n"],
        )


class Tables:
    """Log frequencies: ``scores[n][term]`` over the languages; n = 0 for whole words."""

    def __init__(self, langs: list[str], rows: list[tuple[str, int, str, int]]):
        self.langs = langs
        place = {lang: i for i, lang in enumerate(langs)}
        counts: dict[int, dict[str, np.ndarray]] = {n: {} for n in range(LONGEST + 1)}
        for lang, n, term, count in rows:
            counts[n].setdefault(term, np.zeros(len(langs)))[place[lang]] = count
        self.scores = {}
        for n, terms in counts.items():
            total = sum(terms.values(), np.zeros(len(langs))) + SMALL * (len(terms) + 1)
            self.scores[n] = {term: np.log((c + SMALL) / total) for term, c in terms.items()}

    def word(self, word: str) -> np.ndarray:
        if (known := self.scores[0].get(word)) is not None:
            return known
        for n in range(LONGEST, 0, -1):
            found = [s for g in grams(word, n) if (s := self.scores[n].get(g)) is not None]
            if found:
                return np.mean(found, axis=0)
        return np.zeros(len(self.langs))


class _Known(dict):
    """Token to the row of its scores."""

    def __init__(self, tables: Tables):
        self.tables = tables
        self.rows = np.zeros((CACHED_WORDS + 1, len(tables.langs)))

    def __missing__(self, token: str) -> int:
        place = self[token] = len(self) + 1
        plain = letters(token)
        self.rows[place] = self.tables.word(plain) if plain else 0
        return place


def predict(text: str | None, known: _Known) -> tuple[str, float]:
    langs = known.tables.langs
    if not langs or not text or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0
    tokens = text.lower().split()
    sums = np.zeros(len(langs))
    for start in range(0, len(tokens), CACHED_WORDS // 2):  # so that the table holds any text
        part = tokens[start : start + CACHED_WORDS // 2]
        if len(known) + len(part) > CACHED_WORDS:
            known.clear()
        sums += known.rows[np.fromiter(map(known.__getitem__, part), np.int64, len(part))].sum(axis=0)
    best = int(np.argmax(sums))
    shares = np.exp((sums - sums[best]) / np.sqrt(len(tokens)))
    return langs[best], float(1 / shares.sum())


def learn(docs: DataFrame, sample: int = SAMPLE) -> Tables:
    """Tables from ``docs`` with a non-null lang."""
    labelled = docs.where("lang is not null").select("lang", "doc_id", "text")
    sizes = labelled.groupBy("lang").agg(F.count("*").alias("all"))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("lang")), F.lit(1_000_003)) < F.lit(1_000_003.0) * sample / F.col("all")
    chosen = labelled.join(F.broadcast(sizes), "lang").where(drawn)  # one row per language
    words = chosen.select("lang", "text").mapInArrow(_counted, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = stored(words, "words")
    terms = words.mapInArrow(_grams, "lang string, length int, term string, n long").groupBy("lang", "length", "term").agg(F.sum("n").alias("n"))
    every = words.where("n > 1").select("lang", F.lit(0).alias("length"), F.col("word").alias("term"), "n").union(terms)
    rank = F.row_number().over(Window.partitionBy("lang", "length").orderBy(F.desc("n"), "term"))
    most = F.when(F.col("length") == 0, VOCABULARY).otherwise(GRAMS)
    rows = every.withColumn("rank", rank).where(F.col("rank") <= most).select("lang", "length", "term", "n").collect()
    return Tables(sorted({r["lang"] for r in rows}), [tuple(r) for r in rows])


def identify(docs: DataFrame, tables: Tables) -> DataFrame:
    """The columns of ``docs`` in a struct ``doc`` (without text), ``lang_pred`` and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(tables)
    rest = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text"))
    rows = docs.select(rest.alias("doc"), "text")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known(shared.value)
        for batch in sliced(batches):
            found = [predict(text, known) for text in batch.column(1).to_pylist()]
            langs, scores = pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), langs, scores], names=["doc", "lang_pred", "score"])

    return rows.mapInArrow(scored, f"doc {dict(rows.dtypes)['doc']}, lang_pred string, score double")
