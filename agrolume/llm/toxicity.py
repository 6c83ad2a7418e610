"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

The labelled rows give a bounded sample (``SAMPLE`` of each label, smallest hash of
doc_id first), dealt by hash to three uses: one half finds the lexicon (words and word
beginnings that toxic texts hold far more often), a quarter trains the trees, a quarter
the calibration.  Trees and calibration weigh each row by the labelled rows it stands
for, so a score is the share of toxic ones among like texts, however large the table
and small the sample.  Every text then becomes a few numbers, whatever its length: lexicon
densities (overall, peak within ``WINDOW`` words, distinct terms), hits near a word of
address, capitals, punctuation, and obfuscation (letters mixed with digits or signs,
and hits that only show after undoing this).

The sample, the lexicon (``TERMS`` at most) and the model are of fixed size; they alone
reach the driver.  Every text is scored where it lies, without a shuffle.

Edges: null and empty texts have zeros as features and get a score like any; a label
row that repeats counts once, toxic if any says so; null labels are ignored; without
both labels in the sample every score is the share of toxic labels (0 without labels);
labels without a document count nowhere.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolume.llm.common import sliced, stored

#: Labelled rows used of each label; the model does not grow with the table.
SAMPLE = 4000
TERMS = 2000
WINDOW, NEAR = 50, 5
TREES, DEPTH = 15, 3
CACHED_WORDS = 250_000
#: Lexicon terms: this log ratio or more between toxic and other texts.
LEAST_RATIO = 2.0

# Words of address in the languages seen, and signs that stand for letters.
ADDRESS = frozenset(
    "you your yours yourself u ur du dich dir dein deine deiner euch euer ihr sie tu te toi ton ta tes vous votre vos "
    "tú tus ti usted ustedes vos vosotros vuestro".split()
)
SIGNS = str.maketrans("013457@$!|€", "oieastasiie")
FEATURES = (
    "words", "density", "hits", "distinct", "peak", "addressed", "capitals", "shouted", "exclaimed", "repeated", "mixed", "undone", "digits",
)
CAPITALS, DIGITS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"


def letters(word: str) -> str:
    return word if word.isalpha() else "".join(filter(str.isalpha, word))


def mixes(word: str) -> bool:
    """A digit or sign between letters."""
    inner = word.strip(".,;:!?\"'()[]{}|*-_")
    return len(inner) > 2 and not inner.isalpha() and inner[0].isalnum() and any(map(str.isalpha, inner)) and "@" not in inner[1:-1] + "@"[: "." in inner]


class Words(dict):
    """Lower-cased word to a number: the lexicon term (from 1) times 8, and flags."""

    ADDRESSED, MIXED, UNDONE = 1, 2, 4

    def __init__(self, terms: dict[str, int]):
        self.terms = terms

    def term(self, plain: str) -> int:
        for name in (plain, f"{plain[:5]}*" if len(plain) >= 5 else "", f"{plain[:4]}*" if len(plain) >= 4 else ""):
            if name in self.terms:
                return self.terms[name]
        return 0

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        plain = letters(word)
        found, flags = self.term(plain), 0
        if plain in ADDRESS:
            flags |= self.ADDRESSED
        if mixes(word):
            flags |= self.MIXED
            if not found and (found := self.term(letters(word.translate(SIGNS)))):
                flags |= self.UNDONE
        value = self[word] = found * 8 + flags
        return value


def features(text: str | None, words: Words, weights: np.ndarray) -> list[float]:
    """The numbers of one text, in the order of FEATURES."""
    text = text or ""
    raw = text.encode()
    original = text.split()
    n = len(original)
    if not n:
        return [0.0] * len(FEATURES)
    codes = np.fromiter(map(words.__getitem__, text.lower().split()), np.int64)
    n = max(n, len(codes))
    terms, flags = codes >> 3, codes & 7
    hit = terms > 0
    at = np.flatnonzero(hit)
    peak = addressed = 0
    if len(at):
        peak = int(np.max(np.searchsorted(at, at + WINDOW) - np.arange(len(at))))
        spoken = np.flatnonzero(flags & Words.ADDRESSED)
        addressed = int(np.sum(np.searchsorted(spoken, at + NEAR, "right") > np.searchsorted(spoken, at - NEAR)))
    strip = lambda signs: len(raw) - len(raw.translate(None, signs))
    return [
        math.log1p(n),
        float(weights[terms].sum()) / n,
        math.log1p(len(at)),
        math.log1p(len(np.unique(terms[at]))),
        float(peak),
        addressed / n,
        strip(CAPITALS) / len(raw),
        sum(map(str.isupper, original)) / n,
        strip(b"!?") / n,
        (raw.count(b"!!") + raw.count(b"??")) / n,
        float(np.count_nonzero(flags & Words.MIXED)) / n,
        math.log1p(float(np.count_nonzero(flags & Words.UNDONE))),
        strip(DIGITS) / len(raw),
    ]


def _terms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        names, toxic = [], []
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = set()
            for word in set((text or "").lower().split()):
                plain = letters(word)
                if len(plain) >= 3:
                    found.add(plain)
                if len(plain) >= 4:
                    found.add(f"{plain[:4]}*")
                if len(plain) >= 5:
                    found.add(f"{plain[:5]}*")
            names += found
            toxic += [label] * len(found)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(toxic, pa.int32())], names=["term", "toxic"])


def sample_of(docs: DataFrame, labels: DataFrame, size: int) -> DataFrame:
    """text, toxic, part (0 to 3), weight: at most ``size`` labelled rows of each label, and how many of all each stands for."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = stored(known.join(docs.select("doc_id"), "doc_id", "left_semi"), "labels")
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    order = F.xxhash64("doc_id", F.lit("sample"))
    chosen = [
        known.where(F.col("toxic") == label).orderBy(order, "doc_id").limit(size).withColumn("weight", F.lit(max(1.0, counts.get(label, 0) / size)))
        for label in (0, 1)
    ]
    chosen = stored(chosen[0].union(chosen[1]), "chosen")
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # 2 * size rows at most
    one = rows.groupBy("doc_id", "toxic", "weight").agg(F.max("text").alias("text"))
    return one.select("text", "toxic", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(4)).alias("part"), "weight")


def lexicon(sample: DataFrame, most: int = TERMS) -> list[tuple[str, float]]:
    """Terms and their log ratios, at most ``most``; ``beginning*`` stands for all words that begin so."""
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, other = sizes.get(1, 0), sizes.get(0, 0)
    counted = (
        sample.select("text", "toxic").mapInArrow(_terms_of, "term string, toxic int").groupBy("term").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    )
    ratio = F.log((F.col("a") + 0.5) / (toxic + 1)) - F.log((F.col("b") + 0.5) / (other + 1))
    kept = counted.where(F.col("a") >= max(3, toxic / 250)).select("term", ratio.alias("weight"), "a").where(F.col("weight") >= LEAST_RATIO)
    return [(r["term"], r["weight"]) for r in kept.orderBy(F.desc("weight"), F.desc("a"), "term").limit(most).collect()]


def featured(docs: DataFrame, terms: list[tuple[str, float]]) -> DataFrame:
    """The columns of ``docs``, with ``text`` replaced by the array ``x`` of its features."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)
    columns = [c for c in docs.columns if c != "text"]
    kinds = ", ".join(f"`{n}` {t}" for n, t in docs.select(*columns).dtypes)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words({name: i + 1 for i, (name, _) in enumerate(shared.value)})
        weights = np.array([0.0, *(w for _, w in shared.value)])
        for batch in sliced(batches):
            x = [features(text, words, weights) for text in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(x, pa.list_(pa.float64()))], names=[*columns, "x"])

    return docs.select("text", *columns).mapInArrow(rows, f"{kinds}, x array<double>")


class Toxicity:
    """Fitted on a bounded sample; ``score`` works on any documents."""

    def __init__(self, docs: DataFrame, labels: DataFrame, sample: int = SAMPLE):
        rows = stored(sample_of(docs, labels, sample), "sample")
        self.terms = lexicon(rows.where("part < 2"))
        train = stored(featured(rows.where("part >= 2"), self.terms).withColumn("x", array_to_vector("x")).coalesce(1), "train")
        counts = {(r["part"], r["toxic"]) for r in train.groupBy("part", "toxic").count().collect()}
        self.share = rows.agg(F.coalesce(F.sum(F.col("toxic") * F.col("weight")) / F.sum("weight"), F.lit(0.0))).first()[0]
        self.trees = self.isotonic = None
        if counts >= {(2, 0), (2, 1), (3, 0), (3, 1)}:
            self.trees = GBTClassifier(featuresCol="x", labelCol="toxic", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, cacheNodeIds=False).fit(train.where("part = 2"))
            scored = self._raw(train.where("part = 3")).withColumn("toxic", F.col("toxic").cast("double"))
            self.isotonic = IsotonicRegression(featuresCol="raw", labelCol="toxic", weightCol="weight", predictionCol="score").fit(scored)

    def _raw(self, rows: DataFrame) -> DataFrame:
        return self.trees.transform(rows).withColumn("raw", vector_to_array("probability")[1]).drop("rawPrediction", "probability", "prediction")

    def score(self, docs: DataFrame) -> DataFrame:
        """``doc`` (struct: the row without its text) and ``score``."""
        rest = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text"))
        rows = docs.select(rest.alias("doc"), "text")
        if self.trees is None:
            return rows.select("doc", F.lit(float(self.share)).alias("score"))
        scored = self.isotonic.transform(self._raw(featured(rows, self.terms).withColumn("x", array_to_vector("x"))))
        return scored.select("doc", F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0)).alias("score"))
