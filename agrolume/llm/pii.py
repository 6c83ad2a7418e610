"""Personal data: patterns, then information-theoretic sanitisation.  DataFrame functions only.

Emails, IP addresses, card and phone numbers are found by pattern, leftmost and without
overlap within a kind; what fails its check is dropped.  These are the protected
entities.  Words that stand in the same documents may give them away: with document
counts over the whole corpus, the information that a word t carries about an entity e,
PMI(t, e) = log(D n(t, e) / n(t) n(e)), is set against all there is to know,
IC(e) = log(D / n(e)).  A document is a different text: copies are one document in
every count.  As the share PMI / IC of any chance word of a single document is 1, it is
smoothed by the evidence: with m surroundings of the entity (``AROUND`` characters on
either side) that differ among the documents with the word, it is taken
1 - ``DOUBT`` ** m times.  A word whose share reaches ``DISCLOSES`` becomes a span of
kind ``term`` wherever it stands in the documents of the entity: it is generalised, or
removed from ``REMOVES`` on.  Near copies whose entity stands in the same surroundings
are one observation.

Edges: a null text counts as empty; rows that repeat a doc_id are found each by itself,
rows that agree in doc_id and text are found once and answered alike; a null doc_id is
a document like any other; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agrolume.llm.common import stored

KINDS = ("email", "ip", "card", "phone", "term")
#: The leftmost match always starts where a run of its first class starts, or where the last match ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for the kind to be looked for.
HINTS = {"email": r"@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){11}", "phone": r"\+[0-9]"}
PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
AROUND = 80
#: Of the share that a word has by one observation, this part is taken for chance; of two, its square.
DOUBT = 0.25
DISCLOSES, REMOVES = 0.8, 0.95
TERM = r"\p{L}{3,}"


def luhn(digits: Column) -> Column:
    places = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2),
    )
    return F.aggregate(places, F.lit(0), lambda a, b: a + b) % 10 == 0


def _passes(kind: Column, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.char_length(digits)
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", value.rlike(rf"^{PART}(?:\.{PART}){{3}}$"))
        .when(kind == "card", F.when(n.between(12, 19), luhn(digits)).otherwise(False))
        .otherwise(n.between(9, 15))
    )


def _found(kind: str, text: Column) -> Column:
    """Matches of one kind: kind, at, gap (characters since the last match), value, before, after."""
    gaps, found = F.split(text, PATTERNS[kind], -1), F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
    zipped = F.arrays_zip(gaps, found, F.slice(gaps, F.lit(2), F.lit(2**30)))
    rows = F.transform(
        zipped,
        lambda z, i: F.struct(
            F.lit(kind).alias("kind"),
            i.alias("at"),
            F.char_length(z["0"]).alias("gap"),
            z["1"].alias("value"),
            F.substring(z["0"], -AROUND, AROUND).alias("before"),
            F.substring(z["2"], 1, AROUND).alias("after"),
        ),
    )
    return F.when(text.rlike(HINTS[kind]), rows).otherwise(F.slice(rows, 1, 0))


def base_spans(docs: DataFrame) -> DataFrame:
    """doc, row (hash of the text), kind, start, end, value, before, after of all base spans."""
    text = F.coalesce("text", F.lit(""))
    every = docs.select(F.col("doc_id").alias("doc"), F.xxhash64(text).alias("row"), F.explode(F.concat(*(_found(k, text) for k in PATTERNS))).alias("m"))
    keys = ["doc", "row", "kind"]
    rows = every.where("m.value is not null").select("doc", "row", "m.*").repartition(*keys).dropDuplicates([*keys, "at"])
    so_far = Window.partitionBy(*keys).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    length = F.char_length("value")
    end = F.sum(F.col("gap") + length).over(so_far)
    placed = rows.select(*keys, "value", "before", "after", (end - length).alias("start"), end.alias("end"))
    return placed.where(_passes(F.col("kind"), F.col("value")))


def _entity(kind: Column, value: Column) -> Column:
    return F.concat_ws(":", kind, F.when(kind.isin("card", "phone"), F.regexp_replace(value, "[^0-9]", "")).otherwise(F.lower(value)))


def _whole_words(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower)


def _evidence(observations: Column) -> Column:
    return 1 - F.pow(F.lit(DOUBT), observations)


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"))


def _same(doc: str, row: str) -> Column:
    return F.col("id").eqNullSafe(F.col(doc)) & (F.col("hash") == F.col(row))


def word_counts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """term, n_term: the different texts that hold each word; n_all: the number of different texts.

    All rows are counted, each task's first by itself, then the rows that repeat a text
    are taken off again, so only texts that repeat are dealt.
    """
    texts = _texts(docs)
    rows = stored(texts.groupBy("id", "hash").agg(F.count("*").alias("n")), "rows")
    # One row of each text counts; of n rows that agree in doc_id too, n - 1 are taken off.
    once = rows.groupBy("hash").agg(F.sum("n").alias("copies"), F.min(F.struct("id")).alias("first"))
    once = stored(once, "once")  # a plain side in the join below, which can then split a text with very many copies
    every = once.agg(F.count("*").alias("n_all"))
    copied = rows.join(once.where("copies > 1"), "hash")
    spare = copied.select(F.col("id").alias("spare_id"), F.col("hash").alias("spare_hash"), F.when(F.col("id").eqNullSafe(F.col("first.id")), (F.col("n") - 1) / F.col("n")).otherwise(1.0).alias("off"))
    spare = stored(spare.where("off > 0"), "spare")
    words = F.explode(F.array_distinct(_whole_words(F.col("text")))).alias("term")
    counted = texts.select(words).groupBy("term").agg(F.count("*").cast("double").alias("n"))
    off = texts.join(spare, _same("spare_id", "spare_hash")).select("off", words).groupBy("term").agg((-F.sum("off")).alias("n"))
    return counted.unionByName(off).groupBy("term").agg(F.round(F.sum("n")).cast("long").alias("n_term")), every


def disclosing(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """entity, term, share: the words that give an entity away."""
    named = spans.groupBy("row", _entity(F.col("kind"), F.col("value")).alias("entity")).agg(
        F.min(F.struct("doc")).alias("first"), F.min(F.xxhash64("before", "after")).alias("context")
    )
    # No word has a higher share than all observations of its entity together allow.
    known = named.groupBy("entity").agg(F.count("*").alias("n_entity"), F.count_distinct("context").alias("observed"))
    known = known.where(_evidence(F.col("observed")) >= DISCLOSES).select("entity", "n_entity")
    holders = stored(named.join(known, "entity").select("entity", "n_entity", "row", F.col("first.doc").alias("doc"), "context"), "holders")
    held = _texts(docs).join(holders, _same("doc", "row")).select("entity", "n_entity", "row", "context", F.explode(F.array_distinct(_whole_words(F.col("text")))).alias("term"))
    met = held.groupBy("entity", "term").agg(F.count_distinct("row").alias("n_both"), F.count_distinct("context").alias("observed"), F.max("n_entity").alias("n_entity"))
    candidates = stored(met.where(_evidence(F.col("observed")) >= DISCLOSES), "candidates")
    # All words are counted and only the counts are joined.
    often, every = word_counts(docs)
    counted = candidates.join(often, "term").join(F.broadcast(every))  # one row: the number of documents
    information = F.log(F.col("n_all") / F.col("n_entity"))
    told = F.log(F.col("n_all") * F.col("n_both") / (F.col("n_term") * F.col("n_entity")))
    share = told / information * _evidence(F.col("observed"))
    return counted.where("n_all > n_entity").select("entity", "term", share.alias("share")).where(F.col("share") >= DISCLOSES)


def term_spans(docs: DataFrame, spans: DataFrame, told: DataFrame) -> DataFrame:
    """doc, row, kind, start, end, share of the disclosing words in the documents of their entities."""
    told = stored(told, "told")
    entities = spans.select("doc", "row", _entity(F.col("kind"), F.col("value")).alias("entity")).distinct()
    entities = stored(entities.join(told.select("entity").distinct(), "entity", "left_semi").select("doc", "row", "entity"), "entities")
    concerned = _texts(docs).join(entities.select("doc", "row").distinct(), _same("doc", "row"), "left_semi")
    gaps, found = F.split("text", TERM, -1), F.regexp_extract_all("text", F.lit(TERM), F.lit(0))
    zipped = F.transform(F.arrays_zip(gaps, found), lambda z: F.struct(F.char_length(z["0"]).alias("gap"), z["1"].alias("word")))
    words = concerned.select("id", "hash", F.posexplode(zipped).alias("at", "m")).where("m.word is not null").select("id", "hash", "at", "m.*")
    so_far = Window.partitionBy("id", "hash").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    length = F.char_length("word")
    end = F.sum(F.col("gap") + length).over(so_far)
    placed = words.dropDuplicates(["id", "hash", "at"]).select("id", "hash", F.lower("word").alias("term"), (end - length).alias("start"), end.alias("end"))
    hit = placed.join(told.select("term").distinct(), "term", "left_semi").join(entities, _same("doc", "row")).join(told, ["entity", "term"])
    return hit.groupBy("doc", "row", F.lit("term").alias("kind"), "start", "end").agg(F.max("share").alias("share"))


def find(docs: DataFrame) -> DataFrame:
    """``doc`` (struct: the row of ``docs``) and ``spans``: kind, start, end, share, in order of start and kind.

    Code points, end exclusive.  A term inside a base span is part of that.
    """
    base = stored(base_spans(docs), "spans")
    terms = term_spans(docs, base, disclosing(docs, base))
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    span = F.struct("start", order.alias("order"), "end", "kind", "share")
    every = base.select("doc", "row", "kind", "start", "end", F.lit(None).cast("double").alias("share")).unionByName(terms)
    listed = every.groupBy("doc", "row").agg(F.array_sort(F.collect_set(span)).alias("all"))
    own = F.filter("all", lambda s: s["kind"] != "term")
    free = F.filter("all", lambda t: (t["kind"] != "term") | ~F.exists("own", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    has_terms = F.exists("all", lambda s: s["kind"] == "term")
    cleaned = listed.withColumn("own", own).select("doc", "row", F.when(has_terms, free).otherwise(F.col("all")).alias("spans"))
    nested = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc_row"))
    keyed = nested.select("doc_row", F.col("doc_row.doc_id").alias("id"), F.xxhash64(F.coalesce("doc_row.text", F.lit(""))).alias("hash"))
    narrow = keyed.join(cleaned, F.col("id").eqNullSafe(F.col("doc")) & (F.col("hash") == F.col("row")), "left")
    return narrow.select(F.col("doc_row").alias("doc"), F.coalesce("spans", F.array().cast(dict(cleaned.dtypes)["spans"])).alias("spans"))


def sanitised(found: DataFrame) -> DataFrame:
    """The rows of ``find`` with ``clean``: spans as [kind], terms removed from REMOVES on; of overlapping spans the first counts."""
    text = F.coalesce("doc.text", F.lit(""))
    start = F.struct(F.lit(0).cast("bigint").alias("end"), F.lit("").alias("text"))

    def step(done: Column, span: Column) -> Column:
        gap = F.substr(text, (done["end"] + 1).cast("int"), (span["start"] - done["end"]).cast("int"))
        mark = F.when((span["kind"] == "term") & (span["share"] >= REMOVES), F.lit("")).otherwise(F.concat(F.lit("["), span["kind"], F.lit("]")))
        taken = F.struct(span["end"].cast("bigint").alias("end"), F.concat(done["text"], gap, mark).alias("text"))
        return F.when(span["start"] >= done["end"], taken).otherwise(done)

    rest = lambda done: F.concat(done["text"], F.substr(text, (done["end"] + 1).cast("int")))
    return found.withColumn("clean", F.aggregate("spans", start, step, rest))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
