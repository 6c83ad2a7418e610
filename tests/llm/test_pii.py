"""Base spans against Python's patterns, terms on a small corpus."""

import hashlib
import re

from agrolume.llm import pii
from agrolume.llm.queries import op10_pii
from pyspark.sql import functions as F

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SCHEMA = "doc_id long, text string, spans string"


def passes(kind, value):
    digits = [int(c) for c in value if c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        twice = [d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(twice) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    found = [(m.start(), i, m.end(), k) for i, (k, p) in enumerate(PLAIN.items()) for m in re.finditer(p, text or "") if passes(k, m.group())]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))


def test_the_test_table(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op10_pii(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(base.count(f"{k}:") for k in PLAIN)
        assert ",".join(s for s in r.spans.split(",") if not s.startswith("term:")) == base


def test_odd_texts(spark):
    texts = [
        "", None, "a@b.c_x@d.e y@z", "x@y.z@q.r", "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.0255", "4111 1111 1111 1111-4111-1111-1111-1111", "4111111111111111",
        "+1 (736) 555-2678. +12 +1234567890123456 +49 30 1234567 -", "😀 é me@x.org 😀 10.0.0.1", "a." * 9000 + "@" + "b." * 9000 + "c", "1" * 30000, "9 " * 20000, "+1" * 9000,
        "@" * 5000, "a@b" * 3000, "Straße İ me@x.org",
    ]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(8, texts[8], "y"), (8, "other b@c.d", "y"), (None, texts[8], None)]
    got = pii.find(spark.createDataFrame(rows, SCHEMA)).select("doc.doc_id", "doc.text", pii.joined(F.col("spans")).alias("s")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.s == brute(r.text), (r.text or "")[:60]
    assert pii.find(spark.createDataFrame([], SCHEMA)).count() == 0


def test_terms_that_disclose(spark):
    filler = [f"plain{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)]
    rows = [(i, f"{filler[3 * i]} note Zephyrine {filler[3 * i + 1]} zoe@corp.example {filler[3 * i + 2]}", None) for i in range(5)]
    rows += [(10 + i, f"note {filler[50 + i]} about nothing", None) for i in range(200)]
    rows += [(900 + i, "copied Quixote same q@corp.example words", None) for i in range(9)]
    found = pii.find(spark.createDataFrame(rows, SCHEMA))
    got = {r.doc_id: r for r in pii.sanitised(found).select("doc.doc_id", "doc.text", "clean", "spans").collect()}
    for i in range(5):
        terms = {got[i].text[s.start : s.end] for s in got[i].spans if s.kind == "term"}
        assert terms == {"Zephyrine"}
        assert "Zephyrine" not in got[i].clean and "[email]" in got[i].clean
    assert all(s.kind != "term" for i in got if i >= 10 for s in got[i].spans)
    assert got[900].clean == "copied Quixote same [email] words"


def terms_of(spark, rows):
    found = pii.find(spark.createDataFrame(rows, SCHEMA)).select("doc.doc_id", "doc.text", "spans").collect()
    return {r.doc_id: {r.text[s.start : s.end] for s in r.spans if s.kind == "term"} for r in found}


def test_terms_far_from_their_entity_and_of_two_documents(spark):
    far = "nothing here but padding " * 20
    word = lambda i: f"w{chr(97 + i % 26)}{chr(97 + i // 26)}x"
    rows = [(i, f"Zephyrine {word(i)} {far} {word(i + 40)} zoe@corp.example {word(i + 80)} İ {far} zephyrine", None) for i in range(2)]
    rows += [(10 + i, f"{far} {word(i)}", None) for i in range(200)]
    # Copies are one document: were the word counted by rows, its share would be too low.
    rows += [(300 + i, f"Quillon {word(i % 3 + 120)} {far} ann@corp.example {word(i % 3 + 150)}", None) for i in range(60)]
    rows += [(400 + i, f"Quillon {far} elsewhere", None) for i in range(60)] + [(400, f"Quillon {far} elsewhere", None)]
    # Near copies that surround their entity alike are one observation.
    rows += [(500 + i, f"Mirabel {word(i)} {far} same eve@corp.example words {far}", None) for i in range(5)]
    got = terms_of(spark, rows)
    assert got[0] == got[1] == {"Zephyrine", "zephyrine"}
    assert all(got[300 + i] == {"Quillon"} for i in range(60))
    assert not any(got[i] for i in got if i not in (0, 1, *range(300, 360)))


def test_words_are_counted_by_different_texts(spark):
    rows = [(1, "one two", None), (1, "one two", None), (2, "one two", None), (None, "one two", None), (None, "one two", None), (3, "one three", None), (4, None, None), (5, "", None), (3, "three", None)]
    counts, every = pii.word_counts(spark.createDataFrame(rows, SCHEMA))
    assert {r.term: r.n_term for r in counts.collect()} == {"one": 2, "two": 1, "three": 2}
    assert every.first().n_all == 4
