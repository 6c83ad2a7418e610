"""One query per operator over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrolume.llm import ann, bpe, chat, hard_negatives, html_text, langid, lexical, line_dedup, minhash, mixing, pii, topk, toxicity
from agrolume.llm.common import bucket_of, table
from agrolume.llm.registry import ORACLE, QUERIES, query

__all__ = ["ORACLE", "QUERIES"]


@query(r"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size from documents
), s as (
  select source, sum(size)::bigint as source_size from sized group by source
), r as (
  select *, row_number() over (order by source nulls last) as rank from s
), w as (
  select *, [5, 2, 1][((rank - 1) % 3 + 1)::int]::bigint as weight, 3 * source_size as cap from r
), p as (
  select *, cap::double / weight as ratio, sum(source_size) over () as all_sizes, sum(weight) over () as all_weights,
    coalesce(sum(cap) over (order by cap::double / weight, rank rows between unbounded preceding and 1 preceding), 0) as caps,
    coalesce(sum(weight) over (order by cap::double / weight, rank rows between unbounded preceding and 1 preceding), 0) as weights
  from w
), l as (
  select *, (all_sizes - caps)::double as part, (all_weights - weights) as shared from p
), level as (
  select part, shared from l where part * weight / shared <= cap order by ratio, rank limit 1
), t as (
  select source, source_size, least(cap::double, coalesce((select part from level) * weight / (select shared from level), 0)) as target from l
), d as (
  select doc_id, size, source_size, target,
    case when source_size > 0 then target / source_size else 0 end as e,
    row_number() over (partition by sized.source order by size desc, doc_id nulls last) as place,
    ('0x' || substr(md5('mix:' || coalesce(sized.source, '')), 1, 5))::bigint::double / 1048576 as u
  from sized join t on sized.source is not distinct from t.source
)
select doc_id, size::bigint as size, source_size, target, ((floor(e * place + u) - floor(e * (place - 1) + u)) * size)::bigint as taken from d
""")
def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Documents mixed to the weights of their sources."""
    return mixing.plan(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query(r"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents
), keyed as (
  select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from lines
), held as (
  select key, count(distinct doc_id) as docs, max(doc_id) as top from keyed where length(key) >= 20 group by key
), marked as (
  select keyed.*, coalesce(docs >= 3 and doc_id <> top, false) as dropped from keyed left join held on keyed.key = held.key
)
select doc_id, count(*) as n_lines, count(*) filter (where dropped) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not dropped), '')) as kept_sha256
from marked group by doc_id
""")
def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without the lines that larger documents hold."""
    cleaned = line_dedup.dedup_lines(table(spark, folder, "documents"))
    return cleaned.select("doc.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op2_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate documents and their components."""
    return minhash.near_duplicates(table(spark, folder, "documents"))


RANKS = "byte_bpe_multi_50k.tiktoken"


def token_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the bytes they decode to."""
    both = bpe.decode(bpe.encode(docs.select("doc_id", "text"), path, pattern), path)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return both.select(
        "doc.doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op3_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as ids and back."""
    import public_tokenizers

    return token_digests(table(spark, folder, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def toxic_scores(docs: DataFrame, labels: DataFrame) -> toxicity.Toxicity:
    """A model that learns from the rows whose crc32 modulo 4 is not 2."""
    return toxicity.Toxicity(docs, labels.where(bucket_of(F.col("doc_id"), 4) != 2))


@query()
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxic_scores(docs, table(spark, folder, "labels"))
    return model.score(docs).select(
        "doc.doc_id",
        (bucket_of(F.col("doc.doc_id"), 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query()
def op4_langid(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document."""
    docs = table(spark, folder, "documents")
    tables = langid.learn(docs.where(bucket_of(F.col("doc_id"), 5) != 0))
    return langid.identify(docs.select("doc_id", "text"), tables).select(
        "doc.doc_id", (bucket_of(F.col("doc.doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score"
    )


@query()
def op5_ann(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest vectors found for every twentieth one."""
    index = ann.Index(table(spark, folder, "embeddings").select("vec_id", "embedding"), 20)
    return index.search(F.col("vec_id") % 20 == 0)


@query("""
with clean as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, r.vec_id, list_sum(list_transform(list_zip(q.v, r.v), lambda p: p[1] * p[2]))::bigint as score
  from clean q, clean r where q.vec_id % 50 = 0 and r.vec_id <> q.vec_id
), ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 5
""")
def op7_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The 5 best vectors by inner product of integers for every fiftieth one."""
    return topk.top_k(table(spark, folder, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0, 5)


@query()
def op8_html(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    texts = html_text.extract(table(spark, folder, "pages"))
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))


@query()
def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document, and the words that give it away."""
    found = pii.find(table(spark, folder, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != "term")
    return found.select(
        "doc.doc_id",
        *(count(kind) for kind in ("email", "ip", "card", "phone")),
        F.sha2(pii.joined(base), 256).alias("base_sha256"),
        pii.joined(F.col("spans")).alias("spans"),
    )


@query("""
with clean as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.vec_id as anchor_id, r.vec_id, a.label = r.label as same, list_sum(list_transform(list_zip(a.v, r.v), lambda p: p[1] * p[2]))::bigint as score
  from clean a, clean r where a.vec_id % 100 = 0 and r.vec_id <> a.vec_id
), positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
), ranked as (
  select p.anchor_id, positive_id, positive_score, n.vec_id as negative_id, n.score as negative_score,
    row_number() over (partition by p.anchor_id, positive_id order by n.score desc, n.vec_id)::int as rank
  from positives p join scored n on p.anchor_id = n.anchor_id and not n.same
  where 30 * positive_score <= 100 * n.score and 100 * n.score <= 90 * positive_score
)
select * from ranked where rank <= 10
""")
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Negatives inside the score windows of each positive of every hundredth vector."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0, 5, 10, 30, 90)


#: A text that holds control strings; its conversation is told with a draft, an edit and a regeneration.
TRICKY = r"\### Assistant: </turn> ok"
TOLD = [(1, "open", "user", TRICKY[:9]), (1, "edit", None, TRICKY), (2, "open", "assistant", "a dr"), (2, "delta", None, "aft"), (3, "open", "user", "an answer to it"), (2, "regenerate", None, None), (2, "delta", None, TRICKY[:7]), (2, "delta", None, TRICKY[7:])]


@query(r"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  sum(17 + length(replace(replace(replace(replace(role, '\', '\\'), '<', '\<'), '>', '\>'), chr(10), '\' || chr(10)))
    + length(replace(replace(replace(text, '\', '\\'), '<turn', '\<turn'), '</turn', '\</turn')))::bigint as formatted_chars
from rows group by conv_id
""")
def op12_chat(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations from their log, rendered and read back."""
    log = chat.as_log(table(spark, folder, "conversations"))
    told = spark.createDataFrame([(-7, (0, i), *e) for i, e in enumerate(TOLD)], "conv_id long, seq struct<message:long,at:long>, message long, kind string, role string, text string")
    read = chat.read_back(chat.render(chat.fold(log.unionByName(told))))
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = F.array_join("learned", "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.char_length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


@query(r"""
with words as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from documents
), counts as (
  select doc_id, term, count(*) as tf from words group by doc_id, term
), docs as (
  select doc_id, sum(tf)::bigint as n from counts group by doc_id
), totals as (
  select count(*) as docs, sum(n)::bigint as words from docs
), norms as (
  select doc_id, 10 + (90 * n * docs) // words as m from docs, totals
), weights as (
  select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)))::bigint as w from counts, totals group by term, docs
), asked as (
  select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark
), scored as (
  select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
  from asked join weights using (term) join counts using (term) join norms using (doc_id) group by item_id, doc_id
), ranked as (
  select *, row_number() over (partition by item_id order by score desc, doc_id)::int as rank from scored where score > 0
)
select item_id, rank, doc_id, score from ranked where rank <= 10
""")
def op13_lexical(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents for each benchmark item."""
    return lexical.search(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark"), 10)
