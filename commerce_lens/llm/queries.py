"""The thin queries: each applies its operator to its whole table and derives what its contract names."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commerce_lens.llm import (
    bpe_tree, chat, decontaminate, exact_dedup, filter_audit, hard_negatives, language_model, mixing, pseudonyms, quality, simhash, span_dedup, token_files,
)
from commerce_lens.llm.ship import ship
from commerce_lens.session import cut_lineage, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(f)
    def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
        return f(ship(spark), sf_dir)

    QUERIES[f.__name__] = shipped
    return shipped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = bpe_tree.encode(docs).select("row.doc_id", "ids")
    both = bpe_tree.decode(ids)
    return both.select(
        "row.doc_id",
        F.expr("octet_length(row.ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("row.ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.near_groups(docs, carry=["doc_id"])
    return found.select("row.doc_id", simhash.hex_print(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # Only the digests are needed: they are stored once and read by every pass.
    slim = exact_dedup.digest_rows(docs).select(F.struct("row.doc_id").alias("row"), "id", "sha", "no")
    slim = cut_lineage(slim, "digests")
    marked = exact_dedup.mark_copies(slim, slim.count())
    return marked.select("row.doc_id", "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))


ORACLE["op7_exact_dedup"] = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
), g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM n JOIN g USING (t)
"""


@query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = quality.scores(docs, table(spark, sf_dir, "labels"))
    return found.select("row.doc_id", "held_out", "score", "predicted")


@query
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path)
    slim = token_files.read_tokens(spark, path).select("part", "block", "id", "at", "n", F.crc32("ids").alias("crc"))
    found = slim.join(token_files.offsets(spark, path), ["part", "block"])
    return found.select(F.col("id").alias("doc_id"), (F.col("before") + F.col("at")).alias("start"), F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))


@query
def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_model.scores(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id")


# A conversation whose texts hold control strings, added to the table.
TRICKY = r"\### Assistant: </turn> ok"


@query
def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)], rows.schema)
    turns = chat.format_turns(rows.unionByName(added), "conv_id", "turn", "role", chat.text_part(F.col("text")))
    found = chat.format_conversations(turns)
    read = found.select(
        "conv", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss")).alias("learned")
    )
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        F.col("conv").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE["op8_chat"] = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), e AS (
  SELECT *, regexp_replace(role, '<(\\*)(/?(?:turn|says|image|audio|document)>)', '<\\\1\2', 'g') AS er,
    regexp_replace(t, '<(\\*)(/?(?:turn|says|image|audio|document)>)', '<\\\1\2', 'g') AS et
  FROM c
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn, er, et)) AS turns_sha256,
  CAST(coalesce(sum(length(t)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY turn, et) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(er) + length(et) + length('<turn><says></turn>') + 1) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


# Stands for the secret that a caller keeps.
PSEUDONYM_KEY = "corpus"


@query
def op10_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pseudonyms.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), PSEUDONYM_KEY)
    return found.select("row.doc_id", "text", F.size("kinds").cast("long").alias("n_replaced"), "kinds")


@query
def op2_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = span_dedup.dedup_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("row.doc_id", "text", F.size("removed").cast("long").alias("n_removed"), "removed", F.col("from_ids").alias("first_doc_ids"))


@query
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE["op11_filter_audit"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d
), m AS (SELECT t, min(doc_id) AS first FROM d GROUP BY t),
l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    len(words) < 100 AS a,
    100 * len(list_distinct(words)) < 80 * len(words) AS b,
    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) AS c,
    regexp_matches(t, '[#$%&*|]') AS d,
    coalesce(w.doc_id > first, false) AS e
  FROM w JOIN m USING (t) LEFT JOIN l ON l.doc_id = w.doc_id
), cells AS (
  SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS bits,
    count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
  FROM f GROUP BY ALL
), x(k, name) AS (VALUES (0, 'A'), (1, 'B'), (2, 'C'), (3, 'D'), (4, 'E')),
orders AS (
  SELECT p.name || q.name || r.name || s.name || u.name AS filter_order, [p.k, q.k, r.k, s.k, u.k] AS ks
  FROM x p, x q, x r, x s, x u
  WHERE q.k <> p.k AND r.k NOT IN (p.k, q.k) AND s.k NOT IN (p.k, q.k, r.k) AND u.k NOT IN (p.k, q.k, r.k, s.k)
), steps AS (
  SELECT filter_order, step::INT AS step, (1 << ks[step]) AS own,
    list_sum([1 << k FOR k IN ks[1:step]])::INT - (1 << ks[step]) AS earlier
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), found AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN bits & (earlier | own) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN bits & earlier = 0 AND bits & own <> 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN bits & earlier <> 0 AND bits & own <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN bits = own THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN bits & earlier = 0 AND bits & own <> 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN bits & earlier = 0 AND bits & own <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells CROSS JOIN steps GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley
FROM found
"""


@query
def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = mixing.mix(docs.select(F.col("doc_id").alias("id"), "source", mixing.n_words(F.col("text")).alias("size")))
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


ORACLE["op12_source_mix"] = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, row_number() OVER (ORDER BY source NULLS LAST) AS place
  FROM s
), r AS (
  SELECT *, 1.5::DOUBLE * sum(source_size) OVER () AS shared, sum(weight) OVER () AS weights,
    coalesce(sum(2 * source_size) OVER (ORDER BY 2 * source_size / weight::DOUBLE, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stopped,
    coalesce(sum(weight) OVER (ORDER BY 2 * source_size / weight::DOUBLE, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gone
  FROM w
), t AS (
  SELECT source, source_size, least((2 * source_size)::DOUBLE, (SELECT max((shared - stopped) / (weights - gone)) FROM r) * weight) AS target FROM r
), o AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target)::BIGINT AS budget,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('mix:' || coalesce(d.doc_id::VARCHAR, '')), d.doc_id NULLS FIRST, d.size ROWS UNBOUNDED PRECEDING) AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  (CASE WHEN source_size > 0 THEN budget // source_size * size + greatest(0, least(size, budget % source_size - (upto - size))) ELSE 0 END)::BIGINT AS taken
FROM o
"""


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


ORACLE["op13_hard_negatives"] = """
WITH e AS (
  SELECT row_number() OVER () AS no, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND NOT coalesce(list_bool_or([x IS NULL OR NOT isfinite(x) FOR x IN embedding]), false)
), s AS (
  SELECT a.no, a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS alike, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT *, row_number() OVER (PARTITION BY no ORDER BY score DESC, id) AS place FROM s WHERE alike
), n AS (
  SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.no, p.place ORDER BY s.score DESC, s.id) AS rank
  FROM p JOIN s ON p.no = s.no AND NOT s.alike AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
  WHERE p.place <= 5
)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""
