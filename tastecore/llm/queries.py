"""Registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastecore.llm import (
    hard_negatives,
    langid,
    license_scan,
    mixing,
    mtree,
    ngram_join,
    nn_descent,
    packing,
    secret_scan,
    sharding,
    token_rollup,
    turn_repair,
    wavelet,
)
from tastecore.plans.staging import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.learn(langid.training_rows(docs))
    found = langid.predict(docs, model)
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "lead")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op2_token_wavelet")
def token_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-wavelet")
    wavelet.write_shards(table(spark, sf_dir, "documents"), path, tokenizer_file("word_bpe_49k.json"), end_id=2)
    return wavelet.documents(wavelet.read_shards(spark, path))


TOP_PRODUCTS_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS e FROM embeddings
), q AS (SELECT * FROM v WHERE vec_id % 50 = 0), scored AS (
  SELECT q.vec_id AS query_id, v.vec_id,
         list_sum([p[1] * p[2] FOR p IN list_zip(q.e, v.e)])::BIGINT AS score
  FROM q JOIN v ON q.vec_id <> v.vec_id
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM placed WHERE rank <= 5
"""


@query("op3_mtree_topk", TOP_PRODUCTS_SQL)
def mtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return mtree.top_products(rows, rows.filter("vec_id % 50 = 0"), k=5)


@query("op4_license_scan")
def licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


@query("op5_secret_scan")
def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


@query("op6_ngram_jaccard")
def ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, sf_dir, "documents"))


#: Parts of the mix by the labels' quality and toxicity, and its size against the corpus.
MIX_WEIGHTS = {"q1t0": 0.90, "q0t0": 0.08, "q1t1": 0.015, "q0t1": 0.005}
MIX_SHARE = 1.0


def mix_domain() -> Column:
    return F.concat(F.lit("q"), F.col("quality").cast("string"), F.lit("t"), F.col("toxic").cast("string"))


@query("op7_soft_mixing")
def soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    classifier = mixing.learn_domains(docs, table(spark, sf_dir, "labels"), mix_domain())
    return mixing.document_rates(docs, classifier, MIX_WEIGHTS, MIX_SHARE)


@query("op8_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), end_id=0, capacity=2048)


@query("op9_nn_descent")
def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return nn_descent.nearest_rows(rows, rows.filter("vec_id % 100 = 0"), k=10)


TOKEN_COUNTS_SQL = r"""
WITH kept AS (
  SELECT source, lang, coalesce(text, '') AS text FROM documents
  WHERE doc_id IS NULL OR doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL)
), counted AS (
  SELECT source, lang, 'words-1' AS tokenizer, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS n FROM kept
  UNION ALL
  SELECT source, lang, 'pieces-2', len(regexp_extract_all(text, '[a-zA-Z0-9]+|[^a-zA-Z0-9\x20\x09-\x0D]')) FROM kept
)
SELECT source, lang, tokenizer, count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_tokens
FROM counted GROUP BY source, lang, tokenizer
"""


@query("op10_token_counts", TOKEN_COUNTS_SQL)
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimated counts, then exact ones, then a second tokenizer version, then toxic documents taken out."""
    docs = table(spark, sf_dir, "documents")
    rollup = token_rollup.TokenRollup(spark, scratch_path(spark, "token-rollup"))
    words, pieces = token_rollup.WORDS, token_rollup.PIECES
    rollup.apply(1, docs.select(
        "doc_id", F.lit(words).alias("tokenizer"), "source", "lang",
        F.coalesce(F.floor(F.col("n_chars") / 6), F.lit(0)).alias("n_tokens"),
        F.lit(token_rollup.INSERT).alias("action"), F.lit(0).alias("change_order"),
    ))
    rollup.apply(2, token_rollup.changes(docs, token_rollup.REVISE, words))
    rollup.apply(3, token_rollup.changes(docs, token_rollup.INSERT, pieces))
    rollup.apply(2, token_rollup.changes(docs, token_rollup.REVISE, words))  # a batch sent twice counts once
    toxic = table(spark, sf_dir, "labels").filter("toxic = 1 and doc_id is not null").select("doc_id").distinct()
    gone = toxic.withColumns({"source": F.lit(None), "lang": F.lit(None), "text": F.lit(None).cast("string")})
    rollup.apply(4, token_rollup.changes(gone, token_rollup.DELETE, words).unionAll(token_rollup.changes(gone, token_rollup.DELETE, pieces)))
    return rollup.totals()


#: A list of the bytes' entries in the table of CRC-32, and the CRC-32 of a text's UTF-8 bytes.
CRC_TABLE_SQL = """crc_bits AS (
  SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS v FROM range(256) r(i)
), crc_table AS (SELECT list(v ORDER BY i) AS entries FROM crc_bits)"""


def _crc_sql(text: str) -> str:
    data = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::BIGINT)"
    return f"xor(list_reduce({data}, lambda c, x: xor(c >> 8, entries[(xor(c, x) & 255) + 1]), 4294967295), 4294967295)"


REPAIR_SQL = rf"""
WITH RECURSIVE {CRC_TABLE_SQL}, given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS fault
  FROM conversations, crc_table
), turns AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM given, range(2) r(copy) WHERE fault <> 0 AND (copy = 0 OR fault = 3)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place FROM turns
), repeated AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 AS again FROM placed
), judged AS (
  SELECT *, left(role, 1) AS letter, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY place) AS letter_before,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN again THEN 'duplicate'
         WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault FROM repeated
), facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (place > 1 AND letter_before || letter NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM judged GROUP BY conv_id
), inserted(before, after, edit, extra, word) AS (  -- at most one turn is worth inserting at a place
  SELECT s, s, '', 0, NULL::VARCHAR FROM (VALUES ('start'), ('system'), ('pair'), ('user')) t(s)
  UNION ALL VALUES ('start', 'user', 'I', 3, 'user:'), ('system', 'user', 'I', 3, 'user:'), ('pair', 'user', 'I', 3, 'user:'), ('user', 'pair', 'I', 3, 'assistant:')
), walk AS (
  SELECT conv_id, 0::BIGINT AS place, 'start' AS state, {{'cost': 0, 'audit': '', 'body': NULL::VARCHAR}} AS best FROM facts
  UNION ALL
  SELECT conv_id, place, state, min(best) FROM (
    SELECT w.conv_id, j.place, e.state,
      {{'cost': w.best.cost + i.extra + e.cost, 'audit': w.best.audit || i.edit || e.edit,
        'body': CASE WHEN coalesce(w.best.body, i.word, e.word) IS NOT NULL THEN concat_ws(chr(10), w.best.body, i.word, e.word) END}} AS best
    FROM walk w JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.place = w.place + 1
    JOIN inserted i ON i.before = w.state,
    LATERAL (
      SELECT i.after AS state, 4 AS cost, 'D' AS edit, NULL::VARCHAR AS word
      UNION ALL SELECT CASE WHEN i.after = 'user' THEN 'pair' ELSE 'user' END,
        CASE WHEN j.letter = CASE WHEN i.after = 'user' THEN 'a' ELSE 'u' END THEN 0 ELSE 3 END + CASE j.fault WHEN 'truncated' THEN 3 ELSE 0 END,
        CASE WHEN j.letter = CASE WHEN i.after = 'user' THEN 'a' ELSE 'u' END THEN 'K' ELSE 'R' END,
        CASE WHEN j.letter = CASE WHEN i.after = 'user' THEN 'a' ELSE 'u' END THEN j.role WHEN i.after = 'user' THEN 'assistant' ELSE 'user' END || ':' || j.text
      WHERE j.fault NOT IN ('blank', 'duplicate')
      UNION ALL SELECT 'system', CASE j.fault WHEN 'truncated' THEN 3 ELSE 0 END, 'K', j.role || ':' || j.text
      WHERE j.fault NOT IN ('blank', 'duplicate') AND i.after = 'start' AND j.letter = 's'
    ) e
  ) GROUP BY conv_id, place, state
), ended AS (
  SELECT w.conv_id, min({{'cost': w.best.cost + i.extra, 'audit': w.best.audit || i.edit,
      'body': CASE WHEN coalesce(w.best.body, i.word) IS NOT NULL THEN concat_ws(chr(10), w.best.body, i.word) END}}) AS best
  FROM walk w JOIN facts f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.n = w.place
  JOIN inserted i ON i.before = w.state AND i.after IN ('start', 'pair') GROUP BY w.conv_id
)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
  coalesce(best.audit, '') AS audit, sha256(coalesce(best.body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""


@query("op11_turn_repair", REPAIR_SQL)
def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair(turn_repair.damaged(table(spark, sf_dir, "conversations")))


SHARDS = 40
SHARDING_SQL = rf"""
WITH {CRC_TABLE_SQL}, docs AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 16 AS size, {_crc_sql("coalesce(text, '')")} AS text_crc32 FROM documents, crc_table
), hashed AS (
  SELECT doc_id, s, (('0x' || substr(md5(concat_ws('|', 'shard', s, coalesce(doc_id::VARCHAR, chr(0)))), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
  FROM (SELECT DISTINCT doc_id FROM documents), range({SHARDS + 1}) r(s)
), shards AS (
  SELECT doc_id, arg_max(s, -1 / ln(u)) FILTER (s < {SHARDS}) AS shard, arg_max(s, -1 / ln(u)) AS grown FROM hashed GROUP BY doc_id
)
SELECT d.doc_id, d.size::BIGINT AS size, d.text_crc32::BIGINT AS text_crc32, 'key' AS law, shard::INTEGER AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY d.doc_id NULLS FIRST, d.size, d.text_crc32) - 1 AS slot, grown::INTEGER AS grown_shard
FROM docs d JOIN shards k ON k.doc_id IS NOT DISTINCT FROM d.doc_id
"""


@query("op13_rendezvous_sharding", SHARDING_SQL)
def rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 39, and where each document goes with one more."""
    weights, grown = sharding.equal_shards(SHARDS), sharding.equal_shards(SHARDS + 1)
    return sharding.shard_documents(table(spark, sf_dir, "documents"), weights, grown)


HARD_NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
), q AS (SELECT * FROM v WHERE vec_id % 100 = 0), scored AS (
  SELECT q.vec_id AS anchor_id, v.vec_id, q.label = v.label AS same, list_sum([p[1] * p[2] FOR p IN list_zip(q.e, v.e)])::BIGINT AS score
  FROM q JOIN v ON q.vec_id <> v.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


@query("op12_hard_negatives", HARD_NEGATIVES_SQL)
def mined_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.hard_negatives(rows, rows.filter("vec_id % 100 = 0"))
