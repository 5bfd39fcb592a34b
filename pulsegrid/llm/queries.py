"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import ann, chat, exact_search, language, mixing, near, packing, periodic, phrases, secrets, sharding, token_files, toxicity
from pulsegrid.llm.common import is_held_out, may_learn, table
from pulsegrid.runtime import use_checkpoint_dir

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learned = language.profiles(docs.where(may_learn(F.col("doc_id"))))
    out = language.identify(docs, learned, keep=["doc_id"])
    return out.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "margin")


def op2_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.reply_ordered(table(spark, sf_dir, "conversations"))


def op3_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix_report(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "source")


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(table(spark, sf_dir, "documents"))


def op5_binary_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack(table(spark, sf_dir, "documents"), VOCABULARY)
    return out.select("doc_id", "start", "length", F.crc32("tokens").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")


def _asked(rows: DataFrame) -> DataFrame:
    """The stated query set."""
    return rows.where(F.col("vec_id") % 50 == 0).select(F.col("vec_id").alias("query_id"), "embedding")


def op6_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return ann.search(rows, _asked(rows))[0]


def op7_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.digest(secrets.scan(docs, secrets.train(docs), keep=["doc_id"]))


def op8_approximation_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return exact_search.search(rows, _asked(rows))


def op9_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op10_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(may_learn(F.col("doc_id"))))
    out = toxicity.score(docs, model, keep=["doc_id"])
    return out.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op11_synchronised_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest(periodic.with_planted_runs(table(spark, sf_dir, "documents")))


def op12_phrase_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_range_coded_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/token-files-{uuid.uuid4().hex}"
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, BYTE_VOCABULARY)
    return token_files.read_token_files(spark, path)


QUERIES = {
    f.__name__: f
    for f in (
        op1_language, op2_quotation_linking, op3_pareto_mix, op4_simhash_near_dedup, op5_binary_packing, op6_kmeans_tree,
        op7_markov_secrets, op8_approximation_file, op9_label_propagation, op10_compression_toxicity, op11_synchronised_runs, op12_phrase_graph, op13_range_coded_ids,
    )
}

def _own(text: str) -> str:
    return rf"""regexp_replace(regexp_replace({text}, '(?m)^[ \t]*>.*(\r\n|\n|\r|$)', '', 'g'), '^\s+|\s+$', '', 'g')"""


def _norm(text: str) -> str:
    return rf"""lower(trim(regexp_replace({text}, '\s+', ' ', 'g')))"""


_END, _MARKS = r"\r\n|\n|\r", r"^[ \t]*((?:>[ \t]?)+)"
_QUOTES = rf"""
WITH RECURSIVE quoting AS (
  SELECT DISTINCT conv_id, turn, text FROM conversations WHERE regexp_matches(text, '(?m)^[ \t]*>')
), lines AS (
  SELECT conv_id, turn, text, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos
  FROM (SELECT *, regexp_split_to_array(text, '{_END}') AS parts FROM quoting)
), quoted AS (
  SELECT * FROM (
    SELECT *, length(regexp_replace(regexp_extract(line, '{_MARKS}', 1), '[^>]', '', 'g')) AS level,
           regexp_replace(line, '{_MARKS}', '') AS body FROM lines) WHERE level > 0
), edges AS (
  SELECT *, CASE WHEN lag(pos) OVER w = pos - 1 AND lag(level) OVER w = level THEN 0 ELSE 1 END AS fresh
  FROM quoted WINDOW w AS (PARTITION BY conv_id, turn, text ORDER BY pos)
), numbered AS (
  SELECT *, sum(fresh) OVER (PARTITION BY conv_id, turn, text ORDER BY pos) AS passage FROM edges
), runs AS (
  SELECT conv_id, turn, text, passage, level, string_agg(body, ' ' ORDER BY pos) AS words FROM numbered GROUP BY ALL
), parts AS (
  SELECT *, sum(fresh) OVER (PARTITION BY conv_id, turn, text ORDER BY pos) AS part FROM (
    SELECT *, CASE WHEN lag(pos) OVER w = pos - 1 AND lag(level) OVER w = level THEN 0 ELSE 1 END AS fresh
    FROM quoted WHERE {_norm("body")} <> '' WINDOW w AS (PARTITION BY conv_id, turn, text ORDER BY pos))
), paragraphs AS (
  SELECT conv_id, turn, text, part, level, string_agg(body, ' ' ORDER BY pos) AS words FROM parts GROUP BY ALL
), units AS (
  SELECT conv_id, turn, text, level, {_norm("words")} AS u FROM runs WHERE length({_norm("words")}) >= 1
  UNION ALL SELECT conv_id, turn, text, level, {_norm("words")} FROM paragraphs
  UNION ALL SELECT conv_id, turn, text, level, {_norm("body")} FROM quoted WHERE length({_norm("body")}) >= 12
), own AS (
  SELECT conv_id, turn, {_own("text")} AS o FROM conversations WHERE conv_id IN (SELECT conv_id FROM quoting)
), pieces AS (
  SELECT conv_id, turn, {_norm("o")} AS u, 1 AS least FROM own
  UNION ALL SELECT conv_id, turn, {_norm("x")}, 12 FROM (
    SELECT conv_id, turn, unnest(regexp_split_to_array(o, '(?:{_END})[ \t]*(?:{_END})')) AS x FROM own)
  UNION ALL SELECT conv_id, turn, {_norm("x")}, 12 FROM (SELECT conv_id, turn, unnest(regexp_split_to_array(o, '{_END}')) AS x FROM own)
), originals AS (
  SELECT conv_id, u, min(turn) AS origin FROM pieces WHERE length(u) >= least GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, turn, text ORDER BY level, length(u) DESC, origin DESC) AS place
  FROM units JOIN originals USING (conv_id, u) WHERE origin < turn
), linked AS (
  SELECT r.conv_id, r.turn, r.text, b.origin AS reply_to, r.n_quotes
  FROM (SELECT conv_id, turn, text, count(*) AS n_quotes FROM runs GROUP BY ALL) r
  LEFT JOIN (SELECT * FROM ranked WHERE place = 1) b ON r.conv_id = b.conv_id AND r.turn = b.turn AND r.text = b.text
), steps AS (
  SELECT conv_id, turn, min(reply_to) AS up FROM linked WHERE reply_to IS NOT NULL GROUP BY ALL
), above AS (
  SELECT conv_id, turn, up FROM steps
  UNION ALL SELECT a.conv_id, a.turn, s.up FROM above a JOIN steps s ON a.conv_id = s.conv_id AND a.up = s.turn
), threads AS (SELECT conv_id, turn, min(up) AS thread FROM above GROUP BY ALL)
SELECT c.conv_id, c.turn, c.role, l.reply_to, coalesce(t.thread, c.turn) AS thread, coalesce(l.n_quotes, 0) AS n_quotes, {_own("c.text")} AS text
FROM conversations c
LEFT JOIN linked l ON c.conv_id = l.conv_id AND c.turn = l.turn AND c.text = l.text
LEFT JOIN threads t ON c.conv_id = t.conv_id AND c.turn = t.turn
"""

_PHRASES = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), starts AS (
  SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM words
), ones AS (
  SELECT lang, w[i] AS p, count(*) AS f FROM starts GROUP BY ALL
), twos AS (
  SELECT lang, w[i] AS w1, w[i + 1] AS w2, count(*) AS f FROM starts WHERE i + 1 <= len(w) GROUP BY ALL HAVING count(*) >= 10
), threes AS (
  SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3, count(*) AS f FROM starts WHERE i + 2 <= len(w) GROUP BY ALL HAVING count(*) >= 10
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM ones GROUP BY lang
), inside AS (
  SELECT lang, w1, w2, max(f) AS most FROM (
    SELECT lang, w1, w2, f FROM threes UNION ALL SELECT lang, w2, w3, f FROM threes) GROUP BY ALL
), cuts AS (
  SELECT t.lang, t.w1 || ' ' || t.w2 AS phrase, t.f AS a, x.f AS l, y.f AS r, 1 AS k
  FROM twos t JOIN ones x ON x.lang = t.lang AND x.p = t.w1 JOIN ones y ON y.lang = t.lang AND y.p = t.w2
  LEFT JOIN inside s ON s.lang = t.lang AND s.w1 = t.w1 AND s.w2 = t.w2
  WHERE s.most IS NULL OR 100 * s.most < 50 * t.f
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, x.f, y.f, 1
  FROM threes t JOIN ones x ON x.lang = t.lang AND x.p = t.w1 JOIN twos y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, x.f, y.f, 2
  FROM threes t JOIN twos x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2 JOIN ones y ON y.lang = t.lang AND y.p = t.w3
), marked AS (
  SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM cuts
), lowest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM marked
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest WHERE place = 1
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLES = {
    "op12_phrase_graph": _PHRASES,
    "op2_quotation_linking": _QUOTES,
    "op8_approximation_file": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.w, c.w), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""",
}
