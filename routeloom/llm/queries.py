"""The registered query of each operator, and its SQL where SQL can say it.

Each applies its operator to the whole table with production parameters and derives the columns
that are compared.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routeloom.llm.classifier import fit_documents, held_out, score_documents
from routeloom.llm.conversations import damaged, find_repairs, repaired_digests
from routeloom.llm.decontaminate import mark_contaminated
from routeloom.llm.filter_audit import audit_filters
from routeloom.llm.licenses import scan_licenses
from routeloom.llm.line_dedup import drop_repeated_lines
from routeloom.llm.near_dedup import near_duplicates
from routeloom.llm.packing import pack_documents
from routeloom.llm.rules import quality_rules
from routeloom.llm.scoring import score_documents as language_scores
from routeloom.llm.sharding import shard_documents
from routeloom.llm.substrings import remove_repeats
from routeloom.llm.token_counts import count_tokens

#: Documents with a lower probability of label 1 are rejected.
REJECT_BELOW = 0.7
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def _sha256(text: str):
    return F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(documents(spark, folder)).withColumn("coverage", F.round("coverage", 6))


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(documents(spark, folder), TOKENIZER).select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(documents(spark, folder)).select(
        "doc_id", "n_words", "n_removed", _sha256("text").alias("kept_sha256")
    )


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    return mark_contaminated(documents(spark, folder), items).select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op5_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(documents(spark, folder), size=4)


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return drop_repeated_lines(documents(spark, folder).select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", _sha256("text").alias("kept_sha256")
    )


def op7_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    scores = language_scores(documents(spark, folder))
    return scores.select("doc_id", "n_words", F.round("score", 6).alias("score"))


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    rules = quality_rules(documents(spark, folder))
    return rules.drop("class_distance", "word_distance")


def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return score_documents(docs, fit_documents(docs, labels)).select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        F.when(F.col("score") >= REJECT_BELOW, 1).otherwise(0).alias("predicted"),
    )


def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shard_documents(documents(spark, folder)).select(
        "doc_id",
        "size",
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        "grown_shard",
    )


def op11_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = count_tokens(documents(spark, folder).select("doc_id", "text"), PIECES)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit_filters(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    turns = damaged(spark.read.parquet(f"{folder}/conversations.parquet"))
    return repaired_digests(turns, find_repairs(turns)).withColumnRenamed("conv", "conv_id")


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_packing": op2_packing,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_decontamination": op4_decontamination,
    "op5_minhash_dedup": op5_minhash_dedup,
    "op6_line_dedup": op6_line_dedup,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_quality_rules": op8_quality_rules,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_sharding": op10_sharding,
    "op11_token_counts": op11_token_counts,
    "op12_filter_audit": op12_filter_audit,
    "op13_conversation_repair": op13_conversation_repair,
}

SQL = {
    "op3_substring_dedup": r"""
WITH doc_words AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), windows AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY w[i : i + 19] ORDER BY doc_id, i) AS k
  FROM doc_words, unnest(range(1, len(w) - 18)) AS t(i)
), hit AS (
  SELECT DISTINCT doc_id, p FROM windows, unnest(range(i, i + 20)) AS t(p) WHERE k > 1
), words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM doc_words
), kept AS (
  SELECT w.doc_id, count(h.p) AS n_removed,
         string_agg(word, ' ' ORDER BY w.p) FILTER (WHERE h.p IS NULL) AS text
  FROM words w LEFT JOIN hit h ON w.doc_id = h.doc_id AND w.p = h.p GROUP BY w.doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM doc_words d LEFT JOIN kept USING (doc_id)
""",
    "op4_decontamination": r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL
), item_windows AS (
  SELECT DISTINCT item_id, w[i : i + 12] AS win
  FROM item_words, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS t(i) WHERE len(w) > 0
), doc_words AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), sizes AS (SELECT DISTINCT len(win) AS n FROM item_windows
), doc_windows AS (
  SELECT doc_id, i, n, w[i : i + n - 1] AS win
  FROM doc_words, sizes, unnest(range(1, len(w) - n + 2)) AS t(i)
), hits AS (
  SELECT d.doc_id, d.i, d.n, b.item_id FROM doc_windows d JOIN item_windows b ON d.win = b.win
), words_hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM hits, unnest(range(i, i + n)) AS t(p) GROUP BY doc_id
), listed AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         array_to_string(list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), ',') AS ids
  FROM hits GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc_words d LEFT JOIN words_hit USING (doc_id) LEFT JOIN listed USING (doc_id)
""",
    "op5_minhash_dedup": r"""
WITH RECURSIVE doc_words AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS p, len(w) AS n FROM doc_words
), runs AS (
  SELECT doc_id, p, n, concat_ws(' ', word, lead(word, 1) OVER d, lead(word, 2) OVER d,
                                 lead(word, 3) OVER d) AS g
  FROM words WINDOW d AS (PARTITION BY doc_id ORDER BY p)
), shingles AS (
  SELECT DISTINCT doc_id, g FROM runs WHERE p <= greatest(n - 4, 0)
), sets AS (
  SELECT d.doc_id, count(g) AS size FROM doc_words d LEFT JOIN shingles USING (doc_id) GROUP BY ALL
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM shingles x JOIN shingles y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sets x ON a = x.doc_id JOIN sets y ON b = y.doc_id
  WHERE 100 * n >= 80 * (x.size + y.size - n)
), ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
  SELECT doc_id, doc_id AS other FROM sets
  UNION SELECT doc_id, b FROM reached JOIN ways ON other = a
), placed AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
)
SELECT doc_id, size AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN placed USING (doc_id)
""",
    "op6_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(1, 1 + len(string_split(coalesce(text, ''), chr(10))))) AS place
  FROM documents
), keyed AS (
  SELECT *, translate(
      regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), repeated AS (
  SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT k.*, r.first IS NOT NULL AND r.first <> k.doc_id AS dropped
  FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT doc_id, count(*) AS n_lines,
       CAST(count(*) FILTER (WHERE dropped) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), ''))
         AS kept_sha256
FROM marked GROUP BY doc_id
""",
    "op7_lm_scoring": r"""
WITH doc_words AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM doc_words
), total AS (SELECT count(*) AS n FROM words
), singles AS (SELECT word, count(*) AS n FROM words GROUP BY word
), pairs AS (
  SELECT doc_id, p, word, lag(word) OVER d AS before, lag(p) OVER d IS NULL AS opens
  FROM words WINDOW d AS (PARTITION BY doc_id ORDER BY p)
), doubles AS (
  SELECT before, word, count(*) AS n FROM pairs WHERE NOT opens GROUP BY before, word
), scored AS (
  SELECT pairs.doc_id, CASE
      WHEN NOT opens AND d.n >= 2 THEN log10(d.n / b.n)
      WHEN opens THEN log10(s.n / (SELECT n FROM total))
      ELSE log10(0.4) + log10(s.n / (SELECT n FROM total)) END AS score
  FROM pairs
  JOIN singles s ON pairs.word = s.word
  LEFT JOIN doubles d ON NOT opens AND pairs.word = d.word AND pairs.before = d.before
  LEFT JOIN singles b ON NOT opens AND pairs.before = b.word
), means AS (SELECT doc_id, avg(score) AS score FROM scored GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, round(score, 6) AS score
FROM doc_words d LEFT JOIN means USING (doc_id)
""",
    "op12_filter_audit": r"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), marks AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good,
         coalesce(bool_or(toxic = 1), false) AS bad FROM labels GROUP BY doc_id
), failing AS (
  SELECT part, coalesce(good, false) AS good, coalesce(bad, false) AS bad, [
      len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
      100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t), regexp_matches(t, '[#$%&*|]'),
      coalesce(docs.doc_id > min(docs.doc_id) OVER (PARTITION BY t), false)] AS fails
  FROM docs LEFT JOIN marks USING (doc_id)
), masks AS (
  SELECT part, good, bad, fails, count(*) AS n FROM failing GROUP BY ALL
), letters AS (SELECT unnest([1, 2, 3, 4, 5]) AS i
), orders AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
), steps AS (
  SELECT o, array_to_string(list_transform(o, lambda x: substr('ABCDE', x, 1)), '') AS filter_order,
         unnest([1, 2, 3, 4, 5]) AS step FROM orders
), outcomes AS (
  SELECT part, filter_order, step, o[step] AS filter, n, good, bad, fails[o[step]] AS here,
         list_contains(list_transform(o[1 : step - 1], lambda x: fails[x]), true) AS gone,
         len(list_filter(fails, lambda x: x)) = 1 AS once
  FROM masks, steps
), counted AS (
  SELECT part, filter_order, step, filter,
         coalesce(sum(n) FILTER (WHERE NOT here AND NOT gone), 0) AS kept,
         coalesce(sum(n) FILTER (WHERE here AND NOT gone), 0) AS removed,
         coalesce(sum(n) FILTER (WHERE here AND gone), 0) AS redundant,
         coalesce(sum(n) FILTER (WHERE here AND once), 0) AS unique_fails,
         coalesce(sum(n) FILTER (WHERE here AND NOT gone AND good), 0) AS good_lost,
         coalesce(sum(n) FILTER (WHERE here AND NOT gone AND bad), 0) AS toxic_lost
  FROM outcomes GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM counted
""",
}
