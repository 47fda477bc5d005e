"""The package's queries, one for each operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import language, lexical, line_dedup, mixing, near_dup, packing, phrases, preference, quality, sharding, token_count, token_file, top_k

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.judged(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly")


def op2_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, folder, "documents"))


def op3_token_file(spark: SparkSession, folder: str) -> DataFrame:
    rows = token_file.through_files(table(spark, folder, "documents"), public_tokenizers.path(WORD_BPE))
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_preference(spark: SparkSession, folder: str) -> DataFrame:
    chosen, rejected = preference.repeated_answer_pairs(table(spark, folder, "conversations"))
    return preference.preference_turns(chosen, rejected)


def op5_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = top_k.saved(top_k.integer_vectors(table(spark, folder, "embeddings")), "vectors")
    return top_k.top_k(vectors.where("vec_id % 100 = 0"), vectors)


def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    rows = sharding.sharded(table(spark, folder, "documents"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_count.token_counts(table(spark, folder, "documents"), public_tokenizers.path(BYTE_BPE))


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return language.identified(docs, language.fit(docs))


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    rows = packing.packed(table(spark, folder, "documents"), public_tokenizers.path(WORD_BPE))
    return rows.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.copies(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


def op12_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = line_dedup.dedup_lines(table(spark, folder, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(lexical.build_index(table(spark, folder, "documents")), table(spark, folder, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_token_file": op3_token_file,
    "op4_preference": op4_preference,
    "op5_top_k": op5_top_k,
    "op6_sharding": op6_sharding,
    "op7_token_counts": op7_token_counts,
    "op8_language_id": op8_language_id,
    "op9_packing": op9_packing,
    "op10_mixing": op10_mixing,
    "op11_phrases": op11_phrases,
    "op12_line_dedup": op12_line_dedup,
    "op13_lexical_search": op13_lexical_search,
}

MIX_SQL = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce('=' || source, '') AS k,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    CAST('0x' || substr(md5('mix' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT) % 64 AS salt
  FROM documents),
dealt AS (
  SELECT *, CAST(length(ltrim(bin(size), '0')) + (size = 0)::INT AS BIGINT) AS bits FROM sized),
classed AS (
  SELECT *, bits * 8 + ((size >> greatest(bits - 4, 0)) & 7) AS class FROM dealt),
sources AS (SELECT k, any_value(source) AS source, sum(size)::BIGINT AS source_size FROM classed GROUP BY k),
weighted AS (
  SELECT *, [1, 2, 3][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight, 3 * source_size AS cap FROM sources),
ranked AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open_words,
    sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight FROM weighted),
level AS (
  SELECT open_words, open_weight FROM ranked WHERE open_words * weight <= cap * open_weight
  ORDER BY cap / weight, source NULLS LAST LIMIT 1),
goal AS (
  SELECT k, source_size, least(CAST(cap AS DOUBLE), CAST(weight * level.open_words AS DOUBLE) / CAST(level.open_weight AS DOUBLE)) AS target,
    CAST(CAST('0x' || substr(md5('mix' || k), 1, 12) AS BIGINT) AS DOUBLE) / 281474976710656.0::DOUBLE AS u
  FROM ranked, level),
classes AS (
  SELECT k, class, count(*) AS n, sum(size)::BIGINT AS words, row_number() OVER (PARTITION BY k ORDER BY class DESC) AS nth
  FROM classed GROUP BY k, class),
steps AS (
  SELECT k, nth, class, n, words, target AS want, source_size AS remaining, 0::DOUBLE AS base, u, target, source_size,
    CASE WHEN source_size > 0 THEN least(3::DOUBLE, greatest(0::DOUBLE, target / source_size)) ELSE 0::DOUBLE END AS step
  FROM classes JOIN goal USING (k) WHERE nth = 1
  UNION ALL
  SELECT k, nth, class, n, words, want, remaining, base, u, target, source_size,
    CASE WHEN remaining > 0 THEN least(3::DOUBLE, greatest(0::DOUBLE, want / remaining)) ELSE 0::DOUBLE END AS step
  FROM (
    SELECT s.k, c.nth, c.class, c.n, c.words,
      s.want - (floor(s.base + s.n * s.step + s.u) - floor(s.base + s.u)) * (CAST(s.words AS DOUBLE) / CAST(s.n AS DOUBLE)) AS want,
      s.remaining - s.words AS remaining, s.base + s.n * s.step AS base, s.u, s.target, s.source_size
    FROM steps s JOIN classes c ON c.k = s.k AND c.nth = s.nth + 1)),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY k, class ORDER BY salt, size, doc_id NULLS FIRST) AS r FROM classed)
SELECT doc_id, size, source_size, target,
  CAST(size * (floor(base + r * step + u) - floor(base + (r - 1) * step + u)) AS BIGINT) AS taken
FROM numbered JOIN steps USING (k, class)
"""

TOP_K_SQL = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q, vectors c WHERE q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 10
"""

PREFERENCE_SQL = """
WITH turns AS (
  SELECT DISTINCT conv_id AS pair_id, coalesce(turn, 9223372036854775807) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations),
answers AS (
  SELECT pair_id, turn, text, max(turn) OVER (PARTITION BY pair_id) AS last FROM turns WHERE role = 'assistant'),
known AS (
  SELECT a.pair_id, any_value(a.last) AS last,
    coalesce((SELECT b.text FROM answers b WHERE b.pair_id IS NOT DISTINCT FROM a.pair_id AND b.turn < b.last ORDER BY b.turn DESC, b.text DESC LIMIT 1), '') AS instead
  FROM answers a GROUP BY a.pair_id),
chosen AS (
  SELECT t.*, k.last, k.instead FROM turns t LEFT JOIN known k ON t.pair_id IS NOT DISTINCT FROM k.pair_id),
rejected AS (
  SELECT DISTINCT pair_id, turn, role, CASE WHEN turn = last AND role = 'assistant' THEN instead ELSE text END AS text FROM chosen),
merged AS (
  SELECT pair_id, turn, role, text, bool_or(side = 1) AS in_chosen, bool_or(side = 2) AS in_rejected
  FROM (SELECT pair_id, turn, role, text, 1 AS side FROM chosen UNION ALL SELECT *, 2 FROM rejected) GROUP BY ALL),
placed AS (
  SELECT *, min(CASE WHEN NOT (in_chosen AND in_rejected) THEN turn END) OVER (PARTITION BY pair_id) AS from_turn FROM merged),
parts AS (
  SELECT *, 'prompt' AS part FROM placed WHERE from_turn IS NULL OR turn < from_turn
  UNION ALL SELECT *, 'chosen' FROM placed WHERE turn >= from_turn AND in_chosen
  UNION ALL SELECT *, 'rejected' FROM placed WHERE turn >= from_turn AND in_rejected)
SELECT pair_id, part, turn, role, '<|' || role || '|>' || chr(10) || text || chr(10) AS rendered,
  CAST(CASE WHEN part <> 'prompt' AND role = 'assistant' THEN length(role) + 5 ELSE 0 END AS INTEGER) AS loss_from,
  CAST(CASE WHEN part <> 'prompt' AND role = 'assistant' THEN length(role) + length(text) + 6 ELSE 0 END AS INTEGER) AS loss_to
FROM parts
"""

LINE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS doc,
    string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, doc, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, min(doc) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc) >= 2),
m AS (SELECT k.*, coalesce(first <> doc, false) AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count_if(gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r, doc_id
"""

LEXICAL_SQL = r"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
d AS (SELECT * FROM t WHERE len(terms) > 0),
corpus AS (SELECT count(*)::BIGINT AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d),
post AS (SELECT r, doc_id, len(terms)::BIGINT AS n, term, count(*)::BIGINT AS tf FROM (SELECT *, unnest(terms) AS term FROM d) GROUP BY ALL),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*)::BIGINT AS df FROM post SEMI JOIN q USING (term) GROUP BY term), corpus),
scored AS (
  SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM q JOIN post USING (term) JOIN w USING (term), corpus GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""

PHRASE_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
size AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, greatest(len(w) - k + 2, 1)), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM w, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 10),
cand AS (SELECT lang, k AS words, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cut AS (
  SELECT *, array_to_string(w[1:k], ' ') AS left_, array_to_string(w[k + 1:], ' ') AS right_
  FROM cand, (SELECT unnest([1, 2]) AS k) WHERE k < words),
rated AS (
  SELECT cut.*, x.f AS l, y.f AS r, (1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = left_ JOIN f y ON y.lang = cut.lang AND y.phrase = right_),
worst AS (SELECT * FROM rated QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
around AS (
  SELECT lang, part, max(a) AS f FROM (
    SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS part FROM cand WHERE words = 3) GROUP BY ALL)
SELECT worst.lang, row_number() OVER (PARTITION BY worst.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM worst JOIN size USING (lang) LEFT JOIN around ON around.lang = worst.lang AND around.part = phrase
WHERE around.f IS NULL OR 100 * around.f < 50 * a QUALIFY rank <= 2000
"""

ORACLE: dict[str, str] = {"op11_phrases": PHRASE_SQL, "op13_lexical_search": LEXICAL_SQL, "op12_line_dedup": LINE_SQL, "op4_preference": PREFERENCE_SQL, "op5_top_k": TOP_K_SQL, "op10_mixing": MIX_SQL}
